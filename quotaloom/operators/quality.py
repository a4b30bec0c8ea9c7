"""Quality control of text records (survey V15, V16, Q1, Q3, Q4, Q8, W8, A27).

Rules are named columns; all are evaluated in one pass and a record carries every rule it breaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotaloom.functions.names import ACCENTED, exact_key
from quotaloom.functions.numbers import ABBREVIATIONS

#: Characters per length class; fixed values of the domain.
LENGTHS = {"short": (5, 40), "medium": (30, 90), "long": (70, 160)}
PARTICLES = ["nhé", "nha", "với", "ạ", "đi", "nhỉ"]


def hard_rules(text: Column, length_class: Column) -> dict[str, Column]:
    """A record that breaks one is rejected."""
    low = F.coalesce(*[F.when(length_class == k, lo) for k, (lo, _) in LENGTHS.items()])
    high = F.coalesce(*[F.when(length_class == k, hi) for k, (_, hi) in LENGTHS.items()])
    abbreviations = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
    return {
        "digits": text.rlike("[0-9]"),
        "abbreviation": text.rlike(rf"(?U)(?<!\w)({abbreviations})(?!\w)"),
        "open_slot": text.rlike("[{}]"),
        "length": (F.length(text) < low) | (F.length(text) > high),
        "charset": text.rlike(f"[^a-zA-Z0-9{ACCENTED}\\s.,!?:;'\"()/-]"),
        "white_space": (text != F.trim(text)) | text.contains("  ") | text.rlike(r"[\t\r\n]"),
    }


def soft_rules(text: Column, length_class: Column) -> dict[str, Column]:
    """A flag for review, no rejection."""
    words = F.split(F.lower(text), " +")
    repeated = F.exists(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda i: (F.get(words, i) == F.get(words, i - 1)) & (F.get(words, i) != ""))
    stacked = F.exists(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda i: F.get(words, i).isin(PARTICLES) & F.get(words, i - 1).isin(PARTICLES))
    high = F.coalesce(*[F.when(length_class == k, hi) for k, (_, hi) in LENGTHS.items()])
    return {"long": F.length(text) > high * 1.5, "repeated_word": repeated, "stacked_particles": stacked}


def broken(rules: dict[str, Column]) -> Column:
    """The names of all broken rules in order; a null text breaks none but ``length`` of nothing, so callers filter nulls."""
    return F.array_compact(F.array(*[F.when(c, name) for name, c in rules.items()]))


def exact_dedup(df: DataFrame, text: str, order: list[str]) -> DataFrame:
    """Q1: the first record of each key, by a pre-aggregated minimum of the order columns only, joined back to the rows."""
    keyed = df.withColumn("_key", F.unhex(F.sha2(exact_key(F.col(text)), 256)))  # 32 bytes travel, not the text
    first = keyed.groupBy("_key").agg(F.min(F.struct(*order)).alias("_o"))
    return keyed.join(first, (keyed["_key"].eqNullSafe(first["_key"])) & (F.struct(*order) == F.col("_o")), "left_semi").drop("_key")


def keep_per_group(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """At most ``n`` rows per group. The window's rank limit is pushed below its shuffle, so a hot group is cut
    in each partition first."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def coverage_gate(domain: DataFrame, key: str, seen: DataFrame) -> DataFrame:
    """Q8: (key, verdict) for every value that must occur."""
    hit = seen.select(key).distinct().withColumn("_hit", F.lit(True))
    return domain.select(key).distinct().join(hit, key, "left").select(key, F.when(F.col("_hit"), "PASS").otherwise("FAIL").alias("verdict"))
