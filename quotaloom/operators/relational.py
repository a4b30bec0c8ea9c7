"""Joins, first-per-group, set differences, paging and counting shapes (survey J, W1, T, U, A)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_text(c: Column) -> Column:
    """A key without blanks and tabs at its ends; null if blank."""
    return F.nullif(F.regexp_replace(c, r"^[ \t]+|[ \t]+$", ""), F.lit(""))


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key by ``order``: one aggregate with map-side combine, no sort."""
    rest = [c for c in df.columns if c not in (key, *order)]
    got = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_r"))
    return got.select(*[F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in df.columns])


def latest_rows(df: DataFrame, key: str, at: str, columns: list[str]) -> DataFrame:
    """The last row of each key by ``at``, with ``columns`` only, for tables where few keys come more than once.

    Only keys and times are aggregated, in fixed width; rows of keys that come once stay where they are. Of different rows of one
    key at one time the greatest counts. Null keys are left out.
    """
    rest = [c for c in dict.fromkeys(columns) if c not in (key, at)]
    rows = df.select(key, F.col(at).alias("_at"), *rest, *([F.col(at)] if at in columns else [])).filter(F.col(key).isNotNull())
    again = rows.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"), F.max("_at").alias("_last")).filter("_n > 1").select("_k", "_last")
    once = rows.join(again, F.col(key) == F.col("_k"), "left_anti").select(*columns)
    named = [c for c in dict.fromkeys(columns) if c != key]
    if not named:
        return once.unionByName(again.select(F.col("_k").alias(key)))
    several = rows.join(again, (F.col(key) == F.col("_k")) & F.col("_at").eqNullSafe(F.col("_last")))
    several = several.groupBy(key).agg(F.array_max(F.collect_set(F.struct(*named))).alias("_r"))  # equal deliveries are one
    return once.unionByName(several.select(*[F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in columns]))


def first_per_group(df: DataFrame, keys: list[Column], order: list[str]) -> DataFrame:
    """The first row of each group by ``order``, which must be total."""
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    rest = [c for c in df.columns if c not in order]
    got = df.select("*", *named).groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(F.min(F.struct(*order, *rest)).alias("_r"))
    return got.select(*[F.col(f"_r.{c}").alias(c) for c in df.columns])


def two_path_parent(child: DataFrame, middle: DataFrame, middle_key: str, parent_key: str) -> DataFrame:
    """The parent through ``middle``, else the child's own reference."""
    m = middle.select(F.col(middle_key).alias("_m"), F.col(parent_key).alias("_p"))
    joined = child.join(m, F.col(middle_key) == F.col("_m"), "left")
    return joined.withColumn("resolved", F.coalesce("_p", parent_key)).drop("_m", "_p")


def alias_lookup(names: DataFrame, name: str, aliases: DataFrame, alias: str, current: DataFrame, current_name: str, target: str, order: list[str]) -> DataFrame:
    """``target`` of each name; the last alias row by ``order`` wins, current names only fill gaps."""
    a = aliases.select(F.lower(alias).alias("_k"), F.lit(1).alias("_rank"), F.struct(*order).alias("_o"), F.col(target).alias("_t"))
    c = current.select(F.lower(current_name).alias("_k"), F.lit(0).alias("_rank"), F.lit(None).cast(a.schema["_o"].dataType).alias("_o"), F.col(target).alias("_t"))
    best = a.unionByName(c).filter(F.col("_k").isNotNull()).groupBy("_k").agg(F.max(F.struct("_rank", "_o", "_t"))["_t"].alias(target))
    return names.join(best, F.lower(name) == F.col("_k"), "left").drop("_k")


def missing_parents(rule: str, child: DataFrame, ref: str, row: str, parent: DataFrame, key: str) -> DataFrame:
    """(rule, row, ref) of every reference without a parent; blank references are none."""
    refs = child.select(F.lit(rule).alias("rule"), F.col(row).cast("string").alias("row"), key_text(F.col(ref)).alias("ref")).filter("ref is not null")
    return refs.join(parent.select(key_text(F.col(key)).alias("ref")).distinct(), "ref", "left_anti")


def duplicates(table: str, df: DataFrame, key: str) -> DataFrame:
    """(table_name, key, n) of keys that occur more than once."""
    return df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n")).filter("n > 1").select(F.lit(table).alias("table_name"), "key", "n")


def prefer_left(left: DataFrame, right: DataFrame, keys: list[Column]) -> DataFrame:
    """All of ``left``, and the rows of ``right`` whose keys ``left`` lacks."""
    names = [f"_k{i}" for i in range(len(keys))]
    k = left.select(*[c.alias(n) for c, n in zip(keys, names)]).distinct()
    rest = right.select("*", *[c.alias(n) for c, n in zip(keys, names)]).join(k, names, "left_anti").drop(*names)
    return left.unionByName(rest)


def difference(a: DataFrame, b: DataFrame, key: str, a_name: str, b_name: str) -> DataFrame:
    """Keys on one side only, by one full outer join of the distinct keys."""
    x, y = (d.select(F.col(key)).filter(F.col(key).isNotNull()).distinct().withColumn(n, F.lit(True)) for d, n in ((a, "_x"), (b, "_y")))
    both = x.join(y, key, "full_outer").filter(F.col("_x").isNull() | F.col("_y").isNull())
    return both.select(key, F.when(F.col("_y").isNull(), F.lit(a_name)).otherwise(F.lit(b_name)).alias("only_in"))


def by_precedence(rows: DataFrame, weights: DataFrame, axis: str, levels: list[str]) -> DataFrame:
    """The weight of each value: ``weights`` (level, key, value, weight), the first of ``levels`` that has one wins.

    ``rows`` has a column per level with the key to look up, the last level being a constant default.
    """
    out = rows
    for i, level in enumerate(levels):
        w = weights.filter(F.col("level") == level).select(F.col("key").alias(f"_key{i}"), F.col(axis).alias(f"_v{i}"), F.col("weight").alias(f"_w{i}"))
        out = out.join(w, (F.col(level) == F.col(f"_key{i}")) & (F.col(axis) == F.col(f"_v{i}")), "left").drop(f"_key{i}", f"_v{i}")
    return out.withColumn("weight", F.coalesce(*[F.col(f"_w{i}") for i in range(len(levels))])).drop(*[f"_w{i}" for i in range(len(levels))])


def page(df: DataFrame, order: list[str], number: int, size: int) -> DataFrame:
    """One page in a total order; pages below 1 are the first. A top-k of the rows up to the page's end."""
    return df.orderBy(*order).offset((max(number, 1) - 1) * size).limit(size)


def grid(spark, **axes: list[str]) -> DataFrame:
    """All combinations of fixed value lists, by nested explodes of literals."""
    out = spark.range(1).select()
    for name, values in axes.items():
        out = out.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return out


def grid_counts(df: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per cell over the full grid, zeros included."""
    n = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return cells.join(n, keys, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def marginals(df: DataFrame, axes: list[str]) -> DataFrame:
    """(axis, value, n) of all axes in one pass: each row is expanded to its axes before one aggregate."""
    pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).cast("string").alias("value")) for a in axes]))
    return df.select(pairs.alias("_p")).groupBy("_p.axis", "_p.value").agg(F.count("*").alias("n"))


def positional(items: DataFrame, group: list[str], index: str, pool: DataFrame, rank: str) -> DataFrame:
    """Item i of a group gets the pool's row i mod its size; ``rank`` numbers the pool from 0 in each group.

    The pool's size joins first, so the second join is an equi-join on group and rank.
    """
    sizes = pool.groupBy(*group).agg(F.count("*").alias("_size"))
    at = items.join(sizes, group).withColumn(rank, F.pmod(F.col(index), F.col("_size"))).drop("_size")
    return at.join(pool, [*group, rank])


def ranked(df: DataFrame, group: list[str], order: list[Column], name: str, start: int = 1) -> DataFrame:
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*group).orderBy(*order)) + (start - 1)).cast("long"))


def union_all(*dfs: DataFrame) -> DataFrame:
    """U1."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
