"""Sentence templates with slots: classes, substitution and rules (survey F15-F18, F23-F26, V4-V10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotaloom.functions.numbers import ABBREVIATIONS

SLOTS = ["opener", "entity", "closer", "category_noun"]
# Fixed values of the domain.
SENTENCE_TYPES = ["nav_command", "search", "route_question", "conversational", "short_command", "contextual"]
REGISTERS, LENGTH_CLASSES = ["formal", "neutral", "casual"], ["short", "medium", "long"]
QUANTIFIERS = ["một", "các", "những", "mấy", "vài", "cái"]
WAY_WORDS = ["đường", "lối", "hướng", "phố"]


def slots_of(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\{([a-zA-Z_]+)\}"), 1)))


def skeleton_length(text: Column) -> Column:
    """length without slots."""
    return F.length(F.trim(F.regexp_replace(text, r"\{[a-zA-Z_]+\}", "")))


def bare_tokens(text: Column) -> Column:
    """F26."""
    return F.filter(F.split(F.regexp_replace(text, r"\{[a-zA-Z_]+\}|,", " "), " +"), lambda t: t != "")


def substitute(text: Column, **slots: Column) -> Column:
    """an opener brings a blank after it, a closer one before it; white space is squeezed."""
    for name, value in slots.items():
        value = F.coalesce(value, F.lit(""))
        if name == "opener":
            value = F.when(value != "", F.concat(value, F.lit(" "))).otherwise("")
        if name == "closer":
            value = F.when(value != "", F.concat(F.lit(" "), value)).otherwise("")
        text = F.replace(text, F.lit("{" + name + "}"), value)
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def tail_class(text: Column, question_words: list[str], particles: list[str]) -> Column:
    """F16: what stands right before the closer."""
    tail = F.lower(F.regexp_extract(text, r"(\S+)\{closer\}$", 1))
    after_comma = F.substring_index(text, ",", -1)
    clause = text.contains(",") & ~after_comma.contains("{entity}")
    return F.when(tail == "{entity}", "plain").when(tail.isin(question_words), "question").when(tail.isin(particles), "particle").when((tail != "") & clause, "trailing_clause").otherwise("plain")


def head_class(text: Column, statement_markers: list[str]) -> Column:
    """anything that doesn't begin as a statement counts as imperative."""
    head = F.lower(F.regexp_extract(text, r"^(?:\{opener\})?(\S+)", 1))
    return F.when(head.isin(statement_markers), "statement").otherwise("imperative")


def starts_with_ask(text: Column, word: str = "hỏi", window: int = 5) -> Column:
    """F18."""
    head = F.slice(F.filter(F.split(F.replace(text, F.lit("{opener}"), F.lit("")), r"\s+"), lambda w: w != ""), 1, window)
    return F.exists(head, lambda w: F.trim(F.regexp_replace(w, "^[,.]+|[,.]+$", "")) == word)


def template_issues(template_id: Column, slots: Column, text: Column, allowed_words: list[str]) -> Column:
    """The names of all rules that a template breaks, in rule order."""
    abbreviations = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
    words = F.split(text, r"\s+")
    stripped = F.transform(F.slice(words, 2, F.size(words)), lambda w: F.regexp_replace(F.regexp_replace(w, r"\{[a-zA-Z_]+\}", ""), "^[,.!?;:\"'()]+|[,.!?;:\"'()]+$", ""))
    proper = F.exists(stripped, lambda w: w.rlike(r"^\p{Lu}") & ~w.isin(allowed_words))
    rules = [
        (F.array_sort(F.array_distinct(slots)) != slots_of(text), "slots_match"),
        (F.size(F.array_except(slots, F.array(*[F.lit(s) for s in SLOTS]))) > 0, "slots_allowed"),
        (~text.contains("{entity}"), "has_entity"),
        (text.rlike("[0-9]"), "no_digits"),
        (text.rlike(rf"(?U)(?<!\w)({abbreviations})(?!\w)"), "no_abbreviation"),
        (proper, "no_proper_noun"),
        ((text != F.trim(text)) | text.contains("  ") | text.rlike(r"\s\{(opener|closer)\}|\{(opener|closer)\}\s"), "spacing"),
        (text.rlike(r"(?U)\{entity\}\s+nào\b") | text.rlike(rf"(?U)\b({'|'.join(QUANTIFIERS)})\s+\{{entity\}}") | text.rlike(r"(?U)\{entity\}[^{}]{0,20}?\bgần(?:\s+đây)?\s+nhất\b"), "no_common_noun"),
        (text.rlike(rf"(?U)\b({'|'.join(WAY_WORDS)})\s+\{{entity\}}"), "no_bare_classifier"),
    ]
    return F.array_compact(F.array(*[F.when(broken, name) for broken, name in rules]))


def table_issues(templates: DataFrame, allowed_words: list[str]) -> DataFrame:
    """(template_id, rule) of every broken rule of a table of templates: ids that are missing or not unique, values outside the
    fixed lists, and the rules of ``template_issues``. Ids are counted by an aggregate, not by a window over the table."""
    known = {"sentence_type": SENTENCE_TYPES, "register": REGISTERS, "length_class": LENGTH_CLASSES}
    enums = [F.when(~F.coalesce(F.col(c).isin(v), F.lit(False)), f"known_{c}") for c, v in known.items()]
    named = F.coalesce("template_id", F.lit("")) != ""
    rules = F.concat(F.array_compact(F.array(F.when(~named, "has_id"), *enums)), template_issues(F.col("template_id"), F.col("slots"), F.col("text"), allowed_words))
    twice = templates.filter(named).groupBy("template_id").count().filter("count > 1").select("template_id", F.lit("unique_id").alias("rule"))
    return templates.select(F.coalesce("template_id", F.lit("")).alias("template_id"), F.explode(rules).alias("rule")).unionByName(twice)
