"""Rules that class elements by their tags; the first rule that matches decides (survey P7-P9)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``key`` = ``value``, and every tag of ``require``, and none of ``exclude``."""

    key: str
    value: str
    category: str
    subcategory: str
    require: dict[str, str] = field(default_factory=dict)
    exclude: dict[str, str] = field(default_factory=dict)


def matches(tags: Column, rule: Rule, exclusions: bool = True) -> Column:
    """Whether a rule matches; without ``exclusions`` its wider form for a scan, which a later step refines."""
    hit = F.coalesce(tags[rule.key] == rule.value, F.lit(False))
    for k, v in rule.require.items():
        hit = hit & F.coalesce(tags[k] == v, F.lit(False))
    for k, v in rule.exclude.items() if exclusions else ():
        hit = hit & ~F.coalesce(tags[k] == v, F.lit(False))
    return hit


def classify(tags: Column, rules: list[Rule]) -> Column:
    """A struct of category and subcategory by the first matching rule, null without one; a single CASE."""
    out = None
    for r in rules:
        value = F.struct(F.lit(r.category).alias("category"), F.lit(r.subcategory).alias("subcategory"))
        out = F.when(matches(tags, r), value) if out is None else out.when(matches(tags, r), value)
    return out


def mapped(tags: Column, key: str, table: dict[str, str]) -> Column:
    """The subcategory that a map gives for the tag ``key``; null without one."""
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[tags[key]]
