"""Random draws from hashes: the same for any partitioning, and in any SQL engine with sha256 (survey 2.11, W3, W4, F11-F14)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the parts joined by ``|``."""
    text = F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def uniform_sql(*parts: str) -> str:
    """The same number in the SQL of the tests."""
    return f"(('0x' || substr(sha256(concat_ws('|', {', '.join(parts)})), 1, 13))::BIGINT / 4503599627370496.0)"


def race_key(u: Column, weight: Column) -> Column:
    """Efraimidis-Spirakis: the rows with the largest keys are a weighted sample without replacement."""
    return F.round(F.pow(F.greatest(u, F.lit(1e-12)), 1 / weight), 12)


def cell_key(*parts: Column) -> Column:
    """F11."""
    return F.concat_ws("|", *parts)


def cell_seed(seed: Column, key: Column) -> Column:
    """the first 8 bytes of a sha256 as an unsigned number."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", seed, key), 256), 1, 16), 16, 10).cast("decimal(20,0)")


def sample_id(key: Column, i: Column) -> Column:
    """F13."""
    return F.substring(F.sha1(F.concat_ws("|", key, i.cast("string"))), 1, 16)


def pick(pool: Column, u: Column) -> Column:
    """A uniform choice from an array; null from an empty one."""
    return F.get(pool, F.floor(u * F.size(pool)).cast("int"))


def weighted_pick(options: list[tuple[str, float]], u: Column) -> Column:
    """W4 over a fixed list: the first option, in key order, whose cumulative weight exceeds the draw."""
    options = sorted(options)
    total, run, out = sum(w for _, w in options), 0.0, None
    for name, w in options:
        run += w
        hit = u * total < F.lit(run)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(options[-1][0])
