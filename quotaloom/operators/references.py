"""Orphan references: a linear merge of references and parent keys, with parent validity intervals (problem 5).

References and parents are partitioned by the same key and sorted by time, parents before references at equal times. One
pass over each key then carries three running values: the key's earliest arrival (known from a header row in front), and
the latest end of validity of the parents seen so far. So a reference is decided when it passes by:

* no header before it: the key has no parent row at all, ``missing``;
* some parent seen so far is valid beyond the reference's time: no orphan;
* the key's earliest parent comes after the reference: ``late``;
* else ``deleted``.

Running frames only (unbounded preceding to current row). A group of key and slice is buffered by its task and spills beyond the
buffer, so slices are bounded: a key with more than ``slice_rows`` references is salted, its references are spread over several
slices, and its few parent rows are copied into each. However many keys are hot, none is left whole.

Cases: null or blank references are no references. Keys compare after trimming blanks and tabs and lower-casing. Repeated
rows come out each. A parent whose loaded_at is null never becomes valid and gives no arrival; a reference whose loaded_at
is null can't be placed in time and is left out. Empty parents: every reference is ``missing``. Empty references: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOREVER = "9999-12-31 00:00:00"


def key_of(col: Column) -> Column:
    """Trimmed of blanks and tabs and lower-cased; null if nothing is left."""
    return F.nullif(F.lower(F.regexp_replace(col, r"^[ \t]+|[ \t]+$", "")), F.lit(""))


def hot_keys(refs: DataFrame, key: str, slice_rows: int) -> DataFrame:
    """(_hot, _n): the keys with more than ``slice_rows`` rows and their number of slices; at most rows / slice_rows."""
    return refs.groupBy(F.col(key).alias("_hot")).count().filter(F.col("count") > slice_rows).select("_hot", F.ceil(F.col("count") / slice_rows).cast("int").alias("_n"))


def orphan_references(
    refs: DataFrame,
    parents: DataFrame,
    *,
    ref_key: str,
    parent_key: str,
    row_id: str = "row_id",
    at: str = "loaded_at",
    deleted_at: str = "deleted_at",
    table_name: str = "refs",
    slice_rows: int = 200_000,
) -> DataFrame:
    """(table_name, row_id, key, reason, period) of every reference without a valid parent at its time."""
    r = refs.select(key_of(F.col(ref_key)).alias("_k"), F.col(at).alias("_t"), F.col(row_id).alias("_id"))
    r = r.filter(F.col("_k").isNotNull() & F.col("_t").isNotNull())
    p = parents.select(key_of(F.col(parent_key)).alias("_k"), F.col(at).alias("_t"), F.col(deleted_at).alias("_d"))
    p = p.filter(F.col("_k").isNotNull())
    slices = hot_keys(r, "_k", slice_rows)
    r = r.join(slices, F.col("_k") == F.col("_hot"), "left").withColumn("_s", F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_n")).cast("int"), F.lit(0))).drop("_hot", "_n")
    head = p.groupBy("_k").agg(F.min("_t").alias("_first"))
    kinds = [
        head.select("_k", F.lit(None).cast("timestamp_ntz").alias("_t"), F.lit(0).alias("_kind"), F.lit(None).cast("timestamp_ntz").alias("_d"), F.col("_first").cast("timestamp_ntz").alias("_first")),
        p.filter(F.col("_t").isNotNull()).select("_k", F.col("_t").cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_kind"), F.coalesce(F.col("_d").cast("timestamp_ntz"), F.lit(FOREVER).cast("timestamp_ntz")).alias("_d"), F.lit(None).cast("timestamp_ntz").alias("_first")),
    ]
    side = kinds[0].unionByName(kinds[1])
    side = side.join(slices, F.col("_k") == F.col("_hot"), "left").withColumn("_s", F.explode(F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1))).drop("_hot", "_n")
    side = side.withColumn("_id", F.lit(None).cast(refs.schema[row_id].dataType))
    stream = side.unionByName(
        r.select("_k", F.col("_t").cast("timestamp_ntz").alias("_t"), F.lit(2).alias("_kind"), F.lit(None).cast("timestamp_ntz").alias("_d"), F.lit(None).cast("timestamp_ntz").alias("_first"), "_s", "_id")
    )
    # header rows sort first by their null time; parents come before references at the same time
    w = Window.partitionBy("_k", "_s").orderBy(F.col("_t").asc_nulls_first(), "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = stream.select(
        "_id", "_k", "_t", "_kind",
        F.max(F.when(F.col("_kind") == 0, 1)).over(w).alias("_any"),
        F.min("_first").over(w).alias("_first"),
        F.max("_d").over(w).alias("_until"),
    )
    late = F.col("_first").isNotNull() & (F.col("_first") > F.col("_t"))
    reason = F.when(F.col("_any").isNull(), "missing").when(late, "late").otherwise("deleted")
    orphan = (F.col("_kind") == 2) & ~F.coalesce(F.col("_until") > F.col("_t"), F.lit(False))
    return merged.filter(orphan).select(
        F.lit(table_name).alias("table_name"), F.col("_id").alias("row_id"), F.col("_k").alias("key"), reason.alias("reason"), F.date_format("_t", "yyyy-MM").alias("period")
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per table, reason and period."""
    return orphans.groupBy("table_name", "period", "reason").agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys"))
