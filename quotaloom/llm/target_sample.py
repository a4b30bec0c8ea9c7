"""A sample that matches target category counts, with a report of unmet targets (problem 6).

Per cell, the acceptance probability is the ratio of target to observed records. Every record has a fixed number u in
[0, 1), a hash of its id, and is drawn independently: u below the probability less a margin is drawn for sure, u within the
margin is the slight oversampling. The margin is four standard deviations of the binomial count, so the sure draws fall
short of the target and the band makes up for it in all but about one cell in 10,000; the exact correction then ranks the
band alone and takes what is missing. A cell whose band doesn't suffice has its whole rest ranked. So a cell with a third of
all rows sorts only about 8 * sqrt(target) of them.

Cases: null or missing targets make no cell; rows of the plan that are equal in all columns count once; a target of 0 draws
nothing (``minimum`` applies to positive targets); a cell without records comes out with its whole target as deficit; records
with a null category match no cell; a record delivered again counts once, with the least of its deliveries' keys taken together. Ties in u go to the smaller id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotaloom.functions.words import unit_hash
from quotaloom.workspace import bounded_broadcast, cut

MAX_CELLS = 200_000


def cell_targets(plan: DataFrame, keys: list[str], target: str) -> DataFrame:
    """Sum of the targets per cell, over plan rows that differ in some column; cells without any target are left out."""
    return plan.distinct().groupBy(*keys).agg(F.sum(F.col(target).cast("long")).alias("target")).filter(F.col("target").isNotNull())


def draw_to_targets(records: DataFrame, cells: DataFrame, *, record: str, keys: list[str], target: str = "target", minimum: int = 0, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(sample, report). ``cells`` has one row per combination of ``keys`` with its target.

    sample: the keys and the record id. report: the cell's columns with observed, quota, drawn, deficit; the quota is
    the target, raised to ``minimum`` for positive targets, and deficit is what the target lacks.
    """
    own = ("observed", "quota", "drawn", "deficit", "_lo", "_hi")  # columns of the report; cells that bring such names lose them
    cells = cells.drop(*own)
    once = records.select(F.col(record).alias("_id"), *[F.col(k).alias(k) for k in keys]).filter(F.col(record).isNotNull())
    least = once.groupBy("_id").agg(F.min(F.struct(*[F.col(k) for k in keys])).alias("_r")).select("_id", *[F.col("_r")[k].alias(k) for k in keys])
    once = cut(least.withColumn("_u", unit_hash(F.col("_id"), F.lit(seed))), "records")
    observed = once.groupBy(*keys).agg(F.count("*").alias("observed"))
    quota = F.when(F.col(target) > 0, F.greatest(F.col(target), F.lit(minimum))).otherwise(0).cast("long")
    plan = cells.join(observed, keys, "left").withColumn("observed", F.coalesce("observed", F.lit(0).cast("long"))).withColumn("quota", quota)
    ratio, margin = F.col("quota") / F.col("observed"), (4 * F.sqrt("quota") + 8) / F.col("observed")
    whole = F.col("quota") >= F.col("observed")
    plan = cut(plan.withColumn("_lo", F.when(whole, 1.0).otherwise(ratio - margin)).withColumn("_hi", F.when(whole, 1.0).otherwise(ratio + margin)), "cells")
    marked = once.join(bounded_broadcast(plan.filter((F.col("quota") > 0) & (F.col("observed") > 0)).select(*keys, F.least("quota", "observed").alias("_q"), "_lo", "_hi"), MAX_CELLS), keys)
    sure, band = F.col("_u") < F.col("_lo"), F.col("_u") < F.col("_hi")
    have = marked.groupBy(*keys).agg(F.count_if(sure).alias("_sure"), F.count_if(band).alias("_within"), F.max("_q").alias("_m"))
    have = have.select(*keys, "_sure", ((F.col("_sure") <= F.col("_m")) & (F.col("_within") >= F.col("_m"))).alias("_ok"))
    marked = marked.join(bounded_broadcast(have, MAX_CELLS), keys)
    ranked = marked.filter(F.when(F.col("_ok"), band & ~sure).otherwise(True))
    w = Window.partitionBy(*keys).orderBy("_u", "_id")
    missing = F.col("_q") - F.when(F.col("_ok"), F.col("_sure")).otherwise(0)
    filled = ranked.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= missing)
    sample = cut(marked.filter(F.col("_ok") & sure).select(*keys, "_id").unionByName(filled.select(*keys, "_id")), "sample")
    drawn = sample.groupBy(*keys).agg(F.count("*").alias("drawn"))
    report = plan.drop("_lo", "_hi").join(drawn, keys, "left").withColumn("drawn", F.coalesce("drawn", F.lit(0).cast("long")))
    report = report.withColumn("deficit", F.greatest(F.col(target) - F.col("drawn"), F.lit(0).cast("long")))
    return sample.withColumnRenamed("_id", record), report
