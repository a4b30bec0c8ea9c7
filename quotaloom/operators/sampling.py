"""The least rows of each cell by a uniform number, without sorting whole cells (survey Q7, W9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def take_lowest(rows: DataFrame, cells: DataFrame, keys: list[str], u: Column, order: str) -> DataFrame:
    """The ``quota`` rows of each cell with the least (u, order); ``cells`` has keys, ``observed`` rows and ``quota``.

    u is uniform in [0, 1), so about quota / observed of a cell's rows lie below that share. Rows below it less a margin of four standard
    deviations are taken without ranking, only those within the margin are ranked. A cell whose margin doesn't hold, one in
    10,000, is ranked whole. Rows of cells without a quota are left out.
    """
    ratio, margin = F.col("quota") / F.col("observed"), (4 * F.sqrt("quota") + 8) / F.col("observed")
    whole = F.col("quota") >= F.col("observed")
    bounds = cells.filter("quota > 0").select(*keys, F.col("quota").alias("_q"), F.when(whole, 2.0).otherwise(ratio - margin).alias("_lo"), F.when(whole, 2.0).otherwise(ratio + margin).alias("_hi"))
    marked = rows.withColumn("_u", u).join(bounds, keys)
    sure = F.col("_u") < F.col("_lo")
    have = marked.groupBy(*keys).agg(F.count_if(sure).alias("_sure"), F.count_if(F.col("_u") < F.col("_hi")).alias("_within"), F.count("*").alias("_all"), F.max("_q").alias("_m"))
    ok = (F.col("_sure") <= F.col("_m")) & (F.col("_within") >= F.least("_m", "_all"))
    marked = marked.join(have.select(*keys, "_sure", ok.alias("_ok")), keys)
    direct = marked.filter(F.col("_ok") & sure)
    band = marked.filter(F.when(F.col("_ok"), (F.col("_u") < F.col("_hi")) & ~sure).otherwise(True))
    n = F.row_number().over(Window.partitionBy(*keys).orderBy("_u", order))
    band = band.withColumn("_n", n).filter(F.col("_n") <= F.col("_q") - F.when(F.col("_ok"), F.col("_sure")).otherwise(0))
    return direct.select(*rows.columns).unionByName(band.select(*rows.columns))
