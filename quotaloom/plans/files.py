"""Round trips through the file formats (survey S1-S3, S7, S9, K1-K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotaloom.operators import relational as R
from quotaloom.plans.generate import _DRAWN_SQL, generated
from quotaloom.plans.master import districts, provinces, with_views
from quotaloom.plans.registry import query, table
from quotaloom.sources import files
from quotaloom.workspace import cut, new_path


@query("roundtrip_master_csv", with_views("prov", "dist") + "SELECT 'provinces' AS table_name, province_id AS key, name_current AS name, popularity_tier::VARCHAR || is_municipality::VARCHAR AS rest FROM prov UNION ALL SELECT 'districts', district_id, name, coalesce(province_id, '') FROM dist")
def roundtrip_master_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2, S3, K1."""
    folder = new_path(spark, "master")
    p, d = provinces(spark, sf_dir), districts(spark, sf_dir)
    files.write_master({"provinces": p, "districts": d}, folder)
    m = files.read_master(spark, folder)
    rest = F.concat(F.col("popularity_tier").cast("string"), F.col("is_municipality").cast("string"))
    a = m["provinces"].select(F.lit("provinces").alias("table_name"), F.col("province_id").alias("key"), F.col("name_current").alias("name"), rest.alias("rest"))
    b = m["districts"].select(F.lit("districts").alias("table_name"), F.col("district_id").alias("key"), "name", F.coalesce("province_id", F.lit("")).alias("rest"))
    return R.union_all(a, b, *[m[t].select(F.lit(t).alias("table_name"), F.lit("").alias("key"), F.lit("").alias("name"), F.lit("").alias("rest")) for t in ("wards", "streets", "pois")])


@query("roundtrip_plan_json", "SELECT province_id, category, sentence_type, variation_profile, sum(target_count)::INT AS target_count FROM (SELECT DISTINCT * FROM plan_small) GROUP BY ALL HAVING sum(target_count) > 0")
def roundtrip_plan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7, K2."""
    keys = ["province_id", "category", "sentence_type", "variation_profile"]
    cells = table(spark, sf_dir, "plan_small").distinct().groupBy(*keys).agg(F.sum("target_count").cast("int").alias("target_count")).filter("target_count > 0")
    path = new_path(spark, "plan")
    files.write_plan(cells, path, "run", 42)
    return files.read_plan(spark, path)


@query("roundtrip_samples_csv", _DRAWN_SQL + "SELECT substr(sha1(cell || '|' || i), 1, 16) AS id, cell AS seed_cell, entity_id, 0 AS differing FROM pairs")
def roundtrip_samples_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that come back, in all twenty columns, and how many of the written ones differ from them."""
    path, names = new_path(spark, "samples"), files.schemas.SAMPLES.fieldNames()
    rows = cut(generated(spark, sf_dir).select(*[F.coalesce(c, F.lit("")).alias(c) for c in names]), "samples-written")
    files.write_samples(rows, path)
    back = files.read_samples(spark, path).select(*[F.coalesce(c, F.lit("")).alias(c) for c in names])
    differing = rows.exceptAll(back).unionAll(back.exceptAll(rows)).count()
    return back.select("id", "seed_cell", "entity_id", F.lit(differing).cast("int").alias("differing"))
