"""Queries of problem 5: references to records that don't exist at the time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotaloom.operators.references import orphan_references, orphan_report
from quotaloom.plans.registry import query, table

_SQL = """
WITH
refs AS (
  SELECT 'wards' AS table_name, row_id, 'd' AS parent, district_id AS key, loaded_at FROM wards
  UNION ALL SELECT 'districts', row_id, 'p', province_id, loaded_at FROM districts
  UNION ALL SELECT 'province_alias', row_id, 'p', province_id, loaded_at FROM province_alias),
r AS (SELECT table_name, row_id, parent, lower(trim(key, ' ' || chr(9))) AS key, loaded_at FROM refs WHERE trim(key, ' ' || chr(9)) <> ''),
p AS (SELECT 'd' AS parent, lower(trim(district_id, ' ' || chr(9))) AS key, loaded_at, deleted_at FROM districts
  UNION ALL SELECT 'p', lower(trim(province_id, ' ' || chr(9))), loaded_at, deleted_at FROM provinces),
f AS (SELECT parent, key, min(loaded_at) AS first FROM p GROUP BY ALL),
o AS (SELECT r.table_name, r.row_id, r.key, CASE WHEN f.key IS NULL THEN 'missing' WHEN f.first > r.loaded_at THEN 'late' ELSE 'deleted' END AS reason,
    strftime(r.loaded_at, '%Y-%m') AS period
  FROM r LEFT JOIN f USING (parent, key)
  WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.parent = r.parent AND p.key = r.key AND p.loaded_at <= r.loaded_at
    AND (p.deleted_at IS NULL OR p.deleted_at > r.loaded_at)))
"""


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    wards, districts, provinces, alias = (table(spark, sf_dir, t) for t in ("wards", "districts", "provinces", "province_alias"))
    return (
        orphan_references(wards, districts, ref_key="district_id", parent_key="district_id", table_name="wards")
        .unionByName(orphan_references(districts, provinces, ref_key="province_id", parent_key="province_id", table_name="districts"))
        .unionByName(orphan_references(alias, provinces, ref_key="province_id", parent_key="province_id", table_name="province_alias"))
    )


@query("p5_found", _SQL + "SELECT table_name, row_id, reason, period FROM o")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans(spark, sf_dir).select("table_name", "row_id", "reason", "period")


@query("p5_report", _SQL + "SELECT table_name, period, reason, count(*) AS n, count(DISTINCT key) AS keys FROM o GROUP BY ALL")
def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_report(orphans(spark, sf_dir)).select("table_name", "period", "reason", F.col("n"), F.col("keys"))
