"""Queries of quality control, reports, spatial joins and event windows (survey Q1, Q3, Q4, Q8, A13-A15, A25, A27, J7-J9, K4, K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotaloom.functions.names import ACCENTED
from quotaloom.operators import quality as Y
from quotaloom.operators import relational as R
from quotaloom.operators import spatial as S
from quotaloom.plans.master import aliases, districts, entities, provinces, samples, wards, with_views
from quotaloom.plans.registry import query, table
from quotaloom.workspace import cut

_CLASS_SQL = "CASE WHEN template_id LIKE '%short%' THEN 'short' WHEN template_id LIKE '%long%' THEN 'long' ELSE 'medium' END"
_RULES_SQL = f"""x AS (SELECT id, text, lower(text) AS l, {_CLASS_SQL} AS lc FROM samp WHERE text IS NOT NULL),
y AS (SELECT id, list_filter([
 CASE WHEN regexp_matches(text, '[0-9]') THEN 'digits' END,
 CASE WHEN regexp_matches(text, '(^|[^\\p{{L}}\\p{{M}}\\p{{N}}_])(TP|Q\\.|P\\.|H\\.|BV|TTTM|QL|TL)($|[^\\p{{L}}\\p{{M}}\\p{{N}}_])') THEN 'abbreviation' END,
 CASE WHEN regexp_matches(text, '[{{}}]') THEN 'open_slot' END,
 CASE WHEN length(text) < CASE lc WHEN 'short' THEN 5 WHEN 'medium' THEN 30 ELSE 70 END OR length(text) > CASE lc WHEN 'short' THEN 40 WHEN 'medium' THEN 90 ELSE 160 END THEN 'length' END,
 CASE WHEN regexp_matches(text, '[^a-zA-Z0-9{ACCENTED}\\s.,!?:;''"()/-]') THEN 'charset' END,
 CASE WHEN text <> trim(text, ' ') OR contains(text, '  ') OR regexp_matches(text, '[\\t\\r\\n]') THEN 'white_space' END], lambda r: r IS NOT NULL) AS reasons FROM x)"""


def _classed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("template_id")
    kind = F.when(t.contains("short"), "short").when(t.contains("long"), "long").otherwise("medium")
    return samples(spark, sf_dir, "text", "template_id").filter("text is not null").withColumn("length_class", kind)


@query("qc_reject_reasons", with_views("samp") + f", {_RULES_SQL} SELECT id, array_to_string(reasons, ',') AS reasons FROM y WHERE len(reasons) > 0")
def qc_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V15, Q4."""
    s = _classed(spark, sf_dir).select("id", Y.broken(Y.hard_rules(F.col("text"), F.col("length_class"))).alias("r"))
    return s.filter(F.size("r") > 0).select("id", F.array_join("r", ",").alias("reasons"))


@query("qc_reject_counts", with_views("samp") + f", {_RULES_SQL} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM y) GROUP BY 1")
def qc_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _classed(spark, sf_dir).select(F.explode(Y.broken(Y.hard_rules(F.col("text"), F.col("length_class")))).alias("reason"))
    return s.groupBy("reason").agg(F.count("*").alias("n"))


@query("naturalness_flags", with_views("samp") + f""", x AS (SELECT id, text, regexp_split_to_array(lower(text), ' +') AS w, {_CLASS_SQL} AS lc FROM samp WHERE text IS NOT NULL),
y AS (SELECT id, list_filter([CASE WHEN length(text) > 1.5 * CASE lc WHEN 'short' THEN 40 WHEN 'medium' THEN 90 ELSE 160 END THEN 'long' END,
 CASE WHEN len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1] AND w[i] <> '')) > 0 THEN 'repeated_word' END,
 CASE WHEN len(list_filter(range(2, len(w) + 1), lambda i: list_contains(['nhé', 'nha', 'với', 'ạ', 'đi', 'nhỉ'], w[i]) AND list_contains(['nhé', 'nha', 'với', 'ạ', 'đi', 'nhỉ'], w[i - 1]))) > 0 THEN 'stacked_particles' END],
 lambda f: f IS NOT NULL) AS flags FROM x)
SELECT id, array_to_string(flags, ',') AS flags FROM y WHERE len(flags) > 0""")
def naturalness_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V16."""
    s = _classed(spark, sf_dir).select("id", Y.broken(Y.soft_rules(F.col("text"), F.col("length_class"))).alias("f"))
    return s.filter(F.size("f") > 0).select("id", F.array_join("f", ",").alias("flags"))


@query("exact_dedup", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY trim(regexp_replace(regexp_replace(lower(text), '[^\\p{L}\\p{N}\\t-\\r ]', '', 'g'), '[\\t-\\r \\x{85}\\p{Z}]+', ' ', 'g'))")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1, F27."""
    return Y.exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", ["doc_id"]).select("doc_id")


@query("pair_rule", with_views("samp") + "SELECT min(id) AS id FROM samp WHERE template_id IS NOT NULL AND entity_id IS NOT NULL GROUP BY template_id, entity_id")
def pair_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3."""
    s = samples(spark, sf_dir, "template_id", "entity_id").filter("template_id is not null and entity_id is not null")
    return Y.keep_per_group(s, ["template_id", "entity_id"], ["id"], 1).select("id")


@query("cluster_keep_n", with_views("samp") + "SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY template_id ORDER BY id) AS rn FROM samp) WHERE rn <= 3")
def cluster_keep_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most three records of each template; the cut by near-duplicate clusters (Q2, W8) is ``p1_keep_n`` of the training-data queries."""
    return Y.keep_per_group(samples(spark, sf_dir, "template_id"), ["template_id"], ["id"], 3).select("id")


@query("coverage_gate", with_views("prov", "samp") + "SELECT province_id, CASE WHEN name_current IN (SELECT province FROM samp WHERE province IS NOT NULL) THEN 'PASS' ELSE 'FAIL' END AS verdict FROM prov")
def coverage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8, over all records; whether a province occurs needs no look for repeated deliveries."""
    p = provinces(spark, sf_dir).select("province_id", F.col("name_current").alias("province"))
    seen = table(spark, sf_dir, "generate_small").filter("id is not null").select("province").distinct().join(p, "province").select("province_id")
    return Y.coverage_gate(p, "province_id", seen)


@query("alias_coverage_gate", with_views("alias", "samp") + "SELECT alias, CASE WHEN alias IN (SELECT province_legacy FROM samp WHERE province_legacy IS NOT NULL) THEN 'PASS' ELSE 'FAIL' END AS verdict FROM (SELECT DISTINCT alias FROM alias WHERE alias_type = 'legacy' AND alias IS NOT NULL)")
def alias_coverage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = aliases(spark, sf_dir).filter("alias_type = 'legacy' and alias is not null").select("alias")
    return Y.coverage_gate(domain, "alias", table(spark, sf_dir, "generate_small").filter("id is not null").select(F.col("province_legacy").alias("alias")))


@query("dataset_stats", with_views("samp", "ent") + """
SELECT 'records' AS name, count(*)::DOUBLE AS value FROM samp UNION ALL SELECT 'templates', count(DISTINCT template_id) FROM samp UNION ALL SELECT 'provinces', count(DISTINCT province) FROM samp
UNION ALL SELECT 'with_legacy', count(province_legacy) FROM samp UNION ALL SELECT 'duplicate_rate', round(1 - count(DISTINCT text) / count(text), 6) FROM samp
UNION ALL SELECT 'entity_coverage', round((SELECT count(DISTINCT entity_id) FROM samp WHERE source = 'osm') / (SELECT count(*) FROM ent), 6)""")
def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all records in one pass; distinct values each by a narrow aggregate of its own, texts as 128-bit hashes."""
    s = samples(spark, sf_dir, "text", "province_legacy").agg(F.count("*").alias("records"), F.count("text").alias("texts"), F.count("province_legacy").alias("with_legacy"))
    g = table(spark, sf_dir, "generate_small").filter("id is not null")

    def distinct(c, name: str, where: str = "true") -> DataFrame:
        return g.filter(where).select(c.alias("v")).filter("v is not null").distinct().agg(F.count("*").alias(name))

    text = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.col("text"), F.lit(1)).alias("b"))
    for d in (
        distinct(F.col("template_id"), "templates"), distinct(F.col("province"), "provinces"), distinct(text, "different", "text is not null"),
        distinct(F.col("entity_id"), "osm", "source = 'osm'"), distinct(F.col("entity_id"), "entities"),
    ):
        s = s.withColumn("_one", F.lit(1)).join(d.withColumn("_one", F.lit(1)), "_one").drop("_one")  # one row on both sides
    s = s.select(
        *[F.col(c).cast("double").alias(c) for c in ("records", "templates", "provinces", "with_legacy")], F.round(1 - F.col("different") / F.col("texts"), 6).alias("duplicate_rate"),
        F.round(F.col("osm") / F.col("entities"), 6).alias("entity_coverage"),
    )
    return s.unpivot([], s.columns, "name", "value")


@query("raw_report", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n, strftime(min(loaded_at), '%Y-%m-%d') AS first_day, strftime(max(loaded_at), '%Y-%m-%d') AS last_day FROM {t}" for t in ("provinces", "districts", "wards", "province_alias", "generate_small")))
def raw_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14."""
    def one(t: str) -> DataFrame:
        d = table(spark, sf_dir, t).agg(F.count("*").alias("n"), F.date_format(F.min("loaded_at"), "yyyy-MM-dd").alias("first_day"), F.date_format(F.max("loaded_at"), "yyyy-MM-dd").alias("last_day"))
        return d.select(F.lit(t).alias("table_name"), "n", "first_day", "last_day")

    return R.union_all(*[one(t) for t in ("provinces", "districts", "wards", "province_alias", "generate_small")])


@query("readiness_rollup", with_views("prov", "ent", "samp", "dist", "ward", "alias") + """, wp AS (SELECT ward_id, CASE WHEN dist.district_id IS NOT NULL THEN dist.province_id ELSE ward.province_id END AS p FROM ward LEFT JOIN dist ON dist.district_id = ward.district_id),
checks AS (
SELECT 'provinces' AS name, CASE WHEN count(*) >= 34 THEN 'ok' ELSE 'fail' END AS verdict FROM prov
UNION ALL SELECT 'aliases', CASE WHEN (SELECT count(*) FROM prov WHERE admin_status = 'merged' AND province_id NOT IN (SELECT province_id FROM alias WHERE alias_type = 'legacy' AND province_id IS NOT NULL)) = 0 THEN 'ok' ELSE 'warn' END
UNION ALL SELECT 'districts', CASE WHEN count(*) = count(CASE WHEN province_id IN (SELECT province_id FROM prov) THEN 1 END) THEN 'ok' ELSE 'warn' END FROM dist
UNION ALL SELECT 'wards', CASE WHEN count(*) = count(CASE WHEN p IN (SELECT province_id FROM prov) THEN 1 END) THEN 'ok' ELSE 'warn' END FROM wp
UNION ALL SELECT 'entities', CASE WHEN min(n) >= 20 THEN 'ok' ELSE 'warn' END FROM (SELECT province, count(*) AS n FROM ent GROUP BY province)
UNION ALL SELECT 'landmarks', CASE WHEN (SELECT count(*) FROM prov WHERE name_current NOT IN (SELECT province FROM ent WHERE category = 'landmark' AND province IS NOT NULL)) = 0 THEN 'ok' ELSE 'warn' END
UNION ALL SELECT 'plan', CASE WHEN coalesce(sum(target_count), 0) = 0 THEN 'fail' WHEN count(*) > count(target_count) THEN 'warn' ELSE 'ok' END FROM (SELECT DISTINCT * FROM plan_small)
UNION ALL SELECT 'texts', CASE WHEN count(*) - count(text) = 0 THEN 'ok' ELSE 'warn' END FROM samp)
SELECT * FROM checks UNION ALL SELECT 'overall', CASE max(CASE verdict WHEN 'ok' THEN 0 WHEN 'warn' THEN 1 ELSE 2 END) WHEN 0 THEN 'ok' WHEN 1 THEN 'warn' ELSE 'fail' END FROM checks""")
def readiness_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight checks, and the worst of them."""
    prov = provinces(spark, sf_dir).select("province_id", "name_current", "admin_status")
    known = prov.select("province_id").withColumn("_in", F.lit(True))

    def check(df: DataFrame, name: str, *cases) -> DataFrame:
        verdict = F.lit("ok")
        for broken, grade in reversed(cases):
            verdict = F.when(broken, grade).otherwise(verdict)
        return df.agg(verdict.alias("verdict")).select(F.lit(name).alias("name"), "verdict")

    legacy = aliases(spark, sf_dir).filter("alias_type = 'legacy'").select("province_id")
    d = districts(spark, sf_dir, "province_id")
    w = wards(spark, sf_dir, "district_id", "province_id").join(d.select("district_id", F.col("province_id").alias("_p"), F.lit(True).alias("_d")), "district_id", "left")
    w = w.select(F.when(F.coalesce("_d", F.lit(False)), F.col("_p")).otherwise(F.col("province_id")).alias("province_id"))
    e = cut(entities(spark, sf_dir, "province", "category"), "entities")
    landmarks = e.filter("category = 'landmark'").select(F.col("province").alias("name_current"))
    checks = R.union_all(
        check(prov, "provinces", (F.count("*") < 34, "fail")),
        check(prov.filter("admin_status = 'merged'").join(legacy, "province_id", "left_anti"), "aliases", (F.count("*") > 0, "warn")),
        check(d.join(known, "province_id", "left"), "districts", (F.count("*") > F.count("_in"), "warn")), check(w.join(known, "province_id", "left"), "wards", (F.count("*") > F.count("_in"), "warn")),
        check(e.groupBy("province").count(), "entities", (F.min("count") < 20, "warn")), check(prov.join(landmarks, "name_current", "left_anti"), "landmarks", (F.count("*") > 0, "warn")),
        check(table(spark, sf_dir, "plan_small").distinct(), "plan", (F.coalesce(F.sum("target_count"), F.lit(0)) == 0, "fail"), (F.count("*") > F.count("target_count"), "warn")),
        check(samples(spark, sf_dir, "text"), "texts", (F.count("*") > F.count("text"), "warn")),
    )
    checks = cut(checks, "checks")
    grade = F.when(F.col("verdict") == "ok", 0).when(F.col("verdict") == "warn", 1).otherwise(2)
    worst = checks.agg(F.element_at(F.array(F.lit("ok"), F.lit("warn"), F.lit("fail")), F.max(grade) + 1).alias("verdict"))
    return checks.unionByName(worst.select(F.lit("overall").alias("name"), "verdict"))


# Spatial: the first two components of the embeddings are points, boxes and rings are fixed.
BOXES = [("a", -1.0, -1.0, 0.0, 0.0), ("b", -0.2, -0.2, 0.3, 0.3), ("c", 0.0, -0.5, 1.0, 0.5), ("d", -0.5, 0.1, 0.5, 1.0)]
# Area p has a hole, and r an island; the ways of a border come in any order and direction.
WAYS = {
    "p": [[(-0.3, -0.3), (0.3, -0.3), (0.3, 0.3)], [(-0.3, -0.3), (-0.3, 0.3), (0.3, 0.3)], [(-0.05, -0.05), (0.05, -0.05), (0.05, 0.05), (-0.05, 0.05), (-0.05, -0.05)]],
    "q": [[(0.0, 0.0), (0.4, 0.1), (0.1, 0.4), (0.0, 0.0)], [(0.5, 0.5), (0.6, 0.6)]],
    "r": [[(0.0, 0.4), (-0.4, 0.0)], [(0.0, -0.4), (0.0, 0.4)], [(-0.4, 0.0), (0.0, -0.4)], [(0.35, -0.4), (0.45, -0.4), (0.4, -0.3), (0.35, -0.4)]],
}
_BOX_SQL = "boxes AS (SELECT * FROM (VALUES " + ", ".join(f"('{b[0]}', {b[1]}::DOUBLE, {b[2]}::DOUBLE, {b[3]}::DOUBLE, {b[4]}::DOUBLE)" for b in BOXES) + ") b(box, x0, y0, x1, y1))"
_EDGES = [(k, *w[i], *w[i + 1]) for k, ways in WAYS.items() for w in ways if w != [(0.5, 0.5), (0.6, 0.6)] for i in range(len(w) - 1)]
_EDGE_SQL = "edges AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', {ax}::DOUBLE, {ay}::DOUBLE, {bx}::DOUBLE, {by}::DOUBLE)" for k, ax, ay, bx, by in _EDGES) + ") e(area, ax, ay, zx, zy))"
_POINT_SQL = "pts AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, label FROM embeddings)"
_IN_SQL = f"WITH {_POINT_SQL}, {_EDGE_SQL}, hits AS (SELECT vec_id, area FROM pts, edges WHERE (ay > y) <> (zy > y) AND x < (zx - ax) * (y - ay) / CASE WHEN zy <> ay THEN zy - ay END + ax GROUP BY vec_id, area HAVING count(*) % 2 = 1), located AS (SELECT vec_id, min(area) AS area FROM hits GROUP BY vec_id)"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.get(e, F.lit(0)).cast("double").alias("x"), F.get(e, F.lit(1)).cast("double").alias("y"), "label")


def _areas(spark: SparkSession) -> DataFrame:
    ways = [(k, n, w) for k, ways in WAYS.items() for n, w in enumerate(ways)]
    return S.stitch_rings(spark.createDataFrame(ways, "area string, way int, points array<struct<x:double,y:double>>"), "area")


@query("nearest_region_join", f"WITH {_POINT_SQL}, {_BOX_SQL} SELECT vec_id, box FROM (SELECT vec_id, box, row_number() OVER (PARTITION BY vec_id ORDER BY round(pow(x - (x0 + x1) / 2, 2) + pow(y - (y0 + y1) / 2, 2), 12), box) AS rn FROM pts JOIN boxes ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1) WHERE rn = 1")
def nearest_region_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7, N9, P17, W7."""
    boxes = spark.createDataFrame(BOXES, "box string, x0 double, y0 double, x1 double, y1 double")
    return S.nearest_box(_points(spark, sf_dir), boxes, "vec_id", "box", 0.25)


@query("point_in_polygon", _IN_SQL + " SELECT vec_id, area FROM located")
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas are stitched from ways, with a hole and an island."""
    return S.locate(_points(spark, sf_dir), _areas(spark), "vec_id", "area", 0.25)


@query("elimination_hint", _IN_SQL + " SELECT pts.vec_id, coalesce(area, CASE label % 2 WHEN 0 THEN 's' END) AS area FROM pts LEFT JOIN located USING (vec_id)")
def elimination_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points outside all areas take the one member of their group that has no area."""
    p = _points(spark, sf_dir).withColumn("half", F.col("label") % 2)
    located = p.join(S.locate(p, _areas(spark), "vec_id", "area", 0.25), "vec_id", "left").select("half", "vec_id", "area")
    members = spark.createDataFrame([(h, a) for h in (0, 1) for a in ("p", "q", "r")] + [(0, "s"), (1, "s"), (1, "t")], "half int, area string")
    return S.by_elimination(located, members, members.filter("area in ('p', 'q', 'r')"), "half", "area").select("vec_id", "area")


@query("bounding_boxes", f"WITH {_POINT_SQL} SELECT label, round(min(x), 6) AS x0, round(min(y), 6) AS y0, round(max(x), 6) AS x1, round(max(y), 6) AS y1, round((min(x) + max(x)) / 2, 6) AS cx, round(greatest(least((min(y) + max(y)) / 2, 0.1), -0.1), 6) AS cy FROM pts GROUP BY label")
def bounding_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A25, P15, P17."""
    b = S.bounds(_points(spark, sf_dir).withColumn("x", S.coordinate(F.col("x"), F.lit(0.0))), "label").withColumn("cy", S.clip(F.col("cy"), -0.1, 0.1))
    return b.select("label", *[F.round(c, 6).alias(c) for c in ("x0", "y0", "x1", "y1", "cx", "cy")])


@query("tile_grid", "SELECT t.row, t.col FROM (SELECT unnest(range(3)) AS row) r, LATERAL (SELECT r.row AS row, unnest(range(3)) AS col) t")
def tile_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box cut into n by n tiles, n the root of its area over the largest tile, rounded up."""
    area, largest = 2.0, 0.25
    n = F.ceil(F.sqrt(F.lit(area / largest))).cast("int")
    side = F.sequence(F.lit(0), n - 1)
    return spark.range(1).select(F.explode(side).alias("row")).select("row", F.explode(side).alias("col")).select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"))


@query("content_hash_manifest", """SELECT source, count(*) AS n, sha256(count(*)::VARCHAR || '|' || sum(('0x' || substr(sha256(doc_id::VARCHAR || '|' || coalesce(text, '')), 1, 15))::BIGINT::HUGEINT)::VARCHAR) AS digest
FROM documents GROUP BY source""")
def content_hash_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4, K7: an order-independent digest of each group: the sum of its rows' digests, combined before the shuffle."""
    row = F.sha2(F.concat_ws("|", F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))), 256)
    part = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")
    g = table(spark, sf_dir, "documents").select("source", part.alias("h")).groupBy("source").agg(F.count("*").alias("n"), F.sum("h").alias("s"))
    return g.select("source", "n", F.sha2(F.concat_ws("|", F.col("n").cast("string"), F.col("s").cast("string")), 256).alias("digest"))


@query("event_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey 2.13, an extension: the batch form of the windowed stream."""
    from quotaloom.streaming.windows import windowed_counts

    return windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type", "value", "1 hour").select("start", "event_type", "n", "total")


@query("ward_coverage", with_views("ward") + "SELECT type, count(*) AS n, count(legacy_alias) AS hinted, round(count(legacy_alias) / count(*), 6) AS share FROM ward GROUP BY type")
def ward_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A23."""
    return wards(spark, sf_dir, "type", "legacy_alias").groupBy("type").agg(F.count("*").alias("n"), F.count("legacy_alias").alias("hinted"), F.round(F.count("legacy_alias") / F.count("*"), 6).alias("share"))


@query("category_share_report", with_views("ent") + "SELECT coalesce(category, '') AS category, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 1)::DOUBLE AS percent, ceil(count(*) / 25)::BIGINT AS pages FROM ent GROUP BY 1")
def category_share_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, shares of the whole, and pages of 25."""
    c = entities(spark, sf_dir, "category").groupBy(F.coalesce("category", F.lit("")).alias("category")).agg(F.count("*").alias("n"))
    return c.select("category", "n", F.round(F.col("n") * 100.0 / c.agg(F.sum("n")).scalar(), 1).alias("percent"), F.ceil(F.col("n") / 25).alias("pages"))
