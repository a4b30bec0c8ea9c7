"""Queries of generation (survey R1-R12, J12-J16, A22, Q5-Q7, Q10, W6, W9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotaloom.functions import names as N
from quotaloom.functions import templates as T
from quotaloom.functions.draws import cell_key, race_key, uniform, uniform_sql
from quotaloom.operators import generate as G
from quotaloom.operators import quota as Q
from quotaloom.operators import relational as R
from quotaloom.operators.sampling import take_lowest
from quotaloom.plans.master import aliases, districts, entities, provinces, samples, wards, with_views
from quotaloom.plans.quota import PROFILES, SENTENCE_TYPES
from quotaloom.plans.registry import query, table
from quotaloom.plans.text import PARTICLES, QUESTION_WORDS, STATEMENTS
from quotaloom.workspace import cut

STYLE = G.Style()
# Two bodies per sentence type; with the profiles this makes the bank of templates.
BODIES = {
    "nav_command": ["{opener}đưa tới {entity}{closer}", "{opener}dẫn về {entity}{closer}"],
    "search": ["{opener}tìm {entity}{closer}", "{opener}mình tìm {entity} ở đâu{closer}"],
    "route_question": ["{opener}tới {entity} đi lối nào{closer}", "{opener}tôi cần đi tới {entity}{closer}"],
    "conversational": ["{opener}mình đang ghé {entity}, chắc còn lâu{closer}", "{opener}em vừa qua {entity}{closer}"],
    "short_command": ["về {entity}{closer}", "ra {entity}{closer}"],
    "contextual": ["{opener}quanh {entity} có {category_noun} nào không{closer}", "{opener}ghé {category_noun} gần {entity}{closer}"],
}


def bank(spark: SparkSession) -> DataFrame:
    """Templates by (sentence_type, profile, ordinal) with their classes."""
    rows = [(f"{st}_{p}_{k:03d}", st, p, p.split("_")[0], k, body) for st, bodies in BODIES.items() for p in PROFILES for k, body in enumerate(bodies)]
    t = spark.createDataFrame(rows, "template_id string, sentence_type string, profile string, register string, ordinal long, template_text string")
    x = F.col("template_text")
    return t.select("*", T.head_class(x, STATEMENTS).alias("head"), T.tail_class(x, QUESTION_WORDS, PARTICLES).alias("tail"), T.starts_with_ask(x).alias("asks"), x.contains("giúp").alias("helps"))


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakable entities of known provinces, the provinces, their districts and wards, which inherit their district's hint.
    Written once, since its sizes and its entities are read. Weights by tier: hand-kept entities 1, others 2; provinces their own, districts 2, wards 3."""
    p = provinces(spark, sf_dir).select("province_id", F.col("name_current").alias("province"), F.col("popularity_tier").alias("tier"))
    cols = ["entity", "category", "subcategory", "province", "district", "source"]
    e = entities(spark, sf_dir, *cols, where="category not in ('address', 'admin_unit')").join(p.drop("tier"), "province")
    e = e.select(
        "entity_id", N.squeeze(N.nfc(F.col("entity"))).alias("name"), "category", "subcategory", "province_id", F.coalesce("district", F.lit("")).alias("district"), F.lit("").alias("district_type"),
        F.lit("").alias("unit_type"), F.lit("").alias("hint"), F.when(F.col("source") == "manual", 1).otherwise(2).alias("tier"), "source", F.lit("").alias("grp"),
    )

    def unit(df: DataFrame, kind: str, key, name, district, district_type, unit_type, hint, tier) -> DataFrame:
        return df.select(
            key.alias("entity_id"), N.squeeze(N.nfc(name)).alias("name"), F.lit("admin_unit").alias("category"), F.lit(kind).alias("subcategory"), "province_id", district.alias("district"),
            district_type.alias("district_type"), unit_type.alias("unit_type"), F.coalesce(hint, F.lit("")).alias("hint"), tier.alias("tier"), F.lit("manual").alias("source"), F.lit(kind).alias("grp"),
        )

    no, known = F.lit(""), p.select("province_id")
    d = districts(spark, sf_dir, "province_id", "name", "type", "legacy_alias")
    w = wards(spark, sf_dir, "district_id", "province_id", "name", "type", "legacy_alias")
    of = d.select("district_id", F.col("province_id").alias("_p"), F.col("name").alias("_d"), F.col("type").alias("_t"), F.col("legacy_alias").alias("_h"), F.lit(True).alias("_in"))
    w = w.join(of, "district_id", "left")
    inside = F.coalesce("_in", F.lit(False))
    w = w.withColumn("province_id", F.when(inside, F.col("_p")).otherwise(F.col("province_id"))).join(known, "province_id")
    units = [
        unit(p, "province", F.concat(F.lit("province_"), "province_id"), F.col("province"), no, no, F.lit("tỉnh"), no, F.col("tier")),
        unit(d.join(known, "province_id"), "district", F.col("district_id"), F.col("name"), F.col("name"), F.col("type"), F.col("type"), F.col("legacy_alias"), F.lit(2)),
        unit(w, "ward", F.col("ward_id"), F.col("name"), F.coalesce("_d", no), F.coalesce("_t", no), F.col("type"), F.when(inside, F.col("_h")).otherwise(F.col("legacy_alias")), F.lit(3)),
    ]
    out = R.union_all(e, *units).filter(N.is_speakable(F.col("name")))
    return cut(out.withColumn("weight", F.when(F.col("tier") == 1, STYLE.tiers[0]).when(F.col("tier") == 2, STYLE.tiers[1]).otherwise(STYLE.tiers[2])).drop("tier"), "pool")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["province_id", "category", "sentence_type", "variation_profile"]
    c = table(spark, sf_dir, "plan_small").distinct().groupBy(*keys).agg(F.sum("target_count").cast("long").alias("target")).filter("target > 0")
    return c.withColumn("cell", cell_key(*[F.col(k) for k in keys])).withColumnRenamed("variation_profile", "profile")


def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.generate(cells(spark, sf_dir), pool(spark, sf_dir), bank(spark), G.alias_candidates(aliases(spark, sf_dir), provinces(spark, sf_dir)), STYLE)


@query("generate_samples")
def generate_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the plan. Which entity, template and axes they draw is checked by plan_joined_pool and generation_draws."""
    return generated(spark, sf_dir)


_CELLS_SQL = "c AS (SELECT province_id, category, sentence_type, variation_profile AS profile, province_id || '|' || category || '|' || sentence_type || '|' || variation_profile AS cell, sum(target_count)::BIGINT AS target FROM (SELECT DISTINCT * FROM plan_small) GROUP BY ALL HAVING sum(target_count) > 0)"
_SPOKEN_SQL = r"trim(regexp_replace(nfc_normalize(%s), '[\t-\r \x{85}\p{Z}]+', ' ', 'g'))"
_POOL_SQL = rf"""pe AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY id) AS rn FROM samp WHERE entity_id IS NOT NULL AND category NOT IN ('address', 'admin_unit')),
wd AS (SELECT ward_id, ward.name, dist.name AS dname, CASE WHEN dist.district_id IS NOT NULL THEN dist.province_id ELSE ward.province_id END AS province_id FROM ward LEFT JOIN dist ON dist.district_id = ward.district_id),
pool0 AS (SELECT entity_id, entity AS name, category, province_id, CASE source WHEN 'manual' THEN 5 ELSE 2 END::DOUBLE AS weight, coalesce(district, '') AS district, subcategory, '' AS grp FROM pe JOIN prov ON prov.name_current = pe.province WHERE rn = 1
 UNION ALL SELECT 'province_' || province_id, name_current, 'admin_unit', province_id, CASE popularity_tier WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END, '', 'province', 'province' FROM prov
 UNION ALL SELECT district_id, name, 'admin_unit', province_id, 2, name, 'district', 'district' FROM dist WHERE province_id IN (SELECT province_id FROM prov)
 UNION ALL SELECT ward_id, name, 'admin_unit', province_id, 1, coalesce(dname, ''), 'ward', 'ward' FROM wd WHERE province_id IN (SELECT province_id FROM prov)),
pool AS (SELECT * FROM pool0 WHERE NOT regexp_matches(nfc_normalize(name), '[^\P{{L}}\x{{0}}-\x{{24F}}\x{{1E00}}-\x{{1EFF}}]') AND {_SPOKEN_SQL % "name"} <> '')"""
_PAIRS_SQL = f"""sz AS (SELECT province_id, category AS pc, grp, count(*) AS size FROM pool GROUP BY ALL),
g0 AS (SELECT c.*, pc, grp, size, CASE grp WHEN 'province' THEN 0.3 WHEN 'district' THEN 0.05 WHEN 'ward' THEN 0.65 ELSE 1 END::DOUBLE AS gw FROM c JOIN sz ON sz.province_id = c.province_id AND pc = CASE c.category WHEN 'address' THEN 'street' ELSE c.category END),
g1 AS (SELECT *, gw / sum(gw) OVER (PARTITION BY cell) * target AS raw FROM g0), g2 AS (SELECT *, floor(round(raw, 9))::BIGINT AS fl, round(raw - floor(round(raw, 9)), 9) AS frac FROM g1),
g3 AS (SELECT *, fl + CASE WHEN row_number() OVER (PARTITION BY cell ORDER BY frac DESC, grp) <= target - sum(fl) OVER (PARTITION BY cell) THEN 1 ELSE 0 END AS quota FROM g2),
g AS (SELECT *, sum(quota) OVER (PARTITION BY cell ORDER BY grp) - quota AS off FROM g3 WHERE quota > 0),
j AS (SELECT g.*, pool.entity_id, pool.name, pool.subcategory, pool.district, row_number() OVER (PARTITION BY cell, g.grp ORDER BY
  round(pow(greatest({uniform_sql("'42'", "cell", "entity_id", "'order'")}, 1e-12), 1 / weight), 12) DESC, entity_id) - 1 AS rk
 FROM g JOIN pool ON pool.province_id = g.province_id AND pool.category = g.pc AND pool.grp = g.grp),
pairs AS (SELECT cell, category, subcategory, name, district, profile, entity_id, lap, (off + rk + lap * size)::BIGINT AS i, (floor({uniform_sql("'42'", "cell", "entity_id", "'template'")} * 2)::BIGINT + lap) % 2 AS ordinal
 FROM (SELECT *, unnest(range(0, (quota - 1 - rk) // size + 1)) AS lap FROM j WHERE rk < quota))"""
_DRAWN_SQL = with_views("samp", "prov", "dist", "ward") + f", {_CELLS_SQL}, {_POOL_SQL}, {_PAIRS_SQL} "


@query("plan_joined_pool", _DRAWN_SQL + "SELECT cell, i, entity_id, ordinal FROM pairs")
def plan_joined_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which entity and template each row takes."""
    rows = G.draw_entities(cells(spark, sf_dir), pool(spark, sf_dir), STYLE)
    return G.assign_templates(rows, bank(spark), STYLE.seed).select("cell", "i", "entity_id", "ordinal")


def _axis_sql(weights: dict, axis: str, category: bool = True) -> str:
    """The ladder of an axis: category before register before default."""
    def pick(options) -> str:
        total, run, out = sum(w for _, w in options), 0.0, ""
        for name, w in sorted(options):
            run += w
            out += f" WHEN u_{axis} * {total!r} < {run!r} THEN '{name}'"
        return f"CASE{out} ELSE '{sorted(options)[-1][0]}' END"

    registers = ("formal", "neutral", "casual")
    keys = sorted((k for k in weights if k != "default" and (category or k in registers)), key=lambda k: k in registers)
    return "CASE" + "".join(f" WHEN {'register' if k in registers else 'category'} = '{k}' THEN {pick(weights[k])}" for k in keys) + f" ELSE {pick(weights['default'])} END"


_AXES = ("depth", "variant", "number", "prefix", "tail_prefix")
_US = ", ".join(f"""{uniform_sql("'42'", "cell", "i::VARCHAR", f"'{a}'")} AS u_{a}""" for a in _AXES)


@query("generation_draws", _DRAWN_SQL + f""", a AS (SELECT *, split_part(profile, '_', 1) AS register, {_US} FROM pairs),
b AS (SELECT *, {_axis_sql(STYLE.depth, "depth")} AS d0, {_axis_sql(STYLE.variant, "variant")} AS v0, {_axis_sql(STYLE.number, "number")} AS n0, {_axis_sql(STYLE.prefix, "prefix")} AS p0, {_axis_sql(STYLE.prefix, "tail_prefix", False)} AS t0 FROM a),
d AS (SELECT *, CASE WHEN d0 = 'poi_district' AND district = '' THEN 'full_address' ELSE d0 END AS depth FROM b)
SELECT cell, i, entity_id, depth, CASE WHEN coalesce(subcategory = 'province', false) OR depth = 'full_address' THEN v0 ELSE 'current' END AS drawn_variant,
 CASE WHEN category = 'address' OR regexp_matches(name, '[0-9]') THEN CASE n0 WHEN 'none' THEN 'cardinal' ELSE n0 END ELSE 'none' END AS number_style,
 category IN ('admin_unit', 'street', 'address') AND p0 = 'present' AS admin_prefix, depth <> 'poi_only' AND t0 = 'present' AS tail_prefix FROM d""")
def generation_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The axes drawn for every row."""
    rows = G.drawn(cells(spark, sf_dir), pool(spark, sf_dir), bank(spark), STYLE)
    return rows.select("cell", "i", "entity_id", "depth", "drawn_variant", "number_style", "admin_prefix", "tail_prefix")


@query("generation_counters", _DRAWN_SQL + """
SELECT cell, 'generated' AS reason, count(*) AS n FROM pairs GROUP BY cell
UNION ALL SELECT cell, 'pair_repeated', count(*) FROM pairs WHERE lap >= 2 GROUP BY cell
UNION ALL SELECT cell, 'empty_pool', target FROM c WHERE NOT EXISTS (SELECT 1 FROM pool WHERE pool.province_id = c.province_id AND pool.category = CASE c.category WHEN 'address' THEN 'street' ELSE c.category END)""")
def generation_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated rows, repeated pairs and rejected rows of each cell; texts aren't composed for it."""
    c, p, b = cells(spark, sf_dir), pool(spark, sf_dir), bank(spark)
    done = G.assign_templates(G.draw_entities(c, p, STYLE), b, STYLE.seed).groupBy("cell").agg(F.count("*").alias("generated"), F.count_if("repeated").alias("pair_repeated"))
    done = done.unpivot("cell", ["generated", "pair_repeated"], "reason", "n").filter("n > 0")
    return done.unionByName(G.reject_counts(c, p, b))


_GAPS_SQL = """plan AS (SELECT province_id, category, sentence_type, sum(target_count)::BIGINT AS target FROM (SELECT DISTINCT * FROM plan_small) GROUP BY ALL HAVING sum(target_count) > 0),
have AS (SELECT province_id, category, sentence_type, count(*) AS n FROM samp JOIN prov ON prov.name_current = samp.province GROUP BY ALL)"""


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["province_id", "category", "sentence_type"]
    plan = table(spark, sf_dir, "plan_small").distinct().groupBy(*keys).agg(F.sum("target_count").cast("long").alias("target")).filter("target > 0")
    s = samples(spark, sf_dir, "province", "category", "sentence_type").join(provinces(spark, sf_dir).select("province_id", F.col("name_current").alias("province")), "province")
    have = s.groupBy(*keys).agg(F.count("*").alias("n"))
    return plan.join(have, keys, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long"))).withColumn("gap", F.col("target") - F.col("n"))


@query("gaps_vs_plan", with_views("samp", "prov") + f", {_GAPS_SQL} SELECT plan.*, coalesce(n, 0) AS n, target - coalesce(n, 0) AS gap FROM plan LEFT JOIN have USING (province_id, category, sentence_type) WHERE target <> coalesce(n, 0)")
def gaps_vs_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5."""
    return _gaps(spark, sf_dir).filter("gap <> 0")


_MEASURED_SQL = _CELLS_SQL + ", h AS (SELECT seed_cell AS cell, count(*) AS have FROM samp WHERE seed_cell IS NOT NULL GROUP BY 1)"


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan's cells with the number of records they have."""
    have = samples(spark, sf_dir, "seed_cell").groupBy(F.col("seed_cell").alias("cell")).agg(F.count("*").alias("have"))
    return cells(spark, sf_dir).join(have, "cell", "left").withColumn("have", F.coalesce("have", F.lit(0).cast("long")))


def _regenerated(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = _measured(spark, sf_dir).filter("have < target")
    return G.generate(gaps, pool(spark, sf_dir), bank(spark), G.alias_candidates(aliases(spark, sf_dir), provinces(spark, sf_dir)), STYLE)


@query("regenerate_gaps", _DRAWN_SQL.replace(_CELLS_SQL, _MEASURED_SQL) + """
SELECT substr(sha1(p.cell || '|' || i), 1, 16) AS id, p.cell AS seed_cell, i, p.entity_id FROM pairs p LEFT JOIN h USING (cell) WHERE i >= coalesce(have, 0)""")
def regenerate_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: the rows that cells lack, in the cell's own profile, numbered from the present count on; those a full run would give there."""
    return _regenerated(spark, sf_dir).select("id", "seed_cell", "i", "entity_id")


FINAL, FLOOR, CELL_CAP = 2_000, 5, 0.30
_FILL_SQL = ""
for _k in range(8):  # each pass fixes the cells that would take more than their room
    _FILL_SQL += f""", f{_k + 1} AS (SELECT *, CASE WHEN fixed IS NULL AND want > room THEN room ELSE fixed END AS fixed2 FROM
 (SELECT * EXCLUDE (want), (rest - coalesce(sum(fixed) OVER (), 0)) * w / nullif(sum(CASE WHEN fixed IS NULL THEN w END) OVER (), 0) AS want FROM f{_k})), g{_k + 1} AS (SELECT * EXCLUDE (fixed, fixed2), fixed2 AS fixed FROM f{_k + 1})""".replace(f"FROM f{_k})", f"FROM {'f0' if not _k else f'g{_k}'})")
_QUOTA_SQL = with_views("samp", "prov") + f""", t AS (SELECT id, coalesce(category, '') AS category, coalesce(popularity_tier, 3)::INT AS tier FROM samp LEFT JOIN prov ON prov.name_current = samp.province),
k0 AS (SELECT category, tier, count(*) AS observed FROM t GROUP BY category, tier), k AS (SELECT *, observed * CASE tier WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END::DOUBLE AS w FROM k0),
b AS (SELECT *, least(observed, {int(FINAL * CELL_CAP)}, {FLOOR}) AS base, least(observed, {int(FINAL * CELL_CAP)}) AS most FROM k),
f0 AS (SELECT *, (most - base)::DOUBLE AS room, least(({FINAL} - sum(base) OVER ()), (sum(most - base) OVER ()))::DOUBLE AS rest, CASE WHEN most = base THEN 0.0 END::DOUBLE AS fixed, NULL::DOUBLE AS want FROM b){_FILL_SQL},
e AS (SELECT *, coalesce(fixed, (rest - coalesce(sum(fixed) OVER (), 0)) * w / nullif(sum(CASE WHEN fixed IS NULL THEN w END) OVER (), 0)) AS more FROM g8),
r AS (SELECT *, floor(round(more, 9))::BIGINT AS fl, round(more - floor(round(more, 9)), 9) AS frac FROM e),
q AS (SELECT category, tier, observed, (base + fl + CASE WHEN row_number() OVER (ORDER BY frac DESC, category, tier) <= round(rest - (sum(fl) OVER ())) THEN 1 ELSE 0 END)::BIGINT AS quota FROM r)"""


def _strata(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(records with category and tier of their province, cells with observed rows and quota)."""
    p = provinces(spark, sf_dir).select(F.col("name_current").alias("province"), F.col("popularity_tier").alias("tier"))
    s = samples(spark, sf_dir, "category", "province").join(p, "province", "left").select("id", F.coalesce("category", F.lit("")).alias("category"), F.coalesce("tier", F.lit(3)).alias("tier"))
    s = cut(s, "records")  # read three times, in three narrow columns
    k = s.groupBy("category", "tier").agg(F.count("*").alias("observed"))
    k = cut(k.withColumn("weight", F.when(F.col("tier") == 1, STYLE.tiers[0]).when(F.col("tier") == 2, STYLE.tiers[1]).otherwise(STYLE.tiers[2])), "strata")
    quota = spark.createDataFrame(Q.final_quotas(k, ["category", "tier"], FINAL, FLOOR, CELL_CAP), "category string, tier int, quota long")
    return s, k.join(quota, ["category", "tier"])


@query("finalize_exact", _QUOTA_SQL + f" SELECT id, category FROM (SELECT *, row_number() OVER (PARTITION BY category, tier ORDER BY {uniform_sql("'42'", "id", "'final'")}, id) AS rn FROM t) JOIN q USING (category, tier) WHERE rn <= quota")
def finalize_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FINAL rows, or all there are; cells are categories by tier of the province, with floors, caps and tier weights."""
    s, k = _strata(spark, sf_dir)
    return take_lowest(s, k, ["category", "tier"], uniform("42", F.col("id"), "final"), "id").select("id", "category")


@query("finalize_report", _QUOTA_SQL + f"""SELECT category, tier, observed, quota, quota < observed AS cut FROM q
UNION ALL SELECT '', -1, sum(observed)::BIGINT, sum(quota)::BIGINT, sum(quota) < {FINAL} FROM q""")
def finalize_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and quota of each cell; the last row has the totals, and whether they miss FINAL."""
    k = _strata(spark, sf_dir)[1].select("category", "tier", "observed", "quota", (F.col("quota") < F.col("observed")).alias("cut"))
    total = k.agg(F.sum("observed").alias("observed"), F.sum("quota").alias("quota"))
    return k.unionByName(total.select(F.lit("").alias("category"), F.lit(-1).alias("tier"), "observed", "quota", (F.col("quota") < FINAL).alias("cut")))


@query("stratified_review_pack", with_views("samp") + f"""SELECT id, category, sentence_type FROM (SELECT *, row_number() OVER (PARTITION BY category, sentence_type ORDER BY
 round(pow(greatest({uniform_sql("'42'", "id", "'review'")}, 1e-12), 1.0), 12) DESC, id) AS rn FROM samp WHERE category IS NOT NULL AND sentence_type IS NOT NULL) WHERE rn <= 3""")
def stratified_review_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9."""
    s = samples(spark, sf_dir, "category", "sentence_type").filter("category is not null and sentence_type is not null")
    key = race_key(uniform("42", F.col("id"), "review"), F.lit(1.0))
    return R.ranked(s, ["category", "sentence_type"], [key.desc(), F.col("id")], "rn").filter("rn <= 3").select("id", "category", "sentence_type")


assert set(BODIES) == set(SENTENCE_TYPES)
