"""Queries of shares, plans and plan checks (survey N1-N8, J10, J15, J18, W3-W5, A9-A12, A19-A21, V2, V11-V14, T6, F11-F14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotaloom.functions.draws import cell_key, cell_seed, race_key, sample_id, uniform, uniform_sql, weighted_pick
from quotaloom.operators import quota as Q
from quotaloom.operators import relational as R
from quotaloom.operators.generate import Style
from quotaloom.plans.master import entities, province_weight, provinces, samples, with_views
from quotaloom.plans.registry import query, table

# The default distribution.
SENTENCE_TYPES = {"nav_command": 0.22, "search": 0.20, "route_question": 0.16, "conversational": 0.16, "short_command": 0.14, "contextual": 0.12}
PROFILES = {"formal_medium": 0.15, "neutral_short": 0.25, "neutral_medium": 0.25, "casual_short": 0.20, "casual_long": 0.15}
CATEGORIES = {"admin_unit": 0.14, "street": 0.22, "address": 0.10, "landmark": 0.08, "transport": 0.05, "public_facility": 0.12, "commercial": 0.20, "poi_other": 0.09}
PROVINCE_CAPS, CATEGORY_CAPS, SENTENCE_TYPE_CAPS = (0.003, 0.12), (0.03, 0.30), (0.08, 0.35)
ENTITY_MAX_SHARE = 0.0015
PROVINCE_OVERRIDES = {"04": 0.7}
IPF_STEPS = 200
TOTAL = 20_000
PLAN_KEYS = ["province_id", "category", "sentence_type", "profile"]


def _values(d: dict[str, float], name: str) -> str:
    return "(VALUES " + ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in d.items()) + f") {name}(k, v)"


# water filling, one pass after the other: each pass fixes the free shares outside the bounds at its own scale
def _fill_sql(source: str, key: str, low: float, high: float, passes: int = 6) -> str:
    out = [f"f0 AS (SELECT {key} AS key, w, NULL::DOUBLE AS fixed FROM {source})"]
    for i in range(passes):
        out.append(
            f"f{i + 1} AS (SELECT key, w, CASE WHEN fixed IS NOT NULL THEN fixed WHEN want < {low} - 1e-6 THEN {low} WHEN want > {high} + 1e-6 THEN {high} END AS fixed "
            f"FROM (SELECT *, (1 - coalesce(sum(fixed) OVER (), 0)) * w / sum(CASE WHEN fixed IS NULL THEN w END) OVER () AS want FROM f{i}))"
        )
    out.append(f"filled AS (SELECT key, w, coalesce(fixed, (1 - coalesce(sum(fixed) OVER (), 0)) * w / sum(CASE WHEN fixed IS NULL THEN w END) OVER ()) AS share FROM f{passes})")
    return ", ".join(out)


_OVERRIDE_SQL = "CASE province_id " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PROVINCE_OVERRIDES.items()) + " ELSE 1 END"
_WEIGHTS = f"pw AS (SELECT province_id, ({_OVERRIDE_SQL} * CASE popularity_tier WHEN 1 THEN 6 WHEN 2 THEN 2 ELSE 1 END * CASE WHEN is_municipality THEN 1.5 ELSE 1 END)::DOUBLE AS w FROM prov)"


def _overridden(c):
    return province_weight() * F.coalesce(*[F.when(c == k, v) for k, v in PROVINCE_OVERRIDES.items()], F.lit(1.0))


def province_shares(spark: SparkSession, sf_dir: str, low: float = PROVINCE_CAPS[0], high: float = PROVINCE_CAPS[1]) -> dict[str, float]:
    """Weights with overrides, held within the caps. A bounded dimension, which is checked, so it is read on the driver."""
    rows = provinces(spark, sf_dir).select("province_id", _overridden(F.col("province_id")).alias("w")).limit(Q.MAX_AXIS + 1).collect()
    if len(rows) > Q.MAX_AXIS:
        raise ValueError("more provinces than the driver's limit")
    if unknown := set(PROVINCE_OVERRIDES) - {r.province_id for r in rows}:
        raise ValueError(f"overrides of unknown provinces: {sorted(unknown)}")
    return Q.water_fill({r.province_id: r.w for r in rows}, low, high)


@query("normalized_shares", with_views("prov") + f", {_WEIGHTS} SELECT province_id, round(w / sum(w) OVER (), 9) AS share FROM pw")
def normalized_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N1."""
    p = provinces(spark, sf_dir).select("province_id", _overridden(F.col("province_id")).alias("w"))
    return Q.normalized(p, "w").select("province_id", F.round("share", 9).alias("share"))


@query("clamped_shares", with_views("prov") + f", {_WEIGHTS}, {_fill_sql('pw', 'province_id', 0.015, 0.05)} SELECT key AS province_id, round(share, 9) AS share FROM filled")
def clamped_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N2."""
    return spark.createDataFrame([(k, round(v, 9)) for k, v in province_shares(spark, sf_dir, 0.015, 0.05).items()], "province_id string, share double")


_ROUND_SQL = """raw AS (SELECT *, share * {total} AS r FROM {source}), fl AS (SELECT *, floor(round(r, 9))::BIGINT AS f, round(r - floor(round(r, 9)), 9) AS frac FROM raw),
rk AS (SELECT *, row_number() OVER (ORDER BY frac DESC, {keys}) AS up, row_number() OVER (ORDER BY frac, {keys}) AS down, {total} - sum(f) OVER () AS rest FROM fl),
rounded AS (SELECT *, (f + CASE WHEN rest > 0 AND up <= rest THEN 1 WHEN rest < 0 AND down <= -rest THEN -1 ELSE 0 END)::BIGINT AS target FROM rk)"""


@query("largest_remainder_quota", "WITH s AS (SELECT c_nationkey, c_mktsegment, count(*) / sum(count(*)) OVER () AS share FROM customer GROUP BY ALL), "
       + _ROUND_SQL.format(total=1000, source="s", keys="c_nationkey, c_mktsegment") + " SELECT c_nationkey, c_mktsegment, target FROM rounded")
def largest_remainder_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N3, W2."""
    c = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").cast("double").alias("n"))
    return Q.largest_remainder(Q.normalized(c, "n"), "share", F.lit(1000), ["c_nationkey", "c_mktsegment"]).select("c_nationkey", "c_mktsegment", "target")


def _feasible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of province and category that have an entity; addresses use the streets."""
    e = entities(spark, sf_dir, "category", "province").join(provinces(spark, sf_dir).select("province_id", F.col("name_current").alias("province")), "province")
    pairs = e.filter(F.col("category").isin(*CATEGORIES)).select("province_id", "category").distinct()
    return pairs.unionByName(pairs.filter("category = 'street'").withColumn("category", F.lit("address"))).distinct()


def _clamped(weights: dict[str, float], caps: tuple[float, float]) -> dict[str, float]:
    return Q.rescaled(Q.water_fill(weights, *caps))


def _block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.block_shares(_feasible(spark, sf_dir), "province_id", "category", Q.rescaled(province_shares(spark, sf_dir)), _clamped(CATEGORIES, CATEGORY_CAPS), IPF_STEPS)


def _ipf_sql(steps: int) -> str:
    fill = _fill_sql("pw", "province_id", *PROVINCE_CAPS)
    out = f""", {_WEIGHTS}, {fill}, ps AS (SELECT key AS province_id, share / sum(share) OVER () AS s FROM filled), cs AS (SELECT k AS category, v / sum(v) OVER () AS s FROM {_values(CATEGORIES, 'c')}),
fe AS (SELECT DISTINCT province_id, category FROM ent JOIN prov ON prov.name_current = ent.province),
ff AS (SELECT * FROM fe UNION SELECT province_id, 'address' FROM fe WHERE category = 'street'),
m(step, province_id, category, v, rs, cs) AS (SELECT 0, province_id, category, ps.s * cs.s, ps.s, cs.s FROM ff JOIN ps USING (province_id) JOIN cs USING (category)
 UNION ALL SELECT step + 1, province_id, category, r * cs / sum(r) OVER (PARTITION BY category), rs, cs FROM (SELECT *, v * rs / sum(v) OVER (PARTITION BY province_id) AS r FROM m WHERE step < {steps}))"""
    return with_views("prov", "ent").replace("WITH ", "WITH RECURSIVE ", 1) + out + f", block AS (SELECT province_id, category, v / sum(v) OVER () AS share FROM m WHERE step = {steps})"


_PLAN_SQL = _ipf_sql(IPF_STEPS) + f""", s AS (SELECT province_id, category, st.k AS sentence_type, pr.k AS profile, share * st.v * pr.v AS share FROM block, {_values(SENTENCE_TYPES, 'st')}, {_values(PROFILES, 'pr')}), """
_PLAN_SQL += _ROUND_SQL.format(total=TOTAL, source="s", keys="province_id, category, sentence_type, profile")
_PLAN_SQL += f""", sv AS (SELECT province_id, category, sentence_type, profile, target AS t0, share / sum(share) OVER () AS share, {TOTAL} - sum(target) OVER () AS lost FROM rounded WHERE target >= 2),
raw2 AS (SELECT *, share * lost AS r FROM sv), fl2 AS (SELECT *, floor(round(r, 9))::BIGINT AS f, round(r - floor(round(r, 9)), 9) AS frac FROM raw2),
rk2 AS (SELECT *, row_number() OVER (ORDER BY frac DESC, province_id, category, sentence_type, profile) AS up, lost - sum(f) OVER () AS rest FROM fl2),
plan AS (SELECT province_id, category, sentence_type, profile, (t0 + f + CASE WHEN up <= rest THEN 1 ELSE 0 END)::BIGINT AS target FROM rk2)"""


@query("ipf_plan_shares", _ipf_sql(IPF_STEPS) + " SELECT province_id, category, round(share, 6) AS share FROM block")
def ipf_plan_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N4."""
    return _block(spark, sf_dir).withColumn("share", F.round("share", 6))


_MARGIN_SQL = """, x AS (SELECT 'province' AS axis, province_id AS value, s AS wanted, 0.003 AS low, 0.12 AS high FROM ps UNION ALL SELECT 'category', category, s, 0.03, 0.3 FROM cs),
a AS (SELECT 'province' AS axis, province_id AS value, sum(share) AS got FROM block GROUP BY ALL UNION ALL SELECT 'category', category, sum(share) FROM block GROUP BY ALL)
SELECT axis, value, round(wanted, 6) AS wanted, round(coalesce(got, 0), 6) AS got, abs(coalesce(got, 0) - wanted) <= 1e-6 AS met, coalesce(got, 0) BETWEEN low - 1e-6 AND high + 1e-6 AS within FROM x LEFT JOIN a USING (axis, value)"""


@query("plan_margins", _ipf_sql(IPF_STEPS) + _MARGIN_SQL)
def plan_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted and fitted share of every province and category, and whether it is met and within the caps."""
    block = _block(spark, sf_dir)
    wanted = [("province", k, v, *PROVINCE_CAPS) for k, v in Q.rescaled(province_shares(spark, sf_dir)).items()] + [("category", k, v, *CATEGORY_CAPS) for k, v in _clamped(CATEGORIES, CATEGORY_CAPS).items()]
    w = spark.createDataFrame(wanted, "axis string, value string, wanted double, low double, high double")
    got = R.union_all(*[block.groupBy(F.lit(a).alias("axis"), F.col(c).alias("value")).agg(F.sum("share").alias("got")) for a, c in (("province", "province_id"), ("category", "category"))])
    g = F.coalesce("got", F.lit(0.0))
    met, within = F.abs(g - F.col("wanted")) <= 1e-6, g.between(F.col("low") - 1e-6, F.col("high") + 1e-6)
    return w.join(got, ["axis", "value"], "left").select("axis", "value", F.round("wanted", 6).alias("wanted"), F.round(g, 6).alias("got"), met.alias("met"), within.alias("within"))


def plan_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = Q.spread(_block(spark, sf_dir), {"sentence_type": _clamped(SENTENCE_TYPES, SENTENCE_TYPE_CAPS), "profile": Q.rescaled(PROFILES)})
    return Q.plan(shares, PLAN_KEYS, TOTAL, min_cell=2).select(*PLAN_KEYS, "target")


@query("quota_plan", _PLAN_SQL + " SELECT * FROM plan")
def quota_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N6, P18, P19, J10."""
    return plan_cells(spark, sf_dir)


@query("scaled_plan", "WITH c AS (SELECT province_id, category, sentence_type, variation_profile, sum(target_count)::BIGINT AS t FROM (SELECT DISTINCT * FROM plan_small) WHERE target_count > 0 GROUP BY ALL), "
       "s AS (SELECT *, t / sum(t) OVER () AS share FROM c), " + _ROUND_SQL.format(total=777, source="s", keys="province_id, category, sentence_type, variation_profile")
       + " SELECT province_id, category, sentence_type, variation_profile, target AS scaled FROM rounded WHERE target > 0")
def scaled_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N7."""
    keys = ["province_id", "category", "sentence_type", "variation_profile"]
    c = table(spark, sf_dir, "plan_small").distinct().filter("target_count > 0").groupBy(*keys).agg(F.sum("target_count").alias("t"))
    return Q.scale(c, "t", 777, keys).select(*keys, "scaled")


_CAPS = {"province": ("province_id", PROVINCE_CAPS), "category": ("category", CATEGORY_CAPS), "sentence_type": ("sentence_type", SENTENCE_TYPE_CAPS)}
_CHECK_SQL = _PLAN_SQL + ", n AS (" + " UNION ALL ".join(f"SELECT '{a}' AS axis, {c} AS value, sum(target) AS n FROM plan GROUP BY ALL" for a, (c, _) in _CAPS.items()) + f"""),
d AS (SELECT 'province' AS axis, province_id AS value FROM prov UNION ALL SELECT 'category', k FROM {_values(CATEGORIES, 'c')} UNION ALL SELECT 'sentence_type', k FROM {_values(SENTENCE_TYPES, 's')}),
x AS (SELECT axis, value, round(coalesce(n, 0) / {TOTAL}, 6) AS share, n IS NULL AS empty, CASE axis """ + " ".join(f"WHEN '{a}' THEN {lo}" for a, (_, (lo, _)) in _CAPS.items()) + " END AS low, CASE axis " + " ".join(f"WHEN '{a}' THEN {hi}" for a, (_, (_, hi)) in _CAPS.items()) + f""" END AS high FROM d LEFT JOIN n USING (axis, value))
SELECT axis, value, share, CASE WHEN share > high + 1e-6 THEN 'above' ELSE 'below' END AS rule FROM x WHERE share > high + 1e-6 OR share < low - 1e-6
UNION ALL SELECT axis, value, share, 'no_cell' FROM x WHERE empty AND axis = 'province'
UNION ALL SELECT 'plan', 'total', (SELECT sum(target) FROM plan) / {TOTAL}, 'total' WHERE (SELECT sum(target) FROM plan) <> {TOTAL}
UNION ALL SELECT 'plan', province_id || '|' || category || '|' || sentence_type || '|' || profile, round(target / {TOTAL}, 6), 'min_cell' FROM plan WHERE target < 2"""


@query("plan_violations", _CHECK_SQL)
def plan_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of the rounded plan outside the caps, provinces without a cell, a wrong total, cells below the least size."""
    cells = plan_cells(spark, sf_dir)
    domains = {"province": [r.province_id for r in provinces(spark, sf_dir).select("province_id").limit(Q.MAX_AXIS).collect()], "category": list(CATEGORIES), "sentence_type": list(SENTENCE_TYPES)}
    out = [Q.cap_violations(cells.withColumn(a, F.col(c)), a, domains[a], *caps) for a, (c, caps) in _CAPS.items()]
    empty = provinces(spark, sf_dir).join(cells, "province_id", "left_anti").select(F.lit("province").alias("axis"), F.col("province_id").alias("value"), F.lit(0.0).alias("share"), F.lit("no_cell").alias("rule"))
    total = cells.agg(F.sum("target").alias("t")).filter(F.coalesce("t", F.lit(0)) != TOTAL).select(F.lit("plan").alias("axis"), F.lit("total").alias("value"), (F.col("t") / TOTAL).alias("share"), F.lit("total").alias("rule"))
    small = cells.filter("target < 2").select(F.lit("plan").alias("axis"), cell_key(*[F.col(k) for k in PLAN_KEYS]).alias("value"), F.round(F.col("target") / TOTAL, 6).alias("share"), F.lit("min_cell").alias("rule"))
    return R.union_all(*out, empty, total, small)


_USES = max(1, int(ENTITY_MAX_SHARE * TOTAL + 1e-9))


@query("plan_capacity", _PLAN_SQL + f""", w AS (SELECT province_id, category, sum(target)::BIGINT AS planned FROM plan GROUP BY ALL),
h AS (SELECT province_id, category, count(*) AS pool FROM ent JOIN prov ON prov.name_current = ent.province GROUP BY ALL), g AS (SELECT * FROM h WHERE category <> 'address' UNION ALL SELECT province_id, 'address', pool FROM h WHERE category = 'street')
SELECT w.*, coalesce(pool, 0) AS pool FROM w LEFT JOIN g USING (province_id, category) WHERE planned > coalesce(pool, 0) * {_USES}""")
def plan_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entity may be used for its largest share of the total; addresses draw on the streets."""
    pool = entities(spark, sf_dir, "category", "province").filter("category <> 'address'").join(provinces(spark, sf_dir).select("province_id", F.col("name_current").alias("province")), "province")
    pool = pool.select("province_id", F.explode(F.when(F.col("category") == "street", F.array(F.lit("street"), F.lit("address"))).otherwise(F.array("category"))).alias("category"))
    return Q.capacity_violations(plan_cells(spark, sf_dir), pool, ["province_id", "category"], _USES)


@query("plan_order_keys", _PLAN_SQL + """ SELECT province_id || '|' || category || '|' || sentence_type || '|' || profile AS cell, row_number() OVER (ORDER BY province_id, category, sentence_type, profile) AS by_columns,
row_number() OVER (ORDER BY province_id || '|' || category || '|' || sentence_type || '|' || profile) AS by_key FROM plan""")
def plan_order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6."""
    p = plan_cells(spark, sf_dir).withColumn("cell", cell_key(*[F.col(k) for k in PLAN_KEYS]))
    p = R.ranked(p, [F.lit(0)], [F.col(k) for k in PLAN_KEYS], "by_columns")
    return R.ranked(p, [F.lit(0)], [F.col("cell")], "by_key").select("cell", "by_columns", "by_key")


@query("cell_ids_and_seeds", """SELECT DISTINCT k AS cell, ('0x' || substr(sha256('42|' || k), 1, 16))::UBIGINT::DECIMAL(20, 0) AS seed, substr(sha1(k || '|0'), 1, 16) AS first_id
FROM (SELECT province_id || '|' || category || '|' || sentence_type || '|' || variation_profile AS k FROM plan_small)""")
def cell_ids_and_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11-F13."""
    k = cell_key(*[F.col(c) for c in ("province_id", "category", "sentence_type", "variation_profile")])
    p = table(spark, sf_dir, "plan_small").filter("province_id is not null").select(k.alias("cell")).distinct()
    return p.select("cell", cell_seed(F.lit("42"), F.col("cell")).alias("seed"), sample_id(F.col("cell"), F.lit(0)).alias("first_id"))


@query("variation_keys", with_views("samp") + "SELECT name_variant || '+' || number_style || '+' || 'no_prefix' || '+' || register AS key, count(*) AS n FROM samp WHERE name_variant IS NOT NULL AND number_style IS NOT NULL AND register IS NOT NULL GROUP BY 1")
def variation_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14."""
    s = samples(spark, sf_dir, "name_variant", "number_style", "register").filter("name_variant is not null and number_style is not null and register is not null")
    return s.groupBy(F.concat_ws("+", "name_variant", "number_style", F.lit("no_prefix"), "register").alias("key")).agg(F.count("*").alias("n"))


_TIER_W = "CASE WHEN c_acctbal > 6000 THEN 5.0 WHEN c_acctbal > 0 THEN 2.0 ELSE 1.0 END"


def _tier(c: str = "c_acctbal"):
    return F.when(F.col(c) > 6000, 5.0).when(F.col(c) > 0, 2.0).otherwise(1.0)


@query("weighted_shuffle_topk", f"""SELECT c_nationkey, c_custkey, place FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY
 round(pow(greatest({uniform_sql("'42'", "c_nationkey::VARCHAR", "c_custkey::VARCHAR")}, 1e-12), 1 / {_TIER_W}), 12) DESC, c_custkey) AS place FROM customer) WHERE place <= 5""")
def weighted_shuffle_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3."""
    c = table(spark, sf_dir, "customer")
    u = uniform("42", F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string"))
    return R.ranked(c, ["c_nationkey"], [race_key(u, _tier()).desc(), F.col("c_custkey")], "place").filter("place <= 5").select("c_nationkey", "c_custkey", "place")


STYLES = [("cardinal", 0.5), ("digit_by_digit", 0.18), ("mixed", 0.07), ("none", 0.25)]


@query("weighted_pick", f"""SELECT o_orderkey, CASE WHEN u < 0.5 THEN 'cardinal' WHEN u < 0.68 THEN 'digit_by_digit' WHEN u < 0.75 THEN 'mixed' ELSE 'none' END AS style
FROM (SELECT o_orderkey, {uniform_sql("'42'", "o_orderkey::VARCHAR", "'style'")} AS u FROM orders)""")
def weighted_pick_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4."""
    return table(spark, sf_dir, "orders").select("o_orderkey", weighted_pick(STYLES, uniform("42", F.col("o_orderkey").cast("string"), "style")).alias("style"))


@query("admin_quota_pool", """
WITH t AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL), s AS (SELECT *, n / sum(n) OVER (PARTITION BY c_nationkey) AS share FROM t),
f AS (SELECT *, floor(round(share * 17, 9))::BIGINT AS f, round(share * 17 - floor(round(share * 17, 9)), 9) AS frac FROM s),
k AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY frac DESC, c_mktsegment) AS up, 17 - sum(f) OVER (PARTITION BY c_nationkey) AS rest FROM f)
SELECT c_nationkey, c_mktsegment, n, (f + CASE WHEN up <= rest THEN 1 ELSE 0 END)::BIGINT AS quota FROM k""")
def admin_quota_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cell's target divided among its groups."""
    t = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    s = Q.normalized(t, "n", ["c_nationkey"])
    return Q.largest_remainder(s, "share", F.lit(17), ["c_mktsegment"], ["c_nationkey"], "quota").select("c_nationkey", "c_mktsegment", "n", "quota")


@query("pool_cycle_pairs", """
WITH p AS (SELECT s_nationkey, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS rk, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier),
i AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS i FROM customer)
SELECT c_custkey, s_suppkey, i // n AS lap FROM i JOIN p ON s_nationkey = c_nationkey AND i % n = rk""")
def pool_cycle_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item i takes the pool's row i modulo its size."""
    pool = R.ranked(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey"), ["nation"], [F.col("s_suppkey")], "rk", 0)
    items = R.ranked(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey"), ["nation"], [F.col("c_custkey")], "i", 0)
    sizes = pool.groupBy("nation").agg(F.count("*").alias("n"))
    return R.positional(items, ["nation"], "i", pool, "rk").join(sizes, "nation").select("c_custkey", "s_suppkey", F.floor(F.col("i") / F.col("n")).alias("lap"))


AXIS_WEIGHTS = [("default", "", "present", 0.60), ("default", "", "absent", 0.40), ("register", "formal", "present", 0.85), ("register", "formal", "absent", 0.15),
                ("register", "casual", "present", 0.40), ("category", "admin_unit", "present", 0.85)]
_AXIS_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}', {d})" for a, b, c, d in AXIS_WEIGHTS) + ") w(level, key, value, weight)"


@query("axis_weight_resolution", with_views("samp") + f""", r AS (SELECT DISTINCT coalesce(category, '') AS category, coalesce(register, '') AS register, value FROM samp, (VALUES ('present'), ('absent')) v(value))
SELECT category, register, value, coalesce((SELECT weight::DOUBLE FROM {_AXIS_SQL} WHERE level = 'category' AND key = category AND w.value = r.value), (SELECT weight::DOUBLE FROM {_AXIS_SQL} WHERE level = 'register' AND key = register AND w.value = r.value),
 (SELECT weight::DOUBLE FROM {_AXIS_SQL} WHERE level = 'default' AND w.value = r.value)) AS weight FROM r""")
def axis_weight_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category before register before default."""
    s = table(spark, sf_dir, "generate_small").filter("id is not null").select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("category", "register")]).distinct()
    s = s.withColumn("value", F.explode(F.array(F.lit("present"), F.lit("absent")))).withColumn("default", F.lit(""))
    w = spark.createDataFrame(AXIS_WEIGHTS, "level string, key string, value string, weight double")
    return R.by_precedence(s, w, "value", ["category", "register", "default"]).select("category", "register", "value", "weight")


@query("coverage_matrix_full_grid", "SELECT o.p AS priority, s.s AS segment, count(c_custkey) AS n, count(c_custkey) >= 600 AS ok FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-LOW'), ('5-NONE')) o(p) "
       "CROSS JOIN (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('MACHINERY'), ('SPACE')) s(s) LEFT JOIN (SELECT o_orderpriority, c_mktsegment, c_custkey FROM orders JOIN customer ON c_custkey = o_custkey) x ON o_orderpriority = o.p AND c_mktsegment = s.s GROUP BY ALL")
def coverage_matrix_full_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty cells come out as 0."""
    cells = R.grid(spark, priority=["1-URGENT", "2-HIGH", "3-MEDIUM", "4-LOW", "5-NONE"], segment=["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "SPACE"])
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = o.select(F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("segment"))
    return R.grid_counts(rows, cells, ["priority", "segment"]).withColumn("ok", F.col("n") >= 600)


@query("marginals", with_views("samp") + "SELECT axis, value, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS axis, {a} AS value FROM samp" for a in ("province", "category", "sentence_type", "register", "name_variant")) + ") GROUP BY ALL")
def marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10, A16, A26."""
    axes = ["province", "category", "sentence_type", "register", "name_variant"]
    return R.marginals(samples(spark, sf_dir, *axes), axes)


def _lexicon() -> list[tuple[str, str, float, str]]:
    """(slot, register, rate, word) of the default style; a slot without words has one row with an empty word."""
    style = Style()
    rows = []
    for slot, content in (("opener", style.openers), ("closer", style.closers), ("filler", style.fillers)):
        for register, (rate, words) in content.items():
            rows += [(slot, register, float(rate), w[0] if isinstance(w, tuple) else w) for w in words] or [(slot, register, float(rate), "")]
    return rows + [("noun", r, 1.0, w) for r in ("formal", "neutral", "casual") for w in style.nouns]


def _axis_rows() -> list[tuple[str, str, str, float]]:
    """(axis, key, value, weight) of the default style."""
    style = Style()
    return [(axis, key, value, float(w)) for axis in ("depth", "variant", "number", "prefix") for key, options in getattr(style, axis).items() for value, w in options]


def _rows_sql(rows: list[tuple], columns: str) -> str:
    quoted = ("'" + x + "'" if isinstance(x, str) else f"{x!r}::DOUBLE" for r in rows for x in r)
    width = len(rows[0])
    cells = list(quoted)
    return "(SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(cells[i : i + width]) + ")" for i in range(0, len(cells), width)) + f") v({columns}))"


_SPACE_SQL = f"""lex AS {_rows_sql(_lexicon(), "slot, register, rate, word")}, ax AS {_rows_sql(_axis_rows(), "axis, key, value, weight")},
w AS (SELECT register, slot, sum((word <> '')::INT) + max((rate < 1)::INT) AS n FROM lex GROUP BY ALL), l AS (SELECT axis, count(*) AS n FROM ax WHERE key = 'default' AND weight > 0 GROUP BY 1),
t AS (SELECT register, count(DISTINCT template_id) AS n FROM generate_small WHERE id IS NOT NULL AND register IN ('formal', 'neutral', 'casual') GROUP BY 1),
sp AS (SELECT register, (product(w.n) * (SELECT product(n) FROM l) * max(coalesce(t.n, 0)))::BIGINT AS options FROM w LEFT JOIN t USING (register) GROUP BY register)"""


def _option_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    lex = spark.createDataFrame(_lexicon(), "slot string, register string, rate double, word string")
    ax = spark.createDataFrame(_axis_rows(), "axis string, key string, value string, weight double")
    words = lex.groupBy("register", "slot").agg((F.count_if(F.col("word") != "") + F.max((F.col("rate") < 1).cast("int"))).alias("n"))
    live = ax.filter("key = 'default' and weight > 0").groupBy("axis").agg(F.count("*").alias("n")).select(F.explode(F.array(*[F.lit(r) for r in ("formal", "neutral", "casual")])).alias("register"), F.col("axis").alias("slot"), "n")
    known = table(spark, sf_dir, "generate_small").filter("id is not null and register in ('formal', 'neutral', 'casual')")
    templates = known.select("register", "template_id").filter("template_id is not null").distinct().groupBy("register").agg(F.count("*").alias("n")).select("register", F.lit("template").alias("slot"), "n")
    zero = words.select("register").distinct().join(templates.select("register"), "register", "left_anti").select("register", F.lit("template").alias("slot"), F.lit(0).cast("long").alias("n"))
    counts = R.union_all(words.select("register", "slot", F.col("n").cast("long")), live.select("register", "slot", F.col("n").cast("long")), templates, zero)
    return counts.groupBy("register").agg(F.aggregate(F.collect_list("n"), F.lit(1).cast("long"), lambda a, x: a * x).alias("options"))


@query("option_space_product", f"WITH {_SPACE_SQL} SELECT register, options FROM sp")
def option_space_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per register the exact product of its templates, the words of its slots (and leaving a slot empty) and the live values of its axes."""
    return _option_space(spark, sf_dir)


CANDIDATES = 1.3  # fixed value: candidates per wanted row


@query("weight_warnings", f"""WITH {_SPACE_SQL}, want AS (SELECT split_part(variation_profile, '_', 1) AS register, sum(target_count) * {CANDIDATES} AS n FROM (SELECT DISTINCT * FROM plan_small) GROUP BY 1)
SELECT axis AS item, key, value, 'dead_value' AS issue FROM ax WHERE weight <= 0.05 UNION ALL SELECT axis, key, '', 'not_normalised' FROM ax GROUP BY axis, key HAVING abs(sum(weight) - 1) > 1e-6
UNION ALL SELECT DISTINCT axis, key, '', 'unknown_key' FROM ax WHERE key NOT IN ('default', 'formal', 'neutral', 'casual', 'admin_unit', 'address') UNION ALL SELECT axis, key, value, 'bad_weight' FROM ax WHERE weight < 0 OR weight > 1
UNION ALL SELECT axis, key, value, 'missing_value' FROM (SELECT DISTINCT axis, value FROM ax WHERE key = 'default') JOIN (SELECT DISTINCT axis, key FROM ax) USING (axis) WHERE NOT EXISTS (SELECT 1 FROM ax y WHERE (y.axis, y.key, y.value) = (axis, key, value))
UNION ALL SELECT slot, register, '', 'bad_rate' FROM lex WHERE rate < 0 OR rate > 1 UNION ALL SELECT slot, register, '', 'empty_lexicon_pool' FROM lex GROUP BY ALL HAVING sum((word <> '')::INT) = 0
UNION ALL SELECT 'options', register, '', 'space_below_candidates' FROM sp JOIN want USING (register) WHERE options < n""".replace("(y.axis, y.key, y.value) = (axis, key, value)", "y.axis = x.axis AND y.key = x.key AND y.value = x.value").replace("(SELECT DISTINCT axis, value FROM ax WHERE key = 'default') JOIN (SELECT DISTINCT axis, key FROM ax) USING (axis) WHERE", "(SELECT * FROM (SELECT DISTINCT axis, value FROM ax WHERE key = 'default') JOIN (SELECT DISTINCT axis, key FROM ax) USING (axis)) x WHERE"))
def weight_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All issues of the style at once: values hardly ever drawn, sums, signs, keys, values that a key leaves out, rates, slots
    without words, and registers whose options are fewer than the candidates the plan wants."""
    ax = spark.createDataFrame(_axis_rows(), "item string, key string, value string, weight double")
    lex = spark.createDataFrame(_lexicon(), "item string, key string, rate double, word string")

    def issue(df: DataFrame, name: str, value=F.lit("")) -> DataFrame:
        return df.select("item", "key", value.alias("value"), F.lit(name).alias("issue"))

    v = F.col("value")
    sums = ax.groupBy("item", "key").agg(F.sum("weight").alias("s")).filter(F.abs(F.col("s") - 1) > 1e-6)
    complete = ax.filter("key = 'default'").select("item", "value").join(ax.select("item", "key").distinct(), "item")
    empty = lex.groupBy("item", "key").agg(F.count_if(F.col("word") != "").alias("n")).filter("n = 0")
    plan = table(spark, sf_dir, "plan_small").distinct().groupBy(F.substring_index("variation_profile", "_", 1).alias("register")).agg((F.sum("target_count") * CANDIDATES).alias("want"))
    few = _option_space(spark, sf_dir).join(plan, "register").filter("options < want").select(F.lit("options").alias("item"), F.col("register").alias("key"))
    keys = ax.select("item", "key").distinct().filter(~F.col("key").isin("default", "formal", "neutral", "casual", "admin_unit", "address"))
    return R.union_all(
        issue(ax.filter("weight <= 0.05"), "dead_value", v), issue(sums, "not_normalised"), issue(keys, "unknown_key"), issue(ax.filter("weight < 0 or weight > 1"), "bad_weight", v),
        issue(complete.join(ax.select("item", "key", "value"), ["item", "key", "value"], "left_anti"), "missing_value", v), issue(lex.filter("rate < 0 or rate > 1"), "bad_rate"),
        issue(empty, "empty_lexicon_pool"), issue(few, "space_below_candidates"),
    )


@query("config_table_issues", with_views("prov") + f""", o AS (SELECT * FROM {_rows_sql([(k, v) for k, v in PROVINCE_OVERRIDES.items()], "k, v")}), c AS {_rows_sql(list(CATEGORIES.items()), "k, v")}, s AS {_rows_sql(list(SENTENCE_TYPES.items()), "k, v")}, p AS {_rows_sql(list(PROFILES.items()), "k, v")}
SELECT 'unknown_override' AS rule, k AS item FROM o WHERE k NOT IN (SELECT province_id FROM prov)
UNION ALL SELECT 'infeasible_category', k FROM c WHERE k NOT IN (SELECT category FROM generate_small WHERE category IS NOT NULL)
UNION ALL SELECT 'unknown_category', category FROM (SELECT DISTINCT category FROM plan_small WHERE category IS NOT NULL) WHERE category NOT IN (SELECT k FROM c)
UNION ALL SELECT 'unknown_sentence_type', sentence_type FROM (SELECT DISTINCT sentence_type FROM plan_small WHERE sentence_type IS NOT NULL) WHERE sentence_type NOT IN (SELECT k FROM s)
UNION ALL SELECT 'bad_weight', k FROM (SELECT * FROM c UNION ALL SELECT * FROM s UNION ALL SELECT * FROM p) WHERE v <= 0
UNION ALL SELECT 'thin_cell', s.k || '|' || p.k FROM s, p WHERE (SELECT count(DISTINCT template_id) FROM generate_small g WHERE g.sentence_type = s.k AND contains(template_id, p.k)) < 10""")
def config_table_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every issue of the distribution against the tables at once; thin cells are those of all sentence types and
    profiles with fewer than ten templates."""
    g = table(spark, sf_dir, "generate_small")

    def absent(rule: str, values: DataFrame, known: DataFrame) -> DataFrame:
        return values.toDF("item").filter("item is not null").distinct().join(known.toDF("item").filter("item is not null").distinct(), "item", "left_anti").select(F.lit(rule).alias("rule"), "item")

    def names(d) -> DataFrame:
        return spark.createDataFrame([(x,) for x in d], "item string")

    plan = table(spark, sf_dir, "plan_small")
    bad = [k for d in (CATEGORIES, SENTENCE_TYPES, PROFILES) for k, v in d.items() if v <= 0]
    used = g.select("sentence_type", "template_id").filter("template_id is not null").distinct()
    profile = F.explode(F.filter(F.array(*[F.lit(p) for p in PROFILES]), lambda p: F.contains("template_id", p)))
    have = used.select("sentence_type", profile.alias("profile")).groupBy("sentence_type", "profile").agg(F.count("*").alias("n"))
    thin = R.grid(spark, sentence_type=list(SENTENCE_TYPES), profile=list(PROFILES)).join(have, ["sentence_type", "profile"], "left").filter(F.coalesce("n", F.lit(0)) < 10)
    return R.union_all(
        absent("unknown_override", names(PROVINCE_OVERRIDES), provinces(spark, sf_dir).select("province_id")), absent("infeasible_category", names(CATEGORIES), g.select("category")),
        absent("unknown_category", plan.select("category"), names(CATEGORIES)), absent("unknown_sentence_type", plan.select("sentence_type"), names(SENTENCE_TYPES)),
        names(bad).select(F.lit("bad_weight").alias("rule"), "item"), thin.select(F.lit("thin_cell").alias("rule"), F.concat_ws("|", "sentence_type", "profile").alias("item")),
    )
