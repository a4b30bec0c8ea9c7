"""Queries over the master tables: coverage, integrity, lookups, listings (survey A1-A8, J1-J6, J17, T1-T5, U1-U4, W1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotaloom.functions.names import fold_search
from quotaloom.operators import quality as Y
from quotaloom.operators import relational as R
from quotaloom.plans.registry import query, table

# The taxonomy of entities.
SUBCATEGORIES = {
    "admin_unit": ["province", "district", "ward"],
    "street": ["street", "highway", "alley"],
    "address": ["house_address"],
    "landmark": ["lake", "bridge", "monument", "heritage_site", "market", "mountain", "beach", "museum", "tourist_attraction"],
    "transport": ["airport", "railway_station", "bus_terminal", "ferry_terminal", "metro_station"],
    "public_facility": ["school", "university", "hospital", "government_office"],
    "commercial": ["shopping_mall", "supermarket", "hotel", "restaurant", "gas_station", "bank"],
    "poi_other": ["park", "stadium", "industrial_zone", "worship_place"],
}
TAXONOMY = [(c, s) for c, subs in SUBCATEGORIES.items() for s in subs]
_TAXONOMY_SQL = "(VALUES " + ", ".join(f"('{c}', '{s}')" for c, s in TAXONOMY) + ") t(category, subcategory)"

# The SQL of the derived tables, by name; each query's SQL gets those it names.
VIEWS = {
    "prov": "SELECT province_id, arg_max(name_current, loaded_at) AS name_current, arg_max(region, loaded_at) AS region, arg_max(is_municipality, loaded_at) AS is_municipality, arg_max(popularity_tier, loaded_at) AS popularity_tier, arg_max(admin_status, loaded_at) AS admin_status FROM provinces GROUP BY province_id",
    "dist": "SELECT district_id, nullif(trim(p, ' ' || chr(9)), '') AS province_id, name, type FROM (SELECT district_id, coalesce(province_id, '') AS p, name, type, row_number() OVER (PARTITION BY district_id ORDER BY loaded_at DESC, row_id DESC) AS rn FROM districts) WHERE rn = 1",
    "ward": "SELECT ward_id, nullif(trim(d, ' ' || chr(9)), '') AS district_id, nullif(trim(p, ' ' || chr(9)), '') AS province_id, name, type, legacy_alias FROM (SELECT ward_id, coalesce(district_id, '') AS d, coalesce(province_id, '') AS p, name, type, legacy_alias, row_number() OVER (PARTITION BY ward_id ORDER BY loaded_at DESC, row_id DESC) AS rn FROM wards) WHERE rn = 1",
    "alias": "SELECT DISTINCT nullif(trim(province_id, ' ' || chr(9)), '') AS province_id, alias, alias_type, weight, admin_prefix FROM province_alias",
    "samp": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at) AS rn FROM generate_small WHERE id IS NOT NULL) WHERE rn = 1",
    "ent": "SELECT entity_id, entity, category, subcategory, province, source FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY id) AS rn FROM samp WHERE entity_id IS NOT NULL) WHERE rn = 1",
}
_NEEDS = {"ent": ["samp"]}


def with_views(*names: str) -> str:
    order = [v for v in VIEWS if any(v == n or v in _NEEDS.get(n, []) for n in names)]
    return "WITH " + ", ".join(f"{v} AS ({VIEWS[v]})" for v in order) + " "


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.latest(table(spark, sf_dir, "provinces").drop("deleted_at"), "province_id", ["loaded_at"])


def _latest_units(spark: SparkSession, sf_dir: str, name: str, key: str, columns: tuple[str, ...]) -> DataFrame:
    """The last delivery of each unit; of its columns only those asked for go through the aggregate."""
    columns = columns or tuple(c for c in table(spark, sf_dir, name).columns if c not in ("deleted_at", "row_id", "loaded_at"))
    got = R.latest(table(spark, sf_dir, name).select(*dict.fromkeys((key, "loaded_at", "row_id", *columns))), key, ["loaded_at", "row_id"])
    return got.select(*[R.key_text(F.col(c)).alias(c) if c != key and c in ("district_id", "province_id") else F.col(c) for c in dict.fromkeys((key, *columns))])


def districts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return _latest_units(spark, sf_dir, "districts", "district_id", columns)


def wards(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return _latest_units(spark, sf_dir, "wards", "ward_id", columns)


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "province_alias").select(R.key_text(F.col("province_id")).alias("province_id"), "alias", "alias_type", "weight", "admin_prefix")
    return a.distinct()


def samples(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """(id, columns) of each record once; no other column is read."""
    return R.latest_rows(table(spark, sf_dir, "generate_small"), "id", "loaded_at", ["id", *(c for c in columns if c != "id")])


def entities(spark: SparkSession, sf_dir: str, *columns: str, where: str = "true") -> DataFrame:
    """(entity_id, columns) of each entity, from its smallest record id in its last delivery: one aggregate over the
    columns asked for, without first looking for repeated deliveries; of the records that fulfil ``where``."""
    s = table(spark, sf_dir, "generate_small").filter("entity_id is not null and id is not null").filter(where)
    s = s.select("entity_id", "id", (-F.unix_micros(F.col("loaded_at").cast("timestamp"))).alias("_late"), *columns)
    return R.first_per_group(s, [F.col("entity_id")], ["id", "_late"]).select("entity_id", *columns)


def counted(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


@query("coverage_by_province", with_views("prov", "dist", "ward", "alias", "ent") + """
SELECT prov.province_id, prov.name_current, coalesce(d.n, 0) AS districts, coalesce(w.n, 0) AS wards, coalesce(e.n, 0) AS entities, coalesce(a.n, 0) AS aliases
FROM prov LEFT JOIN (SELECT province_id, count(*) AS n FROM dist GROUP BY 1) d USING (province_id)
LEFT JOIN (SELECT coalesce(dist.province_id, ward.province_id) AS province_id, count(*) AS n FROM ward LEFT JOIN dist ON dist.district_id = ward.district_id GROUP BY 1) w USING (province_id)
LEFT JOIN (SELECT province, count(*) AS n FROM ent GROUP BY 1) e ON e.province = prov.name_current
LEFT JOIN (SELECT province_id, count(*) AS n FROM alias GROUP BY 1) a USING (province_id)""")
def coverage_by_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A4: each dimension is aggregated before it is joined, so no join fans out."""
    d = districts(spark, sf_dir, "province_id")
    w = R.two_path_parent(wards(spark, sf_dir, "district_id", "province_id"), d, "district_id", "province_id").select(F.col("resolved").alias("province_id"))
    e = entities(spark, sf_dir, "province").select(F.col("province").alias("name_current"))
    out = provinces(spark, sf_dir).select("province_id", "name_current")
    for n, key, name in ((d, "province_id", "districts"), (w, "province_id", "wards"), (e, "name_current", "entities"), (aliases(spark, sf_dir), "province_id", "aliases")):
        out = out.join(counted(n, key, name), key, "left")
    return out.select("province_id", "name_current", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("districts", "wards", "entities", "aliases")])


@query("master_totals", with_views("prov", "dist", "ward", "alias", "ent") + """
SELECT 'provinces' AS name, count(*) AS n FROM prov UNION ALL SELECT 'districts', count(*) FROM dist UNION ALL SELECT 'wards', count(*) FROM ward
UNION ALL SELECT 'aliases', count(*) FROM alias UNION ALL SELECT 'entities', count(*) FROM ent""")
def master_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: keys alone are read and counted."""
    keys = {"provinces": ("provinces", "province_id"), "districts": ("districts", "district_id"), "wards": ("wards", "ward_id"), "entities": ("generate_small", "entity_id")}
    parts = {k: table(spark, sf_dir, t).filter("id is not null" if t == "generate_small" else "true").select(c).filter(F.col(c).isNotNull()).distinct() for k, (t, c) in keys.items()}
    parts["aliases"] = aliases(spark, sf_dir)
    return R.union_all(*[d.agg(F.count("*").alias("n")).select(F.lit(k).alias("name"), "n") for k, d in parts.items()])


@query("entity_union", with_views("ent", "dist", "ward") + """
SELECT entity_id AS ref, entity AS name, category, subcategory FROM ent UNION ALL SELECT 'district_' || district_id, name, 'admin_unit', 'district' FROM dist
UNION ALL SELECT 'ward_' || ward_id, name, 'admin_unit', 'ward' FROM ward""")
def entity_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    def unit(df: DataFrame, kind: str) -> DataFrame:
        return df.select(F.concat_ws("_", F.lit(kind), f"{kind}_id").alias("ref"), "name", F.lit("admin_unit").alias("category"), F.lit(kind).alias("subcategory"))

    e = entities(spark, sf_dir, "entity", "category", "subcategory").select(F.col("entity_id").alias("ref"), F.col("entity").alias("name"), "category", "subcategory")
    return R.union_all(e, unit(districts(spark, sf_dir, "name"), "district"), unit(wards(spark, sf_dir, "name"), "ward"))


@query("category_histogram", with_views("ent") + "SELECT coalesce(category, '') AS category, coalesce(subcategory, '') AS subcategory, count(*) AS n FROM ent GROUP BY 1, 2")
def category_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = entities(spark, sf_dir, "category", "subcategory").select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("category", "subcategory")])
    return e.groupBy("category", "subcategory").agg(F.count("*").alias("n"))


@query("empty_categories", with_views("ent") + f"SELECT t.*, s.source FROM {_TAXONOMY_SQL}, (VALUES ('all'), ('manual'), ('osm')) s(source) WHERE NOT EXISTS (SELECT 1 FROM ent WHERE ent.category = t.category AND ent.subcategory = t.subcategory AND (s.source = 'all' OR ent.source = s.source))")
def empty_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subcategories of the taxonomy without an entity, by source: ``all`` sources, or each alone."""
    domain = spark.createDataFrame(TAXONOMY, "category string, subcategory string").withColumn("source", F.explode(F.array(*[F.lit(x) for x in ("all", "manual", "osm")])))
    e = entities(spark, sf_dir, "category", "subcategory", "source").select("category", "subcategory", F.explode(F.array(F.lit("all"), F.col("source"))).alias("source"))
    return domain.join(e.distinct(), ["category", "subcategory", "source"], "left_anti")


@query("duplicate_names_topk", with_views("ent") + """
SELECT province, entity, n, array_to_string(ids[1:5], ',') AS ids FROM (SELECT province, entity, count(*) AS n, list_sort(list(entity_id)) AS ids FROM ent GROUP BY 1, 2 HAVING count(*) > 1)
ORDER BY n DESC, province NULLS FIRST, entity NULLS FIRST LIMIT 50""")
def duplicate_names_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that several entities of a province share, the 50 most frequent with their five smallest ids. Counts alone decide
    the 50; only their entities are ranked, with the limit of five below the shuffle."""
    e = entities(spark, sf_dir, "province", "entity")
    top = e.groupBy("province", "entity").agg(F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n"), "province", "entity").limit(50)
    top = top.select(F.col("province").alias("_p"), F.col("entity").alias("_e"), "n")
    of_top = e.join(top, F.col("province").eqNullSafe(F.col("_p")) & F.col("entity").eqNullSafe(F.col("_e"))).select("province", "entity", "n", "entity_id")
    low = Y.keep_per_group(of_top, ["province", "entity"], ["entity_id"], 5)
    return low.groupBy("province", "entity", "n").agg(F.array_join(F.array_sort(F.collect_list("entity_id")), ",").alias("ids"))


@query("tier_distribution", with_views("prov") + "SELECT popularity_tier AS tier, count(*) AS n, sum(CASE popularity_tier WHEN 1 THEN 6 WHEN 2 THEN 2 ELSE 1 END * CASE WHEN is_municipality THEN 1.5 ELSE 1 END)::DOUBLE AS weight FROM prov GROUP BY 1")
def tier_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8, N5."""
    p = provinces(spark, sf_dir).withColumn("w", province_weight())
    return p.groupBy(F.col("popularity_tier").alias("tier")).agg(F.count("*").alias("n"), F.sum("w").alias("weight"))


def province_weight():
    """Weight by tier, raised for municipalities."""
    tier = F.when(F.col("popularity_tier") == 1, 6.0).when(F.col("popularity_tier") == 2, 2.0).otherwise(1.0)
    return tier * F.when(F.col("is_municipality"), 1.5).otherwise(1.0)


@query("alias_counts", with_views("alias", "prov") + """
SELECT alias_type, count(*) AS n, count(DISTINCT prov.province_id) AS provinces, sum(CASE WHEN admin_prefix = '' THEN 1 ELSE 0 END)::BIGINT AS bare
FROM alias LEFT JOIN prov USING (province_id) GROUP BY 1""")
def alias_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, J2."""
    a = aliases(spark, sf_dir).join(provinces(spark, sf_dir).select("province_id", F.col("province_id").alias("_p")), "province_id", "left")
    return a.groupBy("alias_type").agg(F.count("*").alias("n"), F.countDistinct("_p").alias("provinces"), F.count_if(F.col("admin_prefix") == "").alias("bare"))


@query("alias_lookup", with_views("samp", "prov") + """,
a AS (SELECT lower(alias) AS k, arg_max(trim(province_id, ' ' || chr(9)), strftime(loaded_at, '%Y%m%d%H%M%S%f') || lpad(row_id::VARCHAR, 12, '0')) AS pid FROM province_alias WHERE trim(province_id, ' ' || chr(9)) <> '' GROUP BY 1),
c AS (SELECT lower(name_current) AS k, max(province_id) AS pid FROM prov GROUP BY 1)
SELECT province, count(*) AS n, coalesce(max(a.pid), max(c.pid), '') AS province_id FROM samp LEFT JOIN a ON a.k = lower(province) LEFT JOIN c ON c.k = lower(province)
WHERE province IS NOT NULL GROUP BY 1""")
def alias_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in records resolved to provinces; counted before they are joined."""
    names = counted(samples(spark, sf_dir, "province").filter("province is not null"), "province", "n")
    a = table(spark, sf_dir, "province_alias").withColumn("province_id", R.key_text(F.col("province_id"))).filter("province_id is not null")
    got = R.alias_lookup(names, "province", a, "alias", provinces(spark, sf_dir), "name_current", "province_id", ["loaded_at", "row_id"])
    return got.select("province", "n", F.coalesce("province_id", F.lit("")).alias("province_id"))


@query("master_coverage_flags", with_views("prov", "ent") + """
SELECT province_id, coalesce(n, 0) AS landmarks, coalesce(n, 0) >= 8 AS enough, region FROM prov
LEFT JOIN (SELECT province, count(*) AS n FROM ent WHERE category = 'landmark' GROUP BY 1) e ON e.province = prov.name_current""")
def master_coverage_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provinces without any landmark come out too."""
    e = entities(spark, sf_dir, "category", "province").filter("category = 'landmark'").groupBy(F.col("province").alias("name_current")).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0).cast("long"))
    return provinces(spark, sf_dir).join(e, "name_current", "left").select("province_id", n.alias("landmarks"), (n >= 8).alias("enough"), "region")


# What a complete master has.
EXPECTED = {"provinces": 34, "legacy_aliases": 63}


@query("expected_counts", with_views("prov", "alias", "ent") + """
SELECT 'provinces' AS name, 34 AS expected, count(*) AS n, count(*) = 34 AS met FROM prov
UNION ALL SELECT 'legacy_aliases', 63, count(DISTINCT alias), count(DISTINCT alias) = 63 FROM alias WHERE alias_type = 'legacy'
UNION ALL SELECT 'provinces_without_entities', 0, count(*), count(*) = 0 FROM prov WHERE name_current NOT IN (SELECT province FROM ent WHERE province IS NOT NULL)""")
def expected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: counts against those of a complete master, and provinces without any entity."""
    p = provinces(spark, sf_dir).select("name_current")
    legacy = aliases(spark, sf_dir).filter("alias_type = 'legacy' and alias is not null").select("alias").distinct()
    used = table(spark, sf_dir, "generate_small").filter("id is not null and entity_id is not null").select(F.col("province").alias("name_current"))
    parts = {"provinces": (p, EXPECTED["provinces"]), "legacy_aliases": (legacy, EXPECTED["legacy_aliases"]), "provinces_without_entities": (p.join(used, "name_current", "left_anti"), 0)}
    return R.union_all(*[d.agg(F.count("*").alias("n")).select(F.lit(k).alias("name"), F.lit(e).alias("expected"), "n", (F.col("n") == e).alias("met")) for k, (d, e) in parts.items()])


_FK = [("ward_district", "wards", "district_id", "row_id", "districts"), ("ward_province", "wards", "province_id", "row_id", "provinces"),
       ("district_province", "districts", "province_id", "row_id", "provinces"), ("alias_province", "province_alias", "province_id", "row_id", "provinces"),
       ("lineitem_order", "lineitem", "l_orderkey", "l_linenumber", "orders"), ("order_customer", "orders", "o_custkey", "o_orderkey", "customer")]
_PK = {"districts": "district_id", "provinces": "province_id", "orders": "o_orderkey", "customer": "c_custkey"}


@query("fk_violations", " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, {row}::VARCHAR AS \"row\", trim({ref}::VARCHAR, ' ' || chr(9)) AS ref FROM {t} WHERE trim({ref}::VARCHAR, ' ' || chr(9)) <> '' "
    f"AND trim({ref}::VARCHAR, ' ' || chr(9)) NOT IN (SELECT trim({_PK[p]}::VARCHAR, ' ' || chr(9)) FROM {p} WHERE {_PK[p]} IS NOT NULL)" for rule, t, ref, row, p in _FK))
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4, V1."""
    return R.union_all(*[R.missing_parents(rule, table(spark, sf_dir, t), ref, row, table(spark, sf_dir, p), _PK[p]) for rule, t, ref, row, p in _FK])


@query("pk_uniqueness", " UNION ALL ".join(f"SELECT '{t}' AS table_name, {k}::VARCHAR AS key, count(*) AS n FROM {t} GROUP BY {k} HAVING count(*) > 1" for t, k in
                                         (("provinces", "province_id"), ("districts", "district_id"), ("wards", "ward_id"), ("generate_small", "id"), ("documents", "doc_id"))))
def pk_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17."""
    keys = (("provinces", "province_id"), ("districts", "district_id"), ("wards", "ward_id"), ("generate_small", "id"), ("documents", "doc_id"))
    return R.union_all(*[R.duplicates(t, table(spark, sf_dir, t), k) for t, k in keys])


@query("hint_validity", with_views("ward", "dist", "alias") + """
SELECT ward_id, legacy_alias, coalesce(dist.province_id, ward.province_id) AS province_id FROM ward LEFT JOIN dist ON dist.district_id = ward.district_id
WHERE legacy_alias <> '' AND NOT EXISTS (SELECT 1 FROM alias WHERE alias_type = 'legacy' AND alias.alias = legacy_alias AND alias.province_id = coalesce(dist.province_id, ward.province_id))""")
def hint_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hints that are no legacy alias of the ward's province, which is resolved on both paths first."""
    w = R.two_path_parent(wards(spark, sf_dir, "district_id", "province_id", "legacy_alias").filter("legacy_alias <> ''"), districts(spark, sf_dir, "province_id"), "district_id", "province_id")
    known = aliases(spark, sf_dir).filter("alias_type = 'legacy'").select(F.col("province_id").alias("resolved"), F.col("alias").alias("legacy_alias"))
    return w.join(known, ["resolved", "legacy_alias"], "left_anti").select("ward_id", "legacy_alias", F.col("resolved").alias("province_id"))


@query("manual_wins_union", with_views("ent") + """
SELECT entity_id, entity, province, source FROM ent WHERE source = 'manual' UNION ALL SELECT entity_id, entity, province, source FROM ent o WHERE source = 'osm'
AND NOT EXISTS (SELECT 1 FROM ent m WHERE m.source = 'manual' AND m.province = o.province AND lower(m.entity) = lower(o.entity))""")
def manual_wins_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6."""
    e = entities(spark, sf_dir, "entity", "province", "source")
    return R.prefer_left(e.filter("source = 'manual'"), e.filter("source = 'osm'"), [F.col("province"), F.lower("entity")])


@query("two_path_parent", with_views("ward", "dist") + "SELECT ward_id, coalesce(dist.province_id, ward.province_id) AS province_id FROM ward LEFT JOIN dist ON dist.district_id = ward.district_id")
def two_path_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3."""
    return R.two_path_parent(wards(spark, sf_dir, "district_id", "province_id"), districts(spark, sf_dir, "province_id"), "district_id", "province_id").select("ward_id", F.col("resolved").alias("province_id"))


@query("first_per_group_lowest_id", "SELECT min(p_partkey) AS p_partkey, arg_min(p_name, p_partkey) AS p_name, p_brand FROM part GROUP BY lower(p_name), p_brand")
def first_per_group_lowest_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return R.first_per_group(p, [F.lower("p_name"), F.col("p_brand")], ["p_partkey"])


@query("reconciliation_diff", """
SELECT province_id, 'plan' AS only_in FROM (SELECT province_id FROM plan_small WHERE province_id IS NOT NULL EXCEPT SELECT trim(province_id, ' ' || chr(9)) FROM districts)
UNION ALL SELECT province_id, 'districts' FROM (SELECT trim(province_id, ' ' || chr(9)) AS province_id FROM districts WHERE trim(province_id, ' ' || chr(9)) <> '' EXCEPT SELECT province_id FROM plan_small)""")
def reconciliation_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J17, U2."""
    d = table(spark, sf_dir, "districts").select(R.key_text(F.col("province_id")).alias("province_id"))
    return R.difference(table(spark, sf_dir, "plan_small"), d, "province_id", "plan", "districts")


@query("paged_filtered_entities", with_views("ent") + """
SELECT entity_id, entity FROM ent WHERE category = 'street' AND contains(replace(strip_accents(lower(nfc_normalize(entity))), 'đ', 'd'), 'duong') ORDER BY entity_id LIMIT 25 OFFSET 25""")
def paged_filtered_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12, T2, T3."""
    e = entities(spark, sf_dir, "category", "entity").filter((F.col("category") == "street") & fold_search(F.col("entity")).contains("duong"))
    return R.page(e.select("entity_id", "entity"), ["entity_id"], 2, 25)


@query("folded_text_search", with_views("samp") + """
SELECT id FROM samp WHERE sentence_type = 'search' AND contains(replace(strip_accents(lower(text)), 'đ', 'd'), 'thanh pho')""")
def folded_text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8, P13."""
    s = samples(spark, sf_dir, "sentence_type", "text").filter((F.col("sentence_type") == "search") & fold_search(F.col("text")).contains("thanh pho"))
    return s.select("id")


@query("multi_key_province_sort", with_views("prov") + "SELECT province_id, row_number() OVER (ORDER BY popularity_tier, region, name_current, province_id) AS place FROM prov")
def multi_key_province_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4, over a table of provinces."""
    p = provinces(spark, sf_dir)
    return R.ranked(p, [F.lit(0)], [F.col(c) for c in ("popularity_tier", "region", "name_current", "province_id")], "place").select("province_id", "place")


@query("tile_dedupe_keep_first", """
WITH t AS (SELECT event_id, ts, event_type, tile FROM events, (SELECT unnest([0, 1]) AS tile) WHERE tile = 0 OR event_id % 3 = 0)
SELECT event_id, min(tile) AS tile, arg_min(event_type, tile) AS event_type FROM t GROUP BY 1""")
def tile_dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: elements that overlapping tiles deliver twice."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    tiles = R.union_all(e.withColumn("tile", F.lit(0)), e.filter("event_id % 3 = 0").withColumn("tile", F.lit(1)))
    return R.first_per_group(tiles, [F.col("event_id")], ["tile"]).select("event_id", "tile", "event_type")


@query("null_to_empty_row", with_views("samp") + "SELECT id, coalesce(province_legacy, '') AS province_legacy, coalesce(district, '') AS district, coalesce(ward, '') AS ward, coalesce(street, '') AS street, coalesce(address, '') AS address FROM samp")
def null_to_empty_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11."""
    cols = ("province_legacy", "district", "ward", "street", "address")
    return samples(spark, sf_dir, *cols).select("id", *[F.coalesce(c, F.lit("")).alias(c) for c in cols])
