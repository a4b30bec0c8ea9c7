"""Queries over names, numbers and templates (survey P1-P9, F1-F27, V2-V10, A11, A24)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotaloom.functions import names as N
from quotaloom.functions import numbers as D
from quotaloom.functions import rubric
from quotaloom.functions import templates as T
from quotaloom.functions.tags import Rule, classify, mapped
from quotaloom.operators import relational as R
from quotaloom.plans.master import SUBCATEGORIES, entities, provinces, samples, wards, with_views
from quotaloom.plans.registry import query, table
from quotaloom.workspace import spread_small

# The bank of the queries' templates: (id, sentence type, register, length class, slots, text), good and broken ones.
TEMPLATES = [
    ("nav_command_formal_medium_001", "nav_command", "formal", "medium", "opener,entity,closer", "{opener}dẫn tôi tới {entity}{closer}"),
    ("nav_command_casual_short_001", "nav_command", "casual", "short", "entity,closer", "tới {entity}{closer}"),
    ("search_neutral_short_001", "search", "neutral", "short", "opener,entity,closer", "{opener}giúp em tìm {entity}{closer}"),
    ("search_neutral_medium_001", "search", "neutral", "medium", "opener,entity,closer", "{opener}mình cần tìm {entity} ở đâu{closer}"),
    ("route_question_formal_medium_001", "route_question", "formal", "medium", "opener,entity,closer", "{opener}cho hỏi đi tới {entity} được không{closer}"),
    ("conversational_casual_long_001", "conversational", "casual", "long", "opener,entity,closer", "{opener}mình đang ghé {entity}, chắc còn lâu lắm{closer}"),
    ("contextual_neutral_medium_001", "contextual", "neutral", "medium", "opener,entity,category_noun,closer", "{opener}quanh {entity} có {category_noun} nào không{closer}"),
    ("short_command_casual_short_001", "short_command", "casual", "short", "entity", "về {entity} nha"),
    ("bad_digit_001", "search", "neutral", "short", "entity", "tìm 3 chỗ gần {entity}"),
    ("bad_abbreviation_001", "search", "neutral", "short", "entity", "ra BV cạnh {entity}"),
    ("bad_slots_001", "search", "neutral", "short", "opener,entity", "tìm {entity}{closer}"),
    ("bad_unknown_001", "search", "neutral", "short", "entity,place", "từ {place} tới {entity}"),
    ("bad_missing_001", "search", "neutral", "short", "opener", "{opener}tìm giúp"),
    ("bad_proper_001", "nav_command", "formal", "medium", "entity", "từ Hội An tới {entity}"),
    ("bad_spacing_001", "nav_command", "formal", "medium", "opener,entity", "{opener} đi  tới {entity}"),
    ("bad_quantifier_001", "nav_command", "formal", "medium", "entity", "tìm các {entity} quanh đây"),
    ("bad_nearest_001", "nav_command", "formal", "medium", "entity", "tới {entity} nào gần nhất"),
    ("bad_classifier_001", "nav_command", "formal", "medium", "entity", "hỏi đường {entity}"),
]
QUESTION_WORDS, PARTICLES, STATEMENTS = ["đâu", "nào", "không", "sao"], ["nha", "nhé", "ạ", "nhỉ"], ["mình", "tôi", "em", "chắc"]
TEMPLATE_COLUMNS = "template_id string, sentence_type string, register string, length_class string, slots string, text string"
TEMPLATES_SQL = "bank AS (SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(f"'{x}'" for x in t) + ")" for t in TEMPLATES) + ") t(template_id, sentence_type, register, length_class, slots, text))"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, TEMPLATE_COLUMNS)


_WS = r"[\t-\r \x{85}\p{Z}]+"
_SQUEEZE = rf"trim(regexp_replace(%s, '{_WS}', ' ', 'g'))"
_RAW = "CASE WHEN entity_id LIKE '%7' THEN entity || ' (Tp.A&B) - x;y' ELSE entity END"
_FIRST = _SQUEEZE % f"regexp_extract(nfc_normalize({_RAW}), '^[^\n;]*')"
_SPOKEN = rf"replace(regexp_replace({_FIRST}, '(^|[^\p{{L}}\p{{N}}_])[Tt][Pp]\.', '\1Thành phố ', 'g'), '&', ' và ')"
_PLAIN = _SQUEEZE % rf"regexp_replace({_SPOKEN}, '[()|_·!''\"–—-]', ' ', 'g')"


@query("normalized_names", with_views("ent") + f"SELECT entity_id, {_SQUEEZE % 'nfc_normalize(entity)'} AS name FROM ent")
def normalized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 over names with decomposed accents and odd blanks."""
    return entities(spark, sf_dir, "entity").select("entity_id", N.normalize_name(F.col("entity")).alias("name"))


@query("plain_names", with_views("ent") + f"SELECT entity_id, {_PLAIN} AS name FROM ent")
def plain_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 up to its last step."""
    raw = F.concat("entity", F.when(F.col("entity_id").endswith("7"), " (Tp.A&B) - x;y").otherwise(""))
    return entities(spark, sf_dir, "entity").select("entity_id", N.plain_name(N.nfc(raw)).alias("name"))


@query("clean_names")
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2, P3."""
    raw = F.concat_ws(" ", "entity", F.when(F.col("entity_id").endswith("3"), F.col("entity")))
    e = entities(spark, sf_dir, "entity").select("entity_id", N.nfc(raw).alias("raw"))
    return e.select("entity_id", N.clean_name(F.col("raw")).alias("name"))


@query("usable_names", r"""SELECT p_partkey, p_name, p_size FROM (SELECT p_partkey, p_size, CASE p_size % 5 WHEN 0 THEN 'Chợ' WHEN 1 THEN 'MX' WHEN 2 THEN 'ACB' WHEN 3 THEN 'Khach San Misa' ELSE p_name END AS p_name FROM part)
WHERE lower(p_name) NOT IN ('chợ') AND (length(p_name) > 3 OR lower(p_name) IN ('acb')) AND NOT regexp_matches(p_name, '(?i)\b(Khach San)')""")
def usable_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4."""
    k = F.col("p_size") % 5
    name = F.when(k == 0, "Chợ").when(k == 1, "MX").when(k == 2, "ACB").when(k == 3, "Khach San Misa").otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", name.alias("p_name")).filter(N.is_usable(F.col("p_name"))).select("p_partkey", "p_name", "p_size")


@query("speakable_filter", with_views("ent") + r"SELECT entity_id FROM ent WHERE NOT regexp_matches(entity, '[^\P{L}\x{0}-\x{24F}\x{1E00}-\x{1EFF}]') AND trim(entity) <> ''")
def speakable_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6."""
    return entities(spark, sf_dir, "entity").filter(N.is_speakable(F.col("entity"))).select("entity_id")


@query("slug_and_ref_ids")
def slug_and_ref_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9, F10, over all names: look-alike, full-width, invisible and other-script characters too."""
    return _slugs(entities(spark, sf_dir, "entity", "province"))


def _slugs(e: DataFrame) -> DataFrame:
    s = F.coalesce(N.slug(N.nfc(F.col("entity"))), F.lit("unnamed"))
    return e.select("entity_id", s.alias("slug"), F.concat_ws("_", F.lit("manual"), F.coalesce("province", F.lit("")), s).alias("ref"))


@query("alias_spoken_forms", "SELECT row_id, replace(alias || ' - ' || alias_type, ' - ', ' ') AS alias FROM province_alias WHERE alias IS NOT NULL")
def alias_spoken_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5."""
    a = table(spark, sf_dir, "province_alias").filter("alias is not null")
    return a.select("row_id", N.alias_spoken_form(F.concat_ws(" - ", "alias", "alias_type")).alias("alias"))


@query("prefix_split_and_case")
def prefix_split_and_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F19-F22, over all streets in composed form."""
    s = samples(spark, sf_dir, "street", "subcategory", "category")
    return _prefixes(s.filter("street is not null").withColumn("street", N.nfc(F.col("street"))))


def _prefixes(s: DataFrame) -> DataFrame:
    head, rest = N.street_prefix(F.col("street"))
    return s.select(
        "id", F.coalesce(head, F.lit("")).alias("prefix"), rest.alias("rest"), N.embeds_type(F.col("street"), F.coalesce("subcategory", F.lit(""))).alias("embeds"),
        N.lower_street_words(F.col("street")).alias("lowered"), N.number_leads(F.col("street"), F.coalesce("category", F.lit(""))).alias("leads"),
    )


@query("ward_prefix_split", with_views("ward") + "SELECT ward_id, lower(type) AS kind, name AS core FROM ward WHERE lower(type) IN ('phường', 'xã', 'thị trấn', 'đặc khu') AND name <> ''")
def ward_prefix_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P16."""
    kind, core = N.ward_core(F.concat_ws(" ", F.initcap("type"), "name"))
    return wards(spark, sf_dir, "type", "name").select("ward_id", kind.alias("kind"), core.alias("core")).filter("kind is not null")


_UNITS_SQL = "['" + "','".join(D.DIGITS) + "']"
_WORDS_SQL = f"""
u AS (SELECT n::BIGINT AS n, n // 100 AS h, n % 100 // 10 AS t, n % 10 AS o FROM range(1000) r(n)),
two AS (SELECT *, CASE WHEN t = 0 THEN {_UNITS_SQL}[o + 1] WHEN t = 1 AND o = 0 THEN 'mười' WHEN t = 1 AND o = 5 THEN 'mười lăm' WHEN t = 1 THEN 'mười ' || {_UNITS_SQL}[o + 1]
  ELSE {_UNITS_SQL}[t + 1] || ' mươi' || CASE o WHEN 0 THEN '' WHEN 1 THEN ' mốt' WHEN 4 THEN ' tư' WHEN 5 THEN ' lăm' ELSE ' ' || {_UNITS_SQL}[o + 1] END END AS below FROM u),
grp AS (SELECT n, CASE WHEN h = 0 THEN below ELSE {_UNITS_SQL}[h + 1] || ' trăm' || CASE WHEN t = 0 AND o = 0 THEN '' WHEN t = 0 THEN ' lẻ ' || below ELSE ' ' || below END END AS lead,
  {_UNITS_SQL}[h + 1] || ' trăm' || CASE WHEN t = 0 AND o = 0 THEN '' WHEN t = 0 THEN ' lẻ ' || below ELSE ' ' || below END AS inn FROM two),
k AS (SELECT o_orderkey, (o_orderkey * 7919 % CASE o_orderkey % 4 WHEN 0 THEN 100 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 ELSE 1000000000 END) AS n FROM orders),
g AS (SELECT o_orderkey, n, n // 1000000 AS a, n // 1000 % 1000 AS b, n % 1000 AS c FROM k),
card AS (SELECT o_orderkey, g.n, trim(CASE WHEN a > 0 THEN x.lead || ' triệu ' ELSE '' END
  || CASE WHEN b = 0 THEN '' WHEN a > 0 THEN y.inn || ' nghìn ' ELSE y.lead || ' nghìn ' END
  || CASE WHEN c = 0 AND g.n > 0 THEN '' WHEN a + b > 0 THEN z.inn ELSE z.lead END) AS words FROM g JOIN grp x ON x.n = a JOIN grp y ON y.n = b JOIN grp z ON z.n = c),
digs AS (SELECT o_orderkey, n, array_to_string(list_transform(string_split(n::VARCHAR, ''), lambda d: {_UNITS_SQL}[d::INT + 1]), ' ') AS words FROM k)
"""


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("o_orderkey") % 4
    size = F.when(m == 0, 100).when(m == 1, 1000).when(m == 2, 1_000_000).otherwise(1_000_000_000)
    return table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") * 7919 % size).alias("n"))


@query("number_cardinal", f"WITH {_WORDS_SQL} SELECT o_orderkey, n, words FROM card")
def number_cardinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1-F3."""
    return _numbers(spark, sf_dir).select("o_orderkey", "n", D.read_cardinal(F.col("n").cast("string")).alias("words"))


@query("number_digits", f"WITH {_WORDS_SQL} SELECT o_orderkey, n, words FROM digs")
def number_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4."""
    return _numbers(spark, sf_dir).select("o_orderkey", "n", D.read_digits(F.col("n").cast("string")).alias("words"))


@query("number_mixed", f"WITH {_WORDS_SQL} SELECT o_orderkey, card.n, CASE WHEN card.n < 100 THEN card.words ELSE digs.words END AS words FROM card JOIN digs USING (o_orderkey)")
def number_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers(spark, sf_dir).select("o_orderkey", "n", D.read_number(F.col("n").cast("string"), F.lit(D.MIXED)).alias("words"))


@query("house_numbers", f"""WITH {_WORDS_SQL},
h AS (SELECT l_orderkey, l_linenumber, l_orderkey % 300 + 1 AS a, l_partkey % 99 + 1 AS b, l_suppkey % 5 AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, x.lead || CASE c WHEN 0 THEN ' bê' ELSE '' END || CASE WHEN c > 2 THEN ' xuyệt ' || y.lead ELSE '' END AS words
FROM h JOIN grp x ON x.n = a JOIN grp y ON y.n = b""")
def house_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5, R6."""
    li = spread_small(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"))
    c = F.col("l_suppkey") % 5
    s = F.concat((F.col("l_orderkey") % 300 + 1).cast("string"), F.when(c == 0, "B").otherwise(""), F.when(c > 2, F.concat(F.lit("/"), (F.col("l_partkey") % 99 + 1).cast("string"))).otherwise(""))
    return li.select("l_orderkey", "l_linenumber", D.read_house_number(s, F.lit(D.CARDINAL)).alias("words"))


@query("abbreviation_expand", "SELECT p_partkey, 'quận ' || p_name || ' HTPX trung tâm thương mại thành phố ' || p_brand || ' quốc lộ' AS text FROM part")
def abbreviation_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """whole tokens only."""
    raw = F.concat(F.lit("Q. "), "p_name", F.lit(" HTPX TTTM TP "), "p_brand", F.lit(" QL"))
    return table(spark, sf_dir, "part").select("p_partkey", D.expand_abbreviations(raw).alias("text"))


@query("entity_name_verbalize", f"""WITH {_WORDS_SQL}
SELECT p_partkey, 'quận ' || x.lead || ' Hẻm ' || y.lead || ' xuyệt ' || x.lead || ' xê' AS words FROM part JOIN grp x ON x.n = p_size JOIN grp y ON y.n = p_partkey % 1000""")
def entity_name_verbalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7."""
    raw = F.concat(F.lit("Q. "), F.col("p_size").cast("string"), F.lit(" Hẻm "), (F.col("p_partkey") % 1000).cast("string"), F.lit("/"), F.col("p_size").cast("string"), F.lit("C"))
    return table(spark, sf_dir, "part").select("p_partkey", D.verbalize_name(raw, F.lit(D.CARDINAL)).alias("words"))


@query("head_tail_class", f"""WITH {TEMPLATES_SQL}
SELECT template_id, CASE WHEN lower(tail) = '{{entity}}' THEN 'plain' WHEN lower(tail) IN {_in(QUESTION_WORDS)} THEN 'question' WHEN lower(tail) IN {_in(PARTICLES)} THEN 'particle'
  WHEN tail <> '' AND contains(text, ',') AND NOT contains(list_last(string_split(text, ',')), '{{entity}}') THEN 'trailing_clause' ELSE 'plain' END AS tail,
 CASE WHEN lower(head) IN {_in(STATEMENTS)} THEN 'statement' ELSE 'imperative' END AS head, asks, contains(text, 'giúp') AS helps
FROM (SELECT template_id, text, regexp_extract(text, '(\\S+)\\{{closer\\}}$', 1) AS tail, regexp_extract(text, '^(?:\\{{opener\\}})?(\\S+)', 1) AS head,
 list_contains(list_transform(string_split(replace(text, '{{opener}}', ''), ' ')[1:5], lambda w: trim(w, ',.')), 'hỏi') AS asks FROM bank)""")
def head_tail_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16-F18."""
    t = F.col("text")
    return templates(spark).select("template_id", T.tail_class(t, QUESTION_WORDS, PARTICLES).alias("tail"), T.head_class(t, STATEMENTS).alias("head"), T.starts_with_ask(t).alias("asks"), t.contains("giúp").alias("helps"))


# Tables of templates come with bad ids and bad values too.
BAD_ROWS = [("search_neutral_short_001", "search", "neutral", "short", "entity", "ra {entity}"), ("", "search", "neutral", "short", "entity", "ra {entity}"), ("bad_enum_001", "greeting", "loud", "tiny", "entity", "ra {entity}")]
_ABBREVIATIONS_SQL = "(^|[^\\p{L}\\p{N}_])(TP|Q\\.|P\\.|H\\.|BV|TTTM|QL|TL)($|[^\\p{L}\\p{N}_])"
_RULES_SQL = {
    "has_id": "template_id = ''", "known_sentence_type": f"sentence_type NOT IN {_in(T.SENTENCE_TYPES)}", "known_register": f"register NOT IN {_in(T.REGISTERS)}",
    "known_length_class": f"length_class NOT IN {_in(T.LENGTH_CLASSES)}",
    "slots_match": "list_sort(list_distinct(string_split(slots, ','))) <> list_sort(list_distinct(regexp_extract_all(text, '\\{([a-zA-Z_]+)\\}', 1)))",
    "slots_allowed": "len(list_filter(string_split(slots, ','), lambda s: s NOT IN ('opener', 'entity', 'closer', 'category_noun'))) > 0",
    "has_entity": "NOT contains(text, '{entity}')", "no_digits": "regexp_matches(text, '[0-9]')", "no_abbreviation": f"regexp_matches(text, '{_ABBREVIATIONS_SQL}')",
    "no_proper_noun": "len(list_filter(list_transform(string_split(text, ' ')[2:], lambda w: trim(regexp_replace(w, '\\{[a-zA-Z_]+\\}', '', 'g'), ',.!?;:()')), lambda w: regexp_matches(w, '^\\p{Lu}') AND w <> 'An')) > 0",
    "spacing": "text <> trim(text) OR contains(text, '  ') OR regexp_matches(text, '\\s\\{(opener|closer)\\}|\\{(opener|closer)\\}\\s')",
    "no_common_noun": "regexp_matches(text, '\\{entity\\}\\s+nào($|[^\\p{L}])') OR regexp_matches(text, '(^|[^\\p{L}])(một|các|những|mấy|vài|cái)\\s+\\{entity\\}') OR regexp_matches(text, '\\{entity\\}[^{}]{0,20}?[^\\p{L}]gần(\\s+đây)?\\s+nhất')",
    "no_bare_classifier": "regexp_matches(text, '(^|[^\\p{L}])(đường|lối|hướng|phố)\\s+\\{entity\\}')",
}
_BAD_SQL = "bank2 AS (SELECT * FROM bank UNION ALL SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(f"'{x}'" for x in t) + ")" for t in BAD_ROWS) + ") t)"


@query("slot_validation_issues", f"WITH {TEMPLATES_SQL}, {_BAD_SQL} " + " UNION ALL ".join(f"SELECT template_id, '{rule}' AS rule FROM bank2 WHERE {test}" for rule, test in _RULES_SQL.items())
       + " UNION ALL SELECT template_id, 'unique_id' FROM bank2 WHERE template_id <> '' GROUP BY 1 HAVING count(*) > 1")
def slot_validation_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every broken rule of every template at once."""
    t = spark.createDataFrame([*TEMPLATES, *BAD_ROWS], TEMPLATE_COLUMNS).withColumn("slots", F.split("slots", ","))
    return T.table_issues(t, ["An"])


@query("entry_issues", with_views("ent") + """
SELECT 'alias' AS kind, row_id::VARCHAR AS entry, 'no_name' AS rule FROM province_alias WHERE trim(coalesce(alias, '')) = ''
UNION ALL SELECT 'alias', row_id::VARCHAR, 'unknown_type' FROM province_alias WHERE coalesce(alias_type, '') NOT IN ('legacy', 'spoken', 'abbrev_expanded')
UNION ALL SELECT 'alias', row_id::VARCHAR, 'unknown_prefix' FROM province_alias WHERE coalesce(admin_prefix, '?') NOT IN ('', 'tỉnh', 'thành phố')
UNION ALL SELECT 'alias', lower(alias), 'legacy_of_several' FROM province_alias WHERE alias_type = 'legacy' AND trim(province_id, ' ' || chr(9)) <> '' GROUP BY 2 HAVING count(DISTINCT trim(province_id, ' ' || chr(9))) > 1
UNION ALL SELECT 'landmark', entity_id, 'unknown_subcategory' FROM ent WHERE category = 'landmark' AND coalesce(subcategory, '') NOT IN """ + _in(SUBCATEGORIES["landmark"]) + """
UNION ALL SELECT 'landmark', entity_id, 'no_name' FROM ent WHERE category = 'landmark' AND trim(coalesce(entity, '')) = ''
UNION ALL SELECT 'ward', row_id::VARCHAR, 'no_parent' FROM wards WHERE trim(coalesce(district_id, ''), ' ' || chr(9)) = '' AND trim(coalesce(province_id, ''), ' ' || chr(9)) = ''""")
def entry_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, V2: every broken rule of alias, landmark and ward entries: names, types and prefixes, a legacy alias of several provinces,
    subcategories outside the taxonomy, wards without any parent."""
    a, w = table(spark, sf_dir, "province_alias"), table(spark, sf_dir, "wards")
    e = entities(spark, sf_dir, "category", "subcategory", "entity").filter("category = 'landmark'")

    def issues(df: DataFrame, kind: str, key, broken, rule: str) -> DataFrame:
        return df.filter(broken).select(F.lit(kind).alias("kind"), key.cast("string").alias("entry"), F.lit(rule).alias("rule"))

    key = R.key_text(F.col("province_id"))
    several = a.filter((F.col("alias_type") == "legacy") & key.isNotNull()).groupBy(F.lower("alias").alias("entry")).agg(F.countDistinct(key).alias("n"))
    none = R.key_text(F.coalesce("district_id", F.lit(""))).isNull() & R.key_text(F.coalesce("province_id", F.lit(""))).isNull()
    return R.union_all(
        issues(a, "alias", F.col("row_id"), F.trim(F.coalesce("alias", F.lit(""))) == "", "no_name"),
        issues(a, "alias", F.col("row_id"), ~F.coalesce("alias_type", F.lit("")).isin("legacy", "spoken", "abbrev_expanded"), "unknown_type"),
        issues(a, "alias", F.col("row_id"), ~F.coalesce("admin_prefix", F.lit("?")).isin("", "tỉnh", "thành phố"), "unknown_prefix"),
        issues(several, "alias", F.col("entry"), F.col("n") > 1, "legacy_of_several"),
        issues(e, "landmark", F.col("entity_id"), ~F.coalesce("subcategory", F.lit("")).isin(SUBCATEGORIES["landmark"]), "unknown_subcategory"),
        issues(e, "landmark", F.col("entity_id"), F.trim(F.coalesce("entity", F.lit(""))) == "", "no_name"),
        issues(w, "ward", F.col("row_id"), none, "no_parent"),
    )


@query("skeleton_length_stats", f"""WITH {TEMPLATES_SQL}, l AS (SELECT length_class, length(trim(regexp_replace(text, '\\{{[a-zA-Z_]+\\}}', '', 'g'))) AS n FROM bank)
SELECT length_class, min(n) AS shortest, floor(median(n))::BIGINT AS middle, max(n) AS longest, count(*) AS n FROM l GROUP BY 1""")
def skeleton_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11, F25."""
    t = templates(spark).select("length_class", T.skeleton_length(F.col("text")).alias("k"))
    return t.groupBy("length_class").agg(F.min("k").alias("shortest"), F.floor(F.median("k")).alias("middle"), F.max("k").alias("longest"), F.count("*").alias("n"))


@query("text_length_stats", "SELECT lang, min(n_chars) AS shortest, floor(median(n_chars))::BIGINT AS middle, max(n_chars) AS longest, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1")
def text_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 over documents."""
    d = table(spark, sf_dir, "documents").filter("text is not null")
    return d.groupBy("lang").agg(F.min("n_chars").alias("shortest"), F.floor(F.median("n_chars")).alias("middle"), F.max("n_chars").alias("longest"), F.count("*").alias("n"))


@query("slot_substitution", with_views("ent") + f""", {TEMPLATES_SQL}
SELECT entity_id, template_id, trim(regexp_replace(replace(replace(replace(replace(text, '{{opener}}', 'này '), '{{closer}}', ' nhé'), '{{entity}}', entity), '{{category_noun}}', 'chỗ'), '\\s+', ' ', 'g')) AS text
FROM ent JOIN bank ON bank.sentence_type = CASE ent.category WHEN 'street' THEN 'nav_command' WHEN 'landmark' THEN 'contextual' ELSE 'short_command' END AND template_id NOT LIKE 'bad%'""")
def slot_substitution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F15."""
    kind = F.when(F.col("category") == "street", "nav_command").when(F.col("category") == "landmark", "contextual").otherwise("short_command")
    e = entities(spark, sf_dir, "entity", "category").withColumn("sentence_type", kind)
    t = templates(spark).filter("template_id not like 'bad%'")
    text = T.substitute(F.col("text"), opener=F.lit("này"), closer=F.lit("nhé"), entity=F.col("entity"), category_noun=F.lit("chỗ"))
    return e.join(t, "sentence_type").select("entity_id", "template_id", text.alias("text"))


@query("template_filter", f"WITH {TEMPLATES_SQL} SELECT template_id FROM bank WHERE register = 'neutral' AND (contains(replace(strip_accents(lower(text)), 'đ', 'd'), 'tim') OR contains(template_id, 'tim'))")
def template_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P14."""
    hit = N.fold_search(F.col("text")).contains("tim") | N.fold_search(F.col("template_id")).contains("tim")
    return templates(spark).filter((F.col("register") == "neutral") & hit).select("template_id")


# Survey A24, V17: a rubric is a list of tokens and of phrases, judged per group.
RUBRIC_TOKENS, RUBRIC_PHRASES = ["giúp", "nhé", "ạ"], ["cho hỏi", "chỉ đường"]


@query("rubric_eval", with_views("samp") + f""",
w AS (SELECT id, coalesce(register, '') AS register, lower(text) AS t, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM samp WHERE text IS NOT NULL)
SELECT register, count(*) AS n, sum((list_has_any(w, ['giúp', 'nhé', 'ạ']))::INT)::BIGINT AS tokens, sum((contains(t, 'cho hỏi') OR contains(t, 'chỉ đường'))::INT)::BIGINT AS phrases,
 count(DISTINCT w[1]) AS heads FROM w GROUP BY 1""")
def rubric_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A24, U3, F26."""
    from quotaloom.functions.words import words

    s = samples(spark, sf_dir, "register", "text").filter("text is not null").select(F.coalesce("register", F.lit("")).alias("register"), F.lower("text").alias("t"), words(F.col("text")).alias("w"))
    phrase = F.lit(False)
    for p in RUBRIC_PHRASES:
        phrase = phrase | F.col("t").contains(p)
    return s.groupBy("register").agg(
        F.count("*").alias("n"), F.count_if(F.arrays_overlap("w", F.array(*[F.lit(t) for t in RUBRIC_TOKENS]))).alias("tokens"),
        F.count_if(phrase).alias("phrases"), F.countDistinct(F.get("w", F.lit(0))).alias("heads"),
    )


@query("top_heads", with_views("samp") + """,
w AS (SELECT coalesce(register, '') AS register, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')[1] AS head FROM samp WHERE text IS NOT NULL),
c AS (SELECT register, head, count(*) AS n FROM w WHERE head IS NOT NULL GROUP BY ALL)
SELECT register, head, n, round(n / sum(n) OVER (PARTITION BY register), 6) AS share, n / sum(n) OVER (PARTITION BY register) <= 0.08 AS pass
FROM c QUALIFY row_number() OVER (PARTITION BY register ORDER BY n DESC, head) = 1""")
def top_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent first word of each register, counts first."""
    from quotaloom.functions.words import words

    s = samples(spark, sf_dir, "register", "text").filter("text is not null").select(F.coalesce("register", F.lit("")).alias("register"), F.get(words(F.col("text")), F.lit(0)).alias("head")).filter("head is not null")
    c = s.groupBy("register", "head").agg(F.count("*").alias("n"))
    best = c.groupBy("register").agg(F.min(F.struct((-F.col("n")).alias("m"), "head")).alias("_b"), F.sum("n").alias("_t"))
    share = -F.col("_b.m") / F.col("_t")
    return best.select("register", "_b.head", (-F.col("_b.m")).alias("n"), F.round(share, 6).alias("share"), (share <= 0.08).alias("pass"))


# Survey P7-P9: the tags are an event's type and a hundredth of its number k; the first matching rule wins.
TAG_RULES = [
    Rule("type", "purchase", "commercial", "bank", require={"tens": "1"}), Rule("type", "purchase", "commercial", "hotel", exclude={"tens": "9"}), Rule("type", "view", "landmark", "lake", exclude={"tens": "5"}),
    Rule("type", "error", "public_facility", "hospital"), Rule("tens", "5", "poi_other", "park", exclude={"type": "click"}),
]
HIGHWAYS = {"1": "street", "2": "street", "3": "highway", "7": "alley"}
_TAGS_SQL = "t AS (SELECT event_id, event_type AS type, (json_extract_string(props, '$.k')::INT // 10)::VARCHAR AS tens FROM events)"


def _rule_sql(r: Rule) -> str:
    tests = [f"{r.key} = '{r.value}'", *(f"{k} = '{v}'" for k, v in r.require.items()), *(f"coalesce({k} <> '{v}', true)" for k, v in r.exclude.items())]
    return " AND ".join(tests)


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.from_json("props", "map<string,int>")["k"]
    return table(spark, sf_dir, "events").select("event_id", F.create_map(F.lit("type"), F.col("event_type"), F.lit("tens"), F.floor(k / 10).cast("string")).alias("tags"))


@query("tag_rules_first_match", f"WITH {_TAGS_SQL} SELECT * FROM (SELECT event_id, CASE " + " ".join(f"WHEN {_rule_sql(r)} THEN '{r.category}'" for r in TAG_RULES) + " END AS category, CASE "
       + " ".join(f"WHEN {_rule_sql(r)} THEN '{r.subcategory}'" for r in TAG_RULES) + " END AS subcategory FROM t) WHERE category IS NOT NULL")
def tag_rules_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules with required and excluded tags compile to one CASE, evaluated in the scan's stage."""
    t = _tagged(spark, sf_dir).select("event_id", classify(F.col("tags"), TAG_RULES).alias("c")).filter("c is not null")
    return t.select("event_id", "c.category", "c.subcategory")


@query("highway_classes", f"WITH {_TAGS_SQL} SELECT event_id, CASE tens " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in HIGHWAYS.items()) + " END AS street_type FROM t WHERE tens IN " + _in(list(HIGHWAYS)))
def highway_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map from one tag to the type of a street."""
    return _tagged(spark, sf_dir).select("event_id", mapped(F.col("tags"), "tens", HIGHWAYS).alias("street_type")).filter("street_type is not null")


_R = rubric
_TOKENS_SQL = "list_filter(string_split(regexp_replace(regexp_replace(text, '\\{[a-zA-Z_]+\\}|,', ' ', 'g'), '\\s+', ' ', 'g'), ' '), lambda t: t <> '')"


def _says_sql(words: list[str], phrases: list[str]) -> str:
    return "(" + " OR ".join([*([f"list_has_any(w, [{', '.join(repr(x) for x in words)}])"] if words else []), *(f"contains(text, '{p}')" for p in phrases)]) + ")"


@query("rubric_report", with_views("samp") + f""", w AS (SELECT coalesce(register, '') AS register, text, {_TOKENS_SQL} AS w FROM samp WHERE text IS NOT NULL),
f AS (SELECT register, w[1] AS head, {_says_sql(_R.HONORIFIC_WORDS, _R.HONORIFIC_PHRASES)} AS honorific, {_says_sql([], _R.THIRD_PARTY_PHRASES)} AS third_party, {_says_sql(_R.SLANG_WORDS, [])} AS slang, {_says_sql([], _R.DEVICE_PHRASES)} AS device FROM w),
g AS (SELECT register, max(device::INT) AS d FROM f GROUP BY 1), h AS (SELECT max(n) AS n FROM (SELECT head, count(*) AS n FROM f WHERE head IS NOT NULL GROUP BY 1)),
r AS (SELECT 'A1' AS rule, sum(honorific::INT) AS hits, count(*) AS total, sum(honorific::INT) = 0 AS ok FROM f UNION ALL SELECT 'A2', sum(third_party::INT), count(*), sum(third_party::INT) = 0 FROM f UNION ALL SELECT 'A4', sum(slang::INT), count(*), sum(slang::INT) = 0 FROM f
 UNION ALL SELECT 'A6', sum(d), count(*), sum(d) = count(*) FROM g UNION ALL SELECT 'A7', coalesce(sum(honorific::INT), 0), count(*), coalesce(sum(honorific::INT), 0) = 0 FROM f WHERE register = 'formal'
 UNION ALL SELECT 'C2', (SELECT n FROM h), count(*), (SELECT n FROM h) / count(*) <= {_R.TOP_HEAD_SHARE} FROM f)
SELECT rule, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS verdict, hits::BIGINT AS hits, total::BIGINT AS total FROM r""")
def rubric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six rules of the rubric over all texts."""
    s = samples(spark, sf_dir, "register", "text").filter("text is not null").select(F.coalesce("register", F.lit("")).alias("register"), "text")
    return rubric.report(s)


@query("ingest_filter_pushdown", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events WHERE event_type IN ('view', 'click') AND value > 10 GROUP BY 1")
def ingest_filter_pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter reaches the Parquet scan."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click") & (F.col("value") > 10))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("province_name_tokens", with_views("prov") + "SELECT province_id, len(string_split(name_current, ' ')) AS tokens, array_to_string(string_split(name_current, ' ')[1:1], '') AS head FROM prov")
def province_name_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F26."""
    t = F.split("name_current", " ")
    return provinces(spark, sf_dir).select("province_id", F.size(t).alias("tokens"), F.get(t, F.lit(0)).alias("head"))
