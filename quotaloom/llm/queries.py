"""The queries pN_... of the training-data problems and their SQL; problem 5 is among the core's queries."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotaloom.llm import bpe, format_ledger, leaks, near_dup, scripts, splitting, target_sample, term_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Problem 2: duplicates hidden by formatting

_FIELDS_SQL = """
WITH r AS (SELECT DISTINCT id, text FROM generate_small WHERE id IS NOT NULL AND text IS NOT NULL),
f AS (SELECT id, list_filter(list_transform(regexp_split_to_array(text, '[,;|]'),
        lambda x: array_to_string(regexp_extract_all(lower(x), '[\\p{L}\\p{N}]+'), ' ')), lambda x: x <> '') AS fields FROM r),
k AS (SELECT id, array_to_string(list_sort(fields), '|') AS key FROM f WHERE len(fields) > 0)
"""


def _ledger(spark: SparkSession, sf_dir: str) -> format_ledger.Ledger:
    df = _table(spark, sf_dir, "generate_small")
    quarter = F.concat_ws("-", F.year("loaded_at"), F.quarter("loaded_at"))
    return format_ledger.build_ledger(df, id_col="id", text_col="text", at="loaded_at", batches=quarter)


@_query("p2_found", _FIELDS_SQL + """
SELECT keep_id, id AS copy_id FROM (SELECT id, min(id) OVER (PARTITION BY key) AS keep_id FROM k) WHERE id <> keep_id""")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_ledger.copies(_ledger(spark, sf_dir))


@_query("p2_groups", _FIELDS_SQL + """
SELECT min(k.id) AS keep_id, count(*) AS copies, arg_min(k.id, strftime(t.seen, '%Y-%m-%d %H:%M:%S.%f') || k.id) AS first_id
FROM k JOIN (SELECT id, min(loaded_at) AS seen FROM generate_small GROUP BY id) t USING (id) GROUP BY key""")
def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger(spark, sf_dir).counts().select("keep_id", "copies", "first_id")


# Problem 3: term frequencies

_TERMS_SQL = """
WITH r AS (SELECT DISTINCT id, template_id, entity_id, variation FROM generate_small WHERE id IS NOT NULL),
n AS (SELECT count(DISTINCT id) AS n FROM r),
t AS (SELECT 'template_id' AS field, template_id AS value, id FROM r UNION ALL SELECT 'entity_id', entity_id, id FROM r
      UNION ALL SELECT 'variation', unnest(string_split(variation, '+')), id FROM r),
c AS (SELECT field, value, count(*) AS occurrences, count(DISTINCT id) AS records FROM t WHERE value <> '' GROUP BY 1, 2),
m AS (SELECT c.*, CASE WHEN records < 3 THEN 'rare'
  WHEN records > n * CASE field WHEN 'template_id' THEN 0.02 WHEN 'entity_id' THEN 0.005 ELSE 0.2 END THEN 'common' END AS mark FROM c, n)
"""


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_counts.marked_terms(
        _table(spark, sf_dir, "generate_small"), record="id", order="loaded_at", values=["template_id", "entity_id"], multi={"variation": "+"},
        rare_below=3, common_above={"template_id": 0.02, "entity_id": 0.005, "variation": 0.2},
    )


@_query("p3_found", _TERMS_SQL + "SELECT field, value, mark FROM m WHERE mark IS NOT NULL")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked(spark, sf_dir).filter(F.col("mark").isNotNull()).select("field", "value", "mark")


@_query("p3_counts", _TERMS_SQL + "SELECT field, value, occurrences, records, coalesce(mark, '') AS mark FROM m")
def p3_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked(spark, sf_dir).select("field", "value", "occurrences", "records", F.coalesce("mark", F.lit("")).alias("mark"))


# Problem 6: sampling to target proportions

_CELLS_SQL = """
WITH c AS (SELECT province_id, category, sentence_type, sum(target_count)::BIGINT AS target
  FROM (SELECT DISTINCT * FROM plan_small) GROUP BY ALL HAVING sum(target_count) IS NOT NULL),
p AS (SELECT DISTINCT province_id, name_current FROM provinces),
r AS (SELECT DISTINCT id, province, category, sentence_type FROM generate_small WHERE id IS NOT NULL),
o AS (SELECT province, category, sentence_type, count(*) AS observed FROM r GROUP BY ALL),
x AS (SELECT c.*, coalesce(o.observed, 0) AS observed FROM c LEFT JOIN p USING (province_id)
  LEFT JOIN o ON o.province = p.name_current AND o.category = c.category AND o.sentence_type = c.sentence_type)
"""
_MINIMUM = 2


def _drawn(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    plan = _table(spark, sf_dir, "plan_small")
    names = _table(spark, sf_dir, "provinces").groupBy("province_id").agg(F.min("name_current").alias("province"))
    cells = target_sample.cell_targets(plan, ["province_id", "category", "sentence_type"], "target_count").join(names, "province_id", "left")
    records = _table(spark, sf_dir, "generate_small")
    return target_sample.draw_to_targets(records, cells, record="id", keys=["province", "category", "sentence_type"], minimum=_MINIMUM, seed=42)


@_query("p6_found", _CELLS_SQL + "SELECT province_id, category, sentence_type FROM x WHERE target > observed")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drawn(spark, sf_dir)[1].filter(F.col("deficit") > 0).select("province_id", "category", "sentence_type")


@_query("p6_report", _CELLS_SQL + f"""
SELECT province_id, category, sentence_type, target, observed, least(observed, CASE WHEN target > 0 THEN greatest(target, {_MINIMUM}) ELSE 0 END) AS drawn,
  greatest(target - observed, 0) AS deficit FROM x""")
def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drawn(spark, sf_dir)[1].select("province_id", "category", "sentence_type", "target", "observed", "drawn", "deficit")


@_query("p6_sample")
def p6_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drawn(spark, sf_dir)[0]


# Problems 7 and 9: encoding, splitting

RANK_FILE = os.environ.get("QUOTALOOM_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")


@_query("p7_ids")
def p7_ids(spark: SparkSession, sf_dir: str, rank_path: str = RANK_FILE) -> DataFrame:
    return bpe.encode_corpus(_table(spark, sf_dir, "documents"), id_col="doc_id", text_col="text", rank_path=rank_path)


@_query("p9_pieces")
def p9_pieces(spark: SparkSession, sf_dir: str, rank_path: str = RANK_FILE) -> DataFrame:
    return splitting.split_corpus(_table(spark, sf_dir, "documents"), id_col="doc_id", text_col="text", rank_path=rank_path, limit=512, overlap=64)


@_query("p9_promises", """SELECT doc_id, n_chars AS covered, md5(text) AS digest, true AS fits, true AS overlaps, true AS natural FROM documents WHERE text <> ''""")
def p9_promises(spark: SparkSession, sf_dir: str, rank_path: str = RANK_FILE) -> DataFrame:
    """What holds of the pieces of every document: they cover it, give it back, fit, overlap and end where they say."""
    return splitting.promises(p9_pieces(spark, sf_dir, rank_path), id_col="doc_id", limit=512, overlap=64)


# Problem 8: evaluation passages in training text

_LEAKS_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
e AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM eval_items),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS i FROM d WHERE len(w) > 11)),
h AS (SELECT DISTINCT item_id, array_to_string(w[i:i+11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS i FROM e WHERE len(w) > 11))
SELECT DISTINCT doc_id, item_id FROM g JOIN h USING (g)"""


def _leaks(spark: SparkSession, sf_dir: str, near: float | None = None) -> DataFrame:
    return leaks.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items"), run=12, near=near)


@_query("p8_found", _LEAKS_SQL)
def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).filter(F.col("run") >= 12).select("doc_id", "item_id").distinct()


@_query("p8_matches")
def p8_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir, near=0.8).withColumn("kind", F.when(F.col("run") >= 12, "phrase").otherwise("proximity"))


@_query("p8_items", f"SELECT item_id, count(*) AS documents FROM ({_LEAKS_SQL}) GROUP BY item_id")
def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _leaks(spark, sf_dir).filter(F.col("run") >= 12).select("doc_id", "item_id").distinct()
    return found.groupBy("item_id").agg(F.count("*").alias("documents"))


# Problem 4: look-alike characters

_V = "aàảãáạăằẳẵắặâầẩẫấậbcdđeèẻẽéẹêềểễếệfghiìỉĩíịjklmnoòỏõóọôồổỗốộơờởỡớợpqrstuùủũúụưừửữứựvwxyỳỷỹýỵz"
_V += _V.upper()
_EAST = "\\p{Han}\\p{Hiragana}\\p{Katakana}\\p{Hangul}"
_FOLD_SQL = f"""
WITH v AS (SELECT DISTINCT 'generate_small' AS table_name, id AS row_key, 'entity' AS field, entity AS value FROM generate_small
  UNION SELECT DISTINCT 'generate_small', id, 'street', street FROM generate_small
  UNION SELECT 'province_alias', row_id::VARCHAR, 'alias', alias FROM province_alias),
c AS (SELECT *, regexp_replace(nfc_normalize(value), '[\\p{{Cf}}\\x{{34F}}\\x{{180B}}-\\x{{180F}}\\x{{FE00}}-\\x{{FE0F}}]', '', 'g') AS plain FROM v WHERE value IS NOT NULL)
SELECT DISTINCT table_name, row_key, field FROM c
WHERE value <> nfc_normalize(value) OR plain <> nfc_normalize(value)
  OR regexp_matches(replace(value, ' ', ''), '[\\p{{Z}}\\s\\x{{85}}]')
  OR regexp_matches(value, '[\\x{{FF10}}-\\x{{FF19}}\\x{{FF21}}-\\x{{FF3A}}\\x{{FF41}}-\\x{{FF5A}}]')
  OR regexp_matches(regexp_replace(value, '([{_EAST}])[\\x{{FF01}}-\\x{{FF0F}}\\x{{FF1A}}-\\x{{FF20}}]', '\\1', 'g'), '[\\x{{FF01}}-\\x{{FF0F}}\\x{{FF1A}}-\\x{{FF20}}]')
  OR regexp_matches(plain, '[{_V}][\\p{{L}}\\p{{M}}\\p{{N}}]*' || '[^{_V}\\P{{L}}]') OR regexp_matches(plain, '[^{_V}\\P{{L}}][\\p{{L}}\\p{{M}}\\p{{N}}]*[{_V}]')"""


def _folded(spark: SparkSession, sf_dir: str, by_column: bool = False) -> DataFrame:
    out = []
    for name, key, fields in (("generate_small", "id", ["entity", "street"]), ("province_alias", "row_id", ["alias"])):
        df = _table(spark, sf_dir, name)
        out.append(scripts.folded(df, key=key, fields=fields, table_name=name, dominant=scripts.dominant_scripts(df, fields) if by_column else None))
    return out[0].unionByName(out[1])


@_query("p4_found", _FOLD_SQL)
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir).filter("is_case").select("table_name", "row_key", "field").distinct()


@_query("p4_folded")
def p4_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All values that aren't plain in their consistent form; whole-script look-alikes by the dominant script of their column."""
    return _folded(spark, sf_dir, by_column=True)


# Problem 1: near-duplicate records

_NEAR_SQL = """
WITH r AS (SELECT DISTINCT id, template_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM generate_small
  WHERE id IS NOT NULL AND template_id IS NOT NULL AND text IS NOT NULL),
g AS (SELECT DISTINCT id, template_id, w[i] || ' ' || w[i + 1] AS g FROM (SELECT *, unnest(range(1, len(w))) AS i FROM r)),
n AS (SELECT id, template_id, count(*) AS n FROM g GROUP BY ALL),
c AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS c FROM g a JOIN g b ON a.template_id = b.template_id AND a.g = b.g AND a.id < b.id GROUP BY ALL),
p AS (SELECT id_a, id_b FROM c JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b WHERE 10 * c >= 7 * (x.n + y.n - c))
"""


def _near(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return near_dup.near_duplicates(_table(spark, sf_dir, "generate_small"), id_col="id", text_col="text", part_col="template_id", width=2, threshold=(7, 10))


@_query("p1_found", _NEAR_SQL + "SELECT id_a, id_b FROM p")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.record_pairs(*_near(spark, sf_dir))


@_query("p1_groups", "WITH RECURSIVE " + _NEAR_SQL.strip()[5:] + """,
e AS (SELECT id_a AS a, id_b AS b FROM p UNION ALL SELECT id_b, id_a FROM p),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a)
SELECT id, coalesce(least(id, (SELECT min(b) FROM reach WHERE a = id)), id) AS class_id, (SELECT count(*) FROM e WHERE a = id) AS links FROM (SELECT DISTINCT id FROM n)""")
def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.components(*_near(spark, sf_dir))


@_query("p1_keep_n")
def p1_keep_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most three records of each cluster of near-duplicates, over all records whatever their template."""
    return near_dup.keep_per_cluster(_table(spark, sf_dir, "generate_small"), id_col="id", text_col="text", width=2, threshold=(7, 10), n=3)


@_query("p1_documents")
def p1_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents: five words, similarity 0.8, over all documents as one partition."""
    docs = _table(spark, sf_dir, "documents").withColumn("everything", F.lit("all"))
    return near_dup.components(*near_dup.near_duplicates(docs, id_col="doc_id", text_col="text", part_col="everything", width=5, threshold=(4, 5)))
