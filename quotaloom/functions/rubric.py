"""A rubric over texts: word and phrase lists, and rules judged over all of them (survey A24, V17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the rubric.
HONORIFIC_WORDS = ["xin", "vui", "lòng", "thưa", "kính", "mong", "nhờ", "ơn", "cảm", "ạ"]
HONORIFIC_PHRASES = ["vui lòng", "làm ơn", "xin phép", "cảm ơn", "mong được"]
THIRD_PARTY_PHRASES = ["có ai biết", "ai biết", "hỏi thăm", "có biết"]
SLANG_WORDS = ["hông", "vô", "giùm", "lẹ", "quẹo", "tấp", "cua", "lượn", "ngó", "coi", "nè", "á", "phóng", "vọt", "mò", "lục", "táp"]
DEVICE_PHRASES = ["mở chỉ đường", "bật chỉ đường", "đặt điểm đến", "đổi điểm đến", "thêm điểm dừng", "hủy dẫn đường", "huỷ dẫn đường", "định vị", "mở bản đồ"]
TOP_HEAD_SHARE = 0.08


def _says(tokens: Column, text: Column, words: list[str], phrases: list[str]) -> Column:
    hit = F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in words])) if words else F.lit(False)
    for p in phrases:
        hit = hit | text.contains(p)
    return hit


def report(texts: DataFrame) -> DataFrame:
    """(rule, verdict, hits, total) of texts (text, register): one pass with partial counts for the lists, one for the first words."""
    text = F.col("text")
    tokens = F.filter(F.split(F.regexp_replace(text, r"\{[a-zA-Z_]+\}|,", " "), r"\s+"), lambda t: t != "")
    x = texts.select(
        "register", F.get(tokens, F.lit(0)).alias("head"), _says(tokens, text, HONORIFIC_WORDS, HONORIFIC_PHRASES).alias("honorific"), _says(tokens, text, [], THIRD_PARTY_PHRASES).alias("third_party"),
        _says(tokens, text, SLANG_WORDS, []).alias("slang"), _says(tokens, text, [], DEVICE_PHRASES).alias("device"),
    )
    counts = x.groupBy("register").agg(F.count("*").alias("n"), *[F.count_if(c).alias(c) for c in ("honorific", "third_party", "slang", "device")])
    formal = F.col("register") == "formal"
    total = F.sum("n")

    def rule(name: str, hits: Column, of: Column, ok: Column) -> Column:
        return F.struct(F.lit(name).alias("rule"), F.when(ok, "PASS").otherwise("FAIL").alias("verdict"), F.coalesce(hits, F.lit(0)).cast("long").alias("hits"), F.coalesce(of, F.lit(0)).cast("long").alias("total"))

    none = [rule(name, F.sum(c), total, F.coalesce(F.sum(c), F.lit(0)) == 0) for name, c in (("A1", "honorific"), ("A2", "third_party"), ("A4", "slang"))]
    with_device, registers = F.count_if(F.col("device") > 0), F.count("*")
    own = F.sum(F.when(formal, F.col("honorific")))
    rules = F.array(*none, rule("A6", with_device, registers, with_device == registers), rule("A7", own, F.sum(F.when(formal, F.col("n"))), F.coalesce(own, F.lit(0)) == 0))
    lists = counts.agg(rules.alias("r")).select(F.explode("r").alias("r")).select("r.*")
    heads = x.groupBy("head").agg(F.count("*").alias("k"))
    top = heads.agg(F.max(F.when(F.col("head").isNotNull(), F.col("k"))).alias("hits"), F.sum("k").alias("total"))
    share = F.coalesce(F.col("hits") / F.col("total"), F.lit(0.0)) <= TOP_HEAD_SHARE
    return lists.unionByName(top.select(rule("C2", F.col("hits"), F.col("total"), share).alias("r")).select("r.*"))
