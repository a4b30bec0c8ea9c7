"""Readers and writers of tables, snapshots, plans and samples (survey S1-S10, K1-K5, K7).

Files are read with declared schemas and fail on bad rows. Writers go to a staging folder first and are moved into place when
all parts are written. Only configuration, manifests and directory listings are handled on the driver.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotaloom import schemas


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV table with a header; a missing file is an empty table, columns that the file lacks are null."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None).cast("string")).alias(f.name) for f in schema])


def typed(df: DataFrame, table: str) -> DataFrame:
    """S3: empty strings to null, then the table's types; booleans are the words True and False."""
    out = []
    for f in schemas.MASTER[table]:
        c = F.coalesce(f.name, F.lit("")) if f.name in schemas.KEEP_EMPTY else F.nullif(F.col(f.name), F.lit(""))
        c = F.when(c.isNotNull(), c == "True") if isinstance(f.dataType, T.BooleanType) else c.cast(f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)


def read_master(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """S3."""
    return {t: typed(read_table(spark, f"{folder}/{t}.csv", s), t) for t, s in schemas.MASTER_FILES.items()}


def read_elements(spark: SparkSession, pattern: str) -> DataFrame:
    """Elements of all snapshots: (province_id, bbox, ref, type, id, lat, lon, tags)."""
    docs = spark.read.schema(schemas.SNAPSHOT).option("multiLine", True).option("mode", "FAILFAST").json(pattern)
    e = docs.select("province_id", "bbox", F.explode("elements").alias("e"))
    lat, lon = F.coalesce("e.lat", "e.center.lat"), F.coalesce("e.lon", "e.center.lon")
    return e.select("province_id", "bbox", F.concat_ws("_", "e.type", F.col("e.id").cast("string")).alias("ref"), "e.type", "e.id", lat.alias("lat"), lon.alias("lon"), "e.tags")


def read_config(path: str, version: int | None = None) -> dict | list:
    """A YAML file on the driver; ``version`` gates its schema_version."""
    doc = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if version is not None and doc.get("schema_version") != version:
        raise ValueError(f"{path}: schema_version {doc.get('schema_version')!r}, expected {version}")
    return doc


def axis_weights(spark: SparkSession, axes: dict[str, dict]) -> DataFrame:
    """(axis, level, key, value, weight), normalised within each level's key."""
    rows = []
    for axis, spec in axes.items():
        groups = [("default", "", spec["weights"])] + [(level, k, w) for level in ("register", "category") for k, w in (spec.get(f"by_{level}") or {}).items()]
        for level, key, w in groups:
            total = float(sum(w.values()))
            if total <= 0 or min(w.values()) < 0:
                raise ValueError(f"weights of {axis}/{level}/{key} must not be negative and must have a positive sum")
            rows += [(axis, level, key, value, x / total) for value, x in w.items()]
    return spark.createDataFrame(rows, "axis string, level string, key string, value string, weight double")


def templates(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """The rows of a template file."""
    rows = [(e.get("template_id"), e.get("sentence_type"), e.get("register"), e.get("length_class"), list(e.get("slots") or []), e.get("text")) for e in entries]
    return spark.createDataFrame(rows, "template_id string, sentence_type string, register string, length_class string, slots array<string>, text string")


def lexicon_words(spark: SparkSession, lexicon: dict) -> DataFrame:
    """(slot, register, text, heads) of openers, closers and fillers; empty words are dropped, heads must not be empty."""
    rows = []
    for slot, content in lexicon.items():
        for register, words in (content.items() if isinstance(content, dict) else [("", content)]):
            for w in words:
                text, heads = (w["text"], w["heads"]) if isinstance(w, dict) else (w, None)
                if heads is not None and not heads:
                    raise ValueError(f"{slot}: {text!r} needs heads")
                if text:
                    rows.append((slot, register, text, heads))
    return spark.createDataFrame(rows, "slot string, register string, text string, heads array<string>")


def landmarks(spark: SparkSession, doc: dict[str, list[dict]]) -> DataFrame:
    """(province_id, name, subcategory, fame_tier, hint) of a file of landmarks by province; ``entry_issues`` tells bad entries."""
    rows = [(p, e.get("name"), e.get("subcategory"), e.get("fame_tier"), e.get("legacy_alias_hint")) for p, entries in doc.items() for e in entries or []]
    return spark.createDataFrame(rows, "province_id string, name string, subcategory string, fame_tier int, hint string")


def province_aliases(spark: SparkSession, doc: list[dict]) -> DataFrame:
    """(province_id, alias_type, alias, admin_prefix, weight) of a file of provinces, one row per alias of its three lists."""
    kinds = {"legacy_names": "legacy", "spoken_aliases": "spoken", "abbreviations": "abbrev_expanded"}
    rows = [(p["province_id"], kind, a.get("name"), a.get("admin_prefix"), 1.0) for p in doc for key, kind in kinds.items() for a in p.get(key) or []]
    return spark.createDataFrame(rows, "province_id string, alias_type string, alias string, admin_prefix string, weight double")


def ward_union(curated: DataFrame, extracted: DataFrame) -> DataFrame:
    """Wards of both sources; columns that one lacks are null."""
    return curated.unionByName(extracted, allowMissingColumns=True)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """The cells of a plan document."""
    docs = spark.read.schema(schemas.PLAN).option("multiLine", True).option("mode", "FAILFAST").json(path)
    checked = docs.withColumn("cells", F.when(F.col("schema_version") == schemas.PLAN_VERSION, F.col("cells")).otherwise(F.raise_error(F.lit("unknown plan version"))))
    return checked.select(F.explode("cells").alias("c")).select("c.*")


def write_plan(cells: DataFrame, path: str, run_id: str, seed: int, max_cells: int = 1_000_000) -> None:
    """K2: one JSON document, so one task's work; a plan is a product of small axes, which is checked."""
    if cells.limit(max_cells + 1).count() > max_cells:
        raise ValueError("more cells than one plan document holds")
    doc = cells.agg(F.sum("target_count").cast("long").alias("total"), F.array_sort(F.collect_list(F.struct("province_id", "category", "sentence_type", "variation_profile", "target_count"))).alias("cells"))
    doc = doc.select(F.lit(schemas.PLAN_VERSION).alias("schema_version"), F.lit(run_id).alias("run_id"), "total", F.lit(seed).cast("long").alias("global_seed"), "cells")
    _replace({path: doc.coalesce(1).write.mode("overwrite").json}, cells.sparkSession)


def write_master(tables: dict[str, DataFrame], folder: str) -> None:
    """K1, K5: all tables or none; each sorted by its key, columns in order, nulls empty."""
    jobs = {}
    for t, df in tables.items():
        cols = [F.coalesce(F.initcap(F.col(f.name).cast("string")) if isinstance(schemas.MASTER[t][f.name].dataType, T.BooleanType) else F.col(f.name).cast("string"), F.lit("")).alias(f.name) for f in schemas.MASTER_FILES[t]]
        jobs[f"{folder}/{t}.csv"] = df.select(*cols).orderBy(*schemas.SORT_KEYS[t]).coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv
    _replace(jobs, next(iter(tables.values())).sparkSession)


def _replace(jobs: dict, spark: SparkSession) -> None:
    """Write every target beside its place, then move all in."""
    stage = {path: f"{path}.{uuid.uuid4().hex[:8]}.tmp" for path in jobs}
    for path, write in jobs.items():
        write(stage[path])
    for path, tmp in stage.items():
        fs, p = _fs(spark, path)
        fs.delete(p, True)
        fs.rename(_fs(spark, tmp)[1], p)


def write_samples(df: DataFrame, path: str) -> None:
    """K3: sample files in the fixed column order, as many files as partitions; all columns must be there."""
    if missing := [f.name for f in schemas.SAMPLES if f.name not in df.columns]:
        raise ValueError(f"samples lack the columns {missing}")
    cols = [F.coalesce(F.col(f.name).cast("string"), F.lit("")).alias(f.name) for f in schemas.SAMPLES]
    _replace({path: df.select(*cols).write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv}, df.sparkSession)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """All strings."""
    return read_table(spark, path, schemas.SAMPLES)


def find_samples(spark: SparkSession, folder: str, names: tuple[str, ...] = ("final", "clean", "candidates", "prototype")) -> str | None:
    """In the newest run folder that has samples, the file that comes first in ``names``; on any Hadoop file system."""
    fs, path = _fs(spark, folder)
    runs = [f for f in fs.listStatus(path) if f.isDirectory()]
    for run in sorted(runs, key=lambda f: (f.getModificationTime(), f.getPath().getName()), reverse=True):
        for n in names:
            if exists(spark, f := f"{folder}/{run.getPath().getName()}/{n}.csv"):
                return f
    return None


def manifest(samples: DataFrame, seed: int, inputs: list[str], configs: list[str] = (), code_version: str = "", at: str = "", max_cells: int = 1_000_000) -> dict:
    """K4: seed, digests of inputs and configuration, code version, time, rows per cell; the number of cells is checked."""
    rows = samples.groupBy("seed_cell").count().orderBy("seed_cell").limit(max_cells + 1).collect()
    if len(rows) > max_cells:
        raise ValueError("more cells than a manifest holds")
    counts = {r[0]: r[1] for r in rows}
    return {"seed": seed, "inputs": content_digest(inputs), "configs": content_digest(configs), "code_version": code_version, "at": at, "cells": counts, "total": sum(counts.values())}


def content_digest(paths: list[str]) -> str:
    """K7: the same for any order of the files."""
    h = hashlib.sha256()
    for p in sorted(paths, key=lambda x: Path(x).name):
        h.update(Path(p).name.encode() + b"\0" + hashlib.sha256(Path(p).read_bytes()).digest())
    return h.hexdigest()


def write_json(doc: dict, path: str) -> None:
    """Small driver-side documents, moved into place."""
    tmp = Path(f"{path}.tmp")
    tmp.write_text(json.dumps(doc, ensure_ascii=False, sort_keys=True, indent=1), encoding="utf-8")
    tmp.replace(path)
