"""Operators on small inline tables."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotaloom.operators import quality, quota, relational, spatial
from quotaloom.operators.references import orphan_references
from quotaloom.sources import files
from quotaloom.streaming import windows


def day(n):
    return None if n is None else dt.datetime(2025, 1, 1) + dt.timedelta(days=n)


REFS = "row_id long, ref string, loaded_at timestamp_ntz, key string, _k string, reason string"
PARENTS = "pid string, loaded_at timestamp_ntz, deleted_at timestamp_ntz, _d string"


def reasons(spark, refs, parents, **how):
    r = spark.createDataFrame([(i, k, day(t), "x", "y", "z") for i, (k, t) in enumerate(refs)], REFS)
    p = spark.createDataFrame([(k, day(a), day(d), "w") for k, a, d in parents], PARENTS)
    got = orphan_references(r, p, ref_key="ref", parent_key="pid", **how)
    return {x.row_id: x.reason for x in got.collect()}


def test_orphans(spark):
    refs = [("a", 5), (" A\t", 5), ("b", 5), ("c", 5), ("d", 5), (None, 5), ("  ", 5), ("a", 1), ("e", 5), ("a", 5), ("b", 2), ("a", None)]
    parents = [("a", 2, None), ("b", 1, 3), ("c", 9, None), ("e", 1, 2), ("e", 4, None), (None, 1, None), ("E ", 8, 9)]
    want = {2: "deleted", 3: "late", 4: "missing", 7: "late"}
    assert reasons(spark, refs, parents) == want
    assert reasons(spark, refs, parents, slice_rows=2) == want  # hot keys in slices


def test_orphans_at_equal_times_and_edges(spark):
    assert reasons(spark, [("a", 3)], [("a", 3, None)]) == {}
    assert reasons(spark, [("a", 3)], [("a", 1, 3)]) == {0: "deleted"}
    assert reasons(spark, [("a", 3)], []) == {0: "missing"}
    assert reasons(spark, [], [("a", 1, None)]) == {}
    assert reasons(spark, [("a", 3)] * 50, [("a", 9, None)] * 3, slice_rows=5) == {i: "late" for i in range(50)}


def test_orphans_by_brute_force(spark):
    rng = np.random.default_rng(1)
    refs = [(f"k{rng.integers(12)}", int(rng.integers(30))) for _ in range(400)]
    parents = [(f"k{rng.integers(9)}", int(a := rng.integers(30)), int(a + rng.integers(1, 9)) if rng.random() < 0.6 else None) for _ in range(40)]
    want = {}
    for i, (k, t) in enumerate(refs):
        mine = [(a, d) for p, a, d in parents if p == k]
        if not any(a <= t and (d is None or d > t) for a, d in mine):
            want[i] = "missing" if not mine else "late" if min(a for a, _ in mine) > t else "deleted"
    assert reasons(spark, refs, parents) == want
    assert reasons(spark, refs, parents, slice_rows=7) == want


def test_water_fill():
    got = quota.water_fill({"a": 70, "b": 20, "c": 10}, 0.0, 0.5)
    assert got == pytest.approx({"a": 0.5, "b": 1 / 3, "c": 1 / 6})
    got = quota.water_fill({"x": 60, "y": 39, "z": 1}, 0.07, 0.9)
    assert got == pytest.approx({"x": 0.93 * 60 / 99, "y": 0.93 * 39 / 99, "z": 0.07})
    assert quota.water_fill({"k": 0, "l": 0, "m": 0, "n": 0}, 0.0, 1.0) == dict.fromkeys("klmn", 0.25)
    for weights, low, high in (({"a": 3, "b": 2, "c": 2, "d": 1}, 0.3, 1.0), ({"a": 3, "b": 2, "c": 1}, 0.0, 0.3), ({}, 0, 1)):
        with pytest.raises(ValueError):
            quota.water_fill(weights, low, high)


def test_fit_meets_both_margins():
    m = quota.fit(np.outer([0.2, 0.8], [0.5, 0.5]), np.array([0.3, 0.7]), np.array([0.6, 0.4]))
    assert m.sum(1) == pytest.approx([0.3, 0.7]) and m.sum(0) == pytest.approx([0.6, 0.4])


@pytest.mark.parametrize("total", [0, 1, 7, 1000])
def test_largest_remainder_is_exact(spark, total):
    df = spark.createDataFrame([("a", 1 / 3), ("b", 1 / 3), ("c", 1 / 3)], "k string, s double")
    got = {r.k: r.target for r in quota.largest_remainder(df, "s", F.lit(total), ["k"]).collect()}
    assert sum(got.values()) == total and got["a"] >= got["b"] >= got["c"] >= got["a"] - 1


def test_first_per_group_and_latest(spark):
    df = spark.createDataFrame([(1, "x", 2, "b"), (2, "X", 1, "a"), (3, None, 5, "c"), (4, "y", 1, None)], "id int, k string, o int, v string")
    assert {r.id for r in relational.first_per_group(df, [F.lower("k")], ["o", "id"]).collect()} == {2, 3, 4}
    assert {r.id for r in relational.latest(df, "k", ["o", "id"]).collect()} == {1, 2, 4}


def test_positional_cycles(spark):
    pool = spark.createDataFrame([("g", 0, "a"), ("g", 1, "b")], "g string, r long, v string")
    items = spark.range(5).select(F.lit("g").alias("g"), F.col("id").alias("i"))
    assert [r.v for r in relational.positional(items, ["g"], "i", pool, "r").orderBy("i").collect()] == list("ababa")


def test_exact_dedup_with_nulls(spark):
    df = spark.createDataFrame([(1, "A b!"), (2, "a  b"), (3, None), (4, None), (5, "")], "id int, t string")
    assert sorted(r.id for r in quality.exact_dedup(df, "t", ["id"]).collect()) == [1, 3, 5]


def test_rings(spark):
    ring = "array(named_struct('x',0D,'y',0D),named_struct('x',4D,'y',0D),named_struct('x',4D,'y',4D),named_struct('x',2D,'y',1D),named_struct('x',0D,'y',4D))"
    df = spark.createDataFrame([(1, 1.0, 1.0), (2, 2.0, 3.0), (3, 5.0, 1.0), (4, 3.5, 3.0)], "id int, x double, y double")
    areas = spark.sql(f"select 'a' as area, array({ring}) as rings")
    assert sorted(r.id for r in spatial.locate(df, areas, "id", "area", 1.5).collect()) == [1, 4]


def test_stitched_rings(spark):
    ways = [("a", 2, [(4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]), ("a", 1, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)]), ("a", 3, [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]), ("a", 4, [(9.0, 9.0), (8.0, 8.0)]), ("b", 1, [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)])]
    got = spatial.stitch_rings(spark.createDataFrame(ways, "area string, way int, points array<struct<x:double,y:double>>"), "area").collect()
    assert [(r.area, sorted(len(x) for x in r.rings)) for r in got] == [("a", [4, 5])]
    points = spark.createDataFrame([(1, 3.0, 3.0), (2, 1.8, 1.2), (3, 5.0, 5.0)], "id int, x double, y double")
    areas = spatial.stitch_rings(spark.createDataFrame(ways, "area string, way int, points array<struct<x:double,y:double>>"), "area")
    assert [r.id for r in spatial.locate(points, areas, "id", "area", 1.5).collect()] == [1]


def test_nearest_box_of_those_where_a_point_occurs(spark):
    boxes = spark.createDataFrame([("a", 0.0, 0.0, 2.0, 2.0), ("b", 1.0, 1.0, 4.0, 4.0)], "box string, x0 double, y0 double, x1 double, y1 double")
    points = spark.createDataFrame([(1, 1.2, 1.2), (2, 1.2, 1.2), (3, 9.0, 9.0), (4, 9.0, 9.0)], "id int, x double, y double")
    occurs = spark.createDataFrame([(2, "b"), (3, "a"), (3, "b")], "id int, box string")
    assert {r.id: r.box for r in spatial.nearest_box(points, boxes, "id", "box", 1.0, occurs).collect()} == {1: "a", 2: "b", 3: "b"}


def test_samples_need_all_columns(spark, tmp_path):
    with pytest.raises(ValueError):
        files.write_samples(spark.createDataFrame([("a",)], "id string"), str(tmp_path / "s"))


def test_sources_of_aliases_and_landmarks(spark):
    doc = [{"province_id": "01", "legacy_names": [{"name": "A", "admin_prefix": ""}], "spoken_aliases": [{"name": "B", "admin_prefix": "tỉnh"}]}, {"province_id": "02"}]
    assert {(r.province_id, r.alias_type, r.alias, r.weight) for r in files.province_aliases(spark, doc).collect()} == {("01", "legacy", "A", 1.0), ("01", "spoken", "B", 1.0)}
    assert [(r.province_id, r.name, r.fame_tier) for r in files.landmarks(spark, {"01": [{"name": "X", "subcategory": "lake", "fame_tier": 1}], "02": None}).collect()] == [("01", "X", 1)]


def test_final_quotas(spark):
    cells = spark.createDataFrame([("a", 1.0, 100), ("b", 5.0, 100), ("c", 1.0, 3)], "k string, weight double, observed long")
    got = dict(quota.final_quotas(cells, ["k"], 60, 5, 0.5))
    assert got == {"a": 27, "b": 30, "c": 3} and sum(got.values()) == 60
    assert dict(quota.final_quotas(cells, ["k"], 500, 5, 1.0)) == {"a": 100, "b": 100, "c": 3}
    assert sum(n for _, n in quota.final_quotas(cells, ["k"], 4, 5, 1.0)) == 4


def test_snapshot_files(spark, tmp_path):
    doc = {"province_id": "01", "bbox": [0.0, 0.0, 1.0, 1.0], "elements": [{"type": "node", "id": 7, "lat": 0.5, "lon": 0.6, "tags": {"name": "A"}}, {"type": "way", "id": 8, "center": {"lat": 0.1, "lon": 0.2}, "tags": {"highway": "primary"}}]}
    (tmp_path / "01.json").write_text(json.dumps(doc))
    rows = {r.ref: (r.lat, r.lon, r.tags) for r in files.read_elements(spark, str(tmp_path / "*.json")).collect()}
    assert rows == {"node_7": (0.5, 0.6, {"name": "A"}), "way_8": (0.1, 0.2, {"highway": "primary"})}
    assert files.read_table(spark, str(tmp_path / "none.csv"), files.schemas.SAMPLES).count() == 0


def test_config_tables(spark, tmp_path):
    (tmp_path / "v.yaml").write_text("schema_version: 1\naxes:\n  a:\n    weights: {x: 1, y: 3}\n    by_register:\n      formal: {x: 1, y: 1}\n")
    doc = files.read_config(str(tmp_path / "v.yaml"), 1)
    got = {(r.level, r.key, r.value): r.weight for r in files.axis_weights(spark, doc["axes"]).collect()}
    assert got == {("default", "", "x"): 0.25, ("default", "", "y"): 0.75, ("register", "formal", "x"): 0.5, ("register", "formal", "y"): 0.5}
    with pytest.raises(ValueError):
        files.read_config(str(tmp_path / "v.yaml"), 2)
    words = files.lexicon_words(spark, {"openers": {"formal": ["", {"text": "cho hỏi", "heads": ["statement"]}]}, "nouns": ["chỗ"]})
    assert {(r.slot, r.text) for r in words.collect()} == {("openers", "cho hỏi"), ("nouns", "chỗ")}
    for n in ("b", "a"):
        (tmp_path / n).write_text(n)
    assert files.content_digest([str(tmp_path / "a"), str(tmp_path / "b")]) == files.content_digest([str(tmp_path / "b"), str(tmp_path / "a")])
    (tmp_path / "run1").mkdir()
    assert files.find_samples(spark, str(tmp_path)) is None
    (tmp_path / "run1" / "clean.csv").write_text("id\n")
    assert files.find_samples(spark, str(tmp_path)).endswith("clean.csv")


def test_stream_equals_batch(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(src)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "events.parquet").symlink_to(src)
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in")).withColumn("ts", F.col("ts").cast("timestamp"))
    q = windows.windowed_counts(stream, "ts", "event_type", "value", "1 hour").writeStream.outputMode("complete").format("memory").queryName("w").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    want = windows.windowed_counts(batch, "ts", "event_type", "value", "1 hour").agg(F.sum("n"), F.count("*")).first()
    assert spark.table("w").agg(F.sum("n"), F.count("*")).first() == want
    assert windows.sessions(batch, "ts", "event_type").agg(F.sum("n")).first()[0] == batch.count()
    assert windows.deduplicated(batch, "ts", ["event_type"]).count() == batch.select("event_type").distinct().count()
