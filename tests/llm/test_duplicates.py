"""Near-duplicates, the format ledger and term counts against brute force, with nulls, hot groups and odd columns."""

import datetime as dt
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quotaloom.llm import format_ledger, near_dup, term_counts

T0 = dt.datetime(2025, 1, 1)


def words_of(text):
    return re.findall(r"[^\W_]+", text.lower())


def shingles(text, width):
    w = words_of(text)
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def edited(rng, vocabulary, base):
    w = list(base)
    for _ in range(rng.randint(0, 3)):
        k = rng.randrange(len(w))
        w[k : k + rng.randint(0, 1)] = [rng.choice(vocabulary)]
    return w


def near_rows(seed=1, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 20))] for _ in range(8)]
    rows = []
    for i in range(n):
        w = edited(rng, vocabulary, rng.choice(bases))
        rows.append((f"r{i:03d}", " ".join(w).upper() if i % 7 == 0 else ", ".join(w), rng.choice(["t1", "t1", "t1", "t2", None])))
    rows += [("x1", None, "t1"), ("x2", "", "t1"), ("x3", "one", "t1"), ("x4", "...", "t1"), (None, "a b c", "t1"), ("x5", "a b", "t1"), ("x6", "a b", "t1"), ("x7", "a a a a", "t1"), ("x8", "a a", "t1")]
    rows += rows[:5]  # delivered again
    rows += [(f"h{i:03d}", "same old text again and again and again", "t2") for i in range(60)]
    return rows


@pytest.mark.parametrize(("cap", "block", "copies"), [(200, 20_000, 1000), (3, 20_000, 7), (1, 4, 1000), (2, 2, 20)])
def test_near_duplicates_are_exact(spark, monkeypatch, cap, block, copies):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "COPIES", copies)
    rows = near_rows()
    df = spark.createDataFrame([(a, b, c, 1, "q") for a, b, c in rows], "id string, text string, tpl string, cls int, region string")
    pairs = near_dup.record_pairs(*near_dup.near_duplicates(df, id_col="id", text_col="text", part_col="tpl", width=2, threshold=(7, 10), cap=cap))
    got = [(r.id_a, r.id_b) for r in pairs.collect()]
    want = set()
    once = sorted({r for r in rows if r[0] and r[1] and r[2]})
    sets = [(i, t, shingles(x, 2)) for i, x, t in once]
    for k, (i, t, s) in enumerate(sets):
        for j, u, v in sets[k + 1 :]:
            if s and v and t == u and 10 * len(s & v) >= 7 * len(s | v):
                want.add((i, j))
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("width", [1, 3, 5])
def test_near_duplicates_of_other_widths(spark, width):
    rows = sorted({r for r in near_rows(5, 90) if r[0] and r[1]}, key=str)
    df = spark.createDataFrame([(a, b, "p") for a, b, _ in rows], "id string, text string, tpl string")
    pairs, members = near_dup.near_duplicates(df, id_col="id", text_col="text", part_col="tpl", width=width, threshold=(4, 5), cap=4)
    got = {(r.id_a, r.id_b) for r in near_dup.record_pairs(pairs, members).collect()}
    sets = [(a, shingles(b, width)) for a, b, _ in rows]
    assert got == {(a, b) for a, s in sets for b, v in sets if a < b and s and v and 5 * len(s & v) >= 4 * len(s | v)}


def test_sets_that_share_a_hash_are_told_apart(spark):
    df = spark.createDataFrame([("a", 1, "x", 5, 7), ("b", 1, "x", 5, 7), ("c", 1, "y", 5, 8), ("d", 1, "z", 6, 9)], "id string, part long, text string, cls long, twin long")
    got = {r.id: r.cls for r in near_dup._told_apart(df).collect()}
    assert got["a"] == got["b"] == 5 and got["d"] == 6 and got["c"] not in (5, 6)


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "id string, text string, tpl string")
    pairs, members = near_dup.near_duplicates(df, id_col="id", text_col="text", part_col="tpl", width=2, threshold=(7, 10))
    assert near_dup.record_pairs(pairs, members).count() == 0
    assert near_dup.components(pairs, members).count() == 0


def test_partners_share_a_region_at_any_depth():
    rng = np.random.default_rng(0)
    lists = pa.array([rng.integers(0, 40, rng.integers(2, 25)).tolist() for _ in range(60)], pa.list_(pa.int64()))
    sets = near_dup.Sets(lists, 1)
    key, everything = np.zeros(60, np.int64), np.full(1 << 7, 255, np.uint8)
    grams = [set(sets.gram[s : s + n].tolist()) for s, n in zip(sets.start, sets.n)]
    for levels in range(4):
        owner, path = near_dup.paths(sets, key, (7, 10), [everything] * levels)
        regions = defaultdict(set)
        for o, p in zip(owner.tolist(), path.tolist()):
            regions[o].add(p)
        for a in range(60):
            for b in range(a):
                if 10 * len(grams[a] & grams[b]) >= 7 * len(grams[a] | grams[b]):
                    assert regions[a] & regions[b]


def test_components(spark):
    chain = [(f"c{i:02d}", " ".join(f"k{j}" for j in range(i, i + 20)), "t") for i in range(30)]
    rows = chain + [("z1", "lone words here", "t"), ("z2", "lone words here", "t"), ("z3", "nothing like it", "t")]
    df = spark.createDataFrame(rows, "id string, text string, tpl string")
    got = {r.id: (r.class_id, r.links) for r in near_dup.components(*near_dup.near_duplicates(df, id_col="id", text_col="text", part_col="tpl", width=2, threshold=(7, 10))).collect()}
    assert {got[f"c{i:02d}"][0] for i in range(30)} == {"c00"} and got["z1"][0] == got["z2"][0] == "z1" and got["z3"] == ("z3", 0)
    assert got["c00"][1] == 3 and got["c15"][1] == 6  # 19 shingles each; neighbours up to three steps away share 16 of 22


def test_keep_per_cluster_by_brute_force(spark):
    rows = near_rows(3) + [("s1", "One", "t1"), ("s2", "one!", None), ("s3", "ONE", "t2"), ("s4", "one", "t1"), ("e1", None, "t1"), ("e2", "", "t1"), ("e3", "..", "t1"), ("e4", None, "t1")]
    df = spark.createDataFrame(rows, "id string, text string, tpl string")
    got = [r.id for r in near_dup.keep_per_cluster(df, id_col="id", text_col="text", width=2, threshold=(7, 10), n=3).collect()]
    text = {i: x or "" for i, x, _ in rows if i}
    root = {i: i for i in text}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sorted(text):
        for b in sorted(text):
            s, v, short = shingles(text[a], 2), shingles(text[b], 2), len(words_of(text[a])) == 1 and words_of(text[a]) == words_of(text[b])
            if a < b and (short or s and v and 10 * len(s & v) >= 7 * len(s | v)):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    clusters = defaultdict(list)
    for i in sorted(text):
        clusters[find(i)].append(i)
    assert sorted(got) == sorted(i for c in clusters.values() for i in c[:3]) and {"e1", "e2", "e3", "e4", "s1", "s2", "s3"} <= set(got)
    assert len({t for _, _, t in rows if t}) > 1 and len(got) < len(text)
    assert near_dup.keep_per_cluster(df.limit(0), id_col="id", text_col="text", width=2, threshold=(7, 10), n=3).count() == 0


def canonical(text):
    return tuple(sorted(f for f in (" ".join(words_of(x)) for x in re.split("[,;|]", text)) if f))


FORMS = ["Aa bb, cc", "cc;AA  bb", "cc|aa_bb", "aa bb cc", "aa, bb, cc", "aa bb, cc, cc", "", None, " ,;| ", "Đường Bính", "ĐƯỜNG   bính.", "x" * 5000, "X" * 5000 + "!"]


def ledger_rows():
    rng = random.Random(2)
    rows = [(f"i{k:03d}", rng.choice(FORMS), T0 + dt.timedelta(days=rng.randint(0, 300))) for k in range(150)] + [(None, "aa bb", T0)]
    return rows + [(i, t, at + dt.timedelta(days=40)) for i, t, at in rows[:30]]


def test_ledger(spark):
    rows = ledger_rows()
    df = spark.createDataFrame([(*r, 1, "b") for r in rows], "id string, text string, loaded_at timestamp_ntz, key int, bucket string")
    from pyspark.sql import functions as F

    ledger = format_ledger.build_ledger(df, id_col="id", text_col="text", at="loaded_at", batches=F.quarter("loaded_at"), buckets=4)
    groups, first = defaultdict(set), {}
    for i, t, at in rows:
        if i and t is not None and canonical(t):
            groups[canonical(t)].add(i)
            first[i] = min(first.get(i, at), at)
    want = Counter((min(g), len(g), min((first[i], i) for i in g)[1]) for g in groups.values())
    assert Counter((r.keep_id, r.copies, r.first_id) for r in ledger.counts().collect()) == want
    assert {(r.keep_id, r.copy_id) for r in format_ledger.copies(ledger).collect()} == {(min(g), i) for g in groups.values() for i in g if i != min(g)}
    before = sorted(map(str, ledger.counts().collect()))
    ledger.apply(format_ledger.canonical_keys(df, id_col="id", text_col="text", at="loaded_at", buckets=4).drop("batch"))  # a replay
    assert sorted(map(str, ledger.counts().collect())) == before


@pytest.mark.parametrize("every", [1, 3])
def test_ledger_without_times(spark, every):
    from pyspark.sql import functions as F

    rows = [(i, t, None if k % every == 0 else at) for k, (i, t, at) in enumerate(ledger_rows())]
    df = spark.createDataFrame(rows, "id string, text string, loaded_at timestamp_ntz")
    quarter = F.concat_ws("-", F.year("loaded_at"), F.quarter("loaded_at"))
    ledger = format_ledger.build_ledger(df, id_col="id", text_col="text", at="loaded_at", batches=quarter, buckets=4)
    groups, first = defaultdict(set), {}
    for i, t, at in rows:
        if i and t is not None and canonical(t):
            groups[canonical(t)].add(i)
            first[i] = min(first.get(i, dt.datetime.max), at or dt.datetime.max)
    assert Counter((r.keep_id, r.copies, r.first_id) for r in ledger.counts().collect()) == Counter((min(g), len(g), min((first[i], i) for i in g)[1]) for g in groups.values())


def ledger_batch(spark, rows, buckets):
    df = spark.createDataFrame(rows, "id string, text string, loaded_at timestamp_ntz")
    return format_ledger.canonical_keys(df, id_col="id", text_col="text", at="loaded_at", buckets=buckets).drop("batch")


def test_ledger_touches_the_buckets_of_a_batch_only(spark, tmp_path):
    root = str(tmp_path / "ledger")
    ledger = format_ledger.Ledger(spark, root, 16)
    ledger.apply(ledger_batch(spark, [(f"a{k}", f"text {k}", T0) for k in range(60)], 16))
    before = dict(ledger.state["counts"])
    assert len(before) > 8 and len(set(before.values())) == 1
    batch = ledger_batch(spark, [("b1", "text 3", T0), ("b2", "TEXT 3!", T0)], 16)
    touched = {r.bucket for r in batch.collect()}
    ledger.apply(batch)
    assert {int(b) for b, g in ledger.state["counts"].items() if g != before[b]} == touched and len(touched) == 1
    new = next(g for g in ledger.state["counts"].values() if g not in before.values())
    assert {p.name for p in (tmp_path / "ledger" / "counts" / f"gen={new}").glob("bucket=*")} == {f"bucket={b}" for b in touched}
    read = {f"{'/'.join(f.split('/')[-3:-1])}" for f in ledger.counts(touched).inputFiles()}
    assert read and all("bucket=" in f for f in read)
    plan = ledger.counts(touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan
    again = format_ledger.Ledger(spark, root)  # as in a later session
    assert again.state == ledger.state and again.buckets == 16
    assert {(r.keep_id, r.copies) for r in again.counts().collect() if r.copies > 1} == {("a3", 3)}


@pytest.mark.parametrize("stop", ["members", "counts"])
def test_ledger_stopped_between_the_writes(spark, tmp_path, monkeypatch, stop):
    root = str(tmp_path / "ledger")
    rows = [(f"a{k}", f"text {k % 7}", T0) for k in range(30)]
    more = [(f"b{k}", f"TEXT {k % 9}", T0) for k in range(30)]
    ledger = format_ledger.Ledger(spark, root, 4)
    ledger.apply(ledger_batch(spark, rows, 4))
    want = sorted(map(str, ledger.counts().collect()))

    def fail(*_):
        raise RuntimeError("stopped")

    if stop == "members":
        monkeypatch.setattr(format_ledger.Ledger, "counts", fail)
    else:
        monkeypatch.setattr(format_ledger.Ledger, "_commit", fail)
    with pytest.raises(RuntimeError):
        ledger.apply(ledger_batch(spark, more, 4))
    monkeypatch.undo()
    ledger = format_ledger.Ledger(spark, root)
    assert sorted(map(str, ledger.counts().collect())) == want and ledger.members().count() == 30
    for _ in range(2):  # the replay, and one more
        ledger.apply(ledger_batch(spark, more, 4))
        got = {(r.keep_id, r.copies) for r in ledger.counts().collect()}
        groups = defaultdict(set)
        for i, t, _ in rows + more:
            groups[canonical(t)].add(i)
        assert got == {(min(g), len(g)) for g in groups.values()} and ledger.members().count() == 60


def test_ledger_of_nothing(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([], "id string, text string, loaded_at timestamp_ntz")
    ledger = format_ledger.build_ledger(df, id_col="id", text_col="text", at="loaded_at", batches=F.lit(1))
    assert ledger.counts().count() == 0 and format_ledger.copies(ledger).count() == 0


def term_rows():
    rng = random.Random(3)
    rows = [(f"i{k:03d}", rng.choice(["a", "b", "", None, "A", "\x00"]), rng.choice(["x+y", "x+x+y", "+", "", None, "z", "x++w"]), k % 5) for k in range(200)]
    return rows + [(i, a, b, n + 9) for i, a, b, n in rows[:60]] + [(None, "a", "x", 1)]


@pytest.mark.parametrize("most", [1 << 20, 1])
def test_term_counts(spark, monkeypatch, most):
    monkeypatch.setattr(term_counts, "MAX_TERMS", most)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    rows = term_rows()
    df = spark.createDataFrame([(*r, "c") for r in rows], "id string, one string, many string, at int, field string")
    got = {(r.field, r.value): (r.occurrences, r.records) for r in term_counts.term_frequencies(df, record="id", order="at", values=["one"], multi={"many": "+"}).collect()}
    want = defaultdict(lambda: [0, 0])
    once = {r[0]: r for r in reversed(rows) if r[0]}
    for i, a, b, _ in once.values():
        for field, terms in (("one", [a]), ("many", (b or "").split("+"))):
            for t, n in Counter(t for t in terms if t).items():
                want[field, t][0] += n
                want[field, t][1] += 1
    want[term_counts.TOTAL, ""] = [200, 200]
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {k: tuple(v) for k, v in want.items()}


def test_counters_keep_the_last_record_over_batches():
    c = term_counts._Counters()
    c.add(pa.array(["a", "b", "a"]), np.array([0, 0, 1]))
    c.add(pa.array(["a", "a", "b"]), np.array([1, 2, 2]))
    assert {t: (int(c.occ[s]), int(c.rec[s])) for t, s in c.slot.items()} == {"a": (4, 3), "b": (2, 2)}


def test_marks_and_empty(spark):
    df = spark.createDataFrame([(f"i{k}", "rare" if k < 2 else "mid" if k < 5 else "big") for k in range(100)], "id string, v string")
    got = {r.value: r.mark for r in term_counts.marked_terms(df, record="id", values=["v"], rare_below=3, common_above={"v": 0.5}).collect()}
    assert got == {"rare": "rare", "mid": None, "big": "common"}
    assert term_counts.marked_terms(df.limit(0), record="id", values=["v"], common_above={"v": 0.5}).count() == 0
