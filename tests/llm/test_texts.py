"""Encoding, splitting, leaks, folding and sampling: against public libraries, brute force and their own promises."""

import hashlib
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quotaloom.llm import bpe, leaks, scripts, splitting, target_sample
from quotaloom.llm.queries import RANK_FILE

tokenizers = pytest.importorskip("tokenizers")
ENCODER = bpe.Encoder(open(RANK_FILE, "rb").read())
PUBLIC = tokenizers.Tokenizer.from_file(RANK_FILE.replace(".tiktoken", ".json"))
PUBLIC.encode_special_tokens = True
ALPHABET = "ab \n\t\r'’strevmdl  éạờđĐ1²ⅷ漢字かな서울😀<|endoftext|>.,!-​‍́\x85\x1c"
TEXTS = st.text(st.sampled_from(ALPHABET), max_size=200)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_ids_equal_the_public_library(text):
    assert ENCODER.encode(text) == PUBLIC.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_on_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ENCODER.encode(text) == PUBLIC.encode(text, add_special_tokens=False).ids


def test_long_texts_without_blanks():
    rng = random.Random(1)
    for text in ("đường" * 3000, "a" * 20_000, "".join(rng.choice("abcđẫ") for _ in range(8000)), "漢" * 3000):
        assert ENCODER.encode(text) == PUBLIC.encode(text, add_special_tokens=False).ids


def test_encode_corpus(spark):
    rows = [(1, "xin chào"), (2, None), (3, ""), (1, "xin chào"), (4, "b"), (4, "a"), (4, None), (None, "x"), (None, "x"), (5, "dài " * 20_000)]
    df = spark.createDataFrame([(*r, "i") for r in rows], "doc_id long, text string, ids string")
    got = {r.doc_id: r.ids for r in bpe.encode_corpus(df, id_col="doc_id", text_col="text", rank_path=RANK_FILE).collect()}
    assert got == {1: ENCODER.encode("xin chào"), 2: [], 3: [], 4: [], None: ENCODER.encode("x"), 5: ENCODER.encode("dài " * 20_000)}
    assert bpe.encode_corpus(df.limit(0), id_col="doc_id", text_col="text", rank_path=RANK_FILE).count() == 0


def check_parts(text, parts, limit, overlap):
    if not text:
        assert parts == []
        return
    assert parts[0][0] == 0 and parts[-1][1] == len(text)
    for s, e, n, _, _ in parts:
        assert s < e and n == len(ENCODER.encode(text[s:e])) <= limit
    for a, b in zip(parts, parts[1:]):
        assert a[0] < b[0] <= a[1] < b[1]


BITS = ["ngõ ", "Đường", " phố. ", "\n\n", "\n", "xa!", "漢字。", " ", "  ", "a1b2", "😀", "can't ", "\r\n", "!?\"", "\r", " \n ", "Hẻm"]
SIZES = st.sampled_from([(32, 8), (64, 16), (16, 0), (64, 8)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=400).map("".join), SIZES)
def test_parts_keep_their_promises(text, how):
    check_parts(text, splitting.split_text(text, ENCODER, *how), *how)


def kind_by_look(text, c):
    """The kind of a cut before code point c between two pieces, by looking at the text."""
    a, b = len(text[:c].rstrip(WHITE)), len(text) - len(text[c:].lstrip(WHITE))
    if text[c - 1 : c + 1] == "\r\n":
        return splitting.INSIDE
    gone, ahead = (len(re.findall(r"\r\n|[\r\n]", x)) for x in (text[a:c], text[c:b]))
    stop = bool(re.search(r"[.!?。][\"]*$", text[:a]))
    if ahead:
        return splitting.WORD
    if gone:
        return splitting.PARAGRAPH if gone > 1 else splitting.LINE
    if b > a:
        return splitting.SENTENCE if stop else splitting.WORD
    return splitting.SENTENCE if stop and text[c - 1] == "。" else splitting.EDGE


WHITE = " \r\n"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(BITS), min_size=2, max_size=30).map("".join))
def test_kinds_of_boundaries(text):
    pieces, table = ENCODER.pieces(text), splitting._table(ENCODER)
    places = [sum(map(len, pieces[:k])) for k in range(1, len(pieces))]
    got = splitting.boundary_kinds(table.facts[:, [table[p] for p in pieces]]).tolist()
    assert got == [kind_by_look(text, c) for c in places]


def cheapest_by_search(total, kinds, limit, overlap):
    """The least cost of all plans by trying every end and every start that is offered, one part after the other."""
    n, low, high, least = len(total) - 1, overlap // 2, overlap + overlap // 2, limit // 2
    fewest = max(2, -(-(total[n] - low) // (limit - low)))
    fair = (total[n] + overlap * (fewest - 1)) / fewest
    cost = {0: 0.0}
    for level in (splitting.SENTENCE, splitting.WORD, splitting.EDGE, splitting.INSIDE):
        ends = [e for e in range(1, n) if kinds[e] <= level]
        offered = set(splitting._starts(total, kinds, np.array(ends, int), overlap).tolist())
        cost, best = {0: 0.0}, float("inf")
        for e in [*ends, n]:
            here = [c + splitting.BALANCE * ((total[e] - total[s] - fair) / limit) ** 2 for s, c in cost.items() if least < total[e] - total[s] <= limit]
            if not here:
                continue
            c = min(here) + splitting.PART + splitting.PENALTY[kinds[e]]
            if e == n:
                best = c
            for s in offered if e < n else ():
                if low <= total[e] - total[s] <= high:
                    x = c + splitting.START[kinds[s]] + splitting.SHIFT * ((total[e] - total[s] - overlap) / max(overlap, 1)) ** 2
                    cost[s] = min(cost.get(s, float("inf")), x)
        if best <= fewest * splitting.PART + splitting.PENALTY[level + 1]:
            return best
    return best


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.sampled_from([0, 1, 2, 3, 3, 3, 4, 5])), min_size=25, max_size=90), st.sampled_from([(64, 16), (48, 8), (80, 16)]))
def test_plans_are_the_best(units, how):
    total = np.concatenate([[0], np.cumsum([n for n, _ in units])])
    kinds = np.array([splitting.END, *(k for _, k in units[1:]), splitting.END])
    if total[-1] <= how[0]:
        return
    doc = splitting._Doc(np.arange(len(total)), total, kinds)
    other = splitting._Doc(np.arange(len(total)), np.append(0, np.cumsum(np.diff(total)[::-1])), kinds[::-1])
    for alone in ([doc], [other, doc, other]):
        plan = splitting.best_plans(alone, *how)[len(alone) // 2]
        assert (price(plan, total, kinds, *how) if plan else float("inf")) == pytest.approx(cheapest_by_search(total, kinds, *how))


def price(plan, total, kinds, limit, overlap):
    fewest = max(2, -(-(total[-1] - overlap // 2) // (limit - overlap // 2)))
    fair = (total[-1] + overlap * (fewest - 1)) / fewest
    ends = sum(splitting.PENALTY[kinds[e]] + splitting.PART + splitting.BALANCE * ((total[e] - total[s] - fair) / limit) ** 2 for s, e in plan)
    return ends + sum(splitting.START[kinds[b[0]]] + splitting.SHIFT * ((total[a[1]] - total[b[0]] - overlap) / max(overlap, 1)) ** 2 for a, b in zip(plan, plan[1:]))


def test_parts_cut_at_the_best_boundaries():
    paragraph = " ".join(["Đi thẳng qua cầu rồi rẽ trái ở ngã ba."] * 6)
    text = "\n\n".join([paragraph] * 12)
    parts = splitting.split_text(text, ENCODER)
    check_parts(text, parts, 512, 64)
    assert len(parts) > 2 and all(text[:p[1]].endswith("\n\n") for p in parts[:-1])
    for a, b in zip(parts, parts[1:]):
        assert 32 <= b[3] <= 96 and abs(len(ENCODER.encode(text[b[0] : a[1]])) - b[3]) <= 2
    dense = "=" * 20_000 + "😀" * 300 + "=" * 20_000
    for text in ("đường" * 3000, " " * 4000, "a" * 9000, "x y " * 4000, "\n" * 3000, dense, "漢" * 3000, "một câu dài. " * 6000):
        check_parts(text, splitting.split_text(text, ENCODER), 512, 64)
    check_parts(dense[:9000], [(s, e, n, x, k) for s, e, n, x, k in splitting._longest(dense[:9000], ENCODER, 512, 64)], 512, 64)
    assert splitting.split_text("ngắn", ENCODER) == [(0, 4, len(ENCODER.encode("ngắn")), 0, splitting.END)]


def test_split_corpus(spark):
    rows = [(1, None), (2, ""), (3, "ngắn"), (4, "một câu. " * 500), (4, "ngắn")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, piece_no int")
    got = splitting.split_corpus(df, id_col="doc_id", text_col="text", rank_path=RANK_FILE).collect()
    assert Counter(r.doc_id for r in got)[3] == 1 and {r.doc_id for r in got} == {3, 4}
    assert all(r.n_tokens <= 512 and r.text == dict((i, t) for i, t in rows[:4]).get(r.doc_id, "")[r.start : r.end] for r in got if not (r.doc_id == 4 and r.text == "ngắn"))


def test_promises_are_told_from_the_parts(spark):
    df = spark.createDataFrame([(1, "một câu. " * 500), (2, "dòng\r\n" * 900), (3, "đường" * 900)], "doc_id long, text string")
    parts = splitting.split_corpus(df, id_col="doc_id", text_col="text", rank_path=RANK_FILE)
    got = splitting.promises(parts, id_col="doc_id", limit=512, overlap=64).collect()
    assert len(got) == 3 and all(r.fits and r.overlaps and r.natural for r in got)
    assert {r.doc_id: r.digest for r in got} == {r.doc_id: hashlib.md5(r.text.encode()).hexdigest() for r in df.collect()}
    broken = splitting.promises(parts.filter("piece_no <> 1"), id_col="doc_id", limit=100, overlap=64).collect()
    assert not any(r.fits for r in broken) and {r.digest for r in broken}.isdisjoint(r.digest for r in got)


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def grams(text, n):
    w = words_of(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


@pytest.mark.parametrize(("run", "postings"), [(3, 4_000_000), (6, 40)])
def test_leaks_by_brute_force(spark, monkeypatch, run, postings):
    monkeypatch.setattr(leaks, "MAX_POSTINGS", postings)
    monkeypatch.setattr(leaks, "CHECKED", postings)
    rng = random.Random(run)
    vocabulary = [f"w{min(rng.randrange(30), rng.randrange(30))}" for _ in range(60)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 15)))) for k in range(25)] + [(90, None), (91, ""), (92, "lone")]
    docs = []
    for k in range(120):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if k % 3 == 0:
            w[5:5] = (lambda x: x[rng.randrange(3) :])(words_of(rng.choice(items)[1]))
        docs.append((k, "; ".join(w).title()))
    docs += [(200, None), (201, ""), (0, docs[0][1])]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, run int")
    e = spark.createDataFrame(items, "item_id int, text string")
    found = leaks.find_leaks(d, e, run=run).filter(f"run >= {run}").collect()
    want = {(i, k) for i, t in docs for k, x in items if grams(t, run) & grams(x, run)}
    assert {(r.doc_id, r.item_id) for r in found} == want and want
    for r in found:
        w, x = words_of(dict(docs)[r.doc_id]), words_of(dict(items)[r.item_id])
        assert w[r.doc_pos : r.doc_pos + r.run] == x[r.item_pos : r.item_pos + r.run]
    assert leaks.find_leaks(d.limit(0), e).count() == 0 and leaks.find_leaks(d, e.limit(0)).count() == 0


def test_proximity_and_stored_index(spark, tmp_path):
    item = " ".join(f"a{i}" for i in range(20))
    near = item.replace("a10", "zz")
    d = spark.createDataFrame([("x", near), ("y", "a1 a2 a3")], "doc_id string, text string")
    got = leaks.find_leaks(d, spark.createDataFrame([(1, item)], "item_id long, text string"), run=12).collect()
    assert [(r.doc_id, r.run, r.aligned) for r in got] == [("x", 10, 19)]
    index = leaks.positional_index(d, doc_id="doc_id", text="text", terms=["a1", "a3", "none"], path=str(tmp_path / "index"))
    places = sorted((r.term, doc, pos) for r in index.collect() for doc, pos in zip(r.docs, r.positions, strict=True))
    assert places == [(0, "x", 1), (0, "y", 0), (1, "x", 3), (1, "y", 2)]
    assert {p.name for p in (tmp_path / "index").glob("bucket=*")} == {"bucket=0", "bucket=1"}
    assert leaks.term_counts(index, 3).tolist() == [2, 2, 0]


def test_too_many_items_are_refused_before_they_are_read(spark, monkeypatch):
    monkeypatch.setattr(leaks, "MAX_ITEM_WORDS", 3)
    d = spark.createDataFrame([("x", "a b c d")], "doc_id string, text string")
    with pytest.raises(ValueError):
        leaks.find_leaks(d, spark.createDataFrame([(1, "a b"), (2, "c d")], "item_id long, text string"))


def test_proximity_by_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(40)]
    items = [(k, [rng.choice(vocabulary) for _ in range(rng.randint(10, 30))]) for k in range(20)]
    docs = []
    for k in range(80):
        w = list(rng.choice(items)[1])
        for q in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(["new", *vocabulary])
        docs.append((k, [rng.choice(vocabulary) for _ in range(rng.randint(0, 9))] + w))
    fixed = [f"a{i}" for i in range(20)]
    items, docs = items + [(77, fixed)], docs + [(777, [x if x != "a10" else "zz" for x in fixed])]
    want = set()
    for i, w in docs:
        for k, x in items:
            for d in range(-len(x), len(w)):
                hit = [0 <= q + d < len(w) and w[q + d] == x[q] for q in range(len(x))]
                best = max(map(len, "".join("x" if h else " " for h in hit).split()), default=0)
                if best >= 12 or sum(hit) >= max(12, 0.8 * len(x)):
                    want.add((i, k, best, sum(hit)))
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    got = leaks.find_leaks(d, spark.createDataFrame([(k, " ".join(x)) for k, x in items], "item_id long, text string"), run=12).collect()
    assert {(r.doc_id, r.item_id, r.run, r.aligned) for r in got} == want and len(got) == len({(r.doc_id, r.item_id, r.doc_pos - r.item_pos) for r in got})
    assert (777, 77, 10, 19) in want and len([r for r in want if r[2] < 12]) > 10


FOLDS = {
    "Đường Bính Miền": ("Đường Bính Miền", False), unicodedata.normalize("NFD", "Đường Bính"): ("Đường Bính", True), "hẻm Chành Nhừnɡ": ("hẻm Chành Nhừng", True), "Кến": ("Kến", True),
    "ｎｇõ Ｍảｎ": ("ngõ Mản", True), "ngân hàng": ("ngân hàng", True), "Hẻ­m": ("Hẻm", True), "phố Мост": ("phố Мост", False), "茶館 スシ・バー": ("茶館 スシ・バー", False), "東京，大阪": ("東京，大阪", False),
    "số １２": ("số 12", True), "chợ，cầu": ("chợ,cầu", True), "Ðẩn": ("Đẩn", True), "Sιểυ": ("Siểu", True), "Ρόδο": ("Ρόδο", False), "": ("", False), "  ": ("  ", False), "می‌خواهم": ("می‌خواهم", False),
    "khu​A": ("khuA", True), "dấu\tcách": ("dấu cách", True), "⁠Phố": ("Phố", True), "рhố": ("phố", True), "2号": ("2号", False), "A東": ("A東", True), "số 5": ("số 5", False),
    "Мoсква": ("Москва", True), "Αθήνa": ("Αθήνα", True), "Жoга": ("Жога", True), "сор": ("сор", False), "Sαρ": ("Sap", True), "Кo": ("Ko", True),
}


@pytest.fixture(scope="module")
def table(spark):
    return scripts.Confusables(scripts.skeletons(spark))


@pytest.mark.parametrize("value", list(FOLDS))
def test_fold(value, table):
    got, case, *_ = scripts.fold(value, table)
    assert (got, case) == FOLDS[value]
    assert scripts.fold(got, table)[0] == got


ODD = "aăđờ КарԁеΑοι漢字カー서ｇＡ１，​‍ 　̣́ɡı.-\t5"


def test_fold_is_idempotent(table):
    rng = random.Random(5)
    for _ in range(3000):
        value = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 25)))
        once = scripts.fold(value, table)[0]
        assert scripts.fold(once, table)[0] == once, value


def test_plain_values_are_no_case(table):
    for c in map(chr, range(32, 0x2100)):
        if re.match(scripts.PLAIN, c):
            assert not scripts.fold(f"a{c}b", table)[1] or not unicodedata.is_normalized("NFC", f"a{c}b"), c


def test_the_intersection_of_scripts_decides(table, monkeypatch):
    assert scripts.token_scripts("aК") == frozenset() == scripts.token_scripts("aɡ") and scripts.token_scripts("ab") == {"Viet"}
    assert "Jpan" in scripts.token_scripts("東京スシ") and scripts.token_scripts("Мост") >= {"Cyrl"}
    monkeypatch.setattr(scripts, "token_scripts", lambda token: frozenset(["Viet"]))
    assert not scripts.fold("Кến", table)[1]  # with a constant in its place nothing is a case


def test_whole_script_look_alikes(table):
    assert scripts.fold("phố сор", table) == ("phố сор", False, True, "phố cop") and not scripts.fold("Жук", table)[2]
    assert scripts.fold("Роор", table, "Cyrl")[3] == "Роор" and scripts.fold("Poop", table, "Cyrl")[3] == "Роор"
    assert scripts.fold("Кo", table, "Cyrl")[0] == "Ко"


def test_planted_disguises_come_back(table):
    """Honest values of the data, disguised by look-alikes, decomposition, wide forms, invisible characters and spaces."""
    import pyarrow.parquet as pq

    values = [v for v in pq.read_table("/root/testdata/sf0.001/generate_small.parquet", columns=["entity"])["entity"].to_pylist() if v]
    values = sorted({v for v in values if re.match(scripts.PLAIN, v) and unicodedata.is_normalized("NFC", v) and not scripts.fold(v, table)[1]})
    forms = {}
    for c in table.skeleton:
        to = table.form(c, "Viet")
        if to and to != c and to in scripts.HOME and len(to) == 1 and table.form(to, "Viet") == to:
            forms.setdefault(to, []).append(c)
    rng, cases = random.Random(9), 0
    for v in values:
        w = list(v)
        inside = [k for k, c in enumerate(w) if c in forms and (w[k - 1 : k] + w[k + 1 : k + 2]) and any(x in scripts.HOME and x not in forms for x in _token(v, k))]
        for k in rng.sample(inside, min(len(inside), 2)):
            w[k] = rng.choice(forms[w[k]])
        if rng.random() < 0.5:
            w = [x for c in w for x in (unicodedata.normalize("NFD", c) if rng.random() < 0.3 else c)]
        w = [{" ": rng.choice(" \u00a0\u2009 ")}.get(c, c) for c in w]
        w = [chr(ord(c) + 0xFEE0) if "0" <= c <= "9" and rng.random() < 0.5 else c for c in w]
        if rng.random() < 0.3:
            w.insert(rng.randrange(len(w) + 1), rng.choice("\u200b\u200d\u2060\u00ad"))
        text = "".join(w)
        got, case, *_ = scripts.fold(text, table)
        assert got == v, (v, text)
        assert case == (text != v), (v, text)
        cases += case
    assert cases > 100


def _token(value, k):
    a, b = k, k
    while a and value[a - 1].isalnum():
        a -= 1
    while b < len(value) and value[b].isalnum():
        b += 1
    return value[a:k] + value[k + 1 : b]


def test_folded_table(spark):
    df = spark.createDataFrame([("1", "Кến", None, "x"), ("1", "Кến", None, "x"), ("2", "phố", "a b", "y"), (None, "Кến", "", "z")], "id string, a string, b string, value string")
    got = {(r.row_key, r.field): (r.folded, r.is_case) for r in scripts.folded(df, key="id", fields=["a", "b"], table_name="t").collect()}
    assert got == {("1", "a"): ("Kến", True), ("2", "b"): ("a b", True), (None, "a"): ("Kến", True)}


def test_last_line_ends_are_cases(spark):
    ends = ["\n", "\r\n", "\x85", "\u2028", "\u2029"]
    df = spark.createDataFrame([(str(k), "phố" + e) for k, e in enumerate(ends)] + [("p", "phố")], "id string, a string")
    got = {r.row_key: (r.folded, r.is_case) for r in scripts.folded(df, key="id", fields=["a"], table_name="t").collect()}
    assert got == {str(k): ("phố" + " " * len(e), True) for k, e in enumerate(ends)}


def sample_world(spark):
    rows = [(f"i{k:04d}", "big" if k < 3000 else "mid" if k < 3300 else "small" if k < 3310 else None, "c", "d") for k in range(3400)]
    rows += rows[:500] + [(None, "big", "c", "d")]
    records = spark.createDataFrame(rows, "id string, kind string, quota string, _u string")
    plan = spark.createDataFrame([("big", 100), ("big", 400), ("big", 400), ("mid", 1), ("small", 25), ("gone", 5), ("none", None), ("zero", 0)], "kind string, n int")
    return records, target_sample.cell_targets(plan, ["kind"], "n")


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_sample_meets_targets(spark, seed):
    records, cells = sample_world(spark)
    sample, report = target_sample.draw_to_targets(records, cells, record="id", keys=["kind"], minimum=3, seed=seed)
    got = {r.kind: (r.target, r.observed, r.drawn, r.deficit) for r in report.collect()}
    assert got == {"big": (500, 3000, 500, 0), "mid": (1, 300, 3, 0), "small": (25, 10, 10, 15), "gone": (5, 0, 0, 5), "zero": (0, 0, 0, 0)}
    drawn = [r.id for r in sample.collect()]
    assert len(drawn) == len(set(drawn)) == 513


def test_a_record_with_two_values_keeps_one_of_them(spark):
    records = spark.createDataFrame([("a", "k1", "z2"), ("a", "k2", "z1")], "id string, kind string, zone string")
    cells = spark.createDataFrame([("k1", "z2", 1), ("k1", "z1", 1), ("k2", "z1", 1)], "kind string, zone string, target long")
    report = target_sample.draw_to_targets(records, cells, record="id", keys=["kind", "zone"])[1].collect()
    assert {(r.kind, r.zone): r.drawn for r in report} == {("k1", "z2"): 1, ("k1", "z1"): 0, ("k2", "z1"): 0}


def test_sample_of_nothing(spark):
    records, cells = sample_world(spark)
    assert target_sample.draw_to_targets(records.limit(0), cells, record="id", keys=["kind"])[0].count() == 0
    assert target_sample.draw_to_targets(records, cells.limit(0), record="id", keys=["kind"])[1].count() == 0
