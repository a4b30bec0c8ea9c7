"""Splitting oversized texts at natural boundaries, with overlap (problem 9).

A text is a row of pieces of the tokenizer's pattern; a cut between two pieces leaves all token counts as they are, so the
size of any stretch is a difference of prefix sums. A plan is a number of parts, an end for each but the last, and a start
for each but the first. Dynamic programming finds the plan of least

    PART for each part + PENALTY of the end's boundary + START of the start's boundary
    + BALANCE * ((size - fair size) / limit)^2 + SHIFT * ((shared - overlap) / overlap)^2

over all ends, numbers of parts and starts (those at sentences, and for every end the word nearest to the overlap), subject to a size of more than half the limit and at most the limit, and a shared
stretch of half to one and a half times the overlap. Ends and starts are two tables of the same programme, so the overlap is
chosen with the cuts and not after them. An end looks back over the starts within the limit only, so time is linear in the text.

Penalties rise from paragraph over line, sentence and word end to a place inside a run of letters, and the last to a place
inside a word. The programme first runs over ends at sentences or better. A plan with any weaker end costs at least the
fewest parts and that end's penalty, so a plan that costs no more is the best of all; otherwise the next weaker ends
join in. So nothing is left out that could have been better.

Inside a piece of the pattern longer than an eighth of the limit (a text without blanks), cuts fall between code points, halving
until every stretch is small; token counts there aren't sums, so such parts are encoded again, and the text is planned anew with a lower
limit until all parts fit. If that doesn't end, parts are the longest stretches that fit when encoded: no part ever exceeds the limit,
which must hold the bytes of one code point (4).

Cases: null and empty texts give no part. Texts up to the limit stay one part. Only the text's own columns are used, so
names of other columns can't clash. Rows with the same id are cut each.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotaloom.llm.bpe import Encoder, broadcast_ranks, worker_encoder
from quotaloom.workspace import spread_small

KINDS = ("paragraph", "line", "sentence", "word", "edge", "inside", "end")
PARAGRAPH, LINE, SENTENCE, WORD, EDGE, INSIDE, END = range(7)
PENALTY = np.array([0.0, 0.5, 1.0, 20.0, 400.0, 8000.0, 0.0])
START = np.array([0.0, 0.0, 0.0, 1.0, 4.0, 30.0, 0.0])
PART, BALANCE, SHIFT = 5.0, 4.0, 4.0
_BREAKS = regex.compile(r"\r\n|[\n\r\x0b\x0c\x85  ]")
GAP = ""  # between two texts
_STOP = regex.compile(r"[.!?…。！？।][\"'”’»)\]]*$")


class _Pieces(dict):
    """Numbers of the distinct pieces of the pattern, and per number its tokens, length and what matters for boundaries."""

    TOKENS, LENGTH, BLANK, LEAD, BREAKS, RETURN, FEED, STOP, WIDE = range(9)

    def __init__(self, enc: Encoder) -> None:
        self.enc = enc
        self.facts = np.zeros((9, 1024), np.int64)
        self.chars = 0

    def __missing__(self, piece: str) -> int:
        if len(self) == self.facts.shape[1]:
            self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)], axis=1)
        k = self[piece] = len(self)
        self.chars += len(piece)
        if not piece:
            return k
        blank = piece.isspace()
        self.facts[:, k] = (
            len(self.enc.cache[piece]), len(piece), blank, not blank and piece[0].isspace(), len(_BREAKS.findall(piece)), piece[-1] == "\r", piece[0] == "\n",
            not blank and bool(_STOP.search(piece)), ord(piece[-1]) > 0x2FFF,
        )
        return k


_PIECES: dict[int, _Pieces] = {}
_MAX_PIECES, _MAX_CHARS = 1 << 18, 1 << 24


def _table(enc: Encoder) -> _Pieces:
    """The table of distinct pieces; a cache only, dropped when it grows beyond a bound."""
    table = _PIECES.get(id(enc))
    if table is None or len(table) > _MAX_PIECES or table.chars > _MAX_CHARS:
        table = _PIECES[id(enc)] = _Pieces(enc)
    return table


def boundary_kinds(facts: np.ndarray) -> np.ndarray:
    """How natural a cut before each piece but the first is, from the facts of the pieces.

    A line end belongs to the part before it: a cut with one behind it is a word's. Closing signs stand in one piece with
    their stop, so a stop is a fact of the last piece that isn't blank.
    """
    blank, lead, stop, wide = (facts[k].astype(bool) for k in (_Pieces.BLANK, _Pieces.LEAD, _Pieces.STOP, _Pieces.WIDE))
    n = facts.shape[1]
    torn = np.zeros(n, bool)  # a line feed that ends the line of the return before it
    torn[1:] = (facts[_Pieces.RETURN, :-1] > 0) & (facts[_Pieces.FEED, 1:] > 0) & blank[1:] & blank[:-1]
    run = np.concatenate([[0], np.cumsum(facts[_Pieces.BREAKS] * blank - torn)])  # line ends up to each boundary
    at = np.arange(n)
    full = np.where(blank, -1, at)
    before = np.maximum.accumulate(full)[:-1]  # the last piece before each boundary that isn't blank
    after = np.where(blank, n, at)
    after = np.minimum.accumulate(after[::-1])[::-1][1:]
    here = run[1:-1]
    gone, ahead = here - run[before + 1], run[np.minimum(after, n)] - here
    stopped = (before >= 0) & stop[np.maximum(before, 0)]
    spaced = blank[:-1] | blank[1:] | lead[1:]
    plain = np.where(spaced, np.where(stopped, SENTENCE, WORD), np.where(stopped & wide[:-1], SENTENCE, EDGE))
    out = np.where(ahead > 0, WORD, np.where(gone > 1, PARAGRAPH, np.where(gone == 1, LINE, plain)))
    return np.where(torn[1:], INSIDE, out)


def _small(piece: str, enc: Encoder, unit: int) -> list[tuple[int, int]]:
    """(length, tokens) of stretches of a piece with at most ``unit`` tokens or one code point, by halving."""
    n = len(enc.encode(piece))
    if n <= unit or len(piece) == 1:
        return [(len(piece), n)]
    parts = min(len(piece), -(-2 * n // unit))
    step = -(-len(piece) // parts)
    return [x for k in range(0, len(piece), step) for x in _small(piece[k : k + step], enc, unit)]


@dataclass
class _Doc:
    """Boundaries of a text: their places, the tokens up to each, their kinds; whether pieces were cut."""

    place: np.ndarray
    total: np.ndarray
    kinds: np.ndarray
    cut: bool = False


def _doc(pieces: list[str], lengths: np.ndarray, sizes: np.ndarray, kinds: np.ndarray, enc: Encoder, unit: int) -> _Doc:
    large = (sizes > unit) & (lengths > 1)
    cut = bool(large.any())
    if cut:
        got = [(_small(p, enc, unit) if x else [(m, n)]) for p, x, m, n in zip(pieces, large.tolist(), lengths.tolist(), sizes.tolist())]
        lengths, sizes = (np.array([x[j] for g in got for x in g], np.int64) for j in range(2))
        inner = np.full(len(lengths) - 1, INSIDE)
        inner[np.cumsum([len(g) for g in got])[:-1] - 1] = kinds
        kinds = inner
    ends = np.array([END])
    return _Doc(np.append(0, np.cumsum(lengths)), np.append(0, np.cumsum(sizes)), np.concatenate([ends, kinds, ends]), cut)


def _nearest(at: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Index of the value of the sorted ``at`` nearest to each wanted one; the lower of two."""
    if len(at) < 2:
        return np.zeros(len(want), np.int64)
    k = np.clip(at.searchsorted(want), 1, len(at) - 1)
    return k - (want - at[k - 1] <= at[k] - want)


def _starts(total: np.ndarray, kinds: np.ndarray, ends: np.ndarray, overlap: int) -> np.ndarray:
    """The boundaries where parts may start: all at sentences or better, and for every end the word's start nearest to ``overlap``
    tokens before it, or any boundary if no word starts within half the overlap of that; besides, the starts of texts."""
    want = total[ends] - overlap
    words = np.flatnonzero(kinds <= WORD)
    offered = _nearest(total, want)
    if len(words):
        word = words[_nearest(total[words], want)]
        offered = np.where(2 * np.abs(total[word] - want) <= overlap, word, offered)
    some = np.zeros(len(total), bool)
    some[offered] = True
    return np.flatnonzero(some | (kinds <= SENTENCE) | (kinds == END))


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of all ranges, where each range begins among them); no range may be empty."""
    n = last - first
    at = np.cumsum(n) - n
    return np.arange(n.sum()) - np.repeat(at - first, n), at


def _least(m: np.ndarray, at: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least value of each segment, the first of ``of`` that has it)."""
    low = np.minimum.reduceat(m, at)
    hit = np.flatnonzero(m == np.repeat(low, np.diff(np.append(at, len(m)))))
    return low, of[hit[hit.searchsorted(at)]]


def _programme(docs: list[_Doc], level: int, limit: int, overlap: int) -> list[tuple[float, list[tuple[int, int]]]]:
    """(cost, (start, end) in boundaries) of each text's best plan with its inner ends of ``level`` or better; inf if there is none.

    The texts lie on one axis of tokens, further apart than the limit. A part has more tokens than half the limit, and a start lies at
    most ``high`` tokens before an end. So with steps of half the limit less ``high`` tokens, the starts of a step depend on ends of
    earlier steps only, and its ends on starts up to it: a step is decided at once, for all texts.
    """
    low, high, least = overlap // 2, overlap + overlap // 2, limit // 2
    step, scale, shift = least - high, BALANCE / limit**2, SHIFT / max(overlap, 1) ** 2
    size = np.array([len(d.total) for d in docs])
    text = np.repeat(np.arange(len(docs)), size)
    head = np.cumsum(size) - size
    whole = np.array([d.total[-1] for d in docs])
    base = np.cumsum(whole + limit + 1) - whole - limit - 1
    kinds, total = np.concatenate([d.kinds for d in docs]), np.concatenate([d.total for d in docs]) + base[text]
    final = head + size - 1
    is_end = kinds <= level
    is_end[final] = True
    ends = np.flatnonzero(is_end)
    starts = _starts(total, kinds, ends, overlap)
    te, ts = total[ends], total[starts]
    fair = _fair(whole, _fewest(whole, limit, overlap), overlap)[text[ends]]
    best, from_start = np.full(len(ends), np.inf), np.full(len(ends), -1)
    f, from_end = np.full(len(starts), np.inf), np.full(len(starts), -1)
    f[starts.searchsorted(head)] = 0.0
    own, begin = PENALTY[kinds[ends]] + PART, START[kinds[starts]]
    a, b = ts.searchsorted(te - limit), ts.searchsorted(te - least)
    c, d = te.searchsorted(ts + low), te.searchsorted(ts + high, "right")
    end_step = np.where(b > a, (te - base[text[ends]] - least - 1) // step, -1)
    start_step = np.where(d > c, (ts - base[text[starts]] + high - least - 1) // step + 1, -1)
    by_end, by_start = np.argsort(end_step, kind="stable"), np.argsort(start_step, kind="stable")
    grid = np.arange(int(end_step.max()) + 2)
    end_at, start_at = end_step[by_end].searchsorted(grid), start_step[by_start].searchsorted(grid)
    for j in grid[:-1].tolist():
        s = by_start[start_at[j] : start_at[j + 1]]
        if len(s):
            pair, at = _ranges(c[s], d[s])
            n = d[s] - c[s]
            m = best[pair] + shift * (te[pair] - np.repeat(ts[s] + overlap, n)) ** 2
            got, from_ = _least(m, at, pair)
            got = got + begin[s]
            better = got < f[s]
            f[s[better]], from_end[s[better]] = got[better], from_[better]
        e = by_end[end_at[j] : end_at[j + 1]]
        if len(e):
            pair, at = _ranges(a[e], b[e])
            n = b[e] - a[e]
            m = f[pair] + scale * (np.repeat(te[e] - fair[e], n) - ts[pair]) ** 2
            got, from_start[e] = _least(m, at, pair)
            best[e] = got + own[e]
    out = []
    for k, h, cost in zip(ends.searchsorted(final).tolist(), head.tolist(), best[ends.searchsorted(final)].tolist()):
        plan = []
        while np.isfinite(cost):
            s = int(from_start[k])
            plan.append((int(starts[s]) - h, int(ends[k]) - h))
            if plan[-1][0] == 0:
                break
            k = int(from_end[s])
        out.append((cost, plan[::-1]))
    return out


def _fewest(whole, limit: int, overlap: int):
    """The fewest parts for so many tokens."""
    return np.maximum(2, -(-(whole - overlap // 2) // (limit - overlap // 2)))


def _fair(whole, parts, overlap: int):
    return (whole + overlap * (parts - 1)) / parts


MAX_PAIRS = 1 << 20


def best_plans(docs: list[_Doc], limit: int, overlap: int) -> list[list[tuple[int, int]]]:
    """(start, end) in boundaries of the parts of each text's best plan of all; empty if there is no plan within the limit."""
    best, plans, open_ = [np.inf] * len(docs), [[] for _ in docs], list(range(len(docs)))
    for level in (SENTENCE, WORD, EDGE, INSIDE):
        left, group, pairs = [], [], 0.0
        for k in [*open_, None]:
            if k is not None:
                share = limit / float(docs[k].total[-1])
                pairs += ((docs[k].kinds <= max(level, WORD)).sum() * share / 2) * ((docs[k].kinds <= level).sum() + 1) * share  # of one step, about
            if group and (k is None or pairs > MAX_PAIRS):
                for g, (cost, plan) in zip(group, _programme([docs[g] for g in group], level, limit, overlap)):
                    if cost < best[g]:
                        best[g], plans[g] = cost, plan
                    if level < INSIDE and best[g] > _fewest(int(docs[g].total[-1]), limit, overlap) * PART + PENALTY[level + 1]:
                        left.append(g)
                group, pairs = [], 0.0
            group.append(k)
        open_ = left
        if not open_:
            break
    return plans


def _size(text: str, place: list[int], total: np.ndarray, s: int, e: int, enc: Encoder) -> int:
    """Tokens of a part. Blanks at its end form one piece there, but may be two pieces within the text."""
    end = a = place[e]
    while a > place[s] and text[a - 1].isspace():
        a -= 1
    if a == end:
        return int(total[e] - total[s])
    k = bisect_left(place, a)
    return int(total[k] - total[s]) + len(enc.encode(text[a:end])) if place[k] == a else len(enc.encode(text[place[s] : end]))


def _longest(text: str, enc: Encoder, limit: int, overlap: int) -> list[tuple[int, int, int, int, int]]:
    """Parts that each take the most code points that fit when encoded; the way out if no plan is found."""
    out, s, before = [], 0, 0
    while True:
        low, high = max(s, before) + 1, len(text)
        e, n = low, len(enc.encode(text[s:low]))
        while low <= high:
            mid = (low + high) // 2
            size = len(enc.encode(text[s:mid]))
            low, high = (mid + 1, high) if size <= limit else (low, mid - 1)
            if size <= limit and mid > e:
                e, n = mid, size
        out.append((s, e, n, len(enc.encode(text[s:before])), END if e == len(text) else INSIDE))
        if e == len(text):
            return out
        before = s = e
        while overlap and s > out[-1][0] + 1 and len(enc.encode(text[s - 1 : e])) <= min(overlap, limit - 8):
            s -= 1


def split_texts(texts: list[str | None], enc: Encoder, limit: int = 512, overlap: int = 64) -> list[list[tuple[int, int, int, int, int]]]:
    """For each text the (start, end, tokens, tokens shared with the part before, kind of the end) of its parts; places in code points."""
    out: list[list[tuple[int, int, int, int, int]]] = [[] for _ in texts]
    table, large, numbers = _table(enc), [], []
    gap = np.array([table[GAP]])
    for i, text in enumerate(texts):
        if not text:
            continue
        pieces = enc.pieces(text)
        at = np.fromiter(map(table.__getitem__, pieces), np.int64, len(pieces))
        whole = int(table.facts[_Pieces.TOKENS][at].sum())
        if whole <= limit:
            out[i] = [(0, len(text), whole, 0, END)]
        else:
            large.append((i, pieces))
            numbers += [at, gap]
    if not large:
        return out
    facts = table.facts[:, np.concatenate(numbers)]
    kinds, unit, docs, at = boundary_kinds(facts), max(1, min(limit // 8, overlap or limit)), [], 0
    for _, pieces in large:
        to = at + len(pieces)
        docs.append(_doc(pieces, facts[_Pieces.LENGTH, at:to], facts[_Pieces.TOKENS, at:to], kinds[at : to - 1], enc, unit))
        at = to + 1
    for (i, _), doc, plan in zip(large, docs, best_plans(docs, limit, overlap)):
        out[i] = _checked(texts[i], doc, plan, enc, limit, overlap, unit)
    return out


def _checked(text: str, doc: _Doc, plan: list[tuple[int, int]], enc: Encoder, limit: int, overlap: int, unit: int) -> list[tuple[int, int, int, int, int]]:
    """The parts of a plan with their sizes; planned anew with a lower limit while a part is above it."""
    place, total, kinds, bound = doc.place.tolist(), doc.total, doc.kinds, limit
    while plan:
        sizes = [len(enc.encode(text[place[s] : place[e]])) if doc.cut else _size(text, place, total, s, e, enc) for s, e in plan]
        if max(sizes) <= limit:
            shared = [0, *(int(total[a[1]] - total[b[0]]) for a, b in zip(plan, plan[1:]))]
            return [(place[s], place[e], n, x, int(kinds[e])) for (s, e), n, x in zip(plan, sizes, shared)]
        bound -= max(1, max(sizes) - limit)
        plan = best_plans([doc], bound, overlap)[0] if bound // 2 > overlap + overlap // 2 + unit else []
    return _longest(text, enc, limit, overlap)


def split_text(text: str, enc: Encoder, limit: int = 512, overlap: int = 64) -> list[tuple[int, int, int, int, int]]:
    return split_texts([text], enc, limit, overlap)[0]


def split_corpus(df: DataFrame, *, id_col: str, text_col: str, rank_path: str, limit: int = 512, overlap: int = 64, rows_per_batch: int = 500) -> DataFrame:
    """(id_col, piece_no, n_tokens, shared, cut, start, end, text): parts from 0 on, start and end in code points of the text,
    ``shared`` tokens with the part before, ``cut`` the kind of boundary at the end."""
    file = broadcast_ranks(df.sparkSession, rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(file.value)
        names = [id_col, "piece_no", "n_tokens", "shared", "cut", "start", "end", "text"]
        for b in batches:
            for at in range(0, b.num_rows, rows_per_batch):
                part = b.slice(at, rows_per_batch)
                owner, rows = [], []
                texts = part.column(1).to_pylist()
                for i, (t, parts) in enumerate(zip(texts, split_texts(texts, enc, limit, overlap))):
                    owner += [i] * len(parts)
                    rows += [(k, n, x, KINDS[kind], s, e, t[s:e]) for k, (s, e, n, x, kind) in enumerate(parts)]
                cols = list(zip(*rows)) if rows else [()] * 7
                arrays = [pa.array(cols[i], pa.string() if i in (3, 6) else pa.int32()) for i in range(7)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner, pa.int64())), *arrays], names=names)

    kind = df.schema[id_col].dataType.simpleString()
    return spread_small(df.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, piece_no int, n_tokens int, shared int, cut string, start int, `end` int, text string")


def promises(parts: DataFrame, *, id_col: str, limit: int, overlap: int) -> DataFrame:
    """(id_col, covered, digest, fits, overlaps, natural) per text, from its parts alone.

    covered: code points covered without a gap; digest: MD5 of the text put together again from what each part adds; fits: all
    parts within the limit; overlaps: all shared stretches of half to one and a half times the overlap; natural: each end named
    paragraph or line follows a line end, and each named sentence or word has a blank or a wide stop at it.
    """
    w = Window.partitionBy(id_col).orderBy("piece_no")
    p = parts.withColumn("_before", F.coalesce(F.lag("end").over(w), F.lit(0))).withColumn("_next", F.lead("start").over(w))
    new = F.substring("text", F.col("_before") - F.col("start") + 1, F.length("text"))
    ends, starts = F.regexp_extract("text", r"(?U)(\s*)$", 1), F.lead("text").over(w)
    p = p.withColumns({"_new": new, "_blanks": ends, "_then": F.substring(starts, F.col("end") - F.col("_next") + 1, F.lit(1))})
    blank = (F.col("_blanks") != "") | F.col("_then").rlike(r"(?U)^\s") | F.col("text").rlike(r"[。！？।][\"'”’»)\]]*$")
    natural = F.when(F.col("cut").isin("paragraph", "line"), F.col("_blanks").rlike(r"[\n\r\x0b\x0c\x{85}\x{2028}\x{2029}]")).when(F.col("cut").isin("sentence", "word"), blank).otherwise(True)
    shared = (F.col("piece_no") == 0) | F.col("shared").between(overlap // 2, overlap + overlap // 2)
    g = p.groupBy(id_col).agg(
        F.sum(F.length("_new")).alias("covered"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", "_new"))), lambda x: x["_new"]), "").cast("binary")).alias("digest"),
        F.bool_and(F.col("n_tokens") <= limit).alias("fits"), F.bool_and(shared).alias("overlaps"), F.bool_and(natural).alias("natural"),
    )
    return g
