"""Evaluation passages in training text, by a positional inverted index (problem 8).

One pass over the corpus stores the index: for every evaluation term its postings (document, position), cut into segments by
the tasks that read the documents and into buckets of terms on disk. Terms of no evaluation item can't be searched for and aren't
stored. Counts over the whole corpus come from the index.

A search reads the postings of anchor terms only: of every window of ``run`` consecutive item words, the ``ANCHORS`` rarest
positions. Each posting is shifted by its place in the item, and the lists are intersected: a document position less an item position is a diagonal,
and a window can only match on a diagonal on which all its anchors have a posting. The documents with such diagonals, and no others, are
then read again, and the diagonals compared word by word, which gives the exact longest run. Every match of ``run`` words has
all its anchors on its diagonal, so none is lost.

Proximity has anchors of its own. A diagonal with enough equal words misses at most m of an item's words, those that occur
nowhere in the corpus always; so of the m + ``HITS`` rarest positions that do occur, ``HITS`` are on it. None of these is lost either.
Aligned are words on one diagonal: an inserted or left out word ends it, and the parts before and after it count each by itself.

Cases: null and empty texts match nothing; items of fewer than ``run`` words match no phrase; repeated documents and items
with shared passages come out each. Words are those of ``quotaloom.functions.words``. The evaluation items must fit the driver,
which is checked against ``MAX_ITEM_WORDS`` before they are read; beyond it, search in blocks of items and unite the results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quotaloom.functions.words import words
from quotaloom.workspace import cut, new_path, spread_small

ANCHORS, HITS = 3, 2
BUCKETS = 16
MAX_POSTINGS = 4_000_000
CHECKED = 50_000
MAX_ITEM_WORDS = 20_000_000


class _Vocabulary:
    """The evaluation terms and, for a batch of texts' words, the flat array of their numbers."""

    def __init__(self, terms: list[str]) -> None:
        self.terms = pa.array(terms, pa.string())

    def numbers(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, -1 for other words and one -1 after each text; start of each text in it)."""
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(lengths + 1)])
        flat = np.full(at[-1], -1, np.int64)
        found = pc.fill_null(pc.index_in(lists.flatten(), value_set=self.terms), -1).to_numpy(zero_copy_only=False)
        keep = np.ones(at[-1], bool)
        keep[at[1:] - 1] = False
        flat[keep] = found
        return flat, at[:-1]


def positional_index(docs: DataFrame, *, doc_id: str, text: str, terms: list[str], path: str) -> DataFrame:
    """(bucket, segment, term, n, docs, positions) written to ``path``: for each segment of documents and each term the n places, in
    parallel lists; ``term`` is its number in ``terms``. A segment is one Arrow batch of whole documents, so a list never outgrows one."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(terms)
    kind = to_arrow_type(docs.schema[doc_id].dataType)
    names = ["bucket", "segment", "term", "n", "docs", "positions"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, task = _Vocabulary(vocabulary.value), TaskContext.get().partitionId()
        for k, b in enumerate(batches):
            flat, begins = voc.numbers(b.column(1))
            at = np.flatnonzero(flat >= 0)
            term = flat[at]
            at = at[np.argsort(term, kind="stable")]
            term = flat[at]
            first = np.flatnonzero(np.diff(term, prepend=-1))
            ends = pa.array(np.append(first, len(at)).astype(np.int32))
            doc = np.searchsorted(begins, at, "right") - 1
            own = term[first]
            cols = [
                pa.array((own % BUCKETS).astype(np.int32)), pa.array(np.full(len(own), task << 32 | k)), pa.array(own.astype(np.int32)), pa.array(np.diff(np.append(first, len(at)))),
                pa.ListArray.from_arrays(ends, b.column(0).take(pa.array(doc)).cast(kind)), pa.ListArray.from_arrays(ends, pa.array((at - begins[doc]).astype(np.int32))),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"bucket int, segment long, term int, n long, docs array<{docs.schema[doc_id].dataType.simpleString()}>, positions array<int>"
    segments = docs.select(doc_id, words(F.col(text)).alias("w")).mapInArrow(run, schema)
    segments.write.partitionBy("bucket").parquet(path)
    return docs.sparkSession.read.schema(segments.schema).parquet(path)


def term_counts(index: DataFrame, terms: int) -> np.ndarray:
    """How often each term occurs in the whole corpus: one row per evaluation term."""
    got = index.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(terms, np.int64)
    out[got.column("term").to_numpy()] = got.column("n").to_numpy()
    return out


def anchor_positions(item: list[int], counts: np.ndarray, run: int) -> list[int]:
    """The positions that are among the ``ANCHORS`` rarest of some window of ``run`` words whose words all occur."""
    out: set[int] = set()
    n = [int(counts[t]) for t in item]
    for s in range(len(item) - run + 1):
        window = range(s, s + run)
        if min(n[q] for q in window) > 0:
            out.update(sorted(window, key=lambda q: (n[q], item[q], q))[:ANCHORS])
    return sorted(out)


def proximity_positions(item: list[int], counts: np.ndarray, run: int, near: float) -> tuple[list[int], int]:
    """(positions, least hits): every diagonal with enough equal words has so many of the positions on it."""
    there = sorted((q for q in range(len(item)) if counts[item[q]]), key=lambda q: (int(counts[item[q]]), item[q], q))
    misses = len(there) - max(run, math.ceil(near * len(item)))
    if misses < 0:
        return [], 1
    hits = min(HITS, len(there) - misses)
    return sorted(there[: misses + hits]), hits


class _Anchors:
    """Anchors (item, position, term) in the order of their terms, and how many of an item's must be on a diagonal."""

    def __init__(self, anchors: list[tuple[int, int, int]], hits: list[int]) -> None:
        anchors = sorted(anchors, key=lambda a: a[2])
        self.item, self.pos, self.term = (np.array([a[j] for a in anchors], np.int64) for j in range(3))
        self.hits = np.array(hits, np.int64)

    def keys(self, term: np.ndarray, doc: np.ndarray, pos: np.ndarray, width: int, longest: int) -> np.ndarray:
        """(item * documents + doc) * width + diagonal + longest of the postings' diagonals with enough anchors on them."""
        first, last = (self.term.searchsorted(term, side) for side in ("left", "right"))
        n = last - first
        which = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - first, n)
        docs = int(doc.max(initial=0)) + 1
        key = (self.item[which] * docs + np.repeat(doc, n)) * width + np.repeat(pos, n) - self.pos[which] + longest
        uniq, hits = np.unique(key, return_counts=True)  # one posting for each anchor position: the intersection's size
        return uniq[hits >= self.hits[uniq // (width * docs)]]


def _diagonals(index: DataFrame, anchors: list[_Anchors], longest: int) -> DataFrame:
    """(doc, item, diagonal) on which an item has enough anchors of one kind. A segment holds whole documents, so its lists are
    intersected on their own; only the postings of anchor terms are read and brought together by segment."""
    spark = index.sparkSession
    used = np.unique(np.concatenate([a.term for a in anchors]))
    shared = spark.sparkContext.broadcast(anchors)
    kind = to_arrow_type(index.schema["docs"].dataType.elementType)

    def run(segment: pa.Table) -> pa.Table:
        lists = segment.column("docs").combine_chunks()
        names = lists.flatten().dictionary_encode()
        doc, pos = names.indices.to_numpy().astype(np.int64), segment.column("positions").combine_chunks().flatten().to_numpy().astype(np.int64)
        term = np.repeat(segment.column("term").to_numpy().astype(np.int64), pc.list_value_length(lists).to_numpy())
        order = np.argsort(doc, kind="stable")
        doc, pos, term = doc[order], pos[order], term[order]
        width = int(pos.max(initial=0)) + 2 * longest + 1
        load = np.cumsum(sum(a.term.searchsorted(term, "right") - a.term.searchsorted(term) for a in shared.value))
        docs, cols, at = int(doc.max(initial=0)) + 1, [], 0
        while at < len(doc):  # whole documents with at most MAX_POSTINGS shifted postings, or one document
            to = int(load.searchsorted((load[at - 1] if at else 0) + MAX_POSTINGS, "right"))
            to = int(doc.searchsorted(doc[to])) if to < len(doc) else len(doc)
            to = to if to > at else int(doc.searchsorted(doc[at], "right"))
            part = slice(at, to)
            base = int(doc[at])
            own = int(doc[to - 1]) - base + 1
            for a in shared.value:
                if len(a.item):
                    key = a.keys(term[part], doc[part] - base, pos[part], width, longest)
                    rest, diagonal = np.divmod(key, width)
                    item, d = np.divmod(rest, own)
                    cols.append((d + base, item, diagonal - longest))
            at = to
        d, item, diagonal = (np.concatenate([c[j] for c in cols]) if cols else np.zeros(0, np.int64) for j in range(3))
        arrays = [names.dictionary.take(pa.array(d)).cast(kind), pa.array(item.astype(np.int32)), pa.array(diagonal.astype(np.int32))]
        return pa.Table.from_arrays(arrays, names=["doc", "item", "diagonal"])

    some = index.filter(F.col("bucket").isin(sorted({int(t) % BUCKETS for t in used})))
    wanted = spark.createDataFrame(pa.table({"term": pa.array(used.astype(np.int32))}), "term int")  # at most one row per evaluation word
    some = some.join(wanted, "term", "left_semi").select("segment", "term", "docs", "positions")
    found = some.groupBy("segment").applyInArrow(run, f"doc {index.schema['docs'].dataType.elementType.simpleString()}, item int, diagonal int")
    return found.distinct() if len(anchors) > 1 else found


def _compared(flat, starts, wanted, begin, size, row, item, diagonal, run: int, least: float) -> tuple[np.ndarray, ...]:
    """(row, item, longest run, equal words, its place in document and item) of the diagonals that match, all compared at once.

    ``flat`` holds the words of all rows, with a -1 after each row; ``wanted`` those of all items, item k from ``begin[k]`` on.
    """
    ends = np.append(starts[1:], len(flat)) - 1
    lo = np.maximum(0, -diagonal)
    n = np.maximum(np.minimum(size[item], (ends - starts)[row] - diagonal) - lo, 0)
    which = np.repeat(np.arange(len(row)), n + 1)  # one more place for each diagonal, where any run ends
    first = np.cumsum(n + 1) - n - 1
    k = np.arange(len(which)) - first[which]
    q = lo[which] + k
    inside = k < n[which]
    equal = np.zeros(len(which), bool)
    w, at = which[inside], q[inside]
    equal[inside] = flat[starts[row[w]] + diagonal[w] + at] == wanted[begin[item[w]] + at]
    place = np.arange(len(which))
    length = place - np.maximum.accumulate(np.where(equal, -1, place))  # of the run up to each place
    if not len(which):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    aligned, best = np.add.reduceat(equal.astype(np.int64), first), np.maximum.reduceat(length, first)
    keep = np.flatnonzero((best >= run) | (aligned >= np.maximum(run, least * size[item])))
    hit = np.flatnonzero(length == np.repeat(best, n + 1))
    start = q[hit[hit.searchsorted(first[keep])]] - best[keep] + 1
    return row[keep], item[keep], best[keep], aligned[keep], start + diagonal[keep], start


def find_leaks(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", run: int = 12, near: float | None = 0.8) -> DataFrame:
    """(doc_id, item_id, run, aligned, doc_pos, item_pos), one row per document, item and diagonal.

    ``run`` is the longest stretch of equal words and ``aligned`` the number of equal words on the diagonal. Rows have
    either run >= ``run`` (an exact phrase) or at least ``run`` aligned words that make up ``near`` of the item (proximity); without
    ``near``, exact phrases only are looked for.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col(item_id).alias("i"), words(F.col(item_text)).alias("w")).filter(F.col("i").isNotNull() & (F.size("w") > 0))
    if (wanted.agg(F.sum(F.size("w"))).first()[0] or 0) > MAX_ITEM_WORDS:
        raise ValueError("too many evaluation words for one search; search in blocks of items")
    rows = wanted.collect()
    terms = sorted({x for _, w in rows for x in w})
    number = {t: i for i, t in enumerate(terms)}
    coded = [(i, [number[x] for x in w]) for i, w in rows]
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    index = positional_index(spread_small(docs), doc_id="doc_id", text="text", terms=terms, path=new_path(spark, "index"))
    counts = term_counts(index, len(terms))
    anchors = [_Anchors([(k, q, w[q]) for k, (_, w) in enumerate(coded) for q in anchor_positions(w, counts, run)], [ANCHORS] * len(coded))]
    if near is not None:
        close = [proximity_positions(w, counts, run, near) for _, w in coded]
        anchors.append(_Anchors([(k, q, w[q]) for k, (_, w) in enumerate(coded) for q in close[k][0]], [h for _, h in close]))
    found = _diagonals(index, anchors, max((len(w) for _, w in coded), default=0))
    per_doc = cut(found.groupBy("doc").agg(F.collect_list("item").alias("items"), F.collect_list("diagonal").alias("diagonals")), "diagonals")
    shared = spark.sparkContext.broadcast((terms, coded))
    least = near if near is not None else float("inf")
    kinds = (docs.schema["doc_id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString())
    item_kind = to_arrow_type(items.schema[item_id].dataType)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, coded = shared.value
        voc, ids = _Vocabulary(terms), pa.array([i for i, _ in coded], item_kind)
        size = np.array([len(w) for _, w in coded], np.int64)
        begin, wanted = np.cumsum(size) - size, np.array([x for _, w in coded for x in w], np.int64)
        for b in batches:
            flat, starts = voc.numbers(b.column(1))
            row = np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column(2)).to_numpy())
            item, diagonal = (b.column(j).flatten().to_numpy().astype(np.int64) for j in (2, 3))
            for at in range(0, len(row), CHECKED):
                part = slice(at, at + CHECKED)
                got = _compared(flat, starts, wanted, begin, size, row[part], item[part], diagonal[part], run, least)
                if len(got[0]):
                    cols = [b.column(0).take(pa.array(got[0])), ids.take(pa.array(got[1]))] + [pa.array(x.astype(np.int32)) for x in got[2:]]
                    yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "item_id", "run", "aligned", "doc_pos", "item_pos"])

    suspects = docs.join(per_doc, F.col("doc_id").eqNullSafe(F.col("doc"))).select("doc_id", words(F.col("text")).alias("w"), "items", "diagonals")
    return suspects.mapInArrow(verify, "doc_id {}, item_id {}, run int, aligned int, doc_pos int, item_pos int".format(*kinds))
