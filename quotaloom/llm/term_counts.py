"""Frequency of every distinct value or term, by last-seen counters (problem 3).

Rows are hash-partitioned by their record and ordered by it, so each partition streams its tokens record by record. Each
term of a partition has one counter: occurrences, records, and the last record that was counted. A token raises the
occurrences always and the records only if its record isn't the last one seen, so no set of records is kept for any
term. As the partitions hold disjoint records, adding their counters by term gives exact totals; a term that a third of
all records have is thereby spread over all partitions and reaches the second shuffle as one counter per partition.

A record delivered again (same record, later rows) is seen by the same comparison and skipped whole.

Cases: null values and empty terms don't count; values are compared exactly as written; a null record id is left out;
an empty table gives an empty result. Columns of other names are dropped first, so clashes can't happen. A partition holds
at most ``MAX_TERMS`` counters of a field and one batch's; beyond that it hands on what it has, and starts anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotaloom.workspace import cut

MAX_TERMS = 1 << 20
SCHEMA = "field string, value string, occurrences long, records long"
TOTAL = "\x00records"


class _Counters:
    """One field's counters: slots of (occurrences, records, last record)."""

    def __init__(self) -> None:
        self.slot: dict[str, int] = {}
        self.occ = np.zeros(1024, np.int64)
        self.rec = np.zeros(1024, np.int64)
        self.last = np.full(1024, -1, np.int64)

    def add(self, tokens: pa.Array, record: np.ndarray) -> None:
        """Tokens in record order, with the ordinal of each token's record."""
        if not len(tokens):
            return
        enc = tokens.dictionary_encode()
        names = enc.dictionary.to_pylist()
        slots = np.fromiter((self.slot.setdefault(n, len(self.slot)) for n in names), np.int64, len(names))
        while len(self.slot) > len(self.occ):
            n = len(self.occ)
            self.occ, self.rec = (np.concatenate([a, np.zeros(n, np.int64)]) for a in (self.occ, self.rec))
            self.last = np.concatenate([self.last, np.full(n, -1, np.int64)])
        code = enc.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        code, record = code[order], record[order]
        first = np.empty(len(code), bool)
        first[0] = True
        first[1:] = code[1:] != code[:-1]
        seen_before = np.empty(len(code), np.int64)  # the record last seen by the counter when each token arrives
        seen_before[1:] = record[:-1]
        seen_before[first] = self.last[slots[code[first]]]
        n = len(names)
        self.occ[slots] += np.bincount(code, minlength=n)
        self.rec[slots] += np.bincount(code[record != seen_before], minlength=n)
        end = np.append(np.flatnonzero(first)[1:], len(code)) - 1
        self.last[slots[code[end]]] = record[end]


def _stream(values: list[str], multi: dict[str, str]):
    fields = [*values, *multi]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = {f: _Counters() for f in fields}
        records, last = 0, None
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0)
            new = np.empty(b.num_rows, bool)
            new[0] = ids[0].as_py() != last
            if b.num_rows > 1:
                new[1:] = pc.not_equal(ids.slice(1), ids.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
            last = ids[b.num_rows - 1].as_py()
            at = records + np.cumsum(new) - 1
            records += int(new.sum())
            for k, f in enumerate(fields, start=1):
                col = b.column(k)
                keep = new & pc.is_valid(col).to_numpy(zero_copy_only=False)
                tokens, owner = col.filter(pa.array(keep)), at[keep]
                if f in multi:
                    parts = pc.split_pattern(tokens, multi[f])
                    owner = np.repeat(owner, pc.list_value_length(parts).to_numpy(zero_copy_only=False))
                    tokens = parts.flatten()
                some = pc.not_equal(tokens, "").to_numpy(zero_copy_only=False)
                counters[f].add(tokens.filter(pa.array(some)), owner[some])
            for f in fields:  # a record's tokens lie in one row, so counters may start anew between batches
                if len(counters[f].slot) > MAX_TERMS:
                    yield from given(f, counters[f])
                    counters[f] = _Counters()
        if records:
            yield pa.RecordBatch.from_arrays([pa.array([TOTAL]), pa.array([""]), pa.array([records]), pa.array([records])], names=["field", "value", "occurrences", "records"])
        for f, c in counters.items():
            yield from given(f, c)

    def given(f: str, c: _Counters) -> Iterator[pa.RecordBatch]:
        names = list(c.slot)
        for i in range(0, len(names), 20_000):
            part = names[i : i + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f] * len(part)), pa.array(part, pa.string()), pa.array(c.occ[i : i + len(part)]), pa.array(c.rec[i : i + len(part)])],
                names=["field", "value", "occurrences", "records"],
            )

    return run


def term_frequencies(df: DataFrame, *, record: str, values: list[str] = (), multi: dict[str, str] | None = None, order: str | None = None) -> DataFrame:
    """(field, value, occurrences, records): ``values`` are columns of one value, ``multi`` maps columns to separators.

    One more row, field ``TOTAL``, holds the number of records. Of a record's repeated rows the first by ``order`` counts.
    """
    multi = dict(multi or {})
    fields = [*values, *multi]
    rows = df.select(F.col(record).cast("string").alias("_r"), *[F.col(f).cast("string").alias(f"_v{i}") for i, f in enumerate(fields)], *([F.col(order).alias("_o")] if order else []))
    rows = rows.filter(F.col("_r").isNotNull()).repartition(F.col("_r")).sortWithinPartitions("_r", *(["_o"] if order else [])).drop("_o")
    partial = rows.mapInArrow(_stream(list(values), multi), SCHEMA)
    return partial.groupBy("field", "value").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))


def marked_terms(df: DataFrame, *, record: str, values: list[str] = (), multi: dict[str, str] | None = None, order: str | None = None, rare_below: int = 3, common_above: dict[str, float]) -> DataFrame:
    """(field, value, occurrences, records, mark): mark is ``rare`` below ``rare_below`` records, else ``common`` if more
    than the field's share of all records have the term, else null."""
    counts = cut(term_frequencies(df, record=record, values=values, multi=multi, order=order), "terms")
    total = counts.filter(F.col("field") == TOTAL).agg(F.coalesce(F.max("records"), F.lit(0))).collect()[0][0]
    limit = F.create_map(*[F.lit(x) for f, share in common_above.items() for x in (f, share * total)])[F.col("field")]
    mark = F.when(F.col("records") < rare_below, "rare").when(F.col("records") > limit, "common")
    return counts.filter(F.col("field") != TOTAL).withColumn("mark", mark)
