"""Duplicates hidden by formatting, collapsed by an incremental ledger (problem 2).

The canonical key of a text is a 128-bit hash of its fields in sorted order; a field is its words joined by one blank. The
ledger is a folder with two tables, both cut into buckets of the key on disk:

* ``members/gen=G/bucket=B``: (key, id, seen_at), one row per record; each batch adds a generation;
* ``counts/gen=G/bucket=B``: (key, copies, keep_id, first_seen, first_id), one row per key; each bucket has one current generation.

A batch is aggregated by key, then full-outer-joined with the counts of the buckets it touches; copies are added, the smallest id
and the earliest representative are kept, and those buckets are written as a new generation. Buckets that a batch doesn't touch
are neither read nor written. Records that were delivered before are found among the members of the touched buckets and not
counted again.

``log/N.json`` names the current generation of each bucket's counts and the generations of its members; the highest N
counts. It is moved into place when both tables are written, so counts and members are committed together: a run that
fails before leaves unnamed files only, and a replay of a batch, after a failure or after success, changes nothing. The folder may
lie anywhere and outlives the session; ``Ledger`` on an existing folder goes on from its last version. One writer at a time.

A key that a third of all rows share: the membership test is partitioned by key and id, the count by key is pre-aggregated
before its shuffle, the ledger has one row per key, and members are written after a rebalance that splits large
buckets. Only the last join, which hands each copy its representative, meets the whole group on one key; adaptive execution splits
that side.

Cases: a null text, a text without any word, or a null id is left out. Ties in time go to the smaller id. Equal rows count
once. Rows without a batch are a batch of their own, the last; a record without a time is later than those with one. Empty
batches leave the ledger as it is; an empty table gives an empty ledger.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotaloom.workspace import cut, drop, new_path

NO_BATCH = "__no_batch__"  # of rows without one; an empty partition value would come back as null
MEMBERS = "bucket int, key binary, id string, seen_at timestamp_ntz"
COUNTS = "bucket int, key binary, copies long, keep_id string, first_seen timestamp_ntz, first_id string"


def canonical_text(text: Column) -> Column:
    """The sorted fields of a text joined by ``|``; empty if it has no word, null if it is null."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N},;|]+", " ")
    fields = F.filter(F.transform(F.split(plain, "[,;|]"), lambda f: F.trim(f)), lambda f: f != "")
    return F.array_join(F.array_sort(fields), "|")


def canonical_keys(df: DataFrame, *, id_col: str, text_col: str, at: str, buckets: int, batch: Column | None = None) -> DataFrame:
    """(bucket, key, id, seen_at) of every row with a word, and its batch if one is given."""
    batch = F.lit(None).cast("string") if batch is None else F.coalesce(F.nullif(batch.cast("string"), F.lit("")), F.lit(NO_BATCH))
    rows = df.select(F.col(id_col).cast("string").alias("id"), canonical_text(F.col(text_col)).alias("_c"), F.col(at).cast("timestamp_ntz").alias("seen_at"), batch.alias("batch"))
    rows = rows.filter(F.col("id").isNotNull() & (F.col("_c") != ""))
    key = F.unhex(F.md5(F.col("_c")))
    return rows.select(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"), key.alias("key"), "id", "seen_at", "batch")


class Ledger:
    """The ledger in the folder ``root``, at its last committed version."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16) -> None:
        self.spark, self.root, self.log = spark, root, f"{root}/log"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.log)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(path)
        names = [f.getPath().getName() for f in self._fs.listStatus(path)]
        last = max((n for n in names if n.endswith(".json") and not n.startswith((".", "_"))), default=None)
        self.state = json.loads(self._read(last)) if last else {"version": 0, "buckets": buckets, "counts": {}, "members": {}}

    @property
    def buckets(self) -> int:
        return self.state["buckets"]

    def _read(self, name: str) -> str:
        f = self._fs.open(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.log}/{name}"))
        try:
            return bytes(f.readAllBytes()).decode()
        finally:
            f.close()

    def _table(self, name: str, schema: str, of: dict[str, list[int]]) -> DataFrame:
        """The buckets ``of`` each generation; others are pruned as folders."""
        parts = [self.spark.read.schema(schema).parquet(f"{self.root}/{name}/gen={g}").filter(F.col("bucket").isin(sorted(b))) for g, b in sorted(of.items()) if b]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def members(self, buckets: set[int] | None = None) -> DataFrame:
        """(bucket, key, id, seen_at) of all buckets or of some."""
        of: dict[str, list[int]] = defaultdict(list)
        for b, gens in self.state["members"].items():
            for g in gens if buckets is None or int(b) in buckets else ():
                of[g].append(int(b))
        return self._table("members", MEMBERS, of)

    def counts(self, buckets: set[int] | None = None) -> DataFrame:
        """(bucket, key, copies, keep_id, first_seen, first_id) of all buckets or of some."""
        of: dict[str, list[int]] = defaultdict(list)
        for b, g in self.state["counts"].items():
            if buckets is None or int(b) in buckets:
                of[g].append(int(b))
        return self._table("counts", COUNTS, of)

    def apply(self, batch: DataFrame, touched: set[int] | None = None) -> None:
        """Add one batch of ``canonical_keys`` rows, cut into as many buckets as the ledger; ``touched`` are its buckets, if known."""
        touched = {r.bucket for r in batch.select("bucket").distinct().collect()} if touched is None else touched
        if not touched:
            return
        gen = f"{self.state['version'] + 1:08d}-{uuid.uuid4().hex[:8]}"
        once = batch.groupBy("bucket", "key", "id").agg(F.min("seen_at").alias("seen_at"))
        if any(str(b) in self.state["members"] for b in touched):
            once = once.join(self.members(touched).select("bucket", "key", "id"), ["bucket", "key", "id"], "left_anti")
        members = f"{self.root}/members/gen={gen}"
        once.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(members)
        fresh = self.spark.read.schema(MEMBERS).parquet(members)
        added = fresh.groupBy("bucket", "key").agg(
            F.count("*").alias("b_copies"), F.min("id").alias("b_keep"), F.min(F.struct(F.col("seen_at").isNull().alias("timeless"), "seen_at", "id")).alias("b_first")
        )
        kept = {str(b) for b in touched} & set(self.state["counts"])
        if kept:
            both = self.counts(touched).join(added, ["bucket", "key"], "full_outer")
            first = F.array_min(F.array_compact(F.array(F.when(F.col("first_id").isNotNull(), F.struct(F.col("first_seen").isNull().alias("timeless"), F.col("first_seen").alias("seen_at"), F.col("first_id").alias("id"))), F.col("b_first"))))
            merged = both.select(
                "bucket", "key", (F.coalesce("copies", F.lit(0)) + F.coalesce("b_copies", F.lit(0))).alias("copies"),
                F.least("keep_id", "b_keep").alias("keep_id"), first["seen_at"].alias("first_seen"), first["id"].alias("first_id"),
            )
        else:
            merged = added.select("bucket", "key", F.col("b_copies").alias("copies"), F.col("b_keep").alias("keep_id"), F.col("b_first.seen_at").alias("first_seen"), F.col("b_first.id").alias("first_id"))
        merged.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.root}/counts/gen={gen}")
        old = {g for b, g in self.state["counts"].items() if int(b) in touched}
        state = {"version": self.state["version"] + 1, "buckets": self.buckets, "counts": self.state["counts"] | {str(b): gen for b in touched}}
        state["members"] = self.state["members"] | {str(b): [*self.state["members"].get(str(b), []), gen] for b in touched}
        self._commit(state)
        for g in old - set(state["counts"].values()):
            drop(self.spark, f"{self.root}/counts/gen={g}")

    def _commit(self, state: dict) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        tmp, to = path(f"{self.log}/_{uuid.uuid4().hex}.tmp"), path(f"{self.log}/{state['version']:08d}.json")
        f = self._fs.create(tmp, False)
        f.write(bytearray(json.dumps(state).encode()))
        f.close()
        if self._fs.exists(to) or not self._fs.rename(tmp, to):
            raise RuntimeError(f"another writer has committed version {state['version']} of {self.root}")
        self.state = state


def build_ledger(df: DataFrame, *, id_col: str, text_col: str, at: str, batches: Column, buckets: int = 16, root: str | None = None) -> Ledger:
    """Run the whole table through the ledger in the folder ``root``, batch by batch in the order of the ``batches`` column's values;
    without ``root`` through a new one, which goes with the session.

    ``batches`` must take few values (a load period); they are read on the driver as the schedule.
    """
    ledger = Ledger(df.sparkSession, root or new_path(df.sparkSession, "ledger"), buckets)
    staged = cut(canonical_keys(df, id_col=id_col, text_col=text_col, at=at, buckets=ledger.buckets, batch=batches), "ledger-stage", ["batch"])
    schedule = staged.groupBy("batch").agg(F.collect_set("bucket").alias("buckets")).collect()
    for name, touched in sorted(schedule, key=lambda r: (r.batch == NO_BATCH, r.batch)):
        ledger.apply(staged.filter(F.col("batch").eqNullSafe(name)).drop("batch"), set(touched))
    return ledger


def copies(ledger: Ledger) -> DataFrame:
    """(keep_id, copy_id): one row for each record beside its group's smallest id."""
    groups = ledger.counts().filter(F.col("copies") > 1).select("bucket", "key", "keep_id")
    return ledger.members().join(groups, ["bucket", "key"]).filter(F.col("id") != F.col("keep_id")).select("keep_id", F.col("id").alias("copy_id"))
