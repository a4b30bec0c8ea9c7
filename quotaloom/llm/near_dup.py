"""Near-duplicate records: an exact Jaccard join of shingle sets by recursive regions and windows (problem 1).

Records of one partition key (a template) are sets of ``width`` adjacent words; wanted are all pairs with Jaccard similarity of at
least t. Sets that are equal form a class, and only classes are joined; copies come back at the end.

Regions. A region belongs to a shingle g, as the region of its singleton {g}. Under the weighted Jaccard distance, with weights that
fall steeply with a shingle's frequency, the singleton nearest to a set is that of its rarest shingle: the cell of {g} holds the sets
whose rarest shingle is g. Records as pivots were tried first and can't prune at t = 0.7: in the largest template of check_l (55,379 sets)
the median distance to the nearest of 16, 128 or 1,024 record pivots is 0.88, 0.83 and 0.80, so a window (that distance plus 0.6)
reaches 16, 128 and 1,021 regions of them: each set would be copied into all.

Windows. All sets in the region of {g} lie within L(g), the shingles not rarer than g. By the triangle inequality of set difference a
set x is at least |x - L(g)| shingles away from all of them, and a partner may lack at most n - ceil(t n) of x's n shingles. So x
is replicated into the regions of its first n - ceil(t n) + 1 shingles in order of rarity, and into no other. Two partners
both reach the region of their rarest common shingle, at the latest.

Recursion. A region with more than ``cap`` sets is cut again: its sets are distributed over the regions of the next common
shingle, and the shingles skipped so far stay charged against the window. Regions are thus paths of common shingles. A set that
could end on a path (the path has at least t n shingles) is also kept on the path itself, so partners without a further
common shingle still meet. Regions are cut as long as that lessens the pairs to compare by a tenth at least; what is left of more
than ``BLOCK`` sets, a crowd of near-equal ones, is joined block by block, so no task ever holds such a region.

Within a final region, pairs are compared by size and by a 64-bit sketch whose number of differing
bits never exceeds the number of differing shingles (again the triangle inequality, after a contraction); what remains is checked
exactly on the words.

Size. The order of rarity comes from one table of ``BUCKETS`` counters over the whole input; it decides the cost only, never
the result. Region sizes are exact counts. Regions above the cap reach the tasks as a bitmap of hashed paths, put together in the
cluster word by word; a collision makes a small region be cut too, alike for all its sets. Nothing grows with the data on the driver
but that bitmap, which is limited to ``MAX_BITS``. A class is a 64-bit hash of its set; a second one tells sets apart that share it.

Results. ``components`` has one row per record, whatever the number of copies: the form for large data. ``record_pairs`` gives all
pairs of records, as problem 1's found query asks; the copies of large classes are paired block by block.

Cases: null texts, keys or ids and texts of fewer than ``width`` words are left out. Repeated rows of an id count once. Empty tables
give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotaloom.functions.words import words
from quotaloom.operators.quality import keep_per_group
from quotaloom.workspace import cut, drop, new_path

BUCKETS = 1 << 18
MAX_BITS = 1 << 26
BLOCK = 20_000
COPIES = 1_000
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class Sets:
    """The shingle sets of a batch: flat arrays of set number and shingle, each set's shingles distinct and in the given order."""

    def __init__(self, lists: pa.Array, width: int, counts: np.ndarray | None = None) -> None:
        offsets = lists.offsets.to_numpy().astype(np.int64)
        w = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)[offsets[0] : offsets[-1]] if len(lists) else np.empty(0, np.uint64)
        offsets -= offsets[0] if len(offsets) else 0
        n = np.maximum(np.diff(offsets) - width + 1, 0)
        owner = np.repeat(np.arange(len(n)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offsets[:-1], n)
        g = np.zeros(len(at), np.uint64)
        for k in range(width):
            g = mix(g * _A + w[at + k] + np.uint64(k + 1))
        order = np.lexsort((g, owner))
        owner, g = owner[order], g[order]
        new = np.ones(len(g), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (g[1:] != g[:-1])
        self.owner, self.gram = owner[new], g[new]
        if counts is not None:
            order = np.lexsort((self.gram, counts[(self.gram & np.uint64(BUCKETS - 1)).astype(np.int64)], self.owner))
            self.gram = self.gram[order]
        self.n = np.bincount(self.owner, minlength=len(n)).astype(np.int64)
        self.start = np.cumsum(self.n) - self.n

    def sums(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.n), np.uint64)
        some = self.n > 0
        if some.any():
            out[some] = np.add.reduceat(values, self.start[some])
        return out

    def sketch(self) -> np.ndarray:
        """64 bits: the parity of the shingles that fall on each."""
        bits = np.uint64(1) << (self.gram >> np.uint64(58))
        out = np.zeros(len(self.n), np.uint64)
        some = self.n > 0
        if some.any():
            out[some] = np.bitwise_xor.reduceat(bits, self.start[some])
        return out


def least_overlap(n: np.ndarray, t: tuple[int, int]) -> np.ndarray:
    """ceil(t n): the common shingles that any partner of a set of n has at least."""
    return -(-n * t[0] // t[1])


def paths(sets: Sets, key: np.ndarray, t: tuple[int, int], heavy: list[np.ndarray], depth: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(set number, region) of all memberships in final regions, or with ``depth`` in all regions of that depth.

    ``heavy`` holds a bitmap for each depth from 1 on of the regions that are cut further.
    """
    need = least_overlap(sets.n, t)
    slack = sets.n - need
    some = np.flatnonzero(sets.n > 0)
    owner = np.repeat(some, slack[some] + 1)
    pos = np.arange(len(owner)) - np.repeat(np.cumsum(slack[some] + 1) - slack[some] - 1, slack[some] + 1)
    path = mix(key[owner].view(np.uint64) * _A + sets.gram[sets.start[owner] + pos])
    out_owner, out_path = [], []
    for level in range(1, len(heavy) + 2):
        if depth == level:
            return owner, path
        if level > len(heavy):
            out_owner.append(owner)
            out_path.append(path)
            break
        bitmap = heavy[level - 1]
        hit = (path & np.uint64(len(bitmap) * 8 - 1)).astype(np.int64)
        deep = (bitmap[hit >> 3] >> (hit & 7).astype(np.uint8)) & 1 == 1
        stays = ~deep | (level >= need[owner])
        out_owner.append(owner[stays])
        out_path.append(path[stays])
        owner, pos, path = owner[deep], pos[deep], path[deep]
        more = np.maximum(np.minimum(slack[owner] + level, sets.n[owner] - 1) - pos, 0)
        step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
        owner, pos, path = np.repeat(owner, more), np.repeat(pos, more) + step, np.repeat(path, more)
        path = mix(path * _A + sets.gram[sets.start[owner] + pos])
    if depth is not None:
        return owner[:0], path[:0]
    return np.concatenate(out_owner), np.concatenate(out_path)


def _hashes(text: Column) -> Column:
    return F.transform(F.split(text, " "), lambda w: F.xxhash64(w))


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _classes(rows: DataFrame, width: int) -> DataFrame:
    """Adds ``cls`` and ``twin``, two hashes of key and shingles of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = Sets(b.column(3), width)
            cls = mix(sets.sums(mix(sets.gram + _A)) + mix(b.column(1).to_numpy().view(np.uint64) + sets.n.view(np.uint64)))
            twin = mix(sets.sums(mix(mix(sets.gram) * _C + _B)) ^ mix(b.column(1).to_numpy().view(np.uint64) + _C))
            keep = pa.array(sets.n > 0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), _longs(cls), _longs(twin)], names=["id", "part", "text", "cls", "twin"]).filter(keep)

    return rows.select("id", "part", "text", _hashes(F.col("text")).alias("h")).mapInArrow(run, "id string, part long, text string, cls long, twin long")


def _told_apart(classed: DataFrame) -> DataFrame:
    """The classes, where different sets share one hash numbered by the other; such classes are next to none."""
    shared = classed.groupBy(F.col("cls").alias("_cls")).agg(F.min("twin").alias("_low"), F.max("twin").alias("_high")).filter("_low <> _high").select("_cls", "_low")
    shared = cut(shared, "shared")
    if shared.isEmpty():  # then no text is shuffled for it
        return classed.drop("twin")
    both = classed.join(shared, F.col("cls") == F.col("_cls"), "left")
    return both.withColumn("cls", F.when(F.col("_low").isNull() | (F.col("twin") == F.col("_low")), F.col("cls")).otherwise(F.xxhash64("cls", "twin"))).drop("_cls", "_low", "twin")


def _frequencies(classes: DataFrame, width: int) -> np.ndarray:
    """Occurrences of all shingles, by hash bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for b in batches:
            n += np.bincount((Sets(b.column(0), width).gram & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some])], names=["bucket", "n"])

    got = classes.select(_hashes(F.col("text")).alias("h")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def _members(classes: DataFrame, width: int, t: tuple[int, int], shared, depth: int | None, counted: bool = False) -> DataFrame:
    """Memberships in final regions (region, cls, n, sketch), or with ``depth`` or ``counted`` the number of memberships of each
    region of one depth, or of each final one."""
    counted = counted or depth is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, heavy = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                sets = Sets(part.column(2), width, counts)
                owner, path = paths(sets, part.column(1).to_numpy(), t, heavy, depth)
                if counted:
                    region, n = np.unique(path, return_counts=True)
                    yield pa.RecordBatch.from_arrays([_longs(region), pa.array(n)], names=["region", "n"])
                else:
                    cols = [_longs(path), part.column(0).take(pa.array(owner)), pa.array(sets.n[owner].astype(np.int32)), _longs(sets.sketch()[owner])]
                    yield pa.RecordBatch.from_arrays(cols, names=["region", "cls", "n", "sketch"])

    rows = classes.select("cls", "part", _hashes(F.col("text")).alias("h"))
    got = rows.mapInArrow(run, "region long, n long" if counted else "region long, cls long, n int, sketch long")
    return got.groupBy("region").agg(F.sum("n").alias("n")) if counted else got


def _bitmap(regions: DataFrame, cap: int) -> tuple[np.ndarray | None, float]:
    """(the regions with more than ``cap`` memberships, hashed into 16 bits each, None if there is none; pairs in them).

    The bits are joined to words of 64 before they reach the driver.
    """
    big = cut(regions.filter(F.col("n") > cap), "regions")
    n, pairs = big.agg(F.count("*"), F.coalesce(F.sum(F.col("n").cast("double") * F.col("n")), F.lit(0.0))).first()
    if not n:
        return None, 0.0
    bits = min(MAX_BITS, 1 << max(10, math.ceil(math.log2(16 * n))))
    slot = F.col("region").bitwiseAND(F.lit(bits - 1))
    word = big.select(F.shiftrightunsigned(slot, 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(region & 63 as int))").alias("b"))
    got = word.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[got.column("w").to_numpy()] = got.column("b").to_numpy()
    return out.view(np.uint8), pairs


def _candidates(leaf: DataFrame, sizes: DataFrame, t: tuple[int, int]) -> DataFrame:
    """(cls_a, cls_b), cls_a < cls_b, of the members of a region that sizes and sketches allow.

    Members of a region of more than ``BLOCK`` are cut into blocks, and each pair of blocks is a region of its own.
    """
    p, q = t
    large = cut(sizes.filter(F.col("n") > BLOCK).select(F.col("region").alias("_large"), F.ceil(F.col("n") / BLOCK).cast("int").alias("k")), "large")
    sides = ["region"]
    if not large.isEmpty():
        k = F.coalesce("k", F.lit(1))
        leaf = leaf.join(large, F.col("region") == F.col("_large"), "left").withColumn("block", F.pmod(F.xxhash64("cls"), k).cast("int"))
        leaf = leaf.withColumn("other", F.explode(F.sequence(F.lit(0), k - 1))).drop("k", "_large")
        leaf = leaf.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")})
        sides = ["region", "x", "y"]
    keep = ["cls", "n", "sketch", *(["block"] if len(sides) > 1 else [])]
    a, b = (leaf.select(*sides, *[F.col(c).alias(f"{c}_{s}") for c in keep]) for s in "ab")
    both = F.col("n_a") + F.col("n_b")
    # |A & B| >= p/(p+q) (|A| + |B|), so the difference is at most:
    differ = both - 2 * F.ceil(both * p / F.lit(p + q) - 1e-9)
    near = (F.bit_count(F.col("sketch_a").bitwiseXOR(F.col("sketch_b"))) <= differ) & (F.least("n_a", "n_b") * q >= F.greatest("n_a", "n_b") * p)
    if len(sides) > 1:  # members of one block meet in their own pair of blocks only
        near = near & ((F.col("x") == F.col("y")) | (F.col("block_a") != F.col("block_b")))
    return a.join(b, sides).filter((F.col("cls_a") < F.col("cls_b")) & near).select("cls_a", "cls_b").distinct()


def _shingle_words(text: Column, width: int) -> Column:
    """The distinct shingles of a text as strings."""
    w = F.split(text, " ")
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)), lambda i: F.array_join(F.slice(w, i, width), " ")))


def near_duplicates(df: DataFrame, *, id_col: str, text_col: str, part_col: str, width: int, threshold: tuple[int, int], cap: int = 200) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs (cls_a, cls_b) of different classes with Jaccard similarity >= threshold, each once, and
    members (id, cls). ``threshold`` is a fraction (7, 10)."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(part_col).cast("string").alias("_p"), F.array_join(words(F.col(text_col)), " ").alias("text"))
    long_enough = (F.col("text") != "") & (F.size(F.split("text", " ")) >= width)
    rows = rows.filter(F.col("id").isNotNull() & F.col("_p").isNotNull() & long_enough)
    classed = _told_apart(cut(_classes(rows.select("id", F.xxhash64("_p").alias("part"), "text"), width), "classed"))
    members = cut(classed.groupBy("id").agg(F.min("cls").alias("cls")), "members")
    classes = cut(classed.groupBy("cls", "part").agg(F.min("text").alias("text")), "classes")
    counts, heavy, before = _frequencies(classes, width), [], float("inf")
    while True:
        shared = spark.sparkContext.broadcast((counts, heavy))
        bitmap, pairs = _bitmap(_members(classes, width, threshold, shared, len(heavy) + 1), cap)
        shared.unpersist()
        if bitmap is None or pairs > 0.9 * before:
            break
        heavy.append(bitmap)
        before = pairs
    shared = spark.sparkContext.broadcast((counts, heavy))
    sizes = _members(classes, width, threshold, shared, None, counted=True)
    candidates = cut(_candidates(_members(classes, width, threshold, shared, None), sizes, threshold), "candidates")
    p, q = threshold
    texts = classes.select("cls", "text")
    pairs = candidates.join(texts.select(F.col("cls").alias("cls_a"), F.col("text").alias("text_a")), "cls_a")
    pairs = pairs.join(texts.select(F.col("cls").alias("cls_b"), F.col("text").alias("text_b")), "cls_b")
    sa, sb = _shingle_words(F.col("text_a"), width), _shingle_words(F.col("text_b"), width)
    pairs = pairs.withColumn("_a", sa).withColumn("_b", sb)
    common = F.size(F.array_intersect("_a", "_b"))
    pairs = pairs.filter(common * q >= (F.size("_a") + F.size("_b") - common) * p).select("cls_a", "cls_b")
    return pairs, members


def record_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: all pairs of records whose classes are equal or paired.

    The records of a class of more than ``COPIES`` are cut into blocks; each record of its partner is joined with one block at a time,
    so the pairs of a large class are spread over as many tasks as it has blocks. ``components`` gives the same links without pairs.
    """
    pairs = cut(pairs, "pairs")
    several = cut(members.groupBy("cls").agg(F.count("*").alias("n")).filter("n > 1"), "several")
    links = pairs.unionByName(several.select(F.col("cls").alias("cls_a"), F.col("cls").alias("cls_b")))
    blocks = several.filter(F.col("n") > COPIES).select(F.col("cls").alias("_c"), F.ceil(F.col("n") / COPIES).cast("int").alias("_k"))
    two = members.join(blocks, F.col("cls") == F.col("_c"), "left")
    two = two.select(F.col("cls").alias("cls_b"), F.pmod(F.xxhash64("id"), F.coalesce("_k", F.lit(1))).cast("int").alias("block"), F.col("id").alias("y"))
    links = links.join(blocks, F.col("cls_b") == F.col("_c"), "left").select("cls_a", "cls_b", F.explode(F.sequence(F.lit(0), F.coalesce("_k", F.lit(1)) - 1)).alias("block"))
    one = members.select(F.col("cls").alias("cls_a"), F.col("id").alias("x"))
    out = links.join(one, "cls_a").join(two, ["cls_b", "block"]).filter((F.col("cls_a") != F.col("cls_b")) | (F.col("x") < F.col("y")))
    return out.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def components(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(id, class_id, links): one row per record; class_id is the smallest id of its connected group, links the number of its
    partners.

    Classes are joined by alternating large-star and small-star steps, each of which only re-hangs links between
    neighbours, so no component is ever gathered in one place and the number of rounds is logarithmic. Copies count as
    partners of one another.
    """
    pairs = cut(pairs, "pairs")
    sizes = members.groupBy("cls").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    both = pairs.select(F.col("cls_a").alias("u"), F.col("cls_b").alias("v"))
    both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    degree = both.join(sizes.select(F.col("cls").alias("v"), "n"), "v").groupBy(F.col("u").alias("cls")).agg(F.sum("n").alias("_d"))
    root = roots(both)
    named = sizes.join(root, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    name = named.groupBy("root").agg(F.min("least").alias("class_id"))
    named = named.join(name, "root").join(degree, "cls", "left").select("cls", "class_id", (F.col("n") - 1 + F.coalesce("_d", F.lit(0))).alias("links"))
    return members.join(named, "cls").select("id", "class_id", "links")


def keep_per_cluster(df: DataFrame, *, id_col: str, text_col: str, width: int, threshold: tuple[int, int], n: int) -> DataFrame:
    """(id): at most ``n`` records, those of the smallest ids, of each cluster of near-duplicates (survey Q2, W8).

    Clusters are found over all records as one partition. Texts of fewer than ``width`` words have no shingle: equal ones are a
    cluster; a record without any word is alone. Null ids are left out.
    """
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.lit("").alias("part"))
    found = components(*near_duplicates(rows, id_col="id", text_col="text", part_col="part", width=width, threshold=threshold)).select("id", "class_id")
    once = rows.filter("id is not null").groupBy("id").agg(F.min(F.array_join(words(F.col("text")), " ")).alias("w"))
    own = F.when(F.col("class_id").isNotNull(), F.struct(F.lit(0).alias("kind"), F.col("class_id").alias("name")))
    own = F.coalesce(own, F.when(F.col("w") != "", F.struct(F.lit(1).alias("kind"), F.col("w").alias("name"))), F.struct(F.lit(2).alias("kind"), F.col("id").alias("name")))
    return keep_per_group(once.join(found, "id", "left").select("id", own.alias("cluster")), ["cluster"], ["id"], n).select("id")


def roots(edges: DataFrame) -> DataFrame:
    """(cls, root) of every node of the undirected edges (u, v), given in both directions: root is its component's smallest node."""
    spark = edges.sparkSession
    edges = cut(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    before, written = None, ""
    while True:
        # large star: hang larger neighbours under the smallest neighbour or the node itself
        least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = edges.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: hang the node and its smaller neighbours under the smallest of them
        down = large.filter("v < u").distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u")
        out = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        path = new_path(spark, "stars")
        out.write.parquet(path)
        stars = spark.read.schema(out.schema).parquet(path)
        if written:
            drop(spark, written)
        written = path
        now = stars.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == before:
            return stars.select(F.col("u").alias("cls"), F.col("v").alias("root"))
        before = now
        edges = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
