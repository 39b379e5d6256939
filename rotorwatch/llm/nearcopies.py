"""Near-duplicate documents by HyperMinHash (operator 5).

A document's set of word shingles is kept as a HyperMinHash sketch: each bucket's least hash as its leading-zero count
and ten bits of mantissa, 16 bits a register.  Documents with equal sets are one class from the start.  Bands of
registers bring classes together, and a collision-corrected estimate of their Jaccard similarity decides which may be
linked.  Classes so connected are a cluster; links are verified on full sets, inside clusters.

A band's bucket and a cluster may hold any number of classes, and their pairs are never listed.  In a bucket, first each
class is held against the bucket's least; then only classes outside the bucket's largest cluster ask all others, chunk by
chunk, and a task returns no more than a spanning forest of what the estimate admits.  In a cluster, chunks of bounded
size are verified in one task each, which compares only classes that its links have not connected yet; then only
classes outside the cluster's largest component ask the other chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorwatch.llm import shingles
from rotorwatch.llm.common import arrow_rows, kept, tidy
from rotorwatch.llm.components import components
from rotorwatch.llm.pretokens import text_slices

BUCKET_BITS = 8  # 256 registers
MANTISSA = 10
BAND = 7  # registers; 36 bands: a pair of similarity 0.85 shares one but for 1 in a million, of 0.8 but for 2 in 10,000
DEVIATIONS = 4.5  # an estimate so many standard deviations below the threshold still counts
CHUNK = 4_096  # classes of a bucket compared with at once
CLUSTER_SHINGLES = 1 << 20  # shingles of a cluster's chunk
_M = 1 << BUCKET_BITS


def registers(own: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set of 64-bit hashes, 0 where a bucket is empty."""
    out = np.zeros(_M, np.uint16)
    shift = np.uint64(64 - BUCKET_BITS)
    first = np.searchsorted(own, np.arange(_M, dtype=np.uint64) << shift)
    has = np.flatnonzero(first < len(own))
    least = own[first[has]]
    mine = (least >> shift) == has.astype(np.uint64)
    has, least = has[mine], least[mine] & np.uint64((1 << (64 - BUCKET_BITS)) - 1)
    part, power = np.frexp(np.maximum(least, np.uint64(1)).astype(np.float64))
    out[has] = (64 - BUCKET_BITS - power) * (1 << MANTISSA) + np.minimum((part - 0.5) * (2 << MANTISSA), (1 << MANTISSA) - 1).astype(np.int64) + 1
    return out


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard similarity of sets of sizes ``n`` and ``m`` by their registers (last axis), less the matches that unequal hashes are
    expected to make; and the number of buckets that it rests on."""
    both = ((a == b) & (a > 0)).sum(axis=-1)
    any_ = np.maximum(1, ((a > 0) | (b > 0)).sum(axis=-1))
    chance = 0.169919487159739 * 2.0 ** (BUCKET_BITS - MANTISSA) * 4.0 * n * m / np.maximum(1.0, (n + m) * 1.0 * (n + m))
    return np.maximum(0.0, both - chance) / any_, any_


def admits(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, share: float) -> np.ndarray:
    """Whether the estimate leaves it open that the similarity is ``share`` or more.

    Registers are a sample, without replacement, of the union; in small sets a hash may also hide one or two others.
    """
    found, rests_on = estimate(a, b, n, m)
    union = np.maximum(rests_on, (n + m) / (1 + share))
    deviation = np.sqrt(share * (1 - share) / rests_on * (1 - rests_on / union))
    return (found >= share - DEVIATIONS * deviation - 2.0 / rests_on - 0.01) & (np.minimum(n, m) >= share * np.maximum(n, m) - 1e-9)


def _registers_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), _M)


def sketches(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """(id, n, sig, regs): each row's set size, the 128 bits that stand for its set, and its registers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in text_slices(batch.column(1)):
                sets = shingles.shingle_sets(part, words)
                cells = [[len(s) for s in sets], [shingles.signature(s) for s in sets], [registers(s).tobytes() for s in sets]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), *(pa.array(c, t) for c, t in zip(cells, (pa.int64(), pa.binary(), pa.binary()), strict=True))], names=["id", "n", "sig", "regs"])

    out = T.StructType([T.StructField("id", docs.schema[doc_id].dataType), T.StructField("n", T.LongType()), T.StructField("sig", T.BinaryType()), T.StructField("regs", T.BinaryType())])
    return arrow_rows(docs, doc_id, text).mapInArrow(tidy(work), out)


def band_keys(classes: DataFrame) -> DataFrame:
    """(key, sig): a row per class and band with anything in it; equal keys are equal bands."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regs = _registers_of(batch.column(1)).astype(np.uint64)
            for band in range(_M // BAND):
                own = regs[:, band * BAND: (band + 1) * BAND]
                some = np.flatnonzero(own.any(axis=1))
                key = np.full(len(some), band + 1, np.uint64)
                for k in range(BAND):
                    key = shingles._mixed(key * np.uint64(0x9E3779B97F4A7C15) + own[some, k])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0).take(pa.array(some))], names=["key", "sig"])

    return arrow_rows(classes, "sig", "regs").mapInArrow(tidy(work), "key long, sig binary")


def admitted(pairs: DataFrame, sketch: DataFrame, share: float) -> DataFrame:
    """The ``pairs`` (a, b) that the estimate admits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, m = (np.asarray(batch.column(c)) for c in (2, 3))
                fine = admits(_registers_of(batch.column(4)), _registers_of(batch.column(5)), n, m, share)
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(fine)) for c in batch.columns[:2]], names=["a", "b"])

    left = sketch.select(F.col("sig").alias("_a"), F.col("n").alias("_n"), F.col("regs").alias("_left"))
    right = sketch.select(F.col("sig").alias("_b"), F.col("n").alias("_m"), F.col("regs").alias("_right"))
    rows = pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b"))
    return arrow_rows(rows, "a", "b", "_n", "_m", "_left", "_right").mapInArrow(tidy(work), "a binary, b binary")


class _Sets:
    """Union-find over the names that a task has met."""

    def __init__(self) -> None:
        self.parent: dict[bytes, bytes] = {}

    def root(self, x: bytes) -> bytes:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = x = self.parent.get(up, up)
        return x

    def join(self, a: bytes, b: bytes) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _asked(members: DataFrame, group: list[str], part: str, chunks: DataFrame, alone: str) -> DataFrame:
    """``members`` with chunk and asks: all stay in their own chunk of their ``group``; those whose ``part`` isn't its largest also
    ask, in every chunk (but ``alone``, if given, their own).  ``chunks``: (group, _chunks) of groups in question."""
    sizes = members.groupBy(*group, part).agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.groupBy(*group).agg(F.max(F.struct("_n", part)).alias("_top"), F.count(F.lit(1)).alias("_parts")).where("_parts > 1")
    largest = largest.join(chunks, group).select(*(F.col(g).alias(f"_{g}") for g in group), F.col(f"_top.{part}").alias("_major"), "_chunks")
    same = [F.col(g) == F.col(f"_{g}") for g in group]
    rows = members.join(largest, same).drop(*(f"_{g}" for g in group))
    rows = kept(rows.withColumn("chunk", F.pmod(F.xxhash64("sig"), F.col("_chunks")).cast("int")), "near-groups")
    stay = rows.withColumn("asks", F.lit(False))
    ask = rows.where(F.col(part) != F.col("_major")).withColumn("_own", F.col("chunk")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    ask = ask.where("chunk != _own" if alone else "true").drop("_own").withColumn("asks", F.lit(True))
    return stay.unionByName(ask).repartition(*group, "chunk").sortWithinPartitions(*group, "chunk", "asks", "sig")


def _chunked(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """(a new group, rows of one group): ``keys`` first columns tell groups apart, the next one says who asks."""
    last = None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[: keys + 1]]
        rows = list(zip(*columns, strict=True))
        begin = 0
        for k in range(1, len(rows) + 1):
            if k == len(rows) or rows[k] != rows[begin]:
                yield rows[begin][:keys] != last, batch.slice(begin, k - begin)
                last, begin = rows[begin][:keys], k


def forest(members: DataFrame, share: float) -> DataFrame:
    """(a, b): of the pairs that share a bucket, are in different parts and that the estimate admits, enough to connect all.

    ``members``: (key, sig, part, n, regs).
    """
    chunks = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("_chunks"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined, stay = _Sets(), []
        chunk = None
        for new, rows in _chunked(batches, 2):
            if new:
                joined, stay, chunk = _Sets(), [], None
            if not rows.column(2)[0].as_py():
                stay.append(rows)
                continue
            if chunk is None:
                both = pa.Table.from_batches(stay).combine_chunks() if stay else rows.slice(0, 0)
                chunk = both.column(3).to_pylist(), both.column(4).to_pylist(), np.asarray(both.column(5)), _registers_of(both.column(6))
            left, right = [], []
            for sig, part, n, regs in zip(*(rows.column(c).to_pylist() for c in (3, 4, 5)), _registers_of(rows.column(6)), strict=True):
                for k in np.flatnonzero(admits(chunk[3], regs, chunk[2], np.int64(n), share)):
                    # parts are connected already, so they stand for their classes
                    if chunk[1][k] != part and joined.join(part, chunk[1][k]):
                        left.append(max(sig, chunk[0][k]))
                        right.append(min(sig, chunk[0][k]))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])

    rows = _asked(members, ["key"], "part", chunks, "")
    return arrow_rows(rows, "key", "chunk", "asks", "sig", "part", "n", "regs").mapInArrow(tidy(work), "a binary, b binary").distinct()


def _links(stay: list[tuple], asking: list[tuple], joined: _Sets, percent: int) -> Iterator[tuple[bytes, bytes]]:
    """Links of ``asking`` classes with those that ``stay``, on full sets, where ``joined`` does not connect them yet; without asking
    ones, of those that stay with each other.  Classes are (sig, component, set)."""
    regs = np.stack([registers(c[2]) for c in stay]) if stay else np.zeros((0, _M), np.uint16)
    sizes = np.array([len(c[2]) for c in stay], np.int64)
    for k, (sig, part, own) in enumerate(asking or stay):
        most = len(stay) if asking else k
        open_ = np.flatnonzero(admits(regs[:most], registers(own), sizes[:most], np.int64(len(own)), percent / 100))
        for j in open_:
            other = stay[j]
            if joined.root(part) == joined.root(other[1]):
                continue
            common = int((other[2][np.minimum(np.searchsorted(other[2], own), len(other[2]) - 1)] == own).sum())
            if 100 * common >= percent * (len(own) + len(other[2]) - common):
                joined.join(part, other[1])
                yield max(sig, other[0]), min(sig, other[0])


def verified(members: DataFrame, percent: int, words: int, ask: bool) -> DataFrame:
    """(a, b): links between classes of a cluster, on full sets, enough to connect what is linked.

    ``members``: (cluster, chunk, asks, sig, part, text), by cluster and chunk; those that ask come last in a chunk.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stay: list[tuple] = []
        joined = _Sets()

        def classes(rows: pa.RecordBatch) -> list[tuple]:
            sets = [s for _, part in text_slices(rows.column(5)) for s in shingles.shingle_sets(part, words)]
            return list(zip(rows.column(3).to_pylist(), rows.column(4).to_pylist(), sets, strict=True))

        def out(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

        for new, rows in _chunked(batches, 2):
            if new:
                if not ask:
                    yield out(list(_links(stay, [], joined, percent)))
                stay, joined = [], _Sets()
            if rows.column(2)[0].as_py():
                yield out(list(_links(stay, classes(rows), joined, percent)))
            else:
                stay += classes(rows)
        if not ask:
            yield out(list(_links(stay, [], joined, percent)))

    return arrow_rows(members, "cluster", "chunk", "asks", "sig", "part", "text").mapInArrow(tidy(work), "a binary, b binary").distinct()


def class_texts(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame, words: int) -> DataFrame:
    """(sig, text): a text of each class in ``wanted`` (sig, least), found by an id of the class."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in text_slices(batch.column(0)):
                sigs = [shingles.signature(s) for s in shingles.shingle_sets(part, words)]
                yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.binary()), part.cast(pa.string())], names=["sig", "text"])

    ids = wanted.select(F.col("least").alias("_id")).distinct()
    found = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("text")).join(ids, F.col("_doc").eqNullSafe(F.col("_id")), "left_semi")
    found = arrow_rows(found, "text").mapInArrow(tidy(work), "sig binary, text string")
    return found.join(wanted.select("sig"), "sig", "left_semi").groupBy("sig").agg(F.first("text").alias("text"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80, words: int = shingles.WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per row of ``docs``: documents whose sets of distinct ``words``-word
    shingles share ``percent`` of their union at least are linked; ``component_id`` is the smallest id reachable.

    Null and empty texts, and those without words, have no shingles and are linked with nothing; a text of fewer words
    is one shingle.  Rows with equal ids stay rows of their own; null ids count only where a component has no other.
    An empty table gives no rows; other columns of ``docs`` are not read.
    """
    share = percent / 100
    rows = kept(sketches(docs, doc_id, text, words), "near-sketches")

    # memberships of buckets with two classes at least
    keys = band_keys(rows.where("n > 0").select("sig", "regs"))
    shared = keys.groupBy("key").agg(F.min("sig").alias("center"), F.max("sig").alias("_last")).where("center < _last").select(F.col("key").alias("_k"), "center")
    members = kept(keys.join(shared, F.col("key") == F.col("_k")).select("key", "sig", "center").distinct(), "near-members")
    stars = members.groupBy("sig").agg(F.min("center").alias("center"))
    sketch = rows.join(stars.select("sig"), "sig", "left_semi").groupBy("sig").agg(F.min("id").alias("least"), F.first("n").alias("n"), F.first("regs").alias("regs"))
    sketch = kept(sketch, "near-candidates")

    # clusters: each class with the least of its buckets, then those that are still apart
    pairs = kept(admitted(stars.where("sig != center").select(F.col("sig").alias("a"), F.col("center").alias("b")), sketch, share), "near-pairs")
    roots = components(pairs)
    placed = sketch.select("sig", "n", "regs").join(roots, F.col("sig") == F.col("node"), "left").select("sig", "n", "regs", F.coalesce("root", "sig").alias("part"))
    pairs = pairs.unionByName(forest(members.select("key", "sig").join(placed, "sig"), share))
    roots = kept(components(pairs), "near-clusters")
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())

    # links, in chunks of a cluster, then across chunks
    inside = sketch.select("sig", "n", "least").join(roots, F.col("sig") == F.col("node")).select("sig", "n", "least", F.col("root").alias("cluster"))
    chunks = inside.groupBy("cluster").agg(F.ceil(F.sum("n") / CLUSTER_SHINGLES).cast("int").alias("_chunks"))
    texts = kept(inside.join(class_texts(docs, doc_id, text, inside, words), "sig").select("cluster", "sig", "text"), "near-texts")
    cut = texts.join(chunks, "cluster").withColumn("chunk", F.pmod(F.xxhash64("sig"), F.col("_chunks")).cast("int")).withColumn("asks", F.lit(False)).withColumn("part", F.col("sig"))
    links = kept(verified(cut.repartition("cluster", "chunk").sortWithinPartitions("cluster", "chunk", "sig"), percent, words, False), "near-links")
    roots = components(links)
    wide = chunks.where("_chunks > 1")
    if wide.limit(1).count():
        placed = texts.join(wide.select("cluster"), "cluster", "left_semi").join(roots, F.col("sig") == F.col("node"), "left").select("cluster", "sig", "text", F.coalesce("root", "sig").alias("part"))
        links = kept(links.unionByName(verified(_asked(placed, ["cluster"], "part", wide, "own"), percent, words, True)), "near-links")
        roots = components(links)

    classes = rows.where("n > 0").groupBy("sig").agg(F.min("id").alias("least"))
    named = classes.join(roots, F.col("sig") == F.col("node"), "left").select("sig", "least", F.coalesce("root", "sig").alias("_root"))
    least = named.groupBy(F.col("_root").alias("_r")).agg(F.min("least").alias("component_id"))
    named = named.join(least, F.col("_root") == F.col("_r")).select(F.col("sig").alias("_sig"), "component_id")
    out = rows.drop("regs").join(named, (F.col("sig") == F.col("_sig")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
