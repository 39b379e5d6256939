"""Approximate nearest neighbours by balanced posting lists (operator 4).

Centroids are fitted on a bounded sample; every vector goes to the list of its nearest centroid and, near a border, to
those of others (within a distance ratio, and no two that lie closer to each other than to the vector).  Centroids are
found by best-first search over an in-memory neighbour graph.  A query visits the lists whose centroids are within a
distance ratio of the nearest, up to a number of lists.  Ratio and number are not constants: they are the cheapest pair
that finds ``recall`` of the true neighbours of some vectors drawn from all, compared with all rows, so recall holds
at any size.  ``exact`` adds a second visit, of all lists whose radius leaves room for something nearer.
Lists are scanned as chunks of bounded size, whatever a list's own size is.
Distances between unit vectors order like cosines; scores are computed on the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rotorwatch.llm.common import kept, tidy

SAMPLE = 32_768  # vectors that the centroids are fitted on, at most
HELD = 256  # vectors that the visits are calibrated with, at most
LIST = 64  # vectors a list should hold
CENTROIDS = 4_096  # at most, so that the graph fits a task's memory; beyond, lists grow and are scanned in more chunks
CHUNK = 2_048  # vectors scanned at once
DEGREE = 24  # neighbours of a centroid in the graph
COPIES, COPY_RATIO = 4, 1.10  # lists a vector goes to, and how much farther than the first the others may be
RECALL = 0.97  # of the held vectors' true neighbours that the visits must find
LEAST = 1_024  # a query goes on to farther lists until the lists hold so many vectors
HITS = 65_536  # rows a task holds to combine a query's hits of several chunks
SLACK = 1e-3  # of distances computed in single precision, where ``exact`` rules lists out


@dataclass(frozen=True)
class Index:
    centroids: np.ndarray  # unit length
    graph: np.ndarray  # (centroid, neighbour)
    entries: np.ndarray  # where a search starts

    def nearest(self, vectors: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For unit vectors, ``beam`` near centroids each (or all), nearest first: (number, distance).

        A batch is searched at once: each round opens every vector's best centroids not opened yet.
        """
        n, c = len(vectors), len(self.centroids)
        beam = min(beam, c)
        if 2 * beam >= c:
            score = vectors @ self.centroids.T
            best = np.argsort(-score, axis=1, kind="stable")[:, :beam]
            return best, _far(np.take_along_axis(score, best, axis=1))
        known = np.zeros((n, c), bool)
        pool = np.zeros((n, beam), np.int64)  # each vector's best centroids so far
        score = np.full((n, beam), -np.inf, np.float32)
        opened = np.zeros((n, beam), bool)

        def look(at: np.ndarray, which: np.ndarray) -> None:
            which = np.sort(which, axis=1)
            new = ~known[at[:, None], which]
            new[:, 1:] &= which[:, 1:] != which[:, :-1]
            known[at[:, None], which] = True
            value = np.where(new, np.einsum("nd,nkd->nk", vectors[at], self.centroids[which]), -np.inf)
            ids, values = np.concatenate([pool[at], which], axis=1), np.concatenate([score[at], value], axis=1)
            best = np.argpartition(-values, beam - 1, axis=1)[:, :beam]
            done = np.concatenate([opened[at], np.zeros(which.shape, bool)], axis=1)
            pool[at], score[at], opened[at] = (np.take_along_axis(x, best, axis=1) for x in (ids, values, done))

        at = np.arange(n)
        look(at, np.broadcast_to(self.entries, (n, len(self.entries))))
        width = max(1, min(16, beam // 4))
        while True:
            fresh = np.where(opened[at], -np.inf, score[at])
            more = ~np.isneginf(fresh).all(axis=1)
            at, fresh = at[more], fresh[more]
            if not len(at):
                break
            take = np.argpartition(-fresh, width - 1, axis=1)[:, :width]
            opened[at[:, None], take] = True
            look(at, self.graph[pool[at[:, None], take]].reshape(len(at), -1))
        order = np.argsort(-score, axis=1, kind="stable")
        return np.take_along_axis(pool, order, axis=1), _far(np.take_along_axis(score, order, axis=1))


def _far(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * cosine))


@dataclass(frozen=True)
class Visits:
    lists: int  # that a query visits, at most
    ratio: float  # how much farther than the nearest a list's centroid may be


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    top = np.abs(vectors).max(axis=1, keepdims=True)  # first to a common scale: squares must neither overflow nor vanish
    vectors = vectors / top
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def fit(sample: np.ndarray, n: int, seed: int = 3) -> Index:
    """Balanced spherical k-means on unit vectors: full clusters push vectors away, so lists come out even."""
    k = int(min(CENTROIDS, max(1, n // LIST), max(1, len(sample) // 4)))
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), k, replace=False)].copy()
    burden = np.zeros(k, np.float32)
    for _ in range(12):
        own = np.concatenate([(sample[a: a + 4096] @ centroids.T - burden).argmax(axis=1) for a in range(0, len(sample), 4096)])
        size = np.bincount(own, minlength=k)
        some = size > 0
        by_own = np.argsort(own, kind="stable")
        centroids[some] = np.add.reduceat(sample[by_own], (np.cumsum(size) - size)[some], axis=0)
        centroids[~some] = sample[rng.choice(len(sample), int((~some).sum()))]
        centroids /= np.maximum(1e-12, np.linalg.norm(centroids, axis=1, keepdims=True))
        burden = np.clip(burden + 0.02 * (size / max(1.0, len(sample) / k) - 1), 0, 0.2).astype(np.float32)
    near = centroids @ centroids.T
    np.fill_diagonal(near, -np.inf)
    degree = min(DEGREE, max(1, k - 1))
    graph = np.argsort(-near, axis=1, kind="stable")[:, :degree] if k > 1 else np.zeros((1, 1), int)
    # a ring through all centroids keeps the graph in one piece
    order = np.argsort(centroids @ rng.normal(size=centroids.shape[1]))
    ring = np.empty(k, int)
    ring[order] = np.roll(order, -1)
    entries = rng.choice(k, min(k, 32), replace=False)
    return Index(centroids.astype(np.float32), np.concatenate([graph, ring[:, None]], axis=1), entries)


def lists_of(index: Index, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(vectors, their lists, distances): first each vector's nearest list, then further ones near a border, without a distance."""
    found, far = index.nearest(vectors, 2 * COPIES)
    yield np.arange(len(vectors)), found[:, 0], far[:, 0]
    counts = np.ones(len(vectors), int)
    chosen = np.full((len(vectors), COPIES), -1)
    chosen[:, 0] = found[:, 0]
    for k in range(1, found.shape[1]):
        near = (far[:, k] <= COPY_RATIO * far[:, 0] + 1e-9) & (counts < COPIES)
        for j in range(COPIES):
            other = chosen[:, j]
            apart = np.sqrt(np.maximum(0, 2 - 2 * (index.centroids[found[:, k]] * index.centroids[other]).sum(axis=1)))
            near &= (other < 0) | (apart >= far[:, k])
        rows = np.flatnonzero(near)
        chosen[rows, counts[rows]] = found[rows, k]
        counts[rows] += 1
        yield rows, found[rows, k], np.full(len(rows), np.nan)


def calibrate(index: Index, held: np.ndarray, asked: np.ndarray, true: np.ndarray, sizes: np.ndarray, recall: float) -> Visits:
    """The pair of a ratio and a number of lists that finds ``recall`` of the neighbours and scans least.  ``held``: unit
    vectors; ``true``: neighbours of theirs, as unit vectors, each of the vector numbered by ``asked``; ``sizes`` of the lists."""
    c = len(index.centroids)
    if not len(true):
        return Visits(c, np.inf)
    score = held @ index.centroids.T
    order = np.argsort(-score, axis=1, kind="stable")
    far = _far(np.take_along_axis(score, order, axis=1))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(c), order.shape), axis=1)
    first = np.full(len(true), c)  # the place of the first list that holds the neighbour
    for rows, lists, _ in lists_of(index, true):
        first[rows] = np.minimum(first[rows], place[asked[rows], lists])
    ratios = far / np.maximum(far[:, :1], 1e-9)
    needed = ratios[asked, first]
    held_by = np.cumsum(sizes[order], axis=1)
    best, least = Visits(c, np.inf), np.inf
    for share in np.linspace(recall, 1, 13):
        ratio = float(np.quantile(needed, share, method="higher"))
        inside = np.sort(np.where(needed <= ratio, first, c))
        lists = int(inside[int(np.ceil(recall * len(true))) - 1]) + 1
        go = np.minimum((ratios <= ratio).sum(axis=1), lists)
        cost = float(np.mean(held_by[np.arange(len(held)), go - 1]))
        if cost < least:
            best, least = Visits(min(lists, c), ratio * (1 + 1e-6)), cost
    return best


def probes(index: Index, visits: Visits, vectors: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(queries, lists to visit)."""
    found, far = index.nearest(vectors, visits.lists)
    held = np.cumsum(sizes[found], axis=1)
    go = (far <= visits.ratio * np.maximum(far[:, :1], 1e-9)) | (held - sizes[found] < LEAST)
    q, k = np.nonzero(go)
    yield q, found[q, k]
    few = np.flatnonzero(held[:, -1] < LEAST)  # then other lists, too, nearest first
    if len(few) and found.shape[1] < len(sizes):
        found, _ = index.nearest(vectors[few], len(sizes))
        before = np.cumsum(sizes[found], axis=1) - sizes[found]
        before[:, : visits.lists] = LEAST  # visited
        q, k = np.nonzero(before < LEAST)
        yield few[q], found[q, k]


def open_lists(index: Index, vectors: np.ndarray, bounds: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(queries, lists) where a list may hold a vector within a query's bound: by the triangle inequality it lies at least as
    far as the list's centroid less the list's radius."""
    return np.nonzero((_far(vectors @ index.centroids.T) - radii <= bounds[:, None] + SLACK) & (radii >= 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def usable(vectors: DataFrame, vec_id: str, vector: str, dimension: int | None = None) -> DataFrame:
    """(id, vector) of rows with an id and a vector of ``dimension`` finite components, not all 0; without one, of the commonest length."""
    odd = F.exists(F.col("vector"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("vector")).where(F.col("id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0))
    rows = rows.where(~odd & F.exists(F.col("vector"), lambda x: x != 0))
    if dimension is None:
        usual = rows.groupBy(F.size("vector").alias("_n")).count().orderBy(F.desc("count"), "_n").limit(1).collect()
        dimension = usual[0]["_n"] if usual else 0
    return rows.where(F.size("vector") == dimension)


def _fitted(sample: DataFrame, n: int) -> Index:
    """The index of the bounded ``sample``, fitted in a task; the driver gets its centroids and graph."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [unit(_matrix(batch.column(0))) for batch in batches if batch.num_rows]
        if parts:
            index = fit(np.concatenate(parts), n)
            arrays = (index.centroids.astype(np.float32), index.graph.astype(np.int32), index.entries.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in arrays]), pa.array([x.shape[-1] for x in arrays], pa.int32())], names=["cells", "width"])

    one = sample.repartition(1).sortWithinPartitions(F.xxhash64(F.lit(1), "id"), "id", F.xxhash64("vector")).select("vector")
    centroids, graph, entries = [(bytes(r["cells"]), r["width"]) for r in one.mapInArrow(tidy(work), "cells binary, width int").collect()]
    return Index(np.frombuffer(centroids[0], np.float32).reshape(-1, centroids[1]), np.frombuffer(graph[0], np.int32).reshape(-1, graph[1]).astype(np.int64), np.frombuffer(entries[0], np.int32).astype(np.int64))


def _drawn(rows: DataFrame, most: int, seed: int) -> DataFrame:
    """At most ``most`` rows, the first by a hash."""
    return rows.orderBy(F.xxhash64(F.lit(seed), "id"), "id", F.xxhash64("vector")).limit(most)


def _neighbours(rows: DataFrame, held: np.ndarray, names: list, k: int) -> DataFrame:
    """(asked, vector): the ``k`` nearest of all ``rows`` for each of the held unit vectors, their own ids left out."""
    kinds = dict(rows.dtypes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.asarray(names)
        best, cells = np.full((len(held), 0), 0.0, np.float32), None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                score = held @ unit(_matrix(part.column(1))).T
                score[own[:, None] == np.asarray(part.column(0))[None, :]] = -np.inf
                matrix = _matrix(part.column(1))
                pick = np.argsort(-score, axis=1, kind="stable")[:, :k]
                values = np.concatenate([best, np.take_along_axis(score, pick, axis=1)], axis=1)
                found = matrix[pick] if cells is None else np.concatenate([cells, matrix[pick]], axis=1)
                order = np.argsort(-values, axis=1, kind="stable")[:, :k]
                best, cells = np.take_along_axis(values, order, axis=1), np.take_along_axis(found, order[:, :, None], axis=1)
        if cells is not None:
            fine = ~np.isneginf(best)
            flat = cells[fine]
            out = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.nonzero(fine)[0].astype(np.int32)), pa.array(best[fine].astype(np.float64)), out], names=["asked", "score", "vector"])

    near = rows.select("id", "vector").mapInArrow(tidy(work), f"asked int, score double, vector {kinds['vector']}")
    place = F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score")))
    return near.withColumn("_n", place).where(F.col("_n") <= k).select("asked", "vector")


def search(vectors: DataFrame, every: int, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", recall: float = RECALL, exact: bool = False, dimension: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row whose id is divisible by ``every``.

    Candidates are all rows but those with the query's id.  Rows without a usable vector (:func:`usable`) take no part.
    Rows that repeat a vector are candidates by their ``k`` + 1 smallest ids, which is all that a result can hold;
    rows that repeat an id count once, by their best score.  Ties go to smaller ids.  An empty table gives no rows;
    other columns are not read.

    ``recall``: share of the true neighbours that the visits are calibrated to find (:func:`calibrate`).  ``exact``: no
    neighbour is missed; how many more lists that takes depends on the vectors, up to all of them.
    """
    spark = vectors.sparkSession
    usual = usable(vectors, vec_id, vector, dimension)
    kinds = dict(usual.dtypes)
    schema = T.StructType([T.StructField("query_id", usual.schema["id"].dataType, True), T.StructField("rank", T.IntegerType()), T.StructField(vec_id, usual.schema["id"].dataType), T.StructField("score", T.DoubleType())])
    same = Window.partitionBy("vector").orderBy("id")
    rows = kept(usual.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).select("id", "vector", "copy"), "ann-vectors")
    different = rows.where("copy = 1")
    n = different.count()
    if not n:
        return spark.createDataFrame([], schema)
    index = _fitted(kept(_drawn(different, SAMPLE, 1), "ann-sample"), n)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                for which, lists, far in lists_of(index, unit(_matrix(part.column(1)))):
                    yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), *(c.take(pa.array(which)) for c in part.columns), pa.array(far.astype(np.float64), from_pandas=True)], names=["list", "id", "vector", "far"])

    shape = f"list int, id {kinds['id']}, vector {kinds['vector']}"
    data = kept(rows.select("id", "vector").mapInArrow(tidy(place), f"{shape}, far double"), "ann-lists")
    sizes, radii = np.zeros(len(index.centroids), np.int64), np.full(len(index.centroids), -1.0)
    for r in data.groupBy("list").agg(F.count("list").alias("n"), F.max("far").alias("radius")).collect():  # a row per centroid at most
        sizes[r["list"]] = r["n"]
        if r["radius"] is not None:
            radii[r["list"]] = r["radius"]
    # drawn anew, so they are of the sample as often as any query is: vectors of the fit lie nearer to their centroids
    some = _drawn(different, HELD, 2).select("id", "vector").toArrow().combine_chunks()
    held = unit(_matrix(some.column("vector").combine_chunks()))
    near = _neighbours(rows, held, some.column("id").to_pylist(), k).toArrow().combine_chunks()
    visits = Visits(len(sizes), np.inf)
    if near.num_rows:
        visits = calibrate(index, held, np.asarray(near.column("asked")), unit(_matrix(near.column("vector").combine_chunks())), sizes, recall)
    chunks = np.maximum(1, -(-sizes // CHUNK))
    chunk_of = F.pmod(F.xxhash64("id"), F.element_at(F.array(*map(F.lit, map(int, chunks))), F.col("list") + 1)) if (chunks > 1).any() else F.lit(0)

    def sent(part: pa.RecordBatch, which: np.ndarray, lists: np.ndarray) -> pa.RecordBatch:
        times = chunks[lists]  # a query goes to all chunks of a list
        which, lists = np.repeat(which, times), np.repeat(lists, times)
        number = np.arange(len(lists)) - np.repeat(np.cumsum(times) - times, times)
        return pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), part.column(0).take(pa.array(which)), part.column(1).take(pa.array(which)), pa.array(number.astype(np.int32))], names=["list", "id", "vector", "chunk"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for which, lists in probes(index, visits, unit(_matrix(part.column(1))), sizes):
                    yield sent(part, which, lists)

    def probe_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                bounds = np.asarray(part.column(2).fill_null(np.inf))
                yield sent(part, *open_lists(index, unit(_matrix(part.column(1))), bounds, radii))

    def nearest(queries: DataFrame) -> DataFrame:
        both = data.drop("far").withColumn("chunk", chunk_of.cast("int")).withColumn("asks", F.lit(False)).unionByName(queries.withColumn("asks", F.lit(True)))
        both = both.repartition("list", "chunk").sortWithinPartitions("list", "chunk", "asks").select("list", "chunk", "asks", "id", "vector")
        hits = both.mapInArrow(tidy(lambda batches: _combined(_scan(batches, k), k)), f"query_id {kinds['id']}, found {kinds['id']}, score double")
        hits = hits.groupBy("query_id", "found").agg(F.max("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "found"))
        return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("found").alias(vec_id), "score")

    asks = usual.where(F.col("id") % every == 0)
    first = nearest(asks.mapInArrow(tidy(probe), f"{shape}, chunk int"))
    if not exact:
        return first
    # equal vectors share a query's bound only if their ids are equal, too; then the wider one holds
    bound = kept(first.where(F.col("rank") == k).select(F.col("query_id").alias("_of"), F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("score"))).alias("bound")), "ann-bounds")
    if asks.groupBy("id").count().where("count > 1").isEmpty():
        again = asks.join(bound, F.col("id") == F.col("_of"), "left").select("id", "vector", "bound")
    else:  # rows of one id are one query with several vectors: the best of all vectors is no bound for each
        again = asks.select("id", "vector", F.lit(None).cast("double").alias("bound"))
    return nearest(again.mapInArrow(tidy(probe_rest), f"{shape}, chunk int"))


def _scan(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Each chunk's vectors come first and stay, then its queries stream by."""
    now, names, cells = None, [], []
    ids = matrix = length = order = None
    for batch in batches:
        keys = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in range(3)], axis=1)
        borders = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            if a == b:
                continue
            key, part = tuple(keys[a, :2]), batch.slice(a, b - a)
            if key != now:
                now, names, cells, ids = key, [], [], None
            if not keys[a, 2]:
                names.append(part.column(3))
                cells.append(_matrix(part.column(4)).astype(np.float64))
                continue
            if not names:
                continue
            if ids is None:
                ids, matrix = pa.concat_arrays(names), np.concatenate(cells)
                matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
                length, order = np.linalg.norm(matrix, axis=1), np.asarray(ids)
            for at in range(0, b - a, 256):
                asked = part.slice(at, 256)
                q = _matrix(asked.column(4)).astype(np.float64)
                q = q / np.abs(q).max(axis=1, keepdims=True)
                own, size = np.asarray(asked.column(3)), np.linalg.norm(q, axis=1)
                rough = (q @ matrix.T) / (size[:, None] * length[None, :])
                rough[own[:, None] == order[None, :]] = -np.inf
                # repeated ids may take places, so a few more are kept than asked for
                many = min(2 * k, rough.shape[1])
                floor = -np.partition(-rough, many - 1, axis=1)[:, many - 1]
                q_at, at_ = np.nonzero((rough >= floor[:, None] - 1e-12) & ~np.isneginf(rough))
                # the product's last bits depend on its shape, so what may stay is scored pair by pair: equal vectors tie
                values = (q[q_at] * matrix[at_]).sum(axis=1) / (size[q_at] * length[at_])
                best = np.lexsort((order[at_], -values, q_at))
                starts = np.searchsorted(q_at, q_at)  # of each query's run: q_at rises
                best = best[np.arange(len(best)) - starts < many]
                yield pa.RecordBatch.from_arrays([asked.column(3).take(pa.array(q_at[best])), ids.take(pa.array(at_[best])), pa.array(values[best])], names=["query_id", "found", "score"])


def _combined(hits: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The hits of a task with, as far as ``HITS`` rows at once allow, each query's best ``k`` ids only."""
    held, rows = [], 0
    for batch in hits:
        held.append(batch)
        rows += batch.num_rows
        if rows >= HITS:
            best = _best(held, k)
            held, rows = [best], best.num_rows
            if rows >= HITS // 2:  # other queries, mostly: nothing to gain from holding them
                yield best
                held, rows = [], 0
    if rows:
        yield _best(held, k)


def _best(held: list[pa.RecordBatch], k: int) -> pa.RecordBatch:
    hits = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    query, found, score = (np.asarray(hits.column(c)) for c in range(3))
    order = np.lexsort((-score, found, query))  # an id's best score first
    once = np.ones(len(order), bool)
    once[1:] = (query[order[1:]] != query[order[:-1]]) | (found[order[1:]] != found[order[:-1]])
    order = order[once]
    order = order[np.lexsort((found[order], -score[order], query[order]))]
    place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
    return hits.take(pa.array(order[place < k]))
