"""Exact n-gram Jaccard join in the metric space of shingle sets (operator 11).

Jaccard distance is a metric.  Pivots, themselves documents, cut a region of documents into Voronoi cells: a document is
at home in the cell of its nearest pivot, or outside all cells where none is within ``RADIUS``.  By the triangle
inequality a document can be linked with one at home in a cell only if its own distance to that cell's pivot exceeds
neither its least distance to a pivot by more than two thresholds, nor ``RADIUS`` by more than one; such boundary documents
are replicated into the cell's window.  So every linked pair meets in the home cell of one of the two, and cells are joined
the same way again, down to a few documents that are compared outright.  All comparisons are on full sets.

In Jaccard space nearly all documents are at distance one of each other, and no pivot tells them apart.  The first
regions therefore are what equal parts of sets connect: shingles are dealt to more parts, by their hash, than two linked
sets of a size class can differ in, so linked sets have an equal part.  Shingles that many texts hold are left out of
the parts, so that a common passage doesn't make parts equal, and parts of single shingles don't count, so that chance doesn't.  Regions beyond ``LEAF`` shingles are cut by pivots in parallel,
chunk by chunk; smaller ones are joined in one task.  A region that pivots do not halve is compared in blocks, where
documents that are linked with one pivot need not be compared with each other: what is wanted is what connects, not
all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorwatch.llm import shingles
from rotorwatch.llm.common import arrow_rows, kept, tidy
from rotorwatch.llm.components import components
from rotorwatch.llm.pretokens import text_slices

WORDS = 4
PERCENT = 85
RADIUS = 0.5  # distance to its pivot up to which a document is at home in a cell
LEAF = 1 << 22  # shingles of a region that one task joins (32 MB); a document counts as 512 at least
SPREAD = 3.0  # cells a member may be in, on average, for a cut to pay
FEW = 48  # documents compared outright
FREQUENT = 1 << 16  # frequent shingles that the order puts last: a fixed bound of 512 KB
SLICE_FREQUENT = 4_096  # what each slice of text puts forward
SLICE = 8 << 20
TURNS = 8  # ways to deal out a set to parts, before empty parts count
WANTED_BITS = 1 << 26  # of the bitmap of wanted ids: a fixed bound of 8 MB
_SLACK = 1e-9  # distances are compared as doubles, links as integers


def _ref(sigs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), np.int64)[::2]


def set_rows(docs: DataFrame, doc_id: str, text: str, words: int) -> tuple[DataFrame, np.ndarray]:
    """(id, n, sig, ref) of all rows, each one's set size, 128 bits that stand for its set, and the first 64 of them; and at most ``FREQUENT`` shingles that
    many sets hold, by what the slices of text put forward.  Those decide which regions there are, never which links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in text_slices(batch.column(1), SLICE):
                sets = shingles.shingle_sets(part, words)
                sigs = [shingles.signature(s) for s in sets]
                different = dict(zip(sigs, sets, strict=True))
                found, n = np.unique(np.concatenate(list(different.values())), return_counts=True)
                found, n = found[n >= 8], n[n >= 8]
                if len(n) > SLICE_FREQUENT:
                    top = np.argpartition(-n, SLICE_FREQUENT)[:SLICE_FREQUENT]
                    found, n = found[top], n[top]
                yield rows([batch.column(0).slice(at, len(part)), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.binary()), pa.array(_ref(sigs))])
                yield rows([pa.nulls(len(n), batch.column(0).type), pa.array(n), pa.nulls(len(n), pa.binary()), pa.array(found.view(np.int64))])

    def rows(columns: list[pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(columns, names=["id", "n", "sig", "ref"])

    out = T.StructType([T.StructField("id", docs.schema[doc_id].dataType), T.StructField("n", T.LongType()), T.StructField("sig", T.BinaryType()), T.StructField("ref", T.LongType())])
    both = kept(arrow_rows(docs, doc_id, text).mapInArrow(tidy(work), out), "join-sets")
    found = kept(both.where("sig IS NULL").groupBy(F.col("ref").alias("shingle")).agg(F.sum("n").alias("n")), "frequent-shingles")
    held, least = 0, None
    level = F.floor(F.log2("n")).cast("int").alias("level")
    for r in found.groupBy(level).count().orderBy(F.desc("level")).collect():  # some 60 rows
        held += r["count"]
        if held > FREQUENT:
            break
        least = 1 << r["level"]
    frequent = found.where(F.col("n") >= least).select("shingle").collect() if least else []
    return both.where("sig IS NOT NULL"), np.sort(np.array([r[0] for r in frequent], np.int64).view(np.uint64))


def size_class(n: int) -> tuple[int, int]:
    """A size's class, and the largest size in it: about a quarter more than in the class before."""
    most = place = 1
    while most < n:
        most, place = max(most + 1, most * 5 // 4), place + 1
    return place, most


def part_keys(own: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set's parts, in all size classes where it may meet a linked set; two different linked sets have one in common.

    Linked sets of at most B shingles differ in at most H = floor(2 B (100 - percent) / (100 + percent)) ones, so in m > H parts at
    least m - H are equal.  A part gets a key if it has two shingles at least: long texts that have nothing else in common share
    single ones, more the larger the table is.  Where a set has m - H parts or more without a key, an equal one may be among
    them, and the set is dealt out again, by another hash and with its frequent shingles; so are all sets that it could
    miss there.  The later turns take single shingles, and the last one empty parts.
    """
    n = len(own)
    if not n:
        return np.zeros(0, np.int64)
    rare = own
    if len(frequent):
        rare = own[frequent[np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)] != own]
    dealt: list[tuple[np.ndarray, np.ndarray]] = []
    out = []
    place, most = size_class(n)
    while True:
        differ = 2 * most * (100 - percent) // (100 + percent)
        parts = differ + 1 + differ // 3
        for turn in range(TURNS + 1 if differ else 0):  # none: linked sets are equal
            if turn == len(dealt):
                again = np.sort(shingles._mixed(own + np.uint64(turn))) if turn else rare
                dealt.append((again >> np.uint64(32), np.concatenate([[np.uint64(0)], np.cumsum(shingles._mixed(again + np.uint64(1)), dtype=np.uint64)])))
            at, mixed = dealt[turn]
            part = (at * np.uint64(parts)) >> np.uint64(32)
            border = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]]) if len(part) else np.zeros(1, np.int64)
            has = np.diff(border) >= (2 if turn < TURNS // 2 and most >= 4 * parts else 1)
            some, key = part[border[:-1][has]], (mixed[border[1:]] - mixed[border[:-1]])[has]
            weak = parts - len(some)
            if turn == TURNS:
                none = np.setdiff1d(np.arange(parts, dtype=np.uint64), some)
                some, key = np.append(some, none), np.append(key, np.zeros(len(none), np.uint64))
            out.append(shingles._mixed(shingles._mixed(key + some) + np.uint64(place + (turn << 32))))
            if weak < parts - differ:
                break
        if n * 100 // percent <= most:
            return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)
        most, place = max(most + 1, most * 5 // 4), place + 1


def meetings(docs: DataFrame, text: str, frequent: np.ndarray, percent: int, words: int) -> DataFrame:
    """(a, b): pairs of classes that connect all classes with an equal key.  Classes go by the first 64 bits of their signatures: two that
    share these are in one region, no more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # copies in one task need their keys but once
        for batch in batches:
            for _, part in text_slices(batch.column(0)):
                keys, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for own in shingles.shingle_sets(part, words):
                    sig = shingles.signature(own)
                    if sig not in seen:
                        seen.add(sig)
                        keys.append(part_keys(own, frequent, percent))
                        of.append(np.full(len(keys[-1]), _ref([sig])[0]))
                if len(seen) > 1 << 16:
                    seen.clear()
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(of))], names=["key", "ref"])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, center = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, ref = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            new = np.append(True, key[1:] != key[:-1])
            new[0] = key[0] != last
            begins = np.flatnonzero(new)
            centers = ref[begins][np.cumsum(new) - 1] if len(begins) else np.zeros(len(ref), np.int64)
            if not new[0]:
                centers[: begins[0] if len(begins) else len(ref)] = center
            last, center = key[-1], centers[-1]
            pairs = np.unique(np.stack([ref, centers], axis=1)[ref != centers], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    rows = arrow_rows(docs, text).mapInArrow(tidy(work), "key long, ref long").repartition("key").sortWithinPartitions("key", "ref")
    return rows.mapInArrow(tidy(edges), "a long, b long").distinct()


# what a task does with the sets it holds


class Links:
    """Links found by a task, as many as connect what is linked."""

    def __init__(self) -> None:
        self.up: dict[bytes, bytes] = {}
        self.found: list[tuple[bytes, bytes]] = []

    def root(self, x: bytes) -> bytes:
        while (up := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(up, up)
        return x

    def known(self, a: bytes, b: bytes) -> bool:
        """Notes that ``a`` and ``b`` are connected; whether that is new."""
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b

    def add(self, a: bytes, b: bytes) -> None:
        if self.known(a, b):
            self.found.append((max(a, b), min(a, b)))

    def take(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([f[k] for f in self.found], pa.binary()) for k in (0, 1)], names=["a", "b"])
        self.found = []
        return out


class Member:
    """A set in a region: at home there or in its window only; ``root`` is the pivot it is known to be linked with, or itself."""

    __slots__ = ("home", "root", "sig", "own")

    def __init__(self, home: bool, root: bytes, sig: bytes, own: np.ndarray) -> None:
        self.home, self.root, self.sig, self.own = home, root, sig, own


def overlaps(left: list[Member], right: list[Member]) -> tuple[np.ndarray, np.ndarray]:
    """[l, r]: sizes of intersections and of unions; ``right`` is sorted once, ``left`` goes by parts that bound what is held at once."""
    n = np.array([len(m.own) for m in left]), np.array([len(m.own) for m in right])
    theirs = np.concatenate([m.own for m in right])
    order = np.argsort(theirs, kind="stable")
    theirs, owner = theirs[order], np.repeat(np.arange(len(right)), n[1])[order]
    first = np.flatnonzero(np.append(True, theirs[1:] != theirs[:-1]))
    table, count = theirs[first], np.diff(np.append(first, len(theirs)))
    # shingles that many hold are multiplied as matrices, others are looked up
    common = np.flatnonzero(count > max(8, len(right) // 8))
    place = np.full(len(table), -1)
    place[common] = np.arange(len(common))
    inter = np.zeros((len(left), len(right)), np.int64)
    for begin, end in _parts(n[0], 1 << 20):
        mine = np.concatenate([m.own for m in left[begin:end]])
        at = np.minimum(np.searchsorted(table, mine), len(table) - 1)
        hit = np.flatnonzero(table[at] == mine)
        who, at = np.repeat(np.arange(end - begin), n[0][begin:end])[hit], at[hit]
        column = place[at]
        for low in range(0, len(common), 512):
            some = common[low: low + 512]
            mine_in, their_in = (np.zeros((k, len(some)), np.float32) for k in (end - begin, len(right)))
            held = np.flatnonzero((column >= low) & (column < low + 512))
            mine_in[who[held], column[held] - low] = 1
            their_in[owner[_runs(first[some], count[some])], np.repeat(np.arange(len(some)), count[some])] = 1
            inter[begin:end] += (mine_in @ their_in.T).astype(np.int64)
        who, at = who[column < 0], at[column < 0]
        border = np.searchsorted(who, np.arange(end - begin + 1))
        found = np.concatenate([[0], np.cumsum(count[at])])[border]
        for low, high in _parts(np.diff(found), 1 << 21):
            rows, these = who[border[low]: border[high]] - low, at[border[low]: border[high]]
            cell = np.repeat(rows, count[these]) * len(right) + owner[_runs(first[these], count[these])]
            inter[begin + low: begin + high] += np.bincount(cell, minlength=(high - low) * len(right)).reshape(high - low, len(right))
    return inter, n[0][:, None] + n[1][None, :] - inter


def _parts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(begin, end) of runs of ``sizes`` that add up to ``most`` at the most, or are one."""
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + most, "right")))
        yield begin, end
        begin = end


def _runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``first``, one run after the other."""
    return np.arange(int(count.sum())) + np.repeat(first - np.cumsum(count) + count, count)


def apart(pivots: list[Member], percent: int) -> list[Member]:
    """Of ``pivots``, in order of their signatures, those that no earlier one is linked with: a tight group needs but one."""
    pivots = sorted(pivots, key=lambda m: m.sig)
    inter, union = overlaps(pivots, pivots)
    near = 100 * inter >= percent * union
    stay: list[int] = []
    for k in range(len(pivots)):
        if not near[k, stay].any():
            stay.append(k)
    return [pivots[k] for k in stay]


def placed(members: list[Member], pivots: list[Member], percent: int, links: Links) -> Iterator[tuple[int, Member]]:
    """(cell, member as it is there) of all ``members``; the cell after the last pivot's is the outside.  Adds their links with
    pivots."""
    limit = 1 - percent / 100
    inter, union = overlaps(members, pivots)
    away = 1 - inter / union
    linked = 100 * inter >= percent * union
    nearest = away.argmin(axis=1)
    least = away[np.arange(len(members)), nearest]
    window = away <= np.minimum(least[:, None] + 2 * limit, RADIUS + limit) + _SLACK
    for k, j in zip(*np.nonzero(linked), strict=True):
        links.add(members[k].sig, pivots[j].sig)
    outside = len(pivots)
    for k, m in enumerate(members):
        j = int(nearest[k])
        root = pivots[j].sig if linked[k, j] else m.root
        home = j if least[k] <= RADIUS else outside
        if m.home:
            yield home, Member(True, root, m.sig, m.own)
        elif least[k] > RADIUS - limit - _SLACK:
            yield outside, Member(False, root, m.sig, m.own)
        for c in np.flatnonzero(window[k]):
            if not (m.home and c == home):
                yield int(c), Member(False, root, m.sig, m.own)


def whole(members: list[Member], pivots: list[Member], roots: list[bytes], percent: int, links: Links) -> list[Member]:
    """``members``, each with the root (of ``roots``) of a pivot that it is linked with for its own.  Adds those links."""
    inter, union = overlaps(members, pivots)
    linked = 100 * inter >= percent * union
    for k, j in zip(*np.nonzero(linked), strict=True):
        links.add(members[k].sig, pivots[j].sig)
    return [Member(m.home, roots[int(row.argmax())] if row.any() else m.root, m.sig, m.own) for m, row in zip(members, linked, strict=True)]


def outright(asking: list[Member], members: list[Member], percent: int, links: Links) -> None:
    """Links of ``asking`` members with all, where one of the two is at home, block by block."""
    home = np.array([m.home for m in members])
    block = 256
    for at in range(0, len(asking), block):
        some = asking[at: at + block]
        inter, union = overlaps(members, some)
        near = (100 * inter >= percent * union) & (home[:, None] | np.array([m.home for m in some])[None, :])
        for k, j in zip(*np.nonzero(near), strict=True):
            links.add(members[k].sig, some[j].sig)


def minority(members: list[Member], links: Links) -> list[Member]:
    """Members outside the largest part that is connected already."""
    roots = [links.root(m.sig) for m in members]
    names, back, n = np.unique(np.array(roots, "S16"), return_inverse=True, return_counts=True)
    return [members[k] for k in np.flatnonzero(back != n.argmax())]


def join(members: list[Member], percent: int, links: Links, depth: int = 0) -> None:
    """Links of a region that a task holds: by pivots, cell by cell, recursively."""
    if not any(m.home for m in members):
        return
    for m in members:
        links.known(m.sig, m.root)
    asking = minority(members, links)
    if not asking:
        return
    if len(members) <= FEW or depth > 30:
        return outright(asking, members, percent, links)
    homes = [m for m in members if m.home]
    step = max(1, len(homes) // max(4, int(len(members) ** 0.5)))
    cells: dict[int, list[Member]] = {}
    for cell, m in placed(members, apart(homes[::step], percent), percent, links):
        cells.setdefault(cell, []).append(m)
    if max(map(len, cells.values())) > 0.7 * len(members):  # pivots tell too few apart
        return outright(minority(members, links), members, percent, links)
    for cell in cells.values():
        join(cell, percent, links, depth + 1)


# regions

REGION = "region long, ceiling long, home boolean, root binary, sig binary, n long, own binary"


def _members(batch: pa.RecordBatch) -> list[Member]:
    home, root, sig, own = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("home", "root", "sig", "own"))
    return [Member(h, r, s, np.frombuffer(o, np.uint64)) for h, r, s, o in zip(home, root, sig, own, strict=True)]


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """(whether a new group begins, rows of one group): groups are runs of equal values in the first ``keys`` columns."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*(c.to_pylist() for c in batch.columns[:keys]), strict=True))
        begin = 0
        for k in range(1, len(values) + 1):
            if k == len(values) or values[k] != values[begin]:
                yield values[begin] != before, batch.slice(begin, k - begin)
                before, begin = values[begin], k


def weight(leaf: int) -> Column:
    """A member's share of a task of ``leaf`` shingles, so that neither shingles nor members add up."""
    return F.greatest("n", F.lit(leaf >> 13))


def leaf_links(regions: DataFrame, percent: int) -> DataFrame:
    """(a, b): links inside regions that fit a task each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[Member] = []
        for new, rows in _groups(batches, 1):
            if new and members:
                links = Links()
                join(members, percent, links)
                yield links.take()
                members = []
            members += [m for m in _members(rows) if not (members and members[-1].sig == m.sig and members[-1].home)]
        if members:
            links = Links()
            join(members, percent, links)
            yield links.take()

    rows = regions.repartition("region").sortWithinPartitions("region", "sig", F.desc("home"))
    return arrow_rows(rows, "region", "home", "root", "sig", "own").mapInArrow(tidy(work), "a binary, b binary")


def _cell(region: int, pivot: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(region.to_bytes(8, "little", signed=True) + pivot, digest_size=8).digest(), "little", signed=True)


def cut(regions: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(cells, links) of regions that are too large for a task: (region, ceiling, home, root, sig, n, own) again, and links with pivots.

    ``regions`` also has ``parts`` (chunks that its members are dealt to), ``first`` (its first member by ``dice``) and ``dice``, a
    hash.  The pivots of a region fill a quarter of a task, and every chunk gets them all.  Where the pivots themselves show that
    cells would overlap too much to be worth it, the region stays whole, under a ceiling of 0.
    """
    pivot = F.col("home") & ((F.pmod("dice", F.col("parts")) == 0) | (F.col("sig") == F.col("first")))
    chunk = F.pmod(F.xxhash64("sig", F.lit(2)), F.col("parts")).cast("long")
    columns = ["region", "chunk", "pivot", "ceiling", "home", "root", "sig", "own"]
    rows = regions.withColumn("chunk", chunk).withColumn("pivot", F.lit(0)).select(*columns)
    pivots = regions.where(pivot).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))).withColumn("pivot", F.lit(1)).select(*columns)
    rows = rows.unionByName(pivots).repartition("region", "chunk").sortWithinPartitions("region", "chunk", F.desc("pivot"), "sig")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: list[Member] = []
        links, stay, roots, ready = Links(), [], [], False
        for new, batch in _groups(batches, 3):
            region, _, is_pivot, ceiling = (batch.column(c)[0].as_py() for c in range(4))
            if is_pivot:
                if new:
                    pivots, links, ready = [], Links(), False
                pivots += _members(batch)
                continue
            if not ready:
                stay, ready = apart(pivots, percent), True
                names = [_cell(region, p.sig) for p in stay] + [_cell(region, b"")]
                most = int(SPREAD * len(pivots))
                pays = sum(1 for _ in islice(placed(pivots, stay, percent, links), most + 1)) <= most
                roots = [links.root(p.sig) for p in stay]  # by the pivots' links, which are the same in every chunk
            for at in range(0, batch.num_rows, 512):
                members = _members(batch.slice(at, 512))
                if pays:
                    found = list(placed(members, stay, percent, links))
                else:
                    found = [(-1, m) for m in whole(members, stay, roots, percent, links)]
                    ceiling = 0
                cells = [[names[c] for c, _ in found], [ceiling] * len(found), [m.home for _, m in found], [m.root for _, m in found], [m.sig for _, m in found],
                         [len(m.own) for _, m in found], [m.own.tobytes() for _, m in found]]
                pairs, links.found = links.found, []
                none = [None] * len(pairs)
                cells = [c + x for c, x in zip(cells, (none, none, none, [b for _, b in pairs], [a for a, _ in pairs], none, none), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types, strict=True)], names=REGION.replace(",", "").split()[::2])

    types = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
    out = kept(arrow_rows(rows, *columns).mapInArrow(tidy(work), REGION), "cells")
    return out.where("region IS NOT NULL"), out.where("region IS NULL").select(F.col("sig").alias("a"), F.col("root").alias("b"))


def block_links(regions: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of regions that pivots do not cut, block by block: members stay in a chunk, and those outside the region's
    largest part, by what they are known to be linked with, ask in every chunk."""
    parts = regions.groupBy("region", "root").agg(F.count(F.lit(1)).alias("_n")).groupBy(F.col("region").alias("_region")).agg(F.max(F.struct("_n", "root"))["root"].alias("_major"))
    chunk = F.pmod(F.xxhash64("sig", F.lit(2)), F.col("parts")).cast("long")
    columns = ["region", "chunk", "asks", "home", "root", "sig", "own"]
    rows = regions.withColumn("chunk", chunk).withColumn("asks", F.lit(0)).select(*columns)
    asks = regions.join(parts, F.col("region") == F.col("_region")).where("root != _major")
    asks = asks.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))).withColumn("asks", F.lit(1)).select(*columns)
    rows = rows.unionByName(asks).repartition("region", "chunk").sortWithinPartitions("region", "chunk", "asks", "sig")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stay: list[Member] = []
        links = Links()
        for new, batch in _groups(batches, 2):
            if new:
                stay, links = [], Links()
            asks = np.asarray(batch.column(2)) == 1
            members = _members(batch)
            stay += [m for m, a in zip(members, asks, strict=True) if not a]
            asking = [m for m, a in zip(members, asks, strict=True) if a]
            if asking and stay:
                outright(asking, stay, percent, links)
            yield links.take()

    return arrow_rows(rows, *columns).mapInArrow(tidy(work), "a binary, b binary")


def joined(regions: DataFrame, percent: int, leaf: int = LEAF) -> DataFrame:
    """(a, b): links of all regions; ``regions`` has (region, ceiling, home, root, sig, n, own)."""
    found = None
    while True:
        dice = F.xxhash64("region", "sig")
        sizes = regions.groupBy("region").agg(F.sum(weight(leaf)).alias("total"), F.max("ceiling").alias("most"), F.bool_or("home").alias("some"), F.min_by("sig", dice).alias("any"),
                                              F.min_by("sig", F.when(F.col("home"), dice)).alias("first")).where("some")
        sizes = kept(sizes.drop("some", "any"), "region-sizes")
        fits = F.col("total") <= leaf
        small = regions.join(sizes.where(fits).select("region"), "region", "left_semi")
        links = leaf_links(small, percent)
        large = sizes.where(~fits).withColumn("parts", F.ceil(F.col("total") * 4 / leaf))
        if not large.limit(1).count():
            links = kept(links, "links")
            return found.unionByName(links) if found is not None else links
        rows = regions.drop("ceiling").join(large, "region").withColumn("dice", dice)
        stuck = F.col("total") > F.col("most")
        links = links.unionByName(block_links(rows.where(stuck).withColumn("parts", F.ceil(F.col("parts") / 2)), percent))
        cells, more = cut(rows.where(~stuck).withColumn("ceiling", (F.col("total") / 2).cast("long")), percent)
        links = kept(links, "links").unionByName(more)
        found = found.unionByName(links) if found is not None else links
        regions = cells


def likely(rows: DataFrame, key: str, ids: DataFrame, most: int = WANTED_BITS) -> DataFrame:
    """Those of ``rows`` whose ``key`` may be an ``_id`` of ``ids``, null included: all that are, and of the others about one in
    sixteen.  What tells them apart is a bitmap of hashes of at most ``most`` bits; beyond that, more others stay."""
    bits = min(most, max(1 << 9, 16 * ids.count()))

    def place(id_column: str) -> Column:
        return F.pmod(F.xxhash64(id_column), F.lit(bits))

    maps = ids.groupBy(F.bitmap_bucket_number(place("_id")).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place("_id"))).alias("_bits"))
    at = F.bitmap_bit_position(place(key))
    byte = F.conv(F.hex(F.col("_bits").substr((F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return rows.join(F.broadcast(maps), (F.bitmap_bucket_number(place(key)) == F.col("_bucket")) & (F.bit_get(byte, (at % 8).cast("int")) == 1), "left_semi")


def own_sets(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame, words: int) -> DataFrame:
    """``wanted`` (sig, least, n, region) as members of their regions, with their full sets, from rows with an id of the class: a row
    per class, or a few where rows repeat an id and a text.

    An id that is the least of one class says which region its text is for, so sets are shuffled once, by region; of ids with
    several classes, the sets' signatures have to.  Texts are shuffled by id, but for those that a bitmap shows are not wanted.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for at, part in text_slices(batch.column(0)):
                rest = [c.slice(at, len(part)) for c in batch.columns[1:]]
                expected = rest[0].to_pylist()
                found = [(k, shingles.signature(s), s) for k, s in enumerate(shingles.shingle_sets(part, words))]
                found = [(k, sig, s.tobytes()) for k, sig, s in found if expected[k] in (None, sig) and not (sig in seen or seen.add(sig))]
                if len(seen) > 1 << 16:
                    seen.clear()
                yield pa.RecordBatch.from_arrays([pa.array([f[1] for f in found], pa.binary()), pa.array([f[2] for f in found], pa.binary()),
                                                  *(c.take(pa.array([f[0] for f in found], pa.int64())) for c in rest[1:])], names=["sig", "own", "n", "region"])

    def sets(rows: DataFrame) -> DataFrame:
        return arrow_rows(rows, "_whole", "_sig", "_n", "_region").mapInArrow(tidy(work), "sig binary, own binary, n long, region long")

    texts = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_whole"))
    ids = wanted.groupBy(F.col("least").alias("_id")).agg(F.count(F.lit(1)).alias("_classes"), F.first("sig").alias("_sig"), F.first("n").alias("_n"), F.first("region").alias("_region"))
    ids = kept(ids, "join-ids")
    texts = likely(texts, "_doc", ids)
    one, several = (F.col("_classes") == 1) & F.col("_id").isNotNull(), (F.col("_classes") > 1) | F.col("_id").isNull()
    members = sets(texts.join(ids.where(one), F.col("_doc") == F.col("_id")))
    if ids.where(several).limit(1).count():
        shared = texts.join(ids.where(several).select("_id"), F.col("_doc").eqNullSafe(F.col("_id")), "left_semi")
        shared = sets(shared.select("_whole", F.lit(None).cast("binary").alias("_sig"), F.lit(0).cast("long").alias("_n"), F.lit(0).cast("long").alias("_region")))
        members = members.unionByName(shared.select("sig", "own").join(wanted.select("sig", "n", "region"), "sig"))
    return members.select("region", F.lit((1 << 63) - 1).alias("ceiling"), F.lit(True).alias("home"), F.col("sig").alias("root"), "sig", "n", "own")


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, words: int = WORDS, leaf: int = LEAF) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row per row of ``docs``: documents whose sets of distinct ``words``-word shingles share
    ``percent`` of their union at least are linked; ``component_id`` is the smallest id reachable.

    Null and empty texts, and those without words, have no shingles and are linked with nothing; a text of fewer words
    is one shingle.  Rows with equal ids stay rows of their own; null ids count only where a component has no other.
    An empty table gives no rows; other columns of ``docs``, whatever their names, are not read.  ``leaf``: shingles of a region that
    one task joins.
    """
    rows, frequent = set_rows(docs, doc_id, text, words)
    ids = kept(rows.where("n > 0").groupBy("sig").agg(F.min("id").alias("least"), F.first("n").alias("n"), F.first("ref").alias("ref")), "join-classes")
    roots = kept(components(meetings(docs, text, frequent, percent, words)), "join-roots")
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    wanted = kept(ids.join(roots, F.col("ref") == F.col("node")).select("sig", "least", "n", F.col("root").alias("region")), "join-regions")
    # regions that a task holds are joined as they come; others are written, to be cut
    large = kept(wanted.groupBy("region").agg(F.sum(weight(leaf)).alias("_total")).where(F.col("_total") > leaf).select("region"), "join-large")
    links = leaf_links(own_sets(docs, doc_id, text, wanted.join(large, "region", "left_anti"), words), percent)
    if large.limit(1).count():
        regions = kept(own_sets(docs, doc_id, text, wanted.join(large, "region", "left_semi"), words).dropDuplicates(["sig"]), "regions")
        links = links.unionByName(joined(regions, percent, leaf))
    roots = components(links)

    named = ids.join(roots, F.col("sig") == F.col("node"), "left").select("sig", "least", F.coalesce("root", "sig").alias("_root"))
    least = named.groupBy(F.col("_root").alias("_r")).agg(F.min("least").alias("component_id"))
    named = named.join(least, F.col("_root") == F.col("_r")).select(F.col("sig").alias("_sig"), "component_id")
    out = rows.drop("ref").join(named, (F.col("sig") == F.col("_sig")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"))
