"""Operators 5, 6 and 10 against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF, make_docs, odd_rows  # noqa: F401
from rotorwatch.llm import components, exact, interleave, nearcopies, repeats, shingles

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n)]


# exact copies


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_copies(make_docs, odd_rows, keep):
    hot = [(100 + k, "The Same" if k % 2 else "the same", "h") for k in range(60)]
    rows = odd_rows + hot
    got = exact.exact_duplicates(make_docs(rows), keep=keep).collect()
    groups = defaultdict(list)
    for d, t, _ in rows:
        groups[(t or "").translate(LOWER)].append(d)
    want = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (min if keep == "smallest" else max)(known) if known else None
        left = 1
        for d in ids:
            stays = d == best and left > 0
            left -= stays
            want.append((d, best, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert exact.exact_duplicates(make_docs([])).count() == 0


def test_exact_only_ascii_capitals(make_docs):
    got = {r["doc_id"]: r["keep_id"] for r in exact.exact_duplicates(make_docs([(1, "É a", "x"), (2, "é a", "x"), (3, "é A", "x"), (4, "ΑΣ", "x"), (5, "ας", "x")])).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5}


def test_a_hot_group_is_dealt_to_many_partitions(spark, make_docs, monkeypatch):
    kept = {}
    real = exact.kept
    monkeypatch.setattr(exact, "kept", lambda df, name: kept.setdefault(name, real(df, name)))
    exact.exact_duplicates(make_docs([(k, "copy", "x") for k in range(400)])).count()
    assert kept["content-sort"].groupBy("_salt").count().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


# near copies


def sets_of(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i: i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def linked(rows, percent):
    own = [(d, sets_of(t)) for d, t, _ in rows]
    parent = list(range(len(own)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(own):
        for j in range(i):
            b = own[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(own):
        least[root(i)].append(d)
    known = {r: min((x for x in v if x is not None), default=None) for r, v in least.items()}
    return sorted(str((d, len(s), known[root(i)] if s else d, d == (known[root(i)] if s else d))) for i, (d, s) in enumerate(own))


def near_rows():
    rng = random.Random(4)
    rows, base = [], words(1, 120)
    rows.append((1000, " ".join(base), "s"))
    for k in range(60):  # near copies of one document, of which some are near each other only through others
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(30)}"
        rows.append((k, " ".join(w), "s"))
    chain = words(2, 200)
    for k in range(12):  # a chain: neighbours are near, ends are not
        rows.append((200 + k, " ".join([f"c{j}" for j in range(k * 3)] + chain[k * 3:]), "s"))
    for k in range(40):  # a passage that many share
        rows.append((300 + k, " ".join(words(50 + k, 60)) + " this passage is shared by many documents here " + " ".join(words(90 + k, 20)), "s"))
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_near_copies(make_docs, odd_rows, percent, monkeypatch):
    if percent == 80:  # buckets and clusters in many chunks
        monkeypatch.setattr(nearcopies, "CHUNK", 7)
        monkeypatch.setattr(nearcopies, "CLUSTER_SHINGLES", 500)
    rows = near_rows() + odd_rows
    got = sorted(str(tuple(r)) for r in nearcopies.near_duplicates(make_docs(rows), percent=percent).collect())
    assert got == linked(rows, percent)
    assert nearcopies.near_duplicates(make_docs([])).count() == 0


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(0)
    for _ in range(20):
        pool = rng.integers(0, 2**64, 4000, dtype=np.uint64)
        a, b = np.unique(pool[:3000]), np.unique(pool[400:])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(nearcopies.estimate(nearcopies.registers(a), nearcopies.registers(b), np.int64(len(a)), np.int64(len(b)))[0] - true) < 0.15
    assert not nearcopies.registers(np.zeros(0, np.uint64)).any()


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    for n, m in ((30, 12), (60, 90), (50, 49)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] if m != 49 else [(k, k + 1) for k in range(49)]
        root = {k: k for k in range(n)}
        for _ in range(n):
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a int, b int")).collect()}
        assert got == {k: r for k, r in root.items() if k != r}


# repeated passages


def brute(texts, length):
    seen = Counter(t[i: i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        covered = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i: i + length]] > 1:
                covered[i] += 1
                covered[i + length] -= 1
        hit = np.cumsum(covered[:-1]) > 0
        edges = np.diff(np.concatenate([[0], hit.astype(int), [0]]))
        out.append(([*zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True)], bytes(np.frombuffer(t, np.uint8)[~hit])))
    return out


def test_interleave_finds_what_brute_force_finds():
    rng = np.random.default_rng(1)
    for _ in range(150):
        base, length = rng.integers(97, 97 + rng.integers(1, 4), 200).astype(np.uint8), int(rng.choice([16, 24, 40, 64]))
        parts = []
        for _ in range(rng.integers(1, 8)):
            a = rng.integers(0, 150)
            p = base[a: a + rng.integers(1, 120)].copy() if rng.random() < 0.5 else rng.integers(97, 99, rng.integers(0, 100)).astype(np.uint8)
            if rng.random() < 0.5 and len(p):
                p[rng.integers(0, len(p))] = 122
            parts.append(p)
        seen = Counter(bytes(p[i: i + length]) for p in parts for i in range(len(p) - length + 1))
        want = [i + length <= len(p) and seen[bytes(p[i: i + length])] > 1 for p in parts for i in range(len(p))]
        borders = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        for shard in (1, 50, 10**6):
            for part in (7, 10**6):  # suffixes refined at once
                assert interleave.repeated(np.concatenate(parts), borders, length, shard, part).tolist() == want


def repeat_rows():
    rng = random.Random(9)
    passage = " ".join(words(7, 60))
    rows = [(k, " ".join(words(100 + k, rng.randint(0, 60))) + passage[rng.randint(0, 40): rng.randint(150, 300)] + " ".join(words(200 + k, 30)), "s") for k in range(40)]
    rows += [(50, "ab" * 200, "s"), (51, "x" * 500, "s"), (52, "été " * 100, "s"), (53, passage, "s"), (54, passage, "s")]
    return rows


@pytest.mark.parametrize("crowd", [4096, 3])
def test_repeated_passages(make_docs, odd_rows, crowd, monkeypatch):
    monkeypatch.setattr(repeats, "PART", 1 << 16)  # the long texts are cut
    rows = repeat_rows() + odd_rows
    got = repeats.remove_repeats(make_docs(rows), length=80, gram=16, crowd=crowd, shard=300, batch=1000).collect()
    want = [(d, len((t or "").encode()), spans, left) for (d, t, _), (spans, left) in zip(rows, brute([(t or "").encode() for _, t, _ in rows], 80), strict=True)]
    assert sorted(str((r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"]))) for r in got) == sorted(map(str, want))
    assert repeats.remove_repeats(make_docs([])).count() == 0


def test_repeated_passages_of_rows_with_one_id(spark, make_docs):
    """Two texts of one id whose 32-bit hashes are equal stay two texts."""
    texts = spark.range(300_000).select(F.concat(F.sha2(F.col("id").cast("string"), 256), F.sha2(F.concat(F.lit("x"), "id"), 256)).alias("t"))
    one, other = texts.groupBy(F.hash("t")).agg(F.sort_array(F.collect_list("t")).alias("ts")).where("size(ts) > 1").orderBy("ts").first()["ts"][:2]
    rows = [(None, one, "a"), (None, other, "a"), (3, "q" + one[10:110] + "z", "a")]
    got = repeats.remove_repeats(make_docs(rows), length=80, gram=16).collect()
    want = [(d, spans, left) for (d, _, _), (spans, left) in zip(rows, brute([t.encode() for _, t, _ in rows], 80), strict=True)]
    assert sorted(str((r["doc_id"], [tuple(s) for s in r["spans"]], bytes(r["kept"]))) for r in got) == sorted(map(str, want))


def test_repeated_passages_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/sf0.001/documents.parquet")
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    got = {r["doc_id"]: ([tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in repeats.remove_repeats(docs).collect()}
    assert got == {d: w for (d, _), w in zip(rows, brute([t for _, t in rows], 400), strict=True)}


def test_shingles_of_short_texts():
    import pyarrow as pa

    a, b, c, d, e = shingles.shingle_sets(pa.array(["A b", "a  b\n", "", "a b c d e f", " \t"], pa.large_string()))
    assert a.tolist() == b.tolist() and len(a) == 1 and len(c) == len(e) == 0 and len(d) == 2
