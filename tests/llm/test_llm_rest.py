"""Operators 2, 4 and 9, the pipeline, and what is registered."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry_mod
import corpus_pipeline
from llm_fixtures import SF, make_docs, odd_rows, prose  # noqa: F401
from rotorwatch.llm import ann, mixing, toxicity
from rotorwatch.llm.oracle import ORACLE
from rotorwatch.llm.queries import QUERIES

# mixing


def targets(sizes):
    """Sharing over and over, as the rule says."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    out, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def check_mix(rows, got):
    size = Counter((d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, s in rows)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == size
    sums = defaultdict(int)
    for (_, s, n), k in size.items():
        sums[s] += n * k
    want, taken, largest = targets(dict(sums)), defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == sums[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["times"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1e-6


def test_mix(make_docs, odd_rows):
    rows = odd_rows + [(1000 + k, "w " * (k % 17), "hot" if k % 3 else f"s{k % 7}") for k in range(300)]
    once = mixing.mix(make_docs(rows)).collect()
    check_mix(rows, once)
    assert sorted(map(str, once)) == sorted(map(str, mixing.mix(make_docs(rows, parts=7)).collect()))
    assert mixing.mix(make_docs([])).count() == 0


def test_whole_epochs_come_first(make_docs):
    rows = [(k, "w " * 10, "abc"[k % 3]) for k in range(300)]
    got = mixing.mix(make_docs(rows)).collect()
    times = {s: Counter(r["times"] for r in got if r["source"] == s) for s in "abc"}
    # 4500 words: 2000 for a, which is full, 2500 by 2 to 1 for b and c
    assert times["a"] == {2: 100} and set(times["b"]) == {1, 2} and set(times["c"]) == {0, 1}


def test_better_documents_are_likelier(make_docs):
    docs = make_docs([(k, "w " * 10, "abc"[k % 3]) for k in range(3000)])
    got = mixing.mix(docs, quality=F.when(F.col("doc_id") < 1500, 4.0).otherwise(0.25)).where("source = 'c'").collect()
    good = sum(r["times"] for r in got if r["doc_id"] < 1500)
    assert sum(r["times"] for r in got) == 833 and good > 450  # of 500


def test_weights_that_are_not_positive_come_last(make_docs):
    docs = make_docs([(k, "w " * 10, "abc"[k % 3]) for k in range(300)])
    weights = {0: 0.0, 1: -1.0, 2: float("nan"), 3: None, 4: float("inf")}
    quality = F.col("doc_id") % 5
    quality = F.when(quality == 0, 0.0).when(quality == 1, -1.0).when(quality == 2, float("nan")).when(quality == 4, float("inf"))
    got = mixing.mix(docs, quality=quality).where("source = 'c'").collect()
    taken = {r["doc_id"]: r["times"] for r in got}
    assert sum(taken.values()) == 83  # of 100
    fine = {i for i in taken if weights[i % 5] is None or weights[i % 5] == float("inf")}
    rest = sorted(set(taken) - fine)
    assert all(taken[i] == 1 for i in fine) and [i for i in rest if taken[i]] == rest[: 83 - len(fine)]


# nearest vectors


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("vector", T.StringType()), T.StructField("list", T.IntegerType())]))


def test_nearest_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (10, [1.0, 0.1]), (20, [0.0, 1.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [2.0, 0.0]), (4, [2.0, 0.0]), (5, [2.0, 0.0]), (6, [4.0, 0.0]), (7, None), (8, [0.0, 0.0]), (9, [nan, 1.0]), (11, [inf, 1.0]), (12, [None, 1.0]), (13, [1.0]), (None, [1.0, 0.0]), (14, []), (30, [0.0, 0.0]), (2, [2.0, 0.0]), (15, [1e-30, 1e-32]), (16, [3e38, 3e37])]
    got = defaultdict(list)
    for r in ann.search(vectors(spark, rows), every=10, k=5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {0, 10, 20}
    assert [(a, b) for a, b, _ in got[0]] == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)] and all(s == 1.0 for *_, s in got[0])
    assert [b for _, b, _ in got[10]][0] == 16 and len(got[20]) == 5
    few = ann.search(vectors(spark, rows[:3]), every=10).collect()
    assert Counter(r["query_id"] for r in few) == {0: 2, 10: 2, 20: 2}
    assert ann.search(vectors(spark, []), every=10).count() == 0


@pytest.mark.parametrize("sizes", [(40, 16), (7, 3)])
def test_nearest_recall(spark, sizes, monkeypatch):
    monkeypatch.setattr(ann, "LIST", sizes[0])
    monkeypatch.setattr(ann, "CHUNK", sizes[1])
    rng = np.random.default_rng(2)
    v = rng.normal(size=(1500, 16)).astype(np.float32)
    v[500:1000] = v[0] + 0.01 * rng.normal(size=(500, 16))  # a hot spot
    got = ann.search(vectors(spark, [(k, x.tolist()) for k, x in enumerate(v)]), every=25).collect()
    u = v.astype(np.float64)
    hit = total = 0
    by = defaultdict(list)
    for r in got:
        by[r["query_id"]].append(r)
    for q in range(0, 1500, 25):
        score = u @ u[q] / (np.linalg.norm(u, axis=1) * np.linalg.norm(u[q]))
        score[q] = -2
        best = set(np.lexsort((np.arange(1500), -score))[:5].tolist())
        assert sorted(r["rank"] for r in by[q]) == [1, 2, 3, 4, 5]
        assert all(r["score"] == pytest.approx(score[r["vec_id"]], abs=1e-12) for r in by[q])
        hit += len(best & {r["vec_id"] for r in by[q]})
        total += 5
    assert hit / total >= 0.9


def brute(v, q, k=5):
    u = v.astype(np.float64)
    score = u @ u[q] / (np.linalg.norm(u, axis=1) * np.linalg.norm(u[q]))
    score[q] = -2
    return np.lexsort((np.arange(len(v)), -score))[:k].tolist()


@pytest.mark.parametrize("shape", ["even", "clusters"])
def test_nearest_over_many_lists(spark, shape, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 16)
    monkeypatch.setattr(ann, "LEAST", 32)
    seen = []
    monkeypatch.setattr(ann, "calibrate", lambda *a, real=ann.calibrate: seen.append((len(a[0].centroids), real(*a))) or seen[-1][1])
    rng = np.random.default_rng(4)
    v = rng.normal(size=(8000, 12)).astype(np.float32)
    if shape == "clusters":
        v = (v * 0.1 + rng.normal(size=(80, 12))[rng.integers(0, 80, 8000)]).astype(np.float32)
    rows = vectors(spark, [(k, x.tolist()) for k, x in enumerate(v)])
    want = {q: brute(v, q) for q in range(0, 8000, 40)}
    for exact in (False, True):
        got = defaultdict(list)
        for r in ann.search(rows, every=40, exact=exact).orderBy("query_id", "rank").collect():
            got[r["query_id"]].append(r["vec_id"])
        if exact:
            assert got == want
        else:
            assert sum(len(set(want[q]) & set(got[q])) for q in want) / (5 * len(want)) >= 0.95
    lists, visits = seen[0]
    assert lists > 400 and visits.lists < lists / 4  # far from all are visited


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(5)
    v = ann.unit(rng.normal(size=(6000, 12)))
    index = ann.fit(v, 6000 * ann.LIST)
    found, far = index.nearest(v[:300], 40)
    score = v[:300] @ index.centroids.T
    best = np.argsort(-score, axis=1)[:, :40]
    assert len(index.centroids) == 1500 and (np.diff(far, axis=1) >= 0).all()
    assert np.mean([len(set(a) & set(b)) for a, b in zip(found.tolist(), best.tolist(), strict=True)]) >= 39


def test_equal_vectors_tie_whatever_the_chunk(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 8)
    monkeypatch.setattr(ann, "CHUNK", 7)
    monkeypatch.setattr(ann, "HITS", 16)
    rng = np.random.default_rng(6)
    v = rng.normal(size=(400, 24)).astype(np.float32)
    v[100:140] = v[3] * np.float32(2) ** rng.integers(-3, 4, 40)[:, None].astype(np.float32)  # equal cosines, different vectors
    got = ann.search(vectors(spark, [(k, x.tolist()) for k, x in enumerate(v)]), every=101, exact=True).where("query_id = 101").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [3, 100, 102, 103, 104]
    assert len({r["score"] for r in got}) == 1


def test_dimension_is_an_argument(spark):
    rows = [(0, [1.0, 0.0]), (2, [1.0, 0.1]), (1, [1.0]), (3, [2.0]), (5, [3.0])]
    assert ann.search(vectors(spark, rows), every=2, dimension=2).count() == 2
    assert ann.search(vectors(spark, rows), every=5).count() == 2 and ann.search(vectors(spark, rows), every=5, dimension=2).count() == 1
    assert ann.search(vectors(spark, rows), every=1, dimension=7).count() == 0


# toxicity


def toxic_rows(n=600):
    rng = np.random.default_rng(5)
    calm = ["".join(rng.choice(["than", "on", "er", "the", "wh", "ing", "sh", "ou"], rng.integers(1, 4))) for _ in range(400)]
    rows, labels = [], []
    for k in range(n):
        text = list(rng.choice(calm, rng.integers(5, 200)))
        bad = k % 4 == 0
        for _ in range(1 + len(text) // 40 if bad else 0):
            word = str(rng.choice(["blithok", "gruvnax", "zorpel"]))
            text.insert(rng.integers(0, len(text)), word + str(rng.choice(["", "s", "en", "!", "ish"])))
        rows.append((k, " ".join(text), "a"))
        labels.append((k, int(bad)))
    return rows, labels


def test_toxicity_held_out(spark, make_docs):
    rows, labels = toxic_rows()
    docs = make_docs(rows)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()}
    held = [(got[d]["score"], y) for d, y in labels if got[d]["held"]]
    assert sum((s >= 0.5) == y for s, y in held) / len(held) > 0.95
    again = toxicity.score(docs, toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {d: r["score"] for d, r in got.items()}
    # a misspelling never seen shares n-grams with what was
    new = make_docs([(1, " ".join(["than", "on"] * 10) + " blithokkery", "a"), (2, " ".join(["than", "on"] * 10), "a")])
    unseen = {r["doc_id"]: r["score"] for r in toxicity.score(new, model).collect()}
    assert unseen[1] > unseen[2]


def test_toxicity_never_learns_held_out_labels(spark, make_docs):
    rows, labels = toxic_rows(200)
    held = {r["doc_id"] for r in spark.createDataFrame([(d,) for d, _ in labels], "doc_id long").where(toxicity.held_out(F.col("doc_id"))).collect()}
    flipped = [(d, 1 - y if d in held else y) for d, y in labels]
    a, b = (toxicity.train(make_docs(rows), spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert (a.grams == b.grams).all() and a.bias == b.bias


def test_toxicity_of_odd_texts(spark, make_docs, odd_rows):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (11, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score(make_docs(odd_rows), toxicity.train(make_docs(odd_rows), labels), carry=("source", "text")).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    empty = toxicity.train(make_docs([]), labels.limit(0))
    assert {r["score"] < 0.01 for r in toxicity.score(make_docs(odd_rows), empty).collect()} == {True}
    assert toxicity.score(make_docs([]), empty).count() == 0


def test_toxicity_learns_from_long_texts(spark, make_docs):
    rows, labels = toxic_rows()
    tail = " ".join(["than", "on", "er"] * 2000)
    long = [(d, f"{t} {tail}", s) for d, t, s in rows]
    assert min(len(t) for _, t, _ in long) > 1 << 14
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(make_docs(long), labels)
    held = toxicity.score(make_docs(long), model).where(toxicity.held_out(F.col("doc_id"))).join(labels, "doc_id").collect()
    toxic, other = ([r["score"] for r in held if r["toxic"] == y] for y in (1, 0))
    assert np.mean([t > o for t in toxic for o in other]) > 0.95
    # however little may be learned from, each class has a text
    least = toxicity.train(make_docs(long), labels, sample_bytes=1)
    assert abs(least.bias) < 20 and least.grams.any()


def test_toxicity_labels_without_documents_take_no_place(spark, make_docs):
    rows, labels = toxic_rows()
    more = labels + [(100_000 + k, k % 2) for k in range(4000)]
    a, b = (toxicity.train(make_docs(rows), spark.createDataFrame(x, "doc_id long, toxic int"), per_class=20) for x in (labels, more))
    assert (a.grams == b.grams).all() and a.bias == b.bias


def test_toxicity_learns_a_repeated_row_once(spark, make_docs):
    rows, labels = toxic_rows(200)
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    more = [r for r in rows for _ in range(1 if r[0] % 8 else 30)]
    a, b = (toxicity.train(make_docs(x), labels, per_class=20) for x in (rows, more))
    assert (a.grams == b.grams).all() and a.bias == b.bias


def test_windows_cover_every_word():
    for n in (0, 1, 15, 16, 17, 31, 100):
        begin, end, _ = toxicity.windows(np.array([0, n]))
        covered = np.zeros(n, bool)
        for a, b in zip(begin, end, strict=True):
            assert b - a <= toxicity.WINDOW
            covered[a:b] = True
        assert covered.all()


# pipeline


def pipeline_input(spark, tmp_root, rows, labels):
    docs = spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_root}/documents.parquet")
    spark.createDataFrame([(d, 1, y) for d, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_root}/labels.parquet")
    return spark.read.parquet(f"{tmp_root}/documents.parquet")


def test_pipeline_stages(spark, tmp_root, odd_rows):
    rows, labels = toxic_rows()
    clean = [r for r, (_, y) in zip(rows, labels, strict=True) if not y]
    near = [(5000 + k, r[1] + f" tail{k}", "b") for k, r in enumerate(r for r in clean if len(r[1].split()) > 60)]
    copies = [(7000 + k, r[1].upper() if k % 2 else r[1], "c") for k, r in enumerate(clean[:50])]
    all_rows = rows + near + copies + odd_rows
    docs = pipeline_input(spark, tmp_root, all_rows, labels)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.kept(stage(spark, docs, tmp_root), "test-stage")
        if name != "packing":
            assert now.columns == docs.columns
        out[name], docs = now, now
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    bad = {d for d, y in labels if y}
    left = ids(out["toxicity"])
    assert len(bad & left) <= 0.06 * len(bad) and len({d for d, _, _ in clean} - left) <= 0.03 * len(clean)
    after = out["exact dedup"].select("doc_id", "text").collect()
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    lowered = lambda rows: [(r["text"] or "").translate(small) for r in rows]
    assert len(set(lowered(after))) == len(after)
    assert set(lowered(after)) == set(lowered(out["toxicity"].select("text").collect()))
    kept = ids(out["near dedup"])
    assert not any(d in kept for d, t, _ in near if t.rsplit(" ", 1)[0] in {r["text"] for r in after if r["doc_id"] in kept and r["doc_id"] != d})
    mixed = Counter(r["doc_id"] for r in out["mixing"].collect())
    assert set(mixed) <= kept
    assert max(Counter((r["doc_id"], r["text"]) for r in out["mixing"].collect()).values()) <= 2
    tokens = out["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("one")).where("doc_id > 11").collect()  # the odd rows share ids
    assert {r["doc_id"]: r["n"] for r in tokens} == {r["doc_id"]: r["one"] * mixed[r["doc_id"]] for r in tokens} and len(tokens) == len({d for d in mixed if d is not None and d > 11})


def test_pipeline_keeps_columns_of_any_name(spark, make_docs, tmp_root):
    names = ["SCORE", "_n", "_row", "_copy", "_times", "_rows", "_stays", "_taken", "_extra0", "_doc"]
    docs = make_docs([(k, prose(k, 60), "ab"[k % 2]) for k in range(20)]).select("doc_id", "text", "source")
    docs = docs.select(F.concat(F.lit("of "), F.col("doc_id")).alias("mark"), "*", *(F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in names))
    spark.createDataFrame([(1, 0, 1)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_root}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name != "near dedup":  # its rows are joined as those of the stage before
            docs, before = corpus_pipeline.kept(stage(spark, docs, tmp_root), "test-names"), docs
            assert docs.columns == before.columns
            rows = docs.collect()
            assert rows and all(r["mark"] == f"of {r['doc_id']}" and all(r[c] == f"{c}{r['doc_id']}" for c in names) for r in rows)


def test_pipeline_of_nothing(spark, tmp_root):
    pipeline_input(spark, tmp_root, [], [])
    assert corpus_pipeline.run(spark, tmp_root).count() == 0


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, f"{SF}/sf0.001")
    assert got.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"] and got.count() > 0


# registration


def test_registered():
    names = set(entry_mod.queries())
    assert {*QUERIES, "pipeline"} <= names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/sf0.001/{t}.parquet')")
    got, want = QUERIES[name](spark, f"{SF}/sf0.001"), con.execute(ORACLE[name])
    columns = sorted(got.columns)
    assert columns == sorted(c[0] for c in want.description)
    order = [[c[0] for c in want.description].index(c) for c in columns]
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(tuple(r[k] for k in order) for r in want.fetchall())
