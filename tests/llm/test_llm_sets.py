"""Operators 11 to 13 against brute force and SQL."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF, make_docs, odd_rows, prose  # noqa: F401
from rotorwatch.llm import divergence, infill, jaccardjoin
from rotorwatch.llm.oracle import ORACLE
from rotorwatch.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(text, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i: i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def components_of(rows, percent, words=4):
    """(id, set size, smallest id reachable) of each row; a null id counts only where its component has no other."""
    own = [(d, sets_of(t, words)) for d, t, _ in rows]
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
    known = defaultdict(list)
    for i, (d, _) in enumerate(own):
        known[root(i)].append(d)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in known.items()}
    return Counter((d, len(s), least[root(i)] if s else d) for i, (d, s) in enumerate(own))


def family(seed, first, size, words, edits):
    """Copies of one text, each with some words changed, more the further on."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(words)]
    rows = []
    for k in range(size):
        own = list(base)
        for at in rng.sample(range(words), min(words, edits * k // size)):
            own[at] = f"x{rng.randrange(10 ** 6)}"
        rows.append((first + k, " ".join(own), "f"))
    return rows


def joined(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_join_odd_rows(make_docs, odd_rows):  # noqa: F811
    assert joined(jaccardjoin.jaccard_join(make_docs(odd_rows))) == components_of(odd_rows, 85)
    assert jaccardjoin.jaccard_join(make_docs([])).count() == 0


def test_bitmap_of_wanted_ids(spark):
    ids = spark.range(0, 200_000, 40).selectExpr("id AS _id").unionByName(spark.sql("SELECT CAST(NULL AS long) _id"))
    rows = spark.range(200_000).selectExpr("id AS _doc").unionByName(spark.sql("SELECT CAST(NULL AS long) _doc"))
    got = [r[0] for r in jaccardjoin.likely(rows, "_doc", ids).collect()]
    assert len(got) == len(set(got)) and {r[0] for r in ids.collect()} <= set(got) and len(got) < 30_000
    # a bitmap as small as can be tells little apart, and loses none
    few = [r[0] for r in jaccardjoin.likely(rows, "_doc", ids, most=64).collect()]
    assert {r[0] for r in ids.collect()} <= set(few)
    floats = spark.sql("SELECT explode(array(0D, 1.5D, double('NaN'))) _id"), spark.sql("SELECT explode(array(-0D, 1.5D, double('NaN'))) _doc")
    assert jaccardjoin.likely(floats[1], "_doc", floats[0]).count() == 3
    assert jaccardjoin.likely(rows, "_doc", ids.limit(0)).count() == 0


@pytest.mark.parametrize("repeated", [False, True])
def test_texts_that_are_not_wanted_are_not_shuffled(spark, make_docs, monkeypatch, repeated):
    """Where ids are too many to be broadcast, few texts besides those of classes that meet others go through the shuffle."""
    rows = family(31, 0, 12, 60, 3) + [(100 + k, " ".join(f"u{k}_{j}" for j in range(30)), "u") for k in range(600)]
    if repeated:  # ids of several classes, null too
        rows += [(d, t, s) for d, (_, t, s) in zip([0, 0, None, None], family(32, 0, 4, 60, 2), strict=True)]
    seen = spark.sparkContext.accumulator(0)
    real = jaccardjoin.likely

    def counted(*given):
        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        left = real(*given)
        return left.mapInArrow(count, left.schema)

    monkeypatch.setattr(jaccardjoin, "likely", counted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert joined(jaccardjoin.jaccard_join(make_docs(rows))) == components_of(rows, 85)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert 12 <= seen.value <= 120


@pytest.mark.parametrize(("percent", "leaf"), [(85, jaccardjoin.LEAF), (85, 4_000), (60, 2_500), (40, 2_500)])
def test_join_of_families_and_a_common_passage(make_docs, percent, leaf):  # noqa: F811
    common = " ".join(f"licence{k}" for k in range(60))
    rows = [(k, f"{common} {prose(k, 12 + k % 9)}", "s") for k in range(120)]  # a passage that is most of each text
    rows += family(1, 1000, 60, 120, 30) + family(2, 2000, 40, 40, 12) + family(3, 3000, 5, 700, 60)
    rows += [(5000 + k, prose(900 + k, 30), "u") for k in range(40)] + [(6000 + k, rows[130][1].upper(), "c") for k in range(30)]
    assert joined(jaccardjoin.jaccard_join(make_docs(rows), percent=percent, leaf=leaf)) == components_of(rows, percent)


def test_regions_are_cut_and_blocked(spark, make_docs, monkeypatch):  # noqa: F811
    """Small tasks: pivots cut what they can, the rest goes block by block, and nothing is lost."""
    cuts, blocks = [], []
    real = jaccardjoin.cut, jaccardjoin.block_links
    monkeypatch.setattr(jaccardjoin, "cut", lambda df, p: cuts.append(df) or real[0](df, p))
    monkeypatch.setattr(jaccardjoin, "block_links", lambda df, p: blocks.append(df) or real[1](df, p))
    rows = [r for k in range(6) for r in family(50 + k, 100 * k, 12, 80, 40)]
    shared = " ".join(f"w{k}" for k in range(70))
    rows += [(1000 + k, f"{shared} {prose(k, 6)}", "s") for k in range(40)]
    assert joined(jaccardjoin.jaccard_join(make_docs(rows), leaf=800)) == components_of(rows, 85)
    assert cuts and blocks


def test_threshold_is_met_exactly(make_docs):  # noqa: F811
    # 17 of 20 shingles in common is a link at 85, 16 of 19 is not
    base = [f"a{k}" for k in range(200)]
    rows = [(1, " ".join(base[:23]), "x"), (2, " ".join(base[:20]), "x"), (3, " ".join(["z", *base[100:118]]), "x"), (4, " ".join([*base[100:118], "q", "r"]), "x")]
    sizes = [len(sets_of(t)) for _, t, _ in rows]
    assert sizes[:2] == [20, 17]
    assert joined(jaccardjoin.jaccard_join(make_docs(rows))) == components_of(rows, 85)
    assert jaccardjoin.jaccard_join(make_docs(rows)).where("component_id = 1").count() == 2


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(5)
    linked = 0
    for percent in (40, 60, 85, 95):
        for _ in range(400):
            n = int(rng.integers(1, 90))
            a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
            b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(percent / 100, 1)], rng.integers(0, 2 ** 63, int(rng.integers(0, n // 6 + 1))).astype(np.uint64)]))
            frequent = np.sort(rng.choice(a, int(rng.integers(0, len(a) + 1)), replace=False))
            common = len(np.intersect1d(a, b))
            if 100 * common >= percent * (len(a) + len(b) - common) and common and not np.array_equal(a, b):
                linked += 1
                keys = [set(jaccardjoin.part_keys(s, frequent, percent).tolist()) for s in (a, b)]
                assert keys[0] & keys[1]
    assert linked > 200


def test_linked_larger_sets_share_a_key():
    rng = np.random.default_rng(6)
    linked = 0
    for _ in range(200):
        a = np.unique(rng.integers(0, 2 ** 63, int(rng.integers(90, 3000))).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(0.86, 1)], rng.integers(0, 2 ** 63, int(rng.integers(0, len(a) // 20))).astype(np.uint64)]))
        frequent = np.sort(rng.choice(a, int(len(a) * rng.choice([0, 0.1, 0.9, 1])), replace=False))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common) and not np.array_equal(a, b):
            linked += 1
            assert np.intersect1d(*(jaccardjoin.part_keys(s, frequent, 85) for s in (a, b))).size
    assert linked > 50


@pytest.mark.parametrize(("size", "sets", "shared"), [(12, 3000, 0), (20, 2000, 0), (300, 400, 3), (2000, 150, 20)])
def test_sets_alike_by_chance_share_no_key(size, sets, shared):
    """A few shingles that all hold, or parts that are empty, don't tie sets that have nothing else in common."""
    rng = np.random.default_rng(7)
    common = rng.integers(0, 2 ** 64, shared, dtype=np.uint64)
    none = np.zeros(0, np.uint64)
    keys = [np.unique(jaccardjoin.part_keys(np.unique(np.append(common, rng.integers(0, 2 ** 64, size, dtype=np.uint64))), none, 85)) for _ in range(sets)]
    assert np.unique(np.concatenate(keys), return_counts=True)[1].max() == 1


def test_overlaps_of_uneven_sets():
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 2 ** 64, 3000, dtype=np.uint64)

    def members(count, most):
        return [jaccardjoin.Member(True, b"", b"", np.unique(rng.choice(pool[: int(rng.integers(1, 3000))], int(rng.integers(1, most))))) for _ in range(count)]

    for left, right, most in ((1, 1, 2), (3, 70, 50), (400, 3, 4000), (40, 120, 900)):
        a, b = members(left, most), members(right, most)
        inter, union = jaccardjoin.overlaps(a, b)
        assert inter.tolist() == [[len(np.intersect1d(x.own, y.own)) for y in b] for x in a]
        assert union.tolist() == [[len(np.union1d(x.own, y.own)) for y in b] for x in a]


def test_pivots_are_sorted_once(monkeypatch):
    """A large group of copies, each changed elsewhere, is held against many pivots without sorting them over and over."""
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2 ** 64, 400, dtype=np.uint64)
    group = []
    for k in range(800):
        own = np.where(rng.random(400) < 0.12, rng.integers(0, 2 ** 64, 400, dtype=np.uint64), base)
        group.append(jaccardjoin.Member(True, b"%016d" % k, b"%016d" % k, np.unique(own)))
    sorts, real = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda *given, **named: sorts.append(1) or real(*given, **named))
    assert len(jaccardjoin.apart(group, 85)) > 10
    assert len(sorts) == 1


# fill in the middle


def middle_of(doc_id, text):
    text = text or ""
    found = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(found)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k: 8 * k + 8], 16) for k in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(found[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    form = "spm" if h4 % 100 < 80 else "psm"
    return doc_id, n, form, len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"


TEXTS = ["a", " a", "a ", "  \n ", "<", "<P", "S>", "<P<S<M", "a<P>b", "x <S> y", "<M>", "é ü\x0b漢字\x1c\x85   b c", "a\tb\r\nc  d ", "<<P <<S> >", "ends <P", "<S", "\x00 \x1f", "\U0001f600 \U0001f600"]


def test_infill_forms_and_restoring(make_docs, odd_rows):  # noqa: F811
    rows = [(1000 * k + d, t, "x") for k, t in enumerate(TEXTS) for d in range(60)] + odd_rows
    made = infill.transform(make_docs(rows)).withColumn("restored", infill.restored())
    got = Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"]) for r in made.collect())
    assert got == Counter((*middle_of(d, t), t or "") for d, t, _ in rows)
    assert {"plain", "spm", "psm"} == {r[2] for r in got}
    assert infill.transform(make_docs([])).count() == 0


def test_infill_rates_and_sentinels(make_docs):  # noqa: F811
    rows = [(k, f"some words of text {k} [b] .*", "x") for k in range(400)]
    made = infill.transform(make_docs(rows), rate=100, spm_rate=0, seed=7, sentinels=("[a]", ".*?", "[c]"))
    texts = {d: t for d, t, _ in rows}
    for r in made.withColumn("restored", infill.restored(sentinels=("[a]", ".*?", "[c]"))).collect():
        assert r["form"] == "psm" and r["output"].startswith("[a]") and r["restored"] == texts[r["doc_id"]]
    plain = infill.transform(make_docs(rows), rate=0).where("form = 'plain'").count()
    assert plain == 400


def test_units_of_slices():
    texts = pa.array(TEXTS + ["", None], pa.large_string()).fill_null("")
    got = [[u.decode() for u in x] for x in infill.units(texts[3:]).to_pylist()]
    assert got == [re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t) for t in texts[3:].to_pylist()]


# divergence


def audit_of(rows, top=200):
    docs = [(lang or "", source or "", [w.translate(LOWER) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen = Counter(t for g, _, w in docs if g == lang for t in set(w))
        kept = sorted(t for t, n in seen.items() if n >= 3)
        groups = {s: Counter() for g, s, _ in docs if g == lang}
        for g, s, w in docs:
            if g == lang:
                groups[s].update(t for t in w if seen[t] >= 3)
        whole = sum(groups.values(), Counter())

        def p(count, t):
            return 1 + 10 ** 9 * (count[t] + 1) // (sum(count.values()) + len(kept))

        for s, own in groups.items():
            pairs = [(o, sum((p(own, t) - p(c, t)) ** 2 // p(c, t) for t in kept)) for o, c in groups.items() if o != s]
            marks = [(t, (p(own, t) - p(whole, t)) ** 2 // p(whole, t)) for t in kept if own[t] and p(own, t) > p(whole, t)]
            for part, items, most in (("pair", pairs, None), ("term", marks, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items[:most])]
    return Counter(out)


def audited(df):
    return Counter(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture(scope="module")
def groups_of_text(spark):
    def make(rows):
        data = [(*r, *["x"] * 9) for r in rows]
        return spark.createDataFrame(data, "lang string, source string, text string, n string, term string, p string, q string, value string, rank string, block string, id string, size string").repartition(3)
    return make


def test_audit(groups_of_text, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 2_000)  # many slices
    rng = random.Random(3)
    words = ["the", "The", "été", "Été", "x́", "漢字", "q", "ß", "co-op", "a1b", "\U0001f600", "z"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    rows = [("en" if k % 3 else None, f"s{k % 4}" if k % 7 else None, " ".join(rng.choice(words[: 20 + 30 * (k % 9)]) for _ in range(rng.randint(0, 200)))) for k in range(140)]
    rows += [("en", "hot", "the " * 5_000 + " ".join(words)), ("fr", "empty", None), ("fr", "also", ""), ("de", "a", "one two"), ("de", "b", "one"), ("de", "b", "one one"), ("de", "none", "1 2 3"), ("es", "alone", "uno")]
    rows += rows[:3]
    assert audited(divergence.audit(groups_of_text(rows))) == audit_of(rows)
    assert audited(divergence.audit(groups_of_text(rows), top=3)) == audit_of(rows, 3)


def test_audit_of_many_blocks(groups_of_text, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 300)
    rng = random.Random(4)
    rows = [("en", f"s{k % 6}", " ".join(f"t{chr(97 + int(rng.expovariate(0.1)) % 26)}{chr(97 + int(rng.expovariate(0.2)) % 26)}" for _ in range(120))) for k in range(90)]
    assert audited(divergence.audit(groups_of_text(rows))) == audit_of(rows)


def test_audit_of_nothing(groups_of_text):
    assert divergence.audit(groups_of_text([])).count() == 0
    assert audited(divergence.audit(groups_of_text([(None, None, None)]))) == Counter()


def test_joint_sums_by_bitmaps_and_lists():
    rng = np.random.default_rng(1)
    for size, groups in ((1, 2), (64, 3), (1000, 4), (2049, 5)):
        counts = rng.choice([0, 0, 0, 1, 2, 3, 9], (groups, size)) + (rng.random((groups, size)) < 0.01) * rng.integers(0, 1000, (groups, size))
        p = np.array([1 + 10 ** 9 * (c + 1) // (c.sum() + size) for c in counts])
        zero = np.array([1 + 10 ** 9 // int(c.sum() + size) for c in counts])
        levels = [(g, int(p[g][counts[g] == n][0]), np.flatnonzero(counts[g] == n)) for g in range(groups) for n in np.unique(counts[g]) if n]
        got = divergence.joint_sums(size, zero, levels)
        for g in range(groups):
            for h in range(groups):
                if g != h:
                    assert got[g, h] == ((p[g] - p[h]) ** 2 // p[h]).sum()


def test_shares_beyond_64_bits(spark):
    row = spark.range(1).select(divergence.share(F.lit(5 * 10 ** 12), F.lit(10 ** 13), F.lit(10 ** 6)).alias("p")).first()
    assert row["p"] == 1 + 10 ** 9 * (5 * 10 ** 12 + 1) // (10 ** 13 + 10 ** 6)


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_source_divergence"])
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/sf0.001/documents.parquet')")
    found = con.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    assert Counter(map(tuple, QUERIES[name](spark, f"{SF}/sf0.001").select(*columns).collect())) == Counter(found.fetchall())


def test_join_of_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"], None) for r in docs.collect()]
    assert joined(QUERIES["op11_jaccard_join"](spark, f"{SF}/sf0.001")) == components_of(rows, 85)
