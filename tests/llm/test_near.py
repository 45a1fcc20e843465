import random
import re
from collections import defaultdict

import numpy as np

from lexiforge.llm import components, near_dedup, shingles
from lexiforge.llm.staging import Staging


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, percent):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, shingle_set(t))
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * len(sets[a] | sets[b]):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i, _ in rows)


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows, n = [], 0
    for _ in range(25):
        base = [word() for _ in range(rng.randint(60, 200))]
        for _ in range(rng.randint(1, 12)):
            own = list(base)
            for _ in range(rng.randint(0, 8)):
                own[rng.randrange(len(own))] = word().upper()
            rows.append((n, " ".join(own)))
            n += 1
    chain = [word() for _ in range(150)]  # each near the next, far from the others
    for _ in range(25):
        at = rng.randrange(140)
        chain[at : at + 2] = [word(), word()]
        rows.append((n, " ".join(chain)))
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "a B"), (n + 4, "A  b"), (n + 5, "a b c d e"), (n + 6, "x" * 50_000), (n + 7, rows[0][1]), rows[5]]
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "x", "y", 0, "z") for r in rows], "doc_id long, text string, n long, fp string, rep string, node int, sig string").repartition(4)
    for percent in (80, 85):
        got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, percent).collect())
        assert got == brute(rows, percent)


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    rows = corpus()[:120]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in near_dedup.near_duplicates(df, 85).collect()) == brute(rows, 85)


def test_one_document_of_each_group_stays(spark):
    rows = corpus()[:150] + [(9001, None), (9001, None), (None, "lost words here and there")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string")
    kept = near_dedup.keep_documents(df, 80)
    assert kept.columns == df.columns
    want = sorted({i for i, _, _, keep in brute([r for r in rows if r[0] is not None], 80) if keep})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want


def test_rows_that_share_a_doc_id(spark):
    a, b = "one text of eight plain words in row", "another one that has nothing to do with it"
    rows = [(1, a), (1, b), (2, b), (3, a), (3, a), (3, None), (4, "x y z"), (4, "x  Y z"), (None, a), (5, ""), (5, "")]
    df = spark.createDataFrame([(*r, [1]) for r in rows], "doc_id long, text string, digest array<int>").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, 80).collect()), key=str)
    assert got == sorted([(1, 4, 1, True), (1, 5, 1, True), (2, 5, 1, False), (3, 4, 1, False), (3, 4, 1, False), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (None, 4, None, True), (5, 0, 5, True), (5, 0, 5, True)], key=str)
    kept = sorted(((r.doc_id, r.text if r.doc_id != 4 else "x") for r in near_dedup.keep_documents(df, 80).collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (3, None), (4, "x"), (None, a), (5, "")], key=str)


def test_links_beside_the_hubs(spark):
    """Families whose members are near their like and far from the smallest of the bucket."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, n = [], 0
    for _ in range(4):
        base = [word() for _ in range(200)]
        for _ in range(14):
            kind = list(base)
            for at in rng.sample(range(200), rng.randint(6, 16)):
                kind[at] = word()
            for _ in range(rng.randint(1, 4)):
                own = list(kind)
                own[rng.randrange(200)] = word()
                rows.append((n, " ".join(own)))
                n += 1
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for percent in (80, 85):
        assert sorted(tuple(r) for r in near_dedup.near_duplicates(df, percent).collect()) == brute(rows, percent)


def test_empty_table(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sequential_test_keeps_true_pairs():
    rng = np.random.default_rng(0)
    for percent in (80, 85):
        low = near_dedup.least_matches(percent)
        assert len(low) == near_dedup.HASHES // near_dedup.LOOK and all(a < b for a, b in zip(low, low[1:], strict=False))
        t = percent / 100
        same = rng.random((4000, near_dedup.HASHES)) < t
        a = np.zeros((4000, near_dedup.HASHES), np.uint32)
        assert near_dedup.may_reach(a, (~same).astype(np.uint32), percent).all()
        far = rng.random((4000, near_dedup.HASHES)) < 0.3
        assert not near_dedup.may_reach(a, (~far).astype(np.uint32), percent).any()


def test_shingle_hashes_count_distinct_shingles():
    texts = [t for _, t in corpus()]
    assert [len(s) for s in shingles.shingle_sets(texts)] == [len(shingle_set(t)) for t in texts]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    staging = Staging(spark, "test")
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long"), staging, "c").collect()}
    want = defaultdict(int, {x: root(x) for x in list(parent)})
    assert got == want
