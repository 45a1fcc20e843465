import math
import random

import numpy as np
from pyspark.sql import functions as F

from lexiforge.llm import quality_classifier as Q


def drawn(n, truth, rates, rng):
    """Votes of labellers with the given rate of each vote in each class."""
    return np.stack([np.array([rng.choice(len(r[0]), p=r[c]) for c in truth]) for r in rates], axis=1)


def brute(votes, rate, prior, known, rounds):
    """The same steps, row by row and in plain numbers; known[i] is a row's class or None."""
    classes, total = len(prior), sum(k is None for k in known)
    told = sum(k is not None for k in known)
    for _ in range(rounds):
        posterior = []
        for row in votes:
            p = [prior[c] * math.prod(rate[c][k][v] for k, v in enumerate(row) if v >= 0) for c in range(classes)]
            posterior.append([x / sum(p) for x in p])
        mass = [q if k is None else [total / told * (c == k) for c in range(classes)] for q, k in zip(posterior, known, strict=True)]
        counts = [[[0.5] * len(r) for r in rate[c]] for c in range(classes)]
        for row, m in zip(votes, mass, strict=True):
            for k, v in enumerate(row):
                if v >= 0:
                    for c in range(classes):
                        counts[c][k][v] += m[c]
        rate = [[[x / sum(r) for x in r] for r in counts[c]] for c in range(classes)]
        prior = [0.5 + sum(m[c] for m in mass) for c in range(classes)]
        prior = [p / sum(prior) for p in prior]
    return posterior, rate


def test_label_model_against_brute_force():
    rng = np.random.default_rng(5)
    truth = rng.integers(0, 2, 150)
    votes = drawn(150, truth, [[(0.9, 0.07, 0.03), (0.3, 0.4, 0.3)], [(0.8, 0.1, 0.1), (0.2, 0.2, 0.6)], [(0.95, 0.03, 0.02), (0.5, 0.3, 0.2)]], rng)
    votes[rng.random(votes.shape) < 0.15] = -1
    start, prior = np.array([[[0.9, 0.07, 0.03]] * 3, [[0.4, 0.3, 0.3]] * 3]), np.array([0.8, 0.2])
    for told in (0, 40):
        known = [int(t) if i < told else None for i, t in enumerate(truth)]
        patterns, back = np.unique(votes, axis=0, return_inverse=True)
        back = back.ravel()
        weight, have = np.bincount(back[told:], minlength=len(patterns)).astype(float), np.zeros((len(patterns), 2))
        for i in range(told):
            have[back[i], truth[i]] += 1
        posterior, rate = Q.label_model(patterns, weight, start, prior, have if told else None, rounds=30)
        slow, slow_rate = brute(votes.tolist(), start.tolist(), prior.tolist(), known, 30)
        assert np.allclose(posterior[back], slow, atol=1e-7) and np.allclose(rate, slow_rate, atol=1e-7)


def test_label_model_finds_the_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.choice(4, 20_000, p=[0.8, 0.1, 0.06, 0.04])
    caught = np.full((4, len(Q.STATS)), 0.02)
    for c, shown in enumerate(Q.KINDS.values(), 1):
        caught[c, [Q.STATS.index(x) for x in shown]] = (0.9, 0.75, 0.6)[: len(shown)]
    votes = (rng.random((20_000, len(Q.STATS))) < caught[truth]).astype(int)
    votes[rng.random(votes.shape) < 0.1] = -1
    patterns, back, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    bad = Q.quality_posterior(patterns, n.astype(float))[back.ravel()] > 0.5
    # as good as with the true rates, which one step of the model takes as they are
    best = Q.label_model(patterns, n.astype(float), np.stack([1 - caught, caught], axis=2), np.array([0.8, 0.1, 0.06, 0.04]), rounds=1)[0]
    ideal = 1 - best[back.ravel(), 0] > 0.5
    assert (bad == ideal).mean() > 0.98
    assert (bad == (truth > 0)).mean() > (ideal == (truth > 0)).mean() - 0.01


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    # beginnings of words are found on half of the labels, and the other half judges
    known, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    rows = Q.quality_scores(docs, known).join(held, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and r.toxic == 0]
    poor = [r for r in rows if r.quality == 0]
    toxic = [r for r in rows if r.toxic == 1]
    assert np.mean([r.kept for r in good]) > 0.99
    assert np.mean([not r.kept for r in poor]) > 0.97
    assert np.mean([not r.kept for r in toxic]) > 0.8


def test_odd_input(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["plain", "words", "make", "sense", "and", "more", "of", "them"]) + str(rng.randint(0, 40)) for _ in range(80))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n"), (103, "### " * 50), (104, "x" * 100_000), (105, "you stupid worthless idiot " + rows[0][1]), rows[3]]
    df = spark.createDataFrame([(*r, 1, "x", 0) for r in rows], "doc_id long, text string, kept int, pattern string, toxic int").repartition(2)
    out = Q.quality_scores(df).collect()
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    by = {r.doc_id: r for r in out}
    assert by[100].kept and by[101].kept and by[102].kept and by[5].kept
    kept = Q.keep_documents(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in out if r.kept)
    none = df.where("false")
    assert Q.quality_scores(none, none.select("doc_id", "toxic")).count() == 0


def test_repeated_rows_dont_widen_the_sample(spark):
    rows = [(7, f"the same id on every row but other words each time {i}") for i in range(300)] + [(None, "no id at all here")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert 10 < Q._some(df, 20, df.count(), 7).count() <= 20
    assert Q.quality_scores(df, df.select("doc_id", F.lit(0).alias("toxic")), sample=20).count() == 350
    bad = spark.createDataFrame([(None, "### $$$ %%% *** " * 30), (None, "plain words that mean no harm to anyone in this place")] * 40, "doc_id long, text string")
    kept = Q.keep_documents(bad).collect()
    assert len(kept) == 40 and all("plain" in r.text for r in kept)


def test_votes():
    assert Q.votes(None) == "-" * (len(Q.STATS) + len(Q.TONE))
    names = (*Q.STATS, *Q.TONE)
    vote = lambda t, learnt=Q.NONE: dict(zip(names, Q.votes(t, learnt), strict=True))
    assert vote("OH!! NO!! THIS!! IS!! ALL!! TOO!! LOUD!! HERE!!")["shouting"] == Q.UNFIT
    assert vote("go go go go go go go go go go")["adjacent"] == Q.UNFIT
    assert vote("a | b | c | d | e | f | g | h")["bare_marks"] == Q.UNFIT
    assert vote("w*** x$$$ y### z%%% ok")["odd_ends"] == Q.UNFIT
    assert vote("what an Idiot, he said")["insult"] == Q.UNFIT
    assert vote("what an Idiot, you fool")["insult"] == Q.MORE
    told = vote("some gruelish talk", (frozenset(["gruel"]), frozenset(["mire"])))
    assert (told["learnt_a"], told["learnt_b"], told["insult"]) == (Q.UNFIT, Q.FIT, Q.FIT)
    assert vote("some talk")["learnt_a"] == Q.ABSTAIN


def test_lexicons_are_disjoint():
    where = {"grim": {1, 2, 3, 4}, "grime": {1, 2, 3}, "murk": {1, 2, 3, 5}, "bog": {4, 5, 6}, "rare": {6}}
    a, b = Q.cover(where, 6, {}, least=0.5)
    assert not a & b and "grime" not in a | b and "rare" not in a | b and {"grim", "murk", "bog"} == a | b
    assert Q.known("idio") and Q.known("stupidly") and not Q.known("grim")


def test_ids_are_packed():
    texts = ["some words, and some MORE words 12", None, "a\0b c", "", "words", "é" * 40, "some words, and some MORE words 12"]
    many = Q.Reader()(texts)
    for text, (pattern, ids) in zip(texts, many, strict=True):  # what is read together doesn't matter
        alone = Q.Reader()([text])[0]
        assert alone[0] == pattern and alone[1].tolist() == ids.tolist()
    ids = many[0][1]
    assert (np.diff(ids.astype(int)) > 0).all() and Q.unpacked(Q.packed(ids)).tolist() == ids.tolist()
    assert Q.unpacked(Q.packed(many[1][1])).tolist() == []
