import hashlib
import random
from collections import Counter

import numpy as np

from lexiforge.llm import suffix_dedup as S


def brute(rows, span=200):
    seen = Counter()
    for _, t in rows:
        raw = (t or "").encode()
        seen.update(raw[i : i + span] for i in range(len(raw) - span + 1))
    out = []
    for doc_id, t in rows:
        raw = (t or "").encode()
        mark = bytearray(len(raw))
        for i in range(len(raw) - span + 1):
            if seen[raw[i : i + span]] > 1:
                mark[i : i + span] = b"\1" * span
        kept = bytes(x for x, m in zip(raw, mark, strict=True) if not m)
        spans = sum(1 for i, m in enumerate(mark) if m and (i == 0 or not mark[i - 1]))
        out.append((doc_id, len(raw), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh \n") for _ in range(n))
    base, passage, short, period = [text(2500) for _ in range(4)], text(260), text(150), "ab" * 300
    rows = []
    for i in range(50):
        t = text(rng.randint(0, 1200))
        if rng.random() < 0.5:
            t += passage + text(rng.randint(0, 300))
        if rng.random() < 0.4:
            t += short
        if rng.random() < 0.3:
            b, s = rng.choice(base), rng.randint(0, 2000)
            t += b[s : s + rng.randint(150, 500)]
        if rng.random() < 0.2:
            t += period[: rng.randint(100, 600)]
        if rng.random() < 0.1:
            t = "é\0" * rng.randint(0, 300) + t
        rows.append((i, t))
    return rows + [(100, None), (101, ""), (102, "x" * 500), (103, rows[3][1]), (3, rows[3][1]), (104, "x" * 199), (105, "x" * 200), (106, "\0" * 700), (None, rows[7][1]), (None, "lost " * 120), (None, "lost " * 120), (None, None), (3, "q" * 90)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, len(t or ""), "x", [1]) for i, t in rows], "doc_id long, text string, n_chars long, fp string, spans array<int>").repartition(3)


def test_against_brute_force(spark):
    rows = corpus()
    assert sorted((tuple(r) for r in S.suffix_dedup(frame(spark, rows)).collect()), key=str) == brute(rows)


def test_anchors_with_more_records_than_a_task_takes(spark):
    rows = corpus()
    for group in (1, 3):
        assert sorted((tuple(r) for r in S.suffix_dedup(frame(spark, rows), group=group).collect()), key=str) == brute(rows)


def test_contexts_of_a_common_passage(spark):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage, lefts, rights = text(190), [text(40) for _ in range(4)], [text(40) for _ in range(4)]
    rows = []
    for i in range(120):
        left, right = rng.choice(lefts)[-rng.randint(0, 40) or 40 :], rng.choice(rights)[: rng.randint(0, 40)]
        rows.append((i, text(30) + left + passage + right + text(30)))
    got = sorted((tuple(r) for r in S.suffix_dedup(frame(spark, rows), group=5).collect()), key=str)
    assert got == brute(rows) and 20 < sum(r[2] > 0 for r in got) < 120


def test_empty_table(spark):
    assert S.suffix_dedup(frame(spark, corpus()).where("false")).count() == 0


def test_texts_and_columns(spark):
    rows = corpus()
    out = S.remove_repeats(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "n_chars", "fp", "spans"]
    got = out.collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) and r.spans == [1] for r in got)
    ascii_only = {i for i, t in rows if (t or "").isascii()}
    want = sorted((str(i), n - gone) for i, n, gone, _, _ in brute(rows) if i in ascii_only)
    assert sorted((str(r.doc_id), len(r.text)) for r in got if r.doc_id in ascii_only) == want


def test_long_texts_are_searched_by_pieces(monkeypatch):
    import pyarrow as pa

    rng = random.Random(1)
    text = "".join(rng.choice("abcdef ") for _ in range(40_000))
    batch = next(S.pack([pa.RecordBatch.from_pydict({"key": pa.array([7], pa.int64()), "text": [text]})]))
    whole = [b.to_pydict() for b in S._anchors([batch])]
    monkeypatch.setattr(S, "PIECE", 5000)
    pieces = [b.to_pydict() for b in S._anchors([batch])]
    assert whole == pieces and len(whole[0]["lo"]) > 300


def test_deep_shallow_order():
    rng = random.Random(8)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 60))).encode() for _ in range(300)]
    strings += [b"prefix" * 6 + s for s in strings[:150]] + [b"same" * 9] * 40 + [b"same" * 9 + b"\0", b"same" * 9 + b"\0\0"]
    text, size = S._matrix(strings, 104)
    group = np.array([i % 3 for i in range(len(strings))])
    order = S.deep_shallow(group, text, size)
    assert [(group[i], strings[i]) for i in order] == sorted((group[i], s) for i, s in enumerate(strings))


def test_multikey_order_and_ties():
    rng = np.random.default_rng(4)
    for n, letters in ((0, 1), (1, 1), (50, 2), (3000, 3), (3000, 10**6)):
        words = rng.integers(0, letters, (n, 2)).astype(np.uint64)
        group = rng.integers(0, 7, n)
        order, ties = S.multikey(group, words)
        rows = [(group[i], *words[i].tolist()) for i in order]
        assert rows == sorted(rows) and sorted(order.tolist()) == list(range(n))
        assert ties.tolist() == [i > 0 and rows[i] == rows[i - 1] for i in range(n)]


def test_blind_trie():
    rng = random.Random(3)
    strings = list({"".join(rng.choice("abc") for _ in range(rng.randint(0, 12))).encode() for _ in range(400)})
    trie = S.BlindTrie(strings[0])
    for s in strings:
        trie.add(s)
    assert trie.ordered() == sorted(strings)
