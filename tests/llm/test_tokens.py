"""Token counts and the BPE codec against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexiforge.llm import bpe_codec, token_counts

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None,
    "",
    " ",
    "<|endoftext|>a b<|endoftext|><|startoftext|>c",
    "  x  \n\n y\t z ",
    "ab\x85cd\xa0 e\x1c\x1df",
    "it's we'LL you'll 12345 ½²",
    "日本語 テスト 👍🏽 é",
    "İSΣ ΑΣ ​­﻿ x",
    "a" * 3000,
    "é" * 2000,
    "\x00\x7f" * 5,
    "....!!!!  ",
    " " * 1000 + "x",
    "aaaa bbbb " * 50,
]


def texts():
    each = ["".join(["a", chr(c), "b 1", chr(c), " ", chr(c), chr(c), "\n"]) for c in range(0x320)]
    return ODD + ["".join(each[i : i + 40]) for i in range(0, len(each), 40)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n int, block string, ids string").repartition(3)


def rows():
    out = [(i, t, 1, "x", "y") for i, t in enumerate(texts())]
    return out + out[3:6]


def test_counts_equal_the_library(spark):
    tok = Tokenizer.from_file(WORDS)
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(frame(spark, rows()), WORDS).collect())
    want = sorted((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows())
    assert got == want


def test_counts_of_sample_documents(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK_CHARS", 50_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tok = Tokenizer.from_file(WORDS)
    want = {r.doc_id: len(tok.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, WORDS).collect()} == want


def test_empty_tables(spark):
    none = frame(spark, rows()).where("false")
    assert token_counts.token_counts(none, WORDS).count() == 0
    assert bpe_codec.bpe_round_trip(none, BYTES).count() == 0


def test_round_trip_equals_the_library(spark):
    tok = Tokenizer.from_file(BYTES)

    def digest(s):
        return hashlib.sha256(s.encode()).hexdigest()

    want = []
    for i, t, *_ in rows():
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), digest(",".join(map(str, ids))), digest(tok.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in bpe_codec.bpe_round_trip(frame(spark, rows()), BYTES).collect()]
    assert sorted(got) == sorted(want)


def test_encode_then_decode(spark):
    coded = bpe_codec.bpe_encode(frame(spark, rows()), BYTES)
    back = {r.doc_id: r.text for r in bpe_codec.bpe_decode(coded, BYTES).collect()}
    assert back == {i: t or "" for i, t, *_ in rows()}


def test_compatible_pairs_are_those_that_stay_apart():
    codec, rng = bpe_codec.codec(BYTES), random.Random(3)
    ids = list(codec.sound.values())
    a, b = (np.array([rng.choice(ids) for _ in range(8000)]) for _ in range(2))
    apart = [codec.merge(codec.bytes_of[x] + codec.bytes_of[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    assert codec.compatible(a, b).tolist() == apart


def test_speculation_fails_for_some_words_and_is_mended():
    codec, tok = bpe_codec.codec(BYTES), Tokenizer.from_file(BYTES)
    words = [" " + w for r in ODD if r for w in r.split()] + [" thereinafter", " unbelievably", " thonandthere", " ingthe"]
    greedy = [codec.propose(w.encode()) for w in words]
    exact = codec.encode_words(words)
    assert exact == [codec.merge(w.encode()) for w in words]
    assert any(g != e for g, e in zip(greedy, exact, strict=True))
    assert all(codec.encode_words([w])[0] == tok.encode(w, add_special_tokens=False).ids for w in words[-4:])


@pytest.mark.parametrize("cp", [0x2FF, 0x300, 0x3A3, 0x1F600])
def test_border_of_plain_characters(cp):
    text, tok = f"x{chr(cp)}y Z{chr(cp)} 5{chr(cp)}", Tokenizer.from_file(WORDS)
    pieces, _ = token_counts.PreTokens(WORDS).split(text)
    assert sum(len(e.ids) for e in tok.encode_batch(pieces, add_special_tokens=False)) == len(tok.encode(text, add_special_tokens=False).ids)
