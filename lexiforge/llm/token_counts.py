"""Token counts without token ids.

Pieces are counted once per distinct pre-token and the counts are joined to
the pre-token frequencies of the documents.

Documents are cut into blocks of bounded text. A block has its own vocabulary
of distinct pre-tokens and, for each document, the frequencies over that
vocabulary. Only vocabularies are shuffled, so a very common pre-token travels
once per block and a hot source or a very long document changes nothing.

Defined results for odd input: null text counts as empty (0 tokens); repeated
rows each give a row; empty tables give none; other columns don't take part.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import Staging, tidy

#: A block ends with the document that brings it to so many characters.
BLOCK_CHARS = 24_000_000
#: Below this code point Python's lower() and NFC agree with the library's, character by character.
PLAIN = 0x300


def char_class(*kinds: str) -> str:
    """The code points below PLAIN whose category starts with one of ``kinds``, as the inside of a class."""
    out, start = [], None
    for cp in range(PLAIN + 1):
        inside = cp < PLAIN and unicodedata.category(chr(cp))[0] in kinds
        if inside and start is None:
            start = cp
        elif not inside and start is not None:
            out.append(f"\\u{start:04x}-\\u{cp - 1:04x}")
            start = None
    return "".join(out)


#: White space below PLAIN as Unicode's White_Space property has it.
SPACES = r"\t-\r \x85\xa0"
#: The pre-tokens of the word vocabulary (fixed pattern of its file) over plain characters.
WORD_PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{char_class('L')}]+|[{char_class('N')}]|[^{SPACES}{char_class('L')}{char_class('N')}]+"
)
NOT_PLAIN = re.compile(f"[^\\u0000-\\u{PLAIN - 1:04x}]")


@lru_cache(maxsize=4)
def load(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_padding()
    tok.no_truncation()
    specials = sorted((t.content for t in tok.get_added_tokens_decoder().values()), key=len, reverse=True)
    cut = re.compile("|".join(map(re.escape, specials))) if specials else None
    return tok, cut


class PreTokens:
    """Splits text into the normalised pre-tokens of a tokenizer file, special strings apart."""

    def __init__(self, path: str):
        self.tok, self.cut = load(path)

    def library(self, text: str) -> list[str]:
        text = self.tok.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and how many special strings stood between them."""
        parts = [text]
        if self.cut is not None and "<|" in text:
            parts = self.cut.split(text)
        out: list[str] = []
        for part in parts:
            if not part:
                continue
            if part.isascii() or not NOT_PLAIN.search(part):
                out += WORD_PIECES.findall(part.lower())
            else:
                out += self.library(part)
        return out, len(parts) - 1


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(a.tobytes())


def _unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=dtype)


BLOCKS = pa.schema(
    [
        ("block", pa.string()),
        ("vocabulary", pa.list_(pa.string())),
        ("ids", pa.binary()),
        ("ends", pa.binary()),
        ("freq", pa.binary()),
        ("doc_id", pa.list_(pa.int64())),
        ("n_bytes", pa.list_(pa.int64())),
        ("special", pa.list_(pa.int64())),
    ]
)
BLOCKS_DDL = (
    "block string, vocabulary array<string>, ids binary, ends binary, freq binary, "
    "doc_id array<long>, n_bytes array<long>, special array<long>"
)


#: Blocks whose rows of one pre-token meet in a task.
TOGETHER = 1000
#: Pre-tokens whose counts a task remembers before it starts afresh.
KNOWN = 1_000_000


class _Block:
    def __init__(self):
        self.vocabulary: dict[str, int] = defaultdict(count().__next__)
        self.ids: list[np.ndarray] = []
        self.freq: list[np.ndarray] = []
        self.ends: list[int] = []
        self.doc_id, self.n_bytes, self.special, self.chars = [], [], [], 0

    def add(self, doc_id, text: str, pieces: list[str], special: int) -> None:
        get = self.vocabulary.__getitem__
        ids = np.fromiter(map(get, pieces), dtype=np.int32, count=len(pieces))
        own, freq = np.unique(ids, return_counts=True)
        if own.size:
            own[1:] -= own[:-1].copy()  # gaps pack better than ids
        self.ids.append(own)
        self.freq.append(freq.astype(np.int32))
        self.ends.append(own.size)
        self.doc_id.append(doc_id)
        self.n_bytes.append(len(text.encode("utf-8", "surrogatepass")))
        self.special.append(special)
        self.chars += len(text)

    def batch(self) -> pa.RecordBatch:
        cat = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int32)
        row = [
            uuid.uuid4().hex[:16],
            list(self.vocabulary),
            _pack(cat(self.ids)),
            _pack(np.asarray(self.ends, np.int32)),
            _pack(cat(self.freq)),
            self.doc_id,
            self.n_bytes,
            self.special,
        ]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, BLOCKS.types, strict=True)], schema=BLOCKS)


def _to_blocks(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, block = PreTokens(path), _Block()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                block.add(doc_id, text, *pre.split(text))
                if block.chars >= BLOCK_CHARS:
                    yield block.batch()
                    block = _Block()
        if block.doc_id:
            yield block.batch()

    return run


def _count_pieces(path: str):
    """Rows (piece, block, at), all rows of a piece in one partition -> (block, at[], n[])."""
    out = pa.schema([("block", pa.string()), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, _ = load(path)
        known: dict[str, int] = {}
        held: list[tuple] = []
        rows = 0

        def flush():
            blocks = np.concatenate([h[0] for h in held])
            at = np.concatenate([h[1] for h in held])
            n = np.concatenate([h[2] for h in held])
            names, code = np.unique(blocks, return_inverse=True)
            order = np.argsort(code, kind="stable")
            cuts = np.searchsorted(code[order], np.arange(len(names) + 1))
            offsets = pa.array(cuts.astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(names.astype(object), pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(at[order])),
                    pa.ListArray.from_arrays(offsets, pa.array(n[order])),
                ],
                schema=out,
            )

        for batch in batches:
            pieces = batch.column(0).to_pylist()
            if len(known) > KNOWN:
                known.clear()
            fresh = [p for p in dict.fromkeys(pieces) if p not in known]
            if fresh:
                known.update(zip(fresh, (len(e) for e in tok.encode_batch(fresh, add_special_tokens=False)), strict=True))
            n = np.fromiter(map(known.__getitem__, pieces), np.int32, len(pieces))
            held.append((batch.column(1).to_numpy(zero_copy_only=False).astype("U16"), batch.column(2).to_numpy(zero_copy_only=False).astype(np.int32), n))
            rows += len(pieces)
            if rows >= 500_000:
                yield flush()
                held, rows = [], 0
        if held:
            yield flush()

    return run


COUNTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _sum_block(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block's frequencies and the counts of its vocabulary -> tokens of its documents."""
    row = left.to_pylist()[0]
    flat = lambda name: np.concatenate([np.zeros(0, np.int32), *(c.flatten().to_numpy() for c in right.column(name).chunks)])
    at = flat("at")
    n = np.zeros(int(at.max()) + 1 if at.size else 0, np.int64)
    n[at] = flat("n")
    gaps, ends, freq = (_unpack(row[k], np.int32) for k in ("ids", "ends", "freq"))
    total = np.asarray(row["special"], np.int64)
    if gaps.size:
        start = np.cumsum(ends, dtype=np.int64) - ends
        run = np.cumsum(gaps, dtype=np.int64)
        ids = run - np.repeat(np.where(start > 0, run[np.maximum(start, 1) - 1], 0), ends)
        have = ends > 0
        total[have] += np.add.reduceat(n[ids] * freq, start[have])
    return pa.Table.from_arrays([pa.array(row["doc_id"], pa.int64()), pa.array(row["n_bytes"], pa.int64()), pa.array(total)], schema=COUNTED)


@tidy
def token_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for each row of ``docs`` (doc_id, text) under a word vocabulary file."""
    staging = Staging(docs.sparkSession, "token-counts")
    blocks = staging.put(docs.select("doc_id", "text").mapInArrow(_to_blocks(tokenizer), BLOCKS_DDL), "blocks")
    rows = blocks.select("block", F.posexplode("vocabulary").alias("at", "piece")).select("piece", "block", "at")
    # a pre-token that every block holds is counted in as many tasks as keep its rows few
    deals = F.lit(-(-blocks.count() // TOGETHER) or 1)
    counts = rows.repartition("piece", F.pmod(F.xxhash64("block"), deals)).mapInArrow(_count_pieces(tokenizer), "block string, at array<int>, n array<int>")
    summed = (
        blocks.drop("vocabulary")
        .groupBy("block")
        .cogroup(counts.groupBy("block"))
        .applyInArrow(_sum_block, "doc_id long, n_bytes long, n_tokens long")
    )
    result = staging.put(summed, "result")
    staging.drop("blocks")
    return result
