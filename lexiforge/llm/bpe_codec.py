"""Byte-level BPE, encoded by speculation and verification, and decoded.

The distinct words of a batch are cut greedily into longest vocabulary matches
(the speculation). A token sequence is the BPE encoding of its bytes exactly if
every adjacent pair would stay apart when encoded alone, given that every token
encodes to itself. So each distinct adjacent pair is tested once, all of a
batch together as arrays; words with a failing pair are merged exactly.

Defined results for odd input: null text is empty (0 tokens, digests of the
empty string); repeated rows each give a row; empty tables give none; other
columns don't take part.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .token_counts import NOT_PLAIN, SPACES, char_class, load

#: The words of the byte vocabulary (fixed pattern of its file) over plain characters.
_L, _N = char_class("L"), char_class("N")
WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{SPACES}{_L}{_N}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
#: Words that a worker remembers before it starts afresh.
MEMO_WORDS = 400_000
#: Longer words are not remembered.
MEMO_CHARS = 64


def byte_letters() -> dict[str, int]:
    """The published rule of byte-level BPE: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        vocabulary = {raw(s): i for s, i in spec["model"]["vocab"].items()}
        size = max(vocabulary.values()) + 1
        self.bytes_of: list[bytes] = [b""] * (max([size - 1, *(t["id"] for t in spec["added_tokens"])]) + 1)
        for b, i in vocabulary.items():
            self.bytes_of[i] = b
        for t in spec["added_tokens"]:
            self.bytes_of[t["id"]] = t["content"].encode()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.id_of = vocabulary
        self.rank: dict[int, tuple[int, int]] = {}  # pair key -> rank, merged id
        self.base = size
        # by merge rank; single bytes come before every merge
        self.left, self.right = np.arange(size), np.arange(size)
        self.made_at = np.full(size, -1, np.int64)
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            a, b = raw(a), raw(b)
            x, y, z = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.rank.setdefault(x * size + y, (rank, z))
            if self.made_at[z] < 0:
                self.made_at[z], self.left[z], self.right[z] = rank, x, y
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        ranks = np.fromiter((r for r, _ in self.rank.values()), np.int64, len(self.rank))
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], ranks[order]
        # only tokens that encode to themselves can be proposed
        self.sound = {b: i for b, i in vocabulary.items() if len(b) == 1 or self.merge(b) == [i]}
        self.longest = max(map(len, self.sound))
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, tuple[int, str]] = {}

    # -- speculation -----------------------------------------------------
    def propose(self, word: bytes) -> list[int]:
        out, at, n, get = [], 0, len(word), self.sound.get
        while at < n:
            for end in range(min(n, at + self.longest), at, -1):
                token = get(word[at:end])
                if token is not None:
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            out.append(token)
            at = end
        return out

    # -- verification ----------------------------------------------------
    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.base + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], np.iinfo(np.int64).max)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens, whether no merge would ever cross the border between them.

        Both tokens are unrolled backwards, always the one whose last merge is
        later. Seen forwards, while the border stands between x (the right end of
        a at that moment) and y (the left start of b), the merge (x, y) would
        have to be due before the next merge that consumes x or y.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        good = np.ones(len(a), bool)
        x, y = a.copy(), b.copy()
        never = np.iinfo(np.int64).max
        until_x = np.full(len(a), never)  # rank of the merge that consumes x from the left side
        until_y = np.full(len(a), never)
        live = np.arange(len(a))
        while live.size:
            xs, ys = x[live], y[live]
            rank = self._rank_of(xs, ys)
            # the leftmost of equal merges goes first: a left merge at the same rank wins, a right one doesn't
            bad = (rank < until_x[live]) & (rank <= until_y[live]) & (rank != never)
            good[live[bad]] = False
            mx, my = self.made_at[xs], self.made_at[ys]
            live_on = ~bad & ((mx >= 0) | (my >= 0))
            take_x = live_on & (mx > my)
            # equal ranks: the same merge on both sides; the right one happened last
            take_y = live_on & ~take_x
            ix, iy = live[take_x], live[take_y]
            until_x[ix] = mx[take_x]
            x[ix] = self.right[xs[take_x]]
            until_y[iy] = my[take_y]
            y[iy] = self.left[ys[take_y]]
            live = live[live_on]
        return good

    # -- exact merging ---------------------------------------------------
    def merge(self, word: bytes) -> list[int]:
        """The merges themselves, lowest rank first and leftmost first, with a heap over a linked list."""
        ids = [self.id_of[word[i : i + 1]] for i in range(len(word))]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = self.rank.get(ids[i] * self.base + ids[i + 1])
            if found:
                heap.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, p, q, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != p or j >= n or ids[j] != q:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                found = self.rank.get(made * self.base + ids[after[i]])
                if found:
                    heapq.heappush(heap, (found[0], i, made, ids[after[i]], found[1]))
            k = before[i]
            if k >= 0:
                found = self.rank.get(ids[k] * self.base + made)
                if found:
                    heapq.heappush(heap, (found[0], k, ids[k], made, found[1]))
        return [t for t in ids if t >= 0]

    # -- batches of words --------------------------------------------------
    def encode_words(self, words: list[str]) -> list[list[int]]:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        cut = [self.propose(w) for w in raw]
        size = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = np.fromiter((t for c in cut for t in c), np.int64, int(size.sum()))
        if flat.size > 1:
            inside = np.ones(flat.size, bool)
            ends = np.cumsum(size)
            inside[ends[size > 0] - 1] = False  # no pair across words
            inside[-1] = False
            at = np.flatnonzero(inside)
            key = flat[at] * self.base + flat[at + 1]
            own, back = np.unique(key, return_inverse=True)
            fresh = np.fromiter((k for k in own.tolist() if k not in self.pairs), np.int64)
            if fresh.size:
                self.pairs.update(zip(fresh.tolist(), self.compatible(fresh // self.base, fresh % self.base).tolist(), strict=True))
            good = np.fromiter(map(self.pairs.__getitem__, own.tolist()), bool, own.size)[back]
            word_of = np.repeat(np.arange(len(cut)), size)
            for w in np.unique(word_of[at[~good]]).tolist():
                cut[w] = self.merge(raw[w])
            if len(self.pairs) > 4_000_000:
                self.pairs.clear()
        return cut

    def split(self, text: str) -> list[str]:
        """Words of the whole text; special strings come as words of their own."""
        parts = [text]
        if self.cutter and "<|" in text:
            parts = self.cutter.split(text)
        out: list[str] = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(part)
            elif part.isascii() or not NOT_PLAIN.search(part):
                out += WORDS.findall(part)
            else:
                out += [part[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(part)]
        return out

    @property
    def cutter(self):
        return self._cutter

    def attach(self, path: str) -> Codec:
        self.library, cut = load(path)
        self._cutter = re.compile(f"({cut.pattern})") if cut is not None else None
        self.words = {s: (1, str(i), self.bytes_of[i]) for s, i in self.special.items()}
        return self

    def learn(self, texts: list[list[str]]) -> dict[str, tuple[int, str, bytes]]:
        """(tokens, decimal ids, decoded bytes) of all words in ``texts``; most are already known."""
        if len(self.words) > MEMO_WORDS:
            self.words = {s: (1, str(i), self.bytes_of[i]) for s, i in self.special.items()}
        fresh = [w for w in dict.fromkeys(w for t in texts for w in t) if w not in self.words]
        said = {}
        for w, ids in zip(fresh, self.encode_words(fresh), strict=True):
            # decoded from the ids, so that a wrong id shows in the digest
            said[w] = (len(ids), ",".join(map(str, ids)), b"".join([self.bytes_of[i] for i in ids]))
        self.words.update((w, v) for w, v in said.items() if len(w) <= MEMO_CHARS)
        return said


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path).attach(path)


CODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
#: Characters of text whose words are learnt together.
GROUP_CHARS = 2_000_000


def encode(text: str, path: str) -> list[int]:
    c = codec(path)
    words = c.split(text)
    return [t for w in words for t in ([c.special[w]] if w in c.special else c.encode_words([w])[0])]


def decode(ids: list[int], path: str) -> str:
    c = codec(path)
    return b"".join([c.bytes_of[i] for i in ids]).decode("utf-8", "replace")


def _digests(path: str):
    def group(c: Codec, held: list[tuple]) -> pa.RecordBatch:
        words = [c.split(t) for _, t in held]
        said = c.learn(words)
        known = c.words
        n, ids, back = [], [], []
        for own in words:
            got = [known[w] if w in known else said[w] for w in own]
            n.append(sum([g[0] for g in got]))
            ids.append(hashlib.sha256(",".join([g[1] for g in got]).encode()).hexdigest())
            plain = b"".join([g[2] for g in got]).decode("utf-8", "replace")
            back.append(hashlib.sha256(plain.encode("utf-8")).hexdigest())
        return pa.RecordBatch.from_arrays([pa.array([d for d, _ in held], pa.int64()), pa.array(n, pa.int64()), pa.array(ids), pa.array(back)], schema=CODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, held, chars = codec(path), [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append((doc_id, text or ""))
                chars += len(text or "")
                if chars >= GROUP_CHARS:
                    yield group(c, held)
                    held, chars = [], 0
        if held:
            yield group(c, held)

    return run


def _ids(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([encode(t or "", path) for t in texts], pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    return run


def bpe_encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids``: the token ids of every text."""
    return docs.select("doc_id", "text").mapInArrow(_ids(tokenizer), "doc_id long, ids array<int>")


def bpe_decode(coded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([decode(x or [], tokenizer) for x in batch.column(1).to_pylist()])], names=["doc_id", "text"]
            )

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def bpe_round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text."""
    return docs.select("doc_id", "text").mapInArrow(_digests(tokenizer), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
