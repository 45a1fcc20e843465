"""Word shingles as 64-bit hashes, whole blocks of texts at a time.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D in the UTF-8 text
with A-Z lower-cased; a shingle is ``WIDTH`` consecutive words, or all of them
if there are fewer.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
#: Bytes hashed together; longer texts make a block of their own.
BLOCK_BYTES = 1 << 20

_U = np.uint64
_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = _rng.integers(1, 2**63, WIDTH, dtype=np.uint64) | _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_power: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if n > len(_power.get("up", ())):
        size = max(n, BLOCK_BYTES + (1 << 18))
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _power[name] = np.multiply.accumulate(a)
    return _power["up"], _power["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _hash_block(raw: list[bytes]) -> list[np.ndarray]:
    joined = b" ".join(raw).lower()  # bytes.lower() changes A-Z only
    ends_at = np.cumsum([len(r) + 1 for r in raw])
    buf = np.frombuffer(joined, np.uint8)
    if not buf.size:
        return [np.zeros(0, np.uint64) for _ in raw]
    space = _SPACE[buf]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers(len(buf) + 1)
    with np.errstate(over="ignore"):
        run = np.concatenate([[_U(0)], np.cumsum(_BYTE[buf] * up[: len(buf)])])
        word = mix((run[stop] - run[start]) * down[start] + (stop - start).astype(np.uint64) * _ODD[0])
        n = max(0, len(word) - WIDTH + 1)
        five = np.zeros(n, np.uint64)
        for k in range(WIDTH):
            five += word[k : k + n] * _ODD[k]
        five = mix(five)
        last = np.searchsorted(start, ends_at)  # words up to the end of each text
        out, first = [], 0
        for end in last.tolist():
            if end - first >= WIDTH:
                out.append(five[first : end - WIDTH + 1])
            elif end > first:
                few = _U(end - first)
                for k in range(first, end):
                    few = few * _ODD[1] + word[k] * _ODD[k - first]
                out.append(mix(np.array([few], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
            first = end
    return out


def shingle_hashes(texts: list[str | bytes | None]) -> list[np.ndarray]:
    """Hashes of the shingles of each text in order, repeats included."""
    out: list[np.ndarray] = []
    block: list[bytes] = []
    size = 0
    for text in texts:
        raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
        if block and size + len(raw) > BLOCK_BYTES:
            out += _hash_block(block)
            block, size = [], 0
        block.append(raw)
        size += len(raw) + 1
    return out + (_hash_block(block) if block else [])


def shingle_sets(texts: list[str | bytes | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    return [np.unique(h) for h in shingle_hashes(texts)]
