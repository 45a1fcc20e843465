"""Removal of byte strings that occur more than once, by suffix sorting.

Every byte inside a SPAN-byte string that also starts elsewhere, in the same
document or another, is removed. Suffixes of the whole corpus would be sorted
in vain, since most occur once; so the suffixes to sort are found first.

1. Anchors. Of every SPAN-byte string the leftmost smallest hash among its
   GRAM-byte strings is an anchor. It depends on the string alone, so equal
   strings have equal anchors at equal places, and strings whose anchor occurs
   once in the corpus are unique.
2. An anchor's record is the text around it that strings through it can reach
   (REACH bytes on the left, SPAN from its start on the right). Records with
   equal text, found by counting digests, repeat as a whole; a block of texts
   counts its own first and sends one row for each different record.
3. Anchors that occur with different texts are sorted: their right parts and
   their reversed left parts are suffixes, ordered by deep-shallow sorting.
   Multikey quicksort on 8-byte letters orders them to a shallow depth, blind
   tries order what still ties. In the order of the left parts, records that
   share l bytes are neighbours; the longest right match r of each inside such a
   set shows a repeated string of l + r bytes.
4. An anchor with more than GROUP different records, too many for one task, is
   split: a string through it has k bytes before the anchor, and the range of k
   is halved. A record goes to either half as the window that strings of this
   half can reach, dealt by the bytes that all of them hold; equal windows
   repeat as a whole and become one. So groups shrink until each can be sorted;
   where k is a single number all windows of a group are equal.
5. The spans of a document are united and cut from its bytes.

Only 36 bytes per anchor (about one anchor in 68 bytes) go through the large
shuffles; counting combines before the shuffle, and the joins have a plain
exchange on either side, so that a hot anchor's rows are split. Rows get a key
when they are first staged, and everything is joined by it.

Defined results for odd input: null text is empty; texts under SPAN bytes lose
nothing; repeated rows, also those without doc_id, are copies of each other, so
they lose all (from SPAN bytes on); rows that share a doc_id are judged each by
its own text; empty tables give none; other columns don't take part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from .packed import pack, unpack
from .shingles import _powers, mix
from .staging import Staging, tidy

SPAN, GRAM = 200, 64
REACH = SPAN - GRAM
#: Bytes whose anchors are found together.
BLOCK_BYTES = 1 << 18
#: Records of one anchor that one task sorts; more are split.
GROUP = 20_000
#: Records after which the groups gathered so far are sorted.
SORTED = 20_000
#: Depth in bytes to which suffixes are ordered by multikey quicksort before blind tries take over.
SHALLOW = 16

_U = np.uint64
_TABLE = np.random.default_rng(0xB17E).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = [int(x) | 1 for x in np.random.default_rng(77).integers(1, 2**63, 6)]


def _find(raw: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text number, position, fp, ctx) of the anchors of a block of texts."""
    buf = np.frombuffer(b"".join(raw), np.uint8)
    size = np.array([len(r) for r in raw], np.int64)
    stop = np.cumsum(size)
    start = stop - size
    n = len(buf)
    if n < SPAN:
        return (np.zeros(0, np.int64),) * 4
    with np.errstate(over="ignore"):
        letters = _TABLE[buf]
        gram, width = letters, 1
        for k in _STEP:  # doubling: 1, 2, 4, ... GRAM bytes
            gram = gram[: len(gram) - width] * _U(k) + gram[width:]
            width *= 2
        gram = mix(gram)
        # 44 bits of hash above 20 bits of position: the least is the leftmost of the smallest
        low = (gram & ~_U((1 << 20) - 1)) | np.arange(len(gram), dtype=np.uint64)
        width, want = 1, REACH + 1
        while width * 2 <= want:
            low = np.minimum(low[: len(low) - width], low[width:])
            width *= 2
        if want > width:
            low = np.minimum(low[: len(low) - (want - width)], low[want - width :])
        inside = np.zeros(n + 1, np.int8)
        long = size >= SPAN
        np.add.at(inside, start[long], 1)
        np.add.at(inside, stop[long] - SPAN + 1, -1)
        inside = np.cumsum(inside[: len(low)]).astype(bool)
        at = np.unique((low[inside] & _U((1 << 20) - 1)).astype(np.int64))
        who = np.searchsorted(stop, at, side="right")
        lo, hi = np.maximum(at - REACH, start[who]), np.minimum(at + SPAN, stop[who])
        up, down = _powers(n + 1)
        run = np.concatenate([[_U(0)], np.cumsum(letters * up[:n])])
        ctx = mix((run[hi] - run[lo]) * down[lo] + (at - lo).astype(np.uint64) * _U(_STEP[0]) + (hi - at).astype(np.uint64) * _U(_STEP[1]))
        return who, at - start[who], gram[at].view(np.int64), ctx.view(np.int64)


def _blocks(keys: list, packed: list) -> Iterator[tuple[list, list[bytes]]]:
    """Groups of (keys, bytes) of bounded size; a long text is a group of its own."""
    held_keys, held, size = [], [], 0
    for key, small in zip(keys, packed, strict=True):
        raw = unpack(small)
        if held and size + len(raw) > BLOCK_BYTES:
            yield held_keys, held
            held_keys, held, size = [], [], 0
        held_keys.append(key)
        held.append(raw)
        size += len(raw)
    if held:
        yield held_keys, held


#: Longer texts are searched piece by piece.
PIECE = 900_000


def _find_long(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, fp, ctx) of the anchors of a long text, from overlapping pieces."""
    own: dict[int, tuple[int, int]] = {}
    edge = 2 * SPAN  # each string and each record lies whole in the piece it is taken from
    for lo in range(0, len(text), PIECE - 2 * edge - SPAN):
        piece = text[lo : lo + PIECE]
        end = lo + PIECE >= len(text)
        _, pos, fp, ctx = _find([piece])
        first, last = (0 if lo == 0 else edge - SPAN), (len(piece) if end else len(piece) - SPAN)
        for p, f, c in zip(pos.tolist(), fp.tolist(), ctx.tolist(), strict=True):
            if (lo == 0 or first <= p - REACH) and (end or p + SPAN <= last):
                own[lo + p] = (f, c)
        if end:
            break
    pos = np.array(sorted(own), np.int64)
    return pos, np.array([own[p][0] for p in pos.tolist()], np.int64), np.array([own[p][1] for p in pos.tolist()], np.int64)


#: Rows with fp: a record, how often its block holds it, and where it stands; rows without: a span known to repeat.
ANCHOR = "fp long, ctx long, n long, key long, lo int, hi int"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, raw in _blocks(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if len(raw) == 1 and len(raw[0]) > PIECE:
                pos, fp, ctx = _find_long(raw[0])
                who = np.zeros(len(pos), np.int64)
            else:
                who, pos, fp, ctx = _find(raw)
            key = np.array(keys, np.int64)[who]
            order = np.lexsort((pos, who, ctx, fp))
            key, pos, fp, ctx = key[order], pos[order], fp[order], ctx[order]
            first = np.flatnonzero(np.concatenate([[True], (fp[1:] != fp[:-1]) | (ctx[1:] != ctx[:-1])])[: len(fp)])
            n = np.diff(np.append(first, len(fp)))
            again = np.repeat(n > 1, n)
            doc, lo, hi = overlay(key[again], np.maximum(pos[again] - REACH, 0), pos[again] + SPAN)
            empty = pa.nulls(len(doc), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(fp[first], pa.int64()), empty]),
                    pa.concat_arrays([pa.array(ctx[first], pa.int64()), empty]),
                    pa.concat_arrays([pa.array(n, pa.int64()), empty]),
                    pa.array(np.concatenate([key[first], doc]), pa.int64()),
                    pa.array(np.concatenate([pos[first], lo]).astype(np.int32)),
                    pa.array(np.concatenate([pos[first], hi]).astype(np.int32)),
                ],
                names=["fp", "ctx", "n", "key", "lo", "hi"],
            )


RECORD = "fp long, key long, pos int, back int, bytes binary"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, packed, wanted anchors) -> the bytes around each wanted anchor; ``back`` of them stand before it."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256).to_pylist()
            fp, key, pos, back, out = [], [], [], [], []
            for row in part:
                raw = unpack(row["packed"])
                for want in row["wanted"]:
                    p = want["pos"]
                    a = max(0, p - REACH)
                    fp.append(want["fp"])
                    key.append(row["key"])
                    pos.append(p)
                    back.append(p - a)
                    out.append(raw[a : p + SPAN])
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp, pa.int64()), pa.array(key, pa.int64()), pa.array(pos, pa.int32()), pa.array(back, pa.int32()), pa.array(out, pa.binary())],
                names=["fp", "key", "pos", "back", "bytes"],
            )


# -- deep-shallow sorting ----------------------------------------------------


class BlindTrie:
    """Orders strings that share a long prefix; inner nodes know only their depth and branching bytes."""

    __slots__ = ("root",)

    def __init__(self, first: bytes):
        self.root: object = first

    @staticmethod
    def _shared(a: bytes, b: bytes) -> int:
        n = min(len(a), len(b))
        x = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
        return n - (x.bit_length() + 7) // 8

    def add(self, s: bytes) -> None:
        path, node = [], self.root
        while not isinstance(node, bytes):  # blind descent: branching bytes only
            depth, kids = node
            key = s[depth] if depth < len(s) else -1
            path.append((node, key))
            node = kids.get(key)
            if node is None:
                node = next(iter(kids.values()))
                while not isinstance(node, bytes):
                    node = next(iter(node[1].values()))
                break
        leaf = node
        if leaf == s:
            return
        depth = self._shared(leaf, s)
        key = s[depth] if depth < len(s) else -1
        at = self.root
        above = None
        while not isinstance(at, bytes) and at[0] < depth:
            k = s[at[0]] if at[0] < len(s) else -1
            above, at = (at, k), at[1].get(k)
        if not isinstance(at, bytes) and at is not None and at[0] == depth:
            at[1][key] = s
            return
        other = leaf[depth] if depth < len(leaf) else -1
        fresh = (depth, {other: at, key: s})
        if above is None:
            self.root = fresh
        else:
            above[0][1][above[1]] = fresh

    def ordered(self) -> list[bytes]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, bytes):
                out.append(node)
            else:
                stack += [node[1][k] for k in sorted(node[1], reverse=True)]
        return out


def multikey(group: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of the rows of ``words`` inside each group, groups ascending.

    Gives the order and, for each place, whether its row equals the one before.
    A segment of rows that tie so far is parted into those below, equal to and
    above the middle row's letter; the equal ones go on with the next letter.
    All segments of a round are parted together.
    """
    n, depth = words.shape
    order = np.argsort(group, kind="stable")
    ties = np.zeros(n, bool)
    if not n:
        return order, ties
    edge = np.flatnonzero(np.diff(group[order], prepend=group[order[0]] - 1) != 0)
    start, size, level = edge, np.diff(np.append(edge, n)), np.zeros(len(edge), np.int64)
    while len(start):
        live = size > 1
        done = live & (level == depth)
        for lo, hi in zip(start[done].tolist(), (start + size)[done].tolist(), strict=True):
            ties[lo + 1 : hi] = True
        start, size, level = (x[live & ~done] for x in (start, size, level))
        if not len(start):
            break
        base = np.concatenate([[0], np.cumsum(size)[:-1]])
        own = np.repeat(np.arange(len(start)), size)
        place = np.arange(len(own)) - np.repeat(base, size) + np.repeat(start, size)
        row = order[place]
        letter = words[row, np.repeat(level, size)]
        # the pivot is the median of the first, middle and last letter
        three = np.sort(np.stack([letter[base], letter[base + size // 2], letter[base + size - 1]]), axis=0)
        pivot = three[1][own]
        side = (letter >= pivot).astype(np.int8) + (letter > pivot)
        below = np.bincount(own, side == 0, len(start)).astype(np.int64)
        equal = np.bincount(own, side == 1, len(start)).astype(np.int64)
        first = np.stack([start, start + below, start + below + equal])
        for k in range(3):
            mine = side == k
            seen = np.cumsum(mine) - mine  # rows of this side before, in all segments
            order[first[k][own[mine]] + seen[mine] - seen[base][own[mine]]] = row[mine]
        above = size - below - equal
        start, size, level = np.concatenate(list(first)), np.concatenate([below, equal, above]), np.concatenate([level, level + 1, level])
    return order, ties


def deep_shallow(group: np.ndarray, text: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Order of the strings ``text[i, :size[i]]`` (zeros behind) inside each group, groups ascending.

    Multikey quicksort orders them by SHALLOW bytes, 8 at a time. Strings that
    still tie have a long common prefix; a blind trie orders each such set.
    """
    words = np.ascontiguousarray(text[:, :SHALLOW]).view(">u8").astype(np.uint64)
    order, ties = multikey(group, words)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], ties[1:].astype(np.int8), [0]])))
    for lo, hi in zip(edge[::2].tolist(), (edge[1::2] + 1).tolist(), strict=True):
        own = order[lo:hi]
        strings = [text[i, : size[i]].tobytes() for i in own.tolist()]
        if len(set(strings)) == 1:
            continue
        holders: dict[bytes, list[int]] = {}
        for i, s in zip(own.tolist(), strings, strict=True):
            holders.setdefault(s, []).append(i)
        trie = BlindTrie(strings[0])
        for s in holders:
            trie.add(s)
        order[lo:hi] = [i for s in trie.ordered() for i in holders[s]]
    return order


def _shared_prefix(text: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefix lengths of the strings a[i] and b[i]."""
    out = np.zeros(len(a), np.int64)
    for lo in range(0, len(a), 20_000):
        x, y = a[lo : lo + 20_000], b[lo : lo + 20_000]
        differ = text[x] != text[y]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), text.shape[1])
        out[lo : lo + 20_000] = np.minimum(first, np.minimum(size[x], size[y]))
    return out


def repeated_spans(group: np.ndarray, left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray) -> Iterator[tuple]:
    """(record, from, to) of repeated strings, relative to the anchor's start.

    ``left`` holds the reversed bytes before the anchors, ``right`` the bytes from their start.
    """
    n = len(group)
    by_right = deep_shallow(group, right, n_right)
    rank = np.empty(n, np.int64)
    rank[by_right] = np.arange(n)
    by_left = deep_shallow(group, left, n_left)
    same = group[by_left][1:] == group[by_left][:-1]
    shared = np.where(same, _shared_prefix(left, n_left, by_left[1:], by_left[:-1]), -1)
    # a set of records that share exactly l bytes on the left: neighbours with l or more, l somewhere
    for depth in np.unique(shared[same]).tolist():
        inside = shared >= depth
        edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
        first, last = edge[::2], edge[1::2]  # records first..last inclusive
        least = np.minimum.reduceat(np.append(shared, -1), edge)[::2]
        keep = least == depth
        first, last = first[keep], last[keep]
        width = last - first + 1
        if not width.size:
            continue
        spot = np.repeat(first - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
        run = np.repeat(np.arange(len(width)), width)
        own = by_left[spot]
        order = np.lexsort((rank[own], run))
        own, run = own[order], run[order]
        together = run[1:] == run[:-1]
        match = np.full(len(together), -1)
        match[together] = _shared_prefix(right, n_right, own[1:][together], own[:-1][together])
        best = np.maximum(np.concatenate([[-1], match]), np.concatenate([match, [-1]]))
        hit = depth + best >= SPAN
        yield own[hit], np.full(int(hit.sum()), -depth), best[hit]


SPANS = "key long, lo int, hi int"


def overlay(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the same documents united where they overlap or touch."""
    if not len(doc):
        return doc, lo, hi
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    run = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))
    reach = np.maximum.accumulate(hi + (run << 32)) - (run << 32)
    first = np.concatenate([[True], (doc[1:] != doc[:-1]) | (lo[1:] > reach[:-1])])
    last = np.concatenate([first[1:], [True]])
    return doc[first], lo[first], reach[last]


def _matrix(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join([p.ljust(width, b"\0") for p in parts]), np.uint8).reshape(len(parts), width), size


def _sorted_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records in order of fp -> repeated spans. Whole groups are sorted together, many at a time."""

    def resolve(rows: pa.Table) -> pa.RecordBatch:
        fp, doc, pos, back = (rows.column(c).to_numpy() for c in ("fp", "key", "pos", "back"))
        raw = rows.column("bytes").to_pylist()
        left, n_left = _matrix([r[:b][::-1] for r, b in zip(raw, back.tolist(), strict=True)], REACH)
        right, n_right = _matrix([r[b:] for r, b in zip(raw, back.tolist(), strict=True)], SPAN)
        found = list(repeated_spans(fp, left, n_left, right, n_right))
        who = np.concatenate([np.zeros(0, np.int64), *(f[0] for f in found)])
        lo = pos[who] + np.concatenate([np.zeros(0, np.int64), *(f[1] for f in found)])
        hi = pos[who] + np.concatenate([np.zeros(0, np.int64), *(f[2] for f in found)])
        doc, lo, hi = overlay(doc[who], lo, hi)
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["key", "lo", "hi"])

    held: list[pa.RecordBatch] = []
    rows, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        fp = batch.column(0).to_numpy()
        if rows >= SORTED:
            cut = int(np.argmax(fp != last)) if fp[-1] != last else len(fp)  # where the open group ends
            if cut < len(fp):
                yield resolve(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held, rows, batch = [], 0, batch.slice(cut)
        held.append(batch)
        rows, last = rows + batch.num_rows, fp[-1]
    if held:
        yield resolve(pa.Table.from_batches(held))


WINDOW = "fp long, first int, last int, whole long, key long, pos int, back int, bytes binary"


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records whose strings have first..last bytes before the anchor -> a window for either half of this range."""

    def digest(*parts: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), signed=True)

    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            out = []
            for row in batch.slice(at, 1024).to_pylist():
                raw, back, mid = row["bytes"], row["back"], (row["first"] + row["last"]) // 2
                for first, last in ((row["first"], mid), (mid + 1, row["last"])):
                    if back < first or len(raw) - back < SPAN - last:
                        continue  # holds no string of this half
                    window = raw[max(0, back - last) : back + SPAN - first]
                    left = min(back, last)
                    name = row["fp"].to_bytes(8, signed=True) + bytes([first, last])
                    out.append(
                        {
                            "fp": digest(name, raw[back - first : back + SPAN - last]),
                            "first": first,
                            "last": last,
                            "whole": digest(bytes([left]), window),
                            "key": row["key"],
                            "pos": row["pos"],
                            "back": left,
                            "bytes": window,
                        }
                    )
            schema = pa.schema([("fp", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("whole", pa.int64()), ("key", pa.int64()), ("pos", pa.int32()), ("back", pa.int32()), ("bytes", pa.binary())])
            yield pa.RecordBatch.from_pylist(out, schema=schema)


# -- cutting -------------------------------------------------------------------


def unite(lo: np.ndarray, hi: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that some span covers."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, np.minimum(lo, n), 1)
    np.add.at(edge, np.minimum(hi, n), -1)
    inside = np.cumsum(edge)[:n] > 0
    turn = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return list(zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True))


def cut(raw: bytes, spans) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of runs removed."""
    if not spans.is_valid:
        return raw, 0
    runs = unite(spans.values.field("lo").to_numpy(), spans.values.field("hi").to_numpy(), len(raw))
    ends = [0, *(x for r in runs for x in r), len(raw)]
    return b"".join([raw[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)]), len(runs)


CUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for packed, spans, doc_id in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
            raw = unpack(packed.as_py())
            kept, runs = cut(raw, spans)
            rows.append({"doc_id": doc_id, "n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": runs, "kept_sha256": hashlib.sha256(kept).hexdigest()})
        yield pa.RecordBatch.from_pylist(rows, schema=CUT)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            # a character that lost some of its bytes goes altogether
            out = [cut(unpack(p.as_py()), s)[0].decode("utf-8", "ignore") for p, s in zip(part.column(0), part.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), part.column(2)], names=["text", "rest"])


def _alike(records: DataFrame, by: list[str], kept: Column) -> DataFrame:
    """One record of each kind, and how many there are."""
    return records.groupBy(*by).agg(F.sum("n").alias("n"), F.min(kept).alias("rep"))


def repeated_strings(texts: DataFrame, staging: Staging, group: int = GROUP) -> DataFrame:
    """``key, spans`` from staged ``texts`` (key, packed): spans that cover the repeated bytes of each text that has some."""
    anchors = staging.put(texts.select("key", "packed").mapInArrow(_anchors, ANCHOR), "anchors")
    spans = [anchors.where("fp is null").select("key", "lo", "hi")]
    anchors = anchors.where("fp is not null").select("fp", "ctx", "n", "key", F.col("lo").alias("pos"))
    often = anchors.groupBy("fp").agg(F.sum("n").alias("n"), F.min("ctx").alias("low"), F.max("ctx").alias("high")).where("n > 1")
    often = staging.put(often.select("fp", (F.col("low") != F.col("high")).alias("mixed")), "often")
    found = staging.put(anchors.join(often, "fp"), "found")
    alike = staging.put(_alike(found, ["fp", "ctx", "mixed"], F.struct("key", "pos")), "alike")
    # records with equal text; those that a block holds twice are spans already
    told = found.where("n = 1").select("fp", "ctx", "key", "pos").join(alike.where("n > 1").select("fp", "ctx"), ["fp", "ctx"])
    spans.append(told.select("key", F.greatest(F.col("pos") - REACH, F.lit(0)).alias("lo"), (F.col("pos") + SPAN).alias("hi")))

    # one record of each text where an anchor has several
    mixed = alike.where("mixed").select("fp", "rep.key", "rep.pos")
    wanted = mixed.groupBy("key").agg(F.collect_list(F.struct("fp", "pos")).alias("wanted"))
    records = texts.select("key", "packed").join(wanted, "key").select("key", "packed", "wanted").mapInArrow(_records, RECORD)
    records = staging.put(records.withColumns({"first": F.lit(0), "last": F.lit(REACH)}), "records")
    for turn in range(1, 1 + REACH.bit_length() + 1):
        large = staging.put(records.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group).select("fp"), f"large-{turn}")
        small = records.join(large, "fp", "left_anti") if not (last := large.isEmpty()) else records
        small = small.select("fp", "key", "pos", "back", "bytes").repartition("fp").sortWithinPartitions("fp")
        spans.append(small.mapInArrow(_sorted_spans, SPANS))
        if last:
            break
        halves = staging.put(records.join(large, "fp", "left_semi").select("fp", "key", "pos", "back", "bytes", "first", "last").mapInArrow(_halves, WINDOW).withColumn("n", F.lit(1)), f"halves-{turn}")
        alike = staging.put(_alike(halves, ["fp", "whole", "first", "last"], F.struct("key", "pos", "back", "bytes")), f"alike-{turn}")
        told = halves.drop("n").join(alike.where("n > 1").select("fp", "whole"), ["fp", "whole"])
        spans.append(told.select("key", (F.col("pos") - F.col("back")).alias("lo"), (F.col("pos") - F.col("back") + F.length("bytes")).alias("hi")))
        records = alike.select("fp", "rep.*", "first", "last")
    every = spans[0]
    for more in spans[1:]:
        every = every.union(more.select("key", F.col("lo").cast("int"), F.col("hi").cast("int")))
    merged = staging.put(every.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "spans")
    staging.drop(*[n for n in staging.made if n not in ("texts", "spans")])
    return merged


def _with_spans(docs: DataFrame, group: int) -> DataFrame:
    """``packed, spans, rest`` for each row of ``docs``; ``rest`` holds its columns other than text."""
    staging = Staging(docs.sparkSession, "suffix-dedup")
    rows = docs.select(F.monotonically_increasing_id().alias("key"), "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest"))
    # written once, so that a row keeps its key whatever is computed again
    texts = staging.put(rows.mapInArrow(pack, StructType([rows.schema["key"], StructField("packed", BinaryType()), rows.schema["rest"]])), "texts")
    return texts.join(repeated_strings(texts, staging, group), "key", "left").select("packed", "spans", "rest")


@tidy
def suffix_dedup(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row of ``docs`` (doc_id, text)."""
    joined = _with_spans(docs.select("doc_id", "text"), group).select("packed", "spans", F.col("rest.doc_id").cast("long").alias("doc_id"))
    return joined.mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


@tidy
def remove_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """The rows of ``docs`` with repeated strings cut from their texts, and n_chars, if there, set anew."""
    joined = _with_spans(docs, group)
    cut_rows = joined.mapInArrow(_texts, StructType([StructField("text", StringType()), joined.schema["rest"]]))
    out = cut_rows.select(*[F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns])
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
