"""Conflict-constrained best-fit packing of documents into sequences.

Pieces are packed largest first into the tightest bin that has room and holds
neither a piece of the same source nor one of the same duplicate cluster. Bins
are kept by residual; each carries a bitmap of its sources and clusters, and
for each source and cluster the bins that hold it are counted by residual, so
the search for the next larger residual jumps over levels where every bin is in
conflict, however many bins a hot source fills.

Documents longer than a bin are cut into full bins and a rest; no word is
dropped. Only lengths and keys reach the packer, from a small table that is
written first, so texts are split once. It works in shards of about SHARD pieces
dealt by the hash of the row's number in that table, so a shard is bounded and
a hot source or a doc_id of very many rows is spread over all of them.

Defined results for odd input: texts without words (and null), and lengths that
are null or not positive, are not packed and come with a null bin and length 0;
a null source conflicts with nothing; rows without doc_id, and rows that share
one, are packed each by itself; repeated rows are duplicates of each other, so
they go to different bins; empty tables give none; other columns don't take
part. Which of equally good bins a piece takes, and the names of bins, follow
the order of the rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import Staging, tidy

#: Words in a bin.
CAPACITY = 2048
#: Pieces that one task packs, about.
SHARD = 20_000


def best_fit(length: list[int], source: list, cluster: list, capacity: int) -> list[int]:
    """The bin of each piece, for pieces given in packing order."""
    # only keys that occur twice can conflict; each gets a bit
    bits: dict[tuple, int] = {}
    for kind, values in (("s", source), ("c", cluster)):
        for value, n in Counter(v for v in values if v is not None).items():
            if n > 1:
                bits[kind, value] = len(bits)
    total = np.zeros(capacity + 1, np.int32)
    holding: dict[int, np.ndarray] = {}
    level: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]
    keys: list[tuple[int, ...]] = []
    out = []
    for size, s, c in zip(length, source, cluster, strict=True):
        own = tuple(b for b in (bits.get(("s", s)), bits.get(("c", c))) if b is not None)
        mask = sum(1 << b for b in set(own))
        room = total[size:] > 0
        for b in own:
            if b in holding:
                room = room & (total[size:] > holding[b][size:])
        found = None
        first = int(room.argmax()) if room.size else 0
        if room.size and room[first]:
            # successors in order of residual, until one has a compatible bin
            for r in (np.flatnonzero(room[first:]) + first + size).tolist():
                found = next(((r, m) for m in level[r] if not m & mask), None)
                if found:
                    break
        if found:
            r, m = found
            held = level[r][m]
            at = held.pop()
            if not held:
                del level[r][m]
            total[r] -= 1
            for b in keys[at]:
                holding[b][r] -= 1
        else:
            r, m, at = capacity, 0, len(keys)
            keys.append(())
        left, m = r - size, m | mask
        keys[at] = tuple(dict.fromkeys((*keys[at], *own)))
        level[left].setdefault(m, []).append(at)
        total[left] += 1
        for b in keys[at]:
            if b not in holding:
                holding[b] = np.zeros(capacity + 1, np.int32)
            holding[b][left] += 1
        out.append(at)
    return out


PACKED = "doc_id long, piece int, from_word long, length long, bin_id string, bin_words long"


def _pack_shard(capacity: int):
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        rows.sort(key=lambda r: (-r["length"], r["doc_id"] if r["doc_id"] is not None else -1, r["key"], r["piece"]))
        bins = best_fit([r["length"] for r in rows], [r["source"] for r in rows], [r["cluster"] for r in rows], capacity)
        words = Counter()
        for r, b in zip(rows, bins, strict=True):
            words[b] += r["length"]
        return pa.table(
            {
                "doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()),
                "piece": pa.array([r["piece"] for r in rows], pa.int32()),
                "from_word": pa.array([r["from_word"] for r in rows], pa.int64()),
                "length": pa.array([r["length"] for r in rows], pa.int64()),
                "bin_id": pa.array([f"{r['shard']}-{b}" for r, b in zip(rows, bins, strict=True)], pa.string()),
                "bin_words": pa.array([words[b] for b in bins], pa.int64()),
            }
        )

    return run


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def text_cluster(text: Column) -> Column:
    """Key of texts that are equal up to case and white space."""
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))))


@tidy
def best_fit_packing(items: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Bins for the rows of ``items`` (doc_id, length, source, cluster)."""
    staging = Staging(items.sparkSession, "packing")
    # written with its number, so that a row keeps it whatever is computed again
    lengths = items.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("length").cast("long").alias("length"), "source", "cluster")
    numbered = staging.put(lengths, "lengths")
    last = F.floor((F.col("length") - 1) / capacity).cast("int")
    shards = max(1, -(-numbered.where("length > 0").count() // shard))
    start = F.col("piece").cast("long") * capacity
    pieces = numbered.where("length > 0").select("key", "doc_id", "source", "cluster", "length", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    pieces = pieces.withColumns({"from_word": start, "length": F.least(F.lit(capacity).cast("long"), F.col("length") - start)})
    full = pieces.where(F.col("length") == capacity).select(
        "doc_id", "piece", "from_word", "length", F.concat_ws("-", F.lit("full"), "key", "piece").alias("bin_id"), F.lit(capacity).cast("long").alias("bin_words")
    )
    rest = pieces.where(F.col("length") < capacity).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    packed = rest.groupBy("shard").applyInArrow(_pack_shard(capacity), PACKED)
    none = F.lit(0).cast("long")
    empty = numbered.where("length <= 0 or length is null").select(
        "doc_id", F.lit(0).alias("piece"), none.alias("from_word"), none.alias("length"), F.lit(None).cast("string").alias("bin_id"), none.alias("bin_words")
    )
    return packed.unionByName(full).unionByName(empty)


@tidy
def pack_documents(docs: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Bins for whole documents (doc_id, text, source), with words as the length and equal texts as clusters."""
    return best_fit_packing(
        docs.select("doc_id", word_count(F.col("text")).alias("length"), "source", text_cluster(F.col("text")).alias("cluster")), capacity, shard
    )
