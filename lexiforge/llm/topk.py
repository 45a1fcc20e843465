"""Exact top-k by inner product: term-at-a-time accumulation over blocks.

A term is a vector component. Query rows are sparse lists of (term, weight);
a block of candidates keeps for each term its postings, the candidates with a
value there. Each term of a block of queries scatters its weighted postings
into a dense array of scores; a partition by score leaves the best k of the
block, and the blocks' lists are merged by a bounded aggregate.

Every query block meets every candidate block once. Candidates, the larger side,
are dealt once; the blocks of queries are sent to each deal of them, by an
equi-join on its number, so a task holds one block of each kind. Values travel
in the narrowest integers that hold a block's.

Defined results for odd input: null vectors and vectors with a null or
non-finite component take no part; vectors of different lengths are compared
on their common components (missing ones count as 0); a row is never a
candidate of a query with the same vec_id; repeated rows are candidates, and
queries, once each (with the same ranks for equal queries); ties go to the
smaller vec_id; empty tables give none. Components beyond 64 bits count as the
nearest 64-bit number, and so do scores; all others are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import Staging, tidy

#: Rows of a block of candidates and of a block of queries.
CANDIDATES = 32_768
QUERIES = 4096
#: Queries whose dense scores are held at a time.
SCORED = 64


def quantised(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of every component, null where the vector takes no part."""
    usable = embedding.isNotNull() & F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.when(usable, F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


BLOCK = "ids binary, dims int, width int, values binary"


def _pack(ids: list, vectors: list) -> dict:
    dims = max(map(len, vectors), default=0)
    m = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        m[i, : len(v)] = v
    low, high = (int(m.min()), int(m.max())) if m.size else (0, 0)
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    m = m.astype(kind)
    return {"ids": [np.asarray(ids, np.int64).tobytes()], "dims": pa.array([dims], pa.int32()), "width": pa.array([m.itemsize], pa.int32()), "values": [m.tobytes()]}


def _candidate_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, values) rows -> one row for each CANDIDATES rows: their ids and one matrix."""
    ids, vectors = [], []
    for batch in batches:
        ids += batch.column(0).to_pylist()
        vectors += batch.column(1).to_pylist()
        while len(ids) >= CANDIDATES:
            yield pa.RecordBatch.from_pydict(_pack(ids[:CANDIDATES], vectors[:CANDIDATES]))
            ids, vectors = ids[CANDIDATES:], vectors[CANDIDATES:]
    if ids:
        yield pa.RecordBatch.from_pydict(_pack(ids, vectors))


def _query_block(group: pa.Table) -> pa.Table:
    rows = group.sort_by("vec_id")
    return pa.Table.from_pydict({"q_block": group.column("q_block")[:1], **_pack(rows.column("vec_id").to_pylist(), rows.column("v").to_pylist())})


def _matrix(ids: bytes, dims: int, width: int, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(values, f"<i{width}").reshape(len(own), dims)


def _narrow(q: np.ndarray, c: np.ndarray):
    """The narrowest integers that hold every score of the block, Python's own beyond 64 bits."""
    top = lambda m: int(max(abs(int(m.min())), abs(int(m.max())))) if m.size else 0
    most = top(q) * top(c) * max(1, min(q.shape[1], c.shape[1]))
    return np.int32 if most < 2**31 else np.int64 if most < 2**63 else object


def _long(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit numbers, the nearest where they are larger."""
    return np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64) if scores.dtype == object else scores


def accumulate(q: np.ndarray, c: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Dense scores of SCORED queries at a time against all candidates of the block."""
    kind = _narrow(q, c)
    terms = min(q.shape[1], c.shape[1])
    postings = []
    for t in range(terms):
        at = np.flatnonzero(c[:, t])
        postings.append((slice(None) if at.size == len(c) else at, c[at, t].astype(kind)))
    for lo in range(0, len(q), SCORED):
        part = q[lo : lo + SCORED].astype(kind)
        scores = np.zeros((len(part), len(c)), kind)
        for t in range(terms):
            at, weight = postings[t]
            who = np.flatnonzero(part[:, t])
            if not who.size or not weight.size:
                continue
            for r in who:  # one query's term scatters into its own row of scores
                if isinstance(at, slice):
                    scores[r] += part[r, t] * weight
                else:
                    scores[r, at] += part[r, t] * weight
        yield lo, _long(scores)


def _best(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, q = _matrix(*(row[f"q_{x}"] for x in ("ids", "dims", "width", "values")))
                c_ids, c = _matrix(*(row[f"c_{x}"] for x in ("ids", "dims", "width", "values")))
                order = np.argsort(c_ids, kind="stable")
                c_ids, c = c_ids[order], c[order]
                out_q, out_at, out_c, out_s = [], [], [], []
                for lo, scores in accumulate(q, c):
                    for i, s in enumerate(scores):
                        me = lo + i
                        own = slice(*np.searchsorted(c_ids, [q_ids[me], q_ids[me] + 1]))
                        n_own = own.stop - own.start
                        want = min(k, len(s) - n_own)
                        if want <= 0:
                            continue
                        if len(s) > want + n_own:
                            # partition selection: everything at or above the want-th score, own rows aside
                            floor = np.partition(s, len(s) - want - n_own)[len(s) - want - n_own]
                            near = np.flatnonzero(s >= floor)
                        else:
                            near = np.arange(len(s))
                        near = near[(near < own.start) | (near >= own.stop)]
                        near = near[np.lexsort((c_ids[near], ~s[near].astype(np.int64)))[:want]]
                        out_q.append(np.full(near.size, q_ids[me]))
                        out_at += [f"{row['q_block']}:{me}"] * near.size
                        out_c.append(c_ids[near])
                        out_s.append(s[near].astype(np.int64))
                if out_q:
                    yield pa.RecordBatch.from_pydict(
                        {"query_id": np.concatenate(out_q), "row": out_at, "vec_id": np.concatenate(out_c), "score": np.concatenate(out_s)}
                    )

    return run


@tidy
def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of every query among all rows (vec_id, embedding)."""
    staging = Staging(vectors.sparkSession, "topk")
    usable = (
        vectors.where(F.col("vec_id").isNotNull())
        .select("vec_id", quantised(F.col("embedding"), scale).alias("v"), is_query.alias("__q"))
        .where(F.col("v").isNotNull())
    )
    n, n_asked = usable.agg(F.count(F.lit(1)), F.count_if("__q")).first()
    q_blocks, deals = max(1, -(-n_asked // QUERIES)), max(1, -(-n // CANDIDATES))
    asked = usable.where("__q").select("vec_id", "v")
    dealt = asked.withColumn("q_block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(q_blocks)).cast("long"))
    queries = staging.put(dealt.groupBy("q_block").applyInArrow(_query_block, f"q_block long, {BLOCK}"), "queries")
    # blocks have numbers of their own, so that equal ones are dealt apart
    blocks = usable.select("vec_id", "v").mapInArrow(_candidate_blocks, BLOCK).withColumn("deal", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(deals)))
    parts = ("ids", "dims", "width", "values")
    sent = queries.select("q_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))).alias("deal"), *[F.col(x).alias(f"q_{x}") for x in parts])
    near = blocks.select("deal", *[F.col(x).alias(f"c_{x}") for x in parts]).join(sent, "deal").mapInArrow(_best(k), "query_id long, row string, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
