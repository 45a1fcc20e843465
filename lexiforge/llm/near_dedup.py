"""MinHash near-duplicates with sequential Bayesian verification.

1. Each text becomes its set of distinct word shingles, a digest of the set and
   a MinHash signature. Texts with equal sets are one class, which its smallest
   doc_id stands for; only classes are compared.
2. Banded signatures deal the classes into buckets. In each bucket every class
   is compared with the bucket's smallest class (its hub), so a bucket of m
   classes gives m pairs and not m * m.
3. A pair's signatures are compared batch by batch; after each batch the
   posterior of the similarity, given the matches so far, decides whether the
   pair can still reach the threshold; below MISS it is dropped. Survivors are
   verified exactly on their full shingle sets.
4. A true link need not touch a hub. In a bucket whose classes are not all one
   component of verified links, every class outside the bucket's largest
   component is compared with the bucket's other components, in bounded blocks
   of rows; a pair that shares several buckets is compared in the first of them.
   First the signatures are tested, which tells the classes that have a
   promising partner; then these classes' texts are dealt the same way, and a
   block emits only a spanning set of its verified links. Classes that share no
   bucket never meet. No partner is capped or dropped.
5. Components come from distributed star contractions.

With 40 bands of 5 a pair shares no bucket with probability 7e-11 at similarity
0.85 and 1e-7 at 0.8; the sequential test adds 1e-9 at each of its 5 looks at most.

Defined results for odd input: null, empty and wordless texts have no shingles,
link with nothing and are kept; with fewer than five words the whole sequence
is the one shingle; rows that repeat a doc_id get a row each, judged each by its
own text (component_id is the smallest doc_id of the texts that this text
reaches); rows without doc_id take no part and are kept; empty tables give none;
other columns don't take part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .components import components
from .packed import pack, unpack
from .shingles import mix, shingle_sets
from .staging import Staging, tidy

BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
#: Signature positions compared between two looks at the posterior.
LOOK = 40
#: Posterior probability of reaching the threshold below which a pair is dropped.
MISS = 1e-9
#: Classes on either side of a block of step 4.
BLOCK = 256
#: Texts whose sketches are made together.
GROUP = 512

_rng = np.random.default_rng(20)
_A = _rng.integers(1, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minimum of HASHES multiply-add permutations; in runs, so that it stays in cache."""
    low = np.full(HASHES, 2**32 - 1, np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    for lo in range(0, len(x), 4096):
        np.minimum(low, (x[None, lo : lo + 4096] * _A[:, None] + _B[:, None]).min(axis=1), out=low)
    return low


@lru_cache(maxsize=8)
def least_matches(percent: int) -> tuple[int, ...]:
    """For each look, the fewest matches with which the similarity can still be ``percent`` or more.

    Under a uniform prior the posterior after m of n matches is Beta(m+1, n-m+1),
    and P(similarity >= t) = P(Binomial(n+1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(LOOK, HASHES + 1, LOOK):
        total, m = 0.0, 0
        while True:
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= MISS:
                break
            m += 1
        out.append(m)
    return tuple(out)


def may_reach(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The sequential test for rows of signatures; pairs leave as soon as a look drops them."""
    live = np.arange(len(a))
    matches = np.zeros(len(a), np.int32)
    for k, least in enumerate(least_matches(percent)):
        at = slice(k * LOOK, (k + 1) * LOOK)
        matches[live] += (a[live, at] == b[live, at]).sum(axis=1, dtype=np.int32)
        live = live[matches[live] >= least]
        if not live.size:
            break
    out = np.zeros(len(a), bool)
    out[live] = True
    return out


def linked(common: int, n_a: int, n_b: int, percent: int) -> bool:
    return 100 * common >= percent * (n_a + n_b - common)


SKETCH = "doc_id long, n_shingles long, fp binary, sig binary"


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, GROUP):
            part = batch.slice(lo, GROUP)
            sets = shingle_sets(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "fp", "sig"],
            )


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose first column is a text -> the digest of its set and the other columns."""
    for batch in batches:
        for lo in range(0, batch.num_rows, GROUP):
            part = batch.slice(lo, GROUP)
            found = pa.array([_digest(s) for s in shingle_sets(part.column(0).to_pylist())], pa.binary())
            yield pa.RecordBatch.from_arrays([found, *part.columns[1:]], names=["digest", *part.schema.names[1:]])


def _matching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, fp, packed) -> (node, packed) where the text has the digest that is looked for."""
    for batch in batches:
        for lo in range(0, batch.num_rows, GROUP):
            part = batch.slice(lo, GROUP)
            sets = shingle_sets([unpack(p) for p in part.column(2).to_pylist()])
            same = [_digest(s) == fp for s, fp in zip(sets, part.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2)], names=["node", "packed"]).filter(pa.array(same, pa.bool_()))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), sigs.shape[:2]).copy()
        for r in range(ROWS):
            key = mix(key ^ sigs[:, :, r]) + np.uint64(r)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key.reshape(-1).view(np.int64)),
                pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(sigs))),
                pa.array(np.repeat(batch.column(0).to_numpy(), BANDS)),
            ],
            names=["key", "band", "node"],
        )


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _verify(percent: int):
    """Rows (a, a_sig, a_text, b, b_sig, b_text) -> verified links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index
            good = may_reach(_signatures(batch.column(at("a_sig"))), _signatures(batch.column(at("b_sig"))), percent)
            left = batch.filter(pa.array(good))
            a_ids, b_ids = left.column(at("a")).to_pylist(), left.column(at("b")).to_pylist()
            a_text, b_text = left.column(at("a_text")), left.column(at("b_text"))
            out, hub = [], (None, None)
            for i, (a, b) in enumerate(zip(a_ids, b_ids, strict=True)):
                if hub[0] != b:
                    hub = (b, shingle_sets([unpack(b_text[i].as_py())])[0])
                own = shingle_sets([unpack(a_text[i].as_py())])[0]
                if linked(len(np.intersect1d(own, hub[1], assume_unique=True)), len(own), len(hub[1]), percent):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    return run


class _Sides:
    """The outliers and members of a block, and the pairs of them that may reach the threshold."""

    def __init__(self, group: pa.Table, percent: int):
        column = lambda name: group.column(name).to_numpy(zero_copy_only=False)
        self.node, self.component, self.n = column("node"), column("component"), column("n")
        self.sig, self.percent, self.band = _signatures(group.column("sig")), percent, int(column("band")[0])
        outlier = column("outlier").astype(bool)
        self.outliers, self.members = np.flatnonzero(outlier), np.flatnonzero(~outlier)
        # two outliers meet twice; the one with the smaller node takes the pair
        self.lone = column("lone").astype(bool)[self.members]

    def partners(self, o: int) -> np.ndarray:
        m = self.members
        low, high = np.minimum(self.n[m], self.n[o]), np.maximum(self.n[m], self.n[o])
        fits = (self.component[m] != self.component[o]) & (100 * low >= self.percent * high) & (~self.lone | (self.node[m] > self.node[o]))
        fits = m[fits]
        if fits.size:
            fits = fits[may_reach(np.broadcast_to(self.sig[o], (len(fits), HASHES)), self.sig[fits], self.percent)]
        if fits.size and self.band:  # pairs that share an earlier band are compared there
            before = slice(0, self.band * ROWS)
            shared = (self.sig[fits, before] == self.sig[o, before]).reshape(len(fits), -1, ROWS).all(axis=2).any(axis=1)
            fits = fits[~shared]
        return fits


DEALT = "key long, band int, o int, m int, node long, component long, n long, lone boolean, outlier boolean"


def _promising(percent: int):
    """The rows of a block that have a partner."""

    def run(group: pa.Table) -> pa.Table:
        sides, keep = _Sides(group, percent), np.zeros(group.num_rows, bool)
        for o in sides.outliers.tolist():
            found = sides.partners(o)
            keep[found] = True
            keep[o] |= found.size > 0
        return group.select([c.split()[0] for c in DEALT.split(", ")]).filter(pa.array(keep))

    return run


def _compare(percent: int):
    """A block's promising rows with their texts -> a spanning set of the verified links."""

    def run(group: pa.Table) -> pa.Table:
        sides, parent, out = _Sides(group, percent), {}, []

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        sets = shingle_sets([unpack(p) for p in group.column("packed").to_pylist()])
        for o in sides.outliers.tolist():
            for m in sides.partners(o).tolist():
                x, y = root(int(sides.component[o])), root(int(sides.component[m]))
                if x == y:  # components that this block has joined already
                    continue
                common = len(np.intersect1d(sets[o], sets[m], assume_unique=True))
                if linked(common, len(sets[o]), len(sets[m]), percent):
                    parent[x] = y
                    out.append((int(sides.node[o]), int(sides.node[m])))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


def _remaining(member: DataFrame, links: DataFrame, classes: DataFrame, held: DataFrame, percent: int, staging: Staging) -> DataFrame:
    """Links (a, b) between components that share a bucket."""
    found = components(links, staging, "found")
    placed = member.join(found, "node", "left").select("key", "band", "node", F.coalesce("component", "node").alias("component"))
    placed = staging.put(placed, "placed")
    parts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    shape = (
        parts.groupBy("key")
        .agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("parts"), F.max("n").alias("most"))
        .where("parts > 1 and size > 2")
        .select(
            "key",
            "main",
            F.ceil(F.col("size") / BLOCK).cast("int").alias("m_blocks"),
            F.ceil((F.col("size") - F.col("most")) / BLOCK).cast("int").alias("o_blocks"),
        )
    )
    shape = staging.put(shape, "shape")
    rest = placed.join(shape, "key").withColumns(
        {
            "m": F.pmod(F.xxhash64("node"), F.col("m_blocks")).cast("int"),
            "o": F.pmod(F.xxhash64("node", F.lit(1)), F.col("o_blocks")).cast("int"),
            "lone": F.col("component") != F.col("main"),
        }
    )
    sigs = classes.select("node", "n", "sig")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = ["key", "band", "node", "component", "lone", "n", "sig"]
    rest = staging.put(rest.join(sigs, "node"), "rest")
    members = rest.select(*own, F.lit(False).alias("outlier"), every("o_blocks").alias("o"), "m")
    outliers = rest.where("lone").select(*own, F.lit(True).alias("outlier"), "o", every("m_blocks").alias("m"))
    promising = members.unionByName(outliers).groupBy("key", "o", "m").applyInArrow(_promising(percent), DEALT)
    promising = staging.put(promising, "promising")
    return promising.join(held.select("node", "sig", "packed"), "node").groupBy("key", "o", "m").applyInArrow(_compare(percent), "a long, b long")


def _classes(docs: DataFrame, percent: int, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """The staged sketch of every row, and ``fp, component, rep`` of each class: its component and that one's smallest doc_id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = staging.put(texts.mapInArrow(_sketch, SKETCH), "sketch")
    classes = sketch.where("n_shingles > 0 and doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n"))
    # written with its number, so that a class keeps it whatever is computed again
    classes = staging.put(classes.select(F.monotonically_increasing_id().alias("node"), "rep", "fp", "n", "sig"), "classes")
    bands = classes.select("node", "sig").mapInArrow(_bands, "key long, band int, node long")
    buckets = staging.put(bands.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1").select("key", "hub"), "buckets")
    member = staging.put(bands.join(buckets, "key"), "member")
    star = staging.put(member.where("node <> hub").select("node", "hub").distinct(), "star")
    staging.drop("buckets")

    # the texts of the classes that share a bucket with another
    involved = star.select("node").union(star.select("hub")).distinct()
    wanted = staging.put(involved.join(classes.select("node", "rep", "fp"), "node").select("node", F.col("rep").alias("doc_id"), "fp"), "wanted")
    # always by exchange: what is looked for grows with the corpus
    packed = texts.mapInArrow(pack, "doc_id long, packed binary")
    held = packed.join(wanted.hint("merge"), "doc_id").select("node", "fp", "packed").mapInArrow(_matching, "node long, packed binary").dropDuplicates(["node"])
    held = staging.put(held.join(classes.select("node", "sig"), "node"), "held")
    side = lambda x, n: held.select(F.col("node").alias(n), F.col("sig").alias(f"{x}_sig"), F.col("packed").alias(f"{x}_text"))
    pairs = star.select(F.col("node").alias("a"), F.col("hub").alias("b")).join(side("a", "a"), "a").join(side("b", "b"), "b")
    links = staging.put(pairs.mapInArrow(_verify(percent), "a long, b long"), "links")
    more = staging.put(_remaining(member.drop("hub"), links, classes, held, percent, staging), "more")
    final = components(links.union(more), staging, "final")
    placed = staging.put(classes.select("node", "fp", "rep").join(final, "node", "left").select("fp", F.coalesce("component", "node").alias("component"), "rep"), "classed")
    least = placed.groupBy("component").agg(F.min("rep").alias("least"))
    return sketch, staging.put(placed.join(least, "component").select("fp", "component", F.col("least").alias("rep")), "component")


@tidy
def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (doc_id, text)."""
    staging = Staging(docs.sparkSession, "near-dedup")
    sketch, classes = _classes(docs, percent, staging)
    result = sketch.select("doc_id", "n_shingles", "fp").join(classes.select("fp", "rep"), "fp", "left")
    part = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    result = staging.put(result.select("doc_id", "n_shingles", F.when(part, F.col("rep")).otherwise(F.col("doc_id")).alias("component_id")), "result")
    staging.drop(*[n for n in staging.made if n != "result"])
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


@tidy
def keep_documents(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each component, of those with its smallest doc_id; texts without shingles and rows without doc_id stay.

    Rows that share a doc_id are judged each by its own text; of those that share
    their shingles too, also none, one stays.
    """
    staging = Staging(docs.sparkSession, "near-dedup")
    sketch, classes = _classes(docs, percent, staging)
    rows = sketch.where("n_shingles > 0 and doc_id is not null").select("doc_id", "fp")
    # the row that stands for each component, by doc_id and the digest of its set
    stays = rows.join(classes.select("fp", "component"), "fp").groupBy("component").agg(F.min(F.struct("doc_id", "fp")).alias("s"))
    stays = staging.put(stays.select("s.doc_id", "s.fp"), "stays")
    verdict = sketch.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("n_shingles") == 0).alias("bare"))
    verdict = verdict.join(stays.select("doc_id", F.lit(True).alias("stays")).distinct(), "doc_id", "left").where("rows > 1 or (not bare and stays is null)")
    verdict = staging.put(verdict.select("doc_id", (F.col("rows") > 1).alias("again")), "verdict")
    staging.drop(*[n for n in staging.made if n not in ("stays", "verdict")])
    kept = docs.join(verdict, "doc_id", "left_anti")
    again = verdict.where("again").select("doc_id")
    if not again.isEmpty():
        some = docs.join(again, "doc_id", "left_semi").select("text", "doc_id", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        some = some.mapInArrow(_digested, StructType([StructField("digest", BinaryType()), *some.schema.fields[1:]]))
        none = F.lit(_digest(shingle_sets([""])[0]))
        stays = stays.withColumnRenamed("fp", "digest").union(again.select("doc_id", none))
        chosen = some.join(stays, ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id", "digest"])
        kept = kept.unionByName(chosen.select("row.*"))
    return kept.select(docs.columns)
