"""Quality classifier from weak labels.

1. Overlapping labellers look at every document: shares of symbols, capitals,
   repeats and so on vote fit, unfit or abstain, and lexicons count hits (none,
   one, more). One lexicon is known beforehand; two others, disjoint from it and
   from each other, are found from a bounded sample of labelled rows, if there are
   any: word beginnings that cover the hostile ones and hardly occur elsewhere.
2. The votes are counted by pattern (of which there is a fixed number, whatever
   the corpus). Expectation-maximisation on these counts estimates how often each
   labeller gives each vote in each class, and so the posterior of each pattern.
   Votes are independent given the class, so each kind of fault is a class of its
   own: noise, shouting and repetition share no labeller. For the tone the classes
   of a third of the labelled rows, which no lexicon was made from, are known; they
   weigh as much as the corpus. Nothing bounds the
   rates; without labelled rows the tone keeps the rates it starts from, as one
   lexicon alone can't tell its own accuracy.
3. The posteriors label a bounded sample, SAMPLE rows with the smallest hashes
   (the documented bound of the fit), which trains a hashed linear
   scorer per task.
4. The scorer judges every document from its whole text.

Texts are read once: the pass that votes also writes the ids of each document's
hashed features, from which the scorer is fitted and every row is scored.

Defined results for odd input: null, empty and wordless texts have no evidence
against them and are kept; repeated rows get equal rows, and each row, with or
without doc_id, is judged by its own text; an empty table gives none; other
columns don't take part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from .shingles import _powers, mix
from .staging import Staging, tidy

#: Rows that the scorer is fitted on, at most.
SAMPLE = 8000
#: Labelled documents from which word beginnings and rates of the tone are taken, at most.
LABELLED = 6000
BITS = 18
#: Insults that mark a hostile tone.
INSULTS = frozenset(
    "clown cretin disgusting dumb fool idiot idiotic idiots imbecile jerk loser losers moron moronic morons "
    "pathetic pig scum scumbag stupid trash ugly vermin worthless".split()
)
SYMBOLS = "#*$%&|<>@^~=_"
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»…–—“”‘’¡¿"



STATS = ("symbols", "odd_ends", "capitals", "adjacent", "shouting", "bare_marks", "variety", "exclaims", "pairs")
#: Up to the first share a labeller votes fit, from the second on unfit. Variety and pairs count the other way round.
LIMITS = {
    "symbols": (0.01, 0.05),
    "odd_ends": (0.02, 0.2),
    "capitals": (0.2, 0.5),
    "adjacent": (0.05, 0.2),
    "shouting": (0.02, 0.2),
    "bare_marks": (0.05, 0.2),
    "variety": (3.0, 1.5),
    "exclaims": (0.1, 0.5),
    "pairs": (0.6, 0.25),
}
#: Words below which only symbols and odd ends are judged, and below which variety isn't.
FEW, SOME = 8, 64
TONE = ("insult", "learnt_a", "learnt_b")
#: The kinds of fault and the shares that show them; three each, as fewer can't tell a rate.
KINDS = {"noise": ("symbols", "odd_ends", "bare_marks"), "shouting": ("capitals", "shouting", "exclaims"), "repetition": ("adjacent", "variety", "pairs")}
PREFIXES = (3, 4, 5, 6, 7, 8, 9, 10)
#: Share of the hostile texts that a learnt beginning covers at least, and its share of hostile texts among those that have it.
LEAST, PURITY = 0.01, 0.9

#: Texts read together.
TOGETHER = 128
LETTER = np.random.default_rng(0xC1A55).integers(1, 2**63, 256, dtype=np.uint64)
#: What a word can be; a word's kinds are one small number.
ODD, UPPER, LOUD, BARE, INSULT, LEARNT_A, LEARNT_B = (1 << i for i in range(7))
Lexicons = tuple[frozenset[str], frozenset[str]]
NONE: Lexicons = (frozenset(), frozenset())


class Kinds:
    """What words can be, as one small number each."""

    def __init__(self, learnt: Lexicons):
        self.lexicons = [(x, kind) for x, kind in zip(learnt, (LEARNT_A, LEARNT_B), strict=True) if x]
        shortest = min(PREFIXES)
        self.gate = frozenset(p[:shortest] for x, _ in self.lexicons for p in x)
        self.shortest = shortest

    def of(self, word: str, bare: str) -> int:
        """``bare`` is the word in lower case without the signs at its ends."""
        kinds = (
            (ODD if not word[-1].isalnum() and word[-1] not in ".,;:!?)]}»”’\"'…" else 0)
            | (UPPER if word.isupper() else 0)
            | (LOUD if word.endswith("!!") else 0)
            | (0 if bare else BARE)
            | (INSULT if bare in INSULTS else 0)
        )
        if bare[: self.shortest] in self.gate:
            for lexicon, kind in self.lexicons:
                if any(bare[:k] in lexicon for k in PREFIXES):
                    kinds |= kind
        return kinds


def stats(text: str, words: list[str], distinct: int, by: dict[int, int]) -> list[float]:
    """The shares that the labellers look at, in the order of STATS; -1 where the text is too short."""
    n = len(words)
    share = lambda kind: sum(c for k, c in by.items() if k & kind) / n
    few = n < FEW
    return [
        sum(map(text.count, SYMBOLS)) / len(text),
        share(ODD),
        -1 if few else share(UPPER),
        -1 if few else sum(map(eq, words, words[1:])) / n,
        -1 if few else share(LOUD),
        -1 if few else share(BARE),
        # distinct words against the square root of all: long texts repeat more words
        -1 if n < SOME else distinct / n**0.5,
        -1 if few else text.count("!") / n,
        -1 if few else len(set(zip(words, words[1:], strict=False))) / (n - 1),
    ]


#: A labeller has no opinion; it finds a text fit, or without hits; unfit, or with one hit; with more.
ABSTAIN, FIT, UNFIT, MORE = "-012"


def vote(name: str, x: float) -> str:
    good, bad = LIMITS[name]
    if x < 0:
        return ABSTAIN
    if good > bad:
        x, good, bad = -x, -good, -bad
    return FIT if x <= good else UNFIT if x >= bad else ABSTAIN


def hits(by: dict[int, int], learnt: Lexicons) -> str:
    """Votes of the lexicons."""
    n = [sum(c for k, c in by.items() if k & kind) for kind in (INSULT, LEARNT_A, LEARNT_B)]
    there = (True, *map(bool, learnt))
    return "".join((FIT, UNFIT, MORE)[min(x, 2)] if t else ABSTAIN for x, t in zip(n, there, strict=True))


def beginnings(text: str | None) -> set[str]:
    return {w[:k] for w in {w.strip(EDGE).lower() for w in (text or "").split()} for k in PREFIXES if len(w) >= k}


def known(beginning: str) -> bool:
    """Whether the lexicon known beforehand says the same."""
    return any(beginning.startswith(w) or w.startswith(beginning) for w in INSULTS)


def cover(where: dict[str, set], hostile: int, others: dict[str, int], least: float = LEAST, times: int = 2) -> Lexicons:
    """Word beginnings, picked greedily, that cover each hostile text ``times`` times; every other one goes to either lexicon."""
    need = max(3, least * hostile)
    left: Counter = Counter({i: times for at in where.values() for i in at})
    where, out = dict(where), []
    while where:
        best = max(where, key=lambda p: (sum(left[i] > 0 for i in where[p]), -others.get(p, 0), len(p), p))
        new = [i for i in where[best] if left[i] > 0]
        if len(new) < need:
            break
        out.append(best)
        left.subtract(where[best])
        where = {p: at for p, at in where.items() if not (p.startswith(best) or best.startswith(p))}
    return frozenset(out[::2]), frozenset(out[1::2])


def label_model(votes: np.ndarray, weight: np.ndarray, rate: np.ndarray, prior: np.ndarray, known: np.ndarray | None = None, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """(posterior[pattern, class], rate[class, labeller, vote]) by expectation-maximisation.

    ``votes`` holds a pattern a row, -1 for no opinion, which says nothing;
    ``weight`` how many documents have it; ``rate`` and ``prior`` where to start;
    ``known`` how many labelled documents of each class have it. Half a document
    is added to each count, so that no rate is 0.
    """
    one = np.stack([votes == v for v in range(rate.shape[2])], axis=2).astype(np.float64)
    share = 0.0 if known is None or not known.sum() else weight.sum() / known.sum() * known
    posterior = np.zeros((len(votes), len(prior)))
    for _ in range(rounds):
        score = np.log(prior) + np.einsum("pkv,ckv->pc", one, np.log(rate))
        score = np.exp(score - score.max(axis=1, keepdims=True)) if len(votes) else score
        posterior = score / score.sum(axis=1, keepdims=True)
        mass = posterior * weight[:, None] + share
        counts = np.einsum("pc,pkv->ckv", mass, one) + 0.5
        new, prior = counts / counts.sum(axis=2, keepdims=True), mass.sum(axis=0) + 0.5
        prior, moved, rate = prior / prior.sum(), np.abs(new - rate).max(), new
        if moved < 1e-9:
            break
    return posterior, rate


def quality_posterior(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The posterior of any fault; a class for fit documents and one for each kind of fault."""
    rate = np.full((1 + len(KINDS), len(STATS), 2), 0.01)
    for c, shown in enumerate(KINDS.values(), 1):
        rate[c, [STATS.index(x) for x in shown], 1] = 0.5
    rate[:, :, 0] = 1 - rate[:, :, 1]
    return 1 - label_model(votes, weight, rate, np.array([0.7, 0.1, 0.1, 0.1]))[0][:, 0]


def tone_posterior(votes: np.ndarray, weight: np.ndarray, labelled: np.ndarray) -> np.ndarray:
    """The posterior of a hostile tone."""
    rate = np.array([[[0.98, 0.015, 0.005]] * len(TONE), [[0.4, 0.2, 0.4]] * len(TONE)])
    rounds = 200 if labelled.sum() else 1
    return label_model(votes, weight, rate, np.array([0.9, 0.1]), labelled, rounds)[0][:, 1]


# -- the hashed linear scorer ----------------------------------------------------


def _step(kind: str, value: str) -> int:
    """Id of a step of a share, in the upper half."""
    return (1 << (BITS - 1)) + (zlib.crc32(f"{kind}:{value}".encode()) >> (33 - BITS))


def word_ids(bares: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word, id) of words and their beginnings of 3 to 12 bytes, in the lower half."""
    raw = "\0".join([*bares, ""]).encode("utf-8", "replace")
    buf = np.frombuffer(raw, np.uint8)
    stop = np.flatnonzero(buf == 0)
    start = np.concatenate([[0], stop[:-1] + 1])
    size = stop - start
    up, down = _powers(len(buf) + 1)
    who, ids = [], []
    with np.errstate(over="ignore"):
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(LETTER[buf] * up[: len(buf)])])
        for k in (*range(3, 13), 0):
            own = np.flatnonzero(size >= k)
            at = start[own]
            end = at + k if k else stop[own]
            ids.append(mix((run[end] - run[at]) * down[at] + np.uint64(k)) >> np.uint64(65 - BITS))
            who.append(own)
    return np.concatenate(who), np.concatenate(ids).astype(np.int64)


class Reader:
    """Votes and hashed features of texts: words and word beginnings for the tone, steps of the shares for the quality."""

    def __init__(self, learnt: Lexicons = NONE):
        self.learnt, self.kinds = learnt, Kinds(learnt)

    def __call__(self, texts: list[str | None]) -> list[tuple[str, np.ndarray]]:
        """For each text the pattern of votes, and the distinct ids in ascending order."""
        patterns, bares, own, steps = [], [], [], []
        for i, text in enumerate(texts):
            text = (text or "").replace("\0", " ")
            words = text.split()
            if not words:
                patterns.append(ABSTAIN * (len(STATS) + len(TONE)))
                own.append(0)
                continue
            counts, by = Counter(words), {}
            for w, c in counts.items():
                bare = w.strip(EDGE).lower()
                bares.append(bare)
                kinds = self.kinds.of(w, bare)
                by[kinds] = by.get(kinds, 0) + c
            own.append(len(counts))
            pattern = []
            for name, x in zip(STATS, stats(text, words, len(counts), by), strict=True):
                pattern.append(vote(name, x))
                good, bad = LIMITS[name]
                steps.append((i << BITS) + _step(name, "none" if x < 0 else str(min(5, max(-1, int(4 * (x - good) / (bad - good)))))))
            patterns.append("".join(pattern) + hits(by, self.learnt))
        who, ids = word_ids(bares)
        text_of = np.repeat(np.arange(len(texts)), own)
        every = np.unique(np.concatenate([(text_of[who] << BITS) + ids, np.array(steps, np.int64)]))
        edge = np.searchsorted(every, np.arange(len(texts) + 1) << BITS)
        every &= (1 << BITS) - 1
        return [(p, every[lo:hi]) for p, lo, hi in zip(patterns, edge[:-1].tolist(), edge[1:].tolist(), strict=True)]


def votes(text: str | None, learnt: Lexicons = NONE) -> str:
    return Reader(learnt)([text])[0][0]


def packed(ids: np.ndarray) -> bytes:
    """Ascending ids as steps, which compress well."""
    return np.diff(ids, prepend=0).astype("<u4").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<u4"), dtype=np.int64)


def train(rows: list[np.ndarray], target: np.ndarray, family: slice, rounds: int = 300, screen: float = 5.0, most: int = 4096) -> np.ndarray:
    """Logistic regression on the features that tell the classes apart; the last weight is the intercept."""
    out = np.zeros((1 << BITS) + 1)
    if not rows:
        return out
    n1, n0 = target.sum() + 1e-9, (1 - target).sum() + 1e-9
    size = 1 << BITS
    p1, p0 = np.zeros(size), np.zeros(size)
    for own, y in zip(rows, target.tolist(), strict=True):  # a row's ids are distinct
        p1[own] += y / n1
        p0[own] += (1 - y) / n0
    p = (p1 * n1 + p0 * n0) / (n1 + n0)
    z = np.abs(p1 - p0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0) + 1e-12)
    z[p * (n1 + n0) < 4] = 0
    z[: family.start], z[family.stop :] = 0, 0
    keep = np.argsort(-z, kind="stable")[:most]
    keep = keep[z[keep] >= screen]
    slot = np.full(size, -1, np.int32)
    slot[keep] = np.arange(len(keep))
    kept = [k[k >= 0] for k in (slot[own] for own in rows)]
    who = np.repeat(np.arange(len(rows), dtype=np.int32), [len(k) for k in kept])
    ids = np.concatenate(kept)
    w, b = np.zeros(len(keep)), float(np.log(n1 / n0))
    seen, seen_b = np.full(len(keep), 1e-8), 1e-8
    for _ in range(rounds):
        score = np.bincount(who, w[ids], len(rows)) + b
        off = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - target
        slope, slope_b = np.bincount(ids, off[who], len(keep)) + 0.5 * w, off.sum()
        seen += slope**2
        seen_b += slope_b**2
        w -= 0.5 * slope / np.sqrt(seen)
        b -= 0.5 * slope_b / np.sqrt(seen_b)
    out[keep] = w
    out[-1] = b
    return out


def _read(learnt: Lexicons):
    """(text, rest), or (rest) that holds the text -> (pattern, ids, rest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(learnt)
        for batch in batches:
            for lo in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(lo, TOGETHER)
                rest = part.column(part.num_columns - 1)
                found = read((part.column(0) if part.num_columns > 1 else rest.field("text")).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in found], pa.string()), pa.array([packed(i) for _, i in found], pa.binary()), rest], names=["pattern", "ids", "rest"]
                )

    return run


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found = sorted(b for b in beginnings(text) if not known(b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_id] * len(found), pa.int64()), pa.array([toxic] * len(found), pa.int64()), pa.array(found, pa.string())], names=["doc_id", "toxic", "beginning"]
            )


def _fit(posterior: dict[str, tuple[float, float]]):
    """All sampled rows, in one task (their number is bounded) -> the weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for pattern, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows.append((ids, posterior.get(pattern, (0.0, 0.0))))
        rows.sort()
        ids = [unpacked(r[0]) for r in rows]
        half = 1 << (BITS - 1)
        family = (slice(half, 2 * half), slice(0, half))
        weights = [train(ids, np.array([r[1][k] for r in rows]), family[k]) for k in (0, 1)]
        yield pa.RecordBatch.from_pydict({"weights": pa.array([np.stack(weights).tobytes()], pa.binary())})

    return run


def _score(held):
    """The two scores of a row as a function of its packed ids."""
    @F.pandas_udf("unfit double, hostile double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights = np.frombuffer(held.value).reshape(2, -1)
        for ids in batches:
            z = np.zeros((len(ids), 2))
            for i, raw in enumerate(ids):
                z[i] = weights[:, unpacked(raw)].sum(axis=1) + weights[:, -1]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pd.DataFrame({"unfit": p[:, 0], "hostile": p[:, 1]})

    return score


def _some(df: DataFrame, rows: int, total: int, salt: int) -> DataFrame:
    """The ``rows`` rows with the smallest hashes; first a share that holds about as many and a few more."""
    order = F.xxhash64(F.lit(salt), *df.columns)
    share = min(1.0, (rows + 6 * rows**0.5) / max(1, total))
    near = df.where(order <= F.lit(min(2**63 - 1, int(-(2**63) + share * 2**64))))
    return near.orderBy(order, *df.columns).limit(rows)


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, toxic`` of the bounded sample of labelled documents, a row for each doc_id."""
    rows = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic"))
    some = _some(rows, LABELLED, rows.count(), 5).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(some, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def learn(sample: DataFrame) -> Lexicons:
    """The lexicons of word beginnings; what reaches the driver is bounded by LABELLED rows."""
    hostile = sample.where("toxic = 1").count()
    found = sample.select("doc_id", "text", "toxic").mapInArrow(_beginnings, "doc_id long, toxic long, beginning string")
    by = found.groupBy("beginning").agg(F.sum("toxic").alias("n"), F.count(F.lit(1)).alias("all"), F.collect_list(F.when(F.col("toxic") == 1, F.col("doc_id"))).alias("at"))
    usable = by.where((F.col("n") >= max(3, LEAST * hostile)) & (F.col("n") >= PURITY * F.col("all"))).collect()
    return cover({r["beginning"]: set(r["at"]) for r in usable}, hostile, {r["beginning"]: r["all"] - r["n"] for r in usable})


def _judged(docs: DataFrame, labels: DataFrame | None, rest: Column, sample: int) -> DataFrame:
    """``unfit, hostile, kept, rest`` for each row of ``docs``."""
    spark = docs.sparkSession
    staging = Staging(spark, "quality")
    learnt, known_tone = NONE, None
    if labels is not None:
        rows = staging.put(_labelled(docs, labels), "labelled")
        # found on two thirds and judged on the rest, as rates on the rows that a lexicon was made for would flatter it
        third = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(3)) == 0
        learnt = learn(rows.where(~third))
        told = rows.where(third).select("text", F.struct("toxic").alias("rest")).mapInArrow(_read(learnt), "pattern string, ids binary, rest struct<toxic:bigint>")
        known_tone = {r["tone"]: (r["n"] - r["toxic"], r["toxic"]) for r in told.groupBy(F.right("pattern", F.lit(len(TONE))).alias("tone")).agg(F.count(F.lit(1)).alias("n"), F.sum("rest.toxic").alias("toxic")).collect()}
        staging.drop("labelled")
    source = docs.select("text", rest.alias("rest"))
    if "text" in source.schema["rest"].dataType.names:  # a text travels once
        source = source.select("rest")
    schema = StructType([StructField("pattern", StringType()), StructField("ids", BinaryType()), source.schema["rest"]])
    read = staging.put(source.mapInArrow(_read(learnt), schema), "read")
    counted = read.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = np.array([["-012".index(c) - 1 for c in r["pattern"]] for r in counted], np.int64).reshape(len(counted), len(STATS) + len(TONE))
    weight = np.array([r["n"] for r in counted], np.float64)
    unfit = quality_posterior(patterns[:, : len(STATS)], weight)
    # patterns of the tone, with the labelled rows that have them
    tones = sorted({r["pattern"][len(STATS) :] for r in counted} | set(known_tone or ()))
    tone_weight = np.array([sum(r["n"] for r in counted if r["pattern"].endswith(t)) for t in tones], np.float64)
    tone_known = np.array([(known_tone or {}).get(t, (0, 0)) for t in tones], np.float64).reshape(len(tones), 2)
    tone_votes = np.array([["-012".index(c) - 1 for c in t] for t in tones], np.int64).reshape(len(tones), len(TONE))
    hostile = dict(zip(tones, tone_posterior(tone_votes, tone_weight, tone_known).tolist(), strict=True))
    posterior = {r["pattern"]: (float(x), hostile[r["pattern"][len(STATS) :]]) for r, x in zip(counted, unfit, strict=True)}
    some = _some(read.select(F.col("rest.doc_id").alias("doc_id"), "pattern", "ids"), sample, int(weight.sum()), 7)
    fitted = some.select("pattern", "ids").repartition(1).mapInArrow(_fit(posterior), "weights binary").collect()
    weights = fitted[0]["weights"] if fitted else np.zeros((2, (1 << BITS) + 1)).tobytes()
    held = spark.sparkContext.broadcast(weights)  # 4 MB, fixed by BITS
    scored = read.select("rest", _score(held)("ids").alias("p")).select("p.*", "rest")
    return scored.withColumn("kept", (F.col("unfit") < 0.5) & (F.col("hostile") < 0.5))


@tidy
def quality_scores(docs: DataFrame, labels: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, unfit, hostile, kept`` for each row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic), if given, serve for the lexicons of word beginnings and the rates of the tone, and nothing else.
    """
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"))
    return _judged(docs.select("doc_id", "text"), labels, own, sample).select("rest.doc_id", "unfit", "hostile", "kept")


@tidy
def keep_documents(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns unchanged."""
    kept = _judged(docs, labels, F.struct(*[F.col(f"`{c}`") for c in docs.columns]), SAMPLE).where("kept")
    return kept.select(*[F.col("rest").getField(c).alias(c) for c in docs.columns])
