"""Each stage of the pipeline against a brute-force version, on its own input."""

import random

import corpus_pipeline
import pytest

from lexiforge.llm import quality_classifier, quality_rules, staging
from tests.llm import test_near, test_suffix
from tests.llm.test_rules import brute as measured

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "minhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    assert all(s.columns == stages[0].columns for s in stages[:5])


def test_classifier_stage(spark, stages):
    scores = quality_classifier.quality_scores(stages[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert ids(stages[1]) == ids(scores.where("kept"))
    assert 0 < len(ids(stages[1])) < len(ids(stages[0]))


def test_rules_stage(stages):
    want = sorted(r.doc_id for r in quality_rules.quality_rules(stages[1]).where("kept").collect())
    assert ids(stages[2]) == want
    texts = {r.doc_id: r.text for r in stages[1].collect()}
    assert all(not measured(texts[i])[-1] for i in want)


def test_near_stage(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert ids(stages[3]) == sorted(i for i, _, _, kept in test_near.brute(rows, 80) if kept)


def test_suffix_stage(stages):
    rows = [(r.doc_id, r.text) for r in stages[3].collect()]
    want = {i: n - gone for i, n, gone, _, _ in test_suffix.brute(rows)}
    for r in stages[4].collect():
        assert abs(len(r.text.encode()) - want[r.doc_id]) <= 8 and r.n_chars == len(r.text)


def test_packing_stage(stages):
    words = {r.doc_id: len([w for w in r.text.split(" ") if w]) for r in stages[4].collect()}
    packed = stages[5].collect()
    assert {r.doc_id for r in packed} == set(words)
    assert all(r.bin_words <= 2048 for r in packed)


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    key = lambda r: (r.doc_id, r.piece, r.length)
    assert sorted(map(key, got.collect())) == sorted(map(key, stages[5].collect()))


def test_odd_documents(spark, tmp_path):
    """Nulls in any column, repeated rows, clashing names, an empty table; nothing of a stage stays behind."""
    before, rng = set(_names(spark)), random.Random(3)
    plain = [" ".join(rng.choice("the of and plain words make some sense here today while others rest".split()) + rng.choice(["", "s", "ed", "ing"]) + str(rng.randint(0, 99)) * (rng.random() < 0.3) for _ in range(120)) for _ in range(12)]
    rows = [(i, t, "en", "s1", 1) for i, t in enumerate(plain)] + [(3, plain[3], "en", "s1", 1), (4, plain[5], None, None, None), (None, plain[7], "en", "s2", 1), (50, None, None, None, None), (None, None, None, None, None), (51, "", "en", "s", 0)]
    for name, some in (("all", rows), ("none", [])):
        folder = tmp_path / name
        docs = spark.createDataFrame([(*r, "x", 0) for r in some], "doc_id long, text string, lang string, source string, n_chars int, key string, kept int")
        docs.write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([(1, 1, 0), (None, None, 1), (3, 0, None)] if some else [], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        out = corpus_pipeline.run(spark, str(folder)).collect()
        assert bool(out) == bool(some)
        kept = {r.doc_id for r in out}
        assert kept <= {r[0] for r in some} and (not some or ({0, 1, 2, 3, None} <= kept and not {50, 51} & kept))
    assert [n for n in set(_names(spark)) - before if not n.startswith("pipeline-")] == []


def test_failed_operators_leave_nothing(spark):
    before = set(_names(spark))

    @staging.tidy
    def operator():
        s = staging.Staging(spark, "broken")
        s.put(spark.range(3), "table")
        raise ValueError("on purpose")

    with pytest.raises(ValueError, match="on purpose"):
        operator()
    assert set(_names(spark)) == before and staging._scopes == []


def _names(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(staging._home(spark))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
