import re
from collections import Counter

from lexiforge.llm import quality_rules as R

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    base = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in R.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered), base


def test_measures(spark):
    texts = [None, "", " \n\t ", "a b c d", "a b c d e", "a b c d e " * 4, "x " * 30, "one two three four five six seven eight nine ten", "l 1\nl 1\n\n \nl 1\r", "a\x0bb\x0cc\xa0d e f", "#*$%&|<> # |", "日本 語\n日本 語\n" * 3]
    texts += [f"{'p q r s t u v '}{i} w{i} x{i} y{i} z{i} p q r s t u" for i in range(3)] + ["w" * 5000, " ".join(f"u{i}" for i in range(3000))]
    rows = [(i, t, 1, [1], "x") for i, t in enumerate(texts)]
    rows += rows[:2]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, __words array<int>, __text string")
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in R.quality_rules(df).collect())
    assert got == sorted((i, *brute(t)) for i, t, *_ in rows)
    assert R.quality_rules(df.where("false")).count() == 0
    kept = R.keep_documents(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in R.quality_rules(df).where("kept").collect())


def test_sample_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in R.quality_rules(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}


def test_clean_labelled_documents_are_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    marked = R.quality_rules(docs).join(labels, "doc_id").where("quality = 1 and n_words >= 10 and not base_failed")
    assert marked.where("not kept").count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = R.quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
