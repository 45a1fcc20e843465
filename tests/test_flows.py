"""Prompt-driven flows with backends that answer by rule."""

import json

from pyspark.sql import functions as F

from lexiforge.functions import model_json as J
from lexiforge.functions import taxonomy as X
from lexiforge.operators import flows, models, tagging


def test_tolerant_json(spark):
    answers = ['{"a": 1}', '```json\n{"a": 2}\n```', 'Sure: {"a": 3} done', "none", "", None, 'x {"a": {"b": 1}} y {"c": 2}', "[1, 2] tail"]
    assert [J.greedy(a) for a in answers] == [{"a": 1}, {"a": 2}, {"a": 3}, None, None, None, None, None]
    assert [J.balanced(a) for a in answers] == [{"a": 1}, {"a": 2}, {"a": 3}, None, None, None, {"a": {"b": 1}}, [1, 2]]
    df = spark.createDataFrame([(a,) for a in answers], "a string")
    assert [r[0] for r in df.select(J.greedy_text("a")).collect()] == ['{"a": 1}', '{"a": 2}', '{"a": 3}', None, None, None, None, None]
    assert json.loads(df.select(J.balanced_text("a")).collect()[6][0]) == {"a": {"b": 1}}


def batch_rule(prompt):
    if prompt.startswith("Summarise part"):
        return "" if "silent" in prompt else "point " * 30
    return json.dumps({"resource_type": "Guidance", "n": len(prompt)})


def test_batch_routes(spark):
    long = "=== PARENT CONTENT ===\n\n" + "\n\n".join("word " * 700 for _ in range(8))
    rows = [(1, "t", "u", "short text", "single_pass"), (2, "t", "u", long, "map_reduce"), (3, "silent", "u", long, "map_reduce")]
    df = spark.createDataFrame(rows, "resource_id long, title string, url string, text string, route string")
    out = {r.resource_id: r for r in flows.run_batch(df, lambda: models.RuleBackend(batch_rule)).collect()}
    assert {k: v.status for k, v in out.items()} == {1: "success", 2: "success", 3: "map_failed"}
    assert json.loads(out[2].answer)["resource_type"] == "Guidance"
    assert out[1].validated.resource_type == "Guidance" and out[1].validated.passed and out[3].validated is None


def test_batch_answers_are_validated(spark):
    answer = {
        "individual_characteristics": {"primary": [" disability ", "made up"], "secondary": ["Disability", "AGE", None]},
        "career_pathway": "no block",
        "organisational_culture": {"primary": "no list", "secondary": []},
        "resource_type": "legislation ",
        "resource_format": "Papyrus",
        "sector": "academia, Moon, industry",
    }
    rows = [(1, json.dumps(answer)), (2, json.dumps({"sector": ["Other", "x"]})), (3, None), (4, "{}")]
    df = spark.createDataFrame(rows, "id int, answer string")
    out = {r.id: r.v for r in df.select("id", tagging.validate_answer(F.col("answer")).alias("v")).collect()}
    tags = {t.dim: t for t in out[1].tags}
    assert set(tags) == set(X.MULTI)
    own = tags["individual_characteristics"]
    allowed = {x.lower(): x for x in X.BATCH_TAXONOMY["individual_characteristics"]}
    assert own.primary == [allowed["disability"]] and own.secondary == [allowed[x] for x in ("age",) if x in allowed]
    assert own.removed[0] == "made up" and tags["career_pathway"].removed == tags["organisational_culture"].primary == []
    assert (out[1].resource_type, out[1].resource_format, out[1].sector) == ("Legislation", "", ["Academia", "Industry"])
    assert not out[1].passed and out[1].issues[-1] == "sector: removed Moon" and out[2].issues == ["sector: removed x"]
    assert out[3].passed and out[4].passed and out[4].sector == []


def tag_rule(prompt):
    if prompt.startswith("Describe"):
        return None if "broken" in prompt else json.dumps({"core_topic": "c", "edi_themes": ["grant application"], "interventions_described": ["was piloted"]})
    if prompt.startswith("Which tags"):
        dim = prompt.split("dimension ")[1].split(" fit")[0]
        given = {
            "resource_type": [("guidance", "high"), ("Blog Post", "medium")],
            "resource_format": [("Document", "high")],
            "career_pathway": [("mentoring", "medium"), ("early_career", "low"), ("nonsense", "high"), ("odd", "high")],
            "research_funding_process": [("Advertising", "medium")],
            "adoption_readiness_level": [("Proof of Concept", "high")],
        }.get(dim)
        if dim == "organisational_culture":
            return "no json"
        return "Here: " + json.dumps({"proposed_tags": [{"tag": t, "confidence": c, "evidence": f"e {t}"} for t, c in given or []]})
    if prompt.startswith("The tag"):
        return json.dumps({"rescued_tag": "Leadership"}) if "nonsense" in prompt else json.dumps({"rescued_tag": None})
    return json.dumps({"justified": "early" not in prompt.lower()})


def chunks(spark):
    rows = [(1, 1, "[Section: A]", "text one"), (1, 2, "[Section: B]", "text two"), (2, 1, "[Section: C]", "broken")]
    return spark.createDataFrame(rows, "resource_id long, chunk_index int, part_label string, text string")


def test_chunk_tags(spark):
    tags, work = flows.tag_chunks(chunks(spark), lambda: models.RuleBackend(tag_rule))
    rows = tags.where("resource_id = 1 and chunk_index = 2").collect()
    got = {(r.dim, r.tag): (r.confidence, r.rescued) for r in rows}
    assert got == {
        ("resource_type", "Guidance"): ("high", False),
        ("resource_format", "Document"): ("high", False),
        ("career_pathway", "Mentoring"): ("medium", False),
        ("career_pathway", "Early Career"): ("medium", False),
        ("career_pathway", "Leadership"): ("low", True),
        ("research_funding_process", "Advertising"): ("medium", False),
        ("adoption_readiness_level", "Proof of Concept"): ("high", False),
    }
    done = {(r.resource_id, r.chunk_index): r for r in work.collect()}
    # one description, six dimensions and the format, two rescues
    assert done[1, 2].calls == done[1, 1].calls == 1 + 7 + 2
    assert done[1, 1].errors == ["career_pathway_rejected:odd", "organisational_culture_parse_failed"]
    assert "semantic_parse_failed" in done[2, 1].errors


def test_tagged_resources(spark):
    out = {r.resource_id: r for r in flows.tag_resources(chunks(spark), lambda: models.RuleBackend(tag_rule), verify=True).collect()}
    one = out[1]
    assert one.chunk_count == 2 and [t.tag for t in one.tags["resource_type"]] == ["Guidance"]
    assert {t.tag: t.chunk_count for t in one.tags["career_pathway"]} == {"Mentoring": 2, "Leadership": 2}
    # guidance is no intervention, whatever the model says of its adoption
    assert [t.tag for t in one.tags["adoption_readiness_level"]] == ["Not applicable"]
    assert [t.tag for t in one.tags["research_funding_process"]] == ["Advertising"]
    assert "research_funding_process" not in out[2].tags
    assert one.total_tags_assigned == sum(len(v) for v in one.tags.values()) and one.tags_rescued == 1


def summary_rule(prompt):
    if "broken" in prompt and prompt.startswith("Summarise"):
        return "no"
    if prompt.startswith("List numbers"):
        return json.dumps({"named_entities": ["X"]})
    if prompt.startswith("Summarise"):
        return json.dumps({"core_topic": "topic", "key_points": ["one (note: leak)", "", "two", "three", "four"] if "rich" in prompt else ["only"], "edi_relevance": "for various groups"})
    if prompt.startswith("Correct"):
        return json.dumps({"core_topic": "topic, checked"})
    if prompt.startswith("Write one"):
        return json.dumps({"key_points": ["p1", "p2"]})
    if prompt.startswith("Say whom"):
        return json.dumps({"edi_relevance": "for early-career women"})
    return json.dumps({"Outline": "o"}) if "rich" in prompt else "bad"


def test_summaries(spark):
    rows = [(1, 1, "[Section: S]", "rich text", "Guidance"), (1, 2, "[Sections: ## One | ## Two]", "thin text", None), (2, 1, "x", "broken text", None)]
    df = spark.createDataFrame(rows, "doc_id long, group_no int, part_label string, text string, resource_type string")
    out = flows.summarise_groups(df, lambda: models.RuleBackend(summary_rule))
    got = {(r.doc_id, r.group_no): r for r in out.collect()}
    a, b, c = got[1, 1], got[1, 2], got[2, 1]
    assert a.key_points == ["one", "two", "three"] and a.core_topic == "topic, checked" and a.was_corrected
    assert a.edi_relevance == "for early-career women" and a.template_sections == {"Outline": "o"} and a.calls == 5
    assert b.key_points == ["p1", "p2"] and b.calls == 6 and set(b.template_sections.values()) == {"Parse failed."}
    assert (c.error, c.core_topic, c.calls, c.template_sections) == ("parse_failed", "Could not parse summary", 2, None)
    stats = {r.doc_id: (r.total_groups, r.errors, r.total_calls) for r in flows.summary_stats(out).collect()}
    assert stats == {1: (2, 0, 11), 2: (1, 1, 2)}
    kinds = spark.createDataFrame([(1, "Guidance")], "doc_id long, resource_type string")
    whole = flows.document_summary(out, kinds, lambda: models.RuleBackend(lambda p: json.dumps({"Outline": "A. B. C. Not described in the document."}))).collect()
    assert [(r.doc_id, r.sections, r.error) for r in whole] == [(1, {"Outline": "A. B. C."}, None)]


def test_backends(spark):
    df = spark.createDataFrame([(1, "p"), (2, "q"), (3, None)], "id long, prompt string")
    got = {r.id: r.answer for r in models.ask(df, lambda: models.RecordedBackend({"p": "yes"})).collect()}
    assert got == {1: "yes", 2: None, 3: None}
    assert models.HttpBackend("http://127.0.0.1:9/none", "m", timeout=1).ask("p") is None


def test_prompts_are_asked_in_small_batches(spark, monkeypatch):
    from lexiforge.functions.batches import ROWS
    from lexiforge.operators import models

    class Counted:
        def mapInArrow(self, run, schema):
            self.run = run
            return self

        def select(self, *_):
            return self

        schema = spark.range(0).selectExpr("id", "string(id) as __prompt").schema

    import pyarrow as pa

    monkeypatch.setattr(models, "once", lambda df: df)
    rows = models.ask(Counted(), lambda: models.RuleBackend(lambda p: p + "!"))
    batch = pa.RecordBatch.from_pydict({"id": list(range(ROWS + 2)), "__prompt": [str(i) for i in range(ROWS + 2)]})
    out = list(rows.run(iter([batch])))
    assert [b.num_rows for b in out] == [ROWS, 2] and out[1].to_pydict() == {"id": [ROWS, ROWS + 1], "answer": [f"{ROWS}!", f"{ROWS + 1}!"]}
