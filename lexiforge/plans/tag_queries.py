"""Canonical tags, aggregation over chunks, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import taxonomy as X
from ..operators import evaluation as E
from ..operators import tagging as G
from ..sources.tables import table
from .registry import Registry

R = Registry()

_TAX = "(SELECT * FROM (VALUES " + X.values([(d, i, t, t.lower(), t.replace("-", " ").lower()) for d, ts in X.TAXONOMY.items() for i, t in enumerate(ts)]) + ") t(dim, pos, tag, tag_lower, tag_norm))"
_N = sum(map(len, X.TAXONOMY.values()))
_ORDER = list(X.TAXONOMY)
#: All (dimension, tag) pairs in order, so that an event's number picks one.
_PICK = "(SELECT row_number() OVER (ORDER BY d, pos) - 1 AS k, dim, tag FROM (SELECT *, list_position([" + ", ".join(f"'{d}'" for d in _ORDER) + f"], dim) AS d FROM {_TAX}))"

# proposals from events: the user is the resource, the number of the event picks chunk, tag and spelling
_PROPOSED = f"""
(SELECT user_id AS resource_id, event_id AS pos, CAST(event_id % 5 AS INTEGER) AS chunk_index, dim,
  CASE event_id % 4 WHEN 0 THEN upper(tag) WHEN 1 THEN ' ' || lower(replace(replace(tag, ' ', '_'), '-', ' ')) || ' ' WHEN 2 THEN tag ELSE CASE WHEN event_id % 24 = 3 THEN 'netwotking and collaboration' WHEN event_id % 24 = 7 THEN 'nonsense' ELSE tag END END AS tag,
  CASE WHEN value > 20 THEN 'high' WHEN value > 5 THEN 'medium' ELSE 'low' END AS confidence, event_type AS evidence, event_id % 17 = 0 AS rescued
 FROM events JOIN {_PICK} p ON p.k = (event_id * 31 + user_id) % {_N})"""


def _proposed(spark, sf_dir):
    from pyspark.sql import Row

    pairs = [(d, t) for d in X.TAXONOMY for t in X.TAXONOMY[d]]
    pick = spark.createDataFrame([Row(k=i, dim=d, tag=t) for i, (d, t) in enumerate(pairs)], "k long, dim string, tag string")
    e = F.col("event_id")
    spelt = (
        F.when(e % 4 == 0, F.upper("tag"))
        .when(e % 4 == 1, F.concat(F.lit(" "), F.lower(F.translate("tag", " -", "_ ")), F.lit(" ")))
        .when(e % 24 == 3, "netwotking and collaboration")
        .when(e % 24 == 7, "nonsense")
        .otherwise(F.col("tag"))
    )
    events = table(spark, sf_dir, "events").withColumn("k", (e * 31 + F.col("user_id")) % len(pairs)).join(pick, "k")
    return events.select(
        F.col("user_id").alias("resource_id"),
        e.alias("pos"),
        (e % 5).cast("int").alias("chunk_index"),
        "dim",
        spelt.alias("tag"),
        F.when(F.col("value") > 20, "high").when(F.col("value") > 5, "medium").otherwise("low").alias("confidence"),
        F.col("event_type").alias("evidence"),
        (e % 17 == 0).alias("rescued"),
    )


_TYPOS = "CASE lower(trim(regexp_replace(trim(p.tag), '[_-]', ' ', 'g'))) " + " ".join(f"WHEN '{a}' THEN '{b.lower()}'" for a, b in X.TYPOS.items()) + " ELSE lower(trim(regexp_replace(trim(p.tag), '[_-]', ' ', 'g'))) END"
_CANON = f"""
(SELECT p.resource_id, p.pos, p.chunk_index, p.dim, p.confidence, p.evidence, p.rescued, p.tag AS proposed, coalesce(a.tag, b.tag) AS valid_tag FROM {_PROPOSED} p
 LEFT JOIN {_TAX} a ON a.dim = p.dim AND a.tag_lower = lower(trim(p.tag))
 LEFT JOIN {_TAX} b ON b.dim = p.dim AND b.tag_norm = {_TYPOS})"""


@R.add(f"SELECT resource_id, pos, dim, proposed, valid_tag FROM {_CANON}")
def tag_canonicalise(spark, sf_dir):
    out = G.canonicalise(_proposed(spark, sf_dir), X.taxonomy_frame(spark))
    return out.select("resource_id", "pos", "dim", F.col("tag").alias("proposed"), "valid_tag")


_BATCH = f"(SELECT resource_id, dim, CASE WHEN chunk_index < 3 THEN 'primary' ELSE 'secondary' END AS tier, pos, tag FROM {_PROPOSED})"


@R.add(
    f"""WITH m AS (SELECT p.*, t.tag AS valid FROM {_BATCH} p LEFT JOIN {_TAX} t ON t.dim = p.dim AND t.tag_lower = lower(trim(p.tag))),
g AS (SELECT resource_id, dim, coalesce(list(valid ORDER BY pos) FILTER (valid IS NOT NULL AND tier = 'primary'), []) AS primary_tags,
  coalesce(list(valid ORDER BY pos) FILTER (valid IS NOT NULL AND tier = 'secondary'), []) AS s,
  list_concat(coalesce(list(tag ORDER BY pos) FILTER (valid IS NULL AND tier = 'primary'), []), coalesce(list(tag ORDER BY pos) FILTER (valid IS NULL AND tier = 'secondary'), [])) AS removed FROM m GROUP BY 1, 2)
SELECT resource_id, dim, array_to_string(primary_tags, '|') AS primary_tags, array_to_string(list_filter(s, lambda x: NOT list_contains(primary_tags, x)), '|') AS secondary_tags, array_to_string(removed, '|') AS removed FROM g"""
)
def tag_validate(spark, sf_dir):
    p = _proposed(spark, sf_dir).withColumn("tier", F.when(F.col("chunk_index") < 3, "primary").otherwise("secondary"))
    out = G.validate_batch(p, X.taxonomy_frame(spark))
    joined = lambda c: F.array_join(c, "|")
    return out.select("resource_id", "dim", joined("primary").alias("primary_tags"), joined("secondary").alias("secondary_tags"), joined("removed").alias("removed"))


def _valid(spark, sf_dir):
    out = G.canonicalise(_proposed(spark, sf_dir), X.taxonomy_frame(spark)).where("valid_tag is not null")
    return out.drop("tag").withColumnRenamed("valid_tag", "tag")


def _aggregated(spark, sf_dir):
    return G.aggregate_tags(_valid(spark, sf_dir))


# entries in order of (chunk, position); the first gives confidence and rescue, two or more make it high
_AGG = f"""
(SELECT resource_id, dim, valid_tag AS tag, CASE WHEN count(*) > 1 THEN 'high' ELSE min(confidence) END AS confidence, CAST(count(*) AS INTEGER) AS chunk_count,
  CAST(count(DISTINCT chunk_index) AS INTEGER) AS distinct_chunks, list(chunk_index ORDER BY chunk_index, pos) AS chunk_indices,
  list(evidence ORDER BY chunk_index, pos) AS all_evidence, first(rescued ORDER BY chunk_index, pos) AS rescued, min(CAST(chunk_index AS BIGINT) * 1000000000 + pos) AS seen
 FROM {_CANON} WHERE valid_tag IS NOT NULL GROUP BY 1, 2, 3)"""
_SINGLE = "(" + ", ".join(f"'{d}'" for d in X.SINGLE) + ")"
_RANK = "CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END"


@R.add(
    f"""SELECT resource_id, dim, tag, confidence, chunk_count, distinct_chunks, array_to_string(chunk_indices, ',') AS chunk_indices,
  array_to_string(list_transform(list_filter(list_transform(all_evidence, lambda e, i: [e, CAST(list_position(all_evidence, e) = i AS VARCHAR)]), lambda p: p[2] = 'true'), lambda p: p[1]), ',') AS evidence, rescued FROM {_AGG}"""
)
def tag_aggregate(spark, sf_dir):
    out = _aggregated(spark, sf_dir)
    return out.select("resource_id", "dim", "tag", "confidence", "chunk_count", "distinct_chunks", F.array_join("chunk_indices", ",").alias("chunk_indices"), F.array_join("evidence", ",").alias("evidence"), "rescued")


@R.add(f"SELECT resource_id, dim, tag, confidence, chunk_count FROM {_AGG} WHERE dim IN {_SINGLE} OR chunk_count >= 3 OR (chunk_count = 1 AND confidence = 'high')")
def tag_threshold(spark, sf_dir):
    return G.threshold(_aggregated(spark, sf_dir), 3).select("resource_id", "dim", "tag", "confidence", "chunk_count")


@R.add(
    f"""SELECT resource_id, chunk_index, dim, pos, valid_tag AS tag FROM (SELECT *, row_number() OVER (PARTITION BY resource_id, chunk_index, dim ORDER BY {_RANK} DESC, pos) AS r FROM {_CANON} WHERE valid_tag IS NOT NULL) WHERE dim NOT IN {_SINGLE} OR r = 1"""
)
def tag_chunk_winner(spark, sf_dir):
    return G.chunk_winner(_valid(spark, sf_dir)).select("resource_id", "chunk_index", "dim", "pos", "tag")


_WINNER = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY resource_id, dim ORDER BY chunk_count DESC, {_RANK} DESC, seen) AS r FROM {_AGG}) WHERE dim NOT IN {_SINGLE} OR r = 1)"


@R.add(f"SELECT resource_id, dim, tag, chunk_count FROM {_WINNER}")
def tag_single_top1(spark, sf_dir):
    return G.single_winner(_aggregated(spark, sf_dir)).select("resource_id", "dim", "tag", "chunk_count")


@R.add(f"SELECT resource_id, dim, string_agg(tag, '|' ORDER BY seen) AS conflict FROM {_AGG} WHERE dim IN {_SINGLE} GROUP BY 1, 2 HAVING count(*) > 1")
def tag_conflicts(spark, sf_dir):
    return G.conflicts(_aggregated(spark, sf_dir)).withColumn("conflict", F.array_join("conflict", "|"))


# what profiles and labels say, made up from the customer of the same number
_EVIDENCE = """(SELECT c_custkey AS resource_id, c_custkey % 3 = 0 AS funding, c_custkey % 2 = 0 AS used FROM customer)"""
_POST = f"""
WITH w AS {_WINNER}, k AS (SELECT resource_id, tag AS kind FROM w WHERE dim = 'resource_type'),
m AS (SELECT w.*, kind, coalesce(funding, FALSE) AS funding, coalesce(kind IN ({", ".join(f"'{t}'" for t in X.NOT_APPLICABLE_TYPES)}) OR (kind IN ({", ".join(f"'{t}'" for t in X.KEYWORD_TYPES)}) AND NOT coalesce(used, FALSE)), FALSE) AS forced
  FROM w LEFT JOIN k USING (resource_id) LEFT JOIN {_EVIDENCE} e USING (resource_id)),
kept AS (SELECT * FROM m WHERE (dim <> 'research_funding_process' OR funding) AND (dim <> 'adoption_readiness_level' OR NOT forced OR tag = 'Not applicable'))
SELECT resource_id, dim, tag, chunk_count, confidence FROM kept
UNION ALL SELECT DISTINCT resource_id, 'adoption_readiness_level', 'Not applicable', 1, 'high' FROM m
  WHERE forced AND resource_id NOT IN (SELECT resource_id FROM kept WHERE dim = 'adoption_readiness_level')"""


def _final(spark, sf_dir):
    c = F.col("c_custkey")
    said = table(spark, sf_dir, "customer").select(
        c.alias("resource_id"),
        F.when(c % 3 == 0, "a research grant").otherwise("nothing").alias("profile_text"),
        F.when(c % 2 == 0, "was Piloted").otherwise("").alias("interventions"),
        F.col("c_mktsegment").alias("label"),
    )
    return G.postprocess(G.single_winner(_aggregated(spark, sf_dir)), said)


@R.add(_POST)
def tag_postprocess(spark, sf_dir):
    return _final(spark, sf_dir).select("resource_id", "dim", "tag", "chunk_count", "confidence")


@R.add(
    f"""SELECT c.resource_id, n AS chunk_count, total_errors, total_calls, coalesce(t, 0) AS total_tags_assigned, coalesce(s, 0) AS tags_rescued
FROM (SELECT user_id AS resource_id, count(*) AS n, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS total_errors, CAST(sum(7 + event_id % 3) AS BIGINT) AS total_calls FROM events GROUP BY 1) c
LEFT JOIN (SELECT resource_id, count(*) AS t, count(*) FILTER (rescued) AS s FROM {_WINNER} GROUP BY 1) USING (resource_id)"""
)
def tag_stats(spark, sf_dir):
    none = F.array().cast("array<string>")
    chunks = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("resource_id"),
        F.when(F.col("event_type") == "error", F.array(F.lit("x"))).otherwise(none).alias("errors"),
        (7 + F.col("event_id") % 3).alias("calls"),
    )
    return G.tag_stats(G.single_winner(_aggregated(spark, sf_dir)), chunks)


def _tagged(spark, sf_dir):
    aggregated = _aggregated(spark, sf_dir)
    none = F.array().cast("array<string>")
    chunks = table(spark, sf_dir, "events").select(F.col("user_id").alias("resource_id"), none.alias("errors"), F.lit(8).alias("calls"))
    return G.tagged_resource(G.single_winner(aggregated), G.conflicts(aggregated), G.tag_stats(G.single_winner(aggregated), chunks))


_TAG_LINE = "dim || '=' || tag || ':' || confidence || ':' || chunk_count || ':' || array_to_string(chunk_indices, '+') || ':' || rescued"


@R.add(
    f"""SELECT c.resource_id, n AS chunk_count, CAST(0 AS BIGINT) AS total_errors, CAST(8 * n AS BIGINT) AS total_calls, coalesce(t, 0) AS total_tags_assigned, coalesce(s, 0) AS tags_rescued, coalesce(tags, '') AS tags, coalesce(conflicts, '') AS conflicts
FROM (SELECT user_id AS resource_id, count(*) AS n FROM events GROUP BY 1) c
LEFT JOIN (SELECT resource_id, count(*) AS t, count(*) FILTER (rescued) AS s, string_agg({_TAG_LINE}, ';' ORDER BY {_TAG_LINE}) AS tags FROM {_WINNER} GROUP BY 1) USING (resource_id)
LEFT JOIN (SELECT resource_id, string_agg(dim || '=' || conflict, ';' ORDER BY dim) AS conflicts FROM
  (SELECT resource_id, dim, string_agg(tag, '|' ORDER BY seen) AS conflict FROM {_AGG} WHERE dim IN {_SINGLE} GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1) USING (resource_id)"""
)
def tagged_resources(spark, sf_dir):
    out = _tagged(spark, sf_dir)
    text = lambda c: c.cast("string")
    line = lambda d, t: F.concat(d, F.lit("="), F.concat_ws(":", t["tag"], t["confidence"], text(t["chunk_count"]), F.array_join(F.transform(t["chunk_indices"], text), "+"), text(t["rescued"])))
    lines = F.flatten(F.transform(F.map_entries("tags"), lambda e: F.transform(e["value"], lambda t: line(e["key"], t))))
    split = F.transform("conflicts", lambda c: F.concat(c["dim"], F.lit("="), F.array_join(c["conflict"], "|")))
    joined = {n: F.coalesce(F.array_join(F.array_sort(c), ";"), F.lit("")) for n, c in (("tags", lines), ("conflicts", split))}
    return out.withColumns(joined)


@R.add(
    f"""SELECT c_custkey AS resource_id, coalesce(tag, '{X.DEFAULT_TYPE}') AS resource_type FROM customer
LEFT JOIN (SELECT resource_id, tag FROM {_WINNER} WHERE dim = 'resource_type') ON resource_id = c_custkey"""
)
def summary_types(spark, sf_dir):
    """The summariser's resource type from the tagged resource, or the default."""
    return G.resource_types(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("resource_id")), _tagged(spark, sf_dir).select("resource_id", "tags"))


@R.add(
    """SELECT id, CAST(row_number() OVER (ORDER BY try_cast(id AS BIGINT) NULLS LAST, id) AS INTEGER) AS place
FROM (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'r' || s_suppkey ELSE CAST(s_suppkey * 7 % 1000 AS VARCHAR) || CASE WHEN s_suppkey % 5 = 0 THEN 'x' ELSE '' END END || '' AS id FROM supplier) GROUP BY id"""
)
def resource_order(spark, sf_dir):
    """Places of resources in a report: numbers by value, then the other ids."""
    k = F.col("s_suppkey")
    given = F.when(k % 3 == 0, F.concat(F.lit("r"), k.cast("string"))).otherwise(F.concat((k * 7 % 1000).cast("string"), F.when(k % 5 == 0, "x").otherwise("")))
    ids = table(spark, sf_dir, "supplier").select(given.alias("id")).distinct()
    from pyspark.sql import Window

    return ids.withColumn("place", F.row_number().over(Window.orderBy(*E.id_order("id"))))


@R.add(
    """SELECT t.resource_type, coalesce(k.heads, g.heads) AS headings FROM (SELECT DISTINCT CASE p_type WHEN 'SMALL' THEN 'Guidance' WHEN 'LARGE' THEN 'Legislation' WHEN 'MEDIUM' THEN 'Blog Post' ELSE 'Unheard of' END AS resource_type FROM part) t
LEFT JOIN (SELECT * FROM (VALUES """
    + X.values([(t, "|".join(h)) for t, h in X.TEMPLATES.items()])
    + f") k(resource_type, heads)) k USING (resource_type) CROSS JOIN (SELECT '{'|'.join(X.GENERIC_TEMPLATE)}' AS heads) g"
)
def template_lookup(spark, sf_dir):
    p = F.col("p_type")
    kind = F.when(p == "SMALL", "Guidance").when(p == "LARGE", "Legislation").when(p == "MEDIUM", "Blog Post").otherwise("Unheard of")
    own = F.create_map(*[F.lit(x) for t, h in X.TEMPLATES.items() for x in (t, "|".join(h))])
    out = table(spark, sf_dir, "part").select(kind.alias("resource_type")).distinct()
    return out.withColumn("headings", F.coalesce(F.try_element_at(own, F.col("resource_type")), F.lit("|".join(X.GENERIC_TEMPLATE))))


# -- evaluation: truth from one half of the events, predictions from the other -----------

_TRUTH = f"(SELECT DISTINCT resource_id, dim, lower(coalesce(valid_tag, proposed)) AS tag FROM {_CANON} WHERE pos % 2 = 0 AND resource_id % 10 <> 1)"
_PRED = f"(SELECT DISTINCT resource_id, dim, lower(valid_tag) AS tag FROM {_CANON} WHERE valid_tag IS NOT NULL AND (pos % 2 = 1 OR pos % 6 = 0) AND resource_id % 10 <> 2)"
_IDS = f"(SELECT resource_id FROM {_TRUTH} INTERSECT SELECT resource_id FROM {_PRED})"
_FLAGS = f"""(SELECT coalesce(p.resource_id, a.resource_id) AS resource_id, coalesce(p.dim, a.dim) AS dim, coalesce(p.tag, a.tag) AS tag, p.tag IS NOT NULL AS predicted, a.tag IS NOT NULL AS actual
  FROM {_PRED} p FULL JOIN {_TRUTH} a ON p.resource_id = a.resource_id AND p.dim = a.dim AND p.tag = a.tag)"""
_CELLS = f"""
(SELECT i.resource_id, d.dim, count(*) FILTER (predicted AND actual AND known) AS tp, count(*) FILTER (predicted AND NOT actual AND known) AS fp,
  count(*) FILTER (NOT predicted AND actual AND known) AS fn, max(d.n) - count(*) FILTER (known) AS tn, coalesce(bool_and(predicted = actual), TRUE) AS exact_match
 FROM {_IDS} i CROSS JOIN (SELECT dim, count(*) AS n FROM {_TAX} GROUP BY 1) d
 LEFT JOIN (SELECT f.*, t.tag IS NOT NULL AS known FROM {_FLAGS} f LEFT JOIN {_TAX} t ON t.dim = f.dim AND t.tag_lower = f.tag) f ON f.resource_id = i.resource_id AND f.dim = d.dim
 GROUP BY 1, 2)"""
_P, _C = "(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END)", "(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END)"
_SCORES = f"round(CAST({_P} AS DOUBLE), 4) AS precision, round(CAST({_C} AS DOUBLE), 4) AS recall, round(CAST(CASE WHEN {_P} + {_C} > 0 THEN 2 * {_P} * {_C} / ({_P} + {_C}) ELSE 0.0 END AS DOUBLE), 4) AS f1"


def _sides(spark, sf_dir):
    p = G.canonicalise(_proposed(spark, sf_dir), X.taxonomy_frame(spark))
    truth = p.where("pos % 2 = 0 and resource_id % 10 <> 1").select("resource_id", "dim", F.lower(F.coalesce("valid_tag", "tag")).alias("tag"))
    pred = p.where("valid_tag is not null and (pos % 2 = 1 or pos % 6 = 0) and resource_id % 10 <> 2").select("resource_id", "dim", F.col("valid_tag").alias("tag"))
    return pred, truth


def _flags(spark, sf_dir):
    pred, truth = _sides(spark, sf_dir)
    ids = E.matched_ids(pred, truth)
    return E.tag_flags(pred, truth, ids, X.taxonomy_frame(spark)), ids


def _cells(spark, sf_dir):
    flags, ids = _flags(spark, sf_dir)
    return E.cells(flags, ids, X.taxonomy_frame(spark))


@R.add(f"SELECT resource_id, dim, tp, tn, fp, fn, exact_match, {_SCORES} FROM {_CELLS}")
def eval_cells(spark, sf_dir):
    return _cells(spark, sf_dir).select("resource_id", "dim", "tp", "tn", "fp", "fn", "exact_match", "precision", "recall", "f1")


_DIMS = f"(SELECT dim, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(tn) AS BIGINT) AS tn, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn, count(*) FILTER (exact_match) AS exact_matches, count(*) AS total FROM {_CELLS} GROUP BY {{0}})"
_RATE = "round(CAST(exact_matches AS DOUBLE) / total, 4) AS exact_rate"


@R.add(f"SELECT *, {_SCORES}, {_RATE} FROM {_DIMS.format('dim')}")
def eval_by_dim(spark, sf_dir):
    return E.by_dimension(_cells(spark, sf_dir))


@R.add(f"SELECT coalesce(dim, 'OVERALL') AS dim, tp, tn, fp, fn, exact_matches, total, {_SCORES}, {_RATE} FROM {_DIMS.format('ROLLUP (dim)')}")
def eval_overall(spark, sf_dir):
    return E.overall(_cells(spark, sf_dir))


@R.add(
    f"""SELECT f.dim, f.tag, CAST(max(t.pos) AS INTEGER) AS pos, count(*) FILTER (predicted AND actual) AS tp, count(*) FILTER (predicted AND NOT actual) AS fp, count(*) FILTER (NOT predicted AND actual) AS fn,
  (SELECT count(*) FROM {_IDS}) - count(*) AS tn, count(*) FILTER (predicted <> actual) AS wrong
FROM {_FLAGS} f JOIN {_TAX} t ON t.dim = f.dim AND t.tag_lower = f.tag WHERE f.resource_id IN (SELECT resource_id FROM {_IDS}) GROUP BY 1, 2"""
)
def eval_by_tag(spark, sf_dir):
    flags, ids = _flags(spark, sf_dir)
    return E.by_tag(flags, ids, X.taxonomy_frame(spark))


@R.add(
    f"""SELECT resource_id, 'truth' AS missing FROM (SELECT DISTINCT resource_id FROM {_PRED} EXCEPT SELECT resource_id FROM {_TRUTH})
UNION ALL SELECT resource_id, 'prediction' FROM (SELECT DISTINCT resource_id FROM {_TRUTH} EXCEPT SELECT resource_id FROM {_PRED})"""
)
def eval_unmatched(spark, sf_dir):
    return E.unmatched(*_sides(spark, sf_dir))


@R.add(
    """SELECT DISTINCT resource_id, dim, tag FROM (
  SELECT c_custkey AS resource_id, 'career_pathway' AS dim, trim(unnest(string_split(lower(c_mktsegment || ', ' || c_nationkey || ',, ' || c_mktsegment), ','))) AS tag FROM customer
  UNION ALL SELECT c_custkey, 'resource_type', trim(unnest(string_split(lower(c_name), ','))) FROM customer) WHERE tag <> ''"""
)
def ground_truth(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    wide = c.select(F.col("c_custkey").alias("resource_id"), F.concat_ws("", "c_mktsegment", F.lit(", "), "c_nationkey", F.lit(",, "), "c_mktsegment").alias("path"), "c_name")
    return E.ground_truth(wide, {"career_pathway": "path", "resource_type": "c_name"})



