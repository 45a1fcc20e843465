"""Tags: canonical forms, validation, aggregation over chunks, post-processing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import taxonomy as X
from ..functions import text as T

#: Order of confidences.
CONFIDENCE = {"high": 3, "medium": 2, "low": 1, "rejected": 0}


def confidence_rank(c: Column) -> Column:
    out = F.lit(0)
    for name, rank in CONFIDENCE.items():
        out = F.when(c == name, rank).otherwise(out)
    return out


def normal_form(tag: Column) -> Column:
    """Snake and hyphen case as spaces, known misspellings mended, lower case."""
    clean = F.trim(F.regexp_replace(F.trim(tag), "[_-]", " "))
    low = F.lower(clean)
    out = low
    for wrong, right in X.TYPOS.items():
        out = F.when(low == wrong, right.lower()).otherwise(out)
    return out


def canonicalise(proposals: DataFrame, taxonomy: DataFrame, dim: str = "dim", tag: str = "tag") -> DataFrame:
    """``proposals`` with ``valid_tag``: by the raw form, else by the normal form, else null.

    The taxonomy is a table of fixed size, joined twice on (dimension, form).
    """
    # a form names one tag of a dimension; the first in order if not
    by = lambda form: taxonomy.groupBy(F.col("dim").alias("__d"), F.col(form).alias("__f")).agg(F.min_by("tag", "pos").alias(f"__{form}"))
    out = proposals.withColumns({"__raw": F.lower(F.trim(tag)), "__norm": normal_form(F.col(tag))})
    for key, form in (("__raw", "tag_lower"), ("__norm", "tag_norm")):
        side = by(form)
        out = out.join(side, (F.col(dim) == side["__d"]) & (F.col(key) == side["__f"]), "left").drop("__d", "__f")
    return out.withColumn("valid_tag", F.coalesce("__tag_lower", "__tag_norm")).drop("__raw", "__norm", "__tag_lower", "__tag_norm")


def validate_batch(proposals: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Per resource and dimension: valid primary and secondary tags, and the removed ones.

    ``proposals``: resource_id, dim, tier, pos, tag. Matching ignores case and
    outer space only; a tag that is primary is not secondary.
    """
    forms = taxonomy.select("dim", F.col("tag_lower").alias("__f"), F.col("tag").alias("valid"))
    matched = proposals.withColumn("__f", F.lower(F.trim("tag"))).join(forms, ["dim", "__f"], "left")
    picked = lambda test, what: F.transform(
        F.sort_array(F.collect_list(F.when(test, F.struct("pos", F.col(what).alias("t"))))), lambda x: x["t"]
    )
    good = F.col("valid").isNotNull()
    grouped = matched.groupBy("resource_id", "dim").agg(
        picked(good & (F.col("tier") == "primary"), "valid").alias("primary"),
        picked(good & (F.col("tier") == "secondary"), "valid").alias("secondary"),
        picked(~good & (F.col("tier") == "primary"), "tag").alias("__p"),
        picked(~good & (F.col("tier") == "secondary"), "tag").alias("__s"),
    )
    return grouped.select(
        "resource_id",
        "dim",
        "primary",
        F.filter("secondary", lambda t: ~F.array_contains("primary", t)).alias("secondary"),
        F.concat("__p", "__s").alias("removed"),
    )


def clean_list(tags: Column, allowed: list[str]) -> tuple[Column, Column]:
    """The canonical forms of the tags that are allowed, and the tags that aren't, in order."""
    forms = F.create_map(*[F.lit(x) for t in allowed for x in (t.lower(), t)])
    found = F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.struct(t.alias("said"), F.try_element_at(forms, F.lower(F.trim(t))).alias("tag")))
    good = F.transform(F.filter(found, lambda x: x["tag"].isNotNull()), lambda x: x["tag"])
    return good, F.transform(F.filter(found, lambda x: x["tag"].isNull() & x["said"].isNotNull()), lambda x: x["said"])


def _without(tags: Column, others: Column) -> Column:
    return F.filter(tags, lambda t: ~F.array_contains(others, t))


def validate_answer(answer: Column, taxonomy: dict[str, list[str]] = X.BATCH_TAXONOMY) -> Column:
    """A batch answer held against the taxonomy: tags, single values, sectors, and what was removed.

    A block that is no object is reset without a note; a single value that isn't allowed becomes empty and is no
    issue; a tag that is primary is not secondary.
    """
    tags, issues = [], []
    for dim in X.MULTI:
        block = F.from_json(F.get_json_object(answer, f"$.{dim}"), "primary array<string>, secondary array<string>")
        (first, bad), (second, worse) = (clean_list(block[tier], taxonomy[dim]) for tier in ("primary", "secondary"))
        removed = F.concat(bad, worse)
        tags.append(F.struct(F.lit(dim).alias("dim"), first.alias("primary"), _without(second, first).alias("secondary"), removed.alias("removed")))
        issues.append(F.when(F.size(removed) > 0, F.concat(F.lit(f"{dim}: removed "), F.array_join(removed, ", "))))
    said = F.get_json_object(answer, "$.sector")
    listed = F.coalesce(F.from_json(said, "array<string>"), F.transform(F.split(F.coalesce(said, F.lit("")), ","), lambda x: F.trim(x)))
    sectors, others = clean_list(listed, X.SECTORS)
    others = F.filter(others, lambda x: x != "")
    issues.append(F.when(F.size(others) > 0, F.concat(F.lit("sector: removed "), F.array_join(others, ", "))))
    log = F.filter(F.array(*issues), lambda x: x.isNotNull())
    single = [clean_scalar(F.get_json_object(answer, f"$.{d}"), taxonomy[d]).alias(d) for d in X.SINGLE]
    return F.struct(F.array(*tags).alias("tags"), *single, sectors.alias("sector"), log.alias("issues"), (F.size(log) == 0).alias("passed"))


def clean_scalar(value: Column, allowed: list[str], fallback: str = "") -> Column:
    """The canonical form of a single value, or the fallback."""
    low, out = F.lower(F.trim(F.coalesce(value, F.lit("")))), F.lit(fallback)
    for tag in allowed:
        out = F.when(low == tag.lower(), tag).otherwise(out)
    return out


def clean_sectors(value: Column) -> Column:
    """Valid sectors of a comma-separated string, in order."""
    parts = F.transform(F.split(F.coalesce(value, F.lit("")), ","), lambda s: clean_scalar(s, X.SECTORS))
    return F.filter(parts, lambda s: s != "")


def chunk_winner(tags: DataFrame) -> DataFrame:
    """In each chunk, only the most confident tag of a single-value dimension; the first proposed wins ties."""
    rank = F.row_number().over(Window.partitionBy("resource_id", "chunk_index", "dim").orderBy(confidence_rank(F.col("confidence")).desc(), "pos"))
    single = tags.where(F.col("dim").isin(list(X.SINGLE))).withColumn("__r", rank).where("__r = 1").drop("__r")
    return tags.where(~F.col("dim").isin(list(X.SINGLE))).unionByName(single)


def aggregate_tags(tags: DataFrame) -> DataFrame:
    """Tags of all chunks of a resource, in order of (chunk_index, pos).

    Every further entry of a tag counts, also within a chunk, and makes its
    confidence high. A resource's chunks bound the lists; nothing is listed
    across resources.
    """
    entry = F.struct("chunk_index", "pos", "confidence", F.coalesce("evidence", F.lit("")).alias("evidence"), "rescued")
    grouped = tags.groupBy("resource_id", "dim", "tag").agg(F.sort_array(F.collect_list(entry)).alias("own"))
    first = F.get("own", F.lit(0))
    later = F.filter(F.transform(F.slice("own", 2, F.greatest(F.size("own") - 1, F.lit(0))), lambda x: x["evidence"]), lambda e: (e != "") & (e != first["evidence"]))
    return grouped.select(
        "resource_id",
        "dim",
        "tag",
        F.when(F.size("own") > 1, "high").otherwise(first["confidence"]).alias("confidence"),
        F.size("own").alias("chunk_count"),
        F.size(F.array_distinct(F.transform("own", lambda x: x["chunk_index"]))).alias("distinct_chunks"),
        F.transform("own", lambda x: x["chunk_index"]).alias("chunk_indices"),
        F.concat(F.array(first["evidence"]), F.array_distinct(later)).alias("evidence"),
        first["rescued"].alias("rescued"),
        F.struct(first["chunk_index"], first["pos"]).alias("first_seen"),
    )


def threshold(aggregated: DataFrame, min_chunks: int = 1, min_confidence: str | None = None) -> DataFrame:
    """Tags of multi-value dimensions seen often enough, or once with high confidence; others stay.

    ``min_confidence`` is off unless given.
    """
    rank = confidence_rank(F.col("confidence"))
    kept = (F.col("chunk_count") >= min_chunks) | ((F.col("chunk_count") == 1) & (rank >= CONFIDENCE["high"]))
    if min_confidence:
        kept = kept & (rank >= CONFIDENCE[min_confidence])
    return aggregated.where(F.col("dim").isin(list(X.SINGLE)) | kept)


def conflicts(aggregated: DataFrame) -> DataFrame:
    """Single-value dimensions for which a resource has more than one tag, in order of first sight."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct("first_seen", "tag"))), lambda x: x["tag"])
    single = aggregated.where(F.col("dim").isin(list(X.SINGLE)))
    return single.groupBy("resource_id", "dim").agg(listed.alias("conflict")).where(F.size("conflict") > 1)


def single_winner(aggregated: DataFrame) -> DataFrame:
    """One tag for each single-value dimension: by chunks, then confidence, then first sight."""
    order = Window.partitionBy("resource_id", "dim").orderBy(F.desc("chunk_count"), confidence_rank(F.col("confidence")).desc(), "first_seen")
    single = aggregated.where(F.col("dim").isin(list(X.SINGLE))).withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r")
    return aggregated.where(~F.col("dim").isin(list(X.SINGLE))).unionByName(single)


def postprocess(final: DataFrame, evidence: DataFrame) -> DataFrame:
    """Guards on the funding and the adoption dimension.

    ``evidence``: resource_id, profile_text, interventions, label of each chunk.
    Funding tags stay only where a process keyword occurs in a profile or label;
    adoption becomes "Not applicable" by the resource's type, or for reports and
    databases in which nothing tells of an implementation.
    """
    flags = evidence.groupBy("resource_id").agg(
        F.bool_or(T.mentions_funding_process(F.concat_ws(" ", "profile_text", "label"))).alias("__funding"),
        F.bool_or(T.mentions_implementation(F.concat_ws(" ", "label", "interventions"))).alias("__used"),
    )
    kinds = final.where("dim = 'resource_type'").select("resource_id", F.col("tag").alias("__type"))
    marked = final.join(flags, "resource_id", "left").join(kinds, "resource_id", "left")
    funding = (F.col("dim") != "research_funding_process") | F.coalesce("__funding", F.lit(False))
    forced = F.coalesce(
        F.col("__type").isin(X.NOT_APPLICABLE_TYPES) | (F.col("__type").isin(X.KEYWORD_TYPES) & ~F.coalesce("__used", F.lit(False))), F.lit(False)
    )
    kept = marked.where(funding & ((F.col("dim") != "adoption_readiness_level") | ~forced | (F.col("tag") == "Not applicable")))
    cols = final.columns
    have = kept.where("dim = 'adoption_readiness_level'").select("resource_id")
    added = (
        kinds.join(flags, "resource_id", "left")
        .where(forced)
        .join(have, "resource_id", "left_anti")
        .select(
            "resource_id",
            F.lit("adoption_readiness_level").alias("dim"),
            F.lit("Not applicable").alias("tag"),
            F.lit("high").alias("confidence"),
            F.lit(1).alias("chunk_count"),
            F.lit(1).alias("distinct_chunks"),
            F.array(F.lit(1)).alias("chunk_indices"),
            F.array(F.concat(F.lit("Resource Type is "), "__type", F.lit(" — not an active intervention"))).alias("evidence"),
            F.lit(False).alias("rescued"),
        )
    )
    return kept.select(*[c for c in cols if c != "first_seen"]).unionByName(added)


def tag_stats(final: DataFrame, chunks: DataFrame) -> DataFrame:
    """Tags, rescued tags, errors and model calls of each resource."""
    counted = final.groupBy("resource_id").agg(F.count(F.lit(1)).alias("total_tags_assigned"), F.count_if("rescued").alias("tags_rescued"))
    work = chunks.groupBy("resource_id").agg(
        F.count(F.lit(1)).alias("chunk_count"), F.sum(F.size("errors")).alias("total_errors"), F.sum("calls").alias("total_calls")
    )
    return work.join(counted, "resource_id", "left").na.fill(0)


def resource_types(resources: DataFrame, tagged: DataFrame) -> DataFrame:
    """``resources`` with the resource_type that a tagged resource has first, or the default."""
    first = F.get(F.try_element_at("tags", F.lit("resource_type")), F.lit(0))["tag"]
    known = tagged.select("resource_id", first.alias("resource_type")).where("resource_type is not null").dropDuplicates(["resource_id"])
    return resources.join(known, "resource_id", "left").na.fill(X.DEFAULT_TYPE, ["resource_type"])


def tagged_resource(final: DataFrame, conflict: DataFrame, stats: DataFrame) -> DataFrame:
    """One row a resource: a map from dimension to its tags, its conflicts and statistics."""
    entry = F.struct("tag", "confidence", "chunk_count", "chunk_indices", "evidence", "rescued")
    dims = final.groupBy("resource_id", "dim").agg(F.collect_list(entry).alias("own"))
    tags = dims.groupBy("resource_id").agg(F.map_from_entries(F.collect_list(F.struct("dim", "own"))).alias("tags"))
    flagged = conflict.groupBy("resource_id").agg(F.collect_list(F.struct("dim", "conflict")).alias("conflicts"))
    return stats.join(tags, "resource_id", "left").join(flagged, "resource_id", "left")


def reduce_budget(summaries: DataFrame, budget: int, group: str = "resource_id") -> DataFrame:
    """Summaries kept when the shortest are dropped until the rest fits the budget.

    A summary goes if the total without the shorter ones before it is still over
    the budget. ``summaries``: group, pos, tokens.
    """
    before = Window.partitionBy(group).orderBy("tokens", "pos").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("tokens").over(Window.partitionBy(group))
    running = total - F.coalesce(F.sum("tokens").over(before), F.lit(0))
    return summaries.withColumn("__left", running).where(F.col("__left") <= budget).drop("__left")
