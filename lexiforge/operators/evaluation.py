"""Evaluation of predicted tags against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import taxonomy as X


def ground_truth(wide: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``resource_id, dim, tag`` from comma-separated label columns; ``columns`` maps dimension to column."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(f"`{c}`").cast("string").alias("v")) for d, c in columns.items()])
    usable = wide.where(F.col("resource_id").isNotNull() & ~F.trim("resource_id").isin("", "None"))
    long = usable.select("resource_id", F.explode(pairs).alias("p"))
    parts = F.filter(F.transform(F.split(F.lower(F.coalesce("p.v", F.lit(""))), ","), lambda t: F.trim(t)), lambda t: t != "")
    return long.select("resource_id", F.col("p.dim").alias("dim"), F.explode(F.array_distinct(parts)).alias("tag"))


def id_order(column: str = "resource_id") -> list[Column]:
    """Order of resources: numbers by value, then the other ids."""
    return [F.expr(f"try_cast(`{column}` AS BIGINT)").asc_nulls_last(), F.col(column).asc()]


def matched_ids(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """Resources on both sides."""
    return predicted.select("resource_id").distinct().join(truth.select("resource_id").distinct(), "resource_id")


def unmatched(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """Resources on one side only, and which."""
    a, b = predicted.select("resource_id").distinct(), truth.select("resource_id").distinct()
    return (
        a.join(b, "resource_id", "left_anti")
        .withColumn("missing", F.lit("truth"))
        .unionByName(b.join(a, "resource_id", "left_anti").withColumn("missing", F.lit("prediction")))
    )


def tag_flags(predicted: DataFrame, truth: DataFrame, ids: DataFrame, taxonomy: DataFrame, dims: list[str] | None = None) -> DataFrame:
    """``resource_id, dim, tag, predicted, actual`` for the tags on either side, in or out of the taxonomy.

    Tags on neither side are not made: their number follows from the taxonomy's.
    """
    side = lambda df, n: df.select("resource_id", "dim", F.lower("tag").alias("tag")).distinct().withColumn(n, F.lit(True))
    both = side(predicted, "predicted").join(side(truth, "actual"), ["resource_id", "dim", "tag"], "full_outer").na.fill(False, ["predicted", "actual"])
    if dims is not None:
        both = both.where(F.col("dim").isin(dims))
    known = taxonomy.select("dim", F.col("tag_lower").alias("tag"), F.lit(True).alias("known"))
    return both.join(ids, "resource_id", "left_semi").join(known, ["dim", "tag"], "left").na.fill(False, ["known"])


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def scores(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return {"precision": F.round(p, 4), "recall": F.round(r, 4), "f1": F.round(f, 4)}


def cells(flags: DataFrame, ids: DataFrame, taxonomy: DataFrame, dims: list[str] | None = None) -> DataFrame:
    """Counts and scores per resource and dimension.

    Tags outside the taxonomy are not counted, but break exactness.
    """
    sizes = taxonomy.groupBy("dim").agg(F.count(F.lit(1)).alias("n_tags"))
    if dims is not None:
        sizes = sizes.where(F.col("dim").isin(dims))
    k = F.col("known")
    counted = flags.groupBy("resource_id", "dim").agg(
        F.count_if(k & F.col("predicted") & F.col("actual")).alias("tp"),
        F.count_if(k & F.col("predicted") & ~F.col("actual")).alias("fp"),
        F.count_if(k & ~F.col("predicted") & F.col("actual")).alias("fn"),
        F.bool_and(F.col("predicted") == F.col("actual")).alias("exact_match"),
    )
    # seven dimensions a resource, from a table of fixed size
    grid = ids.select("resource_id", F.explode(F.lit(list(dims or X.TAXONOMY))).alias("dim")).join(sizes, "dim")
    out = grid.join(counted, ["resource_id", "dim"], "left").na.fill(0, ["tp", "fp", "fn"]).na.fill(True, ["exact_match"])
    out = out.withColumn("tn", F.col("n_tags") - F.col("tp") - F.col("fp") - F.col("fn"))
    return out.withColumns(scores(F.col("tp"), F.col("fp"), F.col("fn"))).drop("n_tags")


def by_dimension(cell: DataFrame) -> DataFrame:
    """Summed counts per dimension, scores of the sums, and the share of exact matches."""
    out = cell.groupBy("dim").agg(*_sums())
    return _scored(out)


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("tp", "tn", "fp", "fn")] + [F.count_if("exact_match").alias("exact_matches"), F.count(F.lit(1)).alias("total")]


def _scored(out: DataFrame) -> DataFrame:
    return out.withColumns(scores(F.col("tp"), F.col("fp"), F.col("fn"))).withColumn("exact_rate", F.round(ratio(F.col("exact_matches"), F.col("total")), 4))


def overall(cell: DataFrame) -> DataFrame:
    """The same per dimension and, under OVERALL, for all."""
    out = cell.rollup("dim").agg(*_sums()).withColumn("dim", F.coalesce("dim", F.lit("OVERALL")))
    return _scored(out)


def by_tag(flags: DataFrame, ids: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Counts per tag that occurs on either side; most wrong ones first in ``wrong``."""
    total = ids.agg(F.count(F.lit(1))).scalar()
    counted = flags.where("known").groupBy("dim", "tag").agg(
        F.count_if(F.col("predicted") & F.col("actual")).alias("tp"),
        F.count_if(F.col("predicted") & ~F.col("actual")).alias("fp"),
        F.count_if(~F.col("predicted") & F.col("actual")).alias("fn"),
    )
    positions = taxonomy.select("dim", F.col("tag_lower").alias("tag"), "pos")
    out = counted.join(positions, ["dim", "tag"])
    return out.withColumn("tn", total - F.col("tp") - F.col("fp") - F.col("fn")).withColumn("wrong", F.col("fp") + F.col("fn"))
