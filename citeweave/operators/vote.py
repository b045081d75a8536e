"""Merging a group's records field by field. Every tie has a rule, so results don't depend on order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What a record's source weighs; others weigh DEFAULT_WEIGHT.
SOURCE_WEIGHTS = {"pmc_oa": 7.0, "pmc_oa_reference": 1.0, "pubmed_api": 2.0}
DEFAULT_WEIGHT = 0.5


def weight_of(source: Column, weights: dict[str, float] = SOURCE_WEIGHTS, default: float = DEFAULT_WEIGHT) -> Column:
    out = F.lit(default)
    for name, w in weights.items():
        out = F.when(source == name, F.lit(w)).otherwise(out)
    return out


def weighted_vote(records: DataFrame, key: str, fields: list[str], source: str, weights: dict[str, float] = SOURCE_WEIGHTS, default: float = DEFAULT_WEIGHT) -> DataFrame:
    """(key, field, value, weight): per group and field the value of the greatest weight; ties: the least value."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    votes = records.select(key, weight_of(F.col(source), weights, default).alias("w"), pairs.alias("p")).select(key, "p.field", "p.value", "w").where("value IS NOT NULL")
    sums = votes.groupBy(key, "field", "value").agg(F.sum("w").alias("weight"))
    first = F.row_number().over(Window.partitionBy(key, "field").orderBy(F.desc("weight"), "value"))
    return sums.withColumn("_n", first).where("_n = 1").drop("_n")


def longest_list(records: DataFrame, key: str, column: str) -> DataFrame:
    """Per group its longest list; of equally long ones the greatest."""
    return records.where(F.size(column) > 0).groupBy(key).agg(F.max_by(column, F.struct(F.size(column), F.col(column))).alias(column))


def _counted(records: DataFrame, key: str, column: str) -> DataFrame:
    clean = F.trim(F.regexp_replace(F.col(column), r"\s+", " "))
    return records.select(key, clean.alias("value")).where("value <> ''").groupBy(key, "value").agg(F.count("*").alias("n"))


def mode_vote(records: DataFrame, key: str, column: str) -> DataFrame:
    """Per group the most frequent value, white space squeezed; ties: the greatest value."""
    return _counted(records, key, column).groupBy(key).agg(F.max_by("value", F.struct("n", "value")).alias(column), F.max("n").alias("n"))


def title_vote(records: DataFrame, key: str, column: str) -> DataFrame:
    """Per group the value of the greatest count times squared length; ties: the greatest value."""
    rank = F.struct((F.col("n") * F.length("value") * F.length("value")).alias("rank"), F.col("value"))
    return _counted(records, key, column).groupBy(key).agg(F.max_by("value", rank).alias(column))


def keyword_union(records: DataFrame, key: str, column: str, sep: str = ",") -> DataFrame:
    """Per group all different keywords, sorted."""
    words = records.select(key, F.explode(F.split(column, sep)).alias("w")).select(key, F.trim("w").alias("w")).where("w <> ''")
    return words.groupBy(key).agg(F.sort_array(F.collect_set("w")).alias(column))
