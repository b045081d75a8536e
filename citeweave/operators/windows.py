"""Positions, numbering and neighbours in ordered lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_position(df: DataFrame, array_col: str, item: str = "item", pos: str = "pos") -> DataFrame:
    """One row for each item of an array, numbered from 1."""
    return df.select("*", F.posexplode(array_col).alias(pos, item)).withColumn(pos, F.col(pos) + 1).drop(array_col)


def link_next(df: DataFrame, list_key: str, pos: str) -> DataFrame:
    """Linked lists: next position, and whether an item is its list's first or last."""
    w = Window.partitionBy(list_key).orderBy(pos)
    return df.withColumns({"next": F.lead(pos).over(w), "is_first": F.lag(pos).over(w).isNull(), "is_last": F.lead(pos).over(w).isNull()})


def first_by(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def number_duplicates(df: DataFrame, slug: str, *order: str) -> DataFrame:
    """The n-th of a slug's rows, from the second on, gets ``-n``."""
    n = F.row_number().over(Window.partitionBy(slug).orderBy(*order))
    return df.withColumn("_n", n).withColumn(slug, F.when(F.col("_n") > 1, F.concat_ws("-", slug, F.col("_n").cast("string"))).otherwise(F.col(slug))).drop("_n")


def dense_ids(df: DataFrame, key: str) -> DataFrame:
    """Numbers groups from 0 in order of their key, without a window over all rows.

    Keys are sorted by ranges; a range's number of keys is counted, and each range
    starts where those before it end. One row for each range comes to the driver.
    """
    keys = df.select(key).distinct().repartitionByRange(key).sortWithinPartitions(key)
    from citeweave.session import materialize

    keys = materialize(keys.withColumn("_part", F.spark_partition_id()), "keys")
    counts = keys.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
    before, total = {}, 0
    for r in counts:
        before[r["_part"]] = total
        total += r["n"]
    start = F.coalesce(F.create_map(*[F.lit(x) for p in before.items() for x in p])[F.col("_part")], F.lit(0)) if before else F.lit(0)
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return df.join(keys.select(key, (start + rank).cast("long").alias("group_id")), key)


def stack_offset(df: DataFrame, level: str, year: str, order: str) -> DataFrame:
    """A node's place among those of its level and year, from 0."""
    return df.withColumn("offset", F.row_number().over(Window.partitionBy(level, year).orderBy(order)) - 1)


def rate(df: DataFrame, key: str, tick: str, counter: str) -> DataFrame:
    """Change of a counter since the last tick, a second."""
    w = Window.partitionBy(key).orderBy(tick)
    return df.withColumn("rate", (F.col(counter) - F.lag(counter).over(w)) / (F.col(tick) - F.lag(tick).over(w)))


def page(df: DataFrame, order: list, offset: int = 0, size: int = 10) -> DataFrame:
    """One page of the ordered rows."""
    return df.orderBy(*order).offset(offset).limit(size)


def expand_ranges(pointers: DataFrame, refs: DataFrame, doc: str) -> tuple[DataFrame, DataFrame]:
    """In-text pointers (doc, pointer, first, last) over a document's numbered references (doc, ref, pos).

    (every reference pointed to, in the list's order; pointers whose range runs backwards).
    """
    a, b = refs.select(doc, F.col("ref").alias("first"), F.col("pos").alias("_a")), refs.select(doc, F.col("ref").alias("last"), F.col("pos").alias("_b"))
    ends = pointers.withColumn("last", F.coalesce("last", "first")).join(a, [doc, "first"]).join(b, [doc, "last"])
    good = ends.where("_a <= _b").select(doc, "pointer", F.explode(F.sequence("_a", "_b")).alias("pos"))
    return good.join(refs.select(doc, "pos", "ref"), [doc, "pos"]), ends.where("_a > _b").select(doc, "pointer", "first", "last")
