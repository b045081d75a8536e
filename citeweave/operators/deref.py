"""References inside nested records, followed wherever they stand, and records merged after that.

A record is a row of nested columns; a reference is a struct with the only field ``ref``, an id with or without ``@``.
Records are taken apart into leaves, (id, field, path, ref, value, is_uri): ``path`` says where in the field a leaf
stands, by names and places in lists. So one join of leaves with what they refer to works for any depth and shape.

* an id that has a URI becomes the URI;
* an id that names a record of the data set is replaced by that record's leaves, whose own references come next;
* a reference back to a record that is being put in is cut, and stays ``@id``, as does one that names nothing.

Each round follows the references that the round before put in, is written to the shared folder, and ends the loop when
it finds none; the chain of records that a leaf was reached through is as long as records are nested, not as there are records.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from citeweave.operators.vote import weight_of
from citeweave.session import materialize

LEAF = "array<struct<path:string,ref:string,value:string>>"


def _leaves(c: Column, kind: DataType, path: Column) -> Column:
    """The leaves of a nested value as an array."""
    def one(ref: Column | None, value: Column | None) -> Column:
        none = F.lit(None).cast("string")
        there = F.array(F.struct(path.alias("path"), (none if ref is None else ref).alias("ref"), (none if value is None else value).alias("value")))
        return F.when((value if ref is None else ref).isNotNull(), there).otherwise(F.array().cast(LEAF))

    if isinstance(kind, StructType) and kind.names == ["ref"]:
        return one(F.ltrim(c["ref"], F.lit("@")), None)
    if isinstance(kind, StructType):
        parts = [_leaves(c[f.name], f.dataType, F.concat(path, F.lit(f".{f.name}"))) for f in kind.fields]
        return F.concat(*parts) if parts else F.array().cast(LEAF)
    if isinstance(kind, ArrayType):
        nested = F.transform(c, lambda x, i: _leaves(x, kind.elementType, F.concat(path, F.lit("."), F.lpad((i + 1).cast("string"), 6, "0"))))
        return F.coalesce(F.flatten(nested), F.array().cast(LEAF))
    return one(None, c if isinstance(kind, StringType) else c.cast("string"))


def shredded(records: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(id, field, path, ref, value) of every leaf of the fields; nulls have none."""
    types = {f.name: f.dataType for f in records.schema.fields}

    def of(field: str) -> Column:
        return F.transform(_leaves(F.col(field), types[field], F.lit("")), lambda x: F.struct(F.lit(field).alias("field"), x["path"].alias("path"), x["ref"].alias("ref"), x["value"].alias("value")))

    each = F.explode(F.concat(*map(of, fields)))
    return records.select(F.col(key).alias("id"), each.alias("x")).select("id", "x.*")


def refers(kind: DataType) -> bool:
    """Whether a value of the type can hold a reference, or has parts."""
    return isinstance(kind, StructType | ArrayType)


def saying(records: DataFrame, fields: list[str]) -> DataFrame:
    """The records that have a leaf in any of the fields."""
    types = {f.name: f.dataType for f in records.schema.fields}
    return records.where(reduce(Column.__or__, [F.size(_leaves(F.col(f), types[f], F.lit(""))) > 0 if refers(types[f]) else F.col(f).isNotNull() for f in fields]))


def elected(records: DataFrame, fields: list[str]) -> DataFrame:
    """(group, fields): what :func:`voted` and :func:`widened` make of fields without references, as columns.

    records(group, source, fields). Most groups have one record, which is taken as it is; only others are taken apart.
    """
    rows = records.select("group", "source", *[F.col(f).cast("string").alias(f) for f in fields])
    more = rows.groupBy("group").agg(F.count("*").alias("_n")).where("_n > 1").select("group")
    more = materialize(more, "groups")
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields]))
    votes = rows.join(more, "group", "left_semi").select("group", "source", each.alias("x")).select("group", "source", "x.*")
    # As in voted: sums first, then the best of the different values; a field that no record has stays null.
    sums = votes.groupBy("group", "field", "value").agg(F.sum(weight_of(F.col("source"))).alias("weight"))
    best = [F.min(F.when((F.col("field") == f) & F.col("value").isNotNull(), F.struct((-F.col("weight")).alias("w"), "value")))["value"].alias(f) for f in fields]
    return rows.join(more, "group", "left_anti").drop("source").unionByName(sums.groupBy("group").agg(*best))


def leaves_of(tables: list[DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """For ``followed``: the leaves of those records of the tables whose id is asked for. A table's fields are all but id, group and source."""

    def of(wanted: DataFrame) -> DataFrame:
        out = []
        for t in tables:
            hit = materialize(t.select("id").join(wanted, "id", "left_semi"), "wanted")
            if not hit.isEmpty():
                out.append(shredded(t.join(hit.distinct(), "id", "left_semi"), "id", [c for c in t.columns if c not in ("id", "group", "source")]))
        return reduce(DataFrame.unionByName, out) if out else wanted.sparkSession.createDataFrame([], "id string, field string, path string, ref string, value string")

    return of


def followed(leaves: DataFrame, known: DataFrame | Callable[[DataFrame], DataFrame], uris: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(id, field, path, value, is_uri): ``leaves`` with all references followed.

    known: leaves of the records of the data set, or what gives those of the records of a table of ids; uris(id, uri). Only
    references without a URI meet records. A chain of more than ``most_rounds`` records is an error.
    """
    named = uris.groupBy(F.col("id").alias("ref")).agg(F.min("uri").alias("uri"))

    def inner_of(known: DataFrame) -> DataFrame:
        return known.select(F.col("id").alias("_id"), F.lit(True).alias("_there"), F.concat(F.lit("."), "field", "path").alias("_path"), F.col("ref").alias("_ref"), F.col("value").alias("_value"))
    done = [leaves.where("ref IS NULL").select("id", "field", "path", "value", F.lit(False).alias("is_uri"))]
    left = leaves.where("ref IS NOT NULL").select("id", "field", "path", "ref")
    for _ in range(most_rounds):
        seen = F.col("seen") if "seen" in left.columns else F.array("id")
        open_ = F.col("uri").isNull()
        rows = left.join(named, "ref", "left").select("id", "field", "path", F.when(open_, F.col("ref")).alias("ref"), F.when(open_, seen).alias("seen"), "uri")
        rows = materialize(rows, "references")
        done.append(rows.where("uri IS NOT NULL").select("id", "field", "path", F.col("uri").alias("value"), F.lit(True).alias("is_uri")))
        rows = rows.where("uri IS NULL").drop("uri")
        if rows.isEmpty():
            break
        inner = inner_of(known if isinstance(known, DataFrame) else known(rows.select(F.col("ref").alias("id")).distinct()))
        cut = F.array_contains("seen", F.col("ref"))
        found = rows.join(inner, (F.col("ref") == F.col("_id")) & ~cut, "left")
        found = materialize(found, "followed")
        done.append(found.where("_there IS NULL").select("id", "field", "path", F.concat(F.lit("@"), "ref").alias("value"), F.lit(False).alias("is_uri")))
        there = found.where("_there")
        path = F.concat("path", "_path")
        done.append(there.where("_ref IS NULL").select("id", "field", path.alias("path"), F.col("_value").alias("value"), F.lit(False).alias("is_uri")))
        left = there.where("_ref IS NOT NULL").select("id", "field", path.alias("path"), F.col("_ref").alias("ref"), F.array_append("seen", F.col("ref")).alias("seen"))
    else:
        raise ValueError(f"references are nested more than {most_rounds} deep")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def valued(leaves: DataFrame) -> DataFrame:
    """(id, field, leaves): each field of each record as one value, its leaves in order."""
    # Dealt by id alone, as what knows the records' groups is: one shuffle serves both.
    return leaves.repartition("id").groupBy("id", "field").agg(F.sort_array(F.collect_list(F.struct("path", "value", "is_uri"))).alias("leaves"))


def voted(values: DataFrame, groups: DataFrame, lists: tuple[str, ...] = ()) -> DataFrame:
    """(group, field, leaves): the merged record of each group, field by field.

    groups(id, group, source): a field's value is the one whose records' sources weigh most together, of equal ones the
    least; a field among ``lists`` is its longest list, of equally long ones that of the least id.
    """
    rows = values.join(groups, "id")
    votes = rows.where(~F.col("field").isin(*lists)) if lists else rows
    # Sums first, one row for each task and different value; then the best of the different values.
    sums = votes.groupBy("group", "field", "leaves").agg(F.sum(weight_of(F.col("source"))).alias("weight"))
    best = sums.groupBy("group", "field").agg(F.min(F.struct((-F.col("weight")).alias("w"), "leaves")).alias("x")).select("group", "field", "x.leaves")
    if not lists:
        return best
    items = F.size(F.array_distinct(F.transform("leaves", lambda x: F.substring_index(x["path"], ".", 2))))
    longest = rows.where(F.col("field").isin(*lists)).groupBy("group", "field").agg(F.min(F.struct((-items).alias("n"), "id", "leaves")).alias("x"))
    return best.unionByName(longest.select("group", "field", "x.leaves"))


def longest(values: DataFrame, groups: DataFrame, lists: tuple[str, ...]) -> DataFrame:
    """(group, lists): what :func:`voted` and :func:`widened` make of lists, in one shuffle of their values by group."""
    items = F.size(F.array_distinct(F.transform("leaves", lambda x: F.substring_index(x["path"], ".", 2))))
    rows = values.join(groups.select("id", "group"), "id").select("group", "field", F.struct((-items).alias("n"), "id", F.transform("leaves", lambda x: x["value"]).alias("values")).alias("x"))
    return rows.groupBy("group").agg(*[F.min(F.when(F.col("field") == f, F.col("x")))["values"].alias(f) for f in lists])


def widened(merged: DataFrame, fields: list[str], lists: tuple[str, ...] = (), references: tuple[str, ...] = ()) -> DataFrame:
    """One row a group: each field's first value; of ``references`` only a URI; each of ``lists`` the values of its items' own leaves."""
    first = F.element_at("leaves", 1)

    def of(name: str) -> Column:
        mine = F.col("field") == name
        if name in lists:
            return F.max(F.when(mine, F.transform("leaves", lambda x: x["value"])))
        return F.max(F.when(mine & (first["is_uri"] if name in references else F.lit(True)) & (first["path"] == ""), first["value"]))

    return merged.groupBy("group").agg(*[of(f).alias(f) for f in (*fields, *lists)])


def items(merged: DataFrame, lists: tuple[str, ...], names: list[str]) -> DataFrame:
    """(group, field, position, uri, and a column for each name): the items of lists of records; ``uri`` where the item is one."""
    rows = merged.where(F.col("field").isin(*lists)).select("group", "field", F.explode("leaves").alias("x"))
    place, rest = F.split("x.path", r"\.", 3)[1].cast("int"), F.regexp_replace("x.path", r"^\.\d+\.?", "")
    rows = rows.select("group", "field", place.alias("position"), rest.alias("name"), "x.value", "x.is_uri")
    own = [F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names]
    return rows.groupBy("group", "field", "position").agg(F.max(F.when((F.col("name") == "") & F.col("is_uri"), F.col("value"))).alias("uri"), *own)


def numbered(df: DataFrame, key: str, order: str) -> DataFrame:
    """``n``: a row's number among those of its key, from 1, in order.

    Rows are sorted by ranges of key and order, so that a key with very many rows is many tasks' work; each range starts
    a key's numbers where the ranges before it end.
    """
    rows = df.repartitionByRange(key, order).withColumn("_part", F.spark_partition_id())
    rows = materialize(rows, "numbered")
    counts = rows.groupBy(key, "_part").agg(F.count("*").alias("_k"))
    before = counts.select(key, "_part", (F.sum("_k").over(Window.partitionBy(key).orderBy("_part")) - F.col("_k")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_part", key).orderBy(order))
    return rows.withColumn("_rank", rank).join(before, [key, "_part"]).withColumn("n", F.col("_before") + F.col("_rank")).drop("_part", "_rank", "_before")
