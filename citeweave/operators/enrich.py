"""What every record gets when it comes in: address, collection, stamps, date, and the id it is known by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions import dates
from citeweave.operators import resolve

_IDENTIFIERS = "array<struct<type:string,id:string,canonical:string>>"


def _with(df: DataFrame, name: str, kind: str = "string") -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def common(df: DataFrame, base_url: str, creator: str, collection: str, created: Column | None = None) -> DataFrame:
    """url, _collection, _created, _created_by and date of records with ``_id``; identifiers are a list, if an empty one.

    The date is the record's own ``year``, ``month`` and ``day``, as dd/mm/yyyy; a missing month or day is 01.
    """
    for c in ("year", "month", "day"):
        df = _with(df, c)
    df = _with(df, "identifier", _IDENTIFIERS)
    return df.withColumns({
        "url": F.concat(F.lit(base_url), F.col("_id")), "_collection": F.array(F.lit(f"{creator}_____{collection}")), "_created_by": F.lit(creator),
        "_created": F.date_format(created if created is not None else F.current_timestamp(), "yyyy-MM-dd HHmm"),
        "identifier": F.coalesce("identifier", F.array().cast(_IDENTIFIERS)), "date": dates.day_month_year(F.col("year"), F.col("month"), F.col("day")),
    })


def harvested(df: DataFrame, known: DataFrame, base_url: str, creator: str, collection: str, created: Column | None = None) -> DataFrame:
    """Harvested records as stored ones: the header's identifier joins the record's own, and a record that is known by any keeps its id.

    df(header_id, datestamp, set_spec, deleted, ...), known(canonical, id).
    """
    df = _with(df, "identifier", _IDENTIFIERS)
    own = F.struct(F.lit("oaipmh").alias("type"), F.col("header_id").alias("id"), F.concat(F.lit("oaipmh:"), F.col("header_id")).alias("canonical"))
    df = df.withColumn("identifier", F.array_append(F.coalesce("identifier", F.array().cast(_IDENTIFIERS)), own))
    keys = df.select(F.col("header_id").alias("record_id"), F.explode("identifier.canonical").alias("canonical")).where("canonical IS NOT NULL")
    found = resolve.lookup_or_new(df.select(F.col("header_id").alias("record_id")).distinct(), keys, known)
    out = df.join(found.select(F.col("record_id").alias("header_id"), F.col("id").alias("_id"), "is_new"), "header_id")
    out = out.withColumnsRenamed({"datestamp": "_oaipmh_datestamp", "set_spec": "_oaipmh_setSpec", "deleted": "_oaipmh_isDeleted"})
    return common(out, base_url, creator, collection, created)


def one_record(df: DataFrame, key: str, value: str) -> DataFrame:
    """A single record by its id; an unknown id gives no row."""
    return df.where(F.col(key) == value)


def not_seen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Records whose key isn't among those seen before."""
    return df.join(seen.select(key).distinct(), key, "left_anti")


def of_journals(df: DataFrame, journal: str, wanted: list[str]) -> DataFrame:
    return df.where(F.col(journal).isin(*wanted))


def source_urls(rows: DataFrame, mapping: DataFrame, pmc: str, number: str, url: str, prefix: str = "PMC") -> DataFrame:
    """Rows with the address their text comes from: mapping(number with a prefix, url)."""
    table = mapping.select(F.regexp_replace(number, f"^{prefix}", "").alias("_number"), F.col(url).alias("source_url")).dropDuplicates(["_number"])
    bare = F.regexp_replace(F.col(pmc).cast("string"), f"^{prefix}", "")
    return rows.join(table, bare == F.col("_number"), "left").drop("_number")
