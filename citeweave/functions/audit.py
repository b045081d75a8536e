"""Corrections of bibliographic fields, each with a row in the record's audit trail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions.ids import repair_doi
from citeweave.functions.urls import doi_in_url, normal_url

AUDIT = "array<struct<fields:array<string>,original:array<string>,corrected:array<string>,message:string>>"
#: A volume that also names its part: ``12 (Pt 3)``, ``12 Suppl 3``, ``12;3``.
_VOLUME_AND_PART = r"^\s*(\d+)\s*(?:;|\(?\s*(?:Pt|Suppl)\s)\s*(\d+)\s*\)?\s*$"


def _note(fields: tuple[str, ...], before: list[Column], after: list[Column], message: str) -> Column:
    return F.array(F.struct(
        F.array(*map(F.lit, fields)).alias("fields"), F.array(*[c.cast("string") for c in before]).alias("original"),
        F.array(*[c.cast("string") for c in after]).alias("corrected"), F.lit(message).alias("message"),
    ))


def _correct(df: DataFrame, when: Column, fields: tuple[str, ...], after: list[Column], message: str) -> DataFrame:
    """Replaces the fields where ``when`` holds and notes it."""
    before = [F.col(f) for f in fields]
    when = F.coalesce(when, F.lit(False))
    note = F.when(when, F.concat("errors", _note(fields, before, after, message))).otherwise(F.col("errors"))
    return df.withColumns({"errors": note} | {f: F.when(when, a).otherwise(F.col(f)) for f, a in zip(fields, after, strict=True)})


def _audited(df: DataFrame) -> DataFrame:
    return df if "errors" in df.columns else df.withColumn("errors", F.array().cast(AUDIT))


def sanitize_volume(df: DataFrame) -> DataFrame:
    """Splits an issue out of the volume where there is none; hyphens for minus signs, no backslashes."""
    free = F.coalesce(F.col("issue"), F.lit("")) == ""
    parts = [F.regexp_extract("volume", _VOLUME_AND_PART, i) for i in (1, 2)]
    df = _correct(_audited(df), F.col("volume").rlike(_VOLUME_AND_PART) & free, ("volume", "issue"), parts, "the volume named its issue")
    for char, good, message in (("\u2212", "-", "a minus sign stood for a hyphen"), ("\\", "", "the volume held a backslash")):
        df = _correct(df, F.contains("volume", F.lit(char)), ("volume",), [F.replace("volume", F.lit(char), F.lit(good))], message)
    return df


def sanitize_issue(df: DataFrame) -> DataFrame:
    """``Pt 2`` is 2, ``4 Pt 1`` is 4, and ``Pt 4 Pt 1`` is 4 by both corrections in turn, each with a note of its own."""
    first, second = r"^Pt\s+(.+)$", r"^(\S+)\s+Pt(?:\s.*)?$"
    df = _correct(_audited(df), F.col("issue").rlike(first), ("issue",), [F.regexp_extract("issue", first, 1)], "the issue named its part")
    return _correct(df, F.col("issue").rlike(second), ("issue",), [F.regexp_extract("issue", second, 1)], "the issue named its part")


def sanitize_doi(df: DataFrame) -> DataFrame:
    """Repairs a DOI's beginning, or drops what can't be one; the repaired value is kept."""
    df = _audited(df)
    good = repair_doi(F.col("doi"))
    df = _correct(df, good.isNotNull() & (good != F.col("doi")), ("doi",), [good], "the DOI began wrongly")
    return _correct(df, F.col("doi").isNotNull() & repair_doi(F.col("doi")).isNull(), ("doi",), [F.lit(None).cast("string")], "this can be no DOI")


def sanitize_url(df: DataFrame) -> DataFrame:
    """Addresses in normal form; a resolver's address also gives a missing DOI."""
    df = _audited(df)
    found = doi_in_url(F.col("url"))
    df = _correct(df, F.col("doi").isNull() & found.isNotNull(), ("doi",), [found], "the address named the DOI")
    good = normal_url(F.col("url"))
    df = _correct(df, good.isNotNull() & (good != F.col("url")), ("url",), [good], "the address was not in normal form")
    return _correct(df, F.col("url").isNotNull() & normal_url(F.col("url")).isNull(), ("url",), [F.lit(None).cast("string")], "this can be no address")


def sanitize_record(df: DataFrame) -> DataFrame:
    """Volume, issue, address, DOI, in this order; a column ``uri`` is the address where there is no ``url``."""
    if "uri" in df.columns:
        df = df.withColumn("url", F.coalesce("uri", *["url"] * ("url" in df.columns))).drop("uri")
    return sanitize_doi(sanitize_url(sanitize_issue(sanitize_volume(df))))
