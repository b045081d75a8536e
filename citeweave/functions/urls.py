"""Addresses in normal form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_url(s: Column) -> Column:
    """Lower-case scheme and host, ``http`` where there is no scheme, digits only in the port, a path, no stray marks.

    Null if what is left has no host.
    """
    u = F.regexp_replace(F.trim(s), r"^[\s\[(<]+|[\s\])>.,;]+$", "")
    u = F.translate(u, "‐‑‒–−∼˜ ", "-----~~ ")
    u = F.regexp_replace(u, r"\s+", "")
    u = F.regexp_replace(u, r"^(?i)(https?://)+(?=https?://)", "")
    u = F.when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), u).otherwise(F.concat(F.lit("http://"), u))
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.regexp_replace(F.lower(F.regexp_extract(u, r"://([^/?#:]*)", 1)), r"\.+$", "")
    port = F.regexp_extract(u, r"://[^/?#:]*:(\d+)", 1)
    rest = F.regexp_extract(u, r"://[^/?#]*(.*)$", 1)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    out = F.concat(scheme, F.lit("://"), host, F.when(port != "", F.concat(F.lit(":"), port)).otherwise(F.lit("")), rest)
    return F.when(host != "", out)


def doi_in_url(s: Column) -> Column:
    """The DOI that a resolver's address stands for."""
    return F.nullif(F.regexp_extract(s, r"(?i)^(?:https?://)?(?:dx\.)?doi\.org/(?:doi:)?(10\.\d{4,}/.+)$", 1), F.lit(""))


def host_of(s: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(s, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1), F.lit("")))
