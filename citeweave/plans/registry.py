"""Where a user of the library plugs in: sources by name, readers by format, and parts of records by journal.

Everything registered is a function on DataFrames; choosing among them is left to the plan.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Reader = Callable[[DataFrame], DataFrame]
Source = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Functions by name; an unknown name is an error that tells the known ones."""

    def __init__(self, what: str):
        self.what, self.known = what, {}

    def register(self, name: str, f: Callable | None = None):
        if f is None:
            return lambda g: self.register(name, g)
        self.known[name] = f
        return f

    def __getitem__(self, name: str) -> Callable:
        if name not in self.known:
            raise KeyError(f"no {self.what} {name!r}; there are {sorted(self.known)}")
        return self.known[name]


#: Readers of records from file contents, by format.
READERS = Registry("format")
#: Sources of records, by name.
SOURCES = Registry("source")


def _defaults() -> None:
    from citeweave.sources import archives, xml

    READERS.register("article", xml.articles)
    READERS.register("preprint", xml.preprints)
    READERS.register("docsum", xml.docsums)
    SOURCES.register("articles", lambda spark, path: READERS["article"](archives.binary_files(spark, path, "*.nxml", archives.MOST_BYTES)))
    SOURCES.register("article_archives", lambda spark, path: READERS["article"](archives.tar_members(archives.binary_files(spark, path, "*.tar*"), (".nxml", ".xml"))))
    SOURCES.register("preprints", lambda spark, path: READERS["preprint"](archives.binary_files(spark, path, "*.xml")))
    SOURCES.register("docsums", lambda spark, path: READERS["docsum"](archives.binary_files(spark, path, "*.xml")))


_defaults()


def read(spark: SparkSession, source: str, path: str) -> DataFrame:
    """A source's records."""
    return SOURCES[source](spark, path)


def _glob(pattern: str) -> str:
    """A pattern with ``*`` as an anchored expression; every other character stands for itself."""
    return "(?s)^" + ".*".join(re.escape(part) for part in pattern.split("*")) + "$"


class Components:
    """Columns of a record, each from the provider that weighs most for the record's journal.

    A provider is for one journal, for journals that a pattern with ``*`` fits, or for all
    (``*``); each component needs one for all, the fallback. A result says where it came from.
    """

    def __init__(self) -> None:
        self.known: dict[str, list[tuple[float, str, str, Column]]] = {}

    def register(self, component: str, value: Column, journals: str = "*", weight: float = 1.0, name: str | None = None) -> None:
        self.known.setdefault(component, []).append((weight, journals, name or journals, value))

    def dispatch(self, df: DataFrame, journal: str, components: list[str]) -> DataFrame:
        """``df`` with a column for each component and one, ``<component>_by``, that names its provider.

        Of providers that weigh the same the one of the longest pattern goes first; one that
        gives null leaves the component to the next.
        """
        for c in components:
            ranked = sorted(self.known.get(c, ()), key=lambda p: (-p[0], -len(p[1]), p[2]))
            if not any(p[1] == "*" for p in ranked):
                raise ValueError(f"component {c!r} has no fallback")
            given = [F.when(F.coalesce(F.col(journal), F.lit("")).rlike(_glob(pattern)) & value.isNotNull(), F.struct(value.cast("string").alias("v"), F.lit(name).alias("by"))) for _, pattern, name, value in ranked]
            df = df.withColumn("_given", F.coalesce(*given)).withColumns({c: F.col("_given.v"), f"{c}_by": F.col("_given.by")}).drop("_given")
        return df


def candidates(matchers: list[Callable[[DataFrame, DataFrame], DataFrame]], left: DataFrame, right: DataFrame) -> DataFrame:
    """The pairs that any of several matching functions finds, each once; all give the same columns."""
    return reduce(DataFrame.unionByName, [m(left, right) for m in matchers]).distinct()


def first_found(lookups: list[Callable[[DataFrame], DataFrame]], rows: DataFrame, key: str) -> DataFrame:
    """(key, found, step): what the first lookup that knows a row gives; a row that one settles isn't asked of the next.

    A lookup takes rows and gives (key, found).
    """
    out, left = None, rows
    for i, lookup in enumerate(lookups):
        got = lookup(left).where("found IS NOT NULL").groupBy(key).agg(F.min("found").alias("found")).withColumn("step", F.lit(i))
        out = got if out is None else out.unionByName(got)
        left = left.join(got.select(key), key, "left_anti")
    return out


def combined(records: DataFrame, key: str, fields: list[str], methods: dict[str, Callable[[str], Column]], default: Callable[[str], Column]) -> DataFrame:
    """One row a group, each field by its own aggregate, or by the default one."""
    return records.groupBy(key).agg(*[methods.get(f, default)(f).alias(f) for f in fields])


def most_frequent(field: str) -> Column:
    return F.mode(F.col(field), deterministic=True)


def after_search(result, *steps: Callable):
    """A search's result through a user's own steps, each of which takes and gives one: extra facets, marks, a shorter list."""
    return reduce(lambda r, step: step(r), steps, result)
