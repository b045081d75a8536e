"""Writers: tables, delimited lines, JSON batches, quads and GraphML."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.functions.text import clean_field
from citeweave.operators import rdf


def pipe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows as lines of fields between pipes; nulls are empty."""
    return df.select(F.concat_ws("|", *[F.coalesce(clean_field(F.col(c).cast("string")), F.lit("")) for c in columns]).alias("value"))


def write_pipe_text(df: DataFrame, columns: list[str], path: str) -> None:
    pipe_text(df, columns).write.mode("overwrite").text(path)


def write_json_batches(df: DataFrame, path: str, rows: int = 10_000) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).json(path)


def write_table(df: DataFrame, path: str, partition: list[str] | None = None) -> None:
    (df.write.mode("overwrite").partitionBy(*partition) if partition else df.write.mode("overwrite")).parquet(path)


def trimmed(df: DataFrame, lengths: dict[str, int]) -> DataFrame:
    """Texts cut to what a fixed-width table can hold."""
    return df.withColumns({c: F.substring(c, 1, n) for c, n in lengths.items()})


def write_quads(df: DataFrame, path: str) -> None:
    rdf.lines(df).write.mode("overwrite").option("compression", "gzip").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Rows of texts and numbers as CSV with a header; quotes inside a field are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def ensured(spark, name: str, schema: str, rebuild: bool = False) -> DataFrame:
    """A table of the shared warehouse, made if it isn't there; ``rebuild`` empties it first. Another schema is an error."""
    if rebuild:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet")
    found = spark.table(name)
    if [(f.name, f.dataType) for f in found.schema] != [(f.name, f.dataType) for f in spark.createDataFrame([], schema).schema]:
        raise ValueError(f"table {name} has another schema")
    return found


def once(df: DataFrame, key: str, *order) -> DataFrame:
    """One row for each key, the first in the order given; a scan by pages without an order could give a row twice or never."""
    from citeweave.operators.windows import first_by

    return first_by(df, key, *(order or (key,)))


_KINDS = {"string": "string", "int": "int", "bigint": "long", "double": "double", "boolean": "boolean"}


def _xml(c):
    out = c.cast("string")
    for char, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(char), F.lit(code))
    return out


def graphml(nodes: DataFrame, edges: DataFrame, node: str, src: str, dst: str, directed: bool = True) -> DataFrame:
    """(part, value): the lines of a GraphML file; part 0 is the head, 1 nodes, 2 edges, 3 the end."""
    spark = nodes.sparkSession

    def data(df: DataFrame, prefix: str, skip: tuple[str, ...]):
        cols = [(c, t) for c, t in df.dtypes if c not in skip and t in _KINDS]
        keys = [f'<key id="{prefix}_{c}" for="{"node" if prefix == "n" else "edge"}" attr.name="{c}" attr.type="{_KINDS[t]}"/>' for c, t in cols]
        return keys, F.concat_ws("", *[F.when(F.col(c).isNotNull(), F.concat(F.lit(f'<data key="{prefix}_{c}">'), _xml(F.col(c)), F.lit("</data>"))) for c, _ in cols], F.lit(""))

    node_keys, node_data = data(nodes, "n", (node,))
    edge_keys, edge_data = data(edges, "e", (src, dst))
    head = ["<?xml version=\"1.0\" encoding=\"UTF-8\"?>", '<graphml xmlns="http://graphml.graphdrawing.org/xmlns">', *node_keys, *edge_keys, f'<graph edgedefault="{"directed" if directed else "undirected"}">']
    first = spark.createDataFrame([(0, "\n".join(head))], "part int, value string")
    last = spark.createDataFrame([(3, "</graph></graphml>")], "part int, value string")
    n = nodes.select(F.lit(1).alias("part"), F.concat(F.lit('<node id="'), _xml(F.col(node)), F.lit('">'), node_data, F.lit("</node>")).alias("value"))
    e = edges.select(F.lit(2).alias("part"), F.concat(F.lit('<edge source="'), _xml(F.col(src)), F.lit('" target="'), _xml(F.col(dst)), F.lit('">'), edge_data, F.lit("</edge>")).alias("value"))
    return first.unionByName(n).unionByName(e).unionByName(last)


def read_graphml(df: DataFrame, content: str = "content") -> tuple[DataFrame, DataFrame]:
    """nodes(id, data), edges(src, dst, data) of GraphML texts; an undirected edge goes both ways."""
    import xml.etree.ElementTree as ET

    import pandas as pd

    schema = "is_edge boolean, id string, src string, dst string, data map<string,string>"

    def run(batches):
        for pdf in batches:
            rows = []
            for text in pdf["c"]:
                tree = ET.fromstring(text)
                tag = lambda e: e.tag.rpartition("}")[2]
                names = {k.get("id"): k.get("attr.name") for k in tree.iter() if tag(k) == "key"}
                for g in (e for e in tree.iter() if tag(e) == "graph"):
                    both = g.get("edgedefault") == "undirected"
                    for e in g:
                        values = {names.get(d.get("key"), d.get("key")): d.text or "" for d in e if tag(d) == "data"}
                        if tag(e) == "node":
                            rows.append((False, e.get("id"), None, None, values))
                        elif tag(e) == "edge":
                            rows.append((True, None, e.get("source"), e.get("target"), values))
                            if both:
                                rows.append((True, None, e.get("target"), e.get("source"), values))
            yield pd.DataFrame(rows, columns=["is_edge", "id", "src", "dst", "data"])

    rows = df.select(F.col(content).cast("string").alias("c")).mapInPandas(run, schema)
    return rows.where("NOT is_edge").select("id", "data"), rows.where("is_edge").select("src", "dst", "data")
