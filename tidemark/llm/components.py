"""Connected components of a distributed graph, by alternating large and small stars."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import scratch_path, shuffles_dropped

_PLACES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage with a copy that outlives executors.

    What the write shuffled is dropped with its end; :func:`removed` drops the copy.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    kept = df.sparkSession.read.parquet(path)
    _PLACES[kept] = path
    return kept


def removed(*tables: DataFrame) -> None:
    """Drop copies that :func:`stored` returned; whatever was built on them has to be stored itself."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(_PLACES.pop(table))
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def _stored_edges(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, and a mark by which to see whether they changed; it is taken while writing."""
    seen = Observation()
    kept = stored(edges.observe(seen, F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")), "edges")
    return kept, (seen.get["n"], seen.get["x"])


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for the ends of ``links`` (columns ``u``, ``v``); lone nodes are left out. It is stored.

    Every round shuffles the edges a fixed number of times and keeps at most as many of them. Minima are pre-aggregated; the joins
    that hand them out are keyed by node, and a node with very many edges is split by the skew join.
    """
    edges, mark = _stored_edges(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.withColumnRenamed("m", "v"))
        before, earlier = mark, edges
        edges, mark = _stored_edges(small.distinct())
        removed(earlier)
        if mark == before:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            found = stored(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), "components")
            removed(edges)
            return found
