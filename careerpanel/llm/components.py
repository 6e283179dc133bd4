"""Connected components of a graph of links, by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerpanel.sources.staging import stage

#: Rows of a task that writes a small table; without that a table of a few rows is written by as many tasks as a large one.
ROWS = 10_000


def _few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most so many rows, in no more tasks than they are worth. Large tables stay as they are dealt."""
    return df.coalesce(rows // ROWS + 8)


def _placed(node: str) -> Column:
    """Nodes compare by hash: in an order that has nothing to do with the links, so a chain of ascending nodes shrinks as any other."""
    return F.struct(F.xxhash64(node).alias("h"), F.col(node).alias("node"))


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (u, v): ``label`` is the least node that can be reached.

    In turns every node goes over into the first of its neighbours and itself, by hash, and the links into links
    between what their ends went over into, each once, until none is left. So a star is gone after two rounds, a
    chain loses half of its nodes in each, and later rounds work on what is left only. Then the rounds are read backwards. First nodes
    are aggregates, written before they are joined with the links (Spark can then split a hot node), so a node with
    any number of links stays spread out.
    """
    turns: list[tuple[DataFrame, int]] = []
    links = stage(links.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    while rows := links.count():
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = both.groupBy("u").agg(F.min(_placed("v")).alias("first"))
        first = first.select(F.col("u").alias("node"), F.least("first", _placed("u"))["node"].alias("label"))
        first = stage(_few(first, 2 * rows), "first")
        turns.append((first, 2 * rows))
        a, b = (first.select(F.col("node").alias(x), F.col("label").alias(y)) for x, y in (("u", "a"), ("v", "b")))
        onward = links.join(a, "u").join(b, "v").where("a <> b")
        links = stage(_few(onward.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), rows), "links")
    if not turns:
        return links.select(F.col("u").alias("node"), F.col("v").alias("label"))
    named, rows = turns.pop()
    while turns:
        later = named.select(F.col("node").alias("label"), F.col("label").alias("last"))
        named, rows = turns.pop()
        named = named.join(later, "label", "left").select("node", F.coalesce("last", "label").alias("label"))
    named = stage(_few(named, rows), "named")
    least = stage(_few(named.groupBy("label").agg(F.min("node").alias("least")), rows), "least")
    return named.join(least, "label").select("node", F.col("least").alias("label"))
