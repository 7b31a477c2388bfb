"""Connected components of a table of links, on DataFrames alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.tables import discard, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of a link; the component is its smallest node.

    Each round every node that has a smaller neighbour points to the smallest of them, pointers are
    followed to their ends by doubling, and links are drawn anew between the ends. Nodes without a
    smaller neighbour remain, at most half of those with links. All aggregates combine before
    their shuffle, and every round's tables are stored. Links with a null end and loops connect
    nothing; repeated links count once; no links give no rows.
    """
    spark = links.sparkSession
    links = stored(_ordered(links.select(F.col(a).alias("x"), F.col(b).alias("y"))), "links")
    ends = links.select(F.col("low").alias("node")).union(links.select("high")).distinct()
    labels = stored(ends.select("node", F.col("node").alias("component")), "labels")
    while not links.isEmpty():
        pointers = _followed(stored(
            links.groupBy(F.col("high").alias("from")).agg(F.min("low").alias("to")), "pointers"))
        labels, old = stored(_moved(labels, "component", pointers), "labels"), labels
        discard(spark, old)
        drawn = _moved(_moved(links, "low", pointers), "high", pointers)
        links, old = stored(_ordered(drawn.toDF("x", "y")), "links"), links
        discard(spark, old)
        discard(spark, pointers)
    return labels


def _ordered(links: DataFrame) -> DataFrame:
    return links.filter("x <> y").select(
        F.least("x", "y").alias("low"), F.greatest("x", "y").alias("high")).distinct()


def _moved(rows: DataFrame, column: str, pointers: DataFrame) -> DataFrame:
    """The rows with ``column`` replaced by where it points, if anywhere."""
    moved = rows.join(pointers, rows[column] == pointers["from"], "left")
    return moved.select(*[
        F.coalesce("to", rows[c]).alias(c) if c == column else rows[c] for c in rows.columns])


def _followed(pointers: DataFrame) -> DataFrame:
    """Each pointer moved on until it ends where no pointer starts."""
    spark = pointers.sparkSession
    while True:
        on = pointers.select(F.col("from").alias("to"), F.col("to").alias("further"))
        if pointers.join(on, "to", "left_semi").isEmpty():
            return pointers
        next_ = stored(pointers.join(on, "to", "left").select(
            "from", F.coalesce("further", "to").alias("to")), "pointers")
        discard(spark, pointers)
        pointers = next_
