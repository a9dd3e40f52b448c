"""Connected components by alternating large-star and small-star steps.

First each task replaces its own edges by stars around the least node of what
they connect, twice with a shuffle between; small components are mostly whole
after that. The shuffle is by the larger
node, which has at most a row from each task, not by the centre of a star.
What is left is at most an edge for each node and task; if that is no more than
``LAST`` edges, one task connects them (a bound of memory that holds at every
size). Else rounds follow, few, of an aggregation and a join on node ids each, so
no larger graph is ever gathered in one task; edges are written to the shared folder after each round.
The number of rounds grows with the logarithm of the graph's diameter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import arrow_map, materialise

#: Edges that a task contracts at a time.
CONTRACT = 1 << 20
#: Edges that one task may connect to the end.
LAST = 1 << 17


def _stars(batches: Iterator[pa.RecordBatch], most: int = CONTRACT, centres: bool = False) -> Iterator[pa.RecordBatch]:
    """Stars around the least nodes of what a task's edges connect, ``most`` or so
    at a time; with ``centres`` these too, as linked with themselves."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    def stars() -> pa.RecordBatch:
        pairs = [(x, r) for x in root if (r := find(x)) != x or centres]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["u", "v"])

    seen = 0
    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            u, v = find(u), find(v)
            if u != v:
                root[max(u, v)] = min(u, v)
        seen += batch.num_rows
        if seen >= most:
            yield stars()
            root.clear()
            seen = 0
    yield stars()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of one task's edges with the least that it is connected with."""
    return _stars(batches, LAST + 1, centres=True)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("_u")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.where("v > u").join(least, F.col("u") == F.col("_u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
    linked = down.join(least, F.col("u") == F.col("_u")).select(F.explode(F.array("u", "v")).alias("u"),
                                                                F.col("m").alias("v"))
    return linked.where("u <> v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour or none, which itself has none."""
    none = F.lit(None).cast("long")
    ends = (edges.select(F.col("u").alias("node"), F.col("v").alias("up"), F.lit(False).alias("centre"))
            .unionByName(edges.select(F.col("v").alias("node"), none.alias("up"), F.lit(True).alias("centre"))))
    nodes = ends.groupBy("node").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.max("centre").alias("centre"))
    return nodes.where("low <> high or (centre and high is not null)").isEmpty()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(``node``, ``component``) for the nodes of edges (``u``, ``v``).

    The component is its least node; nodes that are linked with nothing but
    themselves are not in the result.
    """
    edges = arrow_map(edges.select("u", "v").where("u <> v"), _stars, "u bigint, v bigint")
    edges = materialise(arrow_map(edges.repartition("u"), _stars, "u bigint, v bigint"), name)
    if edges.count() <= LAST:
        return arrow_map(edges.coalesce(1), _whole, "u bigint, v bigint").toDF("node", "component")
    while not _are_stars(edges):
        edges = materialise(_small_star(_large_star(edges)), name)
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
