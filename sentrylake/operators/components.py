"""Connected components of an edge table, as a DataFrame loop."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sentrylake.operators.ranking import NARROW_ROWS, join_hot
from sentrylake.session import materialise


def _round(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written out, and their number and checksum, observed while writing."""
    seen = Observation()
    kept = materialise(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo") % F.lit(1 << 40)).alias("sum")), "cc")
    return kept, (seen.get["n"], seen.get["sum"])


def connected_components(edges: DataFrame, left: str = "src", right: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that an edge touches; component is the least node reachable.

    Alternates the two star contractions: first every node hands its larger neighbours to its least
    neighbour, then every node hands its smaller ones to it. Each round is two aggregations, combined
    before the shuffle, and two joins on the node; nodes of more than a thousandth of the edges, so at
    most a thousand, are broadcast (``join_hot``) and their edges stay where they are, so no hub of more
    than NARROW_ROWS edges is gathered in one task. The edge set is written to the shared folder each round; it shrinks to a star
    per component.
    Rows with a null end and self-loops add nodes but no links. Nodes may be numbers or strings.
    """
    both = materialise(edges.select(F.col(left).alias("a"), F.col(right).alias("b")), "edges")
    nodes = both.select(F.col("a").alias("node")).union(both.select("b")).where("node IS NOT NULL").distinct()
    work = (
        both.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )
    work, before = _round(work)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        # large star: u's larger neighbours are handed to the least of u's closed neighbourhood
        sym = work.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            work.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        degree = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("c"))
        met = join_hot(sym.where("v > u"), degree, "u", "c", 2 * before[0], bound=NARROW_ROWS)
        large = met.where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        # small star: u and its smaller neighbours are handed to the least of them
        down = large.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("c"))
        small = (
            join_hot(large, down, "hi", "c", before[0], bound=NARROW_ROWS)
            .select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
            .select("e.*")
            .where("hi <> lo")
            .distinct()
        )
        work, after = _round(small)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("connected components did not settle")
    # an edge set that has settled is stars: each node hangs on one centre
    labels = work.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component"))
    return nodes.join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
