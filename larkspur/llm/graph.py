"""Connected components over tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, spread_join, temporaries, written


def _star(e: DataFrame, rows: int, small: bool) -> DataFrame:
    """One round of large-star or small-star (Kiveris et al., 2014).  A node
    with very many neighbours is dealt out over several tasks."""
    if small:
        near = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        near = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = written(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("held")), "low")
    joined = spread_join(near, low.drop("held"), ["u"], "v", rows if small else 2 * rows, low.select("u", "held"))
    if small:
        linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    else:
        linked = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = written(linked.where("u <> v").distinct(), "edges")
    drop(low)
    return out


def _standing(e: DataFrame) -> tuple[int, int]:
    """(edges, nodes that are not yet at their place): a forest of stars has no
    node with two lesser neighbours, and no node that is both end and centre."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above"))
    centres = e.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    nodes = ends.union(centres).groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    row = nodes.agg(F.sum("below"), F.count_if((F.col("below") > 1) | ((F.col("below") == 1) & (F.col("above") == 1)))).first()
    return row[0] or 0, row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is
    its smallest node.  Self links and repeated links do no harm; no edges, no
    rows.  Alternating stars: about log n rounds, each linear in the edges,
    each kept in the shared folder, until only stars are left; nothing comes to
    the driver but two counts a round.
    """
    with temporaries() as keep:
        now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        while True:
            rows, unsettled = _standing(now)
            if not unsettled:
                break
            large = _star(now, rows, small=False)
            last, now = now, _star(large, rows, small=True)
            drop(last, large)
        return keep(written(now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components"))
