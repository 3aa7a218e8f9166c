"""Connected components of a link table, as joins and grouped minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.session import stage


def _toward_minimum(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star step: every node's neighbours are linked to the smallest node among them and itself.

    ``larger_only`` takes each edge from both ends and moves only neighbours larger than the node
    (large-star); otherwise an edge counts at its larger end (small-star).
    """
    if larger_only:
        sides = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
    else:
        sides = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    least = sides.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("low"))
    moved = sides.join(least, "node")
    if larger_only:
        out = moved.where(F.col("other") > F.col("node")).select(F.col("other").alias("a"), F.col("low").alias("b"))
    else:
        out = moved.select(F.col("other").alias("a"), F.col("low").alias("b")).unionAll(
            least.select(F.col("node").alias("a"), F.col("low").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): every linked node with the smallest node it can reach.

    Alternating large-star and small-star steps; each round is written to the shared folder, so the
    lineage stays short and a lost executor re-reads files. Ends when a round changes nothing.
    Groups never meet in one task: minima are pre-aggregated, and the join's hot keys are split by AQE.
    Self links and NULL ends are ignored.
    """
    edges = stage(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where("a <> b")
        .distinct(),
        "links",
    )

    def signature(df: DataFrame):
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row.n, row.h

    before = signature(edges)
    if before[0]:
        for _ in range(max_rounds):
            edges = stage(_toward_minimum(_toward_minimum(edges, True), False), "links")
            after = signature(edges)
            if after == before:
                break
            before = after
        else:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # Settled edges are stars: node -> smallest node of its component.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
