"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainflow.llm.common import materialize


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) of each node on an edge (a, b); root is the least node of its component.

    Each step keeps at most as many edges as before and joins them to one minimum for each node,
    a join that Spark splits at hot nodes; steps are written, so lineage doesn't grow. Loops and
    null ends are dropped; repeated edges count once. No edge reaches the driver."""

    def stars(sym: DataFrame, only_less: bool) -> DataFrame:
        near = sym.filter("v < u") if only_less else sym
        least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
        met = near.join(least, F.col("u") == F.col("_u"))
        if only_less:
            out = met.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("_u").alias("u"), F.col("m").alias("v")))
        else:
            out = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.filter("u <> v").distinct()

    def both(one_way: DataFrame) -> DataFrame:
        return one_way.union(one_way.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def is_done(one_way: DataFrame) -> bool:
        """Every node has one lesser neighbour, or is the centre of others: all are stars."""
        ends = one_way.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(one_way.select("v", F.lit(0), F.lit(1)))
        roles = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
        return roles.filter("below > 1 or (below = 1 and above = 1)").limit(1).count() == 0

    clean = edges.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = materialize(clean, label)
    while not is_done(now):
        now = materialize(stars(both(stars(both(now), False)), True), label)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
