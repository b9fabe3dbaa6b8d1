"""Connected components of an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coterie.operators.lineage import cut
from coterie.operators.skew import salted_join


def _fingerprint(pairs: DataFrame):
    return tuple(
        pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "target"))).first()
    )


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): each vertex with the smallest id it is connected to.

    ``vertices`` has ``id``, ``edges`` has ``a`` and ``b``. Alternates the large-star and
    small-star steps, which need about log(n) rounds whatever the diameter. Neighbours are never
    collected: each step is a minimum per node and a join back to it, salted because the centre
    of a large component meets all its members.
    """
    smaller, larger = F.least("a", "b"), F.greatest("a", "b")
    pairs = cut(
        edges.where(F.col("a") != F.col("b"))
        .select(larger.alias("node"), smaller.alias("target"))
        .distinct()
    )
    before = None
    now = _fingerprint(pairs)
    while now != before:
        both = pairs.unionByName(
            pairs.select(F.col("target").alias("node"), F.col("node").alias("target"))
        )
        lowest = both.groupBy("node").agg(F.min("target").alias("lowest"))
        lowest = lowest.select("node", F.least("node", "lowest").alias("lowest"))
        large = (
            salted_join(both, lowest, ["node"], "target")
            .where(F.col("target") > F.col("node"))
            .select(F.col("target").alias("node"), F.col("lowest").alias("target"))
            .distinct()
        )
        lowest = large.groupBy("node").agg(F.min("target").alias("lowest"))
        links = F.array(
            F.struct(F.col("node").alias("node"), F.col("lowest").alias("target")),
            F.struct(F.col("target").alias("node"), F.col("lowest").alias("target")),
        )
        pairs = cut(
            salted_join(large, lowest, ["node"], "target")
            .select(F.inline(links))
            .where(F.col("node") != F.col("target"))
            .distinct()
        )
        before, now = now, _fingerprint(pairs)
    found = pairs.select(F.col("node").alias("id"), F.col("target").alias("component"))
    return vertices.join(found, "id", "left").select(
        "id", F.coalesce("component", "id").alias("component")
    )
