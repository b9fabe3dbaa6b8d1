"""Range and nearest-neighbour joins of strings under any metric, by distances to pivots.

Every string is measured against a fixed number of pivots and belongs to the cell of its nearest
one. By the triangle inequality, a string within ``eps`` of a member of another cell is at most
``2 * eps`` closer to its own pivot than to that cell's, and lies within ``eps`` of the cell's
ball; only such strings visit the cell. There, members and visitors whose distances to the pivot
differ by more than ``eps`` are passed over without being measured.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coterie.functions.hashing import md5_int
from coterie.operators.heavy_join import heavy_join
from coterie.operators.lineage import cut

PIVOTS = 24

Measure = Callable[[Column, Column], Column]


def _placed(points: DataFrame, measure: Measure, n_pivots: int) -> tuple[DataFrame, int]:
    """``points`` with ``away``, the distances to all pivots, and ``home``, the nearest one's place.

    The pivots are the strings of smallest hash, at most ``n_pivots``.
    """
    order = md5_int(F.concat(F.lit("pivot:"), "title"))
    pivots = [r["title"] for r in points.select("title").distinct().orderBy(order, "title").limit(n_pivots).collect()]
    away = F.array(*[measure(F.col("title"), F.lit(pivot)) for pivot in pivots]).cast("array<int>")
    placed = points.withColumn("away", away)
    home = F.array_position("away", F.array_min("away")).cast("int")
    return cut(placed.withColumn("home", home)), len(pivots)


def _visits(placed: DataFrame, reach: Column, n_pivots: int, radii: dict[int, int]) -> DataFrame:
    """One row for each cell that a string within ``reach`` of the string may be a member of."""
    own = F.array_min("away")
    cells = [
        F.struct(F.lit(cell).alias("cell"), F.col("away")[cell - 1].alias("from_pivot"))
        for cell in range(1, n_pivots + 1)
        if cell in radii
    ]
    ball = F.array(*[F.lit(radii.get(cell, -1)) for cell in range(1, n_pivots + 1)])
    near = F.filter(
        F.array(*cells),
        lambda c: (c["from_pivot"] - own <= 2 * reach)
        & (c["from_pivot"] <= F.get(ball, c["cell"] - 1) + reach),
    )
    return placed.withColumn("reach", reach).select("*", F.inline(near))


def _radii(placed: DataFrame) -> dict[int, int]:
    """The largest distance of a member of each cell to its pivot; one entry a pivot at most."""
    found = placed.groupBy("home").agg(F.max(F.array_min("away")).alias("radius"))
    return {row["home"]: row["radius"] for row in found.collect()}


def _members(placed: DataFrame) -> DataFrame:
    return placed.select(
        F.col("home").alias("cell"),
        F.col("title").alias("member"),
        F.array_min("away").alias("member_from"),
    )


def metric_pairs(
    titles: DataFrame, eps: int, measure: Measure, apart: str | None = None, n_pivots: int = PIVOTS
) -> DataFrame:
    """All pairs of different titles within ``eps``: (title_a, title_b, distance), title_a smaller.

    ``measure`` must be a metric. With ``apart``, only the pairs that differ in that column.
    """
    side = (F.lit(None).cast("string") if apart is None else F.col(apart)).alias("side")
    points = cut(titles.select("title", side).where("title IS NOT NULL").distinct())
    placed, n_pivots = _placed(points, measure, n_pivots)
    radii = _radii(placed)
    if not radii:
        return titles.sparkSession.createDataFrame([], "title_a string, title_b string, distance int")
    visits = _visits(placed, F.lit(eps), n_pivots, radii).select(
        "cell", "title", "from_pivot", F.col("home").alias("visitor_home"), F.col("side").alias("visitor_side")
    )
    members = placed.select(
        F.col("home").alias("cell"),
        F.col("title").alias("member"),
        F.array_min("away").alias("member_from"),
        "side",
    )
    # of the two cells where a pair of different cells could meet, the one of the larger number
    once = (F.col("visitor_home") < F.col("cell")) | (
        (F.col("visitor_home") == F.col("cell")) & (F.col("title") < F.col("member"))
    )
    if apart is not None:
        once &= ~F.col("side").eqNullSafe(F.col("visitor_side"))
    return (
        heavy_join(members, visits, ["cell"], "member", "title")
        .where(once & (F.abs(F.col("from_pivot") - F.col("member_from")) <= eps))
        .select(
            F.least("title", "member").alias("title_a"),
            F.greatest("title", "member").alias("title_b"),
            measure(F.col("title"), F.col("member")).alias("distance"),
        )
        .where(F.col("distance") <= eps)
    )


def nearest_titles(
    titles: DataFrame, k: int, measure: Measure, n_pivots: int = PIVOTS
) -> DataFrame:
    """(title, rank, neighbour, distance): the ``k`` nearest other titles, ties to the smaller.

    How far a title must look is bounded without measuring pairs: by way of a pivot, the members
    nearest to it are at most both distances away, and ``k`` of them suffice.
    """
    points = cut(titles.select("title").where("title IS NOT NULL").distinct())
    placed, n_pivots = _placed(points, measure, n_pivots)
    radii = _radii(placed)
    if not radii:
        return titles.sparkSession.createDataFrame(
            [], "title string, rank int, neighbour string, distance int"
        )
    order = Window.partitionBy("home").orderBy(F.array_min("away"), "title")
    first = (
        placed.select("home", "title", "away", F.row_number().over(order).alias("rank"))
        .where(F.col("rank") <= k + 1)
        .groupBy("home")
        .agg(F.collect_list(F.array_min("away")).alias("distances"))
    )
    listed = {row["home"]: sorted(row["distances"]) for row in first.collect()}  # k + 1 a pivot
    by_way = F.array(*[F.lit(d) + F.col("away")[cell - 1] for cell in sorted(listed) for d in listed[cell]])
    # itself and k others; all titles where there are not that many
    bounds = F.array_sort(by_way)
    reach = F.coalesce(F.get(bounds, F.lit(k)), F.lit(2**29))
    visits = _visits(placed, reach, n_pivots, radii).select("cell", "title", "from_pivot", "reach")
    met = (
        heavy_join(_members(placed), visits, ["cell"], "member", "title")
        .where(F.col("title") != F.col("member"))
        .where(F.abs(F.col("from_pivot") - F.col("member_from")) <= F.col("reach"))
        .select(
            "title",
            F.col("member").alias("neighbour"),
            measure(F.col("title"), F.col("member")).alias("distance"),
        )
    )
    best = Window.partitionBy("title").orderBy("distance", "neighbour")
    return (
        met.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("title", "rank", "neighbour", "distance")
    )
