"""Equi joins that stay balanced when a key is hot on both sides.

A mergeable sketch of frequent items, kept per task and merged in two steps, names the keys that
hold more than a tile of either side and about how many rows they have. The rows of such a key are
cut into tiles on both sides, and every tile of one side meets every tile of the other in a cell of
its own, so that a key's pairs spread over as many tasks as it has cells.
"""

from dataclasses import dataclass
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# rows of a side that stay together whatever the number of tasks
LEAST_TILE = 512
# cells of a key that holds all rows, for each task: enough that dealing them by hash is even
CELLS_PER_TASK = 32
TRACKED_PER_TILE = 16
MERGERS = 64


@dataclass
class Frequent:
    """``n_rows`` of a table, and the counts of its frequent keys by key hash (upper bounds)."""

    n_rows: int
    counts: dict[int, int]


def _key(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def tiles_of_all(tasks: int) -> int:
    """Tiles of a key that holds all rows of a side."""
    return ceil(sqrt(CELLS_PER_TASK * tasks))


def frequent_keys(tables: list[DataFrame], keys: list[str], tiles: int) -> list[Frequent]:
    """For each table the keys that may hold more than one of ``tiles`` equal parts of its rows.

    A key with fewer rows than half a part is left out, so at most ``2 * tiles`` are named. All
    tables are read in one job, each to count and to sketch its keys; no row is shuffled.
    """
    tracked = 1 << (TRACKED_PER_TILE * tiles - 1).bit_length()
    every = None
    for number, table in enumerate(tables):
        part = table.select(F.lit(number).alias("table"), _key(keys).alias("key"))
        every = part if every is None else every.unionAll(part)
    merger = F.pmod(F.spark_partition_id(), F.lit(MERGERS))
    sketched = every.groupBy("table", merger.alias("merger")).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k_accumulate(key, {tracked})").alias("sketch"),
    )
    merged = sketched.groupBy("table").agg(
        F.sum("n").alias("n"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {2 * tiles})")
        .alias("top"),
    )
    found = [Frequent(0, {}) for _ in tables]
    for row in merged.collect():  # one row a table, 2 * tiles entries at most
        least = row["n"] / tiles / 2
        counts = {top["item"]: top["count"] for top in row["top"] if top["count"] > least}
        found[row["table"]] = Frequent(row["n"], counts)
    return found


def cells_per_key(left: Frequent, right: Frequent, tiles: int) -> dict[int, tuple[int, int]]:
    """Key hash to the numbers of tiles of both sides, for keys with more than one cell."""
    tile_left = max(LEAST_TILE, left.n_rows / tiles)
    tile_right = max(LEAST_TILE, right.n_rows / tiles)
    cells = {}
    for key in left.counts.keys() | right.counts.keys():
        rows = ceil(left.counts.get(key, 1) / tile_left), ceil(right.counts.get(key, 1) / tile_right)
        if max(rows) > 1:
            cells[key] = rows
    return cells


def heavy_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_by: str, right_by: str
) -> DataFrame:
    """Inner join on ``keys``, any of which may be hot on both sides.

    ``left_by`` and ``right_by`` name columns that tell a hot key's rows apart; their hashes deal
    rows to tiles, so a recomputed task deals the same. Rows with a null key meet nothing. Both
    sides are evaluated once more for the sketches, so they should be tables or cheap to derive.
    """
    left, right = left.dropna(subset=keys), right.dropna(subset=keys)
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = tiles_of_all(tasks)
    cells = cells_per_key(*frequent_keys([left, right], keys, tiles), tiles)
    if not cells:
        return left.join(right, keys)
    hot = left.sparkSession.createDataFrame(
        [(key, *rows) for key, rows in cells.items()], "_key bigint, _rows int, _columns int"
    )

    def placed(side: DataFrame, by: str, own: str, other: str, own_place: str, other_place: str):
        # at most 4 * tiles keys are broadcast, a number that the tasks fix
        marked = side.withColumn("_key", _key(keys)).join(F.broadcast(hot), "_key", "left")
        place = F.pmod(F.xxhash64(F.lit(own_place), by), F.coalesce(own, F.lit(1)))
        every = F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)
        return marked.select(
            *side.columns, place.cast("int").alias(own_place), F.explode(every).alias(other_place)
        )

    rows = placed(left, left_by, "_rows", "_columns", "_row", "_column")
    columns = placed(right, right_by, "_columns", "_rows", "_column", "_row")
    return rows.join(columns, [*keys, "_row", "_column"]).drop("_row", "_column")
