"""Exact k nearest neighbours (Euclidean) without comparing all pairs.

1. **Points.** Rows with equal vectors are one point that carries its k + 1 smallest keys: however many copies a vector
   has, more of them can't be among anyone's k nearest.
2. **Cells.** Points go to the nearest of ``fan`` pivots, drawn by hash; a cell with more than ``capacity`` points draws
   pivots of its own, and so on. Points are distinct, so a cell always falls apart. A cell's pivot, radius and number of
   rows stand in one row of the tree table for each cell that was split.
3. **Own cell.** The points of one cell (at most ``capacity``) are compared; the k-th best distance so far is a bound.
4. **Other cells.** From the root down, a point meets the children of a cell: the k-th smallest of (distance + radius),
   counted by rows, tightens its bound; children whose (distance - radius) is above it are left out by the triangle
   inequality. In the cells that remain, only points whose distance to the pivot lies within the bound of the point's own
   are compared.

The work is a join on the cell at each step, so a dense region is many cells, none of them one task's. The points of a cell
meet its pivots, its children or its neighbours' points in blocks of about ``BLOCK``, as matrices (numpy); of the points of
one cell only the k + 1 nearest, ties included, go on to the ranking. How many pairs are compared depends on how well the triangle inequality separates the data: few where a few columns dominate, most of them in
many equally strong dimensions. Nothing is ever left out that could be among the nearest.

Defined results: null and NaN count as 0; equal distances go by key; a row with fewer than k others has as many neighbours
as there are; keys must be unique and not null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.hashing import hash_order
from riskframe.session import materialize

CAPACITY, FAN = 128, 64
#: Points that meet a cell's pivots, children or points as one matrix, and rows of a batch that a task returns.
BLOCK, BATCH = 256, 1 << 16
#: Rows of a table of cells that is broadcast; a larger one is joined by a shuffle.
SMALL = 1000
#: Margin of the bounds above the rounding of distances.
SLACK = 1e-9


def vector(columns: Sequence[str]) -> Column:
    return F.array(*[F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in columns])


def square_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sums of squared differences of all pairs of rows, added in the order of the columns."""
    out = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        d = x[:, j, None] - y[None, :, j]
        out += d * d
    return out


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL else df


@dataclass(frozen=True)
class Cells:
    """``points``: point, x, keys, cell, r (distance to the cell's pivot). ``levels``: for each depth a table of the cells
    split there: cell, kids (cell, x, radius, rows, open)."""

    points: DataFrame
    levels: tuple[DataFrame, ...]


def points_of(rows: DataFrame, key: str, k: int) -> DataFrame:
    """point (the smallest key), x, keys (the k + 1 smallest)."""
    first = Window.partitionBy("x").orderBy(key)
    some = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
    points = some.groupBy("x").agg(F.sort_array(F.collect_list(key)).alias("keys"))
    return points.select(F.col("keys")[0].alias("point"), "x", "keys")


def cells_of(points: DataFrame, capacity: int = CAPACITY, fan: int = FAN, seed: str = "pivot") -> Cells:
    points = materialize(points.withColumns({"cell": F.lit(""), "r": F.lit(0.0)}), "nn-points")
    levels: list[DataFrame] = []
    done = None
    while True:
        over = materialize(points.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > capacity).select("cell"), "nn-over")
        n = over.count()
        if levels:  # whether a child was split is known now
            kids = levels[-1].join(_small(over.withColumn("open", F.lit(True)), n), "cell", "left").withColumn("open", F.coalesce("open", F.lit(False)))
            kid = F.struct("cell", "x", "radius", "rows", "open")
            levels[-1] = materialize(kids.groupBy("parent").agg(F.collect_list(kid).alias("kids")).withColumnRenamed("parent", "cell"), "nn-level")
        if not n:
            return Cells(points if done is None else done.unionByName(points), tuple(levels))
        rest = points.join(_small(over, n), "cell", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        here = points.join(_small(over, n), "cell", "left_semi")
        pick = Window.partitionBy("cell").orderBy(hash_order("point", f"{seed}-{len(levels)}"), "point")
        pivots = here.withColumn("no", F.row_number().over(pick)).where(F.col("no") <= fan)
        pivots = materialize(pivots.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("no", "x"))).alias("pivots")), "nn-pivots")
        blocks = _blocks(here, n, "point", "x", "keys").join(_small(pivots.withColumnRenamed("pivots", "others"), n), "cell")
        dealt = _met(blocks, _nearest_pivot, ["rows.point", "rows.x", "rows.keys", "others.no"], {"r": "double"}, {"parent": "cell", "pivot": "others.x"})
        dealt = dealt.withColumn("cell", F.concat_ws("/", "parent", F.col("no").cast("string"))).drop("no")
        dealt = materialize(dealt, "nn-points")
        levels.append(dealt.groupBy("parent", "cell").agg(F.first("pivot").alias("x"), F.max("r").alias("radius"), F.sum(F.size("keys")).alias("rows")))
        points = dealt.drop("parent", "pivot")


def _blocks(df: DataFrame, cells: int, *fields: str) -> DataFrame:
    """cell, rows: the fields of each cell's points, in arrays of about ``BLOCK``."""
    sizes = df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_n"))
    dealt = df.join(_small(sizes, cells), "cell").withColumn("_part", F.pmod(F.xxhash64("point"), F.col("_n")))
    return dealt.groupBy("cell", "_part").agg(F.collect_list(F.struct(*fields)).alias("rows")).drop("_part")


class _Side:
    """A column of arrays of structs: where each array begins and ends, and the structs' fields end to end."""

    def __init__(self, column: pa.ListArray):
        self.start = np.asarray(column.offsets) - column.offsets[0].as_py()
        structs = column.flatten()
        self.fields = {f.name: structs.field(i) for i, f in enumerate(structs.type)}
        self.numbers = {n: v.to_numpy(zero_copy_only=False) for n, v in self.fields.items() if pa.types.is_floating(v.type) or pa.types.is_integer(v.type) or pa.types.is_boolean(v.type)}
        self.numbers["x"] = self.fields["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(structs), -1)

    def at(self, i: int) -> dict[str, np.ndarray]:
        return {n: v[self.start[i] : self.start[i + 1]] for n, v in self.numbers.items()}


def _met(blocks: DataFrame, compare: Callable, taken: Sequence[str], made: dict[str, str], named: dict[str, str] | None = None) -> DataFrame:
    """Each block's arrays ``rows`` and ``others`` compared: ``compare`` gets the numbers of both as matrices, returns the
    positions of the pairs that go on and the columns ``made``; ``taken`` and ``named`` are fields of the pair."""
    sources = {**{t.split(".")[-1]: t for t in taken}, **(named or {})}

    def of(source: str) -> T.DataType:
        column, _, field = source.partition(".")
        found = blocks.schema[column].dataType
        return found.elementType[field].dataType if field else found

    schema = T.StructType([*(T.StructField(n, of(t)) for n, t in sources.items()), *(T.StructField(n, T.DoubleType() if t == "double" else T.LongType()) for n, t in made.items())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides, found, size = {n: _Side(batch.column(n)) for n in ("rows", "others")}, [], 0
            for i in range(batch.num_rows):
                a, b, *values = compare(sides["rows"].at(i), sides["others"].at(i))
                found.append((a + sides["rows"].start[i], b + sides["others"].start[i], np.full(len(a), i), *values))
                size += len(a)
                if size >= BATCH or i + 1 == batch.num_rows:
                    a, b, i, *values = map(np.concatenate, zip(*found))
                    at = {"rows": a, "others": b}
                    columns = [sides[t.split(".")[0]].fields[t.split(".")[1]].take(pa.array(at[t.split(".")[0]])) if "." in t else batch.column(t).take(pa.array(i)) for t in sources.values()]
                    yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, values)], [*sources, *made])
                    found, size = [], 0

    return blocks.mapInArrow(task, schema)


def _nearest_pivot(rows: dict, others: dict) -> tuple:
    d2 = square_distances(rows["x"], others["x"])
    near = np.where(np.isnan(d2), np.inf, d2).argmin(axis=1)
    here = np.arange(len(near))
    return here, near, np.sqrt(d2[here, near])


def _first(d2: np.ndarray, allowed: np.ndarray, k: int) -> tuple:
    """The pairs allowed, of each row the k + 1 nearest with their ties (each stands for one row at least)."""
    if d2.shape[1] > k + 1:
        bound = np.partition(np.where(allowed, d2, np.inf), k, axis=1)[:, k]
        allowed = allowed & ~(d2 > bound[:, None])
    a, b = np.nonzero(allowed)
    return a, b, d2[a, b]


def _best(candidates: DataFrame, k: int) -> DataFrame:
    """point, best: the k + 1 nearest rows (d2, key), the point's own included."""
    by = Window.partitionBy("point").orderBy("d2", "key")
    top = candidates.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= k + 1)
    return top.groupBy("point").agg(F.sort_array(F.collect_list(F.struct("d2", "key"))).alias("best"))


def own_cell(cells: Cells, k: int) -> DataFrame:
    """point, best of the point's own cell, written."""

    def compare(rows: dict, others: dict) -> tuple:
        d2 = square_distances(rows["x"], others["x"])
        return _first(d2, np.ones(d2.shape, bool), k)

    whole = cells.points.groupBy("cell").agg(F.collect_list(F.struct("point", "x", "keys")).alias("rows")).withColumn("others", F.col("rows"))
    found = _met(whole, compare, ["rows.point", "others.keys"], {"d2": "double"})
    return materialize(_best(found.select("point", "d2", F.explode("keys").alias("key")), k), "nn-own")


def visits(cells: Cells, own: DataFrame, k: int) -> DataFrame:
    """point, x, t (bound), cell, d (distance to its pivot): the other cells that a point must look into."""
    bound = F.when(F.size("best") > k, F.sqrt(F.element_at("best", k + 1)["d2"])).otherwise(F.lit(float("inf")))
    front = cells.points.join(own, "point").select("point", "x", F.col("cell").alias("home"), bound.alias("t"), F.lit("").alias("cell"), F.lit(0.0).alias("d"))
    found = None

    def compare(rows: dict, others: dict) -> tuple:
        d = np.sqrt(square_distances(rows["x"], others["x"]))
        far = d + others["radius"]
        order = np.argsort(far, axis=1)
        enough = np.cumsum(others["rows"][order], axis=1) > k
        upto = np.take_along_axis(far, np.take_along_axis(order, enough.argmax(axis=1)[:, None], 1), 1)[:, 0]
        t = np.where(enough.any(axis=1), np.fmin(rows["t"], upto), rows["t"])
        a, b = np.nonzero(~(d - others["radius"] > t[:, None] + SLACK * (far + 1)))
        return a, b, t[a], d[a, b]

    for level in cells.levels:
        n = level.count()
        blocks = _blocks(front, n, "point", "x", "home", "t").join(_small(level.withColumnRenamed("kids", "others"), n), "cell").drop("cell")
        met = materialize(_met(blocks, compare, ["rows.point", "rows.x", "rows.home", "others.cell", "others.open"], {"t": "double", "d": "double"}), "nn-front")
        leaves = met.where(~F.col("open") & (F.col("cell") != F.col("home"))).drop("open", "home")
        found = leaves if found is None else found.unionByName(leaves)
        front = met.where("open").drop("open")
    return found if found is not None else front.where(F.lit(False)).drop("home")


def _ring(slack: float = SLACK) -> Column:
    return F.abs(F.col("d") - F.col("r")) <= F.col("t") + slack * (F.col("d") + F.col("r") + 1)


def nearest(df: DataFrame, columns: Sequence[str], k: int, key: str, capacity: int = CAPACITY, fan: int = FAN) -> DataFrame:
    """(key, NEIGHBOURS): for each row its k nearest others, an array of (d2, key) in order of distance and key."""
    rows = materialize(df.select(F.col(key).alias("key"), vector(columns).alias("x")), "nn-rows")
    cells = cells_of(points_of(rows, "key", k), capacity, fan)
    own = own_cell(cells, k)
    seen = own.select("point", F.explode("best").alias("b")).select("point", "b.d2", "b.key")

    def compare(rows: dict, others: dict) -> tuple:
        d, r, t = rows["d"][:, None], others["r"][None, :], rows["t"][:, None]
        d2 = square_distances(rows["x"], others["x"])
        ring = ~(np.abs(d - r) > t + SLACK * (d + r + 1))
        return _first(d2, ring & (d2 <= t * t * (1 + SLACK) + SLACK), k)

    others = cells.points.groupBy("cell").agg(F.collect_list(F.struct("x", "keys", "r")).alias("others"))
    blocks = _blocks(visits(cells, own, k), SMALL + 1, "point", "x", "t", "d").join(others, "cell")
    more = _met(blocks, compare, ["rows.point", "others.keys"], {"d2": "double"}).select("point", "d2", F.explode("keys").alias("key"))
    best = _best(seen.unionByName(more), k)
    found = cells.points.select("point", "x").join(best, "point").select("x", "best")
    mine = F.slice(F.filter("best", lambda b: b["key"] != F.col("key")), 1, k)
    return rows.join(found, "x").select(F.col("key").alias(key), mine.alias("NEIGHBOURS"))


def compared_pairs(df: DataFrame, columns: Sequence[str], k: int, key: str, capacity: int = CAPACITY, fan: int = FAN) -> tuple[int, int]:
    """(point pairs compared, all point pairs), for a report."""
    cells = cells_of(points_of(df.select(F.col(key).alias("key"), vector(columns).alias("x")), "key", k), capacity, fan)
    n = cells.points.count()
    inside = cells.points.groupBy("cell").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0] or 0
    others = cells.points.select(F.col("cell").alias("o"), "r")
    across = visits(cells, own_cell(cells, k), k).join(others, (F.col("cell") == F.col("o")) & _ring()).count()
    return inside + across, n * n
