"""Neighbourhood operators on grids in tiles.

The cells of a grid, or of a stack of grids with keys such as a date, are gathered once into square
tiles of arrays. A tile sends only the cells of its edges to the tiles beside it; with these around
it, it computes whole chains of stencils in numpy, so a chain costs one shuffle of the cells and a
small one of edges, whatever the stencils' size and number. Small tiles are computed many at a time.

A grid may have gaps: cells that are not there have no value, give none to their neighbours, and are
not in the result. A cell whose value is null stays, and takes its result from its neighbours. All
grids of a stack have one shape, from 0 to the largest y and x of the whole table. Cells are unique
for each key, y and x; cells with a null in one of these are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

#: Cells on a side of a tile.
SIDE = 256

#: Cells, with those around their tiles, that are computed at once; one tile at least.
AT_ONCE = 1 << 17


@dataclass
class Field:
    """The values of tiles (tile, y, x) with their surroundings: NaN where there is none."""

    z: np.ndarray
    there: np.ndarray
    #: The row and column of the grid that each tile's array begins with, and the grid's shape.
    y0: np.ndarray
    x0: np.ndarray
    height: int
    width: int

    def like(self, z: np.ndarray) -> Field:
        """Values for the same cells; none where no cell is."""
        return Field(np.where(self.there, z, np.nan), self.there, self.y0, self.x0, self.height, self.width)

    def reflected(self) -> np.ndarray:
        """The values, with those beyond the grid's border mirrored at it: d c b a | a b c d | d c b a."""
        tiles, h, w = self.z.shape
        rows, columns = (_mirror(at[:, None] + np.arange(n), size) - at[:, None] for at, n, size in ((self.y0, h, self.height), (self.x0, w, self.width)))
        inside = ((rows >= 0) & (rows < h))[:, :, None] & ((columns >= 0) & (columns < w))[:, None, :]
        found = self.z[np.arange(tiles)[:, None, None], np.clip(rows, 0, h - 1)[:, :, None], np.clip(columns, 0, w - 1)[:, None, :]]
        return np.where(inside, found, np.nan)


def _mirror(i: np.ndarray, n: int) -> np.ndarray:
    j = i % (2 * n)
    return np.where(j < n, j, 2 * n - 1 - j)


def shifted(z: np.ndarray, dy: int, dx: int) -> np.ndarray:
    """The value at (y + dy, x + dx) for each cell of (..., y, x); NaN beyond the array."""
    out = np.full(z.shape, np.nan)
    h, w = z.shape[-2:]
    if abs(dy) < h and abs(dx) < w:
        out[..., max(0, -dy) : h - max(0, dy), max(0, -dx) : w - max(0, dx)] = z[..., max(0, dy) : h - max(0, -dy), max(0, dx) : w - max(0, -dx)]
    return out


def weighted(z: np.ndarray, offsets: Sequence[tuple[int, int, float]]) -> np.ndarray:
    """The sum of weight times neighbour over (dy, dx, weight); neighbours without a value add nothing."""
    total = np.zeros(z.shape)
    for dy, dx, weight in offsets:
        total += np.nan_to_num(shifted(z, dy, dx) * weight)
    return total


def neighbours(z: np.ndarray, offsets: Sequence[tuple[int, int, float]]) -> np.ndarray:
    return np.stack([shifted(z, dy, dx) for dy, dx, _ in offsets])


def gradient(z: np.ndarray, axis: str, spacing: float = 1.0) -> np.ndarray:
    """Central difference; one-sided where only one neighbour has a value, NaN where none has."""
    step = (1, 0) if axis == "y" else (0, 1)
    before, after = shifted(z, -step[0], -step[1]), shifted(z, *step)
    inner = np.where(np.isnan(before), after - z, np.where(np.isnan(after), z - before, (after - before) / 2))
    return inner / spacing


def _tiled(grid: DataFrame, keys: Sequence[str], value: str, side: int) -> DataFrame:
    """A row for each tile: its cells as (place in the tile, value)."""
    cells = grid.na.drop(subset=[*keys, "y", "x"]).select(*keys, F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), F.col(value).cast("double").alias("z"))
    place = F.pmod("y", F.lit(side)) * side + F.pmod("x", F.lit(side))
    placed = cells.select(*keys, F.floor(F.col("y") / side).alias("ty"), F.floor(F.col("x") / side).alias("tx"), F.struct(place.cast("int").alias("p"), "z").alias("cell"))
    return placed.groupBy(*keys, "ty", "tx").agg(F.collect_list("cell").alias("cells"))


def _edges(tiles: DataFrame, keys: Sequence[str], side: int, halo: int) -> DataFrame:
    """What each tile gets from those beside it: (place in the tile with its surroundings, value)."""
    wide = side + 2 * halo

    def sent(dy: int, dx: int):
        row, column = (lambda c: F.floor(c["p"] / side)), (lambda c: c["p"] % side)
        near = lambda at, d: at < halo if d < 0 else at >= side - halo if d > 0 else F.lit(True)
        own = F.filter("cells", lambda c: near(row(c), dy) & near(column(c), dx))
        moved = F.transform(own, lambda c: F.struct(((row(c) - dy * side + halo) * wide + column(c) - dx * side + halo).cast("int").alias("p"), c["z"].alias("z")))
        return F.struct((F.col("ty") + dy).alias("ty"), (F.col("tx") + dx).alias("tx"), moved.alias("cells"))

    beside = F.array(*[sent(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if dy or dx])
    out = tiles.select(*keys, F.explode(beside).alias("e")).select(*keys, "e.ty", "e.tx", "e.cells").where("ty >= 0 and tx >= 0 and size(cells) > 0")
    return out.groupBy(*keys, "ty", "tx").agg(F.flatten(F.collect_list("cells")).alias("edge"))


def _filled(cells: pa.ListArray, size: int, out: np.ndarray, there: np.ndarray, place: Callable[[np.ndarray], np.ndarray]) -> None:
    """Puts the cells of each tile (null: none) into its ``size`` places of flat arrays."""
    values = cells.flatten()
    tile = np.repeat(np.arange(len(cells)), cells.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    at = tile * size + place(values.field("p").to_numpy(zero_copy_only=False).astype(np.int64))
    out[at] = values.field("z").to_numpy(zero_copy_only=False).astype(float)
    there[at] = True


def by_tile(grid: DataFrame, compute: Callable[[Field], Mapping[str, np.ndarray]], outputs: Sequence[str], halo: int = 0, keys: Sequence[str] = (), value: str = "z", side: int = SIDE) -> DataFrame:
    """keys, y, x and ``outputs`` of every cell: ``compute`` gets tiles with ``halo`` cells around each and gives an array of their shape for each output.

    ``halo`` is how far away a cell can be that still matters to a result, over all steps of
    ``compute``; NaN becomes null.
    """
    if not 0 <= halo <= side:
        raise ValueError("cells around a tile come from the tiles beside it only")
    keys, wide = list(keys), side + 2 * halo
    tiles = _tiled(grid, keys, value, side)
    if halo:
        tiles = tiles.join(_edges(tiles, keys, side, halo), [*keys, "ty", "tx"], "left")
    shape = grid.agg((F.max("y") + 1).cast("long").alias("height"), (F.max("x") + 1).cast("long").alias("width"))
    tiles = tiles.join(F.broadcast(shape))  # one row
    schema = StructType([*[f for f in tiles.schema if f.name in keys], StructField("y", LongType()), StructField("x", LongType()), *[StructField(c, DoubleType()) for c in outputs]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(1, AT_ONCE // (wide * wide))
        for batch in (whole.slice(i, most) for whole in batches for i in range(0, whole.num_rows, most)):
            n, number = batch.num_rows, lambda name: batch[name].to_numpy(zero_copy_only=False)  # noqa: B023, E731
            flat, there = np.full(n * wide * wide, np.nan), np.zeros(n * wide * wide, bool)
            _filled(batch["cells"], wide * wide, flat, there, lambda p: (p // side + halo) * wide + p % side + halo)
            if halo:
                _filled(batch["edge"], wide * wide, flat, there, lambda p: p)
            y0, x0 = number("ty") * side - halo, number("tx") * side - halo
            field = Field(flat.reshape(n, wide, wide), there.reshape(n, wide, wide), y0, x0, batch["height"][0].as_py(), batch["width"][0].as_py())
            found = compute(field)
            inner = (slice(None), slice(halo, wide - halo), slice(halo, wide - halo))
            own = field.there[inner]
            tile, y, x = np.nonzero(own)
            columns = [batch[k].take(pa.array(tile)) for k in keys]
            columns += [pa.array(y + (y0 + halo)[tile]), pa.array(x + (x0 + halo)[tile]), *[pa.array(found[c][inner][own], from_pandas=True) for c in outputs]]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "y", "x", *outputs])

    return tiles.mapInArrow(run, schema).withColumns({c: F.col(c).cast(grid.schema[c].dataType) for c in ("y", "x")})
