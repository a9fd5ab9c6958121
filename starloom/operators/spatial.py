"""Point-in-polygon join on grids, in native expressions only.

Every polygon is cut along a square grid that suits its own size: sizes are put into
levels, four times apart, and each level has its grid. A (polygon, cell) pair is one of

* outside  – no edge reaches the cell and its centre is outside: dropped,
* inside   – no edge reaches the cell and its centre is inside: all its points match,
* boundary – an edge reaches the cell: its points are tested, but only against the
  edges that a ray through this cell can meet.

A cell that more than a few polygons share is split in sixteen, and its parts again, two
steps of a quadtree at a time: in small cells most polygons are inside ones, of which the first hides all that
come later. So lists stay short where polygons pile up.

A point falls into one cell per level and meets only the candidates of these cells, so
the cost per point does not depend on the number of polygons or on their number of
vertices, and a large polygon does not coarsen the grid of small ones. The result does
not depend on the grids.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import work_path

_MARGIN = 1e-6
_BROADCAST_BYTES = 64 * 1024 * 1024
# cells along the longest polygon of a level; shorter ones have at least a quarter of it
_CELLS = 4.0
# candidates of a cell above which it is split, and how often
_CROWDED = 32
_DEPTH = 8
_CELL = ["_level", "_depth", "_cx", "_cy"]


def crossings(edges: Column, x: Column, y: Column) -> Column:
    """Number of edges that a ray from (x, y) to the right crosses (half-open rule)."""
    return F.size(
        F.filter(
            edges,
            lambda e: ((e["y1"] > y) != (e["y2"] > y))
            & (x < e["x1"] + F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"])),
        )
    )


def on_edge(edges: Column, x: Column, y: Column) -> Column:
    """True when (x, y) lies exactly on an edge."""
    return F.exists(
        edges,
        lambda e: ((e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"]))
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])),
    )


def contains(edges: Column, x: Column, y: Column) -> Column:
    """Strict containment: a point on the boundary (also of a hole) is not inside."""
    return (crossings(edges, x, y) % 2 == 1) & ~on_edge(edges, x, y)


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size)).cast("bigint")


def _boxes(polygons: DataFrame) -> DataFrame:
    low = lambda a: F.array_min(F.transform("edges", lambda e: F.least(e[f"{a}1"], e[f"{a}2"])))
    high = lambda a: F.array_max(F.transform("edges", lambda e: F.greatest(e[f"{a}1"], e[f"{a}2"])))
    return polygons.where(F.size("edges") > 0).withColumns(
        {"_x0": low("x"), "_x1": high("x"), "_y0": low("y"), "_y1": high("y")}
    )


def _level(size: Column) -> Column:
    """Level of an extent: 4 ** level is the first power of four that is not smaller."""
    return F.ceil(F.round(F.log(size) / F.log(F.lit(4.0)), 9)).cast("int")


def _extent() -> Column:
    return F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"))


@dataclass(frozen=True)
class PolygonGrid:
    """Polygons cut along their grids, stored; built once, it serves any number of joins.

    ``layers`` are the (level, depth) pairs in use, ``bytes`` bounds what a broadcast of all cells takes.
    """

    cells: DataFrame
    layers: tuple[tuple[int, int], ...]
    bytes: int
    per_level: float
    payload: tuple[str, ...]
    kind: str

    def size_of(self, level: int, depth: int) -> float:
        return 4.0 ** (level - depth) / self.per_level


def _once(column: Column, name: str) -> Column:
    """A column that is evaluated once however often it is used: the optimizer copies no generator."""
    return F.explode(F.array(column)).alias(name)


def _bounded(pieces: DataFrame, size: Column) -> DataFrame:
    """Adds ``_box``: a cell's bounds, widened a little so that rounding cannot lose an edge."""
    box = F.expr(f"""named_struct(
        'left', _cx * _size - _size * {_MARGIN}, 'right', (_cx + 1) * _size + _size * {_MARGIN},
        'bottom', _cy * _size - _size * {_MARGIN}, 'top', (_cy + 1) * _size + _size * {_MARGIN},
        'x', (_cx + 0.5D) * _size, 'y', (_cy + 0.5D) * _size)""")
    return pieces.select("*", _once(size, "_size")).select("*", _once(box, "_box")).drop("_size")


def _classified(pieces: DataFrame, size: Column) -> DataFrame:
    """Pieces (cell and edges) that matter in their cell: ``_edges`` that do, NULL for inside ones.

    ``_edges`` comes in as a superset of what a ray through the cell can meet.
    """
    box = F.col("_box")
    band = F.expr("""filter(_edges, e -> greatest(e.y1, e.y2) >= _box.bottom AND least(e.y1, e.y2) <= _box.top
        AND greatest(e.x1, e.x2) >= _box.left)""")
    reached = F.expr("exists(_band, e -> least(e.x1, e.x2) <= _box.right)")
    whole = F.col("_edges").isNull()
    odd = crossings(F.col("_band"), box["x"], box["y"]) % 2 == 1
    judged = _bounded(pieces, size).select("*", _once(band, "_band")).select("*", _once(~whole & reached, "_boundary"))
    return judged.where(whole | F.col("_boundary") | odd).select(
        *_CELL, "_ord", "_zone", F.when(F.col("_boundary"), F.col("_band")).alias("_edges")
    )


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly to all cores: they are few bytes, but much is computed from each."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism * 2)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """df through files on the shared storage."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _first_level(polygons: DataFrame, order_by: Sequence[str], payload: Sequence[str], per_level: float) -> DataFrame:
    """Every polygon's cells on the grid of its level."""
    boxed = _boxes(_spread(polygons)).where(_extent() > 0).withColumn("_level", _level(_extent()))
    size = F.pow(F.lit(4.0), F.col("_level")) / F.lit(per_level)
    cell = lambda c: F.floor(F.col(c) / size).cast("bigint")
    pieces = boxed.select(
        "_level",
        F.lit(0).alias("_depth"),
        F.struct(*order_by).alias("_ord"),
        F.struct(*payload).alias("_zone"),
        F.col("edges").alias("_edges"),
        F.explode(F.sequence(cell("_x0"), cell("_x1"))).alias("_cx"),
        cell("_y0").alias("_low"),
        cell("_y1").alias("_high"),
    ).withColumn("_cy", F.explode(F.sequence("_low", "_high")))
    return _classified(pieces, size)


def _parts(crowded: DataFrame, per_level: float) -> DataFrame:
    """The pieces of crowded cells, in the four by four parts of each."""
    parts = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in range(4) for y in range(4)])
    split = crowded.withColumn("_part", F.explode(parts)).select(
        "_level",
        (F.col("_depth") + 1).alias("_depth"),
        (F.col("_cx") * 4 + F.col("_part.x")).alias("_cx"),
        (F.col("_cy") * 4 + F.col("_part.y")).alias("_cy"),
        "_ord",
        "_zone",
        "_edges",
    )
    size = F.pow(F.lit(4.0), F.col("_level") - F.col("_depth")) / F.lit(per_level)
    return _classified(split, size)


def _clipped() -> Column:
    """What ``_edges`` do inside ``_box``, in one form for all that do the same there.

    Upright and level edges end at the box, and an edge to the right of it counts as an upright one
    there. Slanted edges that reach the box stay as they are: cutting them would round.
    """
    # as text: built call by call, it takes the driver seconds at each split
    beside = "(e.x1 > _box.right AND e.x2 > _box.right)"
    upright = (
        "named_struct('x1', {0}, 'y1', greatest(least(e.y1, e.y2), _box.bottom),"
        " 'x2', {0}, 'y2', least(greatest(e.y1, e.y2), _box.top))"
    )
    lying = (
        "named_struct('x1', greatest(least(e.x1, e.x2), _box.left), 'y1', e.y1,"
        " 'x2', least(greatest(e.x1, e.x2), _box.right), 'y2', e.y1)"
    )
    return F.expr(f"""
        sort_array(transform(
          filter(_edges, e -> NOT coalesce({beside} AND e.y1 = e.y2, false)),
          e -> CASE WHEN {beside} AND e.y1 != e.y2 THEN {upright.format("_box.right + (_box.right - _box.left)")}
                    WHEN e.x1 = e.x2 AND e.y1 != e.y2 THEN {upright.format("e.x1")}
                    WHEN e.y1 = e.y2 AND e.x1 != e.x2 THEN {lying}
                    ELSE named_struct('x1', e.x1, 'y1', e.y1, 'x2', e.x2, 'y2', e.y2) END))""")


def _visible(pieces: DataFrame, per_level: float) -> DataFrame:
    """Pieces that no earlier inside polygon hides, and of those that are the same within their cell the first.

    Counts and minima per cell are aggregates, so no task holds a crowded cell.
    """
    size = F.pow(F.lit(4.0), F.col("_level") - F.col("_depth")) / F.lit(per_level)
    shape = F.coalesce(F.md5(F.to_json(_clipped())), F.lit(""))
    single = _kept(
        _bounded(pieces, size)
        .withColumn("_shape", shape)
        .groupBy(*_CELL, "_shape")
        .agg(F.min(F.struct("_ord", "_zone", "_edges")).alias("_first"))
        .select(*_CELL, "_first.*"),
        "grid_shapes",
    )
    cover = single.where(F.col("_edges").isNull()).groupBy(*_CELL).agg(F.min("_ord").alias("_cover"))
    joined = single.join(cover, _CELL, "left")
    return joined.where(F.col("_cover").isNull() | (F.col("_ord") <= F.col("_cover"))).drop("_cover")


def _crowds(pieces: DataFrame, most: int) -> DataFrame:
    return pieces.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(*_CELL)


def polygon_grid(
    polygons: DataFrame,
    payload: Sequence[str] = ("location_id", "zone", "borough"),
    order_by: Sequence[str] = ("ord",),
    cells: float = _CELLS,
    crowded: int = _CROWDED,
) -> PolygonGrid:
    """Cut polygons along their grids and store the pieces.

    One pass writes the pieces and a second one counts them per cell. Only where a cell has
    more than ``crowded`` of them is it split, which takes a few passes over these
    cells per split; after eight splits a cell keeps what is left.
    """
    pieces = _kept(_first_level(polygons, order_by, payload, cells), "grid")
    full = _crowds(pieces, crowded)
    leaves = [pieces]
    if not full.isEmpty():
        leaves = [pieces.join(full, _CELL, "left_anti")]
        seen = _kept(_spread(_visible(pieces.join(full, _CELL, "left_semi"), cells)), "grid_crowd")
        for _ in range(_DEPTH):
            still = _crowds(seen, crowded)
            if still.isEmpty():
                break
            leaves.append(seen.join(still, _CELL, "left_anti"))
            parts = _parts(seen.join(still, _CELL, "left_semi"), cells)
            seen = _kept(_spread(_visible(parts, cells)), "grid_crowd")
        leaves.append(seen)
    kept = leaves[0]
    for more in leaves[1:]:
        kept = kept.unionByName(more)
    if len(leaves) > 1:
        kept = _kept(kept, "grid_leaves")
    carried = F.octet_length(F.to_json(F.struct("_ord", "_zone")))
    row = kept.agg(
        F.collect_set(F.struct("_level", "_depth")).alias("layers"),
        F.coalesce(F.sum(F.coalesce(F.size("_edges"), F.lit(0)) * 32 + carried + 128), F.lit(0)).alias("bytes"),
    ).first()
    layers = tuple(sorted((r["_level"], r["_depth"]) for r in row["layers"]))
    kinds = ", ".join(f"{c}: {polygons.schema[c].dataType.simpleString()}" for c in payload)
    return PolygonGrid(kept, layers, row["bytes"], cells, tuple(payload), f"struct<{kinds}>")


def _lists(grid: PolygonGrid, level: int, depth: int, on: Sequence[str]) -> DataFrame:
    """Cell → candidates in order, up to the first that fills the cell."""
    own = grid.cells.where((F.col("_level") == level) & (F.col("_depth") == depth))
    gathered = own.groupBy(F.col("_cx").alias(on[0]), F.col("_cy").alias(on[1])).agg(
        F.sort_array(F.collect_list(F.struct("_ord", "_zone", "_edges"))).alias("_candidates")
    )
    filled = F.array_position(F.transform("_candidates", lambda c: c["_edges"].isNull()), True)
    upto = F.when(filled > 0, filled).otherwise(F.size("_candidates"))
    return gathered.withColumn("_candidates", F.slice("_candidates", F.lit(1), upto.cast("int")))


def locate_points(
    points: DataFrame,
    polygons: DataFrame | PolygonGrid,
    x: str,
    y: str,
    payload: Sequence[str] = ("location_id", "zone", "borough"),
    order_by: Sequence[str] = ("ord",),
    alias: str = "zone_of_point",
    broadcast_bytes: int = _BROADCAST_BYTES,
    cells: float = _CELLS,
) -> DataFrame:
    """Add the first polygon (by ``order_by``) that strictly contains each point.

    ``polygons`` has an ``edges`` array (see ``read_zone_polygons``), or is a grid that was
    built before and says payload and order itself. The added column is a struct of
    ``payload``, NULL when no polygon contains the point or a coordinate is missing. Every point
    is kept, exactly once.

    Each layer of the grid is one join by cell. Grids below ``broadcast_bytes`` in all, as
    measured, are broadcast and the points are not shuffled; larger ones leave the join to Spark.
    """
    grid = polygons if isinstance(polygons, PolygonGrid) else polygon_grid(polygons, payload, order_by, cells)
    px, py = F.col(x), F.col(y)
    located, hits = points, []
    for level, depth in grid.layers:
        size = grid.size_of(level, depth)
        on = [f"_cx_{len(hits)}", f"_cy_{len(hits)}"]
        lists = _lists(grid, level, depth, on)
        if grid.bytes <= broadcast_bytes:
            lists = F.broadcast(lists)
        placed = located.withColumns({on[0]: _cell(px, size), on[1]: _cell(py, size)})
        containing = F.filter(
            "_candidates", lambda c: c["_edges"].isNull() | contains(c["_edges"], px, py)
        )
        hit = f"_hit_{len(hits)}"
        first = F.get(F.transform(containing, lambda c: F.struct(c["_ord"], c["_zone"])), F.lit(0))
        located = placed.join(lists, on, "left").withColumn(hit, first).drop("_candidates", *on)
        hits.append(hit)
    if not hits:
        return points.withColumn(alias, F.lit(None).cast(grid.kind))
    best = F.col(hits[0]) if len(hits) == 1 else F.least(*hits)
    return located.select(*points.columns, best["_zone"].alias(alias))
