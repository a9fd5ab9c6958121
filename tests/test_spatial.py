import json
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import locate_points
from starloom.operators.spatial import polygon_grid
from starloom.sources import read_zone_polygons

EDGE_DDL = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def feature(location_id, kind, coordinates):
    return {
        "type": "Feature",
        "geometry": {"type": kind, "coordinates": coordinates},
        "properties": {"location_id": str(location_id), "zone": f"Z{location_id}", "borough": "B"},
    }


def box(x0, y0, x1, y1):
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]


COLLECTION = {
    "type": "FeatureCollection",
    "features": [
        feature(1, "Polygon", [box(0, 0, 2, 2)]),
        feature(2, "Polygon", [box(2, 0, 4, 2)]),
        feature(3, "Polygon", [box(10, 10, 20, 20), box(14, 14, 16, 16)]),
        feature(4, "MultiPolygon", [[box(30, 0, 32, 2)], [box(34, 0, 36, 2)]]),
        feature(5, "Polygon", [box(1, 1, 3, 3)]),
    ],
}

CASES = {
    "first square": (0.5, 0.5, 1),
    "second square": (3.5, 0.5, 2),
    "shared edge": (2.0, 0.5, None),
    "overlap, first wins": (1.5, 1.5, 1),
    "only the overlapping one": (2.5, 2.5, 5),
    "ring of the holed one": (11.0, 11.0, 3),
    "in the hole": (15.0, 15.0, None),
    "on the hole's edge": (14.0, 15.0, None),
    "level with a hole corner": (12.0, 14.0, 3),
    "first part": (31.0, 1.0, 4),
    "between the parts": (33.0, 1.0, None),
    "second part": (35.0, 1.0, 4),
    "corner": (0.0, 0.0, None),
    "outside": (100.0, 100.0, None),
    "negative": (-5.0, -5.0, None),
    "no x": (None, 1.0, None),
    "no y": (1.0, None, None),
}


@pytest.fixture(scope="module")
def zones(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("geo") / "zones.geojson"
    path.write_text(json.dumps(COLLECTION, indent=1))
    return read_zone_polygons(spark, str(path))


def test_geojson_features(zones):
    got = [(r["ord"], r["location_id"], r["zone"], len(r["edges"])) for r in zones.orderBy("ord").collect()]
    assert got == [(0, 1, "Z1", 4), (1, 2, "Z2", 4), (2, 3, "Z3", 8), (3, 4, "Z4", 8), (4, 5, "Z5", 4)]


@pytest.mark.parametrize("cells", [4.0, 1.0, 13.0])
@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_cases(spark, zones, cells, broadcast_bytes):
    points = spark.createDataFrame(
        [(name, x, y) for name, (x, y, _) in CASES.items()], "name string, px double, py double"
    )
    located = locate_points(
        points, zones, "px", "py", alias="z", cells=cells, broadcast_bytes=broadcast_bytes
    )
    assert located.columns == ["name", "px", "py", "z"]
    got = {r["name"]: r["z"] and r["z"]["location_id"] for r in located.collect()}
    assert got == {name: zone for name, (_, _, zone) in CASES.items()}


def brute_force(polygons, x, y):
    for ord_, edges in polygons:
        odd, touching = False, False
        for x1, y1, x2, y2 in edges:
            if (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * (y - y1) / (y2 - y1):
                odd = not odd
            if (
                (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1)
                and min(x1, x2) <= x <= max(x1, x2)
                and min(y1, y2) <= y <= max(y1, y2)
            ):
                touching = True
        if odd and not touching:
            return ord_
    return None


def random_star(rng):
    import math

    cx, cy, n = rng.uniform(-20, 20), rng.uniform(-20, 20), rng.randint(3, 30)
    ring = [
        (cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n))
        for i in range(n)
        for r in [rng.uniform(0.5, 9)]
    ]
    return [(*a, *b) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]


def test_random_polygons_equal_brute_force(spark):
    rng = random.Random(7)
    polygons = [(i, random_star(rng)) for i in range(40)]
    # sizes from a hundredth to a hundredfold
    polygons = [
        (i, [tuple(v * 100.0 ** (i % 3 - 1) for v in e) for e in edges]) for i, edges in polygons
    ]
    polygons += [(i + 40, edges) for i, (_, edges) in enumerate(polygons[:10])]  # copies
    frame = spark.createDataFrame(
        [(i, i, f"Z{i}", "B", [tuple(e) for e in edges]) for i, edges in polygons],
        f"ord bigint, location_id int, zone string, borough string, edges {EDGE_DDL}",
    )
    points = [(i, rng.uniform(-30, 30), rng.uniform(-30, 30)) for i in range(1500)]
    frame_points = spark.createDataFrame(points, "id int, x double, y double")
    for cells in (4.0, 1.0, 9.0):
        located = locate_points(frame_points, frame, "x", "y", alias="z", cells=cells)
        got = {r["id"]: r["z"] and r["z"]["location_id"] for r in located.collect()}
        assert got == {i: brute_force(polygons, x, y) for i, x, y in points}


def test_points_are_not_shuffled_for_small_polygons(spark, zones, plan):
    points = spark.range(10).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"))
    text = plan(locate_points(points, zones, "x", "y"))
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text
    assert "BatchEvalPython" not in text and "BroadcastNestedLoopJoin" not in text


def test_one_large_polygon_leaves_the_grid_of_small_ones(spark):
    rows = [(i, [(i, 0.0, i + 1.0, 0.0), (i + 1.0, 0.0, i, 1.0), (i, 1.0, float(i), 0.0)]) for i in range(50)]
    rows.append((50, [(0.0, 0.0, 900.0, 0.0), (900.0, 0.0, 0.0, 900.0), (0.0, 900.0, 0.0, 0.0)]))
    frame = spark.createDataFrame(
        [(i, i, "Z", "B", [tuple(map(float, e)) for e in edges]) for i, edges in rows],
        f"ord bigint, location_id int, zone string, borough string, edges {EDGE_DDL}",
    )
    grid = polygon_grid(frame, ["zone"], ["ord"])
    assert grid.layers == ((0, 0), (5, 0)) and grid.bytes > 0


def squares(spark, n, seed, spread=3):
    """Squares of one size over one spot, corners on a coarse lattice so that points lie on edges too."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = rng.randint(0, 64 * spread) / 64, rng.randint(0, 64 * spread) / 64
        ring = [(x, y), (x + 8, y), (x + 8, y + 8), (x, y + 8)]
        rows.append((i, [(*a, *b) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]))
    frame = spark.createDataFrame(
        [(i, i, f"Z{i}", "B", e) for i, e in rows],
        f"ord bigint, location_id int, zone string, borough string, edges {EDGE_DDL}",
    )
    return rows, frame


def longest_list(grid):
    counts = grid.cells.groupBy("_level", "_depth", "_cx", "_cy").count()
    return counts.agg(F.max("count")).first()[0]


def test_piles_are_split(spark):
    rows, frame = squares(spark, 3000, 5)
    grid = polygon_grid(frame, crowded=24)
    assert max(depth for _, depth in grid.layers) > 0
    assert longest_list(grid) <= 24
    rng = random.Random(6)
    points = [(i, rng.randint(-64, 64 * 13) / 64, rng.randint(-64, 64 * 13) / 64) for i in range(400)]
    located = locate_points(spark.createDataFrame(points, "id int, x double, y double"), grid, "x", "y", alias="z")
    got = {r["id"]: r["z"] and r["z"]["location_id"] for r in located.collect()}
    assert got == {i: brute_force(rows, x, y) for i, x, y in points}


def test_copies_of_one_polygon_are_one_candidate(spark):
    rows, frame = squares(spark, 1, 1)
    copies = frame.crossJoin(spark.range(500)).withColumn("ord", F.col("id")).withColumn("location_id", F.col("id").cast("int"))
    grid = polygon_grid(copies.drop("id"))
    assert longest_list(grid) <= 32
    x, y = rows[0][1][0][:2]
    point = spark.createDataFrame([(x + 1.0, y + 1.0), (x, y)], "x double, y double")
    got = locate_points(point, grid, "x", "y", alias="z").select("z.location_id").collect()
    assert sorted(got, key=str) == [(0,), (None,)]


def test_no_polygons(spark):
    _, frame = squares(spark, 1, 1)
    point = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    located = locate_points(point, frame.limit(0), "x", "y", alias="z")
    assert located.collect() == [(1.0, 1.0, None)] and located.columns == ["x", "y", "z"]


def test_pieces_that_are_the_same_in_their_cell_are_one(spark):
    # sides on a few lines, no two squares alike: splitting cannot part them, so it must not go on
    rng = random.Random(11)
    corners = [(rng.randrange(3) / 64, rng.uniform(0, 4)) for _ in range(150)]
    corners += [(rng.uniform(0, 4), rng.randrange(3) / 64) for _ in range(150)]
    squares = [(i, [tuple(map(float, (*a, *b))) for a, b in zip(r, r[1:], strict=False)])
               for i, (x, y) in enumerate(corners) for r in [box(x, y, x + 8, y + 8)]]
    frame = spark.createDataFrame(
        [(i, i, "Z", "B", edges) for i, edges in squares],
        f"ord bigint, location_id int, zone string, borough string, edges {EDGE_DDL}",
    )
    grid = polygon_grid(frame, ["location_id"], ["ord"])
    assert max(depth for _, depth in grid.layers) < 6 and grid.cells.count() < 20_000
    points = [(i, rng.randrange(-1, 6) / 64, rng.uniform(0, 12)) for i in range(150)]
    points += [(i + 150, y, x) for i, x, y in points]
    points += [(i + 300, corners[i][0] + 8 * (i % 2), corners[i][1] + 8 * (i % 3)) for i in range(300)]
    found = locate_points(spark.createDataFrame(points, "id int, x double, y double"), grid, "x", "y", alias="z")
    got = {r["id"]: r["z"] and r["z"]["location_id"] for r in found.collect()}
    assert got == {i: brute_force(squares, x, y) for i, x, y in points}
