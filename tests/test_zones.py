import random

import pytest

from haulback import schemas
from haulback.operators.sector import assign_sector
from haulback.operators.zones import assign_zone, locate, mean_positions, zone_cells
from tests.frames import DAY, landings, observers, values

U_SHAPE = [(0, 0), (3, 0), (3, 3), (2, 3), (2, 1), (1, 1), (1, 3), (0, 3)]
HOLED = [[(10, 0), (13, 0), (13, 3), (10, 3)], [(11, 1), (12, 1), (12, 2), (11, 2)]]


def edges(spark, shapes):
    rows = []
    for zone, rings in shapes:
        for r, ring in enumerate(rings):
            for i, a in enumerate(ring):
                b = ring[(i + 1) % len(ring)]
                rows.append((zone, r, i, *map(float, a), *map(float, b)))
    return spark.createDataFrame(rows, schemas.ZONE_EDGES)


def test_points_in_concave_and_holed_zones(spark):
    cells = zone_cells(edges(spark, [(1, [U_SHAPE]), (2, HOLED), (3, [[(2, 2), (4, 2), (4, 4)]])]))
    points = [
        (0.5, 2.5, 1), (1.5, 2.5, 0), (1.5, 0.5, 1), (2.5, 2.9, 1), (3.5, 2.5, 3),
        (10.5, 0.5, 2), (11.5, 1.5, 0), (12.5, 1.5, 2), (50.0, 50.0, 0), (None, 1.0, None),
    ]
    df = spark.createDataFrame(points, "x double, y double, expected int")
    got = locate(df, cells, "y", "x", "zone").collect()
    assert [r.zone for r in got] == [r.expected for r in got] and len(got) == len(points)


def test_grid_cell_size_does_not_matter(spark):
    shapes = edges(spark, [(1, [U_SHAPE]), (2, HOLED)])
    grid = [(x / 7, y / 7) for x in range(100) for y in range(25)]
    df = spark.createDataFrame(grid, "x double, y double")
    found = [
        values(locate(df, zone_cells(shapes, c), "y", "x", "z", c), "x", "y", "z")
        for c in (0.1, 0.25, 5.0)
    ]
    assert found[0] == found[1] == found[2]
    assert {z for _, _, z in found[0]} == {0, 1, 2}


@pytest.mark.parametrize("max_edges, depth", [(16, 6), (1, 4), (2, 2), (1, 0)])
def test_index_against_all_edges(spark, max_edges, depth):
    """Random zones with corners on the grid, holes, doubled edges and slivers, however divided."""
    draw = random.Random(depth)
    shapes = []
    for z in range(1, 5):
        rings = [[(draw.choice([draw.uniform(-2, 3), draw.randint(-2, 3)]), draw.choice([draw.uniform(-2, 3), draw.randint(-8, 12) / 4]))
                  for _ in range(draw.randint(3, 9))] for _ in range(draw.randint(1, 2))]
        shapes.append((z, rings + (rings[:1] * 2 if z == 3 else [])))
    table = edges(spark, shapes)
    rows = table.collect()
    points = [(draw.choice([draw.uniform(-3, 4), draw.randint(-12, 16) / 4]), draw.choice([draw.uniform(-3, 4), draw.randint(-12, 16) / 4]))
              for _ in range(1500)]

    def zone_of(x, y):
        for z in range(1, 5):
            own = [e for e in rows if e.zone_id == z and (e.y1 > y) != (e.y2 > y)]
            if sum(x < e.x1 + (y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) for e in own) % 2:
                return z
        return 0

    df = spark.createDataFrame(points, "x double, y double")
    got = locate(df, zone_cells(table, 0.5, max_edges, depth), "y", "x", "z", 0.5).collect()
    assert len(got) == len(points) and [r.z for r in got] == [zone_of(r.x, r.y) for r in got]


def test_fallback_positions_and_no_zone(spark):
    shapes = edges(spark, [(1, [[(-67, 41), (-66, 41), (-66, 42), (-67, 42)]])])
    land = assign_sector(
        landings(
            spark,
            {"TRIP_ID": 1},
            {"TRIP_ID": 2, "LAT": None, "TRIP": "T2"},
            {"TRIP_ID": 3, "LAT": 10.0, "VR_NUMBER_FISHING": 3},
            {"TRIP_ID": 4, "LAT": 10.0, "VR_NUMBER_FISHING": 4, "TRIP": ""},
            {"TRIP_ID": 5, "LAT": 10.0, "TRIP": "T5"},
            {"TRIP_ID": 6, "LON": None, "VR_NUMBER_FISHING": 9},
        )
    )
    obs = observers(spark, {"TRIP": "T2", "LAT": 45.0}, {"TRIP": "T2", "LAT": 41.2, "SETCD_ID": 7})
    stamp = DAY.strftime("%Y/%m/%d")
    rows = [
        (3, f"{stamp} 01:00:00", 41.0, -66.5), (3, f"{stamp} 02:00:00", 41.5, -66.5),
        (3, f"{stamp} 03:00:00", None, None), (4, f"{stamp} 23:59:59", 50.0, -66.5),
        (3, "2023/01/01 00:00:00", 80.0, 0.0), (3, "not a date", 80.0, 0.0),
    ]
    positions = spark.createDataFrame(rows, schemas.POSITIONS)
    got = assign_zone(land, obs, positions, shapes)
    assert values(got.kept, "TRIP_ID", "ZONE") == [(1, 1), (2, 1), (3, 1)]
    assert values(got.removed, "TRIP_ID", "COMMENT") == [(n, "NO ZONE") for n in (4, 5, 6)]
    assert got.kept.columns == schemas.ZONED
    assert mean_positions(positions).filter("DATE IS NOT NULL").count() == 3
