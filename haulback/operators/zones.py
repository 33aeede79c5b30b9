"""Locate fishing sets in zone polygons, with fallback positions for the unlocated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulback import schemas
from haulback.functions.missing import INF
from haulback.operators.joins import Split, null_safe_join
from haulback.sources.positions import POSITION_DAY, position_day_text

NO_ZONE_COMMENT = "NO ZONE"  # Fixed value.
CELL = 0.25
# Edges that a part of a cell lists at most, and halvings of a cell's side after which it may list more.
MAX_EDGES = 16
MAX_DEPTH = 6
OUTSIDE = 0


def zone_cells(
    edges: DataFrame,
    cell: float = CELL,
    max_edges: int = MAX_EDGES,
    max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """Adaptive grid index of the zones; its size is bounded by the map, not by the data.

    A cell of the grid is divided into 2^split by 2^split parts, with the least split up to
    ``max_depth`` that leaves each part ``max_edges`` edges at most.  Two kinds of rows: (gx, gy,
    split) for a cell that is divided, and (depth, gx, gy, zones) for a part that some zone reaches.

    A zone holds a point if an odd number of its edges lies to the east.  A part lists the edges
    whose stretch in its row lies across it.  Those wholly to the east count at once: such an edge
    turns the answer where it begins and where it ends, so where one ends as another begins nothing
    is left of both, and a part inside a zone has no edges but one turn, at minus infinity.
    """
    edges = edges.filter(F.col("y1") != F.col("y2")).select(
        "zone_id",
        F.struct("x1", "y1", "x2", "y2").alias("edge"),
        F.least("y1", "y2").alias("ymin"),
        F.greatest("y1", "y2").alias("ymax"),
    )
    splits = _splits(edges, cell, max_edges, max_depth)
    boxes = edges.groupBy("zone_id").agg(F.min(F.least("edge.x1", "edge.x2")).alias("west"))
    # Every cell from the zone's western end to an edge's eastern one, with the cell's own split.
    rows = _rows(edges.withColumn("size", F.lit(cell)).join(boxes, "zone_id"))
    cells = rows.withColumn("gx", F.explode(F.sequence(_grid("west", "size"), "right")))
    cells = cells.withColumnRenamed("iy", "gy").drop("left", "right", "size")
    cells = cells.join(splits, ["gx", "gy"], "left").withColumn("split", F.coalesce("split", F.lit(0)))
    cells = cells.withColumn("size", _size(cell, F.col("split")))
    n = _parts_of(F.col("split"))
    parts = _rows(cells, F.col("gy") * n, (F.col("gy") + 1) * n - 1)
    ends = F.least((F.col("gx") + 1) * n - 1, F.col("right"))
    parts = parts.filter(ends >= F.col("gx") * n).withColumn("ix", F.explode(F.sequence(F.col("gx") * n, ends)))
    across = F.col("ix") >= F.col("left")
    begins = F.when(_grid("ymin", "size") < F.col("iy"), F.lit(-INF)).otherwise(F.col("ymin"))
    ends = F.when(_grid("ymax", "size") == F.col("iy"), F.col("ymax"))
    no_edge, no_turn = F.lit(None).cast("struct<x1:double,y1:double,x2:double,y2:double>"), F.lit(None).cast("double")
    entry = F.when(across, F.array(F.struct(F.col("edge"), no_turn.alias("turn")))).otherwise(
        F.array(*(F.struct(no_edge.alias("edge"), y.alias("turn")) for y in (begins, ends)))
    )
    parts = parts.select("split", F.col("ix").alias("gx"), F.col("iy").alias("gy"), "zone_id", F.inline(entry))
    parts = parts.filter("edge IS NOT NULL OR turn IS NOT NULL")
    by_part = ["split", "gx", "gy"]
    odd = parts.groupBy(*by_part, "zone_id", "edge", "turn").agg(F.count("*").alias("n")).filter("n % 2 = 1")
    zones = odd.groupBy(*by_part, "zone_id").agg(
        F.collect_list("edge").alias("edges"), F.collect_list("turn").alias("turns")
    )
    leaves = zones.groupBy(*by_part).agg(
        F.sort_array(F.collect_list(F.struct("zone_id", "edges", "turns"))).alias("zones")
    )
    leaves = leaves.select(F.col("split").alias("depth"), "gx", "gy", "zones")
    return leaves.unionByName(splits.filter("split > 0"), allowMissingColumns=True)


def _grid(v: Column | str, size: Column | str) -> Column:
    value, side = (F.col(c) if isinstance(c, str) else c for c in (v, size))
    return F.floor(value / side)


def _size(cell: float, split: Column) -> Column:
    """Side of the parts of a cell: halving is exact, so a part lies in its cell for every point."""
    return F.lit(cell) / _parts_of(split)


def _parts_of(split: Column) -> Column:
    """Parts along a side."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), split)


def _rows(edges: DataFrame, low: Column | None = None, high: Column | None = None) -> DataFrame:
    """An edge once for each row ``iy`` of side ``size`` it reaches, from ``low`` to ``high``, with
    the columns ``left`` to ``right`` that its stretch in the row can lie across."""
    first, last = _grid("ymin", "size"), _grid("ymax", "size")
    first = first if low is None else F.greatest(first, low)
    last = last if high is None else F.least(last, high)
    rows = edges.filter(first <= last).withColumn("iy", F.explode(F.sequence(first, last)))

    def at(y: Column) -> Column:
        e = F.col("edge")
        return e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])

    one = at(F.greatest(F.col("ymin"), F.col("iy") * F.col("size")))
    two = at(F.least(F.col("ymax"), (F.col("iy") + 1) * F.col("size")))
    slack = F.col("size") * 1e-6  # what rounding can move a crossing, many times over
    return rows.withColumns(
        {"left": _grid(F.least(one, two) - slack, "size"), "right": _grid(F.greatest(one, two) + slack, "size")}
    )


def _splits(edges: DataFrame, cell: float, max_edges: int, max_depth: int) -> DataFrame:
    """(gx, gy, split) of the cells that some edge lies across."""
    depths = F.explode(F.sequence(F.lit(0), F.lit(max_depth)))
    sized = edges.withColumn("split", depths).withColumn("size", _size(cell, F.col("split")))
    parts = _rows(sized).withColumn("ix", F.explode(F.sequence("left", "right")))
    counts = parts.groupBy("split", "ix", "iy").agg(F.count("*").alias("n"))
    whole = lambda c: F.floor(F.col(c) / _parts_of(F.col("split")))
    most = counts.groupBy("split", whole("ix").alias("gx"), whole("iy").alias("gy")).agg(F.max("n").alias("n"))
    least = F.min(F.when(F.col("n") <= max_edges, F.col("split")))
    return most.groupBy("gx", "gy").agg(F.coalesce(least, F.lit(max_depth)).alias("split"))


def index_report(cells: DataFrame) -> DataFrame:
    """By depth: parts, those without an edge, edges listed, and most edges and turns of a part."""
    n = lambda c: F.aggregate(F.transform("zones", lambda z: F.size(z[c])), F.lit(0), lambda a, b: a + b)
    parts = cells.filter("zones IS NOT NULL").select("depth", n("edges").alias("e"), n("turns").alias("t"))
    return parts.groupBy("depth").agg(
        F.count("*").alias("parts"),
        F.count(F.when(F.col("e") == 0, 1)).alias("without_edges"),
        F.sum("e").alias("edges"),
        F.max("e").alias("most_edges"),
        F.max("t").alias("most_turns"),
    )


def _holds(zone: Column, x: Column, y: Column) -> Column:
    """Even-odd rule: an odd number of edges lies east of the point."""

    def crosses(e: Column) -> Column:
        straddles = (e["y1"] > y) != (e["y2"] > y)
        at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])
        return straddles & (x < at)

    turned = F.size(F.filter(zone["turns"], lambda t: t <= y))
    return (turned + F.size(F.filter(zone["edges"], crosses))) % 2 == 1


def locate(
    df: DataFrame, cells: DataFrame, lat: str, lon: str, zone: str, cell: float = CELL
) -> DataFrame:
    """Add the zone of each point: lowest zone holding it, 0 outside, null for a missing point.

    A point meets its cell, which says how finely it is divided, and then its part.  Missing points,
    which would all meet in one cell, do not take part in the joins.  Where ``cells`` is a written
    table, Spark knows its size and sends it to the points if that is under the session's threshold,
    so that these need no shuffle; beyond it, adaptive execution splits the cells of many points.
    """
    x, y = F.col(lon), F.col(lat)
    some = x.isNotNull() & y.isNotNull()
    located = _locate(df.filter(some), cells, x, y, zone, cell)
    return located.unionByName(df.filter(~some).withColumn(zone, F.lit(None).cast("int")))


def _locate(
    df: DataFrame, cells: DataFrame, x: Column, y: Column, zone: str, cell: float
) -> DataFrame:
    divided = cells.filter("split IS NOT NULL").select(
        F.col("gx").alias("_cx"), F.col("gy").alias("_cy"), F.col("split").alias("_split")
    )
    leaves = cells.filter("depth IS NOT NULL").select(
        F.col("depth").alias("_depth"), F.col("gx").alias("_lx"), F.col("gy").alias("_ly"), F.col("zones").alias("_zones")
    )
    keys = {"_gx": _grid(x, F.lit(cell)), "_gy": _grid(y, F.lit(cell))}
    same = (F.col("_gx") == F.col("_cx")) & (F.col("_gy") == F.col("_cy"))
    joined = df.withColumns(keys).join(divided, same, "left")
    joined = joined.withColumn("_split", F.coalesce("_split", F.lit(0)))
    size = _size(cell, F.col("_split"))
    joined = joined.withColumns({"_px": _grid(x, size), "_py": _grid(y, size)})
    part = [F.col("_split") == F.col("_depth"), F.col("_px") == F.col("_lx"), F.col("_py") == F.col("_ly")]
    joined = joined.join(leaves, part, "left")
    inside = F.filter("_zones", lambda z: _holds(z, x, y))
    found = F.coalesce(F.get(inside, F.lit(0))["zone_id"], F.lit(OUTSIDE))
    return joined.select(*df.columns, found.cast("int").alias(zone))


def mean_positions(positions: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Mean position per vessel and day; ``wanted`` limits the work to its vessel-days.

    Positions are folded by vessel and the day's text where they are read, so what is shuffled is a
    row per task and vessel-day.  The wanted days are put into that text form, so only days that count
    are parsed.
    """
    means = {"MEAN_LAT": "LATITUDE", "MEAN_LON": "LONGITUDE"}
    sums = [f(c).alias(f"{n}{m}") for m, c in means.items() for f, n in ((F.sum, "_sum_"), (F.count, "_n_"))]
    days = positions.withColumn("_day", position_day_text()).groupBy("VR_NUMBER", "_day").agg(*sums)
    if wanted is not None:
        keys = wanted.select(
            F.col("VR_NUMBER_FISHING").alias("VR_NUMBER"),
            F.date_format("DATE_FISHED", POSITION_DAY).alias("_day"),
        ).distinct()
        days = days.join(keys, ["VR_NUMBER", "_day"], "left_semi")
    return (
        days.withColumn("DATE", F.try_to_date("_day", POSITION_DAY))
        .groupBy("VR_NUMBER", "DATE")
        .agg(*(F.try_divide(F.sum(f"_sum_{m}"), F.sum(f"_n_{m}")).alias(m) for m in means))
    )


def observer_positions(observers: DataFrame) -> DataFrame:
    """One position per observed trip: that of its row of least latitude, then longitude."""
    known = F.col("LAT").isNotNull() & F.col("LON").isNotNull()
    place = F.min(F.when(known, F.struct("LAT", "LON"))).alias("place")
    return (
        observers.groupBy("TRIP")
        .agg(place)
        .select("TRIP", F.col("place.LAT").alias("OBS_LAT"), F.col("place.LON").alias("OBS_LON"))
    )


def corrected_zones(
    unlocated: DataFrame,
    observers: DataFrame,
    positions: DataFrame,
    cells: DataFrame,
    cell: float = CELL,
) -> DataFrame:
    """Landings without a zone, located again by a fallback position.

    A landing with a trip number takes its observer trip's position, any other the vessel's mean
    position on the day fished.  Only the landings of each branch meet its lookup.
    """
    has_trip = F.coalesce(F.length("TRIP") > 0, F.lit(False))
    columns = [c for c in unlocated.columns if c != "ZONE"]

    observed = unlocated.filter(has_trip).join(observer_positions(observers), "TRIP", "left")
    observed = locate(observed, cells, "OBS_LAT", "OBS_LON", "NEW_ZONE", cell)

    rest = unlocated.filter(~has_trip)
    means = mean_positions(positions, rest).withColumnsRenamed(
        {"VR_NUMBER": "VR_NUMBER_FISHING", "DATE": "DATE_FISHED"}
    )
    rest = null_safe_join(rest, means, ["VR_NUMBER_FISHING", "DATE_FISHED"])
    rest = locate(rest, cells, "MEAN_LAT", "MEAN_LON", "NEW_ZONE", cell)

    out = [*columns, F.coalesce("NEW_ZONE", "ZONE").alias("ZONE")]
    return observed.select(*out).unionByName(rest.select(*out))


def with_fallback(
    located: DataFrame,
    observers: DataFrame,
    positions: DataFrame,
    cells: DataFrame,
    cell: float = CELL,
) -> DataFrame:
    """Landings located by their reported position, or else by a fallback."""
    found = F.coalesce(F.col("ZONE") >= 1, F.lit(False))
    corrected = corrected_zones(located.filter(~found), observers, positions, cells, cell)
    return located.filter(found).unionByName(corrected)


def assign_zone(
    landings: DataFrame,
    observers: DataFrame,
    positions: DataFrame,
    edges: DataFrame,
    *,
    lat: str = "LAT",
    lon: str = "LON",
    cell: float = CELL,
) -> Split:
    """Landings with a zone, and those that have none even by a fallback position."""
    cells = zone_cells(edges, cell)
    located = locate(landings, cells, lat, lon, "ZONE", cell)
    return split_by_zone(with_fallback(located, observers, positions, cells, cell))


def split_by_zone(zoned: DataFrame) -> Split:
    found = F.coalesce(F.col("ZONE") >= 1, F.lit(False))
    removed = zoned.filter(~found).select(*schemas.ZONED, F.lit(NO_ZONE_COMMENT).alias("COMMENT"))
    return Split(kept=zoned.filter(found).select(*schemas.ZONED), removed=removed)
