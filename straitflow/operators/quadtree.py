"""Tagging points with boxes of very different sizes, by a quadtree whose depth follows boxes and points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from straitflow.operators.tagging import LAT, LON
from straitflow.session import staged

#: Levels of the tree: cells of the deepest have a side of 360 / 2**20 and 180 / 2**20 degrees.
LEVELS = 20

#: Level at which points are counted, so that there are at most 4**10 counts.
COUNTED = 10

#: Level at which it is noted which levels hold boxes: at most 4**6 rows, which are broadcast.
NOTED = 6


def _place(degrees: Column | str, low: float, span: float) -> Column:
    """The deepest column (or row) of cells that a longitude (or latitude) is in; those outside are in the outermost.

    It never falls as degrees rise, so a point inside a box lies in cells between those of the box's edges.
    """
    degrees = F.col(degrees) if isinstance(degrees, str) else degrees
    at = F.floor(F.least(F.greatest((degrees.cast("double") - low) / span, F.lit(0.0)), F.lit(1.0)) * (1 << LEVELS))
    return F.least(at.cast("long"), F.lit((1 << LEVELS) - 1))


def _cell(level: Column | str, x: Column | str, y: Column | str) -> Column:
    """One number for the cell of a level that deepest places x and y are in."""
    level = F.col(level) if isinstance(level, str) else level
    up = (LEVELS - level).cast("int")
    over = [F.call_function("shiftright", F.col(c) if isinstance(c, str) else c, up) for c in (x, y)]
    return (level.cast("long") * (1 << LEVELS) + over[0]) * (1 << LEVELS) + over[1]


def _usable(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))


def _size_bits(span: Column) -> Column:
    return F.when(span > 0, F.length(F.bin(span))).otherwise(F.lit(0))


def _own_cells(boxes: DataFrame) -> DataFrame:
    """Each box at the level at which it meets at most two cells either way, a row per cell."""
    placed = boxes.select(
        "box",
        *[_place(c, low, span).alias(n) for n, c, low, span in (
            ("x0", "lon_min", -180.0, 360.0), ("x1", "lon_max", -180.0, 360.0),
            ("y0", "lat_min", -90.0, 180.0), ("y1", "lat_max", -90.0, 180.0),
        )],
    )
    up = F.greatest(_size_bits(F.col("x1") - F.col("x0")), _size_bits(F.col("y1") - F.col("y0")))
    placed = placed.withColumn("level", F.lit(LEVELS) - up)
    return _cover(placed, F.expr("shiftright(x0, 20 - level)"), F.expr("shiftright(x1, 20 - level)"),
                  F.expr("shiftright(y0, 20 - level)"), F.expr("shiftright(y1, 20 - level)"))


def _cover(boxes: DataFrame, x_from: Column, x_to: Column, y_from: Column, y_to: Column) -> DataFrame:
    """A row per cell `cx`, `cy` of `level`; `whole` tells that the box holds all of it, so that points need no comparing."""
    entries = (
        boxes.withColumn("cx", F.explode(F.sequence(x_from, x_to)))
        .withColumn("cy", F.explode(F.sequence(y_from, y_to)))
        .withColumn("_side", F.expr("shiftleft(1L, 20 - level)"))
    )
    whole = (
        (F.col("cx") * F.col("_side") > F.col("x0"))
        & ((F.col("cx") + 1) * F.col("_side") - 1 < F.col("x1"))
        & (F.col("cy") * F.col("_side") > F.col("y0"))
        & ((F.col("cy") + 1) * F.col("_side") - 1 < F.col("y1"))
    )
    return entries.select("box", "x0", "x1", "y0", "y1", "level", "cx", "cy", whole.alias("whole"))


def _counts(points: DataFrame) -> DataFrame:
    """Points below each cell down to level COUNTED."""
    deepest = points.groupBy(
        F.expr(f"shiftright(_x, {LEVELS - COUNTED})").alias("px"), F.expr(f"shiftright(_y, {LEVELS - COUNTED})").alias("py")
    ).agg(F.count("*").alias("n"))
    levels = deepest.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(COUNTED))))
    up = F.lit(COUNTED) - F.col("level")
    return levels.groupBy(
        F.col("level").alias("at"), *[F.call_function("shiftright", F.col(c), up).alias(c) for c in ("px", "py")]
    ).agg(F.sum("n").alias("n"))


def _with_counts(entries: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds `n`, the points in an entry's cell, or in the cell of level COUNTED around it; cells without points are left out."""
    down = F.greatest(F.col("level") - COUNTED, F.lit(0))
    keyed = entries.withColumns(
        {
            "at": F.least("level", F.lit(COUNTED)),
            "px": F.call_function("shiftright", F.col("cx"), down),
            "py": F.call_function("shiftright", F.col("cy"), down),
        }
    )
    return keyed.join(counts, ["at", "px", "py"]).drop("at", "px", "py")


def cover(points: DataFrame, boxes: DataFrame, crowd: int = 64, work: int = 100_000, splits: int = 4) -> DataFrame:
    """The cells of the tree that hold boxes where there are points: box, level, cx, cy, whole.

    A box lies at the level that fits its size, in four cells at most. A cell in which more than `crowd` boxes
    need comparing, and boxes times points exceed `work`, hands those boxes on to its quarters; a box that holds a
    quarter as a whole is not compared there and stays. A box is handed on `splits` times at most, which bounds its
    cells by about 4 * 4**splits, though few come near it; boxes with equal edges are one (`tag_by_quadtree`).
    """
    counts = staged(_counts(points), "point-counts")
    done = []
    open_ = staged(_with_counts(_own_cells(boxes), counts), "entries")
    for _ in range(splits):
        loads = open_.filter(~F.col("whole")).groupBy("level", "cx", "cy").agg(F.count("*").alias("held"), F.max("n").alias("n"))
        crowded = staged(
            loads.filter((F.col("held") > crowd) & (F.col("held") * F.col("n") > work) & (F.col("level") < LEVELS)).select("level", "cx", "cy"),
            "crowded",
        )
        if crowded.isEmpty():
            break
        cell = ["level", "cx", "cy"]
        handed = open_.filter(~F.col("whole")).join(crowded, cell, "left_semi")
        done.append(open_.filter("whole"))
        done.append(open_.filter(~F.col("whole")).join(crowded, cell, "left_anti"))
        lower = handed.withColumn("level", F.col("level") + 1)
        edges = [
            F.greatest(F.col("cx") * 2, F.expr("shiftright(x0, 20 - level)")),
            F.least(F.col("cx") * 2 + 1, F.expr("shiftright(x1, 20 - level)")),
            F.greatest(F.col("cy") * 2, F.expr("shiftright(y0, 20 - level)")),
            F.least(F.col("cy") * 2 + 1, F.expr("shiftright(y1, 20 - level)")),
        ]
        named = dict(zip(("_a", "_b", "_c", "_d"), edges, strict=True))
        quarters = _cover(lower.withColumns(named).drop("cx", "cy", "n"), *[F.col(c) for c in named])
        open_ = staged(_with_counts(quarters, counts), "entries")
    for part in done:
        open_ = open_.unionByName(part)
    return open_.select("box", "level", "cx", "cy", "whole")


def candidates(points: DataFrame, entries: DataFrame) -> DataFrame:
    """Points (with `_x`, `_y`) next to the boxes of the cells above them: their columns, box and whole.

    A point looks up the levels at which its cell of level NOTED holds boxes. The entries are staged: if they are few,
    they are broadcast and points stay where they are; else AQE splits a cell in which many points lie.
    """
    cell = _cell("level", F.expr("shiftleft(cx, 20 - level)"), F.expr("shiftleft(cy, 20 - level)"))
    keyed = staged(entries.select("box", "whole", "level", "cx", "cy", cell.alias("_key")), "cells")
    # A cell above level NOTED is above all cells of it that it holds.
    up = F.lit(NOTED) - F.least("level", F.lit(NOTED))
    down = F.greatest(F.col("level") - NOTED, F.lit(0))
    first = [F.call_function("shiftright", F.call_function("shiftleft", F.col(c), up), down) for c in ("cx", "cy")]
    last = F.call_function("shiftleft", F.lit(1).cast("long"), up) - 1
    noted = (
        keyed.select("level", *[f.alias(n) for f, n in zip(first, ("nx", "ny"), strict=True)], last.alias("more")).distinct()
        .withColumn("nx", F.explode(F.sequence(F.col("nx"), F.col("nx") + F.col("more"))))
        .withColumn("ny", F.explode(F.sequence(F.col("ny"), F.col("ny") + F.col("more"))))
        .groupBy("nx", "ny").agg(F.sort_array(F.collect_set("level")).alias("_levels"))
    )
    placed = points.withColumns({"nx": F.expr(f"shiftright(_x, {LEVELS - NOTED})"), "ny": F.expr(f"shiftright(_y, {LEVELS - NOTED})")})
    looked = placed.join(F.broadcast(noted), ["nx", "ny"]).withColumn("_level", F.explode("_levels"))
    looked = looked.withColumn("_key", _cell("_level", "_x", "_y")).drop("nx", "ny", "_levels", "_level")
    return looked.join(keyed.select("_key", "box", "whole"), "_key").drop("_key")


def with_places(events: DataFrame) -> DataFrame:
    """Events with coordinates as a struct, `_event`, so that no column name clashes, and their deepest places `_x` and `_y`."""
    known = events.filter(_usable(LAT) & _usable(LON))
    places = _place(LON, -180.0, 360.0).alias("_x"), _place(LAT, -90.0, 180.0).alias("_y")
    return known.select(F.struct(*events.columns).alias("_event"), *places)


def box_groups(boxes: DataFrame) -> DataFrame:
    """Boxes of equal edges as one: edges, their hash `box`, and `names`. Boxes without an edge or turned round are left out."""
    edges = ["lat_min", "lat_max", "lon_min", "lon_max"]
    known = boxes
    for c in edges:
        known = known.filter(_usable(c))
    known = known.filter("lat_min <= lat_max AND lon_min <= lon_max")
    grouped = known.groupBy(*[(F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in edges])
    named = grouped.agg(F.collect_list(F.struct("name")).alias("names"))  # in structs, or null names would go
    return named.withColumn("box", F.xxhash64(*edges))


def tag_by_quadtree(events: DataFrame, boxes: DataFrame, crowd: int = 64, work: int = 100_000, splits: int = 4) -> DataFrame:
    """A row per event and box (name, lat_min, lat_max, lon_min, lon_max) that contains it, edges included, with `chokepoint`.

    The same rows as the other tagging joins, for any number of boxes from small to world-wide ones. Events or boxes with
    null or NaN coordinates match nothing; a box given twice counts twice.
    """
    groups = staged(box_groups(boxes), "boxes")
    found = _inside(with_places(events), groups, ["names"], crowd, work, splits)
    return found.select("_event.*", F.explode("box.names.name").alias("chokepoint"))


def _inside(places: DataFrame, groups: DataFrame, carry: list[str], crowd: int, work: int, splits: int) -> DataFrame:
    """Points (`_event`, `_x`, `_y`) next to each box group that contains them, a struct `box` of its edges and `carry`."""
    entries = cover(places.select("_x", "_y"), groups, crowd, work, splits)
    # Edges ride with the cells, so that a pair is decided where it is found.
    box = F.struct("lat_min", "lat_max", "lon_min", "lon_max", *carry).alias("box")
    near = candidates(places, entries.join(groups, "box").select("level", "cx", "cy", "whole", box))
    inside = (
        F.col("whole")
        | F.col(f"_event.{LAT}").between(F.col("box.lat_min"), F.col("box.lat_max"))
        & F.col(f"_event.{LON}").between(F.col("box.lon_min"), F.col("box.lon_max"))
    )
    return near.filter(inside)


def count_by_quadtree(events: DataFrame, boxes: DataFrame, crowd: int = 64, work: int = 100_000, splits: int = 4) -> DataFrame:
    """name and event_count: the rows of `tag_by_quadtree` by chokepoint, without making them.

    Events of equal coordinates are one point with a count, and boxes of equal edges one box; pairs of these are
    summed to boxes, and only the sums meet the names. So events at a place and names of a box add up, where their
    rows would multiply.
    """
    edges = ["lat_min", "lat_max", "lon_min", "lon_max"]
    groups = staged(box_groups(boxes), "boxes")
    known = events.filter(_usable(LAT) & _usable(LON))
    spots = known.groupBy(LAT, LON).agg(F.count("*").alias("_n"))
    found = _inside(staged(with_places(spots), "spots"), groups.drop("names"), [], crowd, work, splits)
    sums = found.groupBy(*[F.col(f"box.{c}").alias(c) for c in edges]).agg(F.sum("_event._n").alias("n"))
    named = groups.join(staged(sums, "box-counts"), edges).select(F.explode("names.name").alias("name"), "n")
    return named.groupBy("name").agg(F.sum("n").alias("event_count"))
