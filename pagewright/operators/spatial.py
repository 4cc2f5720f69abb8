"""Which line of its image a point lies in, for many points at once.

Lines are dealt to the cells of grids whose cells are as wide as a power of two: a
line goes to the finest grid in which it is no wider than a cell, and so to four cells
at most, however large it is. A point is looked up in its one cell of each grid in use.
Both sides meet by an equi-join on image, grid and cell, so neither a large image nor a
large line makes all pairs; whether a point lies in a line is then tested exactly.

A cell in which many lines meet many points is split, and again what it is split into.
A line stays in those parts through which its outline runs and in those that it covers.
Only the first line that holds a point is wanted, so lines after the first that covers
a part leave it: where lines lie on each other, few are left in a small part. Equal
lines are one, and so are equal points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import exprs as E
from pagewright.sources.scratch import kept

IMAGE = ["submission_id", "image_filename"]
#: Numbers of a larger size are no pixels: a line with one holds no point.
LARGEST = float(1 << 50)
#: A cell is split while it has more lines than this and more points, into a power of two a side, down to a width of two to FINEST.
FEW = 32
STEP = 2
FINEST = -8
CELL = [*IMAGE, "tree", "grid", "cx", "cy"]


def _sides(shape: Column, axis: int) -> tuple[Column, Column]:
    own = F.transform(shape, lambda p: p[axis])
    return F.array_min(own), F.array_max(own)


def cells(lines: DataFrame) -> DataFrame:
    """A row for each cell that a line may lie in: IMAGE, grid, cx, cy, index, bbox, polygon (of four points, else empty)."""
    left, top, right, bottom = (F.get("bbox", F.lit(k)) for k in range(4))
    corners = F.when(F.size("bbox") == 4, F.array(F.array(left, top), F.array(right, bottom)))
    shaped = lines.select(*IMAGE, "index", "bbox", E.four_points(F.col("polygon")).alias("polygon")).withColumn("shape", F.when(F.size("polygon") == 4, F.col("polygon")).otherwise(corners))
    (x0, x1), (y0, y1) = _sides(F.col("shape"), 0), _sides(F.col("shape"), 1)
    # a box whose sides are the wrong way round holds nothing
    able = (F.size("polygon") == 4) | ((left <= right) & (top <= bottom))
    boxes = shaped.withColumns({"x0": x0, "x1": x1, "y0": y0, "y1": y1}).filter(able & (F.greatest(F.abs("x0"), F.abs("x1"), F.abs("y0"), F.abs("y1")) <= LARGEST))
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(1.0))
    grid = F.ceil(F.log2(side)).cast("int")
    placed = boxes.withColumn("side", side).withColumn("grid", F.when(F.pow(F.lit(2.0), grid) < F.col("side"), grid + 1).otherwise(grid))
    each = [F.explode(F.sequence(_cell(F.col(f"{a}0")), _cell(F.col(f"{a}1")))).alias(f"c{a}") for a in "xy"]
    return placed.select(*IMAGE, "grid", "index", "bbox", "polygon", "y0", "y1", each[0]).select(*IMAGE, "grid", "index", "bbox", "polygon", "cx", each[1])


def _cell(number: Column) -> Column:
    return F.floor(number / F.pow(F.lit(2.0), F.col("grid"))).cast("long")


def _runs_through(p: Column, q: Column, x0: Column, y0: Column, side: Column, slack: Column) -> Column:
    """Whether the edge from p to q comes nearer than ``slack`` to a cell; true where it has no numbers."""
    dx, dy, half = q[0] - p[0], q[1] - p[1], side / 2
    beside = [(F.least(p[k], q[k]) <= o + side + slack) & (F.greatest(p[k], q[k]) >= o - slack) for k, o in enumerate((x0, y0))]
    away = F.abs((x0 + half - p[0]) * dy - (y0 + half - p[1]) * dx) > (half + slack) * (F.abs(dx) + F.abs(dy))
    return F.coalesce(beside[0] & beside[1] & ~away, F.lit(True))


def _parts(placed: DataFrame) -> DataFrame:
    """Rows of ``cells`` in the parts of their cells, with ``covers``: whether the line holds all of the part."""
    n = 1 << STEP
    part = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_x")).select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_y"))
    part = part.withColumns({"grid": F.col("grid") - STEP, "cx": F.col("cx") * n + F.col("_x"), "cy": F.col("cy") * n + F.col("_y")})
    side = F.pow(F.lit(2.0), F.col("grid"))
    part = part.withColumns({"_side": side, "_x0": F.col("cx") * side, "_y0": F.col("cy") * side})
    x0, y0, side = F.col("_x0"), F.col("_y0"), F.col("_side")
    x1, y1 = x0 + side, y0 + side
    corner = [F.get("polygon", F.lit(k)) for k in range(4)]
    # far wider than the rounding of E.in_polygon, which is so the same in all of a part without an edge
    slack = side * 2.0**-20 + F.greatest(F.abs(x0), F.abs(y0), *(F.abs(c[k]) for c in corner for k in range(2))) * 2.0**-40
    edge = _runs_through(corner[0], corner[3], x0, y0, side, slack)
    for k in range(3):
        edge = edge | _runs_through(corner[k + 1], corner[k], x0, y0, side, slack)
    left, top, right, bottom = (F.get("bbox", F.lit(k)) for k in range(4))
    lies = (left <= x1) & (right >= x0) & (top <= y1) & (bottom >= y0)
    holds = (left <= x0) & (right >= x1) & (top <= y0) & (bottom >= y1)
    drawn = F.size("polygon") == 4
    marked = part.withColumn("_edge", F.when(drawn, edge).otherwise(lies & ~holds))
    whole = F.when(F.col("_edge"), False).when(drawn, E.in_polygon(F.col("polygon"), x0 + side / 2, y0 + side / 2)).otherwise(holds)
    return marked.withColumn("covers", whole).filter("_edge OR covers").drop("_x", "_y", "_x0", "_y0", "_side", "_edge")


def _first_ones(parts: DataFrame) -> DataFrame:
    """``parts`` without lines after the first that covers their part."""
    first = parts.filter("covers").groupBy(*CELL).agg(F.min("index").alias("_first"))
    return parts.join(first, CELL, "left").filter("_first IS NULL OR index <= _first").drop("_first", "covers")


def candidates(dealt: DataFrame, spots: DataFrame) -> DataFrame:
    """Pairs of ``spots`` (distinct IMAGE, x, y) and lines of ``dealt`` (written ``cells``) among which is the first line that holds each: IMAGE, x, y, index, bbox, polygon."""
    dealt = dealt.withColumn("tree", F.col("grid"))
    trees = [r["tree"] for r in dealt.select("tree").distinct().collect()]  # at most one for each power of two up to LARGEST
    sought = spots.select("*", F.explode(F.array(*map(F.lit, trees)).cast("array<int>")).alias("tree")).withColumn("grid", F.col("tree"))
    pairs = None
    while True:
        sought = kept(sought.withColumns({"cx": _cell(F.col("x")), "cy": _cell(F.col("y"))}))
        both = dealt.groupBy(*CELL).agg(F.count("*").alias("lines")).join(sought.groupBy(*CELL).agg(F.count("*").alias("points")), CELL)
        state = kept(both.select(*CELL, ((F.least("lines", "points") > FEW) & (F.col("grid") - STEP >= FINEST)).alias("split")))
        met = dealt.join(state.filter("NOT split").drop("split"), CELL).join(sought, CELL).select(*IMAGE, "x", "y", "index", "bbox", "polygon")
        pairs = met if pairs is None else pairs.unionByName(met)
        split = state.filter("split").drop("split")
        if split.isEmpty():
            return pairs
        dealt = kept(_first_ones(_parts(dealt.join(split, CELL))))
        sought = sought.join(split, CELL, "left_semi").withColumn("grid", F.col("grid") - STEP)


def lines_at(lines: DataFrame, points: DataFrame) -> DataFrame:
    """``points`` (IMAGE, x, y and more) with ``index``, that of the first line of their image which holds them, or -1.

    A line of four polygon points holds what lies in the polygon (even-odd), any other
    what lies in its box of four numbers, edges included, as in ``consumer.line_at``. Points
    without an image or a number lie in no line; each repeated point gets its row.
    """
    every = kept(points)
    shapes = lines.groupBy(*IMAGE, "bbox", "polygon").agg(F.min("index").alias("index"))
    spots = every.select(*IMAGE, "x", "y").filter((F.abs("x") <= LARGEST) & (F.abs("y") <= LARGEST)).distinct()
    inside = F.when(F.size("polygon") == 4, E.in_polygon(F.col("polygon"), F.col("x"), F.col("y"))).otherwise(E.in_box(F.col("bbox"), F.col("x"), F.col("y")))
    first = candidates(kept(cells(shapes)), spots).filter(inside).groupBy(*IMAGE, "x", "y").agg(F.min("index").alias("index"))
    return every.join(first, [*IMAGE, "x", "y"], "left").select(*points.columns, F.coalesce("index", F.lit(-1)).alias("index"))
