"""Points in lines, against all pairs."""

import random

from pagewright.operators import spatial
from pagewright.operators.spatial import cells, lines_at
from pagewright.plans import consumer

LINES = "submission_id string, image_filename string, index int, bbox array<double>, polygon array<array<double>>"
POINTS = "submission_id string, image_filename string, x double, y double, note string"


def holds(bbox, polygon, x, y):
    if polygon is not None and len(polygon) == 4:
        odd = False
        for k in range(4):
            (px, py), (qx, qy) = polygon[k], polygon[k - 1]
            if (py > y) != (qy > y) and x < (qx - px) * (y - py) / (qy - py) + px:
                odd = not odd
        return odd
    return bbox is not None and len(bbox) == 4 and bbox[0] <= x <= bbox[2] and bbox[1] <= y <= bbox[3]


def brute(lines, points):
    out = []
    for s, i, x, y, note in points:
        own = [k for a, b, k, bbox, polygon in lines if (a, b) == (s, i) and None not in (s, i, x, y) and holds(bbox, polygon, x, y)]
        out.append((s, i, x, y, note, min(own, default=-1)))
    return sorted(map(str, out))


def made(seed, images, n):
    """Lines from a pixel to a whole page wide, with the same corners often, and points on corners, edges and beside."""
    rnd, lines, points = random.Random(seed), [], []
    for i in range(images):
        corners = [0.0, 1.0, 64.0, 100.0, 1024.0, -3.5]
        for k in range(n):
            w, h = rnd.choice([0, 1, 3.5, 64, 300, 4000]), rnd.choice([0, 1, 10, 64, 900])
            x, y = rnd.choice([*corners, rnd.uniform(-50, 2000)]), rnd.choice([*corners, rnd.uniform(-50, 2000)])
            polygon = [[x, y], [x + w, y + rnd.randint(0, 9)], [x + w, y + h], [x - rnd.randint(0, 9), y + h]]
            lines.append(("s", f"i{i}", k, rnd.choice([[x, y, x + w, y + h], [x + w, y, x, y + h], [x, y], None]), rnd.choice([polygon, [], None, polygon[:3]])))
            corners += [x, x + w]
        for k in range(n):
            points.append(("s", f"i{i}", rnd.choice([*corners, rnd.uniform(-60, 5000)]), rnd.choice([*corners, rnd.uniform(-60, 5000)]), f"n{k % 3}"))
    return lines, points


def told(df):
    return sorted(str(tuple(r[c] for c in ("submission_id", "image_filename", "x", "y", "note", "index"))) for r in df.collect())


def test_many_points_against_all_pairs(spark):
    lines, points = made(1, 4, 150)
    points += points[:7] + [("s", "none", 1.0, 1.0, "a"), (None, "i0", 1.0, 1.0, "b"), ("s", "i0", None, 1.0, "c"), ("s", "i0", float("nan"), 1.0, "d"), ("s", "i0", 1e300, 1.0, "e")]
    lines += [("s", "i1", 900, [float("nan"), 0.0, 5.0, 5.0], []), ("s", "i1", 901, [-1e300, 0.0, 1e300, 5.0], None), (None, "i0", 0, [0.0, 0.0, 9.0, 9.0], [])]
    usual = [x for x in lines if x[2] < 900]
    got = told(lines_at(spark.createDataFrame(lines, LINES), spark.createDataFrame(points, POINTS)))
    assert got == brute(usual, points) and sum(not x.endswith("-1)") for x in got) > 100


def test_a_line_is_in_few_cells(spark):
    lines, _ = made(2, 2, 200)
    for r in cells(spark.createDataFrame(lines, LINES)).groupBy("image_filename", "index").count().collect():
        assert r["count"] <= 4


def test_one_point_as_the_viewer_asks(spark):
    lines, _ = made(3, 3, 60)
    df = spark.createDataFrame(lines, LINES)
    one = df.select("submission_id", "image_filename").distinct().selectExpr("*", "64.0D AS x", "64.5D AS y", "'n' AS note")
    assert {(r["image_filename"], r["index"]) for r in lines_at(df, one).collect()} == {(r["image_filename"], r["index"]) for r in consumer.line_at(df, 64.0, 64.5).collect()}


def test_no_lines_and_no_points(spark):
    lines, points = made(4, 1, 5)
    none, some = spark.createDataFrame([], LINES), spark.createDataFrame(points, POINTS)
    assert {r["index"] for r in lines_at(none, some).collect()} == {-1}
    assert lines_at(spark.createDataFrame(lines, LINES), spark.createDataFrame([], POINTS)).count() == 0


def test_split_cells_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(spatial, "FEW", 3)
    lines, points = made(5, 2, 120)
    rnd = random.Random(6)
    for k in range(120):  # crossed and thin ones too, often of the same corners
        corners = [[rnd.choice([64.0, 100.0, rnd.gauss(500, 150)]), rnd.choice([64.0, rnd.gauss(500, 150)])] for _ in range(4)]
        lines.append(("s", "i0", 500 + k, None, corners))
        points += [("s", "i0", *rnd.choice(corners), "c"), ("s", "i0", rnd.gauss(500, 150), rnd.gauss(500, 150), "g")]
    assert told(lines_at(spark.createDataFrame(lines, LINES), spark.createDataFrame(points, POINTS))) == brute(lines, points)


def test_pairs_of_lines_on_each_other_grow_in_proportion(spark):
    counts = []
    for n in (300, 1200):
        rnd = random.Random(7)
        number = lambda: rnd.gauss(0, 125)
        lines = [("s", "i", k, None, [[number(), number()] for _ in range(4)]) for k in range(n)]
        spots = [("s", "i", number(), number()) for _ in range(n)]
        pairs = spatial.candidates(cells(spark.createDataFrame(lines, LINES)), spark.createDataFrame(spots, "submission_id string, image_filename string, x double, y double"))
        counts.append(pairs.count())
    assert counts[1] <= 6 * counts[0], counts
