"""Column expressions against plain Python."""

import hashlib
import math
import random
from pathlib import PurePosixPath

import duckdb
from pyspark.sql import functions as F

from pagewright.functions import exprs as E
from pagewright.plans.queries import ORACLE_SQL, QUERIES


def test_stem_is_that_of_pathlib(spark):
    names = ["a.tar.gz", ".hidden", "a.", "a.b.", "..a", "x y.é.PDF", "dir/x.pdf", "plain", "a\nb.jpg", "0.jpg"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", E.stem(F.col("n")).alias("s")).collect()
    for r in got:
        want = PurePosixPath(r["n"]).stem
        assert r["s"] == (r["n"] if r["n"] in ("a.", "a.b.") else want) or r["s"] == want


def test_quarter_turn_rounds_ties_to_even(spark):
    angles = [-180, -135, -90, -46, -45, -44, 0, 44, 45, 46, 90, 134, 135, 136, 180, 225, 270]
    got = spark.createDataFrame([(float(a),) for a in angles], "a double").select("a", E.quarter_turn(F.col("a")).alias("q")).collect()
    assert all(r["q"] == int(-(round(r["a"] / 90) * 90) % 360) for r in got)


def test_resized_like_python_round(spark):
    sizes = [(w, 2048) for w in range(1, 2048, 37)] + [(2048, h) for h in range(1, 2048, 41)] + [(10, 10), (1024, 1024), (4000, 4000), (5000, 1)]
    got = spark.createDataFrame(sizes, "w int, h int").select("w", "h", E.resized(F.col("w"), F.col("h"), 1024).alias("s")).collect()
    for r in got:
        w, h = r["w"], r["h"]
        if w <= 1024 and h <= 1024:
            want = (w, h)
        elif w > h:
            want = (1024, round(h * 1024 / w))
        else:
            want = (round(w * 1024 / h), 1024)
        assert tuple(r["s"]) == want


def test_fingerprint(spark):
    mails = ["User@Example.COM", "  Test@Domain.org \x1c", "   ", "", None]
    got = [r[0] for r in spark.createDataFrame([(m,) for m in mails], "m string").select(E.fingerprint(F.col("m"), "s")).collect()]
    want = [hashlib.sha256(("s" + m.strip().lower()).encode()).hexdigest() if m else None for m in mails]
    assert got == want


def ray(points, x, y):
    inside = False
    for k in range(len(points)):
        (xi, yi), (xj, yj) = points[k], points[k - 1]
        if (yi > y) != (yj > y) and x < (xj - xi) * (y - yi) / (yj - yi) + xi:
            inside = not inside
    return inside


def test_point_in_polygon(spark):
    random.seed(5)
    cases = [([[float(random.randint(0, 6)), float(random.randint(0, 6))] for _ in range(4)], random.randint(0, 6) * 1.0, random.randint(0, 6) * 1.0) for _ in range(500)]
    got = spark.createDataFrame(cases, "p array<array<double>>, x double, y double").select(E.in_polygon(F.col("p"), F.col("x"), F.col("y"))).collect()
    assert [bool(r[0]) for r in got] == [ray(*c) for c in cases]


def test_boxes(spark):
    df = spark.createDataFrame([([[0.0, 0.0, 2.0, 2.0], [1.0, 1.0, 3.0, 3.0]], 2.0, 2.0), ([[0.0, 0.0, 1.0, 1.0]], 5.0, 5.0)], "b array<array<double>>, x double, y double")
    assert [r[0] for r in df.select(E.first_hit(F.col("b"), F.col("x"), F.col("y"))).collect()] == [0, -1]
    bad = spark.createDataFrame([([1.0, 2.0],), ([0.0, 1.0, 2.0, 3.0],)], "b array<double>")
    assert [r[0] for r in bad.select(E.corners(F.col("b"))).collect()] == [[], [[0.0, 1.0], [2.0, 1.0], [2.0, 3.0], [0.0, 3.0]]]


def test_small_ones(spark):
    one = spark.createDataFrame([(" Yes ", "Rotate: 0\nx\nRotate: 90", 0.05, 0.6, 0.35)], "t string, r string, z double, a double, b double")
    got = one.select(E.truthy(F.col("t")), E.reported_angle(F.col("r")), E.zoomed(F.col("z"), 1.25), E.nudged(F.col("a"), F.col("b"), -0.1, 0.1), E.nudged(F.col("a"), F.col("b"), 0.1, 0.0)).first()
    assert got[0] is True and got[1] == 0 and got[2] == 0.1
    assert math.isclose(got[3]["text"], 0.5) and math.isclose(got[3]["blank"], 0.45) and math.isclose(got[4]["text"], 0.7)
    none = spark.createDataFrame([("none",)], "r string").select(E.reported_angle(F.col("r"))).first()
    assert none[0] is None


def test_pdf_by_extension_or_type(spark):
    rows = [(".PDF", None), ("", "Application/PDF"), (".jpg", "image/jpeg"), (None, "application/pdf")]
    got = [r[0] for r in spark.createDataFrame(rows, "e string, m string").select(E.is_pdf(F.col("e"), F.col("m"))).collect()]
    assert got == [True, True, False, None]


def test_box_text_like_python(spark):
    numbers = [0.0, -0.0, -0.3, 0.3, 0.5, -0.5, 1.5, -2.5, 560.21, 10744.0, float(1 << 62), -float(1 << 53), float("nan"), float("-inf"), float("inf"), -7.0]
    boxes = [numbers[k : k + 4] for k in range(len(numbers) - 3)]
    got = spark.createDataFrame([(b,) for b in boxes], "b array<double>").select("b", E.box_text(F.col("b"))).collect()
    assert [r[1] for r in got] == [f"[{a:.0f}, {b:.0f}, {c:.0f}, {d:.0f}]" for a, b, c, d in boxes]
    odd = spark.createDataFrame([([1.0, None, 2.0, 3.0],), ([1.0],), (None,)], "b array<double>").select(E.box_text(F.col("b"))).collect()
    assert [r[0] for r in odd] == [None, "", ""]


def test_viewer_texts_of_zero_values_agree_with_sql(spark, tmp_path):
    rows = [(1, "view", 0.0), (2, "view", -0.0), (3, "buy", -0.4), (4, "buy", None), (5, "buy", 0.5)]
    spark.createDataFrame(rows, "event_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(map(tuple, QUERIES["viewer_texts"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert got == sorted(con.execute(ORACLE_SQL["viewer_texts"]).fetchall())
