import random

from pyspark.sql import functions as F

from tidemill.operators import spatial as S


def square(i, x, y, size):
    return (i, f"p{i}", [(x, y), (x + size, y), (x + size, y + size), (x, y + size)])


SCHEMA = "id long, label string, ring array<struct<lon: double, lat: double>>"


def test_polygons_of_mixed_size(spark):
    rng = random.Random(1)
    shapes = [square(i + 1, rng.random() * 100, rng.random() * 100, rng.choice([.01, .3, 5.0])) for i in range(300)] + [square(0, 20.0, 20.0, 50.0)]
    points = [(i, rng.random() * 110 - 5, rng.random() * 110 - 5) for i in range(400)] + [(1000, None, 3.0), (1001, 21.0, 21.0), (1001, 21.0, 21.0)]
    out = S.point_in_polygon(spark.createDataFrame(points, "k long, lon double, lat double"), spark.createDataFrame(shapes, SCHEMA),
                             ("lon", "lat"), "id", "ring", "label")
    got = sorted((r.k, r.area) for r in out.collect())

    def area(x, y):
        hit = [i for i, _, ring in sorted(shapes) if x is not None and ring[0][0] <= x < ring[2][0] and ring[0][1] <= y < ring[2][1]]
        return f"p{hit[0]}" if hit else "not available"
    assert got == sorted((k, area(x, y)) for k, x, y in points)


def test_one_huge_polygon_does_not_lengthen_the_list(spark):
    small = spark.range(10_000).select((F.col("id") % 100 * 1.0).alias("_x0"), F.floor(F.col("id") / 100).cast("double").alias("_y0"))
    boxes = small.select("_x0", (F.col("_x0") + .01).alias("_x1"), "_y0", (F.col("_y0") + .01).alias("_y1"))
    boxes = boxes.unionByName(spark.createDataFrame([(-1e6, 1e6, -1e6, 1e6)], "_x0 double, _x1 double, _y0 double, _y1 double"))
    assert S.cell_list(boxes).count() <= 4 * 10_001


def test_no_polygons(spark):
    points = spark.createDataFrame([(1, 2.0, 3.0)], "k long, lon double, lat double")
    out = S.point_in_polygon(points, spark.createDataFrame([], SCHEMA), ("lon", "lat"), "id", "ring", "label")
    assert [r.area for r in out.collect()] == ["not available"]
