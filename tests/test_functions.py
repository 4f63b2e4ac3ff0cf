"""Row tests for the Column helpers (pricing rule, segments, labels)."""
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.columns import recommend, rfm_segment, stock_band, price_position


def _rec(spark, rows):
    df = spark.createDataFrame(rows, "price double, avg double, v double")
    r = df.select(recommend(F.col("price"), F.col("avg"), F.col("v")).alias("r")).select("r.*")
    return [tuple(x) for x in r.collect()]


def test_recommend_boundaries(spark):
    # gap exactly +10 / -10 is not enough to move
    got = _rec(spark, [(110.0, 100.0, 0.0), (90.0, 100.0, 9.0)])
    assert [g[0] for g in got] == ["hold", "hold"]
    assert got[0][2] == pytest.approx(0.5) and got[0][1] == 110.0


def test_recommend_velocity_thresholds(spark):
    got = _rec(spark, [(130.0, 100.0, 1.99), (130.0, 100.0, 2.0), (70.0, 100.0, 4.99), (70.0, 100.0, 5.0)])
    assert [g[0] for g in got] == ["lower", "hold", "hold", "raise"]
    # confidence capped at 1.0 for |gap| = 30; moved price = avg * 0.99
    assert got[0][1] == 99.0 and got[0][2] == 1.0
    assert got[3][1] == 99.0 and got[3][2] == 1.0
    # hold floor 0.5
    assert got[1][2] == 0.5


def test_recommend_partial_confidence(spark):
    got = _rec(spark, [(115.0, 100.0, 0.0), (103.0, 100.0, 0.0)])
    assert got[0] == ("lower", 99.0, 0.75)
    assert got[1] == ("hold", 103.0, 0.85)


@pytest.mark.parametrize("r,f,m,seg", [
    (5, 5, 5, "Champions"), (3, 4, 1, "Loyal Customers"), (4, 2, 1, "Potential Loyalists"),
    (2, 1, 5, "Big Spenders"), (2, 3, 3, "At Risk"), (1, 1, 1, "Lost"), (3, 3, 3, "Needs Attention"),
])
def test_rfm_segment_branches(spark, r, f, m, seg):
    df = spark.createDataFrame([(r, f, m)], "r int, f int, m int")
    assert df.select(rfm_segment(F.col("r"), F.col("f"), F.col("m"))).first()[0] == seg


def test_stock_band_and_price_position(spark):
    df = spark.createDataFrame([(9, 100.0, 110.0, 120.0), (10, 130.0, 100.0, 110.0), (30, None, None, None)],
                               "s int, our double, mn double, mx double")
    out = df.select(stock_band(F.col("s")), price_position(F.col("our"), F.col("mn"), F.col("mx"))).collect()
    assert [tuple(r) for r in out] == [("red", "cheaper"), ("amber", "pricier"), ("green", "competitive")]
