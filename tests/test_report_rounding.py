"""Shown numbers are rounded half to even, like the scaled value of a binary fraction."""

from lexiloom.plans.report import rounded


def test_ties(spark):
    rows = spark.createDataFrame([(3.125,), (12.125,), (0.375,), (-2.125,), (7.764,), (None,)], "x double")
    assert [r[0] for r in rows.select(rounded("x", 2)).collect()] == [3.12, 12.12, 0.38, -2.12, 7.76, None]
