import pytest
from pyspark.sql import functions as F

from thalweg.functions import text as X


def test_points_come_in_groups_of_four(spark):
    one = lambda t: spark.createDataFrame([(t,)], "t string").select(X.parsed_points(F.col("t")).alias("p")).first().p
    assert [tuple(p) for p in one(" A, 1,2.5,-2,B,3,4,1")] == [("A", 1.0, 2.5, -2), ("B", 3.0, 4.0, 1)]
    assert one(None) == [] and one("  ") == []
    with pytest.raises(Exception, match="groups of four"):
        one("A,1,2")


def test_boxes_are_checked():
    assert X.parsed_bounds("10,20,-10,-20") == (-10, -20, 10, 20)
    for wrong in ("1,2,3", "a,b,c,d", None, "0,0,190,10", "0,-91,1,1"):
        with pytest.raises(ValueError):
            X.parsed_bounds(wrong)


def test_columns_are_found_whatever_their_case(spark):
    df = spark.createDataFrame([(1, 2)], "Id long, NAME long")
    assert X.resolved(df, ["id", "name", "nid"], ["nid"]).collect() == [(1, 2, None)]
    with pytest.raises(ValueError):
        X.resolved(df, ["nothing"])


def test_uuids(spark):
    rows = [("0f8fad5b-d9cb-469f-a165-70867728950e",), (" 0F8FAD5BD9CB469FA16570867728950E ",), ("no",), (None,)]
    got = spark.createDataFrame(rows, "t string").select(X.parsed_uuid(F.col("t")).alias("u"), X.is_uuid(F.col("t")).alias("p")).collect()
    assert [tuple(r) for r in got] == [(rows[0][0], True), (rows[0][0], False), (None, False), (None, False)]
