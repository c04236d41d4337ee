from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ticksmith.functions.columns import (blank, grenade_category, not_in_list, opposite_side, safe_ratio,
                                         tick_to_seconds, to_bigint, to_bool, to_int, to_u64)


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("x")).collect()[0]["x"]


def test_blank_to_null(spark):
    assert one(spark, blank("v"), "  ") is None
    assert one(spark, blank("v"), "") is None
    assert one(spark, blank("v"), None) is None
    assert one(spark, blank("v"), " Connector ") == "Connector"
    assert one(spark, blank("v"), "\tx\t") == "\tx\t"     # only spaces are trimmed


@pytest.mark.parametrize("text,expected", [("12", 12), ("12.0", 12), ("12.7", 13), ("12.5", 13),
                                           ("-12.5", -13), ("1e3", 1000), (None, None)])
def test_to_int_rounds_like_the_reference(spark, text, expected):
    assert one(spark, to_int(blank("v")), text) == expected


def test_to_int_rejects_text(spark):
    with pytest.raises(Exception):
        one(spark, to_int(blank("v")), "abc")


def test_to_bigint_keeps_17_digit_ids(spark):
    assert one(spark, to_bigint("v"), "76561198074762801") == 76561198074762801
    assert one(spark, to_bigint("v"), "76561198074762801.0") == 76561198074762801


def test_to_u64(spark):
    assert one(spark, to_u64("v"), "18446744073709551615") == Decimal("18446744073709551615")
    with pytest.raises(Exception):
        one(spark, to_u64("v"), "-1")


@pytest.mark.parametrize("text,expected", [("True", True), ("false", False), ("t", True), ("0", False),
                                           ("yes", True), ("N", False), (None, None)])
def test_to_bool(spark, text, expected):
    assert one(spark, to_bool(blank("v")), text) is expected


def test_safe_ratio_and_seconds(spark):
    df = spark.createDataFrame([(3, 0, 100, 64.0, 0.0)], "h int, k int, t int, r double, z double")
    r = df.select(safe_ratio("h", "k").alias("a"), tick_to_seconds("t", F.lit(36), "r").alias("b"),
                  tick_to_seconds("t", F.lit(36), "z").alias("c")).collect()[0]
    assert r.a is None and r.b == 1.0 and r.c is None


def test_grenade_category_order_and_fallback(spark):
    df = spark.createDataFrame([("CHEGrenadeProjectile",), ("CMolotovProjectile",), ("CIncendiaryGrenade",),
                                ("CDecoyGrenade",), ("chegrenade",), (None,)], "v string")
    got = [r.x for r in df.select(grenade_category("v").alias("x")).collect()]
    assert got == ["HE", "Molotov", "Incendiary", "Decoy", "chegrenade", None]


def test_opposite_side_maps_null_to_ct(spark):
    df = spark.createDataFrame([("ct",), ("t",), (None,), ("spec",)], "v string")
    assert [r.x for r in df.select(opposite_side("v").alias("x")).collect()] == ["t", "ct", "ct", "ct"]


def test_not_in_list_drops_null(spark):
    df = spark.createDataFrame([("CKnife",), ("CFlashbang",), (None,)], "v string")
    assert [r.v for r in df.where(not_in_list("v", ["CKnife"])).collect()] == ["CFlashbang"]
