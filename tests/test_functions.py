import hashlib

from pyspark.sql import functions as F

from riskweave import functions as RF


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_ratio_zero_denominator_is_null(spark):
    assert one(spark, RF.ratio(F.lit(3), F.lit(0))) is None
    assert one(spark, RF.ratio(F.lit(1), F.lit(4))) == 0.25


def test_ratio_half_up_is_exact_decimal_rounding(spark):
    # 631/800 = 0.78875 exactly: half-up gives 0.7888 (binary rounding would give 0.7887)
    assert one(spark, RF.ratio_half_up(F.lit(631), F.lit(800), 4)) == 0.7888
    assert one(spark, RF.ratio_half_up(F.lit(1), F.lit(3), 4)) == 0.3333
    assert one(spark, RF.ratio_half_up(F.lit(2), F.lit(3), 4)) == 0.6667
    assert one(spark, RF.ratio_half_up(F.lit(5), F.lit(0), 4)) is None


def test_round_half_up_and_clamp(spark):
    assert one(spark, RF.round_half_up(F.lit(2.345678), 2)) == 2.35
    assert one(spark, RF.round_half_up(F.lit(0.123449), 4)) == 0.1234
    assert one(spark, RF.clamp(F.lit(1.7), 0.0, 1.0)) == 1.0
    assert one(spark, RF.clamp(F.lit(-0.2), 0.0, 1.0)) == 0.0
    assert one(spark, RF.clamp(F.lit(0.3), 0.0, 1.0)) == 0.3
    assert one(spark, RF.clamp(F.lit(None).cast("double"), 0.0, 1.0)) is None


def test_band_thresholds_inclusive(spark):
    b = lambda v: one(spark, RF.band(F.lit(v), (0.70, 0.40), ("Alto", "Medio", "Baixo")))
    assert b(0.70) == "Alto"
    assert b(0.69996) == "Medio"
    assert b(0.40) == "Medio"
    assert b(0.3999) == "Baixo"
    assert one(spark, RF.band(F.lit(None).cast("double"), (0.7, 0.4), ("A", "M", "B"))) == "B"


def test_flags_strict_and_null(spark):
    assert one(spark, RF.flag(F.lit(2200), "lt", 2200)) == 0.0
    assert one(spark, RF.flag(F.lit(2199.99), "lt", 2200)) == 1.0
    assert one(spark, RF.flag(F.lit(8.0), "gt", 8)) == 0.0
    assert one(spark, RF.flag(F.lit(0), "eq0")) == 1.0
    assert one(spark, RF.flag(F.lit(None).cast("string"), "eq", "Evadido")) == 0.0


def test_hash_bucket_matches_md5_rule(spark):
    rows = spark.range(50).select("id", RF.hash_bucket("id").alias("b")).collect()
    for r in rows:
        expect = int(hashlib.md5(str(r["id"]).encode()).hexdigest()[:6], 16) % 100
        assert r["b"] == expect


def test_text_formats(spark):
    assert one(spark, RF.percent_text(F.lit(0.1234), 1)) == "12.3%"
    assert one(spark, RF.percent_text(F.lit(0.12345), 1)) == "12.3%"
    assert one(spark, RF.percent_text(F.lit(0.0), 1)) == "0.0%"
    assert one(spark, RF.short_percent_text(F.lit(0.125))) == "12.5%"
    assert one(spark, RF.short_percent_text(F.lit(0.12))) == "12.0%"
    assert one(spark, RF.short_percent_text(F.lit(0.1205))) == "12.05%"
    assert one(spark, RF.thousands_text(F.lit(1234567))) == "1.234.567"
    assert one(spark, RF.thousands_text(F.lit(999))) == "999"
