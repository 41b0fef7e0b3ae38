import hashlib

from pyspark.sql import functions as F

from lumenmart import functions as X


def one(spark, column, data=(1,)):
    return spark.createDataFrame([data], [f"c{i}" for i in range(len(data))]).select(column.alias("x")).first()["x"]


def test_surrogate_key_is_sixty_bits_of_md5(spark):
    expected = int(hashlib.md5(b"2026.1").hexdigest()[:15], 16)
    assert one(spark, X.surrogate_key(F.lit("2026.1"))) == expected
    assert one(spark, X.surrogate_key("c0"), ("2026.1",)) == expected
    assert X.surrogate_key_of("2026.1") == expected
    assert one(spark, X.surrogate_key(F.lit(None).cast("string"))) is None


def test_date_keys_round_trip(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-07-15 14:30:00' AS t").withColumn("k", X.date_key("t"))
    row = df.select("k", X.key_to_date("k").alias("d"), X.month_key("t").alias("m")).first()
    assert (row["k"], str(row["d"]), row["m"]) == (20260715, "2026-07-15", "2026-07")


def test_ratio_rounds_half_up_and_survives_zero(spark):
    df = spark.createDataFrame([(2675, 1000), (1, 8), (1, 0), (-1, 8)], "n bigint, d bigint")
    got = [r["x"] for r in df.select(X.ratio("n", "d", 2).alias("x")).collect()]
    assert got == [2.68, 0.13, None, -0.13]
    assert one(spark, X.ratio(F.lit(100), F.lit(0))) is None


def test_clean_name(spark):
    assert one(spark, X.clean_name("c0"), ("   Prof.   João\t Carlos   Silva  ",)) == "Prof. João Carlos Silva"


def test_json_fields(spark):
    payload = '{"a": "7", "b": true, "n": null}'
    assert one(spark, X.json_int("c0", "a"), (payload,)) == 7
    assert one(spark, X.json_field("c0", "missing", "b"), (payload,)) == "true"
    assert one(spark, X.json_field("c0", "n"), (payload,)) is None
    assert one(spark, X.json_int("c0", "a"), ("{broken",)) is None


def test_seconds_round(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-01-01 00:00:00' a, timestamp_ntz'2026-01-01 00:07:00.5' b")
    assert df.select(X.seconds_between("a", "b").alias("s")).first()["s"] == 421
