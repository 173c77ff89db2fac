import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtrail.functions import canon, dates


def test_double_text_is_the_shortest_round_trip(spark):
    r = random.Random(1)
    values = [0.0, -0.0, 1.0, -1.5, 1e7, 1e15, 1e16, 123456789.125, 1e-4, 9.9e-5, 1e-5, 0.1 + 0.2, 1e22, 2.2e-322,
              1.7976931348623157e308, float("inf"), -float("inf"), float("nan"), 8.466767299456532e17, 0.001, 12345678901234567.0]
    values += [r.uniform(-1, 1) * 10 ** r.randint(-8, 17) for _ in range(5000)]
    values += [round(r.uniform(0, 1e6), 2) + 10 for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wrong = [(r.v, r.t) for r in df.select("v", canon.canonical_text(F.col("v"), T.DoubleType()).alias("t")).collect() if r.t != repr(r.v)]
    assert wrong == []


def test_other_texts(spark):
    row = spark.range(1).select(
        canon.canonical_text(F.lit(True), T.BooleanType()).alias("t"),
        canon.canonical_text(F.lit(False), T.BooleanType()).alias("f"),
        canon.canonical_text(F.lit(42), T.IntegerType()).alias("i"),
        canon.canonical_text(F.lit("hello"), T.StringType()).alias("s"),
        canon.canonical_text(F.lit(None).cast("double"), T.DoubleType()).alias("n"),
    ).first()
    assert tuple(row) == ("1", "0", "42", "hello", None)


def test_differs_across_types(spark):
    def differs(old, old_type, new, new_type):
        return spark.range(1).select(canon.differs(F.lit(old).cast(old_type), old_type, F.lit(new).cast(new_type), new_type)).first()[0]

    text, flag, whole, number = T.StringType(), T.BooleanType(), T.LongType(), T.DoubleType()
    assert not differs("1", text, True, flag)
    assert not differs("0", text, False, flag)
    assert differs("True", text, True, flag)
    assert not differs(4, whole, 4.0, number)
    assert differs(None, text, "x", text)
    assert not differs(None, number, None, text)


def test_lenient_casts(spark):
    texts = ["12abc", "abc", "", "3.9", "1e3", " 7", "-5x", None, "99999999999999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(canon.lenient_integer(F.col("t")).alias("i"), canon.lenient_real(F.col("t")).alias("r")).collect()
    assert [r.i for r in got] == [12, 0, 0, 3, 1, 7, -5, None, 0]
    assert [r.r for r in got] == [12.0, 0.0, 0.0, 3.9, 1000.0, 7.0, -5.0, None, 1e20]


def test_migrated_value_takes_the_first_match_once(spark):
    df = spark.createDataFrame([("a",), ("b",), ("7x",), (None,)], "t string")
    got = df.select(canon.migrated_value(F.col("t"), T.StringType(), "INTEGER", [("a", "1"), ("1", "2"), ("a", "9")]).alias("v"))
    assert [r.v for r in got.collect()] == [1, 0, 7, None]


def test_text_dates(spark):
    cases = {
        "2026-08-04": "2026-08-04", "2026-08-04T14:00:00.000-05:00": "2026-08-04", "2026-08-04T23:30:00-05:00": "2026-08-05",
        "2026": None, "2026-08": None, "soon": None, "": None, "2026-13-01": None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r.t: r.d for r in df.select("t", dates.to_date(F.col("t")).cast("string").alias("d")).collect()}
    assert got == cases


def test_ranges(spark):
    cases = {
        "2026-06-01": ("2026-06-01", None), "a/b": ("a", "b"), "a/b/c": ("a", "b/c"), "2026-06-01T09:00:00.000-05:00": ("2026-06-01T09:00:00.000-05:00", None), "a/": ("a", ""),
    }
    df = spark.createDataFrame([(t,) for t in [*cases, None]], "t string")
    got = {r.t: (r.s, r.e) for r in df.select("t", dates.range_start(F.col("t")).alias("s"), dates.range_end(F.col("t")).alias("e")).collect()}
    assert got == {**cases, None: (None, None)}
