import datetime as dt

from pyspark.sql import functions as F

from tenderlens.functions import expr as X


def col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_parse_rate_fixture(spark):
    # FIXTURES 6: first decimal number, integers without a dot are not rates (Q15)
    d = col(spark, ["99.12345 (-0.87)", "-1", "100", "a -0.5 b", None])
    got = [r[0] for r in d.select(X.parse_rate("v")).collect()]
    assert got == [99.12345, None, None, -0.5, None]


def test_range_level_after_strip(spark):
    d = col(spark, [" +3% ~ -3%", "+2%~-2% ", "-3%~+3%", "+0% ~ -6%"])
    got = [r[0] for r in d.select(X.range_level(X.strip_whitespace("v"))).collect()]
    assert got == [3, 2, 0, 0]


def test_range_bounds(spark):
    d = col(spark, ["+0%~-6%", "-1.5%~+2%", "3%"])
    got = [tuple(r[0]) for r in d.select(X.range_bounds("v")).collect()]
    assert got == [(-6.0, 0.0, True), (-1.5, 2.0, True), (None, None, False)]


def test_strip_whitespace_null_is_nan(spark):
    d = col(spark, [None, " a b\tc "])
    assert [r[0] for r in d.select(X.strip_whitespace("v")).collect()] == ["nan", "abc"]


def test_days_between_floor(spark):
    d = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 12))], "a timestamp, b timestamp")
    assert d.select(X.days_between("a", "b")).first()[0] == -2


def test_weekday_monday_zero(spark):
    d = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "a timestamp")
    parts = d.select(*X.date_parts("a", "a")).first().asDict()
    assert parts == {"a_year": 2024, "a_month": 1, "a_day": 1, "a_weekday": 0, "a_quarter": 1}


def test_safe_ratio_guarded_and_unguarded(spark):
    d = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "a double, b double")
    g = [r[0] for r in d.select(X.safe_ratio("a", "b")).collect()]
    u = [r[0] for r in d.select(X.safe_ratio("a", "b", zero_default=False)).collect()]
    assert g == [0.0, 0.5] and u == [None, 0.5]


def test_normalize_text_keeps_hangul(spark):
    d = col(spark, ["공고-제목, ABC!"])
    assert d.select(X.normalize_text("v")).first()[0] == "공고 제목  abc "


def test_target_labels():
    names = X.all_target_names()
    assert len(names) == 180 and names[0] == "010_001" and names[-1] == "100_100"
