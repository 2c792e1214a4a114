import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from marquee.functions import dates as D
from marquee.functions import json as J
from marquee.functions import keys as K
from marquee.functions import outcome as O
from marquee.functions import text as T


def one(spark, expr, data=None, schema="x string"):
    df = spark.createDataFrame(data or [(None,)], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_normalize_ws(spark):
    got = one(spark, T.normalize_ws("x"), [("  A   B ",), ("A\tB",), ("\tA  B",), (None,)])
    assert got == ["A B", "A B", " A B", None]


def test_null_markers(spark):
    got = one(spark, T.null_if_marker("x"), [("",), ("-",), ("12",), (None,)])
    assert got == [None, None, "12", None]


def test_na_and_digits_and_numbers(spark):
    assert one(spark, T.na_to_null("x"), [("N/A",), ("n/a",)]) == [None, "n/a"]
    assert one(spark, T.first_digits("x"), [("181 min",), ("abc",), ("87%",)]) == ["181", None, "87"]
    assert one(spark, T.try_number(T.strip_money("x")), [("$858,373,000",), ("N/A",)]) == \
        [Decimal(858373000), None]
    assert one(spark, T.try_number("x", 4, 1), [("8.45",), ("bad",)]) == [Decimal("8.5"), None]
    assert one(spark, T.try_number("x"), [("7.5",)]) == [Decimal(8)]


def test_truncate_and_prefix(spark):
    assert one(spark, T.truncate("x", 3), [("abcdef",)]) == ["abc"]
    assert one(spark, T.strip_prefix("x", "inbox/"), [("inbox/a/b",), ("raw/x",)]) == ["a/b", "raw/x"]


def test_keys(spark):
    import hashlib
    got = one(spark, K.record_id(F.lit(None).cast("string"), F.lit("Heat"), F.lit(1995)))
    assert got == ["notfound_" + hashlib.sha1(b"Heat|1995").hexdigest()[:12]]
    assert one(spark, K.record_id(F.lit("tt1"), F.lit("Heat"), F.lit(1995))) == ["tt1"]
    assert one(spark, K.md5_key("x"), [("Fox",)]) == [hashlib.md5(b"Fox").hexdigest()]
    path = one(spark, K.doc_object_path(F.to_timestamp_ntz(F.lit("2024-03-05 10:00:00")), F.lit("tt9")))
    assert path == ["raw/omdb/yyyy=2024/mm=03/dd=05/tt9.json"]


def test_calendar_spine_bounds(spark):
    cal = D.spine(spark).select(*D.calendar_columns("date_day"))
    assert cal.count() == 9497
    keys = {r[0] for r in cal.select("date_key").collect()}
    assert 20000229 in keys and 20251231 in keys and 20260101 not in keys
    r = cal.where(F.col("date_key") == 20240107).first()  # a Sunday
    assert (r.day_of_week, r.day_name, r.month_name, r.is_weekend, r.quarter) == (0, "Sun", "Jan", True, 1)
    r = cal.where(F.col("date_key") == 20240110).first()
    assert (r.day_of_week, r.day_name, r.is_weekend) == (3, "Wed", False)


def test_padded_calendar_and_labels(spark):
    df = spark.createDataFrame([(dt.date(2003, 5, 2),), (dt.date(2004, 1, 9),)], "d date")
    cal = D.spine_between(D.year_padded_bounds(df, "d"))
    assert cal.count() == 365 + 366
    assert one(spark, D.month_full_name(F.lit(2))) == ["February"]
    assert one(spark, D.quarter_label(D.quarter_no(F.lit(8)))) == ["Qtr 3"]


def test_dst_offset(spark):
    got = one(spark, D.local_from_utc_dst_approx(F.to_timestamp_ntz("x")),
              [("2024-07-01 10:00:00",), ("2024-11-01 10:00:00",)])
    assert got == [dt.datetime(2024, 7, 1, 12), dt.datetime(2024, 11, 1, 11)]


def test_day_range(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 30, 0, 0),), (dt.datetime(2024, 1, 30, 23, 59),),
                                (dt.datetime(2024, 1, 31, 0, 0),), (dt.datetime(2024, 1, 29, 23, 59),)],
                               "t timestamp_ntz")
    assert df.where(D.day_range("t", "2024-01-30")).count() == 2


def test_outcome_classification_order(spark):
    data = [("timeout", None, None, None), ("other", 500, "boom", None), (None, 429, "x", None),
            (None, 503, "Service Unavailable", None), (None, 404, "Not Found", None),
            (None, 200, "OK", '{"Response":"True"}'), (None, 200, "OK", '{"Response":"False","Error":"nf"}'),
            (None, 200, "OK", '{"Search":[]}')]
    df = spark.createDataFrame(data, "error_kind string, http_status int, reason string, body string")
    o, s, m = O.classify()
    got = [tuple(r) for r in df.select(o, s, m).collect()]
    assert got == [("error_timeout", None, "request timed out"), ("error_other", None, "boom"),
                   ("error_429", 429, "rate limit"), ("error_5xx", 503, "Service Unavailable"),
                   ("error_other", 404, "Not Found"), ("found", 200, None), ("not_found", 200, "nf"),
                   ("error_other", 200, "unexpected response shape")]


def test_failed_write_remap(spark):
    df = spark.createDataFrame([("found", None, False), ("found", None, True), ("error_429", "rl", False)],
                               "o string, m string, ok boolean")
    o, m = O.remap_failed_write("o", "m", "ok", F.lit("denied"))
    got = [tuple(r) for r in df.select(o, m).collect()]
    assert got[0] == ("error_other", "write failed (orig outcome=found): denied")
    assert got[1] == ("found", None) and got[2] == ("error_429", "rl")


def test_merge_objects_later_keys_win(spark):
    got = one(spark, J.merge_objects(F.lit('{"a":1,"_s":"x","n":[1,2]}'), F.lit('{"a":2,"b":{"c":3}}')))
    import json
    assert json.loads(got[0]) == {"a": 2, "_s": "x", "n": [1, 2], "b": {"c": 3}}


def test_variant_keys_are_case_sensitive(spark):
    df = spark.createDataFrame([('{"type":"movie"}',), ('{"Type":"movie"}',)], "j string")
    got = [r[0] for r in df.select(J.vget(J.parse("j"), "$.Type")).collect()]
    assert got == [None, "movie"]


def test_display_formats(spark):
    from marquee.functions import formats as FM
    df = spark.createDataFrame([(1234567.0,), (-9876.4,), (0.0,)], "x double")
    assert [r[0] for r in df.select(FM.money("x")).collect()] == ["$1,234,567", "($9,876)", "$0"]
    assert [r[0] for r in df.select(FM.money_millions(F.col("x") / 1e6)).collect()][0] == "$1.2M"
    assert one(spark, FM.one_decimal(F.lit(7.25))) == ["7.3"]
    assert one(spark, FM.refresh_time(F.to_timestamp_ntz(F.lit("2024-07-01 12:05:09")))) == ["2024-07-01 12:05"]
