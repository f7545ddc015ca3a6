import datetime

import pytest
from pyspark.sql import functions as F

from watchlens.functions import identity, jsontext, times, weights


def values(spark, rows, schema, column):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize("user", ["user-00001", "김A", "한글사용자", "a😀b", "", "user-12345678"])
def test_ab_group_adds_code_points(spark, user):
    total = sum(ord(c) for c in user)
    df = spark.createDataFrame([(user,)], "u string")
    row = df.select(identity.code_point_sum(F.col("u")), identity.ab_group(F.col("u"))).first()
    assert tuple(row) == (total, "A" if total % 2 == 0 else "B")


def test_known_ab_labels(spark):
    assert values(spark, [("user-00001",), ("김A",)], "u string", identity.ab_group(F.col("u"))) == ["B", "B"]


def test_ids_keep_wide_numbers(spark):
    got = values(spark, [(7,), (1234567,)], "n bigint", identity.prefixed_id("user", F.col("n")))
    assert got == ["user-00007", "user-1234567"]


def test_pseudonym_is_stable_and_salted(spark):
    df = spark.createDataFrame([("u",)], "u string")
    a, b, c = df.select(*[identity.pseudonym(F.col("u"), salt) for salt in ("x", "x", "y")]).first()
    assert a == b != c and len(a) == 64


@pytest.mark.parametrize(
    "text, wall",
    [
        ("2026-01-06T04:55:51.579395Z", datetime.datetime(2026, 1, 6, 4, 55, 51, 579395)),
        ("2025-01-03T10:30:45.123Z", datetime.datetime(2025, 1, 3, 10, 30, 45, 123000)),
        ("2025-01-03T10:30:45Z", datetime.datetime(2025, 1, 3, 10, 30, 45)),
        ("2025-01-03T10:30:45+00:00", datetime.datetime(2025, 1, 3, 10, 30, 45)),
        ("2025-01-03T19:30:45+09:00", datetime.datetime(2025, 1, 3, 10, 30, 45)),
        ("not a time", None),
        ("", None),
        (None, None),
    ],
)
def test_iso_text_is_read_as_utc(spark, text, wall):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(times.utc_wall_clock(times.parse_iso(F.col("t")))).first()[0] == wall


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    wall = datetime.datetime(2026, 3, 29, 2, 30, 0, 123456)
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
        df = spark.createDataFrame([("2026-03-29T02:30:00.123456Z",)], "t string")
        instant = times.parse_iso(F.col("t"))
        back = times.utc_wall_clock(times.utc_instant(times.utc_wall_clock(instant)))
        row = df.select(times.utc_wall_clock(instant), back, times.format_iso(times.utc_wall_clock(instant))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == (wall, wall, "2026-03-29T02:30:00.123Z")


@pytest.mark.parametrize(
    "text, expected",
    [
        ('["a", "b"]', ["a", "b"]),
        ('"[\\"SF\\", \\"역사\\"]"', ["SF", "역사"]),
        ('["a", " ", ""]', ["a"]),
        ("", []),
        ("   ", []),
        ("[bad", []),
        ('{"a": 1}', []),
        ('"plain"', []),
        (None, []),
    ],
)
def test_text_lists(spark, text, expected):
    assert values(spark, [(text,)], "t string", jsontext.parse_text_list(F.col("t"))) == [expected]


def test_json_text_of_lists_and_maps(spark):
    df = spark.createDataFrame([(["가", "b"], {"k": "v"}), (None, None)], "a array<string>, m map<string,string>")
    got = [tuple(r) for r in df.select(jsontext.to_json_text(F.col("a")), jsontext.metadata_json(F.col("m"))).collect()]
    assert got == [('["가","b"]', '{"k":"v"}'), (None, "{}")]


def test_metadata_value_of_missing_key_or_map(spark):
    got = values(spark, [({"a": "1"},), ({},), (None,)], "m map<string,string>", jsontext.metadata_value(F.col("m"), "a"))
    assert got == ["1", None, None]


def test_segment_weights(spark):
    rows = [("VIP",), ("super-vip",), ("Regular",), ("New",), (None,)]
    assert values(spark, rows, "s string", weights.segment_weight(F.col("s"))) == [3.0, 3.0, 2.0, 1.0, 1.0]


def test_normal_cdf(spark):
    from statistics import NormalDist

    points = [-3.5, -1.96, -0.3, 0.0, 0.5, 1.645, 4.0]
    got = values(spark, [(x,) for x in points], "z double", weights.normal_cdf(F.col("z")))
    assert got == pytest.approx([NormalDist().cdf(x) for x in points], abs=1e-7)
