import hashlib
import itertools
from datetime import date, datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from support import rows
from lakestar.functions import cast_key, content_hash, content_text, parse_date, parse_timestamp

NOON = 1709294400  # 2024-03-01T12:00:00Z


def _column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"t {kind}")


def test_dates(spark):
    texts = ["2020-01-02", "2020-1-2", "2020-01", "2020-01-02T10:30", "", "31/12/2020", None]
    found = [r.d for r in _column(spark, texts).select(parse_date("t").alias("d")).collect()]
    second = date(2020, 1, 2)
    assert found == [second, second, date(2020, 1, 1), second, None, None, None]


@pytest.mark.parametrize("bad", ["", "31/12/2020"])
def test_strict_dates_raise_in_any_mode(spark, with_conf, bad):
    for ansi in ("true", "false"):
        with_conf(spark__sql__ansi__enabled=ansi)
        with pytest.raises(PySparkException):
            _column(spark, [bad]).select(parse_date("t", strict=True)).collect()
    assert _column(spark, [None, "2020-01-02"]).select(parse_date("t", strict=True)).count() == 2


@pytest.mark.parametrize("session_zone", ["UTC", "America/Sao_Paulo", "Asia/Kolkata"])
@pytest.mark.parametrize(
    ("text", "zone", "expected"),
    [
        ("2024-03-01T12:00:00", "UTC", NOON),
        ("2024-03-01T12:00:00", "UTC-3", NOON + 3 * 3600),
        (" 2024-03-01 12:00 ", "UTC-3", NOON + 3 * 3600),
        ("2024-03-01T12:00:00", "America/New_York", NOON + 5 * 3600),
        ("2024-07-01T12:00:00", "America/New_York", 1719835200 + 4 * 3600),
        ("2024-03-01", "UTC", NOON - 12 * 3600),
        ("2024-03", "UTC-3", NOON - 9 * 3600),
        ("2024-03-01T12:00:00Z", "UTC-3", NOON),
        ("2024-03-01T12:00:00.500+02:00", "UTC-3", NOON - 2 * 3600),
        ("2024-03-01T12:00:00-0300", "UTC", NOON + 3 * 3600),
        ("2024-03-01 12:00:00 UTC", "UTC-3", NOON),
        ("12:00:00", "UTC", None),
        ("T12:00:00Z", "UTC", None),
        ("noon", "UTC", None),
        ("", "UTC", None),
    ],
)
def test_timestamps(spark, with_conf, session_zone, text, zone, expected):
    with_conf(spark__sql__session__timeZone=session_zone)
    found = _column(spark, [text]).select(F.unix_seconds(parse_timestamp("t", zone))).collect()[0][0]
    assert found == expected


def test_strict_timestamp_raises(spark):
    with pytest.raises(PySparkException):
        _column(spark, ["noon"]).select(parse_timestamp("t", strict=True)).collect()


def test_cast_key(spark):
    keys = _column(spark, ["57", "x", None, "70000"])
    assert [r[0] for r in keys.select(cast_key("t", "smallint", strict=False)).collect()] == [57, None, None, None]
    with pytest.raises(PySparkException):
        keys.select(cast_key("t", "smallint")).collect()


PARTS = [None, "", "a", "|", "\\", "a|b", "n", "v", "\\|"]


def test_token_text_tells_all_rows_apart(spark):
    every = list(itertools.product(PARTS, repeat=3))
    df = spark.createDataFrame(every, "a string, b string, c string")
    assert df.select(content_text(["a", "b", "c"])).distinct().count() == len(every)


def test_skip_text_drops_nulls(spark):
    df = spark.createDataFrame([(1, "57", None, "1.5"), (1, "57", "1.5", None)], "a long, b string, c string, d string")
    found = {r[0] for r in df.select(content_hash(["a", "b", "c", "d"], "skip")).collect()}
    assert found == {hashlib.sha256(b"1|57|1.5").hexdigest()}
    assert df.select(content_hash(["a", "b", "c", "d"])).distinct().count() == 2
    with pytest.raises(ValueError):
        content_text(["a"], "other")


def test_conform_and_helpers(spark):
    from lakestar.operators import conform, copy_columns, drop_columns, filter_equal, filter_gt, rename

    df = spark.sql("select 1 as id, named_struct('x', 'é') as s union all select null, null")
    assert rows(conform(df, {"n": "id", "up": F.upper("s.x"), "x": "s.x"})) == [(1, "É", "é"), (None, None, None)]
    assert drop_columns(df, ["s", "none"]).columns == ["id"]
    assert rename(df, {"id": "key", "none": "y"}).columns == ["key", "s"]
    assert rows(copy_columns(df.select("id"), {"again": "id"})) == [(1, 1), (None, None)]
    assert filter_gt(df, "id", 0).count() == 1
    assert filter_equal(df, {"s.x": "é", "id": 1}).count() == 1
    assert filter_equal(df, {"s.x": "e"}).count() == 0


@pytest.mark.parametrize("zone", ["Europe/Berlin", "America/New_York", "Australia/Lord_Howe", "Pacific/Apia", "UTC", "UTC-3"])
def test_clock_changes_against_every_quarter_hour(spark, with_conf, zone):
    """A wall clock's instants are those that show it, among all quarters of an hour of the days around."""
    with_conf(spark__sql__session__timeZone="Asia/Kolkata")
    days = ["2011-03-12", "2011-03-27", "2011-04-02", "2011-10-01", "2011-10-30", "2011-11-05", "2011-12-30", "2011-06-15"]
    quarter = 900
    starts = [int(datetime.fromisoformat(d).replace(tzinfo=timezone.utc).timestamp()) for d in days]
    walls = sorted({s + quarter * i for s in starts for i in range(-8, 200)})
    instants = spark.createDataFrame([(s + quarter * i,) for s in starts for i in range(-200, 400)], "at long").distinct()
    shows = instants.select("at", F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds("at"), zone)).alias("wall"))
    known: dict[int, list[int]] = {}
    for at, wall in shows.collect():
        known.setdefault(wall, []).append(at)
    df = spark.createDataFrame([(w, datetime.fromtimestamp(w, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")) for w in walls], "wall long, t string")
    policies = ("earlier", "later", "null")
    read = df.select("wall", *[F.unix_seconds(parse_timestamp("t", zone, twice=p, never=p)).alias(p) for p in policies], F.unix_seconds(parse_timestamp("t", zone)).alias("own"))
    kinds = set()
    for wall, earlier, later, null, own in read.collect():
        found = sorted(known.get(wall, []))
        kinds.add(len(found))
        if len(found) == 1:
            assert earlier == later == null == own == found[0]
        elif found:
            assert (earlier, later, null, own) == (found[0], found[-1], None, found[0])
        else:  # moved by the width of the gap to either side
            assert null is None and own == later > earlier
    assert kinds == ({1} if zone.startswith("UTC") else {0, 1, 2})


def test_clock_changes_raise(spark):
    night = _column(spark, ["2011-03-27T02:30:00"])
    with pytest.raises(PySparkException, match="never: 2011-03-27 02:30:00"):
        night.select(parse_timestamp("t", "Europe/Berlin", never="raise")).collect()
    with pytest.raises(PySparkException, match="twice: 2011-10-30 02:30:00"):
        _column(spark, ["2011-10-30T02:30:00"]).select(parse_timestamp("t", "Europe/Berlin", twice="raise")).collect()
    assert night.select(parse_timestamp("t", "Europe/Berlin", twice="raise")).count() == 1
    with pytest.raises(ValueError, match="policy"):
        parse_timestamp("t", twice="other")
