"""Property tests: key casting and date parsing against plain-Python models."""

import datetime as dt
import re

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from callfacts.functions import numeric_key, parse_date_text

KEY_TEXT = st.one_of(
    st.none(),
    st.text(alphabet=" \t+-0123456789.xe_,", max_size=12),
    st.integers(min_value=-(2**64), max_value=2**64).map(str),
    st.tuples(st.sampled_from(["", " ", "\t", "  "]), st.integers(-(10**20), 10**20), st.sampled_from(["", " ", "\n"])).map(
        lambda t: f"{t[0]}{t[1]}{t[2]}"
    ),
)


def model_key(text):
    """Whitespace around an optional sign and ASCII digits, within BIGINT."""
    if text is None:
        return None
    t = text.strip(" \t\n\r")
    if not re.fullmatch(r"[+-]?[0-9]+", t):
        return None
    v = int(t)
    return v if -(2**63) <= v < 2**63 else None


@settings(max_examples=30, deadline=None)
@given(st.lists(KEY_TEXT, min_size=1, max_size=40))
def test_numeric_key_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", T.StringType())]))
    got = [r[0] for r in df.select(numeric_key("v")).collect()]
    assert got == [model_key(v) for v in values]


DATES = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31))


@settings(max_examples=20, deadline=None)
@given(st.lists(DATES, min_size=1, max_size=40))
def test_date_pattern_round_trips(spark, days):
    text = [d.strftime("%m/%d/%Y") for d in days]
    df = spark.createDataFrame([(t,) for t in text], T.StructType([T.StructField("v", T.StringType())]))
    got = [r[0] for r in df.select(parse_date_text("v")).collect()]
    assert got == [dt.datetime(d.year, d.month, d.day) for d in days]


KEYS = st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\n\r\x00"), max_size=12)
TEXTS = st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=40)
TIMES = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2030, 12, 31)).map(
    lambda t: t.replace(fold=0)
)


NO_SHRINK = (Phase.explicit, Phase.reuse, Phase.generate)  # each example runs Spark jobs


@settings(max_examples=8, deadline=None, phases=NO_SHRINK)
@given(st.lists(st.tuples(st.integers(0, 2**40), st.one_of(st.none(), KEYS), TIMES, TIMES), min_size=1, max_size=20))
def test_csv_facts_round_trip(spark, rows):
    """Any key text without line breaks survives Spark's CSV writer and our reader
    (an empty text reads back as NULL: CSV has no separate empty string)."""
    from callfacts import scratch
    from callfacts import schemas as S
    from callfacts.sources import TIMESTAMP_NTZ_FORMAT, read_calls_csv

    root = scratch.fresh_folder(spark, "tests", "csv-prop")
    df = spark.createDataFrame(rows, S.CALL)
    (
        df.coalesce(1)
        .write.option("timestampNTZFormat", TIMESTAMP_NTZ_FORMAT)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("emptyValue", '""')
        .csv(f"{root}/date=2024-01-05")
    )
    got = sorted(repr(tuple(r)) for r in read_calls_csv(spark, root, "2024-01-05").drop("date").collect())
    want = sorted(repr((i, k if k != "" else None, a.replace(fold=0), b.replace(fold=0))) for i, k, a, b in rows)
    assert got == want


@settings(max_examples=8, deadline=None, phases=NO_SHRINK)
@given(st.lists(st.tuples(st.integers(0, 2**40), st.lists(st.tuples(st.integers(0, 99), TEXTS), max_size=4)), min_size=1, max_size=10))
def test_json_chats_round_trip(spark, chats):
    """Message texts with quotes, unicode and line breaks survive the JSON round trip."""
    from callfacts import scratch
    from callfacts import schemas as S
    from callfacts.sources import TIMESTAMP_NTZ_FORMAT, read_chats_json

    root = scratch.fresh_folder(spark, "tests", "json-prop")
    t = dt.datetime(2024, 1, 1, 12, 0, 0, 123456)
    rows = [(i, str(i), t, t, [(m, text, "01/02/2024") for m, text in msgs]) for i, msgs in chats]
    df = spark.createDataFrame(rows, S.CHAT_RAW)
    df.coalesce(1).write.option("timestampNTZFormat", TIMESTAMP_NTZ_FORMAT).json(f"{root}/date=2024-01-01")
    got = sorted(repr(tuple(r)) for r in read_chats_json(spark, root, "2024-01-01").drop("date").collect())
    assert got == sorted(repr(tuple(r)) for r in df.collect())


ROW = st.tuples(
    st.one_of(st.none(), st.sampled_from(["", "7", " 8 ", "x1", "1.5", "+3"]), st.integers(0, 99).map(str)),
    st.one_of(st.none(), TIMES),
    st.one_of(st.none(), TIMES),
)


def model_rules(key, start, end):
    from callfacts.functions import rules as R

    out = []
    if key is None:
        out.append(R.KEY_MISSING)
    elif model_key(key) is None:
        out.append(R.KEY_NOT_NUMBER)
    if start is None:
        out.append(R.START_MISSING)
    if end is None:
        out.append(R.END_MISSING)
    if start is not None and end is not None and end < start:
        out.append(R.END_BEFORE_START)
    return out


@settings(max_examples=15, deadline=None, phases=NO_SHRINK)
@given(st.lists(ROW, min_size=1, max_size=30))
def test_violation_rows_match_the_rule_model(spark, rows):
    from callfacts import schemas as S
    from callfacts.operators import violation_rows

    data = [(i, k, a, b) for i, (k, a, b) in enumerate(rows)]
    got = sorted((r["id"], r["rule"]) for r in violation_rows(spark.createDataFrame(data, S.CALL)).collect())
    want = sorted((i, rule) for i, k, a, b in data for rule in model_rules(k, a, b))
    assert got == want


WALL = st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2030, 12, 31)).map(
    lambda t: t.replace(fold=0)
)


@settings(max_examples=15, deadline=None, phases=NO_SHRINK)
@given(st.lists(WALL, min_size=1, max_size=60))
def test_zone_rule_matches_python_zoneinfo(spark, walls):
    """An independent oracle for the zone rule, gaps and overlaps included: with
    fold=0 Python resolves them as Spark does (pre-transition offset in a gap,
    first occurrence in an overlap)."""
    import zoneinfo

    from callfacts.functions import SOURCE_ZONE, wall_to_utc

    zone = zoneinfo.ZoneInfo(SOURCE_ZONE)
    df = spark.createDataFrame([(w,) for w in walls], T.StructType([T.StructField("v", T.TimestampNTZType())]))
    got = [r[0] for r in df.select(wall_to_utc("v")).collect()]
    want = [w.replace(tzinfo=zone).astimezone(dt.timezone.utc).replace(tzinfo=None) for w in walls]
    assert got == want
