import datetime as dt

from pyspark.sql import functions as F

from lampyris.functions import rules


def _one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def _d(text):
    return F.lit(text).cast("date")


def _ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_age_months_does_not_round_month_ends(spark):
    cases = {
        ("2001-01-31", "2001-02-28"): 0,
        ("2001-01-30", "2001-03-30"): 2,
        ("2000-02-29", "2001-02-28"): 11,
        ("2000-02-29", "2001-03-01"): 12,
        ("2001-08-01", "2001-08-01"): 0,
    }
    for (a, b), want in cases.items():
        assert _one(spark, rules.age_months(_d(a), _d(b))) == want, (a, b)


def test_age_day_part_borrows_from_the_start_month(spark):
    assert _one(spark, rules.age_day_part(_ts("2001-07-01 12:00:00"), _d("2001-08-01"))) == 30
    assert _one(spark, rules.age_day_part(_ts("2001-07-01 00:00:00"), _d("2001-08-01"))) == 0
    assert _one(spark, rules.age_day_part(_ts("2001-02-28 12:00:00"), _d("2001-03-01"))) == 0


def test_season_has_winter_as_default(spark):
    months = {m: _one(spark, rules.season(_d(f"2001-{m:02d}-15"))) for m in range(1, 13)}
    assert [m for m, s in months.items() if s == "monsoon"] == [6, 7, 8, 9]
    assert [m for m, s in months.items() if s == "summer"] == [3, 4, 5]
    assert months[10] == months[11] == "winter"


def test_urgency_limits_are_inclusive(spark):
    as_of = dt.date(2001, 8, 1)
    for days, want in [(7, "CRITICAL"), (8, "HIGH"), (30, "HIGH"), (31, "MEDIUM"), (90, "MEDIUM"), (91, "LOW")]:
        day = F.date_add(_d("2001-08-01"), days)
        assert _one(spark, rules.urgency(day, as_of)) == want
    assert _one(spark, rules.urgency(F.lit(None).cast("date"), as_of)) == "LOW"


def test_hours_crossed_counts_boundaries(spark):
    a, b = _ts("2001-01-01 10:59:00"), _ts("2001-01-01 11:01:00")
    assert _one(spark, rules.hours_crossed(a, b)) == 1
    assert abs(_one(spark, rules.elapsed_hours(a, b)) - 2 / 60) < 1e-9
    assert _one(spark, rules.hours_crossed(b, a)) == -1
    assert _one(spark, rules.hours_crossed(a, F.lit(None).cast("timestamp_ntz"))) is None


def test_rounding_is_half_away_from_zero(spark):
    assert _one(spark, rules.round_half_up(F.lit(2.5), 0)) == 3.0
    assert _one(spark, rules.round_half_up(F.lit(-2.5), 0)) == -3.0
    assert _one(spark, rules.ratio_pct(F.lit(1), F.lit(0), 1)) is None


def test_ilike_any_matches_like_semantics(spark):
    df = spark.createDataFrame([("A FIRE here",), ("nothing",), (None,), ("a.b",), ("axb",)], "t string")
    hit = lambda p: [r.t for r in df.where(rules.ilike_any(F.col("t"), p)).collect()]
    assert hit(["%fire%", "%spark%"]) == ["A FIRE here"]
    assert hit(["%a.b%"]) == ["a.b"]
    assert hit(["a_b"]) == ["a.b", "axb"]


def test_preview_and_lookup(spark):
    assert _one(spark, rules.preview(F.lit("abc"), 60)) == "abc..."
    assert _one(spark, rules.lookup(F.lit("faulty"), rules.STATUS_COLORS)) == "#e74c3c"
    assert _one(spark, rules.lookup(F.lit("unknown"), rules.STATUS_COLORS)) is None
