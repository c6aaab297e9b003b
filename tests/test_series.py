import datetime as dt

from pyspark.sql import functions as F

from lampyris.operators import forecast as fc
from lampyris.operators import series


def _requests(spark, rows):
    return spark.createDataFrame(
        [(light, dt.datetime.fromisoformat(ts), issue) for light, ts, issue in rows], "light_id int, reported_at timestamp_ntz, issue_type string"
    )


def _daily(spark, rows, keys=""):
    return spark.createDataFrame(
        [(*k, dt.date.fromisoformat(d), y) for *k, d, y in rows], f"{keys}ts date, total bigint"
    )


def test_gap_is_filled_with_zeros(spark):
    df = _requests(spark, [(1, "2001-05-27T10:00", "wiring"), (1, "2001-05-27T11:00", "wiring"), (2, "2001-06-03T09:00", "bulb_failure")])
    rows = series.daily_series(df).orderBy("ts").collect()
    assert [r.total for r in rows] == [2, 0, 0, 0, 0, 0, 0, 1]
    assert rows[0].unique_lights_affected == 1 and rows[0].is_weekend == 1 and rows[0].day_of_week == 0
    assert rows[0].season == "summer" and rows[-1].season == "monsoon"
    week = series.weekly_series(series.daily_series(df)).orderBy("week_start").collect()
    assert [(str(w.week_start), w.weekly_total, w.season) for w in week] == [
        ("2001-05-21", 2, "summer"),
        ("2001-05-28", 1, "monsoon"),  # the alphabetically smaller season of a mixed week
    ]


def test_one_day_and_long_series(spark):
    one = _daily(spark, [("2001-01-01", 4)])
    assert series.gap_fill(one).collect()[0].total == 4
    long = _daily(spark, [("2001-01-01", 1), ("2002-02-05", 1)])  # 401 days
    assert series.gap_fill(long).count() == 401
    assert series.gap_fill(long).count() == series.date_spine(long).count() > 400


def test_keyed_series_equal_single_ones(spark):
    rows = [("a", "2001-01-01", 1), ("a", "2001-01-05", 3), ("b", "2001-01-03", 2), ("b", "2001-01-20", 9)]
    both = series.gap_fill(_daily(spark, rows, "k string, "), ["k"])
    for key in "ab":
        alone = series.gap_fill(_daily(spark, [r[1:] for r in rows if r[0] == key]))
        assert sorted(alone.collect()) == sorted(both.where(F.col("k") == key).drop("k").collect())
    feats = series.rolling_features(both, keys=["k"]).where("k = 'a'").orderBy("ts").collect()
    assert feats[0].rolling_7d_stddev is None and feats[0].lag_1d is None
    assert feats[4].cumulative == 4 and feats[4].rolling_7d_avg == 0.8


def _fit(spark, values, start="2001-01-01", periods=7):
    first = dt.date.fromisoformat(start)
    rows = [((first + dt.timedelta(i)).isoformat(), v) for i, v in enumerate(values)]
    train = series.training_series(_daily(spark, rows))
    return fc.fit_forecast(train).first(), fc.forecast_series(train, periods).orderBy("ts").collect()


def test_constant_series_has_no_band(spark):
    model, rows = _fit(spark, [5] * 21)
    assert abs(model.sd) < 1e-9 and all(abs(r.forecast - 5) < 1e-9 and abs(r.upper_bound - r.lower_bound) < 1e-6 for r in rows)


def test_weekly_pattern_and_trend_are_continued(spark):
    pattern = [10, 0, 0, 0, 0, 0, 4]
    _, rows = _fit(spark, [pattern[i % 7] for i in range(70)])
    assert abs(rows[0].forecast - 10) < 1.0 and abs(rows[1].forecast) < 1.0
    model, rows = _fit(spark, [100 - 3 * i for i in range(40)])
    assert abs(model.slope + 3) < 1e-9
    assert rows[0].ts == dt.date(2001, 2, 10) and rows[0].lower_bound < 0  # not clipped


def test_short_series(spark):
    _, rows = _fit(spark, [4])
    assert [round(r.forecast, 6) for r in rows] == [4.0] * 7
    model, rows = _fit(spark, [1, 3])
    assert abs(model.slope - 2) < 1e-9 and abs(rows[0].forecast - 5) < 1e-6


def test_targets_have_their_own_range(spark):
    df = _requests(
        spark,
        [(1, "2001-01-01T10:00", "wiring"), (2, "2001-01-03T10:00", "bulb_failure"), (3, "2001-01-05T10:00", "bulb_failure"), (3, "2001-01-08T10:00", "wiring")],
    )
    got = {}
    for r in series.target_series(df).collect():
        got.setdefault(r.target, []).append((r.ts.day, r.total))
    assert sorted(got["bulb"]) == [(3, 1), (4, 0), (5, 1)]
    assert len(got["all"]) == 8


def test_evaluation_scores_the_held_out_days(spark):
    rows = [((dt.date(2001, 1, 1) + dt.timedelta(i)).isoformat(), 10) for i in range(60)]
    got = fc.evaluation_metrics(series.training_series(_daily(spark, rows)), 30).first()
    assert got.days == 30 and got.mae == 0.0 and got.rmse == 0.0
