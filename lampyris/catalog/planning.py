"""Registered forecasts and planning queries (FC family) and the dashboard figures on top of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import boosting
from ..operators import forecast as fc
from ..operators import series
from ..plans import dashboard as db
from ..plans import planning as pl
from ..sources.fixtures import AS_OF
from .base import forecast_cte, query, rnd

_ASOF = f"date '{AS_OF}'"


def _train(t, bulb: bool = False):
    return series.training_series(pl.bulb_daily(t) if bulb else pl.all_daily(t))


query("training_series", "select ts, cast(total as double) as y from bulb_series")(lambda t: _train(t, True))
query("training_series_all", "select ts, cast(total as double) as y from all_series")(_train)


def _targets(t):
    return series.training_series(series.target_series(t.requests), keys=["target"])


def _check_sql(table: str, label: str) -> str:
    return f"""select '{label}' as check_name, count(*) as total_records, min(ts) as start_date, max(ts) as end_date,
    cast(sum(total) as bigint) as total, {rnd("avg(total)", 2)} as avg_daily from {table}"""


query("training_check", _check_sql("bulb_series", "Forecast Training Data"))(
    lambda t: series.training_check(_train(t, True), "Forecast Training Data")
)
query("training_check_all", _check_sql("all_series", "All Issues Training Data"))(
    lambda t: series.training_check(_train(t), "All Issues Training Data")
)


@query(
    "fit_forecast",
    f"""select {rnd("regr_slope(total, x)", 8)} as slope, {rnd("regr_intercept(total, x)", 6)} as intercept, count(*) as days,
    max(ts) as last_ts, {rnd("(select sd from all_series_sd)", 6)} as sd from
    (select ts, total, datediff('day', date '1970-01-01', ts) as x from all_series)""",
)
def fit_forecast(t):
    m = fc.fit_forecast(_train(t))
    r = rules.round_half_up
    return m.select(
        r(F.col("slope"), 8).alias("slope"), r(F.col("intercept"), 6).alias("intercept"), "days", "last_ts", r(F.col("sd"), 6).alias("sd")
    )


def _forecast_sql(table: str, periods: int) -> str:
    return f"""select ts, {rnd("forecast", 5)} as forecast, {rnd("lower_bound", 5)} as lower_bound, {rnd("upper_bound", 5)} as upper_bound
    from ({forecast_cte(table, periods)})"""


def _forecast(t, periods, bulb=False):
    r = rules.round_half_up
    return fc.forecast_series(_train(t, bulb), periods).select(
        "ts", *[r(F.col(c), 5).alias(c) for c in ("forecast", "lower_bound", "upper_bound")]
    )


query("forecast", _forecast_sql("bulb_series", 30))(lambda t: _forecast(t, 30, True))
query("forecast_all_90", _forecast_sql("all_series", 90))(lambda t: _forecast(t, 90))


@query(
    "forecast_by_event_type",
    f"""with c as (select event_type as k, cast(ts as date) as ts, count(*) as y, dayofweek(cast(ts as date)) as dow,
      datediff('day', date '1970-01-01', cast(ts as date)) as x from events group by 1, 2, 4, 5),
    m as (select k, regr_slope(y, x) as b, regr_intercept(y, x) as a, max(ts) as last_ts from c group by 1),
    w as (select c.k, c.dow, avg(c.y - (m.a + m.b*c.x)) as effect from c join m on c.k = m.k group by 1, 2)
    select f.k as event_type, f.ts, {rnd("f.a + f.b*datediff('day', date '1970-01-01', f.ts) + coalesce(w.effect, 0)", 4)} as forecast
    from (select m.*, cast(last_ts + cast(r.range as int) as date) as ts from m cross join range(1, 8) r) f
    left join w on w.k = f.k and w.dow = dayofweek(f.ts)""",
)
def forecast_by_event_type(t):
    """All series of a table in one job."""
    daily = t.raw("events").groupBy("event_type", F.to_date("ts").alias("ts")).agg(F.count("*").alias("total"))
    rows = series.training_series(series.gap_fill(daily, ["event_type"]), keys=["event_type"])
    return fc.forecast_series(rows, 7, keys=["event_type"]).select(
        "event_type", "ts", rules.round_half_up(F.col("forecast"), 4).alias("forecast")
    )


@query(
    "evaluation_metrics",
    f"""with lim as (select max(ts) - 30 as cut from all_series),
    tr as (select ts, total as y, dayofweek(ts) as dow, datediff('day', date '1970-01-01', ts) as x from all_series, lim where ts <= cut),
    m as (select regr_slope(y, x) as b, regr_intercept(y, x) as a from tr),
    w as (select dow, avg(y - (m.a + m.b*x)) as effect from tr, m group by 1),
    te as (select s.total as y, m.a + m.b*datediff('day', date '1970-01-01', s.ts) + coalesce(w.effect, 0) as f
      from all_series s cross join lim cross join m left join w on w.dow = dayofweek(s.ts) where s.ts > lim.cut)
    select count(*) as days, {rnd("avg(abs(y-f))", 4)} as mae, {rnd("sqrt(avg((y-f)*(y-f)))", 4)} as rmse,
    {rnd("avg(abs(y-f)/nullif(abs(y),0))*100", 4)} as mape from te""",
)
def evaluation_metrics(t):
    return fc.evaluation_metrics(_train(t))


@query(
    "boosting_features",
    f"""with d as (select 'all' as target, ts, cast(total as double) as y from all_series union all
      select 'bulb', ts, cast(total as double) from bulb_series),
    w as (select *, lag(y, 1) over o as l1, lag(y, 7) over o as l7, lag(y, 14) over o as l14,
      avg(y) over (partition by target order by ts rows between 7 preceding and 1 preceding) as r7,
      avg(y) over (partition by target order by ts rows between 14 preceding and 1 preceding) as r14,
      greatest(avg(y) over (partition by target order by ts rows between 30 preceding and 1 preceding), 1) as level,
      stddev_samp(y) over (partition by target order by ts rows between 7 preceding and 1 preceding) as s7
      from d window o as (partition by target order by ts))
    select target, ts, y, {rnd("level", 6)} as level, {rnd("l1/level", 6)} as lag_1d, {rnd("l7/level", 6)} as lag_7d, {rnd("l14/level", 6)} as lag_14d,
    {rnd("r7/level", 6)} as rolling_7d_avg, {rnd("r14/level", 6)} as rolling_14d_avg, {rnd("s7/level", 6)} as rolling_7d_stddev,
    cast(dayofweek(ts) as double) as day_of_week, cast(month(ts) as double) as month,
    case when dayofweek(ts) in (0, 6) then 1.0 else 0.0 end::double as is_weekend from w where l14 is not null""",
)
def boosting_features(t):
    """What the boosted model learns from, both targets in one job."""
    rows = boosting.lagged_features(_targets(t), "y", ["target"])
    return rows.select("target", "ts", "y", *[rules.round_half_up(F.col(c), 6).alias(c) for c in ("level", *boosting.FEATURES)])


@query(
    "evaluation_metrics_both",
    """with s as (select 'all' as target, ts from all_series union all select 'bulb', ts from bulb_series),
    n as (select target, count(*) filter (where ts > last - 30) as days from (select *, max(ts) over (partition by target) as last from s) group by target)
    select target, model, days, true as scored from n cross join (values ('boosted'), ('trend')) as m(model)""",
)
def evaluation_metrics_both(t):
    """Both forecasters on the same held-out days of both targets; ``scored`` if the errors are finite and ordered."""
    rows = _targets(t)
    found = [
        fc.evaluation_metrics(rows, keys=["target"], forecaster=f).withColumn("model", F.lit(name))
        for name, f in (("trend", fc.forecast_series), ("boosted", boosting.forecast_series))
    ]
    finite = (F.col("mae") >= 0) & (F.col("rmse") >= F.col("mae")) & (F.col("rmse") < 1e9)
    return found[0].union(found[1]).select("target", "model", "days", finite.alias("scored"))


@query(
    "boosted_forecast",
    """select target, cast(last + n as date) as ts, true as inside from (
      select 'all' as target, max(ts) as last from all_series union all select 'bulb', max(ts) from bulb_series)
    cross join (select cast(range as int) as n from range(1, 31))""",
)
def boosted_forecast(t):
    """Thirty days of both targets, day by day from the days before; ``inside`` if the band holds the forecast."""
    rows = boosting.forecast_series(_targets(t), 30, keys=["target"])
    inside = (F.col("forecast") >= 0) & F.col("forecast").between(F.col("lower_bound"), F.col("upper_bound"))
    return rows.select("target", "ts", inside.alias("inside"))


def _t30(noun: str, table: str) -> str:
    return f"""select forecast_date, predicted as {noun}, lower_bound, upper_bound, predicted_precise as {noun}_precise, day_of_week,
    season, prediction_range from {table}"""


def _t90(noun: str, table: str) -> str:
    return f"select forecast_date, predicted as {noun}, lower_bound, upper_bound, week_start, month_start, season from {table}"


query("forecast_30d", _t30("predicted_failures", "bulb_fc30"))(
    lambda t: pl.forecast_30d(pl.bulb_forecast(t, 30), "predicted_failures")
)
query("forecast_30d_all", _t30("predicted_requests", "all_fc30"))(
    lambda t: pl.forecast_30d(pl.all_forecast(t, 30), "predicted_requests")
)
query("forecast_90d", _t90("predicted_failures", "bulb_fc90"))(
    lambda t: pl.forecast_90d(pl.bulb_forecast(t, 90), "predicted_failures")
)
query("forecast_90d_all", _t90("predicted_requests", "all_fc90"))(
    lambda t: pl.forecast_90d(pl.all_forecast(t, 90), "predicted_requests")
)


def _bulb_schedule(t):
    return pl.bulb_schedule(pl.bulb_forecast(t, 30))


def _all_schedule(t):
    return pl.maintenance_schedule(pl.all_forecast(t, 30))


query("bulb_schedule", "select * from bulb_schedule")(_bulb_schedule)
query("maintenance_schedule", "select * from all_schedule")(_all_schedule)


def _weekly_sql(table: str, noun: str) -> str:
    return f"""select week_start, total_predicted as total_predicted_{noun}, total_lower_bound, total_upper_bound,
    avg_daily as avg_daily_{noun}, peak_day as peak_day_{noun}, primary_season from {table}"""


query("weekly_bulb_forecast", _weekly_sql("bulb_weekly_fc", "failures"))(
    lambda t: pl.weekly_forecast(pl.bulb_forecast(t, 90), "failures")
)
query("weekly_maintenance_forecast", _weekly_sql("all_weekly_fc", "requests"))(
    lambda t: pl.weekly_forecast(pl.all_forecast(t, 90), "requests")
)
query(
    "forecast_comparison",
    f"""select b.forecast_date, b.predicted as bulb_failures, a.predicted as all_issues, a.predicted - b.predicted as other_issues,
    {rnd("b.predicted*100.0/nullif(a.predicted,0)", 1)} as bulb_percentage, b.season,
    case when a.predicted >= 8 then 'HIGH' when a.predicted >= 5 then 'MEDIUM' else 'LOW' end as overall_workload
    from bulb_fc30 b join all_fc30 a on a.forecast_date = b.forecast_date""",
)(lambda t: pl.forecast_comparison(pl.both_forecasts(t, 30)))
query(
    "model_summary",
    """select 'Bulb Failure Forecast' as model, (select count(*) from bulb_series) as training_days,
    count(*) as forecast_30d_days, cast(sum(predicted) as bigint) as total_30d_predicted from bulb_fc30
    union all select 'All Issues Forecast', (select count(*) from all_series), count(*), cast(sum(predicted) as bigint) from all_fc30""",
)(pl.model_summary)
query(
    "next_7_days",
    f"""select forecast_date, predicted_failures, cast(lower_bound as varchar) || ' - ' || cast(upper_bound as varchar) as range, priority,
    staffing_recommendation, bulbs_to_stock from bulb_schedule where forecast_date <= {_ASOF} + 7""",
)(lambda t: pl.next_7_days(_bulb_schedule(t), AS_OF))
query(
    "today_briefing",
    f"""select forecast_date as today, predicted_failures as expected_failures, staffing_recommendation, bulbs_to_stock as bulbs_needed,
    priority, case when season = 'monsoon' then 'Monsoon season - expect weather delays' when season = 'summer' then
    'Summer heat - schedule early morning/evening' else 'Favorable conditions' end as weather_note from bulb_schedule
    where forecast_date = {_ASOF} + 2""",
)(lambda t: pl.today_briefing(_bulb_schedule(t), "2001-08-03"))
query(
    "high_volume_alert",
    """select forecast_date, predicted_failures, upper_bound as worst_case, season, 'Deploy ' || case when predicted_failures >= 5 then
    '3+ crews' when predicted_failures >= 3 then '2 crews' else '1 crew' end || ', stock ' ||
    cast(cast(ceil(upper_bound*1.5) as bigint) as varchar) || ' bulbs' as action_required from bulb_schedule
    where priority in ('HIGH', 'MEDIUM')""",
)(lambda t: pl.high_volume_alert(_bulb_schedule(t)))
query(
    "weekly_inventory_budget",
    """select week_start, total_predicted as predicted_bulb_failures, total_upper_bound as worst_case_estimate,
    cast(ceil(total_upper_bound*1.2) as bigint) as bulbs_to_order, primary_season,
    cast(ceil(total_upper_bound*1.2) as bigint)*1000 as material_cost_inr, total_predicted*500 as labor_cost_inr,
    total_predicted*150 as transport_cost_inr,
    cast(ceil(total_upper_bound*1.2) as bigint)*1000 + total_predicted*500 + total_predicted*150 as total_weekly_budget_inr
    from bulb_weekly_fc order by week_start limit 12""",
)(lambda t: pl.weekly_inventory_budget(pl.weekly_forecast(pl.bulb_forecast(t, 90), "failures")))
query(
    "crew_schedule",
    f"""select forecast_date, case dayofweek(forecast_date) when 0 then 'Sun' when 1 then 'Mon' when 2 then 'Tue' when 3 then 'Wed'
    when 4 then 'Thu' when 5 then 'Fri' else 'Sat' end as day, predicted_failures, priority,
    case when predicted_failures >= 5 then 'Crew A + Crew B + Crew C' when predicted_failures >= 3 then 'Crew A + Crew B' else 'Crew A' end
    as assigned_crews, cast(predicted_failures*1.5 as double) as estimated_work_hours from bulb_schedule
    where forecast_date between {_ASOF} and {_ASOF} + 7""",
)(lambda t: pl.crew_schedule(_bulb_schedule(t), AS_OF))
query(
    "monthly_forecast",
    f"""select month_start as month, cast(sum(predicted) as bigint) as total_predicted_failures, {rnd("avg(predicted)", 1)} as avg_daily_failures,
    max(predicted) as peak_day, cast(ceil(sum(upper_bound)*1.2) as bigint) as bulbs_to_stock from bulb_fc90 group by 1""",
)(lambda t: pl.monthly_forecast(pl.bulb_forecast(t, 90)))
query(
    "seasonal_risk",
    f"""select season, count(*) as forecast_days, cast(sum(predicted) as bigint) as total_failures, {rnd("avg(predicted)", 2)} as avg_daily_failures,
    max(predicted) as peak_day_failures, case when avg(predicted) > 3 then 'HIGH RISK' when avg(predicted) > 2 then 'MEDIUM RISK'
    else 'LOW RISK' end as seasonal_risk from bulb_fc90 group by 1""",
)(lambda t: pl.seasonal_risk(pl.bulb_forecast(t, 90)))
_BUDGET = """select month, jobs, b as bulbs_needed, b*1000 as material_cost_inr, jobs*500 as labor_cost_inr, jobs*150 as transport_cost_inr,
    jobs*100 as overhead_cost_inr, b*1000 + jobs*500 + jobs*150 + jobs*100 as total_monthly_budget_inr from
    (select month_start as month, cast(sum(predicted) as bigint) as jobs, cast(ceil(sum(upper_bound)*1.2) as bigint) as b from bulb_fc90 group by 1)"""
query("monthly_budget", _BUDGET)(lambda t: pl.monthly_budget(pl.bulb_forecast(t, 90)))
_BUDGET_ALL = """select *, bulbs_needed*1000 as bulb_cost_inr, wiring_kits_needed*2000 as wiring_cost_inr, poles_needed*15000 as pole_cost_inr,
    total_jobs*500 as labor_cost_inr, total_jobs*150 as transport_cost_inr,
    bulbs_needed*1000 + wiring_kits_needed*2000 + poles_needed*15000 + total_jobs*500 + total_jobs*150 as total_monthly_budget_inr from
    (select cast(date_trunc('month', forecast_date) as date) as month, cast(sum(predicted_requests) as bigint) as total_jobs,
    cast(sum(bulbs_to_stock) as bigint) as bulbs_needed, cast(sum(wiring_kits_to_stock) as bigint) as wiring_kits_needed,
    cast(sum(poles_to_stock) as bigint) as poles_needed from all_schedule group by 1)"""
query("monthly_budget_all", _BUDGET_ALL)(lambda t: pl.monthly_budget_all(_all_schedule(t)))
_METRICS = f"""select 'FORECAST_NEXT_7_DAYS' as metric, cast(cast(sum(predicted_failures) as bigint) as varchar) as value,
    'Expected bulb failures in next 7 days' as description from bulb_schedule where forecast_date <= {_ASOF} + 7
    union all select 'FORECAST_NEXT_30_DAYS', cast(cast(sum(predicted_failures) as bigint) as varchar), 'Expected bulb failures in next 30 days' from bulb_schedule
    union all select 'HIGH_PRIORITY_DAYS', cast(count(*) as varchar), 'Days requiring extra staffing (next 30 days)' from bulb_schedule where priority = 'HIGH'
    union all select 'BULBS_TO_ORDER_30D', cast(cast(sum(bulbs_to_stock) as bigint) as varchar), 'Recommended bulb inventory for next 30 days' from bulb_schedule"""
query("forecast_metrics", _METRICS)(lambda t: pl.forecast_metrics(_bulb_schedule(t), AS_OF))
query(
    "workload_metrics",
    f"""select 'TOTAL_REQUESTS_NEXT_7_DAYS' as metric, cast(cast(sum(predicted_requests) as bigint) as varchar) as value,
    'Expected total maintenance requests in next 7 days' as description from all_schedule where forecast_date <= {_ASOF} + 7
    union all select 'TOTAL_REQUESTS_NEXT_30_DAYS', cast(cast(sum(predicted_requests) as bigint) as varchar), 'Expected total maintenance requests in next 30 days' from all_schedule
    union all select 'HIGH_WORKLOAD_DAYS', cast(count(*) as varchar), 'Days with high workload (next 30 days)' from all_schedule where workload_level = 'HIGH'
    union all select 'TOTAL_PARTS_NEEDED', cast(cast(sum(bulbs_to_stock) + sum(wiring_kits_to_stock) + sum(poles_to_stock) as bigint) as varchar),
    'Total parts to stock for next 30 days' from all_schedule""",
)(lambda t: pl.workload_metrics(_all_schedule(t), AS_OF))
query(
    "flat_cost_by_month",
    """select month_start as month, cast(sum(predicted) as bigint) as failures, cast(sum(predicted) as bigint)*1750 as estimated_cost_inr
    from bulb_fc90 group by 1""",
)(lambda t: pl.flat_cost_by_month(pl.bulb_forecast(t, 90)))
query(
    "flat_cost_by_week",
    """select cast(date_trunc('week', forecast_date) as date) as week_start, cast(sum(predicted_failures) as bigint) as total_failures,
    cast(sum(predicted_failures) as bigint)*1650 as total_budget_inr from bulb_schedule group by 1""",
)(lambda t: pl.flat_cost_by_week(_bulb_schedule(t)))


def _season_totals(table: str) -> str:
    return f"""select season, cast(sum(predicted) as bigint) as total_failures, {rnd("avg(predicted)", 1)} as avg_daily from {table} group by 1"""


query("season_totals", _season_totals("bulb_fc90"))(lambda t: pl.season_totals(pl.bulb_forecast(t, 90)))
query("season_totals_30d", _season_totals("bulb_fc30"))(lambda t: pl.season_totals(pl.bulb_forecast(t, 30)))

# ordered reads of the planning views
_READS = {
    "forecast_read_bulb_30d": (
        _bulb_schedule,
        "forecast_date, predicted_failures, lower_bound, upper_bound, season, day_of_week, priority, staffing_recommendation, bulbs_to_stock",
        "bulb_schedule",
    ),
    "forecast_read_all_30d": (
        _all_schedule,
        "forecast_date, predicted_requests, lower_bound, upper_bound, season, day_of_week, workload_level, staffing_recommendation, "
        "bulbs_to_stock, wiring_kits_to_stock, poles_to_stock, uncertainty_range",
        "all_schedule",
    ),
    "forecast_overview": (_bulb_schedule, "forecast_date, predicted_failures, priority, staffing_recommendation", "bulb_schedule"),
}
for _key, (_fn, _cols, _table) in _READS.items():
    query(_key, f"select {_cols} from {_table}")(
        lambda t, fn=_fn, cols=_cols: fn(t).select(*cols.split(", ")).orderBy("forecast_date")
    )

# dashboard figures on the forecast
_PARTS = {"Material": "material_cost_inr", "Labor": "labor_cost_inr", "Transport": "transport_cost_inr", "Overhead": "overhead_cost_inr"}
_PARTS_ALL = {
    "Bulbs": "bulb_cost_inr", "Wiring Kits": "wiring_cost_inr", "Poles": "pole_cost_inr", "Labor": "labor_cost_inr",
    "Transport": "transport_cost_inr",
}


def _breakdown_sql(parts: dict[str, str], table: str) -> str:
    return " union all ".join(
        f"select '{k}' as component, cast(sum({c}) as bigint) as total from ({table})" for k, c in parts.items()
    )


query("budget_breakdown", _breakdown_sql(_PARTS, _BUDGET))(
    lambda t: db.unpivot_totals(pl.monthly_budget(pl.bulb_forecast(t, 90)), _PARTS)
)
query("budget_breakdown_all", _breakdown_sql(_PARTS_ALL, _BUDGET_ALL))(
    lambda t: db.unpivot_totals(pl.monthly_budget_all(_all_schedule(t)), _PARTS_ALL)
)
_NAMES = ["FORECAST_NEXT_7_DAYS", "FORECAST_NEXT_30_DAYS", "HIGH_PRIORITY_DAYS", "BULBS_TO_ORDER_30D"]
query(
    "metrics_lookup",
    "select " + ", ".join(f"max(case when metric = '{n}' then value end) as {n.lower()}" for n in _NAMES) + f" from ({_METRICS})",
)(lambda t: db.metrics_wide(pl.forecast_metrics(_bulb_schedule(t), AS_OF), _NAMES).select(*[F.col(n).alias(n.lower()) for n in _NAMES]))
query(
    "forecast_filter",
    "select forecast_date, predicted_requests, workload_level from all_schedule where workload_level in ('HIGH', 'MEDIUM')",
)(
    lambda t: pl.forecast_filter(_all_schedule(t), "workload_level", ["HIGH", "MEDIUM"]).select(
        "forecast_date", "predicted_requests", "workload_level"
    )
)
