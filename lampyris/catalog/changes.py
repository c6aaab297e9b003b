"""Registered change-feed and streaming operators (CDC family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changes, search
from ..plans import operational as op
from ..plans.questions import LiveTables
from ..session import shared_dir
from ..sources.fixtures import AS_OF, AS_OF_TS, DOMAIN_TABLES
from ..streaming import changes as sc
from ..streaming import search as ss
from ..streaming import series as st
from .base import query
from .search import _postings

_TS = f"timestamp '{AS_OF_TS}'"


def _now():
    return F.lit(AS_OF_TS).cast("timestamp_ntz")


def _state(t):
    """Lights as a change-tracked table that no change has touched yet."""
    snapshot = changes.snapshot_load(t.lights.drop("_deleted", "_updated_at", "created_at"), _now())
    return snapshot.select("light_id", "status", "wattage", "neighborhood_id", "updated_at", "_deleted", "_updated_at").withColumn(
        "_version", F.lit(-1).cast("bigint")
    )


_APPLIED = f"""select coalesce(l.light_id, c.light_id) as light_id, case when c.light_id is null then l.status else c.status end as status,
    l.wattage, l.neighborhood_id, case when c.light_id is null then l.updated_at else c.changed_at end as updated_at,
    coalesce(c.op = 'delete', false) as _deleted, case when c.light_id is null then {_TS} else c.changed_at end as _updated_at,
    coalesce(c.version, -1) as _version from lights l full join current_state c on c.light_id = l.light_id"""

query(
    "snapshot_load",
    f"""select light_id, status, wattage, neighborhood_id, updated_at, false as _deleted, {_TS} as _updated_at, cast(-1 as bigint) as _version from lights""",
)(_state)
query("apply_changes", _APPLIED)(lambda t: changes.apply_changes(_state(t), t.feed))


@query("late_changes", _APPLIED)
def late_changes(t):
    """The newer half of the feed arrives first; the older half must not win afterwards."""
    middle = t.feed.agg(F.avg("version")).scalar()
    newer, older = t.feed.where(F.col("version") >= middle), t.feed.where(F.col("version") < middle)
    return changes.apply_changes(changes.apply_changes(_state(t), newer), older)


query(
    "live_rows",
    "select light_id, status from lights where not _deleted",
)(lambda t: changes.live_rows(t.lights).select("light_id", "status"))
query(
    "stream_apply",
    "select light_id, version, changed_at, op, status from current_state",
)(lambda t: _stream_apply(t))


def _stream_apply(t):
    """Drain the feed through the streaming job and read its state back."""
    path = shared_dir(t.spark, "cdc")
    sc.stream_apply(sc.read_domain_stream(t.spark, t.path, "feed"), path)
    sc.fold_state(t.spark, path)
    return sc.read_state(t.spark, path)


_FRESH = " union all ".join(
    f"""select '{n}' as table_name, count(*) filter (where cast(_updated_at as date) = date '{AS_OF}') as changed_today,
    count(*) filter (where _updated_at > {_TS} - interval 1 hour and _updated_at <= {_TS}) as changed_last_hour,
    max(_updated_at) as latest_change from {n}"""
    for n in DOMAIN_TABLES
)


def _freshness(t):
    return changes.freshness({n: getattr(t, n) for n in DOMAIN_TABLES}, _now())


query("freshness", _FRESH)(_freshness)
query("latest_change_per_table", f"select table_name, latest_change from ({_FRESH})")(
    lambda t: _freshness(t).select("table_name", "latest_change")
)
query("synced_last_hour", f"select table_name, changed_last_hour from ({_FRESH})")(
    lambda t: _freshness(t).select("table_name", "changed_last_hour")
)


@query(
    "count_reconcile",
    " union all ".join(
        f"""select '{n}' as table_name, count(*) as source_rows, count(*) filter (where not _deleted) as target_rows,
        count(*) = count(*) filter (where not _deleted) as in_sync from {n}"""
        for n in DOMAIN_TABLES
    ),
)
def count_reconcile(t):
    return changes.reconcile_counts(op.one_row_counts(t, DOMAIN_TABLES), op.one_row_counts(LiveTables(t), DOMAIN_TABLES))


query("point_lookup", f"select light_id, status, updated_at from ({_APPLIED}) where light_id = 7")(
    lambda t: changes.apply_changes(_state(t), t.feed).where(F.col("light_id") == 7).select("light_id", "status", "updated_at")
)


@query(
    "touch_updated_at",
    f"""select l.light_id, n.status, case when n.status is distinct from l.status then {_TS} else l.updated_at end as updated_at
    from lights l join ({_APPLIED}) n on n.light_id = l.light_id""",
)
def touch_updated_at(t):
    before = t.lights.select("light_id", "status", "updated_at")
    after = changes.apply_changes(_state(t), t.feed).select("light_id", "status")
    after = after.join(before.select("light_id", "updated_at"), "light_id")
    return changes.touch_updated_at(before, after, "light_id", _now(), ["status"])


def _mutated(t, change_set):
    after = changes.apply_changes(_state(t), change_set.select("light_id", "version", "op", "changed_at", "status"))
    return after.groupBy("status").agg(F.count("*").alias("lights"))


def _mutated_sql(gained: str, n: int) -> str:
    return f"""select status, count(*) + case status when '{gained}' then {n} when 'operational' then -{n} else 0 end as lights
    from lights group by status"""


query("fail_light", _mutated_sql("faulty", 1))(lambda t: _mutated(t, changes.fail_light(t.lights, _now(), 10**12)))
query("schedule_maintenance", _mutated_sql("maintenance_required", 5))(
    lambda t: _mutated(t, changes.schedule_maintenance(t.lights, _now(), 10**12, 5))
)


@query(
    "stream_daily_counts",
    """select cast(reported_at as date) as ts, count(*) as total, count(*) filter (where issue_type = 'bulb_failure') as bulb_failures,
    count(*) filter (where issue_type = 'wiring') as wiring_issues, count(*) filter (where issue_type = 'pole_damage') as pole_damage,
    count(*) filter (where issue_type = 'power_supply') as power_supply, count(*) filter (where issue_type = 'sensor_failure') as sensor_failures,
    count(distinct light_id) as unique_lights_affected from requests where reported_at is not null group by 1""",
)
def stream_daily_counts(t):
    path = shared_dir(t.spark, "daily")
    st.stream_daily_counts(sc.read_domain_stream(t.spark, t.path, "requests"), path)
    st.fold_daily(t.spark, path)
    return st.read_daily(t.spark, path)


@query(
    "stream_search_refresh",
    f"""with {_postings('documents', 'doc_id', 'text')} select term, count(*) as documents, cast(sum(tf) as bigint) as occurrences from post group by 1""",
)
def stream_search_refresh(t):
    path = shared_dir(t.spark, "search-refresh")
    ss.stream_search_refresh(sc.read_table_stream(t.spark, t.path, "documents").select("doc_id", "text"), "doc_id", "text", path, interval=None)
    postings, _ = search.read_index(t.spark, path, "doc_id")
    return postings.groupBy("term").agg(F.count("*").alias("documents"), F.sum("tf").alias("occurrences"))


