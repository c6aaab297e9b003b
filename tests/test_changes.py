import datetime as dt
import random
import re

from pyspark.sql import functions as F

from lampyris.operators import changes, search
from lampyris.streaming import changes as sc
from lampyris.streaming import search as ss
from lampyris.streaming import series as st

T0 = dt.datetime(2024, 1, 1)
FEED = "light_id int, version bigint, changed_at timestamp_ntz, op string, status string"
STATE = "light_id int, status string, updated_at timestamp_ntz, _deleted boolean, _updated_at timestamp_ntz, _version bigint"


def _feed(spark, rows):
    return spark.createDataFrame([(k, v, T0 + dt.timedelta(minutes=v), op, s) for k, v, op, s in rows], FEED)


def _state(spark, keys):
    return spark.createDataFrame([(k, "operational", T0, False, T0, -1) for k in keys], STATE)


def _view(df):
    return {r.light_id: (r.status, r._deleted, r._version) for r in df.collect()}


EVENTS = [
    (1, 10, "update", "faulty"),
    (1, 10, "update", "faulty"),  # duplicate
    (2, 5, "delete", None),
    (2, 3, "update", "faulty"),  # late, older than the delete
    (3, 7, "delete", None),
    (3, 9, "insert", "operational"),  # re-inserted
    (9, 4, "update", "faulty"),  # update before its insert
    (9, 2, "insert", "operational"),
]
WANT = {
    1: ("faulty", False, 10),
    2: (None, True, 5),  # the delete carried no image
    3: ("operational", False, 9),
    4: ("operational", False, -1),
    9: ("faulty", False, 4),
}


def test_latest_version_wins_whatever_the_order(spark):
    state = _state(spark, [1, 2, 3, 4])
    for seed in range(3):
        events = EVENTS[:]
        random.Random(seed).shuffle(events)
        assert _view(changes.apply_changes(state, _feed(spark, events))) == WANT
        cut = len(events) // 2
        step = changes.apply_changes(state, _feed(spark, events[:cut]))
        assert _view(changes.apply_changes(step, _feed(spark, events[cut:]))) == WANT


def test_live_rows_and_touch(spark):
    after = changes.apply_changes(_state(spark, [1, 2, 3, 4]), _feed(spark, EVENTS))
    assert {r.light_id for r in changes.live_rows(after).collect()} == {1, 3, 4, 9}
    before = _state(spark, [1, 2])
    stamp = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    touched = changes.touch_updated_at(before, before.withColumn("status", F.when(F.col("light_id") == 1, "faulty").otherwise(F.col("status"))), "light_id", stamp, ["status"])
    assert {r.light_id: r.updated_at.month for r in touched.collect()} == {1: 6, 2: 1}


def test_random_picks_are_repeatable(spark):
    lights = spark.createDataFrame([(i, "operational" if i % 3 else "faulty") for i in range(100)], "light_id int, status string")
    now = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    a = {r.light_id for r in changes.schedule_maintenance(lights, now, 1, 5).collect()}
    b = {r.light_id for r in changes.schedule_maintenance(lights.repartition(7), now, 1, 5).collect()}
    assert a == b and len(a) == 5 and all(i % 3 for i in a)
    assert changes.fail_light(lights, now, 1, light_id=3).first().light_id == 3
    assert changes.fail_light(lights, now, 1).count() == 1


def test_stream_survives_restart_and_any_split(spark, tmp_path):
    source, out = str(tmp_path / "feed"), str(tmp_path / "state")
    chunks = [EVENTS[5:], EVENTS[:3], EVENTS[3:5]]
    schema = _feed(spark, EVENTS).schema

    def drain():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        sc.stream_apply(stream, out)

    for chunk in chunks:  # every drain is a restart from the checkpoint
        _feed(spark, chunk).coalesce(1).write.mode("append").parquet(source)
        drain()
    drain()
    got = {r.light_id: (r.op, r.version) for r in sc.read_state(spark, out).collect()}
    assert got == {1: ("update", 10), 2: ("delete", 5), 3: ("insert", 9), 9: ("update", 4)}
    sc.fold_state(spark, out)
    assert sc.read_log(spark, out).count() == 4
    sc.drop_folded(spark, out)
    _feed(spark, [EVENTS[0]]).coalesce(1).write.mode("append").parquet(source)
    drain()
    assert {r.light_id: (r.op, r.version) for r in sc.read_state(spark, out).collect()} == got


def test_daily_counts_grow_over_batches(spark, tmp_path):
    source, out = str(tmp_path / "req"), str(tmp_path / "daily")
    schema = "reported_at timestamp_ntz, light_id int, issue_type string"
    for hour, light, issue in [(1, 7, "wiring"), (5, 7, "wiring"), (30, 7, "bulb_failure"), (2, 8, "bulb_failure"), (3, None, "wiring")]:
        spark.createDataFrame([(T0 + dt.timedelta(hours=hour), light, issue)], schema).coalesce(1).write.mode("append").parquet(source)
        st.stream_daily_counts(spark.readStream.schema(schema).parquet(source), out)
        if hour == 30:
            st.fold_daily(spark, out)
    got = {r.ts.day: (r.total, r.wiring_issues, r.bulb_failures, r.unique_lights_affected) for r in st.read_daily(spark, out).collect()}
    assert got == {1: (4, 3, 1, 2), 2: (1, 0, 1, 1)}


def test_daily_counts_lose_nothing_when_the_newest_files_come_first(spark, tmp_path):
    source, out = str(tmp_path / "req"), str(tmp_path / "daily")
    schema = "reported_at timestamp_ntz, light_id int, issue_type string"
    rows = [(T0 + dt.timedelta(days=40 * i, hours=h), h % 3, "wiring") for i in reversed(range(5)) for h in range(6)]
    for i in range(5):
        spark.createDataFrame(rows[6 * i : 6 * i + 6], schema).coalesce(1).write.mode("append").parquet(source)
    st.stream_daily_counts(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source), out)
    got = sorted((r.ts, r.total, r.unique_lights_affected) for r in st.read_daily(spark, out).collect())
    assert got == [((T0 + dt.timedelta(days=40 * i)).date(), 6, 3) for i in range(5)]


def test_search_index_follows_new_changed_and_removed_documents(spark, tmp_path):
    source, out, plain = str(tmp_path / "docs"), str(tmp_path / "index"), str(tmp_path / "plain")
    schema = "doc_id int, text string, version int, gone boolean"
    batches = [
        [(0, "lamp dark", 1, False), (1, "spark and fire", 1, False), (3, "fire brigade", 1, False)],
        [(2, "lamp fire fire", 2, None), (1, "calm now", 2, False), (1, "spark spark", 1, False)],
        [(3, None, 3, True), (0, "fire lamp here", 3, False)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        ss.stream_search_refresh(stream, "doc_id", "text", out, version="version", removed="gone", interval=None)
    now = spark.createDataFrame([(0, "fire lamp here"), (1, "calm now"), (2, "lamp fire fire")], "doc_id int, text string")
    search.write_index(now, "doc_id", "text", plain, buckets=4)
    for phrase in ("fire", "lamp", "spark", "calm fire"):
        got = [tuple(r) for r in search.search_index(spark, out, "doc_id", phrase, 5).collect()]
        assert got == [tuple(r) for r in search.search_index(spark, plain, "doc_id", phrase, 5).collect()], phrase
        assert got == [tuple(r) for r in search.search(now, "doc_id", "text", phrase, 5).collect()]


def test_a_query_scans_its_buckets_and_no_text(spark, tmp_path):
    path = str(tmp_path / "index")
    docs = spark.createDataFrame([(i, f"lamp word{i} fire", "a" if i % 2 else "b") for i in range(40)], "doc_id int, text string, zone string")
    search.write_index(docs, "doc_id", "text", path, buckets=16, attributes=["zone"])
    found = search.search_index(spark, path, "doc_id", "word7", 5, filters=F.col("zone") == "a")
    assert [r.doc_id for r in found.collect()] == [7]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "text:string" not in plan and re.search(r"PartitionFilters: \[[^\]]*bucket#", plan)


def test_fifty_batches_leave_a_bounded_log_and_the_batch_result(spark, tmp_path):
    """Each file is a batch; versions come in any order, and nothing is held between batches but what was written."""
    rnd, source, out = random.Random(3), str(tmp_path / "feed"), str(tmp_path / "out")
    events = [(rnd.randrange(40), v, rnd.choice(["insert", "update", "delete"]), rnd.choice(["faulty", "operational"])) for v in range(250)]
    rnd.shuffle(events)
    for i in range(50):
        _feed(spark, events[5 * i : 5 * i + 5]).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(_feed(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = sc.stream_apply(stream, out)
    assert all(not p["stateOperators"] for p in query.recentProgress)
    batches, folds = list((tmp_path / "out" / "log").glob("batch=*")), list((tmp_path / "out" / "folds").glob("upto=*"))
    assert len(batches) < 40 and 1 <= len(folds) <= 2
    got = {r.light_id: (r.version, r.op, r.status) for r in sc.read_state(spark, out).collect()}
    want = {r.light_id: (r.version, r.op, r.status) for r in changes.latest_changes(_feed(spark, events), "light_id").collect()}
    assert got == want
    assert spark.read.parquet(f"{out}/folds").groupBy("upto").count().agg(F.max("count")).first()[0] <= 40
