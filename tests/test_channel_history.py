"""The channel at the time of an event, against a search through the history."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adlake.operators import channel_history, gold_bookings, gold_extra
from adlake.operators.grains import counts_at_grains, heavy_ids
from adlake.plans import jobs
from adlake.session import build_session
from adlake.sources.sinks import write_table
from tests.samples import bookings, spend

HISTORY = "event_type_uri string, channel string, valid_from timestamp, valid_to timestamp"
START = datetime(2026, 1, 1)


def at(hours):
    return None if hours is None else START + timedelta(hours=hours)


def inputs():
    draw = random.Random(2)
    history = []
    for uri in ("u1", "u2", "u3", None):
        for _ in range(8):
            begins = draw.choice([None, *range(0, 100, 5)])
            history.append((uri, f"c{draw.randrange(6)}", begins, draw.choice([None, None, 20, 50, 80])))
    history += [("u1", "a", 40, None), ("u1", "b", 40, 60), ("u4", "only", 10, 12)]
    events = [(i, draw.choice(["u1", "u1", "u1", "u2", "u3", "u4", "none", None]), draw.choice([None, *range(-3, 110)])) for i in range(700)]
    return history, events


def plain(history, events):
    found = {}
    for i, uri, when in events:
        entries = [h for h in history if h[0] == uri and uri is not None and h[2] is not None and when is not None and h[2] <= when]
        if not entries:
            found[i] = None
            continue
        last = max(h[2] for h in entries)
        _, channel, _, until = max((h for h in entries if h[2] == last), key=lambda h: (h[1], h[3] is not None, h[3] or 0))
        found[i] = channel if until is None or when < until else None
    return found


@pytest.mark.parametrize("few", [0, channel_history.FEW])
def test_against_a_search(spark, few):
    history, events = inputs()
    h = spark.createDataFrame([(u, c, at(f), at(t)) for u, c, f, t in history], HISTORY)
    e = spark.createDataFrame([(i, u, at(w)) for i, u, w in events], "id int, uri string, booked timestamp").withColumn("channel", F.lit("was"))
    got = channel_history.with_channel_at(e, h, at="booked", key="uri", few=few)
    assert sorted(got.columns) == sorted(e.columns)
    assert {row.id: row.channel for row in got.collect()} == plain(history, events)
    none = channel_history.with_channel_at(e, h.limit(0), at="booked", key="uri", few=few)
    assert {row.channel for row in none.collect()} == {None} and none.count() == len(events)
    assert channel_history.with_channel_at(e.limit(0), h, at="booked", key="uri", few=few).count() == 0


def test_a_common_type_is_dealt_to_many_tasks(spark):
    h = spark.createDataFrame([("u", "c", at(0), None)], HISTORY)
    e = spark.range(20_000).select("id", F.lit("u").alias("uri"), F.lit(at(5)).alias("booked"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = channel_history.with_channel_at(e, h, at="booked", key="uri", few=0)
        sizes = [row["count"] for row in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 20_000 and max(sizes) < 12_000


def test_heavy_ids_are_found_and_dealt_out(spark):
    grains = {"by_day": ["day"], "by_kind": ["day", "kind"], "all": []}
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 9000)).alias("booking_id"),
        (F.col("id") % 500).alias("day"), (F.col("id") % 11).alias("kind"),
    ).unionByName(spark.createDataFrame([(None, 1, 1)] * 5, "booking_id string, day long, kind long"))
    heavy = heavy_ids(rows, "booking_id")
    assert heavy == ["hot"] and heavy_ids(rows.limit(0), "booking_id") == []

    def counted(ids):
        return sorted(map(str, counts_at_grains(rows, "booking_id", grains, "n", ids).collect()))

    assert counted(heavy) == counted([])


def test_a_task_holds_no_table_of_ids_at_every_grain(spark):
    """Copies that a grain makes of an id's rows are counted once, without a distinct over all grains."""
    rows = spark.range(3000).selectExpr("cast(id % 700 as string) AS booking_id", "cast(id % 7 as string) AS a", "if(id % 5 = 0, NULL, id % 5) AS b")
    grains = {"both": ["a", "b"], "a": ["a"], "b": ["b"], "all": []}
    counted = counts_at_grains(rows, "booking_id", grains, "n")
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    above, found, _ = plan.partition("RepartitionByExpression")
    assert found and not re.search(r"Aggregate \[booking_id#\d+, grain", above)
    got = {(r.grain, r.a, r.b): r.n for r in counted.collect()}
    ids = {}
    for n in range(3000):
        a, b = str(n % 7), (n % 5 or None)
        for key in (("both", a, b), ("a", a, None), ("b", None, b), ("all", None, None)):
            ids.setdefault(key, set()).add(n % 700)
    assert got == {key: len(found) for key, found in ids.items()}


def test_metrics_scan_silver_once(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / name) for name in ("s", "b")]
    write_table(spend(spark), paths[0], partition_by=["spend_date"], fmt="parquet")
    write_table(bookings(spark).unionByName(bookings(spark)), paths[1], partition_by=["meeting_date"], fmt="parquet")
    read, got = [], {}

    def export(table, path):
        read.extend(table.inputFiles())
        got[path.rpartition("/")[2]] = sorted(map(str, table.collect()))

    monkeypatch.setattr(jobs, "export_json", export)
    jobs.metrics_job(spark, *paths, str(tmp_path / "x"), fmt="parquet")
    assert read and not [name for name in read if str(tmp_path) in name]
    want = gold_extra.metric_tables(spend(spark), bookings(spark))
    assert got == {name: sorted(map(str, table.collect())) for name, table in want.items()}
    assert gold_bookings.CALLS


def test_session_has_utc_and_adaptive_plans(spark):
    session = build_session("named", shuffle_partitions=4, conf={"spark.sql.ansi.enabled": "true"})
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session.conf.get("spark.sql.adaptive.enabled") == "true"
    assert session.conf.get("spark.sql.shuffle.partitions") == "4"
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")
    session.conf.unset("spark.sql.streaming.stateStore.providerClass")
