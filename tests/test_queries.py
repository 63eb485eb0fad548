"""Every registered query against its SQL, and what their plans must not contain."""

import pytest

from __spark_entry__ import SMALL, entry, oracle_sql, queries
from adlake import session
from adlake.sources.files import Folder
from adlake.sources.readers import read_bronze_bookings
from checks import registry, views
from checks.compare import difference, oracle_connection
from checks.registry import ORACLES, QUERIES

PLANS = ["daily_cpb_by_channel", "combined_dashboard_kpis", "booking_cube", "campaign_cpb", "employee_weekly_load", "line_cpb_daily", "webhook_intake", "silver_bookings_derived"]


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, connection, name):
    assert difference(spark, connection, name, SMALL) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", PLANS)
def test_plan(spark, name, capsys):
    queries()[name](spark, SMALL).explain()
    plan = capsys.readouterr().out
    for unwanted in ("Cartesian", "NestedLoop", "PythonUDF", "Pandas", "ArrowEval", "SinglePartition, REPARTITION"):
        assert unwanted not in plan


def test_scans_read_what_they_need(spark, capsys):
    queries()["line_cpb_daily"](spark, SMALL).explain("formatted")
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<l_extendedprice:double,l_linestatus:string,l_shipdate:timestamp_ntz>" in plan
    assert "LessThan(l_extendedprice,1.0E16)" in plan and "IsNotNull(o_orderstatus)" in plan
    # two aggregates and the distinct pass: the join adds no exchange
    assert plan.count("hashpartitioning") == 3


@pytest.mark.parametrize("name", ["order_booking_cube", "line_cpb_daily_from_cube"])
def test_grains_multiply_rows_after_the_raw_shuffle(spark, capsys, name):
    queries()[name](spark, SMALL).explain()
    plan = capsys.readouterr().out
    multiplied = next(part for part in plan.split("Generate inline")[1:] if "REPARTITION_BY_COL" in part)
    # read from the top down: partial counts above, and between them and the rows dealt out by id no exchange
    assert "hashpartitioning(booking_id" in multiplied.split("Exchange ")[1]
    assert "Expand" not in plan.split("HashAggregate(keys=[grain")[-1].split("Exchange ")[0]

def test_doubled_events_are_packed(spark):
    """The input of the streams' queries is not most of what they write."""
    plain = Folder(spark, views.bronze_bookings_on_disk(spark, SMALL))
    twice = Folder(spark, registry._twice_on_disk(spark, SMALL))
    assert 4 * twice.size("") < plain.size("")
    events = spark.read.parquet(f"{SMALL}/events.parquet").count()
    assert read_bronze_bookings(spark, twice.path).count() == 2 * events


def test_documents_are_packed(spark, tmp_path, monkeypatch):
    """The documents and the files beside them are small next to one plain copy of the events."""
    plain = Folder(spark, views.bronze_bookings_on_disk(spark, SMALL))
    monkeypatch.setattr(session, "scratch_dir", lambda spark: str(tmp_path))
    read = queries()["documents_to_silver"](spark, SMALL)
    assert 4 * Folder(spark, str(tmp_path)).size("") < plain.size("")
    assert read.count() == queries()["silver_bookings_derived"](spark, SMALL).count()
    names = [path.name for path in tmp_path.rglob("part-*")]
    assert sum(name.endswith(".txt.gz") for name in names) == 16 and any(name.endswith(".json.gz") for name in names)
