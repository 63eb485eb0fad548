"""Counts per rule come from the pass that writes the rows."""

import json

import pytest
from adlake.operators.quality import InvalidRows
from adlake.plans import jobs
from adlake.sources.readers import read_silver_spend
from adlake.sources.versions import current

RECORDS = [
    {"date": "2025-10-08", "channel": "facebook_paid_ads", "spend": 1.0},
    {"date": "bad", "channel": "facebook_paid_ads", "spend": -1.0},
    {"date": None, "channel": "unknown", "spend": 2.0},
]
COUNTS = {"rows": 3, "broken_rows": 2, "invalid_date": 1, "negative_spend": 1, "missing_date": 1, "unsupported_channel": 1}


@pytest.fixture
def bronze(tmp_path):
    folder = tmp_path / "bronze"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"raw_s3_key": "a", "raw_payload": RECORDS}) + "\n")
    return str(folder)


@pytest.mark.parametrize("mode", ["overwrite", "replace_partitions", "publish", "append"])
@pytest.mark.parametrize("rejects", [False, True])
def test_counts_of_every_mode(spark, bronze, tmp_path, mode, rejects):
    where = str(tmp_path / "r") if rejects else None
    counts = jobs.silver_spend_job(spark, bronze, str(tmp_path / "s"), rejects=where, mode=mode, fmt="parquet")
    assert {name: n for name, n in counts.items() if n} == COUNTS
    assert read_silver_spend(spark, str(tmp_path / "s"), "parquet").count() == 1


@pytest.mark.parametrize("mode", ["publish", "append"])
def test_strict_writes_once_and_commits_nothing(spark, bronze, tmp_path, monkeypatch, mode):
    writes = []
    kind = type(spark.range(1))
    plain = kind.write.fget
    monkeypatch.setattr(kind, "write", property(lambda self: writes.append(self) or plain(self)))
    with pytest.raises(InvalidRows, match="invalid_date"):
        jobs.silver_spend_job(spark, bronze, str(tmp_path / "s"), mode=mode, strict=True, fmt="parquet")
    assert current(spark, str(tmp_path / "s")) is None
    # the run itself and, for append, the names of its input files (staged, and in the run)
    assert len(writes) == (1 if mode == "publish" else 3)


def test_nothing_new_to_append(spark, bronze, tmp_path):
    target = str(tmp_path / "s")
    jobs.silver_spend_job(spark, bronze, target, mode="append", fmt="parquet")
    assert jobs.silver_spend_job(spark, bronze, target, mode="append", fmt="parquet") == {"rows": 0, "broken_rows": 0}
