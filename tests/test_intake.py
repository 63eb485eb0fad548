import base64
import json

import pytest

from adlake.fixed_values import BOOKING_SOURCE_SYSTEM, SPEND_SOURCE_SYSTEM
from adlake.operators import silver_bookings, silver_spend
from adlake.operators.quality import rejected_rows, valid_rows
from adlake.sources import intake, manifest
from adlake.sources.readers import read_bronze_bookings, read_bronze_spend
from adlake.sources.sinks import write_bronze
from tests.samples import TIKTOK, webhook

AT = "2025-10-08T07:41:20.000000+00:00"


def requests(spark, *bodies):
    return spark.createDataFrame(list(bodies), intake.REQUESTS)


def packed(text):
    return base64.b64encode(text.encode() if isinstance(text, str) else text).decode()


def test_webhook_intake(spark, tmp_path):
    taken = intake.webhook_intake(
        requests(
            spark,
            (json.dumps(webhook("1")), False),
            (packed(json.dumps(webhook("2", kind=TIKTOK))), True),
            (json.dumps(webhook("3", uri=None)), None),
            (json.dumps(webhook("4", kind="elsewhere")), False),
        ),
        ingested_at=AT,
    )
    good = {row.booking_id: row for row in valid_rows(taken).drop("raw_event").collect()}
    assert set(good) == {"book-1", "book-2", None, "book-4"}
    assert good["book-1"].raw_s3_key.endswith(
        "/event_type=invitee.created/ingest_date=2025-10-08/book-1.json"
    )
    assert (good["book-1"].source_system, good["book-1"].ingestion_timestamp) == (BOOKING_SOURCE_SYSTEM, AT)
    assert (good["book-2"].channel, good["book-4"].channel) == ("tiktok_paid_ads", None)
    assert len(good[None].raw_s3_key.rpartition("/")[2]) == 64 + len(".json")

    target = str(tmp_path / "bronze")
    write_bronze(
        valid_rows(taken).select(*intake.BOOKING_ENVELOPE, *intake.BOOKING_PARTITIONS),
        target,
        intake.BOOKING_PARTITIONS,
    )
    (folder,) = (tmp_path / "bronze").glob("event_type=*/ingest_date=*")
    assert f"{folder.parent.name}/{folder.name}" == "event_type=invitee.created/ingest_date=2025-10-08"
    lines = [json.loads(line) for file in folder.glob("*.json") for line in file.read_text().splitlines()]
    assert all(line["raw_event"]["payload"]["unlisted_field"] == {"kept": True} for line in lines)
    silver = silver_bookings.bookings(read_bronze_bookings(spark, target, layout="lines"))
    assert {row.booking_id for row in silver.collect()} == {"book-1", "book-2"}
    # a frame taken in but not yet stored serves as bronze too
    assert silver_bookings.bookings(valid_rows(taken)).count() == 2


@pytest.mark.parametrize(
    "body, encoded, first_reason",
    [
        (None, False, "missing_body"),
        (packed(b"\xff\xfe"), True, "invalid_encoding"),
        ("!!!", True, "invalid_encoding"),
        ("{broken", False, "invalid_json"),
        ("[1, 2]", False, "not_an_object"),
        ('"text"', False, "not_an_object"),
        (json.dumps(webhook(event="invitee.canceled")), False, "unsupported_event"),
        ('{"event": "invitee.created"}', False, "missing_payload"),
        ('{"event": "invitee.created", "payload": {}}', False, "missing_payload"),
        ('{"event": "invitee.created", "payload": {"uri": "x"}}', False, "missing_scheduled_event"),
        ('{"event": "invitee.created", "payload": {"uri": "x", "scheduled_event": {}}}', False, "missing_scheduled_event"),
    ],
)
def test_webhook_rejects(spark, body, encoded, first_reason):
    taken = intake.webhook_intake(requests(spark, (body, encoded)))
    assert valid_rows(taken).count() == 0
    assert rejected_rows(taken).head().reject_reasons[0] == first_reason


def test_spend_intake(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    records = [{"date": "2025-06-24", "channel": "facebook_paid_ads", "spend": 653.28, "extra": 1}]
    (raw / "spend_data_2025-06-24.json").write_text(json.dumps(records, indent=2))
    (raw / "spend_data_empty.json").write_text("[]")
    (raw / "spend_data_object.json").write_text('{"date": "2025-06-24"}')
    (raw / "readme.json").write_text("[]")
    taken = intake.spend_intake(spark, str(raw), ingested_at=AT, source_base_url="https://files.example/x/")
    seen = {row.source_file_name: row for row in taken.drop("raw_payload").collect()}
    assert {name: row.record_count for name, row in seen.items()} == {
        "spend_data_2025-06-24.json": 1,
        "spend_data_empty.json": 0,
        "spend_data_object.json": None,
    }
    (tmp_path / "index.json").write_text(json.dumps({"files": list(seen)}, indent=1))
    listed = manifest.manifest_names(manifest.read_manifests(spark, str(tmp_path / "index.json")))
    newest = [row.file_name for row in manifest.select_names(listed, newest=1).collect()]
    only = intake.spend_intake(spark, str(raw), file_names=newest)
    assert [row.source_file_name for row in only.collect()] == ["spend_data_object.json"]
    row = seen["spend_data_2025-06-24.json"]
    assert row.source_url == "https://files.example/x/spend_data_2025-06-24.json"
    assert row.raw_s3_key.endswith("/ingest_date=2025-10-08/spend_data_2025-06-24.json")
    assert row.source_system == SPEND_SOURCE_SYSTEM

    write_bronze(taken.drop("record_count"), str(tmp_path / "bronze"), intake.SPEND_PARTITIONS)
    stored = "".join(p.read_text() for p in (tmp_path / "bronze").rglob("*.json"))
    assert '"extra":1' in stored
    for bronze in (taken, read_bronze_spend(spark, str(tmp_path / "bronze"), layout="lines")):
        assert [r.spend_usd for r in silver_spend.spend(bronze).collect()] == [653.28]
        assert rejected_rows(silver_spend.checked_spend(bronze)).count() == 2


@pytest.mark.parametrize("limit", [1, 300, 1 << 20])
def test_long_spend_files_lose_no_record(spark, tmp_path, limit):
    raw, bronze = tmp_path / "raw", str(tmp_path / "bronze")
    raw.mkdir()
    records = [{"date": "2025-06-24", "channel": "facebook_paid_ads", "spend": n + 0.25, "note": "a,\"[é" * (n % 3)} for n in range(50)]
    (raw / "spend_data_long.json").write_text("\n " + json.dumps([*records, None], indent=2))
    (raw / "spend_data_object.json").write_text(json.dumps({"records": records}))
    (raw / "spend_data_broken.json").write_text(json.dumps(records)[:-1])
    taken = intake.spend_intake(spark, str(raw), ingested_at=AT, split_bytes=limit)
    counts = {r[0]: r[1] for r in taken.groupBy("source_file_name").agg({"record_count": "sum"}).collect()}
    assert counts == {"spend_data_long.json": 51, "spend_data_object.json": None, "spend_data_broken.json": None}
    for _ in range(2):  # all rows of one key stay, and running again adds none
        write_bronze(taken.drop("record_count"), bronze, intake.SPEND_PARTITIONS)
    silver = silver_spend.spend(read_bronze_spend(spark, bronze, layout="lines"))
    assert sorted(r.spend_usd for r in silver.collect()) == [n + 0.25 for n in range(50)]


def names(spark, document, **selection):
    frame = spark.createDataFrame([(json.dumps(document),)], "value string")
    selected = manifest.select_names(manifest.manifest_names(frame), **selection)
    return sorted(row.file_name for row in selected.collect())


A, B, C = (f"spend_data_2025-07-0{n}.json" for n in (7, 8, 9))


@pytest.mark.parametrize(
    "document",
    [
        [A, B, A, "notes.txt"],
        {"files": [A, B]},
        {"file_names": [A, B]},
        {"files": [], "spend_files": [A, B]},
        {"objects": [{"key": f"some/prefix/{A}"}, {"path": f"{B}/"}]},
        [{"file_name": A}, {"filename": "", "name": B}, {"other": C}, 7, None],
    ],
)
def test_manifest_shapes(spark, document):
    assert names(spark, document) == [A, B]


@pytest.mark.parametrize("document", [{}, {"files": "x"}, ["notes.txt"], "text", 3])
def test_manifest_without_names(spark, document):
    frame = spark.createDataFrame([(json.dumps(document),)], "value string")
    with pytest.raises(ValueError, match="no spend files"):
        manifest.require_names(manifest.manifest_names(frame))


@pytest.mark.parametrize(
    "selection, expected",
    [
        ({}, [A, B, C]),
        ({"file_name": B}, [B]),
        ({"file_name": "spend_data_none.json"}, []),
        ({"file_names": [A, C, "other"]}, [A, C]),
        ({"file_names": []}, []),
        ({"newest": 2}, [B, C]),
        ({"newest": 0}, [A, B, C]),
        ({"newest": 2, "cap": 1}, [C]),
        ({"file_names": [A, B], "cap": 1}, [B]),
        ({"file_name": A, "newest": 2}, [A]),
    ],
)
def test_selection(spark, selection, expected):
    assert names(spark, [A, B, C], **selection) == expected


@pytest.mark.parametrize("cap", [0, -1])
def test_cap_must_be_positive(spark, cap):
    with pytest.raises(ValueError, match="positive"):
        names(spark, [A], cap=cap)
