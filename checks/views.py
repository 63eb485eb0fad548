"""The library's inputs, derived in Spark from the supplied tables, and the same in SQL.

The supplied tables hold no bookings or spend, so ``events`` stands in for both (and
``orders`` and ``lineitem`` for larger ones). One channel has bookings only and one has spend
only, and some attributes are missing or malformed, so that every rule has rows to act on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.functions import columns as c
from adlake.session import staging_path

SITE = "https://bookings.example"

CHANNELS = {
    f"{SITE}/event_types/click": "paid_social",
    f"{SITE}/event_types/view": "paid_video",
    f"{SITE}/event_types/purchase": "paid_search",
}

SPEND_CHANNELS = ["paid_social", "paid_video", "paid_audio"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with its counter ``k`` read out of ``props``, in zoned time."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        # generated, so that props is parsed once however many columns use k
        F.inline(F.array(F.from_json("props", "k int"))),
    )


def _case(names: dict[str, str]) -> Column:
    return c.lookup(F.col("event_type"), names)


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver bookings as gold reads them."""
    k, user = F.col("k"), F.col("user_id")
    meets = F.col("ts") + F.make_dt_interval(F.lit(0), k)
    staff = (user % 10).cast("string")
    return events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("booking_id"),
        _case({"click": "paid_social", "view": "paid_video", "purchase": "paid_search"}).alias(
            "channel"
        ),
        F.to_date("ts").alias("booking_date"),
        F.to_date(meets).alias("meeting_date"),
        c.day_name(meets).alias("meeting_day_of_week"),
        c.hour_of_day(meets).alias("meeting_hour"),
        c.week_start(meets).alias("meeting_week_start_date"),
        F.when(k % 5 != 0, F.concat(F.lit("campaign_"), k % 5)).alias("utm_campaign"),
        F.when(user % 10 != 0, F.concat(F.lit("emp_"), staff)).alias("employee_id"),
        F.when(user % 10 != 0, F.concat(F.lit("Host "), staff, F.lit("."), k % 3)).alias(
            "employee_name"
        ),
        F.when(k % 7 != 0, F.concat(F.lit("host"), staff, F.lit("@example.com"))).alias(
            "employee_email"
        ),
    )


BOOKINGS_SQL = """
ev AS (SELECT event_id, ts, user_id, event_type, value, CAST(props->>'k' AS INT) AS k FROM events),
bk AS (SELECT CAST(event_id AS VARCHAR) AS booking_id,
  CASE event_type WHEN 'click' THEN 'paid_social' WHEN 'view' THEN 'paid_video'
                  WHEN 'purchase' THEN 'paid_search' END AS channel,
  CAST(ts AS DATE) AS booking_date,
  CAST(ts + to_hours(k) AS DATE) AS meeting_date,
  dayname(ts + to_hours(k)) AS meeting_day_of_week,
  CAST(hour(ts + to_hours(k)) AS INT) AS meeting_hour,
  CAST(date_trunc('week', ts + to_hours(k)) AS DATE) AS meeting_week_start_date,
  CASE WHEN k % 5 <> 0 THEN 'campaign_' || (k % 5) END AS utm_campaign,
  CASE WHEN user_id % 10 <> 0 THEN 'emp_' || (user_id % 10) END AS employee_id,
  CASE WHEN user_id % 10 <> 0 THEN 'Host ' || (user_id % 10) || '.' || (k % 3) END AS employee_name,
  CASE WHEN k % 7 <> 0 THEN 'host' || (user_id % 10) || '@example.com' END AS employee_email
  FROM ev),
b AS (SELECT * FROM bk WHERE channel IS NOT NULL)"""


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver spend as gold reads it."""
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("spend_date"),
        _case({"click": "paid_social", "view": "paid_video", "error": "paid_audio"}).alias(
            "channel"
        ),
        F.col("value").alias("spend_usd"),
    )


SPEND_SQL = """
s AS (SELECT * FROM (SELECT CAST(ts AS DATE) AS spend_date,
  CASE event_type WHEN 'click' THEN 'paid_social' WHEN 'view' THEN 'paid_video'
                  WHEN 'error' THEN 'paid_audio' END AS channel,
  CAST(value AS DECIMAL(18,2)) AS usd FROM events) WHERE channel IS NOT NULL AND usd >= 0)"""


def order_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = F.col("o_custkey")
    ordered = F.col("o_orderdate").cast("timestamp")
    meets = ordered + F.make_dt_interval(customer % 30, F.col("o_orderkey") % 24)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("booking_id"),
        F.col("o_orderstatus").alias("channel"),
        F.to_date("o_orderdate").alias("booking_date"),
        F.to_date(meets).alias("meeting_date"),
        c.day_name(meets).alias("meeting_day_of_week"),
        c.hour_of_day(meets).alias("meeting_hour"),
        c.week_start(meets).alias("meeting_week_start_date"),
        F.col("o_orderpriority").alias("utm_campaign"),
        F.concat(F.lit("emp_"), customer % 100).alias("employee_id"),
        F.concat(F.lit("Host "), customer % 100).alias("employee_name"),
        F.concat(F.lit("host"), customer % 100, F.lit("@example.com")).alias("employee_email"),
    )


ORDER_BOOKINGS_SQL = """
om AS (SELECT *, o_orderdate + to_days(CAST(o_custkey % 30 AS INT)) + to_hours(o_orderkey % 24) AS meets
  FROM orders),
b AS (SELECT CAST(o_orderkey AS VARCHAR) AS booking_id, o_orderstatus AS channel,
  CAST(o_orderdate AS DATE) AS booking_date, CAST(meets AS DATE) AS meeting_date,
  dayname(meets) AS meeting_day_of_week, CAST(hour(meets) AS INT) AS meeting_hour,
  CAST(date_trunc('week', meets) AS DATE) AS meeting_week_start_date,
  o_orderpriority AS utm_campaign, 'emp_' || (o_custkey % 100) AS employee_id,
  'Host ' || (o_custkey % 100) AS employee_name,
  'host' || (o_custkey % 100) || '@example.com' AS employee_email FROM om)"""


def line_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("spend_date"),
        F.col("l_linestatus").alias("channel"),
        F.col("l_extendedprice").alias("spend_usd"),
    )


LINE_SPEND_SQL = """
s AS (SELECT CAST(l_shipdate AS DATE) AS spend_date, l_linestatus AS channel,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS usd FROM lineitem)"""


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def webhook_events(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Every row of ``events``, or of ``rows`` made of it, as a webhook event, some of them broken
    in known ways. Further columns of ``rows`` stay."""
    k, user = F.col("k"), F.col("user_id")
    number = F.col("event_id").cast("string")
    starts = _iso(F.col("ts") + F.make_dt_interval(F.lit(0), k))
    staff = (user % 10).cast("string")
    host = F.struct(
        F.concat(F.lit(f"{SITE}/users/emp_"), staff).alias("user"),
        F.concat(F.lit("Host "), staff).alias("user_name"),
        F.concat(F.lit("host"), staff, F.lit("@example.com")).alias("user_email"),
    )

    def question(text: str, answer: Column, position: int) -> Column:
        return F.struct(
            F.lit(text).alias("question"),
            answer.alias("answer"),
            F.lit(position).alias("position"),
        )

    asked = F.array(
        question("Which team are you on?", F.lit("sales"), 0),
        question("What is your Phone number?", F.concat(F.lit("+1 555 "), user), 1),
    )
    meeting = F.struct(
        F.concat(F.lit(f"{SITE}/meetings/M"), number).alias("uri"),
        F.lit("Intro call").alias("name"),
        F.lit("active").alias("status"),
        F.concat(F.lit(f"{SITE}/event_types/"), "event_type").alias("event_type"),
        F.when(k % 17 == 0, F.lit("not a time"))
        .when(k % 19 == 0, F.lit(None))
        .otherwise(starts)
        .alias("start_time"),
        starts.alias("end_time"),
        F.struct(
            F.lit("custom").alias("type"),
            F.when(k % 4 == 0, F.lit("Room 1")).alias("location"),
        ).alias("location"),
        F.when(user % 10 == 0, F.array().cast("array<struct<user: string, user_name: string, user_email: string>>"))
        .otherwise(F.array(host))
        .alias("event_memberships"),
    )
    payload = F.struct(
        F.concat(
            F.lit(f"{SITE}/meetings/M"),
            number,
            F.lit("/invitees/B"),
            number,
            F.when(k % 13 == 0, F.lit("/")).otherwise(F.lit("")),
        ).alias("uri"),
        _iso(F.col("ts")).alias("created_at"),
        F.concat(F.lit("guest"), user, F.lit("@example.com")).alias("email"),
        F.when(k % 2 == 1, asked).alias("questions_and_answers"),
        meeting.alias("scheduled_event"),
        F.struct(F.when(k % 5 != 0, F.concat(F.lit("campaign_"), k % 5)).alias("utm_campaign")).alias(
            "tracking"
        ),
    )
    rows = events(spark, sf_dir) if rows is None else rows
    further = [name for name in rows.columns if name not in ("event_id", "k", "ts", "user_id", "event_type", "value")]
    return rows.select(
        *further,
        "event_id",
        "k",
        "ts",
        F.struct(
            F.when(k % 11 == 0, F.lit("invitee.canceled"))
            .otherwise(F.lit("invitee.created"))
            .alias("event"),
            _iso(F.col("ts")).alias("created_at"),
            F.lit(f"{SITE}/users/owner").alias("created_by"),
            payload.alias("payload"),
        ).alias("raw_event"),
    )


# every webhook event with the fields that silver derives; t is the meeting time
WEBHOOKS_SQL = """
ev AS (SELECT event_id, ts, user_id, event_type, CAST(props->>'k' AS INT) AS k FROM events),
w AS (SELECT event_id, k, ts, 'B' || event_id AS booking_id, 'M' || event_id AS scheduled_event_id,
  CASE WHEN k % 11 = 0 THEN 'invitee.canceled' ELSE 'invitee.created' END AS webhook_event,
  CASE event_type WHEN 'click' THEN 'paid_social' WHEN 'view' THEN 'paid_video'
                  WHEN 'purchase' THEN 'paid_search' END AS channel,
  CAST(ts AS DATE) AS booking_date,
  CASE WHEN k % 17 <> 0 AND k % 19 <> 0 THEN ts + to_hours(k) END AS t,
  k % 17 <> 0 AND k % 19 = 0 AS no_start,
  k % 17 = 0 AS bad_start,
  CASE WHEN k % 2 = 1 THEN '+1 555 ' || user_id END AS invitee_phone,
  CASE WHEN k % 5 <> 0 THEN 'campaign_' || (k % 5) END AS utm_campaign,
  CASE WHEN k % 4 = 0 THEN 'Room 1' END AS meeting_location,
  CASE WHEN user_id % 10 <> 0 THEN 'emp_' || (user_id % 10) END AS employee_id
  FROM ev)"""

VALID_WEBHOOK_SQL = "webhook_event = 'invitee.created' AND channel IS NOT NULL AND t IS NOT NULL"


def bronze_bookings(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    found = webhook_events(spark, sf_dir, rows)
    return found.select(
        *(name for name in found.columns if name not in ("event_id", "k", "ts", "raw_event")),
        F.lit("events").alias("source_system"),
        _iso(F.col("ts")).alias("ingestion_timestamp"),
        F.concat(F.lit("bronze/"), "event_id").alias("raw_s3_key"),
        "raw_event",
    )


def bronze_bookings_on_disk(spark: SparkSession, sf_dir: str, *, times: int = 1, packed: bool = False) -> str:
    """The same, written as JSON lines, each event so many times; returns the folder."""
    path = staging_path(spark, "bronze-bookings")
    for _ in range(times):
        writer = bronze_bookings(spark, sf_dir).write.mode("append")
        writer.option("compression", "gzip" if packed else "none").json(path)
    return path


def webhook_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests carrying the webhook events; some bodies are base64, some unusable."""
    k = F.col("k")
    body = F.to_json("raw_event")
    requests = webhook_events(spark, sf_dir).select(
        "event_id",
        F.when(k % 23 == 0, F.lit(None))
        .when(k % 23 == 1, F.lit("{broken"))
        .when(k % 23 == 2, F.lit("[1, 2]"))
        .when(k % 3 == 0, F.base64(F.encode(body, "utf-8")))
        .otherwise(body)
        .alias("body"),
        ((k % 3 == 0) & (k % 23 > 2)).alias("isBase64Encoded"),
    )
    return c.settled(requests)


EVENTS_PER_DOCUMENT = 10_000


def documents_on_disk(spark: SparkSession, sf_dir: str) -> str:
    """Packed JSON documents, each an array of some ``EVENTS_PER_DOCUMENT`` bronze events, however
    many there are, beside packed files of other names; returns the folder.

    The rows of a document are brought together while they are as narrow as in ``events``, and each
    document by a task of its own, as it is put together in memory."""
    path = staging_path(spark, "documents")
    found = events(spark, sf_dir)
    documents = max(16, -(-found.count() // EVENTS_PER_DOCUMENT))
    part = F.pmod(F.xxhash64("event_id"), F.lit(documents)).cast("int").alias("part")
    dealt = bronze_bookings(spark, sf_dir, found.select("*", part).repartitionById(documents, F.col("part")))
    row = F.struct(*(name for name in dealt.columns if name != "part"))
    whole = dealt.groupBy("part").agg(F.to_json(F.collect_list(row)).alias("value"))
    whole.write.partitionBy("part").option("compression", "gzip").text(f"{path}/a")
    skipped = bronze_bookings(spark, sf_dir).write.option("compression", "gzip")
    skipped.json(f"{path}/a/part=0/skipped")
    return path


REQUESTS_PER_FILE = 100_000


def webhook_requests_on_disk(spark: SparkSession, sf_dir: str) -> str:
    """The same as packed logs, each read whole by one task; returns the folder."""
    path = staging_path(spark, "requests")
    writer = webhook_requests(spark, sf_dir).select("body", "isBase64Encoded").write
    writer.option("compression", "gzip").option("maxRecordsPerFile", REQUESTS_PER_FILE).json(path)
    return path


def _written_spend() -> tuple[Column, Column, Column]:
    k = F.col("k")
    date = (
        F.when(k % 29 == 0, F.lit("not-a-date"))
        .when(k % 29 == 1, F.lit(None))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    channel = _case(
        {"click": "paid_social", "view": "paid_video", "error": "paid_audio", "signup": "print"}
    )
    amount = (
        F.when(k % 23 == 0, -F.col("value"))
        .when(k % 23 == 1, F.lit(None))
        .otherwise(F.col("value"))
        .cast("string")
    )
    return date, channel, F.when(k % 23 == 2, F.lit("n/a")).otherwise(amount)


RECORDS_PER_FILE = 200


def bronze_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend files of up to ``RECORDS_PER_FILE`` records, however many events there are."""
    date, channel, amount = _written_spend()
    record = F.struct(date.alias("date"), channel.alias("channel"), amount.alias("spend"))
    number = F.floor(F.col("event_id") / RECORDS_PER_FILE)
    files = (
        events(spark, sf_dir)
        .groupBy(number.alias("number"))
        .agg(F.collect_list(record).alias("raw_payload"))
    )
    return files.select(
        F.lit("events").alias("source_system"),
        F.concat(F.lit("spend_data_"), "number", F.lit(".json")).alias("source_file_name"),
        "raw_payload",
    )


# every spend record with its reject reasons
SPEND_RECORDS_SQL = """
ev AS (SELECT event_id, ts, event_type, value, CAST(props->>'k' AS INT) AS k FROM events),
r AS (SELECT 'spend_data_' || (event_id // 200) || '.json' AS source_file,
  CASE WHEN k % 29 = 0 THEN 'not-a-date' WHEN k % 29 = 1 THEN NULL
       ELSE strftime(ts, '%Y-%m-%d') END AS written_date,
  CASE WHEN k % 29 > 1 THEN CAST(ts AS DATE) END AS spend_date,
  CASE event_type WHEN 'click' THEN 'paid_social' WHEN 'view' THEN 'paid_video'
    WHEN 'error' THEN 'paid_audio' WHEN 'signup' THEN 'print' END AS channel,
  CASE WHEN k % 23 = 0 THEN -value WHEN k % 23 > 2 THEN value END AS spend_usd,
  k % 23 = 1 AS no_spend, k % 23 = 2 AS bad_spend FROM ev),
x AS (SELECT *, concat_ws(',',
  CASE WHEN written_date IS NULL THEN 'missing_date' END,
  CASE WHEN written_date = 'not-a-date' THEN 'invalid_date' END,
  CASE WHEN channel IS NULL THEN 'missing_channel' END,
  CASE WHEN channel = 'print' THEN 'unsupported_channel' END,
  CASE WHEN no_spend THEN 'missing_spend' END,
  CASE WHEN bad_spend THEN 'invalid_spend' END,
  CASE WHEN spend_usd < 0 THEN 'negative_spend' END) AS reasons FROM r)"""
