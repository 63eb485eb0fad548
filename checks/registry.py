"""One entry per query: its name, the Spark query, and the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adlake import schemas
from adlake.functions import columns as c
from adlake.operators import (
    bitmaps,
    channel_history,
    drift,
    gold_bookings,
    gold_combined,
    gold_extra,
    gold_spend,
    silver_bookings,
    silver_spend,
)
from adlake.operators.quality import reason_counts, rejected_rows, valid_rows
from adlake.plans import jobs, reports
from adlake.session import staging_path
from adlake.sources import intake, manifest, readers, sinks
from adlake.streaming import jobs as streams
from checks import views
from checks.views import (
    BOOKINGS_SQL,
    LINE_SPEND_SQL,
    ORDER_BOOKINGS_SQL,
    SPEND_RECORDS_SQL,
    SPEND_SQL,
    VALID_WEBHOOK_SQL,
    WEBHOOKS_SQL,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def exact_ratio(total: str, count: str) -> str:
    """``total / count`` in cents, half up, in whole-number arithmetic (total >= 0)."""
    return (
        f"CASE WHEN {count} > 0 THEN "
        f"((2 * CAST({total} * 100 AS HUGEINT) + {count}) // (2 * {count})) / 100.0 END"
    )


# --- gold: bookings -------------------------------------------------------------------


def _calls_sql(keys: str, source: str = BOOKINGS_SQL, select: str | None = None) -> str:
    return (
        f"WITH {source} SELECT {select or keys}, COUNT(DISTINCT booking_id) AS booked_call_count "
        f"FROM b GROUP BY {keys}"
    )


LOAD_KEYS = (
    "COALESCE(employee_id, 'unknown_employee'), COALESCE(employee_name, 'Unknown Employee'), "
    "COALESCE(employee_email, 'unknown_email')"
)
LOAD_SELECT = (
    "COALESCE(employee_id, 'unknown_employee') AS employee_id, "
    "COALESCE(employee_name, 'Unknown Employee') AS employee_name, "
    "COALESCE(employee_email, 'unknown_email') AS employee_email"
)
CAMPAIGN = "COALESCE(utm_campaign, 'unknown_campaign')"

BOOKING_TABLES_SQL = {
    "daily_calls_by_source": _calls_sql("booking_date, channel"),
    "booking_trends": _calls_sql("booking_date"),
    "channel_attribution": _calls_sql(
        f"channel, {CAMPAIGN}", select=f"channel, {CAMPAIGN} AS utm_campaign"
    ),
    "booking_volume_by_time_slot": _calls_sql("meeting_day_of_week, meeting_hour"),
    "employee_meeting_load": _calls_sql(LOAD_KEYS, select=LOAD_SELECT),
    "booking_dashboard_kpis": f"""WITH {BOOKINGS_SQL}
      SELECT COUNT(DISTINCT booking_id) AS total_bookings, COUNT(DISTINCT channel) AS channel_count,
        COUNT(DISTINCT booking_date) AS booking_date_count,
        COUNT(DISTINCT meeting_date) AS meeting_date_count FROM b""",
}

for _name, _sql in BOOKING_TABLES_SQL.items():
    check(_name, _sql)(
        lambda spark, sf, name=_name: gold_bookings.booking_tables(views.bookings(spark, sf))[name]
    )


def _cube_sql(source: str) -> str:
    columns = {
        "booking_date": "DATE",
        "channel": "VARCHAR",
        "utm_campaign": "VARCHAR",
        "meeting_day_of_week": "VARCHAR",
        "meeting_hour": "INT",
        "employee_id": "VARCHAR",
        "employee_name": "VARCHAR",
        "employee_email": "VARCHAR",
        "meeting_date": "DATE",
    }
    filled = {
        "utm_campaign": CAMPAIGN,
        "employee_id": "COALESCE(employee_id, 'unknown_employee')",
        "employee_name": "COALESCE(employee_name, 'Unknown Employee')",
        "employee_email": "COALESCE(employee_email, 'unknown_email')",
    }
    grains = gold_bookings.GRAINS | {"meeting_dates": ["meeting_date"], "everything": []}
    parts = []
    for grain, keys in grains.items():
        shown = ", ".join(
            f"{filled.get(n, n)} AS {n}" if n in keys else f"CAST(NULL AS {t}) AS {n}"
            for n, t in columns.items()
        )
        grouped = f" GROUP BY {', '.join(filled.get(n, n) for n in keys)}" if keys else ""
        parts.append(
            f"SELECT '{grain}' AS grain, {shown}, "
            f"COUNT(DISTINCT booking_id) AS booked_call_count FROM b{grouped}"
        )
    return f"WITH {source} " + " UNION ALL ".join(parts)


@check("booking_cube", _cube_sql(BOOKINGS_SQL))
def _booking_cube(spark, sf):
    return gold_bookings.booking_cube(views.bookings(spark, sf))


@check("booking_kpis_from_cube", BOOKING_TABLES_SQL["booking_dashboard_kpis"])
def _booking_kpis_from_cube(spark, sf):
    cube = gold_bookings.booking_cube(views.bookings(spark, sf))
    return gold_bookings.tables_from_cube(cube)["booking_dashboard_kpis"]


@check(
    "time_slot_by_channel",
    f"""WITH {BOOKINGS_SQL} SELECT meeting_day_of_week, meeting_hour, channel,
      COUNT(DISTINCT booking_id) AS bookings FROM b GROUP BY ALL""",
)
def _time_slot_by_channel(spark, sf):
    return gold_extra.time_slot_by_channel(views.bookings(spark, sf))


@check(
    "employee_weekly_load",
    f"""WITH {BOOKINGS_SQL}, n AS (SELECT employee_id, employee_name, MAX(booking_date) AS d
        FROM bk WHERE employee_id IS NOT NULL GROUP BY ALL),
      named AS (SELECT employee_id, employee_name FROM n QUALIFY
        row_number() OVER (PARTITION BY employee_id ORDER BY d DESC, employee_name DESC) = 1),
      g AS (SELECT employee_id, COUNT(DISTINCT booking_id) AS m,
        COUNT(DISTINCT meeting_week_start_date) AS w FROM bk WHERE employee_id IS NOT NULL GROUP BY ALL),
      q AS (SELECT *, (100 * m) // w AS lo, 2 * ((100 * m) % w) AS rest FROM g)
      SELECT employee_id, employee_name, m AS total_meetings, w AS number_of_weeks,
        (lo + CASE WHEN rest > w OR (rest = w AND lo % 2 = 1) THEN 1 ELSE 0 END) / 100.0
          AS avg_meetings_per_week
      FROM q JOIN named USING (employee_id)""",
)
def _employee_weekly_load(spark, sf):
    return gold_extra.employee_weekly_load(views.bookings(spark, sf))


# --- gold: spend ----------------------------------------------------------------------


def _summary_sql(source: str) -> str:
    return f"""WITH {source}, g AS (SELECT channel, SUM(usd) AS t, COUNT(DISTINCT spend_date) AS n
        FROM s GROUP BY channel)
      SELECT channel, CAST(t AS DOUBLE) AS total_spend_usd, n AS spend_day_count,
        {exact_ratio("t", "n")} AS average_daily_spend_usd FROM g"""


def _daily_spend_sql(source: str) -> str:
    return f"""WITH {source} SELECT spend_date, channel, CAST(SUM(usd) AS DOUBLE) AS total_spend_usd
      FROM s GROUP BY ALL"""


@check("daily_spend_by_channel", _daily_spend_sql(SPEND_SQL))
def _daily_spend_by_channel(spark, sf):
    return gold_spend.daily_spend_by_channel(views.spend(spark, sf))


@check("channel_spend_summary", _summary_sql(SPEND_SQL))
def _channel_spend_summary(spark, sf):
    return gold_spend.channel_spend_summary(views.spend(spark, sf))


# --- gold: combined -------------------------------------------------------------------


def _cpb_sql(keys: str, sources: str) -> str:
    """Cost per booking by a full outer join, on ``metric_date, channel`` or ``channel``."""
    return f"""WITH {sources},
      sp AS (SELECT {keys}, SUM(usd) AS t FROM
        (SELECT spend_date AS metric_date, channel, usd FROM s) GROUP BY {keys}),
      bo AS (SELECT {keys}, COUNT(DISTINCT booking_id) AS n FROM
        (SELECT booking_date AS metric_date, channel, booking_id FROM b) GROUP BY {keys}),
      j AS (SELECT {keys}, COALESCE(t, 0) AS t, COALESCE(n, 0) AS n
        FROM sp FULL OUTER JOIN bo USING ({keys}))
      SELECT {keys}, CAST(t AS DOUBLE) AS total_spend_usd, n AS booked_call_count,
        {exact_ratio("t", "n")} AS cost_per_booking_usd FROM j"""


def _kpis_sql(sources: str) -> str:
    return f"""WITH {sources},
      k AS (SELECT (SELECT COALESCE(SUM(usd), 0) FROM s) AS t,
        (SELECT COUNT(DISTINCT booking_id) FROM b) AS n)
      SELECT CAST(t AS DOUBLE) AS total_spend_usd, n AS total_bookings,
        {exact_ratio("t", "n")} AS average_cost_per_booking_usd,
        (SELECT COUNT(*) FROM (SELECT channel FROM s UNION SELECT channel FROM b)) AS channel_count,
        (SELECT COUNT(DISTINCT spend_date) FROM s) AS spend_date_count,
        (SELECT COUNT(DISTINCT booking_date) FROM b) AS booking_date_count FROM k"""


BOTH_SQL = f"{BOOKINGS_SQL}, {SPEND_SQL}"
COMBINED_TABLES_SQL = {
    "cpb_by_channel": _cpb_sql("channel", BOTH_SQL),
    "daily_cpb_by_channel": _cpb_sql("metric_date, channel", BOTH_SQL),
    "combined_dashboard_kpis": _kpis_sql(BOTH_SQL),
}


def _inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return views.spend(spark, sf), views.bookings(spark, sf)


for _name, _sql in COMBINED_TABLES_SQL.items():
    check(_name, _sql)(
        lambda spark, sf, name=_name: gold_combined.combined_tables(*_inputs(spark, sf))[name]
    )
    check(f"{_name}_from_cube", _sql)(
        lambda spark, sf, name=_name: gold_combined.tables_from_cube(
            gold_combined.combined_cube(*_inputs(spark, sf))
        )[name]
    )


@check(
    "dashboard_kpis",
    f"""SELECT total_bookings, total_spend_usd AS total_spend,
      average_cost_per_booking_usd AS average_cpb
      FROM ({COMBINED_TABLES_SQL["combined_dashboard_kpis"]})""",
)
def _dashboard_kpis(spark, sf):
    return gold_combined.dashboard_kpis(*_inputs(spark, sf))


@check(
    "campaign_cpb",
    f"""WITH {BOTH_SQL}, sp AS (SELECT channel, SUM(usd) AS t FROM s GROUP BY channel),
      g AS (SELECT channel, {CAMPAIGN} AS campaign, COUNT(DISTINCT booking_id) AS n FROM b GROUP BY ALL),
      j AS (SELECT channel, campaign, n, COALESCE(t, 0) AS t FROM g LEFT JOIN sp USING (channel))
      SELECT channel, campaign, n AS total_bookings, CAST(t AS DOUBLE) AS total_spend,
        {exact_ratio("t", "n")} AS cost_per_booking FROM j""",
)
def _campaign_cpb(spark, sf):
    return gold_extra.campaign_cpb(*_inputs(spark, sf))


@check(
    "channel_union",
    f"WITH {BOTH_SQL} SELECT channel FROM s UNION SELECT channel FROM b",
)
def _channel_union(spark, sf):
    return gold_combined.channels_in_use(*_inputs(spark, sf))


# --- gold at scale: orders as bookings, line items as spend ------------------------------

LINE_BOTH_SQL = f"{ORDER_BOOKINGS_SQL}, {LINE_SPEND_SQL}"


def _line_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return views.line_spend(spark, sf), views.order_bookings(spark, sf)


@check("line_cpb_daily", _cpb_sql("metric_date, channel", LINE_BOTH_SQL))
def _line_cpb_daily(spark, sf):
    return gold_combined.daily_cpb_by_channel(*_line_inputs(spark, sf))


@check("line_cpb_daily_from_cube", _cpb_sql("metric_date, channel", LINE_BOTH_SQL))
def _line_cpb_daily_from_cube(spark, sf):
    cube = gold_combined.combined_cube(*_line_inputs(spark, sf))
    return gold_combined.tables_from_cube(cube)["daily_cpb_by_channel"]


@check("line_cpb", _cpb_sql("channel", LINE_BOTH_SQL))
def _line_cpb(spark, sf):
    return gold_combined.cpb_by_channel(*_line_inputs(spark, sf))


@check("line_kpis", _kpis_sql(LINE_BOTH_SQL))
def _line_kpis(spark, sf):
    return gold_combined.combined_dashboard_kpis(*_line_inputs(spark, sf))


@check("line_spend_summary", _summary_sql(LINE_SPEND_SQL))
def _line_spend_summary(spark, sf):
    return gold_spend.channel_spend_summary(views.line_spend(spark, sf))


@check("order_booking_cube", _cube_sql(ORDER_BOOKINGS_SQL))
def _order_booking_cube(spark, sf):
    return gold_bookings.booking_cube(views.order_bookings(spark, sf))


def _long_sql(source: str) -> str:
    """The five tables in one, keys as text: what :func:`_long` makes of them."""
    return f"WITH cube AS ({_cube_sql(source)}) " + " UNION ALL ".join(
        f"SELECT grain, concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}) AS keys, "
        f"booked_call_count FROM cube WHERE grain = '{grain}'"
        for grain, keys in gold_bookings.GRAINS.items()
    )


@check("order_booking_tables", _long_sql(ORDER_BOOKINGS_SQL))
def _order_booking_tables(spark, sf):
    """The booking tables one by one, for comparison with the cube."""
    tables = gold_bookings.booking_tables(views.order_bookings(spark, sf))
    longs = [
        tables[grain].select(
            F.lit(grain).alias("grain"),
            F.concat_ws("|", *(F.col(key).cast("string") for key in keys)).alias("keys"),
            "booked_call_count",
        )
        for grain, keys in gold_bookings.GRAINS.items()
    ]
    merged = longs[0]
    for table in longs[1:]:
        merged = merged.unionByName(table)
    return merged


@check(
    "order_employee_load",
    _calls_sql("employee_id, employee_name, employee_email", ORDER_BOOKINGS_SQL),
)
def _order_employee_load(spark, sf):
    return gold_bookings.employee_meeting_load(views.order_bookings(spark, sf))


# --- silver ---------------------------------------------------------------------------

SILVER_FIELDS = [
    "booking_id", "scheduled_event_id", "channel", "booking_date", "meeting_date",
    "meeting_day_of_week", "meeting_hour", "meeting_week_start_date", "invitee_phone",
    "invitee_canceled", "meeting_location", "utm_campaign", "employee_id",
]

SILVER_SELECT_SQL = """booking_id, scheduled_event_id, channel, booking_date,
  CAST(t AS DATE) AS meeting_date, dayname(t) AS meeting_day_of_week,
  CAST(hour(t) AS INT) AS meeting_hour, CAST(date_trunc('week', t) AS DATE) AS meeting_week_start_date,
  invitee_phone, CAST(NULL AS BOOLEAN) AS invitee_canceled, meeting_location, utm_campaign, employee_id"""

SILVER_SQL = f"WITH {WEBHOOKS_SQL} SELECT {SILVER_SELECT_SQL} FROM w WHERE {VALID_WEBHOOK_SQL}"


@check("silver_bookings_derived", SILVER_SQL)
def _silver_bookings_derived(spark, sf):
    bronze = views.bronze_bookings(spark, sf)
    return silver_bookings.bookings(bronze, views.CHANNELS).select(SILVER_FIELDS)


@check(
    "bronze_booking_scan",
    f"""WITH {WEBHOOKS_SQL} SELECT {SILVER_SELECT_SQL}, 'events' AS bronze_source_system,
      'bronze/' || event_id AS bronze_raw_s3_key, TRUE AS has_path FROM w WHERE {VALID_WEBHOOK_SQL}""",
)
def _bronze_booking_scan(spark, sf):
    bronze = readers.read_bronze_bookings(
        spark, views.bronze_bookings_on_disk(spark, sf), layout="lines"
    )
    silver = silver_bookings.bookings(bronze, views.CHANNELS)
    return silver.select(
        *SILVER_FIELDS,
        "bronze_source_system",
        "bronze_raw_s3_key",
        F.col("bronze_source_file_path").endswith(".json").alias("has_path"),
    )


BOOKING_REASONS_SQL = """concat_ws(',',
  CASE WHEN webhook_event <> 'invitee.created' THEN 'unsupported_event' END,
  CASE WHEN channel IS NULL THEN 'unmapped_channel' END,
  CASE WHEN no_start THEN 'missing_meeting_date' END,
  CASE WHEN bad_start THEN 'invalid_meeting_date' END)"""


@check(
    "booking_rejects",
    f"""WITH {WEBHOOKS_SQL} SELECT * FROM
      (SELECT booking_id, {BOOKING_REASONS_SQL} AS reasons FROM w) WHERE reasons <> ''""",
)
def _booking_rejects(spark, sf):
    checked = silver_bookings.checked_bookings(views.bronze_bookings(spark, sf), views.CHANNELS)
    return rejected_rows(checked).select(
        "booking_id", F.array_join("reject_reasons", ",").alias("reasons")
    )


@check(
    "booking_reason_counts",
    f"""WITH {WEBHOOKS_SQL} SELECT reason, COUNT(*) AS row_count FROM
      (SELECT unnest(string_split({BOOKING_REASONS_SQL}, ',')) AS reason FROM w)
      WHERE reason <> '' GROUP BY reason""",
)
def _booking_reason_counts(spark, sf):
    bronze = views.bronze_bookings(spark, sf)
    return reason_counts(silver_bookings.checked_bookings(bronze, views.CHANNELS))


@check(
    "silver_spend_valid",
    f"""WITH {SPEND_RECORDS_SQL} SELECT spend_date, channel, spend_usd, source_file,
      'events' AS bronze_source_system FROM x WHERE reasons = ''""",
)
def _silver_spend_valid(spark, sf):
    silver = silver_spend.spend(views.bronze_spend(spark, sf), views.SPEND_CHANNELS)
    return silver.select("spend_date", "channel", "spend_usd", "source_file", "bronze_source_system")


@check(
    "spend_rejects",
    f"WITH {SPEND_RECORDS_SQL} SELECT written_date, channel, spend_usd, reasons FROM x WHERE reasons <> ''",
)
def _spend_rejects(spark, sf):
    checked = silver_spend.checked_spend(views.bronze_spend(spark, sf), views.SPEND_CHANNELS)
    return rejected_rows(checked).select(
        "written_date", "channel", "spend_usd", F.array_join("reject_reasons", ",").alias("reasons")
    )


@check(
    "spend_exploded",
    f"WITH {SPEND_RECORDS_SQL} SELECT source_file, written_date, channel, spend_usd FROM x",
)
def _spend_exploded(spark, sf):
    rows = silver_spend.explode_records(views.bronze_spend(spark, sf))
    return rows.select("source_file", F.col("_date").alias("written_date"), "channel", "spend_usd")


@check(
    "gold_booking_rejects",
    f"""WITH {BOOKINGS_SQL} SELECT booking_id, 'missing_channel' AS reasons FROM bk
      WHERE channel IS NULL""",
)
def _gold_booking_rejects(spark, sf):
    return rejected_rows(gold_bookings.checked_bookings(views.bookings(spark, sf))).select(
        "booking_id", F.array_join("reject_reasons", ",").alias("reasons")
    )


@check(
    "gold_spend_rejects",
    """SELECT CAST(ts AS DATE) AS spend_date, value AS spend_usd, 'missing_channel' AS reasons
      FROM events WHERE event_type NOT IN ('click', 'view', 'error')""",
)
def _gold_spend_rejects(spark, sf):
    return rejected_rows(gold_spend.checked_spend(views.spend(spark, sf))).select(
        "spend_date",
        F.col("written_spend_usd").alias("spend_usd"),
        F.array_join("reject_reasons", ",").alias("reasons"),
    )


# --- functions ------------------------------------------------------------------------


@check(
    "url_last_segment",
    r"SELECT page_id, NULLIF(regexp_extract(url, '([^/]+)/*$', 1), '') AS last_segment FROM pages",
)
def _url_last_segment(spark, sf):
    pages = views.table(spark, sf, "pages")
    return pages.select("page_id", c.last_segment(F.col("url")).alias("last_segment"))


@check(
    "url_campaign",
    """SELECT page_id, COALESCE(NULLIF(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), ''),
      'unknown_campaign') AS campaign FROM pages""",
)
def _url_campaign(spark, sf):
    campaign = c.query_parameter(F.col("url"), "utm_source")
    pages = views.table(spark, sf, "pages")
    return pages.select("page_id", c.label(campaign, "unknown_campaign").alias("campaign"))


@check(
    "instants",
    """SELECT event_id, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INT) AS hour, dayname(ts) AS day_name,
      CAST(date_trunc('week', ts) AS DATE) AS week_start FROM events""",
)
def _instants(spark, sf):
    """Timestamps written with an offset and read back land on the UTC day and hour."""
    there = F.from_utc_timestamp("ts", "+05:30")
    written = F.concat(F.date_format(there, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:30"))
    ts = c.instant(written)
    return views.events(spark, sf).select(
        "event_id",
        c.calendar_date(ts).alias("day"),
        c.hour_of_day(ts).alias("hour"),
        c.day_name(ts).alias("day_name"),
        c.week_start(ts).alias("week_start"),
    )


@check(
    "phone_answers",
    f"WITH {WEBHOOKS_SQL} SELECT event_id, invitee_phone FROM w WHERE invitee_phone IS NOT NULL",
)
def _phone_answers(spark, sf):
    asked = F.col("raw_event.payload.questions_and_answers")
    answers = views.webhook_events(spark, sf).select(
        "event_id", c.answer_to(asked, "PHONE").alias("invitee_phone")
    )
    return answers.dropna()


@check(
    "optional_fields",
    f"""WITH {WEBHOOKS_SQL} SELECT event_id, FALSE AS canceled, meeting_location AS place,
      'none' AS note, employee_id FROM w""",
)
def _optional_fields(spark, sf):
    rows = views.webhook_events(spark, sf)
    meeting = "raw_event.payload.scheduled_event"
    host = c.first_of(F.col(f"{meeting}.event_memberships"))["user"]
    return rows.select(
        "event_id",
        c.safe_col(rows, "raw_event.payload.canceled", False, "boolean").alias("canceled"),
        c.safe_col(rows, f"{meeting}.location.location").alias("place"),
        c.column_or(rows, "note", "none").alias("note"),
        c.last_segment(host).alias("employee_id"),
    )


@check(
    "order_cents",
    """SELECT o_orderkey, round(CAST(o_totalprice AS DECIMAL(18,2)), 2)::DOUBLE AS cents,
      ((2 * CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS HUGEINT) + (1 + o_custkey % 7))
        // (2 * (1 + o_custkey % 7))) / 100.0 AS share FROM orders""",
)
def _order_cents(spark, sf):
    total = c.money(F.col("o_totalprice"))
    return views.table(spark, sf, "orders").select(
        "o_orderkey",
        c.amount_usd(total).alias("cents"),
        c.cost_per(total, 1 + F.col("o_custkey") % 7).alias("share"),
    )


# --- intake ---------------------------------------------------------------------------

INTAKE_AT = "2024-02-01T06:00:00.000000+00:00"

REQUESTS_SQL = f"""{WEBHOOKS_SQL}, q AS (SELECT *, CASE WHEN k % 23 = 0 THEN 'missing_body'
  WHEN k % 23 = 1 THEN 'invalid_json' WHEN k % 23 = 2 THEN 'not_an_object' END AS broken FROM w)"""


def _intake(spark: SparkSession, sf: str) -> DataFrame:
    requests = views.webhook_requests(spark, sf)
    return intake.webhook_intake(requests, ingested_at=INTAKE_AT, channels=views.CHANNELS)


@check(
    "webhook_intake",
    f"""WITH {REQUESTS_SQL} SELECT webhook_event, booking_id, channel, '{INTAKE_AT}' AS ingestion_timestamp,
      'event_type=' || webhook_event || '/ingest_date=2024-02-01/' || booking_id || '.json' AS key_end,
      'events' AS source_system, 'Intro call' AS meeting_name
      FROM q WHERE broken IS NULL AND webhook_event = 'invitee.created'""",
)
def _webhook_intake(spark, sf):
    return valid_rows(_intake(spark, sf)).select(
        "webhook_event",
        "booking_id",
        "channel",
        "ingestion_timestamp",
        F.regexp_extract("raw_s3_key", "event_type=.*$", 0).alias("key_end"),
        F.lit("events").alias("source_system"),
        F.variant_get("raw_event", "$.payload.scheduled_event.name", "string").alias("meeting_name"),
    )


@check(
    "webhook_intake_rejects",
    f"""WITH {REQUESTS_SQL} SELECT CASE WHEN broken IS NULL THEN 'unsupported_event'
        ELSE broken || ',unsupported_event,missing_payload,missing_scheduled_event' END AS reasons,
      COUNT(*) AS row_count FROM q WHERE broken IS NOT NULL OR webhook_event <> 'invitee.created'
      GROUP BY ALL""",
)
def _webhook_intake_rejects(spark, sf):
    reasons = F.array_join("reject_reasons", ",").alias("reasons")
    return rejected_rows(_intake(spark, sf)).groupBy(reasons).agg(F.count("*").alias("row_count"))


@check(
    "webhook_to_silver",
    f"""WITH {REQUESTS_SQL} SELECT {SILVER_SELECT_SQL} FROM q
      WHERE broken IS NULL AND {VALID_WEBHOOK_SQL}""",
)
def _webhook_to_silver(spark, sf):
    """Requests to bronze folders and back, then to silver."""
    path = staging_path(spark, "bronze")
    bronze = valid_rows(_intake(spark, sf)).select(
        *intake.BOOKING_ENVELOPE, *intake.BOOKING_PARTITIONS
    )
    sinks.write_bronze(bronze, path, intake.BOOKING_PARTITIONS)
    read = readers.read_bronze_bookings(spark, path, layout="lines")
    return silver_bookings.bookings(read, views.CHANNELS).select(SILVER_FIELDS)


@check(
    "spend_intake",
    f"""WITH {SPEND_RECORDS_SQL} SELECT source_file AS source_file_name, COUNT(*) AS record_count,
      'ingest_date=2024-02-01/' || source_file AS key_end,
      'https://files.example/' || source_file AS source_url FROM x GROUP BY source_file""",
)
def _spend_intake(spark, sf):
    files = views.bronze_spend(spark, sf).select(
        "source_file_name", F.parse_json(F.to_json("raw_payload")).alias("raw_payload")
    )
    rows = intake.spend_envelopes(
        files, ingested_at=INTAKE_AT, source_base_url="https://files.example/"
    )
    return rows.select(
        "source_file_name",
        F.col("record_count").cast("long").alias("record_count"),
        F.regexp_extract("raw_s3_key", "ingest_date=.*$", 0).alias("key_end"),
        "source_url",
    )


@check(
    "spend_files_to_silver",
    f"WITH {SPEND_RECORDS_SQL} SELECT spend_date, channel, spend_usd FROM x WHERE reasons = ''",
)
def _spend_files_to_silver(spark, sf):
    """Spend arrays written as whole files, taken in, stored as bronze and read into silver."""
    raw, bronze = staging_path(spark, "spend-files"), staging_path(spark, "bronze-spend")
    # one array per partition folder, so that each file is one whole JSON document
    arrays = views.bronze_spend(spark, sf).select(
        "source_file_name", F.to_json("raw_payload").alias("value")
    )
    arrays.write.partitionBy("source_file_name").text(raw)
    taken = intake.spend_intake(spark, raw, ingested_at=INTAKE_AT, glob=None)
    sinks.write_bronze(taken.drop("record_count"), bronze, intake.SPEND_PARTITIONS)
    read = readers.read_bronze_spend(spark, bronze, layout="lines")
    return silver_spend.spend(read, views.SPEND_CHANNELS).select("spend_date", "channel", "spend_usd")


def _page_files(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("feed/spend_data_"), c.last_segment(F.col("url")), F.lit(".json"))
    return views.table(spark, sf, "pages").select("page_id", name.alias("path"))


FILES_SQL = r"""
f AS (SELECT page_id, 'spend_data_' || regexp_extract(url, '([^/]+)/*$', 1) || '.json' AS file_name FROM pages),
n AS (SELECT DISTINCT file_name FROM f)"""


@check("file_names", f"WITH {FILES_SQL} SELECT file_name FROM n")
def _file_names(spark, sf):
    return manifest.spend_file_names(_page_files(spark, sf))


@check("newest_files", f"WITH {FILES_SQL} SELECT file_name FROM n ORDER BY file_name DESC LIMIT 25")
def _newest_files(spark, sf):
    names = manifest.spend_file_names(_page_files(spark, sf))
    return manifest.select_names(names, newest=40, cap=25)


@check(
    "manifest_names",
    f"WITH {FILES_SQL} SELECT DISTINCT file_name FROM f",
)
def _manifest_names(spark, sf):
    """A manifest per page, in each accepted shape by turns, each with entries to ignore."""
    path, shape = F.col("path"), F.col("page_id") % 4
    ignored = F.lit("feed/readme.txt")
    by_key = F.array(F.struct(path.alias("key")), F.struct(ignored.alias("key")))
    text = (
        F.when(shape == 0, F.to_json(F.array(path, ignored)))
        .when(shape == 1, F.to_json(F.struct(F.array(path, ignored).alias("files"))))
        .when(shape == 2, F.to_json(F.struct(by_key.alias("objects"))))
        .otherwise(F.to_json(by_key))
    )
    return manifest.manifest_names(_page_files(spark, sf).select(text.alias("value")))


# --- drift of payloads -------------------------------------------------------------------


@check(
    "payload_drift",
    f"""WITH {WEBHOOKS_SQL}
      SELECT CAST(ts AS DATE) AS day, 'payload.surprise' AS path, 'unlisted' AS change, 'OBJECT' AS kind, COUNT(*) AS events
      FROM w WHERE k % 13 = 0 GROUP BY ALL
      UNION ALL SELECT CAST(ts AS DATE), 'payload.scheduled_event.name', 'type', 'BIGINT', COUNT(*) FROM w WHERE k % 29 = 0 GROUP BY ALL""",
)
def _payload_drift(spark, sf):
    """Events with a field that no schema lists, and with one that has another type."""
    events, k = views.webhook_events(spark, sf), F.col("k")
    text = F.to_json("raw_event")
    text = F.when(k % 13 == 0, F.replace(text, F.lit('"payload":{'), F.lit('"payload":{"surprise":{"a":[1]},'))).otherwise(text)
    text = F.when(k % 29 == 0, F.replace(text, F.lit('"name":"Intro call"'), F.lit('"name":7'))).otherwise(text)
    rows = c.settled(events.select(F.to_date("ts").alias("day"), F.parse_json(text).alias("payload")))
    declared = StructType.fromDDL(f"e {schemas.WEBHOOK_EVENT}")["e"].dataType
    found = drift.drift(drift.fields_seen(rows, day="day", payload="payload"), declared)
    return found.where("change <> 'absent'")


# --- sinks and registration --------------------------------------------------------------


@check(
    "silver_table_roundtrip",
    f"WITH {WEBHOOKS_SQL} SELECT {SILVER_SELECT_SQL} FROM w WHERE {VALID_WEBHOOK_SQL}",
)
def _silver_table_roundtrip(spark, sf):
    path = staging_path(spark, "silver")
    silver = silver_bookings.bookings(views.bronze_bookings(spark, sf), views.CHANNELS)
    sinks.write_table(silver, path, partition_by=[silver_bookings.PARTITION], fmt="parquet")
    return readers.read_table(spark, path, "parquet").select(SILVER_FIELDS)


@check("replaced_partitions", BOOKING_TABLES_SQL["daily_calls_by_source"])
def _replaced_partitions(spark, sf):
    """Dates written wrongly are replaced; the others stay."""
    path = staging_path(spark, "gold")
    calls = gold_bookings.daily_calls_by_source(views.bookings(spark, sf))
    late = F.day("booking_date") > 15
    wrong = F.when(late, -1).otherwise(F.col("booked_call_count")).cast("long")
    first = calls.withColumn("booked_call_count", wrong)
    sinks.write_table(first, path, partition_by=["booking_date"], fmt="parquet")
    sinks.write_table(
        calls.where(late), path, mode="replace_partitions", partition_by=["booking_date"], fmt="parquet"
    )
    return readers.read_table(spark, path, "parquet").select(calls.columns)


@check("json_export", COMBINED_TABLES_SQL["daily_cpb_by_channel"])
def _json_export(spark, sf):
    path = staging_path(spark, "export")
    daily = gold_combined.daily_cpb_by_channel(*_inputs(spark, sf))
    sinks.export_json(daily, path)
    return spark.read.schema(daily.schema).json(path)


@check("registered_table", BOOKING_TABLES_SQL["daily_calls_by_source"])
def _registered_table(spark, sf):
    path = staging_path(spark, "registered")
    calls = gold_bookings.daily_calls_by_source(views.bookings(spark, sf))
    sinks.write_table(calls, path, partition_by=["booking_date"], fmt="parquet")
    sinks.register_table(spark, "checked_daily_calls", path, "parquet")
    return spark.sql("SELECT booking_date, channel, booked_call_count FROM checked_daily_calls")


# --- channels that change -----------------------------------------------------------------


def _named_events(spark: SparkSession, sf: str, few: int) -> DataFrame:
    """Events by the name their type had on their day. Every type changes its name after four
    days; one has none for a while, and one loses it in the end."""
    events = views.table(spark, sf, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    first = events.groupBy("event_type").agg(F.min("day").alias("first"))

    def entry(name: str, begins: int, ends=None):
        until = F.date_add("first", ends) if ends is not None else F.lit(None).cast("date")
        named = F.concat("event_type", F.lit(name)).alias("channel")
        return first.select(F.col("event_type").alias("event_type_uri"), named, F.date_add("first", begins).alias("valid_from"), until.alias("valid_to"))

    late = F.col("event_type_uri") == "click"
    history = entry("/old", 0).unionByName(entry("/new", 4, 12).where(~late)).unionByName(entry("/late", 6).where(late))
    named = channel_history.with_channel_at(events, history, at="day", key="event_type", few=few)
    return named.groupBy("day", "channel").agg(F.count("*").alias("events"))


NAMED_EVENTS_SQL = """WITH e AS (SELECT event_type AS t, CAST(ts AS DATE) AS day, MIN(CAST(ts AS DATE)) OVER (PARTITION BY event_type) AS first FROM events)
  SELECT day, CASE WHEN t = 'click' THEN CASE WHEN day < first + 6 THEN t || '/old' ELSE t || '/late' END
      WHEN day < first + 4 THEN t || '/old' WHEN day < first + 12 THEN t || '/new' END AS channel, COUNT(*) AS events
  FROM e GROUP BY ALL"""

check("channel_as_of", NAMED_EVENTS_SQL)(lambda spark, sf: _named_events(spark, sf, channel_history.FEW))
check("channel_as_of_sorted", NAMED_EVENTS_SQL)(lambda spark, sf: _named_events(spark, sf, 0))


# --- bitmaps ----------------------------------------------------------------------------


def _bitmaps(spark: SparkSession, sf: str) -> str:
    """Bookings taken into bitmaps in three deliveries: a part, all but a part (most of the first
    again, with days that were complete before), and the rest with some of either."""
    root = staging_path(spark, "bitmaps")
    booked = views.bookings(spark, sf)
    part = F.pmod(F.xxhash64("booking_id"), F.lit(10))
    for delivery in (booked.where(part < 4), booked.where(part != 7), booked.where(part.isin(1, 7))):
        with bitmaps.added_bookings(delivery, root):
            pass
    return root


for _name in BOOKING_TABLES_SQL:
    if _name in ("daily_calls_by_source", "channel_attribution", "employee_meeting_load", "booking_dashboard_kpis"):

        @check(f"bitmap_{_name}", BOOKING_TABLES_SQL[_name])
        def _from_bitmaps(spark, sf, name=_name):
            cube = bitmaps.cube_of(bitmaps.kept_bitmaps(spark, _bitmaps(spark, sf)))
            return gold_bookings.tables_from_cube(cube)[name]


# --- reports --------------------------------------------------------------------------


def _gold(spark: SparkSession, sf: str, name: str) -> DataFrame:
    if name in COMBINED_TABLES_SQL:
        return gold_combined.combined_tables(*_inputs(spark, sf))[name]
    return gold_bookings.booking_tables(views.bookings(spark, sf))[name]


def _report_sql(name: str) -> str:
    """The table, with the place of each row in the order of its report."""
    sql = (COMBINED_TABLES_SQL | BOOKING_TABLES_SQL)[name]
    if name not in reports.ORDERINGS:
        return sql
    order = [f"{key} {'DESC' if down else 'ASC'} NULLS LAST" for key, down in reports.ORDERINGS[name]]
    return f"SELECT *, RANK() OVER (ORDER BY {', '.join(order)}) AS place FROM ({sql})"


def _report(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The report with the places of its rows, equal keys sharing the first."""
    return reports.report_with_places(_gold(spark, sf, name), name)


for _name in reports.COLUMNS:
    check(f"report_{_name}", _report_sql(_name))(lambda spark, sf, name=_name: _report(spark, sf, name))


@check(
    "first_by_keys",
    f"SELECT * FROM ({BOOKING_TABLES_SQL['daily_calls_by_source']}) ORDER BY booking_date, channel LIMIT 25",
)
def _first_by_keys(spark, sf):
    """The head of a table in key order."""
    return reports.by_keys(_gold(spark, sf, "daily_calls_by_source"), "booking_date", "channel").limit(25)


@check(
    "calls_pivot",
    f"""WITH {BOOKINGS_SQL} SELECT booking_date,
      COUNT(DISTINCT booking_id) FILTER (WHERE channel = 'paid_social') AS "Paid Social",
      COUNT(DISTINCT booking_id) FILTER (WHERE channel = 'paid_video') AS paid_video,
      COUNT(DISTINCT booking_id) FILTER (WHERE channel = 'paid_search') AS paid_search
      FROM b GROUP BY booking_date""",
)
def _calls_pivot(spark, sf):
    return reports.calls_pivot(
        _gold(spark, sf, "daily_calls_by_source"),
        ["paid_social", "paid_video", "paid_search"],
        {"paid_social": "Paid Social"},
    )


@check(
    "cpb_pivot",
    f"""WITH d AS ({COMBINED_TABLES_SQL["daily_cpb_by_channel"]})
      SELECT metric_date, AVG(cost_per_booking_usd) FILTER (WHERE channel = 'paid_social') AS paid_social,
        AVG(cost_per_booking_usd) FILTER (WHERE channel = 'paid_video') AS paid_video,
        AVG(cost_per_booking_usd) FILTER (WHERE channel = 'paid_search') AS paid_search
      FROM d WHERE cost_per_booking_usd IS NOT NULL GROUP BY metric_date""",
)
def _cpb_pivot(spark, sf):
    daily = _gold(spark, sf, "daily_cpb_by_channel")
    return reports.cpb_pivot(daily, ["paid_social", "paid_video", "paid_search"])


@check(
    "priced_rows",
    f"SELECT * FROM ({COMBINED_TABLES_SQL['daily_cpb_by_channel']}) WHERE cost_per_booking_usd IS NOT NULL",
)
def _priced_rows(spark, sf):
    return reports.priced_rows(_gold(spark, sf, "daily_cpb_by_channel"))


@check(
    "chart_titles",
    f"""SELECT channel AS "Channel", total_spend_usd AS "Total Spend", booked_call_count AS "Booked Calls",
      cost_per_booking_usd AS "Cost per Booking" FROM ({COMBINED_TABLES_SQL["cpb_by_channel"]})""",
)
def _chart_titles(spark, sf):
    return reports.with_chart_titles(_gold(spark, sf, "cpb_by_channel"))


# --- streams --------------------------------------------------------------------------


def _run(*queries) -> None:
    for query in queries:
        query.awaitTermination()


def _twice_on_disk(spark: SparkSession, sf: str) -> str:
    """The bronze events with every one delivered twice, packed: as plain lines they would be most
    of what the streams' queries write."""
    return views.bronze_bookings_on_disk(spark, sf, times=2, packed=True)


@check(
    "stream_bronze_intake",
    f"""WITH {REQUESTS_SQL} SELECT booking_id, channel, '{INTAKE_AT}' AS ingestion_timestamp
      FROM q WHERE broken IS NULL AND webhook_event = 'invitee.created'""",
)
def _stream_bronze_intake(spark, sf):
    source, target = staging_path(spark, "requests"), staging_path(spark, "bronze")
    views.webhook_requests(spark, sf).select("body", "isBase64Encoded").write.json(source)
    _run(
        *streams.intake_stream(
            spark, source, target, staging_path(spark, "stream"),
            rejects=staging_path(spark, "rejects"), channels=views.CHANNELS, ingested_at=INTAKE_AT,
        )
    )
    read = readers.read_bronze_bookings(spark, target, layout="lines")
    return read.select("booking_id", "channel", "ingestion_timestamp")


@check("silver_stream", SILVER_SQL)
def _silver_stream(spark, sf):
    target = staging_path(spark, "silver")
    bronze = views.bronze_bookings_on_disk(spark, sf)
    _run(
        streams.silver_stream(
            spark, bronze, target, staging_path(spark, "stream"),
            channels=views.CHANNELS, fmt="parquet",
        )
    )
    return readers.read_table(spark, target, "parquet").select(SILVER_FIELDS)


@check("silver_stream_dedup", SILVER_SQL)
def _silver_stream_dedup(spark, sf):
    target = staging_path(spark, "silver")
    _run(
        streams.silver_stream(
            spark, _twice_on_disk(spark, sf), target, staging_path(spark, "stream"),
            channels=views.CHANNELS, fmt="parquet", once_within="90 days",
        )
    )
    return readers.read_table(spark, target, "parquet").select(SILVER_FIELDS)


WEBHOOK_DAILY_SQL = f"""WITH {WEBHOOKS_SQL} SELECT booking_date, channel,
  COUNT(DISTINCT booking_id) AS booked_call_count FROM w WHERE {VALID_WEBHOOK_SQL} GROUP BY ALL"""


@check("stream_gold_refresh", WEBHOOK_DAILY_SQL)
def _stream_gold_refresh(spark, sf):
    facts, gold = staging_path(spark, "facts"), staging_path(spark, "gold")
    _run(
        streams.gold_refresh_stream(
            spark, _twice_on_disk(spark, sf), facts, gold, staging_path(spark, "stream"),
            channels=views.CHANNELS, fmt="parquet",
        )
    )
    calls = readers.read_table(spark, f"{gold}/daily_calls_by_source", "parquet")
    return calls.select("booking_date", "channel", "booked_call_count")


@check(
    "stream_daily_counts",
    f"""WITH {WEBHOOKS_SQL}, v AS (SELECT * FROM w WHERE {VALID_WEBHOOK_SQL})
      SELECT booking_date, channel, COUNT(*) AS booked_call_count FROM v
      WHERE booking_date + INTERVAL 2 DAY <= (SELECT MAX(ts) FROM v) GROUP BY ALL""",
)
def _stream_daily_counts(spark, sf):
    target = staging_path(spark, "days")
    _run(
        streams.closed_days_stream(
            spark, _twice_on_disk(spark, sf), target, staging_path(spark, "stream"),
            channels=views.CHANNELS, fmt="parquet", lateness="1 day",
        )
    )
    return readers.read_table(spark, target, "parquet")


SETTLED_SQL = f"""WITH {WEBHOOKS_SQL}, v AS (SELECT * FROM w WHERE {VALID_WEBHOOK_SQL})"""


def _settled(spark: SparkSession, sf: str) -> str:
    """Every event delivered twice, and taken in by several batches."""
    root = staging_path(spark, "settled")
    _run(
        streams.settled_stream(
            spark, _twice_on_disk(spark, sf), root, staging_path(spark, "stream"),
            channels=views.CHANNELS, lateness="1 day", files_per_batch=6,
        )
    )
    return root


@check(
    "settled_days",
    f"""{SETTLED_SQL} SELECT booking_date, channel, COUNT(*) AS booked_call_count FROM v
      WHERE booking_date + INTERVAL 2 DAY <= (SELECT MAX(ts) FROM v) GROUP BY ALL""",
)
def _settled_days(spark, sf):
    return readers.read_table(spark, f"{_settled(spark, sf)}/closed_days", "parquet")


@check(
    "repeated_deliveries",
    f"{SETTLED_SQL} SELECT booking_date, channel, COUNT(*) AS repeated FROM v WHERE ts IS NOT NULL GROUP BY ALL",
)
def _repeated_deliveries(spark, sf):
    reported = readers.read_table(spark, f"{_settled(spark, sf)}/reported", "parquet").where("kind = 'repeated'")
    return reported.groupBy("booking_date", "channel").agg(F.count("*").alias("repeated"))


# --- whole jobs -------------------------------------------------------------------------


def _refreshed(spark: SparkSession, sf: str) -> str:
    """Run the whole sequence over bronze written from ``events``; returns the lakehouse root."""
    root, spend = staging_path(spark, "lake"), staging_path(spark, "bronze-spend")
    views.bronze_spend(spark, sf).write.json(spend)
    jobs.refresh_lakehouse(
        spark, views.bronze_bookings_on_disk(spark, sf), spend, root,
        layout="lines", channels=views.CHANNELS, spend_channels=views.SPEND_CHANNELS, fmt="parquet",
    )
    return root


JOB_SOURCES_SQL = f"""{WEBHOOKS_SQL}, b AS (SELECT * FROM w WHERE {VALID_WEBHOOK_SQL}),
  {SPEND_RECORDS_SQL.replace("ev AS", "ev2 AS").replace("FROM ev)", "FROM ev2)")},
  s AS (SELECT spend_date, channel, CAST(spend_usd AS DECIMAL(18,2)) AS usd FROM x WHERE reasons = '')"""


@check("published_daily_cpb", _cpb_sql("metric_date, channel", JOB_SOURCES_SQL))
def _published_daily_cpb(spark, sf):
    """The sequence published twice, first over a part of the spend, and read by its registered name."""
    root, spend = staging_path(spark, "lake"), staging_path(spark, "bronze-spend")
    records = views.bronze_spend(spark, sf)
    bookings = views.bronze_bookings_on_disk(spark, sf)
    for part in (records.where(F.pmod(F.xxhash64("source_file_name"), F.lit(2)) == 0), records):
        part.write.mode("overwrite").json(spend)
        jobs.refresh_lakehouse(
            spark, bookings, spend, root, mode="publish", database="published_checks",
            channels=views.CHANNELS, spend_channels=views.SPEND_CHANNELS, fmt="parquet",
        )
    return spark.table("published_checks.daily_cpb_by_channel").select(reports.COLUMNS["daily_cpb_by_channel"])


@check(
    "appended_spend",
    f"WITH {SPEND_RECORDS_SQL} SELECT spend_date, channel, spend_usd FROM x WHERE reasons = ''",
)
def _appended_spend(spark, sf):
    """Spend files appended to silver in two runs, each of which is run again with nothing new."""
    target, bronze = staging_path(spark, "silver"), staging_path(spark, "bronze-spend")
    part = F.pmod(F.xxhash64("source_file_name"), F.lit(2))
    for number in (0, 1):
        views.bronze_spend(spark, sf).where(part == number).write.mode("append").json(bronze)
        for _ in range(2):
            jobs.silver_spend_job(spark, bronze, target, mode="append", channels=views.SPEND_CHANNELS, fmt="parquet")
    return readers.read_silver_spend(spark, target, "parquet").select("spend_date", "channel", "spend_usd")


@check(
    "documents_to_silver",
    f"WITH {WEBHOOKS_SQL} SELECT {SILVER_SELECT_SQL} FROM w WHERE {VALID_WEBHOOK_SQL}",
)
def _documents_to_silver(spark, sf):
    """Folders of whole JSON documents, each an array of events, beside files that the glob leaves out."""
    read = readers.read_bronze_bookings(spark, views.documents_on_disk(spark, sf), layout="documents", glob="*.txt.gz")
    return silver_bookings.bookings(read, views.CHANNELS).select(SILVER_FIELDS)


@check(
    "webhook_intake_job",
    f"""WITH {REQUESTS_SQL} SELECT {SILVER_SELECT_SQL} FROM q
      WHERE broken IS NULL AND {VALID_WEBHOOK_SQL}""",
)
def _webhook_intake_job(spark, sf):
    """Logged requests taken in by the job, twice, and read into silver."""
    requests, bronze = views.webhook_requests_on_disk(spark, sf), staging_path(spark, "bronze")
    for _ in range(2):
        jobs.webhook_intake_job(
            spark, requests, bronze, rejects=staging_path(spark, "rejects"), ingested_at=INTAKE_AT, channels=views.CHANNELS
        )
    read = readers.read_bronze_bookings(spark, bronze, layout="lines")
    return silver_bookings.bookings(read, views.CHANNELS).select(SILVER_FIELDS)


@check("refreshed_daily_cpb", _cpb_sql("metric_date, channel", JOB_SOURCES_SQL))
def _refreshed_daily_cpb(spark, sf):
    gold = readers.read_table(spark, f"{_refreshed(spark, sf)}/gold/daily_cpb_by_channel", "parquet")
    return gold.select(reports.COLUMNS["daily_cpb_by_channel"])


def _spend_gold(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """A table as the spend job writes it, from rows that carry its stamp."""
    silver, gold = staging_path(spark, "spend"), staging_path(spark, "gold")
    sinks.write_table(views.spend(spark, sf), silver, partition_by=["spend_date"], fmt="parquet")
    jobs.gold_spend_job(spark, silver, gold, fmt="parquet")
    written = readers.read_table(spark, f"{gold}/{table}", "parquet")
    return written.where(F.col(jobs.GOLD_STAMP).isNotNull()).drop(jobs.GOLD_STAMP)


@check("spend_job_daily", _daily_spend_sql(SPEND_SQL))
def _spend_job_daily(spark, sf):
    return _spend_gold(spark, sf, "daily_spend_by_channel")


@check("spend_job_summary", _summary_sql(SPEND_SQL))
def _spend_job_summary(spark, sf):
    return _spend_gold(spark, sf, "channel_spend_summary")


@check("exported_metrics", ORACLES["campaign_cpb"])
def _exported_metrics(spark, sf):
    spend, booked, root = (staging_path(spark, name) for name in ("spend", "bookings", "metrics"))
    sinks.write_table(views.spend(spark, sf), spend, partition_by=["spend_date"], fmt="parquet")
    sinks.write_table(views.bookings(spark, sf), booked, partition_by=["meeting_date"], fmt="parquet")
    jobs.metrics_job(spark, spend, booked, root, fmt="parquet")
    schema = gold_extra.campaign_cpb(*_inputs(spark, sf)).schema
    return spark.read.schema(schema).json(f"{root}/channel_attribution")


@check(
    "refreshed_row_counts",
    f"""WITH {JOB_SOURCES_SQL}
      SELECT 'silver/bookings' AS target, (SELECT COUNT(*) FROM b) AS row_count
      UNION ALL SELECT 'silver/spend', (SELECT COUNT(*) FROM s)
      UNION ALL SELECT 'rejects/bookings', (SELECT COUNT(*) FROM w) - (SELECT COUNT(*) FROM b)
      UNION ALL SELECT 'rejects/spend', (SELECT COUNT(*) FROM x WHERE reasons <> '')
      UNION ALL SELECT 'gold/booking_trends', (SELECT COUNT(DISTINCT booking_date) FROM b)
      UNION ALL SELECT 'gold/combined_dashboard_kpis', 1""",
)
def _refreshed_row_counts(spark, sf):
    root = _refreshed(spark, sf)
    targets = [
        "silver/bookings", "silver/spend", "rejects/bookings", "rejects/spend",
        "gold/booking_trends", "gold/combined_dashboard_kpis",
    ]
    counts = [
        readers.read_table(spark, f"{root}/{target}", "parquet").agg(
            F.lit(target).alias("target"), F.count("*").alias("row_count")
        )
        for target in targets
    ]
    merged = counts[0]
    for count in counts[1:]:
        merged = merged.unionByName(count)
    return merged
