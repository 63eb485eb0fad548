"""The jobs a user submits: intake to bronze, bronze to silver, silver to gold, and the sequence.

A silver job that keeps rejects, or is strict, parses its input once: the checked rows are staged
in the shared folder, and good rows, rejects and the strict check read them there. The gold jobs
read theirs once as well: they compute one small cube of all grains, stage it, and cut the tables
out of it. A job deletes what it staged when it ends.

Run ``python -m adlake.plans.jobs --help`` for the command line.
"""

from __future__ import annotations

import argparse
import hashlib
import json
from collections.abc import Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.fixed_values import CHANNEL_BY_EVENT_TYPE, SPEND_CHANNELS
from adlake.operators import gold_bookings, gold_combined, gold_spend, silver_bookings, silver_spend
from adlake.operators.gold_extra import metric_inputs, metric_tables
from adlake.operators.grains import heavy_ids
from adlake.operators.quality import BROKEN, REASONS, ROWS, raise_on_counts, rejected_rows, valid_rows, watched
from adlake.session import build_session, staged
from adlake.sources.intake import (
    BOOKING_ENVELOPE,
    BOOKING_PARTITIONS,
    SPEND_PARTITIONS,
    read_requests,
    spend_intake,
    webhook_intake,
)
from adlake.sources.manifest import manifest_names, read_manifests, require_names, select_names
from adlake.sources.readers import (
    read_bronze_bookings,
    read_bronze_spend,
    read_silver_bookings,
    read_silver_spend,
)
from adlake.sources.sinks import export_json, pending_table, register_table, stamped, write_bronze, write_table
from adlake.sources.versions import (
    INPUT_FILES,
    Pending,
    append,
    current,
    fingerprint,
    is_written_in_place,
    marks,
    new_inputs,
    run_folder,
    taken_in,
    write_run,
)

SILVER_STAMP = "silver_processed_at"
GOLD_STAMP = "gold_processed_at"
REJECT_PARTITION = "ingest_date"


@dataclass(frozen=True)
class Written:
    """A table that a job writes."""

    df: DataFrame
    path: str
    mode: str
    partition_by: Sequence[str]
    fmt: str | None


#: Tables of a job that are written at a time.
WRITERS = 4
#: Mark of a published table: what it was made of.
MADE_OF = "made of"


class Progress:
    """Which steps of a sequence are done already: those whose tables are marked with what their
    inputs amount to now. Inputs are told by paths, sizes and times of files, or by runs."""

    def __init__(self, spark: SparkSession, resume: bool):
        self.spark, self.resume = spark, resume

    def of(self, inputs: Collection[str], **parameters) -> str | None:
        """The fingerprint of a step; None where steps are not to be skipped."""
        if not self.resume:
            return None
        found = {path: fingerprint(self.spark, path) for path in inputs}
        return hashlib.sha256(json.dumps([found, parameters], sort_keys=True, default=str).encode()).hexdigest()

    def done(self, made_of: str | None, targets: Collection[str]) -> bool:
        return made_of is not None and all(marks(self.spark, path).get(MADE_OF) == made_of for path in targets)


def _write_all(spark: SparkSession, tables: list[Written], made_of: str | None = None) -> None:
    """Write a job's tables. In the publishing modes all are written first and then committed one
    right after the other, so that a job which dies while writing has changed none of them."""
    published = [table for table in tables if table.mode.startswith("publish")]

    def write(table: Written) -> Pending:
        return pending_table(
            table.df, table.path, mode=table.mode, partition_by=table.partition_by, fmt=table.fmt,
            noted={MADE_OF: made_of} if made_of else None,
        )

    for table in tables:
        if not table.mode.startswith("publish"):
            write_table(table.df, table.path, mode=table.mode, partition_by=table.partition_by, fmt=table.fmt)
    # side by side, as none of them needs another and a small one leaves most cores idle
    with ThreadPoolExecutor(max_workers=WRITERS) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(write), table) for table in published]
    pending = [table.result() for table in running]
    for version in pending:
        version.commit()


def _dated_rejects(bad: DataFrame) -> DataFrame:
    """Rejects carry no reliable date of their own, so they are laid out by that of their intake,
    and a day taken in again replaces its own rejects only."""
    day = F.coalesce(F.left("bronze_ingestion_timestamp", F.lit(10)), F.lit("unknown"))
    return bad.withColumn(REJECT_PARTITION, day)


def _publish_silver(
    checked: DataFrame, reasons, accepted, partition: str, target: str, rejects: str | None, *, mode, strict, fmt, made_of=None
) -> dict[str, int]:
    """Write good rows and, where wanted, rejects; returns what ``watched`` counts on the way.

    Without rejects, a published table needs no second look at its rows: in strict mode the version
    that is written is not committed if one of them broke a rule.
    """
    spark = checked.sparkSession
    seen, counts = watched(checked, reasons)
    if mode == "publish" and not rejects:
        noted = {MADE_OF: made_of} if made_of else None
        silver = stamped(accepted(seen), SILVER_STAMP)
        version = pending_table(silver, target, mode=mode, partition_by=[partition], fmt=fmt, noted=noted)
        if strict:
            raise_on_counts(counts.get)
        version.commit()
        return dict(counts.get)
    with staged(seen) if strict or rejects else nullcontext(seen) as rows:
        if strict:
            raise_on_counts(counts.get)
        silver = stamped(accepted(rows), SILVER_STAMP)
        tables = [Written(silver, target, mode, [partition], fmt)]
        if rejects:
            bad = stamped(rejected_rows(rows), SILVER_STAMP)
            if mode.endswith("partitions"):
                tables.append(Written(_dated_rejects(bad), rejects, mode, [REJECT_PARTITION], fmt))
            else:
                tables.append(Written(bad, rejects, mode, [], fmt))
        _write_all(spark, tables, made_of)
        return dict(counts.get)


def _append_silver(
    spark, read, check, reasons, accepted, partition, source, target, rejects, *, strict, fmt
) -> dict[str, int]:
    """Add what the files under ``source`` hold that the table has not taken in yet. Which files
    those are is committed with their rows: run again, or after dying anywhere, the job adds
    nothing twice and leaves nothing out."""
    if is_written_in_place(spark, target):
        raise ValueError(f"{target} was written in place and has no record of its input files: publish it first")
    with staged(new_inputs(spark, source, target)) as inputs:
        # file names only: as many as the planner lists for any scan of them
        paths = [row["path"] for row in inputs.select("path").collect()]
        if not paths:
            return {ROWS: 0, BROKEN: 0}
        seen, counts = watched(check(read(paths)), reasons)
        with staged(seen) if rejects else nullcontext(seen) as rows:
            if rejects:
                if strict:
                    raise_on_counts(counts.get)
                _append_rejects(spark, stamped(rejected_rows(rows), SILVER_STAMP), inputs, target, rejects, fmt)
            more = append(stamped(accepted(rows), SILVER_STAMP), target, inputs=inputs, partition_by=[partition], fmt=fmt)
            if strict:
                raise_on_counts(counts.get)
            more.commit()
        return dict(counts.get)


def _append_rejects(spark, bad: DataFrame, inputs: DataFrame, target: str, rejects: str, fmt: str | None) -> None:
    """Rejects are committed first. Those of files that the table itself has not taken in are left
    from a job that died in between, and give way to the new ones."""
    known, now = taken_in(spark, target), current(spark, rejects)
    onto = []
    for run in now.runs if now else ():
        of_run = spark.read.parquet(f"{run_folder(rejects, run)}/_inputs")
        if known is not None and of_run.join(known, INPUT_FILES, "left_anti").isEmpty():
            onto.append(run)
    write_run(bad, rejects, onto=onto, fmt=fmt, inputs=inputs).commit()


def webhook_intake_job(
    spark: SparkSession,
    requests: str,
    target: str,
    *,
    rejects: str | None = None,
    ingested_at: str | None = None,
    channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    packed: bool = True,
) -> None:
    """Logged webhook requests to bronze. Rejects, keyed alike, go to a folder of their own.

    Both are files of gzip unless ``packed`` is turned off. Only rejects are staged with their body:
    that of a good row would be its event once more."""
    received = webhook_intake(read_requests(spark, requests), ingested_at=ingested_at, channels=channels)
    with staged(received.withColumn("body", F.when(F.size(REASONS) > 0, F.col("body")))) as rows:
        good = valid_rows(rows).select(*BOOKING_ENVELOPE, *BOOKING_PARTITIONS)
        write_bronze(good, target, BOOKING_PARTITIONS, repeatable=True, packed=packed)
        if rejects:
            # rejects may name any event type, each a folder
            bad = rejected_rows(rows).drop("raw_event")
            write_bronze(bad, rejects, BOOKING_PARTITIONS, rebalance=True, repeatable=True, packed=packed)


def spend_intake_job(
    spark: SparkSession,
    files: str,
    target: str,
    *,
    manifests: str | None = None,
    file_names: Collection[str] | None = None,
    newest: int | None = None,
    cap: int | None = None,
    counts: str | None = None,
    ingested_at: str | None = None,
    source_base_url: str | None = None,
) -> None:
    """Spend files to bronze: all under ``files``, or those that the manifests list and the
    selection leaves. ``counts`` receives the number of records per file, NULL for a file that
    holds no array, which is kept in bronze all the same and rejected by the silver job."""
    chosen: DataFrame | Collection[str] | None = file_names
    if manifests:
        listed = require_names(manifest_names(read_manifests(spark, manifests)))
        chosen = select_names(listed, file_names=file_names, newest=newest, cap=cap)
    elif newest is not None or cap is not None:
        raise ValueError("newest and cap select among the names of a manifest")
    taken = spend_intake(
        spark, files, file_names=chosen, ingested_at=ingested_at, source_base_url=source_base_url
    )
    with staged(taken) as rows:
        write_bronze(rows.drop("record_count"), target, SPEND_PARTITIONS, repeatable=True)
        if counts:
            per_file = rows.groupBy("raw_s3_key", "source_file_name", *SPEND_PARTITIONS).agg(
                F.sum("record_count").alias("record_count")
            )
            write_bronze(per_file, counts, SPEND_PARTITIONS)


def silver_bookings_job(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    rejects: str | None = None,
    mode: str = "overwrite",
    strict: bool = False,
    layout: str = "lines",
    channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    fmt: str | None = None,
    made_of: str | None = None,
) -> dict[str, int]:
    """Bronze events to silver. ``append`` adds the events of files not taken in yet; the other
    modes make the table, or its partitions, from all of ``source``. Returns the number of rows
    read, of those that break a rule, and per reason, counted as the rows are written."""
    reasons = [rule.reason for rule in silver_bookings.rules()]
    if mode == "append":
        return _append_silver(
            spark,
            lambda paths: read_bronze_bookings(spark, paths, layout=layout),
            lambda bronze: silver_bookings.checked_bookings(bronze, channels),
            reasons, silver_bookings.accepted, silver_bookings.PARTITION, source, target, rejects, strict=strict, fmt=fmt,
        )
    bronze = read_bronze_bookings(spark, source, layout=layout)
    return _publish_silver(
        silver_bookings.checked_bookings(bronze, channels),
        reasons,
        silver_bookings.accepted,
        silver_bookings.PARTITION,
        target,
        rejects,
        mode=mode,
        strict=strict,
        fmt=fmt,
        made_of=made_of,
    )


def silver_spend_job(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    rejects: str | None = None,
    mode: str = "overwrite",
    strict: bool = False,
    layout: str = "lines",
    channels: Collection[str] = SPEND_CHANNELS,
    fmt: str | None = None,
    made_of: str | None = None,
) -> dict[str, int]:
    """Spend files to silver, as ``silver_bookings_job`` does."""
    reasons = [rule.reason for rule in silver_spend.rules(channels)]
    if mode == "append":
        return _append_silver(
            spark,
            lambda paths: read_bronze_spend(spark, paths, layout=layout),
            lambda bronze: silver_spend.checked_spend(bronze, channels),
            reasons, silver_spend.accepted, silver_spend.PARTITION, source, target, rejects, strict=strict, fmt=fmt,
        )
    bronze = read_bronze_spend(spark, source, layout=layout)
    return _publish_silver(
        silver_spend.checked_spend(bronze, channels),
        reasons,
        silver_spend.accepted,
        silver_spend.PARTITION,
        target,
        rejects,
        mode=mode,
        strict=strict,
        fmt=fmt,
        made_of=made_of,
    )


def _write_gold(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    partitions: Mapping[str, list[str]],
    mode: str,
    fmt: str | None,
    paths: Mapping[str, str] | None,
    made_of: str | None = None,
) -> None:
    # a table without partitions is replaced whole
    whole = {"replace_partitions": "overwrite", "publish_partitions": "publish"}
    # the gold tables are made from all of silver, so an append of them would repeat every row
    mode = "publish" if mode == "append" else mode
    _write_all(
        spark,
        [
            Written(
                stamped(table, GOLD_STAMP),
                (paths or {}).get(name, f"{root}/{name}"),
                mode if name in partitions else whole.get(mode, mode),
                partitions.get(name, ()),
                fmt,
            )
            for name, table in tables.items()
        ],
        made_of,
    )


def gold_bookings_job(
    spark: SparkSession,
    silver: str,
    root: str,
    *,
    mode: str = "overwrite",
    fmt: str | None = None,
    paths: Mapping[str, str] | None = None,
    made_of: str | None = None,
) -> None:
    """Six booking tables under ``root`` (or at ``paths`` by table name)."""
    rows = read_silver_bookings(spark, silver, fmt)
    with staged(gold_bookings.booking_cube(rows, heavy_ids(rows, "booking_id"))) as cube:
        tables = gold_bookings.tables_from_cube(cube)
        _write_gold(spark, tables, root, gold_bookings.PARTITIONS, mode, fmt, paths, made_of)


def gold_spend_job(
    spark: SparkSession,
    silver: str,
    root: str,
    *,
    mode: str = "overwrite",
    fmt: str | None = None,
    paths: Mapping[str, str] | None = None,
    made_of: str | None = None,
) -> None:
    with staged(gold_spend.daily_totals(read_silver_spend(spark, silver, fmt))) as totals:
        tables = gold_spend.tables_from_totals(totals)
        _write_gold(spark, tables, root, gold_spend.PARTITIONS, mode, fmt, paths, made_of)


def gold_combined_job(
    spark: SparkSession,
    silver_spend_path: str,
    silver_bookings_path: str,
    root: str,
    *,
    mode: str = "overwrite",
    fmt: str | None = None,
    paths: Mapping[str, str] | None = None,
    made_of: str | None = None,
) -> None:
    spend = read_silver_spend(spark, silver_spend_path, fmt)
    bookings = read_silver_bookings(spark, silver_bookings_path, fmt)
    with staged(gold_combined.combined_cube(spend, bookings, heavy_ids(bookings, "booking_id"))) as cube:
        tables = gold_combined.tables_from_cube(cube)
        _write_gold(spark, tables, root, gold_combined.PARTITIONS, mode, fmt, paths, made_of)


def metrics_job(
    spark: SparkSession,
    silver_spend_path: str,
    silver_bookings_path: str,
    root: str,
    *,
    fmt: str | None = None,
) -> None:
    """The metrics bundle as JSON, one folder per metric under ``root``. Silver is scanned once."""
    with metric_inputs(
        read_silver_spend(spark, silver_spend_path, fmt), read_silver_bookings(spark, silver_bookings_path, fmt)
    ) as inputs:
        for name, table in metric_tables(*inputs).items():
            export_json(table, f"{root}/{name}")


BOOKING_TABLES = [*gold_bookings.GRAINS, "booking_dashboard_kpis"]
SPEND_TABLES = ["daily_spend_by_channel", "channel_spend_summary"]
COMBINED_TABLES = ["cpb_by_channel", "daily_cpb_by_channel", "combined_dashboard_kpis"]
GOLD_TABLES = [*BOOKING_TABLES, *SPEND_TABLES, *COMBINED_TABLES]


def register_gold(
    spark: SparkSession, root: str, *, database: str = "default", fmt: str | None = None
) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in GOLD_TABLES:
        register_table(spark, f"{database}.{name}", f"{root}/{name}", fmt)


def refresh_lakehouse(
    spark: SparkSession,
    bronze_bookings: str,
    bronze_spend: str,
    root: str,
    *,
    mode: str = "overwrite",
    strict: bool = False,
    layout: str = "lines",
    channels: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    spend_channels: Collection[str] = SPEND_CHANNELS,
    database: str | None = None,
    fmt: str | None = None,
    resume: bool = False,
) -> None:
    """Everything: both silver tables, their rejects, all gold tables, and, when a database is
    named, their registration. Spend and bookings need nothing of each other until they are
    combined, so their jobs run side by side.

    With ``publish`` a reader never sees a table half written: silver is committed per job, the
    gold tables of a job together, and names move to the new versions at the end. ``resume`` then
    leaves out the steps whose tables were made of what their inputs are now: a sequence that died
    goes on where it was, and a changed file repeats only what depends on it."""
    if resume and mode != "publish":
        raise ValueError("only published tables know what they were made of: resume needs mode publish")
    bookings, spend = f"{root}/silver/bookings", f"{root}/silver/spend"
    gold = f"{root}/gold"
    common = {"mode": mode, "strict": strict, "layout": layout, "fmt": fmt}
    progress = Progress(spark, resume)

    def silver_step(job, source: str, target: str, rejects: str, known) -> None:
        made_of = progress.of([source], step=job.__name__, known=known, strict=strict, layout=layout, fmt=fmt)
        if not progress.done(made_of, [target, rejects]):
            job(spark, source, target, rejects=rejects, channels=known, made_of=made_of, **common)

    def gold_step(job, inputs: list[str], names: Collection[str]) -> None:
        made_of = progress.of(inputs, step=job.__name__, fmt=fmt)
        if not progress.done(made_of, [f"{gold}/{name}" for name in names]):
            job(spark, *inputs, gold, mode=mode, fmt=fmt, made_of=made_of)

    def spend_branch() -> None:
        silver_step(silver_spend_job, bronze_spend, spend, f"{root}/rejects/spend", spend_channels)
        gold_step(gold_spend_job, [spend], SPEND_TABLES)

    def booking_branch() -> None:
        silver_step(silver_bookings_job, bronze_bookings, bookings, f"{root}/rejects/bookings", channels)
        gold_step(gold_bookings_job, [bookings], BOOKING_TABLES)

    with ThreadPoolExecutor(max_workers=2) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(branch)) for branch in (spend_branch, booking_branch)]
    for branch in running:
        branch.result()
    gold_step(gold_combined_job, [spend, bookings], COMBINED_TABLES)
    if database:
        register_gold(spark, gold, database=database, fmt=fmt)


def _parser() -> argparse.ArgumentParser:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--mode", default="overwrite", help="overwrite or replace_partitions in place; publish or publish_partitions, "
                        "seen at once when complete; append, of files not taken in yet")
    shared.add_argument("--format", dest="fmt", help="table format; delta when enabled, else parquet")
    shared.add_argument("--delta", action="store_true", help="build the session with Delta")
    shared.add_argument("--shuffle-partitions", type=int)
    to_silver = argparse.ArgumentParser(add_help=False)
    to_silver.add_argument("--source", required=True)
    to_silver.add_argument("--target", required=True)
    to_silver.add_argument("--rejects")
    intake = argparse.ArgumentParser(add_help=False)
    intake.add_argument("--strict", action="store_true", help="fail on the first invalid row")
    intake.add_argument("--layout", default="lines", help="lines, as our own intake writes, or documents")
    intake.add_argument("--channels", help="JSON object of event type URI to channel")

    session = argparse.ArgumentParser(add_help=False)
    session.add_argument("--shuffle-partitions", type=int)
    session.add_argument("--ingested-at", help="ISO timestamp; the time of the run when left out")
    session.add_argument("--target", required=True)

    parser = argparse.ArgumentParser(prog="adlake")
    jobs = parser.add_subparsers(dest="job", required=True)
    webhooks = jobs.add_parser("intake-webhooks", parents=[session])
    webhooks.add_argument("--requests", required=True)
    webhooks.add_argument("--rejects")
    webhooks.add_argument("--channels", help="JSON object of event type URI to channel")
    files = jobs.add_parser("intake-spend", parents=[session])
    files.add_argument("--files", required=True)
    files.add_argument("--manifests", help="JSON manifests that list the files to take in")
    files.add_argument("--file-name", action="append", dest="file_names")
    files.add_argument("--newest", type=int)
    files.add_argument("--cap", type=int)
    files.add_argument("--counts", help="where the number of records per file goes")
    files.add_argument("--source-base-url")
    jobs.add_parser("silver-bookings", parents=[shared, to_silver, intake])
    jobs.add_parser("silver-spend", parents=[shared, to_silver, intake])
    for name in ("gold-bookings", "gold-spend"):
        gold = jobs.add_parser(name, parents=[shared])
        gold.add_argument("--silver", required=True)
        gold.add_argument("--root", required=True)
    for name in ("gold-combined", "metrics"):
        combined = jobs.add_parser(name, parents=[shared])
        combined.add_argument("--silver-spend", required=True)
        combined.add_argument("--silver-bookings", required=True)
        combined.add_argument("--root", required=True)
    everything = jobs.add_parser("refresh", parents=[shared, intake])
    everything.add_argument("--bronze-bookings", required=True)
    everything.add_argument("--bronze-spend", required=True)
    everything.add_argument("--root", required=True)
    everything.add_argument("--database")
    everything.add_argument("--resume", action="store_true", help="with publish: leave out steps that are done")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(
        f"adlake {args.job}", delta=getattr(args, "delta", False), shuffle_partitions=args.shuffle_partitions
    )
    given = json.loads(args.channels) if getattr(args, "channels", None) else None
    by_type = given or CHANNEL_BY_EVENT_TYPE
    if args.job == "intake-webhooks":
        webhook_intake_job(
            spark, args.requests, args.target,
            rejects=args.rejects, ingested_at=args.ingested_at, channels=by_type,
        )
        return
    if args.job == "intake-spend":
        spend_intake_job(
            spark, args.files, args.target, manifests=args.manifests, file_names=args.file_names,
            newest=args.newest, cap=args.cap, counts=args.counts,
            ingested_at=args.ingested_at, source_base_url=args.source_base_url,
        )
        return
    table = {"mode": args.mode, "fmt": args.fmt}
    accepted = tuple(dict.fromkeys(given.values())) if given else SPEND_CHANNELS
    if args.job in ("silver-bookings", "silver-spend"):
        job, known = (
            (silver_bookings_job, by_type)
            if args.job == "silver-bookings"
            else (silver_spend_job, accepted)
        )
        job(
            spark, args.source, args.target, rejects=args.rejects,
            strict=args.strict, layout=args.layout, channels=known, **table,
        )
    elif args.job == "gold-combined":
        gold_combined_job(spark, args.silver_spend, args.silver_bookings, args.root, **table)
    elif args.job == "metrics":
        metrics_job(spark, args.silver_spend, args.silver_bookings, args.root, fmt=args.fmt)
    elif args.job == "refresh":
        refresh_lakehouse(
            spark, args.bronze_bookings, args.bronze_spend, args.root,
            strict=args.strict, layout=args.layout, channels=by_type,
            spend_channels=accepted, database=args.database, resume=args.resume, **table,
        )
    else:
        job = gold_bookings_job if args.job == "gold-bookings" else gold_spend_job
        job(spark, args.silver, args.root, **table)


if __name__ == "__main__":
    main()
