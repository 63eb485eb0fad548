"""Channels that change: the channel an event type had at the time of the event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of history up to which it is sent to the events, instead of events and history being
#: sorted together. A row is a URI, a channel and two times.
FEW = 20_000
#: Parts that the events of one type are dealt to, each with the type's whole history, so that no
#: task gets all events of a common type.
SALTS = 64

HISTORY = ["event_type_uri", "channel", "valid_from", "valid_to"]


def effective(history: DataFrame) -> DataFrame:
    """The history with at most one entry for any type and time: an entry ends where the next
    one of its type begins, or at its own ``valid_to`` (NULL: never), whichever is earlier. Of entries that
    begin together the one of the greatest channel name counts."""
    known = history.where(F.col("event_type_uri").isNotNull() & F.col("valid_from").isNotNull())
    begins = known.groupBy("event_type_uri", "valid_from").agg(F.max(F.struct("channel", "valid_to")).alias("entry"))
    following = F.lead("valid_from").over(Window.partitionBy("event_type_uri").orderBy("valid_from"))
    until = F.least(F.col("entry.valid_to"), following)
    return begins.select("event_type_uri", F.col("entry.channel").alias("channel"), "valid_from", until.alias("valid_to"))


def with_channel_at(
    events: DataFrame, history: DataFrame, *, at: str, key: str = "event_type_uri", to: str = "channel", few: int = FEW
) -> DataFrame:
    """The events with the column ``to``: the channel that the type ``key`` had at the time ``at``,
    from ``valid_from`` on and before ``valid_to``; NULL where it had none then, or type or time
    is NULL. ``at`` and the times of the history have one type.

    The history is counted first: a small one is broadcast, a large one sorted with the events.
    """
    names = [name for name in events.columns if name != to]
    rows = events.select(F.struct(*(F.col(name) for name in names)).alias("event"), F.col(key).alias("of"), F.col(at).alias("at"))
    entries = effective(history)
    if history.limit(few + 1).count() <= few:
        found = _broadcast(rows, entries)
    else:
        found = _sorted(rows, entries)
    return found.select(*(F.col("event")[name].alias(name) for name in names), F.col("found").alias(to))


def _broadcast(rows: DataFrame, entries: DataFrame) -> DataFrame:
    holds = (F.col("at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to")))
    same = F.col("of") == F.col("event_type_uri")
    return rows.join(F.broadcast(entries), same & holds, "left").select("event", F.col("channel").alias("found"))


def _sorted(rows: DataFrame, entries: DataFrame) -> DataFrame:
    dealt = F.pmod(F.xxhash64("event"), F.lit(SALTS)).cast("int")
    asked = rows.select("of", "at", dealt.alias("salt"), F.lit(1).alias("later"), "event", F.lit(None).cast("string").alias("channel"))
    asked = asked.withColumn("until", F.lit(None).cast(rows.schema["at"].dataType))
    known = entries.select(
        F.col("event_type_uri").alias("of"), F.col("valid_from").alias("at"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(0).alias("later"),
        F.lit(None).cast(rows.schema["event"].dataType).alias("event"), "channel", F.col("valid_to").alias("until"),
    )
    order = Window.partitionBy("of", "salt").orderBy("at", "later").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entry = F.when(F.col("later") == 0, F.struct("channel", "until"))
    both = asked.unionByName(known).withColumn("entry", F.last(entry, ignorenulls=True).over(order))
    holds = F.col("of").isNotNull() & F.col("at").isNotNull() & (F.col("entry.until").isNull() | (F.col("at") < F.col("entry.until")))
    return both.where(F.col("later") == 1).select("event", F.when(holds, F.col("entry.channel")).alias("found"))
