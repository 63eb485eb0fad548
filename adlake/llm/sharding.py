"""Sharding by weighted rendezvous hashing.

Each record key draws a number per shard from a hash of both and goes to the shard of the
highest score, ``-weight / ln(u)``. A shard's scores do not depend on the other shards, so one
shard more takes records only into itself, and in proportion to its weight.

Slots within a shard come from counts per (shard, bucket) and a rank within the bucket: no task
holds a whole shard.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlake.llm.common import hash52

SHARDS = 8
#: Hash buckets of a shard, for its slots.
BUCKETS = 2048


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key. Ties, which need equal 52-bit hashes, go to the larger number. A shard
    without positive weight takes nothing."""
    live = {shard: weight for shard, weight in weights.items() if weight > 0}
    if not live:
        raise ValueError("no shard has a positive weight")

    def score(shard: int, weight: float) -> Column:
        u = (hash52(key, F.lit(shard)).cast("double") + 0.5) / float(2**52)
        return F.struct((-weight / F.log(u)).alias("score"), F.lit(shard).alias("shard"))

    draws = [score(shard, weight) for shard, weight in live.items()]
    return (F.greatest(*draws) if len(draws) > 1 else draws[0])["shard"]


def equal_weights(shards: int) -> dict[int, float]:
    return dict.fromkeys(range(shards), 1.0)


def shard_slots(rows: DataFrame, shard: str, identity: Sequence[str], *, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``slot``: gapless from 0 within each shard, in order of a hash bucket, then identity.
    Rows equal in identity are interchangeable."""
    spread = hash52(*(F.col(name) for name in identity))
    keyed = rows.withColumn("_bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
    earlier = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(shard, "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(shard, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy(shard, "_bucket").orderBy(*identity)
    ranked = keyed.withColumn("_rank", F.row_number().over(within))
    slot = (F.col("_before") + F.col("_rank") - 1).cast("long")
    return ranked.join(offsets, [shard, "_bucket"]).select(*rows.columns, slot.alias("slot"))


def shard_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    weights: Mapping[int, float] | None = None,
    grown: Mapping[int, float] | None = None,
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, grown_shard.

    ``weights`` are those of the shards, ``grown`` those after a change (by default eight equal
    shards, and one more). Size is that of the text in UTF-8, plus 1.

    Defined cases: a NULL text is an empty one; rows without an id share a key and so a shard;
    repeated rows go to one shard under slots of their own; an empty table gives an empty result;
    other columns are ignored.
    """
    weights = weights or equal_weights(SHARDS)
    grown = grown or weights | {max(weights) + 1: 1.0}
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = rows.select(
        "*",
        rendezvous(F.col("doc_id"), weights).cast("int").alias("shard"),
        rendezvous(F.col("doc_id"), grown).cast("int").alias("grown_shard"),
    )
    return shard_slots(placed, "shard", ["doc_id", "text_crc32", "size"])
