"""Mixing sources to target weights by systematic sampling.

Within a source every document is expected equally often: target over size of the source. The
expected copies are prefix-summed along the documents, one offset drawn per source is added, and
a document is emitted once per integer boundary that its stretch crosses. Documents lie in order
of size class, so that every class is taken in its share.

Ranks within a source come from counts per (source, class, hash bucket), which are few whatever
the number of documents, plus a rank within the bucket. No task holds a whole source. All of this
is on narrow rows: a document's text is read for its size and digest, and once more when it is
taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlake.llm.common import Staging, as_row, hash52, out_of_row, shuffles_dropped, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
#: Hash buckets of a size class. A class with N documents of a source is ranked in groups of
#: about N / BUCKETS rows.
BUCKETS = 1024
SEED = 17
#: Key of the documents without a source, which come last.
NO_SOURCE = ""


def size_class(size: Column) -> Column:
    """0 for an empty document, then eight classes per doubling."""
    return F.when(size <= 0, 0).otherwise(F.floor(F.log2(size.cast("double")) * 8) + 1).cast("int")


def source_targets(
    sizes: DataFrame, *, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """source, source_size, target from one row per document (source, size), none NULL.

    The share of all sizes is dealt by weight; targets stop at ``cap`` times the size of their
    source and the excess goes to the others by weight until none is above. That end is found
    directly: with sources ordered by size over weight, the stopped ones come first, and the
    level of the rest follows from running sums. One row per source is ordered in one task.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source") == NO_SOURCE, "source")
    cycle = F.array(*(F.lit(int(w)) for w in weights))
    weighted = totals.withColumn("weight", F.get(cycle, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))))
    everything = Window.partitionBy()
    stop_order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source") == NO_SOURCE, "source")
    before = stop_order.rowsBetween(Window.unboundedPreceding, -1)
    level = weighted.select(
        "*",
        F.sum("source_size").over(everything).alias("all_size"),
        F.sum("weight").over(everything).alias("all_weight"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("stopped_size"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("stopped_weight"),
    ).select(
        "*",
        # the level if exactly the sources before this one are stopped
        (
            (share * F.col("all_size") - cap * F.col("stopped_size")) / (F.col("all_weight") - F.col("stopped_weight"))
        ).alias("level"),
    )
    free = F.col("level") * F.col("weight") <= cap * F.col("source_size")
    held = level.withColumn(
        "level_at", F.min(F.when(free, F.struct("stopped_size", "stopped_weight", "level"))).over(everything)
    )
    target = F.least(
        F.coalesce(F.col("level_at.level") * F.col("weight"), cap * F.col("source_size")), cap * F.col("source_size")
    )
    return held.select("source", "source_size", target.alias("target"))


def source_key(source: Column) -> Column:
    """A name that is never NULL and sorts as the source does."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(NO_SOURCE))


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")))


def narrow(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, source, size (words) and digest: one small row per document. Reads every text once."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(text).alias("size"),
        _digest(text).alias("digest"),
    )


def copies_in_mix(
    rows: DataFrame,
    identity: Sequence[str] = ("doc_id", "digest"),
    *,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """All columns of ``rows`` plus source_size, target and copies, from 0 to ``cap`` rounded up.

    ``rows`` has source, size and the columns in ``identity``, which orders rows of one bucket
    (rows equal in it are interchangeable); none is named like what this function adds or uses
    (of, spread, bucket, class, rank, before, before_class, n). It is read four times, so stage it.
    """
    spread = hash52(*(F.col(name) for name in identity))
    keyed = rows.select(
        "*",
        source_key(F.col("source")).alias("of"),
        spread.alias("spread"),
        F.pmod(spread, F.lit(buckets)).cast("int").alias("bucket"),
        size_class(F.col("size")).alias("class"),
    )
    targets = source_targets(keyed.select(F.col("of").alias("source"), "size"), weights=weights, share=share, cap=cap)
    targets = targets.withColumnRenamed("source", "of")
    # ranks before a bucket in two levels: classes of a source, then buckets of a class
    counts = keyed.groupBy("of", "class", "bucket").agg(F.count("*").alias("n"))
    of_class = counts.groupBy("of", "class").agg(F.sum("n").alias("n"))

    def before(keys: list[str], order: str) -> Column:
        earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(earlier), F.lit(0))

    classes = of_class.select("of", "class", before(["of"], "class").alias("before_class")).join(targets, "of")
    placing = counts.select("of", "class", "bucket", before(["of", "class"], "bucket").alias("before")).join(classes, ["of", "class"])
    within = Window.partitionBy("of", "class", "bucket").orderBy("spread", *identity)
    placed = keyed.withColumn("rank", F.row_number().over(within)).join(placing, ["of", "class", "bucket"])
    # one offset per source, a multiple of 2**-20 within (0, 1)
    drawn = (F.pmod(hash52(F.lit(seed), F.col("of")), F.lit(2**20 - 1)) + 1) / float(2**20)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    upto = (F.col("before_class") + F.col("before") + F.col("rank")).cast("double")
    copies = F.floor(drawn + upto * rate) - F.floor(drawn + (upto - 1) * rate)
    return placed.select(*rows.columns, "source_size", "target", copies.cast("int").alias("copies"))


def sampled_copies(
    docs: DataFrame, *, size: Column, identity: Sequence[Column], source_col: str = "source", **options
) -> DataFrame:
    """All columns of ``docs`` plus ``_size``, ``_source_size``, ``_target`` and ``_copies``: how
    often the mix takes the document, from 0 to ``cap`` rounded up. Options are those of
    ``copies_in_mix``.

    ``identity`` orders rows of one bucket; rows equal in it are interchangeable.

    Defined cases: a document of size 0 is ranked like any other, and a source whose sizes are
    all 0 has target 0 and is not taken; a NULL source is a source, ordered last; repeated rows
    are documents of their own; an empty table gives an empty result; reruns agree; a column of
    ``docs`` named like one that is added is an error.
    """
    added = {"_size": "size", "_source_size": "source_size", "_target": "target", "_copies": "copies"}
    if clash := sorted(set(added) & set(docs.columns)):
        raise ValueError(f"columns {clash} would be overwritten")
    names = [f"i{k}" for k in range(len(identity))]
    rows = docs.select(
        as_row(docs),
        F.col(source_col).cast("string").alias("source"),
        size.cast("long").alias("size"),
        *(value.alias(name) for name, value in zip(names, identity, strict=True)),
    )
    taken = copies_in_mix(rows, names, **options)
    return taken.select(*out_of_row(docs.columns), *(F.col(inner).alias(name) for name, inner in added.items()))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents (doc_id, source, text and any other columns) of the mix, all columns, each
    as often as it is taken.

    Sizes and digests are staged once and sampled without the texts. The copies are then joined
    to the documents, which are shuffled once, by themselves and not by their source.

    Defined cases: those of ``sampled_copies``; rows equal in doc_id, source and text that differ
    in other columns share the copies that fall to them, in an order of their own; an empty table
    gives an empty result; all columns stay as they are, whatever their name.
    """
    spark = docs.sparkSession

    def identity(doc_id: Column, source: Column, digest: Column) -> Column:
        return F.xxhash64(doc_id, source_key(source), digest)

    with shuffles_dropped(spark):
        staging = Staging(spark, "mixing")
        taken = copies_in_mix(staging.keep(narrow(docs)), **options)
        of = identity(F.col("doc_id"), F.col("source"), F.col("digest")).alias("of")
        shares = taken.groupBy(of).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
        shares = staging.keep(shares.where(F.col("copies") > 0))
    key = identity(F.col("doc_id").cast("long"), F.col("source").cast("string"), _digest(F.col("text")))
    joined = docs.select(as_row(docs), key.alias("key")).join(shares, F.col("key") == F.col("of"))
    # the nth of the rows that share an identity takes its part of their copies
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row")))
    upto = F.col("copies") * F.col("nth")
    times = F.floor(upto / F.col("rows")) - F.floor((upto - F.col("copies")) / F.col("rows"))
    numbered = joined.withColumn("nth", nth).select("row", times.cast("int").alias("times")).where(F.col("times") > 0)
    each = numbered.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    return each.select(*out_of_row(docs.columns))
