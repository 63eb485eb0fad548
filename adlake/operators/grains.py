"""Distinct ids at several grains, with the raw rows shuffled by id instead of once per grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import settled

GRAIN = "grain"

Grains = Mapping[str, Sequence[str]]


def grain_columns(grains: Grains) -> list[str]:
    return list(dict.fromkeys(name for keys in grains.values() for name in keys))


def at_grains(rows: DataFrame, grains: Grains, *carried: str) -> DataFrame:
    """Each row once per grain, which it names; columns outside the grain are NULL.

    An ``inline`` and not an ``Expand``: Spark knows that it keeps rows where they are, so a
    partitioning by a carried column still holds after it.
    """
    types, columns = dict(rows.dtypes), grain_columns(grains)

    def placed(name: str, keys: Sequence[str]):
        shown = [F.col(n) if n in keys else F.lit(None).cast(types[n]) for n in columns]
        named = [value.alias(n) for n, value in zip(columns, shown, strict=True)]
        return F.struct(F.lit(name).alias(GRAIN), *named)

    return rows.select(*carried, F.inline(F.array(*(placed(name, keys) for name, keys in grains.items()))))


#: An id is heavy that holds more than this share of the rows; the sketch that finds such ids
#: keeps so many counters and never misses one.
HEAVY_SHARE, COUNTERS = 0.005, 4096


def heavy_ids(rows: DataFrame, id_column: str) -> list[str]:
    """The ids that hold more than ``HEAVY_SHARE`` of the rows, so 200 at most. Reads one column."""
    most = int(1 / HEAVY_SHARE)
    found = rows.where(F.col(id_column).isNotNull()).agg(
        F.call_function("approx_top_k", F.col(id_column), F.lit(most), F.lit(COUNTERS)).alias("top"), F.count("*").alias("n")
    )
    row = found.first()
    return [top["item"] for top in row["top"] or [] if top["count"] > HEAVY_SHARE * row["n"]]


def _per_id(rows: DataFrame, id_column: str, grains: Grains) -> DataFrame:
    """The rows of each id once per grain and key, without the id."""
    types, columns = dict(rows.dtypes), grain_columns(grains)
    lists = rows.groupBy(id_column).agg(F.collect_list(F.struct(*columns)).alias("_rows"))

    def placed(name: str, keys: Sequence[str], row):
        shown = [(row[n] if n in keys else F.lit(None).cast(types[n])).alias(n) for n in columns]
        return F.struct(F.lit(name).alias(GRAIN), *shown)

    def in_order(name: str, keys: Sequence[str]):
        # most ids have one row, which needs no function per element
        alone = F.when(F.size("_rows") == 1, F.array(placed(name, keys, F.col("_rows")[0])))
        return alone.otherwise(F.array_sort(F.transform("_rows", lambda row: placed(name, keys, row)))).alias(name)

    # sorted once per id, and then each compared with the one before it
    ordered = settled(lists.select(*(in_order(name, keys) for name, keys in grains.items())))

    def once(name: str):
        several = F.filter(name, lambda row, i: (i == 0) | ~row.eqNullSafe(F.get(name, i - 1)))
        return F.when(F.size(name) == 1, F.col(name)).otherwise(several)

    return ordered.select(F.inline(F.flatten(F.array(*(once(name) for name in grains)))))


def counts_at_grains(rows: DataFrame, id_column: str, grains: Grains, count: str, heavy: Sequence[str] = ()) -> DataFrame:
    """Distinct ids per key of each grain. No row for a grain that nothing falls into.

    Equal tuples are dropped first, map-side too, so that an id delivered any number of times
    moves as one row per task. The rest is dealt out by id: all tuples of an id lie together, the
    grains multiply them in place, and only partial counts are shuffled after that. Copies that a
    grain makes are dropped within the list of an id, so a task sorts its tuples once and holds no
    table of them at every grain.

    Ids in ``heavy`` may have so many different tuples that one task should not get them all.
    Theirs are multiplied where they are and dealt out by id and keys.
    """
    columns = grain_columns(grains)
    once = rows.select(id_column, *columns).distinct()
    few, many = once, None
    if heavy:
        listed = F.coalesce(F.col(id_column).isin(*heavy), F.lit(False))
        few, many = once.where(~listed), once.where(listed)
    each = _per_id(few.repartition(id_column), id_column, grains)
    if many is not None:
        each = each.unionByName(at_grains(many, grains, id_column).distinct().drop(id_column))
    return each.groupBy(GRAIN, *columns).agg(F.count("*").alias(count))
