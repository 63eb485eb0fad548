"""Exact top-k search by inner product, term at a time.

Every query is scored against every candidate. Both sides are cut into blocks by a hash of
their row, and each pair of blocks is one bounded task group. In it the candidates become
postings (per term, the rows that have it and their weights), each query scatters its weighted
postings into a dense array of scores, and a partition selection keeps its k best. The k best of
all blocks are then merged per query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlake.llm.common import Staging

#: Rows per block, for vectors of up to ``TERMS`` terms (about 12 MB; a task holds one block of
#: either kind), and fewer in proportion for longer ones.
CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 4096
TERMS = 128


def integer_weights(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` per component as long; NULL when the vector is NULL or holds a NULL,
    infinite or NaN component. Values beyond the range of long saturate."""
    whole = F.transform(vector, lambda x: x.cast("double"))
    usable = ~F.exists(
        whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    big = 9.2e18
    scaled = F.transform(
        whole,
        lambda x: F.greatest(F.least(F.floor(x * scale), F.lit(big)), F.lit(-big)).cast("long"),
    )
    return F.when(usable, scaled)


def top_k(
    vectors: DataFrame,
    *,
    id_col: str,
    vector_col: str,
    is_query: Column,
    k: int = 5,
    candidate_block: int = CANDIDATE_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k candidates with the highest integer inner product for each query.

    ``vector_col`` holds arrays of long; ``is_query`` marks the rows that are queries, and every
    row is a candidate except for queries of its own id. Returns query_id, rank (from 1), vec_id,
    score; ties go to the smaller id, and a query with fewer candidates gets them all.

    Defined cases: rows with a NULL id or vector take no part; rows that repeat an id are
    candidates and queries of their own, equal or not, but none for queries of that id, and the
    ranks of a query id go over all its rows; vectors of different lengths meet in the terms they
    share; an empty vector scores 0 with everyone; scores are 64-bit and wrap beyond that, as longs do;
    an empty table gives an empty result; other columns are ignored.
    """
    # staged with a number per row, which deals out rows that share an id
    rows = Staging(vectors.sparkSession, "topk").keep(
        vectors.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(vector_col).alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        )
        .where(F.col("id").isNotNull() & F.col("vector").isNotNull())
        .withColumn("row", F.monotonically_increasing_id())
    )
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q"), F.max(F.size("vector")).alias("terms")).first()
    shorter = max(1, -(-(sizes["terms"] or 0) // TERMS))
    candidate_blocks = max(1, -(-sizes["n"] * shorter // candidate_block))
    query_blocks = max(1, -(-sizes["q"] * shorter // query_block))

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = rows.select(
        "id", "vector", block(candidate_blocks).alias("cb"), everywhere(query_blocks).alias("qb")
    )
    queries = rows.where("asks").select(
        "id", "vector", everywhere(candidate_blocks).alias("cb"), block(query_blocks).alias("qb")
    )
    best = (
        queries.groupBy("cb", "qb")
        .cogroup(candidates.groupBy("cb", "qb"))
        .applyInPandas(_scorer(k), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def postings(vectors: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per term: the rows with a weight there, ascending, and those weights."""
    if not vectors:
        return {}
    lengths = np.array([len(vector) for vector in vectors])
    row = np.repeat(np.arange(len(vectors)), lengths)
    weight = np.concatenate(vectors).astype(np.int64)
    term = np.arange(len(weight)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    present = weight != 0
    term, row, weight = term[present], row[present], weight[present]
    order = np.argsort(term, kind="stable")
    term, row, weight = term[order], row[order], weight[order]
    starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else []
    ends = np.r_[starts[1:], len(term)] if len(term) else []
    return {int(term[a]): (row[a:b], weight[a:b]) for a, b in zip(starts, ends, strict=True)}


def select_best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller position; not ordered."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    level = np.flatnonzero(scores == least)[: k - len(above)]
    return np.concatenate([above, level])


def _scorer(k: int):
    def score(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        candidates = candidates.sort_values("id")
        ids = candidates["id"].to_numpy()
        lists = postings(list(candidates["vector"]))
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        for query, vector in zip(queries["id"], queries["vector"], strict=True):
            scores = np.zeros(len(ids), dtype=np.int64)
            for term, weight in enumerate(np.asarray(vector, dtype=np.int64)):
                if weight and term in lists:
                    rows, weights = lists[term]
                    if len(rows) == len(scores):
                        scores += weight * weights
                    else:
                        scores[rows] += weight * weights
            own = np.searchsorted(ids, [query, query + 1])
            others = np.r_[0 : own[0], own[1] : len(ids)] if own[0] < own[1] else np.arange(len(ids))
            best = others[select_best(scores[others], k)]
            found.append((query, ids[best], scores[best]))
        return pd.DataFrame(
            {
                "query_id": np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype("int64"),
                "vec_id": np.concatenate([f[1] for f in found] or [np.array([], "int64")]),
                "score": np.concatenate([f[2] for f in found] or [np.array([], "int64")]),
            }
        )

    return score
