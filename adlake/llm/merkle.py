"""A Merkle manifest of a table: a leaf per row, a tree per language, a tree over the languages.

Nodes of a tree are cut into superblocks of ``2**BITS`` consecutive ones. On the way up every
superblock is reduced to one node by a bounded task, layer by layer, until each tree has its
root. On the way down the nodes of a superblock are cogrouped with the outer nodes that they need
(the path from the superblock's own root upwards): one bounded task finishes the local reduction,
joins each node's siblings with the outer ones, and folds the leaf up to the root again.

A row's place in its tree comes from a range-partitioned sort: an index within the partition plus
the sizes of the partitions before it. No task holds a language, however large.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlake.llm.common import Staging, shuffles_dropped

#: A superblock holds two to this power nodes.
BITS = 12
ARITY = 2

NODES = "tree long, n long, index long, hash string"
OUTER = "tree long, block long, path string, top string"
RESULT = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

#: ``monotonically_increasing_id`` has the partition above this bit and the row within it below.
_ROW_BITS = 33


def field(value: Column) -> Column:
    """How a value enters a leaf: its length in UTF-8, a colon and itself; ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*(field(value) for value in values)), 256)


def digest(*nodes: str) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def height(n: int) -> int:
    """Rounds until one of n nodes is left."""
    return (n - 1).bit_length()


def reduced(hashes: list[str], rounds: int) -> list[list[str]]:
    """The nodes of each level, from the given ones up. A last node without partner is hashed alone."""
    levels = [hashes]
    for _ in range(rounds):
        below = levels[-1]
        levels.append([digest(*below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """What a node is hashed with on each level: ``L`` or ``R`` and the sibling, or ``N`` for none."""
    found = []
    for nodes in levels[:-1]:
        other = at ^ 1
        found.append("N" if other >= len(nodes) else ("L" if other < at else "R") + nodes[other])
        at //= ARITY
    return found


def fold(node: str, path: list[str]) -> str:
    """The root that a node and its siblings lead to."""
    for step in path:
        if step == "N":
            node = digest(node)
        else:
            node = digest(step[1:], node) if step[0] == "L" else digest(node, step[1:])
    return node


def proof_digest(path: list[str]) -> str:
    return digest(*(step[1:] for step in path))


def with_place(rows: DataFrame, staging: Staging, *order: Column) -> DataFrame:
    """Adds ``place``: gapless from 0 in that order, which must leave no ties that matter.

    The rows are staged range-partitioned and sorted, each with partition and index, so that a
    repeated step cannot number them differently. Only one count per partition meets in one task.
    """
    numbered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    kept = staging.keep(numbered)
    part = F.shiftright("_at", _ROW_BITS).alias("_part")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = kept.groupBy(part).agg(F.count("*").alias("_n"))
    before = staging.keep(sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    index = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    return kept.withColumn("_part", part).join(before, "_part").withColumn("place", F.col("_before") + index).drop("_at", "_part", "_before")


def _superblock(bits: int) -> Column:
    return F.shiftright("index", bits).alias("block")


def climb(nodes: DataFrame, staging: Staging, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """The layers of nodes from the given ones up, and the root of each tree (tree, hash)."""

    def reduce(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        n = int(frame["n"].iloc[0])
        hashes = list(frame.sort_values("index")["hash"])
        top = reduced(hashes, min(bits, height(n)))[-1]
        return pd.DataFrame({"tree": [key[0]], "n": [-(-n // (1 << bits))], "index": [key[1]], "hash": top})

    layers = [nodes]
    while (layers[-1].agg(F.max("n")).first()[0] or 0) > 1:
        layer = layers[-1]
        layers.append(staging.keep(layer.groupBy("tree", _superblock(bits)).applyInPandas(reduce, NODES)))
    return layers[: max(1, len(layers) - 1)], layers[-1].select("tree", "hash")


def _local(frame: pd.DataFrame, bits: int) -> tuple[pd.DataFrame, list[list[str]]]:
    frame = frame.sort_values("index", ignore_index=True)
    return frame, reduced(list(frame["hash"]), min(bits, height(int(frame["n"].iloc[0]))))


def descend(layers: list[DataFrame], outer: DataFrame, staging: Staging, bits: int) -> DataFrame:
    """The outer nodes of the superblocks of the lowest layer, from those of the trees' roots."""

    def extend(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        frame, levels = _local(nodes, bits)
        path, top = above["path"].iloc[0], above["top"].iloc[0]
        paths = [",".join(filter(None, [*siblings(levels, i), path])) for i in range(len(frame))]
        return pd.DataFrame({"tree": frame["tree"], "block": frame["index"], "path": paths, "top": top})

    for layer in reversed(layers[1:]):
        cogrouped = layer.groupBy("tree", _superblock(bits)).cogroup(outer.groupBy("tree", "block"))
        outer = staging.keep(cogrouped.applyInPandas(extend, OUTER))
    return outer


def _typed(found: DataFrame) -> DataFrame:
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def manifest(docs: DataFrame, *, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, leaf, subroot (of its language), root, proof_sha256,
    folded_root and verified (whether that is the root).

    Input columns are doc_id, source, lang, n_chars and text. A leaf is the digest of these, a
    language's leaves go by doc_id. ``folded_root`` starts from the leaf of the row as a tampered
    copy holds it: where 7 divides the crc32 of the id, that copy has one more in ``n_chars``.

    Defined cases: NULL in any column enters the leaf as ``-``; NULL ids come first, and rows
    that share an id go by leaf; equal rows are leaves of their own and interchangeable; a NULL
    id or NULL n_chars is never tampered with; a NULL language is one of its own, before all
    others, and an empty text is not a NULL one; texts are hashed whole; a table of one row has
    its leaf as root and no siblings; an empty table gives an empty result; other columns are
    ignored.
    """
    spark = docs.sparkSession
    chars = F.col("n_chars").cast("decimal(20,0)")
    of_row = [F.col("doc_id"), F.col("source"), F.col("lang")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    with shuffles_dropped(spark):
        staging = Staging(spark, "merkle")
        leaves = staging.keep(
            docs.select(
                F.col("lang").cast("string").alias("lang"),
                F.col("doc_id").cast("long").alias("doc_id"),
                leaf(*of_row, chars, F.col("text")).alias("hash"),
                F.when(hit & chars.isNotNull(), leaf(*of_row, chars + 1, F.col("text"))).alias("tampered"),
                # deals out equal rows, which nothing else tells apart
                F.monotonically_increasing_id().alias("_copy"),
            )
        )
        order = [F.asc_nulls_first("lang"), F.asc_nulls_first("doc_id"), F.asc("hash"), F.asc("_copy")]
        placed = with_place(leaves, staging, *order)
        # a language's tree goes by the place of its first leaf
        langs = placed.groupBy("lang").agg(F.min("place").alias("tree"), F.count("*").alias("n"))
        langs = staging.keep(langs)
        same = placed["lang"].eqNullSafe(langs["lang"])
        nodes = staging.keep(
            placed.join(langs, same).select(
                "tree", "n", (F.col("place") - F.col("tree")).alias("index"), "hash",
                # as text, since pandas turns longs with NULLs among them into doubles
                F.col("doc_id").cast("string").alias("doc_id"), "tampered",
            )
        )
        layers, subroots = climb(nodes, staging, bits)
        subroots = staging.keep(subroots)
        ranked = with_place(subroots, staging, F.asc("tree")).withColumnsRenamed({"tree": "of", "place": "index"})
        one_tree = [F.lit(0).cast("long").alias("tree"), F.lit(subroots.count()).cast("long").alias("n")]
        over = staging.keep(ranked.select(*one_tree, "index", "hash", "of"))
        top_layers, root = climb(over, staging, bits)
        found = root.first()
        if found is None:
            return _typed(spark.createDataFrame([], RESULT))
        top = found["hash"]

        start = root.select("tree", F.lit(0).cast("long").alias("block"), F.lit("").alias("path"), F.col("hash").alias("top"))
        start = descend(top_layers, start, staging, bits)

        def of_languages(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
            frame, levels = _local(nodes, bits)
            path = above["path"].iloc[0]
            paths = [",".join(filter(None, [*siblings(levels, i), path])) for i in range(len(frame))]
            return pd.DataFrame({"tree": frame["of"], "block": 0, "path": paths, "top": frame["hash"]})

        cogrouped = over.groupBy("tree", _superblock(bits)).cogroup(start.groupBy("tree", "block"))
        outer = descend(layers, staging.keep(cogrouped.applyInPandas(of_languages, OUTER)), staging, bits)

    def proofs(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        frame, levels = _local(nodes, bits)
        rest = [step for step in above["path"].iloc[0].split(",") if step]
        rows = []
        for i, (node, changed) in enumerate(zip(frame["hash"], frame["tampered"], strict=True)):
            path = siblings(levels, i) + rest
            rows.append((proof_digest(path), fold(changed if isinstance(changed, str) else node, path)))
        result = frame[["doc_id"]].assign(leaf=frame["hash"], subroot=above["top"].iloc[0], root=top)
        result["proof_sha256"], result["folded_root"] = [row[0] for row in rows], [row[1] for row in rows]
        return result.assign(verified=result["folded_root"] == top)

    cogrouped = nodes.groupBy("tree", _superblock(bits)).cogroup(outer.groupBy("tree", "block"))
    return _typed(cogrouped.applyInPandas(proofs, RESULT))
