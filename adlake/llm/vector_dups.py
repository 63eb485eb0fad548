"""Near duplicates among embeddings by a forest of random-projection trees.

Equal vectors are one node. Every tree splits the nodes again and again at the median of their
projections on a random direction of its own; nodes close to the threshold go to both sides
(spill), so that a similar pair is rarely parted. Splits are fitted on a bounded sample, every
node is routed, and a leaf that is still large is sampled and split anew. Nodes are compared
within leaves, each pair is verified by its cosine in double precision, and the links found by
all trees are united.

Where a large share of all vectors lies close together, comparing all pairs would be quadratic
for no gain: vectors within half the linking angle of a common centre are linked for certain.
Such caps are found on the sample; a node belongs to one cap at most, and links within a cap are
counted, not listed. Only the rest is compared.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlake.llm.common import Staging, shuffles_dropped
from adlake.llm.neardup import components

LINKED = 0.95
TREES = 8
#: Trees whose leaves are compared in one step, which bounds the disk that copies of vectors take.
TOGETHER = 2
#: Share of a sampled node, around its median, that goes to both sides.
SPILL = 0.1
#: Nodes a leaf is to hold; leaves beyond OVERSIZE are split again, up to DEPTH levels a round.
LEAF, OVERSIZE, DEPTH, MAX_LEVELS = 256, 8192, 8, 48
#: Rows that the splits of one tree node are fitted on, in rows and in bytes.
SAMPLE, SAMPLE_BYTES = 8192, 1 << 24
#: The least that a cap must hold of the sample's rows, so that caps are at most SAMPLE / CAP_LEAST.
CAP_LEAST = 8
#: Largest leaf that one task compares at once; larger ones are compared in blocks.
BLOCK = 1024
SEED = 20240531

#: Margin for what rounding may add to an angle.
_SURE = 1e-9

PLACED = "tree int, leaf long, node long, cap int"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles; NULL where they take no part."""
    for batch in batches:
        found = []
        for value in batch.column(1).to_pylist():
            x = np.array([math.nan if v is None else v for v in value], dtype="<f8") if value else None
            usable = x is not None and np.isfinite(x).all() and np.any(x)
            # adding 0 makes -0 a 0, so that equal vectors have equal bytes
            found.append((x + 0.0).tobytes() if usable else None)
        lengths = [None if x is None else len(x) // 8 for x in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lengths, pa.int32()), pa.array(found, pa.binary())], names=["vec_id", "length", "vector"]
        )


def unpacked(vectors) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), dtype="<f8").reshape(len(vectors), -1)


def normalized(x: np.ndarray) -> np.ndarray:
    # large and tiny components would overflow or vanish when squared
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Forest:
    """Directions of tree nodes, drawn once per task. Node 1 is the root of a tree, the children
    of node p are 2p and 2p + 1."""

    def __init__(self, dims: int):
        self.dims = dims
        self.drawn: dict[tuple[int, int], np.ndarray] = {}

    def direction(self, tree: int, node: int) -> np.ndarray:
        if (tree, node) not in self.drawn:
            if len(self.drawn) >= 4096:
                self.drawn.clear()
            self.drawn[tree, node] = np.random.default_rng([SEED, tree, node]).standard_normal(self.dims)
        return self.drawn[tree, node]

    def fit(self, x: np.ndarray, tree: int, root: int, depth: int, spill: float) -> dict[int, tuple[float, float]]:
        """Per split node below ``root`` the bounds between which rows go to both sides."""
        bounds: dict[int, tuple[float, float]] = {}
        waiting = [(root, x)]
        for _ in range(depth):
            below = []
            for node, rows in waiting:
                if len(rows) < 8:
                    continue
                p = rows @ self.direction(tree, node)
                bounds[node] = low, high = tuple(np.quantile(p, [0.5 - spill / 2, 0.5 + spill / 2]))
                left, right = self.sides(p, low, high)
                below += [(2 * node, rows[left]), (2 * node + 1, rows[right])]
            waiting = below
        return bounds

    @staticmethod
    def sides(p: np.ndarray, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
        return p <= high, (p >= low if low < high else p > high)

    def route(self, x: np.ndarray, tree: int, root: int, bounds: dict[int, tuple[float, float]]) -> Iterator[tuple[int, np.ndarray]]:
        """The leaves below ``root`` and the positions of their rows."""
        waiting = [(root, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            if not len(rows):
                continue
            if node not in bounds:
                yield node, rows
                continue
            left, right = self.sides(x[rows] @ self.direction(tree, node), *bounds[node])
            waiting += [(2 * node, rows[left]), (2 * node + 1, rows[right])]


def caps(x: np.ndarray, linked: float, least: int = CAP_LEAST) -> np.ndarray:
    """Centres of caps that hold at least ``least`` of the rows, densest first."""
    degree = np.concatenate([(x[i : i + 512] @ x.T >= linked).sum(axis=1) for i in range(0, len(x), 512)]) if len(x) else np.zeros(0)
    free = np.ones(len(x), dtype=bool)
    centres = []
    for i in np.argsort(-degree, kind="stable"):
        if degree[i] < least:
            break
        if not free[i]:
            continue
        free[i] = False
        around = (x @ x[i] >= linked) & free
        around[i] = True
        if around.sum() < least:
            continue
        centre = x[around].mean(axis=0)
        centre /= np.linalg.norm(centre)
        inside = (x @ centre >= cap_cosine(linked)) & free
        if inside.sum() >= least - 1:
            centres.append(centre)
            free &= ~inside
    return np.array(centres).reshape(len(centres), x.shape[1])


def cap_cosine(linked: float) -> float:
    """Any two vectors this close to one centre are linked: their angles to it add up."""
    return math.cos(math.acos(linked) / 2) + _SURE


def _into_caps(centres: np.ndarray, linked: float):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cosine = normalized(unpacked(batch.column(1).to_pylist())) @ centres.T
            best = cosine.argmax(axis=1)
            inside = cosine[np.arange(len(best)), best] >= cap_cosine(linked)
            cap = pa.array(np.where(inside, best, -1), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), cap], names=["node", "cap"])

    return assign


def _routed(models: dict[int, dict[int, tuple[float, float]]], dims: int):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest(dims)
        for batch in batches:
            if not batch.num_rows:
                continue
            node, cap = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            x = normalized(unpacked(batch.column(2).to_pylist()))
            for tree, bounds in models.items():
                yield _placed([(tree, leaf, node[rows], cap[rows]) for leaf, rows in forest.route(x, tree, 1, bounds)])

    return route


def _placed(found: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    sizes = [len(node) for _, _, node, _ in found]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat([f[0] for f in found], sizes), pa.int32()),
            pa.array(np.repeat([f[1] for f in found], sizes), pa.int64()),
            pa.array(np.concatenate([f[2] for f in found]), pa.int64()),
            pa.array(np.concatenate([f[3] for f in found]), pa.int32()),
        ],
        names=["tree", "leaf", "node", "cap"],
    )


def _fitted(depth: int, spill: float):
    def fit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        x = normalized(unpacked(frame["vector"]))
        bounds = Forest(x.shape[1]).fit(x, int(key[0]), int(key[1]), depth, spill)
        return pd.DataFrame({"tree": [key[0]], "leaf": [key[1]], "model": [pickle.dumps(bounds)]})

    return fit


def _rerouted(dims: int):
    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = Forest(dims)
        for frame in frames:
            for (tree, leaf), rows in frame.groupby(["tree", "leaf"], sort=False):
                bounds = pickle.loads(rows["model"].iloc[0])
                x = normalized(unpacked(rows["vector"]))
                node, cap = rows["node"].to_numpy(), rows["cap"].to_numpy()
                yield _placed([(tree, to, node[at], cap[at]) for to, at in forest.route(x, tree, leaf, bounds)]).to_pandas()

    return route


def _compared(linked: float):
    """Linked pairs of a group: of different caps, and in a group of two blocks of different blocks."""

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        x = unpacked(frame["vector"])
        unit = normalized(x)
        node, cap, block = (frame[name].to_numpy() for name in ("node", "cap", "block"))
        two_blocks = key[-2] != key[-1]
        found_a, found_b = [], []
        for start in range(0, len(x), 256):
            rows = np.arange(start, min(start + 256, len(x)))
            near = unit[rows] @ unit[start:].T >= linked - _SURE
            a, b = np.nonzero(near)
            a, b = a + start, b + start
            wanted = (a < b) & ((cap[a] != cap[b]) | (cap[a] < 0))
            if two_blocks:
                wanted &= block[a] != block[b]
            a, b = a[wanted], b[wanted]
            exact = np.einsum("ij,ij->i", unit[a], unit[b])
            found_a.append(node[a[exact >= linked]])
            found_b.append(node[b[exact >= linked]])
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return compare


def _split_again(placed: DataFrame, nodes: DataFrame, staging: Staging, dims: int, spill: float, sizes: dict) -> DataFrame:
    """The placed nodes with oversized leaves split until none is left or trees are too deep.

    What a leaf holds of its largest cap does not count: those nodes need no comparison with
    each other, so they are no work.
    """
    done = None
    for _ in range(MAX_LEVELS // sizes["depth"]):
        of_cap = placed.groupBy("tree", "leaf", "cap").agg(F.count("*").alias("n"))
        work = F.sum("n") - F.coalesce(F.max(F.when(F.col("cap") >= 0, F.col("n"))), F.lit(0))
        large = staging.keep(of_cap.groupBy("tree", "leaf").agg(work.alias("n")).where(F.col("n") > sizes["oversize"]).select("tree", "leaf"))
        if large.isEmpty():
            break
        fine = staging.keep(placed.join(large, ["tree", "leaf"], "left_anti"))
        done = fine if done is None else done.unionByName(fine)
        open_rows = staging.keep(placed.join(large, ["tree", "leaf"], "left_semi"))
        order = Window.partitionBy("tree", "leaf").orderBy(F.xxhash64("node", "leaf"), "node")
        drawn = open_rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= sizes["sample"])
        sampled = drawn.select("tree", "leaf", "node").join(nodes.select("node", "vector"), "node")
        models = staging.keep(
            sampled.groupBy("tree", "leaf").applyInPandas(_fitted(sizes["depth"], spill), "tree int, leaf long, model binary")
        )
        full = open_rows.join(nodes.select("node", "vector"), "node").join(models, ["tree", "leaf"])
        placed = staging.keep(full.select("tree", "leaf", "node", "cap", "vector", "model").mapInPandas(_rerouted(dims), PLACED))
    return placed if done is None else done.unionByName(placed)


def _cells(placed: DataFrame, staging: Staging, block: int) -> DataFrame:
    """Each placed node with the groups it is compared in: (tree, leaf, one, other, low, high).

    A leaf of at most ``block`` nodes is one group. In a larger one the nodes of each cap, and
    those of none, are cut into blocks, and each block meets those of the other caps: no group
    is larger than ``block``, and the nodes of a cap do not meet each other.
    """
    key = ["tree", "leaf"]
    of_cap = staging.keep(placed.groupBy(*key, "cap").agg(F.count("*").alias("n")))
    leaves = of_cap.groupBy(*key).agg(F.sum("n").alias("n"))
    large = staging.keep(leaves.where(F.col("n") > block).select(*key))
    whole = placed.join(large, key, "left_anti").select(
        *key, *(F.lit(0).alias(name) for name in ("one", "other", "low", "high", "block")), "node", "cap"
    )
    parts = of_cap.join(large, key).select(*key, "cap", F.ceil(F.col("n") / (block // 2)).cast("int").alias("blocks"))
    mine, theirs = parts, parts.withColumnsRenamed({"cap": "with", "blocks": "of_with"})
    meet = mine.join(theirs, key).where((F.col("cap") != F.col("with")) | (F.col("cap") < 0))
    cut = placed.join(staging.keep(meet), [*key, "cap"])
    cut = cut.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("of_with") - 1)))
    first = (F.col("cap") < F.col("with")) | ((F.col("cap") == F.col("with")) & (F.col("block") <= F.col("at")))
    own, other = F.struct("cap", "block"), F.struct(F.col("with").alias("cap"), F.col("at").alias("block"))
    low, high = F.when(first, own).otherwise(other), F.when(first, other).otherwise(own)
    # blocks of different caps get different numbers, so that a group of two is told from a group of one
    cut = cut.select(
        *key, low["cap"].alias("one"), high["cap"].alias("other"),
        (low["block"] * 2).alias("low"), (high["block"] * 2 + (low["cap"] != high["cap"]).cast("int")).alias("high"),
        (F.col("block") * 2 + (~first & (low["cap"] != high["cap"])).cast("int")).alias("block"), "node", "cap",
    )
    return whole.unionByName(cut)


def _links(nodes: DataFrame, staging: Staging, dims: int, linked: float, trees: int, spill: float, sizes: dict) -> tuple[DataFrame, DataFrame]:
    """Linked pairs (a, b) of nodes (node, vector) that share no cap, and the caps (node, cap)."""
    total = nodes.count()
    rows = max(64, min(sizes["sample"], SAMPLE_BYTES // (8 * dims)))
    drawn = nodes.orderBy(F.xxhash64("node"), "node").limit(rows).select("vector").collect()
    sample = normalized(unpacked([bytes(row["vector"]) for row in drawn]))
    centres = caps(sample, linked)
    if len(centres):
        capped = staging.keep(nodes.select("node", "vector").mapInArrow(_into_caps(centres, linked), "node long, cap int"))
    else:
        capped = staging.keep(nodes.select("node", F.lit(-1).alias("cap")))
    depth = min(sizes["depth"], max(0, math.ceil(math.log2(total / sizes["leaf"]))))
    forest = Forest(dims)
    models = {tree: forest.fit(sample, tree, 1, depth, spill) for tree in range(trees)}
    entered = nodes.join(capped, "node").select("node", "cap", "vector")
    placed = staging.keep(entered.mapInArrow(_routed(models, dims), PLACED))
    placed = _split_again(placed, nodes, staging, dims, spill, sizes)
    pairs = None
    for start in range(0, trees, TOGETHER):
        cells = _cells(placed.where(F.col("tree").between(start, start + TOGETHER - 1)), staging, sizes["block"])
        grouped = cells.join(nodes.select("node", "vector"), "node").groupBy("tree", "leaf", "one", "other", "low", "high")
        found = staging.keep(grouped.applyInPandas(_compared(linked), "a long, b long").distinct())
        pairs = found if pairs is None else pairs.unionByName(found)
    return staging.keep(pairs.distinct()), capped


def near_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    linked: float = LINKED,
    trees: int = TREES,
    spill: float = SPILL,
    leaf: int = LEAF,
    oversize: int = OVERSIZE,
    depth: int = DEPTH,
    sample: int = SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors of cosine ``linked`` or more that the
    forest finds), component_id (the smallest id that links lead to, its own included), kept
    (whether that is its own).

    Defined cases: vectors that are NULL, empty, all zero, or hold a NULL, infinite or NaN
    component link with nothing, and so do rows without an id, whose component is NULL and which
    are kept; rows that repeat an id are vectors of their own, which share its component only
    through links; equal vectors always link; vectors of different length never do (each length
    has a forest of its own); an empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    sizes = {"leaf": leaf, "oversize": oversize, "depth": depth, "sample": sample, "block": block}
    with shuffles_dropped(spark):
        staging = Staging(spark, "vectors")
        whole = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        rows = staging.keep(whole.mapInArrow(_packed, "vec_id long, length int, vector binary"))
        usable = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        equal = usable.groupBy("length", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
        nodes = staging.keep(equal.withColumn("node", F.monotonically_increasing_id()))
        links = spark.createDataFrame([], "a long, b long")
        capped = spark.createDataFrame([], "node long, cap int, length int")
        for row in nodes.select("length").distinct().collect():
            dims = row["length"]
            found, inside = _links(nodes.where(F.col("length") == dims), staging, dims, linked, trees, spill, sizes)
            links = links.unionByName(found)
            capped = capped.unionByName(inside.where("cap >= 0").withColumn("length", F.lit(dims)))

        weighed = capped.join(nodes.select("node", "n"), "node")
        of_cap = staging.keep(weighed.groupBy("length", "cap").agg(F.sum("n").alias("all"), F.min("node").alias("leader")))
        in_cap = staging.keep(weighed.join(of_cap, ["length", "cap"]).select("node", "leader", (F.col("all") - F.col("n")).alias("others")))
        both = links.union(links.select("b", "a")).toDF("node", "other")
        other = nodes.select(F.col("node").alias("other"), "n")
        listed = both.join(other, "other").groupBy("node").agg(F.sum("n").alias("listed"))
        star = in_cap.where(F.col("node") != F.col("leader")).select(F.col("node").alias("a"), F.col("leader").alias("b"))
        joined = components(staging.keep(links.union(star)), staging).withColumnRenamed("id", "node")

        counted = nodes.join(listed, "node", "left").join(in_cap, "node", "left").join(joined, "node", "left")
        counted = staging.keep(
            counted.select(
                "node", "length", "vector", "first", F.coalesce("component", "node").alias("component"),
                (F.col("n") - 1 + F.coalesce("listed", F.lit(0)) + F.coalesce("others", F.lit(0))).alias("n_links"),
            )
        )
        least = counted.groupBy("component").agg(F.min("first").alias("component_id"))
        final = staging.keep(counted.join(least, "component").select("length", "vector", "n_links", "component_id"))
    known = F.when(F.col("vec_id").isNotNull(), F.col("vector"))
    found = rows.withColumn("vector", known).join(final, ["length", "vector"], "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
