"""Near duplicates: a multi-index Hamming join over MinHash signatures, confirmed on full sets.

A document's set is that of its word shingles. ``VALUES`` minima of hashed shingles, cut to 16
bits each, make its signature. Two signatures that differ in at most ``MAX_DISTANCE`` values,
cut into ``CHUNKS`` chunks, have a chunk with at most ``ERRORS`` differing values (pigeonhole).
So every chunk is entered once per way to leave out that many values, and documents within the
distance meet under at least one key, for certain. At a similarity of 0.75 a value differs with
probability 0.25, and more than ``MAX_DISTANCE`` of them with a probability near one in a
million.

What meets is not expanded into pairs at once:

1. Equal sets are one node, the smallest id.
2. Each node is compared with one node: the smallest of a key, of those it shares most keys with.
   That joins large groups of near copies by as many comparisons as they have members.
3. Under keys where more than one component is left, members of different components are
   compared in blocks of bounded size, those of the key's largest component not among themselves:
   by signature, then by a parity sketch of the whole sets. What is near is confirmed.

The parity sketch toggles one of ``PARITY_BITS`` bits per element. Where two sketches differ, the
sets differ, so their number of differing bits never exceeds that of differing elements: a pair
it rules out is not similar enough, for certain.

Confirmation counts the full sets, as 64-bit hashes of shingles, of the texts themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import Staging, as_row, out_of_row, shuffles_dropped

SHINGLE = 5
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 75

VALUES, CHUNKS, ERRORS = 80, 20, 1
MAX_DISTANCE = CHUNKS * (ERRORS + 1) - 1
WIDTH = VALUES // CHUNKS
#: The values of a chunk that stay when up to ERRORS of them are left out.
KEPT = list(combinations(range(WIDTH), WIDTH - ERRORS))

PARITY_BITS = 2048
#: A node's record: values of the signature, size of the set, parity sketch.
RECORD = np.dtype([("values", np.uint16, VALUES), ("size", np.int64), ("parity", np.uint64, PARITY_BITS // 64)])

#: Largest block of one key that is compared with another block in one group.
BLOCK = 512

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 2**63, VALUES, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text in UTF-8.

    ``bytes`` lower-cases A-Z only and splits at ASCII white space only. With fewer words than a
    shingle has, the whole sequence is the one element; without words the set is empty.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.array([], dtype=np.uint64)
    hashes = np.array([xxhash.xxh3_64_intdigest(word) for word in words], dtype=np.uint64)
    length = min(shingle, len(hashes))
    total = np.full(len(hashes) - length + 1, length, dtype=np.uint64)
    for i in range(length):
        total = total * _GOLDEN + hashes[i : len(hashes) - length + 1 + i]
    return np.unique(_mixed(total))


def signature(elements: np.ndarray) -> np.ndarray:
    """The low 16 bits of the minimum under each of ``VALUES`` hash functions."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(elements), 4096):
        block = elements[start : start + 4096, None] * _FACTORS + _SHIFTS
        least = np.minimum(least, block.min(axis=0))
    return _mixed(least).astype(np.uint16)


def parity(elements: np.ndarray) -> np.ndarray:
    """The parity sketch of a set, as 64-bit words."""
    odd = np.bincount((elements >> np.uint64(20)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def record(elements: np.ndarray) -> bytes:
    found = np.zeros(1, dtype=RECORD)
    found["values"], found["size"], found["parity"] = signature(elements), len(elements), parity(elements)
    return found.tobytes()


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of each signature (a row): one per chunk and choice of values kept."""
    parts = np.ascontiguousarray(signatures).reshape(len(signatures), CHUNKS, WIDTH).astype(np.uint64)
    keys = []
    for way, kept in enumerate(KEPT):
        packed = (np.arange(CHUNKS, dtype=np.uint64) * np.uint64(len(KEPT)) + np.uint64(way))[None, :]
        packed = np.repeat(_mixed(packed + np.uint64(1)), len(signatures), axis=0)
        for position in kept:
            packed = _mixed(packed * _GOLDEN + parts[:, :, position])
        keys.append(packed)
    return np.concatenate(keys, axis=1)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            sizes, digests, signatures = [], [], []
            for value in part.column(1):
                elements = shingle_set(value.as_py())
                sizes.append(len(elements))
                digests.append(hashlib.blake2b(elements.tobytes(), digest_size=16).digest())
                signatures.append(record(elements) if len(elements) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "signature"],
            )


def _enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            keys = chunk_keys(np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=RECORD)["values"])
            ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), keys.shape[1])
            yield pa.RecordBatch.from_arrays([_signed(keys.ravel()), pa.array(ids, pa.int64())], names=["key", "id"])


def _near_in_groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of one (key, low, high) group, from different components and, where low and high
    differ, from different blocks, that signature and parity do not rule out. Rows come sorted by
    group."""
    rest = None

    def pairs(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        records = np.frombuffer(b"".join(frame["signature"]), dtype=RECORD)
        values, size, odd = (np.ascontiguousarray(records[name]) for name in RECORD.names)
        ids, component = frame["id"].to_numpy(), frame["component"].to_numpy()
        block, cross = frame["block"].to_numpy(), (frame["low"] != frame["high"]).to_numpy()
        group = frame[["key", "low", "high"]].to_numpy()
        edges = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(axis=1), True])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            for i in range(a, b - 1):
                others = slice(i + 1, b)
                wanted = component[others] != component[i]
                if cross[i]:
                    wanted &= block[others] != block[i]
                at = i + 1 + np.flatnonzero(wanted)
                near = at[(values[at] != values[i]).sum(axis=1) <= MAX_DISTANCE]
                differing = np.bitwise_count(odd[near] ^ odd[i]).sum(axis=1, dtype=np.int64)
                near = near[(100 + PERCENT) * differing <= (100 - PERCENT) * (size[near] + size[i])]
                if len(near):
                    yield np.minimum(ids[near], ids[i]), np.maximum(ids[near], ids[i])

    def found(frame: pd.DataFrame) -> pd.DataFrame:
        each = list(pairs(frame))
        if not each:
            return pd.DataFrame({"a": np.array([], "int64"), "b": np.array([], "int64")})
        return pd.DataFrame(
            {"a": np.concatenate([x for x, _ in each]), "b": np.concatenate([y for _, y in each])}
        ).drop_duplicates()

    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        last = frame[["key", "low", "high"]].iloc[-1]
        open_at = (frame[["key", "low", "high"]] == last).all(axis=1).to_numpy().argmax()
        rest = frame.iloc[open_at:]
        if open_at:
            yield found(frame.iloc[:open_at])
    if rest is not None and len(rest):
        yield found(rest)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, of_last = None, None
    for batch in batches:
        linked_a, linked_b = [], []
        for a, b, left, right in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if b != last or of_last[0] != right:
                last, of_last = b, (right, shingle_set(right))
            one, other = shingle_set(left), of_last[1]
            smaller, larger = sorted((len(one), len(other)))
            if 100 * smaller < PERCENT * larger:
                continue
            common = len(np.intersect1d(one, other, assume_unique=True))
            if common and 100 * common >= PERCENT * (len(one) + len(other) - common):
                linked_a.append(a)
                linked_b.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(linked_a, pa.int64()), pa.array(linked_b, pa.int64())], names=["a", "b"])


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough. ``texts``: id, text."""
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
    both = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(_confirm, "a long, b long").distinct()


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """id, component (its smallest id) of all that edges (a, b) join.

    Each round takes the smallest label among neighbours, then that of one's label, so that the
    rounds grow with the logarithm of a chain's length.
    """
    both = staging.keep(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = staging.keep(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component")))
    while True:
        offered = staging.keep(
            both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m"))
        )
        hooked = staging.keep(
            labels.join(offered, "id").select("id", F.col("component").alias("before"), F.least("component", "m").alias("label"))
        )
        onward = hooked.select(F.col("id").alias("label"), F.col("label").alias("component"))
        after = staging.keep(hooked.join(onward, "label").select("id", "before", "component"))
        settled = after.where(F.col("component") < F.col("before")).isEmpty()
        staging.drop(labels, offered, hooked)
        labels = after.select("id", "component")
        if settled:
            return labels


def _relabelled(ids: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """``ids`` with the column replaced by its component, where it has one."""
    found = labels.select(F.col("id").alias(column), F.col("component").alias("_to"))
    return ids.join(found, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")


def _groups_to_compare(left: DataFrame, staging: Staging) -> DataFrame:
    """The members (key, id, component, n of the key) with the groups (key, low, high) they are
    compared in, and their block there.

    Up to ``BLOCK`` members of a key are one group. Of more, those outside the key's largest
    component are cut into blocks that meet each other, and the blocks of the largest one, whose
    members need no comparison among themselves. With n members, m of them outside, that is m * n
    comparisons and not n * n.
    """
    names = ["key", "id", "component", "block", "low", "high"]
    nothing = [F.lit(0).alias(name) for name in ("block", "low", "high")]
    whole = left.where(F.col("n") <= BLOCK).select("key", "id", "component", *nothing)
    large = left.where(F.col("n") > BLOCK)
    sizes = large.groupBy("key", "component").agg(F.count("*").alias("of"), F.max("n").alias("n"))
    largest = F.max(F.struct("of", "component"))
    parts = sizes.groupBy("key").agg(largest.alias("top"), F.max("n").alias("n")).select(
        "key",
        F.col("top.component").alias("largest"),
        F.ceil(F.col("top.of") / BLOCK).cast("int").alias("inner"),
        F.ceil((F.col("n") - F.col("top.of")) / BLOCK).cast("int").alias("outer"),
    )
    cut = large.join(staging.keep(parts), "key")
    outside = F.col("component") != F.col("largest")
    number = F.pmod(F.xxhash64("id"), F.when(outside, F.col("outer")).otherwise(F.col("inner"))).cast("int")
    # blocks of the largest component are numbered on from the others
    cut = cut.withColumn("block", F.when(outside, number).otherwise(F.col("outer") + number))
    every = F.when(outside, F.sequence(F.lit(0), F.col("outer") + F.col("inner") - 1)).otherwise(F.sequence(F.lit(0), F.col("outer") - 1))
    met = cut.withColumn("other", F.explode(every))
    met = met.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    return whole.unionByName(met.select(*names))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id that links lead
    to, its own included), kept (whether that is its own).

    Defined cases: a NULL or empty text, or one without words, has an empty set and is linked
    with nothing; rows that repeat an id are one document, linked with each other unless empty; rows without an
    id are linked with nothing, have no component and are kept; texts are read whole; an empty
    table gives an empty result; other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    with shuffles_dropped(spark):
        staging = Staging(spark, "neardup")
        sketched = staging.keep(
            texts.mapInArrow(_sketch, "doc_id long, n_shingles long, digest binary, signature binary")
        )
        alive = sketched.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
        nodes = staging.keep(alive.groupBy("digest").agg(F.min("doc_id").alias("id")))
        signed = staging.keep(
            alive.select("digest", F.col("doc_id").alias("id"), "signature")
            .join(nodes, ["digest", "id"])
            .select("id", "signature")
            .distinct()
        )
        entered = signed.mapInArrow(_enter, "key long, id long")
        shared = staging.keep(
            entered.groupBy("key")
            .agg(F.min("id").alias("leader"), F.max("id").alias("last"))
            .where(F.col("leader") < F.col("last"))
            .select("key", "leader")
        )
        members = staging.keep(entered.join(shared, "key").select("key", "id", "leader"))

        # each node against the one leader that it shares most keys with
        votes = members.where(F.col("id") != F.col("leader")).groupBy("id", "leader").agg(F.count("*").alias("n"))
        nearest = votes.groupBy("id").agg(F.max(F.struct("n", (-F.col("leader")).alias("m")))["m"].alias("m"))
        star = staging.keep(nearest.select(F.col("id").alias("a"), (-F.col("m")).alias("b")))
        first = components(staging.keep(_confirmed(star, texts)), staging)

        # all that is left: members of one key in different components
        labelled = staging.keep(
            members.join(first, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
        )
        open_keys = staging.keep(
            labelled.groupBy("key")
            .agg(F.min("component").alias("m"), F.max("component").alias("x"), F.count("*").alias("n"))
            .where(F.col("m") < F.col("x"))
            .select("key", "n")
        )
        placed = _groups_to_compare(labelled.join(open_keys, "key"), staging)
        grouped = (
            staging.keep(placed)
            .join(signed, "id")
            .repartition("key", "low", "high")
            .sortWithinPartitions("key", "low", "high")
        )
        near = staging.keep(grouped.mapInPandas(_near_in_groups, "a long, b long").distinct())
        staging.drop(members, labelled)
        links = staging.keep(_confirmed(near, texts))
        # a document whose rows hold different texts is in several nodes, which it joins
        several = alive.groupBy("doc_id").agg(F.min("digest").alias("m"), F.max("digest").alias("x")).where("m < x")
        same = alive.join(staging.keep(several.select("doc_id")), "doc_id").select("digest", F.col("doc_id").alias("a"))
        links = links.union(same.join(nodes.withColumnRenamed("id", "b"), "digest").select("a", "b"))
        between = _relabelled(_relabelled(links, "a", first), "b", first)
        second = components(staging.keep(between.where(F.col("a") != F.col("b"))), staging)
        final = staging.keep(
            _relabelled(nodes.select("digest", F.col("id").alias("component")), "component", first)
        )
        final = staging.keep(_relabelled(final, "component", second).select("digest", "component"))
    joined = sketched.join(
        final, (sketched["digest"] == final["digest"]) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left"
    )
    component = F.coalesce("component", "doc_id")
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents (doc_id, text and any other columns), all columns, less those of which a
    near copy with a smaller id is there. Of rows that repeat an id one stays.

    Defined cases: rows without an id stay, all of them; so do documents without a text or
    without words, one row per id; of rows that repeat an id the one with the longest text stays
    (a NULL text is the shortest), then that of the smallest hash of the whole row, so that a
    rerun keeps the same; an empty table gives an empty result; all columns stay as they are,
    whatever their name.
    """
    staging = Staging(docs.sparkSession, "kept")
    found = near_duplicates(docs.select("doc_id", "text")).where(F.col("kept") & F.col("doc_id").isNotNull())
    kept = found.select(F.col("doc_id").alias("id")).distinct()
    doc_id = F.col("doc_id").cast("long")
    keyed = docs.where(doc_id.isNotNull()).select(as_row(docs), doc_id.alias("id"), F.octet_length("text").alias("length"))
    keyed = keyed.withColumn("hash", F.xxhash64("row"))
    # which row of an id stays is settled without the texts; what is left to drop are equal rows
    order = F.struct((-F.coalesce("length", F.lit(-1))).alias("shorter"), "hash")
    best = keyed.groupBy("id").agg(F.min(order).alias("best")).select("id", F.col("best.hash").alias("hash"))
    best = staging.keep(best.join(kept, "id", "left_semi"))
    single = keyed.select("row", "id", "hash").dropDuplicates(["id", "hash"]).join(best, ["id", "hash"], "left_semi")
    return single.select(*out_of_row(docs.columns)).unionByName(docs.where(doc_id.isNull()))
