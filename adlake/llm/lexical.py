"""Ranked lexical search with bag deduplication.

The vocabulary is that of the items, not of the documents. Each document becomes its bag, the
term frequencies of that vocabulary, with its length. Documents of equal bag and equal length
norm ``m`` score alike on every item, so they are one class: found by hash, verified by the whole
vector (the grouping compares it), scored once. A class carries its ``k`` smallest ids, since no
item can rank more of one class, and expands to them in ascending order at the end.

Items are taken in blocks of about ``BLOCK_PAIRS`` distinct (item, term) pairs, with a pass over
the documents each, so that what travels to the tasks is bounded whatever the number of items.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlake.llm.common import Staging, shuffles_dropped

#: Distinct (item, term) pairs of a block of items: at most about 10 MB of terms.
BLOCK_PAIRS = 1 << 18
#: Terms longer than this many bytes go by a digest, which no term can equal.
LONG_TERM = 32
#: Cells of the scores and additions to them that a task holds at once.
CELLS = 1 << 21

#: All but ASCII digits and letters, and what is beyond ASCII, parts terms; A-Z become a-z.
_FOLDED = bytes(
    b if b >= 0x80 or chr(b).isalnum() and not chr(b).isupper() else ord(chr(b).lower()) if chr(b).isalpha() else 0x20
    for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8, repeats included."""
    return text.encode().translate(_FOLDED).split() if text else []


def term_key(term: bytes) -> bytes:
    """The term, or for a long one ``#`` and its digest, so that keys are bounded."""
    return term if len(term) <= LONG_TERM else b"#" + hashlib.blake2b(term, digest_size=LONG_TERM).digest()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            keys = [term_key(term) for term in set(terms(text.as_py()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(keys), pa.int64()), pa.array(keys, pa.binary())], names=["item_id", "term"]
            )


def _bags(vocabulary):
    """Per document with a term: its length and its bag, as pairs of term number and frequency."""

    def bag(numbers: dict[bytes, int], words: list[bytes]) -> bytes:
        counts = Counter(words)
        found = []
        for word, tf in counts.items():
            number = numbers.get(word if len(word) <= LONG_TERM else term_key(word))
            if number is not None:
                found.append((number, tf))
        return np.array(sorted(found), dtype="<u4").tobytes()

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {term: number for number, term in enumerate(vocabulary.value)}
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids, lengths, found = [], [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    words = terms(text.as_py())
                    if words:
                        ids.append(doc_id)
                        lengths.append(len(words))
                        found.append(bag(numbers, words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(found, pa.binary())],
                    names=["doc_id", "n", "bag"],
                )

    return convert


def _pairs(bags: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bags), dtype="<u4").reshape(-1, 2).astype(np.int64)


def _document_frequencies(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_pairs(batch.column(0).to_pylist())[:, 0], minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found])], names=["term", "df"])

    return count


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


class Best:
    """The k best classes of each item, by score and then by smallest id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.first = (np.zeros(0, np.int64) for _ in range(3))
        self.members = np.zeros(0, object)
        self.least = np.ones(items, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, first: np.ndarray, members: np.ndarray) -> None:
        if not len(item):
            return
        item, score = np.r_[self.item, item], np.r_[self.score, score]
        first, members = np.r_[self.first, first], np.r_[self.members, members]
        order = np.lexsort((first, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[place < self.k]
        self.item, self.score, self.first, self.members = item[place < self.k], score[order], first[order], members[order]
        full = place[place < self.k] == self.k - 1
        self.least[self.item[full]] = self.score[full]

    def rows(self) -> list[tuple[int, int, int]]:
        """(item, doc_id, score), the k best documents of each item."""
        each = [(i, -s, d) for i, s, ids in zip(self.item, self.score, self.members, strict=True) for d in ids]
        taken: Counter[int] = Counter()
        found = []
        for i, s, d in sorted(each):
            if taken[i] < self.k:
                taken[i] += 1
                found.append((i, d, -s))
        return found


def _scorer(block, k: int):
    """Adds every class's weighted terms to the scores of the items that have them."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, starts, items, weights = block.value
        best = Best(len(item_ids), k)
        per_term = starts[1:] - starts[:-1]

        def scored(norms: np.ndarray, bags: list[bytes], members: np.ndarray) -> None:
            pairs = _pairs(bags)
            term, tf = pairs[:, 0], pairs[:, 1]
            row = np.repeat(np.arange(len(bags)), [len(bag) // 8 for bag in bags])
            value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * norms[row]))
            times = per_term[term]
            within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            item = items[np.repeat(starts[term], times) + within]
            scores = np.zeros((len(bags), len(item_ids)), dtype=np.int64)
            np.add.at(scores, (np.repeat(row, times), item), np.repeat(value, times))
            at, item = np.nonzero(scores >= best.least)
            first = np.array([ids[0] for ids in members], dtype=np.int64)
            best.add(item, scores[at, item], first[at], members[at])

        for batch in batches:
            norms = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            bags = batch.column(1).to_pylist()
            members = np.empty(len(bags), dtype=object)
            members[:] = batch.column(2).to_pylist()
            cost = np.array([per_term[_pairs([bag])[:, 0]].sum() for bag in bags]) + len(item_ids)
            piece = np.cumsum(cost) // CELLS
            edges = [0, *(np.flatnonzero(np.diff(piece)) + 1), len(bags)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                scored(norms[a:b], bags[a:b], members[a:b])
        found = best.rows()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([item_ids[i] for i, _, _ in found], pa.int64()),
                pa.array([d for _, d, _ in found], pa.int64()),
                pa.array([s for _, _, s in found], pa.int64()),
            ],
            names=["item_id", "doc_id", "score"],
        )

    return score


def length_norm(n: Column, documents: int, length: int) -> Column:
    """10 + (90 * n * documents) div length; the product may need more than 64 bits."""
    product = (n * 90).cast("decimal(20,0)") * F.lit(documents).cast("decimal(18,0)")
    return (F.call_function("div", product, F.lit(length).cast("decimal(18,0)")) + 10).cast("long")


def classes(bags: DataFrame, norm: Column, k: int) -> DataFrame:
    """m, bag and ids (the k smallest, ascending) of each class of equal m and equal bag.

    Classes are dealt out and sorted by a hash, with the vector itself behind it, so that two
    vectors of one hash stay two classes. Each task lets go of all but k members before the
    shuffle, so the largest group of copies moves as k rows a task.
    """
    keyed = bags.select("doc_id", "bag", norm.alias("m"))
    keyed = keyed.where(F.col("doc_id").isNotNull() & (F.octet_length("bag") > 0)).withColumn("hash", F.xxhash64("bag", "m"))
    key = ["hash", "m", "bag"]
    placed = keyed.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy("doc_id")))
    few = placed.where(F.col("place") <= k)
    return few.groupBy(*key).agg(F.sort_array(F.collect_list("doc_id")).alias("ids")).select("m", "bag", "ids")


def search(docs: DataFrame, items: DataFrame, *, k: int = 10, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """The k documents (doc_id, text) of highest score above 0 for each item (item_id, text):
    item_id, rank (from 1), doc_id, score; equal scores by ascending doc_id.

    Defined cases: a NULL text, and one without terms, has no part in any statistic and no rank;
    repeated rows of documents are documents of their own; rows without doc_id count for the
    statistics and are never ranked; rows that repeat an item_id are one item with the terms of
    all of them, and so are those without one; items without terms have no rows; texts and terms
    count whole; an empty table of either kind gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    with shuffles_dropped(spark):
        staging = Staging(spark, "lexical")
        wanted = staging.keep(asked.mapInArrow(_item_terms, "item_id long, term binary").distinct())
        blocks = -(-wanted.count() // block_pairs)
        for number in range(blocks):
            of_block = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).collect()
            if not of_block:
                continue
            item_ids = sorted({row["item_id"] for row in of_block}, key=lambda i: (i is None, i))
            vocabulary = sorted({bytes(row["term"]) for row in of_block})
            item_at, term_at = ({x: i for i, x in enumerate(xs)} for xs in (item_ids, vocabulary))
            postings = np.array(sorted((term_at[bytes(row["term"])], item_at[row["item_id"]]) for row in of_block), dtype=np.int64)
            starts = np.searchsorted(postings[:, 0], np.arange(len(vocabulary) + 1))

            bags = staging.keep(texts.mapInArrow(_bags(spark.sparkContext.broadcast(vocabulary)), "doc_id long, n long, bag binary"))
            total = bags.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
            if not total["documents"]:
                break
            counted = bags.select("bag").mapInArrow(_document_frequencies(len(vocabulary)), "term long, df long")
            weights = np.zeros(len(vocabulary), dtype=np.int64)
            for row in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():
                weights[row["term"]] = weight(total["documents"], row["df"])

            norm = length_norm(F.col("n"), total["documents"], total["length"])
            block = spark.sparkContext.broadcast((item_ids, starts, postings[:, 1].copy(), weights))
            best = classes(bags, norm, k).mapInArrow(_scorer(block, k), "item_id long, doc_id long, score long")
            found = found.unionByName(staging.keep(best))
            staging.drop(bags)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
