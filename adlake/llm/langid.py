"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

N-grams of one to three characters are hashed into ``BUCKETS`` features. Document frequencies
come from all training texts. Weights are fitted by follow-the-regularised-leader with elastic-net
penalties on a bounded sample of labelled rows, part of which is held back to calibrate a
temperature. The model has a fixed size and is sent to the tasks that predict.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import hash52

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Bounds of the fit: expected number of sampled rows in all, but at least so many per language.
#: Every language is learned. While it is fitted the model takes 0.8 MB per language on the driver.
SAMPLE_ROWS = 2000
LEAST_ROWS = 20
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
CALIBRATION_SHARE = 0.25

UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")


def _codes(text: str) -> np.ndarray:
    """Code points in lower case, everything but letters a space (and one at either end)."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = ((points >= 97) & (points <= 122)) | (points > 127)
    return np.where(letter, points, 32).astype(np.uint64)


def term_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that a text's n-grams fall into, ascending, and how many do."""
    points = _codes(text)
    total = np.zeros(BUCKETS, dtype=np.int64)
    for order in ORDERS:
        # a text of any length is counted whole, block by block
        for start in range(0, max(len(points) - order + 1, 0), 1 << 20):
            block = points[start : start + (1 << 20) + order - 1]
            size = len(block) - order + 1
            mixed = np.full(size, order, dtype=np.uint64)
            for i in range(order):
                mixed = (mixed ^ block[i : i + size]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            spaces = np.ones(size, dtype=bool)
            for i in range(order):
                spaces &= block[i : i + size] == 32
            buckets = (mixed >> np.uint64(49)).astype(np.int64)[~spaces]
            total += np.bincount(buckets, minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


def vector(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = (1 + np.log(counts)) * idf[buckets]
    length = np.sqrt((weights * weights).sum())
    return weights / length if length > 0 else weights


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max())
    return e / e.sum()


class Ftrl:
    """Multinomial logistic regression; per coordinate the regularised leader in closed form.
    The last feature is the bias, which is not penalised."""

    def __init__(self, features: int, classes: int):
        self.z = np.zeros((features + 1, classes))
        self.n = np.zeros((features + 1, classes))

    def weights(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        free = np.zeros(len(z), dtype=bool)
        free[-1] = True
        l1 = np.where(free, 0.0, L1)[:, None]
        l2 = np.where(free, 0.0, L2)[:, None]
        shrunk = np.sign(z) * l1 - z
        return np.where(np.abs(z) <= l1, 0.0, shrunk / ((BETA + np.sqrt(n)) / ALPHA + l2))

    def learn(self, buckets: np.ndarray, x: np.ndarray, label: int) -> None:
        rows, x = np.append(buckets, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(rows)
        error = _softmax(x @ w)
        error[label] -= 1
        gradient = x[:, None] * error[None, :]
        squared = gradient * gradient
        self.z[rows] += gradient - (np.sqrt(self.n[rows] + squared) - np.sqrt(self.n[rows])) / ALPHA * w
        self.n[rows] += squared


def temperature(logits: list[np.ndarray], labels: list[int]) -> float:
    """The divisor of logits under which held-back labels are likeliest; 1 without any."""
    if not logits:
        return 1.0
    stacked = np.stack(logits)
    stacked = stacked - stacked.max(axis=1, keepdims=True)
    right = stacked[np.arange(len(labels)), labels]

    def loss(t: float) -> float:
        return float(np.mean(np.log(np.exp(stacked / t).sum(axis=1)) - right / t))

    grid = np.geomspace(0.05, 20, 121)
    return float(grid[np.argmin([loss(t) for t in grid])])


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not LETTER.search(text):
            return UNDETERMINED, 0.0
        buckets, counts = term_counts(text)
        x = vector(buckets, counts, self.idf)
        shares = _softmax((x @ self.weights[buckets] + self.weights[-1]) / self.temperature)
        best = int(shares.argmax())
        return self.languages[best], float(shares[best])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequency per bucket over one task, and the number of documents as bucket -1."""
    frequency, documents = np.zeros(BUCKETS, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            frequency[term_counts(text.as_py())[0]] += 1
            documents += 1
    seen = np.flatnonzero(frequency)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(seen, -1)), pa.array(np.append(frequency[seen], documents))], names=["bucket", "n"]
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [term_counts(text.as_py()) for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                pa.array([c[0].astype(np.int32) for c in counts], pa.list_(pa.int32())),
                pa.array([c[1].astype(np.int32) for c in counts], pa.list_(pa.int32())),
            ],
            names=["lang", "draw", "buckets", "counts"],
        )


def train(labelled: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit on rows (row_id, text, lang), those with NULLs left out.

    Document frequencies cover all rows; the regression sees about ``sample_rows`` of them, the
    same number per language as far as there are, chosen by a hash of row_id.

    Defined cases: a text that is empty or has no letter counts for the document frequencies and
    is learned as any other; rows that repeat a row_id are drawn together; an empty table gives
    a model without languages; other columns are ignored.
    """
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    languages = sorted(row["lang"] for row in sizes)
    if not languages:
        return LanguageModel([], np.zeros(BUCKETS), np.zeros((BUCKETS + 1, 0)), 1.0)
    df = rows.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    documents = int(df.loc[df["bucket"] == -1, "n"].iloc[0])
    seen = df[df["bucket"] >= 0]
    idf = np.full(BUCKETS, np.log(documents + 1.0) + 1)
    idf[seen["bucket"]] = np.log((documents + 1.0) / (seen["n"] + 1.0)) + 1

    draw = hash52(F.col("row_id"), F.lit("langid")).cast("double") / float(2**52)
    each = max(sample_rows / len(languages), LEAST_ROWS)
    # one literal, since an expression per language would not compile for many
    chances = json.dumps({row["lang"]: min(1.0, each / row["n"]) for row in sizes})
    chance = F.from_json(F.lit(chances), "map<string,double>")
    sampled = rows.select("lang", "text", draw.alias("draw"), chance[F.col("lang")].alias("chance")).where(F.col("draw") < F.col("chance"))
    # scaled to its language's chance, the draw of a sampled row is uniform again
    taken = (
        sampled.select("lang", "text", (F.col("draw") / F.col("chance")).alias("draw"))
        .mapInArrow(_counted, "lang string, draw double, buckets array<int>, counts array<int>")
        .toPandas()
        .sort_values(["draw", "lang"])
    )
    return _fitted(languages, idf, taken)


def _fitted(languages: list[str], idf: np.ndarray, taken: pd.DataFrame) -> LanguageModel:
    number = {name: i for i, name in enumerate(languages)}
    examples = [
        (np.asarray(b), vector(np.asarray(b), np.asarray(c, dtype=float), idf), number[lang])
        for lang, b, c in zip(taken["lang"], taken["buckets"], taken["counts"], strict=True)
    ]
    # every so manieth row calibrates; all rows fit where there are too few to hold any back
    step = round(1 / CALIBRATION_SHARE)
    back = examples[::step] if len(examples) >= 20 * len(languages) else []
    fit = [e for i, e in enumerate(examples) if not back or i % step]
    model = Ftrl(BUCKETS, len(languages))
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(fit)):
            model.learn(*fit[i])
    weights = model.weights()
    t = temperature([x @ weights[b] + weights[-1] for b, x, _ in back], [label for _, _, label in back])
    return LanguageModel(languages, idf, weights, t)


def identify(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score (the calibrated probability of lang_pred).

    Defined cases: a text that is NULL, empty or has no letter is ``und`` with score 0, and so is
    every text under a model without languages; ties go to the language first by name; repeated
    rows get a row each; texts are read whole; an empty table gives an empty result; other
    columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(**shared.value)
        for batch in batches:
            found = [model.predict(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo a number of folds."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), F.lit(folds))
