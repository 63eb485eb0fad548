"""Toxicity: maximum-scoring segments of token log-odds, calibrated by extreme values.

Tokens score by the log-odds of occurring in toxic documents, under Dirichlet priors: the share
of a token is drawn towards that of its stem, and that of a stem towards the classes' own shares.
Scores are shifted so that ordinary text sums downwards. A linear-time scan finds all maximal
segments of a text; how high they reach in clean texts of its length follows an extreme-value
law, which turns each into an expected number of chance finds. Their sum over a text is mapped to
a probability on labelled rows that the token counts have not seen.

The model has a fixed size (hashed tables of tokens and stems) and is sent to the tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import hash52

TOKEN_BITS, STEM_BITS = 20, 16
STEM_BYTES = 5
#: Strength of the priors, in documents.
TOKEN_PRIOR, STEM_PRIOR = 10.0, 20.0
#: What every token costs, so that segments end.
DRIFT = 0.5
#: Bounds of the fit: expected number of sampled toxic and clean documents.
SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 10000
#: Part of the sample that calibrates and is not counted.
CALIBRATION_SHARE = 0.3
#: A passage is significant when clean text of that length has fewer finds as high, on average.
SIGNIFICANT = 0.01

PASSAGES = "array<struct<first_word:int,last_word:int,score:double,expected:double>>"

#: ASCII punctuation ends tokens, as white space does; letters A-Z are lower-cased.
_TABLE = bytes(
    32 if chr(i) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else i for i in range(256)
)


def tokens(text: bytes | None) -> list[bytes]:
    return text.lower().translate(_TABLE).split() if text else []


def token_ids(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed token and hashed stem of each word."""
    crc = zlib.crc32
    token = np.array([crc(w) for w in words], dtype=np.int64) & ((1 << TOKEN_BITS) - 1)
    stem = np.array([crc(w[:STEM_BYTES], 1) for w in words], dtype=np.int64) & ((1 << STEM_BITS) - 1)
    return token, stem


def occurrence(ids: np.ndarray) -> np.ndarray:
    """1 for the first time a token occurs in a text, 2 for the second, and so on. Tokens are
    counted once per document, so a word said again is less evidence than one not yet said."""
    order = np.argsort(ids, kind="stable")
    ordered = ids[order]
    start = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    rank = np.arange(len(ids)) - np.repeat(start, np.diff(np.append(start, len(ids)))) + 1
    found = np.empty(len(ids), dtype=np.int64)
    found[order] = rank
    return found


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence, in order, in linear time.

    Each is positive, and none can be lengthened or shortened to its gain. Runs of positive
    scores enter one by one; a run joins the nearest earlier segment that starts lower, as long
    as that ends lower than the run. Links to that segment skip what has been passed already.
    """
    positive = scores > 0
    if not positive.any():
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], positive, [False]]).astype(np.int8)))
    first: list[int] = []
    last: list[int] = []
    lower: list[int] = []
    for start, end in edges.reshape(-1, 2).tolist():
        a, b = start, end
        at = len(first) - 1
        while True:
            while at >= 0 and sums[first[at]] >= sums[a]:
                at = lower[at]
            if at < 0 or sums[last[at]] >= sums[b]:
                break
            a, at_next = first[at], lower[at]
            del first[at:], last[at:], lower[at:]
            at = at_next
        first.append(a)
        last.append(b)
        lower.append(at)
    return [(a, b - 1, float(sums[b] - sums[a])) for a, b in zip(first, last, strict=True)]


@dataclass
class ToxicityModel:
    """Counts, the constants of the extreme-value law, and those of the last mapping."""

    token_toxic: np.ndarray
    token_all: np.ndarray
    stem_share: np.ndarray
    base: float = 0.0
    decay: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    intercept: float = -20.0

    def segments(self, text: bytes | None) -> tuple[int, list[tuple[int, int, float]]]:
        words = tokens(text)
        if not words:
            return 0, []
        token, stem = token_ids(words)
        share = (self.token_toxic[token] + TOKEN_PRIOR * self.stem_share[stem]) / (self.token_all[token] + TOKEN_PRIOR)
        scores = (np.log(share / (1 - share)) - self.base) / occurrence(token)
        return len(words), maximal_segments(scores - DRIFT)

    def evidence(self, words: int, found: list[tuple[int, int, float]]) -> float:
        """Minus the logarithm of the expected chance finds, segments combined."""
        reach = np.array([score for _, _, score in found] or [0.0]) * self.decay
        top = reach.max()
        return float(top + np.log(np.exp(reach - top).sum()) - np.log(max(words, 1)) - self.log_k)

    def probability(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * evidence + self.intercept, -500, 500))))

    def score(self, text: bytes | None) -> tuple[float, list[tuple[int, int, float, float]]]:
        words, found = self.segments(text)
        passages = []
        for first, last, reach in found:
            expected = float(np.exp(np.log(max(words, 1)) + self.log_k - self.decay * reach))
            if expected < SIGNIFICANT:
                passages.append((first, last, reach, expected))
        return self.probability(self.evidence(words, found)), passages


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and clean document counts per hashed token, and per hashed stem below zero, over one task."""
    tables = [(np.zeros(1 << TOKEN_BITS, np.int32), np.zeros(1 << STEM_BITS, np.int32)) for _ in range(2)]
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
            words = list(set(tokens(text.as_py())))
            if words:
                token, stem = token_ids(words)
                tables[toxic.as_py()][0][np.unique(token)] += 1
                tables[toxic.as_py()][1][np.unique(stem)] += 1
    (clean_token, clean_stem), (toxic_token, toxic_stem) = tables
    at, of = np.flatnonzero(clean_token + toxic_token), np.flatnonzero(clean_stem + toxic_stem)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([at, -1 - of])),
            pa.array(np.concatenate([toxic_token[at], toxic_stem[of]]).astype(np.int64)),
            pa.array(np.concatenate([clean_token[at], clean_stem[of]]).astype(np.int64)),
        ],
        names=["bucket", "toxic", "clean"],
    )


def _without_evidence() -> ToxicityModel:
    return ToxicityModel(np.zeros(1 << TOKEN_BITS, np.float32), np.zeros(1 << TOKEN_BITS, np.float32), np.full(1 << STEM_BITS, 0.5))


def _tables(counts, prior: float) -> ToxicityModel:
    """The model's tables from document counts; ``prior`` is the toxic share of those counted."""
    model = _without_evidence()
    is_token = counts["bucket"] >= 0
    rows = counts[is_token]
    model.token_toxic[rows["bucket"]] = rows["toxic"]
    model.token_all[rows["bucket"]] = rows["toxic"] + rows["clean"]
    toxic, total = np.zeros(1 << STEM_BITS), np.zeros(1 << STEM_BITS)
    rows = counts[~is_token]
    toxic[-1 - rows["bucket"]] = rows["toxic"]
    total[-1 - rows["bucket"]] = rows["toxic"] + rows["clean"]
    model.stem_share = (toxic + STEM_PRIOR * prior) / (total + STEM_PRIOR)
    model.base = float(np.log(prior / (1 - prior)))
    return model


def _extreme_law(best: np.ndarray, words: np.ndarray) -> tuple[float, float]:
    """Decay and log K of the highest segment in clean texts: ``exp(-K n exp(-decay S))``, from
    the quartiles of what remains once the logarithm of the length is taken off. Quartiles do not
    mind a few mislabelled texts."""
    decay, log_n = 1.0, np.log(np.maximum(words, 1))
    if len(best) < 20:
        return decay, 0.0
    # quantiles of the standard law: -ln(-ln p)
    low, high = -np.log(-np.log(0.25)), -np.log(-np.log(0.75))
    for _ in range(20):
        q1, q3 = np.quantile(best - log_n / decay, [0.25, 0.75])
        decay = float(np.clip((high - low) / max(q3 - q1, 1e-3), 0.2, 5.0))
    middle = np.median(best - log_n / decay)
    # at the median, K n exp(-decay S) is ln 2
    return decay, float(decay * middle + np.log(np.log(2)))


def _mapping(evidence: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton steps with a weak pull to 0."""
    center, scale = float(np.mean(evidence)), float(np.std(evidence) or 1.0)
    x = np.stack([(evidence - center) / scale, np.ones_like(evidence)], axis=1)
    w, pull = np.zeros(2), np.diag([0.05, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - toxic)) + pull @ w
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + pull
        step = np.linalg.solve(curvature, gradient)
        w = w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    slope = max(float(w[0] / scale), 0.0)
    return slope, float(w[1] - slope * center)


def train(docs: DataFrame, labelled: DataFrame) -> ToxicityModel:
    """Fit on documents (doc_id, text) with labels (doc_id, toxic 0 or 1), NULLs left out.

    All labels are counted; about ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` of them, by a hash of
    the id, are read with their texts. That sample is bounded, so it is broadcast and the
    documents are not shuffled. Without documents of both classes every score is the share of
    toxic labels, 0 without any.

    Defined cases: an id that repeats among the labels is toxic if any of its rows is; documents
    that repeat an id are each an example; a NULL or empty text is an example without tokens.
    """
    labels = (
        labelled.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sizes = {row["toxic"]: row["n"] for row in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    empty = _without_evidence()
    share = n_toxic / max(n_toxic + n_clean, 1)
    empty.intercept = float(np.log(share / (1 - share))) if 0 < share < 1 else (20.0 if share else -20.0)
    if not n_toxic or not n_clean:
        return empty
    chances = {1: min(1.0, SAMPLE_TOXIC / n_toxic), 0: min(1.0, SAMPLE_CLEAN / n_clean)}
    draw = hash52(F.col("doc_id"), F.lit("toxicity")).cast("double") / float(2**52)
    chance = F.when(F.col("toxic") == 1, chances[1]).otherwise(chances[0])
    sample = labels.where(draw < chance).select("doc_id", "toxic", (draw / chance < CALIBRATION_SHARE).alias("calibrates"))
    read = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(sample), "doc_id")

    counted = read.where(~F.col("calibrates")).select("text", "toxic")
    counts = (
        counted.mapInArrow(_frequencies, "bucket long, toxic long, clean long")
        .groupBy("bucket")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .toPandas()
    )
    sampled_toxic, sampled_clean = n_toxic * chances[1], n_clean * chances[0]
    model = _tables(counts, sampled_toxic / (sampled_toxic + sampled_clean))
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_tables = ToxicityModel(**shared.value)
        for batch in batches:
            found = [of_tables.segments(text.as_py()) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array([words for words, _ in found], pa.int32()),
                    pa.array([sorted((s[2] for s in each), reverse=True) for _, each in found], pa.list_(pa.float64())),
                ],
                names=["toxic", "words", "reach"],
            )

    held = (
        read.where("calibrates")
        .select("text", "toxic")
        .mapInArrow(measure, "toxic int, words int, reach array<double>")
        .toPandas()
    )
    held = held[held["words"] > 0]
    best = held["reach"].map(lambda reach: reach[0] if len(reach) else 0.0).to_numpy(dtype=float)
    words, toxic = held["words"].to_numpy(), held["toxic"].to_numpy(dtype=float)
    if not (toxic == 1).any() or not (toxic == 0).any():
        model.intercept = empty.intercept
        return model
    model.decay, model.log_k = _extreme_law(best[toxic == 0], words[toxic == 0])
    evidence = np.array(
        [model.evidence(n, [(0, 0, s) for s in reach]) for n, reach in zip(words, held["reach"], strict=True)]
    )
    # back to the classes' own shares, which the sample has changed
    weight = np.where(toxic == 1, 1 / chances[1], 1 / chances[0])
    model.slope, model.intercept = _mapping(evidence, toxic, weight / weight.mean())
    return model


def score_documents(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score (0 to 1, the likelihood of label 1), predicted (1 from
    0.5), passages (significant segments: first and last word from 0, score, expected finds).

    Defined cases: a NULL or empty text, or one without words, scores what a text without any
    segment does; repeated rows get a row each; texts are read whole; an empty table gives an
    empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())])
        )
        model = ToxicityModel(**shared.value)
        for batch in batches:
            found = [model.score(text.as_py()) for text in batch.column(1)]
            passages = [
                [dict(zip(("first_word", "last_word", "score", "expected"), p, strict=True)) for p in each] for _, each in found
            ]
            scores = np.array([score for score, _ in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32)), pa.array(passages, kind)],
                names=["doc_id", "score", "predicted", "passages"],
            )

    return rows.mapInArrow(run, f"doc_id long, score double, predicted int, passages {PASSAGES}")


def without_toxic(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text") -> DataFrame:
    """The documents, all columns, that score below 0.5. Each goes by its own text, so nothing is
    joined or shuffled.

    Defined cases: a NULL text is scored like an empty one; rows that repeat a text go or stay
    alike; texts are read whole; an empty table gives an empty result; columns of any name stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ToxicityModel(**shared.value)
        for batch in batches:
            keep = []
            for text in batch.column(place):
                value = text.as_py()
                keep.append(model.score(value.encode() if value is not None else None)[0] < 0.5)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
