"""From raw documents to token ids: toxicity, near duplicates, secrets, mixing, SentencePiece.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the
last return the columns of ``documents``. Rows without an id are kept through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import langid, mixing, neardup, secrets, sentencepieces, toxicity
from adlake.llm.common import Staging, staging_deleted
from adlake.llm.queries import PIECES, table

#: SQL cannot express the learned model, the near-duplicate join or the tokenizer.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels outside the held-out fold and drops documents of score 0.5 or more.

    A document goes by its own text, so the model travels to the rows and nothing is joined.
    Rows without a text or an id are scored like an empty or any other text; repeated rows go or
    stay alike; without labels of both kinds nothing goes.
    """
    held_out = langid.fold(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group, and of rows that repeat an id one,
    always the same. Rows without an id stay; an empty table gives an empty one."""
    return neardup.without_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces the secrets of every document; all documents stay, a NULL text as it is, repeated
    rows alike, other columns untouched."""
    return secrets.without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the weights of the sources ask. A NULL source is a source,
    repeated rows are documents of their own; a source without words is not taken."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per row, and the digest of the text that decodes from them. A NULL text is an
    empty one; repeated rows get a row each."""
    encoded = sentencepieces.encode(docs, public_tokenizers.path(PIECES))
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again.

    What a stage has staged, and the copy that it has read, are deleted once its own result is
    written. The last stage is left to the caller, so the copy that it reads stays.
    """
    staging = Staging(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        with staging_deleted(spark):
            docs = staging.keep(stage(spark, docs, sf_dir))
        if before is not None:
            staging.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
