"""SentencePiece encoding and decoding over a table of distinct chunks.

No piece of the model holds a white-space marker after another character, so merges never cross
the places where a marker follows one. A normalised text cut there into chunks (a run of markers
and what follows) encodes chunk by chunk. Each task keeps a table of the distinct chunks it has
met, segments each of them once with the library, and joins ids and decoded text back to the
documents by position. There is no shuffle, and the table is emptied when it is full, so memory
does not grow with the input.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"

#: Entries of a task's table before it is emptied, about 60 MB. Results do not depend on it.
TABLE_ENTRIES = 200_000

OUTPUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
WITH_TEXT = "doc_id long, n_tokens long, ids array<int>, decoded string"


class ChunkTable:
    """Distinct chunk -> ids, ids as text, decoded text."""

    CHUNK = re.compile(f"{MARK}+[^{MARK}]*")

    def __init__(self, model_path: str, entries: int = TABLE_ENTRIES):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.entries = entries
        self.table: dict[str, tuple[list[int], str, str]] = {}
        self.end = self.model.eos_id()
        crossing = re.compile(f"[^{MARK}]{MARK}")
        if any(crossing.search(self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())):
            raise ValueError("this model has pieces that cross white-space markers")
        if self.model.normalize("a") != f"{MARK}a" or self.model.normalize(" a  b ") != f"{MARK}{MARK}a{MARK}{MARK}b{MARK}":
            raise ValueError("this model does not keep white space or adds no marker in front")

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text, in order; none for an empty one."""
        return self.CHUNK.findall(self.model.normalize(text)) if text else []

    def learn(self, chunks: set[str]) -> None:
        new = [chunk for chunk in chunks if chunk not in self.table]
        if len(self.table) + len(new) > self.entries:
            self.table = {}
            new = list(chunks)
        # the library puts one marker in front by itself, but none before an empty text
        encoded = self.model.encode([chunk[1:] for chunk in new], num_threads=1) if new else []
        encoded = [[self.model.piece_to_id(MARK)] if chunk == MARK else ids for chunk, ids in zip(new, encoded, strict=True)]
        decoded = self.model.decode(encoded, num_threads=1) if new else []
        for chunk, ids, text in zip(new, encoded, decoded, strict=True):
            self.table[chunk] = (ids, " ".join(map(str, ids)), " " + text)

    def lookup(self, texts: list[str]) -> Iterator[list[tuple[list[int], str, str]]]:
        for text in texts:
            chunks = self.chunks(text)
            self.learn(set(chunks))
            table = self.table
            yield [table[chunk] for chunk in chunks]


def _decoded(found: list[tuple[list[int], str, str]]) -> str:
    # decoding drops the marker that encoding put in front of the text
    return "".join([entry[2] for entry in found])[1:]


def encode(
    docs: DataFrame,
    model_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    entries: int = TABLE_ENTRIES,
    digests: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_tokens and either ids and decoded text or, with
    ``digests``, their SHA-256.

    ids are those of the library for the whole text, then the end id; decoded is what its
    ``decode`` gives for them. ``model_path`` must exist on every executor.

    Defined cases: a NULL text is an empty one, and an empty one has the end id alone and decodes
    to an empty text; repeated rows each give a row; NULL ids stay NULL; texts of any length are
    encoded whole; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    schema = OUTPUT if digests else WITH_TEXT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model_path, entries)
        end = table.end
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                count, first, second = [], [], []
                for found in table.lookup(part.column(1).to_pylist()):
                    decoded = _decoded(found)
                    count.append(sum(len(entry[0]) for entry in found) + 1)
                    if digests:
                        ids = " ".join([entry[1] for entry in found] + [str(end)])
                        first.append(hashlib.sha256(ids.encode()).hexdigest())
                        second.append(hashlib.sha256(decoded.encode()).hexdigest())
                    else:
                        first.append([i for entry in found for i in entry[0]] + [end])
                        second.append(decoded)
                kind = pa.string() if digests else pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(count, pa.int64()), pa.array(first, kind), pa.array(second, pa.string())],
                    names=[field.split(" ")[0] for field in schema.split(", ")],
                )

    return rows.mapInArrow(run, schema)
