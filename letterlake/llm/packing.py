"""Best-fit packing of token pieces into sequences of bounded length.

Each task packs the documents it reads as they come. A fixed number of sequences is open at a time,
in a bitset with one bit per amount of free space: the lowest bit at or above a piece's length is the
tightest fit. When nothing fits and all places are taken, the fullest sequence closes. A task holds
the open sequences' numbers and nothing else, and needs no other task: no shuffle, and a lost task
is repeated alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from letterlake.llm.common import table, text_or_empty
from letterlake.llm.tokens import Encoder, vocabulary_path

SEQUENCE_TOKENS = 1024
OPEN_SEQUENCES = 4096
END_TOKEN = 2

SCHEMA = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
)


class BestFit:
    """Online best fit with a bounded number of open sequences.

    ``place(length)`` gives (sequence, offset). ``bits`` has bit f set while a sequence with f free
    tokens is open; ``free[f]`` lists those sequences.
    """

    def __init__(self, capacity: int, open_limit: int, first: int = 0) -> None:
        self.capacity, self.open_limit, self.next = capacity, open_limit, first
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0
        self.open = 0

    def _take(self, space: int) -> int:
        sequence = self.free[space].pop()
        if not self.free[space]:
            self.bits &= ~(1 << space)
        self.open -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            sequence = self._take(space)
        else:
            if self.open >= self.open_limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            space, sequence = self.capacity, self.next
            self.next += 1
        left = space - length
        if left:
            self.free[left].append(sequence)
            self.bits |= 1 << left
            self.open += 1
        return sequence, self.capacity - space


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, the first one shorter if need be."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((start, capacity) for start in range(first, n, capacity))]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = SEQUENCE_TOKENS,
    open_sequences: int = OPEN_SEQUENCES,
    vocabulary: str | None = None,
    end_token: int = END_TOKEN,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its text's tokens and ``end_token``; a null or empty text is the end token alone.
    ``with_ids`` adds the piece's tokens, to write sequences from. Null and repeated ids are carried
    as they are. An empty table gives no rows.
    """
    path = vocabulary or vocabulary_path()
    schema = SCHEMA + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        fit = BestFit(capacity, open_sequences, TaskContext.get().partitionId() << 33)
        for batch in batches:
            out: list[list] = [[] for _ in range(7 + with_ids)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encoder.ids(text), np.uint32(end_token)).astype("<u4", copy=False)
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start : start + length]
                    row = (doc_id, piece, start, length, zlib.crc32(part.tobytes()), *fit.place(length))
                    for column, value in zip(out, row, strict=False):
                        column.append(value)
                    if with_ids:
                        out[7].append(part)
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 5, *[pa.list_(pa.int32())] * with_ids]
            names = [field.split(" ")[0] for field in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    source = docs.select(docs[id_col].cast("bigint").alias("doc_id"), text_or_empty(docs[text_col]).alias("text"))
    return source.mapInArrow(run, schema)


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
