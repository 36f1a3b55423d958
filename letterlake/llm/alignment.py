"""Alignment of two tokenizers' tokens over a corpus.

Every text is encoded by a byte-level vocabulary (A) and by one of pieces (B). Byte offsets where
tokens of both end cut them into groups; tokens whose byte ranges overlap are linked. An overlap is
one stretch between neighbouring ends of either side, so links are found by one merge of the ends.

* **Identity map.** For each A id, the B id of the same bytes is looked up beforehand. A group of one
  such pair needs no pair: it is counted in a vector as long as the vocabulary.
* **Irregular links** become pairs, counted within a block of documents before they are shuffled.
  A block numbers its pairs, and its documents' links are kept as these numbers, so a second
  encoding is not needed: pairs go to their corpus-wide counts and come back to the block, never to
  every document. A block holds about ``BLOCK_CHARS`` characters, so what returns to it is bounded; one
  longer text is a block of its own.

Broadcast are two arrays as long as the vocabulary and the highest count of each B id.

A null or empty text has no tokens, as has one that either side does not give back byte for byte.
Null and repeated ids are carried as they are, each row counting for itself. Equal counts are all the
highest. An empty table gives no rows. Input columns beside id and text are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterlake.llm.common import kept, table, text_or_empty
from letterlake.llm.tokens import Encoder, vocabulary_path

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_CHARS = 16 * 1024 * 1024
# Links whose counts are looked up at once: a batch of rows can hold some ten million.
SUMMED = 1 << 19
DOCUMENT, PAIR, REGULAR = 0, 1, 2
STATISTICS = ("n_a", "n_b", "n_groups", "n_links")
KEPT = (
    "kind int, block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, links array<int>, number int, a int, b int, count bigint"
)
NAMES = [field.split(" ")[0] for field in KEPT.split(", ")]
TYPES = [pa.int32(), *[pa.int64()] * 6, pa.string(), pa.list_(pa.int32()), *[pa.int32()] * 3, pa.int64()]


def byte_level() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones for themselves, the rest from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {**{chr(byte): byte for byte in plain}, **{chr(256 + at): byte for at, byte in enumerate(others)}}


class Aligner:
    """Both vocabularies, their tokens' bytes, and the identity map between them."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import json

        import sentencepiece

        self.encoder = Encoder(path_a, plain=True)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        with open(path_a, encoding="utf-8") as file:
            vocabulary = json.load(file)
        entries = dict(vocabulary["model"]["vocab"]) | {t["content"]: t["id"] for t in vocabulary.get("added_tokens", [])}
        byte_of = byte_level()
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.bytes_a[number] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        self.bytes_b = []
        for number in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(number)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(number) else piece.replace("▁", " ").encode())
        self.lengths_a = np.array([len(entry) for entry in self.bytes_a], dtype=np.int64)
        self.lengths_b = np.array([len(entry) for entry in self.bytes_b], dtype=np.int64)
        # Of equal bytes the last id: a piece rather than the single byte, which precede the pieces.
        same = {entry: number for number, entry in enumerate(self.bytes_b)}
        self.identity = np.array([same.get(entry, -1) if entry else -1 for entry in self.bytes_a], dtype=np.int64)
        # Decimal ids with what follows them: another id of the side, the end of it, the next group.
        self.written = [f"{number}{mark}" for mark in ",|;" for number in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.n_written = len(self.written) // 3

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or nothing where one of them does not give the text back."""
        if not text:
            return None
        whole = " " + text
        data = whole.encode("utf-8", "replace")
        a = self.encoder.ids(whole).astype(np.int64)
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != data:
            return None
        numbers = self.pieces.encode(text, num_threads=1)
        if b"".join(map(self.bytes_b.__getitem__, numbers)) != data:
            return None
        return a, np.array(numbers, dtype=np.int64)

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[int, str, np.ndarray, np.ndarray]:
        """(groups, digest, A ids of identity groups, other links as a * |B| + b)."""
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        at_b = np.searchsorted(ends_b, ends_a)  # the B token that covers an A token's last byte
        shared_a = ends_b[at_b] == ends_a
        at_a = np.searchsorted(ends_a, ends_b)
        shared_b = ends_a[at_a] == ends_b
        # Where each id stands in the written groups: all of the other side's before its group, too.
        groups_before_a = np.cumsum(shared_a) - shared_a
        groups_before_b = np.cumsum(shared_b) - shared_b
        last_a, last_b = np.flatnonzero(shared_a), np.flatnonzero(shared_b)
        b_until = np.concatenate(([0], last_b + 1))
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + b_until[groups_before_a]] = a + self.n_written * shared_a
        order[np.arange(len(b)) + (last_a + 1)[groups_before_b]] = b + 2 * self.n_written * shared_b
        groups = "".join(map(self.written.__getitem__, order.tolist()))[:-1]
        # One link for each stretch between neighbouring ends: those of A, and those of B that are not A's.
        first = np.concatenate(([True], shared_a[:-1]))
        alone_a = shared_a & first
        alone_b = shared_b & np.concatenate(([True], shared_b[:-1]))
        same = alone_a & alone_b[at_b] & (self.identity[a] == b[at_b])
        width = len(self.bytes_b)
        others = np.concatenate((a[~same] * width + b[at_b[~same]], a[at_a[~shared_b]] * width + b[~shared_b]))
        return len(last_a), hashlib.sha256(groups.encode()).hexdigest(), a[same], others


@cache
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


class _Block:
    """The pairs of a block in the order they came, with their counts."""

    def __init__(self, number: int) -> None:
        self.number, self.chars = number, 0
        self.codes, self.numbers, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def add(self, codes: np.ndarray) -> np.ndarray:
        """Counts the pairs and gives the number of each."""
        distinct, back, counts = np.unique(codes, return_inverse=True, return_counts=True)
        at = np.searchsorted(self.codes, distinct)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == distinct[known]
        fresh = np.arange((~known).sum(), dtype=np.int32) + len(self.counts)
        numbers = np.empty(len(distinct), np.int32)
        numbers[known], numbers[~known] = self.numbers[at[known]], fresh
        self.counts = np.concatenate((self.counts, np.zeros(len(fresh), np.int64)))
        self.counts[numbers] += counts
        self.codes = np.insert(self.codes, at[~known], distinct[~known])
        self.numbers = np.insert(self.numbers, at[~known], fresh)
        return numbers[back]


def _rows(n: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind) for name, kind in zip(NAMES, TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=NAMES)


def _pair_rows(block: _Block, width: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(block.codes), 50_000):
        codes, numbers = block.codes[at : at + 50_000], block.numbers[at : at + 50_000]
        n = len(codes)
        yield _rows(
            n, kind=np.full(n, PAIR), block=np.full(n, block.number), number=numbers, a=codes // width, b=codes % width, count=block.counts[numbers]
        )


def _encoded(paths: tuple[str, str], block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*paths)
        width, size_a = len(aligner.bytes_b), len(aligner.bytes_a)
        first = TaskContext.get().partitionId() << 32
        block, regular = _Block(first), np.zeros(size_a, np.int64)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                rows, codes, spans = [], [], []
                began = at
                while at < len(texts) and (at == began or len(rows) < 2000 and block.chars < block_chars):
                    text = texts[at]
                    block.chars += len(text)
                    both = aligner.encode(text)
                    if both is None:
                        rows.append((0, 0, 0, 0, ""))
                        spans.append((np.zeros(0, np.int64), 0))
                    else:
                        groups, digest, same, others = aligner.align(*both)
                        rows.append((len(both[0]), len(both[1]), groups, len(same) + len(others), digest))
                        spans.append((same, len(others)))
                        codes.append(others)
                        regular += np.bincount(same, minlength=size_a)
                    at += 1
                numbers = block.add(np.concatenate(codes or [np.zeros(0, np.int64)])) + size_a
                links, used = [], 0
                for same, n in spans:
                    links.append(np.concatenate((same, numbers[used : used + n])).astype(np.int32))
                    used += n
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in links]))).astype(np.int32)
                columns = dict(zip((*STATISTICS, "groups_sha256"), zip(*rows, strict=True), strict=True))
                n = len(rows)
                yield _rows(
                    n,
                    kind=np.full(n, DOCUMENT),
                    block=np.full(n, block.number),
                    doc_id=ids[began:at],
                    links=pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(links))),
                    **columns,
                )
                if block.chars >= block_chars:
                    yield from _pair_rows(block, width)
                    block = _Block(block.number + 1)
        yield from _pair_rows(block, width)
        used = np.flatnonzero(regular)
        n = len(used)
        yield _rows(n, kind=np.full(n, REGULAR), a=used, b=aligner.identity[used], count=regular[used])

    return run


def _sums(links: pa.ListArray, counts: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's sums of its links' counts and flags, ``SUMMED`` links at a time."""
    offsets, flat = links.offsets.to_numpy(), links.values.to_numpy()
    sums = np.zeros(len(links), np.int64), np.zeros(len(links), np.int64)
    sizes = np.diff(offsets)
    for at in range(int(offsets[0]), int(offsets[-1]), SUMMED):
        until = min(at + SUMMED, int(offsets[-1]))
        # The documents with links here; one that goes on beyond the piece is added to again.
        first, last = np.searchsorted(offsets, [at, until - 1], "right") - 1
        rows = np.arange(first, last + 1)[sizes[first : last + 1] > 0]
        starts = np.maximum(offsets[rows], at) - at
        for total, values in zip(sums, (counts, best), strict=True):
            total[rows] += np.add.reduceat(values[flat[at:until]], starts, dtype=np.int64)
    return sums


def _scored(size_a: int, shared):
    """Documents of each block with their links' counts, read after the block's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = shared.value
        block, own_counts, own_best, parts = None, None, None, []
        for batch in batches:
            column = {name: batch.column(at) for at, name in enumerate(batch.schema.names)}
            blocks, kinds = column["block"].to_numpy(), column["kind"].to_numpy()
            cuts = np.flatnonzero(np.diff(blocks) | np.diff(kinds)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
                if start == end:
                    continue
                if blocks[start] != block:
                    block, parts, own_counts = blocks[start], [], None
                if kinds[start] == PAIR:
                    parts.append(tuple(column[name].slice(start, end - start).to_numpy(zero_copy_only=False) for name in ("number", "count", "best")))
                    continue
                if own_counts is None:
                    numbers, many, flags = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3
                    own_counts = np.concatenate((counts, np.zeros(len(numbers), np.int64)))
                    own_best = np.concatenate((best, np.zeros(len(numbers), bool)))
                    own_counts[size_a + numbers.astype(np.int64)], own_best[size_a + numbers.astype(np.int64)] = many, flags.astype(bool)
                sums = _sums(column["links"].slice(start, end - start), own_counts, own_best)
                out = [column[name].slice(start, end - start) for name in ("doc_id", *STATISTICS)]
                out += [pa.array(sums[1]), pa.array(sums[0]), column["groups_sha256"].slice(start, end - start)]
                yield pa.RecordBatch.from_arrays(out, names=[field.split(" ")[0] for field in SCHEMA.split(", ")])

    return run


SCHEMA = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None, block_chars: int = BLOCK_CHARS
) -> tuple[DataFrame, DataFrame]:
    """(per document, pairs): the pairs are (a, b, count, best) over the whole corpus."""
    paths = (path_a or vocabulary_path(VOCABULARY_A), path_b or vocabulary_path(VOCABULARY_B))
    spark = docs.sparkSession
    source = docs.select(docs[id_col].cast("bigint").alias("doc_id"), text_or_empty(docs[text_col]).alias("text"))
    encoded = kept(source.mapInArrow(_encoded(paths, block_chars), KEPT), "alignment")
    partial = encoded.where(F.col("kind") != DOCUMENT).select("kind", "block", "number", "a", "b", "count")
    counts = partial.groupBy("a", "b").agg(F.sum("count").alias("count"))
    counts = kept(counts, "pair-counts")
    # As long as a vocabulary: one row for each B id, one for each A id.
    highest = F.broadcast(counts.groupBy("b").agg(F.max("count").alias("highest")))
    pairs = counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))
    aligner = _aligner(*paths)
    size_a = len(aligner.bytes_a)
    regular = partial.where(F.col("kind") == REGULAR).select("a", "b").distinct()
    vectors = np.zeros(size_a, np.int64), np.zeros(size_a, bool)
    for row in pairs.join(F.broadcast(regular), ["a", "b"]).toLocalIterator():
        vectors[0][row["a"]], vectors[1][row["a"]] = row["count"], row["best"]
    shared = spark.sparkContext.broadcast(vectors)
    asked = partial.where(F.col("kind") == PAIR).select("kind", "block", "number", "a", "b")
    answered = asked.join(pairs, ["a", "b"]).select("kind", "block", "number", "count", "best")
    documents = encoded.where(F.col("kind") == DOCUMENT).select("kind", "block", "doc_id", *STATISTICS, "groups_sha256", "links")
    both = answered.unionByName(documents, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", F.col("kind").desc())
    return both.mapInArrow(_scored(size_a, shared), SCHEMA), pairs


def op13_cross_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))[0]
