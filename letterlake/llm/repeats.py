"""Removal of byte strings that a document with a smaller id holds as well, by phrase parsing.

Rolling-hash triggers cut each text into overlapping phrases: the smallest hash among the 20-byte
strings within a 50-byte string is its trigger, and a run of 50-byte strings with one trigger is a
phrase. Equal strings have equal triggers wherever they stand.

1. Dictionary: the smallest document of each phrase. An occurrence in a larger document goes as a
   whole, without a look at its strings.
2. Where the phrases of a trigger have different smallest documents, the 50-byte strings of these, each
   in its first document only, are put in order, and those that meet get the smallest document: this
   decides the edges of repeats.

Texts lie in blocks of some million bytes. A block asks once for each of its different phrases or
strings, with its own smallest document; the asked ones of all blocks are put in order shard by shard,
and a code for each returns to its block. So a frequent one costs a row's part for a block.

The full suffix order of the corpus is not written down: only its neighbours at 50 bytes are asked
for. Strings and phrases are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letterlake.llm.blocks import bucketed, opened
from letterlake.llm.common import kept, table, text_or_empty

LENGTH = 50
TRIGGER = 20
# A very long text is parsed in parts of this many strings.
PART = 1 << 20
# A block ends with the document that brings it to so many bytes.
BLOCK_BYTES = 4_000_000
# What is asked for is dealt by the first bits of its hash.
SHARD_BITS = 10
_REPEATED, _EDGE = 1, 2
_PIECE = pa.schema([("doc_id", pa.int64()), ("id_key", pa.int64()), ("data", pa.binary())])
_ASKS = "block bigint, shard int, n int, entries binary"
_ANSWERS = "block bigint, shard int, n int, codes binary"
_PHRASE, _STRING = (np.uint32, np.uint64, np.int64), (np.uint64, np.int64)

_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(50).integers(1, 2**63, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, PART + 2 * LENGTH + 1)
_DOWN = _powers(pow(_BASE, -1, 2**64), PART + 2 * LENGTH + 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


class Part:
    """The 50-byte strings of (a part of) a text: rolling hashes, phrases, triggers."""

    def __init__(self, data: np.ndarray) -> None:
        self.n = len(data) - LENGTH + 1
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * _UP[: len(data)])])
        least = self.minima(TRIGGER)
        self.first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        self.count = np.diff(np.append(self.first, self.n))
        self.trigger = least[self.first]

    def _rolling(self, width: int) -> np.ndarray:
        return (self.sums[width:] - self.sums[:-width]) * _DOWN[: len(self.sums) - width]

    def minima(self, gram: int) -> np.ndarray:
        """For each 50-byte string, the smallest hash of the shorter strings in it."""
        least, span, width = _mix(self._rolling(gram)), 1, LENGTH - gram + 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        return np.minimum(least[: span - width], least[width - span :]) if width > span else least

    def inside(self, which: np.ndarray) -> np.ndarray:
        """The places of the strings of some phrases."""
        edges = np.zeros(self.n + 1, np.int64)
        np.add.at(edges, self.first[which], 1)
        np.add.at(edges, self.first[which] + self.count[which], -1)
        return np.flatnonzero(np.cumsum(edges[:-1]))

    def phrases(self, which: np.ndarray) -> np.ndarray:
        first, end = self.first[which], self.first[which] + self.count[which] + LENGTH - 1
        return _mix((self.sums[end] - self.sums[first]) * _DOWN[first] + end.astype(np.uint64) - first.astype(np.uint64))

    def strings(self) -> np.ndarray:
        return _mix(self._rolling(LENGTH))


def parts(text: bytes) -> Iterator[tuple[int, Part]]:
    """(offset, part) of a text of 50 bytes or more; nothing for a shorter one."""
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data) - LENGTH + 1, PART):
        yield at, Part(data[at : at + PART + LENGTH - 1])


class Block:
    """The parsed texts of a block, its different phrases and, by the answers to these, strings at edges."""

    def __init__(self, rows: pa.Table) -> None:
        self.texts = rows["data"].to_pylist()
        found = [(row, key, at, part) for row, (key, text) in enumerate(zip(rows["id_key"].to_pylist(), self.texts, strict=True)) for at, part in parts(text)]
        self.parts = found
        self.ends = np.cumsum([0, *(len(part.first) for *_, part in found)])
        self.ids = _concatenated([np.full(len(part.first), key) for _, key, _, part in found], np.int64)
        # Triggers are smallest hashes: mixed again, they are spread evenly.
        triggers = (_mix(_concatenated([part.trigger for *_, part in found], np.uint64)) >> np.uint64(32)).astype(np.uint32)
        phrases = _concatenated([part.phrases(np.arange(len(part.first))) for *_, part in found], np.uint64)
        self.asked, self.places = _different((triggers, phrases), self.ids)

    def judged(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each phrase: whether it goes as a whole, whether its strings are asked for."""
        codes, lows = codes[self.places], self.asked[-1][self.places]
        repeated = (codes & _REPEATED > 0) | (lows < self.ids)
        return repeated, ~repeated & (codes & _EDGE > 0)

    def strings(self, edge: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(row, id, places in the text, hashes) of the strings asked for."""
        for i, (row, key, at, part) in enumerate(self.parts):
            which = np.flatnonzero(edge[self.ends[i] : self.ends[i + 1]])
            if len(which):
                places = part.inside(which)
                yield row, key, places + at, part.strings()[places]


def _concatenated(found: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *found]).astype(kind, copy=False)


def _starts(keys: tuple[np.ndarray, ...]) -> np.ndarray:
    """Where in ordered rows a new key begins."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
    return new


def _different(keys: tuple[np.ndarray, ...], ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The different keys in order, each with its smallest id, and the place of each row among them."""
    order = np.lexsort(keys[::-1])
    keys = tuple(key[order] for key in keys)
    new = _starts(keys)
    places = np.empty(len(order), np.int64)
    places[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    lows = np.minimum.reduceat(ids[order], first) if len(first) else ids
    return [*(key[first] for key in keys), lows], places


def _asks(block: int, asked: list[np.ndarray]) -> pa.RecordBatch:
    """Ordered entries as one compressed value for each shard, the bytes of a column's numbers by their place."""
    head = asked[0]
    shards = (head >> head.dtype.type(8 * head.itemsize - SHARD_BITS)).astype(np.int32)
    starts = np.flatnonzero(_starts((shards,)))
    codec, values = pa.Codec("zstd", compression_level=1), []
    for a, b in zip(starts, np.append(starts, len(head))[1:], strict=True):
        columns = [np.diff(head[a:b], prepend=head.dtype.type(0)), *(column[a:b] for column in asked[1:])]
        values.append(codec.compress(b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(b - a, -1).T).tobytes() for x in columns), asbytes=True))
    sizes = np.diff(np.append(starts, len(head))).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), block, np.int64)), pa.array(shards[starts]), pa.array(sizes), pa.array(values, pa.binary())], names=["block", "shard", "n", "entries"])


def _entries(n: int, value: bytes, kinds: tuple[type, ...]) -> list[np.ndarray]:
    widths = [np.dtype(kind).itemsize for kind in kinds]
    data = np.frombuffer(pa.Codec("zstd").decompress(value, decompressed_size=n * sum(widths), asbytes=True), np.uint8)
    columns = [np.ascontiguousarray(part.reshape(width, n).T).view(kind).reshape(n) for part, width, kind in zip(np.split(data, n * np.cumsum(widths)[:-1]), widths, kinds, strict=True)]
    return [np.cumsum(columns[0], dtype=columns[0].dtype), *columns[1:]]


def _answered(kinds: tuple[type, ...]) -> Callable[[pa.Table], pa.Table]:
    """Codes for all entries of a shard: whether a smaller document has the same, and, where there are
    triggers, whether the phrases of its trigger have different smallest documents."""

    def run(asks: pa.Table) -> pa.Table:
        sizes = asks["n"].to_pylist()
        *keys, ids = (np.concatenate(x) for x in zip(*(_entries(n, value.as_py(), kinds) for n, value in zip(sizes, asks["entries"], strict=True)), strict=True))
        (*keys, lows), places = _different(tuple(keys), ids)
        codes = np.where(lows[places] < ids, _REPEATED, 0).astype(np.uint8)
        if len(keys) > 1:
            new = _starts((keys[0],))
            first, trigger = np.flatnonzero(new), np.cumsum(new) - 1
            edge = np.minimum.reduceat(lows, first) != np.maximum.reduceat(lows, first)
            codes[edge[trigger][places]] |= _EDGE
        codec = pa.Codec("zstd", compression_level=1)
        values = [codec.compress(part.tobytes(), asbytes=True) for part in np.split(codes, np.cumsum(sizes)[:-1])]
        return asks.select(["block", "shard", "n"]).append_column("codes", pa.array(values, pa.binary()))

    return run


def _codes(answers: pa.Table) -> np.ndarray:
    """The codes of a block's entries in their order."""
    codec, rows = pa.Codec("zstd"), sorted(zip(*(answers[name].to_pylist() for name in ("shard", "n", "codes")), strict=True))
    return np.frombuffer(b"".join(codec.decompress(value, decompressed_size=n, asbytes=True) for _, n, value in rows), np.uint8)


def _phrase_asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield _asks(number, Block(opened(rows)).asked)


def _string_asks(answers: pa.Table, blocks: pa.Table) -> pa.Table:
    block = Block(opened(blocks["rows"][0]))
    found = list(block.strings(block.judged(_codes(answers))[1]))
    ids = _concatenated([np.full(len(hashes), key) for _, key, _, hashes in found], np.int64)
    asked, _ = _different((_concatenated([hashes for *_, hashes in found], np.uint64),), ids)
    return pa.Table.from_batches([_asks(blocks["block"][0].as_py(), asked)])


def _removed(answers: pa.Table, blocks: pa.Table) -> pa.Table:
    """The documents of a block, with the answers to its phrases and to its strings."""
    rows = opened(blocks["rows"][0])
    block = Block(rows)
    of_strings = answers["of_strings"].to_numpy().astype(bool)
    repeated, edge = block.judged(_codes(answers.filter(pa.array(~of_strings))))
    ranges: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for i, (row, _, at, part) in enumerate(block.parts):
        which = np.flatnonzero(repeated[block.ends[i] : block.ends[i + 1]])
        if len(which):
            ranges.setdefault(row, []).append((part.first[which] + at, part.count[which]))
    found = list(block.strings(edge))
    ids = _concatenated([np.full(len(hashes), key) for _, key, _, hashes in found], np.int64)
    (_, lows), places = _different((_concatenated([hashes for *_, hashes in found], np.uint64),), ids)
    gone = (_codes(answers.filter(pa.array(of_strings)))[places] > 0) | (lows[places] < ids)
    at = 0
    for row, _, firsts, _ in found:
        firsts, at = firsts[gone[at : at + len(firsts)]], at + len(firsts)
        ranges.setdefault(row, []).append((firsts, np.ones(len(firsts), np.int64)))
    cut = [_cut(text, ranges.get(row, [])) for row, text in enumerate(block.texts)]
    columns = [rows["doc_id"], pa.array([len(text) for text in block.texts], pa.int64()), *(pa.array([x[i] for x in cut], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string())))]
    return pa.Table.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _cut(text: bytes, ranges: list[tuple[np.ndarray, np.ndarray]]) -> tuple[int, int, str]:
    """(bytes removed, maximal removed runs, digest of the rest) for runs (first, n) of strings."""
    if not ranges:
        return 0, 0, hashlib.sha256(text).hexdigest()
    edges = np.zeros(len(text) + 1, np.int64)
    for firsts, counts in ranges:
        np.add.at(edges, firsts, 1)
        np.add.at(edges, firsts + counts + LENGTH - 1, -1)
    covered = np.cumsum(edges[:-1]) > 0
    spans = np.count_nonzero(covered[1:] & ~covered[:-1]) + int(covered[0])
    return int(covered.sum()), spans, hashlib.sha256(np.frombuffer(text, np.uint8)[~covered].tobytes()).hexdigest()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Judged on the input texts as UTF-8 bytes; a null text is empty. Rows without an id count as
    larger than all; rows that repeat an id do not repeat each other. An empty table gives no rows.
    """
    spark, key = docs.sparkSession, F.col(id_col).cast("bigint")
    keyed = docs.select(key.alias("doc_id"), F.coalesce(key, F.lit(2**63 - 1)).alias("id_key"), text_or_empty(text_col).cast("binary").alias("data"))
    stored = bucketed(keyed, _PIECE, "data", BLOCK_BYTES, level=3)
    try:
        blocks = spark.table(stored)
        phrases = kept(blocks.mapInArrow(_phrase_asks, _ASKS).groupBy("shard").applyInArrow(_answered(_PHRASE), _ANSWERS), "phrase-answers")
        asks = phrases.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(_string_asks, _ASKS)
        strings = asks.groupBy("shard").applyInArrow(_answered(_STRING), _ANSWERS)
        answers = phrases.withColumn("of_strings", F.lit(False)).unionByName(strings.withColumn("of_strings", F.lit(True)))
        both = answers.groupBy("block").cogroup(blocks.groupBy("block"))
        return kept(both.applyInArrow(_removed, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"), "cut")
    finally:
        spark.sql(f"drop table {stored}")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
