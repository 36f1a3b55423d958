"""Grouped prefix join: documents whose word n-gram sets are alike.

1. A fixed-size table of shingle frequencies over all documents gives the order of shingles, rare
   ones first. Two sets as alike as asked for share a shingle among the first few of that order.
2. Documents with equal sets become one class, classes with equal prefix and size one group. Only
   groups are listed under their prefix shingles.
3. Group pairs pass a size, a position and a bitmap filter. All three are bounds: none loses a link.
4. What is left is expanded to classes and verified on the whole sets.

A component needs a spanning set of links, so step 3 runs twice. First every list links its groups
to the one that most lists know (copies of one text then need one pair each). Then all pairs that
still lie in different components are tried, so no link between components is missed. Classes of one
group share the whole prefix: their pairs are taken by group, also where the group is alone on its lists.

A shingle is held as a 64-bit hash of its words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from letterlake.functions.sizes import broadcast_if_small
from letterlake.llm.common import kept, table, text_or_empty, whole_rows
from letterlake.llm.components import components

# The frequency table: this many counters, whatever the size of the corpus.
SKETCH_BITS = 21
_SKETCH_CHUNKS = 64
# A counter is never less than the length of its shingles' lists. Lists proven shorter than this meet
# in one window; the others are counted ahead of the join, which then can be split.
LONG_LIST = 4096
_BITMAP_WORDS = 16
_REMEMBERED_WORDS = 100_000

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """A text's distinct word n-grams as sorted 64-bit hashes; words are lower-cased in A-Z only."""

    def __init__(self, n: int) -> None:
        self.n = n
        self.words = _WordHashes()

    def shingles(self, text: str) -> np.ndarray:
        # bytes.lower and bytes.split know ASCII letters and ASCII white space only.
        words = text.encode("utf-8", "surrogatepass").lower().split()
        hashes = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(words))
        if not n:
            return hashes
        mixed = np.full(len(words) - n + 1, n, np.uint64)
        for i in range(n):
            mixed = (mixed ^ hashes[i : len(words) - n + 1 + i]) * _ODD[0]
            mixed ^= mixed >> np.uint64(29)
        mixed *= _ODD[1]
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def _texts(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    shingler = Shingler(n)
    for batch in batches:
        yield batch, [shingler.shingles(text) for text in batch.column(0).to_pylist()]


def frequencies(texts: DataFrame, n: int, bits: int) -> np.ndarray:
    """How many documents hold a shingle of each hash bucket: 2**bits counters.

    Tasks count into whole tables and send them compressed; a table's chunks are added up apart from
    each other, one row at a time. The driver receives 8 * 2**bits bytes.
    """
    chunk = (1 << bits) // _SKETCH_CHUNKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, shift = np.zeros(1 << bits, np.uint32), np.uint64(64 - bits)
        for _, sets in _texts(batches, n):
            if sets:
                counts += np.bincount((np.concatenate(sets) >> shift).astype(np.int64), minlength=1 << bits).astype(np.uint32)
        if counts.any():
            parts = [zlib.compress(part.tobytes(), 1) for part in counts.reshape(_SKETCH_CHUNKS, chunk)]
            yield pa.RecordBatch.from_arrays([pa.array(range(_SKETCH_CHUNKS), pa.int32()), pa.array(parts, pa.binary())], names=["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total = totals.setdefault(key, np.zeros(chunk, np.uint64))
                total += np.frombuffer(zlib.decompress(part), np.uint32)
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], names=["chunk", "counts"])

    schema = "chunk int, counts binary"
    total = np.zeros((_SKETCH_CHUNKS, chunk), np.uint64)
    for key, part in texts.mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema).collect():
        total[key] = np.frombuffer(part, np.uint64)
    return total.reshape(-1)


def _signatures(docs: DataFrame, n: int, percent: int, bits: int) -> DataFrame:
    """One row per document: size, digests of set and prefix, prefix, bitmap."""
    table_ = docs.sparkSession.sparkContext.broadcast(np.minimum(frequencies(docs.select("text"), n, bits), (1 << 24) - 1).astype(np.uint32))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, shift = table_.value, np.uint64(64 - bits)
        for batch, sets in _texts(batches, n):
            out: list[list] = [[], [], [], [], [], []]
            for found in sets:
                size = len(found)
                rank = counts[found >> shift].astype(np.uint64) << np.uint64(40) | found >> np.uint64(24)
                prefix = found[np.argsort(rank, kind="stable")[: size - (percent * size + 99) // 100 + 1 if size else 0]]
                bitmap = np.packbits(np.bincount((found >> np.uint64(8) & np.uint64(64 * _BITMAP_WORDS - 1)).astype(np.int64), minlength=64 * _BITMAP_WORDS) & 1)
                out[0].append(size)
                out[1].append(xxhash.xxh3_128_digest(found.tobytes()))
                out[2].append(xxhash.xxh3_128_digest(size.to_bytes(8, "little") + prefix.tobytes()))
                out[3].append(prefix.view(np.int64))
                out[4].append(int(np.count_nonzero(counts[prefix >> shift] < LONG_LIST)))
                out[5].append(bitmap.view(np.int64))
            longs = pa.list_(pa.int64())
            types = [pa.int64(), pa.binary(), pa.binary(), longs, pa.int32(), longs]
            arrays = [pa.array(values, kind) for values, kind in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), *arrays], names=["doc_id", "size", "digest", "prefix_digest", "prefix", "short", "bitmap"])

    return docs.select("text", "doc_id").mapInArrow(
        sign, "doc_id bigint, size bigint, digest binary, prefix_digest binary, prefix array<bigint>, short int, bitmap array<bigint>"
    )


def _whole_sets(docs: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """(cls, shingles) of the classes given, from one document of each."""
    wanted = kept(classes, "wanted")
    ids = broadcast_if_small(wanted.select(F.col("first_doc").alias("_id")))
    texts = docs.join(ids, docs.doc_id.eqNullSafe(F.col("_id")), "left_semi")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _texts(batches, n):
            digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([digests, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["digest", "shingles"])

    found = texts.select("text").mapInArrow(whole, "digest binary, shingles array<bigint>")
    return kept(found.join(wanted.select("digest", "cls"), "digest").select("cls", "shingles"), "whole-sets")


def _linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of the distinct pairs (u, v) of classes that are alike: bitmap bound, then whole sets."""
    marks = classes.select("cls", "size", "bitmap")
    left, right = (marks.select([F.col(c).alias(f"{side}_{c}") for c in marks.columns]) for side in "uv")
    both = pairs.distinct().join(left, F.col("u") == F.col("u_cls")).join(right, F.col("v") == F.col("v_cls"))
    apart = F.expr("aggregate(zip_with(u_bitmap, v_bitmap, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)")
    total = F.col("u_size") + F.col("v_size")
    # Every shingle that one side lacks flips one bit at most.
    likely = kept(both.where(_alike((total - apart) / 2, total, percent)).select("u", "v", "u_size", "v_size"), "likely")
    ends = likely.select(F.explode(F.array("u", "v")).alias("cls")).distinct()
    sets = _whole_sets(docs, classes.select("cls", "digest", "first_doc").join(ends, "cls"), n)
    left, right = (sets.select(F.col("cls").alias(side), F.col("shingles").alias(f"{side}_set")) for side in "uv")
    shared = F.size(F.array_intersect("u_set", "v_set"))
    return likely.join(left, "u").join(right, "v").where(_alike(shared, F.col("u_size") + F.col("v_size"), percent)).select("u", "v")


def _alike(shared: Column, total: Column, percent: int) -> Column:
    return shared * 100 >= (total - shared) * percent


def _fits(size: Column, place: Column, size2: Column, place2: Column, percent: int) -> Column:
    """Size and position bounds for two sets that share the shingle at these places of their prefixes."""
    rest = F.least(size - place, size2 - place2)
    return (F.least(size, size2) * 100 >= F.greatest(size, size2) * percent) & _alike(rest, size + size2, percent)


def _compatible(a: str, b: str, percent: int) -> Column:
    return _fits(*[F.col(f"{side}.{name}") for side in (a, b) for name in ("size", "place")], percent)


def ngram_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, percent: int = 90, sketch_bits: int = SKETCH_BITS
) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id, component_id.

    Documents link when shared shingles are at least ``percent`` hundredths of all of both. The
    component is the smallest id reachable; equal sets have the same class_id. A text without words
    or a null has an empty set, no class and is alone. Repeated rows are documents like any other; a
    null id counts as no id in the minimum. An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = kept(_signatures(docs, n, percent, sketch_bits), "signatures")
    worded = rows.where("size > 0")
    # Prefixes go to the groups alone and bitmaps to the classes alone.
    classes = kept(
        worded.groupBy("digest")
        .agg(F.min("doc_id").alias("first_doc"), *[F.first(c).alias(c) for c in ("size", "prefix_digest", "bitmap")])
        .withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )
    leaders = classes.groupBy("prefix_digest").agg(F.min("cls").alias("grp"))
    prefixes = worded.groupBy("prefix_digest").agg(F.first("size").alias("size"), F.first("prefix").alias("prefix"), F.first("short").alias("short"))
    groups = kept(prefixes.join(leaders, "prefix_digest"), "groups")
    listed = groups.select("grp", "size", "short", F.posexplode("prefix").alias("place", "shingle"))
    # A list of one group pairs nothing, nor does a row none of whose partners passes the bounds. The
    # partners nearest in size are looked at; where there are more beyond them, only by size.
    by_size = Window.partitionBy("shingle").orderBy("size")
    row = F.struct("size", "place")
    short = listed.where("place < short").withColumns(
        {"lower": F.lag(row).over(by_size), "upper": F.lead(row).over(by_size), "more_lower": F.lag("size", 2).over(by_size), "more_upper": F.lead("size", 2).over(by_size)}
    )
    beyond = (F.col("more_lower").isNotNull() & (F.col("lower.size") * 100 >= F.col("size") * percent)) | (
        F.col("more_upper").isNotNull() & (F.col("size") * 100 >= F.col("upper.size") * percent)
    )
    fits = [F.coalesce(_fits(F.col("size"), F.col("place"), F.col(f"{side}.size"), F.col(f"{side}.place"), percent), F.lit(False)) for side in ("lower", "upper")]
    short = short.where(beyond | fits[0] | fits[1]).select("grp", "size", "place", "shingle")
    long = listed.where("place >= short").select("grp", "size", "place", "shingle")
    counted = kept(long.groupBy("shingle").count().where("count > 1").drop("count"), "long-lists")
    lists = kept(short.unionByName(long.join(counted, "shingle")), "lists")

    # First pass: in each list, all to the group that has most of its prefix in common with others.
    known = lists.groupBy("grp").agg(F.count("*").alias("known"))
    ranked = kept(lists.join(known, "grp"), "ranked")
    centres = kept(ranked.groupBy("shingle").agg(F.max(F.struct("known", F.col("grp").alias("grp"), "size", "place")).alias("c")).select("shingle", "c.*"), "centres")
    pairs = (
        ranked.alias("x")
        .join(centres.alias("y"), F.col("x.shingle") == F.col("y.shingle"))
        .where((F.col("x.grp") != F.col("y.grp")) & _compatible("x", "y", percent))
        .select(F.greatest("x.grp", "y.grp").alias("u"), F.least("x.grp", "y.grp").alias("v"))
    )
    by_class = kept(classes.select("cls", "size", "prefix_digest").join(groups.select("prefix_digest", "grp"), "prefix_digest").select("cls", "grp"), "by-class")
    inside = by_class.where("cls <> grp").select(F.col("cls").alias("u"), F.col("grp").alias("v"))
    links = kept(_linked(pairs.unionByName(inside), classes, docs, n, percent), "links-1")
    found = kept(components(links), "components-1")

    # Second pass: every pair of a list or a group whose ends are still apart.
    placed = kept(
        by_class.join(found, by_class.cls == found.node, "left").select("cls", "grp", F.coalesce("component", "cls").alias("component")), "placed"
    )
    full = kept(
        lists.join(placed, "grp")
        .select("shingle", "cls", "component", "size", "place"),
        "full-lists",
    )
    sizes = kept(full.groupBy("shingle", "component").agg(F.count("*").alias("n")), "list-components")
    main = kept(
        sizes.groupBy("shingle").agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("parts")).where("parts > 1").select("shingle", F.col("top.component").alias("main")),
        "main-components",
    )
    open_lists = kept(full.join(main, "shingle"), "open-lists")
    few = open_lists.where("component <> main")
    # A pair between components has an end outside the list's largest one; of two such ends, one order.
    crossing = (
        few.alias("x")
        .join(open_lists.alias("y"), F.col("x.shingle") == F.col("y.shingle"))
        .where(
            (F.col("x.component") != F.col("y.component"))
            & ((F.col("y.component") == F.col("y.main")) | (F.col("x.cls") > F.col("y.cls")))
            & _compatible("x", "y", percent)
        )
        .select(F.greatest("x.cls", "y.cls").alias("u"), F.least("x.cls", "y.cls").alias("v"))
    )
    # Pairs within a group, the largest component's own left out as above.
    parts = kept(placed.groupBy("grp", "component").agg(F.count("*").alias("n")), "group-components")
    split = parts.groupBy("grp").agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    split = kept(placed.join(split.select("grp", F.col("top.component").alias("main")), "grp"), "split-groups")
    within = (
        split.where("component <> main")
        .alias("x")
        .join(split.alias("y"), F.col("x.grp") == F.col("y.grp"))
        .where((F.col("x.component") != F.col("y.component")) & ((F.col("y.component") == F.col("y.main")) | (F.col("x.cls") > F.col("y.cls"))))
        .select(F.greatest("x.cls", "y.cls").alias("u"), F.least("x.cls", "y.cls").alias("v"))
    )
    more = kept(_linked(crossing.unionByName(within), classes, docs, n, percent), "links-2")
    final = kept(components(links.unionByName(more)), "components-2")

    named = classes.select("digest", "cls", "first_doc").join(final, F.col("cls") == F.col("node"), "left")
    named = kept(named.select("digest", "cls", "first_doc", F.coalesce("component", "cls").alias("component")), "named")
    smallest = kept(named.groupBy("component").agg(F.min("first_doc").alias("component_id")), "smallest")
    labels = kept(named.join(smallest, "component").select("digest", "cls", "component_id"), "labels")
    return rows.join(labels, "digest", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.col("cls").alias("class_id"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def drop_alike(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the smallest id of each component; rows without an id stay."""
    found = ngram_components(docs, id_col, text_col, n, percent)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_id")).distinct()
    return whole_rows(docs, id_col, text_col).join(gone, F.col("doc_id") == F.col("_id"), "left_anti").select("doc.*")


def op3_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))
