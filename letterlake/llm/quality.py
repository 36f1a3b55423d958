"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters of every script, four at a time; white space and digits are one symbol
each, and of a word that repeats the one before it, a mark and the last two letters stand, so that
every further repeat is as unlikely as the first. Three of four trusted documents are counted, the
fourth sets the thresholds. An n-gram is a
row: a context of up to three symbols, packed into 63 bits, and the symbol after it; so the model grows
with the trusted text and its alphabet, and nothing of it is held whole by the driver or a task.

Documents are scored in blocks of some million characters. A block's different n-grams are counted
in its task and become its questions; the questions of all blocks, each n-gram once, are joined with
the discounted probabilities and the back-offs of their contexts, order by order, sharded by n-gram
and context; the answers return to their blocks, where each document's are added up. So an n-gram
travels once for a block and not once for a document, and a frequent one costs a row for a block. On
their way back the answers that a task has for one block are one compressed row.

A document goes when its perplexity is beyond its language's quantile among trusted documents that
the model has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterlake.functions.sizes import broadcast_if_small
from letterlake.llm.blocks import bucketed, opened
from letterlake.llm.common import kept, table, text_or_empty, whole_rows

ORDER = 4
_BITS = 21
_POINTS = 0x110000
# A block ends with the document that brings it to so many characters.
BLOCK_CHARS = 2_000_000
# Different numbers below this are told by a table of all of them, others by sorting slices.
_TABLE = 1 << 26
# Below this the table holds their places as well.
_PLACES = 1 << 23
_SLICE = 1 << 19
# A task packs its answers by block when it holds so many.
ANSWERS = 1 << 20
# The share of trusted documents of a language that lies within its threshold, and the room above it.
QUANTILE = 0.995
MARGIN = 1.15
# A document counts as so many symbols of typical text more than it has: short ones say little.
PRIOR_SYMBOLS = 60
# One of so many trusted documents sets thresholds; the others make the model.
MEASURES = 4

_REPEAT, _START = "\x01", "\x02"
_PIECE = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("trusted", pa.bool_()), ("counted", pa.bool_()), ("text", pa.string())])


def _fold() -> np.ndarray:
    codes = np.arange(_POINTS, dtype=np.uint32)
    for space in "\t\n\r\x0b\f":
        codes[ord(space)] = ord(" ")
    for digit in "0123456789":
        codes[ord(digit)] = ord("0")
    return codes


_CODES = _fold()


def symbols(text: str) -> np.ndarray:
    """The folded text after ORDER - 1 start marks."""
    words = text.split(" ")
    words[1:] = [_REPEAT + b[-2:] if b == a and a else b for a, b in zip(words, words[1:], strict=False)]
    return _CODES[np.frombuffer((_START * (ORDER - 1) + " ".join(words)).encode("utf-32-le", "surrogatepass"), "<u4")]


def _ranked(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order, and the place of each value among them; all are below ``size``."""
    slices = [values[at : at + _SLICE] for at in range(0, len(values), _SLICE)]
    if size <= _TABLE:
        seen = np.zeros(size, bool)
        seen[values] = True
        different = np.flatnonzero(seen).astype(values.dtype)
    else:
        different = np.unique(np.concatenate([np.unique(part) for part in slices] or [values]))
    if size <= _PLACES:
        table = np.zeros(size, np.int32)
        table[different] = np.arange(len(different), dtype=np.int32)
        return different, table[values]
    places = np.empty(len(values), np.int32)
    for at, part in enumerate(slices):
        places[at * _SLICE : at * _SLICE + len(part)] = np.searchsorted(different, part)
    return different, places


def _joined(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Two numbers below ``n`` as one, in the narrower type that holds it."""
    joined = left.astype(np.int32 if n * n < 1 << 31 else np.int64)
    joined *= n
    joined += right
    return joined


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, symbols, places, sizes): the different n-grams of the texts; for each symbol of each
    text, one after the other, the place of its n-gram among them; how many symbols each text has."""
    parts = [symbols(text) for text in texts]
    sizes = np.array([len(part) - (ORDER - 1) for part in parts], np.int64)
    # One n-gram begins at each place but the last ones of a text.
    begins = np.ones(int(sizes.sum()) + (ORDER - 1) * len(parts), bool)
    ends = np.cumsum(sizes + (ORDER - 1))
    for back in range(1, ORDER):
        begins[ends - back] = False
    alphabet, numbers = _ranked(np.concatenate(parts or [np.zeros(0, np.uint32)]), _POINTS)
    del parts
    # The last ones of all texts begin nothing, so pairs of pairs are fewer by as many.
    begins = begins[: max(len(numbers) - (ORDER - 1), 0)]
    pairs, numbers = _ranked(_joined(numbers[:-1], numbers[1:], len(alphabet)), len(alphabet) ** 2)
    fours, places = _ranked(_joined(numbers[:-2][begins], numbers[2:][begins], len(pairs)), len(pairs) ** 2)
    left, right = pairs[fours // len(pairs)] if len(fours) else fours, pairs[fours % len(pairs)] if len(fours) else fours
    one, two, three, last = (alphabet[x].astype(np.int64) if len(x) else x for half in (left, right) for x in (half // len(alphabet), half % len(alphabet)))
    return (one << 2 * _BITS) | (two << _BITS) | three, last, places, sizes


def _questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each n-gram of a block once, with its number among them and how often the counted documents have it."""
    for batch in batches:
        for block, value in zip(batch.column(0), batch.column(1), strict=True):
            rows = opened(value)
            contexts, last, places, sizes = grams(rows["text"].to_pylist())
            counted = np.repeat(rows["counted"].to_numpy(), sizes)
            counts = np.bincount(places[counted], minlength=len(last))
            arrays = [pa.array(np.full(len(last), block.as_py())), pa.array(np.arange(len(last), dtype=np.int32)), pa.array(contexts), pa.array(last.astype(np.int32)), pa.array(counts.astype(np.int64))]
            whole = pa.RecordBatch.from_arrays(arrays, names=["block", "number", "context", "symbol", "n"])
            for at in range(0, len(last), 50_000):
                yield whole.slice(at, 50_000)


def _discounts(counts: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney, for counts of one, two, and three or more."""
    n = [x or 0 for x in counts.agg(*[F.count_if(F.col("n") == i) for i in (1, 2, 3, 4)]).first()]
    if not all(n):
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.05), i + 0.95) for i in range(3)]


def _order(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(context, symbol, share): discounted probabilities; (context, backoff): what is left for the order below."""
    d = _discounts(counts)
    level = F.least("n", F.lit(3))
    counts = counts.withColumn("cut", F.when(level == 1, d[0]).when(level == 2, d[1]).otherwise(d[2]))
    totals = kept(counts.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("freed")), "context-counts")
    share = counts.join(totals, "context").select("context", "symbol", ((F.col("n") - F.col("cut")) / F.col("total")).alias("share"))
    return share, totals.select("context", (F.col("freed") / F.col("total")).alias("backoff"))


def _shorter(length: int):
    """The last ``length`` symbols of a context."""
    return F.col("context").bitwiseAND(F.lit((1 << _BITS * length) - 1).cast("bigint"))


def probabilities(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """(context, symbol, p) for the n-grams ``asked``, whether seen or not.

    ``counts`` (context, symbol, n) holds the n-grams of the highest order in trusted text. A symbol
    never seen there has the back-off of the lowest order: one symbol's share of the alphabet.
    """
    orders = [kept(counts, "counts")]
    wanted = [kept(asked, "asked")]
    for length in range(ORDER - 2, -1, -1):
        # How many different symbols come before: one row each in the order above.
        below = orders[-1].groupBy(_shorter(length).alias("context"), "symbol").agg(F.count("*").alias("n"))
        orders.append(kept(below, "suffix-counts"))
        wanted.append(kept(wanted[-1].select(_shorter(length).alias("context"), "symbol").distinct(), "suffix-asked"))
    uniform = 1 / (orders[-1].count() + 1)
    found = None
    for length, (seen, rows) in enumerate(zip(reversed(orders), reversed(wanted), strict=True)):
        share, backoff = _order(seen)
        if found is None:
            rows = rows.withColumn("lower", F.lit(uniform))
        else:
            lower = found.select(F.col("context").alias("_context"), F.col("symbol").alias("_symbol"), F.col("p").alias("lower"))
            rows = rows.join(lower, (_shorter(length - 1) == F.col("_context")) & (F.col("symbol") == F.col("_symbol"))).drop("_context", "_symbol")
        rows = rows.join(share, ["context", "symbol"], "left").join(backoff, "context", "left")
        p = F.coalesce("share", F.lit(0.0)) + F.coalesce("backoff", F.lit(1.0)) * F.col("lower")
        found = kept(rows.select("context", "symbol", p.alias("p")), "probabilities")
    return found


def _bundled(held: int):
    """Answers (block, number, bits) as one compressed value for each block of ``held`` answers."""

    def rows(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        blocks, numbers, bits = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((numbers, blocks))
        blocks, numbers, bits = blocks[order], numbers[order], bits[order]
        starts = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
        # In order the steps between numbers are small.
        steps = np.diff(numbers, prepend=np.int32(0))
        steps[starts] = numbers[starts]
        codec = pa.Codec("zstd", compression_level=1)
        values = [codec.compress(steps[a:b].tobytes() + bits[a:b].tobytes(), asbytes=True) for a, b in zip(starts, np.append(starts[1:], len(blocks)), strict=True)]
        sizes = np.diff(np.append(starts, len(blocks))).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(blocks[starts]), pa.array(sizes), pa.array(values, pa.binary())], names=["block", "n", "answers"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            parts.append(tuple(column.to_numpy(zero_copy_only=False).astype(kind) for column, kind in zip(batch.columns, (np.int64, np.int32, np.float32), strict=True)))
            n += batch.num_rows
            if n >= held:
                yield rows(parts)
                parts, n = [], 0
        if n:
            yield rows(parts)

    return run


def _unbundled(n: int, value: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, bits) of ``n`` answers."""
    whole = pa.Codec("zstd").decompress(value, decompressed_size=8 * n, asbytes=True)
    return np.cumsum(np.frombuffer(whole, np.int32, n)), np.frombuffer(whole, np.float32, n, 4 * n)


def _scored(answers: pa.Table, blocks: pa.Table) -> pa.Table:
    """The documents of one block, with all answers to it."""
    parts = [_unbundled(n.as_py(), value.as_py()) for n, value in zip(answers["n"], answers["answers"], strict=True)]
    bits = np.zeros(sum(len(numbers) for numbers, _ in parts))
    for numbers, found in parts:
        bits[numbers] = found
    docs = opened(blocks["rows"][0])
    _, _, places, sizes = grams(docs["text"].to_pylist())
    sums = np.concatenate(([0.0], np.cumsum(bits[places]) if len(places) else []))
    ends = np.cumsum(sizes)
    found = docs.select(["doc_id", "lang", "trusted", "counted"])
    return found.append_column("n_symbols", pa.array(sizes)).append_column("bits", pa.array(sums[ends] - sums[ends - sizes]))


def score(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, lang, trusted, counted, n_symbols, bits) of documents (doc_id, lang, trusted, counted, text):
    the bits of each whole text under the model of the counted ones."""
    spark = docs.sparkSession
    stored = bucketed(docs, _PIECE, "text", block_chars)
    try:
        blocks = spark.table(stored)
        # Asked twice, as that costs less than to store the questions: a block's are always the same.
        questions = blocks.mapInArrow(_questions, "block bigint, number int, context bigint, symbol int, n bigint")
        once = kept(questions.groupBy("context", "symbol").agg(F.sum("n").alias("n")), "grams")
        found = probabilities(once.where("n > 0"), once.select("context", "symbol"))
        answers = questions.join(found, ["context", "symbol"]).select("block", "number", (-F.log2("p")).cast("float").alias("bits"))
        bundles = answers.mapInArrow(_bundled(ANSWERS), "block bigint, n int, answers binary")
        both = bundles.groupBy("block").cogroup(blocks.groupBy("block"))
        return kept(both.applyInArrow(_scored, "doc_id bigint, lang string, trusted boolean, counted boolean, n_symbols bigint, bits double"), "scores")
    finally:
        spark.sql(f"drop table {stored}")


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """One row per document: doc_id, lang, n_symbols, perplexity, threshold, kept.

    Trusted are the documents whose label has quality 1; each counts as often as its id has rows. One id
    in ``MEASURES`` is not counted but sets the thresholds, as the model knows the others too well; where
    there is none such, all trusted documents set them. The perplexity of an empty or null text is the prior's. A language without such documents, or a
    null one, takes the threshold of all; without any trusted text there is no threshold and all is
    kept. Rows without an id are judged, never trusted.
    """
    trusted = broadcast_if_small(kept(labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("_id")).distinct(), "trusted"))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text_or_empty("text").alias("text"))
    marked = docs.join(trusted, F.col("doc_id") == F.col("_id"), "left").withColumn("trusted", F.col("_id").isNotNull())
    measure = F.crc32(F.col("doc_id").cast("string")) % MEASURES == 0
    scores = score(marked.withColumn("counted", F.col("trusted") & ~measure))
    basis = scores.where("trusted and not counted and n_symbols > 0")
    if basis.isEmpty():
        basis = scores.where("trusted and n_symbols > 0")
    typical = basis.agg(F.sum("bits") / F.sum("n_symbols")).first()[0] or 0.0
    mean = (F.col("bits") + PRIOR_SYMBOLS * typical) / (F.col("n_symbols") + PRIOR_SYMBOLS)
    limit = (F.percentile_approx(F.pow(F.lit(2.0), mean), quantile, 10_000) * margin).alias("threshold")
    by_lang = kept(basis.groupBy("lang").agg(limit), "thresholds")
    over_all = basis.agg(limit).first()[0]
    judged = scores.withColumn("perplexity", F.pow(F.lit(2.0), mean)).join(broadcast_if_small(by_lang), "lang", "left")
    threshold = F.coalesce("threshold", F.lit(over_all).cast("double"))
    return judged.select("doc_id", "lang", "n_symbols", "perplexity", threshold.alias("threshold"), F.coalesce(F.col("perplexity") <= threshold, F.lit(True)).alias("kept"))


def drop_poor(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows beyond their language's threshold; rows without an id stay."""
    poor = kept(judge(docs, labels).where("not kept").select(F.col("doc_id").alias("_id")).where("_id is not null").distinct(), "poor")
    return whole_rows(docs).join(broadcast_if_small(poor), F.col("doc_id") == F.col("_id"), "left_anti").select("doc.*")


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
