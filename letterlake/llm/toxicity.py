"""Toxicity from subword bags: character n-gram vectors, averaged into a linear softmax.

A word is the bag of its character n-grams and of itself, each hashed to a bucket with a vector. The
vectors of a passage of ``PASSAGE`` neighbouring words are averaged and go through a linear softmax
of two classes. A document scores as its worst passage does, so a few words weigh the same in a note
and in a book. Vectors and softmax are learned together from labelled documents: first from any
passage of each, then from the one that scores highest in each document at the time. A
misspelt or inflected word that was never seen shares n-grams, and so vectors, with those that were.

Learning takes a bounded sample of labelled rows: at most ``SAMPLE_ROWS`` rows a class, in the order
of a hash, and of those as many as ``SAMPLE_CHARS`` characters hold. One task learns from it, in
numpy, and its model, of a size fixed by ``BUCKETS``, is stored. Scoring reads every text whole.

A null or empty text, and one without words, has the score of an empty bag. Null and repeated ids are
carried as they are; a labelled row counts once however often its id is repeated, as its highest
label, and a null label counts for nothing. Without labels of both classes every score is one half.
Ties between passages change no score. No table is collected but the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from letterlake.llm.common import kept, table, text_or_empty

BUCKETS = 1 << 18
DIMENSION = 16
GRAMS = (3, 4, 5, 6)
PASSAGE = 3
# Scripts without spaces come as one long run, which is read in pieces.
LONGEST_WORD = 24
SAMPLE_ROWS = 4_000
SAMPLE_CHARS = 16_000_000
THRESHOLD = 0.7
ANY_EPOCHS, WORST_EPOCHS = 60, 80
# Of the vectors, the softmax and its bias: how far one step goes at first.
STEPS = (10.0, 0.1, 0.1)
MOMENTUM = 0.9
# Words whose score a task remembers at a time; it forgets all and goes on beyond that.
_REMEMBERED = 500_000
_CHUNK_CHARS = 1_000_000
_BASE = np.uint64(0x100000001B3)
_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»„“”‚‘’…–—¡¿"


def words(text: str) -> list[str]:
    """Runs between spaces in lower case, without punctuation at their edges, in pieces if long.

    A word said over and over counts once in a row.
    """
    found, last = [], ""
    for run in text.lower().split():
        word = run.strip(_EDGES)
        if word == last:
            continue
        last = word
        if len(word) <= LONGEST_WORD:
            if word:
                found.append(word)
        else:
            found += [word[at : at + LONGEST_WORD] for at in range(0, len(word), LONGEST_WORD)]
    return found


def _bucket(mixed: np.ndarray) -> np.ndarray:
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS


def bags(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, sizes) of the words' bags, one after the other: n-grams, edges marked, and the word itself.

    All words' characters are one array; an n-gram's hash is a polynomial of its characters.
    """
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    chars = np.frombuffer("".join(f"<{word}>" for word in found).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.array([len(word) + 2 for word in found])
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(found)), lengths)
    left = np.repeat(ends, lengths) - np.arange(len(chars))
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _BASE))
    owners, buckets = [np.arange(len(found))], [_bucket(np.add.reduceat(chars * powers[left], ends - lengths))]
    for n in GRAMS:
        starts = np.flatnonzero(left >= n)
        mixed = np.full(len(starts), n, np.uint64)
        for at in range(n):
            mixed = mixed * _BASE + chars[starts + at]
        owners.append(owner[starts])
        buckets.append(_bucket(mixed))
    owners = np.concatenate(owners)
    return np.concatenate(buckets)[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(found))


class Sample:
    """The labelled documents as arrays: each document's words, each word's buckets."""

    def __init__(self, texts: list[str], labels: list[int]) -> None:
        number: dict[str, int] = {}
        documents = [np.array([number.setdefault(word, len(number)) for word in words(text)], np.int32) for text in texts]
        filled = [at for at, found in enumerate(documents) if len(found)]
        self.labels = np.array([labels[at] for at in filled], dtype=np.int64)
        self.sizes = np.array([len(documents[at]) for at in filled], dtype=np.int64)
        self.lengths = np.minimum(self.sizes, PASSAGE)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = np.concatenate([documents[at] for at in filled] or [np.zeros(0, np.int32)])
        self.buckets, self.bag_sizes = bags(list(number))
        self.bag_starts = np.cumsum(self.bag_sizes) - self.bag_sizes

    def any(self, rng: np.random.Generator) -> np.ndarray:
        """The start of one passage of each document, each equally likely."""
        return self.starts + rng.integers(0, self.sizes - self.lengths + 1)

    def worst(self, weights: np.ndarray) -> np.ndarray:
        """The start of each document's highest passage under a weight for each bucket."""
        scores = np.add.reduceat(weights[self.buckets], self.bag_starts) / self.bag_sizes
        total = np.concatenate(([0.0], np.cumsum(scores[self.words])))
        found = np.empty_like(self.starts)
        for at, (start, size, length) in enumerate(zip(self.starts, self.sizes, self.lengths, strict=True)):
            span = total[start : start + size + 1]
            found[at] = start + np.argmax(span[length:] - span[:-length])
        return found


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every run, one run after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def learn(texts: list[str], labels: list[int], seed: int = 11) -> tuple[np.ndarray, float]:
    """(a weight for each bucket, bias): the softmax's log odds of a bag are their mean plus the bias.

    Vectors (``BUCKETS`` x ``DIMENSION``) and the softmax's two rows take gradient steps together. The
    classes weigh the same in the loss. A step has a set length and the gradient's direction, so what
    many documents share moves far and what one document happens to hold hardly moves.
    """
    sample = Sample(texts, labels)
    if len(set(sample.labels.tolist())) < 2:
        return np.zeros(BUCKETS, np.float32), 0.0
    rng = np.random.default_rng(seed)
    vectors = np.zeros((BUCKETS, DIMENSION), np.float32)
    softmax = rng.normal(0, 0.5, (2, DIMENSION)).astype(np.float32)
    softmax -= softmax.mean(axis=0)
    bias = np.zeros(2, np.float32)
    onehot = np.eye(2, dtype=np.float32)[sample.labels]
    weight = (0.5 / np.bincount(sample.labels, minlength=2))[sample.labels].astype(np.float32)
    firsts = np.cumsum(sample.lengths) - sample.lengths
    speed = [np.zeros_like(part) for part in (vectors, softmax, bias)]
    for epoch in range(ANY_EPOCHS + WORST_EPOCHS):
        weights = vectors @ (softmax[1] - softmax[0])
        starts = sample.any(rng) if epoch < ANY_EPOCHS else sample.worst(weights)
        chosen = sample.words[_runs(starts, sample.lengths)]
        sizes = sample.bag_sizes[chosen]
        buckets = sample.buckets[_runs(sample.bag_starts[chosen], sizes)]
        word_vectors = np.add.reduceat(vectors[buckets], np.cumsum(sizes) - sizes) / sizes[:, None]
        bags = np.add.reduceat(word_vectors, firsts) / sample.lengths[:, None]
        logits = bags @ softmax.T + bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = (odds / odds.sum(axis=1, keepdims=True) - onehot) * weight[:, None]
        # Back through the averages: document to word to bucket. All of a bag's buckets move alike.
        pull = np.repeat(error / sample.lengths[:, None], sample.lengths, axis=0) / sizes[:, None]
        pulled = np.stack([np.bincount(buckets, np.repeat(pull[:, c], sizes), BUCKETS) for c in (0, 1)], axis=1).astype(np.float32)
        step = 1 - epoch / (ANY_EPOCHS + WORST_EPOCHS)
        gradients = (pulled @ softmax, error.T @ bags, error.sum(axis=0))
        for part, now, gradient, length in zip((vectors, softmax, bias), speed, gradients, STEPS, strict=True):
            now *= MOMENTUM
            now += gradient
            part -= length * step * now / max(float(np.linalg.norm(now)), 1e-12)
    return vectors @ (softmax[1] - softmax[0]), float(bias[1] - bias[0])


class Scorer:
    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias, self.seen = weights.astype(np.float64), bias, {}

    def _one(self, found: list[str]) -> float:
        worst = 0.0
        if found:
            length = min(len(found), PASSAGE)
            total = np.concatenate(([0.0], np.cumsum([self.seen[word] for word in found])))
            worst = float((total[length:] - total[:-length]).max()) / length
        return float(1 / (1 + np.exp(-np.clip(worst + self.bias, -500, 500))))

    def scores(self, texts: list[str]) -> list[float]:
        """The texts' scores, some million characters at a time: a chunk's new words are hashed together."""
        done: list[float] = []
        while len(done) < len(texts):
            chunk, size = [], 0
            while size < _CHUNK_CHARS and len(done) + len(chunk) < len(texts):
                text = texts[len(done) + len(chunk)]
                chunk.append(words(text))
                size += len(text)
            if len(self.seen) >= _REMEMBERED:
                self.seen.clear()
            fresh = list({word for found in chunk for word in found if word not in self.seen})
            if fresh:
                buckets, sizes = bags(fresh)
                means = np.add.reduceat(self.weights[buckets], np.cumsum(sizes) - sizes) / sizes
                self.seen.update(zip(fresh, means.tolist(), strict=True))
            done += map(self._one, chunk)
        return done


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels = [], []
    for batch in batches:
        texts += batch.column(0).to_pylist()
        labels += batch.column(1).to_pylist()
    weights, bias = learn(texts, labels)
    yield pa.RecordBatch.from_pydict({"weights": [weights.astype("<f4").tobytes()], "bias": [bias]})


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> tuple[bytes, float]:
    """The model from labelled documents; ``usable`` tells of a label's ``doc_id`` whether it may teach."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    if usable is not None:
        marked = marked.where(usable)
    marked = marked.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where("toxic in (0, 1)")
    order = F.xxhash64("id")
    # Two bounded lists, each the first of its class by hash; the ids alone are ranked.
    picked = [marked.where(F.col("toxic") == value).orderBy(order, "id").limit(rows) for value in (0, 1)]
    picked = F.broadcast(picked[0].unionByName(picked[1]))
    texts = docs.select(docs["doc_id"].alias("id"), text_or_empty(docs["text"]).alias("text"))
    texts = kept(texts.join(picked, "id").groupBy("id", "toxic").agg(F.min("text").alias("text")), "toxic-sample")
    upto = F.sum(F.char_length("text")).over(Window.partitionBy("toxic").orderBy(order, "id"))
    bounded = texts.withColumn("upto", upto).where(F.col("upto") <= chars // 2).select("text", "toxic", order.alias("place"))
    one = bounded.repartition(1).sortWithinPartitions("place", "text").select("text", "toxic")
    model = kept(one.mapInArrow(_learned, "weights binary, bias double"), "toxic-model").first()
    return (bytes(model["weights"]), model["bias"]) if model else (np.zeros(BUCKETS, "<f4").tobytes(), 0.0)


@cache
def _scorer(weights: bytes, bias: float) -> Scorer:
    return Scorer(np.frombuffer(weights, "<f4"), bias)


def score(docs: DataFrame, model: tuple[bytes, float]) -> DataFrame:
    """(doc_id, score) of every row, from its whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(*shared.value)
        for batch in batches:
            scores = pa.array(scorer.scores(batch.column(1).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["doc_id", "score"])

    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_or_empty(docs["text"]).alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op11_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
