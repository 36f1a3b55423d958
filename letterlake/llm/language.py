"""Language of web pages by Bayesian fusion of what the page and its address say.

For each page and language four things are multiplied: the likelihood of its text (byte n-grams,
counted over all documents of known language), of the language its markup declares, of its address
suffix, and a prior from its host. Declarations and suffixes are as telling as the corpus shows: how
often each goes with each language is counted over all pages. Host priors are smoothed in a
hierarchy, a host by its domain, a domain by all pages; a page's own text does not count in its host's
prior. The counts are grouped sums, combined in the map tasks, so a huge host is one row per language.

The text model is rows of (language, n-gram, count). It is applied to the pages by blocks of languages,
so that however many there are, the driver and each worker hold one block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letterlake.llm.common import kept, table, text_or_empty

GRAM_BITS = 16
GRAM_BYTES = 3
# Text evidence is weighed as if its n-grams came in independent groups of this size.
TEXT_TEMPER = 8.0
# How many pages' worth of the level above a host, a domain, a declaration or a suffix starts with.
HOST_PRIOR, DOMAIN_PRIOR, SIGNAL_PRIOR = 4.0, 8.0, 5.0
# Languages whose n-grams are held at once: 256 kB each.
LANGUAGE_BLOCK = 32

# A tag holds no other, so that one that never ends is looked at once.
_HIDDEN = re.compile(r"<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^<>]*+>|&[#A-Za-z0-9]+;", re.S | re.I)
# Where a page declares its language: in its first tag or as the header it would be sent with.
_DECLARED = (
    r"(?is)<html\b[^<>]*?(?<![\w-])lang\s*=\s*[\"']?([A-Za-z]{2,8})",
    r"(?is)<meta\b(?=[^<>]*\bhttp-equiv\s*=\s*[\"']?content-language)[^<>]*?(?<![\w-])content\s*=\s*[\"']?\s*([A-Za-z]{2,8})",
)


def _grams(text: str) -> np.ndarray:
    """Hash buckets of the byte n-grams of the letters, in small letters."""
    data = np.frombuffer((" " + re.sub(r"[\W\d_]+", " ", text.lower()) + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    n = len(data) - GRAM_BYTES + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    key = np.zeros(n, np.uint32)
    for i in range(GRAM_BYTES):
        key = key * np.uint32(257) + data[i : i + n]
    return ((key * np.uint32(2654435769)) >> np.uint32(32 - GRAM_BITS)).astype(np.int64)


def visible(page: str) -> str:
    return _HIDDEN.sub(" ", page)


def text_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", block: int = LANGUAGE_BLOCK) -> DataFrame:
    """(lang, gram, n): n-gram buckets counted over all documents with a language, and a row with gram -1 for each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, own in counts.items():
                seen = np.flatnonzero(own)
                grams, n = np.append(seen, -1), np.append(own[seen], 0)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in counts and len(counts) >= block:
                    yield from counted()
                own = counts.setdefault(lang, np.zeros(1 << GRAM_BITS, np.int64))
                own += np.bincount(_grams(text), minlength=1 << GRAM_BITS)
        yield from counted()

    known = docs.select(F.col(lang_col).cast("string").alias("lang"), text_or_empty(text_col).alias("text")).where("lang is not null")
    parts = known.mapInArrow(count, "lang string, gram bigint, n bigint")
    return kept(parts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")


def block_model(counts: DataFrame, languages: list[str]) -> np.ndarray:
    """log2 likelihood of each n-gram bucket in each of the languages, which are one block."""
    found = counts.where(F.col("lang").isin(languages) & (F.col("gram") >= 0))
    names = F.array(*[F.lit(x) for x in languages])
    rows = found.select((F.array_position(names, F.col("lang")) - 1).cast("int").alias("place"), F.col("gram").cast("int").alias("gram"), "n").toPandas()
    totals = np.full((len(languages), 1 << GRAM_BITS), 0.5)
    totals[rows["place"].to_numpy(), rows["gram"].to_numpy()] += rows["n"].to_numpy()
    return np.log2(totals / totals.sum(axis=1, keepdims=True)).astype(np.float32)


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _likelihoods(pages: DataFrame, languages: list[str], counts: DataFrame, block: int) -> DataFrame:
    """``text_bits``: how likely each language makes a page's text, in the languages' order."""
    blocks = [languages[i : i + block] for i in range(0, len(languages), block)]
    rows = pages.withColumn("text_bits", F.array().cast("array<double>"))
    for number, names in enumerate(blocks):
        shared = pages.sparkSession.sparkContext.broadcast(block_model(counts, names))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bits = []
                for page, before in zip(batch.column("html").to_pylist(), batch.column("text_bits").to_pylist(), strict=True):
                    bits.append(before + (shared.value[:, _grams(visible(page))].sum(axis=1, dtype=np.float64) / TEXT_TEMPER).tolist())
                yield batch.set_column(batch.schema.get_field_index("text_bits"), "text_bits", pa.array(bits, pa.list_(pa.float64())))

        rows = rows.mapInArrow(run, rows.schema)
        if number + 1 < len(blocks):
            # One block's model at a time in a worker.
            rows = kept(rows, "page-bits")
    best = F.array_max("text_bits")
    return rows.select("page_id", "url", "declared", F.transform("text_bits", lambda x: x - best).alias("text_bits"))


def _softmax(bits: Column) -> Column:
    powers = F.transform(bits, lambda x: F.pow(F.lit(2.0), x - F.array_max(bits)))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def _sums(weight: str, n: int) -> list[Column]:
    return [F.sum(F.col(weight)[i]).alias(f"s{i}") for i in range(n)]


def _packed(n: int) -> Column:
    return F.array(*[F.col(f"s{i}") for i in range(n)])


def identify(
    pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", block: int = LANGUAGE_BLOCK
) -> DataFrame:
    """One row per page: page_id, url, lang, confidence, text_lang, declared_lang, host, suffix.

    A null page or url is an empty one: its language is then told by what is left. ``text_lang`` is
    what the text alone says. Ties go to the first language in alphabetical order. Without documents
    of known language nothing can be told: ``lang`` is null. Repeated rows are judged alike. Of broken
    markup, a tag that never ends is text. ``block`` languages are compared with the texts at a time.
    """
    source = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.lower(F.coalesce(*[F.nullif(F.regexp_extract(text_or_empty(html_col), pattern, 1), F.lit("")) for pattern in _DECLARED], F.lit(""))).alias("declared"),
        text_or_empty(html_col).alias("html"),
    )
    counts = text_counts(docs, block=block)
    # As many as the column has names for languages.
    languages = sorted(row.lang for row in counts.where("gram = -1").select("lang").collect())
    n = len(languages)
    if not n:
        blank = F.lit(None).cast("string")
        return source.select("page_id", "url", blank.alias("lang"), F.lit(None).cast("double").alias("confidence"), blank.alias("text_lang"), F.nullif("declared", F.lit("")).alias("declared_lang"), _host(text_or_empty("url")).alias("host"), blank.alias("suffix"))
    host = _host(text_or_empty("url"))
    rows = _likelihoods(source, languages, counts, block).withColumn("host", host)
    rows = rows.withColumns({"domain": F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), "suffix": F.regexp_extract("host", r"\.([^.0-9]+)$", 1)})
    rows = kept(rows.withColumn("by_text", _softmax(F.col("text_bits"))), "page-texts")

    overall = rows.agg(F.count("*").alias("pages"), *_sums("by_text", n)).first()
    total = max(overall["pages"], 1)
    base = [((overall[f"s{i}"] or 0.0) + 1.0) / (total + n) for i in range(n)]
    everywhere = F.array(*[F.lit(b) for b in base])

    def signal(name: str) -> DataFrame:
        """How much likelier each language makes each value of a column than it is overall, in bits."""
        sums = kept(rows.groupBy(name).agg(F.count("*").alias("n"), *_sums("by_text", n)), f"{name}-counts")
        share = F.transform(_packed(n), lambda x, i: (x + SIGNAL_PRIOR * everywhere[i]) / (F.col("n") + SIGNAL_PRIOR))
        return sums.select(name, F.zip_with(share, everywhere, lambda p, b: F.log2(p / b)).alias(f"{name}_bits"))

    domains = kept(rows.groupBy("domain").agg(F.count("*").alias("domain_n"), *_sums("by_text", n)).select("domain", "domain_n", _packed(n).alias("domain_sums")), "domain-counts")
    hosts = rows.groupBy("host", "domain").agg(F.count("*").alias("host_n"), *_sums("by_text", n)).select("host", "domain", "host_n", _packed(n).alias("host_sums"))
    priors = kept(hosts.join(domains, "domain").drop("domain"), "host-priors")
    known = rows.join(priors, "host").join(kept(signal("declared"), "declared-bits"), "declared").join(kept(signal("suffix"), "suffix-bits"), "suffix")
    # Without the page itself: its text has its own say.
    own = F.col("by_text")
    domain = F.transform(F.col("domain_sums"), lambda x, i: (F.greatest(x - own[i], F.lit(0.0)) + DOMAIN_PRIOR * everywhere[i]) / (F.col("domain_n") - 1 + DOMAIN_PRIOR))
    prior = F.transform(F.col("host_sums"), lambda x, i: (F.greatest(x - own[i], F.lit(0.0)) + HOST_PRIOR * F.col("domain_p")[i]) / (F.col("host_n") - 1 + HOST_PRIOR))
    told = known.withColumn("domain_p", domain).withColumn("prior", prior)
    bits = F.transform(F.col("text_bits"), lambda x, i: x + F.col("declared_bits")[i] + F.col("suffix_bits")[i] + F.log2(F.col("prior")[i]))
    told = told.withColumn("p", _softmax(bits))
    names = F.array(*[F.lit(x) for x in languages])
    best = lambda scores: F.element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))
    return told.select(
        "page_id",
        "url",
        best(F.col("p")).alias("lang"),
        F.array_max("p").alias("confidence"),
        best(F.col("by_text")).alias("text_lang"),
        F.nullif("declared", F.lit("")).alias("declared_lang"),
        "host",
        F.nullif("suffix", F.lit("")).alias("suffix"),
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
