"""Held-out accuracy of language identification, many languages, and declared languages."""

import random
import time

import pytest
from pyspark.sql import functions as F

from letterlake.llm import language

SMALL = "/root/testdata/sf0.001"


def tables(spark, docs, pages):
    return (
        spark.createDataFrame(pages, "page_id bigint, url string, html string"),
        spark.createDataFrame([(i, text, lang) for i, (lang, text) in enumerate(docs)], "doc_id bigint, text string, lang string"),
    )


def made_up(n, rng):
    """Languages with syllables of their own."""
    return {f"x{i:02}": ["".join(rng.choice("aeioubcdfghklmnprstvz") for _ in range(3)) for _ in range(12)] for i in range(n)}


def text_in(syllables, rng, words=60):
    return " ".join(rng.choice(syllables) + rng.choice(syllables) for _ in range(words))


def test_languages_beyond_one_block_are_told_alike(spark):
    rng = random.Random(4)
    spoken = made_up(7, rng)
    docs = [(lang, text_in(own, rng)) for lang, own in spoken.items() for _ in range(6)]
    pages = [(i, f"https://h{i}.example/", f"<p>{text_in(spoken[lang], rng, 20)}</p>") for i, lang in enumerate(spoken)]
    pages_table, docs_table = tables(spark, docs, pages)
    one, many = (sorted(map(tuple, language.identify(pages_table, docs_table, block=b).collect())) for b in (32, 2))
    assert [r[:3] + r[4:] for r in one] == [r[:3] + r[4:] for r in many]
    assert [a[3] for a in one] == pytest.approx([b[3] for b in many])
    assert [r[2] for r in one] == list(spoken)


def test_held_out_documents_are_recognised(spark):
    """Trained on two thirds of the given documents, the text alone tells the rest."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("lang is not null and length(text) >= 100")
    out = docs.where("doc_id % 3 = 0")
    pages = out.select(F.col("doc_id").alias("page_id"), F.lit("").alias("url"), F.col("text").alias("html"))
    told = language.identify(pages, docs.where("doc_id % 3 <> 0")).join(out.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("truth")), "page_id").collect()
    assert len(told) > 20
    assert sum(r.text_lang == r.truth for r in told) >= 0.9 * len(told)


def test_where_a_language_is_declared(spark):
    heads = {
        "<html lang=DE>": "de",
        "<html data-lang='fr'>": None,
        "<html class=a xml:lang='es-MX'>": "es",
        "<html data-lang=fr lang=it>": "it",
        "<html><meta http-equiv='Content-Language' content='pt-BR'>": "pt",
        "<html><meta content=nl http-equiv=content-language>": "nl",
        "<html><meta name=x content=nl>": None,
        "<html lang=en><meta http-equiv='content-language' content='pt'>": "en",
    }
    pages, docs = tables(spark, [("en", "some text"), ("de", "mancher text")], [(i, "", head + "<p>word</p>") for i, head in enumerate(heads)])
    found = {r.page_id: r.declared_lang for r in language.identify(pages, docs).collect()}
    assert [found[i] for i in range(len(heads))] == list(heads.values())


@pytest.mark.parametrize("unit", ["<", "<a ", "<script", "<!-", "&", "</"])
def test_broken_markup_takes_linear_time(unit):
    began = time.time()
    language.visible(unit * (400_000 // len(unit)))
    assert time.time() - began < 5
