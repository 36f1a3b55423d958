"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator."""

import pytest

from letterlake.llm import decontamination, exact_dedup, html_extraction, language, licenses, ngram_join, packing, pii, quality, repeats
from tests.llm.rows import CLASHING, DOCUMENTS, PAGES, documents, items, labels, pages, sorted_rows, with_clashing

PER_DOCUMENT = {
    "op3": lambda spark, docs: ngram_join.ngram_components(docs),
    "op4": lambda spark, docs: decontamination.contamination(docs, items(spark)),
    "op5": lambda spark, docs: exact_dedup.exact_dedup(docs).drop("identity"),
    "op6": lambda spark, docs: repeats.remove_repeats(docs),
    "op7": lambda spark, docs: pii.find_pii(docs),
    "op8": lambda spark, docs: quality.judge(docs, labels(spark)).drop("perplexity", "threshold"),
}
# Rows whose number differs from the documents': pieces, licenses.
OTHERS = {
    "op1": lambda spark, docs: packing.pack(docs).drop("sequence_id", "offset"),
    "op2": lambda spark, docs: licenses.license_matches(docs),
}
FILTERS = {
    "op3": lambda spark, docs: ngram_join.drop_alike(docs, n=5, percent=80),
    "op4": lambda spark, docs: decontamination.drop_contaminated(docs, items(spark)),
    "op5": lambda spark, docs: exact_dedup.drop_copies(docs),
    "op8": lambda spark, docs: quality.drop_poor(docs, labels(spark)),
}
PER_PAGE = {
    "op9": lambda spark, rows: html_extraction.extract(rows),
    "op10": lambda spark, rows: language.identify(rows, documents(spark)),
}


@pytest.mark.parametrize("name", [*PER_DOCUMENT, *OTHERS])
def test_documents(spark, name):
    build = {**PER_DOCUMENT, **OTHERS}[name]
    plain = sorted_rows(build(spark, documents(spark)))
    if name in PER_DOCUMENT:
        assert len(plain) == len(DOCUMENTS)
        assert sorted(map(str, (r[0] for r in plain))) == sorted(str(r[0]) for r in DOCUMENTS)
    assert sorted_rows(build(spark, with_clashing(documents(spark)))) == plain


@pytest.mark.parametrize("name", [*PER_DOCUMENT, *OTHERS])
def test_no_documents(spark, name):
    assert {**PER_DOCUMENT, **OTHERS}[name](spark, documents(spark, [])).collect() == []


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_the_columns(spark, name):
    plain = FILTERS[name](spark, documents(spark))
    assert plain.columns == documents(spark).columns
    wide = with_clashing(documents(spark))
    found = FILTERS[name](spark, wide)
    assert found.columns == wide.columns
    assert sorted_rows(found, *plain.columns) == sorted_rows(plain)
    assert all(row[c] == f"own {c}" for row in found.drop("text").collect() for c in CLASHING)
    assert FILTERS[name](spark, documents(spark, [])).collect() == []


@pytest.mark.parametrize("name", PER_PAGE)
def test_pages(spark, name):
    plain = sorted_rows(PER_PAGE[name](spark, pages(spark)))
    assert len(plain) == len(PAGES)
    assert sorted_rows(PER_PAGE[name](spark, with_clashing(pages(spark)))) == plain
    assert PER_PAGE[name](spark, pages(spark, [])).collect() == []


def test_other_tables_empty(spark):
    """No items hit nothing, no labels reject nothing, no documents tell no language."""
    docs = documents(spark)
    assert {r.contaminated for r in decontamination.contamination(docs, items(spark, [])).collect()} == {False}
    assert quality.judge(docs, labels(spark, [])).where("not kept").count() == 0
    assert {r.lang for r in language.identify(pages(spark), documents(spark, [])).collect()} == {None}
