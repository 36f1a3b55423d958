"""Rows that every operator must bear, and columns named as the operators name their own."""

from pyspark.sql import functions as F

from letterlake.llm.common import kept

CLASHING = (
    "_id", "_sha", "_n", "_kept_sha", "_text", "_row_id", "_row_text", "row", "name", "normal", "id_key", "text_key",
    "data", "key", "size", "hash", "n", "words", "low", "start", "end", "kind", "term", "place", "group_size", "kept",
    "bits", "n_symbols", "threshold", "perplexity", "declared", "host", "window", "band", "count", "component_id",
)
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(40_000))
DOCUMENTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (1, "Another text under an id that is taken.", "en", "b"),
    (None, "The quick brown fox  jumps over the lazy dog near the river bank today.", None, None),
    (None, None, None, None),
    (2, None, "de", "a"),
    (3, "", "de", "a"),
    (4, " \t\n ", "fr", "b"),
    (5, LONG, "en", "b"),
    (6, LONG + " end", None, "c"),
    (7, "é", "fr", "c"),
    (8, "x" * 300_000, "en", "c"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"
LABELS = [(1, 1, 0), (5, 1, 0), (7, 0, 1), (None, 1, None), (6, None, None), (99, 1, 0), (1, 1, 0)]
ITEMS = [
    (1, "quick BROWN fox jumps over the lazy dog near the river bank"),
    (2, None),
    (3, ""),
    (4, "lazy, dog"),
    (None, "absent words only here"),
    (1, "quick BROWN fox jumps over the lazy dog near the river bank"),
]
PAGES = [
    (1, "https://a.example/x", "<html lang=en><body><p>The quick brown fox jumps over the lazy dog.</p></body></html>"),
    (1, "https://a.example/x", "<html lang=en><body><p>The quick brown fox jumps over the lazy dog.</p></body></html>"),
    (2, None, None),
    (None, "", ""),
    (3, "not a url", "<<p <div"),
    (4, "http://b.example", "<p>" + LONG + "</p>"),
    (5, "http://[bad", "<div>" * 3000 + "deep" + "</div>" * 3000),
]


def with_clashing(rows):
    """The same rows with columns of the operators' inner names."""
    return rows.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


def _stored(spark, rows, schema):
    """As files: over local rows the optimizer would run each expression itself, on one thread."""
    return kept(spark.createDataFrame(rows, schema), "rows")


def documents(spark, rows=DOCUMENTS):
    return _stored(spark, rows, SCHEMA)


def labels(spark, rows=LABELS):
    return _stored(spark, rows, "doc_id bigint, quality int, toxic int")


def items(spark, rows=ITEMS):
    return _stored(spark, rows, "item_id bigint, text string")


def pages(spark, rows=PAGES):
    return _stored(spark, rows, "page_id bigint, url string, html string")


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)
