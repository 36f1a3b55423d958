"""Benchmark decontamination with a positional inverted index of the training tokens.

Test items are cut into windows of consecutive words. The corpus is counted for the test terms, and
each window is looked for under its two rarest terms: their postings (term, document, position) are
stored, shifted by the term's offset in the window, and intersected. A start that both lists agree
on is verified word by word. Only the postings of those rare terms are ever stored; a window with a
term that the corpus lacks is looked for nowhere.

DataFrame functions only. Test terms and anchors are broadcast if their measured size allows, else
joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from letterlake.functions.sizes import broadcast_if_small
from letterlake.llm.common import kept, lower_ascii, table, text_or_empty, whole_rows

WINDOW_WORDS = 10
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_KEY = ["id_key", "text_key"]


def _split(text: str | Column) -> Column:
    """Words of a text, case as it is; the first and the last may be empty."""
    return F.split(text_or_empty(text), _SEPARATORS)


def words(text: str | Column) -> Column:
    return F.filter(_split(lower_ascii(text_or_empty(text))), lambda word: word != "")


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The texts with a key that tells rows apart unless both id and text are equal."""
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))).alias("id_key"),
        F.xxhash64(text, F.col(id_col).isNull()).alias("text_key"),
        text.alias("text"),
    )


def _occurrences(docs: DataFrame) -> DataFrame:
    """One row per word: key, position from 0, term."""
    split = docs.select(*_KEY, _split(lower_ascii(F.col("text"))).alias("words"))
    # The outer form, as the plain one would have Spark split once more to drop empty arrays; there are none.
    first_empty = (F.element_at("words", 1) == "").cast("int")
    placed = split.select(*_KEY, first_empty.alias("lead"), F.posexplode_outer("words").alias("at", "term")).where("term <> ''")
    return placed.select(*_KEY, (F.col("at") - F.col("lead")).alias("place"), "term")


def windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = WINDOW_WORDS) -> DataFrame:
    """(item_id, terms): each ``size`` consecutive words; a shorter item is one window, an empty one none."""
    cut = items.select(F.col(item_col).alias("item_id"), words(text_col).alias("all")).where("size(all) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - size + 1, F.lit(1)))
    return cut.select("item_id", "all", F.explode(starts).alias("from")).select("item_id", F.slice("all", F.col("from"), size).alias("terms"))


def _anchors(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """The windows whose terms all occur, with their two rarest terms and those terms' offsets."""
    terms = kept(distinct.select(F.explode("terms").alias("term")).distinct(), "terms")
    counts = kept(_occurrences(docs).join(broadcast_if_small(terms), "term").groupBy("term").count(), "term-counts")
    spread = distinct.select("window", "terms", F.posexplode("terms").alias("offset", "term")).join(broadcast_if_small(counts), "term", "left")
    # A window of one word is its own second anchor.
    order = F.struct(F.coalesce("count", F.lit(0)).alias("n"), "term", "offset")
    return (
        spread.groupBy("window")
        .agg(F.first("terms").alias("terms"), F.array_sort(F.collect_list(order)).alias("rank"))
        .where("rank[0].n > 0")
        .select("window", "terms", F.col("rank")[0].alias("rare"), F.try_element_at("rank", F.lit(2)).alias("next"))
        .select("window", "terms", "rare.term", "rare.offset", F.coalesce("next.term", "rare.term").alias("term2"), F.coalesce("next.offset", "rare.offset").alias("offset2"))
    )


def _index(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """Postings of the anchor terms."""
    wanted = kept(anchors.select(F.explode(F.array("term", "term2")).alias("term")).distinct(), "anchor-terms")
    return kept(_occurrences(docs).join(broadcast_if_small(wanted), "term").select("term", *_KEY, "place"), "postings")


def _windows_and_index(docs: DataFrame, items: DataFrame, size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    cut = kept(windows(items, size=size).distinct(), "windows")
    distinct = kept(cut.select("terms").distinct().withColumn("window", F.monotonically_increasing_id()), "distinct-windows")
    anchors = kept(_anchors(docs, distinct), "anchors")
    return cut.join(distinct, "terms").select("window", "item_id"), anchors, _index(docs, anchors)


def _starts(anchors: DataFrame, postings: DataFrame) -> DataFrame:
    """Where the rarest term puts a window's start, with the place its second term must have."""
    found = postings.join(broadcast_if_small(anchors.select("window", "term", "offset", "term2", "offset2")), "term")
    return found.select("window", *_KEY, (F.col("place") - F.col("offset")).alias("start"), "term2", "offset2").where("start >= 0")


def _verified(docs: DataFrame, anchors: DataFrame, starts: DataFrame) -> DataFrame:
    """(key, window, start, length) of the starts whose every word is the window's."""
    keys = broadcast_if_small(kept(starts.select(*_KEY).distinct(), "candidate-documents"))
    texts = _occurrences(docs.join(keys, _KEY, "left_semi")).distinct()
    asked = starts.join(broadcast_if_small(anchors.select("window", "terms")), "window").select(
        *_KEY, "window", "start", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term")
    )
    asked = asked.select(*_KEY, "window", "start", "length", (F.col("start") + F.col("offset")).alias("place"), "term")
    met = asked.join(texts, [*_KEY, "place", "term"])
    return met.groupBy(*_KEY, "window", "start", "length").count().where("count = length").drop("count")


def phrase_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """(documents' keys with ids and words, one row per document, item, window start and length)."""
    keyed = _documents(docs, id_col, text_col)
    owners, anchors, postings = _windows_and_index(keyed, items, size)
    second = postings.select(F.col("term").alias("term2"), *_KEY, F.col("place").alias("place2")).distinct()
    starts = _starts(anchors, postings).withColumn("place2", F.col("start") + F.col("offset2"))
    agreed = kept(starts.join(second, ["term2", *_KEY, "place2"], "left_semi").select("window", *_KEY, "start").distinct(), "agreed-starts")
    matches = kept(_verified(keyed, anchors, agreed), "matches")
    return keyed, matches.join(broadcast_if_small(kept(owners, "window-owners")), "window").select(*_KEY, "item_id", "start", "length")


def proximity_matches(docs: DataFrame, items: DataFrame, slack: int, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, item_id, start, shift): a window's two rarest terms, at most ``slack`` words off their distance.

    ``start`` is where the rarest term puts the window. Finds passages with words put in or left out.
    """
    keyed = _documents(docs, id_col, text_col)
    owners, anchors, postings = _windows_and_index(keyed, items, size)
    span = slack + 1
    second = postings.select(F.col("term").alias("term2"), *_KEY, F.col("place").alias("place2"), F.floor(F.col("place") / span).alias("cell"))
    starts = _starts(anchors, postings).withColumn("due", F.col("start") + F.col("offset2"))
    cells = F.array(*[F.floor(F.col("due") / span) + i for i in (-1, 0, 1)])
    near = starts.withColumn("cell", F.explode(cells)).join(second, ["term2", *_KEY, "cell"]).withColumn("shift", F.col("place2") - F.col("due"))
    near = near.where(F.abs("shift") <= slack).groupBy("window", *_KEY, "start").agg(F.min_by("shift", F.struct(F.abs("shift"), "shift")).alias("shift"))
    ids = keyed.select("doc_id", *_KEY).distinct()
    return near.join(owners, "window").join(ids, _KEY).select("doc_id", "item_id", "start", "shift").distinct()


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null text has no words. Rows that repeat an id are judged by their own text each; rows that
    repeat both get equal results. No items, or items without words, hit nothing.
    """
    keyed, matches = phrase_matches(docs, items, id_col, text_col, size)
    matches = kept(matches, "item-matches")
    spans = matches.select(*_KEY, "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    before = Window.partitionBy(*_KEY).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    # Of each span, the part that no earlier one covered.
    fresh = spans.withColumn("reached", F.max("end").over(before)).select(
        *_KEY, F.greatest(F.col("end") - F.greatest("start", F.coalesce("reached", "start")), F.lit(0)).alias("fresh")
    )
    hits = fresh.groupBy(*_KEY).agg(F.sum("fresh").alias("n_hit"))
    named = matches.groupBy(*_KEY).agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    found = kept(hits.join(named, _KEY), "contaminated")
    size_of = F.size("words") - (F.element_at("words", 1) == "").cast("int") - ((F.element_at("words", -1) == "") & (F.size("words") > 1)).cast("int")
    rows = keyed.select("doc_id", *_KEY, _split("text").alias("words")).select("doc_id", *_KEY, size_of.cast("bigint").alias("n_words"))
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(found, _KEY, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(items_found).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(items_found)).cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` without the rows that hold a window of an item."""
    _, matches = phrase_matches(docs, items, id_col, text_col, size)
    keys = kept(matches.select(F.col("id_key").alias("_id"), F.col("text_key").alias("_text")).distinct(), "hit-documents")
    rows = whole_rows(docs, id_col, text_col)
    row_id = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)))
    row_text = F.xxhash64(text_or_empty("text"), F.col("doc_id").isNull())
    here = (row_id == F.col("_id")) & (row_text == F.col("_text"))
    return rows.join(broadcast_if_small(keys), here, "left_anti").select("doc.*")


def op4_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
lens AS (SELECT DISTINCT least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, list_slice(w, i, i + least(len(w), 10) - 1) AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
m AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
          FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
