"""License statements in documents, by MinHash bands over text windows and exact containment.

Texts are cut into overlapping windows of words, long enough and close enough that every statement
lies whole in one of them. A window's word pairs get one MinHash value per band; a statement that
agrees with it in any band is retrieved. With one value per band, a pair of similarity s is retrieved
with probability 1 - (1 - s)**BANDS; the shortest statement fills 2 of a window's 17 pairs, which
gives more than 0.999. A retrieved pair is then verified: the share of the statement's pairs that the
window holds must reach the threshold.

Before that, texts without any key word are set aside. Each statement's key words are chosen so that
a window without them cannot reach the threshold, so nothing is lost. DataFrame functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from letterlake.llm.common import kept, table, text_or_empty
from letterlake.llm.decontamination import words

WINDOW_WORDS = 18
STRIDE_WORDS = 7
BANDS = 64
CONTAINMENT = 0.8

# Notices of public licenses, by their public short names.
STATEMENTS = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released under CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "Proprietary": "All rights reserved.",
}


def _plain_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub(r"[A-Z]", lambda m: m.group().lower(), text))


def key_words(statements: dict[str, str], containment: float) -> list[str]:
    """Words without which no statement's containment can be reached; long words first, as rare ones."""
    chosen: set[str] = set()
    for text in statements.values():
        found = _plain_words(text)
        pairs = set(zip(found, found[1:], strict=False))
        for word in sorted(set(found), key=lambda w: (-len(w), w)):
            if sum(not chosen & set(pair) for pair in pairs) < containment * len(pairs):
                break
            chosen.add(word)
    return sorted(chosen)


def _pairs(found: Column) -> Column:
    """Neighbouring words of an array, in order."""
    starts = F.sequence(F.lit(1), F.size(found) - 1)
    return F.when(F.size(found) > 1, F.transform(starts, lambda i: F.concat_ws(" ", F.element_at(found, i), F.element_at(found, i + 1))))


def _bands(pairs: Column, bands: int) -> Column:
    """The smallest hash of the pairs under each band's seed, with the band in its low bits."""
    hashes = F.transform(pairs, lambda pair: F.xxhash64(pair))
    seeds = F.sequence(F.lit(1), F.lit(bands))
    return F.transform(seeds, lambda seed: F.xxhash64(F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, seed))), seed))


def license_matches(
    docs: DataFrame,
    statements: dict[str, str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per document and license: doc_id, license, containment, n_windows, first_word.

    ``first_word`` is where the first window that holds it begins. Notices
    of different licenses share most words, and a window may cut one: a match most of whose places a
    better held one covers does not count. Notices beside each other cover different places, and all
    count. Null and empty texts match nothing;
    repeated rows of an id are one document; a null id is an id. An empty table gives no rows.
    """
    statements = statements or STATEMENTS
    spark = docs.sparkSession
    known = spark.createDataFrame(sorted(statements.items()), "license string, notice string")
    known = kept(known.select("license", F.array_distinct(_pairs(words("notice"))).alias("asked")).where("size(asked) > 0"), "statements")
    text = text_or_empty(text_col)
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).where(text.rlike(f"(?i)(?<![a-z0-9])(?:{'|'.join(map(re.escape, key_words(statements, containment)))})(?![a-z0-9])"))
    split = keyed.select("doc_id", words("text").alias("words")).where("size(words) > 1")
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 2, F.lit(0)), F.lit(STRIDE_WORDS))
    windows = split.select("doc_id", "words", F.explode(starts).alias("first_word"))
    windows = windows.select("doc_id", "first_word", _pairs(F.slice("words", F.col("first_word") + 1, WINDOW_WORDS)).alias("held")).where("held is not null")
    banded = windows.select("doc_id", "first_word", "held", F.explode(_bands(F.col("held"), bands)).alias("band"))
    # The statements are a fixed list: a row per statement and band.
    asked = F.broadcast(known.select("license", "asked", F.explode(_bands(F.col("asked"), bands)).alias("band")))
    share = F.size(F.array_intersect("held", "asked")) / F.size("asked")
    met = banded.join(asked, "band").select("doc_id", "first_word", "license", share.alias("containment"), "held", "asked").where(F.col("containment") >= containment)
    # The places of the document whose word pairs are the statement's.
    places = F.array_compact(F.transform("held", lambda pair, i: F.when(F.array_contains("asked", pair), F.col("first_word") + i)))
    met = met.select("doc_id", "first_word", "license", "containment", places.alias("places")).distinct()
    near = Window.partitionBy("doc_id").orderBy("first_word").rangeBetween(1 - WINDOW_WORDS, WINDOW_WORDS - 1)
    around = met.withColumn("around", F.collect_set(F.struct("containment", "places")).over(near))
    covered = lambda other: 2 * F.size(F.array_intersect(other["places"], F.col("places"))) > F.size("places")
    best = around.where(~F.exists("around", lambda other: (other["containment"] > F.col("containment")) & covered(other)))
    return best.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.count("*").alias("n_windows"), F.min("first_word").cast("bigint").alias("first_word")
    )


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"))
