"""Held-out accuracy on the given labels, unseen spellings, and rows of every kind."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from letterlake.llm import toxicity
from letterlake.llm.common import table
from tests.llm.rows import documents, labels, sorted_rows, with_clashing

LARGER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    rows = toxicity.op11_toxicity(spark, LARGER).join(table(spark, LARGER, "labels"), "doc_id").collect()
    return [row for row in rows if row.held_out and row.toxic is not None]


def test_held_out_accuracy(scored):
    clean = [row for row in scored if not row.toxic]
    toxic = [row for row in scored if row.toxic]
    assert sum(row.predicted for row in clean) <= 0.02 * len(clean)
    assert sum(row.predicted for row in toxic) >= 0.8 * len(toxic)
    ranks = np.argsort(np.argsort([row.score for row in scored]))
    above = ranks[[bool(row.toxic) for row in scored]].sum() - len(toxic) * (len(toxic) - 1) / 2
    assert above / len(toxic) / len(clean) >= 0.93


def test_held_out_rows(scored):
    assert all(zlib.crc32(str(row.doc_id).encode()) % 3 == 1 for row in scored)


def test_unseen_spellings():
    """Spellings of learnt words that no text of the sample has."""
    rng = np.random.default_rng(1)
    plain = ["".join(rng.choice(list("aeiounrst"), 6)) for _ in range(400)]

    def text(*more):
        found = [*rng.choice(plain, 30), *more]
        rng.shuffle(found)
        return " ".join(found)

    texts = [text() for _ in range(200)] + [text(rng.choice(["worthless", "pathetic"])) for _ in range(200)]
    scorer = toxicity.Scorer(*toxicity.learn(texts, [0] * 200 + [1] * 200))
    clean, *toxic = scorer.scores([text(), text("worthlesss"), text("patheticc"), text("wworthless")])
    assert clean < 0.5 and min(toxic) >= toxicity.THRESHOLD


def test_bags():
    """The vectorised hashes of a word do not depend on its neighbours; n-grams are of characters."""
    words = ["a", "héllo", "日本語", "x" * toxicity.LONGEST_WORD, "\U0001f600b"]
    buckets, sizes = toxicity.bags(words)
    assert list(sizes) == [1 + sum(max(len(word) + 3 - n, 0) for n in toxicity.GRAMS) for word in words]
    for word, own in zip(words, np.split(buckets, np.cumsum(sizes)[:-1]), strict=True):
        assert sorted(toxicity.bags([word])[0]) == sorted(own)
    shared = set(toxicity.bags(["worthless"])[0]) & set(toxicity.bags(["worthlesss"])[0])
    assert len(shared) > 15


def test_words():
    assert toxicity.words(" The,  river!\n(x) -- the the END ") == ["the", "river", "x", "the", "end"]
    assert toxicity.words("y" * 60) == ["y" * 24, "y" * 24, "y" * 12]


def test_unusual_rows(spark):
    docs = documents(spark)
    model = toxicity.fit(docs, labels(spark))
    plain = sorted_rows(toxicity.score(docs, model))
    assert len(plain) == docs.count() and all(0 <= score <= 1 for _, score in plain)
    assert sorted_rows(toxicity.score(with_clashing(docs), toxicity.fit(with_clashing(docs), with_clashing(labels(spark))))) == plain
    assert toxicity.score(documents(spark, []), model).collect() == []
    nothing = toxicity.fit(docs, labels(spark, []))
    assert {row.score for row in toxicity.score(docs, nothing).collect()} == {0.5}


def test_held_out_labels_do_not_teach(spark):
    """The model is the same whatever the labels of rows that may not teach."""
    docs = documents(spark, [(i, f"word{i} other{i % 5} text", "en", "s") for i in range(40)])
    marked = [(i, 1, i % 2) for i in range(40)]
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in marked]
    usable = ~toxicity.held_out(F.col("doc_id"))
    models = [toxicity.fit(docs, labels(spark, rows), usable) for rows in (marked, turned)]
    assert models[0] == models[1]
