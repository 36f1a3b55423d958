"""The language model against a plain one, its accuracy on held-out labels, and other scripts."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from letterlake.llm import quality

from .rows import documents, labels

SMALL = "/root/testdata/sf0.01"
WORDS = {
    "en": "the mail was sent to every reader of our list and most of them opened it before noon on that day".split(),
    "ru": "письмо было отправлено всем читателям нашего списка и многие открыли его до полудня того дня".split(),
    "zh": "今天 我们 把 信件 发送 给了 所有的 读者 其中 大多数 人 在 中午 之前 打开了 它 并且 点击了 链接".split(),
}


def _plain_grams(text):
    got = "".join(map(chr, quality.symbols(text)))
    return [got[i : i + 4] for i in range(len(got) - 3)]


def _plain_model(texts):
    """p of an n-gram of four, from nested dictionaries."""
    counts = {4: Counter(g for text in texts for g in _plain_grams(text))}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cuts, totals, freed = {}, defaultdict(float), defaultdict(float)
    for k, seen in counts.items():
        n = [sum(c == i for c in seen.values()) for i in (1, 2, 3, 4)]
        d = [0.5, 0.75, 0.9]
        if all(n):
            y = n[0] / (n[0] + 2 * n[1])
            d = [min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.05), i + 0.95) for i in range(3)]
        for gram, c in seen.items():
            cuts[gram] = d[min(c, 3) - 1]
            totals[k, gram[:-1]] += c
            freed[k, gram[:-1]] += cuts[gram]

    def p(gram):
        if not gram:
            return 1 / (len(counts[1]) + 1)
        k, context = len(gram), gram[:-1]
        if (k, context) not in totals:
            return p(gram[1:])
        own = (counts[k][gram] - cuts[gram]) / totals[k, context] if gram in counts[k] else 0.0
        return own + freed[k, context] / totals[k, context] * p(gram[1:])

    return p, counts


def _texts(rng, lang, n, junk=False):
    out = []
    for _ in range(n):
        words = [rng.choice(WORDS[lang]) for _ in range(rng.randrange(30, 90))]
        if junk:
            letters = sorted(set("".join(words)))
            words = ["".join(rng.choice(letters) for _ in word) for word in words]
        out.append(("" if lang == "zh" else " ").join(words))
    return out


@pytest.mark.parametrize("block_chars", [200, quality.BLOCK_CHARS])
def test_score_against_a_plain_model(spark, block_chars):
    rng = random.Random(4)
    texts = [(i, lang, True, text) for i, (lang, text) in enumerate((x, t) for x in WORDS for t in _texts(rng, x, 8))]
    texts += [(100, "en", False, "zzz \U0001f600 unseen unseen 42"), (101, None, False, ""), (102, "en", False, "a"), (103, "ru", True, "\x01\x02 \t1")]
    rows = spark.createDataFrame(texts, "doc_id bigint, lang string, trusted boolean, text string").withColumn("counted", F.col("trusted")).repartition(3)
    got = {r.doc_id: (r.n_symbols, r.bits) for r in quality.score(rows, block_chars).collect()}
    p, _ = _plain_model([t[3] for t in texts if t[2]])
    assert len(got) == len(texts)
    for key, _, _, text in texts:
        grams = _plain_grams(text)
        assert got[key][0] == len(grams)
        assert got[key][1] == pytest.approx(sum(-math.log2(p(g)) for g in grams), rel=1e-6, abs=1e-6)


def test_places_by_table_and_by_search_are_the_same(monkeypatch):
    rng = np.random.default_rng(9)
    for size in (1, 300, quality._PLACES, quality._PLACES + 1):
        values = rng.integers(0, size, 5_000).astype(np.int32)
        found = quality._ranked(values, size)
        with monkeypatch.context() as m:
            m.setattr(quality, "_PLACES", 0)
            searched = quality._ranked(values, size)
        for a, b in zip(found, searched, strict=True):
            assert a.dtype == b.dtype and (a == b).all()
        assert (found[0][found[1]] == values).all()


def test_grams_of_any_alphabet():
    """Sorting and the table give the same; so does an alphabet beyond sixteen bits."""
    wide = "".join(map(chr, range(0x100, 0xD800))) + "".join(map(chr, range(0x10000, 0x18000)))
    texts = ["abab abab", "", "a", wide, wide[::-1]]
    contexts, last, places, sizes = quality.grams(texts)
    assert list(sizes) == [len(_plain_grams(t)) for t in texts]
    shift = np.array([2 * 21, 21, 0])
    found = ["".join(map(chr, [*((int(c) >> s) & (1 << 21) - 1 for s in shift), x])) for c, x in zip(contexts, last.tolist(), strict=True)]
    assert [found[i] for i in places] == [g for t in texts for g in _plain_grams(t)]
    assert len(set(found)) == len(found)
    assert [len(x) for x in quality.grams([])] == [0, 0, 0, 0]


@pytest.mark.parametrize("held", [1, 700, 1 << 20])
def test_bundles_hold_all_answers_in_less_room(held):
    rng = np.random.default_rng(8)
    blocks, numbers = np.repeat([5, 1 << 32, 7], 2_000), np.tile(np.arange(2_000, dtype=np.int32), 3)
    bits = rng.random(6_000, np.float32)
    order = rng.permutation(6_000)
    arrays = [pa.array(x[order]) for x in (blocks, numbers, bits)]
    batch = pa.RecordBatch.from_arrays(arrays, names=["block", "number", "bits"])
    found, room = {}, 0
    for out in quality._bundled(held)(iter([batch.slice(0, 2_500), batch.slice(2_500, 0), batch.slice(2_500)])):
        for block, n, value in zip(*(column.to_pylist() for column in out.columns), strict=True):
            places, answers = quality._unbundled(n, value)
            room += len(value)
            for place, answer in zip(places.tolist(), answers.tolist(), strict=True):
                assert (block, place) not in found
                found[block, place] = answer
    assert found == {(b, n): x for b, n, x in zip(blocks.tolist(), numbers.tolist(), bits.tolist(), strict=True)}
    assert room < 8 * len(order)
    assert list(quality._bundled(held)(iter([]))) == []


def test_probabilities_add_up(spark):
    """Over all symbols and the unseen one, after contexts seen and unseen."""
    texts = _texts(random.Random(5), "en", 20)
    _, counts = _plain_model(texts)
    alphabet = [*counts[1], "一"]
    contexts = ["the", "mai", "qqq", "\x02\x02\x02"]
    pack = lambda c: (ord(c[0]) << 42) | (ord(c[1]) << 21) | ord(c[2])
    seen = spark.createDataFrame([(pack(g[:3]), ord(g[3]), n) for g, n in counts[4].items()], "context bigint, symbol int, n bigint")
    asked = spark.createDataFrame([(pack(c), ord(s)) for c in contexts for s in alphabet], "context bigint, symbol int")
    sums = quality.probabilities(seen, asked).groupBy("context").agg(F.sum("p").alias("p")).collect()
    assert len(sums) == len(contexts)
    assert all(row.p == pytest.approx(1.0, abs=1e-9) for row in sums)


def test_junk_is_told_from_prose_in_every_script(spark):
    rng = random.Random(6)
    rows, good = [], set()
    for lang in WORDS:
        for text in _texts(rng, lang, 60):
            good.add(len(rows))
            rows.append((len(rows), text, lang, "a"))
        rows += [(len(rows) + i, text, lang, "a") for i, text in enumerate(_texts(rng, lang, 20, junk=True))]
    known = [(i, 1, 0) for i in good if i % 2]
    got = {r.doc_id: r.kept for r in quality.judge(documents(spark, rows), labels(spark, known)).collect()}
    for lang in WORDS:
        own = [r[0] for r in rows if r[2] == lang]
        assert not any(got[i] for i in own if i not in good)
        held_out = [got[i] for i in own if i in good and not i % 2]
        assert sum(held_out) >= 0.9 * len(held_out)


def test_accuracy_on_held_out_labels(spark):
    docs, marks = (spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    judged = quality.judge(docs, marks.where(~held_out))
    rows = judged.join(marks.where(held_out & F.col("quality").isNotNull()).select("doc_id", "quality").distinct(), "doc_id").collect()
    right = sum(r.kept == (r.quality == 1) for r in rows)
    assert len(rows) > 50 and right >= 0.9 * len(rows)
    for value in (0, 1):
        own = [r.kept == (value == 1) for r in rows if r.quality == value]
        assert sum(own) >= 0.9 * len(own)


def test_texts_stay_in_their_buckets(spark, monkeypatch):
    plans, kept = {}, quality.kept

    def noted(rows, name):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return kept(rows, name)

    monkeypatch.setattr(quality, "kept", noted)
    rows = spark.createDataFrame([(i, "en", i % 2 == 0, f"text number {i}") for i in range(40)], "doc_id bigint, lang string, trusted boolean, text string")
    tables = spark.catalog.listTables()
    assert quality.score(rows.withColumn("counted", F.col("trusted")), 100).count() == 40
    # The answers are dealt by block, the blocks are read where they lie.
    assert plans["scores"].count("Exchange hashpartitioning(block") == 1
    assert "Bucketed: true" in plans["scores"]
    assert spark.catalog.listTables() == tables
