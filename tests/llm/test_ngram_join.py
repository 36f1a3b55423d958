import random
import re
from itertools import combinations
from string import ascii_lowercase, ascii_uppercase

import pytest
from pyspark.sql import functions as F

from letterlake.llm import ngram_join
from letterlake.llm.components import components

LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)


def sets_of(texts, n):
    out = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set())
    return out


def roots(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def brute(rows, n, percent):
    found = dict(zip([i for i, _ in rows], sets_of([t for _, t in rows], n), strict=True))
    links = [(a, b) for a, b in combinations(found, 2) if found[a] and found[b] and 100 * len(found[a] & found[b]) >= percent * len(found[a] | found[b])]
    return {i: (len(found[i]), root) for i, root in roots(found, links).items()}


def corpus(seed):
    """Families of near copies around originals, copies of copies, a shared passage, tiny and empty texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = [rng.choice(vocabulary) for _ in range(12)]
    texts = [None, "", "  ", "a", "A", "a b", "É", "é"]
    for _ in range(9):
        original = [rng.choice(vocabulary) for _ in range(rng.randint(4, 90))]
        if rng.random() < 0.5:
            original += passage
        texts.append(" ".join(original))
        for _ in range(rng.randint(0, 9)):
            copy = list(original)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 2)
            texts.append("\t ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
            if rng.random() < 0.3:
                original = copy
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "n", "percent", "long_list"), [(1, 3, 90, 4096), (2, 3, 90, 1), (3, 5, 80, 4096), (4, 2, 60, 8), (5, 1, 50, 1)])
def test_components_equal_brute_force(spark, monkeypatch, seed, n, percent, long_list):
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = ngram_join.ngram_components(docs, n=n, percent=percent, sketch_bits=10).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, n, percent)


def test_links_inside_a_group_alone_on_its_lists(spark):
    """A, B, C with one prefix that no other text has; only B and C are alike. Of 16 such triples each member leads some."""
    rng = random.Random(11)
    words = lambda name, size: [f"{name}{rng.randrange(10**9)}" for _ in range(size)]
    first = words("f", 2)
    x, y = first + words("x", 60), first + words("y", 60)
    tails = [x, y, y[:-2] + words("z", 2)]
    texts = [" ".join(words("own", 90) + tail) for tail in tails for _ in range(10)]
    for _ in range(16):
        passage = words("p", 40)
        texts += [" ".join(passage + tail) for tail in tails]
    rows = list(enumerate(texts))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == brute(rows, 3, 90)
    assert all(found[i + 2][1] == i + 1 and found[i][1] == i for i in range(30, 78, 3))


def test_unusual_rows(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, long, "a"), (1, long, "a"), (None, long, None), (2, long + " end", "b"), (3, None, "c"), (3, "other words here now", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, size string")
    found = sorted(((r.doc_id, r.component_id) for r in ngram_join.ngram_components(docs).collect()), key=str)
    assert found == sorted([(1, 1), (1, 1), (None, 1), (2, 1), (3, 3), (3, 3)], key=str)
    kept = ngram_join.drop_alike(docs, n=5, percent=80).collect()
    assert sorted((str(r.doc_id), r.size) for r in kept) == [("1", "a"), ("1", "a"), ("3", "c"), ("3", "c"), ("None", None)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert ngram_join.ngram_components(docs).count() == 0


def test_components_of_a_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).where(F.lit(True)).count() == 0
