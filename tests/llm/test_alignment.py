"""Groups, links and counts against brute force over whole texts."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from letterlake.llm import alignment
from tests.llm.rows import documents, sorted_rows, with_clashing

ODD = [
    None, "", " ", "a", "hello <|endoftext|> world <s> </s>", "two  spaces\n\nand\ttabs", "aaa aaaa aaa", "日本語のテキスト é ü ß",
    "lower one eighth ▁ is lost", "<0x41> A", "\x00\x01", "x" * 3000, "tokenizer tokenizers tokenization", "hi", "hi",
]


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "internationalization", "Größe", "don't", "e.g.", "naïve", "thntdor", "ereaningth", "12345", "(x)", "—"]
    texts = ODD + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(30)]
    return [(i, text, "en", "s") for i, text in enumerate(texts)] + [(None, "no id", "en", "s")]


def brute(rows):
    side_a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    side_a.encode_special_tokens = True
    side_b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of = alignment.byte_level()

    def piece_bytes(number):
        piece = side_b.id_to_piece(number)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def ranges(tokens):
        end = 0
        for number, data in tokens:
            yield number, end, (end := end + len(data))

    counts, per_document = Counter(), []
    for doc_id, text, *_ in rows:
        found = side_a.encode(" " + (text or ""), add_special_tokens=False)
        a = [(number, bytes(byte_of[c] for c in token)) for number, token in zip(found.ids, found.tokens, strict=True)]
        b = [(number, piece_bytes(number)) for number in side_b.encode(text or "")]
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(data for _, data in side) != whole for side in (a, b)):
            per_document.append((doc_id, 0, 0, 0, [], ""))
            continue
        a, b = list(ranges(a)), list(ranges(b))
        cuts = sorted({end for *_, end in a} & {end for *_, end in b})
        groups = [
            "|".join(",".join(str(n) for n, start, end in side if low <= start and end <= high) for side in (a, b))
            for low, high in zip([0, *cuts], cuts, strict=False)
        ]
        links = [(x, y) for x, low, high in a for y, start, end in b if start < high and low < end]
        counts.update(links)
        per_document.append((doc_id, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    rows = [
        (doc_id, n_a, n_b, n, len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), digest)
        for doc_id, n_a, n_b, n, links, digest in per_document
    ]
    return rows, {(a, b, n, n == highest[b]) for (a, b), n in counts.items()}


@pytest.mark.parametrize(("seed", "block"), [(1, 100), (2, 1 << 24)])
def test_alignment(spark, seed, block):
    rows = corpus(seed)
    expected, expected_pairs = brute(rows)
    found, pairs = alignment.align(with_clashing(documents(spark, rows)), block_chars=block)
    assert sorted_rows(found) == sorted(expected, key=str)
    assert {tuple(row) for row in pairs.collect()} == expected_pairs


def test_lost_characters_have_no_tokens(spark):
    found, _ = alignment.align(documents(spark, [(1, "a ▁ b", "en", "s")]))
    assert tuple(found.first()) == (1, 0, 0, 0, 0, 0, 0, "")


def answers_and_documents(sizes, n_pairs):
    """A block's pairs and then its documents, as ``_scored`` reads them; links number ids below 5 and the pairs."""
    rng = np.random.default_rng(7)
    links = rng.integers(0, 5 + n_pairs, sum(sizes)).astype(np.int32)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    names = ["kind", "block", "number", "count", "best", "doc_id", *alignment.STATISTICS, "groups_sha256", "links"]

    def batch(n, **given):
        return pa.RecordBatch.from_arrays([given.get(name, pa.nulls(n, pa.int64())) for name in names], names=names)

    counts, best = rng.integers(1, 1 << 40, n_pairs), rng.random(n_pairs) < 0.5
    pairs = batch(
        n_pairs,
        kind=pa.array([alignment.PAIR] * n_pairs),
        block=pa.array([3] * n_pairs),
        number=pa.array(np.arange(n_pairs)),
        count=pa.array(counts),
        best=pa.array(best),
    )
    n = len(sizes)
    docs = batch(n, kind=pa.array([alignment.DOCUMENT] * n), block=pa.array([3] * n), links=pa.ListArray.from_arrays(pa.array(offsets), pa.array(links)))
    vectors = np.arange(1, 6, dtype=np.int64), np.array([True, False, True, True, False])
    shared = SimpleNamespace(value=vectors)
    all_counts, all_best = np.concatenate((vectors[0], counts)), np.concatenate((vectors[1], best))
    spans = [links[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
    expected = [(int(all_best[x].sum()), int(all_counts[x].sum())) for x in spans]
    return shared, [pairs, docs], expected


def summed(shared, batches):
    out = list(alignment._scored(5, shared)(iter(batches)))
    return [pair for x in out for pair in zip(x.column(5).to_pylist(), x.column(6).to_pylist(), strict=True)]


@pytest.mark.parametrize("piece", [1, 4, 1 << 19])
def test_links_are_summed_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(alignment, "SUMMED", piece, raising=False)
    shared, batches, expected = answers_and_documents([0, 3, 0, 0, 9, 1, 4, 0], 11)
    assert summed(shared, batches) == expected
    # The first rows cut off: links begin amid the values.
    assert summed(shared, [batches[0], batches[1].slice(3)]) == expected[3:]


def test_links_take_little_memory():
    shared, batches, expected = answers_and_documents([1000] * 4000, 1000)
    tracemalloc.start()
    found = summed(shared, batches)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == expected
    assert peak < 40e6
