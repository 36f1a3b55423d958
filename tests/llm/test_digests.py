"""Results against brute force over small corpora."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from letterlake.llm import decontamination, exact_dedup, html_blocks, html_extraction, licenses, packing, pii, repeats
from letterlake.llm.tokens import Encoder, vocabulary_path
from tests.llm.rows import DOCUMENTS, documents

LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)


def corpus(seed, size=60):
    """Texts that share passages, repeat themselves and each other, with accents and odd spaces."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Größe", "naïve", "ÉCOLE", "a.b", "x-y"]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 40))) for _ in range(8)]
    texts = [None, "", " ", "w1"]
    while len(texts) < size:
        roll = rng.random()
        if roll < 0.2:
            texts.append(rng.choice(texts))
        elif roll < 0.3:
            texts.append((rng.choice(texts) or "").replace(" ", rng.choice([" \n", "\t", "\x0b\x0c"])))
        else:
            texts.append(rng.choice([" ", ", "]).join(rng.choice([*passages, *vocabulary]) for _ in range(rng.randint(1, 9))))
    rng.shuffle(texts)
    return [(i, text, "en", "s") for i, text in enumerate(texts)]


@pytest.mark.parametrize(("seed", "block", "weak"), [(1, 64, False), (2, 4, False), (3, 4, True)])
def test_exact_dedup(spark, seed, block, weak):
    """Also with fingerprints that collide: blocks are then named with another seed or compared."""
    rows = corpus(seed)
    normal = {i: re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for i, text, *_ in rows}
    members = defaultdict(list)
    for i, text in normal.items():
        members[text].append(i)
    expected = {
        (i, min(members[t]), len(members[t]), i == min(members[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in normal.items()
    }
    more = {}
    if weak:
        more["make"] = lambda value, seed: F.struct(
            F.when(F.lit(seed == 0), F.lit(0)).otherwise(F.xxhash64(value, F.lit(seed))).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b")
        )
    found = exact_dedup.exact_dedup(documents(spark, rows), block_bytes=block, **more)
    assert {tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()} == expected


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


@pytest.mark.parametrize("seed", [4, 5])
def test_contamination(spark, seed):
    rows = corpus(seed)
    rng = random.Random(seed)
    sources = [words(text) for _, text, *_ in rows if words(text)]
    texts = [" ".join(source[: rng.randint(1, 14)]).title() for source in rng.sample(sources, 6)] + ["w1 w2 nowhere", "", None, "w3", "w3"]
    items = [(i, text) for i, text in enumerate(texts, 10)]
    expected = set()
    for i, text, *_ in rows:
        have, hit, held = words(text), set(), set()
        for item, passage in items:
            asked = words(passage)
            for start in range(max(len(asked) - 9, 1) if asked else 0):
                window = asked[start : start + 10]
                for at in range(len(have) - len(window) + 1):
                    if have[at : at + len(window)] == window:
                        hit.update(range(at, at + len(window)))
                        held.add(str(item))
        digest = hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
        expected.add((i, len(have), len(hit), len(held), digest, bool(hit)))
    found = decontamination.contamination(documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {tuple(r) for r in found.collect()} == expected
    left = decontamination.drop_contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {r.doc_id for r in left.collect()} == {row[0] for row in expected if not row[5]}


def test_proximity_finds_a_passage_with_a_word_put_in(spark):
    docs = documents(spark, [(1, "zero alpha beta gamma extra delta", "en", "s"), (2, "delta gamma beta alpha", "en", "s")])
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id bigint, text string")
    found = decontamination.proximity_matches(docs, items, slack=1).select("doc_id", "item_id").distinct().collect()
    assert (1, 1) in {tuple(r) for r in found}


@pytest.mark.parametrize("seed", [6, 7])
def test_repeats(spark, seed):
    rows = corpus(seed, 40)
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdé ") for _ in range(700))
    rows += [(1000 + i, base[rng.randint(0, 300) : rng.randint(300, 700)] + rng.choice(["", "zz", base[:60]]), "en", "s") for i in range(12)]
    rows += [(2000, "q" * 49, "en", "s"), (2001, "q" * 50, "en", "s"), (2002, "q" * 120 + "r" + "q" * 49, "en", "s")]
    seen, expected = set(), set()
    for i, text, *_ in sorted(rows):
        data = (text or "").encode()
        covered = np.zeros(len(data), bool)
        strings = [data[at : at + 50] for at in range(len(data) - 49)]
        for at, string in enumerate(strings):
            if string in seen:
                covered[at : at + 50] = True
        seen.update(strings)
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        left = bytes(np.frombuffer(data, np.uint8)[~covered])
        expected.add((i, len(data), int(covered.sum()), spans, hashlib.sha256(left).hexdigest()))
    found = repeats.remove_repeats(documents(spark, rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert {tuple(r) for r in found.collect()} == expected


def test_repeats_in_small_blocks(spark, monkeypatch):
    docs = documents(spark, corpus(6, 40) + [(3000, None, "en", "s"), (3001, "", "en", "s"), (3002, "short", "en", "s")])
    whole = repeats.remove_repeats(docs).collect()
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 300)
    assert sorted(repeats.remove_repeats(docs).collect()) == sorted(whole)


def test_repeats_store_less_than_the_text(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    passages = [" ".join(rng.choices(words, k=30)) for _ in range(800)]
    rows = [(i, " ".join([*rng.choices(words, k=100), *rng.choices(passages, k=2), *rng.choices(words, k=20)]), "en", "s") for i in range(1500)]
    folder = Path(spark.conf.get("spark.checkpoint.dir"))

    def stored():
        return sum(file.stat().st_size for file in folder.rglob("*.parquet"))

    before = stored()
    assert repeats.remove_repeats(documents(spark, rows)).count() == len(rows)
    assert stored() - before < sum(len(text) for _, text, *_ in rows)


def test_packing_round_trip(spark):
    rows = [(i, text, "en", "s") for i, (_, text, *_) in enumerate(DOCUMENTS)] + [(100 + i, t, l, s) for i, t, l, s in corpus(8)]
    rows += [(200, "日本語の文 🙂 <|endoftext|>", "ja", "s")]
    encoder = Encoder(vocabulary_path())
    pieces, used = defaultdict(list), defaultdict(list)
    for r in packing.pack(documents(spark, rows), with_ids=True).collect():
        pieces[r.doc_id].append(r)
        used[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    for i, text, *_ in rows:
        own = sorted(pieces[i], key=lambda r: r.piece)
        ids = [*encoder.ids(text or ""), 2]
        assert [r.piece for r in own] == list(range(len(own))) and len(own) == -(-len(ids) // 1024)
        assert [r.start for r in own] == [sum(p.length for p in own[:k]) for k in range(len(own))]
        assert [t for r in own for t in r.ids] == ids
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024


@pytest.mark.parametrize("plain", [False, True])
def test_tokens_are_those_of_the_library(plain):
    """Every character that goes the fast way, random text, and added tokens spelt out in a text."""
    encoder, library = Encoder(vocabulary_path(), plain), Tokenizer.from_file(vocabulary_path())
    library.encode_special_tokens = plain
    rng = random.Random(7)
    texts = ["".join(map(chr, range(0x250))), "‐–—…‘’“”€", "a\r\n\t b  c   ", "don't I'LL 12345 <|endoftext|> <s>", "<|endoftext|>"]
    texts += [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in range(0x250)]
    texts += ["".join(chr(rng.choice([32, 10, rng.randint(33, 126), rng.randint(160, 0x3000)])) for _ in range(80)) for _ in range(60)]
    for text in texts:
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert encoder.ids("a <|endoftext|>").tolist()[-1] == (29 if plain else 50256)


def test_base_spans():
    text = "a.b@c.de x@y z@-.- 1.2.3.255 1.2.3.256 and 4111 1111 1111 1111 or 4111111111111112 +49 (30) 123-4567 +12 é +123456789"
    plain = []
    for kind in pii.KINDS:
        for m in re.finditer(pii.PATTERNS[kind], text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            folded = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
            valid = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and sum(folded) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            plain += [(kind, *m.span())] if valid else []
    assert pii.base_spans(text) == plain
    assert Counter(kind for kind, *_ in plain)["card"] == 1
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choice("a@.-1+ 9(é") for _ in range(30))
        emails = [("email", *m.span()) for m in re.finditer(pii.PATTERNS["email"], text)]
        assert [s for s in pii.base_spans(text) if s[0] == "email"] == emails, text
        assert [m.span() for m in pii._COMPILED["ip"].finditer(text)] == [m.span() for m in re.finditer(pii.PATTERNS["ip"], text)], text
        plain = r"(?=[^\s]*[0-9@])[A-Za-z0-9+(][A-Za-z0-9@._%+()\-]{4,}[A-Za-z0-9)]"
        assert list(pii._candidates(text)) == [m.span() for m in re.finditer(plain, text)], text
    assert pii.base_spans("0" * 500 + "7.1.1.1 1.1.1.0256") == [("ip", 0, 507)]


@pytest.mark.parametrize("unit", ["x", "1", "(", "+", "@", "a.", "1.", "a@", "+1", "1 ", "é", "1-"])
def test_pii_takes_long_runs_in_one_pass(unit):
    """Texts without the usual spaces; anything quadratic would not end."""
    pii._all_mentions(unit * 300_000)


def test_bootstrap_discovers_by_context(spark):
    """Tokens shaped as known ones in the contexts that those keep; the same tokens elsewhere stay."""
    rows = [(i, f"Her machine reached server 10.{i}.7.{i + 1} during maintenance of rack {i}.", "en", "s") for i in range(40)]
    rows += [(100 + i, f"Her machine reached server 10.{i}.7.{i + 300} during maintenance.", "en", "s") for i in range(3)]
    rows += [(200, "Section 4.300.2.999 was rewritten and the year 2024abc passed.", "en", "s")]
    found = {r.doc_id: r for r in pii.find_pii(documents(spark, rows)).collect()}
    assert all(found[i].n_ip == 1 and found[i].n_found == 0 for i in range(40))
    assert [(found[100 + i].n_ip, found[100 + i].spans) for i in range(3)] == [(0, "ip:27:37")] * 3
    assert found[200].spans == ""


def test_licenses_at_every_place_of_a_window(spark):
    rows, expected = [], set()
    for name, notice in licenses.STATEMENTS.items():
        for lead in (0, 1, 5, 6, 7, 11, 17, 40):
            rows.append((len(rows), " ".join(f"k{len(rows)}x{j}" for j in range(lead)) + f" {notice.upper()} and more follows here", "en", "s"))
            expected.add((rows[-1][0], name))
    rows.append((9999, "The license of all work is reserved to the public, version two.", "en", "s"))
    found = licenses.license_matches(documents(spark, rows)).select("doc_id", "license")
    assert {tuple(r) for r in found.collect()} == expected


@pytest.mark.parametrize("code", ["for(i=0;i<n;i++){x()}", "if(a<b){s='</p>'}", "<!-- a<b", "x='<a href=\"'"])
def test_text_after_a_script_stays(code):
    for end in ("</script>", "</SCRIPT >"):
        assert [b.text for b in html_blocks.blocks(f"<p>Before</p><script>{code}{end}<p>Article</p>")] == ["Before", "Article"]
    assert [b.text for b in html_blocks.blocks(f"<p>Before</p><script>{code}")] == ["Before"]


def test_only_the_attribute_and_the_style_hide():
    weights, moves = np.zeros((html_extraction._SLOTS, 2)), np.zeros((2, 2))
    weights[:, 1] = 1
    text = lambda attribute: html_extraction.main_text(f"<div {attribute}><p>Article</p></div>", weights, moves)
    shown = ['class="overflow-hidden"', 'class="hidden-print"', 'aria-hidden="false"', 'title="hidden gems"', 'data-x="a hidden b"', 'title="style=display:none"']
    assert [text(a) for a in shown] == ["Article"] * len(shown)
    assert [text(a) for a in ("hidden", 'hidden=""', 'id="a" HIDDEN class=b', 'style="color:red; display: none"')] == [""] * 4


def test_neighbouring_licenses_both_stay(spark):
    """Each notice cut or changed where it stands, beside a short one that is whole, at every offset of the stride."""
    notices = [({"Apache-2.0"}, "Licensed under the Apache License, Version 2.")]
    notices += [({name}, licenses.STATEMENTS[name]) for name in ("AGPL-3.0", "LGPL-3.0", "GPL-3.0", "MIT", "CC-BY-SA-4.0")]
    rows, expected = [], set()
    for names, notice in notices:
        for lead in range(licenses.STRIDE_WORDS):
            for text in (f"{notice} All rights reserved.", f"All rights reserved. {notice}"):
                rows.append((len(rows), " ".join(f"k{j}" for j in range(lead)) + f" {text} and more", "en", "s"))
                expected |= {(rows[-1][0], name) for name in names | {"Proprietary"}}
    found = licenses.license_matches(documents(spark, rows)).select("doc_id", "license")
    assert {tuple(r) for r in found.collect()} == expected
