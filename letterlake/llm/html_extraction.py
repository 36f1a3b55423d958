"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is the chain of its blocks. Features are the tags and class words of a block's ancestors and
measures of its text; the field weighs them with the labels' transitions. It is trained on labelled
pages: a small grammar of layouts whose parts are known, and a bounded sample of the given pages that
mark their article themselves. Viterbi decoding picks the blocks of each page.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterlake.llm.common import table, text_or_empty
from letterlake.llm.html_blocks import Block, blocks

# Training: pages of the grammar, given pages at most and how much one counts beside a page of the grammar
# (a corpus may know a single layout), characters of a given page and blocks of a page at most, rounds.
GRAMMAR_PAGES = 480
SAMPLE_PAGES = 100
SAMPLE_WEIGHT = 0.25
SAMPLE_CHARS = 1_000_000
TRAIN_BLOCKS = 80
ROUNDS = 200
# Features of fewer training pages have no weight.
RARE = 3
_SLOTS = 1 << 16


@lru_cache(maxsize=4096)
def _path_features(path: tuple[tuple[str, tuple[str, ...]], ...]) -> frozenset[str]:
    """What the ancestors say; pages of a layout share them."""
    found = {"bias", f"tag {path[-1][0] if path else ''}"}
    for tag, marks in path:
        found.add(f"in {tag}")
        found.update(f"word {mark.removesuffix('s')}" for mark in marks)
    # The innermost named element often says more than those around it.
    for _, marks in reversed(path):
        if marks:
            found.update(f"near {mark.removesuffix('s')}" for mark in marks)
            break
    return frozenset(found)


def _text_features(block: Block) -> list[str]:
    text, n = block.text, len(block.text)
    found = [f"length {min(n.bit_length(), 9)}", f"links {4 * block.linked // max(n, 1)}"]
    if text[-1] in ".!?…\"'”»":
        found.append("sentence")
    if re.search(r"[©®™]|\b(?i:copyright)\b", text):
        found.append("rights")
    if sum(map(text.count, "|·›")) > 1:
        found.append("separators")
    return found


def features(block: Block) -> list[str]:
    return sorted({*_path_features(tuple(block.path)), *_text_features(block)})


def _slot(feature: str) -> int:
    return zlib.crc32(feature.encode()) % _SLOTS


@lru_cache(maxsize=4096)
def _path_slots(path: tuple[tuple[str, tuple[str, ...]], ...]) -> frozenset[int]:
    return frozenset(map(_slot, _path_features(path)))


def _slots(block: Block) -> list[int]:
    return sorted({*_path_slots(tuple(block.path)), *map(_slot, _text_features(block))})


def _grammar(rng: random.Random) -> list[tuple[str, int]]:
    """(markup, is main text) parts of one page with a layout drawn from the usual ones."""
    syllables = [a + b for a in "bcdfglmnprst" for b in ("a", "e", "i", "o", "u", "en", "ar", "is")]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    line = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda: (line(3, 25).capitalize() + rng.choice([".", ".", ".", "!", ""]))
    prose = lambda: " ".join(sentence() for _ in range(rng.randint(1, 6)))
    links = lambda: "<ul>" + "".join(f'<li><a href="/{word()}">{line(1, 3)}</a></li>' for _ in range(rng.randint(2, 8))) + "</ul>"
    junk_body = lambda: rng.choice([lambda: f"<p>{prose()}</p>", links, sentence, lambda: line(1, 8), lambda: f"<h3>{line(1, 4)}</h3><p>{sentence()}</p>"])()

    def part(names: str, tags: str = "div section") -> str:
        """A box named by class or id, or by its tag."""
        name, tag = rng.choice(names.split()), rng.choice(tags.split())
        place = rng.choice(["class", "class", "id"])
        usual = rng.choice("area bar block box container inner item list module panel section widget wrap wrapper".split())
        extra = rng.choice(["", "", f" {word()}", " box", f"-{usual}", f"-{usual}", f" {name}-{usual}"])
        prefix = rng.choice(["", "", "", "site-", "page-", "main-", "global-"])
        return f'<{tag} {place}="{prefix}{name}{extra}">{junk_body()}</{tag}>'

    boxes = {
        "menu": lambda: rng.choice([f"<nav>{links()}</nav>", part("nav menu navbar navigation breadcrumb breadcrumbs topnav", "div ul nav")]),
        "header": lambda: rng.choice([f"<header>{junk_body()}</header>", part("header masthead banner site-header topbar", "div header")]),
        "footer": lambda: rng.choice([f"<footer>&copy; {word()} &middot; {sentence()}</footer>", f"<footer>{junk_body()}</footer>", part("footer site-footer copyright colophon", "div footer")]),
        "side": lambda: rng.choice([f"<aside>{junk_body()}</aside>", part("sidebar side related widget recommended trending newsletter share social tags author-bio", "div aside section")]),
        "notice": lambda: part("cookie cookies notice consent alert gdpr popup modal cookie-banner privacy", "div section p"),
        "advert": lambda: part("ad ads advert advertisement sponsored sponsor promo adbox promotion", "div aside section p"),
        "form": lambda: rng.choice([f'<form action="/s"><label>{line(1, 3)}</label><input><button>{word()}</button><p>{sentence()}</p></form>', part("form search subscribe signup login search-form", "div form")]),
        "comments": lambda: rng.choice([part("comment comments comment-list replies reply discussion respond", "div section ol"), f'<section class="comments"><h2>{line(1, 2)}</h2>' + "".join(f'<div class="comment"><p>{prose()}</p></div>' for _ in range(rng.randint(1, 5))) + "</section>"]),
    }
    some = lambda *names: [(boxes[n](), 0) for n in names if rng.random() < 0.45]

    def body() -> list[tuple[str, int]]:
        # An article's own header is its headline; the page's is none of the article.
        left, right = rng.choice([("", "")] * 5 + [("<header>", "</header>"), ('<div class="header">', "</div>")])
        out = [(f"{left}<h1>{line(2, 12).capitalize()}</h1>{right}", 1)] if rng.random() < 0.85 else []
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            if kind < 0.55:
                out.append((f"<p>{prose()}</p>", 1))
            elif kind < 0.7:
                out.append((f"<p><b>{sentence()}<br>", 1))
            elif kind < 0.78:
                out.append((f"<h2>{line(1, 6)}</h2>", 1))
            elif kind < 0.84:
                out.append((f"<blockquote>{prose()}</blockquote>", 1))
            elif kind < 0.9:
                out.append(("<ul>" + "".join(f"<li>{line(2, 14)}</li>" for _ in range(rng.randint(1, 4))) + "</ul>", 1))
            elif kind < 0.95:
                out.append((f'<p>{prose()} <a href="/{word()}">{line(1, 4)}</a> {sentence()}</p>', 1))
            else:
                out += some("advert", "side", "notice", "form")
        return out

    # An article's own names may hold any word, also one that a box around no article would have.
    junk = rng.choice("ad comment cookie footer form header menu nav newsletter notice promo related search share sidebar social tag".split())
    odd = rng.choice([f"{junk}-{word()}", f"{word()}-{junk}", f"{junk}-{word()}-{word()}", word(), f"{word()}-{word()}"])
    plain = lambda name: rng.choice([(f'<div {p}="{name}">', "</div>") for p in ("class", "id")] + [(f'<section class="{name}">', "</section>")])
    named = plain(rng.choice("content article post entry entry-content story main article-body post-body text body-text page-content".split()))
    neutral = plain(odd if rng.random() < 0.5 else rng.choice("wrap wrapper container page inner row column col-8 layout site center".split()))
    kind = rng.random()
    if kind < 0.25:
        opening, closing = "<article>", "</article>"
    elif kind < 0.35:
        opening, closing = rng.choice([("<main>", "</main>"), ("<main><article>", "</article></main>"), (f'<article class="{odd}">', "</article>")])
    elif kind < 0.55:
        opening, closing = named
    elif kind < 0.65:
        opening, closing = f"<main>{neutral[0]}", f"{neutral[1]}</main>"
    elif kind < 0.9:
        opening, closing = neutral
    else:
        opening, closing = "", ""
    # Around the article alone, or around the whole page.
    outer = plain(odd if rng.random() < 0.3 else rng.choice("wrap wrapper container page site layout".split())) if rng.random() < 0.4 else ("", "")
    if rng.random() < 0.5:
        opening, closing, outer = outer[0] + opening, closing + outer[1], ("", "")
    head = f"<!DOCTYPE html><html><head><title>{line(2, 8)}</title><style>p{{margin:0}}</style><script>var a='<p>'</script></head><body>"
    return [
        (head + outer[0], 0), *some("notice", "header", "menu", "advert", "side", "form", "menu"), (opening, 0), *body(), *some("comments", "side", "advert"), (closing, 0),
        *some("comments", "side", "advert", "form", "notice", "footer"), *([(boxes["footer"](), 0)] if rng.random() < 0.7 else []), (outer[1], 0),
    ]


def _known(parts: list[tuple[str, int]]) -> list[tuple[list[int], int]]:
    """(feature slots, label) of a grammar page's blocks; main text is wrapped in marks to tell it."""
    marked = "".join(f"\x01{re.sub(r'>([^<]*)<', lambda m: '>' + (chr(1) + m.group(1) if m.group(1).strip() else m.group(1)) + '<', text)}" if label else text for text, label in parts)
    out = []
    for block in blocks(marked):
        label = int("\x01" in block.text)
        block.text = block.text.replace("\x01", "").strip()
        if block.text and block.shown:
            out.append((_slots(block), label))
    return out


def _self_labelled(page: str) -> list[tuple[list[int], int]]:
    """Blocks of a page that marks its article, with the label its landmarks give; else none."""
    found = [b for b in blocks(page) if b.shown]
    inside = [any(tag == "article" for tag, _ in b.path) for b in found]
    if not any(inside):
        return []
    marks = {"nav", "aside", "footer", "header", "form"}
    words = {"ad", "ads", "advert", "comment", "comments", "comment-list", "sidebar", "cookie", "cookie-banner", "notice"}
    labels = [int(i and not any(tag in marks or words & set(m) for tag, m in b.path)) for i, b in zip(inside, found, strict=True)]
    return [(_slots(b), label) for b, label in zip(found, labels, strict=True)]


def train(chains: list[list[tuple[list[int], int]]], rounds: int = ROUNDS, counts: list[float] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights (slot, label) and transitions (label, label) that maximise the labels' likelihood.

    ``counts`` is how much each chain counts, 1 by default.
    """
    counts = [1.0] * len(chains) if counts is None else counts
    much = np.array([count for chain, count in zip(chains, counts, strict=True) if chain])[:, None, None]
    chains = [chain[:TRAIN_BLOCKS] for chain in chains if chain]
    pages = Counter(s for chain in chains for s in {s for slots, _ in chain for s in slots})
    used = sorted(s for s, count in pages.items() if count >= RARE)
    column = {s: i for i, s in enumerate(used)}
    longest = max(map(len, chains), default=0)
    x = np.zeros((sum(map(len, chains)), len(used)), np.float32)
    y, here = np.zeros((len(chains), longest), np.int64), np.zeros((len(chains), longest), bool)
    row = 0
    for i, chain in enumerate(chains):
        for j, (slots, label) in enumerate(chain):
            x[row, [column[s] for s in slots if s in column]] = 1
            y[i, j], here[i, j] = label, True
            row += 1
    w, moves = np.zeros((len(used), 2)), np.zeros((2, 2))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(moves), np.zeros_like(moves)]
    truth = np.eye(2)[y] * here[..., None]
    pairs = here[:, 1:]
    true_moves = np.einsum("bti,btj->ij", truth[:, :-1] * pairs[..., None] * much, truth[:, 1:])
    for step in range(1, rounds + 1):
        scores = np.zeros((len(chains), longest, 2))
        scores[here] = x @ w.astype(np.float32)
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        if longest:
            forward[:, 0] = scores[:, 0]
        for t in range(1, longest):
            last = forward[:, t - 1]
            reach = np.logaddexp(last[:, :1] + moves[0], last[:, 1:] + moves[1]) + scores[:, t]
            forward[:, t] = np.where(here[:, t, None], reach, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            then = scores[:, t + 1] + backward[:, t + 1]
            reach = np.logaddexp(moves[:, 0] + then[:, :1], moves[:, 1] + then[:, 1:])
            backward[:, t] = np.where(here[:, t + 1, None], reach, 0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        single = np.exp(forward + backward - total[:, None, None]) * here[..., None]
        double = forward[:, :-1, :, None] + moves + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        expected = (np.exp(double) * pairs[..., None, None] * much[..., None]).sum((0, 1))
        grads = [x.T @ ((truth - single) * much)[here].astype(np.float32) - 0.05 * w, true_moves - expected - 0.05 * moves]
        for k, (value, grad) in enumerate(zip((w, moves), grads, strict=True)):
            state[2 * k] = 0.9 * state[2 * k] + 0.1 * grad
            state[2 * k + 1] = 0.99 * state[2 * k + 1] + 0.01 * grad**2
            value += 0.1 * (state[2 * k] / (1 - 0.9**step)) / (np.sqrt(state[2 * k + 1] / (1 - 0.99**step)) + 1e-8)
    whole = np.zeros((_SLOTS, 2))
    whole[used] = w
    return whole, moves


def decode(scores: np.ndarray, moves: np.ndarray) -> list[int]:
    """The likeliest labels of a chain (Viterbi)."""
    best, back = scores[0], []
    for row in scores[1:]:
        reach = best[:, None] + moves
        back.append(reach.argmax(axis=0))
        best = reach.max(axis=0) + row
    labels = [int(best.argmax())]
    for step in reversed(back):
        labels.append(int(step[labels[-1]]))
    return labels[::-1]


def main_text(page: str, weights: np.ndarray, moves: np.ndarray) -> str:
    found = [b for b in blocks(page) if b.shown]
    if not found:
        return ""
    labels = decode(np.array([weights[_slots(b)].sum(axis=0) for b in found]), moves)
    return "\n".join(b.text for b, label in zip(found, labels, strict=True) if label)


def fit(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", sample: int = SAMPLE_PAGES) -> tuple[np.ndarray, np.ndarray]:
    """A field trained on the grammar and on up to ``sample`` given pages, those with the smallest ids.

    Pages of more than ``SAMPLE_CHARS`` characters and of no id are not trained on; all are extracted.
    """
    rng = random.Random(7)
    chains = [_known(_grammar(rng)) for _ in range(GRAMMAR_PAGES)]
    usable = pages.where(F.col(id_col).isNotNull() & (F.length(html_col) <= SAMPLE_CHARS)).select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    # The ids first: pages of other ids never leave their tasks.
    ids = [row.id for row in usable.select("id").distinct().orderBy("id").limit(sample).collect()]
    given = [row.html for row in usable.where(F.col("id").isin(ids)).limit(sample).collect()] if ids else []
    own = [_self_labelled(page) for page in given]
    return train(chains + own, counts=[1.0] * len(chains) + [SAMPLE_WEIGHT] * len(own))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    A null or empty page, and one without main text, has the empty text. Null and repeated ids and
    urls are carried. Nothing is cut: every block of every page is decoded.
    """
    field_ = pages.sparkSession.sparkContext.broadcast(model or fit(pages, html_col, id_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, moves = field_.value
        for batch in batches:
            texts = [main_text(page, weights, moves) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), text_or_empty(html_col).alias("html"))
    return source.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
