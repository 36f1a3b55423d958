"""Personal data: fixed patterns, and identifiers found by the contexts they keep.

Base spans come from four patterns. They seed the bootstrap: the words before and after a span are a
lexical pattern, and every identifier-like token of the corpus stands in such patterns too. Spark
scores the graph of patterns and instances in rounds: a pattern is as good as the share of its
instances that are trusted, an instance as good as the patterns it stands in. High-confidence
patterns then give a kind to unseen identifiers, which are added as spans. Base spans always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterlake.llm.common import kept, table, text_or_empty

# The patterns and the order of kinds in the digests.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

ROUNDS = 3
# A pattern is used for discovery from so many distinct trusted instances and this score on.
MIN_SUPPORT = 5
MIN_SCORE = 0.8

_COMPILED = {kind: re.compile(pattern) for kind, pattern in PATTERNS.items()}
# The same matches: one never begins within a run of digits, as its first part would take the whole run.
_COMPILED["ip"] = re.compile(r"(?<![0-9])" + PATTERNS["ip"])
# An email can only begin in the run of its own characters before an @.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
# What could be an identifier: six characters and more of these, with a digit or an @ from there on in
# the same unspaced text. Each pattern begins in one place of a run, so a run is read once, however long.
_UNSPACED = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_TOKEN = re.compile(r"[A-Za-z0-9+(][A-Za-z0-9@._%+()\-]*")
_NOT_LAST = "@._%+(-"
_CANDIDATE_CHARS = 6


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    return sum(d if i % 2 == 0 else (2 * d) // 10 + (2 * d) % 10 for i, d in enumerate(reversed(digits))) % 10 == 0


def _valid(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(int(part.lstrip("0")[:4] or 0) <= 255 for part in text.split("."))
    if kind == "card":
        digits = _digits(text)
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_digits(text)) <= 15
    return True


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the email pattern's leftmost matches, looking only around each @."""
    done = 0
    at = text.find("@")
    while at >= 0:
        first = at
        while first > done and _LOCAL.fullmatch(text, first - 1, first):
            first -= 1
        found = _COMPILED["email"].match(text, first) if first < at else None
        if found:
            yield found.span()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind and start; per kind leftmost, non-overlapping, failing ones dropped."""
    spans = [("email", *span) for span in _emails(text)] if "@" in text else []
    for kind in KINDS[1:]:
        if kind == "phone" and "+" not in text:
            continue
        spans += [(kind, *m.span()) for m in _COMPILED[kind].finditer(text) if _valid(kind, m.group())]
    return spans


def _context(text: str, start: int, end: int) -> tuple[str, str]:
    """The nearest word on either side, in small letters, digits as 0."""
    before = text[max(0, start - 80) : start].split()
    after = text[end : end + 80].split()
    clean = lambda words, i: re.sub(r"[0-9]", "0", words[i].lower().strip(".,:;=\"'()")) if words else ""
    return clean(before, -1), clean(after, 0)


def _shape(token: str) -> str:
    """Runs of letters as a, of digits as 0, other characters as they are."""
    return re.sub(r"[0-9]+", "0", re.sub(r"[A-Za-z]+", "a", token))


def patterns(found: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT, min_score: float = MIN_SCORE) -> DataFrame:
    """(pattern, shape, kind): contexts that, with a token of that shape, tell a kind.

    Nodes are patterns (a context word and the token's shape) and instances (a token); an edge is
    their meeting, however often. Trust starts at 1 for seeds and 0 elsewhere and flows both ways.
    Edges are counted before they are joined, so one frequent word is one node, not many rows.
    """
    edges = kept(
        found.select("kind", F.xxhash64("token").alias("instance"), "shape", F.explode("patterns").alias("pattern"))
        .where("pattern not in ('L ', 'R ')")
        .groupBy("pattern", "shape", "instance")
        .agg(F.max("kind").alias("kind")),
        "pattern-graph",
    )
    trust = edges.groupBy("instance").agg(F.max("kind").alias("kind"), F.when(F.max("kind").isNotNull(), 1.0).otherwise(0.0).alias("trust"))
    trust = kept(trust, "instance-trust")
    graph = edges.select("pattern", "shape", "instance")
    for _ in range(rounds):
        votes = graph.join(trust, "instance")
        by_kind = votes.where("kind is not null").groupBy("pattern", "shape", "kind").agg(F.sum("trust").alias("mass"), F.count_if(F.col("trust") >= min_score).alias("support"))
        everything = votes.groupBy("pattern", "shape").agg(F.count("*").alias("met"))
        best = by_kind.groupBy("pattern", "shape").agg(F.max_by(F.struct("kind", "mass", "support"), F.struct("mass", "kind")).alias("b"))
        scored = kept(best.join(everything, ["pattern", "shape"]).select("pattern", "shape", "b.kind", (F.col("b.mass") / F.col("met")).alias("score"), "b.support"), "pattern-scores")
        good = scored.where((F.col("support") >= min_support) & (F.col("score") >= min_score))
        seen = graph.join(good.select("pattern", "shape", F.col("kind").alias("told"), "score"), ["pattern", "shape"])
        reached = kept(seen.groupBy("instance").agg(F.max_by("told", F.struct("score", "told")).alias("told"), F.max("score").alias("reach")), "instance-scores")
        trust = kept(
            trust.join(reached, "instance", "left").select("instance", F.coalesce("kind", "told").alias("kind"), F.greatest("trust", F.coalesce("reach", F.lit(0.0))).alias("trust")),
            "instance-trust",
        )
    return good.select("pattern", "shape", "kind")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found.

    The four counts and the digest are of base spans; ``spans`` has all, as kind:start:end in code
    points by kind and start, and ``n_found`` counts the added ones. A null or empty text has none.
    Null and repeated ids are kept as they are: rows are told apart by a number of their own.
    """
    spans = kept(_numbered_mentions(docs, id_col, text_col), "mentions")
    rows = spans.where("place = -1").select("row", "doc_id")
    found = spans.where("place >= 0").drop("doc_id")
    told = kept(patterns(found), "patterns")
    unseen = found.where("kind is null").select("row", "start", "end", "shape", F.explode("patterns").alias("pattern"))
    # Both sides of an unseen token must tell the same kind, or one side tell it and the shape be a seed's.
    shapes = kept(found.where("kind is not null").groupBy("shape", F.col("kind").alias("shape_kind")).count().where(F.col("count") >= MIN_SUPPORT).drop("count"), "seed-shapes")
    hits = unseen.join(told, ["pattern", "shape"]).groupBy("row", "start", "end", "shape").agg(F.min("kind").alias("kind"), F.max("kind").alias("other"), F.count("*").alias("sides"))
    hits = hits.where("kind = other").join(shapes, "shape", "left").where("sides = 2 or shape_kind = kind").select("row", "kind", "start", "end", F.lit(False).alias("base")).distinct()
    base = found.where("kind is not null").select("row", "kind", "start", "end", F.lit(True).alias("base"))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    listed = base.unionByName(hits).select("row", F.struct(order.alias("k"), "start", "end", "kind", "base").alias("s"))
    by_row = kept(listed.groupBy("row").agg(F.array_sort(F.collect_list("s")).alias("all")), "spans")
    joined = rows.join(by_row, "row", "left").withColumn("all", F.coalesce("all", F.array().cast(by_row.schema["all"].dataType)))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    own = F.filter("all", lambda s: s["base"])
    own_kinds = F.transform(own, lambda s: s["kind"])
    counts = [(F.size(own) - F.size(F.array_remove(own_kinds, k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return joined.select(
        "doc_id",
        *counts,
        F.sha2(text(own).cast("binary"), 256).alias("base_sha256"),
        text(F.col("all")).alias("spans"),
        F.size(F.filter("all", lambda s: ~s["base"])).cast("bigint").alias("n_found"),
    )


def _numbered_mentions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Mentions by row number, and for each row one with place -1 that has its id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                entries = [(row, doc_id, -1, None, None, None, None, None, None)]
                for place, (kind, start, end) in enumerate(_all_mentions(text)):
                    left, right = _context(text, start, end)
                    token = text[start:end]
                    entries.append((row, None, place, kind, start, end, token, _shape(token), [f"L {left}", f"R {right}"]))
                for entry in entries:
                    for column, value in zip(out, entry, strict=True):
                        column.append(value)
                row += 1
            types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string())]
            names = ["row", "doc_id", "place", "kind", "start", "end", "token", "shape", "patterns"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return source.mapInArrow(
        run, "row bigint, doc_id bigint, place int, kind string, start bigint, end bigint, token string, shape string, patterns array<string>"
    )


def _all_mentions(text: str) -> list[tuple[str | None, int, int]]:
    """Base spans, then the identifier-like tokens that touch none of them (kind None)."""
    spans = base_spans(text)
    taken = sorted((start, end) for _, start, end in spans)
    found: list[tuple[str | None, int, int]] = list(spans)
    i = 0
    for start, end in _candidates(text):
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if i == len(taken) or taken[i][0] >= end:
            found.append((None, start, end))
    return found


def _candidates(text: str) -> Iterator[tuple[int, int]]:
    for unspaced in _UNSPACED.finditer(text):
        last = unspaced.end() - 1
        while text[last] not in "0123456789@":
            last -= 1
        for token in _TOKEN.finditer(text, *unspaced.span()):
            start = token.start()
            length = len(token.group().rstrip(_NOT_LAST))
            if length >= _CANDIDATE_CHARS and start <= last:
                yield start, start + length


def op7_pii(spark, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))
