"""The trie against brute force, with shards, blocks and queues small enough to be many."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from letterlake.llm import conversation_trie
from letterlake.llm.common import kept

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def conversations(seed):
    """Conversations that share turns, some of them copies, one long, with nulls and a row without id."""
    rng = random.Random(seed)
    rows = [(None, 1, "user", "nobody's")]
    for conv in range(50):
        if conv % 9 == 4:
            continue
        copied = [row for row in rows if row[0] == conv - 11]
        if conv % 7 == 3 and copied:
            rows += [(conv, *row[1:]) for row in copied]
            continue
        for turn in range(rng.choice([1, 2, 3, 6, 12, 40])):
            rows.append((conv, turn or None, rng.choice(["user", None]), rng.choice(["x", "é", "hello", None, ""])))
    return rows


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {conv: [row[2:] for row in sorted(found)] for conv, found in turns.items()}
    paths = {}
    for conv, own in turns.items():
        shared = zlib.crc32(str(conv).encode()) % 9
        paths[conv] = tuple(turns.get(conv - conv % 5, [])[:shared] + own[shared:])
    members, children = defaultdict(list), defaultdict(list)
    for conv in sorted(paths):
        for depth in range(len(paths[conv]) + 1):
            members[paths[conv][:depth]].append(conv)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    totals, rows = {}, []
    for prefix in sorted(members, key=len, reverse=True):
        below = [totals[child] for child in children[prefix]]
        saved = (len(members[prefix]) - 1) * len(prefix[-1][1].encode()) if prefix else 0
        totals[prefix] = sum(x for x, _ in below) or 1, sum(x for _, x in below) + saved
        ends = ",".join(str(conv) for conv in members[prefix] if len(paths[conv]) == len(prefix))
        parent = members[prefix[:-1]][0] if prefix else None
        rows.append(
            (members[prefix][0], len(prefix), parent, len(members[prefix]), len(children[prefix]), *totals[prefix], hashlib.sha256(ends.encode()).hexdigest())
        )
    return Counter(rows)


@pytest.mark.parametrize(("seed", "sizes"), [(1, {}), (2, {"shard_size": 3, "block_turns": 4, "queue_messages": 5})])
def test_trie(spark, seed, sizes):
    rows = conversations(seed)
    table = kept(spark.createDataFrame(rows, SCHEMA), "rows")
    clashing = table.withColumns({name: F.lit(f"own {name}") for name in ("pos", "a", "b", "bytes", "digest", "place", "shard", "depth", "first")})
    found = Counter(tuple(row) for row in conversation_trie.prefix_trie(clashing, **sizes).collect())
    assert found == brute(rows)


def test_many_ends_of_one_node(spark, monkeypatch):
    """One hot conversation: its members' ids pass in pieces."""
    rows = [(conv, 0, "user", "same") for conv in range(300)]
    table = kept(spark.createDataFrame(rows, SCHEMA), "rows")
    monkeypatch.setattr(conversation_trie, "PIECE_IDS", 7)
    assert Counter(tuple(row) for row in conversation_trie.prefix_trie(table, shard_size=10).collect()) == brute(rows)


def test_repeated_turns_are_kept(spark):
    rows = [(0, 1, "user", "x"), (0, 1, "user", "x"), (0, None, "user", "y")]
    found = conversation_trie.prefix_trie(kept(spark.createDataFrame(rows, SCHEMA), "rows")).collect()
    assert max(row.depth for row in found) == 3 and len(found) == 4


def test_no_conversations(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        assert conversation_trie.prefix_trie(kept(spark.createDataFrame(rows, SCHEMA), "rows")).collect() == []


@pytest.mark.parametrize("limit", [2, 3, 50, 10_000])
def test_spilling_queue(limit):
    rng = random.Random(limit)
    queue = conversation_trie.SpillingQueue(limit)
    expected = defaultdict(lambda: [0, 0, 0])
    waiting = sorted({(rng.randint(-9, 0), rng.randint(0, 60)) for _ in range(300)})
    for at, receiver in enumerate(waiting):
        for _ in range(rng.randint(0, 4)):
            later = rng.choice(waiting[at:])
            queue.push(later, (1, 2, 3))
            expected[later] = [x + y for x, y in zip(expected[later], (1, 2, 3), strict=True)]
        assert list(queue.take(receiver)) == expected[receiver]
    assert not queue.heap and not queue.heads and not queue.runs
