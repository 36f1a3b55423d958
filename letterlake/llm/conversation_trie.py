"""The prefix trie of conversations, its subtree totals by time-forward processing.

**Turns to nodes.** A turn is shuffled as a 128-bit digest of its role and text. Turns are numbered by a
range sort that cuts through a long conversation: a partition counts its own, and what earlier
partitions hold is added. A prefix is named by the exclusive or of 128 bits of each (digest, depth) in
it, which adds up block by block, so no conversation is walked as a whole. A node is a distinct name;
its smallest member and its depth identify it, as no two nodes of a depth share their smallest member.

**Totals.** A node's totals need its children's. Nodes are cut into shards: below the prefixes that
``shard_size`` or more conversations share, each subtree is a shard of less than that. Within a shard
the nodes come in reverse level order, sorted by Spark, and each sends its totals forward to its parent
through a priority queue that spills. What shard roots send to the prefixes above is added up, and
those prefixes are sharded in turn, at the next power of ``shard_size``, until the root has received its
messages. The last shard of all holds at most the turns divided by the last power but one.

**Ends.** The digest over a node's ending members needs their ids in order: a range sort writes them in
pieces, which are hashed one after the other in a bounded buffer. SHA-256 has no parallel form, so the
pieces of one node pass one task as a stream.

Rows without ``conv_id`` belong to no conversation; a null role or text is empty. Turns of equal number
(repeated rows among them) are ordered by their digests and all kept. An absent or shorter source
conversation lends what it has. ``%`` is that of SQL, also below zero. No conversation gives no rows,
not even a root.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from letterlake.functions.sizes import broadcast_if_small
from letterlake.llm.common import kept, table

SHARD_SIZE = 1024
BLOCK_TURNS = 1 << 16
QUEUE_MESSAGES = 100_000
PIECE_IDS = 8192
SHARED, GROUP = 9, 5


class SpillingQueue:
    """Messages in the order of their receivers (depth falling, then id).

    At most ``limit`` messages are in memory; beyond that they are sorted, those of one receiver added
    up, and written as a run to an unnamed file of the task, like Spark's own spills: a repeated task
    writes its own. Runs are read again by their smallest message, and merged when there are many.
    """

    RUNS, PAGE = 32, 4096

    def __init__(self, limit: int = QUEUE_MESSAGES) -> None:
        self.limit, self.heap, self.runs, self.heads, self.spilled = limit, [], {}, [], 0

    def push(self, receiver: tuple[int, int], values: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, (*receiver, *values))
        if len(self.heap) >= self.limit:
            self._spill(sorted(self.heap))
            self.heap = []
            if len(self.runs) > self.RUNS:
                waiting = [self._rest(run) for run in list(self.runs)]
                self.heads = []
                self._spill(heapq.merge(*waiting))

    def _spill(self, messages) -> None:
        file = tempfile.TemporaryFile()
        page, last = [], None
        for message in messages:
            if last is not None and last[:2] == message[:2]:
                last = (*last[:2], *(x + y for x, y in zip(last[2:], message[2:], strict=True)))
                continue
            if last is not None:
                page.append(last)
            last = message
            if len(page) >= self.PAGE:
                pickle.dump(page, file)
                page = []
        pickle.dump([*page, *([last] if last is not None else [])], file)
        file.seek(0)
        self.spilled += 1
        self.runs[self.spilled] = self._read(file)
        self._advance(self.spilled)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: int) -> None:
        message = next(self.runs[run], None)
        if message is None:
            del self.runs[run]
        else:
            heapq.heappush(self.heads, (message, run))

    def _rest(self, run: int) -> Iterator[tuple]:
        head = [message for message, at in self.heads if at == run]
        return itertools.chain(head, self.runs.pop(run))

    def take(self, receiver: tuple[int, int]) -> tuple[int, int, int]:
        """The sum of the receiver's messages; receivers ask in order."""
        children = leaves = saved = 0
        while self.heap and self.heap[0][:2] == receiver:
            message = heapq.heappop(self.heap)
            children, leaves, saved = children + message[2], leaves + message[3], saved + message[4]
        while self.heads and self.heads[0][0][:2] == receiver:
            message, run = heapq.heappop(self.heads)
            children, leaves, saved = children + message[2], leaves + message[3], saved + message[4]
            self._advance(run)
        return children, leaves, saved


TOTALS = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_parent bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"


def _time_forward(bound: int, queue_limit: int):
    """Nodes in reverse level order to their totals; parents of fewer than ``bound`` members are in the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(queue_limit)
        for batch in batches:
            nodes = batch.to_pydict()
            out = {name: nodes[name] for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_parent")}
            totals: list[list[int]] = [[], [], []]
            for conv, depth, parent, n, n_parent, size, *received in zip(
                *(nodes[name] for name in (*out, "bytes", "children", "leaves", "saved")), strict=True
            ):
                children, leaves, saved = (x + (y or 0) for x, y in zip(queue.take((-depth, conv)), received, strict=True))
                leaves = leaves if children else 1
                saved += (n - 1) * size
                for column, value in zip(totals, (children, leaves, saved), strict=True):
                    column.append(value)
                if n_parent is not None and n_parent < bound:
                    queue.push((1 - depth, parent), (1, leaves, saved))
            out |= dict(zip(("n_children", "n_leaves", "saved_tokens"), totals, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in out.values()], names=list(out))

    return run


def _digest(role: Column, text: Column) -> Column:
    # The role's length first: no other pair of role and text gives the same bytes.
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def rebuilt_turns(conversations: DataFrame, block_turns: int) -> tuple[DataFrame, int]:
    """(rows, number of conversations): conv_id, pos, a, b, term_a, term_b, bytes, last.

    ``a`` and ``b`` name the prefix that ends with the row; without its terms they name the one before.
    Row 0 of every conversation is the root.
    """
    role, text = (F.coalesce(conversations[name].cast("string"), F.lit("")) for name in ("role", "text"))
    turns = conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("bigint").alias("conv_id"),
        conversations["turn"].alias("turn"),
        _digest(role, text).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    order = ("conv_id", "turn", "digest")
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = kept(ranged.select("conv_id", "digest", "bytes", F.monotonically_increasing_id().alias("place")), "turns")
    part = F.shiftright("place", 33).alias("part")
    parts = placed.groupBy("conv_id", part).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = kept(parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "turn-counts")

    convs = parts.groupBy("conv_id").agg(F.sum("n").alias("n_own"))
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).alias("shared")
    convs = convs.select("conv_id", "n_own", shared, (F.col("conv_id") - F.col("conv_id") % GROUP).alias("source"))
    lent = convs.where("conv_id = source").select(F.col("source"), F.col("n_own").alias("n_source"))
    own = F.col("conv_id") == F.col("source")
    skipped = F.when(own, 0).otherwise(F.col("shared"))
    taken = F.when(own, 0).otherwise(F.least("shared", F.coalesce("n_source", F.lit(0))))
    convs = convs.join(lent, "source", "left").select("conv_id", "source", skipped.alias("skipped"), taken.alias("taken"), "n_own")
    length = F.col("taken") + F.greatest(F.col("n_own") - F.col("skipped"), F.lit(0))
    convs = kept(convs.select("conv_id", "source", "skipped", "taken", length.alias("length")), "conversations")

    known = parts.join(convs, "conv_id").select("conv_id", "part", "first", "before", "source", "skipped", "taken", "length")
    number = (F.col("before") + F.col("place") - F.col("first")).alias("number")
    numbered = placed.withColumn("part", part).join(known, ["conv_id", "part"])
    numbered = kept(numbered.select("conv_id", number, "digest", "bytes", "source", "skipped", "taken", "length"), "numbered-turns")
    own_turns = numbered.where("number >= skipped").select(
        "conv_id", (F.col("taken") + F.col("number") - F.col("skipped") + 1).alias("pos"), "digest", "bytes", "length"
    )
    heads = numbered.where((F.col("conv_id") == F.col("source")) & (F.col("number") < SHARED - 1)).select("source", "number", "digest", "bytes")
    heads = convs.where("taken > 0").join(heads, "source").where("number < taken")
    heads = heads.select("conv_id", (F.col("number") + 1).alias("pos"), "digest", "bytes", "length")
    rows = own_turns.unionByName(heads)
    terms = [F.xxhash64("digest", "pos").alias("term_a"), F.xxhash64("pos", "digest", F.lit(1)).alias("term_b")]
    rows = rows.select("conv_id", "pos", *terms, "bytes", (F.col("pos") == F.col("length")).alias("last"), "length")
    no_turn = F.lit(0).cast("bigint")
    roots = convs.select(
        "conv_id", *[no_turn.alias(name) for name in ("pos", "term_a", "term_b", "bytes")], (F.col("length") == 0).alias("last"), "length"
    )
    rows = rows.unionByName(roots).withColumn("block", F.floor(F.col("pos") / block_turns))
    n_convs, longest = convs.agg(F.count("*"), F.max("length")).first()

    before = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    named = rows.select("*", *[F.expr(f"bit_xor(term_{x})").over(before).alias(x) for x in "ab"])
    if longest and longest >= block_turns:
        blocks = rows.where(F.col("length") >= block_turns).groupBy("conv_id", "block").agg(*[F.expr(f"bit_xor(term_{x})").alias(x) for x in "ab"])
        earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = blocks.select("conv_id", "block", *[F.expr(f"bit_xor({x})").over(earlier).alias(f"{x}_before") for x in "ab"])
        named = named.join(blocks, ["conv_id", "block"], "left")
        named = named.withColumns({x: F.col(x).bitwiseXOR(F.coalesce(f"{x}_before", F.lit(0))) for x in "ab"})
    return kept(named.select("conv_id", "pos", "a", "b", "term_a", "term_b", "bytes", "last"), "prefixes"), n_convs


def _sharded(nodes: DataFrame, turns: DataFrame, bounds: list[int]) -> DataFrame:
    """``nodes`` with ``tier`` (between which two bounds its members are) and the ``shard`` of that tier.

    The shard is named by the first prefix on the way that has fewer members than the tier's bound.
    """
    tier = sum((F.col("n_convs") >= bound).cast("int") for bound in bounds[:-1]) if len(bounds) > 1 else F.lit(0)
    nodes = nodes.withColumn("tier", tier)
    if len(bounds) == 1:
        return nodes.withColumn("shard", F.lit(0).cast("bigint"))
    wide = kept(nodes.where(F.col("n_convs") >= bounds[0]).select("pos", "a", "b", "n_convs"), "wide-prefixes")
    members = F.coalesce("n_convs", F.lit(0))
    way = turns.select("conv_id", "pos", "a", "b").join(broadcast_if_small(wide), ["pos", "a", "b"], "left")
    # The last bound is above all: its shard is the whole trie above the others.
    roots = [F.expr(f"min_by(a, pos) FILTER (WHERE coalesce(n_convs, 0) < {bound})").alias(f"shard_{at}") for at, bound in enumerate(bounds[:-1])]
    ways = way.withColumn("n_convs", members).groupBy("conv_id").agg(*roots)
    shard = F.lit(0).cast("bigint")
    for at in range(len(bounds) - 1):
        shard = F.when(F.col("tier") == at, F.col(f"shard_{at}")).otherwise(shard)
    return nodes.join(ways, "conv_id").withColumn("shard", shard).drop(*[f"shard_{at}" for at in range(len(bounds) - 1)])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ends in order to (conv_id, depth, first, ids), some thousand ids in a row."""
    node, ids = None, []

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"conv_id": [node[0]], "depth": [node[1]], "first": [ids[0]], "ids": [",".join(map(str, ids))]})

    for batch in batches:
        out = []
        for conv, depth, member in zip(*batch.to_pydict().values(), strict=True):
            if node != (conv, depth) or len(ids) >= PIECE_IDS:
                if ids:
                    out.append(done())
                node, ids = (conv, depth), []
            ids.append(member)
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if ids:
        yield done()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, running = None, None
    for batch in batches:
        out: dict[str, list] = {"conv_id": [], "depth": [], "ends_sha256": []}
        for conv, depth, ids in zip(*(batch.column(at).to_pylist() for at in (0, 1, 3)), strict=True):
            if node == (conv, depth):
                running.update(b",")
            else:
                if node:
                    for column, value in zip(out.values(), (*node, running.hexdigest()), strict=True):
                        column.append(value)
                node, running = (conv, depth), hashlib.sha256()
            running.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(out, (pa.int64(), pa.int64(), pa.string()), strict=True)], names=list(out))
    if node:
        yield pa.RecordBatch.from_pydict({"conv_id": [node[0]], "depth": [node[1]], "ends_sha256": [running.hexdigest()]})


def _end_digests(turns: DataFrame, nodes: DataFrame) -> DataFrame:
    ends = turns.where("last").select("pos", "a", "b", F.col("conv_id").alias("member"))
    ends = ends.join(nodes.select("pos", "a", "b", "conv_id"), ["pos", "a", "b"]).select("conv_id", F.col("pos").alias("depth"), "member")
    order = ("conv_id", "depth", "member")
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces, "conv_id bigint, depth bigint, first bigint, ids string")
    pieces = pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return pieces.mapInArrow(_hashed, "conv_id bigint, depth bigint, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, shard_size: int = SHARD_SIZE, block_turns: int = BLOCK_TURNS, queue_messages: int = QUEUE_MESSAGES
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, n_convs = rebuilt_turns(conversations, block_turns)
    nodes = turns.groupBy("pos", "a", "b").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("term_a").alias("term_a"),
        F.min("term_b").alias("term_b"),
        F.max("bytes").alias("bytes"),
    )
    nodes = kept(nodes, "nodes")
    bounds = [shard_size]
    while bounds[-1] <= (n_convs or 0):
        bounds.append(bounds[-1] * shard_size)

    parents = nodes.select(
        (F.col("pos") + 1).alias("pos"),
        F.col("a").alias("a_above"),
        F.col("b").alias("b_above"),
        F.col("conv_id").alias("parent_conv_id"),
        F.col("n_convs").alias("n_parent"),
    )
    above = {f"{x}_above": F.col(x).bitwiseXOR(F.col(f"term_{x}")) for x in "ab"}
    children = _sharded(nodes, turns, bounds).withColumns(above).join(parents, ["pos", "a_above", "b_above"], "left")
    children = kept(
        children.select("conv_id", F.col("pos").alias("depth"), "parent_conv_id", "n_convs", "n_parent", "bytes", "tier", "shard"), "linked-nodes"
    )
    done = None
    for at, bound in enumerate(bounds):
        tier = children.where(F.col("tier") == at)
        if done is None:
            tier = tier.select("*", *[F.lit(0).cast("bigint").alias(name) for name in ("children", "leaves", "saved")])
        else:
            sent = done.where(F.col("n_parent") >= bounds[at - 1]).groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
            sent = sent.agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
            tier = tier.join(sent, ["conv_id", "depth"], "left")
        ordered = tier.repartition("shard").sortWithinPartitions(F.col("depth").desc(), "conv_id")
        totals = kept(ordered.mapInArrow(_time_forward(bound, queue_messages), TOTALS), "totals")
        done = totals if done is None else done.unionByName(totals)
    ends = F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    return done.drop("n_parent").join(_end_digests(turns, nodes), ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends
    )


def op12_conversation_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


# Turns of equal number have no order here: the tables hold none.
ORACLE = """
with ordered as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first) - 1 as number
    from conversations where conv_id is not null),
ids as (select distinct conv_id, cast(conv_id as varchar) as digits from ordered),
-- crc32, byte by byte and bit by bit.
hashed as (
    select conv_id, conv_id - conv_id % 5 as source,
        xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(digits, ''), lambda c: ascii(c)::ubigint)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]),
                lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end)),
            4294967295::ubigint) % 9 as shared
    from ids),
turns as (
    select h.conv_id, o.role, o.text, o.number as place from hashed h join ordered o on o.conv_id = h.source where o.number < h.shared
    union all
    select h.conv_id, o.role, o.text, o.number as place from hashed h join ordered o on o.conv_id = h.conv_id where o.number >= h.shared),
rebuilt as (
    select h.conv_id, list(struct_pack(role := t.role, text := t.text) order by t.place) filter (t.conv_id is not null) as path
    from hashed h left join turns t on t.conv_id = h.conv_id group by h.conv_id),
sized as (select conv_id, coalesce(path, []) as path, coalesce(len(path), 0) as size from rebuilt),
members as (
    select conv_id, size, unnest(range(0, size + 1)) as depth, path from sized),
prefixes as (select conv_id, size, depth, path[1:depth] as prefix from members),
nodes as (
    select prefix, any_value(depth) as depth, min(conv_id) as conv_id, count(*) as n_convs,
        sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (size = depth), '')) as ends_sha256,
        case when any_value(depth) = 0 then 0 else (count(*) - 1) * octet_length(encode(any_value(prefix[-1].text))) end as saved
    from prefixes group by prefix),
children as (
    select n.*, p.conv_id as parent_conv_id from nodes n left join nodes p on p.depth = n.depth - 1 and p.prefix = n.prefix[1:n.depth - 1]),
counted as (select parent_conv_id, depth - 1 as depth, count(*) as n_children from children where depth > 0 group by all),
whole as (
    select c.*, coalesce(k.n_children, 0) as n_children from children c
    left join counted k on k.parent_conv_id = c.conv_id and k.depth = c.depth),
below as (
    select prefix[1:up] as top, n_children, saved from (select *, unnest(range(0, depth + 1)) as up from whole)),
totals as (select top, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved_tokens from below group by top)
select w.conv_id, cast(w.depth as bigint) as depth, w.parent_conv_id, w.n_convs, cast(w.n_children as bigint) as n_children,
    cast(t.n_leaves as bigint) as n_leaves, cast(t.saved_tokens as bigint) as saved_tokens, w.ends_sha256
from whole w join totals t on t.top = w.prefix
"""
