"""Prefix trie of conversations, with subtree totals by time-forward processing.

A node is a distinct sequence of leading turns, known by its depth and a 128-bit
key, the exclusive-or of position-dependent hashes of its turns. Nodes are dealt
out in shards. Within a shard they are sorted externally by reverse level order,
and each passes its totals to its parent through a priority queue that spills to
disk. Parts of the trie that hang together within one shard form the nodes of a
smaller tree, whose totals are passed across shards in the same way.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
import tempfile
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from studytrace.llm.common import table, with_row_id
from studytrace.session import durable

FAMILY, HEADS = 100, 6
#: Turns of one conversation whose keys are summed in one window.
SEGMENT = 1_000
#: Nodes of a shard, as long as that makes no more than twice the shuffle partitions.
SHARD_NODES = 5_000
#: Messages a task holds before it writes a sorted run to disk.
QUEUE_LIMIT = 500_000
#: Ids hashed in one piece.
IDS = 4_096

NODE, PARENT, PART = ("d", "k1", "k2"), ("pd", "p1", "p2"), ("cd", "c1", "c2")
_NODE_TYPES = [("d", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64())]
_INT = ("shard", "d", "pd", "cd", "kind", "childless")


class SpillingQueue:
    """A priority queue of tuples; beyond ``limit`` they wait in sorted runs on disk."""

    def __init__(self, limit: int = QUEUE_LIMIT) -> None:
        self.limit, self.heap, self.heads, self.spills = limit, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            # A sorted list is a heap; the smaller half stays.
            self.heap.sort()
            self._start(self._written(self.heap[self.limit // 2 :]))
            del self.heap[self.limit // 2 :]

    def peek(self) -> tuple | None:
        """The smallest item, or None."""
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        """Remove and return the smallest item."""
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, _, run = heapq.heappop(self.heads)
            self._start(run)
            return item
        return heapq.heappop(self.heap)

    def _start(self, run: Iterator[tuple]) -> None:
        head = next(run, None)
        if head is not None:
            self.spills += 1
            heapq.heappush(self.heads, (head, self.spills, run))

    @staticmethod
    def _written(items: list[tuple]) -> Iterator[tuple]:
        # An unnamed file: it goes with the task, however that ends.
        file = tempfile.TemporaryFile()
        for at in range(0, len(items), 1_000):
            pickle.dump(items[at : at + 1_000], file)
        file.seek(0)

        def read() -> Iterator[tuple]:
            with file:
                while True:
                    try:
                        yield from pickle.load(file)
                    except EOFError:
                        return

        return read()


def _same(left: tuple[str, ...], right: tuple[str, ...]) -> list[Column]:
    return [F.col(a).alias(b) for a, b in zip(left, right, strict=True)]


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and blocks: what identifies each turn, and where its conversation starts.

    Turns are sorted by (conv_id, turn with nulls first, role, text); null role
    or text is empty, and turns without conversation are left out. A turn's
    index is ``place - start`` by its (conv_id, block), so that a conversation of
    any length is spread over tasks. ``blocks`` also has the conversation's
    length ``own``.
    """
    rows = with_row_id(
        conversations.filter(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("uid")]
    turns = durable(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            F.xxhash64("role", "text").alias("h1"),
            F.xxhash64(F.lit(1), "role", "text").alias("h2"),
            F.char_length("text").cast("long").alias("chars"),
            F.spark_partition_id().alias("block"),
            F.monotonically_increasing_id().alias("place"),
        )
    )
    held = turns.groupBy("conv_id", "block").agg(
        F.count(F.lit(1)).alias("held"), F.min("place").alias("first")
    )
    whole = W.partitionBy("conv_id")
    earlier = whole.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = held.select(
        "conv_id",
        "block",
        (F.col("first") - F.coalesce(F.sum("held").over(earlier), F.lit(0))).alias("start"),
        F.sum("held").over(whole).alias("own"),
    )
    return turns, blocks


def own_sequences(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sequences and members of a trie of the conversations as they are."""
    turns, blocks = ordered_turns(conversations)
    index = F.col("place") - F.col("start")
    sequences = turns.join(blocks, ["conv_id", "block"]).select(
        "conv_id", (index + 1).alias("position"), "h1", "h2", "chars", (index + 1 == F.col("own")).alias("ends")
    )
    return sequences, blocks.groupBy("conv_id").agg(F.max("own").alias("n_turns"))


def family_sequences(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Sequences and members where each conversation starts like the first of its family.

    The first h turns are those of conversation c - c % ``family`` (the sign of
    the remainder is that of c), then the conversation's own turns after its
    first h; h = crc32 of the decimal id, modulo ``heads``. Sequences are
    (conv_id, position from 1, h1, h2, chars, ends: whether it is the last turn);
    members are (conv_id, n_turns).
    """
    turns, blocks = ordered_turns(conversations)
    blocks = durable(blocks)
    lengths = blocks.groupBy("conv_id").agg(F.max("own").alias("own"))
    first = F.col("conv_id") - F.col("conv_id") % family
    known = lengths.select(
        "conv_id",
        "own",
        first.alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
    )
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    members = durable(
        known.join(bases, "base", "left").select(
            "conv_id",
            "base",
            "h",
            F.least("h", F.coalesce("base_own", F.lit(0))).alias("head"),
            F.greatest(F.col("own") - F.col("h"), F.lit(0)).alias("rest"),
        )
    )
    placed = turns.join(blocks.join(members, "conv_id"), ["conv_id", "block"])
    index = F.col("place") - F.col("start")
    rest = placed.filter(index >= F.col("h")).select(
        "conv_id",
        (F.col("head") + index - F.col("h") + 1).alias("position"),
        "h1",
        "h2",
        "chars",
        (index + 1 == F.col("own")).alias("ends"),
    )
    # At most ``heads`` - 1 turns of a base, each met by the members of its family.
    leading = placed.filter((F.col("conv_id") == F.col("base")) & (index < heads - 1)).select(
        "base", (index + 1).alias("position"), "h1", "h2", "chars"
    )
    head = (
        members.filter(F.col("head") > 0)
        .join(leading, "base")
        .filter(F.col("position") <= F.col("head"))
        .select(
            "conv_id",
            "position",
            "h1",
            "h2",
            "chars",
            ((F.col("position") == F.col("head")) & (F.col("rest") == 0)).alias("ends"),
        )
    )
    return head.unionByName(rest), members.select("conv_id", (F.col("head") + F.col("rest")).alias("n_turns"))


def prefix_keys(sequences: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation and turn with its node and that node's parent.

    Keys are summed within segments of a conversation; what earlier segments
    sum up to, one row each, is added to the later ones.
    """
    rows = sequences.select(
        "conv_id",
        F.col("position").cast("int").alias("d"),
        "chars",
        "ends",
        F.floor((F.col("position") - 1) / segment).alias("segment"),
        F.xxhash64("position", "h1", "h2").alias("g1"),
        F.xxhash64(F.lit(1), "position", "h1", "h2").alias("g2"),
    )
    upto = W.partitionBy("conv_id", "segment").orderBy("d").rowsBetween(W.unboundedPreceding, W.currentRow)
    inner = rows.withColumns({f"k{i}": F.bit_xor(f"g{i}").over(upto) for i in (1, 2)})
    before = W.partitionBy("conv_id").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        rows.groupBy("conv_id", "segment")
        .agg(F.bit_xor("g1").alias("g1"), F.bit_xor("g2").alias("g2"))
        .select("conv_id", "segment", *[F.bit_xor(f"g{i}").over(before).alias(f"b{i}") for i in (1, 2)])
        .filter(F.col("segment") > 0)
    )
    joined = inner.join(carried, ["conv_id", "segment"], "left")
    keys = [F.col(f"k{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))).alias(f"k{i}") for i in (1, 2)]
    return joined.select("conv_id", "d", "chars", "ends", "g1", "g2", *keys).select(
        "conv_id",
        *NODE,
        (F.col("d") - 1).alias("pd"),
        F.col("k1").bitwiseXOR(F.col("g1")).alias("p1"),
        F.col("k2").bitwiseXOR(F.col("g2")).alias("p2"),
        "chars",
        "ends",
    )


def trie_nodes(keyed: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node: key, parent, smallest member, members, and own values.

    A node is childless if all members end there. The root has no parent and no text.
    """
    root = members.agg(
        F.min("conv_id").alias("owner"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count_if(F.col("n_turns") == 0).alias("n_ends"),
    ).filter("n_convs > 0")
    none = F.lit(None)
    root = root.select(
        *[F.lit(0).cast(t).alias(n) for n, t in zip(NODE, ("int", "long", "long"))],
        *[none.cast(t).alias(n) for n, t in zip(PARENT, ("int", "long", "long"))],
        "owner",
        "n_convs",
        "n_ends",
        F.lit(0).cast("long").alias("chars"),
    )
    inner = keyed.groupBy(*NODE).agg(
        *[F.min(name).alias(name) for name in PARENT],
        F.min("conv_id").alias("owner"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count_if("ends").alias("n_ends"),
        F.max("chars").alias("chars"),
    )
    return root.unionByName(inner).select(
        *NODE,
        *PARENT,
        "owner",
        "n_convs",
        (F.col("n_ends") == F.col("n_convs")).cast("int").alias("childless"),
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of the batches as tuples of whole numbers; missing ones are None."""
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Tuples as batches of bounded size."""
    while held := list(islice(rows, 10_000)):
        columns = [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def downwards(rows: Iterator[tuple], limit: int = QUEUE_LIMIT) -> Iterator[tuple]:
    """Give each node of a shard the top of its connected part, and its parent's owner.

    ``rows`` are (shard, node, parent, childless, owner, …), sorted by shard and
    parent; every parent is then met before its children. Adds (top, parent's
    owner) to the rows, the latter None for a top.
    """
    shard, queue, current = None, SpillingQueue(limit), None
    for row in rows:
        at, node, parent, childless, owner = row[0], row[1:4], row[4:7], row[7], row[8]
        if at != shard:
            shard, queue, current = at, SpillingQueue(limit), None
        top, above = node, None
        if parent[0] is not None:
            while (head := queue.peek()) is not None and head[:3] <= parent:
                current = queue.pop()
            if current is not None and current[:3] == parent:
                top, above = current[3:6], current[6]
        if not childless:
            queue.push((*node, *top, owner))
        yield (*row, *top, above)


def upwards(rows: Iterator[tuple], limit: int = QUEUE_LIMIT) -> Iterator[tuple]:
    """Time-forward processing: each node's totals, sent to its parent in the shard.

    ``rows`` are (shard, node, kind, parent, children, leaves, saved, …) by
    shard, reverse level, key and kind. Rows of kind 0 are messages from other
    shards to the node after them; kind 1 are nodes. Yields (shard, node,
    children, leaves, saved, …) of the nodes, totals over their subtrees.
    """
    shard, queue, waiting = None, SpillingQueue(limit), (0, 0, 0)
    for row in rows:
        at, (d, k1, k2), kind, parent, own = row[0], row[1:4], row[4], row[5:8], row[8:11]
        if at != shard:
            shard, queue, waiting = at, SpillingQueue(limit), (0, 0, 0)
        sums = [a + b for a, b in zip(waiting, own, strict=True)]
        if kind == 0:
            waiting = sums
            continue
        waiting, here = (0, 0, 0), (-d, k1, k2)
        while (head := queue.peek()) is not None and head[:3] <= here:
            message = queue.pop()
            # Messages to nodes of other shards are sent by their part's total instead.
            if message[:3] == here:
                sums = [a + b for a, b in zip(sums, (1, *message[3:]), strict=True)]
        if parent[0] is not None:
            queue.push((-parent[0], *parent[1:], sums[1], sums[2]))
        yield (at, d, k1, k2, *sums, *row[11:])


def _pass(df: DataFrame, names: list[str], step: Callable, out: list[str], limit: int) -> DataFrame:
    """Run a streaming pass over sorted partitions."""
    kinds = {n: pa.int32() if n in _INT else pa.int64() for n in out}
    schema = ", ".join(f"{n} {'int' if n in _INT else 'long'}" for n in out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(step(_streamed(batches), limit), pa.schema(kinds))

    return df.select(*names).mapInArrow(run, schema)


def subtree_totals(
    nodes: DataFrame, shard_nodes: int = SHARD_NODES, limit: int = QUEUE_LIMIT, level: int = 0
) -> DataFrame:
    """(node, children, leaves, saved, owner, n_convs, parent_owner): subtree totals.

    ``nodes`` are written rows of (node, parent, childless, owner, n_convs,
    leaves, saved). A shard is a range of (owner, depth): the nodes a
    conversation owns form a path, which stays together, or is cut across shards
    where it is long. Any dealing out gives the same totals.
    """
    held = nodes.count()
    most = 2 * int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, min(math.ceil(held / shard_nodes), most))
    names = ["shard", *NODE, *PARENT, "childless", "owner", "n_convs", "leaves", "saved"]
    dealt = (
        nodes.repartitionByRange(shards, "owner", "d")
        .withColumn("shard", F.spark_partition_id())
        .sortWithinPartitions(*[F.col(n).asc_nulls_first() for n in PARENT])
    )
    # Written, so that both passes see the same shards.
    whole = durable(_pass(dealt, names, downwards, [*names, *PART, "parent_owner"], limit))
    rows = whole.withColumns({"kind": F.lit(1), "children": F.lit(0)})
    links = None
    if shards > 1:
        links = part_links(whole)
        rows = rows.unionByName(part_messages(whole, links, shard_nodes, limit, level), allowMissingColumns=True)
    carried = ["owner", "n_convs", "parent_owner"]
    done = _pass(
        rows.repartition(shards, "shard").sortWithinPartitions("shard", F.desc("d"), "k1", "k2", "kind"),
        ["shard", *NODE, "kind", *PARENT, "children", "leaves", "saved", *carried],
        upwards,
        ["shard", *NODE, "children", "leaves", "saved", *carried],
        limit,
    ).drop("shard")
    if links is None:
        return done
    above = links.select(*_same(PART, NODE), "above")
    return (
        done.join(above, list(NODE), "left")
        .withColumn("parent_owner", F.coalesce("parent_owner", "above"))
        .drop("above")
    )


def part_links(whole: DataFrame) -> DataFrame:
    """For each top with a parent: that parent, its part, its shard and its owner."""
    tops = whole.filter(reduce(Column.__and__, [F.col(a) == F.col(b) for a, b in zip(NODE, PART)]))
    above = whole.filter("childless = 0").select(
        *_same(NODE, PARENT), *_same(PART, ("ud", "u1", "u2")), "shard", F.col("owner").alias("above")
    )
    return durable(tops.select(*PART, *PARENT).join(above, list(PARENT)))


def part_messages(
    whole: DataFrame, links: DataFrame, shard_nodes: int, limit: int, level: int
) -> DataFrame:
    """What parts send to nodes of other shards: one row per receiving node."""
    parts = whole.groupBy(*PART).agg(
        F.min(F.when(F.col("d") == F.col("cd"), F.col("owner"))).alias("owner"),
        F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"),
    )
    tree = parts.join(links.select(*PART, "ud", "u1", "u2"), list(PART), "left").select(
        *_same(PART, NODE), *_same(("ud", "u1", "u2"), PARENT), "owner", "leaves", "saved"
    )
    totals = part_totals(durable(tree), shard_nodes, limit, level)
    return (
        links.join(totals.select(*_same(NODE, PART), "leaves", "saved"), list(PART))
        .groupBy("shard", *PARENT)
        .agg(F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        .select("shard", *_same(PARENT, NODE), F.lit(0).alias("kind"), "children", "leaves", "saved")
    )


def part_totals(tree: DataFrame, shard_nodes: int, limit: int, level: int) -> DataFrame:
    """Totals of the tree of parts: (node, leaves, saved).

    Parts without parts below them are final; their values are added to their
    parents by a grouping, so that a part with very many of them is no burden
    for one task. The rest is a smaller tree, solved like the trie. Where it is
    not smaller by half, or after three levels, shards grow, at last to a single
    stream, which needs no more memory than any other.
    """
    parents = tree.filter(F.col("pd").isNotNull()).select(*_same(PARENT, NODE)).distinct()
    below = tree.join(parents, list(NODE), "left_anti").select(*NODE, *PARENT, "leaves", "saved")
    added = (
        below.filter(F.col("pd").isNotNull())
        .groupBy(*_same(PARENT, NODE))
        .agg(F.sum("leaves").alias("more"), F.sum("saved").alias("extra"))
    )
    rest = durable(
        tree.join(parents, list(NODE), "left_semi")
        .join(added, list(NODE), "left")
        .select(
            *NODE,
            *PARENT,
            F.lit(0).alias("childless"),
            "owner",
            F.lit(None).cast("long").alias("n_convs"),
            (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("extra", F.lit(0))).alias("saved"),
        )
    )
    final = below.select(*NODE, "leaves", "saved")
    left = rest.count()
    if not left:
        return final
    if level >= 3 or 2 * left > tree.count():
        shard_nodes *= 8
    done = subtree_totals(rest, shard_nodes, limit, level + 1)
    return final.unionByName(done.select(*NODE, "leaves", "saved"))


def end_digests(keyed: DataFrame, members: DataFrame) -> DataFrame:
    """(node, ends_sha256) of nodes where conversations end: their ids, ascending.

    Ids are sorted over all tasks and joined in pieces; a node's pieces are then
    hashed in order as a stream, since this hash cannot be taken in parts.
    """
    ends = keyed.filter("ends").select(*NODE, "conv_id")
    turnless = members.filter("n_turns = 0").select(
        F.lit(0).cast("int").alias("d"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), "conv_id"
    )
    order = [*NODE, "conv_id"]
    pieces = (
        ends.unionByName(turnless)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_pieces, "d int, k1 long, k2 long, first long, ids string")
    )
    return (
        pieces.repartition(*NODE)
        .sortWithinPartitions(*NODE, "first")
        .mapInArrow(_hashed, "d int, k1 long, k2 long, ends_sha256 string")
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring ids of one node, joined by commas, at most ``IDS`` in a row."""

    def rows() -> Iterator[tuple]:
        for node, group in groupby(_streamed(batches), key=lambda row: row[:3]):
            while ids := [row[3] for row in islice(group, IDS)]:
                yield (*node, ids[0], ",".join(map(str, ids)))

    yield from _batches(rows(), pa.schema([*_NODE_TYPES, ("first", pa.int64()), ("ids", pa.string())]))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node over its pieces; a node's pieces follow one another."""

    def rows() -> Iterator[tuple]:
        for node, group in groupby(_streamed(batches), key=lambda row: row[:3]):
            digest = hashlib.sha256()
            for i, row in enumerate(group):
                digest.update(("," * (i > 0) + row[4]).encode())
            yield (*node, digest.hexdigest())

    yield from _batches(rows(), pa.schema([*_NODE_TYPES, ("ends_sha256", pa.string())]))


def prefix_trie(
    sequences: DataFrame,
    members: DataFrame,
    segment: int = SEGMENT,
    shard_nodes: int = SHARD_NODES,
    limit: int = QUEUE_LIMIT,
) -> DataFrame:
    """One row per node of the trie of all sequences; see ``own_sequences``.

    The root is there as soon as there is a member. Children are distinct turns
    by role and text; equal sequences share all nodes.
    """
    keyed = durable(prefix_keys(sequences, segment))
    nodes = durable(trie_nodes(keyed, members))
    totals = subtree_totals(nodes, shard_nodes, limit)
    none = hashlib.sha256(b"").hexdigest()
    return totals.join(end_digests(keyed, members), list(NODE), "left").select(
        F.col("owner").alias("conv_id"),
        F.col("d").cast("long").alias("depth"),
        F.col("parent_owner").alias("parent_conv_id"),
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all conversations, each starting like the first of its hundred.

    Turns without conversation id are in no conversation. Turns of equal number
    follow one another by role and text; repeated rows are turns of their own.
    Without any conversation there is no node.
    """
    return prefix_trie(*family_sequences(table(spark, folder, "conversations")))


#: Fixed value: the reversed polynomial of the checksum that sets h.
CRC32_POLYNOMIAL = 0xEDB88320
_CRC32 = f"""xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1),
      lambda i: ascii(CAST(conv_id AS VARCHAR)[i])::BIGINT)),
    lambda sum, byte: list_reduce(list_prepend(xor(sum, byte), list_resize([]::BIGINT[], 8, 0)),
      lambda c, _: xor(c >> 1, CASE WHEN c & 1 = 1 THEN {CRC32_POLYNOMIAL} ELSE 0 END))))"""

OP12_SQL = f"""
WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), sized AS (
  SELECT conv_id, turns, {_CRC32} % {HEADS} AS h FROM own
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
  FROM sized a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % {FAMILY}
), held AS (
  SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
), nodes AS (
  SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(CASE WHEN len(turns) = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends
  FROM held GROUP BY 1, 2
), above AS (
  SELECT path[1:unnest(range(0, depth + 1))] AS top, depth, path, n_convs FROM nodes
), children AS (
  SELECT path[1:depth - 1] AS parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), summed AS (
  SELECT top, count(*) FILTER (c.n IS NULL) AS n_leaves,
    sum((n_convs - 1) * CASE WHEN depth > 0 THEN length(path[depth].text) ELSE 0 END)::BIGINT AS saved_tokens
  FROM above a LEFT JOIN children c ON c.parent = a.path GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
  s.n_leaves, s.saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN summed s ON s.top = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
LEFT JOIN children c ON c.parent = n.path
"""
