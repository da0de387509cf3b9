"""The trie against plain dictionaries of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest

from studytrace.llm import trie as R

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = (
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
)


def plain(rows, family=True):
    """All nodes by walking every prefix."""
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [(r, t) for _, r, t in sorted(listed)] for c, listed in turns.items()}
    whole = turns
    if family:
        whole = {}
        for c, own in turns.items():
            h = zlib.crc32(str(c).encode()) % 6
            base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
            whole[c] = turns.get(base, [])[:h] + own[h:]
    members, children = {}, {}
    for c, listed in whole.items():
        for d in range(len(listed) + 1):
            node = tuple(listed[:d])
            members.setdefault(node, []).append(c)
            if d:
                children.setdefault(node[:-1], set()).add(node)
    leaves, saved = Counter(), Counter()
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += node not in children
        saved[node] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    out = []
    for node, held in members.items():
        ends = sorted(c for c in held if len(whole[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(held), len(node), parent, len(held), len(children.get(node, ())), leaves[node], saved[node], digest)
        )
    return sorted(out, key=repr)


def made(rng, convs, words, longest):
    rows = []
    for c in rng.sample(range(-150, 700), convs):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "bot", None]), rng.choice(words)))
    return rows


def collected(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = made(rng, 120, ["a", "bé", "\U0001f600c", "", None], 5)
    out += [(5, None, "user", "first"), (5, 0, "user", "a"), (5, 0, "bot", "a"), (5, 0, "bot", "a")]
    out += [(None, 0, "user", "lost"), (200, 0, None, None), (900, 3, "u", "x"), (901, 0, "u", "x")]
    return out


def test_query_equals_plain_prefixes(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(6).write.parquet(f"{tmp_path}/conversations.parquet")
    got = R.op12_conversation_trie(spark, str(tmp_path))
    assert collected(got) == plain(rows)


@pytest.mark.parametrize("shape", ["bushy", "chains", "nested"])
def test_any_shards_and_segments_give_the_same(spark, shape):
    rng = random.Random(6)
    if shape == "bushy":
        rows = made(rng, 150, ["a", "b"], 7)
    elif shape == "chains":
        rows = [(c, t, "u", f"{t % 3}") for c in (3, 4, 9) for t in range(70 - c)]
        rows += [(20 + c, t, "u", f"{t % 3}" if t < c else "x") for c in range(30) for t in range(c + 2)]
    else:
        # Conversation c leaves conversation c - 1 in its c-th turn.
        rows = [(c, t, "u", "s" if t < c else f"e{c}") for c in range(40) for t in range(c + 3)]
    got = R.prefix_trie(
        *R.own_sequences(spark.createDataFrame(rows, SCHEMA).repartition(3)), segment=4, shard_nodes=15, limit=3
    )
    assert collected(got) == plain(rows, family=False)


def test_queue_spills_and_keeps_order():
    rng = random.Random(1)
    queue, held = R.SpillingQueue(5), []
    for step in range(3_000):
        if held and rng.random() < 0.45:
            assert queue.peek() == min(held)
            held.remove(queue.pop())
        else:
            item = (rng.randint(0, 50), step)
            queue.push(item)
            held.append(item)
    assert queue.spills > 100
    assert [queue.pop() for _ in range(len(held))] == sorted(held)
    assert queue.peek() is None


def test_many_ends_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(R, "IDS", 7)
    rows = [(c, 0, "u", "same") for c in range(100)]
    got = R.prefix_trie(*R.own_sequences(spark.createDataFrame(rows, SCHEMA).repartition(4)))
    assert collected(got) == plain(rows, family=False)


def test_empty_table_and_one_turnless_conversation(spark, tmp_path):
    schema = SCHEMA + ", d string, shard string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/a/conversations.parquet")
    assert R.op12_conversation_trie(spark, f"{tmp_path}/a").collect() == []
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0)
    rows = [(lone, 0, "u", "x")]
    spark.createDataFrame([(*r, "taken", "taken") for r in rows], schema).write.parquet(
        f"{tmp_path}/b/conversations.parquet"
    )
    got = collected(R.op12_conversation_trie(spark, f"{tmp_path}/b"))
    assert got == plain(rows) and len(got) == 1
