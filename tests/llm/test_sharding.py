from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from studytrace.llm import sharding
from studytrace.llm.sharding import shard_by_bytes


def sizes_of(rows, shards=16):
    held = [0] * shards
    for r in rows:
        held[r["shard"]] += r["size"]
    return held


def check_slots(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("hot", [0, 600])
def test_shards_are_near_equal(docs_of, monkeypatch, hot):
    monkeypatch.setattr(sharding, "PIECE_ROWS", 100)
    rng = random.Random(3)
    rows = [(i, "w" * rng.randint(1, 60) + str(i)) for i in range(1_200)]
    rows += [(5_000 + i, "copied text") for i in range(hot)]
    got = shard_by_bytes(docs_of(rows)).collect()
    assert len(got) == len(rows)
    held = sizes_of(got)
    mean = sum(held) / 16
    assert max(abs(h - mean) for h in held) <= 2 * 0.01 * mean + 70
    check_slots(got)
    texts = dict(rows)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in got)
    # Equal texts are neighbours: their shards are consecutive.
    own = {r["shard"] for r in got if r["doc_id"] >= 5_000}
    assert not own or max(own) - min(own) == len(own) - 1


def test_awkward_rows(awkward, awkward_rows, empty):
    rows = shard_by_bytes(awkward).collect()
    assert sorted(r["size"] for r in rows) == sorted(
        len((r[1] or "").encode()) + 1 for r in awkward_rows
    )
    check_slots(rows)
    assert shard_by_bytes(empty).collect() == []


@pytest.mark.parametrize("hot", [0, 300])
def test_splitters_equal_sorted_splitters(spark, hot):
    """Boundaries against the rows sorted on one machine."""
    from pyspark.sql import functions as F

    rng = random.Random(11)
    rows = [(rng.getrandbits(63) - 2**62, i, i, rng.randint(1, 400)) for i in range(900)]
    rows += [(7, i, 5_000 + i, 50) for i in range(hot)]
    df = spark.createDataFrame(rows, "_hash long, _id long, _row long, size long").repartition(5)
    ordered = sorted(rows)
    keys = [sum((v + 2**63) << 64 * (2 - at) for at, v in enumerate(r[:3])) for r in ordered]
    total, parts = sum(r[3] for r in rows), 16
    cuts = sharding.splitters(df, parts)
    assert len(cuts) == parts - 1 and cuts == sorted(cuts)
    for i, cut in enumerate(cuts, 1):
        below = sum(r[3] for r, key in zip(ordered, keys, strict=True) if key < cut)
        nearest = min(
            abs(sum(r[3] for r in ordered[:n]) - i * total // parts) for n in range(len(ordered) + 1)
        )
        # Within tolerance, or as near as any boundary between two rows is.
        assert abs(below - i * total // parts) <= max(0.01 * total / parts, nearest) + 1
    assert df.agg(F.sum("size")).first()[0] == total
