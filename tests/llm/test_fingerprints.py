from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from __spark_entry__ import queries
from studytrace.llm import fingerprints
from studytrace.llm.fingerprints import (
    ANCHORS,
    class_members,
    similar_classes,
    signatures,
    with_next,
)
from tests.llm.conftest import sentence


def plain_signatures(text):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    content = [w for w in words if w not in ANCHORS]
    starts, seen = {0}, 0
    for word in words:
        if word in ANCHORS:
            starts.add(seen)
        else:
            seen += 1
    chains = [" ".join(content[s : s + 3]) for s in starts if s < len(content)] or [text]
    return sorted({hashlib.md5(c.encode()).hexdigest()[:8] for c in chains})


def test_signatures_equal_plain_code(docs_of, awkward_rows):
    rows = docs_of(awkward_rows).select("text", signatures(F.col("text")).alias("s")).collect()
    for row in rows:
        assert row["s"] == plain_signatures(row["text"] or "")


def test_all_of_a_text_without_common_words_counts(docs_of):
    first = "один два три четыре пять шесть"
    rows = [(1, first), (2, first.replace("шесть", "семь")), (3, "one")]
    got = {r["doc_id"]: r["signatures"] for r in class_members(docs_of(rows)).collect()}
    words = first.split()
    chains = [" ".join(words[i : i + 3]) for i in range(6)]
    assert got[1] == sorted(hashlib.md5(c.encode()).hexdigest()[:8] for c in chains)
    assert len(set(got[1]) & set(got[2])) == 3
    assert got[3] == [hashlib.md5(b"one").hexdigest()[:8]]


def test_next_document_over_ranges(docs_of, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 3)
    rows = [(3 * i, f"text {i}") for i in range(20)] + [(None, "none")]
    random.Random(1).shuffle(rows)
    got = {r["text"]: r["next_text"] for r in with_next(docs_of(rows)).collect()}
    order = [f"text {i}" for i in range(19, -1, -1)] + ["none"]
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))


def test_awkward_rows(awkward, awkward_rows, empty, docs_of):
    assert with_next(awkward).count() == len(awkward_rows)
    assert with_next(empty).collect() == []
    alone = with_next(docs_of([(1, "only")])).first()
    assert alone["next_text"] == "only"


def test_links_equal_all_pairs(docs_of):
    rng = random.Random(2)
    rows = []
    for i in range(12):
        words = sentence(rng, 90).split()
        for j in range(4):
            edited = list(words)
            for _ in range(j * 2):
                edited[rng.randrange(len(edited))] = f"x{rng.random()}"
            rows.append((4 * i + j, " ".join(edited)))
    docs = docs_of(rows)
    members = {r["class"]: set(r["signatures"]) for r in class_members(docs).collect()}
    want = set()
    for a in members:
        for b in members:
            x, y = members[a], members[b]
            if a < b and len(x & y) >= 0.8 * len(x | y):
                want.add(frozenset((a, b)))
    got = {frozenset((r["class_a"], r["class_b"])) for r in similar_classes(docs).collect()}
    assert want and got == want


def test_classes_and_link_counts_of_a_whole_table(spark, sf_dir):
    rows = queries()["op10_spot_classes"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    sets = {}
    for r in rows:
        sets[r["class"]] = {r["fingerprint"][i : i + 8] for i in range(0, len(r["fingerprint"]), 8)}
    want = {
        a: sum(a != b and len(x & y) >= 0.8 * len(x | y) for b, y in sets.items())
        for a, x in sets.items()
    }
    assert any(want.values()) and len(want) < len(rows)
    assert all(r["n_links"] == want[r["class"]] for r in rows)
