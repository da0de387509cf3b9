from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from studytrace.llm import order_minhash
from studytrace.llm.order_minhash import aligned, components, keep_one, near_duplicates
from tests.llm.conftest import sentence


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_alignment_equals_dynamic_programme():
    rng = random.Random(9)
    for _ in range(400):
        a = np.array([rng.randrange(4) for _ in range(rng.randint(1, 25))], np.uint64)
        b = np.array([rng.randrange(4) for _ in range(rng.randint(1, 25))], np.uint64)
        best = lcs(a.tolist(), b.tolist())
        assert aligned(a, b, best) and not aligned(a, b, best + 1)


def test_components_of_chains(spark):
    rng = random.Random(10)
    ids = list(range(60))
    rng.shuffle(ids)
    links = list(zip(ids[:39], ids[1:40], strict=True)) + [(ids[50], ids[51])]
    got = {
        r["uid"]: r["component"]
        for r in components(spark.createDataFrame(links, "a long, b long")).collect()
    }
    assert {got[i] for i in ids[:40]} == {min(ids[:40])}
    assert got[ids[51]] == min(ids[50:52]) and len(got) == 42


def test_later_links_merge_components(spark):
    labels = spark.createDataFrame([(0, 0), (1, 0), (5, 5), (6, 5), (7, 7), (8, 7)], "uid long, component long")
    links = spark.createDataFrame([(1, 6), (6, 9), (1, 5), (3, 4)], "a long, b long")
    got = {r["uid"]: r["component"] for r in order_minhash._merged(labels, links).collect()}
    assert got == {0: 0, 1: 0, 5: 0, 6: 0, 9: 0, 7: 7, 8: 7, 3: 3, 4: 3}


def shingles(text):
    words = re.findall(r"\w+", text.lower())
    return [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))]


def brute_classes(rows):
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            x, y = shingles(a), shingles(b)
            if min(len(x), len(y)) < 0.8 * max(len(x), len(y)):
                continue
            best = lcs(x, y)
            if best >= 0.8 * (len(x) + len(y) - best):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i, _ in rows}


def family(rng, first, members, words=60):
    text, rows = sentence(rng, words).split(), []
    for i in range(members):
        edited = list(text)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            edited[rng.randrange(len(edited))] = f"w{rng.random()}"
        rows.append((first + i, " ".join(edited)))
    return rows


def test_classes_equal_brute_force(docs_of, monkeypatch):
    rng = random.Random(11)
    rows = family(rng, 0, 40) + family(rng, 100, 8) + family(rng, 200, 8, 25)
    rows += [(300 + i, sentence(rng, 40)) for i in range(20)]
    rng.shuffle(rows)
    want = brute_classes(rows)
    for small in (32, 4):
        monkeypatch.setattr(order_minhash, "SMALL_BUCKET", small)
        got = near_duplicates(docs_of(rows)).collect()
        assert {r["doc_id"]: r["class_id"] for r in got} == want
        assert sorted(r["class_id"] for r in got if r["kept"]) == sorted(set(want.values()))


def test_parts_of_other_texts_are_found(docs_of):
    """Every shingle of the shorter texts is in a text with a smaller row number."""
    rng = random.Random(12)
    rows = []
    for first in range(0, 60, 3):
        words = sentence(rng, 60).split()
        rows += [(first + i, " ".join(words[i : 60 - 2 * i])) for i in range(3)]
    got = near_duplicates(docs_of(rows)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(rows)
    assert {r["class_id"] for r in got} == set(range(0, 60, 3))


def test_bits_bound_what_is_shared(spark):
    rng = random.Random(13)
    pairs = []
    for words in (6, 30, 400, 3_000):
        for _ in range(5):
            pairs.append([text for _, text in family(rng, 0, 2, words)])
    make = order_minhash._sketched
    sketched = spark.createDataFrame(pairs, "x string, y string").select(
        make(F.col("x")).alias("a"), make(F.col("y")).alias("b"), "x", "y"
    )
    bound = order_minhash._enough_shared("a.n", "a.bits", "b.n", "b.bits").alias("may")
    for r in sketched.select("x", "y", bound).collect():
        x, y = Counter(shingles(r["x"])), Counter(shingles(r["y"]))
        shared = (x & y).total()
        assert r["may"] or shared < 0.8 * (x.total() + y.total() - shared)


def test_one_large_bucket_in_common_is_enough(spark, monkeypatch):
    """Pairs that meet in a single large bucket are all candidates, whatever the tiles."""
    rng = random.Random(14)
    monkeypatch.setattr(order_minhash, "SMALL_BUCKET", 4)
    monkeypatch.setattr(order_minhash, "TILE", 5)
    base = [rng.getrandbits(63) for _ in range(order_minhash.BITS // 64)]
    n = {uid: 500 + 10 * (uid % 8) for uid in range(30)}
    bits = {uid: [w ^ (rng.getrandbits(63) & rng.getrandbits(63)) if uid % 3 else w for w in base] for uid in n}
    component = {uid: uid // 2 for uid in n}
    banded = spark.createDataFrame([(7, uid, n[uid], 30) for uid in n], "key long, uid long, n int, held long")
    labels = spark.createDataFrame(list(component.items()), "uid long, component long")
    sketches = spark.createDataFrame(list(bits.items()), "uid long, bits array<long>")
    want = set()
    for a in n:
        for b in range(a + 1, 30):
            lone = [sum((p & ~q).bit_count() for p, q in zip(bits[x], bits[y])) for x, y in ((a, b), (b, a))]
            fits = min(n[a], n[b]) >= 0.8 * max(n[a], n[b])
            enough = min(n[a] - lone[0], n[b] - lone[1]) * 1.8 >= 0.8 * (n[a] + n[b])
            if component[a] != component[b] and fits and enough:
                want.add((a, b))
    got = order_minhash._candidates_left(banded, labels, sketches).collect()
    assert 30 < len(want) < 400 and len(got) == len(want)
    assert {(r["a"], r["b"]) for r in got} == want


def test_awkward_rows(awkward, awkward_rows, empty):
    rows = near_duplicates(awkward).collect()
    assert len(rows) == len(awkward_rows)
    classes = {}
    for r in rows:
        classes.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert classes[3] == classes[4] == {3} and classes[1] == classes[2] == {1}
    assert classes[None] == {1, 3} and classes[9] == {9} and classes[-8] == {-8}
    assert sum(r["kept"] for r in rows) == len({r["class_id"] for r in rows})
    kept = keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(
        r["doc_id"] for r in rows if r["kept"]
    )
    assert near_duplicates(empty).collect() == [] and keep_one(empty).collect() == []
