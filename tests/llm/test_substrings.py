from __future__ import annotations

import random
from collections import Counter

import numpy as np

from studytrace.llm import substrings
from studytrace.llm.substrings import remove_repeats
from studytrace.llm.suffixes import repeats_predecessor, suffix_array
from tests.llm.conftest import sentence


def test_suffix_arrays_equal_sorting():
    rng = np.random.default_rng(1)
    for _ in range(300):
        sigma = int(rng.integers(1, 6))
        text = rng.integers(0, sigma, int(rng.integers(0, 60))).astype(np.int16)
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert suffix_array(text, sigma).tolist() == want


def test_many_names_are_ranked_by_doubling(monkeypatch):
    monkeypatch.setattr("studytrace.llm.suffixes.BUCKET_PASSES", 2)
    rng = np.random.default_rng(2)
    for _ in range(200):
        text = rng.integers(0, 3, int(rng.integers(1, 80))).astype(np.int16)
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert suffix_array(text, 3).tolist() == want


def test_common_prefixes():
    data = np.frombuffer(b"abcdefghij_abcdefghij_abcdefghix", np.uint8)
    got = repeats_predecessor(data, np.array([0, 11, 22]), 10)
    assert got.tolist() == [False, True, False]


def brute(rows):
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        seen = set()
        for j, other in rows:
            if (i is None and j is not None) or (i is not None and j is not None and j < i):
                b = (other or "").encode()
                seen.update(b[p : p + 50] for p in range(len(b) - 49))
        for p in range(len(raw) - 49):
            if raw[p : p + 50] in seen:
                gone[p : p + 50] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out.append(
            (
                i, len(raw), np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(),
                np.frombuffer(raw, np.uint8)[~gone].tobytes(),
            )
        )
    return Counter(map(repr, out))


def found(df):
    return Counter(
        repr((r["doc_id"], r["n_bytes"], r["span_starts"], r["span_ends"], bytes(r["kept"])))
        for r in df.collect()
    )


def test_equals_brute_force(docs_of, monkeypatch):
    rng = random.Random(12)
    shared = [sentence(rng, 40) for _ in range(4)] + ["é" * 80, "ab" * 90, "x" * 130]
    rows = []
    for i in range(60):
        parts = [sentence(rng, rng.randint(0, 30)), rng.choice(shared), sentence(rng, 10)]
        begin = rng.randint(0, 20)
        rows.append((i, parts[0] + parts[1][begin : begin + rng.randint(45, 120)] + parts[2]))
    rows += [(100, rows[3][1]), (101, shared[0] + "\0" + shared[0]), (102, ""), (103, None)]
    rng.shuffle(rows)
    want = brute(rows)
    assert found(remove_repeats(docs_of(rows))) == want
    # Small rows, stretches and sorts cut the same work in other places.
    monkeypatch.setattr(substrings, "BATCH_BYTES", 300)
    monkeypatch.setattr(substrings, "STRETCH", 97)
    monkeypatch.setattr(substrings, "SORT_BYTES", 200)
    monkeypatch.setattr(substrings, "LEAST_SHARDS", 3)
    assert found(remove_repeats(docs_of(rows))) == want


def test_awkward_rows(awkward, awkward_rows, empty):
    assert found(remove_repeats(awkward)) == brute([r[:2] for r in awkward_rows])
    assert remove_repeats(empty).collect() == []
