from __future__ import annotations

import random
from collections import Counter, defaultdict

import corpus_pipeline
from pyspark.sql import functions as F
from studytrace.llm import order_minhash
from studytrace.llm.pieces import Encoder, model_path
from tests.llm.conftest import sentence
from tests.llm.test_credentials import base


def test_every_stage_takes_effect(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    start = {r["doc_id"]: r["text"] for r in docs.collect()}
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], folder).cache())
    good, single, masked, mixed, coded = seen[1:]
    for kept in (good, single, masked, mixed):
        assert kept.columns == docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    left = {r["doc_id"] for r in good.collect()}
    judged = [(i in left) == (q == 1) for i, q in labels.items() if i in start]
    assert sum(judged) > 0.97 * len(judged)
    texts = Counter(r["text"] for r in single.collect())
    assert max(texts.values()) == 1 and set(texts) <= {start[i] for i in left}
    assert {r["doc_id"] for r in single.collect()} < left
    for row in masked.collect():
        assert not base(row["text"]) and row["n_chars"] == len(row["text"])
    assert {r["doc_id"] for r in masked.collect()} == {r["doc_id"] for r in single.collect()}
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert abs(sum(copies.values()) - masked.count()) < 0.2 * masked.count() and max(copies.values()) > 1
    encoder, by_id = Encoder(model_path()), {r["doc_id"]: r["text"] for r in masked.collect()}
    rows = coded.collect()
    assert Counter(r["doc_id"] for r in rows) == copies
    for row in rows[:50]:
        assert row["ids"] == encoder.library.encode(by_id[row["doc_id"]])


def test_awkward_rows(spark, awkward, empty, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    for docs in (awkward, empty):
        start = Counter(r["doc_id"] for r in docs.collect())
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        left = {r["doc_id"] for r in docs.collect()}
        # Without labels nothing is rejected; of equal texts one row stays.
        assert left <= set(start) and bool(left) == bool(start)


def test_one_large_bucket_in_common_makes_one_class(spark, docs_of, monkeypatch):
    """A chain of similar texts that meet in a single large bucket is one class."""
    rng, whole = random.Random(15), order_minhash._sketched
    monkeypatch.setattr(order_minhash, "SMALL_BUCKET", 2)
    monkeypatch.setattr(order_minhash, "TILE", 3)
    monkeypatch.setattr(order_minhash, "LEADERS", 1)
    monkeypatch.setattr(
        order_minhash, "_sketched", lambda text: whole(text).withField("bands", F.slice(whole(text)["bands"], 1, 1))
    )
    rows = []
    for family in range(4):
        words = sentence(rng, 200).split()
        for step in range(20):
            # Neighbours are similar, the first and the last are not.
            words[(37 * step) % 200] = f"w{family}x{step}"
            rows.append((len(rows), " ".join(words)))
    docs = docs_of(rows)
    held = docs.select("doc_id", order_minhash._sketched(F.col("text")).alias("s")).select("doc_id", "s.*").collect()
    buckets = defaultdict(list)
    for r in sorted(held, key=lambda r: r["doc_id"]):
        buckets[r["bands"][0]].append((r["doc_id"], r["words"]))
    assert max(map(len, buckets.values())) > 4
    top = {i: i for i, _ in rows}
    for members in buckets.values():
        for i, x in members:
            for j, y in members:
                if i < j and order_minhash.similar(x, y):
                    low, high = sorted((top[i], top[j]))
                    top = {k: low if t == high else t for k, t in top.items()}
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert 4 <= len(kept) < len(rows) and {r["doc_id"] for r in kept} == set(top.values())
