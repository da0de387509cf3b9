from __future__ import annotations

import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from studytrace.llm.common import kth_largest
from studytrace.llm.importance import fit_log_ratio, importance_sample, keep_good, quality_bound
from studytrace.llm.wordhash import hashed
from tests.llm.conftest import sentence


def corpus(spark, docs_of):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(400):
        text = sentence(rng, rng.randint(10, 60))
        bad = i % 4 == 0
        rows.append((i, re.sub(r"(\w+)", r"\1###", text) if bad else text))
        if i % 3 == 0:
            labels.append((i, int(not bad), 0))
    return docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_keeps_good_and_drops_bad(spark, docs_of):
    docs, labels, _ = corpus(spark, docs_of)
    kept = {r["doc_id"] for r in keep_good(docs, labels).collect()}
    assert kept == {i for i in range(400) if i % 4}


def test_weights_equal_plain_counts(spark, docs_of):
    docs, labels, rows = corpus(spark, docs_of)
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    raw, target = np.ones(2**14), np.ones(2**14)

    def words(text):
        found = re.findall(r"\w+|[^\w\s]+", text)
        return (hashed(found) >> np.uint64(50)).astype(int)

    for i, text in rows:
        for b in words(text):
            raw[b] += 1
            target[b] += i in good
    ratio = fit_log_ratio(docs, labels)
    # Words alone: pairs only add to the same buckets' counts.
    assert abs(ratio[words("###")[0]] - math.log(target[words("###")[0]] / raw[words("###")[0]])) < 2
    assert ratio[words("###")[0]] < -2


def test_sample_of_given_size_follows_weights(spark, docs_of):
    docs, labels, _ = corpus(spark, docs_of)
    weights, least, _ = importance_sample(docs, labels, k=100)
    rows = sorted(weights.collect(), key=lambda r: -r["sample_key"])
    assert rows[99]["sample_key"] == least
    assert all(r["doc_id"] % 4 for r in rows[:100])


def test_kth_largest_equals_sorting(spark):
    rng = random.Random(8)
    values = [rng.choice([rng.getrandbits(63), -rng.getrandbits(63), 5, -1, 0]) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "key long")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 150, 300):
        assert kth_largest(df, "key", k) == ordered[k - 1]
    assert kth_largest(df, "key", 0) is None and kth_largest(df, "key", 301) is None


def test_quality_bound_parts_the_kinds(spark):
    weights = spark.createDataFrame(
        [(i, float(i)) for i in range(10)], "doc_id long, log_weight double"
    )
    labels = spark.createDataFrame([(i, int(i >= 6)) for i in range(0, 10, 2)], "doc_id long, quality int")
    assert quality_bound(weights, labels) == 5.0
    assert quality_bound(weights, labels.filter("quality = 1")) == float("-inf")


def test_awkward_rows(awkward, awkward_rows, empty, no_labels, spark):
    kept = keep_good(awkward, no_labels)
    assert kept.columns == awkward.columns and kept.count() == len(awkward_rows)
    assert keep_good(empty, no_labels).collect() == []
    labels = spark.createDataFrame(
        [(3, 1, 0), (9, 0, 0), (None, 1, 1), (5, None, None), (3, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    left = keep_good(awkward, labels)
    assert left.filter("doc_id = 3").count() == 2
    assert left.select(F.col("uid")).distinct().first()[0] == "taken"


def plain_buckets(text):
    """Buckets of words and of neighbouring words, one at a time."""
    from studytrace.llm.wordhash import _MIX, mixed

    own = hashed(re.findall(r"\w+|[^\w\s]+", text))
    out = [int(h) >> 50 for h in own]
    for a, b in zip(own, own[1:]):
        with np.errstate(over="ignore"):
            joined = _MIX if a == b else mixed(mixed(np.array([a])) + b)[0]
        out.append(int(joined) >> 50)
    return out


def test_query_equals_plain_models_and_gumbel_keys(spark, docs_of, tmp_path):
    from studytrace.llm.importance import SEED, op9_importance_resampling

    docs, labels, rows = corpus(spark, docs_of)
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    raw, target = np.ones(2**14), np.ones(2**14)
    for i, text in rows:
        for b in plain_buckets(text):
            raw[b] += 1
            target[b] += quality.get(i) == 1
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    weight = {i: round(float(sum(ratio[b] for b in plain_buckets(t))), 6) for i, t in rows}
    seeds = docs.select("doc_id", F.xxhash64(F.lit(SEED), F.col("doc_id")).alias("h")).collect()
    uniform = {r["doc_id"]: (((r["h"] % 2**64) >> 11) + 0.5) / 2.0**53 for r in seeds}
    key = {i: w - math.log(-math.log(uniform[i])) for i, w in weight.items()}
    got = {r["doc_id"]: r for r in op9_importance_resampling(spark, str(tmp_path)).collect()}
    assert all(abs(got[i]["log_weight"] - w) < 2e-6 for i, w in weight.items())
    # Every bound between the worst good and the best bad document draws as many.
    worst = min(weight[i] for i, q in quality.items() if q == 1)
    best = max(weight[i] for i, q in quality.items() if q == 0)
    assert best < worst
    k = sum(w >= (best + worst) / 2 for w in weight.values())
    drawn = set(sorted(key, key=key.get)[-k:])
    assert {i for i, r in got.items() if r["kept"]} == drawn
