from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from studytrace.llm.mixing import poisson_mix, repetition_rates, temperature_weights


def test_shares_follow_weights_and_order_is_random(spark):
    docs = spark.range(6_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 4_000, "big").otherwise("small").alias("source"),
    )
    weights = spark.createDataFrame([("big", 1.0), ("small", 3.0)], "source string, weight double")
    rows = poisson_mix(docs, weights, total=8_000).collect()
    held = Counter(r["source"] for r in rows)
    assert abs(held["big"] - 2_000) < 200 and abs(held["small"] - 6_000) < 350
    copies = Counter(Counter(r["doc_id"] for r in rows if r["source"] == "small").values())
    # Poisson with mean 3: P(3) = 0.224 of 2,000 documents.
    assert 370 < copies[3] < 530
    assert len({(r["doc_id"], r["mix_part"], r["mix_copy"]) for r in rows}) == len(rows)


def test_large_rates_are_drawn_in_parts(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, source string")
    weights = spark.createDataFrame([("a", 1.0)], "source string, weight double")
    rate = repetition_rates(docs, weights, total=2_000).first()
    assert rate["parts"] == 63 and abs(rate["cdf"][-1] - 1) < 1e-9
    assert 1_800 < poisson_mix(docs, weights, total=2_000).count() < 2_200


def test_awkward_rows(awkward, empty):
    mixed = poisson_mix(awkward, temperature_weights(awkward), total=500)
    assert set(awkward.columns) < set(mixed.columns)
    rows = mixed.collect()
    assert None in {r["source"] for r in rows} and "taken" in {r["mix_rate"] for r in rows}
    twice = Counter(r["doc_id"] for r in rows)
    assert twice[3] % 2 == 0
    assert poisson_mix(empty, temperature_weights(empty)).collect() == []


def test_sources_without_weight_are_left_out(spark, awkward):
    weights = spark.createDataFrame([("s", 1.0), ("t", 0.0)], "source string, weight double")
    assert {r["source"] for r in poisson_mix(awkward, weights, total=100).collect()} == {"s"}
