"""Near-duplicates by order MinHash and banded alignment.

A document is the sequence of its five-word shingles. For each hash function
the sketch keeps the two shingles, labelled with their occurrence number, that
hash lowest, in the order they have in the text. Documents that agree on a band
of sketches are candidates; a banded alignment of their shingles decides.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrace.llm.common import fresh, small_or_shuffled, table, with_row_id
from studytrace.llm.wordhash import WORD, blocks, hashed, mixed
from studytrace.session import durable

SHINGLE = 5
SIMILAR = 0.8
#: Hash functions, and how many of them make a band. A pair exactly as similar
#: as ``SIMILAR`` agrees on a band with probability 0.41: it shares none of the
#: bands once in 38,000 pairs.
FUNCTIONS = 40
BAND = 2
BANDS = FUNCTIONS // BAND
#: Texts of each bucket that all its members are compared with at first.
LEADERS = 4
#: Members of larger buckets are compared in squares, ``TILE`` members a side.
SMALL_BUCKET = 128
TILE = 1024
#: Row numbers of candidates that may be broadcast, 8 bytes each.
UID_BOUND = 1_000_000
#: Bits that a text's shingles are hashed to. A bit that only one of two texts
#: has stands for at least one shingle that no alignment of them can match.
BITS = 1024
BLOCK_CHARS = 400_000
_LARGEST = np.uint64(2**64 - 1)
_FACTORS = mixed(np.arange(1, FUNCTIONS + 1, dtype=np.uint64)) | np.uint64(1)


def _shingles(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's shingles, and their number; short texts are one shingle."""
    held = np.where(counts > 0, np.maximum(counts - SHINGLE + 1, 1), 0)
    first = np.repeat(np.cumsum(counts) - counts, held) + (
        np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
    )
    last = np.repeat(np.cumsum(counts), held)
    padded = np.append(hashes, np.zeros(SHINGLE, np.uint64))
    out = np.zeros(len(first), np.uint64)
    for i in range(SHINGLE):
        word = np.where(first + i < last, padded[first + i], np.uint64(0))
        out = mixed(out + word)
    return out, held


def _occurrences(values: np.ndarray) -> np.ndarray:
    """How often each value came before."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - first
    return out


def sketch(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Band keys and bits (a row per text with words), and all shingle counts."""
    shingle, held = _shingles(hashes, counts)
    some = np.flatnonzero(held)
    held_some = held[some]
    starts = np.cumsum(held_some) - held_some
    owner = np.repeat(np.arange(len(some)), held_some)
    with np.errstate(over="ignore"):
        within = mixed(shingle + mixed(owner.astype(np.uint64)))
        labelled = mixed(shingle + mixed(_occurrences(within).astype(np.uint64)))
        keys = np.zeros((len(some), BANDS), np.uint64)
        bits = np.zeros((len(some), BITS // 64), np.uint64)
        bit = shingle >> np.uint64(64 - BITS.bit_length() + 1)
        np.bitwise_or.at(
            bits, (owner, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63))
        )
        for f in range(FUNCTIONS):
            rank = labelled * _FACTORS[f]
            lowest = np.minimum.reduceat(rank, starts)
            at = np.flatnonzero(rank == np.repeat(lowest, held_some))
            one = at[np.searchsorted(owner[at], np.arange(len(some)))]
            rank[one] = _LARGEST
            lowest = np.minimum.reduceat(rank, starts)
            at = np.flatnonzero(rank == np.repeat(lowest, held_some))
            two = at[np.searchsorted(owner[at], np.arange(len(some)))]
            ordered = mixed(mixed(shingle[np.minimum(one, two)]) + shingle[np.maximum(one, two)])
            keys[:, f // BAND] = mixed(keys[:, f // BAND] + ordered + np.uint64(f))
    return keys, bits, held


def _sketched(text: Column) -> Column:
    """A struct of ``digest``, ``n`` shingles, ``bands``, ``bits`` and ``words``.

    Words are lower-case runs of letters and digits, kept as 16-bit hashes: a
    shingle of five has 80 bits. Texts with the same words have the same
    digest; a text without words has no bands and the digest of its raw text.
    """

    @F.pandas_udf("digest binary, n int, bands array<long>, bits array<long>, words binary")
    def make(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            # One frame per block, so that no more than a block's arrays are held.
            for block in blocks(texts, BLOCK_CHARS):
                rows = []
                found = [WORD.findall(t.lower()) for t in block]
                counts = np.fromiter(map(len, found), np.int64, len(found))
                hashes = hashed([w for words in found for w in words])
                keys, bits, held = sketch(hashes, counts)
                keys, bits, row = keys.view(np.int64), bits.view(np.int64), 0
                ends = np.cumsum(counts)
                for t, n, shingles, end in zip(block, counts, held, ends, strict=True):
                    if not n:
                        raw = hashlib.md5(t.encode()).digest()
                        rows.append((raw, 0, np.zeros(0, np.int64), np.zeros(0, np.int64), b""))
                        continue
                    own = hashes[end - n : end]
                    digest = hashlib.md5(own.tobytes()).digest()
                    short = (own >> np.uint64(48)).astype("<u2").tobytes()
                    rows.append((digest, shingles, keys[row], bits[row], short))
                    row += 1
                yield pd.DataFrame(rows, columns=["digest", "n", "bands", "bits", "words"])

    return make(text)


def _sequence(words: bytes) -> np.ndarray:
    """Shingles of packed words, as integers."""
    w = np.frombuffer(words, "<u2").astype(np.uint64)
    w = np.append(w, np.zeros(max(0, SHINGLE - len(w)), np.uint64))
    n = len(w) - SHINGLE + 1
    out = mixed(w[SHINGLE - 1 :])
    for i in range(SHINGLE - 1):
        out = out + (w[i : i + n] << np.uint64(16 * i))
    return mixed(out)


def aligned(a: np.ndarray, b: np.ndarray, wanted: int) -> bool:
    """Whether the best alignment of two sequences matches ``wanted`` elements.

    Matches further than the band from the diagonal would leave too many
    elements unmatched, so they are left out. A row of the alignment is one
    integer with a bit per element of ``a``.
    """
    short = min(len(a), len(b))
    differs = np.flatnonzero(a[:short] != b[:short])
    head = int(differs[0]) if len(differs) else short
    tail = short - head
    differs = np.flatnonzero(a[::-1][:tail] != b[::-1][:tail])
    tail = int(differs[0]) if len(differs) else tail
    matched = head + tail
    if matched >= wanted:
        return True
    band = len(a) + len(b) - 2 * wanted
    if band < 0:
        return False
    a, b = a[head : len(a) - tail].tolist(), b[head : len(b) - tail].tolist()
    places: dict[int, int] = {}
    for i, value in enumerate(a):
        places[value] = places.get(value, 0) | 1 << i
    full = (1 << len(a)) - 1
    near = (1 << 2 * band + 1) - 1
    row = full
    for j, value in enumerate(b):
        match = places.get(value)
        if match:
            match &= near << j - band if j >= band else near >> band - j
            carried = row & match
            row = ((row + carried) | (row - carried)) & full
    return matched + len(a) - row.bit_count() >= wanted


def similar(a: bytes, b: bytes, least: float = SIMILAR) -> bool:
    """Whether aligned shingles over all shingles of both reach ``least``."""
    x, y = _sequence(a), _sequence(b)
    total = len(x) + len(y)
    # matched / (total - matched) >= least
    wanted = math.ceil(total * least / (1 + least) - 1e-9)
    if min(len(x), len(y)) < wanted:
        return False
    # What two bags share bounds what an alignment can match.
    values, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    bags = [np.bincount(side, minlength=len(values)) for side in (at[: len(x)], at[len(x) :])]
    if np.minimum(*bags).sum() < wanted:
        return False
    return aligned(x, y, wanted)


def _verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ``words`` are similar."""
    both = pairs.join(
        words.select(F.col("uid").alias("a"), F.col("words").alias("x")), "a"
    ).join(words.select(F.col("uid").alias("b"), F.col("words").alias("y")), "b")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            good = [similar(x, y) for x, y in zip(rows["x"], rows["y"], strict=True)]
            yield rows.loc[np.array(good, bool), ["a", "b"]]

    return durable(both.mapInPandas(check, "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """(uid, component) of every linked row: the least uid it can reach.

    Every round takes the least label among neighbours and then the label of
    that label, so chains shrink geometrically. Labels are written each round.
    """
    edges = durable(
        links.select("a", "b").union(links.select("b", "a")).distinct()
    )
    labels = durable(
        edges.groupBy(F.col("a").alias("uid")).agg(
            F.least(F.min("b"), F.first("a")).alias("component")
        )
    )
    while True:
        near = (
            edges.join(labels.withColumnRenamed("uid", "b"), "b")
            .groupBy(F.col("a").alias("uid"))
            .agg(F.min("component").alias("near"))
        )
        least = labels.join(near, "uid").select(
            "uid", F.col("component").alias("old"), F.least("component", "near").alias("new")
        )
        jump = labels.select(F.col("uid").alias("new"), F.col("component").alias("further"))
        moved = durable(
            least.join(jump, "new").select(
                "uid", "old", F.least("new", "further").alias("component")
            )
        )
        labels = moved.select("uid", "component")
        if not moved.filter("old <> component").limit(1).count():
            return labels


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links between different components.

    Only the components that these links touch are searched again.
    """
    ends = links.select(F.col("a").alias("uid")).union(links.select("b")).distinct()
    known = durable(
        ends.join(labels, "uid", "full").withColumn("component", F.coalesce("component", "uid"))
    )
    left = known.select(F.col("uid").alias("a"), F.col("component").alias("ca"))
    right = known.select(F.col("uid").alias("b"), F.col("component").alias("cb"))
    contracted = links.join(left, "a").join(right, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = durable(
        components(contracted).select(F.col("uid").alias("component"), F.col("component").alias("new"))
    )
    return known.join(small_or_shuffled(joined), "component", "left").select(
        "uid", F.coalesce("new", "component").alias("component")
    )


def _fits(a: str, b: str) -> Column:
    """Whether two shingle counts allow enough similarity."""
    return F.least(a, b) >= F.greatest(a, b) * SIMILAR - 1e-9


def _enough_shared(a: str, bits_a: str, b: str, bits_b: str) -> Column:
    """Whether the shingles that both texts may have allow enough similarity."""

    def only(x: str, y: str) -> Column:
        lone = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q))))
        return F.aggregate(lone, F.lit(0), lambda n, k: n + k)

    shared = F.least(F.col(a) - only(bits_a, bits_b), F.col(b) - only(bits_b, bits_a))
    return shared >= (F.col(a) + F.col(b)) * (SIMILAR / (1 + SIMILAR)) - 1e-6


def _stars(banded: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs of a bucket's leaders and its other members.

    Members are dealt over ``LEADERS`` slots; the one of each slot that shares
    most buckets with others leads, as it is nearest to them.
    """
    met = banded.groupBy("uid").agg(F.sum("held").alias("met"))
    full = durable(banded.join(met.join(bits, "uid"), "uid"))
    leaders = (
        full.groupBy("key", F.pmod(F.xxhash64("uid"), F.lit(LEADERS)).alias("slot"))
        .agg(F.min(F.struct(-F.col("met"), "uid", "n", "bits")).alias("leader"))
        .select(
            "key",
            F.col("leader.uid").alias("led"),
            F.col("leader.n").alias("m"),
            F.col("leader.bits").alias("bits_led"),
        )
    )
    return durable(
        full.join(leaders, "key")
        .filter(
            (F.col("uid") != F.col("led"))
            & _fits("n", "m")
            & _enough_shared("n", "bits", "m", "bits_led")
        )
        .select(F.least("uid", "led").alias("a"), F.greatest("uid", "led").alias("b"))
        .distinct()
    )


def _square(rows: pd.DataFrame) -> pd.DataFrame:
    """The pairs (a, b) of one square of a bucket that components and bits leave.

    Rows of tiles ``lo`` and ``hi``; within one tile, all its rows meet.
    """
    lo, hi = rows["lo"].iat[0], rows["hi"].iat[0]
    sides = [rows[rows["tile"] == tile] for tile in (lo, hi)]
    uid, n, component = ([side[c].to_numpy() for side in sides] for c in ("uid", "n", "component"))
    bits = [
        np.stack(list(side["bits"])).view(np.uint64) if len(side) else np.zeros((0, BITS // 64), np.uint64)
        for side in sides
    ]
    both = np.zeros((len(uid[0]), len(uid[1])), np.int64)
    for word in range(BITS // 64):
        both += np.bitwise_count(bits[0][:, word, None] & bits[1][None, :, word])
    # Bits that only one side has stand for shingles no alignment matches.
    left, right = (k - np.bitwise_count(own).sum(axis=1, dtype=np.int64) for k, own in zip(n, bits, strict=True))
    shared = both + np.minimum(left[:, None], right[None, :])
    x, y = n[0][:, None], n[1][None, :]
    may = (shared >= (x + y) * (SIMILAR / (1 + SIMILAR)) - 1e-6) & (
        np.minimum(x, y) >= np.maximum(x, y) * SIMILAR - 1e-9
    )
    may &= component[0][:, None] != component[1][None, :]
    if lo == hi:
        may = np.triu(may, 1)
    i, j = np.nonzero(may)
    ends = uid[0][i], uid[1][j]
    return pd.DataFrame({"a": np.minimum(*ends), "b": np.maximum(*ends)})


def _all_in_squares(members: DataFrame) -> DataFrame:
    """All pairs of different components in each bucket that bits do not rule out.

    ``members`` are (key, held, uid, n, component, bits). The members of a bucket
    are dealt over tiles, and each pair of tiles is a group of its own, so that no
    task holds more than two tiles, however large the bucket is.
    """
    tiles = F.ceil(F.col("held") / TILE).cast("int")
    dealt = members.withColumn("tiles", tiles).withColumn(
        "tile", F.pmod(F.xxhash64("uid"), F.col("tiles")).cast("int")
    )
    squares = dealt.withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    ).select(
        "key",
        F.least("tile", "other").alias("lo"),
        F.greatest("tile", "other").alias("hi"),
        "tile",
        "uid",
        F.col("n").cast("long").alias("n"),
        "component",
        "bits",
    )
    return squares.groupBy("key", "lo", "hi").applyInPandas(_square, "a long, b long")


def _candidates_left(banded: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs of different components that meet in a bucket, less those bits rule out.

    Members of a small bucket are joined, and a pair is made once, where its least
    common small key is. Members of a large one all meet as well, in squares.
    """
    labelled = banded.join(labels, "uid", "left").withColumn(
        "component", F.coalesce("component", "uid")
    )
    mixed_keys = (
        labelled.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .filter("lo <> hi")
        .select("key")
    )
    open_ = durable(labelled.join(mixed_keys, "key"))
    large = open_.filter(F.col("held") > SMALL_BUCKET).join(sketches, "uid")
    small = open_.filter(F.col("held") <= SMALL_BUCKET).select("key", "uid", "n", "component")
    keys = small.groupBy("uid").agg(F.sort_array(F.collect_list("key")).alias("smalls"))
    meeting = durable(small.join(sketches.join(keys, "uid"), "uid"))
    x, y = meeting.alias("x"), meeting.alias("y")
    joined = (
        x.join(y, "key")
        .filter(
            (F.col("x.uid") < F.col("y.uid"))
            & (F.col("x.component") != F.col("y.component"))
            & _fits("x.n", "y.n")
            & (F.get(F.array_intersect("x.smalls", "y.smalls"), F.lit(0)) == F.col("key"))
            & _enough_shared("x.n", "x.bits", "y.n", "y.bits")
        )
        .select(F.col("x.uid").alias("a"), F.col("y.uid").alias("b"))
    )
    return durable(joined.union(_all_in_squares(large)).distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: uid, doc_id, text_key, class_id, n_links, kept.

    ``class_id`` is the least doc_id that a chain of similar texts reaches;
    ``kept`` is true for one row of each class, the first by doc_id. ``n_links``
    counts the different texts that were found similar to this one; links that
    would join texts already in one class are not all looked for.

    Texts with the same words are one text from the start. Of each bucket a
    few texts that meet many others are compared with the others; all pairs of
    a bucket that this leaves in different classes are compared further. Pairs
    whose shingles fall on too many different bits are left out, without loss.
    Null and empty texts are equal; texts without words equal only themselves. Null ids and repeated rows are
    documents of their own; a class of null ids has a null id.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = with_row_id(docs.select("doc_id", "text"))
    texts = durable(
        rows.select(
            "uid", "doc_id", F.md5(text.cast("binary")).alias("text_key"), _sketched(text).alias("s")
        ).select("uid", "doc_id", "text_key", "s.*")
    )
    first = texts.groupBy("digest").agg(F.min("uid").alias("first"))
    members = durable(texts.select("uid", "doc_id", "text_key", "digest").join(first, "digest"))
    firsts = members.filter("uid = first").select("uid")
    banded = durable(
        texts.select("uid", "n", F.explode("bands").alias("key")).join(firsts, "uid", "left_semi")
    )
    shared = banded.groupBy("key").agg(F.count("*").alias("held")).filter("held > 1")
    banded = durable(banded.join(shared, "key"))
    candidates = small_or_shuffled(durable(banded.select("uid").distinct()), UID_BOUND)
    words = durable(texts.select("uid", "words", "bits").join(candidates, "uid"))
    links = _verified(_stars(banded, words.select("uid", "bits")), words)
    labels = components(links)
    left = _candidates_left(banded, labels, words.select("uid", "bits"))
    more = _verified(left, words)
    if more.limit(1).count():
        links = links.unionByName(more)
        labels = _merged(labels, more)
    degree = (
        links.select(F.col("a").alias("first"))
        .union(links.select("b"))
        .groupBy("first")
        .agg(F.count("*").alias("n_links"))
    )
    classed = members.join(
        labels.select(F.col("uid").alias("first"), "component"), "first", "left"
    ).withColumn("component", F.coalesce("component", "first"))
    classed = classed.join(degree, "first", "left")
    named = classed.groupBy("component").agg(
        F.min("doc_id").alias("class_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("head"),
    )
    return classed.join(named, "component").select(
        "uid",
        "doc_id",
        "text_key",
        "class_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("uid") == F.col("head")["uid"]).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class of near-duplicates, all columns.

    Rows are matched by id and text. Of rows equal in both, one stays.
    """
    key, kept_id, mark = (fresh(docs.columns, n) for n in ("_text_key", "_doc_id", "_copy"))
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = durable(
        near_duplicates(docs)
        .filter("kept")
        .select(F.col("doc_id").alias(kept_id), F.col("text_key").alias(key))
    )
    keyed = docs.withColumn(key, F.md5(text.cast("binary")))
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (keyed[key] == kept[key])
    chosen = keyed.join(kept, same, "left_semi")
    # Only rows repeated whole can be more than the rows that stay.
    ids = chosen.groupBy("doc_id", key).agg(F.count("*").alias(mark)).filter(F.col(mark) > 1)
    if ids.limit(1).count():
        chosen = chosen.dropDuplicates(["doc_id", key])
    return chosen.select(*docs.columns)


def op6_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near-duplicates of all documents."""
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "n_links", "kept")
