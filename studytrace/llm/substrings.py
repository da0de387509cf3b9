"""Removal of repeated strings by suffix arrays over shards of the corpus.

Every 50-byte window belongs to the shard of the least hash among its 16-byte
grams, so equal windows always meet, whichever documents they come from. Runs of
windows with one least hash are cut out as fragments; only fragments whose hash
occurs in more than one document are sent. Each shard sorts the suffixes of its
distinct fragments by induced sorting, finds equal windows as neighbours with a
long enough common prefix, and answers every fragment with the least document
that has each of its windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrace.llm.common import table, text_or_empty
from studytrace.llm.suffixes import repeats_predecessor, suffix_array
from studytrace.session import durable

WINDOW = 50
GRAM = 16
#: Text of about this many bytes travels as one row; a longer text alone.
BATCH_BYTES = 1_000_000
#: Window starts hashed at a time: these arrays stay in a core's cache.
STRETCH = 1 << 17
#: Corpus bytes per shard, and the least number of shards.
SHARD_BYTES = 2_000_000
LEAST_SHARDS = 96
#: Fragment bytes whose suffixes are sorted at a time.
SORT_BYTES = 500_000
_GRAM_FACTOR = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SENT_BITS = 48  # of a least hash, when only its repetition is counted
_NULL_ID = np.iinfo(np.int64).max


def _pack(*arrays: np.ndarray) -> bytes:
    """Compressed arrays of bytes, with their lengths in front."""
    raw = [np.ascontiguousarray(a).tobytes() for a in arrays]
    body = b"".join([np.array([len(r) for r in raw], np.int64).tobytes(), *raw])
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _unpack(blob: bytes, *kinds: type) -> list[np.ndarray]:
    size = int.from_bytes(blob[:8], "little")
    body = pa.decompress(blob[8:], size, codec="zstd", asbytes=True)
    lengths = np.frombuffer(body, np.int64, len(kinds))
    at, out = 8 * len(kinds), []
    for kind, n in zip(kinds, lengths, strict=True):
        out.append(np.frombuffer(body, kind, n // np.dtype(kind).itemsize, at))
        at += n
    return out


def least_hashes(data: np.ndarray) -> np.ndarray:
    """The least gram hash of every window of ``data``, by window start."""
    with np.errstate(over="ignore"):
        h, width, factor = data.astype(np.uint64) + np.uint64(1), 1, _GRAM_FACTOR
        while width < GRAM:
            h = h[:-width] * np.uint64(factor) + h[width:]
            factor, width = factor * factor & _MASK, 2 * width
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    grams, span = WINDOW - GRAM + 1, 1
    while 2 * span <= grams:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if span < grams:
        h = np.minimum(h[: -(grams - span)], h[grams - span :])
    return h


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one least hash: hash, first window, count, text.

    ``ends`` are the ends of the texts in ``data``; no window spans two texts.
    """
    found: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, max(0, len(data) - WINDOW + 1), STRETCH):
        h = least_hashes(data[begin : begin + STRETCH + WINDOW - 1])
        starts = np.arange(begin, begin + len(h))
        text = np.searchsorted(ends, starts, side="right")
        inside = starts + WINDOW <= ends[text]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(h)))
        good = inside[first]
        first, count = first[good], count[good]
        found.append((h[first], first + begin, count, text[first]))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _batches(docs: DataFrame) -> DataFrame:
    """(batch, ids, nulls, data): texts of up to a megabyte or so per row."""

    def gather(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 33
        ids, nulls, texts, held = [], [], [], 0

        def row() -> pd.DataFrame:
            ends = np.cumsum([len(t) for t in texts])
            blob = _pack(
                np.array(ids, np.int64), np.array(nulls, bool), ends.astype(np.int64),
                np.frombuffer(b"".join(texts), np.uint8),
            )
            return pd.DataFrame({"batch": [number], "data": [blob]})

        for part in parts:
            for doc_id, text in zip(part["doc_id"].astype("Int64"), part["text"], strict=True):
                none = doc_id is pd.NA
                ids.append(_NULL_ID if none else int(doc_id))
                nulls.append(none)
                texts.append(text.encode())
                held += len(texts[-1])
                if held >= BATCH_BYTES:
                    yield row()
                    number, held = number + 1, 0
                    ids, nulls, texts = [], [], []
        if ids:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInPandas(gather, "batch long, data binary")


def _open(blob: bytes) -> tuple[np.ndarray, ...]:
    return tuple(_unpack(blob, np.int64, bool, np.int64, np.uint8))


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _distinct_hashes(hashes: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per shard, the ascending distinct hashes."""
    distinct = np.unique(hashes)
    if not len(distinct):
        return
    shard = _shard_of(distinct, shards)
    first = np.flatnonzero(np.diff(shard, prepend=-1))
    for begin, end in zip(first, np.append(first[1:], len(shard)), strict=True):
        yield int(shard[begin]), distinct[begin:end]


def _ask(shards: int):
    """Per batch and shard: its distinct least hashes, and which two texts share."""

    def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for batch, blob in zip(part["batch"], part["data"], strict=True):
                _, _, ends, data = _open(blob)
                hashes, _, _, text = runs(data, ends)
                order = np.lexsort((text, hashes))
                h, t = hashes[order], text[order]
                twice = np.unique(h[1:][(h[1:] == h[:-1]) & (t[1:] != t[:-1])])
                out = []
                for shard, own in _distinct_hashes(hashes, shards):
                    cut = (own & np.uint64((1 << _SENT_BITS) - 1)).view(np.uint8).reshape(-1, 8)
                    shared = np.packbits(np.isin(own, twice))
                    sent = _pack(cut[:, : _SENT_BITS // 8], shared, np.array([len(own)], np.int64))
                    out.append((batch, shard, sent))
                yield pd.DataFrame(out, columns=["batch", "shard", "sent"])

    return ask


def _count(rows: pd.DataFrame) -> pd.DataFrame:
    """Which hashes of each batch occur in a second text somewhere."""
    values, shared, sizes = [], [], []
    for blob in rows["sent"]:
        cut, bits, n = _unpack(blob, np.uint8, np.uint8, np.int64)
        wide = np.zeros((n[0], 8), np.uint8)
        wide[:, : _SENT_BITS // 8] = cut.reshape(-1, _SENT_BITS // 8)
        values.append(wide.view(np.uint64).ravel())
        shared.append(np.unpackbits(bits, count=n[0]).astype(bool))
        sizes.append(n[0])
    value, twice = np.concatenate(values), np.concatenate(shared)
    _, at, count = np.unique(value, return_inverse=True, return_counts=True)
    repeated = count > 1
    repeated[at[twice]] = True
    answers = np.split(repeated[at], np.cumsum(sizes)[:-1])
    return pd.DataFrame(
        {
            "batch": rows["batch"],
            "shard": rows["shard"],
            "bits": [_pack(np.packbits(a)) for a in answers],
        }
    )


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as counted, one after the other."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


class _Fragments:
    """The fragments of a batch whose hash occurs in a second text.

    Occurrences are given by ``first`` byte, ``text`` and the number of their
    distinct fragment; distinct fragments come in the order of their shards.
    """

    def __init__(self, blob: bytes, shards: int, bits: dict[int, bytes]) -> None:
        self.ids, self.nulls, self.ends, self.data = _open(blob)
        hashes, first, count, text = runs(self.data, self.ends)
        flagged = []
        for shard, own in _distinct_hashes(hashes, shards):
            packed = _unpack(bits[shard], np.uint8)[0]
            flagged.append(own[np.unpackbits(packed, count=len(own)).astype(bool)])
        wanted = np.concatenate(flagged) if flagged else np.zeros(0, np.uint64)
        at = np.searchsorted(wanted, hashes)
        keep = np.zeros(len(hashes), bool)
        near = at < len(wanted)
        keep[near] = wanted[at[near]] == hashes[near]
        hashes, first, count, text = (x[keep] for x in (hashes, first, count, text))
        order = np.argsort(hashes, kind="stable")
        hashes, self.first, count, self.text = (x[order] for x in (hashes, first, count, text))
        body = self.data.tobytes()
        known: dict[bytes, int] = {}
        self.pieces: list[bytes] = []
        which, head = [], []
        stops = (self.first + count + WINDOW - 1).tolist()
        for i, (begin, stop) in enumerate(zip(self.first.tolist(), stops, strict=True)):
            piece = body[begin:stop]
            number = known.setdefault(piece, len(known))
            if number == len(self.pieces):
                self.pieces.append(piece)
                head.append(i)
            which.append(number)
        self.which = np.array(which, np.int64)
        self.hashes = hashes[head] if head else hashes[:0]
        self.shard = _shard_of(self.hashes, shards)
        self.least = np.full(len(self.pieces), _NULL_ID)
        np.minimum.at(self.least, self.which, self.ids[self.text])


def _send(shards: int):
    """Per batch and shard: the distinct fragments, with the least document of each."""

    def send(batches: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        bits = dict(zip(answers["shard"], answers["bits"], strict=True))
        for batch, blob in zip(batches["batch"], batches["data"], strict=True):
            f = _Fragments(blob, shards, bits)
            edges = np.flatnonzero(np.diff(f.shard, prepend=-1, append=shards))
            for begin, end in zip(edges[:-1], edges[1:], strict=True):
                pieces = f.pieces[begin:end]
                sent = _pack(
                    f.hashes[begin:end],
                    np.array([len(p) for p in pieces], np.int32),
                    f.least[begin:end],
                    np.frombuffer(b"".join(pieces), np.uint8),
                )
                out.append((batch, int(f.shard[begin]), sent))
        return pd.DataFrame(out, columns=["batch", "shard", "sent"])

    return send


def _least_by_window(pieces: list[bytes], least: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per window of the pieces, in order: its piece, and the least document that has it."""
    sizes = np.array([len(p) + 1 for p in pieces])
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    text = raw.astype(np.int16) + np.int16(1)
    text[starts + sizes - 1] = 0  # a separator below every byte
    counts = sizes - WINDOW
    piece = np.repeat(np.arange(len(pieces)), counts)
    windows = _ranges(starts, counts)
    is_window = np.zeros(len(text), bool)
    is_window[windows] = True
    ordered = suffix_array(text, 257, WINDOW)
    ordered = ordered[is_window[ordered]]
    number = np.zeros(len(text), np.int64)
    number[windows] = np.arange(len(windows))
    ordered_windows = number[ordered]
    first = np.flatnonzero(~repeats_predecessor(raw, ordered, WINDOW))
    group_least = np.minimum.reduceat(least[piece[ordered_windows]], first)
    out = np.empty(len(windows), np.int64)
    out[ordered_windows] = np.repeat(group_least, np.diff(np.append(first, len(ordered))))
    return piece, out


def _judge(rows: pd.DataFrame) -> pd.DataFrame:
    """Per batch: each fragment's windows as runs with one least document."""
    known: dict[bytes, int] = {}
    pieces: list[bytes] = []
    hashes, leasts, refs = [], [], []
    for blob in rows["sent"]:
        h, sizes, least, raw = _unpack(blob, np.uint64, np.int32, np.int64, np.uint8)
        body, at = raw.tobytes(), 0
        own = np.empty(len(h), np.int64)
        for i, size in enumerate(sizes.tolist()):
            piece = body[at : at + size]
            at += size
            number = known.setdefault(piece, len(pieces))
            if number == len(pieces):
                pieces.append(piece)
                hashes.append(h[i])
            own[i] = number
        refs.append(own)
        leasts.append(least)
    least = np.full(len(pieces), _NULL_ID)
    np.minimum.at(least, np.concatenate(refs), np.concatenate(leasts))
    order = np.argsort(np.array(hashes, np.uint64), kind="stable")
    _, group, held = np.unique(
        np.array(hashes, np.uint64)[order], return_inverse=True, return_counts=True
    )
    # All texts that have the hash of a lone fragment have the same windows there.
    alone = order[held[group] == 1]
    length = np.array([len(p) for p in pieces])
    run_piece, run_length, run_least = [alone], [length[alone] - WINDOW + 1], [least[alone]]
    together = order[held[group] > 1]
    groups = group[held[group] > 1]
    filled = np.cumsum(length[together])
    begin = 0
    while begin < len(together):
        done = filled[begin - 1] if begin else 0
        end = int(np.searchsorted(filled, done + SORT_BYTES))
        # Fragments of one hash stay together.
        end = int(np.searchsorted(groups, groups[min(end, len(groups) - 1)], side="right"))
        own = together[begin:end]
        piece, value = _least_by_window([pieces[i] for i in own], least[own])
        new = np.ones(len(piece), bool)
        new[1:] = (piece[1:] != piece[:-1]) | (value[1:] != value[:-1])
        first = np.flatnonzero(new)
        run_piece.append(own[piece[first]])
        run_length.append(np.diff(np.append(first, len(piece))))
        run_least.append(value[first])
        begin = end
    piece, run, value = (np.concatenate(x) for x in (run_piece, run_length, run_least))
    counts = np.bincount(piece, minlength=len(pieces))
    # The runs of one piece lie together, in order.
    starts = np.zeros(len(pieces), np.int64)
    first = np.flatnonzero(np.diff(piece, prepend=-1))
    starts[piece[first]] = first
    out = []
    for batch, own in zip(rows["batch"], refs, strict=True):
        at = _ranges(starts[own], counts[own])
        out.append(
            (batch, rows["shard"].iloc[0], _pack(counts[own].astype(np.int32), run[at].astype(np.int32), value[at]))
        )
    return pd.DataFrame(out, columns=["batch", "shard", "runs"])


def _removed(f: _Fragments, judged: dict[int, bytes]) -> np.ndarray:
    """Which bytes of the batch repeat a string of a smaller document."""
    counts, run, value = [], [], []
    for shard in np.unique(f.shard):
        c, r, v = _unpack(judged[int(shard)], np.int32, np.int32, np.int64)
        counts.append(c)
        run.append(r)
        value.append(v)
    cover = np.zeros(len(f.data) + 1, np.int64)
    if counts:
        count, length, least = np.concatenate(counts), np.concatenate(run), np.concatenate(value)
        first = np.cumsum(count) - count
        # Where each run starts within its fragment.
        before = np.cumsum(length) - length
        before -= np.repeat(before[first], count)
        at = _ranges(first[f.which], count[f.which])
        occurrence = np.repeat(np.arange(len(f.which)), count[f.which])
        hit = least[at] < f.ids[f.text[occurrence]]
        at, occurrence = at[hit], occurrence[hit]
        begin = f.first[occurrence] + before[at]
        np.add.at(cover, begin, 1)
        np.add.at(cover, begin + length[at] + WINDOW - 1, -1)
    return np.cumsum(cover[:-1]) > 0


def _cut(shards: int):
    """Per text: what stays, and the spans that go."""

    def cut(batches: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        bits = {s: b for s, b in zip(asked["shard"], asked["bits"], strict=True) if b is not None}
        judged = {s: r for s, r in zip(asked["shard"], asked["runs"], strict=True) if r is not None}
        for blob in batches["data"]:
            f = _Fragments(blob, shards, bits)
            gone = _removed(f, judged)
            starts = np.concatenate([[0], f.ends[:-1]])
            edge = np.zeros(len(gone) + 1, bool)
            edge[starts] = True
            opens = gone & ~np.concatenate([[False], gone[:-1]]) | gone & edge[:-1]
            closes = gone & ~np.concatenate([gone[1:], [False]]) | gone & np.append(edge[1:-1], True)
            span_from, span_to = np.flatnonzero(opens), np.flatnonzero(closes) + 1
            owner = np.searchsorted(f.ends, span_from, side="right")
            first = np.searchsorted(owner, np.arange(len(f.ends)))
            last = np.searchsorted(owner, np.arange(len(f.ends)), side="right")
            for i, (begin, end) in enumerate(zip(starts.tolist(), f.ends.tolist(), strict=True)):
                spans = slice(first[i], last[i])
                stays = f.data[begin:end]
                if first[i] < last[i]:
                    stays = stays[~gone[begin:end]]
                out.append(
                    (
                        None if f.nulls[i] else int(f.ids[i]),
                        end - begin,
                        span_from[spans] - begin,
                        span_to[spans] - begin,
                        stays.tobytes(),
                    )
                )
        frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "span_starts", "span_ends", "kept"])
        return frame.astype({"doc_id": "Int64"})

    return cut


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, span_starts, span_ends, kept) of every document.

    A byte goes if it lies in a 50-byte string that also starts in a document
    with a smaller doc_id; ``kept`` are the other bytes, and spans are the
    maximal runs that go, in bytes of the text. All is judged on the texts as
    given. Null texts are empty; null ids count as larger than all others and
    equal to each other; rows with one id do not remove from each other. Texts
    of any length are read whole; an empty table has no rows.
    """
    batches = durable(_batches(docs))
    total = docs.agg(F.sum(F.octet_length(text_or_empty())).alias("n")).first()["n"] or 0
    shards = max(LEAST_SHARDS, -(-total // SHARD_BYTES))
    asked = batches.mapInPandas(_ask(shards), "batch long, shard long, sent binary")
    bits = durable(
        asked.groupBy("shard").applyInPandas(_count, "batch long, shard long, bits binary")
    )
    by_batch = batches.groupBy("batch")
    sent = by_batch.cogroup(bits.groupBy("batch")).applyInPandas(
        _send(shards), "batch long, shard long, sent binary"
    )
    judged = sent.groupBy("shard").applyInPandas(_judge, "batch long, shard long, runs binary")
    answers = bits.select("batch", "shard", "bits", F.lit(None).cast("binary").alias("runs")).union(
        judged.select("batch", "shard", F.lit(None).cast("binary").alias("bits"), "runs")
    )
    return by_batch.cogroup(answers.groupBy("batch")).applyInPandas(
        _cut(shards),
        "doc_id long, n_bytes long, span_starts array<long>, span_ends array<long>, kept binary",
    )


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What stays of all documents once repeated 50-byte strings are gone."""
    return remove_repeats(table(spark, folder, "documents")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("span_starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
