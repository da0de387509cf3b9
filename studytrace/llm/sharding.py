"""Balanced shards by histogram sort.

Rows are ordered by (hash of the text, doc_id, row number) and cut where the
bytes below a boundary come close enough to an even share. The boundaries are
found by counting: each round counts the exact bytes below all candidate
boundaries across partitions, keeps those within tolerance, and refines the
others inside the one cell that holds them. The rows then move once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from studytrace.llm.common import small_or_shuffled, table, text_or_empty, with_row_id
from studytrace.session import durable

SHARDS = 16
#: Largest distance of a boundary from its even place, as a share of a shard.
TOLERANCE = 0.01
#: Rows one task numbers, and the most tasks that are dealt to.
PIECE_ROWS = 100_000
MAX_PIECES = 4_096
_KEYS = ("_hash", "_id", "_row")
_CELL_BITS = 12
#: Cells with at most this many rows are finished from their rows.
_FEW = 256
_LONG_BITS = 64
_WORDS = len(_KEYS) * _LONG_BITS


@dataclass
class _Open:
    """A boundary still sought: it lies in the cell ``prefix`` of ``bits`` bits."""

    number: int
    target: int
    bits: int
    prefix: int
    below: int
    rows: int


def _unsigned_digits(word: Column, start: int, width: int) -> Column:
    """``width`` bits of a long from bit ``start`` (0 is the top), sign bit flipped."""
    flipped = word.bitwiseXOR(F.lit(-(2**63)))
    shifted = F.shiftrightunsigned(flipped, _LONG_BITS - start - width)
    return shifted.bitwiseAND(F.lit(2**width - 1))


def _in_cell(prefix: int, bits: int) -> Column:
    """True for rows whose key starts with these bits."""
    condition = F.lit(True)
    for i, name in enumerate(_KEYS):
        width = min(_LONG_BITS, bits - i * _LONG_BITS)
        if width <= 0:
            break
        digits = prefix >> (bits - i * _LONG_BITS - width) & (2**width - 1)
        if width == _LONG_BITS:
            condition = condition & (F.col(name) == F.lit(digits - 2**63))
        else:
            condition = condition & (_unsigned_digits(F.col(name), 0, width) == F.lit(digits))
    return condition


def splitters(rows: DataFrame, parts: int, tolerance: float = TOLERANCE) -> list[int]:
    """``parts`` - 1 ascending boundaries: 192-bit keys; a row below one lies left of it.

    ``rows`` has the three key columns and ``size``. Each round sends at most
    4,096 counts per sought boundary to the driver. A boundary that no cell edge
    serves is set at the nearer side of the row that holds it; cells of up to
    256 rows are looked through directly.
    """
    total = rows.agg(F.sum("size").alias("s")).first()["s"] or 0
    slack = tolerance * total / parts
    found: dict[int, int] = {}
    open_ = [_Open(i, i * total // parts, 0, 0, 0, _FEW + 1) for i in range(1, parts)]
    while any(o.rows > _FEW for o in open_):
        done = [o for o in open_ if o.rows <= _FEW]
        open_ = [o for o in open_ if o.rows > _FEW]
        cells = sorted({(o.bits, o.prefix) for o in open_})
        bits = cells[0][0]
        start = bits % _LONG_BITS
        width = min(_CELL_BITS, _LONG_BITS - start)
        word = F.col(_KEYS[bits // _LONG_BITS])
        number = F.lit(None).cast("int")
        for i, (_, prefix) in enumerate(cells):
            number = F.when(_in_cell(prefix, bits), i).otherwise(number)
        counted = (
            rows.withColumn("cell", number)
            .filter("cell IS NOT NULL")
            .groupBy("cell", _unsigned_digits(word, start, width).alias("digit"))
            .agg(F.sum("size").alias("size"), F.count("*").alias("n"))
            .collect()
        )
        by_cell: dict[int, list[tuple[int, int, int]]] = {}
        for row in counted:
            by_cell.setdefault(row["cell"], []).append((row["digit"], row["size"], row["n"]))
        last = bits + width == _WORDS
        still = done
        for o in open_:
            below = o.below
            for digit, size, n in sorted(by_cell[cells.index((bits, o.prefix))]):
                if below + size >= o.target:
                    break
                below += size
            key = o.prefix << width | digit
            left, right = o.target - below, below + size - o.target
            if last or min(left, right) <= slack:
                edge = key if left <= right else key + 1
                found[o.number] = edge << (_WORDS - bits - width)
            else:
                still.append(_Open(o.number, o.target, bits + width, key, below, n))
        open_ = still
    found.update(_finished(rows, open_))
    return [found[i] for i in sorted(found)]


def _finished(rows: DataFrame, open_: list[_Open]) -> dict[int, int]:
    """The boundaries in cells of few rows, each at the nearer side of a row."""
    if not open_:
        return {}
    inside = F.lit(False)
    for o in open_:
        inside = inside | _in_cell(o.prefix, o.bits)
    held = []
    for row in rows.filter(inside).select(*_KEYS, "size").collect():
        key = 0
        for name in _KEYS:
            key = key << _LONG_BITS | row[name] + 2**63
        held.append((key, row["size"]))
    held.sort()
    found = {}
    for o in open_:
        below = o.below
        for key, size in held:
            if key >> (_WORDS - o.bits) != o.prefix:
                continue
            if below + size >= o.target:
                found[o.number] = key if o.target - below <= below + size - o.target else key + 1
                break
            below += size
    return found


def _at_or_above(splitter: int) -> Column:
    """True for rows whose key is not below a boundary."""
    words = [
        (splitter >> (_LONG_BITS * (len(_KEYS) - 1 - i)) & (2**_LONG_BITS - 1)) - 2**63
        for i in range(len(_KEYS))
    ]
    if splitter >> _WORDS:
        return F.lit(False)
    result = F.col(_KEYS[-1]) >= F.lit(words[-1])
    for name, word in zip(reversed(_KEYS[:-1]), reversed(words[:-1]), strict=True):
        result = (F.col(name) > F.lit(word)) | ((F.col(name) == F.lit(word)) & result)
    return result


def shard_by_bytes(
    docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row, shards near equal in bytes.

    ``size`` is the text's UTF-8 bytes plus one (a null text has one). Equal
    texts are neighbours in the order, so they share a shard unless a boundary
    has to cut their group to meet the tolerance; no boundary is further from
    its even place than the tolerance or half a document. Slots count the
    rows of a shard from 0 in key order. Null ids are keyed as the smallest id;
    repeated rows stay apart; an empty table gives no rows.
    """
    text = text_or_empty()
    keyed = durable(
        with_row_id(docs.select("doc_id", "text"), "_row").select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("_hash"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("_id"),
            "_row",
        )
    )
    count = keyed.count()
    if not count:
        return keyed.select(
            "doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")
        )
    bounds = splitters(keyed, shards, tolerance)
    shard = sum((_at_or_above(b).cast("int") for b in bounds), F.lit(0))
    # Numbering a shard in one task would bind the work to the shard count, so
    # rows are numbered in pieces of the key order.
    placed = keyed.withColumn("shard", shard).withColumn("_piece", _piece(keyed, count))
    held = placed.groupBy("shard", "_piece").agg(F.count("*").alias("held"))
    before = W.partitionBy("shard").orderBy("_piece")
    offsets = held.select(
        "shard", "_piece", (F.sum("held").over(before) - F.col("held")).alias("before")
    )
    in_piece = W.partitionBy("shard", "_piece").orderBy(*_KEYS)
    return (
        placed.withColumn("rank", F.row_number().over(in_piece))
        .join(small_or_shuffled(offsets), ["shard", "_piece"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("before") + F.col("rank") - 1).cast("long").alias("slot"),
        )
    )


def _piece(keyed: DataFrame, count: int) -> Column:
    """A number of the row's piece of the key order, ascending along it.

    Pieces share the leading bits of the hash. A hash that more rows share than
    a task should number is a run of pieces of its own, cut by ``_id``.
    """
    wanted = min(MAX_PIECES, max(SHARDS, count // PIECE_ROWS * 2))
    leading = _unsigned_digits(F.col("_hash"), 0, (wanted - 1).bit_length())
    limit = max(PIECE_ROWS, count // MAX_PIECES)
    hot = keyed.groupBy("_hash").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    shares = [i / 100 for i in range(1, 100)]
    hot = (
        keyed.join(F.broadcast(hot), "_hash")  # count / limit rows: MAX_PIECES at most
        .groupBy("_hash")
        .agg(F.percentile_approx("_id", shares, 1_000).alias("ids"))
        .collect()
    )
    hashes = sorted(row["_hash"] for row in hot)
    if not hashes:
        return F.struct(leading.alias("a"), F.lit(0).alias("b"), F.lit(0).alias("c"))
    listed = F.array(*[F.lit(h) for h in hashes])
    run = F.size(F.filter(listed, lambda h: h < F.col("_hash"))) + F.size(
        F.filter(listed, lambda h: h <= F.col("_hash"))
    )
    cut = F.lit(0)
    for row in hot:
        ids = F.array(*[F.lit(i) for i in sorted(set(row["ids"]))])
        inside = F.size(F.filter(ids, lambda i: i < F.col("_id")))
        cut = F.when(F.col("_hash") == F.lit(row["_hash"]), inside).otherwise(cut)
    return F.struct(leading.alias("a"), run.alias("b"), cut.alias("c"))


def op5_histogram_sort(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    sharded = shard_by_bytes(table(spark, folder, "documents"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
