"""SpotSigs document fingerprints.

A signature is a common word's place in the text together with the chain of
content words that follow it; lists of links, menus and other text without
running sentences hardly have any. The set of all signatures is a document's
fingerprint, and likeness is the Jaccard similarity of two sets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from studytrace.llm.common import table, text_or_empty
from studytrace.session import durable

# Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in is that for on with was be this by as at it are from "
    "der die das und ist nicht mit von den des ein eine zu auf "
    "le la les et est du un une dans pour par que qui sur au aux "
    "el los las y se del al con para su como esta"
).split()
CHAIN = 3
#: Hexadecimal digits kept of each signature's hash.
SIGNATURE_DIGITS = 8
SIMILAR = 0.8
#: Rows per task when documents are put in order of their ids.
RANGE_ROWS = 2_000
MAX_RANGES = 65_536
_COARSE = 256
_WORD_GAP = r"[^\p{L}\p{N}]+"


def signatures(text: Column) -> Column:
    """The sorted set of signatures of a text, as an array of hex strings.

    Every common word starts a chain of the next ``CHAIN`` content words, fewer
    at the end of the text; the start of the text counts as a common word. In a
    text without any common word every content word starts a chain, so that its
    fingerprint covers the whole text too. A text without content words has the
    hash of the text itself as its only signature, so the set is never empty.
    The null text is the empty text.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(F.lower(text), _WORD_GAP, -1), lambda w: w != "")
    content = F.filter(words, lambda w: ~w.isin(ANCHORS))
    # The j-th common word, at word i, has i - j content words before it.
    marked = F.transform(words, lambda w, i: F.when(w.isin(ANCHORS), i).otherwise(-1))
    places = F.transform(F.filter(marked, lambda i: i >= 0), lambda i, j: i - j)

    def starts(t: Column) -> Column:
        after_common = F.array_distinct(F.concat(F.array(F.lit(0)), t["p"]))
        every = F.sequence(F.lit(0), F.greatest(F.size(t["c"]) - 1, F.lit(0)))
        return F.when(F.size(t["p"]) > 0, after_common).otherwise(every)

    # A lambda over the content words binds them once per text.
    sets = F.transform(
        F.array(F.struct(content.alias("c"), places.alias("p"))),
        lambda t: F.transform(
            F.filter(starts(t), lambda at: at < F.size(t["c"])),
            lambda at: F.substring(
                F.md5(F.array_join(F.slice(t["c"], at + 1, CHAIN), " ").cast("binary")),
                1,
                SIGNATURE_DIGITS,
            ),
        ),
    )[0]
    itself = F.array(F.substring(F.md5(text.cast("binary")), 1, SIGNATURE_DIGITS))
    return F.array_sort(F.array_distinct(F.when(F.size(sets) > 0, sets).otherwise(itself)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets."""
    common = F.size(F.array_intersect(a, b)).cast("double")
    return common / (F.size(a) + F.size(b) - common)


def _descending_range(docs: DataFrame) -> Column:
    """A range number that grows as ``doc_id`` falls; null ids come last.

    The bounds are approximate percentiles: they only have to make the ranges
    about equally large. They are looked up in two steps, coarse and fine.
    """
    rows = docs.count()
    ranges = min(MAX_RANGES, max(1, -(-rows // RANGE_ROWS)))
    shares = [i / ranges for i in range(1, ranges)]
    if not shares or not rows:
        return F.when(F.col("doc_id").isNull(), 1).otherwise(0)
    found = docs.agg(F.percentile_approx("doc_id", shares, 10 * ranges + 10_000).alias("b")).first()
    bounds = sorted(set(found["b"] or []), reverse=True)
    blocks = [bounds[i : i + _COARSE] for i in range(0, len(bounds), _COARSE)]
    heads = F.array(*[F.lit(b[0]).cast("long") for b in blocks])
    nested = F.array(*[F.array(*[F.lit(x).cast("long") for x in b]) for b in blocks])
    doc_id = F.col("doc_id")
    block = F.greatest(F.size(F.filter(heads, lambda h: h > doc_id)), F.lit(1))
    inside = F.size(F.filter(F.element_at(nested, block), lambda h: h > doc_id))
    number = (block - 1) * _COARSE + inside
    return F.when(doc_id.isNull(), len(bounds) + 1).otherwise(number)


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, signatures, next_text, next_signatures) of every document.

    The next document is the one after it in descending ``doc_id``, nulls last
    and equal ids by their texts; after the last comes the first. A table of
    one document is its own next. Rows are dealt once, by ranges of ids; each
    range also gets a copy of the first document of the range after it.
    """
    number = _descending_range(docs)
    rows = docs.select("doc_id", text_or_empty().alias("text"), number.alias("range"))
    firsts = rows.groupBy("range").agg(F.max("doc_id").alias("first_id"))
    by_range = W.orderBy("range")
    firsts = firsts.select(
        F.col("range").alias("from_range"),
        "first_id",
        F.coalesce(
            F.lag("range").over(by_range), F.max("range").over(W.partitionBy(F.lit(0)))
        ).alias("to_range"),
    )
    tie = F.xxhash64("text")
    leader = W.partitionBy("from_range").orderBy(tie, "text")
    guests = (
        rows.join(
            F.broadcast(firsts),  # at most MAX_RANGES + 1 rows
            (F.col("range") == F.col("from_range")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
        )
        .withColumn("n", F.row_number().over(leader))
        .filter("n = 1")
        .select("doc_id", "text", F.col("to_range").alias("range"), F.lit(True).alias("guest"))
    )
    dealt = rows.withColumn("guest", F.lit(False)).unionByName(guests).repartition("range")
    order = W.partitionBy("range").orderBy(
        "guest", F.col("doc_id").desc_nulls_last(), tie, "text"
    )
    return (
        dealt.withColumn("signatures", signatures(F.col("text")))
        .withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_signatures", F.lead("signatures").over(order))
        .filter(~F.col("guest"))
        .select("doc_id", "text", "signatures", "next_text", "next_signatures")
    )


def similar_classes(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """Links between different fingerprints with likeness of at least ``least``.

    Returns (class_a, class_b, similarity), classes named by the digest of their
    fingerprint; ``class_members`` tells each document's class. Copies are one
    class, so repeated rows add no links; an empty table has none.
    """
    return _links(_class_sets(class_members(docs)), least)


def _class_sets(members: DataFrame) -> DataFrame:
    """(class, signatures), written out, of the rows of ``class_members``."""
    return durable(members.groupBy("class").agg(F.first("signatures").alias("signatures")))


def _links(sets: DataFrame, least: float) -> DataFrame:
    """The links of ``similar_classes`` between the rows of ``_class_sets``.

    Sets are partitioned by length, since similar sets have similar lengths, and
    within and between neighbouring partitions only sets that share one of their
    rarest signatures meet. Their lengths, and what can still be common after
    the places of the shared signature, are tested while they are joined.
    """
    sets = sets.withColumn("n", F.size("signatures"))
    part = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(least)) + 1e-9)
    each = sets.select("class", "n", part.alias("part"), F.explode("signatures").alias("s"))
    held = each.groupBy("s").agg(F.count("*").alias("held"))
    rarest = W.partitionBy("class").orderBy("held", "s")
    prefix = (
        each.join(held, "s")
        .withColumn("at", F.row_number().over(rarest))
        .filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1)
        .drop("held")
    )
    near_part = prefix.withColumn(
        "part", F.explode(F.array(F.col("part"), F.col("part") + 1))
    )
    a, b = prefix.alias("a"), near_part.alias("b")
    # At their first shared signature, similar sets have this much ahead of them.
    ahead = 1 + F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    meet = (
        (F.col("a.s") == F.col("b.s"))
        & (F.col("a.part") == F.col("b.part"))
        & (
            (F.col("a.n") > F.col("b.n"))
            | ((F.col("a.n") == F.col("b.n")) & (F.col("a.class") > F.col("b.class")))
        )
        & (F.col("b.n") >= F.col("a.n") * least - 1e-9)
        & (ahead >= (F.col("a.n") + F.col("b.n")) * (least / (1 + least)) - 1e-9)
    )
    pairs = (
        a.join(b, meet)
        .select(F.col("a.class").alias("class_a"), F.col("b.class").alias("class_b"))
        .distinct()
    )
    one = sets.select(F.col("class").alias("class_a"), F.col("signatures").alias("x"))
    two = sets.select(F.col("class").alias("class_b"), F.col("signatures").alias("y"))
    return (
        pairs.join(one, "class_a")
        .join(two, "class_b")
        .select("class_a", "class_b", likeness(F.col("x"), F.col("y")).alias("similarity"))
        .filter(F.col("similarity") >= least)
    )


def class_members(docs: DataFrame) -> DataFrame:
    """(doc_id, class, signatures): equal fingerprints make a class.

    One row per document row, null and repeated ids included; null texts are
    empty, and all empty texts are one class. Other columns are not read.
    """
    signed = docs.select("doc_id", signatures(F.col("text")).alias("signatures"))
    return signed.withColumn("class", F.md5(F.array_join("signatures", "").cast("binary")))


def op10_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likenesses."""
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut)
    )
    return (
        with_next(table(spark, folder, "documents"))
        .withColumn("edited", edited)
        .withColumn("edited_signatures", signatures(F.col("edited")))
        .select(
            "doc_id",
            n.cast("long").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            F.array_join("signatures", "").alias("fingerprint"),
            F.array_join("edited_signatures", "").alias("edited_fingerprint"),
            likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
            likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
        )
    )


def op10_spot_classes(spark: SparkSession, folder: str) -> DataFrame:
    """The class of all documents, and the number of other classes like it.

    One row per document row, as in ``class_members``; a class of no likeness to
    others, such as that of empty texts, has no links.
    """
    members = durable(class_members(table(spark, folder, "documents")))
    links = _links(_class_sets(members), SIMILAR)
    counts = (
        links.select(F.explode(F.array("class_a", "class_b")).alias("class"))
        .groupBy("class")
        .agg(F.count("*").alias("n_links"))
    )
    return members.join(counts, "class", "left").select(
        "doc_id",
        F.array_join("signatures", "").alias("fingerprint"),
        "class",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def _sql_signatures(name: str, source: str, column: str) -> str:
    anchors = ", ".join(f"'{word}'" for word in ANCHORS)
    return f"""
{name}_words AS (
  SELECT *, list_filter(string_split_regex(lower({column}), '{_WORD_GAP}'), lambda w: w <> '') AS words
  FROM {source}
), {name}_places AS (
  SELECT *, list_filter(words, lambda w: w NOT IN ({anchors})) AS content,
         list_filter(list_transform(words, lambda w, i: CASE WHEN w IN ({anchors}) THEN i - 1 ELSE -1 END),
           lambda i: i >= 0) AS marked
  FROM {name}_words
), {name}_starts AS (
  SELECT *, CASE WHEN len(marked) > 0
    THEN list_distinct(list_concat([0], list_transform(marked, lambda i, j: i - (j - 1))))
    ELSE range(0, greatest(len(content), 1)) END AS starts
  FROM {name}_places
), {name} AS (
  SELECT * EXCLUDE (words, content, marked, starts), list_sort(list_distinct(
    CASE WHEN len(content) > 0 THEN
      list_transform(list_filter(starts, lambda s: s < len(content)),
        lambda s: substr(md5(array_to_string(content[s + 1:s + {CHAIN}], ' ')), 1, {SIGNATURE_DIGITS}))
    ELSE [substr(md5({column}), 1, {SIGNATURE_DIGITS})] END)) AS {column}_signatures
  FROM {name}_starts
)"""


def _sql_likeness(a: str, b: str) -> str:
    common = f"len(list_intersect({a}, {b}))"
    return f"{common}::DOUBLE / (len({a}) + len({b}) - {common})"


OP10_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), {_sql_signatures("signed", "texts", "text")}, paired AS (
  SELECT *,
    coalesce(lead(text) OVER d, first_value(text) OVER d) AS next_text,
    coalesce(lead(text_signatures) OVER d, first_value(text_signatures) OVER d) AS next_signatures
  FROM signed WINDOW d AS (ORDER BY doc_id DESC)
), edits AS (
  SELECT *, substr(text, 1, (length(text) - length(text) // 3)::BIGINT)
    || substr(next_text, 1, (length(text) // 3)::BIGINT) AS edited
  FROM paired
), {_sql_signatures("compared", "edits", "edited")}
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256,
       array_to_string(text_signatures, '') AS fingerprint,
       array_to_string(edited_signatures, '') AS edited_fingerprint,
       {_sql_likeness("text_signatures", "edited_signatures")} AS near_edited,
       {_sql_likeness("text_signatures", "next_signatures")} AS near_next
FROM compared
"""
