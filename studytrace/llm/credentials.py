"""Secret scans judged by corpus-wide ownership of each value.

Patterns find credential-like spans in every text; every value's hash is then
counted over the distinct owners and repositories that hold it. A value that
several owners hold, or one owner in many repositories, is a copied example; a
value that one owner holds in few repositories looks live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from studytrace.llm.common import fresh, table, text_or_empty, with_row_id
from studytrace.session import durable


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# The base patterns, their kinds in order, and their least lengths.
ASSIGN = (
    f"({_either_case('password|passwd|secret|token|api_?key')})"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
# Runs shorter than the least length fail whole, so the bound can stand in the
# pattern; an assignment that fails still uses up its text, so it can not there.
ACCESS_LONG = f"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}"
HEX_LONG = f"[0-9a-f]{{{HEX_LEAST},}}"

#: Bare tokens that the ownership count may add: long, mixing digits with letters
#: of both cases.
BARE = "[A-Za-z0-9+/_=-]{24,}"
OWNED = "owned"
#: A value looks live up to so many owners and repositories.
MAX_OWNERS, MAX_REPOSITORIES = 1, 2
REDACTED = "[secret]"


def _pieces(text: Column, pattern: str, kind: str, value_group: int) -> Column:
    """Per match: kind, order, gap since the match before, length and value.

    Splitting at a pattern and extracting it walk the same matches, so the gaps
    and matches alternate; positions are their running sums.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    gaps = F.split(text, pattern, -1)
    return F.transform(
        F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), values.alias("value")),
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(m["gap"]).alias("gap"),
            F.length(m["whole"]).alias("long"),
            m["value"].alias("value"),
        ),
    )


def _if_found(text: Column, pattern: str, kind: str, value_group: int) -> Column:
    nothing = F.array().cast(
        "array<struct<kind:string,i:int,gap:int,long:int,value:string>>"
    )
    return F.when(text.rlike(pattern), _pieces(text, pattern, kind, value_group)).otherwise(nothing)


def find_spans(docs: DataFrame, owner: str = "source", repository: str = "lang") -> DataFrame:
    """Every candidate span: uid, doc_id, text_key, owner, repository, kind, start, end, value.

    Positions are code points, ``end`` exclusive. A document without a span has
    one row with null kind. Kind ``bare`` is a candidate only. A repository is
    known by its owner and name.
    """
    rows = with_row_id(
        docs.select(
            "doc_id", "text", F.col(owner).alias("owner"), F.col(repository).alias("repository")
        )
    )
    text = text_or_empty()
    any_found = text.rlike(ASSIGN) | text.rlike(ACCESS_LONG) | text.rlike(HEX_LONG)
    scanned = rows.select(
        "uid",
        "doc_id",
        F.when(any_found | text.rlike(BARE), F.md5(text.cast("binary"))).alias("text_key"),
        "owner",
        F.concat_ws("/", "owner", "repository").alias("repository"),
        F.explode_outer(
            F.concat(
                _if_found(text, ASSIGN, "assign", 2),
                _if_found(text, ACCESS_LONG, "access", 0),
                _if_found(text, HEX_LONG, "hex", 0),
                _if_found(text, BARE, "bare", 0),
            )
        ).alias("m"),
    ).select("uid", "doc_id", "text_key", "owner", "repository", "m.*")
    so_far = W.partitionBy("uid", "kind").orderBy("i")
    placed = scanned.repartition("uid").withColumn(
        "end", F.sum(F.col("gap") + F.coalesce("long", F.lit(0))).over(so_far)
    )
    value = F.col("value")
    mixed = value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")
    fits = (
        F.when(F.col("kind") == "assign", F.length(value) >= ASSIGN_LEAST)
        .when(F.col("kind") == "bare", mixed)
        .otherwise(F.col("long").isNotNull())
    )
    # The last gap of each kind has no match; it fails like a short value, but
    # every document keeps a row.
    good = F.coalesce(fits & F.col("long").isNotNull(), F.lit(False))
    kept = [
        F.when(good, c).alias(c_name)
        for c_name, c in (
            ("kind", F.col("kind")),
            ("start", F.col("end") - F.col("long")),
            ("end", F.col("end")),
            ("value", value),
        )
    ]
    rank = F.row_number().over(W.partitionBy("uid").orderBy(F.col("good").desc(), "kind", "i"))
    return (
        placed.withColumn("good", good)
        .withColumn("rank", rank)
        .filter(F.col("good") | (F.col("rank") == 1))
        .select("uid", "doc_id", "text_key", "owner", "repository", *kept)
    )


def ownership(spans: DataFrame) -> DataFrame:
    """(value_hash, owners, repositories): distinct holders of each value.

    Holders are reduced to distinct (value, owner, repository) on the map side,
    so an example that a third of all documents hold is counted where it lies.
    """
    held = spans.filter("value_hash IS NOT NULL").select("value_hash", "owner", "repository").distinct()
    return held.groupBy("value_hash").agg(
        F.countDistinct("owner").alias("owners"),
        F.countDistinct("repository").alias("repositories"),
    )


def scan_secrets(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "lang",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row per document: uid, doc_id, text_key, ``base`` and ``found`` spans.

    Each span has kind, start, end, owners, repositories and ``live``: held by
    at most ``max_owners`` owners in at most ``max_repositories`` repositories. Base spans always stay. ``found`` also has
    the bare tokens (kind ``owned``) that lie outside every base span and look
    live. ``text_key`` names the text; it is null where no pattern matches.

    Null texts are empty; null ids and repeated rows each give their own row; a
    null owner counts as nobody. Other columns are not read.
    """
    spans = durable(
        find_spans(docs, owner, repository).select(
            "uid", "doc_id", "text_key", "owner", "repository", "kind", "start", "end",
            F.sha2(F.col("value"), 256).alias("value_hash"),
        )
    )
    unknown = F.lit(None).cast("long")
    # Rows without a value take no part in the join: they would share its null key.
    joined = (
        spans.filter("value_hash IS NOT NULL")
        .join(ownership(spans), "value_hash")
        .unionByName(
            spans.filter("value_hash IS NULL").select(
                "*", unknown.alias("owners"), unknown.alias("repositories")
            )
        )
    )
    is_bare = F.col("kind") == "bare"
    span = F.struct(
        "start",
        F.when(is_bare, len(KINDS))
        .when(F.col("kind") == "hex", 2)
        .when(F.col("kind") == "access", 1)
        .otherwise(0)
        .alias("rank"),
        F.when(is_bare, OWNED).otherwise(F.col("kind")).alias("kind"),
        "end",
        "owners",
        "repositories",
        (
            (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
        ).alias("live"),
    )
    grouped = joined.groupBy("uid").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("text_key").alias("text_key"),
        F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), span))).alias("all"),
    )
    added = F.filter(
        "all",
        lambda s: (s["kind"] == OWNED)
        & s["live"]
        & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return grouped.withColumn("base", F.filter("all", lambda s: s["kind"] != OWNED)).select(
        "uid", "doc_id", "text_key", "base", F.array_sort(F.concat("base", added)).alias("found")
    )


def redact(docs: DataFrame, owner: str = "source", repository: str = "lang") -> DataFrame:
    """``docs`` with every found span masked as ``[secret]``; all rows stay.

    ``n_chars``, if it is a column, becomes the new length of a changed text.
    Only texts that a pattern matches are joined with their spans, by text: the
    spans of equal texts are equal.
    """
    key, found, acc = (fresh(docs.columns, n) for n in ("_text_key", "_found", "_masked"))
    text = text_or_empty()
    suspect = (
        text.rlike(ASSIGN) | text.rlike(ACCESS_LONG) | text.rlike(HEX_LONG) | text.rlike(BARE)
    )
    spans = (
        scan_secrets(docs, owner, repository)
        .filter("text_key IS NOT NULL")
        .groupBy(F.col("text_key").alias(key))
        .agg(F.first("found").alias(found))
    )

    def mask(done: Column, span: Column) -> Column:
        inside = span["start"] < done["upto"]
        piece = F.concat(
            F.substring(F.col("text"), done["upto"] + 1, span["start"] - done["upto"]),
            F.lit(REDACTED),
        )
        return F.struct(
            F.greatest(done["upto"], span["end"]).cast("int").alias("upto"),
            F.concat(done["out"], F.when(inside, F.lit("")).otherwise(piece)).alias("out"),
        )

    start = F.struct(F.lit(0).alias("upto"), F.lit("").alias("out"))
    short = F.transform(
        found, lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"))
    )
    masked = (
        docs.filter(suspect)
        .withColumn(key, F.md5(text.cast("binary")))
        .join(spans, key, "left")
        .withColumn(acc, F.aggregate(short, start, mask))
    )
    rest = F.substring(F.col("text"), F.col(acc)["upto"] + 1, F.length("text"))
    changed = F.when(F.size(found) > 0, F.concat(F.col(acc)["out"], rest)).otherwise(F.col("text"))
    masked = masked.withColumn("text", changed)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.size(found) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        masked = masked.withColumn("n_chars", length)
    return masked.select(*docs.columns).unionByName(docs.filter(~suspect))


def _listed(spans: str) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _most(count: str) -> Column:
    """The largest count over a document's spans; zero without any."""
    return F.coalesce(F.array_max(F.transform("found", lambda s: s[count])), F.lit(0))


def op4_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents, as counts, digest of the base spans, and spans."""
    found = scan_secrets(table(spark, folder, "documents"))
    live = F.size(F.filter("found", lambda s: s["live"])).cast("long")
    return found.select(
        "doc_id",
        *[_count("base", kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"),
        _listed("found").alias("spans"),
        live.alias("n_live"),
        (F.size("found").cast("long") - live).alias("n_copied"),
        _most("owners").alias("max_owners"),
        _most("repositories").alias("max_repositories"),
    )


def _sql_pieces(kind: str, pattern: str, group: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, source, lang, '{kind}' AS kind,
         string_split_regex(text, '{quoted}') AS gaps,
         regexp_extract_all(text, '{quoted}', 0) AS hits,
         regexp_extract_all(text, '{quoted}', {group}) AS vals
  FROM documents WHERE regexp_matches(text, '{quoted}')"""


OP4_SQL = f"""
WITH pieces AS ({" UNION ALL ".join([
    _sql_pieces("assign", ASSIGN, 2), _sql_pieces("access", ACCESS_LONG, 0),
    _sql_pieces("hex", HEX_LONG, 0), _sql_pieces("bare", BARE, 0)])}
), listed AS (
  SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM pieces
), placed AS (
  SELECT doc_id, source, lang, kind, vals[i] AS val, length(hits[i]) AS long,
         list_sum(list_transform(gaps[1:i], lambda x: length(x)))::BIGINT
           + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0)::BIGINT AS start
  FROM listed
), spans AS (
  SELECT *, start + long AS stop, sha256(val) AS value_hash FROM placed
  WHERE CASE kind WHEN 'assign' THEN length(val) >= {ASSIGN_LEAST}
    WHEN 'bare' THEN regexp_matches(val, '[0-9]') AND regexp_matches(val, '[a-z]')
      AND regexp_matches(val, '[A-Z]') ELSE true END
), owned AS (
  SELECT value_hash, count(DISTINCT source) AS owners,
    count(DISTINCT concat_ws('/', source, lang)) AS repositories
  FROM spans GROUP BY 1
), judged AS (
  SELECT s.*, o.owners, o.repositories,
    o.owners <= {MAX_OWNERS} AND o.repositories <= {MAX_REPOSITORIES} AS live
  FROM spans s JOIN owned o USING (value_hash)
), kept AS (
  SELECT doc_id, start, stop, live, owners, repositories, CASE kind WHEN 'bare' THEN '{OWNED}' ELSE kind END AS kind,
         CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 WHEN 'hex' THEN 2 ELSE 3 END AS rank
  FROM judged a
  WHERE kind <> 'bare' OR (live AND NOT EXISTS (
    SELECT 1 FROM judged b WHERE b.doc_id = a.doc_id AND b.kind <> 'bare'
      AND b.start < a.stop AND a.start < b.stop))
)
SELECT d.doc_id,
       count(*) FILTER (kind = 'assign') AS n_assign,
       count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)
         FILTER (kind <> '{OWNED}'), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank), '') AS spans,
       count(*) FILTER (live) AS n_live,
       count(*) FILTER (NOT live) AS n_copied,
       coalesce(max(owners), 0) AS max_owners,
       coalesce(max(repositories), 0) AS max_repositories
FROM documents d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id
"""
