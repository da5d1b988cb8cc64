"""Exact duplicates: a 128-bit content hash, bytes compared inside each hash group.

Texts are equal when identical after deleting ASCII white space. Rows are
grouped by (MD5 of the normalised text, normalised text): the hash spreads the
rows and leads the sort, the text as second key compares the bytes, so a hash
collision makes two groups. Partial aggregation sends a copied text once per
task, however large its group of copies.

Defined results: a null text is an empty text; empty texts are copies of one
another. Of equal texts the row with the most code points in its original text
stays, then the smallest id (a null id counts as the largest). Rows repeated
with the id and length of the kept row are all marked ``kept`` by
:func:`exact_dedup`, which returns one row per input row; :func:`drop_exact_copies`
keeps exactly one row of each group. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, text_or_empty


def _normalised(text: str):
    return F.regexp_replace(text_or_empty(text), SPACES, "")


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per different text: content_hash, text_sha256, group_size, keep_id, keep_chars."""
    keyed = docs.select(F.col(id_col).alias("id"), F.length(text_or_empty(text_col)).alias("chars"),
                        _normalised(text_col).alias("norm"))
    keyed = keyed.select("*", F.unhex(F.md5("norm")).alias("content_hash"))
    best = F.min(F.struct((-F.col("chars")).alias("minus_chars"), F.col("id").isNull().alias("no_id"), F.col("id")))
    return (keyed.groupBy("content_hash", "norm")
            .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
            .select("content_hash", F.sha2("norm", 256).alias("text_sha256"), "group_size",
                    F.col("best.id").alias("keep_id"), (-F.col("best.minus_chars")).alias("keep_chars")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Rows find their group by both digests; two texts with equal MD5 are apart in
    the groups (bytes compared) and told apart here by SHA-256. The rows moved by
    this join hold digests only, and a hot key is split by the skew-join rule.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.length(text_or_empty(text_col)).alias("chars"),
                       _normalised(text_col).alias("norm"))
    rows = rows.select("id", "chars", F.unhex(F.md5("norm")).alias("content_hash"),
                       F.sha2("norm", 256).alias("text_sha256"))
    found = rows.join(content_groups(docs, id_col, text_col), ["content_hash", "text_sha256"])
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows with all their columns: one row of each group of equal texts."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("row"), F.length(text_or_empty(text_col)).alias("chars"),
                        F.col(id_col).alias("id"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("any"),
                        _normalised(text_col).alias("norm"))
    keyed = keyed.select("*", F.unhex(F.md5("norm")).alias("content_hash"))
    order = F.struct(-F.col("chars"), F.col("id").isNull(), F.col("id"), F.col("any"))
    return keyed.groupBy("content_hash", "norm").agg(F.min_by("row", order).alias("row")).select("row.*")


EXACT_SQL = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT norm, count(*) AS group_size, max(length(t)) AS chars FROM n GROUP BY norm),
k AS (
  SELECT n.norm, min(n.doc_id) AS keep_id FROM n JOIN g ON n.norm = g.norm AND length(n.t) = g.chars GROUP BY n.norm)
SELECT n.doc_id, k.keep_id, CAST(g.group_size AS BIGINT) AS group_size,
       (n.doc_id = k.keep_id AND length(n.t) = g.chars) AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g ON n.norm = g.norm JOIN k ON n.norm = k.norm
"""
