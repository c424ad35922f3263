"""Exact duplicates by full content, combined in two salted steps.

A group of copies may hold a third of all rows. Copies are first combined where
they are read (partial aggregation), then per (digest, content, salt), then the
winners of the salts per (digest, content). The number of salts grows with the
table, so no list and no task holds more than its share of a group. The content
is a grouping key at both steps, so equality never rests on the digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import SPACES, text_or_empty

ROWS_PER_SALT = 100_000


def normal_text(column: str) -> Column:
    """The text with each run of white space as one space; null is empty."""
    return F.regexp_replace(text_or_empty(column), SPACES, " ")


def _salts(docs: DataFrame, rows_per_salt: int) -> int:
    return max(1, -(-docs.count() // rows_per_salt))


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after `normal_text`; null counts as empty.
    Of equal texts the row with the smallest id stays; null ids come last, so
    `keep_id` is null only if a group has no other. Of repeated rows (equal id
    and text) one is kept. Other columns are not read; an empty table gives no
    rows.
    """
    salts = _salts(docs, rows_per_salt)
    rows = docs.select(F.col(id_col).alias("id"), normal_text(text_col).alias("body")).select(
        F.struct(F.col("id").isNull().alias("none"), "id").alias("id"),
        "body",
        F.unhex(F.sha2("body", 256)).alias("digest"),
        F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"),
    )
    salted = rows.groupBy("digest", "body", "salt").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    winners = salted.select("digest", "body", "salt", F.col("ids")[0].alias("first"), F.size("ids").alias("n"))
    groups = winners.groupBy("digest", "body").agg(
        F.min("first").alias("keep"),
        F.sum("n").alias("group_size"),
        # One entry per salt.
        F.collect_list(F.struct("salt", "first")).alias("parts"),
    )
    parts = groups.select("digest", "keep", "group_size", F.explode("parts").alias("part")).select(
        "digest", "keep", "group_size", F.col("part.salt").alias("salt"), F.col("part.first").alias("first")
    )
    members = salted.select(
        F.col("digest").alias("m_digest"), F.col("salt").alias("m_salt"), F.col("ids")[0].alias("m_first"), "ids"
    )
    match = (
        parts["digest"].eqNullSafe(members["m_digest"])
        & parts["salt"].eqNullSafe(members["m_salt"])
        & parts["first"].eqNullSafe(members["m_first"])
    )
    return parts.join(members, match).select(
        "keep", "group_size", "digest", "first", F.posexplode("ids").alias("at", "id")
    ).select(
        F.col("id.id").alias(id_col),
        F.col("keep.id").alias("keep_id"),
        "group_size",
        ((F.col("at") == 0) & F.col("first").eqNullSafe(F.col("keep"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """The rows that stay, with their own columns and texts.

    The same two steps as `duplicate_groups`, carrying the winning row instead
    of the list of ids. The winner's own text travels only where it differs
    from the normal form. Rows that agree in id and text are interchangeable.
    """
    columns = docs.columns
    salts = _salts(docs, rows_per_salt)
    text = F.col(text_col)
    body = normal_text(text_col)
    own = F.when(text.isNull() | (text != body), F.struct(text.alias("text")))
    rest = F.struct(*[F.col(c) for c in columns if c != text_col])
    rows = docs.select(
        body.alias("__body"),
        F.unhex(F.sha2(body, 256)).alias("__digest"),
        F.pmod(F.xxhash64(id_col), F.lit(salts)).alias("__salt"),
        F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), own.alias("own")).alias("__order"),
        F.struct(own.alias("own"), rest.alias("rest")).alias("__row"),
    )
    for keys in (["__digest", "__body", "__salt"], ["__digest", "__body"]):
        rows = rows.groupBy(*keys).agg(F.min_by("__row", "__order").alias("__row"), F.min("__order").alias("__order"))
    text = F.when(F.col("__row.own").isNull(), F.col("__body")).otherwise(F.col("__row.own.text"))
    return rows.select(
        *[text.alias(c) if c == text_col else F.col("__row.rest").getField(c).alias(c) for c in columns]
    )


SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT doc_id, body, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""
