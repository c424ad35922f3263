"""Cross-site boilerplate lines by the number of distinct sites that use them.

Every line hash gets a HyperLogLog sketch of its sites, merged by aggregation.
Lines whose estimate is far below or above the limit are settled; those near it
get an exact distinct count. Lines on enough sites are cut from all documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import SPACES, text_or_empty
from lapwise.session import materialised

MIN_SITES = 6
# Registers as a power of two: a relative standard error of 0.83 / sqrt(2^12) = 1.3 %.
LG_REGISTERS = 12
# Standard errors on either side of the limit within which sites are counted exactly.
NEAR = 8
# A line in more than 1 / HOT_SHARE of all line rows is hot; there can be no more than HOT_SHARE of them.
HOT_SHARE = 10_000


def line_form(line: Column) -> Column:
    """Lines are compared with runs of white space as one space and without it at the ends."""
    return F.trim(F.regexp_replace(line, SPACES, " "))


def lines_of(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """(id, key, site, at, h1, h2): the 128-bit hash of every line that is not blank; `key` is a hash of the whole text.

    Id and key name a row, as ids may repeat or be null. Rows with both equal have the same lines.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), F.col(site_col).cast("string").alias("site"),
                       F.posexplode(F.split(text, "\n")).alias("at", "line"))
    rows = rows.withColumn("line", line_form(F.col("line"))).filter("line != ''")
    return rows.select("id", "key", "site", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """(h1, h2, uses) of the lines on at least `min_sites` sites; a null site is none."""
    band = 1 + NEAR * 0.83 / math.sqrt(2**lg_registers) * min_sites
    sketched = lines.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("uses"), F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_registers))).alias("sites")
    )
    # A line has no more sites than uses.
    sketched = materialised(sketched.filter((F.col("uses") >= min_sites) & (F.col("sites") >= min_sites - band)), "spread")
    far = sketched.filter(F.col("sites") > min_sites + band).select("h1", "h2", "uses")
    near = sketched.filter(F.col("sites") <= min_sites + band).select("h1", "h2", "uses")
    exact = lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
    exact = exact.groupBy("h1", "h2").agg(F.count("site").alias("exact")).filter(F.col("exact") >= min_sites)
    return far.union(near.join(exact, ["h1", "h2"]).select("h1", "h2", "uses"))


def cut_spread_lines(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    lg_registers: int = LG_REGISTERS,
) -> DataFrame:
    """One row per input row: id, text without spread lines, n_lines, n_cut.

    A line is cut everywhere if it is on `min_sites` distinct sites or more.
    Blank lines are never cut. A null or empty text gives an empty text with
    one blank line; a null site counts for no line; rows with equal or null ids
    are cut each by its own text. An empty table gives no rows.
    """
    # Written once: the sketches, the exact counts and the cuts all read the hashes.
    lines = materialised(lines_of(docs, id_col, text_col, site_col), "lines")
    spread = materialised(spread_lines(lines, min_sites, lg_registers), "boilerplate")
    uses = spread.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0]
    # Fewer than HOT_SHARE lines can have more than that share of the uses, which bounds the broadcast.
    hot = spread.filter(F.col("uses") * HOT_SHARE > uses).select("h1", "h2", F.lit(True).alias("hot"))
    cold = spread.filter(F.col("uses") * HOT_SHARE <= uses).select(F.col("h1").alias("c1"), F.col("h2").alias("c2"))
    marked = lines.join(F.broadcast(hot), ["h1", "h2"], "left").select("id", "key", "at", "h1", "h2", "hot")
    rest = marked.filter("hot IS NULL").join(cold, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left_semi")
    found = marked.filter("hot").select("id", "key", "at").union(rest.select("id", "key", "at"))
    # A document has no more entries here than lines.
    cuts = found.groupBy(F.col("id").alias("cut_id"), F.col("key").alias("cut_key")).agg(F.array_sort(F.collect_set("at")).alias("cut"))
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    rows = rows.join(cuts, rows["id"].eqNullSafe(cuts["cut_id"]) & (F.col("key") == F.col("cut_key")), "left")
    rows = rows.select("id", F.split("text", "\n").alias("lines"), F.coalesce("cut", F.array().cast("array<int>")).alias("cut"))
    # The runs between neighbouring cuts, so that the work is linear in the lines.
    runs = """flatten(transform(sequence(0, size(cut)), i -> slice(
        lines, if(i = 0, 1, cut[i - 1] + 2), if(i = size(cut), size(lines), cut[i]) - if(i = 0, 0, cut[i - 1] + 1))))"""
    kept = F.when(F.size("cut") == 0, F.col("lines")).otherwise(F.expr(runs))
    return rows.select(
        F.col("id").alias(id_col),
        F.array_join(kept, "\n").alias(text_col),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("cut").cast("long").alias("n_cut"),
    )


SQL = r"""
WITH l AS (SELECT d.doc_id, d.source, x.pos, x.line,
                  trim(regexp_replace(x.line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS form
           FROM documents d, (SELECT 1) o, LATERAL (
             SELECT unnest(string_split(coalesce(d.text, ''), chr(10))) AS line,
                    unnest(range(len(string_split(coalesce(d.text, ''), chr(10))))) AS pos) x),
s AS (SELECT form FROM l WHERE form <> '' GROUP BY form HAVING count(DISTINCT source) >= 6)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE s.form IS NULL), '') AS text,
       count(*) AS n_lines, count(s.form) AS n_cut
FROM l LEFT JOIN s USING (form) GROUP BY doc_id
"""
