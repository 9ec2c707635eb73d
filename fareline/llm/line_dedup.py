"""Boilerplate lines: those that many sites share, found by HyperLogLog sketches of each line's sites.

Each line hash gets a sketch of its sites; partial sketches of a task merge in the aggregation, so a line that every
document holds costs one row a task. The sketch decides where its estimate is far from the threshold. Lines near it get
an exact count of distinct sites, from the same lines again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.session import broadcast_if_small, pin

#: Sites from which on a line is boilerplate, and words that it needs to be looked at.
MIN_SITES, MIN_WORDS = 10, 3
#: log2 of a sketch's places: a relative error of 1.04 / sqrt(2^10), about 3 %, for many sites, and exact for few.
SKETCH = 10
#: Estimates within this share of the threshold are counted exactly: six standard errors.
NEAR = 0.2
#: Boilerplate hashes that may be broadcast, after they have been counted.
BROADCAST_LINES = 500_000


def _normal(line: Column) -> Column:
    """A line as it is compared: lower case, white space around it gone and inside it single."""
    return F.lower(F.trim(F.regexp_replace(line, "[ \\t\\x0B\\f\\r]+", " ")))


def _hashed(line: Column) -> Column:
    """A number for each normal line of enough words, null for others."""
    words = F.length(_normal(line)) - F.length(F.replace(_normal(line), F.lit(" "), F.lit("")))
    return F.when(words >= MIN_WORDS - 1, F.xxhash64(_normal(line)))


def _lines(docs: DataFrame, text: str, site: str, doc_id: str) -> DataFrame:
    """The lines that are looked at: their row's hashes (of ID and text), ID, place, hash and site; pinned."""
    parts = F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n", -1)).alias("at", "line")
    rows = docs.select(F.xxhash64(doc_id).alias("__k1"), F.xxhash64(text).alias("__k2"), F.col(doc_id).alias("id"), F.col(site).alias("site"), parts)
    rows = rows.withColumn("site", F.when(F.col("site").isNotNull(), F.xxhash64("site")))
    return pin(rows.withColumn("line", _hashed(F.col("line"))).where("line is not null"))


def line_sites(lines: DataFrame, min_sites: int = MIN_SITES, near: float = NEAR, sketch: int = SKETCH) -> DataFrame:
    """(line, sites) of those of `lines` (line, site) that at least `min_sites` distinct sites hold; pinned.

    `sites` is the sketch's estimate, or the exact number near the threshold. Null sites do not count.
    """
    lines = lines.where(F.col("site").isNotNull()).select("line", "site")
    # A line of one site alone, as most are, needs no sketch: two cheap aggregates leave it out.
    shared = lines.groupBy("line").agg(F.min("site").alias("lo"), F.max("site").alias("hi")).where("lo != hi").select("line")
    shared = broadcast_if_small(pin(shared), BROADCAST_LINES)
    spread = lines.join(shared, "line", "left_semi").groupBy("line").agg(F.hll_sketch_agg("site", sketch).alias("sites"))
    spread = pin(spread.withColumn("sites", F.hll_sketch_estimate("sites")).where(F.col("sites") >= min_sites * (1 - near)))
    doubtful = broadcast_if_small(spread.where(F.col("sites") < min_sites * (1 + near)).select("line"), BROADCAST_LINES)
    exact = lines.join(doubtful, "line", "left_semi").distinct().groupBy("line").agg(F.count("*").alias("exact"))
    found = spread.join(exact, "line", "left").select("line", F.coalesce("exact", "sites").alias("sites"))
    return pin(found.where(F.col("sites") >= min_sites))


def remove_boilerplate(
    docs: DataFrame, text: str = "text", site: str = "source", doc_id: str = "doc_id", min_sites: int = MIN_SITES,
    keep_first: bool = False, drop_empty: bool = False,
) -> DataFrame:
    """`docs` without the lines that `min_sites` or more distinct sites share; adds n_lines and n_removed.

    Lines are cut at line feeds and compared in lower case with single white space; lines of fewer than three words
    stay. With `keep_first` the document of smallest ID keeps its copies of a line. Rows without any such line stay as
    they are, null texts too (no lines; an empty text is one line); rows without a site lose lines but do not count.
    `n_chars`, if there, is counted anew; columns named n_lines or n_removed are replaced. With `drop_empty` rows go of
    which nothing but white space is left, if they lost a line. Repeated rows lose the same lines.
    """
    docs = docs.drop("n_lines", "n_removed")
    lines = _lines(docs, text, site, doc_id)
    common = line_sites(lines, min_sites).select("line")
    hits = lines.join(broadcast_if_small(common, BROADCAST_LINES), "line")
    if keep_first:
        first = pin(hits.groupBy("line").agg(F.min("id").alias("__first")))
        hits = hits.join(broadcast_if_small(first, BROADCAST_LINES), "line").where(~F.col("id").eqNullSafe(F.col("__first")))
    # The places of one document: no more than it has lines.
    removed = hits.groupBy("__k1", "__k2").agg(F.collect_set("at").alias("__removed"))
    parts = F.split(text, "\n", -1)
    out = docs.withColumn("__k1", F.xxhash64(doc_id)).withColumn("__k2", F.xxhash64(text)).join(removed, ["__k1", "__k2"], "left")
    out = out.withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("long"))
    out = out.withColumn("n_removed", F.when(F.col("__removed").isNull(), 0).otherwise(F.size("__removed")).cast("long"))
    left = F.filter(parts, lambda _, k: ~F.array_contains("__removed", k))
    out = out.withColumn(text, F.when(F.col("__removed").isNull(), F.col(text)).otherwise(F.array_join(left, "\n")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    if drop_empty:
        out = out.where((F.col("n_removed") == 0) | F.col(text).rlike("\\S"))
    return out.select(*docs.columns, "n_lines", "n_removed")
