"""URL filters by dated lists: every capture is judged by the entries that were active when it was fetched.

The dated changes of a list ("from this day on, this host is on or off") become validity intervals, one row for each
span of time in which an entry is on. A capture's host stands for itself and its parent domains; each of these is an
equi-join on the name, with the fetch time inside the interval. A host's intervals never overlap, so no name matches
twice, and a very common host is a skewed join key that Spark splits, not a group that meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareline.session import broadcast_if_small, pin

#: Intervals that may be broadcast, after they have been counted.
BROADCAST_INTERVALS = 200_000
HOST = "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


def host_of(url: str):
    """The lower-case host of a URL column, without user, port and final dot; null where there is none."""
    host = F.rtrim(F.regexp_extract(F.lower(F.trim(url)), HOST, 1), F.lit("."))
    return F.when(host != "", host)


def validity_intervals(changes: DataFrame, host: str = "host", at: str = "at", listed: str = "listed") -> DataFrame:
    """(entry, since, until) of every span in which an entry is on; `until` is null where it still is.

    Of several changes of an entry at one time, being listed wins. Rows with a null in any of the columns are left out.
    An entry's changes make one window group: they are edits of one line of a list.
    """
    sound = changes.where(F.col(host).isNotNull() & F.col(at).isNotNull() & F.col(listed).isNotNull())
    daily = sound.groupBy(F.lower(host).alias("entry"), F.col(at).alias("since")).agg(F.bool_or(listed).alias("on"))
    later = Window.partitionBy("entry").orderBy("since")
    turns = daily.withColumn("before", F.lag("on").over(later)).where(F.col("before").isNull() | (F.col("before") != F.col("on")))
    spans = turns.withColumn("until", F.lead("since").over(later)).where("on")
    return spans.select("entry", "since", "until")


def judge_captures(
    captures: DataFrame, changes: DataFrame, url: str = "url", fetched: str = "fetched", host: str = "host", at: str = "at",
    listed: str = "listed",
) -> DataFrame:
    """`captures` with `blocked`, and `entry` and `since` of the longest active entry that covers the host.

    An entry covers its own host and all hosts below it. A capture on the day of a change falls under the new state.
    Captures without a host or a fetch time are not blocked; repeated rows are judged one by one; an empty list blocks
    none; columns named blocked, entry or since are replaced.
    """
    kept = captures.drop("blocked", "entry", "since")
    intervals = broadcast_if_small(pin(validity_intervals(changes, host, at, listed)), BROADCAST_INTERVALS)
    labels = F.split(host_of(url), "\\.")
    names = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    own = pin(kept.withColumn("__row", F.monotonically_increasing_id()))
    rows = own.select("__row", F.col(fetched).alias("__at"), F.explode(F.when(F.size(labels) > 0, names)).alias("entry"))
    active = (F.col("since") <= F.col("__at")) & (F.col("until").isNull() | (F.col("__at") < F.col("until")))
    found = rows.join(intervals, "entry").where(active)
    best = found.groupBy("__row").agg(F.max(F.struct(F.length("entry").alias("n"), "entry", "since")).alias("__best"))
    out = own.join(best, "__row", "left")
    return out.select(
        *kept.columns, F.col("__best").isNotNull().alias("blocked"), F.col("__best.entry").alias("entry"), F.col("__best.since").alias("since")
    )
