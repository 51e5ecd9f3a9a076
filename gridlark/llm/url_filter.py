"""URL filters by temporal list join.

A list entry is dated: ``(list_name, pattern, action, listed_at)``, where the pattern is a host, a domain (all hosts below it) or a
host with a path prefix, and the action adds or removes it. Entries become validity intervals ``[valid_from, valid_to)``; an as-of
join evaluates each capture against the entries that were active at its fetch time.

The join is an equi-join on pattern: a capture asks for its host with all parent domains and for all its path prefixes, of the depths
that the list's patterns have; as many patterns as its url has labels and segments, at most. No side is broadcast by hint; a host with a third of the
captures only makes repeated join keys on the capture side, which are combined with a distinct before the join. Captures without a url or fetch time take
no part in any join.

Defined cases: a null url or fetch time matches nothing (blocked false); a null key stays null; an entry with a null pattern, action or date is dropped;
several entries of a pattern, list and date: a removal wins; repeated captures stay repeated; an empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null where the url has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.nullif(F.regexp_replace(host, r"\.$", ""), F.lit(""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def list_depths(patterns: DataFrame) -> DataFrame:
    """One row: the numbers of labels ``_labels`` that patterns without a path have, and of segments ``_segments`` that those with one have."""
    slashes = F.regexp_count("pattern", F.lit("/"))
    labels = F.regexp_count("pattern", F.lit(r"\.")) + 1
    return patterns.agg(F.collect_set(F.when(slashes == 0, labels)).alias("_labels"), F.collect_set(F.when(slashes > 0, slashes)).alias("_segments"))


def capture_patterns(url: Column, label_depths: Column, segment_depths: Column) -> Column:
    """The patterns of the given depths that would block a url: its host, its parent domains, and its host with each path prefix."""
    host, labels = host_of(url), F.split(host_of(url), r"\.")
    domains = F.transform(F.filter(label_depths, lambda i: i <= F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, -i, i)))
    parts = F.filter(F.split(path_of(url), "/"), lambda x: x != "")
    prefixes = F.transform(F.filter(segment_depths, lambda i: i <= F.size(parts)), lambda i: F.concat(host, F.lit("/"), F.concat_ws("/", F.slice(parts, 1, i))))
    return F.when(host.isNotNull(), F.array_distinct(F.concat(domains, prefixes)))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``(list_name, pattern, valid_from, valid_to)`` from dated entries; ``valid_to`` is null while an entry stays."""
    clean = entries.select("list_name", F.lower("pattern").alias("pattern"), F.col("action"), F.col("listed_at")).where("pattern is not null and action is not null and listed_at is not null")
    day = clean.groupBy("list_name", "pattern", "listed_at").agg(F.min(F.when(F.col("action") == "add", 1).otherwise(0)).alias("on"))
    w = Window.partitionBy("list_name", "pattern").orderBy("listed_at")
    # A repeated addition doesn't start a new interval.
    turns = day.withColumn("was", F.coalesce(F.lag("on").over(w), F.lit(0))).where("on <> was")
    ended = turns.withColumn("valid_to", F.lead("listed_at").over(w))
    return ended.where("on = 1").select("list_name", "pattern", F.col("listed_at").alias("valid_from"), "valid_to")


def filter_urls(captures: DataFrame, entries: DataFrame, *, key: str = "page_id", url: str = "url", fetched_at: str = "fetched_at") -> DataFrame:
    """A row for each capture: key, url, fetch time, ``n_matches`` (active entries), ``matched`` (the smallest ``list:pattern``), ``blocked``."""
    intervals = validity_intervals(entries)
    depths = list_depths(intervals)
    patterns = capture_patterns(F.col("_u"), F.col("_labels"), F.col("_segments"))
    rows = captures.select(F.col(key).alias("_k"), F.col(url).alias("_u"), F.col(fetched_at).alias("_at"))
    bare = F.col("_u").isNull() | F.col("_at").isNull()
    # Captures of the same url and time share their matches.
    pair = rows.where(~bare).select("_u", "_at").distinct().select("_u", "_at", depths.select("_labels").scalar().alias("_labels"), depths.select("_segments").scalar().alias("_segments")).select("_u", "_at", F.explode(patterns).alias("pattern"))
    # Which patterns occur at all: distinct before the join, so a hot host is one row of a map task.
    asked = pair.select("pattern", "_at").distinct()
    active = asked.join(intervals, "pattern").where((F.col("valid_from") <= F.col("_at")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("_at"))))
    hits = active.groupBy("pattern", "_at").agg(F.count("*").alias("n"), F.min(F.concat_ws(":", "list_name", "pattern")).alias("m"))
    found = pair.join(hits, ["pattern", "_at"]).groupBy("_u", "_at").agg(F.sum("n").alias("n_matches"), F.min("m").alias("matched"))
    out = rows.where(~bare).join(found, ["_u", "_at"], "left").select("_k", "_u", "_at", "n_matches", "matched")
    out = out.unionByName(rows.where(bare).select("*", F.lit(None).cast("long").alias("n_matches"), F.lit(None).cast("string").alias("matched")))
    return out.select(F.col("_k").alias(key), F.col("_u").alias(url), F.col("_at").alias(fetched_at), F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), "matched", F.col("n_matches").isNotNull().alias("blocked"))
