"""URL filter: list entries become validity intervals, joined as of the time of each capture.

List events (list, action, pattern, at) say that a pattern enters or leaves a
block or allow list. A pattern is a host, which covers its subdomains, or a
host and a path prefix. The events of one (list, pattern) in order of time make
intervals [added, removed). A capture is looked up under each of its host's
suffixes, alone and with each of its path's prefixes, as deep as the deepest
pattern of the list; the entry in force at its fetch time with the longest pattern decides, and of equal ones the allowing.

Defined results: captures with a null URL or time, or without a host, match
nothing and are kept; events with nulls are ignored; of events at one time, a
removal counts last; empty path segments do not count, in patterns (host/a/ is
host/a, host/ is host) as in URLs; repeated captures each give a row; an empty list keeps
all; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


#: A pattern in lower case without empty path segments.
_NORMAL = "array_join(filter(split(lower(pattern), '/'), x -> x <> ''), '/')"


def intervals(events: DataFrame) -> DataFrame:
    """list, pattern, valid_from, valid_to (null: still in force)."""
    rows = (events.select("list", F.expr(_NORMAL).alias("pattern"), "action", F.col("at").alias("valid_from"))
            .filter("list is not null and pattern is not null and action in ('add', 'remove') and valid_from is not null"))
    state = rows.groupBy("list", "pattern", "valid_from").agg(F.max("action").alias("action"))  # remove after add
    order = Window.partitionBy("list", "pattern").orderBy("valid_from")
    changed = state.withColumn("was", F.lag("action").over(order)).filter("was is null or was <> action")
    return (changed.withColumn("valid_to", F.lead("valid_from").over(order)).filter("action = 'add'")
            .select("list", "pattern", "valid_from", "valid_to"))


def keys(url: str, depth: str):
    """The patterns of up to ``depth`` path segments that can cover a URL (host suffixes, with and without path prefixes)."""
    host = rf"lower(regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"
    path = rf"regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)', 1)"
    hosts = (f"transform(sequence(1, size(split({host}, '[.]'))), "
             f"i -> array_join(slice(split({host}, '[.]'), i, size(split({host}, '[.]'))), '.'))")
    parts = f"slice(filter(split(lower({path}), '/'), x -> x <> ''), 1, {depth})"
    paths = (f"concat(array(''), if(size({parts}) = 0, cast(array() as array<string>), "
             f"transform(sequence(1, size({parts})), i -> concat('/', array_join(slice({parts}, 1, i), '/')))))")
    return F.expr(f"if({url} is null or {host} = '', cast(array() as array<string>), array_distinct(flatten("
                  f"transform({hosts}, h -> transform({paths}, p -> concat(h, p))))))")


def judge(captures: DataFrame, events: DataFrame) -> DataFrame:
    """``captures(page_id, url, fetched_at)`` with matched (pattern or null), list and blocked."""
    rows = captures.select("page_id", "url", "fetched_at")
    # copies of one capture are judged once
    distinct = rows.filter("url is not null and fetched_at is not null").select("url", "fetched_at").distinct()
    entries = intervals(events)
    # one row: the path segments of the deepest pattern
    deepest = entries.agg(F.coalesce(F.max(F.size(F.split("pattern", "/")) - 1), F.lit(0)).alias("depth"))
    looked = distinct.crossJoin(F.broadcast(deepest)).select(
        "url", "fetched_at", F.explode(keys("url", "depth")).alias("pattern"))
    best = (looked.join(entries, "pattern")
            .filter("fetched_at >= valid_from and (valid_to is null or fetched_at < valid_to)")
            .groupBy("url", "fetched_at")
            .agg(F.max(F.struct(F.length("pattern").alias("n"), (F.col("list") == "allow").alias("allow"), "pattern",
                                "list")).alias("m")))
    return (rows.join(best, ["url", "fetched_at"], "left")
            .select("page_id", "url", "fetched_at", F.col("m.pattern").alias("matched"), F.col("m.list").alias("list"),
                    F.coalesce(F.col("m.list") == "block", F.lit(False)).alias("blocked")))
