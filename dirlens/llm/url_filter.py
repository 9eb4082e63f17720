"""URL filters as a temporal list join, in DataFrame functions alone.

*History*: of dated list entries (add or remove a pattern) the last one at or before a capture's time decides whether the
pattern holds then: an entry holds from its time to the next entry for the same list, kind and pattern.

*As-of join*: every capture is expanded into the few keys that could match it (its URL, its host, each
parent domain, each path prefix) and, for each list that has the key, takes its place among the entries of (list, kind, key)
in the order of time. That order is kept an hour at a time, so a hot host spreads over hours; an hour with captures
starts with the entry that held before it, found among the last entries of the pattern's hours. Nothing is paired: each
entry and each key of a capture goes by once, whatever the number of entries that a hot pattern has.
Captures of one key and time are looked up once (a distinct before it) and the answer goes back to all of them.

Kinds: ``url`` (whole normalised URL), ``prefix`` (host and path up to a segment), ``host``, ``domain`` (the
host or any subdomain). URLs are normalised: scheme, user, port, query and fragment go, A-Z in the
host are folded, a trailing slash goes. A capture is blocked when a ``block`` entry is active and no
``allow`` entry at least as specific (url > prefix > host > domain, longer pattern first) is.

Defined results: a capture without URL, host or time matches nothing and passes. Of entries for one
pattern at one time the last by (action, entry id) counts. Entries without time or pattern are
ignored. Repeated captures come back as often. Empty lists block nothing; no captures, no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Kinds by falling specificity.
KINDS = ("url", "prefix", "host", "domain")


def normal_url(url: Column) -> Column:
    """host/path without scheme, user, port, query, fragment and trailing slash; null without a host."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), r"[?#][\s\S]*$", "")
    host = F.lower(F.regexp_replace(F.regexp_replace(F.substring_index(bare, "/", 1), r"^.*@", ""), r":\d*$", ""))
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/]*([\s\S]*)$", 1), r"/+$", "")
    return F.when(F.length(host) > 0, F.concat(host, path))


# Dyadic ranges of days, for joins of long intervals by equal keys; the as-of join above needs none.
def _shifted(x: Column, level: Column) -> Column:
    return F.call_function("shiftright", x, level)


def ranges(first: Column, last: Column, levels: Column) -> Column:
    """Array of (level, number) of the dyadic ranges that make up the days ``first`` to ``last``, numbers from 0: range
    (l, i) holds the days from i * 2^l to (i + 1) * 2^l - 1."""
    def at(level):
        # the ranges of this size inside the interval; the outer ones that no larger range holds
        lo = _shifted(first + F.call_function("shiftleft", F.lit(1), level) - 1, level)
        hi = _shifted(last + 1, level) - 1
        ends = F.array(F.struct(level.alias("level"), lo.alias("node"), (lo % 2 == 1).alias("outer")),
                       F.struct(level.alias("level"), hi.alias("node"), (hi % 2 == 0).alias("outer")))
        return F.filter(ends, lambda e: e["outer"] & (lo <= hi))
    return F.transform(F.flatten(F.transform(F.sequence(F.lit(0), levels), at)), lambda e: F.struct(e["level"], e["node"]))


def ranges_of_day(day: Column, levels: Column) -> Column:
    """Array of the dyadic ranges of all sizes that hold the day."""
    return F.transform(F.sequence(F.lit(0), levels), lambda level: F.struct(level.alias("level"), _shifted(day, level).alias("node")))


def _keys(url: Column) -> Column:
    """Array of (kind, key) that could match a normalised URL."""
    host = F.substring_index(url, "/", 1)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.struct(F.lit("domain").alias("kind"),
                                             F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("key")))
    parts = F.split(url, "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda i: F.struct(F.lit("prefix").alias("kind"),
                                              F.array_join(F.slice(parts, F.lit(1), i), "/").alias("key")))
    single = F.array(F.struct(F.lit("url").alias("kind"), url.alias("key")),
                     F.struct(F.lit("host").alias("kind"), host.alias("key")))
    return F.concat(single, domains, prefixes)


def _hour(at: str) -> Column:
    return F.floor(F.unix_seconds(F.col(at).cast("timestamp")) / 3600)


def active(keyed: DataFrame, entries: DataFrame) -> DataFrame:
    """norm, fetched, list, kind, key of the lists that hold a key of ``keyed`` (norm, fetched, hour, kind, key) at its time, by
    entries (entry_id, list, kind, pattern, action in add/remove, at)."""
    dated = (entries.where("pattern IS NOT NULL AND at IS NOT NULL AND kind IS NOT NULL")
             .select("list", "kind", F.col("pattern").alias("key"), _hour("at").alias("hour"), F.col("at").cast("timestamp").alias("at"),
                     "action"))
    # the entry that ends an hour; of those at one time the largest action counts
    ends = dated.groupBy("list", "kind", "key", "hour").agg(F.max(F.struct("at", "action")).alias("end"))
    lists = ends.where("end.at IS NOT NULL").select("list", "kind", "key").distinct()
    asked = keyed.select("kind", "key", "hour").distinct().join(lists, ["kind", "key"])
    hours = (ends.withColumn("asked", F.lit(False))
             .unionByName(asked.withColumn("asked", F.lit(True)), allowMissingColumns=True))
    before = Window.partitionBy("list", "kind", "key").orderBy("hour").rangeBetween(Window.unboundedPreceding, -1)
    held = (hours.withColumn("held", F.last("end", ignorenulls=True).over(before)).where("asked AND held.action = 'add'")
            .select("list", "kind", "key", "hour", F.col("held.action").alias("action")))
    found = keyed.join(lists, ["kind", "key"]).withColumn("at", F.col("fetched").cast("timestamp"))
    # what held before the hour comes first (no time), a capture after the entries of its time
    line = (dated.unionByName(held, allowMissingColumns=True).unionByName(found, allowMissingColumns=True))
    so_far = (Window.partitionBy("list", "kind", "key", "hour").orderBy("at", F.col("norm").isNotNull(), "action")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    added = F.when(F.col("norm").isNull(), F.coalesce(F.col("action") == "add", F.lit(False)))
    return (line.withColumn("added", F.last(added, ignorenulls=True).over(so_far)).where("added AND norm IS NOT NULL")
            .select("norm", "fetched", "list", "kind", "key"))


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """capture_id, url, fetched, blocked, n_active, decided_by (list:kind:pattern of the most specific
    active entry) for captures (capture_id, url, fetched)."""
    c = captures.select("capture_id", "url", "fetched", normal_url(F.col("url")).alias("norm"))
    asked = c.where("norm IS NOT NULL AND fetched IS NOT NULL").select("norm", "fetched").distinct()
    keyed = (asked.withColumn("hour", _hour("fetched"))
             .select("norm", "fetched", "hour", F.explode(F.array_distinct(_keys(F.col("norm")))).alias("k"))
             .select("norm", "fetched", "hour", "k.*"))
    hit = active(keyed, entries)
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(len(KINDS) - i)) for i, k in enumerate(KINDS)])
    # of equally specific entries an allow decides
    weight = F.struct(rank.alias("rank"), F.length("key").alias("length"), (F.col("list") == "allow").cast("int").alias("allow"),
                      F.concat_ws(":", "list", "kind", "key").alias("name"))
    verdict = (hit.groupBy("norm", "fetched")
               .agg(F.count(F.lit(1)).alias("n"), F.max(weight).alias("top"), F.max(F.col("list") == "block").alias("any")))
    verdict = verdict.select(F.col("norm").alias("__norm"), F.col("fetched").alias("__at"), "n", "top",
                             (F.col("any") & (F.col("top.allow") == 0)).alias("stop"))
    return (c.join(verdict, (c["norm"] == verdict["__norm"]) & (c["fetched"] == verdict["__at"]), "left")
            .select("capture_id", "url", "fetched", F.coalesce("stop", F.lit(False)).alias("blocked"),
                    F.coalesce("n", F.lit(0)).alias("n_active"), F.col("top.name").alias("decided_by")))
