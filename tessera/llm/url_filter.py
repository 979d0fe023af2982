"""URL filters by a temporal list join, in DataFrame operations only.

A list is dated entries: from ``at`` on, ``action`` (block, allow or lift) holds for a pattern, until
the pattern's next entry. So entries become validity intervals, and each capture is judged by the
list as it stood when it was fetched: an as-of join on the pattern, within the interval. A pattern is
a host or domain (and all hosts below it), or a host with the first segments of a path; of the
entries in force the longest pattern decides, and without any a capture is allowed.

A capture has as many keys as its host has labels and its path has segments, at most as deep as the
list's patterns. Keys meet patterns in an equi-join, whose skewed keys (a host or domain that a third
of all captures have) Spark splits, as both sides are plain shuffles of written tables. A pattern
with more than ``PLAIN`` entries is cut into time slots of about that many entries, and the join is
by (pattern, slot): a capture then meets the entries of one slot, however often its pattern changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch

PLAIN = 16
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[^/?#]*://[^/?#]*(/[^?#]*)"


def url_host(url: Column) -> Column:
    """The host in lower case, without a last dot; empty if the URL has none."""
    return F.regexp_replace(F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), HOST, 1), r"\.$", "")


def url_segments(url: Column) -> Column:
    """The non-empty path segments."""
    return F.filter(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1), "/"), lambda x: x != "")


def url_keys(host: Column, segments: Column, labels: Column, depth: Column) -> Column:
    """Domains of up to ``labels`` labels that the host lies in, and the host with each of its first
    1 .. ``depth`` path segments."""
    parts = F.split(host, r"\.")
    n = F.least(F.size(parts), labels)
    domains = F.when(host != "", F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat_ws(".", F.slice(parts, F.size(parts) - i + 1, i))))
    m = F.least(F.size(segments), depth)
    paths = F.when((host != "") & (m > 0), F.transform(
        F.sequence(F.lit(1), F.greatest(m, F.lit(1))), lambda i: F.concat(host, F.lit("/"), F.concat_ws("/", F.slice(segments, F.lit(1), i)))))
    return F.array_distinct(F.concat(F.coalesce(domains, F.array().cast("array<string>")), F.coalesce(paths, F.array().cast("array<string>"))))


def intervals(s: Scratch, entries: DataFrame) -> DataFrame:
    """``(pattern, action, valid_from, valid_to, n)`` from ``(pattern, at, entry_id, action)``:
    half-open intervals, ``valid_to`` null while the entry still holds; ``n`` entries per pattern.

    Of entries of one pattern and time the largest entry_id (then action) holds. Null patterns, times
    and actions are left out. The next entry is found per (pattern, month), and across months from
    each month's first entry, so a pattern with a third of all entries is not one task's.
    """
    month = 30 * 86400
    good = entries.filter("pattern is not null and at is not null and action is not null")
    once = good.groupBy("pattern", "at").agg(F.max_by("action", F.struct(F.coalesce("entry_id", F.lit("")), "action")).alias("action")).withColumn(
        "m", F.floor(F.col("at") / month))
    by_month = once.groupBy("pattern", "m").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy("pattern")
    months = s.keep(by_month.withColumn("next_first", F.lead("first").over(w.orderBy("m"))).withColumn("n", F.sum("k").over(w)).select("pattern", "m", "next_first", "n"))
    own = once.withColumn("next_own", F.lead("at").over(Window.partitionBy("pattern", "m").orderBy("at")))
    return own.join(months, ["pattern", "m"]).select(
        "pattern", "action", F.col("at").alias("valid_from"), F.coalesce("next_own", "next_first").alias("valid_to"), "n"
    )


def judge(spark, captures: DataFrame, entries: DataFrame, keep: tuple[str, ...] = ("page_id",), url: str = "url", at: str = "fetched_at") -> DataFrame:
    """``(*keep, host, fetched_at, blocked, pattern, action, valid_from, valid_to)`` per capture.

    Times are seconds (bigint). A null or malformed URL has host '' and no keys, a capture without a
    time meets no interval: both are allowed, with null pattern. Repeated captures are judged each;
    an empty list allows all; an empty capture table gives an empty result. Columns of ``captures``
    other than ``keep``, the URL and the time are not read.
    """
    s = Scratch(spark, "urls")
    c = s.keep(captures.select(*[F.col(k).alias(f"k_{k}") for k in keep], F.col(url).alias("url"), F.col(at).cast("bigint").alias("fetched_at"))
               .withColumn("cap", F.monotonically_increasing_id()))
    spans = s.keep(intervals(s, entries).filter("action <> 'lift'"))
    path = F.instr("pattern", "/") > 0
    most = spans.agg(
        F.max(F.when(~path, F.size(F.split("pattern", r"\.")))), F.max(F.when(path, F.size(F.split("pattern", "/")) - 1))
    ).first()
    keys = url_keys(F.col("host"), F.col("segments"), F.lit(most[0] or 0), F.lit(most[1] or 0))
    keyed = s.keep(
        c.select("cap", "fetched_at", url_host(F.col("url")).alias("host"), url_segments(F.col("url")).alias("segments"))
        .filter("fetched_at is not null").select("cap", "fetched_at", F.explode(keys).alias("pattern"))
    )
    within = (F.col("fetched_at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    hits = keyed.join(spans.filter(F.col("n") <= PLAIN).drop("n"), "pattern").filter(within)
    busy = spans.filter(F.col("n") > PLAIN)
    if not busy.isEmpty():
        # slots of a busy pattern: equal parts of the time from its first to its last entry
        slots = s.keep(busy.groupBy("pattern").agg(
            F.min("valid_from").alias("t0"),
            (F.floor((F.max("valid_from") - F.min("valid_from")) * PLAIN / F.first("n")) + 1).cast("bigint").alias("width"),
            F.max("valid_from").alias("t1"),
        ))
        slot = lambda t: F.floor((F.least(t, F.col("t1")) - F.col("t0")) / F.col("width")).cast("bigint")
        placed = s.keep(busy.drop("n").join(slots, "pattern").withColumn(
            "slot", F.explode(F.sequence(slot(F.col("valid_from")), slot(F.coalesce(F.col("valid_to"), F.col("t1")))))
        ).drop("t0", "t1", "width"))
        asked = s.keep(keyed.join(slots, "pattern").filter("fetched_at >= t0").withColumn("slot", slot(F.col("fetched_at"))).drop("t0", "t1", "width"))
        hits = hits.unionByName(asked.join(placed, ["pattern", "slot"]).filter(within).drop("slot"))
    rule = F.struct(F.length("pattern").alias("len"), "pattern", "action", "valid_from", "valid_to")
    best = hits.groupBy("cap").agg(F.max_by(rule, F.length("pattern")).alias("r"))
    out = c.join(best, "cap", "left")
    return out.select(
        *[F.col(f"k_{k}").alias(k) for k in keep], url_host(F.col("url")).alias("host"), "fetched_at",
        F.coalesce(F.col("r.action") == "block", F.lit(False)).alias("blocked"),
        *[F.col(f"r.{x}").alias(x) for x in ("pattern", "action", "valid_from", "valid_to")],
    )


# ---- a dated list and fetch times, derived from the pages ----------------------------------------

START, SPAN = 1704067200, 2 * 365 * 86400  # 2024 and 2025
BAD_WORDS = "casino|pills|bets"


def digits(*parts) -> Column:
    """32 bits of the MD5 of the parts."""
    text = F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def fetched_pages(pages: DataFrame) -> DataFrame:
    """Pages as captures, fetched at a time that the id decides."""
    return pages.select("page_id", "url", (F.lit(START) + digits("fetch:", F.col("page_id")) % SPAN).alias("fetched_at"))


def dated_list(pages: DataFrame) -> DataFrame:
    """``(pattern, at, entry_id, action)``: entries on a third of the hosts, half of the domains and
    an eighth of the pages' paths, at times that digests decide, and from the start on all hosts
    named by a bad word. The list grows with the pages."""
    host = url_host(F.col("url"))
    seg = url_segments(F.col("url"))
    pages = pages.select("url", host.alias("host"), seg.alias("seg")).filter("host <> ''")
    parts = F.split("host", r"\.")
    hosts = pages.select(F.col("host").alias("pattern")).distinct()
    domains = pages.filter(F.size(parts) > 2).select(F.concat_ws(".", F.slice(parts, F.size(parts) - 1, 2)).alias("pattern")).distinct()
    paths = pages.filter(F.size("seg") > 0).filter(digits("path:", F.col("url")) % 8 == 0).select(
        F.concat("host", F.lit("/"), F.concat_ws("/", "seg")).alias("pattern")).distinct()
    actions = F.array(*[F.lit(x) for x in ("block", "lift", "allow", "block", "lift")])

    def entries(rows: DataFrame, most: int) -> DataFrame:
        rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        at = F.lit(START) + digits("at:", F.col("k"), ":", F.col("pattern")) % SPAN
        return rows.select("pattern", at.alias("at"), F.col("k").cast("string").alias("entry_id"), F.element_at(actions, F.col("k") + 1).alias("action"))

    bad = hosts.filter(F.col("pattern").rlike(BAD_WORDS)).select(
        "pattern", F.lit(START).cast("bigint").alias("at"), F.lit("bad").alias("entry_id"), F.lit("block").alias("action"))
    return (
        entries(hosts.filter(digits("host:", F.col("pattern")) % 3 == 0), 5)
        .unionByName(entries(domains.filter(digits("domain:", F.col("pattern")) % 2 == 0), 3))
        .unionByName(entries(paths, 2)).unionByName(bad)
    )
