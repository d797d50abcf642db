"""URL filters: dated list entries as validity intervals, joined as of the fetch.

A list log has (list, key, action, at): `add` or `remove` of a host, a domain or a
URL path on a named list.  The log becomes intervals during which a key was
listed.  A capture looks its keys up (its host, every parent domain, its host with
every leading path) and meets the entries active at its fetch time: those with
valid_from <= fetched_at < valid_to.

Both sides meet on (key, period), a period being a fixed stretch of time, so a
domain with a third of all captures is spread over the periods it was fetched in,
and adaptive execution may split what is left.  An interval is repeated once per
period it touches; intervals of one list and key do not overlap, so this adds at
most one row per key and period.  Intervals are chained by two levels, within a
period and between periods, so no key's whole history is sorted in one task.

Defined results: among entries of one list, key and time the last by action name
holds (`remove`); entries without list, key or time are ignored, as are repeats;
a null or unparsable URL has no host and no keys, and is allowed; a capture
without a fetch time meets no entry; hosts are compared in lower case without
port; repeated captures are returned as often as they come; empty tables give no
rows; columns of captures beyond those named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinfold.session import materialize

PERIOD_DAYS = 30
ADD, REMOVE = "add", "remove"


def host_of(url: Column) -> Column:
    """Host in lower case without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.rtrim(host, F.lit(".")), F.lit(""))


def path_of(url: Column) -> Column:
    """Path without query, `` if there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def keys_of(url: Column) -> Column:
    """The host, its parent domains, and the host with each leading path; as many as labels and path parts."""
    host, parts = host_of(url), F.filter(F.split(path_of(url), "/"), lambda p: p != "")
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.when(F.size(parts) > 0, F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat_ws("/", host, F.array_join(F.slice(parts, F.lit(1), i), "/"))))
    return F.when(host.isNull(), F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(domains, F.coalesce(paths, F.array().cast("array<string>")))))


def period_of(at: Column) -> Column:
    return F.floor(F.unix_seconds(at) / (PERIOD_DAYS * 86400)).cast("int")


def intervals(log: DataFrame) -> DataFrame:
    """(list, key, valid_from, valid_to) of each stretch that a key was listed; valid_to is null while it still is."""
    dated = (log.filter("list IS NOT NULL AND key IS NOT NULL AND at IS NOT NULL").groupBy("list", "key", "at")
             .agg(F.max("action").alias("action")).withColumn("period", period_of(F.col("at"))))
    inside = Window.partitionBy("list", "key", "period").orderBy("at")
    periods = dated.groupBy("list", "key", "period").agg(F.min("at").alias("first_at"))
    later = periods.withColumn("next_at", F.lead("first_at").over(Window.partitionBy("list", "key").orderBy("period"))).drop("first_at")
    chained = (dated.withColumn("lead_at", F.lead("at").over(inside)).join(later, ["list", "key", "period"])
               .withColumn("valid_to", F.coalesce("lead_at", "next_at")))
    return chained.filter(F.col("action") == ADD).select("list", "key", F.col("at").alias("valid_from"), "valid_to")


def active_entries(captures: DataFrame, log: DataFrame) -> DataFrame:
    """(capture, url, fetched_at, list, key, valid_from) of every entry active when a capture was fetched.

    `captures` has (capture, url, fetched_at); one id may have several urls and times, each is a capture of its own.
    """
    spans = materialize(intervals(log), "url-intervals")
    last = captures.agg(F.max("fetched_at").alias("t")).first()["t"]
    horizon = period_of(F.coalesce(F.col("valid_to"), F.greatest(F.col("valid_from"), F.lit(last))))
    listed = (spans.withColumn("period", F.explode(F.sequence(period_of(F.col("valid_from")), horizon)))
              .withColumnRenamed("key", "listed_key").withColumnRenamed("period", "listed_period"))
    asked = (captures.filter("fetched_at IS NOT NULL").withColumn("period", period_of(F.col("fetched_at")))
             .select("capture", "url", "fetched_at", "period", F.explode(keys_of(F.col("url"))).alias("key")))
    same = (F.col("key") == F.col("listed_key")) & (F.col("period") == F.col("listed_period"))
    active = (F.col("valid_from") <= F.col("fetched_at")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    return asked.join(listed, same & active).select("capture", "url", "fetched_at", "list", "key", "valid_from")


def verdicts(captures: DataFrame, log: DataFrame) -> DataFrame:
    """Per capture (id, url and time): host, whether it is allowed, how many entries were active, and the longest-listed of them."""
    named = materialize(captures.select("capture", "url", "fetched_at"), "url-captures")
    hits = active_entries(named.distinct(), log).groupBy(*[F.col(c).alias(f"hit_{c}") for c in named.columns]).agg(
        F.count("*").alias("n_active"), F.min(F.struct("valid_from", "list", "key")).alias("oldest"))
    same = [F.col(c).eqNullSafe(F.col(f"hit_{c}")) for c in named.columns]
    return (named.join(hits, same, "left")
            .select("capture", host_of(F.col("url")).alias("host"), F.col("oldest").isNull().alias("allowed"),
                    F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), F.col("oldest.list").alias("list"),
                    F.col("oldest.key").alias("listed_key"), F.col("oldest.valid_from").alias("listed_since")))


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages as captures: one an hour in order of page_id."""
    return pages.select(F.col("page_id").alias("capture"), "url", F.timestamp_seconds(1704067200 + 3600 * F.col("page_id")).alias("fetched_at"))


def page_log(pages: DataFrame) -> DataFrame:
    """A list log from the pages themselves.

    When a page with symbol junk is fetched, its host goes on the list `junk` and its
    first path part on `section`; both leave it when a page there is fetched without.
    Pages with a reference parameter put the domain above the host on `tracking`.
    """
    seen = pages.select(host_of(F.col("url")).alias("host"), F.split(path_of(F.col("url")), "/").alias("parts"), "url",
                        F.timestamp_seconds(1704067200 + 3600 * F.col("page_id")).alias("at"),
                        F.contains("html", F.lit("%%%")).alias("junk"))
    action = F.when(F.col("junk"), ADD).otherwise(REMOVE)
    section = F.when(F.coalesce(F.try_element_at("parts", F.lit(2)), F.lit("")) != "",
                     F.concat_ws("/", "host", F.try_element_at("parts", F.lit(2))))
    tracked = F.when(F.contains("url", F.lit("ref=")), ADD).otherwise(REMOVE)
    rows = F.array(F.struct(F.lit("junk").alias("list"), F.col("host").alias("key"), action.alias("action")),
                   F.struct(F.lit("section").alias("list"), section.alias("key"), action.alias("action")),
                   F.struct(F.lit("tracking").alias("list"), F.nullif(F.regexp_extract("host", r"^[^.]+\.(.+)$", 1), F.lit("")).alias("key"),
                            tracked.alias("action")))
    return seen.filter("host IS NOT NULL").select("at", F.inline(rows))


def report(pages: DataFrame) -> DataFrame:
    judged = verdicts(page_captures(pages), page_log(pages)).withColumnRenamed("capture", "page_id")
    return judged.withColumn("listed_since", F.date_format("listed_since", "yyyy-MM-dd HH:mm:ss"))
