"""URL filters by dated lists, in Spark's own functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Captures and intervals meet in stretches of so many days.
STRETCH_DAYS = 32


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null if there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    found = F.regexp_replace(F.regexp_replace(found, r"^.*@", ""), r"\.?(:[0-9]*)?$", "")
    return F.when(found != "", found)


def _parts(path: Column) -> Column:
    return F.filter(F.split(path, "/", -1), lambda x: x != "")


def _keys(url: Column, host: Column, deepest: Column) -> Column:
    """All entry names that would cover a URL: its domains, and its host with leading path parts.

    Names are in lower case, as entries are. No entry has more than ``deepest`` path parts.
    """
    labels = F.split(host, r"\.", -1)
    parts = _parts(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)))
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    depth = F.least(F.size(parts), deepest)
    prefixes = F.when(
        depth > 0,
        F.transform(F.sequence(F.lit(1), depth), lambda i: F.concat_ws("/", host, F.array_join(F.slice(parts, 1, i), "/"))),
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(domains, prefixes))


def intervals(events: DataFrame) -> DataFrame:
    """``entry``, ``since``, ``until``: when each entry is on the list.

    ``events`` has ``entry`` (a domain, or a host and leading path parts), ``at`` (a date) and
    ``listed`` (true when it is added, false when it is removed). An event holds from its
    day to the day before the next one of its entry; the last has no end. Of several
    on one day, a removal wins. Events without an entry, day or action say nothing.
    """
    rows = events.where(F.col("entry").isNotNull() & F.col("at").isNotNull() & F.col("listed").isNotNull())
    daily = rows.groupBy(F.lower("entry").alias("entry"), F.col("at").cast("date").alias("at")).agg(
        F.min(F.col("listed").cast("int")).alias("listed")
    )
    following = F.lead("at").over(Window.partitionBy("entry").orderBy("at"))
    return daily.select("entry", F.col("at").alias("since"), following.alias("until"), "listed").where("listed = 1").drop("listed")


def _stretch(day: Column) -> Column:
    return F.floor(F.unix_date(day) / STRETCH_DAYS).cast("int")


def as_of(captures: DataFrame, events: DataFrame) -> DataFrame:
    """``captures`` with ``host``, ``n_active``, ``entry``, ``blocked`` at the day of each fetch.

    ``captures`` has ``page_id``, ``url`` and ``fetched`` (a date). ``n_active`` counts the entries
    that cover the URL and were listed that day, ``entry`` is the first of them by
    name. Entries may have any number of path parts; case makes no difference in host
    or path. A capture without a host or day meets none. Repeated rows are looked up once
    and come back each. The join key is the entry and a stretch of days, so a host with a
    third of all captures is spread over the stretches before Spark splits what is
    still large; each URL and day is looked up once, however often it was captured.
    """
    rows = captures.select("page_id", "url", F.col("fetched").cast("date").alias("fetched"))
    asked = rows.where("url is not null and fetched is not null").select("url", "fetched").distinct()
    asked = asked.withColumn("host", host_of(F.col("url"))).where("host is not null")
    deepest = events.agg(F.coalesce(F.max(F.size(_parts(F.col("entry"))) - 1), F.lit(0)).alias("deepest"))
    keyed = asked.crossJoin(F.broadcast(deepest)).select(
        "url", "fetched", _stretch(F.col("fetched")).alias("stretch"),
        F.explode(_keys(F.col("url"), F.col("host"), F.col("deepest"))).alias("entry"),
    )
    last = asked.agg(F.max("fetched").alias("last"))
    spans = intervals(events).crossJoin(F.broadcast(last)).where(F.col("since") <= F.col("last"))
    dealt = spans.select(
        "entry", "since", "until",
        F.explode(
            F.sequence(
                _stretch(F.col("since")),
                F.greatest(
                    _stretch(F.least(F.coalesce(F.date_sub("until", 1), F.col("last")), F.col("last"))), _stretch(F.col("since"))
                ),
            )
        ).alias("stretch"),
    )
    active = keyed.join(dealt, ["entry", "stretch"]).where(
        (F.col("since") <= F.col("fetched")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until")))
    )
    hits = active.groupBy("url", "fetched").agg(F.count("*").alias("n_active"), F.min("entry").alias("entry"))
    return rows.join(hits, ["url", "fetched"], "left").select(
        "page_id", "url", "fetched", host_of(F.col("url")).alias("host"),
        F.coalesce("n_active", F.lit(0).cast("bigint")).alias("n_active"), "entry",
        F.col("n_active").isNotNull().alias("blocked"),
    )


# ------------------------------------------------- a dated list and fetch days for the given pages

def fetch_days(pages: DataFrame) -> DataFrame:
    """The table of pages has no fetch day; one of 360 days of 2024 follows from the id."""
    return pages.select(
        "page_id", "url",
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(360)).cast("int")).alias("fetched"),
    )


def derived_events(pages: DataFrame) -> DataFrame:
    """A list history made from the hosts of ``pages``: domains and host sections come and go.

    The digest of a name says whether it is ever listed, when, and for how long.
    """
    hosts = pages.select(host_of(F.col("url")).alias("host"), "url").where("host is not null")
    section = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)
    names = (
        hosts.select("host", section.alias("section")).distinct()
        .select(F.explode(F.array("host", F.when(F.col("section") != "", F.concat_ws("/", "host", F.lower("section"))))).alias("entry"))
        .where("entry is not null").distinct()
    )
    digest = F.conv(F.substring(F.md5("entry"), 1, 7), 16, 10).cast("int")
    rows = names.withColumn("h", digest).where(F.pmod("h", F.lit(4)) < 2)
    start = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("h", F.lit(200)))
    return rows.select(
        "entry",
        F.explode(
            F.array(
                F.struct(start.alias("at"), F.lit(True).alias("listed")),
                F.struct(F.date_add(start, F.pmod("h", F.lit(90)) + 10).alias("at"), F.lit(False).alias("listed")),
                F.struct(F.date_add(start, F.pmod("h", F.lit(90)) + 60).alias("at"), F.lit(True).alias("listed")),
            )
        ).alias("e"),
    ).select("entry", "e.at", "e.listed")


SQL = r"""
WITH p AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST((page_id * 37) % 360 AS INTEGER) AS DATE) AS fetched,
    nullif(regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', ''), '\.?(:[0-9]*)?$', ''), '') AS host,
    list_filter(string_split(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)), '/'), lambda x: x <> '') AS parts,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS section
  FROM pages
), names AS (
  SELECT host AS entry FROM p WHERE host IS NOT NULL
  UNION SELECT host || '/' || lower(section) FROM p WHERE host IS NOT NULL AND section <> ''
), hashed AS (
  SELECT entry, CAST('0x' || substr(md5(entry), 1, 7) AS INTEGER) AS h FROM names
), events AS (
  SELECT entry, CAST(DATE '2024-01-01' + h % 200 + k.days * (h % 90) + k.more AS DATE) AS dated, k.listed
  FROM hashed, (VALUES (0, 0, 1), (1, 10, 0), (1, 60, 1)) AS k(days, more, listed) WHERE h % 4 < 2
), daily AS (
  SELECT entry, dated, min(listed) AS listed FROM events GROUP BY entry, dated
), spans AS (
  SELECT * FROM (SELECT entry, dated AS since, lead(dated) OVER (PARTITION BY entry ORDER BY dated) AS until, listed FROM daily) WHERE listed = 1
), labels AS (
  SELECT page_id, url, fetched, host, string_split(host, '.') AS l, parts FROM p WHERE host IS NOT NULL
), keyed AS (
  SELECT page_id, url, fetched, array_to_string(l[i:], '.') AS entry FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM labels)
  UNION SELECT page_id, url, fetched, host || '/' || array_to_string(parts[1:i], '/')
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM labels)
), hits AS (
  SELECT page_id, count(*) AS n_active, min(k.entry) AS entry
  FROM keyed k JOIN spans s ON k.entry = s.entry AND s.since <= k.fetched AND (s.until IS NULL OR k.fetched < s.until)
  GROUP BY page_id
)
SELECT p.page_id, url, CAST(fetched AS VARCHAR) AS fetched, host, CAST(coalesce(n_active, 0) AS BIGINT) AS n_active, entry, n_active IS NOT NULL AS blocked
FROM p LEFT JOIN hits ON p.page_id = hits.page_id
"""
