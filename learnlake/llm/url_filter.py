"""URL filtering against lists that change over time.

A list is a log of dated entries: a day on which a value (a domain, a host, or a host with the start of a path) is added
to a list or removed from it. Entries become validity intervals, and an as-of join holds every capture against the
entries that were active on the day it was fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlake.llm.common import fresh, written

KINDS = ("domain", "host", "prefix")
BLOCK, ALLOW = "block", "allow"


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    return F.nullif(F.rtrim(host, F.lit(".")), F.lit(""))


def url_path(url: Column) -> Column:
    """Segments of the path that are not empty."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.array_remove(F.split(path, "/"), "")


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, value, valid_from, valid_to) from a log (list, kind, value, dated, added boolean).

    An entry is active from the day it is added until the day it is removed, that day excluded; ``valid_to`` is null
    while it still is. Repeated entries change nothing, and on a day that has both, the removal counts. Rows without a
    value or a day are ignored. Only the history of one value is ordered at a time.
    """
    known = entries.where("list is not null and kind is not null and value is not null and dated is not null")
    daily = known.groupBy("list", "kind", "value", "dated").agg(F.min(F.coalesce("added", F.lit(False))).alias("added"))
    history = Window.partitionBy("list", "kind", "value").orderBy("dated")
    changes = daily.withColumn("before", F.lag("added").over(history)).where(
        (F.col("before").isNull() & F.col("added")) | (F.col("before") != F.col("added")))
    return changes.withColumn("valid_to", F.lead("dated").over(history)).where("added").select(
        "list", "kind", "value", F.col("dated").alias("valid_from"), "valid_to")


def url_keys(url: Column, depth: int) -> Column:
    """What lists may say about a URL: (kind, value) of its host, every domain it lies in, and up to ``depth`` starts of its path."""
    host, path = url_host(url), url_path(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("value")))
    exact = F.array(F.struct(F.lit("host").alias("kind"), host.alias("value")))
    starts = F.transform(
        F.filter(F.sequence(F.lit(1), F.lit(max(depth, 1))), lambda i: i <= F.least(F.size(path), F.lit(depth))),
        lambda i: F.struct(F.lit("prefix").alias("kind"), F.concat(
            host, F.lit("/"), F.array_join(F.slice(path, F.lit(1), i), "/")).alias("value")))
    return F.when(host.isNotNull(), F.concat(domains, exact, starts))


def evaluate(captures: DataFrame, entries: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, n_active, n_block, n_allow, blocked of every capture (url, fetched date).

    A capture is blocked if an entry of a block list was active on the day it was fetched and none of an allow list.
    Captures without a host or a day match nothing and are not blocked; repeated ones are judged each.

    Distinct (url, day) pairs are judged once, so a page fetched again and again costs one row; list history is written
    first, and Spark broadcasts it or not by its size. A very common host only repeats a key of the history side, which
    a skewed join splits.
    """
    active = written(intervals(entries), "list-intervals")
    longest = active.where("kind = 'prefix'").agg(F.max(F.size(F.split("value", "/")) - 1)).first()[0] or 0
    judged = captures.select("url", "fetched").where("url is not null and fetched is not null").distinct()
    asked = judged.select("url", "fetched", F.inline(url_keys(F.col("url"), longest)))
    during = (F.col("fetched") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    hits = asked.join(active, ["kind", "value"]).where(during)
    found = hits.groupBy("url", "fetched").agg(
        F.count("*").alias("n_active"), F.count_if(F.col("list") == BLOCK).alias("n_block"),
        F.count_if(F.col("list") == ALLOW).alias("n_allow"))
    url, fetched, a, b, c = fresh(captures, "hit_url", "hit_fetched", "n_active", "n_block", "n_allow")
    found = found.toDF(url, fetched, a, b, c)
    rows = captures.join(found, (captures["url"] == found[url]) & (captures["fetched"] == found[fetched]), "left")
    counts = {n: F.coalesce(F.col(x), F.lit(0)) for n, x in (("n_active", a), ("n_block", b), ("n_allow", c))}
    return rows.select(
        *keys, *[v.alias(n) for n, v in counts.items()],
        ((counts["n_block"] > 0) & (counts["n_allow"] == 0)).alias("blocked"))


def _code(text: Column) -> Column:
    """A whole number from a text: 28 bits of its MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long")


def fetch_day(page_id: Column) -> Column:
    """The day a page of the tables counts as fetched: a hash of its id picks one of 2024."""
    return F.date_add(F.lit("2024-01-01").cast("date"), (_code(page_id.cast("string")) % 366).cast("int"))


def entries_from_pages(pages: DataFrame) -> DataFrame:
    """A log of list entries about the hosts of ``pages``, derived from them by hashes.

    A third of all hosts gets on the block list, by host, domain or the start of a path, and half of these off it
    later; a ninth gets on the allow list. The tables hold no list of their own.
    """
    hosts = pages.select(url_host(F.col("url")).alias("host")).where("host is not null").distinct()
    code = _code(F.col("host"))
    day = lambda c: F.date_add(F.lit("2024-01-01").cast("date"), c.cast("int"))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.floor(code / 9) % 3 + 1).cast("int"))
    value = F.when(kind == "prefix", F.concat("host", F.lit("/en"))).otherwise(F.col("host"))
    row = lambda name, dated, added, when: F.when(when, F.struct(
        F.lit(name).alias("list"), kind.alias("kind"), value.alias("value"), dated.alias("dated"), F.lit(added).alias("added")))
    start = F.floor(code / 27) % 200
    log = F.array(
        row(BLOCK, day(start), True, code % 3 == 0),
        row(BLOCK, day(start + 40 + F.floor(code / 7) % 90), False, code % 6 == 0),
        row(ALLOW, day(F.floor(code / 11) % 366), True, code % 9 == 3))
    return hosts.select(F.inline(F.array_compact(log)))


def filter_pages(pages: DataFrame) -> DataFrame:
    """page_id, fetched, n_active, n_block, n_allow, blocked of every page."""
    captures = pages.select("page_id", "url", fetch_day(F.col("page_id")).alias("fetched"))
    return evaluate(captures, entries_from_pages(pages), ["page_id", "fetched"])


SQL = r"""
WITH pages_ AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(fetch_code % 366 AS INTEGER) AS fetched,
    nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.'), '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/+([^/?#]+)', 1) AS segment
  FROM (SELECT *, CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 7) AS BIGINT) AS fetch_code FROM pages)
), hosts AS (
  SELECT host, CAST('0x' || substr(md5(host), 1, 7) AS BIGINT) AS code FROM (SELECT DISTINCT host FROM pages_ WHERE host IS NOT NULL)
), kinds AS (
  SELECT host, code, ['domain', 'host', 'prefix'][1 + (code // 9) % 3] AS kind FROM hosts
), vals AS (
  SELECT *, CASE WHEN kind = 'prefix' THEN host || '/en' ELSE host END AS value FROM kinds
), entries AS (
  SELECT 'block' AS list, kind, value, DATE '2024-01-01' + CAST((code // 27) % 200 AS INTEGER) AS valid_from,
    CASE WHEN code % 6 = 0 THEN DATE '2024-01-01' + CAST((code // 27) % 200 + 40 + (code // 7) % 90 AS INTEGER) END AS valid_to
  FROM vals WHERE code % 3 = 0
  UNION ALL
  SELECT 'allow', kind, value, DATE '2024-01-01' + CAST((code // 11) % 366 AS INTEGER), NULL FROM vals WHERE code % 9 = 3
), keys AS (
  SELECT page_id, url, fetched, 'host' AS kind, host AS value FROM pages_ WHERE host IS NOT NULL
  UNION ALL
  SELECT page_id, url, fetched, 'domain', array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.')
  FROM (SELECT *, unnest(generate_series(1, len(string_split(host, '.')))) AS i FROM pages_ WHERE host IS NOT NULL)
  UNION ALL
  SELECT page_id, url, fetched, 'prefix', host || '/' || segment FROM pages_ WHERE host IS NOT NULL AND segment <> ''
), hits AS (
  SELECT page_id, url, fetched, count(*) AS n_active, count(*) FILTER (WHERE list = 'block') AS n_block,
    count(*) FILTER (WHERE list = 'allow') AS n_allow
  FROM keys JOIN entries USING (kind, value) WHERE fetched >= valid_from AND (valid_to IS NULL OR fetched < valid_to)
  GROUP BY ALL
)
SELECT p.page_id, p.fetched, coalesce(n_active, 0) AS n_active, coalesce(n_block, 0) AS n_block,
  coalesce(n_allow, 0) AS n_allow, coalesce(n_block > 0 AND n_allow = 0, false) AS blocked
FROM pages_ p LEFT JOIN hits h ON p.page_id = h.page_id AND p.url = h.url AND p.fetched = h.fetched
"""
