"""Boilerplate lines of web pages by their frequency within a site.

A page's lines are the text between block elements of its html. For each host, the pages that
contain a line are divided by the pages of the host; lines over a ratio, on at least a few pages, are
dropped from all pages of that host.

Everything is a DataFrame expression. Each page counts a line once, which needs no shuffle as its
lines are an array; (host, line) counts are combined per task before they are shuffled, as 64-bit
hashes; so a host or a line on a third of all pages is one row per task. A host has at most
``mean lines of a page / ratio`` boilerplate lines, so these are kept as one array per host; pages
are joined with that array and filter their own lines. Texts are never shuffled unless the hosts with
boilerplate are too many to be sent to every executor, which is checked.

Defined results: null and empty html have no line and an empty text; a null or malformed url has the
empty host, whose pages are not a site and keep all lines; every input row is a page, repeated ids
and null ids included; a ratio equal to the bound does not exceed it; an empty table gives no rows.
Other columns of the input are neither read nor required.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.storage import stage

RATIO = 0.3
LEAST_PAGES = 3
# Most hosts with boilerplate that are sent to every executor.
BROADCAST_HOSTS = 200_000

# The elements that begin a new line, and what is no text.
BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    "h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|"
    "title|tr|ul"
)
NO_TEXT = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!doctype[^>]*>"
BLOCK_TAG = rf"(?i)</?(?:{BLOCKS})\b[^>]*>"
OTHER_TAG = r"</?[A-Za-z][^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
SPACE = r"[\x20\x09\x0B-\x0D]+"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def lines_of(html: Column) -> Column:
    """The non-empty lines of a page in order, with single spaces."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), NO_TEXT, "")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK_TAG, "\n"), OTHER_TAG, "")
    text = F.regexp_replace(text, SPACE, " ")
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda line: line != "")


def boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, boiler): the hashes of the boilerplate lines of every host that has any."""
    of_page = pages.select(host_of(F.col("url")).alias("host"), lines_of(F.col("html")).alias("lines"))
    of_page = of_page.where("host <> ''")
    # The empty line stands for the page itself: its count is the number of pages of the host.
    marks = F.array_distinct(F.concat("lines", F.array(F.lit(""))))
    counts = (
        of_page.select("host", F.explode(marks).alias("line"))
        .select("host", F.xxhash64("line").alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least_pages)
    )
    counts = stage(counts, "site-lines")
    whole = F.xxhash64(F.lit(""))
    totals = counts.where(F.col("line") == whole).select("host", F.col("n").alias("pages"))
    return (
        counts.where(F.col("line") != whole)
        .join(totals, "host")
        .where(F.col("n") > F.lit(ratio) * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list("line").alias("boiler"))
    )


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(page_id, host, n_lines, n_dropped, text) of every page: its lines, how many of them are
    boilerplate of the host, and the others joined by line breaks."""
    boiler = stage(boilerplate(pages, ratio, least_pages), "boilerplate")
    if boiler.count() <= BROADCAST_HOSTS:
        boiler = F.broadcast(boiler)
    of_page = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), lines_of(F.col("html")).alias("lines")
    ).join(boiler, "host", "left")
    kept = F.when(F.col("boiler").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda line: ~F.array_contains("boiler", F.xxhash64(line)))
    )
    return of_page.withColumn("kept", kept).select(
        "page_id",
        "host",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("bigint").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"),
    )


def sql(ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> str:
    """The same question for DuckDB, on whole lines."""
    return rf"""
        WITH page AS (
            SELECT row_number() OVER () AS r, page_id,
                   lower(regexp_extract(coalesce(url, ''), '{HOST}', 1)) AS host,
                   regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
                       '{NO_TEXT}', '', 'g'), '{BLOCK_TAG}', chr(10), 'g'), '{OTHER_TAG}', '', 'g'),
                       '{SPACE}', ' ', 'g') AS plain
            FROM pages
        ), listed AS (
            SELECT r, page_id, host,
                   list_filter(list_transform(string_split(plain, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS lines
            FROM page
        ), line AS (
            SELECT r, host, unnest(list_distinct(lines)) AS line FROM listed WHERE host <> ''
        ), total AS (
            SELECT host, count(*) AS pages FROM listed WHERE host <> '' GROUP BY host
        ), boiler AS (
            SELECT host, list(line) AS boiler
            FROM (SELECT host, line, count(*) AS n FROM line GROUP BY host, line) JOIN total USING (host)
            WHERE n >= {least_pages} AND n > {ratio}::DOUBLE * pages
            GROUP BY host
        ), kept AS (
            SELECT page_id, host, lines,
                   list_filter(lines, lambda x: NOT list_contains(coalesce(boiler, []), x)) AS kept
            FROM listed LEFT JOIN boiler USING (host)
        )
        SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped,
               array_to_string(kept, chr(10)) AS text
        FROM kept
    """
