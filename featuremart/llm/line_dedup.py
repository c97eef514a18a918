"""Line dedup by site-relative frequency, with built-in expressions only.

Per host the share of pages that contain a line is the line's frequency; lines
above the boilerplate ratio are dropped from the host's pages. A line is
compared without blanks at its ends, as a 63-bit hash of its text and its length class.

Distinct line hashes are counted per host with partial sums before the shuffle,
so a host with a third of all pages or a line on all pages costs each task one
row. At most (lines per page / ratio) lines of a host can exceed the ratio; they
travel as one array per host. The table of these arrays is sent to all tasks
only if it is small, and otherwise joined by a shuffle in which adaptive
execution splits large hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import checkpointed, fresh

#: Hashes of boilerplate lines that are sent to every task (8 bytes each).
HASHES_SENT = 500_000
#: Characters from which a line counts as long.
LONG = 40


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without port; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\x0b\f\r"))


def _hash(line: Column) -> Column:
    """Hash of a line; its last bit tells whether the line is long."""
    bare = _trimmed(line)
    return F.shiftleft(F.shiftright(F.xxhash64(bare), 1), 1).bitwiseOR((F.length(bare) >= LONG).cast("bigint"))


def drop_boilerplate(
    pages: DataFrame, host: Column, text: str = "text", ratio: float = 0.1, min_pages: int = 20, long_ratio: float | None = None, long_pages: int = 1
) -> DataFrame:
    """``pages`` with boilerplate lines removed from ``text``, plus ``n_lines`` and ``n_dropped``.

    A line is dropped if more than ``ratio`` of its host's pages hold it and the
    host has at least ``min_pages`` pages (on a handful of pages a frequency says
    nothing). A line of ``LONG`` characters or more hardly recurs by chance: for it
    the ratio is ``long_ratio`` (by default the same), and at least ``long_pages`` pages must hold it. Repeats within a page count once. Lines without a word are kept and not
    counted. Null hosts form one host; a null text stays null with no lines; a
    page whose lines all go keeps its row with an empty text. Columns already
    named ``n_lines`` or ``n_dropped`` are replaced.
    """
    site, bad, hits = fresh(pages, "site", "bad", "hits")
    pages = pages.drop("n_lines", "n_dropped")
    split = F.split(F.col(text), "\n")
    hashes = F.filter(F.transform(split, lambda x: F.when(_trimmed(x) != "", _hash(x))), lambda h: h.isNotNull())
    long = F.col("line").bitwiseAND(F.lit(1)) == 1
    share = F.when(long, ratio if long_ratio is None else long_ratio).otherwise(ratio)
    least = F.when(long, long_pages).otherwise(1)
    site_col = F.coalesce(F.concat(F.lit("="), host), F.lit("~"))
    seen = pages.select(site_col.alias("site"), F.explode(F.array_distinct(hashes)).alias("line")).groupBy("site", "line").count().where((F.col("count") >= min_pages * share) & (F.col("count") >= least))
    sizes = pages.select(site_col.alias("site")).groupBy("site").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    often = seen.join(sizes, "site").where(F.col("count") > F.col("pages") * share)
    per_site = checkpointed(often.groupBy("site").agg(F.collect_list("line").alias("bad")))
    size = per_site.agg(F.sum(F.size("bad"))).first()[0] or 0
    found = per_site.select(F.col("site").alias(site), F.col("bad").alias(bad))
    found = F.broadcast(found) if size <= HASHES_SENT else found
    joined = pages.withColumn(site, site_col).join(found, site, "left")

    # most pages have few of the host's lines: those are looked up per line, not the host's whole list
    own = F.when(F.col(bad).isNotNull(), F.array_intersect(hashes, F.col(bad)))
    flagged = joined.withColumn(hits, own).withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size(hashes)).cast("bigint"))
    some = F.size(hits) > 0  # null or -1 where nothing matched
    gone = lambda x: F.array_contains(F.col(hits), _hash(x)) & (_trimmed(x) != "")
    kept = F.when(some, F.filter(split, lambda x: ~gone(x)))
    flagged = flagged.withColumn("n_dropped", F.when(some, F.size(F.filter(split, gone))).otherwise(0).cast("bigint"))
    return flagged.withColumn(text, F.when(some, F.concat_ws("\n", kept)).otherwise(F.col(text))).drop(site, bad, hits)
