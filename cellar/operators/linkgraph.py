"""The link graph of stored pages: who is linked, how often, and is it stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.functions import htmlscan
from cellar.functions.keys import host_rev
from cellar.operators.joins import salted_join


def inlinks(pages: DataFrame, stored: DataFrame, md5: bool = False) -> DataFrame:
    """One row per linked row key: target_key, host_rev, n_links, n_pages, stored, host_pages.

    ``pages``: row_key, url, page (text); ``stored``: row_key, url of the stored
    versions. ``n_links`` counts links, ``n_pages`` the row keys that link,
    ``host_pages`` the stored keys on the target's host. References that cannot
    be resolved count nowhere.

    Links are counted per (page, target) and then per target, each time partially
    before the shuffle, so a target that everything links to is one row per task;
    page text enters no shuffle. The join with the stored keys has one row a key on
    both sides; the one with the hosts is salted by target.
    """
    rows = htmlscan.link_rows(pages.select("row_key", "url", "page"), F.col("page"), md5=md5).filter(F.col("target").isNotNull())
    pairs = rows.groupBy("row_key", "target_key").agg(F.count(F.lit(1)).alias("n"), F.min(host_rev("target")).alias("host_rev"))
    targets = pairs.groupBy("target_key").agg(
        F.sum("n").alias("n_links"), F.count(F.lit(1)).alias("n_pages"), F.min("host_rev").alias("host_rev"))
    keys = stored.groupBy("row_key").agg(F.min(host_rev("url")).alias("host_rev"))
    hosts = keys.groupBy("host_rev").agg(F.count(F.lit(1)).alias("host_pages"))
    known = keys.select(F.col("row_key").alias("target_key"), F.lit(True).alias("stored"))
    out = salted_join(targets.join(known, "target_key", "left"), hosts, "host_rev", "target_key")
    return out.select("target_key", "host_rev", "n_links", "n_pages", F.coalesce("stored", F.lit(False)).alias("stored"),
                      F.coalesce("host_pages", F.lit(0)).cast("bigint").alias("host_pages"))
