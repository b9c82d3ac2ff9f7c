"""Listings followed into their folders, over a table of known pages.

The reference walks a listing page, then each folder linked from it, and so
on, page by page.  Here a round takes all new folders at once (semi-naive
iteration): the frontier is joined with the pages, their links are taken by
column expressions in one pass before, and folders not met before are the
next frontier.  Each page's links are taken once, cycles end, and a folder
whose page is not in the table is returned as such.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalflow.functions.urls import PROCESSABLE_SUFFIXES
from fiscalflow.session import materialize
from fiscalflow.sources.listings import listing_links


def page_key(url: str | Column) -> Column:
    """What tells pages apart: the URL without query, fragment and slashes at its end."""
    return F.regexp_replace(F.regexp_replace(F.col(url) if isinstance(url, str) else url, r"[?#].*$", ""), r"/+$", "")


@dataclass
class Crawl:
    #: (pagina, url_link, caminho_relativo, nivel): each file link once, at its first page (least level, then least page).
    files: DataFrame
    #: (pagina, nivel, conhecida): each folder once; ``conhecida``: its page is in the table.
    folders: DataFrame
    rounds: int


def crawl(pages: DataFrame, seeds: Sequence[str], *, url_col: str = "url", html_col: str = "html", root: str | None = "/", suffixes: Sequence[str] | None = PROCESSABLE_SUFFIXES) -> Crawl:
    """All files reached from the seed pages through folder links.  Pages that share a key count as one page with all their links."""
    spark = pages.sparkSession
    known = pages.select(page_key(url_col).alias("pagina"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    edges = materialize(listing_links(known, url_col="url", html_col="html", root=root, suffixes=suffixes, keys=("pagina",)), spark, "crawl-links")
    there = materialize(known.select("pagina").distinct().withColumn("conhecida", F.lit(True)), spark, "crawl-pages")
    frontier = spark.createDataFrame([(s,) for s in seeds], "s string").select(page_key("s").alias("pagina")).distinct()
    frontier = visited = materialize(frontier, spark, "crawl-frontier")
    found, met, level = [], [], 0
    while frontier.take(1):
        links = edges.join(frontier, "pagina", "left_semi")
        found.append(links.where("NOT pasta").select("pagina", "url_link", "caminho_relativo", F.lit(level).alias("nivel")))
        met.append(frontier.join(there, "pagina", "left").select("pagina", F.lit(level).alias("nivel"), F.coalesce("conhecida", F.lit(False)).alias("conhecida")))
        new = links.where("pasta").select(page_key("url_link").alias("pagina")).distinct().join(visited, "pagina", "left_anti")
        frontier = materialize(new, spark, "crawl-frontier")
        visited = materialize(visited.unionByName(frontier), spark, "crawl-visited")
        level += 1
    if not found:
        raise ValueError("no seed page was given")
    first = reduce(DataFrame.unionByName, found).groupBy("url_link").agg(F.min(F.struct("nivel", "pagina", "caminho_relativo")).alias("f"))
    files = materialize(first.select("f.pagina", "url_link", "f.caminho_relativo", "f.nivel"), spark, "crawl-files")
    return Crawl(files, reduce(DataFrame.unionByName, met), level)
