"""Links of listing pages, from a ``(page url, html)`` table.

The reference fetches one folder page at a time and walks its ``<a href>``
tags.  Here the pages are rows, and every step is a column expression:
comments are cut out, ``regexp_extract_all`` takes whole anchor tags (a ``>``
between quotes does not end one) and then whole attributes, of which the
first named ``href`` counts; entities are decoded; then skip rules,
``resolve_href`` for ``urljoin``, a same-host filter, the path relative to
a root, an optional suffix filter, and de-duplication of (url, relative
path) per page keeping the first position.  Fetching linked sub-folders
(network I/O) is not done; folder links are returned flagged.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalflow.functions.names import file_suffix
from fiscalflow.functions.urls import PROCESSABLE_SUFFIXES, resolve_href, url_host, url_path

COMMENT = r"(?s)<!--.*?(?:-->|$)"
ANCHOR = r"""(?is)<a(?=[\s/])((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>"""
ATTRIBUTE = r"""(?s)([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
# The hrefs the reference skips outright.
SKIPPED_HREFS = ("../", "./", "/")


def _named_entities() -> Column:
    """Entity name -> characters, from Python's table of the HTML standard."""
    return F.from_json(F.lit(json.dumps({k: v for k, v in html5.items() if k.endswith(";")})), "map<string,string>")


def _entity_text(entity: Column) -> Column:
    """The characters of one entity; an unknown one stays as it is."""
    body = F.substring(entity, 3, 1 << 30)
    number = F.when(F.lower(F.substring(entity, 3, 1)) == "x", F.conv(F.regexp_extract(entity, r"([0-9a-fA-F]+);$", 1), 16, 10)).otherwise(F.regexp_extract(body, r"^([0-9]+)", 1)).try_cast("long")
    valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(entity.startswith("&#"), F.when(valid, char).otherwise(F.lit("\ufffd"))).otherwise(
        F.coalesce(F.try_element_at(_named_entities(), F.substring(entity, 2, 1 << 30)), entity)
    )


def decode_entities(c: Column) -> Column:
    """Numeric and named character references (with their semicolon) decoded once, from left to right."""
    between, found = F.split(c, ENTITY, -1), F.regexp_extract_all(c, F.lit(ENTITY), F.lit(0))
    joined = F.concat(F.transform(found, lambda e, i: F.concat(F.element_at(between, i + 1), _entity_text(e))), F.slice(between, -1, 1))
    return F.when(c.contains("&") & (F.size(found) > 0), F.array_join(joined, "")).otherwise(c)


def anchors(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """One row per ``<a>`` with an ``href``, with its 0-based position among them in the page."""
    tags = F.regexp_extract_all(F.regexp_replace(F.col(html_col), COMMENT, ""), F.lit(ANCHOR), 1)

    def href(tag: Column) -> Column:
        names, values = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1)), F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(2))
        return F.element_at(values, F.array_position(F.transform(names, F.lower), F.lit("href")).cast("int"))

    has_href = lambda tag: F.array_contains(F.transform(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1)), F.lower), "href")
    others = [c for c in pages.columns if c != html_col]
    each = pages.select(*others, F.posexplode(F.transform(F.filter(tags, has_href), href)).alias("posicao", "href_raw"))
    bare = F.regexp_replace(F.col("href_raw"), r"""^["']|["']$""", "")
    return each.withColumn("href", F.regexp_replace(decode_entities(bare), r"^\s+|\s+$", "")).drop("href_raw")


def relative_to_root(path: Column, root: str) -> Column:
    """Path relative to ``root`` (``PurePosixPath.relative_to``); null when
    the path is not under the root."""
    root = "/" + root.strip("/") if root.strip("/") else "/"
    trimmed = F.regexp_replace(path, r"/+$", "")
    if root == "/":
        return F.when(trimmed.startswith("/"), F.substring(trimmed, 2, 1 << 30)).otherwise(F.when(trimmed == "", F.lit("")))
    return (
        F.when(trimmed == root, F.lit("."))
        .when(trimmed.startswith(root + "/"), F.substring(trimmed, len(root) + 2, 1 << 30))
    )


def listing_links(
    pages: DataFrame,
    *,
    url_col: str = "url",
    html_col: str = "html",
    root: str | None = "/",
    suffixes: Sequence[str] | None = PROCESSABLE_SUFFIXES,
    keys: Sequence[str] = ("page_id",),
) -> DataFrame:
    """Files and folders linked from each page.

    ``root`` is the path links must sit under (``None``: the page's own
    folder, as on the reference's first call); ``suffixes`` filters file
    links by lower-cased suffix (``None``: keep all).
    """
    base = F.when(F.col(url_col).endswith("/"), F.col(url_col)).otherwise(F.concat(F.col(url_col), F.lit("/")))
    a = anchors(pages, html_col).withColumn("__base", base)
    h = F.col("href")
    a = a.filter(
        (h != "") & ~h.isin(*SKIPPED_HREFS) & ~h.startswith("#") & ~h.startswith("?")
    ).withColumn("url_link", resolve_href(F.col("__base"), h))
    a = a.filter(url_host(F.col("url_link")) == url_host(F.col("__base")))
    abs_path = F.regexp_replace(url_path(F.col("url_link")), r"/+$", "")
    if root is None:
        page_root = F.regexp_replace(url_path(F.col("__base")), r"/+$", "")
        rel = F.when(abs_path == page_root, F.lit(".")).when(
            abs_path.startswith(F.concat(page_root, F.lit("/"))), F.expr("substring(__abs, length(__proot) + 2)")
        )
        a = a.withColumns({"__abs": abs_path, "__proot": page_root}).withColumn("caminho_relativo", rel)
    else:
        a = a.withColumn("caminho_relativo", relative_to_root(abs_path, root))
    name = F.regexp_extract(abs_path, r"([^/]*)$", 1)
    a = a.filter(F.col("caminho_relativo").isNotNull() & (name != ""))
    a = a.withColumn("pasta", h.endswith("/"))
    if suffixes is not None:
        a = a.filter(F.col("pasta") | file_suffix(name).isin(*[s.lower() for s in suffixes]))
    keys = list(keys)
    return a.groupBy(*keys, "url_link", "caminho_relativo", "pasta").agg(F.min("posicao").alias("posicao"))


def distinct_hrefs(pages: DataFrame, keys: Sequence[str] = ("page_id",), html_col: str = "html") -> DataFrame:
    """Each distinct href per page with the position of its first
    occurrence (order-preserving de-duplication)."""
    return anchors(pages, html_col).groupBy(*keys, "href").agg(F.min("posicao").alias("posicao"))
