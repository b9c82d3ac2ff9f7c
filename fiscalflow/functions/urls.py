"""URL and path functions: parts, relative-link resolution, source kind.

Regex based (RFC 3986 appendix B split) rather than ``parse_url``: the
links found in listing pages carry raw non-ASCII characters that
``java.net.URI`` rejects, and the regex form is total (never raises).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fiscalflow.functions._util import col
from fiscalflow.functions.names import file_suffix

# Extensions the reference reads, and its source-kind labels.
TABULAR_SUFFIXES = (".csv", ".xlsx", ".xls", ".ods")
ARCHIVE_SUFFIX = ".zip"
PROCESSABLE_SUFFIXES = TABULAR_SUFFIXES + (ARCHIVE_SUFFIX,)
KIND_ZIP = "arquivo_zip"
KIND_TABULAR = "arquivo_tabular"
KIND_FTP_FOLDER = "ftp_pasta"
KIND_HTTP_PAGE = "http_pagina"

_URL = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"


def url_scheme(c: str | Column) -> Column:
    return F.lower(F.regexp_extract(col(c), _URL, 2))


def url_host(c: str | Column) -> Column:
    return F.regexp_extract(col(c), _URL, 4)


def url_path(c: str | Column) -> Column:
    return F.regexp_extract(col(c), _URL, 5)


def url_query(c: str | Column) -> Column:
    return F.regexp_extract(col(c), _URL, 7)


def source_kind(url: str | Column) -> Column:
    """``arquivo_zip`` / ``arquivo_tabular`` / ``ftp_pasta`` / ``http_pagina``;
    null for a scheme other than http, https or ftp (the reference raises;
    here the caller routes those rows to its error table)."""
    scheme = url_scheme(url)
    ext = file_suffix(url_path(url))
    return (
        F.when(~scheme.isin("http", "https", "ftp"), F.lit(None).cast("string"))
        .when(ext == ARCHIVE_SUFFIX, F.lit(KIND_ZIP))
        .when(ext.isin(*TABULAR_SUFFIXES), F.lit(KIND_TABULAR))
        .when(scheme == "ftp", F.lit(KIND_FTP_FOLDER))
        .otherwise(F.lit(KIND_HTTP_PAGE))
    )


def file_kind(path: str | Column) -> Column:
    """Reader to dispatch a file to, from its lower-cased suffix; null when
    the suffix is not supported (the row goes to the error table)."""
    ext = file_suffix(path)
    return (
        F.when(ext == ".csv", F.lit("csv"))
        .when(ext == ".xlsx", F.lit("xlsx"))
        .when(ext == ".xls", F.lit("xls"))
        .when(ext == ".ods", F.lit("ods"))
        .when(ext == ".parquet", F.lit("parquet"))
        .when(ext == ARCHIVE_SUFFIX, F.lit("zip"))
    )


def _remove_dot_segments(path: Column, drop_empty_inner: bool = False) -> Column:
    """RFC 3986 5.2.4 on an absolute path, as a fold over its segments.

    ``drop_empty_inner`` also removes empty segments other than the last
    (``a//b`` -> ``a/b``), which ``urljoin`` does for relative references."""
    segs = F.slice(F.split(path, "/"), 2, 1 << 30)  # drop the empty head before the first '/'
    if drop_empty_inner:
        n = F.size(segs)
        segs = F.filter(segs, lambda x, i: (x != "") | (i == n - 1))
    empty = F.array().cast("array<string>")

    def step(acc, s):
        popped = F.when(F.size(acc) > 0, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(acc)
        return F.when(s == "..", popped).when(s == ".", acc).otherwise(F.array_append(acc, s))

    kept = F.aggregate(segs, empty, step)
    last = F.element_at(segs, -1)
    trailing = F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), trailing)


def resolve_href(base_url: str | Column, href: str | Column) -> Column:
    """``urljoin(base, href)`` for the link forms listing pages use:
    absolute, scheme-relative (``//host/p``), host-rooted (``/p``) and
    relative with ``.``/``..`` segments.  Query and fragment of ``href`` are
    kept; those of ``base`` are dropped (as RFC 3986 does for a path href)."""
    b, h = col(base_url), col(href)
    scheme, host, bpath = url_scheme(b), url_host(b), url_path(b)
    h_path = F.regexp_extract(h, r"^([^?#]*)", 1)
    h_rest = F.regexp_extract(h, r"^[^?#]*(.*)$", 1)
    base_dir = F.regexp_replace(F.when(bpath == "", F.lit("/")).otherwise(bpath), r"[^/]*$", "")
    merged = _remove_dot_segments(F.concat(base_dir, h_path), drop_empty_inner=True)
    rooted = _remove_dot_segments(h_path)
    prefix = F.concat(scheme, F.lit("://"), host)
    return (
        F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), F.concat(prefix, rooted, h_rest))
        .otherwise(F.concat(prefix, merged, h_rest))
    )


def url_file_name(url: str | Column) -> Column:
    """Percent-decoded last path segment of a URL (``.../Dados%20ANS.csv`` ->
    ``Dados ANS.csv``), the name a downloaded file gets."""
    return F.url_decode(F.regexp_extract(url_path(url), r"([^/]*)$", 1))
