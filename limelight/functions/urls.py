"""URL column functions.

``canonicalize_url`` follows the split rules of RFC 3986 appendix B, the same
rules Python's ``urllib.parse.urlsplit`` applies: optional scheme, ``//host``
only after it, path up to ``?``/``#``, query up to ``#``. The host keeps port
and user info. ``try_parse_url`` is not used because it rejects URLs that
contain spaces or ``|``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limelight.functions._util import col_of
from limelight.functions.text import strip_ws

URL_SPLIT = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def url_parts(value) -> tuple[Column, Column, Column]:
    """(host, path, query) of a URL, empty strings for absent parts."""
    cleaned = F.regexp_replace(strip_ws(col_of(value)), r"[\t\r\n]", "")
    host = F.regexp_extract(cleaned, URL_SPLIT, 1)
    path = F.regexp_extract(cleaned, URL_SPLIT, 2)
    query = F.regexp_extract(cleaned, URL_SPLIT, 3)
    return host, path, query


def canonicalize_url(value) -> Column:
    """host lower-cased without one leading ``www.``, path without trailing ``/``,
    non-empty query kept, scheme and fragment dropped; without host the path as is."""
    return _joined(*url_parts(value))


def _joined(host: Column, path: Column, query: Column) -> Column:
    host = F.lower(host)
    host = F.when(host.startswith("www."), F.substring(host, 5, 1 << 30)).otherwise(host)
    path = F.regexp_replace(path, r"/+$", "")
    base = F.when(host != "", F.concat(host, path)).otherwise(path)
    return F.when(query != "", F.concat(base, F.lit("?"), query)).otherwise(base)


def with_canonical_url(df: DataFrame, value, out: str = "canonical_url") -> DataFrame:
    """F3 as a column of ``df``: each part of the URL is extracted once, in a projection of its own."""
    host, path, query = url_parts(value)
    parts = df.withColumns({"_url_host": host, "_url_path": path, "_url_query": query})
    return parts.withColumn(out, _joined(F.col("_url_host"), F.col("_url_path"), F.col("_url_query"))).drop(
        "_url_host", "_url_path", "_url_query")


def percent_decode(value) -> Column:
    """``unquote``-like decoding: ``+`` and a ``%`` without two hex digits stay as they are."""
    raw = col_of(value)
    protected = F.replace(F.regexp_replace(raw, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(protected), raw)


def url_contains_token(value, token: str) -> Column:
    """1.0 if the decoded, lower-cased URL contains ``token``; NULL URL -> 0.0."""
    decoded = F.lower(percent_decode(value))
    return F.when(F.coalesce(F.instr(decoded, token.lower()) > 0, F.lit(False)), F.lit(1.0)).otherwise(F.lit(0.0))


def encode_title(value) -> Column:
    """Percent-encode a title like Python's ``quote``: UTF-8 escapes, space as
    ``%20``, ``/`` and ``~`` kept, ``*`` escaped (``url_encode`` is form encoding,
    which differs on exactly these characters)."""
    encoded = F.url_encode(col_of(value))
    for form, path in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(form), F.lit(path))
    return encoded


def article_url(title, language, site: str = "wikipedia.org") -> Column:
    """``https://{lang}.{site}/wiki/{encoded title}``."""
    return F.concat(F.lit("https://"), col_of(language), F.lit("." + site + "/wiki/"), encode_title(title))


def pageviews_url(title, language, start, end,
                  base: str = "https://wikimedia.org/api/rest_v1/metrics/pageviews/per-article") -> Column:
    """per-article daily views request URL for one language project."""
    return F.concat_ws(
        "/",
        F.lit(base),
        F.concat(col_of(language), F.lit(".wikipedia.org")),
        F.lit("all-access"),
        F.lit("user"),
        encode_title(title),
        F.lit("daily"),
        F.concat(F.date_format(col_of(start), "yyyyMMdd"), F.lit("00")),
        F.concat(F.date_format(col_of(end), "yyyyMMdd"), F.lit("00")),
    )
