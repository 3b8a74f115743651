"""Feed URLs: the stored form and the partition key made of it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# scheme :// [userinfo @] host[:port] path, query and fragment left out
_URL = r"^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#]*@)?([^/?#]+)([^?#]*)(?:[?#](?s:.*))?$"


def sanitize_url(url: Column) -> Column:
    """Scheme, host and path of a URL; NULL when scheme or host is missing.

    Percent escapes are kept as published.
    """
    scheme = F.lower(F.regexp_extract(url, _URL, 1))
    rest = F.concat(F.regexp_extract(url, _URL, 2), F.regexp_extract(url, _URL, 3))
    return F.when(scheme != "", F.concat(scheme, F.lit("://"), rest))


def base64url(text: Column) -> Column:
    """Unpadded URL-safe base64 of the UTF-8 text, on one line."""
    encoded = F.translate(F.base64(text.cast("binary")), "+/\r\n", "-_")
    return F.rtrim(encoded, F.lit("="))
