"""String expressions for file keys and report lines."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters escaped in published URLs, in the order they are escaped. "%" comes first
# so that the escapes themselves survive; "=" and "/" stay literal.
URL_ESCAPES = (("%", "%25"), (" ", "%20"), ("#", "%23"), ("?", "%3F"), ("+", "%2B"))

# Fixed value: what marks a key as internal.
INTERNAL_KEY = "(^|/)_"


def base_name(path) -> Column:
    path = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(path, "/"), -1)


def strip_prefix(path, prefix: str) -> Column:
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(path, "^" + re.escape(prefix.rstrip("/")) + "/", "")


def encode_key(key) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    for raw, escaped in URL_ESCAPES:
        key = F.replace(key, F.lit(raw), F.lit(escaped))
    return key


def is_internal(key) -> Column:
    """True when a path segment starts with an underscore."""
    key = F.col(key) if isinstance(key, str) else key
    return key.rlike(INTERNAL_KEY)


def csv_line(columns, indent: str = "  ") -> Column:
    """The given columns of a row as one indented CSV line."""
    options = {"dateFormat": "yyyy-MM-dd", "nullValue": "NA"}
    return F.concat(F.lit(indent), F.to_csv(F.struct(*columns), options))


def path_key(path, encoded: bool = False) -> Column:
    """A path without its scheme, by which listings, manifests and file metadata name the same file alike.
    ``encoded`` says that the path is written as a URI, as file metadata has it."""
    path = F.col(path) if isinstance(path, str) else path
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/*|^/+", "/")
