"""URL keys and hosts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import catalogs as cat
from . import text as t


def url_key(url: Column) -> Column:
    """B1: comparison key of a URL; all trailing slashes go, empty becomes NULL."""
    return F.when(~t.is_blank(url), F.rtrim(url, F.lit("/")))


def root_domain(url: Column) -> Column:
    """Host in lower case without user, port and tracking labels; NULL when there is none."""
    full = F.when(F.contains(url, F.lit("://")), url).otherwise(F.concat(F.lit("https://"), url))
    authority = F.regexp_extract(full, r"(?s)^[^/?#]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.lower(authority), r"^.*@|:.*$", "")
    labels = "|".join(cat.TRACKING_LABELS)
    return t.blank_to_null(F.regexp_replace(host, rf"^(?:(?:{labels})\.)+(?=[^.]*\.[^.]*)", ""))
