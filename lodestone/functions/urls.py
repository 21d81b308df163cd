"""URL identity and predicates."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import parse_qsl, urlencode

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Query keys that only track.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "gclid", "fbclid")

PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.regexp_replace(url, r"^\s+|\s+$", ""), PARTS, group)


@F.pandas_udf(StringType())
def quoted_query(query: pd.Series) -> pd.Series:
    """Queries with escapes: decoded, filtered and encoded again."""
    return query.map(lambda q: urlencode([(k, v) for k, v in parse_qsl(q, keep_blank_values=True) if k not in TRACKING and v != ""]))


def plain_query(query: Column) -> Column:
    """The same for queries of unreserved characters, in the JVM."""
    pairs = F.transform(F.split(query, "&"), lambda p: F.struct(F.split(p, "=", 2)[0].alias("k"), F.coalesce(F.get(F.split(p, "=", 2), F.lit(1)), F.lit("")).alias("v")))
    kept = F.filter(pairs, lambda p: ~p["k"].isin(*TRACKING) & (p["v"] != ""))
    return F.array_join(F.transform(kept, lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&")


def identity(url: Column, exact: bool = False) -> Column:
    """Lower-case scheme and host, no trailing slash but the root's, no tracking or blank parameters, no fragment.

    exact: parameters with characters that need escapes go through Python; without, they stay as they are.
    """
    scheme, host, path, query = F.lower(part(url, 1)), F.lower(part(url, 3)), part(url, 4), part(url, 5)
    path = F.when(F.regexp_replace(path, "/+$", "") == "", F.lit("/")).otherwise(F.regexp_replace(path, "/+$", ""))
    q = plain_query(query)
    if exact:
        q = F.when(query.rlike(r"^[A-Za-z0-9_.~&=\-]*$") & ~query.rlike("=[^&]*="), q).otherwise(quoted_query(query))
    front = F.when((host != "") | F.startswith(path, F.lit("//")), F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), F.lit("//"), host)).otherwise(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""))
    return F.concat(front, path, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))


def host(url: Column) -> Column:
    return F.lower(part(url, 3))


def is_detail(url: Column, hosts: Sequence[str], section: str, keep_empty: bool = False) -> Column:
    """The host is one of hosts and the path is section/<one name>. keep_empty: empty path parts count (the stricter of the two rules in use)."""
    path = part(url, 4)
    parts = F.split(F.regexp_replace(path, "^/+|/+$", ""), "/") if keep_empty else F.filter(F.split(path, "/"), lambda p: p != "")
    return part(url, 3).isin(*hosts) & (F.size(parts) == 2) & (F.get(parts, F.lit(0)) == section)


def is_pdf(url: Column) -> Column:
    return F.endswith(F.lower(part(url, 4)), F.lit(".pdf"))
