"""Scalar text functions. Everything but normalisation runs inside the JVM."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the white space of Unicode text, as a regular expression class.
WS = r"[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SHINGLE_WORDS = 5


def _normal(t: str | None) -> str | None:
    if t is None:
        return None
    if not unicodedata.is_normalized("NFKC", t):
        t = unicodedata.normalize("NFKC", t)
    return " ".join(t.split())


@F.pandas_udf(T.StringType())
def _normalize(s: pd.Series) -> pd.Series:
    return s.map(_normal)


def normalize_text(c: Column) -> Column:
    """NFKC, white space runs to one space, trimmed; letter case kept. Null stays null. There is no NFKC in the
    JVM's functions, so the text crosses to Python once, in Arrow batches, and is finished there."""
    return _normalize(c)


def strip(c: Column) -> Column:
    """Trim every Unicode white space, not only blanks."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def text_hash(c: Column) -> Column:
    return F.sha1(F.encode(normalize_text(c), "utf-8"))


def words(norm: Column) -> Column:
    """Words of a normalised text; the empty text has none."""
    return F.when(norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " "))


def shingles(norm: Column, k: int = SHINGLE_WORDS) -> Column:
    """Distinct runs of k words; a shorter text gives itself, an empty one nothing."""
    w = words(norm)
    n = F.greatest(F.size(w) - (k - 1), F.lit(0))
    # Parallel slices, so that the words are not split again for each run.
    rows = F.arrays_zip(*[F.slice(w, i + 1, n).alias(f"w{i}") for i in range(k)])
    runs = F.transform(rows, lambda r: F.concat_ws(" ", *[r.getField(f"w{i}") for i in range(k)]))
    return F.when(F.size(w) == 0, F.array().cast("array<string>")).when(F.size(w) < k, F.array(norm)).otherwise(F.array_distinct(runs))


def basename(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def last_url_segment(c: Column) -> Column:
    """Last path segment of a URL without query and fragment."""
    return basename(F.regexp_replace(c, "[?#].*$", ""))


def site(url: Column, source: Column) -> Column:
    """Host of ``url`` in lower case without scheme, user, port and a leading ``www.`` or ``m.``;
    ``source`` where there is no host. Null only if both are null."""
    rest = F.regexp_replace(F.regexp_replace(F.lower(url), r"^\s+", ""), r"^(?:[a-z][a-z0-9+.\-]*:)?//", "")
    host = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#\\\s]*", 0), r"^.*@", "")
    host = F.regexp_replace(F.regexp_replace(host, r":\d*$", ""), r"^(?:www|m)\.", "")
    return F.coalesce(F.when(F.length(host) > 0, host), source)


def line_key(line: Column) -> Column:
    """Letters and combining marks of a line in lower case: what two lines are compared by."""
    return F.regexp_replace(F.lower(line), r"[^\p{L}\p{M}]+", "")
