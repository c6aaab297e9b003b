"""Text columns: tokens and query-side tokenising."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_SEPARATORS = r"[^\p{L}0-9]+"


def tokens(text: Column) -> Column:
    """Lower-cased words and numbers in order; NULL text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def query_terms(text: str) -> list[str]:
    """Distinct terms of a search phrase, split the same way as documents: letters (category L) and digits 0-9."""
    kept = "".join(c if c in "0123456789" or unicodedata.category(c)[0] == "L" else " " for c in text.lower())
    return list(dict.fromkeys(kept.split()))
