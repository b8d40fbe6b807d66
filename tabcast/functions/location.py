"""Address parsing as built-in column expressions (no Python UDF).

A free-text address yields three features: a two-letter state code, a five-digit zip
and a military-post flag. A NULL address or the literal ``'Missing'`` gives
(``'Missing'``, ``'Missing'``, 0).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's rules for equal results):
#   military post words, matched as whole words in any letter case: APO FPO DPO
#   military state codes, matched as whole words in upper case only: AA AE AP
#   state: two capital letters as a word, then whitespace, then five digits
#   zip: the first stand-alone run of exactly five digits
#   placeholder for anything absent: Missing
MILITARY_WORDS = r"(?i)\b(APO|FPO|DPO)\b"
MILITARY_STATES = r"\b(AA|AE|AP)\b"
STATE_PATTERN = r"\b([A-Z]{2})\b\s+\d{5}"
ZIP_PATTERN = r"\b(\d{5})\b"
MISSING = "Missing"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _absent(loc: Column) -> Column:
    return loc.isNull() | (loc == F.lit(MISSING))


def military_flag(loc: str | Column) -> Column:
    """1 when the address names a military post, else 0 (also for NULL)."""
    loc = _c(loc)
    hit = loc.rlike(MILITARY_WORDS) | loc.rlike(MILITARY_STATES)
    return F.when(_absent(loc), F.lit(0)).when(hit, F.lit(1)).otherwise(F.lit(0))


def _extract_or_missing(loc: Column, pattern: str) -> Column:
    got = F.nullif(F.regexp_extract(loc, pattern, 1), F.lit(""))
    return F.when(_absent(loc), F.lit(MISSING)).otherwise(F.coalesce(got, F.lit(MISSING)))


def state_code(loc: str | Column) -> Column:
    """first capital-letter pair followed by whitespace and five digits."""
    return _extract_or_missing(_c(loc), STATE_PATTERN)


def zip_code(loc: str | Column) -> Column:
    """first stand-alone five-digit number, kept as text."""
    return _extract_or_missing(_c(loc), ZIP_PATTERN)


def parse_location(df, col: str = "Hospital_Location", prefix: str = "Location"):
    """add ``{prefix}_State``, ``{prefix}_Zip``, ``{prefix}_Is_Military`` in one narrow projection."""
    return df.withColumns(
        {
            f"{prefix}_State": state_code(col),
            f"{prefix}_Zip": zip_code(col),
            f"{prefix}_Is_Military": military_flag(col),
        }
    )
