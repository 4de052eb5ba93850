"""Text clean-up, labels and name similarity."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower-case substrings that mark test and depot stations.
TEST_STATION_WORDS = [
    "don't use", "dont use", "do not use",
    "nycbs depot", "nycbs test",
    "mobile 01", "mobile 02",
    "8d ops", "8d qc", "8d mobile",
    "gow tech", "tech shop", "ssp tech",
    "kiosk in a box", "mlswkiosk",
    "facility", "warehouse",
    "temp", ".temp",
    "deployment",
    "mtl-eco", "lab",
    "la metro", "demo",
]

# Operator names as published, and the name each is reported under.
OPERATOR_NAMES = {
    "NYC Ferry": "NYC Ferry",
    "NYWW (Port Imperial FC)": "NY Waterway",
    "New York Water Taxi": "Water Taxi",
    "SeaStreak": "SeaStreak",
    "Liberty Landing Ferry": "Liberty Landing",
    "NY Waterway": "NY Waterway",
    "NY Waterway-(Port Imperial FC)": "NY Waterway",
    "NY Waterway-(Billy Bey FC)": "Billy Bey",
    "Billy Bey": "Billy Bey",
    "Water Tours": "Water Tours",
    "New York Water Tours": "Water Tours",
    "Baseball": "Baseball",
    "HMS": "HMS",
}

# Subway line groups.
LINE_GROUPS = {
    "8th Ave": ["A", "C", "E"],
    "6th Ave": ["B", "D", "F", "M"],
    "Crosstown": ["G"],
    "Nassau": ["J", "Z"],
    "14th St-Canarsie": ["L"],
    "Broadway": ["N", "Q", "R", "W"],
    "7th Ave": ["1", "2", "3"],
    "Lexington": ["4", "5", "6"],
    "Flushing": ["7"],
    "Shuttle": ["S"],
}

# Boroughs that may follow a dash in a stop name.
BOROUGH_SUFFIXES = ["Manhattan", "Brooklyn", "Queens", "Bronx"]


def strip_float_suffix(station_id: Column) -> Column:
    """``519.0`` -> ``519``; ids with real decimals such as ``5636.10`` stay whole."""
    text = station_id.cast("string")
    return F.when(text.contains(".0"), F.regexp_replace(text, r"\.0$", "")).otherwise(text)


def id_class(station_id: Column) -> Column:
    """``modern`` for dashed, JC and HB ids; ``legacy`` for the rest, NULL included."""
    modern = station_id.contains("-") | station_id.startswith("JC") | station_id.startswith("HB")
    return F.when(modern, "modern").otherwise("legacy")


def is_legacy_numeric_id(station_id: Column, low: int = 3000, high: int = 5000) -> Column:
    """Digits only, in ``[low, high)``."""
    number = station_id.try_cast("int")
    return station_id.rlike("^[0-9]+$") & (number >= low) & (number < high)


def is_legacy_short_id(station_id: Column, below: int = 10) -> Column:
    return ~station_id.contains("-") & (F.length(station_id) < below)


def contains_any(name: Column, words: Sequence[str]) -> Column:
    """Case-insensitive substring test as one regular expression (NULL in, NULL out).

    Words are tried only where one of their first letters stands.
    """
    if not all(words):
        return F.lower(name).rlike("|".join(re.escape(w) for w in words))
    first = "".join(sorted({re.escape(w[0]) for w in words}))
    return F.lower(name).rlike(f"(?=[{first}])(?:" + "|".join(re.escape(w) for w in words) + ")")


def is_test_station(name: Column, words: Sequence[str] = TEST_STATION_WORDS) -> Column:
    return contains_any(name, words)


def route_label(a: Column, b: Column, sep: str = " → ") -> Column:
    """``a → b``; NULL when either end is NULL."""
    return F.concat(a, F.lit(sep), b)


def bracket_prefix(text: Column) -> tuple[Column, Column]:
    """``(Holiday) Monday`` -> (``Monday``, ``Holiday``); plain text -> (text, NULL)."""
    trimmed = F.trim(text)
    pattern = r"^\(([^)]+)\)\s*(\w+)"
    hit = trimmed.rlike(pattern)
    rest = F.when(hit, F.trim(F.regexp_extract(trimmed, pattern, 2))).otherwise(
        F.coalesce(trimmed, F.lit("")))
    inner = F.when(hit, F.trim(F.regexp_extract(trimmed, pattern, 1)))
    return rest, inner


def clean_count(text: Column) -> Column:
    """Counts from cells: blank 0, ``1,234`` 1234, ``12.7`` 12, anything else 0."""
    number = F.regexp_replace(F.trim(text.cast("string")), ",", "").try_cast("double")
    whole = F.when(F.isnan(number), F.lit(0.0)).otherwise(number)
    return F.coalesce(whole.try_cast("bigint"), F.lit(0).cast("bigint"))


def coerce_int(text: Column, default: int) -> Column:
    """Integer through double, with a default for blanks and bad text."""
    return F.coalesce(text.cast("string").try_cast("double").try_cast("bigint"), F.lit(default).cast("bigint"))


def borough_of(stop_name: Column) -> Column:
    out = F.lit(None).cast("string")
    for b in reversed(BOROUGH_SUFFIXES):
        out = F.when(stop_name.contains(f"- {b}"), b).otherwise(out)
    return out


def line_group(line: Column) -> Column:
    out = F.lit("Other")
    for group, lines in LINE_GROUPS.items():
        out = F.when(line.isin(*lines), group).otherwise(out)
    return out


def split_observed(name: Column) -> tuple[Column, Column]:
    """Holiday name without its ``(observed)`` mark, and observed / federal."""
    kind = F.when(F.lower(name).contains("(observed)"), "observed").otherwise("federal")
    clean = F.when(kind == "observed", F.regexp_replace(name, r" \([Oo]bserved\)", "")).otherwise(name)
    return clean, kind


def sorted_tokens(name: Column) -> Column:
    """Lower-case words in sorted order, joined by one blank."""
    words = F.split(F.trim(F.lower(name)), r"\s+")
    return F.array_join(F.array_sort(words), " ")


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one big-integer step per character."""
    positions: dict[str, int] = {}
    for i, ch in enumerate(a):
        positions[ch] = positions.get(ch, 0) | (1 << i)
    mask = (1 << len(a)) - 1
    rows = mask
    for ch in b:
        matched = rows & positions.get(ch, 0)
        rows = ((rows + matched) | (rows - matched)) & mask
    return len(a) - rows.bit_count()


def _ratio(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * _common_subsequence(a, b) / total


def similarity(a: Column, b: Column) -> Column:
    """Indel ratio 0..100: ``200 * LCS / (len a + len b)``.

    The one place that needs Python: Spark has Levenshtein but no longest common
    subsequence. Arrow batches, and only on candidate pairs.
    """
    @F.pandas_udf("double")
    def indel_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([_ratio(x, y) for x, y in zip(left, right)], dtype="float64")

    return indel_ratio(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Similarity of two names after lower-casing and sorting their words."""
    return similarity(sorted_tokens(a), sorted_tokens(b))
