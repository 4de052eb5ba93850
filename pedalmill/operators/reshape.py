"""Wide to long, long to wide, and two-header sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..session import lookup_join


def unpivot_months(wide: DataFrame, ids: Sequence[str], value: str = "value",
                   first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Columns named like ``2015-01-31`` become rows (ids, month, year, value); blanks go.

    All such columns are taken unless the caller names the first or last year.
    """
    years = {c: int(c.split("-")[0]) for c in wide.columns if "-" in c and c.split("-")[0].isdigit()}
    months = [c for c, year in years.items() if (first_year is None or year >= first_year)
              and (last_year is None or year <= last_year)]
    return (wide.select(*ids, *[F.col(f"`{m}`").cast("double").alias(m) for m in months])
            .unpivot(list(ids), [F.col(f"`{m}`") for m in months], "month", value)
            .filter(F.col(value).isNotNull())
            .withColumn("year", F.substring("month", 1, 4).cast("int")))


def annual_mean(long: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    return long.groupBy(*by, "year").agg(F.avg(value).alias(value))


def pivot_sum(df: DataFrame, rows: Sequence[str], column: str, levels: Sequence, value: str) -> DataFrame:
    """One column per level in the given order; levels without rows give 0.

    Levels are named, so no extra job is needed to find them.
    """
    return df.groupBy(*rows).pivot(column, list(levels)).agg(F.sum(value)).fillna(0)


# Text that is no header (spacers, day headings, totals).
NOT_A_ROUTE = ["weekday", "weekdays", "total", "none", "nan", ""]
NOT_A_STOP = ["day", "date", "weekday", "weekdays", "none", ""]
SUMMARY_WORDS = ["total", "average", "weekday ridership", "number of"]


def _parsed_date(value: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(value, F.lit("yyyy-MM-dd[ HH:mm:ss]")),
                      F.try_to_timestamp(value, F.lit("M/d/yyyy"))).cast("date")


def _filled(cells: DataFrame) -> DataFrame:
    return (cells.withColumn("value", F.trim("value"))
            .filter(F.col("value").isNotNull() & (F.col("value") != "")))


def _is_mark() -> Column:
    low = F.lower(F.col("value"))
    return ((F.col("col") == 0) & (low == "day")) | ((F.col("col") == 1) & (low == "date"))


def sheets_without_header(cells: DataFrame, sheet_keys: Sequence[str] = ("file", "sheet")) -> DataFrame:
    """Sheets that no row marks as ``Day`` or ``Date``: ``sheet_records`` finds nothing in them."""
    marked = _filled(cells).groupBy(*sheet_keys).agg(F.max(_is_mark()).alias("marked"), F.count(F.lit(1)).alias("cells"))
    return marked.filter("NOT marked").drop("marked")


def sheet_records(cells: DataFrame, sheet_keys: Sequence[str] = ("file", "sheet")) -> DataFrame:
    """Ridership records from sheets with a route header row above a stop header row.

    ``cells``: file, sheet, row, col, value (text), rows and columns from 0. In
    each sheet the first row whose first cell is ``Day`` or second is ``Date`` names
    the stops, wherever it stands (see ``sheets_without_header`` for the others); the nearest row above with any heading names the destinations,
    filled to the right over merged cells. Data starts at the first dated row.
    Only the cells of two header rows go through a window. Data cells are grouped per row, and each row then meets the list of
    headed columns of its sheet, so a blank cell counts as zero rides.
    """
    keys = list(sheet_keys)
    low = F.lower(F.col("value"))
    cells = _filled(cells)

    heading = (F.col("col") >= 2) & ~low.isin("none", "weekday", "weekdays")
    stops = cells.filter(_is_mark()).groupBy(*keys).agg(F.min("row").alias("stop_row"))
    above = lookup_join(cells.filter(heading), stops, keys, "inner").filter(F.col("row") < F.col("stop_row"))
    routes = above.groupBy(*keys).agg(F.max("row").alias("route_row"))
    marks = stops.join(routes, keys, "left").withColumn("route_row", F.coalesce(
        "route_row", F.greatest(F.col("stop_row") - 1, F.lit(0))))
    top = lookup_join(cells, marks, keys, "inner").filter(F.col("row").isin(F.col("stop_row"), F.col("route_row")))
    is_stop = ((F.col("row") == F.col("stop_row")) & (F.col("col") >= 2) & ~low.isin(*NOT_A_STOP)
               & ~low.contains("total"))
    is_route = (F.col("row") == F.col("route_row")) & ~low.isin(*NOT_A_ROUTE)
    fill = Window.partitionBy(*keys).orderBy("col").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heads = (top.groupBy(*keys, "col", "stop_row").agg(
                F.max(F.when(is_stop, F.col("value"))).alias("origin"),
                F.max(F.when(is_route, F.col("value"))).alias("route"))
             .withColumn("destination", F.coalesce(F.last("route", ignorenulls=True).over(fill), F.lit("Unknown")))
             .filter(F.col("origin").isNotNull() & ~F.lower("destination").contains("total"))
             .groupBy(*keys, "stop_row")
             .agg(F.collect_list(F.struct("col", "destination", "origin")).alias("heads")))

    day, holiday = text.bracket_prefix(F.col("day_text"))
    is_summary = text.contains_any(F.col("day_text"), SUMMARY_WORDS)
    rows = (cells.groupBy(*keys, "row").agg(
                F.max(F.when(F.col("col") == 0, F.col("value"))).alias("day_text"),
                F.max(F.when(F.col("col") == 1, F.col("value"))).alias("date_text"),
                F.map_from_entries(F.collect_list(F.struct("col", "value"))).alias("cells"))
            .withColumn("date", _parsed_date(F.col("date_text")))
            .filter(F.col("date").isNotNull() & ~F.coalesce(is_summary, F.lit(False))))
    found = (lookup_join(rows, heads, keys, "inner").filter(F.col("row") > F.col("stop_row"))
             .withColumn("h", F.explode("heads")))
    value = F.coalesce(F.try_element_at("cells", F.col("h.col")), F.lit(""))
    return found.select(*keys, "date", day.alias("day_of_week"), holiday.alias("holiday"),
                        F.col("h.destination").alias("destination"), F.col("h.origin").alias("origin"),
                        text.clean_count(value).alias("ridership"))


def _substrings(text_col: str, shortest: int = 1) -> Column:
    """All distinct substrings of a short text."""
    n = F.length(text_col)
    starts = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    parts = F.flatten(F.transform(starts, lambda i: F.transform(
        F.sequence(F.lit(1), F.greatest(n - i + 1, F.lit(1))),
        lambda k: F.substring(F.col(text_col), i, k))))
    return F.explode(F.filter(F.array_distinct(parts), lambda s: F.length(s) >= shortest))


def match_names(names: DataFrame, known: DataFrame, name: str = "name", key: str = "known") -> DataFrame:
    """Loose match of two name lists: containment either way first, else a shared long word.

    "Contains" becomes equality with one of the other name's substrings, so all
    three tests are equi joins on distinct names rather than a comparison of every
    pair. Ties go to the first known name in order.
    """
    a = names.select(F.col(name).alias("name")).distinct().withColumn("__l", F.lower("name"))
    b = known.select(F.col(key).alias("match")).distinct().withColumn("__m", F.lower("match"))
    inside = a.select("name", _substrings("__l").alias("__s"))
    holds = (inside.join(b, F.col("__s") == F.col("__m")).select("name", "match", F.lit(1).alias("step")))
    parts = b.select("match", _substrings("__m").alias("__s"))
    held = parts.join(a, F.col("__s") == F.col("__l")).select("name", "match", F.lit(1).alias("step"))
    long_words = (a.select("name", F.explode(F.array_distinct(F.split("__l", r"\s+"))).alias("__w"))
                  .filter(F.length("__w") > 3))
    shared = (parts.filter(F.length("__s") > 3).join(long_words, F.col("__s") == F.col("__w"))
              .select("name", "match", F.lit(2).alias("step")))
    best = (holds.unionByName(held).unionByName(shared).groupBy("name")
            .agg(F.min_by("match", F.struct("step", "match")).alias("match")))
    return a.select("name").join(best, "name", "left")
