"""Date parsing and calendar features as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the strict text-date layout the reference parses (month/day/two-digit year).
STRICT_FORMAT = "MM/dd/yy"
# Month-first layouts tried in order by the mixed parser (documented list, first match wins).
MIXED_FORMATS = ("MM/dd/yy", "MM/dd/yyyy", "M/d/yy", "M/d/yyyy", "yyyy-MM-dd", "MM-dd-yyyy", "MMM d, yyyy")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _two_digit_year_pivot(d: Column, fmt: str) -> Column:
    """Spark reads ``yy`` as 2000–2099; the POSIX rule (pandas, DuckDB) maps 69–99 to 1969–1999."""
    if "yy" in fmt and "yyyy" not in fmt:
        return F.when(F.year(d) >= 2069, F.add_months(d, -1200)).otherwise(d)
    return d


def parse_strict(c: str | Column, fmt: str = STRICT_FORMAT) -> Column:
    """Text → DATE with one layout; anything that does not parse becomes NULL."""
    return _two_digit_year_pivot(F.try_to_date(_c(c), fmt), fmt)


def parse_mixed(c: str | Column, formats=MIXED_FORMATS) -> Column:
    """Text → DATE trying month-first layouts in order; no match → NULL."""
    return F.coalesce(*[parse_strict(c, f) for f in formats])


def weekday_monday0(c: str | Column) -> Column:
    """Day of week with Monday = 0 … Sunday = 6 (Spark's ``weekday``)."""
    return F.weekday(_c(c))


def calendar_features(df: DataFrame, date_col: str, prefix: str) -> DataFrame:
    """D3+D4: year, month, day, day-of-week (Mon=0) and quarter as ``{prefix}_*`` doubles."""
    d = F.col(date_col)
    return df.withColumns(
        {
            f"{prefix}_Year": F.year(d).cast("double"),
            f"{prefix}_Month": F.month(d).cast("double"),
            f"{prefix}_Day": F.dayofmonth(d).cast("double"),
            f"{prefix}_DayOfWeek": weekday_monday0(d).cast("double"),
            f"{prefix}_Quarter": F.quarter(d).cast("double"),
        }
    )


def lead_days(end: str | Column, start: str | Column) -> Column:
    """Whole days from ``start`` to ``end`` (negative when end precedes start)."""
    return F.datediff(_c(end), _c(start))


def date_features(
    df: DataFrame,
    order_col: str = "Order_Placed_Date",
    delivery_col: str = "Delivery_Date",
    drop: bool = True,
) -> DataFrame:
    """D1+D3+D4+D5 in one projection: parse both text dates, add calendar parts and lead time."""
    od, dd = "__order_date", "__delivery_date"
    out = df.withColumns({od: parse_strict(order_col), dd: parse_strict(delivery_col)})
    out = calendar_features(out, od, "Order")
    out = calendar_features(out, dd, "Delivery")
    out = out.withColumn("Delivery_Time", lead_days(dd, od).cast("double"))
    out = out.drop(od, dd)
    return out.drop(order_col, delivery_col) if drop else out
