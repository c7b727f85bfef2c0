"""Column expressions with the null semantics that the league operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns) -> None:
    """Raises unless all columns are there; decided at analysis, without a job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def running_sum(x: Column, w: WindowSpec) -> Column:
    """Running sum that is null from the first null on."""
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.when(F.count(F.when(x.isNull(), 1)).over(w) > 0, None).otherwise(F.sum(x).over(w))


def lag_or_zero(x: Column, w: WindowSpec) -> Column:
    """The row before's value; 0 where there is none or it is null."""
    return F.coalesce(F.lag(x, 1).over(w), F.lit(0))


def ratio(num: Column, den: Column) -> Column:
    """num / den, 0 where den isn't positive."""
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def implied_probability(odds: Column) -> Column:
    """Probability implied by American odds; null for null."""
    o = odds.cast("double")
    return F.when(o < 0, F.abs(o) / (F.abs(o) + 100)).when(o >= 0, 100 / (o + 100))


def tri_state(value: Column, line: Column) -> Column:
    """True above the line, false below, null on it or where either is null."""
    return F.when(value > line, True).when(value < line, False)


def time_of_day(gametime: Column) -> Column:
    """Day before 15 h, Evening up to 18 h, Night after; null without an hour."""
    hour = F.nullif(F.regexp_extract(gametime, r"(\d+)(?=:)", 1), F.lit("")).try_cast("double")
    return F.when(hour < 15, "Day").when(hour.between(15, 18), "Evening").when(hour > 18, "Night")


def recoded(x: Column, mapping: dict[str, str]) -> Column:
    """The mapped value, or the value itself."""
    if not mapping:
        return x
    table = F.create_map(*[F.lit(v) for pair in mapping.items() for v in pair])
    return F.coalesce(F.element_at(table, x), x)


def masked_sum(mask: Column, x: Column) -> Column:
    return F.coalesce(F.sum(F.when(mask, x)), F.lit(0.0))


def masked_mean(mask: Column, x: Column) -> Column:
    return F.coalesce(F.avg(F.when(mask, x)), F.lit(0.0))


def masked_count(mask: Column) -> Column:
    return F.count(F.when(mask, 1))
