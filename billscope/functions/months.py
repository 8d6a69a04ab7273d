"""Calendar-month helpers. Months are DATEs on the first day of the month."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_of(moment: Column) -> Column:
    """First day of the month, as DATE (date_trunc would give a TIMESTAMP)."""
    return F.trunc(moment.cast("date"), "month")


def later_month(month: date, count: int) -> date:
    """The month `count` months after a literal month."""
    year, index = divmod(month.year * 12 + month.month - 1 + count, 12)
    return date(year, index + 1, 1)


def within(moment: Column, start: date, end: date) -> Column:
    """Half-open range test; literals, so it reaches the parquet scan as a pushed filter."""
    return (moment >= F.lit(start)) & (moment < F.lit(end))


def in_year(month: Column, year: int) -> Column:
    return within(month, date(year, 1, 1), date(year + 1, 1, 1))


def in_months(table: DataFrame, month: str, start: date | None, end: date) -> DataFrame:
    """Rows of a table laid out by `month` that can lie in the half-open range; a table without that column as it is.

    A test on literals of a partition column: files of other months are not even listed for reading.
    """
    if month not in table.columns:
        return table
    last = (end - timedelta(days=1)).replace(day=1)
    rows = table.filter(F.col(month) <= F.lit(last))
    return rows if start is None else rows.filter(F.col(month) >= F.lit(start.replace(day=1)))


def invoice_key(*tables: DataFrame) -> list[str]:
    """The columns that rows of one invoice share: its id and, where all tables are laid out by it, its month.

    The month is a function of the id, so it changes no result; as a join key it lets Spark read only those months of one side
    that the other side has.
    """
    return ["invoice_id", *(["invoice_month"] if all("invoice_month" in t.columns for t in tables) else [])]
