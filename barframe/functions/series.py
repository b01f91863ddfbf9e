"""Column expressions over one ordered series; ``w`` is its window, ordered by row."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def pct_change_col(col: str, n: int, w: WindowSpec) -> Column:
    """``x / x[n rows earlier] - 1``; NULL in the first n rows and where the earlier value is 0."""
    return F.try_divide(F.col(col), F.lag(col, n).over(w)) - 1


def forward_return_col(col: str, n: int, w: WindowSpec) -> Column:
    """The n-row change as seen n rows ahead."""
    return F.try_divide(F.lead(col, n).over(w), F.col(col)) - 1


def target_col(forward: Column, null_tail: bool = False) -> Column:
    """1 where the return ahead is positive, else 0; a missing one counts as 0 unless ``null_tail``."""
    label = F.when(forward > 0, 1).otherwise(0)
    return F.when(forward.isNotNull(), label) if null_tail else label


def rolling_std_col(col: str, n: int, w: WindowSpec) -> Column:
    """Sample standard deviation of the last n rows, NULL until there are n values."""
    frame = w.rowsBetween(-(n - 1), Window.currentRow)
    return F.when(F.count(col).over(frame) == n, F.stddev_samp(col).over(frame))


def session_parts(ts: Column | str, tz: str | None = None) -> dict[str, Column]:
    """Hour, minute and weekday (Monday is 0); ``tz`` converts from UTC first."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    local = F.from_utc_timestamp(ts, tz) if tz else ts
    return {"Hour": F.hour(local), "Minute": F.minute(local), "DayOfWeek": F.weekday(local)}
