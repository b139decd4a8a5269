"""Event-time helpers: buckets, reporting clock, bands."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(at: datetime) -> Column:
    """A zone-free time literal; it folds to a constant and can reach the scan."""
    return F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def since(column: str, as_of: datetime, back: timedelta) -> Column:
    return F.col(column) >= moment(as_of - back)


def before(column: str, as_of: datetime, back: timedelta = timedelta(0)) -> Column:
    return F.col(column) < moment(as_of - back)


def window_start(column: str, width: str) -> Column:
    """Start of the epoch-aligned window a time falls in."""
    return F.window(column, width).getField("start")


def flatten_window(df: DataFrame, bucket: str = "bucket") -> DataFrame:
    """Replace a window struct by its start, first, as ``time_window``."""
    others = [c for c in df.columns if c != bucket]
    return df.select(F.col(f"{bucket}.start").alias("time_window"), *others)


# Lower bound of each band and its label.
AGE_BANDS = (
    (18, "18-24"),
    (25, "25-34"),
    (35, "35-44"),
    (45, "45-54"),
)
YOUNGEST = "Under 18"
OLDEST = "55+"
OLDEST_FROM = 55


def age_band(age: str = "age") -> Column:
    """Age label. An unknown age falls in the last band."""
    years = F.col(age)
    label = F.when(years < AGE_BANDS[0][0], YOUNGEST)
    upper_bounds = [low for low, _ in AGE_BANDS[1:]] + [OLDEST_FROM]
    for (_, name), upper in zip(AGE_BANDS, upper_bounds):
        label = label.when(years < upper, name)
    return label.otherwise(OLDEST)
