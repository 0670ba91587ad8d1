"""Linear trend of the market share per language and its forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions import vocab as V
from eventmart.functions.columns import ladder


def _settled(value: Column) -> Column:
    """Take off the noise of the last bits, which depends on the order of the rows.

    Shares have three decimals, so slopes do fall exactly between two rounded values or on
    a threshold; without this, noise would decide those cases.
    """
    return F.round(value, 10)


def language_trend(
    yearly: DataFrame,
    languages: DataFrame,
    forecast_years: Sequence[int] = (2026, 2027),
    min_years: int = 3,
    computed_at: str | None = None,
) -> DataFrame:
    """Ordinary least squares per language with the built-in regression aggregates.

    Years are counted from the first forecast year, which makes the intercept the forecast
    itself and keeps the fit well conditioned. A language with a constant share has no
    trend and gets no row, nor does one observed in fewer than `min_years` years.
    """
    origin = forecast_years[0]
    x = (F.col("year") - origin).cast("double")
    y = F.col("market_share_pct")
    fit = (
        yearly.groupBy("language_key")
        .agg(
            F.count(y).alias("n"),
            (F.min(y) < F.max(y)).alias("varies"),
            _settled(F.regr_slope(y, x)).alias("slope"),
            F.regr_intercept(y, x).alias("level"),
            _settled(F.regr_r2(y, x)).alias("r2"),
        )
        .filter((F.col("n") >= min_years) & F.col("varies"))
    )

    def forecast(year: int) -> Column:
        share = _settled(F.col("level") + F.col("slope") * float(year - origin))
        return F.round(F.greatest(F.lit(0.0), share), 4).alias(f"forecast_{year}_share")

    at = F.lit(computed_at).cast("timestamp") if computed_at else F.current_timestamp()
    named = languages.select("language_key", "language_name")
    return (
        fit.join(named, "language_key", "left")
        .select(
            "language_key",
            F.round("slope", 4).alias("slope_pct_per_year"),
            F.round("r2", 4).alias("r_squared"),
            *map(forecast, forecast_years),
            ladder(F.col("slope"), V.TREND_LABELS, V.TREND_BELOW, "gt").alias("trend_label"),
            "language_name",
            at.alias("computed_at"),
        )
        .orderBy(F.desc("slope_pct_per_year"))
    )
