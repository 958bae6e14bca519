"""Quoted catering events: clean the exported sheet, monthly metrics per branch, and the
previous / current / next month figures attached to every monthly row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.fixed_values import BOOKING_MONTH_SHIFT_DAYS, WON_STATUS
from branchlens.functions.semantics import (coerce_int, drop_null_keys, iso_date_text,
                                            month_of, parse_currency, parse_day_first_date,
                                            shifted_month, sum_or_zero, title_case, to_double)

WON = WON_STATUS
MONTH_SHIFT_DAYS = BOOKING_MONTH_SHIFT_DAYS


def _money(df: DataFrame, name: str):
    """Currency text is parsed; a column that already arrives numeric passes unchanged."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.col(name).cast("double")
    return parse_currency(name)


def clean_bookings(raw: DataFrame, won: str = WON) -> DataFrame:
    """event_date (yyyy-MM-dd text, null if unparsable), client (title case), branch, menu,
    guests (int, 0 if unparsable), slot, price_per_guest, total (double), month (yyyy-MM)."""
    won_rows = raw.filter(F.col("status") == won)
    iso = iso_date_text(parse_day_first_date("event_date"))
    return won_rows.select(
        iso.alias("event_date"),
        title_case("client").alias("client"),
        "branch", "menu",
        coerce_int("guests").alias("guests"),
        "slot",
        _money(won_rows, "price_per_guest").alias("price_per_guest"),
        _money(won_rows, "total").alias("total"),
        F.substring(iso, 1, 7).alias("month"),
    )


def booking_monthly(clean: DataFrame) -> DataFrame:
    """branch, month, events, guests, income. Rows with a bad date (null month) drop.

    Income is summed as decimal(20,2) (currency has cents) so the total does not depend
    on the order in which partitions are combined. Amounts beyond that type (a mistyped
    cell such as ``1e30``) are added as doubles instead of failing the job;
    ``oversized_amounts`` lists them.
    """
    exact = F.col("total").try_cast("decimal(20,2)")
    beyond = F.sum(F.when(exact.isNull(), F.col("total")))
    return drop_null_keys(clean, ["branch", "month"]).groupBy("branch", "month").agg(
        F.count("event_date").alias("events"),
        F.sum("guests").cast("bigint").alias("guests"),
        (to_double(sum_or_zero(exact, "decimal(20,2)")) + F.coalesce(beyond, F.lit(0.0))).alias("income"))


def oversized_amounts(clean: DataFrame) -> DataFrame:
    """Cleaned rows whose total does not fit decimal(20,2): to be looked at by hand."""
    return clean.filter(F.col("total").isNotNull() & F.col("total").try_cast("decimal(20,2)").isNull())


def booking_metrics(monthly: DataFrame, as_of: dt.date) -> DataFrame:
    """Each (branch, month) row plus that branch's figures for the month 30 days before
    ``as_of``, the month of ``as_of`` and the month 30 days after (0 when absent).

    Runs on the monthly aggregate: the window per branch holds one row per month.
    """
    a = F.lit(as_of)
    months = {"prev": shifted_month(a, -MONTH_SHIFT_DAYS), "cur": month_of(a),
              "next": shifted_month(a, MONTH_SHIFT_DAYS)}
    w = Window.partitionBy("branch")
    cols = [F.col(c) for c in ("branch", "month", "events", "guests", "income")]
    for tag, m in months.items():
        for measure in ("events", "guests", "income"):
            zero = F.lit(0.0) if measure == "income" else F.lit(0).cast("bigint")
            cols.append(F.coalesce(F.sum(F.when(F.col("month") == m, F.col(measure))).over(w), zero)
                        .alias(f"{measure}_{tag}"))
    return monthly.select(*cols)
