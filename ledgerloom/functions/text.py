"""Cleansing and formatting of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digits_only(text: str | Column) -> Column:
    """Phone cleansing: everything but 0-9 is removed."""
    return F.regexp_replace(text, "[^0-9]", "")


def clean_name(text: str | Column) -> Column:
    return F.upper(F.trim(text))


def padded_id(prefix: str, number: str | Column, width: int) -> Column:
    """``prefix`` and the number, zero-filled on the left; null when the number is null.

    A number with more digits than ``width`` is kept whole, so ids never repeat.
    """
    digits = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def short_id(text: str | Column, keep: int = 8) -> Column:
    return F.concat(F.substring(text, 1, keep), F.lit("..."))


def clock(ts: str | Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def amount_label(amount: str | Column, currency: str | Column) -> Column:
    """Grouped thousands and at most three decimals, followed by the currency."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    currency = F.col(currency) if isinstance(currency, str) else currency
    grouped = F.call_function("format_number", amount, F.lit("#,##0.###"))
    return F.concat(grouped, F.lit(" "), currency)


def iso_timestamp(ts: str | Column) -> Column:
    """ISO text with a ``T``; fractions only as far as they are set."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.translate(ts.cast("string"), " ", "T")


def normalise_headers(names: list[str]) -> list[str]:
    """Lower-cased and trimmed; runs on column names only."""
    return [name.lower().strip() for name in names]
