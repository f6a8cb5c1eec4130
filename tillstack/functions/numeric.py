"""Numeric and conditional rules as Column expressions (NUM1-4, NUM6)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillstack import fixed_values as FV
from tillstack.functions.text import _c, drop_thousands, strip_ws

# A plain decimal or scientific number; anything else (``1d``, ``nan``,
# ``inf``, ``-``, blanks) is treated as missing, like a coercing parse.
_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def lenient_number(c) -> Column:
    """NUM1: text → double; unparseable → null.  Thousands commas removed."""
    t = strip_ws(drop_thousands(_c(c)))
    return F.when(t.rlike(_NUMBER), t.try_cast("double"))


def round_half_even_2(c) -> Column:
    """NUM2: round to 2 places, half-to-even on the binary value (numpy)."""
    return F.rint(_c(c) * 100.0) / 100.0


def amount(c) -> Column:
    return round_half_even_2(lenient_number(c))


def payment_type(cash, gcash) -> Column:
    """NUM3 on the text form of the cash / gcash cells.

    ``cash`` / ``gcash`` are Columns or None when the column is absent: a
    missing cash column reads as ``0`` and a missing gcash column as ``-``;
    a null cell reads as ``nan``.
    """
    cash_t = (F.coalesce(_c(cash), F.lit(FV.MISSING_TEXT)) if cash is not None
              else F.lit(FV.MISSING_CASH_TEXT))
    gcash_t = (F.coalesce(_c(gcash), F.lit(FV.MISSING_TEXT)) if gcash is not None
               else F.lit(FV.NOT_PAID_TEXT))
    return (
        F.when(cash_t.isin(FV.CASH_FREE_TEXTS), F.lit(FV.PAYMENT_FREE))
        .when(cash_t != FV.NOT_PAID_TEXT, F.lit(FV.PAYMENT_CASH))
        .when(gcash_t != FV.NOT_PAID_TEXT, F.lit(FV.PAYMENT_GCASH))
        .otherwise(F.lit(FV.PAYMENT_CARD))
    )


def null_false(c: Column) -> Column:
    """A predicate where null counts as false (pandas mask semantics)."""
    return F.coalesce(c, F.lit(False))
