"""Amounts, years and small numbers read from text."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from bazaarlens import fixed_values as fv
from bazaarlens.functions.text import matched, present, search, strip

_NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_SUFFIXED = rf"(?i)^({_NUMBER})(?U:\s*)(thousand|million|billion|mil|mm|k|m|b)?$"
_SCALE = {"k": 1e3, "thousand": 1e3, "m": 1e6, "mil": 1e6, "million": 1e6, "mm": 1e6,
          "b": 1e9, "billion": 1e9}


def number_or_null(c: Column) -> Column:
    """Plain decimal notation only; ``1.0d``, ``nan``, ``.`` and the like give NULL. Nothing that isn't a number is
    cast: an exception behind each NULL costs more than the rest."""
    return matched(c, rf"^(?U:\s*)({_NUMBER})(?U:\s*)$", 1).try_cast("double")


def _bare(c: Column) -> Column:
    return F.translate(c, "$,", "")


def parse_price_base(c: Column) -> Column:
    """An ``m`` anywhere means millions, else a ``k`` anywhere thousands; NULL on failure."""
    s = _bare(F.lower(c))
    millions, thousands = s.contains("m"), s.contains("k")
    digits = F.when(millions, F.replace(s, F.lit("m"))).when(thousands, F.replace(s, F.lit("k"))).otherwise(s)
    return number_or_null(digits) * F.when(millions, 1e6).when(thousands, 1e3).otherwise(1.0)


def parse_price_suffix(c: Column) -> Column:
    """Number plus an optional scale word at the end; 0.0 on failure."""
    s = strip(_bare(c))
    scale_word = F.lower(F.regexp_extract(s, _SUFFIXED, 2))
    scale = F.lit(1.0)
    for factor in (1e3, 1e6, 1e9):
        scale = F.when(scale_word.isin([w for w, f in _SCALE.items() if f == factor]), factor).otherwise(scale)
    return F.coalesce(matched(s, _SUFFIXED, 1).try_cast("double") * scale, F.lit(0.0))


def annualise(monthly: Column) -> Column:
    """D3"""
    return monthly * 12


def per_month_label(monthly: Column) -> Column:
    """D3, card form"""
    return F.concat(F.lit("$"), F.format_number(monthly, 0), F.lit("/month"))


def multiple(price: Column, cash_flow: Column) -> Column:
    """Price over cash flow to two places when both are present and not zero."""
    return F.round(F.try_divide(present(price), present(cash_flow)), 2)


def revenue_from_margin(cash_flow: Column, margin_percent: Column) -> Column:
    """D5"""
    return F.when(margin_percent > 0, F.try_divide(cash_flow, margin_percent / 100))


def revenue_from_margin_label(margin_percent: Column) -> Column:
    """D5, the text kept next to the estimate"""
    return F.when(
        margin_percent > 0,
        F.concat(F.lit("Estimated from "), (margin_percent / 100 * 100).cast("string"), F.lit("% margin")),
    )


def strip_price_label(c: Column, *labels: str) -> Column:
    """The text without its labels, lower case."""
    out = F.lower(c)
    for label in labels:
        out = F.replace(out, F.lit(label), F.lit(""))
    return strip(out)


def labelled_price_text(c: Column, *labels: str) -> Column:
    """The text of an amount behind a label; ``accepting offers`` is 0, not missing."""
    s = strip_price_label(c, *labels)
    return F.when(s.contains("accepting offers"), "0").otherwise(s)


def labelled_price(c: Column, *labels: str) -> Column:
    """D6"""
    return parse_price_base(labelled_price_text(c, *labels))


def year_in_range(text: Column, patterns: Sequence[str], low: int = fv.YEAR_WINDOW[0],
                  high: int = fv.YEAR_WINDOW[1]) -> Column:
    """First pattern whose match lies in the window."""
    years = [F.array(search(text, p).try_cast("int")) for p in patterns]
    return F.coalesce(*[F.get(F.filter(y, lambda one: one.between(low, high)), F.lit(0)) for y in years])


def first_digits(c: Column, pattern: str = r"\d+") -> Column:
    """First run of digits (or first four) in a value."""
    return matched(c, pattern)


def first_int(c: Column, pattern: str = r"\d+") -> Column:
    """D8"""
    return first_digits(c, pattern).try_cast("int")
