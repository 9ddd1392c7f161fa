"""Column expressions for derived portfolio measures.

Everything returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen. Null handling follows the application's
``when``/``otherwise`` ladders exactly: a null input falls through every test
and lands in the last label (see ``band``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import BUREAU_COLS
from . import labels as L

DAYS_PER_YEAR = 365.25


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(value: Column, bounds: Sequence[tuple[float, str]], other: str,
         inclusive: bool = False) -> Column:
    """First label whose bound the value is below (``<=`` when inclusive);
    ``other`` for everything else, null included."""
    expr = None
    for bound, label in bounds:
        test = value <= F.lit(bound) if inclusive else value < F.lit(bound)
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    return expr.otherwise(other)


def band_from_top(value: Column, bounds: Sequence[tuple[float, str]], other: str) -> Column:
    """First label whose minimum the value reaches (``>=``); ``other`` below
    the last minimum. Null stays null (no label is claimed for it)."""
    expr = None
    for bound, label in bounds:
        test = value >= F.lit(bound)
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    return F.when(value.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(other))


# --- P1/P2 ------------------------------------------------------------------
def age_years(days_birth: str | Column = "DAYS_BIRTH") -> Column:
    return -_c(days_birth) / F.lit(DAYS_PER_YEAR)


def age_band(age: str | Column | None = None) -> Column:
    age = age_years() if age is None else _c(age)
    return band(age, L.AGE_BANDS, L.AGE_OTHER)


# --- P3 ---------------------------------------------------------------------
def credit_income_ratio(credit: str | Column = "AMT_CREDIT",
                        income: str | Column = "AMT_INCOME_TOTAL") -> Column:
    """Credit over income rounded to 2 places; null when income is 0 (no
    ANSI divide-by-zero failure)."""
    return F.round(F.try_divide(_c(credit), _c(income)), 2)


# --- P4/P5 ------------------------------------------------------------------
def years_employed(days: str | Column = "DAYS_EMPLOYED") -> Column:
    """Tenure in years; the 'not employed' sentinel counts as 0. Null stays
    null (and so lands in the top employment band)."""
    d = _c(days)
    return F.when(d == F.lit(L.UNEMPLOYED_DAYS), F.lit(0.0)).otherwise(-d / F.lit(DAYS_PER_YEAR))


def employment_band(years: str | Column | None = None) -> Column:
    years = years_employed() if years is None else _c(years)
    return band(years, L.EMPLOYMENT_BANDS, L.EMPLOYMENT_OTHER)


# --- P6/P7 ------------------------------------------------------------------
def total_enquiries(cols: Sequence[str] = BUREAU_COLS) -> Column:
    """Sum of the bureau enquiry counters, null counted as 0."""
    total = None
    for c in cols:
        term = F.coalesce(F.col(c), F.lit(0))
        total = term if total is None else total + term
    return total


def enquiry_band(total: str | Column | None = None) -> Column:
    total = total_enquiries() if total is None else _c(total)
    ladder = band(total, L.ENQUIRY_BANDS, L.ENQUIRY_OTHER, inclusive=True)
    return F.when(total == F.lit(0), L.ENQUIRY_NONE).otherwise(ladder)


# --- P8 ---------------------------------------------------------------------
def realty_label(flag: str | Column = "FLAG_OWN_REALTY") -> Column:
    """Y/N to the ownership label; any other value (null included) -> null."""
    f = _c(flag)
    expr = None
    for code, label in L.REALTY_LABELS.items():
        expr = F.when(f == code, label) if expr is None else expr.when(f == code, label)
    return expr


# --- P9 ---------------------------------------------------------------------
def weekday_rank(day: str | Column = "WEEKDAY_APPR_PROCESS_START", strict: bool = True) -> Column:
    """Monday=0 .. Sunday=6, case-insensitive; a null day ranks 0. An unknown
    name fails the query when ``strict`` (as the application does), else
    ranks null."""
    d = _c(day)
    pos = F.array_position(F.array(*[F.lit(w) for w in L.WEEKDAYS]), F.upper(d))
    unknown = (F.raise_error(F.concat(F.lit("unknown weekday: "), d)).cast("long")
               if strict else F.lit(None).cast("long"))
    return (F.when(d.isNull(), F.lit(0))
             .when(pos > 0, pos - 1)
             .otherwise(unknown)).cast("int")


# --- P10 --------------------------------------------------------------------
def is_default(target: str | Column = "TARGET") -> Column:
    """1 for a defaulted application, 0 otherwise (null counts as 0)."""
    return F.when(_c(target) == 1, 1).otherwise(0)


def default_rate(target: str | Column = "TARGET") -> Column:
    """Aggregate: percent of defaults, 2 places."""
    return F.round(F.avg(is_default(target)) * 100, 2)


# --- P15/P16 ----------------------------------------------------------------
def age_whole_years(days_birth: str | Column = "DAYS_BIRTH") -> Column:
    """Completed years of age (truncated toward zero); null stays null."""
    return (-_c(days_birth) / F.lit(DAYS_PER_YEAR)).cast("int")


def report_years_employed(days: str | Column = "DAYS_EMPLOYED") -> Column:
    """Tenure for the client report: null and the sentinel both give 0."""
    d = _c(days)
    return (F.when(d.isNull() | (d == F.lit(L.UNEMPLOYED_DAYS)), F.lit(0.0))
             .otherwise(-d.cast("double") / F.lit(DAYS_PER_YEAR)))
