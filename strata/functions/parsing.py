"""Tolerant parsers as Column expressions (no Python per row).

They never raise: anything that does not parse becomes NULL (or FALSE for
``is_catalogued``); deciding whether to drop or warn is the job of a rule.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.util import as_col

# The series codes the catalogue accepts (1 = dollar rate,
# 11 = Selic rate, 433 = IPCA inflation).
CATALOGUED_SERIES = (1, 11, 433)

# A plain decimal number as Python's float() reads it (after the comma swap).
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_SPECIAL = r"^[+-]?(?i)(inf|infinity|nan)$"
# d/M/yyyy with one- or two-digit day and month and a four-digit year other than 0000.
_DATE_BR = r"^(0?[1-9]|[12][0-9]|3[01])/(0?[1-9]|1[0-2])/(?!0000)[0-9]{4}$"
_INTEGER = r"^[+-]?[0-9]+$"


def strip_ws(c: Column) -> Column:
    """Trim leading/trailing whitespace (space, tab, newline, CR, FF, VT)."""
    return F.btrim(c, F.lit(" \t\n\r\f\u000b"))


def parse_brl(c) -> Column:
    """String (or number) -> double.

    '4.90' -> 4.9; '1.234,56' -> 1234.56; '12,5' -> 12.5. A comma marks the
    Brazilian format: dots are thousands separators and the comma is the
    decimal mark. NULL, blank and unparsable text give NULL.
    """
    s = strip_ws(as_col(c).cast("string"))
    # the swap can expose new edge whitespace ('0, .' -> '0. '), so trim again
    s = F.when(s.contains(","), strip_ws(F.regexp_replace(F.regexp_replace(s, r"\.", ""), ",", "."))).otherwise(s)
    ok = s.rlike(_NUMBER) | s.rlike(_SPECIAL)
    return F.when(ok, s.try_cast("double"))


def parse_date_br(c) -> Column:
    """'dd/MM/yyyy' text -> DATE; impossible dates (31/02) and junk -> NULL."""
    s = strip_ws(as_col(c).cast("string"))
    return F.when(s.rlike(_DATE_BR), F.try_to_date(s, "d/M/yyyy"))


def parse_month_br(c) -> Column:
    """'MM/yyyy' reference month -> first day of that month (DATE) or NULL."""
    return parse_date_br(F.concat(F.lit("01/"), strip_ws(as_col(c).cast("string"))))


def is_catalogued(c, codes: Iterable[int] = CATALOGUED_SERIES) -> Column:
    """TRUE when the value reads as an integer in ``codes``; FALSE otherwise, never NULL."""
    s = strip_ws(as_col(c).cast("string"))
    n = F.when(s.rlike(_INTEGER), s.try_cast("bigint"))
    return F.coalesce(n.isin(list(codes)), F.lit(False))


def latest_observation(arr, date_field: str = "data") -> Column:
    """Element of an array of structs with the greatest valid date.

    Elements whose date does not parse are ignored; on equal dates the first
    element wins; no valid element gives NULL. Pure higher-order functions, so
    it stays inside generated code.
    """
    a = as_col(arr)

    def key(x, i):
        d = parse_date_br(x[date_field])
        # invalid dates become NULL elements, which array_max skips
        return F.when(d.isNotNull(), F.struct(d.alias("d"), (-i).alias("neg_pos"), x.alias("obs")))
    return F.array_max(F.transform(a, key))["obs"]
