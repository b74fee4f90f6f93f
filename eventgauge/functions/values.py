"""Expressions on single values: missing, normalised, invalid, ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventgauge.settings import as_list

# ---------------------------------------------------------------------------
# Fixed values.
# ---------------------------------------------------------------------------
ZERO_UUID = "00000000-0000-0000-0000-000000000000"
NULL_WORD = "null"
NULL_DIMENSION = "NULL"
NO_COLUMN = "NO_COLUMN"
MISSING_LABEL = "<MISSING>"
NUMBER_PATTERN = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]|[nN][aA][nN])$"
# ---------------------------------------------------------------------------


def quoted(column: str) -> str:
    """A column name for use inside an SQL expression."""
    return "`" + column.replace("`", "``") + "`"


def text(column: str) -> Column:
    return F.expr(f"cast({quoted(column)} as string)")


def _missing_sql(value: str) -> str:
    """Cheap length and prefix tests come first: few values need a new string."""
    return (
        f"coalesce({value} = '' or {value} = '{ZERO_UUID}'"
        f" or (octet_length({value}) = {len(NULL_WORD)} and lower({value}) = '{NULL_WORD}')"
        f" or (startswith({value}, ' ') and trim({value}) = ''), true)"
    )


def is_missing(column: str) -> Column:
    """NULL, only spaces, the all-zero UUID or the word ``null``; never NULL itself."""
    return F.expr(_missing_sql(f"cast({quoted(column)} as string)"))


def normalized(column: str) -> Column:
    """The untrimmed text of a value, or NULL where it counts as missing."""
    value = f"cast({quoted(column)} as string)"
    return F.expr(f"case when not {_missing_sql(value)} then {value} end")


def first_present(aliases: Sequence[str], available: Sequence[str]) -> tuple[Column, list[str]]:
    """The first alias that holds a value, and the aliases that exist."""
    present = [name for name in aliases if name in available]
    if not present:
        return F.lit(None).cast("string"), []
    return F.coalesce(*[normalized(name) for name in present]), present


def as_number(value: Column) -> Column:
    """A strict number: no blanks around it, no type suffix; otherwise NULL."""
    return F.when(value.rlike(NUMBER_PATTERN), value.try_cast("double"))


def is_invalid(value: Column, rule: Mapping[str, Any], default_invalid: Sequence[str]) -> Column:
    """Whether a present value breaks a rule; false for a rule without conditions.

    The rule is configuration, so every list, pattern and limit is a literal and
    the whole test stays inside generated code.
    """
    listed = as_list(rule.get("invalid_values"))
    invalid = list(default_invalid) if listed is None else listed
    allowed = as_list(rule.get("allowed_values")) or []
    lowered = F.lower(value)
    conditions: list[Column] = []
    if invalid:
        conditions.append(lowered.isin([word.lower() for word in invalid]))
    if allowed:
        conditions.append(~lowered.isin([word.lower() for word in allowed]))
    if rule.get("allowed_pattern"):
        conditions.append(~value.rlike(str(rule["allowed_pattern"])))
    number = as_number(value)
    if rule.get("min_value") is not None:
        conditions.append(number.isNull() | (number < float(rule["min_value"])))
    if rule.get("max_value") is not None:
        above = (number > float(rule["max_value"])) & ~F.isnan(number)
        conditions.append(number.isNull() | above)
    if not conditions:
        return F.lit(False)
    return reduce(lambda left, right: left | right, conditions)


def first_valid(
    aliases: Sequence[str],
    available: Sequence[str],
    rule: Mapping[str, Any],
    default_invalid: Sequence[str],
) -> tuple[Column, list[str]]:
    """The first alias that holds a valid value, else the first that holds any.

    An identifier whose populated aliases are all invalid keeps its first value, so
    that it is still reported as invalid rather than as missing.
    """
    present = [name for name in aliases if name in available]
    if len(present) < 2:
        return first_present(aliases, available)
    values = [normalized(name) for name in present]
    valid = [F.when(~is_invalid(v, rule, default_invalid), v) for v in values]
    return F.coalesce(*valid, *values), present


def dimension(column: str, available: Sequence[str]) -> Column:
    """A grouping label that tells an empty value from an absent column."""
    if column not in available:
        return F.lit(NO_COLUMN)
    return F.expr(f"coalesce(nullif(cast({quoted(column)} as string), ''), '{NULL_DIMENSION}')")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL where the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def pct(part: Column, whole: Column) -> Column:
    """A ratio rounded to six digits."""
    return F.round(ratio(part, whole), 6)


def sum_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("long")


def any_table(column: str, tables: Sequence[str]) -> Column:
    """Whether a table name is in a configured list; false for an empty list."""
    return F.col(column).isin(list(tables)) if tables else F.lit(False)
