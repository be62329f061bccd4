"""Numeric helpers (C2, C3) and number-to-text formatting used by C5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms a float parser accepts.  Plain decimal with
# optional sign, fraction and exponent, or inf / infinity / nan (optionally
# signed, in any letter case); nothing else (no blanks, no line end, no type
# suffix, no hex).
FLOAT_TEXT_PATTERN = r"^([+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|[+-]?(?i:inf|infinity))\z"
NAN_TEXT_PATTERN = r"^[+-]?(?i:nan)\z"
SQL_FLOAT_TEXT_PATTERN = "([+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|[+-]?([iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY]))"
SQL_NAN_TEXT_PATTERN = "[+-]?[nN][aA][nN]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_price(text) -> Column:
    """Text -> double; anything a strict float parser rejects -> 0.0.

    The guard is needed because a SQL cast is lenient (blanks, ``1.0d``)."""
    t = _col(text)
    return (
        F.when(t.rlike(NAN_TEXT_PATTERN), F.lit(float("nan")))  # a SQL cast reads no signed nan
        .when(t.rlike(FLOAT_TEXT_PATTERN), F.coalesce(t.try_cast("double"), F.lit(0.0)))
        .otherwise(F.lit(0.0))
    )


def sql_parse_price(text: str) -> str:
    return (f"CASE WHEN regexp_full_match({text}, '{SQL_NAN_TEXT_PATTERN}') THEN 'nan'::DOUBLE "
            f"WHEN regexp_full_match({text}, '{SQL_FLOAT_TEXT_PATTERN}') "
            f"THEN coalesce(TRY_CAST({text} AS DOUBLE), 0.0) ELSE 0.0 END")


def hlc3(high="high", low="low", close="close") -> Column:
    """Typical price."""
    return (_col(high) + _col(low) + _col(close)) / F.lit(3.0)


def _shortest(x) -> tuple[Column, Column, Column, Column]:
    """Sign, digits text without exponent and trailing ``.0``, its digits alone,
    and the exponent (null without one) of a double's shortest text."""
    text = _col(x).cast("string")
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    body = F.regexp_replace(text, "^-", "")
    mantissa = F.regexp_replace(F.split_part(body, F.lit("E"), F.lit(1)), r"\.0$", "")
    exponent = F.when(body.rlike("^[0-9.]+E"), F.split_part(body, F.lit("E"), F.lit(2)).try_cast("int"))
    return sign, mantissa, F.replace(mantissa, F.lit("."), F.lit("")), exponent


def display_number(x) -> Column:
    """Plain decimal text of a double: shortest digits, no exponent, and a
    whole number printed without ``.0`` (the form used in trade text).  The
    point of the shortest text is moved by its exponent; no digit is lost."""
    sign, mantissa, digits, e = _shortest(x)
    whole = e + 1
    large = F.when(F.length(digits) <= whole, F.rpad(digits, F.greatest(whole, F.lit(1)), F.lit("0"))).otherwise(
        F.concat(F.substring(digits, F.lit(1), whole), F.lit("."), F.substring(digits, e + 2, F.lit(400)))
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    plain = F.when(e.isNull(), mantissa).when(e >= 0, large).otherwise(small)
    return F.when(_col(x).isNotNull(), F.concat(sign, plain))


def debug_number(x) -> Column:
    """Debug text of a double: like display, but whole numbers keep ``.0``, and
    from 1e16 up or below 1e-4 the form is digits and exponent."""
    v, d = _col(x), display_number(x)
    sign, mantissa, _, e = _shortest(x)
    scientific = (F.abs(v) >= F.lit(1e16)) | ((v != 0) & (F.abs(v) < F.lit(1e-4)))
    return (
        F.when(scientific & e.isNotNull(), F.concat(sign, mantissa, F.lit("e"), e.cast("string")))
        .when(d.contains(".") | d.contains("N") | d.contains("I"), d)
        .otherwise(F.concat(d, F.lit(".0")))
    )


def sql_display_number(x: str) -> str:
    """The exact decimal expansion of the shortest digits, from DuckDB's own shortest text."""
    t = f"CAST(abs({x}) AS VARCHAR)"
    mantissa = f"regexp_replace(split_part({t}, 'e', 1), '\\.0$', '')"
    e = f"CAST(split_part({t}, 'e', 2) AS INT)"
    digits = f"replace({mantissa}, '.', '')"
    fraction = f"(length({digits}) - 1)"
    large = (f"CASE WHEN {fraction} <= {e} THEN {digits} || repeat('0', {e} - {fraction}) "
             f"ELSE left({digits}, {e} + 1) || '.' || substr({digits}, {e} + 2) END")
    small = f"'0.' || repeat('0', -{e} - 1) || {digits}"
    body = f"CASE WHEN NOT contains({t}, 'e') THEN {mantissa} WHEN {e} >= 0 THEN {large} ELSE {small} END"
    return f"(CASE WHEN {x} < 0 THEN '-' ELSE '' END || ({body}))"


def sql_debug_number(x: str) -> str:
    t, d = f"CAST(abs({x}) AS VARCHAR)", sql_display_number(x)
    mantissa = f"regexp_replace(split_part({t}, 'e', 1), '\\.0$', '')"
    scientific = f"CASE WHEN {x} < 0 THEN '-' ELSE '' END || {mantissa} || 'e' || CAST(CAST(split_part({t}, 'e', 2) AS INT) AS VARCHAR)"
    return (f"CASE WHEN abs({x}) >= 1e16 OR ({x} <> 0 AND abs({x}) < 1e-4) THEN {scientific} "
            f"WHEN contains({d}, '.') THEN {d} ELSE {d} || '.0' END")
