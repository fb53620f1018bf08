"""Numbers written as text, as SQL expressions.

The functions take and give SQL text: the larger expressions are nested deeply,
and Spark parses a text far faster than Python builds the same tree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN = -(2**31)
INT_MAX = 2**31 - 1

_BLANKS = "'" + "".join(f"\\u{c:04x}" for c in range(33)) + "'"
_DECIMAL = r"r'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?$'"
_SPECIAL = "'^[+-]?(NaN|Infinity)$'"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once.

    The value is the start of an aggregate over nothing, the body its finish.
    """
    return f"aggregate(array(), {value}, (held, none) -> held, {name} -> {body})"


def strict_int(text: Column) -> Column:
    """Sign and digits only, no blanks, in int range; NULL otherwise."""
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))


def double_in_text(text: str) -> str:
    """The double a text spells once its outer blanks are gone, else NULL."""
    spelled = f"t RLIKE {_DECIMAL} OR t RLIKE {_SPECIAL}"
    return let(
        f"btrim({text}, {_BLANKS})", "t", f"CASE WHEN {spelled} THEN try_cast(t AS DOUBLE) END"
    )


def int_in_text(text: str) -> str:
    """The int a text spells, else 0.

    Whole numbers must fit; anything with a fraction or an exponent is read as
    a double and cut to range.
    """
    whole = "coalesce(try_cast(t AS INT), 0)"
    other = int_from_double(double_in_text("t"))
    return let(
        f"regexp_replace(btrim({text}, {_BLANKS}), r'^\\+', '')",
        "t",
        f"CASE WHEN t RLIKE '^-?[0-9]+$' THEN {whole} ELSE {other} END",
    )


def int_from_double(number: str) -> str:
    """Cut towards zero, held to int range; 0 for NULL and NaN."""
    return let(
        number,
        "d",
        f"""CASE WHEN d IS NULL OR isnan(d) THEN 0
                 WHEN d >= {INT_MAX}D THEN {INT_MAX}
                 WHEN d <= {INT_MIN}D THEN int({INT_MIN})
                 ELSE try_cast(d AS INT) END""",
    )


def low_32_bits(number: str) -> str:
    """A bigint reduced to the int its low 32 bits spell."""
    return let(
        f"({number}) & {2**32 - 1}L",
        "low",
        f"int(CASE WHEN low > {INT_MAX} THEN low - {2**32}L ELSE low END)",
    )
