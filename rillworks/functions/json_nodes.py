"""Reading loosely typed JSON fields with fixed defaults.

A field can be missing, null, or of any JSON kind, and each case has its own
result. A field parsed as VARIANT tells them apart: SQL NULL means missing, a
variant null means an explicit null. Functions named ``*_sql`` take and give
SQL text, see :mod:`rillworks.functions.numbers`.

Limits: integers of more than 38 digits keep double precision, and ``-0.0``
reads as ``0.0``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillworks.functions.numbers import (
    double_in_text,
    int_from_double,
    int_in_text,
    let,
    low_32_bits,
)

BAD = "_bad"

# Spellings that mean the same as a number and as a text, and texts that start
# unlike a number, an object or an array.
_SURELY_INT = r"^(0|-?[1-9][0-9]{0,8})$"
_SURELY_DOUBLE = r"^-?(0|[1-9][0-9]{0,14})(\.[0-9]{1,15})?$"
SURELY_TEXT = r"^[^-0-9{\[]"

_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": BAD,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def parse_typed_sql(text: str, columns: Sequence[str]) -> str:
    """Struct of the given DDL columns, plus the bad text."""
    ddl = ", ".join([*columns, f"`{BAD}` string"])
    options = ", ".join(f"'{k}', '{v}'" for k, v in _OPTIONS.items())
    return f"from_json({text}, '{ddl}', map({options}))"


def parse_fields_sql(text: str, fields: Sequence[str]) -> str:
    """Struct of the named top-level fields as variants, plus the bad text."""
    return parse_typed_sql(text, [f"`{name}` variant" for name in fields])


def malformed_sql(text: str, node: str | None = None) -> str:
    """Not JSON at all. Empty text and non-objects are legal: no fields.

    Read as plain text, so neither the fields that are asked for nor a setting
    for repeated names has a say. What is no object is read as a field of one.
    ``node``, parsed from the same text before, only saves the work.
    """
    plain = f"{parse_typed_sql(text, ['`_any` string'])}.{BAD} IS NOT NULL"
    wrapped = f"concat('{{\"_any\":', {text}, '}}')"
    inner = f"{parse_typed_sql(wrapped, ['`_any` string'])}.{BAD} IS NOT NULL"
    seen = f"{node}.{BAD} IS NOT NULL AND " if node else ""
    return f"({text} IS NULL OR ({seen}{plain} AND {inner}))"


def field_sql(node: str, name: str) -> str:
    """A field of a variant; SQL NULL when missing or not an object."""
    return f"try_variant_get({node}, '$.{name}', 'variant')"


def _get(node: str, kind: str) -> str:
    return f"try_variant_get({node}, '$', '{kind}')"


def _by_kind(node: str, body: str) -> str:
    """``body`` on a variant ``v`` and the name ``k`` of its kind."""
    return let(node, "v", let("schema_of_variant(v)", "k", body))


_NESTED = "(startswith(k, 'OBJECT<') OR startswith(k, 'ARRAY<'))"
# A whole number beyond bigint.
_WIDE = f"(endswith(k, ',0)') AND {_get('v', 'bigint')} IS NULL)"


def text_sql(node: str) -> str:
    """Missing and nested give '', null gives 'null', scalars their text."""
    return _by_kind(
        node,
        f"""CASE WHEN k IN ('STRING', 'BIGINT', 'BOOLEAN') THEN {_get('v', 'string')}
                 WHEN k = 'VOID' THEN 'null'
                 WHEN k IS NULL OR {_NESTED} THEN ''
                 WHEN {_WIDE} THEN {_get('v', 'string')}
                 ELSE string({_get('v', 'double')}) END""",
    )


def int_sql(node: str) -> str:
    """Missing, null and nested give 0; wide numbers wrap, fractions are cut."""
    wide = f"bigint(pmod({_get('v', 'decimal(38,0)')}, decimal({2**32})))"
    return _by_kind(
        node,
        f"""CASE WHEN k = 'BIGINT' THEN {low_32_bits(_get('v', 'bigint'))}
                 WHEN k = 'STRING' THEN {int_in_text(_get('v', 'string'))}
                 WHEN k = 'BOOLEAN' THEN int({_get('v', 'boolean')})
                 WHEN k IS NULL OR k = 'VOID' OR {_NESTED} THEN 0
                 WHEN {_WIDE} THEN {low_32_bits(wide)}
                 ELSE {int_from_double(_get('v', 'double'))} END""",
    )


def double_sql(node: str) -> str:
    """Missing, null, nested and unreadable text give 0.0."""
    number = _by_kind(
        node,
        f"""CASE WHEN k = 'STRING' THEN {double_in_text(_get('v', 'string'))}
                 WHEN k = 'BOOLEAN' THEN double({_get('v', 'boolean')})
                 WHEN k IS NULL OR k = 'VOID' OR {_NESTED} THEN 0.0D
                 ELSE {_get('v', 'double')} END""",
    )
    return f"coalesce({number}, 0.0D)"


def elements_sql(node: str) -> str:
    """The members of an array, the values of an object, else no elements."""
    return let(
        node,
        "v",
        f"""coalesce({_get('v', 'array<variant>')},
                     map_values({_get('v', 'map<string,variant>')}),
                     cast(array() AS array<variant>))""",
    )


def surely_int(text: Column, null_is_zero: bool = True) -> Column:
    """A field parsed to text that reads as the same int whatever its kind was.

    NULL stands for missing or null, which both read as 0.
    """
    certain = text.rlike(_SURELY_INT)
    return text.isNull() | certain if null_is_zero else certain


def surely_double(text: Column) -> Column:
    """The same for a double."""
    return text.isNull() | text.rlike(_SURELY_DOUBLE)


def surely_text(text: Column) -> Column:
    """The same for a text; NULL leaves open which default applies."""
    return text.rlike(SURELY_TEXT)


def settle(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that later filters and joins read rather than recompute.

    A condition on a plain computed column is pushed below it by repeating its
    expression, here one JSON parse per mention. It stops at a generator.
    """
    kept = [c for c in df.columns if c not in columns]
    made = df.select(*kept, *[c.alias(f"_{name}") for name, c in columns.items()])
    row = F.struct(*[F.col(f"_{name}").alias(name) for name in columns])
    return made.select(*kept, F.inline(F.array(row)))


def read_fields(
    df: DataFrame,
    text: str,
    ints: Mapping[str, str] | None = None,
    texts: Mapping[str, str] | None = None,
    missing: str = "default",
) -> DataFrame:
    """Add top-level JSON fields as columns, and ``malformed`` for the text.

    ``ints`` and ``texts`` map new columns to fields. A missing field gives the
    default of its type, or NULL with ``missing='null'``.

    Nearly all records spell numbers as numbers and texts as texts. A parse to
    plain text settles those, where no other JSON kind could have led to the
    same text; only the other records are parsed as variants.
    """
    ints, texts = ints or {}, texts or {}
    fields = [*ints.values(), *texts.values()]
    quick = parse_typed_sql(text, [f"`{f}` string" for f in fields])
    got = F.col("_quick")
    sure = got.isNotNull() & got[BAD].isNull()
    for f in ints.values():
        sure = sure & surely_int(got[f], null_is_zero=missing != "null")
    for f in texts.values():
        sure = sure & surely_text(got[f])

    def value(sql: str, f: str) -> str:
        return f"if(node.`{f}` IS NOT NULL, {sql}, NULL)" if missing == "null" else sql

    slowly = [f"'malformed', {malformed_sql(text, 'node')}"]
    slowly += [f"'{c}', {value(int_sql(f'node.`{f}`'), f)}" for c, f in ints.items()]
    slowly += [f"'{c}', {value(text_sql(f'node.`{f}`'), f)}" for c, f in texts.items()]
    slow = let(parse_fields_sql(text, fields), "node", f"named_struct({', '.join(slowly)})")
    checked = (
        df.withColumn("_quick", F.expr(quick))
        .withColumn("_sure", F.coalesce(sure, F.lit(False)))
        .withColumn("_slow", F.expr(f"if(_sure, NULL, {slow})"))
    )
    sure, slow = F.col("_sure"), F.col("_slow")
    columns = {"malformed": ~sure & slow["malformed"]}
    for c, f in ints.items():
        zero = None if missing == "null" else 0
        quickly = F.coalesce(got[f].try_cast("int"), F.lit(zero))
        columns[c] = F.when(sure, quickly).otherwise(slow[c])
    for c, f in texts.items():
        columns[c] = F.when(sure, got[f]).otherwise(slow[c])
    return settle(checked, columns).drop("_quick", "_sure", "_slow")
