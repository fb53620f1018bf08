from rillworks.functions.json_nodes import (  # noqa: F401
    BAD,
    SURELY_TEXT,
    double_sql,
    elements_sql,
    field_sql,
    int_sql,
    malformed_sql,
    parse_fields_sql,
    parse_typed_sql,
    read_fields,
    settle,
    surely_double,
    surely_int,
    surely_text,
    text_sql,
)
from rillworks.functions.numbers import let, strict_int  # noqa: F401
