from qualia.functions.text import (
    col_of,
    normalize_method_col,
    percent_text_sql,
    py_float_sql,
    quote_ident,
    split_params_col,
    strip_ws,
)

__all__ = [
    "col_of",
    "normalize_method_col",
    "percent_text_sql",
    "py_float_sql",
    "quote_ident",
    "split_params_col",
    "strip_ws",
]
