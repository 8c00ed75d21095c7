from millrace.functions.literals import list_literal, parse_list
from millrace.functions.text import (
    base64_text,
    default_to,
    datetime_value,
    first_group,
    lookup,
    null_tokens,
    path_join,
    quote_datetimes,
    replace_all,
)

__all__ = [
    "base64_text",
    "datetime_value",
    "default_to",
    "first_group",
    "list_literal",
    "lookup",
    "null_tokens",
    "parse_list",
    "path_join",
    "quote_datetimes",
    "replace_all",
]
