"""Column-level functions (JVM-side expressions, no Python UDFs)."""

from tallyframe.functions.exact import avg_half_even, half_even_div, share_half_even
from tallyframe.functions.text import (
    casefold_key,
    lines_of,
    money_text,
    pad_left,
    pad_right,
    py_repr,
    regex_literal,
    replacement_literal,
    url_quote,
    ustrip,
)
from tallyframe.functions.values import (
    amount_from_text,
    amount_from_variant,
    date_from_text,
)

__all__ = [
    "amount_from_text", "amount_from_variant", "avg_half_even", "casefold_key",
    "date_from_text", "half_even_div", "lines_of", "money_text", "pad_left",
    "pad_right", "py_repr", "regex_literal", "replacement_literal",
    "share_half_even", "url_quote", "ustrip",
]
