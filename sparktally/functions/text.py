"""Word splitting."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Fixed delimiter set: white space, double quote, comma, parentheses, star.
# A full stop or a slash stays inside its word.
TOKEN_DELIMITERS = ' \t\r\n",()*'


_NAMED = {"\t": r"\t", "\r": r"\r", "\n": r"\n"}


def token_array(text: Column, delimiters: str = TOKEN_DELIMITERS) -> Column:
    """Lower-cased words; may hold empty strings at the ends, null for null."""
    members = "".join(_NAMED.get(c) or re.escape(c) for c in delimiters)
    return F.split(F.lower(text), f"[{members}]+")
