"""Text expressions: tokenisers, blank tests, routing by token length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes the tokenisers split on.
# Non-word split (ASCII word characters are [A-Za-z0-9_]).
NON_WORD = r"\W+"
# Single whitespace character, one split per character.
ONE_WHITESPACE = r"\s"
# StringTokenizer's default delimiters: space, tab, newline, carriage
# return, form feed.
TOKENIZER_DELIMS = "[ \t\n\r\f]+"
# Whitespace removed from each token afterwards (adds vertical tab).
TOKEN_WHITESPACE = "[ \t\n\u000b\f\r]"
# Characters at or below U+0020 count as blank, as in a Java trim().
BLANK = r"^[\x00-\x20]*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonword_tokens(text: Column | str) -> Column:
    """Array of lower-cased tokens split on non-word runs; empties removed."""
    parts = F.split(F.lower(_c(text)), NON_WORD)
    return F.filter(parts, lambda t: t != F.lit(""))


def whitespace_tokens(text: Column | str) -> Column:
    """Split on every single whitespace character.

    Leading and inner empty tokens are kept; trailing empty tokens are
    dropped (the text is right-trimmed of whitespace before splitting).
    """
    trimmed = F.regexp_replace(_c(text), r"\s+$", "")
    return F.split(trimmed, ONE_WHITESPACE)


def delimiter_tokens(text: Column | str) -> Column:
    """Tokens between default tokenizer delimiters, whitespace stripped and
    lower-cased; empty tokens removed."""
    parts = F.split(_c(text), TOKENIZER_DELIMS)
    cleaned = F.transform(parts, lambda t: F.lower(F.regexp_replace(t, TOKEN_WHITESPACE, "")))
    return F.filter(cleaned, lambda t: t != F.lit(""))


def is_blank(c: Column | str) -> Column:
    """Null, empty, or only characters <= U+0020."""
    c = _c(c)
    return c.isNull() | c.rlike(BLANK)


def token_route(token: Column | str, max_len: int = 5) -> Column:
    """'kept' for 1..max_len characters, 'rejected' above, null for empty."""
    n = F.length(_c(token))
    return (F.when(n > max_len, F.lit("rejected"))
            .when(n > 0, F.lit("kept")))
