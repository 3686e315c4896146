"""Padding, n-gram keys and their prefixes and suffixes.

A gram or context is keyed by its tokens joined with U+001F.  `joinable`
escapes that character inside tokens, so the key is one-to-one; the model
works on escaped tokens throughout and `readable` undoes it for display.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

START = "<START>"
END = "<END>"
SEPARATOR = "\x1f"
ESCAPE = "\x1e"


def pad_tokens(tokens: Column, n: int) -> Column:
    """n-1 start markers, the tokens, one end marker."""
    start = F.array_repeat(F.lit(START), n - 1)
    return F.concat(start, tokens, F.array(F.lit(END)))


def joinable(tokens: Column) -> Column:
    """Tokens with U+001F and U+001E escaped; nearly always the tokens themselves."""

    def escape(token: Column) -> Column:
        escaped = F.replace(token, F.lit(ESCAPE), F.lit(ESCAPE + "e"))
        return F.replace(escaped, F.lit(SEPARATOR), F.lit(ESCAPE + "s"))

    reserved = F.exists(tokens, lambda t: t.contains(SEPARATOR) | t.contains(ESCAPE))
    return F.when(reserved, F.transform(tokens, escape)).otherwise(tokens)


def readable(token: Column) -> Column:
    """The token text behind a `joinable` token."""
    unescaped = F.replace(token, F.lit(ESCAPE + "s"), F.lit(SEPARATOR))
    return F.replace(unescaped, F.lit(ESCAPE + "e"), F.lit(ESCAPE))


def gram_key(tokens: Column) -> Column:
    return F.array_join(tokens, SEPARATOR)


def _substring_index(key: Column, count: Column) -> Column:
    return F.call_function("substring_index", key, F.lit(SEPARATOR), count.cast("int"))


def key_prefix(key: Column, length: Column) -> Column:
    """Key of the first `length` tokens."""
    return _substring_index(key, length)


def key_suffix(key: Column, length: Column) -> Column:
    """Key of the last `length` tokens."""
    return _substring_index(key, -length)



def extended_key(ctx: Column, length: Column, target: Column) -> Column:
    """Key of a context of `length` tokens and the token after it."""
    return F.when(length > 0, F.concat(ctx, F.lit(SEPARATOR), target)).otherwise(target)
