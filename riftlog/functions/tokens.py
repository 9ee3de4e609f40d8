"""Column expressions over message and sequence text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riftlog.config import WILDCARD
from riftlog.functions.parsing import strip

# A token that holds a digit; the look-behind keeps the scan linear.
_DIGIT_TOKEN = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"
# Two or more letters, digits of any script, or underscores.
_WORD = r"[\p{L}\p{N}_]{2,}"


def shape_of(message: Column) -> Column:
    """Message with single blanks between tokens and every token that holds a
    digit replaced by the wildcard. Null for a message of blanks only."""
    masked = F.regexp_replace(strip(message), _DIGIT_TOKEN, WILDCARD)
    return F.nullif(F.regexp_replace(masked, r"\s+", " "), F.lit(""))


def token_count(shape: Column) -> Column:
    return F.length(shape) - F.length(F.replace(shape, F.lit(" "), F.lit(""))) + 1


def first_token(shape: Column) -> Column:
    return F.substring_index(shape, " ", 1)


def words(text: Column) -> Column:
    """Lower-case words of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))
