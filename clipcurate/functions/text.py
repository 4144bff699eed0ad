"""Text expressions; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code-point ranges that count as white space, U+001C to U+001F included.
WHITESPACE_RANGES = (
    (0x0009, 0x000D),
    (0x001C, 0x0020),
    (0x0085, 0x0085),
    (0x00A0, 0x00A0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)
WHITESPACE = "".join(chr(c) for low, high in WHITESPACE_RANGES for c in range(low, high + 1))

# The code-point block of the Gujarati script.
GUJARATI = (0x0A80, 0x0AFF)


def clean_text(text: Column) -> Column:
    """Drop `>`, turn pipes into spaces, collapse white space and strip the ends.

    One pass maps every white-space character to a space, which leaves the pattern only the rare runs of
    spaces to find; a character class of all of them costs twice the time.
    """
    plain = F.translate(text, f"|{WHITESPACE}>", " " * (1 + len(WHITESPACE)))
    return F.trim(F.regexp_replace(plain, " {2,}", " "))


def strip_whitespace(text: Column) -> Column:
    """Strip Unicode white space from both ends only."""
    return F.trim(text, F.lit(WHITESPACE))


def characters(text: Column) -> Column:
    """The code points of a text, in order, as an array of strings; an empty text has none."""
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(text, ""))


def strip_outer_quotes(text: Column) -> Column:
    return F.trim(text, F.lit('"'))


def preview(text: Column, size: int = 60) -> Column:
    return F.substring(text, 1, size)


def in_script(char: Column, low: int = GUJARATI[0], high: int = GUJARATI[1]) -> Column:
    return F.ascii(char).between(low, high)


def only_script(text: Column, low: int = GUJARATI[0], high: int = GUJARATI[1]) -> Column:
    """The text without any character outside the code-point range."""
    return F.regexp_replace(text, f"[^\\x{{{low:04X}}}-\\x{{{high:04X}}}]+", "")


def word_count(text: Column) -> Column:
    """Words of a cleaned text."""
    cleaned = clean_text(text)
    return F.when(F.length(cleaned) == 0, F.lit(0)).otherwise(F.size(F.split(cleaned, " ")))


def length_band(words: Column) -> Column:
    """Expected synthesis quality by word count; a count on two bands takes the lower one."""
    return (
        F.when(words < 5, "poor")
        .when(words <= 15, "decent")
        .when(words <= 30, "good")
        .otherwise("good_with_artifacts")
    )
