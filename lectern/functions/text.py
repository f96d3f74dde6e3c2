"""Array-producing text functions: the three ways an article is cut into chunks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.schemas import FIXED_CHUNK_CHARS, WHITESPACE_CHUNK_CHARS, WINDOW_OVERLAP, WINDOW_TOKENS

# The white-space class of the warehouse's regular expressions.
SPACE = r"[\t\n\f\r ]"
NOT_SPACE = r"[^\t\n\f\r ]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whitespace_chunk_pattern(size: int) -> str:
    """Pattern whose group 1 is the next chunk.

    A chunk is at most ``size`` characters of one line plus the white space that ends it. Text with
    no break for more than ``size`` characters keeps only its last ``size``. The optional first
    group jumps over the part that is lost in one step; without it a long unbroken run would be
    retried from each of its characters, which costs run length times ``size``.
    """
    end = rf"(?:{SPACE}|\z)"
    lost = rf"(?:{NOT_SPACE}+(?={NOT_SPACE}{{{size}}}{end}))?+"
    return rf"{lost}([^\n]{{1,{size}}}{end})"


def whitespace_chunks(text: Column | str, size: int = WHITESPACE_CHUNK_CHARS) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(whitespace_chunk_pattern(size)), F.lit(1))


def fixed_slices(text: Column | str, size: int = FIXED_CHUNK_CHARS) -> Column:
    """Consecutive slices of ``size`` characters; '' and null give an empty array."""
    t = _col(text)
    length = F.coalesce(F.char_length(t), F.lit(0))
    starts = F.sequence(F.lit(1), F.greatest(length, F.lit(1)), F.lit(size))
    return F.when(length > 0, F.transform(starts, lambda i: F.substring(t, i, F.lit(size)))).otherwise(
        F.array().cast("array<string>")
    )


def tokens(text: Column | str) -> Column:
    """White-space tokens."""
    return F.array_remove(F.split(_col(text), SPACE + "+"), "")


def token_windows(
    token_list: Column | str, size: int = WINDOW_TOKENS, overlap: int = WINDOW_OVERLAP
) -> Column:
    """Overlapping windows over a token array, each joined by one space.

    The last window is the first that reaches the end of the text.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    words = _col(token_list)
    count = F.coalesce(F.size(words), F.lit(0))
    starts = F.sequence(F.lit(1), F.greatest(count - overlap, F.lit(1)), F.lit(size - overlap))
    return F.when(
        count > 0, F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(size)), " "))
    ).otherwise(F.array().cast("array<string>"))
