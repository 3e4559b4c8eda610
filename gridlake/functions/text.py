r"""Whole-text expressions: line handling, fences, tokens.

Everything here stays in the row (or in a narrow explode of the row), so a document
never leaves its task and no line-level data is shuffled to find out whether a line
lies inside a fenced block.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that end a line (a carriage return and line feed pair
# counts once) and those that are trimmed as blank.
LINE_ENDS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
BLANKS = (
    "\t\x1f \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)


def unix_lines(text: Column) -> Column:
    r"""Every kind of line end as ``\n``. Texts that hold no other kind are passed through
    after plain substring tests, which cost far less than a regular-expression scan."""
    other = reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in LINE_ENDS])
    return F.when(other, F.regexp_replace(text, rf"\r\n|[{LINE_ENDS}]", "\n")).otherwise(text)


def strip(line: Column) -> Column:
    """Drop blank characters at both ends of one line."""
    return F.btrim(line, F.lit(BLANKS))


def strip_all(text: Column) -> Column:
    """Drop blanks and line ends at both ends of a whole text."""
    return F.btrim(text, F.lit(BLANKS + LINE_ENDS + "\n"))


def code_shape(text: Column) -> Column:
    """Text without ``#`` comment lines and blank lines, every line trimmed."""
    lines = F.transform(F.split(unix_lines(text), "\n", -1), strip)
    kept = F.filter(lines, lambda line: (line != "") & ~F.startswith(line, F.lit("#")))
    return F.array_join(kept, "\n")


def line_total(text: Column) -> Column:
    r"""Number of ``\n``-terminated lines, counting an unterminated last one."""
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    open_end = (text != "") & ~F.endswith(text, F.lit("\n"))
    return (breaks + open_end.cast("int")).cast("long")


def text_outside(text: Column, fence: str) -> Column:
    r"""The text without its fenced blocks: of a fence line and of what it encloses only the line breaks
    stay, so every other line keeps its number. Texts that do not hold the fence at all are passed
    through after a substring test."""
    breaks = lambda s: F.length(s) - F.length(F.replace(s, F.lit("\n"), F.lit("")))
    segments = F.split(unix_lines(text), rf"(?m)^[{BLANKS}]*{re.escape(fence)}[^\n]*$", -1)
    # Every second segment is fenced.
    kept = F.transform(segments, lambda s, i: F.when(i % 2 == 0, s).otherwise(F.repeat(F.lit("\n"), breaks(s))))
    return F.when(F.contains(text, F.lit(fence)), F.array_join(kept, "")).otherwise(unix_lines(text))


def lines_outside(text: Column, fence: str) -> Column:
    """Array of the lines outside fenced blocks, each at its place (other lines read as empty)."""
    return F.split(text_outside(text, fence), "\n", -1)


def explode_lines_outside(df: DataFrame, key: str, text: str, fence: str) -> DataFrame:
    """``(key, line_no, line)``, 1-based as in the text. Lines of fenced blocks read as empty."""
    lines = df.select(key, F.posexplode(lines_outside(F.col(text), fence)).alias("i", "line"))
    return lines.select(key, (F.col("i") + 1).cast("long").alias("line_no"), "line")


def is_comment(line: Column, opening: str = "<!--", closing: str = "-->") -> Column:
    bare = strip(line)
    return F.startswith(bare, F.lit(opening)) | F.endswith(bare, F.lit(closing))
