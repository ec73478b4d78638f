"""Line and word splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_lines(text: Column) -> Column:
    """The lines a text-file reader would see: LF, CR or CRLF ends a line, and a final line end
    does not start another line."""
    unix = F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")) \
        .otherwise(text)
    body = F.when(F.endswith(unix, F.lit("\n")), F.left(unix, F.length(unix) - 1)).otherwise(unix)
    # a single-character separator needs no regular expression
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))


def split_words(line: Column, drop_trailing: bool = True) -> Column:
    """Words between single spaces; neighbouring spaces enclose empty words.

    With ``drop_trailing`` empty words at the end of the line are left out, so a line of spaces
    only has no word, while an empty line has one empty word. Without it all are kept.
    """
    if not drop_trailing:
        return F.split(line, " ", -1)
    trimmed = F.rtrim(line)
    return F.when(
        (trimmed == "") & (line != ""), F.array().cast("array<string>")
    ).otherwise(F.split(trimmed, " ", -1))
