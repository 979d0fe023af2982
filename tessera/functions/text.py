"""Text expressions that keep the reference's record and token rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE_BREAK = r"\r\n|\n|\r"


def split_lines(text: Column) -> Column:
    """Lines of a text the way a line reader sees a file: ``\\n``, ``\\r\\n`` and ``\\r`` end a line,
    and a final line terminator does not start an empty last line. An empty text has no lines."""
    parts = F.split(text, LINE_BREAK, -1)
    ends_with_break = text.endswith("\n") | text.endswith("\r")
    return (
        F.when(text == "", F.array().cast("array<string>"))
        .when(ends_with_break, F.slice(parts, 1, F.size(parts) - 1))
        .otherwise(parts)
    )


def space_tokens(line: Column) -> Column:
    """Tokens of ``line.split(" ")`` under Java's rule: split on every single space, drop trailing
    empty tokens, keep leading and inner ones; the empty line yields one empty token."""
    trimmed = F.rtrim(line)
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " ", -1))
    )


def utf16_length(s: Column) -> Column:
    """Length in UTF-16 code units (Java ``String.length``)."""
    return (F.octet_length(F.encode(s, "UTF-16BE")) / 2).cast("bigint")
