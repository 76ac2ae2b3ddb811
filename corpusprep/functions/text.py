"""Text expressions: tagged and delimited text, list parsing, word tokens.

All of these are built-in Spark expressions, so they stay inside
whole-stage codegen; none needs a Python worker.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that Python's ``str.strip()`` removes (derived by rule, not typed).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# The text of a missing cell, the separator of delimited
# text, the preview length and the word pattern.
NULL_TEXT = "nan"
DELIMITER = " | "
PREVIEW_CHARS = 250
WORD_PATTERN = r"[\p{L}\p{N}]+"


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()`` on a string column."""
    return F.btrim(c, F.lit(WHITESPACE))


def as_text(c: Column, null_text: str = NULL_TEXT) -> Column:
    """Stringify a cell; a missing value becomes ``null_text``."""
    return F.coalesce(c.cast("string"), F.lit(null_text))


def tagged_text(cols: Sequence[str], present: Sequence[str] | Mapping[str, Column] | None = None,
                null_text: str = NULL_TEXT) -> Column:
    """``[COL] value`` for each column in order, joined by one space.

    A column that is absent contributes its tag followed by a space and
    nothing else. ``present`` names the columns of the frame, or gives for
    each of them the condition under which the row's group has it.
    ``concat_ws`` drops nulls, so values are coalesced first.
    """
    has = present if isinstance(present, Mapping) else {c: None for c in (cols if present is None else present)}
    parts = []
    for c in cols:
        tag = F.lit(f"[{c.upper()}] ")
        if c not in has:
            parts.append(tag)
            continue
        value = F.concat(tag, strip_ws(as_text(F.col(c), null_text)))
        parts.append(value if has[c] is None else F.when(has[c], value).otherwise(tag))
    return F.concat_ws(" ", *parts)


def delimited_text(cols: Sequence[str], sep: str = DELIMITER,
                   null_text: str = NULL_TEXT) -> Column:
    """Values of ``cols`` as text joined by ``sep`` (nulls become ``null_text``)."""
    return F.concat_ws(sep, *[as_text(F.col(c), null_text) for c in cols])


def preview(c: Column, n: int = PREVIEW_CHARS) -> Column:
    return F.substring(c, 1, n)


def csv_list(c: Column, keep_blank: bool = False) -> Column:
    """Split on commas and trim; blanks are dropped unless ``keep_blank``."""
    items = F.transform(F.split(c, ","), lambda x: strip_ws(x))
    return items if keep_blank else F.filter(items, lambda x: x != F.lit(""))


def word_tokens(c: Column) -> Column:
    """Lower-cased runs of letters and digits (the uncased word step)."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD_PATTERN), 0)


def file_stem(c: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(c, r"\.[^.]+$", "")
