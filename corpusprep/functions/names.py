"""Worksheet-name normalisation (used by the skip list)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusprep.functions.text import strip_ws

# The name fragments removed anywhere in a sheet name, in the
# order the loader removes them.
NAME_PREFIXES = ("aws_", "amazon_")


def normalize_name(c: Column, prefixes: Sequence[str] = NAME_PREFIXES) -> Column:
    """trim, lower, then remove every occurrence of each fragment in turn."""
    out = F.lower(strip_ws(c))
    for p in prefixes:
        out = F.replace(out, F.lit(p), F.lit(""))
    return out


def normalize_name_py(name: str, prefixes: Sequence[str] = NAME_PREFIXES) -> str:
    out = name.strip().lower()
    for p in prefixes:
        out = out.replace(p, "")
    return out
