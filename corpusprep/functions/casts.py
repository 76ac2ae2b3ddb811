"""Safe casts with defaults, applied to columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words read as true / false by the boolean cast.
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")


def safe_int(c: Column, default: int | None = None) -> Column:
    return F.coalesce(c.try_cast("bigint"), F.lit(default).cast("bigint"))


def safe_float(c: Column, default: float | None = None) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(default).cast("double"))


def safe_bool(c: Column, default: bool | None = False) -> Column:
    v = F.lower(c.cast("string"))
    return (F.when(v.isin(*TRUE_WORDS), F.lit(True))
            .when(v.isin(*FALSE_WORDS), F.lit(False))
            .otherwise(F.lit(default).cast("boolean")))


def safe_json(c: Column, schema: str, default: Column | None = None) -> Column:
    """Parse JSON text into ``schema`` (DDL); text that is not such JSON, and null, give ``default``."""
    parsed = F.from_json(c, schema, {"mode": "PERMISSIVE"})
    ok = F.try_parse_json(c).isNotNull() & parsed.isNotNull()
    return F.coalesce(F.when(ok, parsed), F.lit(None) if default is None else default)
