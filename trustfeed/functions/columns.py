"""Column expressions shared by the operators. All JVM-side built-ins (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pg_concat(*parts) -> Column:
    """String concatenation where NULL counts as the empty string (PostgreSQL)."""
    return F.concat_ws("", *[_c(p) for p in parts])


def id_head(x) -> Column:
    """Part of a compound id ``profile-pub`` before the first dash ('' if none)."""
    x = _c(x)
    return x.substr(F.lit(1), F.instr(x, "-") - F.lit(1))


def id_tail(x) -> Column:
    """Part of a compound id after the first dash (whole string if none)."""
    x = _c(x)
    return x.substr(F.instr(x, "-") + F.lit(1), F.lit(2147483647))


def try_bool(x) -> Column:
    """Text to boolean; unparseable text becomes NULL instead of failing."""
    return _c(x).try_cast("boolean")


def uniform_u32(key, seed: str = "") -> Column:
    """Repeatable uniform integer in [0, 2^32) from md5(key || seed).

    The same value is ``CAST('0x' || substr(md5(key || seed), 1, 8) AS BIGINT)``
    in DuckDB, so samples built on it have exact oracles.
    """
    k = F.concat(_c(key).cast("string"), F.lit(seed))
    return F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint")


def uniform01(key, seed: str = "") -> Column:
    """Repeatable uniform double in (0, 1): (u32 + 0.5) / 2^32."""
    return (uniform_u32(key, seed).cast("double") + F.lit(0.5)) / F.lit(TWO_POW_32)


def dtime_to_timestamp(dtime) -> Column:
    """Packed run id YYYYMMDDHHMMSS (bigint) to a timestamp."""
    return F.to_timestamp(F.lpad(_c(dtime).cast("string"), 14, "0"), "yyyyMMddHHmmss")
