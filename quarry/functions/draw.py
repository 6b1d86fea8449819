"""Deterministic, partitioning-independent random draws.

Every random choice in the library is a hash of ``(seed, key, salt)``, so a
result never depends on partition layout or task retries and can be restated
in another SQL engine (SHA-1 is available everywhere).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_60 = float(2 ** 60)
TWO_64 = float(2 ** 64)


def draw(seed: int, key, salt: str = "") -> Column:
    """60-bit unsigned draw: first 15 hex digits of sha1('seed|key|salt')."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.sha1(F.concat_ws("|", F.lit(str(seed)), k.cast("string"), F.lit(salt)))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def draw_sql(seed: int, key_sql: str, salt: str = "") -> str:
    """The same draw as DuckDB SQL text (used by the oracle queries)."""
    return f"('0x' || substr(sha1('{seed}' || '|' || CAST({key_sql} AS VARCHAR) || '|' || '{salt}'), 1, 15))::BIGINT"


def uniform(seed: int, key, salt: str = "") -> Column:
    return draw(seed, key, salt) / F.lit(TWO_60)


def bucket(seed: int, key, k, salt: str = "") -> Column:
    """A draw from 0 to ``k`` - 1 (a number or a column)."""
    return F.pmod(draw(seed, key, salt), F.lit(k))


def sha1_unit(c) -> Column:
    """First 8 bytes of SHA-1 as an unsigned 64-bit integer / 2^64 (a double)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(F.sha1(c), 1, 16), 16, 10).cast("double") / F.lit(TWO_64)


def hash_split(c, valid_ratio: float) -> Column:
    """'valid' when the text's SHA-1 unit value is below the ratio, else 'train'."""
    if not 0.0 <= valid_ratio < 1.0:
        raise ValueError("valid_ratio must be in [0, 1)")
    return F.when(sha1_unit(c) < F.lit(valid_ratio), F.lit("valid")).otherwise(F.lit("train"))
