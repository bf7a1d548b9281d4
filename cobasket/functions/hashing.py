"""Pseudo-random choices that any engine can repeat.

``rand`` and ``sample`` depend on how rows happen to be partitioned, so a retried task may choose other rows. A
choice made from the md5 of a row's key does not.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEED = 42


def hash_text(*cols: str | Column, seed: int = SEED) -> Column:
    """The leading 32 bits of the md5 of the key columns in hexadecimal, which sort as the numbers do."""
    text = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols],
                       F.lit(str(seed)))
    return F.substring(F.md5(text), 1, 8)


def key_hash(*cols: str | Column, seed: int = SEED) -> Column:
    """:func:`hash_text` as a bigint."""
    return F.conv(hash_text(*cols, seed=seed), 16, 10).cast("bigint")


def unit_hash(*cols: str | Column, seed: int = SEED) -> Column:
    """:func:`key_hash` scaled to [0, 1)."""
    return key_hash(*cols, seed=seed).cast("double") / F.lit(4294967296.0).cast("double")


def percent_bucket(*cols: str | Column, seed: int = SEED) -> Column:
    """A bucket from 0 to 99."""
    return key_hash(*cols, seed=seed) % 100
