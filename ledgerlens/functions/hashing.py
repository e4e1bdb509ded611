"""Content ids, stable bucket numbers and hash shares, all as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = 1 << 32


def md5_word(digest: Column, index: int) -> Column:
    """The ``index``-th 32-bit word of an md5 hex digest, as bigint."""
    return F.conv(F.substring(digest, 1 + 8 * index, 8), 16, 10).cast("bigint")


def md5_mod(col: Column, n: int | Column) -> Column:
    """``md5(col)`` read as one 128-bit number, modulo ``n`` (``n`` < 2**31).

    Horner's rule over four 32-bit words keeps every step inside a bigint,
    which is about five times faster than going through decimals.
    """
    digest = F.md5(col)
    modulus = F.lit(n).cast("bigint") if isinstance(n, int) else n.cast("bigint")
    rest = md5_word(digest, 0) % modulus
    for index in (1, 2, 3):
        rest = (rest * F.lit(_WORD) + md5_word(digest, index)) % modulus
    return rest.cast("int")


def content_id(*cols: str) -> Column:
    """SHA-256 of the ``||``-joined columns, nulls read as empty text."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(F.col(c), F.lit("")) for c in cols]), 256)


def hash_word(key: Column, seed: int) -> Column:
    """A 32-bit hash of the row key; the same for any partitioning or retry."""
    return md5_word(F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string"))), 0)


def hash_share(key: Column, seed: int) -> Column:
    """``hash_word`` scaled to [0, 1)."""
    return hash_word(key, seed) / F.lit(float(_WORD))
