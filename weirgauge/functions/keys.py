"""Row identity: fingerprints and stable hash buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import SPLIT_SHARES
from .cells import ref

NULL_MARK = "\\N"
FIELD_MARK = "|"
HASH_SPACE = 2**32


def key_text(columns) -> Column:
    """Text of several columns in which NULL differs from every value."""
    parts = [c if isinstance(c, Column) else ref(c) for c in columns]
    return F.concat_ws(
        FIELD_MARK, *[F.coalesce(p.cast("string"), F.lit(NULL_MARK)) for p in parts]
    )


def fingerprint(columns) -> Column:
    return F.sha2(key_text(columns), 256)


def hash_word(columns) -> Column:
    """Eight hex digits that depend on the key alone.

    Unlike a random draw they do not change with partitioning, retries or lost
    executors, so rows with equal keys always land on the same side.
    """
    return F.substring(F.md5(key_text(columns)), 1, 8)


def hash_point(columns) -> Column:
    """The hash word as an integer in [0, 2**32)."""
    return F.conv(hash_word(columns), 16, 10).cast("bigint")


def split_at(word: Column, shares=SPLIT_SHARES) -> Column:
    """Split of a hash word: the hash space is cut at the cumulative shares.

    Words of one length order as the numbers they spell, so none is converted.
    """
    upper, picks = 0.0, []
    for name, share in shares[:-1]:
        upper += share
        cut = int(round(upper, 9) * HASH_SPACE)
        below = word < f"{cut:08x}" if cut < HASH_SPACE else F.lit(True)
        picks.append(F.when(below, F.lit(name)))
    return F.coalesce(*picks, F.lit(shares[-1][0]))


def split_name(columns, shares=SPLIT_SHARES) -> Column:
    """Split chosen by the hash of a key."""
    return split_at(hash_word(columns), shares)

