"""Random draws that depend only on a salt and row keys, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = 4294967296.0  # 2^32: eight hex digits


def digest(salt: str, *keys: Column | str) -> Column:
    """128-bit digest of the salt and keys; slice it for up to four draws."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(salt), *[p.cast("string") for p in parts]))


def draw(digest_col: Column, slot: int = 0) -> Column:
    """32-bit integer draw from one of the four slots of a digest."""
    return F.conv(F.substring(digest_col, 1 + 8 * slot, 8), 16, 10).cast("bigint")


def uniform(salt: str, *keys: Column | str, slot: int = 0) -> Column:
    """Uniform draw in [0, 1)."""
    return draw(digest(salt, *keys), slot) / F.lit(_SPAN)


def open_uniform(salt: str, *keys: Column | str, slot: int = 0) -> Column:
    """Uniform draw in the open interval (0, 1), for laws that diverge at 0."""
    return (draw(digest(salt, *keys), slot) + F.lit(0.5)) / F.lit(_SPAN)
