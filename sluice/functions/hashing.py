"""Seeded SHA-256 keys: total orders, remainders, request seeds and splits that any engine can reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: int | Column, *parts: Column) -> Column:
    """Hex SHA-256 of "seed:part:part..."."""
    first = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    return F.sha2(F.concat_ws(":", first, *(p.cast("string") for p in parts)), 256)


def order_key(seed: int | Column, *parts: Column) -> Column:
    """16 hex digits that sort as the digest's first eight bytes do as an unsigned number."""
    return F.substring(digest(seed, *parts), 1, 16)


def remainder(seed: int | Column, n: int | Column, *parts: Column) -> Column:
    """The digest's first eight bytes as an unsigned number, modulo n."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(F.conv(order_key(seed, *parts), 16, 10).cast("decimal(20,0)"), n.cast("decimal(20,0)")).cast("long")


def request_seed(seed: int | Column, request_id: Column) -> Column:
    """31 bits of the digest's first four bytes."""
    return F.conv(F.substring(digest(seed, request_id), 1, 8), 16, 10).cast("long").bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).cast("int")


def marker(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 20)


def one_in_ten(group: Column) -> Column:
    """True where the first byte of the group's digest is below 26."""
    return F.conv(F.substring(F.sha2(group.cast("string"), 256), 1, 2), 16, 10).cast("int") < 26
