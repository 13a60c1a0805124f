"""Hashes that decide on splits, ids and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def head32(hex_digest: Column) -> Column:
    """The first 32 bits of a hexadecimal digest as a number."""
    return F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("long")


def stable_split(group: Column, seed: int, train: float = 0.70, validation: float = 0.85) -> Column:
    """train, validation or test by a hash of seed and group; the bounds are cumulative. Null groups give null."""
    u = head32(F.sha2(F.concat(F.lit(f"{seed}:"), group), 256)) / F.lit(float(0xFFFFFFFF))
    return F.when(group.isNotNull(), F.when(u < train, "train").when(u < validation, "validation").otherwise("test"))


def calibration_half(group: Column, seed: int) -> Column:
    """Divides a validation group: 'calibration' if the hash is odd, else 'validation'."""
    return F.when(head32(F.sha2(F.concat(F.lit(f"calibration:{seed}:"), group), 256)) % 2 == 1, "calibration").otherwise("validation")


def bucket_split(group: Column, train: int = 75, validation: int = 88) -> Column:
    """train, validation or test by sha1 modulo 100."""
    b = head32(F.sha1(group)) % 100
    return F.when(group.isNotNull(), F.when(b < train, "train").when(b < validation, "validation").otherwise("test"))


def id_set_hash(ids: Column) -> Column:
    """Aggregate: a fingerprint of a set of ids that does not depend on their order.

    Each id's 256-bit hash is cut into eight words that are summed, so the state of
    a group is eight numbers however many ids it has.
    """
    digest = F.sha2(ids.cast("string"), 256)
    words = [F.lower(F.lpad(F.hex(F.sum(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")).bitwiseAND(0xFFFFFFFF)), 8, "0")) for i in range(8)]
    return F.concat(*words)


def short_id(text: Column, length: int = 16) -> Column:
    return F.left(F.sha1(text), F.lit(length))


def numbered_id(number: Column, content: Column, prefix: str = "case") -> Column:
    """prefix, number of three digits, and eight digits of the content's hash."""
    return F.concat(F.lit(f"{prefix}_"), F.lpad(number.cast("string"), 3, "0"), F.lit("_"), F.left(F.sha2(content, 256), F.lit(8)))
