"""Keyed hashes as column expressions, and secrets that stay out of query plans."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, SparkSession, functions as F


def secret_column(spark: SparkSession, value: str | bytes) -> Column:
    """One secret value as a subquery column, so no literal shows in explain or event logs."""
    kind = "string" if isinstance(value, str) else "binary"
    row = value if isinstance(value, str) else bytearray(value)
    return spark.createDataFrame([(row,)], f"secret {kind}").scalar()


def as_column(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def hex_limb(hex_text: Column, index: int, digits: int = 8) -> Column:
    """The ``index``-th group of hex digits as a number."""
    return F.conv(F.substring(hex_text, 1 + digits * index, digits), 16, 10)


def digest_mod(hex_digest: Column, modulus: int) -> Column:
    """A 256-bit hex digest modulo a small number, by Horner's rule over 32-bit parts."""
    rest = F.lit(0).cast("bigint")
    for index in range(8):
        rest = (rest * F.lit(1 << 32) + hex_limb(hex_digest, index).cast("bigint")) % F.lit(modulus)
    return rest


def derive_key(secret: str) -> bytes:
    """A 32-byte key from a pass phrase."""
    return hashlib.sha256(secret.encode("utf-8")).digest()
