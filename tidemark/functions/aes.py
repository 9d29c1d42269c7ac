"""Deterministic AES-256-CBC columns, which still join and group."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F

from tidemark.functions.hashing import derive_key

IV_BYTES = 16
LIMB_HEX = 16


def aes_cbc_det(col: Column, key: Column, iv: Column) -> Column:
    """Ciphertext bytes under a fixed IV: equal input gives equal output."""
    sealed = F.aes_encrypt(col.cast("string").cast("binary"), key, F.lit("CBC"), F.lit("PKCS"), iv)
    # the built-in puts the IV in front
    return F.substring(sealed, IV_BYTES + 1, F.lit(2**31 - 1))


def aes_cbc_det_decrypt(cipher: Column, key: Column, iv: Column) -> Column:
    return F.aes_decrypt(F.concat(iv, cipher), key, F.lit("CBC"), F.lit("PKCS")).cast("string")


def cipher_to_limbs(cipher: Column) -> Column:
    """Ciphertext as unsigned 64-bit numbers; a single decimal cannot hold 128 bits."""
    groups = F.regexp_extract_all(F.hex(cipher), F.lit(f"[0-9A-F]{{{LIMB_HEX}}}"), F.lit(0))
    return F.transform(groups, lambda g: F.conv(g, 16, 10).cast("decimal(20,0)"))


def limbs_to_cipher(limbs: Column) -> Column:
    groups = F.transform(limbs, lambda n: F.lpad(F.conv(n.cast("string"), 10, 16), LIMB_HEX, "0"))
    return F.unhex(F.array_join(groups, ""))


def key_from_alias(alias: str, secrets: Mapping[str, str] | Callable[[str], str]) -> bytes:
    """32-byte key from a named secret held outside the job."""
    return derive_key(secrets(alias) if callable(secrets) else secrets[alias])
