"""Masking rules as column expressions; all run inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.hashing import as_column


def keep(col: Column) -> Column:
    return col


def nullify(col: Column) -> Column:
    return F.nullif(col, col)


def mask_fixed(col: Column, mask_char: str = "X") -> Column:
    return F.repeat(F.lit(mask_char), F.length(col.cast("string")))


def mask_lastn(col: Column, n: int = 4, mask_char: str = "X") -> Column:
    """Show only the last ``n`` characters; a value that short is masked whole."""
    text = col.cast("string")
    hidden = F.repeat(F.lit(mask_char), F.length(text) - n)
    return F.when(F.length(text) <= n, mask_fixed(col, mask_char)).otherwise(
        F.concat(hidden, F.right(text, F.lit(n))))


def mask_firstn(col: Column, n: int = 4, mask_char: str = "X") -> Column:
    """Show only the first ``n`` characters; a value that short is masked whole."""
    text = col.cast("string")
    hidden = F.repeat(F.lit(mask_char), F.length(text) - n)
    return F.when(F.length(text) <= n, mask_fixed(col, mask_char)).otherwise(
        F.concat(F.left(text, F.lit(n)), hidden))


def hash_deterministic(col: Column, salt: str | Column, max_length: int | None = None) -> Column:
    """Salted SHA-256 in hex, cut to the column's declared length."""
    digest = F.sha2(F.concat(as_column(salt), col.cast("string")), 256)
    return F.left(digest, F.lit(max_length)) if max_length else digest
