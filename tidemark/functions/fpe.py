"""Format-preserving encryption of digits and alphanumerics.

The reversible ciphers run in Arrow UDFs: the key stays in the closure, so it is in no
plan, and one HMAC call per round beats a fold of SQL hash expressions.
"""

from __future__ import annotations

import hashlib
import hmac
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

from tidemark.functions.arrow import series_udf
from tidemark.functions.hashing import digest_mod, hex_limb

# fixed values of the digit cipher
ROUNDS = 10
# an HMAC-SHA-256 has 32 bytes, one per digit of the left half; more digits take numbered blocks
BLOCK_DIGITS = 32
AES_ROUNDS = 6
# halves of more digits than fit decimal(38) after a 32-bit shift are added in groups of digits
DECIMAL_DIGITS, GROUP_DIGITS = 27, 9

LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
DIGITS = "0123456789"


def _round_hashes(key: bytes) -> list[tuple]:
    """Per round, SHA-256 states that have taken in the HMAC pads of the round key."""
    states = []
    for r in range(ROUNDS):
        # the round key is hex text of exactly one hash block
        round_key = hashlib.sha256(f"{key.hex()}{r}".encode()).hexdigest().encode()
        states.append(tuple(hashlib.sha256(bytes(b ^ pad for b in round_key)) for pad in (0x36, 0x5C)))
    return states


def _stream(parts: np.ndarray, width: int, state: tuple) -> np.ndarray:
    """``width`` digits of HMAC for each row of digits."""
    inner, outer = state
    text, step, out = (parts + ord("0")).astype(np.uint8).tobytes(), parts.shape[1], []
    blocks = max(1, -(-width // BLOCK_DIGITS))
    for start in range(0, len(text), step):
        for block in range(blocks):
            first, second = inner.copy(), outer.copy()
            first.update(text[start:start + step])
            if block:
                first.update(f":{block}".encode())
            second.update(first.digest())
            out.append(second.digest())
    return np.frombuffer(b"".join(out), np.uint8).reshape(len(parts), 32 * blocks)[:, :width] % 10


def _encrypt_rows(rows: np.ndarray, states: list[tuple]) -> np.ndarray:
    mid = rows.shape[1] // 2
    for state in states:
        left, right = rows[:, :mid], rows[:, mid:]
        rows = np.hstack([right, (left + _stream(right, mid, state)) % 10])
    return rows


def _decrypt_rows(rows: np.ndarray, states: list[tuple]) -> np.ndarray:
    mid = rows.shape[1] // 2
    for state in reversed(states):
        right, left = rows[:, :rows.shape[1] - mid], rows[:, rows.shape[1] - mid:]
        rows = np.hstack([(left + 10 - _stream(right, mid, state)) % 10, right])
    return rows


def _numeric(key: bytes, cipher):
    """UDF: apply ``cipher`` to the digits and put them back between the other characters.

    Values of one digit count form a matrix, so only the hashing is a loop.
    """
    def change(values: pd.Series) -> pd.Series:
        states = _round_hashes(key)
        digits = values.str.replace("[^0-9]", "", regex=True)
        done = values.copy()
        for size, group in digits.groupby(digits.str.len()):
            size = int(size)
            if size < 2:
                continue
            rows = np.frombuffer("".join(group).encode(), np.uint8).reshape(-1, size) - ord("0")
            text = (cipher(rows, states) + ord("0")).astype(np.uint8).tobytes().decode()
            done[group.index] = [text[i:i + size] for i in range(0, len(text), size)]
        framed = values.str.len() != digits.str.len()
        done[framed] = [_framed(old, new) for old, new in zip(values[framed], done[framed])]
        return done

    return series_udf(change)


def _framed(old: str, new: str) -> str:
    """The digits of ``new`` in the digit places of ``old``."""
    digits = iter(re.findall("[0-9]", new))
    return re.sub("[0-9]", lambda _: next(digits), old)


def fpe_numeric_encrypt(col: Column, key: bytes) -> Column:
    """Ten Feistel rounds over the digits; punctuation keeps its place."""
    return cipher_udf("numeric_encrypt", key)(col.cast("string"))


def fpe_numeric_decrypt(col: Column, key: bytes) -> Column:
    """Inverse of :func:`fpe_numeric_encrypt`."""
    return cipher_udf("numeric_decrypt", key)(col.cast("string"))


def _alnum(key: bytes, sign: int):
    """UDF: shift letters and digits by a keystream of their place; values of one length form a matrix."""
    stream: list[int] = []  # grows to the longest value of the task

    def change(values: pd.Series) -> pd.Series:
        done = values.copy()
        for size, group in values.groupby(values.str.len()):
            size = int(size)
            if not size:
                continue
            while len(stream) < size:
                stream.append(hmac.digest(key, f"alpha:{len(stream)}".encode(), "sha256")[0])
            rows = np.frombuffer("".join(group).encode("utf-32-le"), "<u4").reshape(-1, size).astype(np.int64)
            shift, out = sign * np.array(stream[:size]), rows
            for alphabet in (LOWER, UPPER, DIGITS):
                place = rows - ord(alphabet[0])
                inside = (place >= 0) & (place < len(alphabet))
                out = np.where(inside, ord(alphabet[0]) + (place + shift) % len(alphabet), out)
            text = out.astype("<u4").tobytes().decode("utf-32-le")
            done[group.index] = [text[i:i + size] for i in range(0, len(text), size)]
        return done

    return series_udf(change)


def fpe_alnum_encrypt(col: Column, key: bytes) -> Column:
    """Shift each letter or digit by a keystream of its position."""
    return cipher_udf("alnum_encrypt", key)(col.cast("string"))


def fpe_alnum_decrypt(col: Column, key: bytes) -> Column:
    return cipher_udf("alnum_decrypt", key)(col.cast("string"))


CIPHERS = {
    "numeric_encrypt": lambda key: _numeric(key, _encrypt_rows),
    "numeric_decrypt": lambda key: _numeric(key, _decrypt_rows),
    "alnum_encrypt": lambda key: _alnum(key, 1),
    "alnum_decrypt": lambda key: _alnum(key, -1),
}


def cipher_udf(name: str, key: bytes):
    """The Arrow UDF of one reversible cipher under one key."""
    return CIPHERS[name](key)


def fpe_one_way(col: Column, key: Column) -> Column:
    """Shift all letters and digits of a value by one hash of key and value; stays in generated code."""
    text = col.cast("string")
    digest = F.sha2(F.concat(key, text), 256)

    def turned(alphabet: str) -> Column:
        size = len(alphabet)
        return F.substring(F.lit(alphabet * 2), (digest_mod(digest, size) + 1).cast("int"), F.lit(size))

    return F.call_function(
        "translate", text, F.lit(LOWER + UPPER + DIGITS), F.concat(*map(turned, (LOWER, UPPER, DIGITS))))


def _power_of_ten(digits: Column) -> Column:
    return F.rpad(F.lit("1"), digits + 1, F.lit("0"))


def _aes_block(half: Column, round_no: Column, key: Column) -> Column:
    """AES-128 block of the half and the round number, in hex."""
    block = F.rpad(F.concat(half, round_no.cast("string")), 16, "0")
    # ECB with PKCS appends a padding block; the first one is the plain block cipher
    return F.hex(F.aes_encrypt(block, key, F.lit("ECB"), F.lit("PKCS")))


def _shifted(source: Column, digest: Column, sign: int) -> Column:
    """``source`` plus or minus the 128-bit digest, modulo its power of ten."""
    def fold(kind: str) -> Column:
        modulus = _power_of_ten(F.length(source)).cast(kind)
        rest = F.lit(0).cast(kind)
        for index in range(4):
            part = hex_limb(digest, index)
            rest = (rest * F.lit(1 << 32).cast("bigint" if kind == "bigint" else "decimal(10,0)")
                    + part.cast("bigint" if kind == "bigint" else "decimal(10,0)")) % modulus
            rest = rest.cast("decimal(27,0)" if kind != "bigint" else kind)
        value = source.cast(kind)
        mixed = value + rest if sign > 0 else value + modulus - rest
        return (mixed % modulus).cast("decimal(38,0)" if kind != "bigint" else kind).cast("string")

    # nine digits leave room for a 32-bit shift in a long
    number = F.when(F.length(source) <= 9, fold("bigint")).when(F.length(source) <= DECIMAL_DIGITS, fold("decimal(28,0)"))
    return F.when(F.length(source) <= DECIMAL_DIGITS, F.lpad(number, F.length(source), F.lit("0"))).otherwise(_shifted_groups(source, digest, sign))


def _carried(items: Column, first: Column, value) -> Column:
    """Groups of nine digits, the lowest first: ``value(item, carry)`` from the lowest up, with ``first`` carried in; the last carry is dropped."""
    base = F.lit(10**GROUP_DIGITS).cast("bigint")

    def add(done: Column, item: Column) -> Column:
        total = value(item, done["carry"])
        return F.struct(F.concat(done["groups"], F.array(F.pmod(total, base))).alias("groups"), F.call_function("div", total - F.pmod(total, base), base).alias("carry"))

    return F.aggregate(items, F.struct(F.array().cast("array<bigint>").alias("groups"), first.alias("carry")), add, lambda done: done["groups"])


def _digest_groups(digest: Column) -> Column:
    """A 128-bit hex digest as five groups, by Horner's rule over 32-bit parts."""
    parts = F.array(*[hex_limb(digest, i).cast("bigint") for i in range(4)])
    zero = F.array(*[F.lit(0).cast("bigint")] * 5)
    return F.aggregate(parts, zero, lambda groups, part: _carried(groups, part, lambda g, carry: g * F.lit(1 << 32) + carry))


def _shifted_groups(source: Column, digest: Column, sign: int) -> Column:
    """As ``_shifted``, for any number of digits from 28 on."""
    n = F.length(source)
    count = F.ceil(n / GROUP_DIGITS).cast("int")
    start = lambda i: n - GROUP_DIGITS * (i + 1)
    own = lambda i: F.substring(source, F.greatest(start(i), F.lit(0)) + 1, GROUP_DIGITS + F.least(start(i), F.lit(0))).cast("bigint")
    pairs = F.zip_with(F.transform(F.sequence(F.lit(0), count - 1), own), _digest_groups(digest),
                       lambda x, y: F.struct(x.alias("own"), F.coalesce(y, F.lit(0).cast("bigint")).alias("add")))
    # a digest has five groups; those beyond the value's own are no part of it
    groups = _carried(F.filter(pairs, lambda p: p["own"].isNotNull()), F.lit(0).cast("bigint"), lambda p, carry: p["own"] + sign * p["add"] + carry)
    text = F.array_join(F.transform(F.reverse(groups), lambda g: F.lpad(g.cast("string"), GROUP_DIGITS, "0")), "")
    return F.substring(text, F.length(text) - n + 1, n)


def _aes_feistel(col: Column, key: Column, decrypt: bool) -> Column:
    text = F.trim(col.cast("string"))
    n = F.length(text)
    start = F.struct(
        F.left(text, F.floor(n / 2).cast("int")).alias("l"),
        F.substring(text, F.floor(n / 2).cast("int") + 1, n).alias("r"),
    )

    def step(halves: Column, round_no: Column) -> Column:
        source, other = (halves["r"], halves["l"]) if decrypt else (halves["l"], halves["r"])
        # array expressions evaluate every mention, so the cipher runs under a name of its own
        new = F.transform(F.array(_aes_block(other, round_no, key)), lambda d: _shifted(source, d, -1 if decrypt else 1))[0]
        return F.struct((new if decrypt else other).alias("l"), (other if decrypt else new).alias("r"))

    order = F.sequence(F.lit(AES_ROUNDS - 1), F.lit(0)) if decrypt else F.sequence(F.lit(0), F.lit(AES_ROUNDS - 1))
    done = F.aggregate(order, start, step, lambda halves: F.concat(halves["l"], halves["r"]))
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(~text.rlike("^[0-9]+$"), F.lit(None).cast("string"))
        .when(n == 1, text)
        .otherwise(done)
    )


def fpe_digits_error(col: Column) -> Column:
    """Why a value has no cipher: null for digits of any number, and for null."""
    text = F.trim(col.cast("string"))
    return F.when(text.isNotNull() & ~text.rlike("^[0-9]+$"), F.lit("expected digits"))


def fpe_digits_enc(col: Column, key: Column) -> Column:
    """Six Feistel rounds with an AES-128 round function; ``key`` is a 16-byte column.

    Values may have any number of digits; one with other characters gives null, see :func:`fpe_digits_error`.
    """
    return _aes_feistel(col, key, decrypt=False)


def fpe_digits_dec(col: Column, key: Column) -> Column:
    """Inverse of :func:`fpe_digits_enc`, odd lengths included."""
    return _aes_feistel(col, key, decrypt=True)
