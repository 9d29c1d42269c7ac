"""AES in SQL, for the oracles of the ciphers: rounds as list expressions over an S-box list."""

from __future__ import annotations


def _times(a: int, b: int) -> int:
    """Product in the field of 256 elements of the standard (modulus x^8 + x^4 + x^3 + x + 1)."""
    out = 0
    while b:
        out ^= a if b & 1 else 0
        a, b = (a << 1) ^ (0x11B if a & 0x80 else 0), b >> 1
    return out


def _substitution() -> list[int]:
    """The inverse of each byte, then the sum of its five rotations and 63 hex."""
    inverse = [0] + [next(y for y in range(1, 256) if _times(x, y) == 1) for x in range(1, 256)]
    turned = lambda x, n: (x << n | x >> (8 - n)) & 255
    return [x ^ turned(x, 1) ^ turned(x, 2) ^ turned(x, 3) ^ turned(x, 4) ^ 0x63 for x in inverse]


SBOX = _substitution()


def round_keys(key: bytes) -> list[list[int]]:
    size = len(key) // 4
    words, factor = [list(key[i:i + 4]) for i in range(0, len(key), 4)], 1
    for i in range(size, 4 * (size + 7)):
        last = words[-1]
        if i % size == 0:
            last = [SBOX[b] for b in last[1:] + last[:1]]
            last[0] ^= factor
            factor = _times(factor, 2)
        elif size > 6 and i % size == 4:
            last = [SBOX[b] for b in last]
        words.append([a ^ b for a, b in zip(words[-size], last)])
    return [sum(words[i:i + 4], []) for i in range(0, len(words), 4)]


def _from(ahead: int) -> list[int]:
    """For each byte of a block, the 1-based place of the byte ``ahead`` rows below it once rows have been shifted."""
    rows = [(column, (row + ahead) % 4) for column in range(4) for row in range(4)]
    return [4 * ((column + row) % 4) + row + 1 for column, row in rows]


def tables() -> str:
    """A one-row relation ``aes`` of the lists that :func:`block` reads."""
    lists = {"s1": SBOX, "s2": [_times(2, x) for x in SBOX], "s3": [_times(3, x) for x in SBOX], **{f"p{n}": _from(n) for n in range(4)}}
    return "aes AS (SELECT " + ", ".join(f"{v} AS {n}" for n, v in lists.items()) + ")"


def block(state: str, key: bytes) -> str:
    """The cipher block (a list of 16 numbers) of the list ``state``."""
    first, *middle, last = round_keys(key)
    start = f"list_transform(range(1, 17), lambda i: xor(({state})[i], {first}[i]))"
    mixed = "xor(xor(s2[s[p0[i]] + 1], s3[s[p1[i]] + 1]), xor(s1[s[p2[i]] + 1], s1[s[p3[i]] + 1]))"
    rounds = f"list_reduce({middle}, lambda s, k: list_transform(range(1, 17), lambda i: xor({mixed}, k[i])), {start})"
    return f"list_transform([{rounds}], lambda s: list_transform(range(1, 17), lambda i: xor(s1[s[p0[i]] + 1], {last}[i])))[1]"


def text_bytes(text: str) -> str:
    """The UTF-8 bytes of a text as numbers."""
    return f"list_transform(range(0, octet_length(encode({text}))), lambda b: CAST('0x' || substr(hex(encode({text})), CAST(2 * b + 1 AS INT), 2) AS INT))"


def cbc_hex(text: str, key: bytes, iv: str) -> str:
    """Upper-case hex of CBC with padding to whole blocks; ``iv`` has 16 ASCII characters."""
    padded = f"list_transform([{text_bytes(text)}], lambda x: list_concat(x, list_resize(CAST([] AS INT[]), 16 - len(x) % 16, CAST(16 - len(x) % 16 AS INT))))[1]"
    blocks = f"list_transform([{padded}], lambda x: list_transform(range(0, len(x) // 16), lambda n: x[16 * n + 1:16 * n + 16]))[1]"
    chained = "list_transform(range(1, 17), lambda i: xor(done[len(done) - 16 + i], part[i]))"
    sealed = f"list_reduce({blocks}, lambda done, part: list_concat(done, {block(chained, key)}), {list(iv.encode())})"
    return f"array_to_string(list_transform(({sealed})[17:], lambda b: format('{{:02X}}', b)), '')"


def feistel_digits(source: str, key: bytes, id_: str, digits: str, rounds: int) -> str:
    """The AES digit cipher, one relation for each round; halves of under 30 digits."""
    steps = [f"f0 AS (SELECT {id_} AS id, left({digits}, length({digits}) // 2) AS l, substr({digits}, length({digits}) // 2 + 1) AS r FROM {source})"]
    for n in range(rounds):
        state = text_bytes(f"rpad(r || '{n}', 16, '0')")
        power = "CAST(rpad('1', CAST(length(l) + 1 AS INT), '0') AS HUGEINT)"
        rest = f"list_reduce(list_prepend(CAST(0 AS HUGEINT), list_transform({block(state, key)}, lambda b: CAST(b AS HUGEINT))), lambda a, b: (a * 256 + b) % {power})"
        steps.append(f"f{n + 1} AS MATERIALIZED (SELECT id, r AS l, lpad(CAST((CAST(l AS HUGEINT) + {rest}) % {power} AS VARCHAR), CAST(length(l) AS INT), '0') AS r FROM f{n}, aes)")
    return f"WITH {tables()}, {', '.join(steps)} SELECT id AS {id_}, l || r AS digits FROM f{rounds}"
