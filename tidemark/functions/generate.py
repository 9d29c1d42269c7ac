"""Deterministic test data: each value depends on seed, row id and column name only.

A row is the same whatever the partitioning, and a lost task remakes it exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.session import spread_small

ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
UPPER, LOWER, DIGITS = ALNUM[:26], ALNUM[26:52], ALNUM[52:]
# fixed values of the generator
NULL_SHARE = 0.1
DEFAULT_LENGTH = 5
FIRST_DAY, DAYS = "2000-01-01", 8766
OFFSETS = (-7, -5, 0, 1, 2, 5, 8)
TEMPLATE = {"9": DIGITS, "A": UPPER, "a": LOWER, "*": ALNUM}
MIN_AGE, MAX_AGE = 18, 80

FIRST_NAMES = ("Ada", "Ben", "Cora", "Dan", "Eva", "Finn", "Gia", "Hugo", "Iris", "Jon", "Kira", "Liam", "Mia", "Noah", "Ola", "Pia")
LAST_NAMES = ("Abbott", "Barker", "Carver", "Dalton", "Ellis", "Fowler", "Graves", "Harper", "Irwin", "Jarvis", "Keller", "Lowell")
STREETS = ("Oak St", "Elm Ave", "Hill Rd", "Lake Dr", "Mill Ln", "Park Way", "River Rd", "Station St")
TOWNS = ("Ashford", "Brookton", "Clayfield", "Dunmore", "Eastvale", "Fairlea", "Glenwood", "Highport")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str = "VARCHAR"
    nullable: bool = False
    length: int = DEFAULT_LENGTH
    pattern: str | None = None
    copy_of: str | None = None


SPARK_TYPES = {
    "VARCHAR": "string", "NUMBER": "decimal(38,4)", "INTEGER": "bigint", "FLOAT": "double", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "TIMESTAMP_NTZ": "timestamp_ntz", "TIMESTAMP_LTZ": "timestamp",
    "TIMESTAMP_TZ": "struct<ts:timestamp_ntz,offset:string>", "BOOLEAN": "boolean", "VARIANT": "variant",
    "ARRAY": "array<bigint>", "OBJECT": "map<string,map<string,bigint>>",
}


def spec_schema(spec: list[ColumnSpec]) -> T.StructType:
    fields = ", ".join(f"`{c.name}` {SPARK_TYPES[c.type]}{'' if c.nullable else ' NOT NULL'}" for c in spec)
    return T.StructType.fromDDL(fields)


def column_type(c: ColumnSpec) -> str:
    """The type of a table's column that holds what the spec says and no more: its length is a bound."""
    length = c.length if c.length > 0 else DEFAULT_LENGTH
    if c.type == "VARCHAR":
        return f"varchar({max(length, len(c.pattern or ''))})"
    if c.type == "NUMBER":
        return f"decimal({min(38, length + 4)},4)"
    if c.type == "INTEGER":
        return f"decimal({min(38, length)},0)"
    return SPARK_TYPES[c.type]


def spec_columns(spec: list[ColumnSpec]) -> str:
    """The spec as column definitions of a table."""
    return ", ".join(f"`{c.name}` {column_type(c)}{'' if c.nullable else ' NOT NULL'}" for c in spec)


class Draws:
    """Draws for one row id, seed and column name: the first bits of an MD5 of these and of what else names the draw.

    Any engine with MD5 makes the same values.
    """

    def __init__(self, row: Column, seed: int, name: str):
        self.row, self.seed, self.name = row, seed, name

    def _bits(self, digits: int, *salt) -> Column:
        """A whole number from the first ``digits`` hex digits."""
        keys = [s if isinstance(s, Column) else F.lit(s) for s in (self.seed, self.row, self.name, *salt)]
        text = F.concat_ws(":", *[k.cast("string") for k in keys])
        return F.conv(F.left(F.md5(text.cast("binary")), F.lit(digits)), 16, 10).cast("bigint")

    def below(self, n: int, *salt) -> Column:
        """Whole number from 0 to n - 1, for n up to 10^15."""
        return self._bits(15, *salt) % F.lit(n).cast("bigint")

    def unit(self, *salt) -> Column:
        """Number from 0 up to 1, in 2^52 steps."""
        return self._bits(13, *salt).cast("double") / F.lit(float(1 << 52))

    def digits(self, n: int, *salt) -> Column:
        """A text of ``n`` digits."""
        parts = [min(15, n - at) for at in range(0, n, 15)]
        return F.concat(*[F.lpad(self.below(10**size, *salt, i).cast("string"), size, "0") for i, size in enumerate(parts)])

    def pick(self, alphabet: str, *salt) -> Column:
        return F.substring(F.lit(alphabet), (self.below(len(alphabet), *salt) + 1).cast("int"), F.lit(1))

    def text(self, alphabet: str, length: int, *salt) -> Column:
        places = F.sequence(F.lit(1), F.lit(length))
        return F.array_join(F.transform(places, lambda i: self.pick(alphabet, *salt, i)), "")

    def word(self, words: tuple[str, ...], *salt) -> Column:
        return F.element_at(F.array(*map(F.lit, words)), (self.below(len(words), *salt) + 1).cast("int"))


def from_template(draws: Draws, pattern: str) -> Column:
    """9 digit, A upper, a lower, * either; other characters stand for themselves."""
    return F.concat(*[draws.pick(TEMPLATE[c], i) if c in TEMPLATE else F.lit(c) for i, c in enumerate(pattern)])


def _second(draws: Draws) -> Column:
    return F.timestamp_add("SECOND", draws.below(DAYS * 86400, "second"), F.lit(FIRST_DAY).cast("timestamp_ntz"))


def _key(draws: Draws, size: int, *salt) -> Column:
    """A key that no other key of its object equals: its last character tells its place."""
    place = F.substring(F.lit(ALNUM), F.pmod(salt[-1] if isinstance(salt[-1], Column) else F.lit(salt[-1]), F.lit(62)).cast("int") + 1, F.lit(1))
    return F.concat(draws.text(ALNUM, size - 1, "key", *salt), place)


def random_value(draws: Draws, kind: str, length: int) -> Column:
    length = length if length > 0 else DEFAULT_LENGTH
    places = F.sequence(F.lit(1), F.lit(length))
    if kind == "VARCHAR":
        return draws.text(ALNUM, length)
    if kind == "NUMBER":
        # rounded half up to so many decimals, as whole ten-thousandths
        decimals = [F.lit(10 ** (4 - d)).cast("bigint") for d in range(1, min(4, length) + 1)]
        if length <= 11:
            step = F.element_at(F.array(*decimals), (draws.below(len(decimals), "scale") + 1).cast("int"))
            value = draws.below((10**length - 1) * 10**4 + 1) + F.call_function("div", step, F.lit(2))
            return ((value - value % step).cast("decimal(19,0)") * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(38,4)")
        value = (draws.unit() * F.lit(float(10**length - 1))).cast("decimal(38,9)")
        rounded = [F.round(value, d).cast("decimal(38,4)") for d in range(1, 5)]
        return F.element_at(F.array(*rounded), (draws.below(4, "scale") + 1).cast("int"))
    if kind == "INTEGER":
        if length > 38:
            raise ValueError("an INTEGER has at most 38 digits")
        return draws.digits(length).cast("bigint" if length <= 18 else "decimal(38,0)")
    if kind == "FLOAT":
        return draws.unit() * F.lit(length * 100.0)
    if kind == "DATE":
        return F.date_add(F.lit(FIRST_DAY).cast("date"), draws.below(DAYS).cast("int"))
    if kind in ("TIMESTAMP", "TIMESTAMP_NTZ"):
        return _second(draws)
    offset = F.element_at(F.array(*map(F.lit, OFFSETS)), (draws.below(len(OFFSETS), "zone") + 1).cast("int"))
    if kind == "TIMESTAMP_LTZ":
        return F.timestamp_add("HOUR", -offset, _second(draws).cast("timestamp"))
    if kind == "TIMESTAMP_TZ":
        return F.struct(_second(draws).alias("ts"), F.concat(
            F.when(offset < 0, "-").otherwise("+"), F.lpad(F.abs(offset).cast("string"), 2, "0"), F.lit(":00")).alias("offset"))
    if kind == "BOOLEAN":
        return draws.below(2) == 0
    if kind == "ARRAY":
        return F.transform(places, lambda i: draws.below(100, i) + 1)
    if kind == "VARIANT":
        def entry(i):
            value = (F.when(draws.below(3, "kind", i) == 0, F.concat(F.lit('"'), draws.text(ALNUM, 5, "value", i), F.lit('"')))
                     .when(draws.below(3, "kind", i) == 1, (draws.below(100, "value", i) + 1).cast("string"))
                     .otherwise((draws.below(2, "value", i) == 0).cast("string")))
            return F.concat(F.lit('"'), _key(draws, 5, i), F.lit('":'), value)
        return F.parse_json(F.concat(F.lit("{"), F.array_join(F.transform(places, entry), ","), F.lit("}")))
    if kind == "OBJECT":
        def nested(i):
            inner = F.transform(F.sequence(F.lit(1), (draws.below(2, "size", i) + 1).cast("int")), lambda j: F.struct(
                _key(draws, 3, i, j).alias("k"), (draws.below(100, i, j) + 1).alias("v")))
            return F.struct(_key(draws, 5, i).alias("k"), F.map_from_entries(inner).alias("v"))
        return F.map_from_entries(F.transform(places, nested))
    raise ValueError(f"unknown type {kind}")


def generate_for(df: DataFrame, row: str, spec: list[ColumnSpec], seed: int) -> DataFrame:
    """Add the spec's columns to existing rows with a unique id."""
    made: dict[str, Column] = {}
    for c in spec:
        draws = Draws(F.col(row), seed, c.name)
        if c.copy_of:
            made[c.name] = made[c.copy_of]
            continue
        value = from_template(draws, c.pattern) if c.pattern else random_value(draws, c.type, c.length)
        made[c.name] = F.when(draws.unit("null") >= NULL_SHARE, value) if c.nullable else value
    return spread_small(df).select("*", *[col.alias(name) for name, col in made.items()])


def generate(spark: SparkSession, spec: list[ColumnSpec], n: int, seed: int) -> DataFrame:
    rows = spark.range(1, n + 1).toDF("_row")
    return generate_for(rows, "_row", spec, seed).drop("_row")


def fake_people(df: DataFrame, row: str, seed: int, as_of: str) -> DataFrame:
    """The sixteen columns of the personal-data table for rows with a unique id."""
    def at(name):
        return Draws(F.col(row), seed, name)

    number = F.col(row).cast("bigint")
    first, last = at("first").word(FIRST_NAMES), at("last").word(LAST_NAMES)
    ssn, card, phone = (from_template(at(n), p) for n, p in (
        ("ssn", "999-99-9999"), ("card", "9999-9999-9999-9999"), ("phone", "(999) 999-9999")))
    age = at("dob").below((MAX_AGE - MIN_AGE) * 365 + 1).cast("int") + MIN_AGE * 365
    born = F.date_format(F.date_sub(F.lit(as_of).cast("date"), age), "MM/dd/yyyy")
    digit_count = F.length(number.cast("string"))
    columns = {
        "name": F.concat_ws(" ", first, last),
        "address": F.concat_ws(", ", F.concat_ws(" ", (at("house").below(9999) + 1).cast("string"), at("street").word(STREETS)),
                               F.concat_ws(" ", at("town").word(TOWNS), from_template(at("zip"), "AA 99999"))),
        # the row id makes the address unique
        "email": F.lower(F.concat(first, F.lit("."), last, number.cast("string"), F.lit("@example.com"))),
        "customer_id": F.concat(F.lit("CUST"), F.lpad(number.cast("string"), F.greatest(digit_count, F.lit(6)), F.lit("0"))),
        "ssn": ssn, "social_security_number": ssn, "credit_card": card, "credit_card_number": card,
        "phone": phone, "phone_number": phone, "date_of_birth": born, "dob": born,
        "account_number": from_template(at("account"), "9" * 10), "routing_number": from_template(at("routing"), "9" * 9),
        "passport": at("passport").text(UPPER + DIGITS, 9), "drivers_license": at("license").text(UPPER + DIGITS, 8),
    }
    return df.select(row, *[col.alias(name) for name, col in columns.items()])
