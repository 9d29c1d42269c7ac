"""Frame-level encryption driven by a data dictionary or an IV table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import aes, fpe
from tidemark.functions.hashing import secret_column
from tidemark.session import spread_small
from tidemark.sinks.writers import unload_csv
from tidemark.sources.tables import CsvFormat, read_text_columns

# fixed: fields treated as sensitive when no dictionary is given
DEFAULT_DICTIONARY = {
    "ssn": "numeric",
    "social_security_number": "numeric",
    "credit_card": "numeric",
    "credit_card_number": "numeric",
    "phone": "numeric",
    "phone_number": "numeric",
    "email": "alphanumeric",
    "customer_id": "alphanumeric",
    "account_number": "numeric",
    "routing_number": "numeric",
    "passport": "alphanumeric",
    "drivers_license": "alphanumeric",
    "date_of_birth": "numeric",
    "dob": "numeric",
}


def read_dictionary(spark: SparkSession, path: str | None, columns: Iterable[str] | None = None) -> dict[str, str]:
    """Field name → type from a CSV of field_name, type, format, description.

    With ``columns`` only their rows reach the driver, however long the dictionary is.
    """
    if path is None:
        return dict(DEFAULT_DICTIONARY)
    rows = spark.read.csv(path, header=True).filter("field_name IS NOT NULL").select("field_name", "type")
    if columns is not None:
        rows = rows.filter(F.lower(F.btrim("field_name")).isin([c.strip().lower() for c in columns]))
    rows = rows.collect()
    return {r["field_name"].strip().lower(): (r["type"] or "").strip().lower() for r in rows}


def sensitive_columns(columns: Iterable[str], dictionary: dict[str, str]) -> dict[str, str]:
    """The listed columns that the dictionary names, whatever their case."""
    known = {name.strip().lower(): kind for name, kind in dictionary.items()}
    return {c: known[c.strip().lower()] for c in columns if c.strip().lower() in known}


def _encrypted(col: Column, kind: str, key: bytes) -> Column:
    ways = {"numeric": fpe.fpe_numeric_encrypt, "alphanumeric": fpe.fpe_alnum_encrypt}
    return ways[kind](col, key) if kind in ways else col


def _decrypted(col: Column, kind: str, key: bytes) -> Column:
    ways = {"numeric": fpe.fpe_numeric_decrypt, "alphanumeric": fpe.fpe_alnum_decrypt}
    return ways[kind](col, key) if kind in ways else col


def encrypt_columns(df: DataFrame, dictionary: dict[str, str], key: bytes) -> DataFrame:
    """Encrypt every column the dictionary names, in one projection."""
    kinds = sensitive_columns(df.columns, dictionary)
    return spread_small(df).withColumns({c: _encrypted(F.col(c), kind, key) for c, kind in kinds.items()})


def decrypt_columns(df: DataFrame, dictionary: dict[str, str], key: bytes) -> DataFrame:
    kinds = sensitive_columns(df.columns, dictionary)
    return spread_small(df).withColumns({c: _decrypted(F.col(c), kind, key) for c, kind in kinds.items()})


def round_trip_errors(df: DataFrame, dictionary: dict[str, str], key: bytes) -> DataFrame:
    """Per sensitive column, the rows that do not come back; one pass, no join."""
    checks = []
    for c, kind in sensitive_columns(df.columns, dictionary).items():
        back = _decrypted(_encrypted(F.col(c), kind, key), kind, key)
        checks.append(F.count(F.when(~F.col(c).cast("string").eqNullSafe(back), 1)).alias(c))
    return spread_small(df).agg(F.count("*").alias("rows"), *checks)


def encrypt_csv(
    spark: SparkSession, source: str, target: str, dictionary: dict[str, str], key: bytes, decrypt: bool = False
) -> DataFrame:
    """CSV to CSV; all columns are read as strings, so leading zeros survive.

    Fields may hold quotes, separators and line breaks; a quoted empty field stays apart from a
    missing one. Large files are read in splits all the same.
    """
    rows = read_text_columns(spark, source, None, CsvFormat(line_breaks=True), emptyValue="")
    done = (decrypt_columns if decrypt else encrypt_columns)(rows, dictionary, key)
    unload_csv(done, target)
    return done


def encrypt_by_column(df: DataFrame, iv_table: DataFrame, key: bytes) -> DataFrame:
    """AES-CBC on each column listed in (COLUMN_NAME, COLUMN_IV_KEY), as upper-case hex."""
    names = {c.upper(): c for c in df.columns}
    listed = iv_table.filter(F.upper("COLUMN_NAME").isin(list(names))).collect()
    secret = secret_column(df.sparkSession, key)
    def sealed(row) -> Column:
        plain = F.col(names[row["COLUMN_NAME"].upper()])
        cipher = F.hex(aes.aes_cbc_det(plain, secret, F.lit(row["COLUMN_IV_KEY"]).cast("binary")))
        # null comes from the plain value alone: a join then tests that, and not the cipher once more
        return F.when(plain.isNotNull(), F.coalesce(cipher, F.lit("")))

    return df.withColumns({names[row["COLUMN_NAME"].upper()]: sealed(row) for row in listed})
