"""The column functions under SQL names, for users who write SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from tidemark.functions.fpe import CIPHERS, cipher_udf
from tidemark.sources.archives import MEMBER_ERRORS, member_lines

# SQL bodies are expanded into the caller's plan
SQL_FUNCTIONS = {
    "tm_mask_fixed(v STRING, c STRING)": "repeat(c, length(v))",
    "tm_mask_lastn(v STRING, n INT, c STRING)":
        "CASE WHEN length(v) <= n THEN repeat(c, length(v)) ELSE concat(repeat(c, length(v) - n), right(v, n)) END",
    "tm_mask_firstn(v STRING, n INT, c STRING)":
        "CASE WHEN length(v) <= n THEN repeat(c, length(v)) ELSE concat(left(v, n), repeat(c, length(v) - n)) END",
}


@udtf(returnType="line_no long, line string, error string", useArrow=True)
class UnzipMember:
    """Cleaned lines of one archive member, streamed; one row with the error if it can't be read."""

    def eval(self, archive: str, member: str):
        try:
            for _, number, line in member_lines(archive, member):
                yield number, line, None
        except MEMBER_ERRORS as error:
            yield None, None, f"{type(error).__name__}: {error}"


def register_functions(spark: SparkSession, key: bytes) -> None:
    """Temporary functions of this session: masks, ciphers under ``key``, and the archive reader."""
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS STRING RETURN {body}")
    for name in CIPHERS:
        spark.udf.register(f"tm_{name}", cipher_udf(name, key))
    spark.udtf.register("tm_unzip_member", UnzipMember)
