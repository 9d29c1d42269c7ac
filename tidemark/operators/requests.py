"""Masking requests: columns asked to be masked, submitted once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.obfuscate import Rule

REQUEST_SCHEMA = (
    "Request_ID string, S_No int, Database_name string, Schema_name string, "
    "Table_name string, Field_name string, Data_type string, User_ID string"
)


def request_rows(df: DataFrame, request_id: str, name: str, columns: list[str], user: str) -> DataFrame:
    """Rows asking to mask columns of ``database.schema.table``."""
    database, schema, table = name.split(".")
    rows = [(request_id, i, database, schema, table, c, df.schema[c].dataType.simpleString(), user)
            for i, c in enumerate(columns, 1)]
    return df.sparkSession.createDataFrame(rows, REQUEST_SCHEMA)


def new_requests(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Fresh rows whose request id was not submitted before."""
    return fresh.join(stored.select("Request_ID"), "Request_ID", "left_anti").select(*fresh.columns)


def submit(table: str, fresh: DataFrame) -> None:
    new_requests(fresh.sparkSession.table(table), fresh).write.mode("append").insertInto(table)


def request_rules(requests: DataFrame, request_id: str, rule: str = "MASK_FIXED") -> list[Rule]:
    """Obfuscation rules for the fields of one request, which are few."""
    rows = requests.filter(F.col("Request_ID") == request_id).orderBy("S_No").select("Field_name").collect()
    return [Rule(r["Field_name"], rule) for r in rows]
