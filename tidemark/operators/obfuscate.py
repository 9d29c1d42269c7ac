"""Column obfuscation driven by a rule table."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import masking, scramble
from tidemark.functions.hashing import secret_column
from tidemark.operators.ranks import global_rank
from tidemark.session import spread_small


@dataclass(frozen=True)
class Rule:
    column: str
    rule: str
    params: dict = field(default_factory=dict)
    scope: str | None = None
    max_length: int | None = None


def load_rules(config: DataFrame, dataset: str) -> list[Rule]:
    """Enabled rules of one dataset, which has one a column; ``obf_params`` may be a variant or JSON text."""
    params = F.col("obf_params")
    if config.schema["obf_params"].dataType.typeName() == "variant":
        params = F.to_json(params)
    rows = (
        config.filter((F.col("dataset_name") == dataset) & F.coalesce(F.col("enabled"), F.lit(True)))
        .select("column_name", "obf_rule", params.alias("params"), "scope_key", "max_length")
        .collect()
    )
    return [Rule(r["column_name"], r["obf_rule"], json.loads(r["params"] or "{}"), r["scope_key"], r["max_length"])
            for r in rows]


# rules that scramble words, with the variant each stands for
WORD_RULES = {
    "SCRAMBLE_WORDS_FULL": "FULL_SHUFFLE",
    "SCRAMBLE_WORDS_INTERNAL": "INTERNAL_SHUFFLE_KEEP_FIRST_LAST",
    "SCRAMBLE_WORDS_REVERSE": "REVERSE",
    "SCRAMBLE_WORDS_BLOCKS": "BLOCKS",
}


def rule_column(rule: Rule, col: Column, salt: str, secret: Column) -> Column:
    """The expression of one rule; an unknown rule is an error, never a silent pass."""
    scope = rule.scope or rule.column
    keyed = {"scope": scope, "salt": salt}
    name, params = rule.rule.upper(), rule.params
    if name == "KEEP":
        return masking.keep(col)
    if name == "NULLIFY":
        return masking.nullify(col)
    if name == "MASK_FIXED":
        return masking.mask_fixed(col, **params)
    if name == "MASK_LASTN":
        return masking.mask_lastn(col, **params)
    if name == "MASK_FIRSTN":
        return masking.mask_firstn(col, **params)
    if name == "HASH_DETERMINISTIC":
        return masking.hash_deterministic(col, secret, rule.max_length)
    if name == "SCRAMBLE_WORDS":
        return scramble.scramble_words(col, **keyed, **params)
    if name == "SCRAMBLE_WORDS_ROTATE":
        direction = params.get("direction", "left").upper()
        return scramble.scramble_words(col, **keyed, variant=f"ROTATE_{direction}")
    if name in WORD_RULES:
        return scramble.scramble_words(col, **keyed, variant=WORD_RULES[name], **params)
    if name == "SCRAMBLE_DIGITS":
        return scramble.scramble_digits(col, **keyed)
    if name == "SCRAMBLE_ALPHANUM":
        return scramble.scramble_alphanum(col, **keyed)
    raise ValueError(f"unknown rule {rule.rule} for column {rule.column}")


def _rule_columns(df: DataFrame, rules: list[Rule], salt: str) -> dict[str, Column]:
    names = {c.lower(): c for c in df.columns}
    secret = secret_column(df.sparkSession, salt)
    return {names[r.column.lower()]: rule_column(r, F.col(names[r.column.lower()]), salt, secret)
            for r in rules if r.column.lower() in names}


def obfuscate(df: DataFrame, rules: list[Rule], salt: str) -> DataFrame:
    """Apply the rules in one projection; columns without a rule pass unchanged."""
    costly = any(r.rule.upper().startswith("SCRAMBLE") for r in rules)
    return (spread_small(df) if costly else df).withColumns(_rule_columns(df, rules, salt))


def before_after(df: DataFrame, rules: list[Rule], salt: str) -> DataFrame:
    """Each ruled column next to its obfuscated form, from one projection."""
    changed = _rule_columns(df, rules, salt)
    return df.select(*[c for name, col in changed.items() for c in (F.col(name), col.alias(f"{name}_OBF"))])


def shuffle_column(df: DataFrame, row_key: list[str], column: str, salt: str) -> DataFrame:
    """Permute the values of ``column`` over the rows.

    Row r in key order takes the value of row r in the order of a salted hash of the
    key: two range sorts and a join on the rank, with no single-partition window.
    """
    secret = secret_column(df.sparkSession, salt)
    keyed = df.withColumn("_hash", F.sha2(F.concat_ws("|", secret, *[F.col(k).cast("string") for k in row_key]), 256))
    rows = global_rank(keyed.drop(column, "_hash"), row_key, "_rank")
    values = global_rank(keyed.select(*row_key, "_hash", column), ["_hash", *row_key], "_rank").select("_rank", column)
    return rows.join(values, "_rank").select(*df.columns)
