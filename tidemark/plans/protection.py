"""Checked queries over masking, scrambling, encryption and deterministic AES columns."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from tidemark.functions import aes, fpe, masking
from tidemark.functions.hashing import derive_key, secret_column
from tidemark.operators import encrypt, obfuscate as obf
from tidemark.operators.obfuscate import Rule
from tidemark.plans import aes_sql
from tidemark.plans.registry import query
from tidemark.session import spread_small, work_path
from tidemark.sinks import writers

# demo values; a job passes its own secrets
SALT = "demo-salt"
KEY = hashlib.sha256(b"demo-key").digest()[:16]
PHRASE = "demo-phrase"
IVS = [("C_CUSTKEY", "0011223344556677"), ("O_CUSTKEY", "0011223344556677"), ("C_NAME", "7766554433221100")]


def pii(t):
    """Customer rows with a phone, a card number and an e-mail built from the key."""
    k = F.col("c_custkey")
    four = lambda m: F.lpad(((k * m) % 10000).cast("string"), 4, "0")
    return t.customer.select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal",
        F.format_string("(%03d) %03d-%04d", 200 + k % 700, (k * 7) % 1000, (k * 13) % 10000).alias("phone"),
        F.concat_ws("-", four(3), four(17), four(7919), four(104729)).alias("credit_card"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@Example.com")).alias("email"),
    )


PII_SQL = """(SELECT c_custkey, c_name, c_mktsegment, c_acctbal,
  printf('(%03d) %03d-%04d', 200 + c_custkey % 700, (c_custkey * 7) % 1000, (c_custkey * 13) % 10000) AS phone,
  printf('%04d-%04d-%04d-%04d', (c_custkey * 3) % 10000, (c_custkey * 17) % 10000, (c_custkey * 7919) % 10000, (c_custkey * 104729) % 10000) AS credit_card,
  lower(replace(c_name, '#', '.')) || '@Example.com' AS email FROM customer)"""


# --- masks ------------------------------------------------------------------------

@query("ob1_keep", "SELECT c_custkey, c_name AS kept FROM customer")
def _(t):
    return t.customer.select("c_custkey", masking.keep(F.col("c_name")).alias("kept"))


@query("ob2_nullify", "SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name FROM customer")
def _(t):
    return t.customer.select("c_custkey", masking.nullify(F.col("c_name")).alias("c_name"))


@query("ob3_mask_fixed", "SELECT c_custkey, repeat('*', length(c_mktsegment)) AS masked FROM customer")
def _(t):
    return t.customer.select("c_custkey", masking.mask_fixed(F.col("c_mktsegment"), "*").alias("masked"))


@query("ob4_mask_lastn", """
SELECT c_custkey, CASE WHEN length(c_mktsegment) <= 8 THEN repeat('X', length(c_mktsegment))
  ELSE repeat('X', length(c_mktsegment) - 8) || right(c_mktsegment, 8) END AS masked FROM customer""")
def _(t):
    return t.customer.select("c_custkey", masking.mask_lastn(F.col("c_mktsegment"), 8, "X").alias("masked"))


@query("ob5_mask_firstn", """
SELECT c_custkey, CASE WHEN length(c_mktsegment) <= 8 THEN repeat('#', length(c_mktsegment))
  ELSE left(c_mktsegment, 8) || repeat('#', length(c_mktsegment) - 8) END AS masked FROM customer""")
def _(t):
    return t.customer.select("c_custkey", masking.mask_firstn(F.col("c_mktsegment"), 8, "#").alias("masked"))


# --- scrambles --------------------------------------------------------------------

_TOKEN_SQL = r"[A-Za-z0-9]+(?:[''\-][A-Za-z0-9]+)*"


def _perm(items, seed):
    return (f"list_transform(list_sort(list_transform({items}, lambda c, i: {{'k': substr(sha256({seed} || '|' || "
            f"CAST((i - 1) // 16 AS VARCHAR)), CAST(4 * ((i - 1) % 16) + 1 AS BIGINT), 4), 'i': i, 'c': c}})), lambda x: x.c)")


def _weave(text, pattern, fills):
    return (f"array_to_string(list_transform(string_split_regex({text}, '{pattern}'), "
            f"lambda g, j: g || coalesce(({fills})[j], '')), '')")


def _seed(scope, text):
    return f"('{scope}|' || {text} || '|{SALT}')"


def _ends(chars, seed):
    return (f"CASE WHEN len({chars}) <= 2 THEN {chars} ELSE list_concat(list_concat({chars}[1:1], "
            f"{_perm(f'{chars}[2:len({chars}) - 1]', seed)}), {chars}[len({chars}):]) END")


def _mod(digest, modulus):
    return (f"list_reduce(list_transform(range(0, 8), lambda p: CAST('0x' || substr({digest}, 8 * p + 1, 8) AS BIGINT)), "
            f"lambda acc, p: CAST((CAST(acc AS HUGEINT) * 4294967296 + p) % {modulus} AS BIGINT), CAST(0 AS BIGINT))")


def _token_sql(variant, scope):
    base = "lower(t)"
    seed = _seed(scope, base)
    full = f"array_to_string({_perm(f'string_split({base}, chr(0))', seed)}, '')".replace("chr(0)", "''")
    if variant == "REVERSE":
        mixed = f"reverse({base})"
    elif variant.startswith("ROTATE"):
        shift = f"greatest({_mod(f'sha256({seed})', f'length({base})')}, 1)"
        cut = shift if variant == "ROTATE_LEFT" else f"length({base}) - {shift}"
        mixed = (f"CASE WHEN length({base}) <= 1 THEN {base} ELSE list_transform([{cut}], "
                 f"lambda k: substr({base}, k + 1) || left({base}, k))[1] END")
    elif variant == "BLOCKS":
        mixed = f"array_to_string({_perm(f'''regexp_extract_all({base}, '(?s).{{1,3}}')''', seed)}, '')"
    elif variant == "FULL_SHUFFLE":
        mixed = full
    else:
        letters = _weave(base, "[a-z]", _ends(f"regexp_extract_all({base}, '[a-z]')", seed))
        mixed = f"CASE WHEN regexp_full_match(t, '[0-9]+') THEN {full} ELSE {letters} END"
    bare = "regexp_replace(t, '[^A-Za-z]', '', 'g')"
    head = "regexp_extract(o, '^[^a-z]*[a-z]')"
    return (f"list_transform([{mixed}], lambda o: CASE WHEN regexp_full_match({bare}, '[A-Z]+') THEN upper(o) "
            f"WHEN regexp_full_match({bare}, '[A-Z][a-z]*') THEN upper({head}) || substr(o, length({head}) + 1) ELSE o END)[1]")


def words_sql(source, key, column, variant, scope):
    """Words and gaps as rows; each distinct word is scrambled once and joined back."""
    return f"""
WITH src AS (SELECT {key} AS k, {column} AS v FROM {source}),
words AS (SELECT k, unnest(regexp_extract_all(v, '{_TOKEN_SQL}')) AS t,
                 generate_subscripts(regexp_extract_all(v, '{_TOKEN_SQL}'), 1) AS j FROM src),
gaps AS (SELECT k, unnest(string_split_regex(v, '{_TOKEN_SQL}')) AS g,
                generate_subscripts(string_split_regex(v, '{_TOKEN_SQL}'), 1) AS j FROM src),
dict AS (SELECT t, {_token_sql(variant, scope)} AS s FROM (SELECT DISTINCT t FROM words))
SELECT k AS {key}, string_agg(g || coalesce(s, ''), '' ORDER BY j) AS {column}
FROM gaps LEFT JOIN words USING (k, j) LEFT JOIN dict USING (t) GROUP BY k"""


_WORD_QUERIES = {
    "ob6_words_full": "FULL_SHUFFLE",
    "ob7_words_internal": "INTERNAL_SHUFFLE_KEEP_FIRST_LAST",
    "ob8_words_rotate_left": "ROTATE_LEFT",
    "ob9_words_rotate_right": "ROTATE_RIGHT",
    "ob10_words_reverse": "REVERSE",
    "ob13_words_blocks": "BLOCKS",
}


def _register_words(name, variant):
    rule = Rule("text", "SCRAMBLE_WORDS", {"variant": variant}, "DOC")

    @query(name, words_sql("documents", "doc_id", "text", variant, "DOC"))
    def _(t):
        return obf.obfuscate(t.documents.select("doc_id", "text"), [rule], SALT)


for _name, _variant in _WORD_QUERIES.items():
    _register_words(_name, _variant)


_TITLES = """(SELECT page_id, upper(split_part(url, '/', 3)) || ' ' || url || ' ' || upper(left(url, 1)) || substr(url, 2) AS title FROM pages)"""


@query("ob11_case_patterns", words_sql(_TITLES, "page_id", "title", "ROTATE_LEFT", "TITLE"))
def _(t):
    url = F.col("url")
    title = F.concat(F.upper(F.split_part(url, F.lit("/"), F.lit(3))), F.lit(" "), url, F.lit(" "),
                     F.upper(F.left(url, F.lit(1))), F.substr(url, F.lit(2)))
    return obf.obfuscate(t.pages.select("page_id", title.alias("title")),
                         [Rule("title", "SCRAMBLE_WORDS", {"variant": "ROTATE_LEFT"}, "TITLE")], SALT)


@query("ob12_tokenisation", words_sql("pages", "page_id", "html", "INTERNAL_SHUFFLE_KEEP_FIRST_LAST", "html"))
def _(t):
    return obf.obfuscate(t.pages.select("page_id", "html"), [Rule("html", "SCRAMBLE_WORDS")], SALT)


@query("ob14_scramble_digits", f"""
SELECT c_custkey, {_weave('phone', '[0-9]', _perm("regexp_extract_all(phone, '[0-9]')", _seed('phone', 'phone')))} AS phone FROM {PII_SQL}""")
def _(t):
    return obf.obfuscate(pii(t).select("c_custkey", "phone"), [Rule("phone", "SCRAMBLE_DIGITS")], SALT)


_ALNUM_STEP = _weave("email", "[A-Za-z]", _perm("regexp_extract_all(email, '[A-Za-z]')", _seed("email", "email")))


@query("ob15_scramble_alphanum", f"""
SELECT c_custkey, {_weave('step', '[0-9]', _perm("regexp_extract_all(step, '[0-9]')", _seed('email', 'email')))} AS email
FROM (SELECT *, {_ALNUM_STEP} AS step FROM {PII_SQL})""")
def _(t):
    return obf.obfuscate(pii(t).select("c_custkey", "email"), [Rule("email", "SCRAMBLE_ALPHANUM")], SALT)


@query("ob16_shuffle_column_values", f"""
SELECT r.c_custkey, r.c_name, v.c_acctbal FROM
  (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS n FROM customer) r
JOIN (SELECT c_acctbal, row_number() OVER (ORDER BY sha256('{SALT}|' || c_custkey), c_custkey) AS n FROM customer) v ON r.n = v.n""")
def _(t):
    return obf.shuffle_column(t.customer.select("c_custkey", "c_name", "c_acctbal"), ["c_custkey"], "c_acctbal", SALT)


@query("ob17_hash_deterministic", f"SELECT c_custkey, left(sha256('{SALT}' || c_mktsegment), 12) AS c_mktsegment FROM customer")
def _(t):
    return obf.obfuscate(t.customer.select("c_custkey", "c_mktsegment"),
                         [Rule("c_mktsegment", "HASH_DETERMINISTIC", max_length=12)], SALT)


REPORT_RULES = [
    Rule("c_custkey", "KEEP"),
    Rule("c_name", "MASK_LASTN", {"n": 4, "mask_char": "*"}),
    Rule("c_mktsegment", "MASK_FIRSTN", {"n": 3, "mask_char": "#"}),
    Rule("phone", "MASK_FIXED", {"mask_char": "X"}),
    Rule("email", "NULLIFY"),
]


@query("ob18_before_after_report", f"""
SELECT c_custkey, c_custkey AS "c_custkey_OBF", c_name, repeat('*', length(c_name) - 4) || right(c_name, 4) AS "c_name_OBF",
       c_mktsegment, left(c_mktsegment, 3) || repeat('#', length(c_mktsegment) - 3) AS "c_mktsegment_OBF",
       phone, repeat('X', length(phone)) AS "phone_OBF", email, CAST(NULL AS VARCHAR) AS "email_OBF" FROM {PII_SQL}""")
def _(t):
    return obf.before_after(pii(t), REPORT_RULES, SALT)


@query("ob0_rule_table", f"""
SELECT c_custkey, repeat('X', length(c_name) - 4) || right(c_name, 4) AS c_name,
       left(sha256('{SALT}' || c_mktsegment), 10) AS c_mktsegment, w.email, phone
FROM {PII_SQL} p JOIN ({words_sql(PII_SQL, 'c_custkey', 'email', 'FULL_SHUFFLE', 'CONTACT')}) w USING (c_custkey)""")
def _(t):
    config = t.spark.sql("""
        SELECT * FROM VALUES
          ('demo', 'c_name', 'MASK_LASTN', parse_json('{"n": 4}'), NULL, 0, true),
          ('demo', 'c_mktsegment', 'HASH_DETERMINISTIC', parse_json('{}'), NULL, 10, true),
          ('demo', 'email', 'SCRAMBLE_WORDS', parse_json('{"variant": "FULL_SHUFFLE"}'), 'CONTACT', 0, true),
          ('demo', 'phone', 'NULLIFY', NULL, NULL, 0, false),
          ('other', 'phone', 'NULLIFY', NULL, NULL, 0, true)
        AS c(dataset_name, column_name, obf_rule, obf_params, scope_key, max_length, enabled)""")
    frame = pii(t).select("c_custkey", "c_name", "c_mktsegment", "email", "phone")
    return obf.obfuscate(frame, obf.load_rules(config, "demo"), SALT)


# --- format-preserving encryption -------------------------------------------------

def _pads():
    rows = []
    for r in range(fpe.ROUNDS):
        key = hashlib.sha256(f"{KEY.hex()}{r}".encode()).hexdigest().encode()
        rows.append(f"({r}, '{bytes(b ^ 0x36 for b in key).hex()}', '{bytes(b ^ 0x5c for b in key).hex()}')")
    return ", ".join(rows)


def _hmac_sql(inner, outer, message):
    return f"sha256(unhex({outer}) || unhex(sha256(unhex({inner}) || {message}::BLOB)))"


def numeric_sql(source, key, column):
    """The digit cipher as a recursive query, one step per round."""
    return f"""
WITH RECURSIVE pads(r, ipad, opad) AS (VALUES {_pads()}),
src AS (SELECT {key} AS k, {column} AS v, regexp_replace({column}, '[^0-9]', '', 'g') AS d FROM {source}),
step(k, v, d, r) AS (
  SELECT k, v, d, 0 FROM src
  UNION ALL
  SELECT k, v, right_half || array_to_string(list_transform(range(0, mid), lambda i:
      CAST((CAST(substr(d, i + 1, 1) AS INT) + CAST('0x' || substr(mac, 2 * i + 1, 2) AS INT)) % 10 AS VARCHAR)), ''), r + 1
  FROM (SELECT s.*, length(d) // 2 AS mid, substr(d, length(d) // 2 + 1) AS right_half,
               {_hmac_sql('ipad', 'opad', 'substr(d, length(d) // 2 + 1)')} AS mac
        FROM step s JOIN pads p ON s.r = p.r))
SELECT k AS {key}, {_weave('v', '[0-9]', "string_split(d, '')")} AS {column} FROM step WHERE r = {fpe.ROUNDS}"""


@query("fp1_numeric_encrypt", numeric_sql(PII_SQL, "c_custkey", "phone"))
def _(t):
    return pii(t).select("c_custkey", fpe.fpe_numeric_encrypt(F.col("phone"), KEY).alias("phone"))


@query("fp2_numeric_decrypt", f"SELECT c_custkey, credit_card FROM {PII_SQL}")
def _(t):
    sealed = pii(t).select("c_custkey", fpe.fpe_numeric_encrypt(F.col("credit_card"), KEY).alias("sealed"))
    return sealed.select("c_custkey", fpe.fpe_numeric_decrypt(F.col("sealed"), KEY).alias("credit_card"))


def alnum_sql(source, key, column):
    block = KEY.ljust(64, b"\0")
    ipad, opad = (f"'{bytes(b ^ p for b in block).hex()}'" for p in (0x36, 0x5C))
    mac = _hmac_sql(ipad, opad, "('alpha:' || i)")
    shift = f"CAST('0x' || substr({mac}, 1, 2) AS INT)"
    return f"""
WITH stream AS (SELECT list({shift} ORDER BY i) AS ks FROM range(0, (SELECT max(length({column})) FROM {source})) r(i))
SELECT {key}, array_to_string(list_transform(string_split({column}, ''), lambda c, i:
  CASE WHEN c BETWEEN 'a' AND 'z' THEN chr(97 + (ascii(c) - 97 + ks[i]) % 26)
       WHEN c BETWEEN 'A' AND 'Z' THEN chr(65 + (ascii(c) - 65 + ks[i]) % 26)
       WHEN c BETWEEN '0' AND '9' THEN chr(48 + (ascii(c) - 48 + ks[i]) % 10) ELSE c END), '') AS {column}
FROM {source}, stream"""


@query("fp3_alnum_encrypt", alnum_sql(PII_SQL, "c_custkey", "email"))
def _(t):
    return pii(t).select("c_custkey", fpe.fpe_alnum_encrypt(F.col("email"), KEY).alias("email"))


@query("fp4_alnum_decrypt", f"SELECT c_custkey, email FROM {PII_SQL}")
def _(t):
    sealed = pii(t).select("c_custkey", fpe.fpe_alnum_encrypt(F.col("email"), KEY).alias("sealed"))
    return sealed.select("c_custkey", fpe.fpe_alnum_decrypt(F.col("sealed"), KEY).alias("email"))


@query("fp5_encrypt_columns", f"""
SELECT a.c_custkey, c_name, phone, email FROM ({numeric_sql(PII_SQL, "c_custkey", "phone")}) a
JOIN ({alnum_sql(PII_SQL, "c_custkey", "email")}) b ON a.c_custkey = b.c_custkey
JOIN customer c ON a.c_custkey = c.c_custkey""")
def _(t):
    frame = pii(t).select("c_custkey", "c_name", "phone", "email")
    return encrypt.encrypt_columns(frame, encrypt.DEFAULT_DICTIONARY, KEY)


@query("fp6_decrypt_columns", f"SELECT c_custkey, c_name, phone, email, credit_card FROM {PII_SQL}")
def _(t):
    frame = pii(t).select("c_custkey", "c_name", "phone", "email", "credit_card")
    sealed = encrypt.encrypt_columns(frame, encrypt.DEFAULT_DICTIONARY, KEY)
    return encrypt.decrypt_columns(sealed, encrypt.DEFAULT_DICTIONARY, KEY)


@query("fp7_csv_to_csv", f"SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, phone, email, '0' || c_custkey AS account_number FROM {PII_SQL}")
def _(t):
    plain, sealed, back = (work_path(t.spark, n) for n in ("plain", "sealed", "back"))
    frame = pii(t).select("c_custkey", "phone", "email", F.expr("'0' || c_custkey").alias("account_number"))
    writers.unload_csv(frame, plain)
    encrypt.encrypt_csv(t.spark, plain, sealed, encrypt.DEFAULT_DICTIONARY, KEY)
    encrypt.encrypt_csv(t.spark, sealed, back, encrypt.DEFAULT_DICTIONARY, KEY, decrypt=True)
    return t.spark.read.csv(back, header=True)


@query("fp8_round_trip_errors", """
SELECT count(*) AS "rows", 0 AS o_orderkey, 0 AS o_custkey, 0 AS o_orderpriority FROM orders""")
def _(t):
    fields = {"o_orderkey": "numeric", "o_custkey": "numeric", "o_orderpriority": "alphanumeric"}
    return encrypt.round_trip_errors(t.orders, fields, KEY)


_ONE_WAY = "sha256('{p}' || email)".format(p=PHRASE)


@query("fp9_one_way", f"""
SELECT c_custkey, array_to_string(list_transform(string_split(email, ''), lambda c:
  CASE WHEN c BETWEEN 'a' AND 'z' THEN chr(97 + (ascii(c) - 97 + m26) % 26)
       WHEN c BETWEEN 'A' AND 'Z' THEN chr(65 + (ascii(c) - 65 + m26) % 26)
       WHEN c BETWEEN '0' AND '9' THEN chr(48 + (ascii(c) - 48 + m10) % 10) ELSE c END), '') AS email
FROM (SELECT c_custkey, email, CAST({_mod(_ONE_WAY, 26)} AS INT) AS m26, CAST({_mod(_ONE_WAY, 10)} AS INT) AS m10 FROM {PII_SQL})""")
def _(t):
    key = secret_column(t.spark, PHRASE)
    return pii(t).select("c_custkey", fpe.fpe_one_way(F.col("email"), key).alias("email"))


def _order_digits(t):
    """Order keys as digit strings of mixed, also odd, lengths."""
    digits = F.concat(F.lit("9"), F.col("o_orderkey").cast("string"), F.lpad(F.col("o_custkey").cast("string"), 5, "0"))
    key = secret_column(t.spark, derive_key(PHRASE)[:16])
    return spread_small(t.orders.select("o_orderkey", digits.alias("digits"))).withColumn("_key", key)


_DIGITS = "(SELECT o_orderkey, '9' || o_orderkey || lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS digits FROM orders)"


@query("fp10_aes_digits_encrypt", aes_sql.feistel_digits(_DIGITS, derive_key(PHRASE)[:16], "o_orderkey", "digits", fpe.AES_ROUNDS))
def _(t):
    return _order_digits(t).select("o_orderkey", fpe.fpe_digits_enc(F.col("digits"), F.col("_key")).alias("digits"))


@query("fp11_aes_digits_decrypt", f"SELECT o_orderkey, digits FROM {_DIGITS}")
def _(t):
    sealed = _order_digits(t).withColumn("sealed", fpe.fpe_digits_enc(F.col("digits"), F.col("_key")))
    return sealed.select("o_orderkey", fpe.fpe_digits_dec(F.col("sealed"), F.col("_key")).alias("digits"))


@query("fp11_long_digits", """
SELECT c_custkey, repeat(lpad(CAST(c_custkey AS VARCHAR), 10, '7'), 20) AS digits, true AS sealed, 'expected digits' AS error_of_name FROM customer""")
def _(t):
    long = F.repeat(F.lpad(F.col("c_custkey").cast("string"), 10, "7"), 20)
    key = secret_column(t.spark, derive_key(PHRASE)[:16])
    rows = spread_small(t.customer.select("c_custkey", "c_name", long.alias("digits"))).withColumn("_key", key)
    sealed = rows.withColumn("e", fpe.fpe_digits_enc(F.col("digits"), F.col("_key")))
    return sealed.select("c_custkey", fpe.fpe_digits_dec(F.col("e"), F.col("_key")).alias("digits"),
                         ((F.length("e") == 200) & (F.col("e") != F.col("digits"))).alias("sealed"), fpe.fpe_digits_error(F.col("c_name")).alias("error_of_name"))


# --- deterministic AES ------------------------------------------------------------

def _aes_parts(t):
    return secret_column(t.spark, derive_key(PHRASE)), F.lit(IVS[0][1]).cast("binary")


@query("ae1_aes_round_trip", "SELECT c_custkey, c_name, 32 AS cipher_bytes FROM customer")
def _(t):
    key, iv = _aes_parts(t)
    sealed = t.customer.select("c_custkey", aes.aes_cbc_det(F.col("c_name"), key, iv).alias("c"))
    return sealed.select("c_custkey", aes.aes_cbc_det_decrypt(F.col("c"), key, iv).alias("c_name"),
                         F.length("c").alias("cipher_bytes"))


_SEALED = {name: aes_sql.cbc_hex(f"CAST({name.lower()} AS VARCHAR)", derive_key(PHRASE), iv) for name, iv in IVS}


@query("ae2_encrypt_by_column", f"""
WITH {aes_sql.tables()} SELECT * EXCLUDE (s1, s2, s3, p0, p1, p2, p3) REPLACE ({_SEALED['C_CUSTKEY']} AS c_custkey, {_SEALED['C_NAME']} AS c_name) FROM customer, aes""")
def _(t):
    ivs = t.spark.createDataFrame(IVS, "COLUMN_NAME string, COLUMN_IV_KEY string")
    return encrypt.encrypt_by_column(t.customer, ivs, derive_key(PHRASE))


@query("ae3_projection_with_cipher_key", """
SELECT c_custkey, c_name, c_mktsegment, count(*) OVER (PARTITION BY c_custkey) AS rows_of_cipher FROM customer""")
def _(t):
    key, iv = _aes_parts(t)
    masked = t.customer.withColumn("c_custkey_masked", F.hex(aes.aes_cbc_det(F.col("c_custkey"), key, iv)))
    n = masked.groupBy("c_custkey_masked").agg(F.count("*").alias("rows_of_cipher"))
    return masked.join(n, "c_custkey_masked").select("c_custkey", "c_name", "c_mktsegment", "rows_of_cipher")


@query("ae4_join_on_encrypted_keys", """
SELECT c_name, count(*) AS orders FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name""")
def _(t):
    ivs = t.spark.createDataFrame(IVS, "COLUMN_NAME string, COLUMN_IV_KEY string").filter("COLUMN_NAME != 'C_NAME'")
    key = derive_key(PHRASE)
    c = encrypt.encrypt_by_column(t.customer.select("c_custkey", "c_name"), ivs, key)
    o = encrypt.encrypt_by_column(t.orders.select("o_custkey"), ivs, key)
    # equal ciphers of null keys don't exist, so the sides need no further test for null
    return (c.join(o, c["c_custkey"] == o["o_custkey"]).groupBy("c_custkey", "c_name")
            .agg(F.count("*").alias("orders")).select("c_name", "orders"))


@query("ae5_cipher_as_number_and_back", "SELECT c_custkey, c_name, 4 AS limbs FROM customer")
def _(t):
    key, iv = _aes_parts(t)
    sealed = t.customer.select("c_custkey", aes.aes_cbc_det(F.col("c_name"), key, iv).alias("cipher"))
    numbers = sealed.select("c_custkey", aes.cipher_to_limbs(F.col("cipher")).alias("limbs"))
    back = numbers.select("c_custkey", F.size("limbs").alias("limbs"), aes.limbs_to_cipher(F.col("limbs")).alias("cipher"))
    return back.select("c_custkey", aes.aes_cbc_det_decrypt(F.col("cipher"), key, iv).alias("c_name"), "limbs")


@query("ae6_key_from_alias", f"WITH {aes_sql.tables()} SELECT c_custkey, {_SEALED['C_NAME']} AS sealed FROM customer, aes")
def _(t):
    # the key stays in its subquery; that it is the right one shows in the cipher
    key = secret_column(t.spark, aes.key_from_alias("key1", {"key1": PHRASE, "key2": "another"}))
    return t.customer.select("c_custkey", F.hex(aes.aes_cbc_det(F.col("c_name"), key, F.lit(dict(IVS)["C_NAME"]).cast("binary"))).alias("sealed"))
