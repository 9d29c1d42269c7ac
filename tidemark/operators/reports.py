"""Report text to tables.

Input is a frame of lines (doc_id, line_no, line), ``line_no`` rising within a document.
Many documents run in one job; a document of any length spreads over tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.ranks import (
    CHUNK_ROWS, last_before, last_so_far, ordered_scan, previous_value, row_number_by, running_sum, sum_so_far,
)
from tidemark.operators.relational import first_per_key
from tidemark.session import cut_lineage

DOC, NO, LINE = "doc_id", "line_no", "line"

# fixed phrases of the collateral report
AS_OF = "AS OF"
TOTAL_FOR = "Total For :"
NOISE = ("Accrued", "MOODY S&P FITCH")
FUND = "Mutual Fund"
TRIGGER = "LENDING COLLATERAL"
RATING = "Aaa"
NOT_RATED = "N/R N/R N/R"


def _contains(text: str) -> Column:
    return F.contains(LINE, F.lit(text))


def between_markers(lines: DataFrame, start: str, end: str, mode: str = "contains") -> DataFrame:
    """Lines from the i-th start marker to the i-th end marker of a document, both included.

    ``contains`` looks for both texts anywhere and wants the end on a later line;
    ``equals_prefix`` wants a line equal to ``start`` and one that begins with ``end``.
    Overlapping ranges repeat their lines, told apart by ``pair``.
    """
    if mode == "contains":
        is_start, is_end, valid = _contains(start), _contains(end), F.col("_s") < F.col("_e")
    elif mode == "equals_prefix":
        is_start, is_end, valid = F.col(LINE) == start, F.startswith(LINE, F.lit(end)), F.col("_s") <= F.col("_e")
    else:
        raise ValueError(f"unknown mode {mode}")
    marks = lines.filter(is_start | is_end).select(DOC, F.col(NO).cast("bigint").alias(NO), is_start.alias("_start"), is_end.alias("_end"))
    counted = ordered_scan(marks, [DOC], NO, {
        "_ns": sum_so_far(F.col("_start").cast("int")), "_ne": sum_so_far(F.col("_end").cast("int"))})
    # the i-th start and the i-th end meet in one group; a line may be both
    ends = F.array_compact(F.array(
        F.when(F.col("_start"), F.struct(F.col("_ns").alias("pair"), F.col(NO).alias("s"), F.lit(None).cast("bigint").alias("e"))),
        F.when(F.col("_end"), F.struct(F.col("_ne").alias("pair"), F.lit(None).cast("bigint").alias("s"), F.col(NO).alias("e")))))
    ranges = (counted.select(DOC, F.explode(ends).alias("m")).groupBy(DOC, F.col("m.pair").alias("pair"))
              .agg(F.max("m.s").alias("_s"), F.max("m.e").alias("_e")).filter(valid))
    # a range becomes its line numbers, block by block, and those an equi join: no range join within a document
    blocks = ranges.withColumn("_b", F.explode(F.sequence(F.floor(F.col("_s") / CHUNK_ROWS), F.floor(F.col("_e") / CHUNK_ROWS))))
    numbers = blocks.select(DOC, "pair", F.explode(F.sequence(
        F.greatest(F.col("_s"), F.col("_b") * CHUNK_ROWS),
        F.least(F.col("_e"), F.col("_b") * CHUNK_ROWS + (CHUNK_ROWS - 1)))).alias(NO))
    return numbers.join(lines.withColumn(NO, F.col(NO).cast("bigint")), [DOC, NO]).select(DOC, "pair", *[c for c in lines.columns if c != DOC])


def drop_noise(lines: DataFrame, equal: tuple[str, ...] = NOISE, contains: tuple[str, ...] = ()) -> DataFrame:
    kept = ~F.col(LINE).isin(*equal)
    for text in contains:
        kept = kept & ~_contains(text)
    return lines.filter(kept)


def section_ids(lines: DataFrame, start: str = AS_OF, end: str = TOTAL_FOR, out: str = "section") -> DataFrame:
    """Number of the open section, 0 outside; the end line belongs to its section."""
    scanned = ordered_scan(lines, [DOC], NO, {
        "_n": sum_so_far(_contains(start).cast("int")),
        "_opened": last_so_far(F.when(_contains(start), F.col(NO))),
        "_closed": last_before(F.when(_contains(end), F.col(NO))),
    })
    is_open = F.col("_opened").isNotNull() & (F.col("_closed").isNull() | (F.col("_opened") > F.col("_closed")))
    return scanned.withColumn(out, F.when(is_open, F.col("_n")).otherwise(0)).drop("_n", "_opened", "_closed")


def _account_name() -> Column:
    name = F.split_part(F.get(F.split(LINE, ":", 2), F.lit(1)), F.lit("$"), F.lit(1))
    return F.when(_contains(TOTAL_FOR), F.btrim(name))


def _as_of_date() -> Column:
    return F.when(_contains(AS_OF), F.get(F.split(LINE, "OF", 2), F.lit(1)))


def account_names(lines: DataFrame) -> DataFrame:
    """Text after the first ':' and before the first '$' of the total lines."""
    return lines.filter(_contains(TOTAL_FOR)).select(DOC, "section", _account_name().alias("account_name"))


def as_of_dates(lines: DataFrame) -> DataFrame:
    return lines.filter(_contains(AS_OF)).select(DOC, "section", _as_of_date().alias("as_of_date"))


def market_values(lines: DataFrame) -> DataFrame:
    """Type and market value of fund, cash and debenture lines, from one pass over a rule table."""
    rules = [(1, _contains("Mutual Fund ")), (2, F.startswith(LINE, F.lit("USD "))), (3, _contains("Debentures "))]
    kinds = F.array_compact(F.array(*[F.when(test, F.lit(kind)) for kind, test in rules]))
    parts = F.split(LINE, r"\$", 5)
    return lines.select(
        DOC, "section", NO, F.explode(kinds).alias("kind"), F.get(parts, F.lit(0)).alias("collateral_type"),
        F.concat(F.lit("$"), F.get(parts, F.lit(2))).alias("market_value"))


def cash_identifiers(lines: DataFrame) -> DataFrame:
    """First Cash-USD line of each section: identifier and description by blanks."""
    cash = lines.filter(F.startswith(LINE, F.lit("Cash-USD"))).select(DOC, "section", NO, LINE)
    parts = F.split(LINE, " ", 3)
    return first_per_key(cash, [DOC, "section"], [NO]).select(
        DOC, "section", NO, F.get(parts, F.lit(0)).alias("cusip"), F.get(parts, F.lit(1)).alias("security_description"))


def fund_identifiers(lines: DataFrame) -> DataFrame:
    """Fund identifier and description, with the continuation lines that follow the main line."""
    inside = between_markers(lines, FUND, f"{FUND} $", "equals_prefix").filter(~_contains(FUND) & ~_contains(RATING))
    main = F.size(F.filter(F.split(F.btrim(LINE), r"\s+"), lambda token: token != "")) >= 10
    grouped = running_sum(cut_lineage(inside.withColumn("_main", main)), [DOC], NO, F.col("_main").cast("int"), "_group")
    text = F.when(F.col("_main"), F.regexp_replace(
        F.split_part(F.get(F.split(LINE, " ", 2), F.lit(1)), F.lit("%"), F.lit(1)), r"\d.*", "")
    ).otherwise(F.replace(LINE, F.lit(NOT_RATED), F.lit("")))
    rows = grouped.filter("_group > 0").groupBy(DOC, "pair", "_group").agg(
        F.min_by("section", NO).alias("section"), F.min(NO).alias(NO),
        F.split_part(F.min_by(LINE, NO), F.lit(" "), F.lit(1)).alias("cusip"),
        # the main line sorts first; its few continuation lines follow in order
        F.array_sort(F.collect_list(F.struct(F.col(NO), text.alias("t")))).alias("parts"))
    return rows.select(DOC, "section", NO, "cusip",
                       F.array_join(F.transform("parts", lambda p: p["t"]), " ").alias("security_description"))


def debenture_identifiers(lines: DataFrame) -> DataFrame:
    """Identifier and description on the line after a line equal to 'Debentures'."""
    after = previous_value(lines, [DOC], NO, F.col(LINE) == "Debentures", "_after").filter("_after")
    parts = F.split(LINE, " ", 2)
    return after.select(DOC, "section", NO, F.get(parts, F.lit(0)).alias("cusip"),
                        F.regexp_replace(F.get(parts, F.lit(1)), r"\d.*", "").alias("security_description"))


def assemble(lines: DataFrame) -> DataFrame:
    """Securities with account and date: identifiers and values meet by rank within a section."""
    empty = F.lit(None).cast("string")
    parts = [frame.select(DOC, "section", NO, F.lit(kind).alias("kind"), F.lit(True).alias("named"), "cusip", "security_description",
                          empty.alias("collateral_type"), empty.alias("market_value"))
             for kind, frame in ((1, fund_identifiers(lines)), (2, cash_identifiers(lines)), (3, debenture_identifiers(lines)))]
    parts.append(market_values(lines).select(DOC, "section", NO, "kind", F.lit(False).alias("named"), empty.alias("cusip"),
                                             empty.alias("security_description"), "collateral_type", "market_value"))
    # identifiers and values of a section are numbered by kind, then line; the n-th of each meet in one row
    order = Window.partitionBy(DOC, "section").orderBy("named", "kind", NO)
    values = F.count_if(~F.col("named")).over(Window.partitionBy(DOC, "section"))
    place = F.row_number().over(order)
    ranked = reduce(DataFrame.unionByName, parts).withColumn("rank", F.when(F.col("named"), place - values).otherwise(place).cast("bigint"))
    fields = ("cusip", "security_description", "collateral_type", "market_value")
    securities = ranked.groupBy(DOC, "section", "rank").agg(*[F.max(c).alias(c) for c in fields])
    heads = lines.filter(_contains(AS_OF) | _contains(TOTAL_FOR)).groupBy(DOC, "section").agg(
        F.max(_as_of_date()).alias("as_of_date"), F.max(_account_name()).alias("account_name"))
    return heads.join(securities, [DOC, "section"], "right").select(DOC, "section", "rank", "as_of_date", "account_name", *fields)


def extract_report(lines: DataFrame) -> DataFrame:
    """Lines of all documents to the securities table."""
    # eight readers share the sections, so they are written once
    return assemble(cut_lineage(section_ids(drop_noise(lines)).filter("section > 0")))


def document_status(securities: DataFrame, documents: DataFrame) -> DataFrame:
    """Per document, the rows found and whether a field is missing."""
    lacking = F.col("account_name").isNull() | F.col("as_of_date").isNull() | F.col("market_value").isNull()
    counts = securities.groupBy(DOC).agg(F.count("*").alias("rows"), F.count(F.when(lacking, 1)).alias("incomplete"))
    return documents.select(DOC).distinct().join(counts, DOC, "left").select(
        DOC, F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("incomplete", F.lit(0)).alias("incomplete"),
        F.when(F.col("rows").isNull(), "ERROR: no rows").when(F.col("incomplete") > 0, "ERROR: missing fields").otherwise("OK").alias("status"))


# --- pages and table cells ---------------------------------------------------------

# fixed: a three-part object name, blanks allowed around the dots
LABEL = r"(?i)\b([A-Za-z_][\w$]*)\s*\.\s*([A-Za-z_][\w$]*)\s*\.\s*([A-Za-z_][\w$]*)\b"


def first_page_with(pages: DataFrame, doc: str, page: str, text: str, anchor: str, start_page: int = 1) -> DataFrame:
    """First page of each document that holds the anchor; null when none does."""
    found = F.contains(F.coalesce(text, F.lit("")), F.lit(anchor)) & (F.col(page) >= start_page)
    return pages.groupBy(doc).agg(F.min(F.when(found, F.col(page))).alias("first_page"))


def find_label(text: Column) -> Column:
    """(db, schema, table) of the first three-part name, null when there is none."""
    part = lambda i: F.regexp_extract(text, LABEL, i)
    return F.when(text.rlike(LABEL), F.struct(part(1).alias("db"), part(2).alias("schema"), part(3).alias("table")))


def keep_three_columns(df: DataFrame, names: tuple[str, str, str] = ("column_name", "description", "comments")) -> DataFrame:
    """Cells of a three-column table under standard names, without blank rows."""
    cells = [F.nullif(F.btrim(F.col(n)), F.lit("")).alias(n) for n in names]
    others = [c for c in df.columns if c not in names]
    return df.select(*others, *cells).filter(F.coalesce(*names).isNotNull())


def drop_header_rows(df: DataFrame) -> DataFrame:
    """Drop repeated heading rows of a dictionary table."""
    low = lambda c: F.lower(F.btrim(F.coalesce(c, F.lit(""))))
    heading = (low("column_name").rlike(r"^column(\s*name)?$") & (low("description") == "description")
               & low("comments").rlike(r"^comments(\s*/\s*notes)?$"))
    return df.filter(~heading)


def merge_continuations(df: DataFrame, keys: list[str], pos: str, key: str, fields: list[str]) -> DataFrame:
    """Rows without a key append their texts to the row above; leading ones form a row of their own."""
    def clean(c):
        text = F.btrim(F.coalesce(F.col(c).cast("string"), F.lit("")))
        return F.when(F.lower(text).isin("<na>", "nan", "none"), "").otherwise(text)

    rows = df.select(*keys, pos, *[clean(c).alias(c) for c in (key, *fields)])
    grouped = running_sum(rows, keys, pos, (F.col(key) != "").cast("int"), "_group")
    joined = [
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.when(F.col(c) != "", F.struct(F.col(pos), F.col(c).alias("t"))))),
            lambda p: p["t"]), " ").alias(c)
        for c in fields]
    return grouped.groupBy(*keys, "_group").agg(F.min(pos).alias(pos), F.max(key).alias(key), *joined).drop("_group")


def words_to_lines(words: DataFrame, keys: list[str], tolerance: float = 3.0) -> DataFrame:
    """Words (top, x0, text) to lines: a gap in ``top`` above the tolerance starts a new line."""
    # each scan reads its input twice, so the ranked words are written once
    placed = cut_lineage(row_number_by(words, keys, ["top", "x0", "text"], "_pos"))
    gaps = previous_value(placed, keys, "_pos", F.col("top"), "_above")
    new = F.col("_above").isNull() | (F.col("top") - F.col("_above") > tolerance)
    numbered = running_sum(gaps, keys, "_pos", new.cast("int"), "line_no")
    return numbered.groupBy(*keys, "line_no").agg(
        F.min("top").alias("top"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "_pos", "text"))), lambda w: w["text"]), " ").alias("line"))


def label_tables(labels: DataFrame, tables: DataFrame, max_scan: float = 700.0) -> DataFrame:
    """Give each table (doc_id, page, top, bottom, …) the label (doc_id, page, y, label) it falls under.

    The nearest label above on its page within ``max_scan`` becomes the active one;
    labels below the last table of a page, or on a page without tables, hold for what follows.
    """
    page = [DOC, "page"]
    extra = [c for c in tables.columns if c not in (*page, "top", "bottom")]
    marks = labels.select(*page, F.col("y"), F.lit(0).alias("_kind"), "label", F.struct(
        *[F.lit(None).cast(tables.schema[c].dataType).alias(c) for c in ("top", "bottom", *extra)]).alias("_t"))
    boxes = tables.select(*page, F.col("top").alias("y"), F.lit(1).alias("_kind"), F.lit(None).cast("string").alias("label"),
                          F.struct("top", "bottom", *extra).alias("_t"))
    # at one height the table comes first: a label counts as above only when strictly so
    events = row_number_by(marks.unionByName(boxes), page, [F.col("y"), F.col("_kind").desc(), F.col("label")], "_in_page")
    near = ordered_scan(cut_lineage(events), page, "_in_page", {
        "_near": last_so_far(F.when(F.col("_kind") == 0, F.struct("y", "label")))})
    last = tables.groupBy(*page).agg(F.max("bottom").alias("_last"))
    held = near.join(last, page, "left").withColumn(
        "_set", F.when(F.col("_kind") == 1, F.when(F.col("y") - F.col("_near.y") <= max_scan, F.col("_near.label")))
        .when(F.col("_last").isNull() | (F.col("y") > F.col("_last")), F.col("label")))
    ordered = row_number_by(cut_lineage(held), [DOC], [F.col("page"), F.col("_kind").desc(), F.col("_in_page")], "_n")
    active = ordered_scan(cut_lineage(ordered), [DOC], "_n", {"active_label": last_so_far(F.col("_set"))})
    return active.filter("_kind = 1").select(
        *page, F.col("_t.top").alias("top"), F.col("_t.bottom").alias("bottom"), *[F.col("_t")[c].alias(c) for c in extra], "active_label")
