"""Cleaning a mapped export: dates, numbers, duplicates, required fields,
quantity and price checks, and the counted quality report.

The order of the steps is fixed (dates, future rows, numbers, duplicates,
nulls, quantity, price).  All checks are one projection that tags each row
with the first check it fails; the clean rows and the report both read that
tagged frame, so the report is a single aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens import config as C
from ledgerlens.config import DEFAULT, Params
from ledgerlens.functions.columns import ws_trim
from ledgerlens.operators import mapping as MP
from ledgerlens.operators.ranking import numbered
from ledgerlens.sources import files
from ledgerlens.sources.tables import written

# accepted date layouts, tried in order; the two groups of numbers swap places
# with ``Params.day_first``
ISO_DATES = ("yyyy-M-d", "yyyy/M/d")
DAY_FIRST = ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy")
MONTH_FIRST = ("M/d/yyyy", "M-d-yyyy", "M.d.yyyy")
NAMED_MONTHS = ("d-MMM-yyyy", "d MMM yyyy", "MMM d yyyy", "d-MMMM-yyyy", "d MMMM yyyy", "MMMM d yyyy")
DIGITS = r"\A[0-9]+(\.[0-9]+)?\z"
ISO_TEXT = r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"
TIME_OF_DAY = r"(?i)[T ]\s*\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[AP]M|[+-]\d{2}:?\d{2})?$"


def parse_date(c: Column, day_first: bool = True) -> Column:
    """The date of a text in any accepted layout, with or without a time of day
    (which is cut off), else null.

    A plain ISO date is cast.  Other texts are tried layout by layout inside ``transform``:
    fourteen parsers in the generated code of the projection make a method that the JVM
    does not compile, and a layout that does not fit costs an exception, so only those
    are tried whose signs the text has: a year has four digits at least, and layouts
    of numbers have no letters."""
    def bare(c: Column) -> Column:
        t = ws_trim(c)
        return F.when(t.contains(":"), F.regexp_replace(t, TIME_OF_DAY, "")).otherwise(t)

    def read(t: Column) -> Column:
        named = t.rlike("[A-Za-z]") & t.rlike("[0-9]")

        def tried(layout: str) -> Column:
            signs = [t.contains(s) for s in "-/. " if s in layout] + [named if "MMM" in layout else ~t.rlike("[A-Za-z]")]
            if layout.startswith("yyyy"):
                signs.append(F.instr(t, layout[4]) > 4)
            return F.when(reduce(Column.__and__, signs), F.try_to_date(t, layout))

        numbers = (*DAY_FIRST, *MONTH_FIRST) if day_first else (*MONTH_FIRST, *DAY_FIRST)
        return F.coalesce(*map(tried, (*ISO_DATES, *numbers, *NAMED_MONTHS)))

    texts = F.transform(F.transform(F.array(c), bare), lambda t: F.when(t.contains(", "), F.regexp_replace(t, ", ", " ")).otherwise(t))
    return F.when(c.rlike(ISO_TEXT), c.try_cast("date")).otherwise(F.transform(texts, read)[0])


def clean_dates(df: DataFrame, col: str = "transaction_date", p: Params = DEFAULT,
                drop_future: bool = True) -> DataFrame:
    """Lenient parse (unparseable -> null), rows dated after ``as_of`` removed
    (null dates pass), then written back as yyyy-MM-dd text."""
    d = parse_date(F.col(col), p.day_first)
    out = df.withColumn(col, d)
    if drop_future:
        out = out.where(F.col(col).isNull() | (F.col(col) <= F.lit(p.as_of)))
    return out.withColumn(col, F.date_format(F.col(col), "yyyy-MM-dd"))


def to_number(c: Column) -> Column:
    """Rupee signs, digit-group commas and outer blanks stripped; anything
    that is not a plain or exponent number becomes null,
    NaN included.  Instead of a regex per value: the text may hold only
    digits, sign, point and exponent letters, and ``try_cast`` rejects any
    arrangement of those that is not a number (so '12d' or 'NaN' never pass).
    Digits with at most a point between them, as most values are, are cast as they
    are: ``translate`` looks every character up."""
    c = c.cast("string")
    t = ws_trim(F.translate(c, "₹,", ""))
    plain = F.length(F.translate(t, "0123456789.+-eE", "")) == 0
    return F.when(c.rlike(DIGITS), c.try_cast("double")).when(plain & (F.length(t) > 0), t.try_cast("double"))


def clean_numeric(df: DataFrame, cols=C.NUMERIC_COLUMNS) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: to_number(F.col(c)) for c in present}) if present else df


def in_file_order(df: DataFrame, landed: bool = False) -> DataFrame:
    """The rows written once, with ``_order``: one long that ascends with (file,
    place of the split in it, row in the split).  Splits are numbered over all
    files (a table of a row per split), a row keeps its place in its split below
    that number.  ``landed`` rows are read from a table that already holds their
    place, and are not written again."""
    rows = df if landed else written(df, "typed")
    splits = rows.groupBy("_file_path", "_block_start").agg(F.min("_row_in_split").alias("_first"))
    splits = numbered(splits, [F.col("_file_path"), F.col("_block_start")], name="_split").select(
        F.col("_file_path").alias("_f"), F.col("_block_start").alias("_b"), "_first", "_split")
    here = (F.col("_file_path") == F.col("_f")) & (F.col("_block_start") == F.col("_b"))
    return rows.join(written(splits, "splits"), here).withColumn(
        "_order", F.shiftleft("_split", 33) + (F.col("_row_in_split") - F.col("_first"))).drop("_f", "_b", "_first", "_split")


def first_rows(df: DataFrame, key: str, order: str, candidates: Column | None = None) -> DataFrame:
    """Marks the first row (lowest ``order``, a long that no two rows share) of
    every ``key`` value, nulls forming one group; only rows meeting ``candidates``
    compete (the others get ``_is_first`` null).  The lowest number of a key is a
    partial + final hash aggregate, so a key holding a third of the rows costs one
    row per task; it is joined back on the number, which spreads a hot key."""
    pool = df if candidates is None else df.where(candidates)
    firsts = pool.groupBy(key).agg(F.min(order).alias("_f")).select("_f")
    flag = F.col("_f").isNotNull()
    if candidates is not None:
        flag = F.when(candidates, flag)
    return df.join(firsts, F.col(order) == F.col("_f"), "left").withColumn("_is_first", flag).drop("_f")


def quality_checks(df: DataFrame, required=C.CLEANER_REQUIRED) -> list[tuple[str, str, Column]]:
    """(check, action, failing-condition) in the order they are applied."""
    checks = []
    if "transaction_id" in df.columns:
        checks.append(("duplicate", "removed", ~F.col("_is_first")))
    for f in required:
        if f in df.columns:
            checks.append((f"null_{f}", "removed", F.col(f).isNull()))
    if "quantity" in df.columns:
        checks.append(("invalid_quantity", "removed", F.col("quantity").isNull() | (F.col("quantity") <= 0)))
    if "unit_price" in df.columns:
        checks.append(("invalid_price", "removed", F.col("unit_price").isNull() | (F.col("unit_price") <= 0)))
    return checks


def tag_quality(df: DataFrame, order: str, required=C.CLEANER_REQUIRED,
                live: Column | None = None) -> DataFrame:
    """Adds ``_dq_check``: the first check the row fails, null for a clean row.
    Only ``live`` rows are checked (rows already removed get null)."""
    if "transaction_id" in df.columns:
        df = first_rows(df, "transaction_id", order, live)
    tag = F.lit(None).cast("string")
    for name, _, cond in reversed(quality_checks(df, required)):
        tag = F.when(cond, F.lit(name)).otherwise(tag)
    if live is not None:
        tag = F.when(live, tag)
    return df.withColumn("_dq_check", tag)


# columns that reading and checking add to those of the files
BOOKKEEPING = (*files.BOOKKEEPING, "_order", "_unparsed", "_future", "_is_first", "_dq_check")


@dataclass
class Cleaned:
    system: str
    tagged: DataFrame          # every input row, with _future and _dq_check
    matches: list[dict]        # column matches (universal, expected, matched, score)
    unmatched: list[str]
    missing: list[str]         # required fields absent after mapping

    @property
    def rows(self) -> DataFrame:
        """Clean rows, without bookkeeping columns."""
        keep = [c for c in self.tagged.columns if c not in BOOKKEEPING or c == "_source_file"]
        # the (always true) test on the file-order id keeps the typing
        # projection's fence in place, so the filter reads computed columns
        clean = ~F.col("_future") & F.col("_dq_check").isNull() & (F.col("_row_in_split") >= 0)
        out = self.tagged.where(clean).select(*keep)
        return out.withColumnRenamed("_source_file", "source_file")


def clean_export(df: DataFrame, system: str | None = None, p: Params = DEFAULT,
                 collapse: bool = True, exclude_exact: bool = False, landed: bool = False) -> Cleaned:
    """Mapped, typed and tagged export.  ``df`` comes from ``files.read_csv``
    (all text plus file-order columns), or, ``landed``, from ``landing.layouts``."""
    data_cols = files.data_columns(df)
    if system is None:
        system, _ = MP.detect_system(data_cols)
    targets, matches, unmatched = MP.plan_columns(data_cols, system, collapse=collapse,
                                                  exclude_exact=exclude_exact)
    mapped = MP.apply_columns(df, targets)
    # one typing projection: dates, numbers, the future flag and the file-order
    # id.  The id is non-deterministic, which makes this projection a fence the
    # optimizer does not push filters through, so the conversions are computed
    # once here instead of again inside every later filter (see ``rows``).
    typed = {}
    if "transaction_date" in mapped.columns:
        d = parse_date(F.col("transaction_date"), p.day_first)
        typed["_unparsed"] = F.col("transaction_date").isNotNull() & d.isNull()
        typed["_future"] = F.coalesce(d > F.lit(p.as_of), F.lit(False))
        typed["transaction_date"] = F.date_format(d, "yyyy-MM-dd")
    else:
        typed["_unparsed"] = typed["_future"] = F.lit(False)
    typed.update({c: to_number(F.col(c)) for c in C.NUMERIC_COLUMNS if c in mapped.columns})
    place = F.monotonically_increasing_id()
    # landed rows keep the place they had in their file
    typed["_row_in_split"] = F.when(place >= 0, F.col("_row_in_split")) if landed else place
    mapped = mapped.withColumns(typed)
    if "transaction_id" in mapped.columns:  # the rows are read twice from here on
        mapped = in_file_order(mapped, landed)
    # duplicates are judged among the rows that survived the date step
    tagged = tag_quality(mapped, "_order", live=~F.col("_future"))
    missing = [f for f in C.CLEANER_REQUIRED if f not in mapped.columns]
    return Cleaned(system, tagged, matches, unmatched, missing)


def _counts(c: Cleaned) -> list[Column]:
    """The report's counts over the tagged rows; ``input_rows`` counts rows after the
    future-date step, as the reference does."""
    checks = quality_checks(c.tagged)
    live = ~F.col("_future")
    clean = live & F.col("_dq_check").isNull()
    out = [F.count_if(F.col("_future")).alias("future_date"), F.count_if(live).alias("input_rows")]
    out += [F.count_if(live & (F.col("_dq_check") == name)).alias(name) for name, _, _ in checks]
    out.append(F.count_if(live & F.col("_unparsed")).alias("unparsed_date"))
    if {"cost_price", "unit_price"} <= set(c.tagged.columns):
        out.append(F.count_if(clean & F.col("cost_price").isNotNull()
                              & (F.col("cost_price") > F.col("unit_price"))).alias("cost_above_price"))
    return [*out, F.count_if(clean).alias("final_rows")]


def _lines(c: Cleaned) -> list[tuple[str, str]]:
    """(check, action) of the report's lines with a count, in their order."""
    out = [("future_date", "removed_before_validation"), ("input_rows", "counted")]
    out += [(n, a) for n, a, _ in quality_checks(c.tagged)] + [("unparsed_date", "warned")]
    if {"cost_price", "unit_price"} <= set(c.tagged.columns):
        out.append(("cost_above_price", "warned"))
    return [*out, ("rows_removed", "counted"), ("final_rows", "counted")]


def _report(one: DataFrame, c: Cleaned) -> DataFrame:
    one = one.withColumn("rows_removed", F.col("input_rows") - F.col("final_rows"))
    entries = [f"'{n}', '{a}', CAST(`{n}` AS BIGINT)" for n, a in _lines(c)]
    # required fields absent after mapping: reported in the same row set, no count
    entries += [f"'missing_field:{m}', 'warned', CAST(NULL AS BIGINT)" for m in c.missing]
    rep = one.selectExpr("input_rows AS _input", f"stack({len(entries)}, {', '.join(entries)}) AS (check, action, rows)")
    pct = F.when(F.col("_input") > 0, F.round(F.col("rows") * 100.0 / F.col("_input"), 1))
    return rep.select("check", "action", "rows", pct.alias("pct_of_input"))


def quality_report(c: Cleaned) -> DataFrame:
    """(check, action, rows, pct_of_input): one aggregate over the tagged rows.
    Future rows are a line of their own and not part of ``rows_removed``."""
    return _report(c.tagged.agg(*_counts(c)), c)


def observed(c: Cleaned) -> tuple[Observation, Cleaned]:
    """The counts of the report as metrics that the pass which writes the rows takes
    (``.get`` of the observation, after it)."""
    seen = Observation("quality")
    return seen, replace(c, tagged=c.tagged.observe(seen, *_counts(c)))


def report_from(spark: SparkSession, c: Cleaned, counts: dict[str, int]) -> DataFrame:
    """The report of counts already observed."""
    schema = ", ".join(f"`{n}` long" for n in counts)
    return _report(spark.createDataFrame([tuple(counts.values())], schema), c)


def read_and_clean(spark: SparkSession, path: str, system: str | None = None, p: Params = DEFAULT,
                   encoding: str | None = None, collapse: bool = True) -> Cleaned:
    """CSV files -> cleaned (entry point of the cleaning stage)."""
    return clean_export(files.read_csv(spark, path, encoding), system, p, collapse=collapse)


def require_rows(final_rows: int) -> None:
    """Abort when cleaning left nothing (the count observed while the rows were written)."""
    if not final_rows:
        raise ValueError("All rows were removed during cleaning. Check the data quality.")
