"""Column-wide date order: evidence, decision, conversion.

Two modes.  csv: one order for the whole column.  mixed (workbooks, Parquet):
each value that can be read one way only is, and the others follow the only
order seen.  What cannot be decided is an error: `date_issues` gives it as a
row, and the conversion raises when it is run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.functions import expr as X

from .samples import with_samples

#: Groups whose evidence is read at once and sent to all tasks; of more, rows meet their group's in a join.
GROUPS = 10_000

COUNTS = ("n_values", "n_dmy", "n_mdy", "n_ambiguous", "n_ymd", "n_invalid")


def read_dates(df: DataFrame, text: Column) -> DataFrame:
    """df with d_a, d_b, d_year, d_first, d_time, d_hour, d_minute, d_second of each digit date, null for other text (see functions.expr.dated).

    The same parts in steps of their own, each computed once a row inside
    generated code, for scans over whole tables.
    """
    parted = df.withColumn("d_text", text).withColumn("d_marked", F.when(F.col("d_text").between("\t", ":"), F.regexp_replace("d_text", X.DIGIT_DATE, X.DATE_PARTS)))
    parted = parted.withColumn("d_parts", F.when(F.col("d_marked") != F.col("d_text"), F.split("d_marked", r"\|")))
    p = F.col("d_parts")
    found = parted.select(
        *df.columns, *[p[k].try_cast("int").alias(n) for k, n in enumerate(("d_a", "d_b", "d_year"))], (p[3] != "").alias("d_first"), (p[4] != "").alias("d_time"),
        F.when(p[4] != "", F.split(p[4], "[:.]")).alias("d_clock"), F.when(p[5] != "", F.upper(p[5])).alias("d_half"),
    )
    k, half = F.col("d_clock"), F.col("d_half")
    hour = F.get(k, F.lit(0)).try_cast("int")
    hour = F.when(k.isNull(), 0).when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(half == "PM", 12).otherwise(0)).otherwise(99)
    second = F.concat(F.coalesce(F.get(k, F.lit(2)), F.lit("0")), F.lit("."), F.rpad(F.coalesce(F.get(k, F.lit(3)), F.lit("0")), 6, "0")).try_cast("decimal(16,6)")
    minute = F.when(k.isNotNull(), F.get(k, F.lit(1)).try_cast("int")).otherwise(0)
    return found.select(
        *df.columns, "d_a", "d_b", "d_year", "d_first", "d_time", F.when(F.col("d_a").isNotNull(), hour).alias("d_hour"), minute.alias("d_minute"),
        F.when(k.isNotNull(), second).otherwise(F.lit(0).cast("decimal(16,6)")).alias("d_second"),
    )


def _moment(month: Column, day: Column) -> Column:
    return F.when((F.col("d_year") > 0) & (F.col("d_second") < 60), F.try_make_timestamp_ntz("d_year", month, day, "d_hour", "d_minute", "d_second"))


def read_orders(df: DataFrame, text: Column) -> DataFrame:
    """df with dmy, mdy, ymd (which readings of a digit date are valid; null for other text) and d_time."""
    a, b, first = F.col("d_a"), F.col("d_b"), F.col("d_first")
    both = read_dates(df, text).select(*df.columns, "d_time", "d_first", F.when(~first, _moment(b, a)).isNotNull().alias("d_dmy"), _moment(a, b).isNotNull().alias("d_mdy"))
    known = first.isNotNull()
    return both.select(*df.columns, "d_time", F.when(known, F.col("d_dmy")).alias("dmy"), F.when(known, F.col("d_mdy") & ~first).alias("mdy"), F.when(known, F.col("d_mdy") & first).alias("ymd"))


def order_evidence(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """n_values, n_dmy, n_mdy, n_ambiguous, n_ymd, n_invalid, has_time, a sample of invalid text: they add up over any split of the rows.

    `by` gives evidence for each of its groups, as for each file of a load.
    """
    read = read_orders(df.select(*(by or []), F.col(column).alias("t")), F.col("t"))
    filled, dmy, mdy, ymd = F.trim("t") != "", F.col("dmy"), F.col("mdy"), F.col("ymd")
    invalid = filled & ~F.coalesce(dmy | mdy | ymd, F.lit(False))
    return read.groupBy(*(by or [])).agg(
        F.count_if(filled).alias("n_values"), F.count_if(dmy & ~mdy).alias("n_dmy"), F.count_if(mdy & ~dmy).alias("n_mdy"),
        F.count_if(dmy & mdy).alias("n_ambiguous"), F.count_if(ymd).alias("n_ymd"), F.count_if(invalid).alias("n_invalid"),
        F.coalesce(F.bool_or("d_time"), F.lit(False)).alias("has_time"), F.min(F.when(invalid, F.col("t"))).alias("invalid_sample"),
    )


def invalid_samples(df: DataFrame, column: str, by: list[str] | None = None, most: int = 5) -> DataFrame:
    """n_invalid and invalid: how many filled values of each group are no digit dates, and the smallest few of them, distinct."""
    by = by or []
    read = read_orders(df.select(*by, F.col(column).alias("t")), F.col("t"))
    wrong = (F.trim("t") != "") & ~F.coalesce(F.col("dmy") | F.col("mdy") | F.col("ymd"), F.lit(False))
    rows = read.select(*by, F.when(wrong, F.col("t")).alias("bad"))
    return with_samples(rows.groupBy(*by).agg(F.count("bad").alias("n_invalid")), rows, by, "bad", "invalid", most)


def merge_evidence(evidence: DataFrame, by: list[str] | None = None) -> DataFrame:
    return evidence.groupBy(*(by or [])).agg(*[F.sum(c).alias(c) for c in COUNTS], F.bool_or("has_time").alias("has_time"), F.min("invalid_sample").alias("invalid_sample"))


def known_evidence(evidence: DataFrame) -> DataFrame | None:
    """Evidence without its sample of text as rows at hand, for several uses of one scan; None if it has more than GROUPS rows."""
    counts = evidence.drop("invalid_sample")
    rows = counts.limit(GROUPS + 1).collect()
    return counts.sparkSession.createDataFrame(rows, counts.schema) if len(rows) <= GROUPS else None


def resolve_order(evidence: DataFrame) -> DataFrame:
    """evidence with date_order: conflict, dayfirst, monthfirst or none; what is only ambiguous is dayfirst."""
    return evidence.withColumn(
        "date_order",
        F.when((F.col("n_dmy") > 0) & (F.col("n_mdy") > 0), "conflict").when(F.col("n_dmy") > 0, "dayfirst").when(F.col("n_mdy") > 0, "monthfirst").when(F.col("n_ambiguous") > 0, "dayfirst").otherwise("none"),
    )


def decision(mode: str, us: bool) -> tuple[Column, Column]:
    """From evidence: the error (null if none) and whether the day comes first where a value does not say."""
    dmy, mdy, open_ = F.col("n_dmy") > 0, F.col("n_mdy") > 0, F.col("n_ambiguous") > 0
    if us:
        return F.when(dmy, "FORCED_US_BUT_DAY_FIRST"), F.lit(False)
    if mode == "mixed":
        return F.when(open_ & (dmy == mdy), "AMBIGUOUS_DATES"), dmy
    return F.when(dmy & mdy, "CONFLICTING_DATE_ORDERS"), dmy | ~mdy


def date_issues(df: DataFrame, column: str, us: bool = False, mode: str = "csv", by: list[str] | None = None, evidence: DataFrame | None = None) -> DataFrame:
    """severity, code, column_name, detail for a column (or its groups) whose dates cannot be decided; free text is no issue, as such a column stays text."""
    e = order_evidence(df, column, by) if evidence is None else evidence
    error, _ = decision(mode, us)
    found = e.where("n_invalid = 0").withColumn("code", error).where("code is not null")
    detail = F.format_string("day first %d, month first %d, either %d", "n_dmy", "n_mdy", "n_ambiguous")
    return found.select(*(by or []), F.lit("ERROR").alias("severity"), "code", F.lit(column).alias("column_name"), detail.alias("detail"))


def to_timestamp(text: Column, order: str) -> Column:
    return X.parse_date(text, F.lit(order != "monthfirst"))


def normalise_dates(df: DataFrame, column: str, out: str, us: bool = False, mode: str = "csv", by: list[str] | None = None, text_out: str | None = None, evidence: DataFrame | None = None) -> DataFrame:
    """df with `out`: the column as timestamps by its own order, or by that of each group of `by` (as each file's).

    A column (or group) that holds other text is left as it is: `out` is null,
    and text_out, if named, holds its text unchanged and ISO text elsewhere.
    What cannot be decided raises when the result is used.  The evidence of groups
    is read when this is called, unless it is given (as of known_evidence), and
    goes to the rows, which stay where they are: a file of any size is not sent to
    one task.
    """
    error, day_leads = decision(mode, us)
    if by and evidence is None:
        evidence = known_evidence(order_evidence(df, column, by))
    e = (order_evidence(df, column, by) if evidence is None else evidence).select(*[F.col(c).alias(f"by_{k}") for k, c in enumerate(by or [])], (F.col("n_invalid") == 0).alias("dates_only"), error.alias("error"), day_leads.alias("day_leads"))
    lead = F.col("e.day_leads")
    a, b, first = F.col("d_a"), F.col("d_b"), ~F.col("d_first")
    if mode == "mixed" and not us:
        lead = F.when(a > 12, True).when(b > 12, False).otherwise(lead)
    value = _moment(F.when(first & lead, b).otherwise(a), F.when(first & lead, a).otherwise(b))
    failed = F.raise_error(F.concat_ws(" ", F.col("e.error"), F.lit(f"in column {column}"))).cast("timestamp_ntz")
    value = F.when(F.col("e.dates_only"), F.when(F.col("e.error").isNotNull(), failed).otherwise(value))
    one = e.select(F.struct("*").alias("e"))
    if by:
        same = None
        for k, c in enumerate(by):
            part = F.col(c).eqNullSafe(F.col(f"e.by_{k}"))
            same = part if same is None else same & part
        joined = df.join(one if evidence is None else F.broadcast(one), same)  # GROUPS rows at most are broadcast
    else:
        joined = df.crossJoin(F.broadcast(one))  # one row
    t = F.col(column)
    dated = read_dates(joined, t).select(*joined.columns, value.alias(out))
    if text_out:
        midnight = F.col(out) == F.date_trunc("day", out)
        iso = F.when(midnight, F.date_format(out, "yyyy-MM-dd")).otherwise(F.col(out).cast("string"))
        dated = dated.withColumn(text_out, F.when(F.col("e.dates_only"), iso).otherwise(t))
    return dated.drop("e")
