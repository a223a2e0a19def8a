"""Statistics of all columns of a table in one scan, and what they say about types.

Statistics add up: those of two tables, taken together by merge_statistics, are
those of their union.  Each cell is read once (read_cells), and
partial results are a few numbers a column, so the shuffle does not grow with rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatewright.functions import expr as X

from .dates import read_orders

#: name: (statistic of a group of cells from what read_cells says, how statistics are put together)
STATISTICS = {
    "rows": (lambda: F.count(F.lit(1)), F.sum),
    "nulls": (lambda: F.count_if(F.col("t").isNull()), F.sum),
    "max_len": (lambda: F.coalesce(F.max(F.length("t")), F.lit(0)), F.max),
    "filled": (lambda: F.count("s"), F.sum),
    "numbers": (lambda: F.count_if("number"), F.sum),
    "max_total": (lambda: F.max("total"), F.max),
    "max_fraction": (lambda: F.max("fraction"), F.max),
    "has_point": (lambda: F.coalesce(F.bool_or("point"), F.lit(False)), F.bool_or),
    "max_abs": (lambda: F.max("size"), F.max),
    "date_like": (lambda: F.count_if("like_date"), F.sum),
    "n_dmy": (lambda: F.count_if(F.col("dmy") & ~F.col("mdy")), F.sum),
    "n_mdy": (lambda: F.count_if(F.col("mdy") & ~F.col("dmy")), F.sum),
    "n_dates": (lambda: F.count_if(F.col("dmy") | F.col("mdy") | F.col("ymd")), F.sum),
    "has_time": (lambda: F.coalesce(F.bool_or("d_time"), F.lit(False)), F.bool_or),
    "bits": (lambda: F.count_if("bit"), F.sum),
}


CODE_PATTERN = r"^[A-Za-z0-9][A-Za-z0-9_./-]*$"


def as_text(df: DataFrame, column: str) -> Column:
    """A column as text; a timestamp at midnight is a date."""
    c = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, T.TimestampType | T.TimestampNTZType):
        return F.when(c == F.date_trunc("day", c), F.date_format(c, "yyyy-MM-dd")).otherwise(c.cast("string"))
    return c.cast("string")


def read_cells(cells: DataFrame) -> DataFrame:
    """cells (t, text) with s (stripped, null if blank) and what each is: number, total, fraction, point, size, like_date, dmy, mdy, ymd, d_time, bit.

    Each question is asked once, in a step of its own, so that nothing is
    computed twice and all of it stays in generated code.
    """
    given = cells.columns
    stripped = cells.withColumn("s", F.nullif(X.strip(F.col("t")), F.lit("")))
    s = F.col("s")
    # only text that begins with a sign, a point or a digit can be a number
    known = stripped.withColumn("number", F.when(s.isNotNull(), s.between("+", ":") & s.rlike(X.NUMBER)))
    number = F.col("number")
    known = known.withColumn("power", F.when(number & (F.contains(s, F.lit("e")) | F.contains(s, F.lit("E"))), F.coalesce(F.substring_index(F.lower(s), "e", -1).try_cast("int"), F.lit(0))))
    mantissa = F.when(F.col("power").isNull(), s).otherwise(F.substring_index(F.lower(s), "e", 1))
    known = known.withColumn("m", F.when(number, F.ltrim(mantissa, F.lit("+-"))))
    known = known.withColumn("part", F.when(F.contains("m", F.lit(".")), F.length("m") - F.instr("m", ".")).otherwise(0))
    known = known.withColumns({"shift": F.coalesce("power", F.lit(0)) - F.col("part"), "digits": F.length(F.ltrim(F.when(F.col("part") > 0, F.replace("m", F.lit("."), F.lit(""))).otherwise(F.rtrim("m", F.lit("."))), F.lit("0")))})
    zero = F.lit(0)
    known = known.select(
        *given, "s", "number", F.when(number, F.greatest(F.col("digits") + F.greatest("shift", zero), -F.col("shift"), F.lit(1))).alias("total"),
        F.when(number, F.greatest(-F.col("shift"), zero)).alias("fraction"), (number & (F.col("power").isNotNull() | F.contains("m", F.lit(".")))).alias("point"),
        F.when(number, F.abs(s.try_cast("double"))).alias("size"), F.when(s.isNotNull() & ~number & s.between("0", ":"), s).alias("digit"),
        F.when(s.isNotNull(), F.when(F.length(s) <= 5, F.lower(s).isin(*X.TRUE_TOKENS, *X.FALSE_TOKENS)).otherwise(False)).alias("bit"),
    )
    dated = read_orders(known, F.col("digit"))
    return dated.withColumn("like_date", F.when(s.isNotNull(), F.col("dmy").isNotNull() | F.coalesce(F.col("digit").rlike(X.DATE_LIKE), F.lit(False))))


def column_statistics(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """One row for each column (and each group of `by`): column_name, ordinal, is_text and the statistics, with all_number, all_date and all_bit.

    Columns are melted to cells, so that the code for one cell serves all of
    them, however many there are, and combined on the map side.
    """
    by = by or []
    columns = columns or [c for c in df.columns if c not in by]
    cells = df.select(*by, F.posexplode(F.array(*[as_text(df, c) for c in columns])).alias("k", "t"))
    found = read_cells(cells).groupBy(*by, "k").agg(*[f().alias(n) for n, (f, _) in STATISTICS.items()])
    names = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(isinstance(df.schema[c].dataType, T.StringType)).alias("is_text")) for c in columns])
    if not by:  # a row for each column also of an empty table
        empty = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("k"))
        found = empty.join(found, "k", "left").fillna(0, [n for n in STATISTICS if n not in ("has_point", "has_time", "max_total", "max_fraction", "max_abs")]).fillna(False, ["has_point", "has_time"])
    named = found.withColumn("name", names[F.col("k")])
    return with_verdicts(named.select(*by, "name.column_name", (F.col("k") + 1).alias("ordinal"), "name.is_text", *STATISTICS))


def with_verdicts(stats: DataFrame) -> DataFrame:
    filled = F.col("filled")
    return stats.withColumns({f"all_{n}": (filled > 0) & (F.col(c) == filled) for n, c in (("number", "numbers"), ("date", "date_like"), ("bit", "bits"))})


def merge_statistics(stats: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Statistics of several tables (sheets, files) taken together, by column name in lower case; the place is the first one's."""
    key = F.lower(F.trim("column_name"))
    merged = stats.groupBy(*(by or []), key.alias("k")).agg(
        F.min_by("column_name", "ordinal").alias("column_name"), F.min("ordinal").alias("ordinal"), F.bool_or("is_text").alias("is_text"), *[put(n).alias(n) for n, (_, put) in STATISTICS.items()]
    )
    return with_verdicts(merged.drop("k"))


#: Registers of a sketch are 2 to this power: 1.6 % standard error, 4 kB a column at most.
SKETCH_BITS = 12


def column_sketches(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """by, column_name, rows, nulls and sketch: a sketch of each column's distinct values, kept with a file's profile so that the file need not be read again.

    One scan; a task passes on a sketch a column and group, whatever the number of values.
    """
    by = by or []
    columns = columns or [c for c in df.columns if c not in by]
    cells = df.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), as_text(df, c).alias("t")) for c in columns])))
    return cells.groupBy(*by, "column_name").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("t").isNull()).alias("nulls"), F.hll_sketch_agg("t", SKETCH_BITS).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The sketches of several files or sheets taken together: those of all their rows, without a scan of any."""
    return sketches.groupBy(*(by or []), "column_name").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.hll_union_agg("sketch").alias("sketch"))


def key_bounds(sketches: DataFrame, slack: float = 0.1) -> DataFrame:
    """sketches with n_distinct (about) and may_be_key: without nulls, and not surely with repeated values (slack is six standard errors)."""
    n = F.hll_sketch_estimate("sketch")
    return sketches.withColumn("n_distinct", n).withColumn("may_be_key", (F.col("nulls") == 0) & (n >= (1 - slack) * F.col("rows")))


def native_family(kind: T.DataType) -> str:
    """What a column's own type says, before any of its text is read."""
    if isinstance(kind, T.NumericType):
        return "numeric"
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        return "datetime"
    return "bool" if isinstance(kind, T.BooleanType) else "string"


def family(stats: DataFrame, schema: T.StructType | None = None, destination: Column | None = None) -> DataFrame:
    """statistics with source_family: 'any' if all is null; else what the column's type in schema says, unless that is text.

    Text is of the destination's family (a column of stats) if all its filled
    values are, and string otherwise, whatever else they look like.  Without a
    destination it is of the first family that fits: numeric, datetime, bool.
    """
    native = F.lit("string")
    if schema is not None:
        typed = {f.name: native_family(f.dataType) for f in schema}
        native = F.coalesce(F.create_map(*[F.lit(x) for pair in typed.items() for x in pair])[F.col("column_name")], native)
    due = lambda name: F.lit(True) if destination is None else F.coalesce(destination == name, F.lit(False))
    kind = (
        F.when(F.col("nulls") == F.col("rows"), "any").when(native != "string", native).when(F.col("all_number") & due("numeric"), "numeric")
        .when(F.col("all_date") & due("datetime"), "datetime").when(F.col("all_bit") & due("bool"), "bool").otherwise("string")
    )
    return stats.withColumn("source_family", kind)


def narrowest_type(stats: DataFrame, padding: float = 0.2, us_dates: bool = False) -> DataFrame:
    """statistics with inferred (raw form, see merge_types) and raw_type (written out): the narrowest type that holds every value.

    Columns of text whose name says business text stay text.  Dates must all be
    digit dates without a conflict of orders (none with the day first if
    us_dates); a time of day anywhere makes them date-times.
    """
    total, fraction = F.col("max_total"), F.col("max_fraction")
    precision = F.greatest(F.lit(X.MIN_PRECISION), total, fraction + 1)
    decimal = F.when((fraction <= X.MAX_SCALE) & (precision <= X.MAX_PRECISION), F.concat_ws(":", F.lit("DECIMAL"), precision.cast("string"), fraction.cast("string"))).otherwise("FLOAT")
    text = F.concat(F.lit("VARCHAR:"), F.col("max_len").cast("string"))
    orders = F.col("n_dmy") == 0 if us_dates else (F.col("n_dmy") == 0) | (F.col("n_mdy") == 0)
    kind = (
        F.when(F.col("nulls") == F.col("rows"), "VARCHAR(255)")
        .when(F.col("is_text") & F.col("column_name").rlike(X.TEXT_NAME), text)
        .when((F.col("filled") > 0) & (F.col("n_dates") == F.col("filled")) & orders, F.when(F.col("has_time"), "DATETIME2(3)").otherwise("DATE"))
        .when(F.col("all_number"), F.when(F.col("has_point"), decimal).when(F.col("max_abs") <= X.MAX_INT, "INT").otherwise("BIGINT"))
        .when(F.col("all_bit"), "BIT")
        .otherwise(text)
    )
    return stats.withColumn("inferred", kind).withColumn("raw_type", X.finalise_type(F.col("inferred"), padding))


def code_like(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, code_like: short words of even length made of letters and digits, judged over all filled values in one scan."""
    parts = []
    for k, c in enumerate(columns):
        v = F.when(F.trim(F.col(c).cast("string")) != "", F.trim(F.col(c).cast("string")))
        n = F.length(v)
        share = lambda rule: F.avg(rule.cast("int"))
        spread = F.coalesce(F.stddev_samp(n), F.lit(0.0)) / F.avg(n)
        rule = (F.max(n) <= 50) & ~F.bool_or(v.rlike(r"\s")) & (spread <= 0.40) & (share(v.rlike(CODE_PATTERN)) >= 0.8) & (share(v.rlike("[A-Za-z]") & v.rlike("[0-9]")) >= 0.7)
        parts.append(F.coalesce(rule, F.lit(False)).alias(f"r{k}"))
    one = df.agg(*parts)
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"r{k}").alias("code_like")) for k, c in enumerate(columns)])))
