"""Key checks: duplicates within a load, conflicts with a target, and the search for a key."""

from __future__ import annotations

import re
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewright.functions import expr as X

from .profile import code_like, column_statistics, key_bounds, narrowest_type
from .samples import with_samples


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each key that occurs more than once, with n; null keys group together.  One shuffle of keys, combined on the map side."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """dup_groups, dup_rows."""
    return duplicate_groups(df, keys).agg(F.count("*").alias("dup_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("dup_rows"))


def duplicate_samples(df: DataFrame, keys: list[str], by: list[str], most: int = 5) -> DataFrame:
    """dup_groups, dup_rows and samples (keys as text, joined by a bar, the smallest few) of each load; a null is an empty text in a sample."""
    groups = df.groupBy(*by, *keys).agg(F.count("*").alias("n"))
    text = F.array_join(F.array(*[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys]), "|")
    rows = groups.select(*by, "n", F.when(F.col("n") > 1, text).alias("key"))
    counts = rows.groupBy(*by).agg(F.count("key").alias("dup_groups"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("dup_rows"))
    return with_samples(counts, rows, by, "key", "samples", most)


def seen_before(df: DataFrame, keys: list[str], batch: str) -> DataFrame:
    """Each key and batch in which the key stands though an earlier batch had it; one row however often it repeats there."""
    each = df.select(*keys, batch).distinct()
    earlier = F.min(batch).over(Window.partitionBy(*keys))
    return each.withColumn("_first", earlier).where(F.col(batch) > F.col("_first")).drop("_first")


def key_conflicts(staged: DataFrame, target: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Distinct staged keys that the target holds; a null never matches."""
    t = target.select(*[F.col(v).alias(k) for k, v in pairs.items()])
    return staged.select(*pairs).distinct().join(t, list(pairs), "left_semi")


def test_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """null_rows, distinct_keys, duplicate_rows of one combination of columns."""
    has_null = F.greatest(*[F.col(c).isNull().cast("int") for c in columns], F.lit(0))
    grouped = df.groupBy(*columns).agg(F.count("*").alias("n"), F.max(has_null).alias("has_null"))
    return grouped.agg(
        F.coalesce(F.sum(F.col("n") * F.col("has_null")), F.lit(0)).alias("null_rows"), F.count("*").alias("distinct_keys"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows")
    )


#: Columns that loads fill themselves; none is part of a key, but for the tab.
SYSTEM = ("source_file_name", "excel_tab_name", "sp_ingest_load_dt", "audit_id", "__$batch_id", "__$job_instance_id")


def key_candidates(df: DataFrame, stats: DataFrame | None = None) -> list[str]:
    """Columns whose name hints at a key, whole numbers, and short codes, in the table's order.

    Two scans: statistics (given or made), and the code test of the text columns left.
    """
    own = [c for c in df.columns if c.lower() not in SYSTEM]
    kinds = {r.column_name: r.inferred for r in narrowest_type(stats if stats is not None else column_statistics(df, own)).select("column_name", "inferred").collect()}  # a row a column
    sure = {c for c in own if re.search(X.KEY_NAME, c) or kinds.get(c) in ("INT", "BIGINT")}
    texts = [c for c in own if c not in sure and kinds.get(c, "").startswith("VARCHAR")]
    codes = {r.column_name for r in code_like(df, texts).where("code_like").collect()} if texts else set()
    return [c for c in own if c in sure or c in codes]


#: Rows of the sample that refutes combinations; combinations that one job tests at most.
SAMPLE_ROWS, AT_ONCE = 20_000, 64
#: Rows that a task of a test over all rows gets; repeated values that are looked up to refute other combinations.
TASK_ROWS, WITNESSES = 250_000, 100
_SET = "__set_of_rows"


def repeated(df: DataFrame, combos: list[tuple[str, ...]]) -> set[tuple[str, ...]]:
    """Which of the combinations of columns (without nulls) occur twice, by one job over grouping sets.

    Each row is sent once for each combination; a combination's verdict is one
    flag a task.  Only the names of those found come to the driver.
    """
    if not combos:
        return set()
    names = list(dict.fromkeys(c for combo in combos for c in combo))
    short = {c: f"k{i}" for i, c in enumerate(names)}
    rows = df.select(*[F.col(f"`{c}`").alias(k) for c, k in short.items()])
    sets = [[F.col(short[c]) for c in combo] for combo in combos]
    counted = rows.groupingSets(sets, *short.values()).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    found = {r.g for r in counted.where("n > 1").select("g").distinct().collect()}
    # a bit of grouping_id is set where the column is left out, the first column's is the highest
    number = {combo: sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in combo) for combo in combos}
    return {combo for combo in combos if number[combo] in found}


def repeated_in_share(df: DataFrame, combos: list[tuple[str, ...]], share: float) -> set[tuple[str, ...]]:
    """Which of the combinations (without nulls) occur twice among a share of their values, drawn by hash; one scan.

    All rows of a drawn value are there, so that a combination whose values
    repeat now and then is found in a table of any size; in a sample of rows the
    second row of a pair is as rare as the first.
    """
    names = list(dict.fromkeys(c for combo in combos for c in combo))
    cell = {c: (F.col(f"`{c}`"), F.lit(None).cast(df.schema[c].dataType)) for c in names}
    drawn = [F.pmod(F.xxhash64(*[cell[c][0] for c in combo]), F.lit(1 << 20)) < round(share * (1 << 20)) for combo in combos]
    each = [F.when(hit, F.struct(F.lit(g).alias("g"), *[cell[c][c not in combo].alias(f"k{i}") for i, c in enumerate(names)])) for g, (combo, hit) in enumerate(zip(combos, drawn))]
    some = drawn[0]
    for hit in drawn[1:]:
        some = some | hit
    rows = df.where(some).select(F.inline(F.array(*each))).where("g is not null")
    counted = rows.groupBy("g", *[f"k{i}" for i in range(len(names))]).agg(F.count("*").alias("n"))
    return {combos[r.g] for r in counted.where("n > 1").select("g").distinct().collect()}


def _witnesses(df: DataFrame, combo: tuple[str, ...], rows: int) -> DataFrame | None:
    """All rows of some values that a combination (without nulls) holds twice; None if it is unique.  Exact.

    Each row's values are sent once.  Nothing is counted before, as what comes
    here is unique or nearly so; tasks get TASK_ROWS rows each, however many there
    are.  At most WITNESSES values come to the driver.
    """
    short = {c: f"k{i}" for i, c in enumerate(combo)}
    values = df.select(*[F.col(f"`{c}`").alias(k) for c, k in short.items()])
    parts = -(-rows // TASK_ROWS)
    dealt = values.repartition(parts, *short.values()).groupBy(*short.values()).agg(F.count("*").alias("n"))
    twice = dealt.where("n > 1").select(*short.values()).limit(WITNESSES).collect()
    if not twice:
        return None
    known = df.sparkSession.createDataFrame(twice, values.schema)
    same = [F.col(f"`{c}`") == F.col(k) for c, k in short.items()]
    return df.join(F.broadcast(known), same, "left_semi")


def _counts(df: DataFrame, names: list[str]) -> tuple[int, dict[str, float]]:
    """The rows of df, and about how many values each of the columns without nulls has."""
    first = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{k}") for k, c in enumerate(names)],
        *[F.approx_count_distinct(F.col(f"`{c}`"), 0.02).alias(f"distinct_{k}") for k, c in enumerate(names)],
    ).first()
    return first["rows"], {c: first[f"distinct_{k}"] for k, c in enumerate(names) if not first[f"nulls_{k}"]}


def _stored_counts(sketches: DataFrame, names: list[str]) -> tuple[int, dict[str, float]]:
    known = {r.column_name: r for r in key_bounds(sketches).where(F.col("column_name").isin(names)).collect()}  # a row a column
    if lost := [c for c in names if c not in known]:
        raise ValueError(f"no sketches of {lost}")
    return max(r.rows for r in known.values()), {c: known[c].n_distinct for c in names if not known[c].nulls}


def infer_key(df: DataFrame, candidates: list[str] | None = None, most: int = 3, tab: str | None = None, sample_rows: int = SAMPLE_ROWS, sketches: DataFrame | None = None) -> list[str] | None:
    """The first combination of up to `most` candidates, in their order, that is unique and free of nulls.

    Without candidates they are found (key_candidates).  If none fits and there
    is a tab column, the same are tried with it.  The search goes by level:

    - one job counts rows, nulls and about the distinct values of each candidate,
      or they come from the sketches that profiles of the files hold
      (profile.merge_sketches), without a scan; a column with a null is out, and a
      combination whose distinct counts multiply to less than the number of rows
      cannot be unique;
    - a job over a sample of rows tests a level's combinations by grouping sets:
      what repeats there is refuted, whatever the other rows hold;
    - a scan tests the others on a share of their values (repeated_in_share), all
      together an eighth of the rows or less;
    - the survivors, which are few, are tested one by one over all rows, each row
      sent once; the first unique one in order ends the search, so that what
      contains it is never tested.  The rows in which another one repeats are tried
      with all that are left, so that a few odd rows cost one such test, not one a
      combination.  Levels of more than AT_ONCE combinations go in parts; a table no
      larger than the sample is tested whole by one job a part.
    """
    candidates = key_candidates(df) if candidates is None else candidates
    extra = [tab] if tab and tab in df.columns else []
    names = [*candidates, *extra]
    if not candidates:
        return None
    rows, counts = _counts(df, names) if sketches is None else _stored_counts(sketches, names)
    if not rows:
        return None

    def may_be(combo: tuple[str, ...]) -> bool:
        room = 1.0
        for c in combo:
            room *= 1.2 * counts[c]  # far beyond the error of the estimate
        return room >= rows

    usable = [c for c in candidates if c in counts]
    levels = [[(*combo, *more) for combo in combinations(usable, size)] for more in ([[], extra] if extra and extra[0] in counts else [[]]) for size in range(1, most + 1)]
    levels = [[combo for combo in level if may_be(combo)] for level in levels]
    if rows <= sample_rows:
        for level in levels:
            for at in range(0, len(level), AT_ONCE):
                part = level[at : at + AT_ONCE]
                wrong = repeated(df, part)
                if left := [combo for combo in part if combo not in wrong]:
                    return list(left[0])
        return None
    df, kept = df.select(*[F.col(f"`{c}`") for c in names]), []

    def keep(found: DataFrame) -> None:
        """Rows that are there, so that what repeats among them repeats in the table; a number tells one set from the next."""
        kept.append(found.withColumn(_SET, F.lit(len(kept))).persist())

    def not_refuted(part: list[tuple[str, ...]], at: int = 0) -> list[tuple[str, ...]]:
        seen = reduce(DataFrame.union, kept[at:])
        wrong = repeated(seen, [(_SET, *combo) for combo in part])
        return [combo for combo in part if (_SET, *combo) not in wrong]

    keep(df.sample(sample_rows / rows, 17))
    try:
        for level in levels:
            for at in range(0, len(level), AT_ONCE):
                part = not_refuted(level[at : at + AT_ONCE])
                if part:
                    wrong = repeated_in_share(df, part, min(1 / 64, 1 / (8 * len(part))))
                    part = [combo for combo in part if combo not in wrong]
                while part:
                    found = _witnesses(df, part[0], rows)
                    if found is None:
                        return list(part[0])
                    keep(found)
                    part = not_refuted(part[1:], len(kept) - 1)
    finally:
        for seen in kept:
            seen.unpersist()
    return None


def key_report(df: DataFrame, tab: str | None = None) -> DataFrame:
    """pk_columns, strategy (APPEND with a key, else TRUNCATE) and n_rows."""
    found = infer_key(df, tab=tab)
    return df.agg(F.count("*").alias("n_rows")).select(F.lit(",".join(found or [])).alias("pk_columns"), F.lit("APPEND" if found else "TRUNCATE").alias("strategy"), "n_rows")


def append_guard(staged: DataFrame, target: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """code, n: duplicate keys in the load and keys that the target holds, to be checked before any write."""
    dup = duplicate_summary(staged, list(pairs)).select(F.lit("DUPLICATE_IN_LOAD").alias("code"), F.col("dup_rows").alias("n"))
    conflict = key_conflicts(staged, target, pairs).agg(F.count("*").alias("n")).select(F.lit("KEY_IN_TARGET").alias("code"), "n")
    return dup.unionByName(conflict)
