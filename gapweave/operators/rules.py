"""Row-wise data-quality rules driven by rule tables. Everything but the summaries also runs on streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from gapweave.functions.scalars import clip, iso_to_timestamp, quoted, unix_to_date
from gapweave.plans import rule_tables as rt


def replace_columns(df: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    """One projection in which the named columns take new expressions."""
    return df.select(*[changes[c].alias(c) if c in changes else F.col(quoted(c)) for c in df.columns])


def _limited(c: str, limit: float) -> Column:
    return F.when(~(F.col(quoted(c)) > limit), F.col(quoted(c)))


def _role_limits(df: DataFrame, limits: Mapping[str, float], columns: Mapping[str, str]) -> dict[str, float]:
    return {columns[r]: v for r, v in limits.items() if columns.get(r) in df.columns}


def check_integrity(
    df: DataFrame,
    limits: Mapping[str, float] = rt.LIMITS_KJ,
    pairs: Sequence[tuple[str, str]] = rt.PART_OF,
    columns: Mapping[str, str] = rt.PRODUCT_COLUMNS,
) -> DataFrame:
    """Values above their limit become null; then a part above its whole becomes null, pair by pair."""
    out = replace_columns(df, {c: _limited(c, v) for c, v in _role_limits(df, limits, columns).items()})
    for part, whole in pairs:
        a, b = columns.get(part), columns.get(whole)
        if a in df.columns and b in df.columns:
            ca, cb = F.col(quoted(a)), F.col(quoted(b))
            out = replace_columns(out, {a: F.when(ca > cb, F.lit(None)).otherwise(ca)})
    return out


def _broken(
    df: DataFrame, limits: Mapping[str, float], pairs: Sequence[tuple[str, str]], columns: Mapping[str, str]
) -> list[tuple[str, Column, Column]]:
    """(rule, condition, value) of every rule of ``check_integrity``, in its order."""
    role_limits = _role_limits(df, limits, columns)
    found = [(f"{c} > {v:g}", F.col(quoted(c)) > v, F.col(quoted(c))) for c, v in role_limits.items()]
    cleared: dict[str, Column] = {c: _limited(c, v) for c, v in role_limits.items()}
    for part, whole in pairs:
        a, b = columns.get(part), columns.get(whole)
        if a in df.columns and b in df.columns:
            ca, cb = cleared.get(a, F.col(quoted(a))), cleared.get(b, F.col(quoted(b)))
            found.append((f"{a} > {b}", ca > cb, ca))
            cleared[a] = F.when(ca > cb, F.lit(None)).otherwise(ca)
    return found


def integrity_violations(
    df: DataFrame,
    key: str,
    limits: Mapping[str, float] = rt.LIMITS_KJ,
    pairs: Sequence[tuple[str, str]] = rt.PART_OF,
    columns: Mapping[str, str] = rt.PRODUCT_COLUMNS,
) -> DataFrame:
    """One row (key, rule, value) per cell that ``check_integrity`` clears."""
    items = [
        F.when(bad, F.struct(F.lit(rule).alias("rule"), value.cast("double").alias("value"))) for rule, bad, value in _broken(df, limits, pairs, columns)
    ]
    return df.select(F.col(quoted(key)), F.explode(F.array_compact(F.array(*items))).alias("v")).select(quoted(key), "v.*")


def _observed(df: DataFrame, counters: Mapping[str, Column], name: str | None) -> tuple[DataFrame, Observation | None]:
    """The frame with its counters; without a name as an ``Observation``, with one for the progress of a stream."""
    seen = Observation() if name is None else None
    return df.observe(seen if name is None else name, *[c.alias(k) for k, c in counters.items()]), seen


def observed_integrity(
    df: DataFrame,
    limits: Mapping[str, float] = rt.LIMITS_KJ,
    pairs: Sequence[tuple[str, str]] = rt.PART_OF,
    columns: Mapping[str, str] = rt.PRODUCT_COLUMNS,
    name: str | None = None,
) -> tuple[DataFrame, Observation | None]:
    """``check_integrity`` with the number of cells that every rule clears, counted in the pass that writes the result.

    The counts are there after the first action on the frame."""
    counted, seen = _observed(df, {rule: F.count_if(bad) for rule, bad, _ in _broken(df, limits, pairs, columns)}, name)
    return check_integrity(counted, limits, pairs, columns), seen


def counter_rows(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """(rule, n) of observed counters."""
    return spark.createDataFrame([(k, int(v)) for k, v in counts.items()], "rule string, n long")


def check_grades(
    df: DataFrame,
    columns: Mapping[str, str] = rt.PRODUCT_COLUMNS,
    ranges: Mapping[str, tuple] = rt.GRADE_RANGES,
    strict_case: bool = False,
) -> DataFrame:
    """Both scores must lie in the ranges of the grade; otherwise grade and scores become null.

    A null score of a known grade fails. ``strict_case=True`` knows upper-case grades only."""
    g, fr, uk = (F.col(quoted(columns[r])) for r in ("grade", "fr_score", "uk_score"))
    grade = g if strict_case else F.lower(g)
    fails = F.lit(False)
    for name, ((fr_lo, fr_hi), (uk_lo, uk_hi)) in ranges.items():
        known = grade == (name.upper() if strict_case else name)
        inside = F.coalesce(fr.between(fr_lo, fr_hi) & uk.between(uk_lo, uk_hi), F.lit(False))
        fails = fails | (known & ~inside)
    bad = F.coalesce(fails, F.lit(False))
    return replace_columns(df, {columns[r]: F.when(~bad, F.col(quoted(columns[r]))) for r in ("grade", "fr_score", "uk_score")})


def fill_datetime(df: DataFrame, unix_column: str, datetime_column: str) -> DataFrame:
    """Missing or unreadable datetimes take the day of the unix time."""
    filled = F.coalesce(iso_to_timestamp(datetime_column), unix_to_date(unix_column).cast("timestamp_ntz"))
    return replace_columns(df, {datetime_column: filled})


def datetime_discrepancies(df: DataFrame, key: str, unix_column: str, datetime_column: str) -> DataFrame:
    """Rows whose two dates differ: (key, unix_date, datetime_date)."""
    return df.select(
        F.col(quoted(key)), unix_to_date(unix_column).alias("unix_date"), iso_to_timestamp(datetime_column).cast("date").alias("datetime_date")
    ).where(F.col("unix_date") != F.col("datetime_date"))


def _present(df: DataFrame, columns: Mapping[str, str], roles: Sequence[str]) -> dict[str, str]:
    return {r: columns[r] for r in roles if columns.get(r) in df.columns}


def _share_of(group: Column | None, table: Mapping, whole: Column) -> Column | None:
    """whole x share of the group; null without a group value, the general share without a group column."""
    if group is None:
        return whole * table[""]
    share = F.when(group.isNull(), F.lit(None).cast("double"))
    for name, value in table.items():
        if name:
            share = share.when(group == name, value)
    return whole * share.otherwise(table[None])


def apply_constraints(df: DataFrame, columns: Mapping[str, str] = rt.PRODUCT_COLUMNS, second_pass: bool = False) -> DataFrame:
    """Domain constraints in eight ordered steps; each step sees the result of the one before.

    Caps come after the part/whole rules and can break them again; ``second_pass`` runs all steps twice."""
    c = _present(df, columns, (*rt.NUTRIENTS, "fr_score", "uk_score", "group"))

    def col(role: str) -> Column:
        return F.col(quoted(c[role]))

    group = col("group") if "group" in c else None
    out = df
    for _ in range(2 if second_pass else 1):
        # 1 negatives
        out = replace_columns(out, {c[r]: F.when(col(r) < 0, 0.0).otherwise(col(r)) for r in rt.NUTRIENTS if r in c})
        # 2 protein of zero by group, then 3 general minimums
        minimum = {}
        for role, value in rt.ZERO_MINIMUMS.items():
            if role not in c:
                continue
            new = F.when(F.lit(False), F.lit(None).cast("double"))
            if role == "proteins" and group is not None:
                for name, protein in rt.GROUP_PROTEIN.items():
                    new = new.when((col(role) == 0) & (group == name), protein)
            applies = col(role) == 0
            if group is not None and role in rt.DRINK_EXEMPT:
                applies = applies & ~F.coalesce(group == rt.DRINK_GROUP, F.lit(False))
            minimum[c[role]] = new.when(applies, value).otherwise(col(role))
        out = replace_columns(out, minimum)
        # 4a salt and sodium
        if "salt" in c and "sodium" in c:
            out = replace_columns(
                out,
                {
                    c["salt"]: F.coalesce(col("salt"), col("sodium") * rt.SALT_PER_SODIUM),
                    c["sodium"]: F.coalesce(col("sodium"), col("salt") / rt.SALT_PER_SODIUM),
                },
            )
            low, high = rt.SALT_RATIO_RANGE
            rate = col("salt") / F.nullif(col("sodium"), F.lit(0.0))
            broken = F.when(col("sodium") == 0, col("salt") > 0).otherwise((rate < low) | (rate > high))
            out = replace_columns(out, {c["salt"]: F.when(broken, col("sodium") * rt.SALT_PER_SODIUM).otherwise(col("salt"))})
        # 4b, 4c part and whole
        parts = {}
        for part, whole, cap_share, table in (
            ("saturated_fat", "fat", rt.SATURATED_CAP_SHARE, rt.SATURATED_SHARE),
            ("sugars", "carbohydrates", rt.SUGAR_CAP_SHARE, rt.SUGAR_SHARE),
        ):
            if part in c and whole in c:
                estimate = _share_of(group, table, col(whole))
                parts[c[part]] = (
                    F.when(col(part) > col(whole), col(whole) * cap_share)
                    .when((col(whole) > rt.PART_THRESHOLD) & (col(part) == 0), F.coalesce(estimate, col(part)))
                    .otherwise(col(part))
                )
        out = replace_columns(out, parts)
        # 5 whole scores and 6 caps
        changes = {c[r]: F.bround(col(r)) for r in ("fr_score", "uk_score") if r in c}
        changes |= {c[r]: F.when(col(r) > v, v).otherwise(col(r)) for r, v in rt.LIMITS_KCAL.items() if r in c}
        out = replace_columns(out, changes)
        macros = ("fat", "carbohydrates", "proteins")
        if all(r in c for r in macros):
            # 7 balance of the macronutrients
            total = col("fat") + col("carbohydrates") + col("proteins")
            factor = F.lit(rt.MACRO_SUM_TARGET) / F.nullif(total, F.lit(0.0))
            out = replace_columns(out, {c[r]: F.when(total > rt.MACRO_SUM_LIMIT, col(r) * factor).otherwise(col(r)) for r in macros})
            if "energy" in c:
                # 8 energy
                theory = _energy(col)
                off = (F.abs(col("energy") - theory) / F.nullif(theory, F.lit(0.0))) > rt.ENERGY_TOLERANCE
                out = replace_columns(
                    out,
                    {
                        c["energy"]: F.when(col("energy").isNull(), theory)
                        .when((col("energy") > 0) & (theory > 0) & off, (col("energy") + theory) / 2)
                        .otherwise(col("energy"))
                    },
                )
    return out


def _energy(col) -> Column:
    k = rt.KCAL_PER_GRAM
    return col("proteins") * k["proteins"] + col("carbohydrates") * k["carbohydrates"] + col("fat") * k["fat"]


def _off_by(actual: Column, expected: Column, percent: float) -> Column:
    """Relative deviation above ``percent``; an expected zero is off for any other actual value."""
    return F.when(expected == 0, actual != 0).otherwise(F.abs((actual - expected) / F.nullif(expected, F.lit(0.0)) * 100) > percent)


def _relation_flags(columns: Mapping[str, str]) -> dict[str, Column]:
    def col(role: str) -> Column:
        return F.col(quoted(columns[role]))

    have = {r: col(r).isNotNull() for r in ("energy", "proteins", "carbohydrates", "fat", "salt", "sodium")}
    flags = {
        "salt_checked": have["salt"] & have["sodium"],
        "salt_off": _off_by(col("salt"), col("sodium") * rt.SALT_PER_SODIUM, 10.0),
        "energy_checked": have["energy"] & have["proteins"] & have["carbohydrates"] & have["fat"],
        "energy_off": _off_by(col("energy"), _energy(col), 20.0),
    }
    for macro in ("proteins", "carbohydrates", "fat"):
        others = [m for m in ("proteins", "carbohydrates", "fat") if m != macro]
        flags[f"{macro}_solvable"] = have["energy"] & ~have[macro] & have[others[0]] & have[others[1]]
    return {k: F.coalesce(v, F.lit(False)) for k, v in flags.items()}


def fix_sodium_salt(df: DataFrame, columns: Mapping[str, str] = rt.PRODUCT_COLUMNS) -> DataFrame:
    """Salt more than 10 % off 2.5 x sodium is recomputed from sodium."""
    flags = _relation_flags(columns)
    salt, sodium = F.col(quoted(columns["salt"])), F.col(quoted(columns["sodium"]))
    return replace_columns(df, {columns["salt"]: F.when(flags["salt_checked"] & flags["salt_off"], sodium * rt.SALT_PER_SODIUM).otherwise(salt)})


def fix_energy_macros(df: DataFrame, columns: Mapping[str, str] = rt.PRODUCT_COLUMNS) -> DataFrame:
    """Energy more than 20 % off the sum of its parts is recomputed and capped; a single missing part is
    solved from the energy and clamped."""
    flags = _relation_flags(columns)

    def col(role: str) -> Column:
        return F.col(quoted(columns[role]))

    theory = _energy(col)
    changes = {
        columns["energy"]: F.when(
            flags["energy_checked"] & flags["energy_off"], F.when(theory > rt.MAX_ENERGY, rt.MAX_ENERGY).otherwise(theory)
        ).otherwise(col("energy"))
    }
    for macro, cap in rt.MACRO_CAPS.items():
        rest = col("energy")
        known = F.lit(0.0)
        for other in ("proteins", "carbohydrates", "fat"):
            if other != macro:
                known = known + col(other) * rt.KCAL_PER_GRAM[other]
        solved = clip((rest - known) / rt.KCAL_PER_GRAM[macro], 0.0, cap)
        changes[columns[macro]] = F.when(flags[f"{macro}_solvable"], solved).otherwise(col(macro))
    return replace_columns(df, changes)


def _relation_counters(columns: Mapping[str, str]) -> dict[str, Column]:
    flags = _relation_flags(columns)
    return {
        **{f"{r}_checked": F.count_if(flags[f"{r}_checked"]) for r in ("salt", "energy")},
        **{f"{r}_off": F.count_if(flags[f"{r}_checked"] & flags[f"{r}_off"]) for r in ("salt", "energy")},
        **{f"{m}_solved": F.count_if(flags[f"{m}_solvable"]) for m in rt.MACRO_CAPS},
    }


def _relation_table(wide: DataFrame) -> DataFrame:
    """One row per relation from the row of counters."""
    null = F.lit(None).cast("long")

    def row(name: str, prefix: str, solved: bool) -> Column:
        return F.struct(
            F.lit(name).alias("relation"),
            F.col(f"{prefix}_checked").alias("checked"),
            (F.col(f"{prefix}_checked") - F.col(f"{prefix}_off")).alias("consistent"),
            F.col(f"{prefix}_off").alias("inconsistent"),
            (F.lit(100.0) - F.col(f"{prefix}_off") * 100.0 / F.nullif(f"{prefix}_checked", F.lit(0).cast("long"))).alias("consistent_pct"),
            *[(F.col(f"{m}_solved") if solved else null).alias(f"{m}_solved") for m in rt.MACRO_CAPS],
        )

    rows = F.array(row("sodium-salt", "salt", False), row("energy-macronutrients", "energy", True))
    return wide.select(F.explode(rows).alias("r")).select("r.*").where(F.col("checked") > 0)


def relation_summary(df: DataFrame, columns: Mapping[str, str] = rt.PRODUCT_COLUMNS) -> DataFrame:
    """Checked, consistent and inconsistent rows per relation; one aggregation over the input."""
    return _relation_table(df.agg(*[c.alias(k) for k, c in _relation_counters(columns).items()]))


def observed_relations(
    df: DataFrame, columns: Mapping[str, str] = rt.PRODUCT_COLUMNS, name: str | None = None
) -> tuple[DataFrame, Observation | None]:
    """The frame corrected as by ``validate_relations``, with its counters taken in the pass that writes the result."""
    counted, seen = _observed(df, _relation_counters(columns), name)
    return fix_energy_macros(fix_sodium_salt(counted, columns), columns), seen


def relation_rows(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """The rows of ``relation_summary`` from observed counters; none if nothing was observed."""
    found = {**dict.fromkeys(_relation_counters(rt.PRODUCT_COLUMNS), 0), **counts}
    return _relation_table(spark.createDataFrame([[int(v) for v in found.values()]], ", ".join(f"{k} long" for k in found)))


def validate_relations(df: DataFrame, columns: Mapping[str, str] = rt.PRODUCT_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(summary, corrected frame). Salt is no input of the energy rule, so one summary pass serves both."""
    return relation_summary(df, columns), fix_energy_macros(fix_sodium_salt(df, columns), columns)


def align_scores(
    df: DataFrame, columns: Mapping[str, str] = rt.PRODUCT_COLUMNS, lines: Mapping[str, tuple[float, float]] = rt.GRADE_LINES
) -> DataFrame:
    """First score brought onto the grade's line where it is clearly off, or filled from the second score;
    rounded half-even, the second score dropped, the grade in lower case."""
    g, fr, uk = (F.col(quoted(columns[r])) for r in ("grade", "fr_score", "uk_score"))
    slope = F.lit(None).cast("double")
    intercept = F.lit(None).cast("double")
    for name, (s, i) in lines.items():
        slope = F.when(F.lower(g) == name, s).otherwise(slope)
        intercept = F.when(F.lower(g) == name, i).otherwise(intercept)
    fitted = (uk - intercept) / slope
    off = (F.abs(uk - (fr * slope + intercept)) > 0.5) & (F.abs(fr - fitted) > 0.1)
    new = F.when(fr.isNull() | off, F.coalesce(fitted, fr)).otherwise(fr)
    return replace_columns(df, {columns["grade"]: F.lower(g), columns["fr_score"]: F.bround(new).cast("int")}).drop(columns["uk_score"])
