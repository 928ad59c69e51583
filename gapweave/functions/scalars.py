"""Row-wise column expressions. All of them run unchanged on streaming frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Text tokens that stand for a missing value.
BAD_NULL_TOKENS = ("", "None", "NULL", "null")

# Grade letters from best to worst, and the upper score of all but the last.
GRADES = ("a", "b", "c", "d", "e")
GRADE_UPPER_SCORES = (0, 3, 10, 18)

# Name parts of columns that cannot be negative.
NON_NEGATIVE_KEYWORDS = ("_100g", "energy", "fat", "protein", "carbohydrate", "sugar", "salt", "fiber")


def _col(c: str | Column) -> Column:
    return F.col(quoted(c)) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """Column name safe for names with dots or hyphens."""
    return "`" + name.replace("`", "``") + "`"


def is_fractional(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.DoubleType, T.FloatType))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing-value policy: NaN becomes null, once, at the entry of a frame."""
    return df.select(
        *[
            F.when(~F.isnan(_col(f.name)), _col(f.name)).alias(f.name) if is_fractional(f) else _col(f.name)
            for f in df.schema
        ]
    )


def normalize_label(c: str | Column) -> Column:
    """Lower case, hyphens to blanks, single blanks; null stays null."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(_col(c)), "-", " "), r"\s+", " "))


def clean_text(c: str | Column) -> Column:
    """Lower case with every non-word character as a blank, as fuzzy matching compares it."""
    return F.trim(F.lower(F.regexp_replace(_col(c), r"(?U)\W", " ")))


def token_sorted(c: str | Column) -> Column:
    """Words of the cleaned text in alphabetical order."""
    words = F.filter(F.split(clean_text(c), r"\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def to_number(c: str | Column) -> Column:
    """Number or null; text that is no number and NaN both give null."""
    value = _col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def unix_to_date(c: str | Column) -> Column:
    """UTC calendar day of unix seconds, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(_col(c).try_cast("double") / 86400).cast("int"))


def iso_to_timestamp(c: str | Column) -> Column:
    """Wall-clock time of ISO text, or null; a trailing zone is ignored."""
    return _col(c).try_cast("timestamp_ntz")


def tuple_text_to_struct(c: str | Column, fields: Mapping[str, str]) -> Column:
    """Read legacy text such as ``('a', 1.0, nan)`` into typed fields; ``nan`` and ``None`` become null."""
    text = F.regexp_replace(_col(c), r"^\s*\(|,?\s*\)\s*$", "")
    text = F.regexp_replace(text, r"\b(nan|None)\b(?=\s*(,|$))", "null")
    items = F.from_json(
        F.concat(F.lit("["), text, F.lit("]")), "array<string>", {"allowSingleQuotes": "true"}
    )
    return F.struct(*[F.get(items, F.lit(i)).try_cast(t).alias(n) for i, (n, t) in enumerate(fields.items())])


def grade_to_number(c: str | Column) -> Column:
    """Letter to 1..5 without regard to case; anything else is null."""
    position = F.array_position(F.array(*[F.lit(g) for g in GRADES]), F.lower(_col(c)))
    return F.when(position > 0, position.cast("int"))


def number_to_grade(c: str | Column) -> Column:
    """Half-even rounding, clamped to the known grades."""
    position = clip(F.bround(_col(c)), 1, len(GRADES)).cast("int")
    # `get`, not `element_at`: the latter returns the last item for a null index of a null-free array.
    return F.get(F.array(*[F.lit(g) for g in GRADES]), position - 1)


def score_to_grade(c: str | Column) -> Column:
    """Letter of a score by the upper bound of each grade."""
    score = _col(c)
    result = F.when(score.isNull(), F.lit(None).cast("string"))
    for grade, upper in zip(GRADES, GRADE_UPPER_SCORES):
        result = result.when(score <= upper, grade)
    return result.otherwise(GRADES[-1])


def is_bad_null(c: str | Column, tokens: Iterable[str] = BAD_NULL_TOKENS) -> Column:
    """True for text that only looks like a value; null gives false."""
    return F.coalesce(_col(c).cast("string").isin(*tokens), F.lit(False))


def zero_tiny_negatives(df: DataFrame, keywords: Sequence[str] = NON_NEGATIVE_KEYWORDS, limit: float = 1e-5) -> DataFrame:
    """Numeric columns whose name holds a keyword: values in (-limit, 0) become 0."""
    out = []
    for f in df.schema:
        c = _col(f.name)
        if isinstance(f.dataType, T.NumericType) and any(k in f.name.lower() for k in keywords):
            c = F.when((c < 0) & (c > -limit), F.lit(0).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def round_half_even(c: str | Column) -> Column:
    return F.bround(_col(c)).cast("int")


def clip(c: str | Column, low, high) -> Column:
    """Clamp without the null-skipping of ``least`` and ``greatest``."""
    value = _col(c)
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def tags(c: str | Column) -> Column:
    """Comma list to an array of trimmed tags; empty text gives an empty array."""
    return F.filter(F.transform(F.split(_col(c), ","), lambda t: F.trim(t)), lambda t: t != "")


def same_prefix(a: str | Column, b: str | Column, length: int = 3) -> Column:
    return F.when(F.substring(_col(a), 1, length) == F.substring(_col(b), 1, length), "Yes").otherwise("No")


def change_label(percent: str | Column, is_new: Column) -> Column:
    """``New``, or the percentage with one digit."""
    value = F.bround(_col(percent), 1)
    return F.when(is_new, "New").when(value.isNotNull(), F.format_string("%.1f%%", value))


def null_if(c: str | Column, token) -> Column:
    return F.when(_col(c) != token, _col(c))


def fill_null(c: str | Column, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))
