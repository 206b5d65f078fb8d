"""Column expressions for parsing, cleaning and formatting. All stay inside codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed value: what counts as a decimal number in text. A plain cast would also take '1.5d'.
NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"


def to_number(text: Column, suffix: str = "") -> Column:
    """Text to double; anything that is not a plain decimal number (and suffix) becomes null.

    The text is looked at once, so that a long expression behind it is not repeated.
    """
    return F.regexp_extract(text, rf"^\s*({NUMBER})\s*{suffix}$", 1).try_cast("double")


def strip(text: Column) -> Column:
    """Remove surrounding whitespace of every kind; ``trim`` only knows the space."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def parse_currency(text: Column) -> Column:
    """``"$1,234.50"`` to 1234.5; bad text to null."""
    return to_number(F.translate(text.cast("string"), "$,", ""))


def parse_date(text: Column) -> Column:
    """ISO text to a date; bad text to null."""
    return F.to_date(F.try_to_timestamp(strip(text.cast("string")), F.lit("yyyy-MM-dd")))


def parse_percent(text: Column) -> Column:
    """``"90%"`` to 90.0; bad text to null."""
    return to_number(text.cast("string"), "%*")


def normalise_text(text: Column) -> Column:
    return F.lower(strip(text))


def map_flag(flag: Column, labels: dict[str, str]) -> Column:
    """Label per flag value; a value without a label becomes null."""
    return F.coalesce(*[F.when(flag == k, F.lit(v)) for k, v in labels.items()])


def case_bucket(x: Column, edges: list[tuple[float, str]], last: str, missing: str) -> Column:
    """Label of the first edge above ``x``; ``last`` beyond all edges, ``missing`` for null."""
    start = F.when(x.isNull(), F.lit(missing))
    return reduce(lambda acc, e: acc.when(x < e[0], F.lit(e[1])), edges, start).otherwise(F.lit(last))


def pct(count: Column, total: Column) -> Column:
    """Share in percent; 0 when there is nothing to share."""
    return F.coalesce(F.try_divide(count, total) * 100.0, F.lit(0.0))


def round_coord(x: Column, decimals: int = 4) -> Column:
    """Half-even rounding of the scaled double."""
    scale = F.lit(float(10**decimals))
    return F.rint(x * scale) / scale


def clip_text(text: Column, width: int = 40) -> Column:
    """One-line sample text: pipes escaped, newlines flattened, long text cut with an ellipsis."""
    flat = F.regexp_replace(F.replace(text, F.lit("|"), F.lit("\\|")), "[\n\r]", " ")
    return F.when(F.length(flat) > width, F.concat(F.left(flat, F.lit(width - 3)), F.lit("..."))).otherwise(flat)


def pow10(x: Column) -> Column:
    return F.pow(F.lit(10.0), x)


def rows_of(*structs: Column) -> Column:
    """Structs of one row as rows of their own."""
    return F.inline(F.array(*structs))


def month_of(date: Column) -> Column:
    return F.month(date).cast("long")
