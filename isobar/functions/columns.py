"""Column → Column helpers. All built-ins, so they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month labels and words read as true.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
TRUE_WORDS = ["true", "1", "yes"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable_round(c: Column | str, places: int) -> Column:
    """Half-up rounding that ignores the last-bit noise of double sums.

    A distributed sum of doubles depends on the order in which partitions
    merge. Snapping four digits below the wanted place first makes the rounded
    figure the same for any layout. What no decimal can hold, NaN among it, gives NULL.
    """
    return F.round(col(c).try_cast(f"decimal(38,{places + 4})"), places).cast("double")


def finite(c: Column | str) -> Column:
    """The number, or NULL where it is NaN or infinite."""
    c = col(c)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def number(text: Column) -> Column:
    """Text as a finite double; anything else, "NaN" and "Infinity" too, gives NULL."""
    return finite(text.try_cast("double"))


def clamp(c: Column | str, low: float, high: float) -> Column:
    """Limit to [low, high]; NULL stays NULL (greatest/least would skip it)."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high))))


def null_outside(c: Column | str, low: float, high: float) -> Column:
    c = col(c)
    return F.when(c.between(low, high), c)


def month_sin(month: Column | str) -> Column:
    return F.sin(F.lit(2.0) * F.pi() * col(month) / F.lit(12.0))


def month_cos(month: Column | str) -> Column:
    return F.cos(F.lit(2.0) * F.pi() * col(month) / F.lit(12.0))


def month_name(month: Column | str) -> Column:
    m = col(month)
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return F.when(m.between(1, 12), F.try_element_at(names, m))


def parse_date(text: Column | str) -> Column:
    """First word of the text as year-month-day; anything else gives NULL."""
    first = F.split(F.trim(col(text)), r"\s+").getItem(0)
    return F.try_to_date(first, "yyyy-M-d")


def date_text(d: Column | str) -> Column:
    return F.date_format(col(d), "yyyy-MM-dd")


def year_of(year: Column | str, d: Column | str) -> Column:
    return F.coalesce(col(year), F.year(col(d)))


def month_of(month: Column | str, d: Column | str) -> Column:
    return F.coalesce(col(month), F.month(col(d)))


def region_code(name: Column | str) -> Column:
    return F.replace(F.substring(F.upper(col(name)), 1, 10), F.lit(" "), F.lit("_"))


def region_key(name: Column | str) -> Column:
    return F.split(F.lower(F.coalesce(col(name), F.lit("Unknown"))), " ").getItem(0)


def with_suffix(name: Column | str, suffix: str = "Africa") -> Column:
    name = F.coalesce(col(name), F.lit("Unknown"))
    return F.when(name.contains(suffix), name).otherwise(F.concat(name, F.lit(" " + suffix)))


def parse_bool(text: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(col(text))).isin(TRUE_WORDS), F.lit(False))


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation; NULL where a side is constant or has one row."""
    x, y = col(x), col(y)
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))


def json_field(text: Column | str, field: str) -> Column:
    return F.get_json_object(col(text), f"$.{field}")


def units(c: Column | str, places: int = 5) -> Column:
    """A measure as whole units of 10^-places, so that sums in frames are exact."""
    return F.rint(col(c) * F.lit(float(10**places))).try_cast("long")


def uniform(key: Column | str, seed: int, draw: int) -> Column:
    """The row's `draw`-th number in [0, 1), made from a digest of its key.

    Unlike rand(seed) it does not change with the partition layout, so a
    retried or repartitioned task draws the same values, and so does any other
    engine that knows MD5. One digest serves four draws.
    """
    digest = F.md5(F.concat_ws("#", col(key), F.lit(str(seed)), F.lit(str(draw // 4))))
    part = F.substring(digest, 8 * (draw % 4) + 1, 8)
    return F.conv(part, 16, 10).cast("double") / F.lit(float(2**32))
