"""Column helpers.  Every helper returns a JVM-side ``Column`` expression (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

# Money is a fixed-point amount with four decimals; report ratios use two.
ASSORTMENT_FROM = "19999999"  # fixed value: assortment codes have a suffix above it
MONEY = DecimalType(19, 4)
RATIO = DecimalType(12, 2)

# Text that a numeric check accepts: optional sign, digits with optional decimal point.
NUMERIC_TEXT = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$"


def ts_lit(value) -> Column:
    """A time-zone-independent timestamp literal (the synthetic tables carry local timestamps)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def item_key(c: str | Column, width: int = 20) -> Column:
    """Zero-pad a code and keep the rightmost ``width`` characters.

    ``lpad`` would keep the *leftmost* characters of a longer input, so the
    padding is done by concatenation and ``right``.  NULL stays NULL.
    """
    return F.right(F.concat(F.lit("0" * width), col(c).cast("string")), F.lit(width))


def trimmed_item_key(c: str | Column, width: int = 20) -> Column:
    """``item_key`` of a code with surrounding spaces removed (wholesale item numbers)."""
    return item_key(F.trim(col(c)), width)


def is_blank(c: str | Column) -> Column:
    """TRUE for NULL, empty or all-space text (trailing blanks are not significant)."""
    return F.rtrim(F.coalesce(col(c), F.lit(""))) == ""


def is_present(c: str | Column) -> Column:
    """Negation of ``is_blank``: text with at least one non-space character."""
    return ~is_blank(c)


def equals_blank(c: str | Column) -> Column:
    """``c = ''`` with blank padding ignored; NULL stays NULL (unlike ``is_blank``)."""
    return F.rtrim(col(c)) == ""


# Text is compared without regard to case or trailing blanks, and never changed for it.
TEXT_COLLATION = "UTF8_LCASE_RTRIM"


def text_key(c: str | Column) -> Column:
    """The text under the comparison rule: equality, joins and grouping ignore case and trailing blanks."""
    return F.collate(col(c), TEXT_COLLATION)


def same_text(c: str | Column, value: str | Column) -> Column:
    """``c = value`` under the comparison rule; NULL stays NULL."""
    return text_key(c) == (F.lit(value) if isinstance(value, str) else text_key(value))


def left(c: str | Column, n: int) -> Column:
    return F.substring(col(c), 1, n)


def money(c: str | Column) -> Column:
    return col(c).cast(MONEY)


def to_minute(c: str | Column) -> Column:
    """Round a timestamp half-up to the minute (small-datetime: a zone-less timestamp)."""
    return F.date_trunc("minute", col(c) + F.expr("INTERVAL 30 SECONDS")).cast("timestamp_ntz")


def number_or_zero(c: str | Column) -> Column:
    """A money value from numeric text or a number; anything else (or NULL) is 0."""
    return F.coalesce(col(c).try_cast(MONEY), F.lit(0).cast(MONEY))


def numeric_or_left(c: str | Column, n: int) -> Column:
    """Keep numeric text as is, otherwise its first ``n`` characters (PO numbers)."""
    c = col(c)
    return F.when(c.rlike(NUMERIC_TEXT), c).otherwise(left(c, n))


def pct_sold(sold: str | Column, shipped: str | Column) -> Column:
    """Sell-through percentage; when nothing shipped it is the sold count itself."""
    sold, shipped = col(sold), col(shipped)
    return F.when(F.coalesce(shipped, F.lit(0)) == 0, F.coalesce(sold, F.lit(0)).cast(DoubleType())).otherwise(
        sold.cast(DoubleType()) / shipped.cast(DoubleType()) * F.lit(100.0)
    )


def discount_pct(register: str | Column, qty: str | Column, price: str | Column) -> Column:
    """register / (qty * price) rounded half-up to 2 decimals; 0 when the base is 0."""
    base = col(qty).cast(DecimalType(19, 0)) * col(price)
    return F.when(base == 0, F.lit(0).cast(RATIO)).otherwise((col(register) / base).cast(RATIO))


def initials(name: str | Column) -> Column:
    """'John Smith' -> 'J.S.'; a name without a space repeats its first letter ('Cher' -> 'C.C.').

    The first letter is taken after removing leading spaces, the second is the
    character after the first space of the untrimmed name.
    """
    n = col(name)
    second = F.substring(n, F.locate(" ", n) + F.lit(1), F.lit(1))
    return F.concat(F.substring(F.ltrim(n), 1, 1), F.lit("."), second, F.lit("."))


def assortment(item_code: str | Column) -> Column:
    """Assortment items carry a code whose last 8 characters sort above '19999999'."""
    return F.right(col(item_code), F.lit(8)) > F.lit(ASSORTMENT_FROM)


def title_item(item_code: str | Column) -> Column:
    """Mirror of ``assortment`` with a strict '<' (a suffix of exactly '19999999' is neither)."""
    return F.right(col(item_code), F.lit(8)) < F.lit(ASSORTMENT_FROM)


def ymd(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")
