"""Column expressions that turn scraped text into numbers and keys.

Every parser returns NULL for what it cannot read: NaN never enters a DataFrame, because Spark's ``avg``, ``max``
and ``percentile`` would treat it as an ordinary (and the largest) value.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ---- fixed values -------------------------------------------------------------------------------------------
MISSING = "N/a"
NA_TOKENS = ("N/a", "n/a", "NA", "na", "NaN", "nan", "")
# Tokens a CSV reader in the pandas tradition takes as missing without being told to.
DEFAULT_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
PLACEHOLDER_NAMES = ("", "Player", "N/a")
CURRENCY_SIGNS = "€£$ "
# -------------------------------------------------------------------------------------------------------------

# A plain decimal number.  ``try_cast`` alone would also take 'nan', 'inf', '1d' and '1.5f'.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INTEGER = r"^[+-]?\d+$"
_EDGE_SPACE = r"^\s+|\s+$"


def _col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def strip_space(c: Column | str) -> Column:
    """Trim blanks, tabs, line ends and no-break spaces at both ends."""
    return F.regexp_replace(_col(c), r"^[\s ]+|[\s ]+$", "")


def num(c: Column | str) -> Column:
    """Text to double, NULL when it is not a plain finite number."""
    text = F.trim(_col(c).cast("string"))
    value = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(F.abs(value) != F.lit(float("inf")), value)


def clean_num(c: Column | str) -> Column:
    """``num`` after dropping thousands commas."""
    return num(strip_commas(c))


def finite(c: Column | str) -> Column:
    """A numeric column with NaN and infinities turned into NULL."""
    value = _col(c).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def strip_commas(c: Column | str) -> Column:
    return F.replace(_col(c).cast("string"), F.lit(","), F.lit(""))


def strip_percent(c: Column | str) -> Column:
    return F.replace(_col(c).cast("string"), F.lit("%"), F.lit(""))


def safe_int(c: Column | str, default: int = 0) -> Column:
    """Whole number with optional thousands commas; anything else (also ``'12.5'``) gives ``default``."""
    text = F.trim(strip_commas(c))
    return F.coalesce(F.when(text.rlike(INTEGER), text.try_cast("bigint")), F.lit(default).cast("bigint"))


def null_tokens(c: Column | str, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """NULL where the trimmed text is one of the missing-value tokens, the untouched text elsewhere."""
    col = _col(c)
    return F.when(~F.trim(col).isin(list(tokens)), col)


def unsentinel(c: Column | str, sentinel: str = MISSING) -> Column:
    return F.nullif(_col(c), F.lit(sentinel))


def first_token(c: Column | str) -> Column:
    """Text before the first blank, all of it when there is none, ``''`` for NULL."""
    return F.coalesce(F.split_part(_col(c), F.lit(" "), F.lit(1)), F.lit(""))


def _fold_accents(names: Column) -> Column:
    """NFKD folding, one text at a time.  Defined inside so that it ships by value to executors without this package."""

    def fold(text: str | None) -> str | None:
        from unicodedata import combining, normalize

        if text is None:
            return None
        if not text.isascii():
            text = "".join(ch for ch in normalize("NFKD", text) if not combining(ch))
        return text.lower().strip()

    return F.udf(fold, StringType(), useArrow=False)(names)


def name_key(c: Column | str) -> Column:
    """Accent-free, lower-case, trimmed join key; ``''`` for NULL.

    Spark has no NFKD function and its accent-insensitive collations also fold letters such as Ø, which this key
    must keep, so this is the one Python expression of the library.  It is no Arrow one: an Arrow batch holds 10,000
    texts however long they are, and folding a batch makes several copies of them all.
    """
    return F.coalesce(_fold_accents(_col(c)), F.lit(""))


def _scaled_money(text: Column) -> Column:
    millions, thousands = text.contains("m"), text.contains("k")
    digits = F.replace(F.replace(text, F.lit("m"), F.lit("")), F.lit("k"), F.lit(""))
    factor = F.when(millions, F.lit(1e6)).when(thousands, F.lit(1e3)).otherwise(F.lit(1.0))
    return num(digits) * factor / F.lit(1e6)


def money_raw(c: Column | str) -> Column:
    """``'€117M'`` / ``'€900K'`` / ``'500000'`` to millions, unrounded.  A comma makes it unreadable.

    Only one unit letter is dropped: a text with both M and K is unreadable.
    """
    text = F.translate(F.lower(F.trim(_col(c))), CURRENCY_SIGNS, "")
    both = text.contains("m") & text.contains("k")
    return F.when(~both, _scaled_money(text))


def money(c: Column | str) -> Column:
    """As ``money_raw`` but reads thousands commas and rounds to two places."""
    text = F.translate(F.lower(_col(c)), CURRENCY_SIGNS + ",", "")
    return round_binary(_scaled_money(text), 2)


def round_binary(c: Column | str, places: int = 2) -> Column:
    """Round by the exact binary value of the double: 2.675 is a little below the tie and gives 2.67.

    ``round`` decides by the printed decimals and would give 2.68.  The scaled value is computed without error as
    ``product + rest`` by splitting the double into halves; exact ties go to the even neighbour.  For values
    whose scaled size stays well below 2**52.
    """
    value, scale = _col(c), F.lit(float(10**places))
    carry = value * F.lit(134217729.0)
    upper = carry - (carry - value)
    product = value * scale
    rest = (upper * scale - product) + (value - upper) * scale
    whole = F.floor(product).cast("double")
    past_half = (product - whole - F.lit(0.5)) + rest
    up = (past_half > 0) | ((past_half == 0) & (whole % 2 != 0))
    return (whole + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / scale


def score(c: Column | str) -> Column:
    """A number, or the number before ``/`` in texts such as ``'92.8/100'``."""
    return F.coalesce(num(c), num(F.split_part(_col(c), F.lit("/"), F.lit(1))))


def age_years(c: Column | str) -> Column:
    """Years from ``'24-123'`` (years-days) or ``'24'``."""
    return num(F.split_part(_col(c).cast("string"), F.lit("-"), F.lit(1)))


def nan_to_num(c: Column | str) -> Column:
    """NaN to 0, infinities to the largest finite doubles; NULL counts as NaN."""
    import sys

    col, big = _col(c), sys.float_info.max
    return (
        F.when(col.isNull() | F.isnan(col), F.lit(0.0))
        .when(col == F.lit(float("inf")), F.lit(big))
        .when(col == F.lit(float("-inf")), F.lit(-big))
        .otherwise(col)
    )


def clamp_zero(c: Column | str) -> Column:
    return F.greatest(_col(c), F.lit(0.0))


def fixed(c: Column | str, places: int = 2) -> Column:
    """Fixed-decimal text; NULL stays NULL."""
    col = _col(c)
    return F.when(col.isNotNull(), F.format_string(f"%.{places}f", col))


def leader_text(group: Column | str, value: Column | str) -> Column:
    """``'Group (1.23)'``."""
    return F.when(_col(value).isNotNull(), F.format_string("%s (%.2f)", _col(group), _col(value)))


def leader_group(text: Column | str) -> Column:
    """The group name back out of ``leader_text``."""
    return F.split_part(_col(text), F.lit(" ("), F.lit(1))


def metric_slug(c: Column | str, max_len: int = 100) -> Column:
    """File-safe metric label; also used to partition report tables by metric."""
    steps = ((r"[:/\\ ]", "_"), ("%", "Percent"), (r"\.", "_dot_"), (r'[<>*?"|]', ""), ("_+", "_"), ("^_|_$", ""))
    slug = reduce(lambda text, step: F.regexp_replace(text, step[0], step[1]), steps, _col(c))
    return F.substring(slug, 1, max_len)


def metric_slug_plain(c: Column | str) -> Column:
    """Older label form: blanks to underscores, reserved characters dropped."""
    return F.regexp_replace(F.replace(_col(c), F.lit(" "), F.lit("_")), r'[\\/*?:"<>|]', "")
