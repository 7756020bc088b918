"""Text cells: trimming, missing markers, numbers, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for a missing cell, compared in lower case.
NA_TOKENS = (
    "", "nan", "na", "n/a", "none", "null", ".",
    "#n/a", "#n/a n/a", "#na", "<na>", "-nan", "1.#ind", "-1.#ind", "1.#qnan", "-1.#qnan",
)

# Text that a table reader takes for an empty cell, compared as it is.
EMPTY_MARKS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Fixed value: the label of a session when a subject has no session folders.
NO_SESSION = "_no_session"

_WHITESPACE = " \t\r\n\x0b\x0c"

# Spark's own cast also takes "1.0d", "1f" and hexadecimal text; plain decimal
# notation is what counts as a number here.
_NUMBER = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))$"


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(text, F.lit(_WHITESPACE))


def is_missing(cell: Column) -> Column:
    """True for NULL, blank, and the usual markers of a missing value."""
    return cell.isNull() | F.lower(strip(cell)).isin(*NA_TOKENS)


def is_empty(cell: Column) -> Column:
    """True for NULL and for text that is read as an empty cell, not for other words."""
    return cell.isNull() | cell.isin(*EMPTY_MARKS)


def to_number(cell: Column) -> Column:
    """DOUBLE value of a text cell; NULL (never NaN) when it is not a number."""
    return stripped_number(strip(cell))


def stripped_number(text: Column) -> Column:
    """The same for text without white space at its ends, best a column of its own."""
    # Text that starts and ends like a number and has no "x" needs no regex: the
    # cast alone decides. Codes 43-57 are + , - . / and the digits, 46-57 . / and the digits.
    plain = (
        F.ascii(text).between(43, 57)
        & F.ascii(F.right(text, F.lit(1))).between(46, 57)
        & ~F.contains(F.lower(text), F.lit("x"))
    )
    return F.when(plain | text.rlike(_NUMBER), text.try_cast("double"))


def null_if_nan(value: Column) -> Column:
    """NULL in place of NaN, so that comparisons and aggregates skip it."""
    return F.when(~F.isnan(value), value)


def normalise_header(name: Column) -> Column:
    """Column name in lower case, trimmed, blanks as underscores."""
    return F.translate(F.lower(strip(name)), " ", "_")


def normalise_bundle(name: Column) -> Column:
    """Bundle name in lower case, trimmed, blanks and hyphens as underscores."""
    return F.translate(F.lower(strip(name)), " -", "__")


def strip_label(label: Column, prefix: str) -> Column:
    """``sub-01`` -> ``01`` for prefix ``sub-``; other text is left as it is."""
    return F.when(
        F.startswith(label, F.lit(prefix)), F.substr(label, F.lit(len(prefix) + 1))
    ).otherwise(label)


def with_label(label: Column, prefix: str) -> Column:
    """``1mo`` -> ``ses-1mo`` for prefix ``ses-``; a present prefix is kept."""
    return F.when(F.startswith(label, F.lit(prefix)), label).otherwise(
        F.concat(F.lit(prefix), label)
    )


def share(part: Column, total: Column, digits: int = 6) -> Column:
    """``part / total`` rounded; NULL when the total is zero."""
    return F.round(F.try_divide(part, total), digits)


def name_cell(header: Column, values: Column, name: str) -> Column:
    """The cell under the first column called ``name``; NULL when there is none."""
    return F.get(values, F.array_position(header, name).cast("int") - 1)
