"""Rules for ``code = value`` label lines.

A line such as ``   'ANC'<TAB>=<TAB>'ANCHORAGE, AK    '`` is split on the
first ``=`` after every single quote is deleted.  Codes are normalised per
label kind; values are trimmed of spaces *and* tabs (a bare ``trim`` leaves
tabs in place).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The quote deleted from label lines, the code/value separator
# and the blank characters removed from codes and trimmed from values.
QUOTE = "'"
SEPARATOR = "="
BLANKS = " \t"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_quotes(line: str | Column) -> Column:
    return F.translate(_col(line), QUOTE, "")


def label_code(line: str | Column) -> Column:
    """Raw code: text before the separator, quotes deleted, blanks kept."""
    return F.split_part(strip_quotes(line), F.lit(SEPARATOR), F.lit(1))


def label_value(line: str | Column) -> Column:
    """Raw value: text after the separator, quotes deleted, blanks kept."""
    return F.split_part(strip_quotes(line), F.lit(SEPARATOR), F.lit(2))


def clean_value(value: str | Column) -> Column:
    """Trim spaces and tabs from both ends."""
    return F.trim(_col(value), F.lit(BLANKS))


def _no_blanks(code: str | Column) -> Column:
    return F.translate(_col(code), BLANKS, "")


def port_code(code: str | Column) -> Column:
    """Port codes: delete every space and tab (``'AG'<TAB><TAB>`` -> ``AG``)."""
    return _no_blanks(code)


def state_code(code: str | Column) -> Column:
    """State codes: the last two characters once blanks are deleted."""
    return F.right(_no_blanks(code), F.lit(2))


def int_code(code: str | Column) -> Column:
    """Numeric codes (country, mode, visa): padded text -> int.

    Parsed as a number first and then truncated, so ``' 582 '`` and
    ``'582.0'`` both give 582; anything non-numeric gives null.
    """
    return F.trim(_col(code), F.lit(BLANKS)).try_cast("double").try_cast("int")
