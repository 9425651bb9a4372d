"""Column builders that turn raw text into typed values.

Every builder is a plain Column expression (code-generated, no Python worker).
A value that does not parse becomes NULL and never raises, whatever the
session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings accepted as booleans.
TRUE_WORDS = ("t", "true", "1", "yes", "y")
FALSE_WORDS = ("f", "false", "0", "no", "n")

# Spellings a delimited file may use for "no value".
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Characters taken out of amounts and percentages.
MONEY, PERCENT = "$,", "%"

# Characters that count as surrounding whitespace.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# A number has a digit and none of the letters with which a cast would accept more than a plain number: type suffixes
# (1.5d), nan, inf, hexadecimal floats. Text that cannot be one is not tried, as a failed cast costs much more.
_NUMERAL = "^[^aAdDfFpP0-9]*[0-9][^aAdDfFpP]*$"
_NOT_WHITE = "[^" + "".join(f"\\u{ord(c):04x}" for c in WHITESPACE) + "]"
_DATE = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9:.Z+-]*)?\s*$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


# A cleaned table has some hundred parsed columns, so the builders below write each as one expression text: a plan
# of many columns is then put together by one call a column instead of one an operator.

def strip(c: str | Column) -> Column:
    """Trim every kind of surrounding whitespace, not only spaces."""
    return F.trim(col(c), F.lit(WHITESPACE))


def has_text(c: str) -> Column:
    """Whether a character other than ``WHITESPACE`` stands in the text (a search that stops at the first)."""
    return F.expr(f"{named(c)} RLIKE {literal(_NOT_WHITE)}")


def blank_to_null(c: str) -> Column:
    """Whitespace-only text becomes NULL; other text is left as it is."""
    return F.expr(f"CASE WHEN {named(c)} RLIKE {literal(_NOT_WHITE)} THEN {named(c)} END")


def missing_token_to_null(c: str) -> Column:
    """The usual spellings of "no value" become NULL."""
    return F.expr(f"CASE WHEN {named(c)} NOT IN ({', '.join(map(literal, MISSING_TOKENS))}) THEN {named(c)} END")


# Spark runs the code of a stage in methods, and those of more than 8,000 bytes are never compiled to machine code. A
# value that an expression names several times is written out as often, so the parsers name each once or twice, and a
# table of many columns is cleaned in two projections: the doubles (``plain``), then what is made of them.

def _plain_text(c: str, dropped: str = "") -> str:
    text = f"CAST({named(c)} AS STRING)"
    kept = f"translate({text}, {literal(dropped)}, '')" if dropped else text
    return f"CASE WHEN {text} RLIKE {literal(_NUMERAL)} THEN try_cast({kept} AS DOUBLE) END"


def _finite_text(x: str) -> str:
    return f"CASE WHEN abs({x}) < CAST('Infinity' AS DOUBLE) THEN {x} END"


def _whole_text(x: str, c: str) -> str:
    return f"CASE WHEN {x} = floor({x}) THEN coalesce(try_cast(CAST({named(c)} AS STRING) AS BIGINT), floor({x})) END"


def plain(c: str, dropped: str = "") -> Column:
    """The double of the text with the ``dropped`` characters taken out, infinite where it overflows."""
    return F.expr(_plain_text(c, dropped))


def finite(x: str) -> Column:
    """The finite values of a column of doubles."""
    return F.expr(_finite_text(named(x)))


def whole(x: str, c: str) -> Column:
    """``whole_number(c)`` where column ``x`` is ``plain(c)``."""
    return F.expr(_whole_text(named(x), c))


def number(c: str) -> Column:
    """Text or numeric column -> finite double, NULL when not a number."""
    return F.expr(_finite_text(_plain_text(c)))


def currency(c: str) -> Column:
    """``$1,250.00`` -> 1250.0."""
    return F.expr(_finite_text(_plain_text(c, MONEY)))


def percent(c: str) -> Column:
    """``95%`` -> 95.0 (points on a 0-100 scale)."""
    return F.expr(_finite_text(_plain_text(c, PERCENT)))


def boolean(c: str) -> Column:
    """Known spellings only; anything else is NULL, never a guess."""
    word = f"lower(trim(BOTH {literal(WHITESPACE)} FROM CAST({named(c)} AS STRING)))"
    known = ((TRUE_WORDS, "TRUE"), (FALSE_WORDS, "FALSE"))
    meanings = ", ".join(f"{literal(w)}, {meaning}" for words, meaning in known for w in words)
    return F.expr(f"try_element_at(map({meanings}), {word})")


def date(c: str) -> Column:
    """ISO calendar date, with or without a time part; partial dates are NULL."""
    text = f"CAST({named(c)} AS STRING)"
    return F.expr(f"CASE WHEN {text} RLIKE {literal(_DATE)} THEN try_cast({text} AS DATE) END")


def whole_number(c: str) -> Column:
    """Text such as ``12`` or ``12.0`` -> 12; a fraction or overflow is NULL.

    Plain numerals are cast directly, so identifiers beyond 2**53, where a
    double is not exact, keep every digit; only other spellings, which that
    cast refuses, get their value from the double.
    """
    return F.expr(_whole_text(_plain_text(c), c))


def yes_no_label(c: str | Column) -> Column:
    """Readable label of a flag: Yes, No, Missing, or the text itself."""
    raw = col(c).cast("string")
    word = F.lower(strip(raw))
    return (
        F.when(raw.isNull(), "Missing")
        .when(word.isin("true", "t", "1", "yes"), "Yes")
        .when(word.isin("false", "f", "0", "no"), "No")
        .otherwise(raw)
    )


def one_line(c: str | Column, limit: int = 120) -> Column:
    """A single-line sample: whitespace collapsed, cut at ``limit`` with ``...``."""
    text = strip(F.regexp_replace(col(c).cast("string"), r"\s+", " "))
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))).otherwise(text)


def is_blank(c: str | Column) -> Column:
    """True for NULL or text holding nothing but spaces."""
    c = col(c).cast("string")
    return c.isNull() | (F.trim(c) == "")
