"""Column builders for raw text fields.

Every builder stays a built-in expression, so it runs inside code generation, and none
raises on bad text: a value that does not parse is NULL, also in ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space, number and date shapes, truth words, and the text that stands for "no value".
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NUMBER = r"([+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?)"
YEAR_OF_1900S = r"(69|[7-9]\d)"
YEAR_OF_2000S = r"([0-5]\d|6[0-8])"
DAY_AND_MONTH = r"\.(?: (?=[1-9]\.))?(0[1-9]|[12]\d|3[01]|[1-9])\.(0[1-9]|1[0-2]|[1-9])"
STARTS_WITH_YEAR = r"\d{4}"
OTHER_TIMES = (
    "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy", "d MMM yyyy H:mm:ss", "d MMM yyyy H:mm", "d MMM yyyy",
    "MMM d, yyyy H:mm:ss", "MMM d, yyyy H:mm", "MMM d, yyyy", "MMMM d, yyyy H:mm:ss", "MMMM d, yyyy",
    "d MMMM yyyy", "yyyy/M/d H:mm:ss", "yyyy/M/d", "yyyyMMdd'T'HHmmss", "yyyyMMdd",
)
WEEKDAY = r"\A(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*,? +"
ZONE = r"(?i: *(?:z|utc|gmt))\z"
TRUE_WORDS = "true|t|1|yes"
FALSE_WORDS = "false|f|0|no"
NO_VALUE = "nan"
INFERRED_PREFIX = "inferred_"

_SPACE = f"[{WHITESPACE}]*"


def _whole(pattern: str, flags: str = "") -> str:
    """The pattern for the whole text up to surrounding white space.

    One match on the raw text is cheaper than stripping it first for each use.
    """
    return rf"{flags}\A{_SPACE}{pattern}{_SPACE}\z"


def strip(c: Column) -> Column:
    """Drop leading and trailing Unicode white space."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_missing(c: Column) -> Column:
    """NULL, blank, or the text ``nan`` (V2)."""
    return c.isNull() | c.rlike(_whole(f"(?:{NO_VALUE})?"))


def parse_int(c: Column, to: str = "bigint") -> Column:
    """Number text truncated toward zero (F1); the pattern keeps out Java-only forms such as ``1d``."""
    number = F.regexp_extract(c, _whole(NUMBER), 1)
    parsed = number.try_cast("double").try_cast("bigint")
    return parsed if to == "bigint" else parsed.try_cast(to)


def parse_bool(c: Column) -> Column:
    """Truth words in any case (F2); anything else is NULL."""
    return F.when(c.rlike(_whole(f"(?:{TRUE_WORDS})", "(?i)")), F.lit(True)).when(
        c.rlike(_whole(f"(?:{FALSE_WORDS})", "(?i)")), F.lit(False)
    )


def parse_feed_date(c: Column) -> Column:
    """``yy.dd.mm`` (F3). Years 69-99 are 19xx; impossible days are NULL."""
    late = _whole(YEAR_OF_2000S + DAY_AND_MONTH)
    early = _whole(YEAR_OF_1900S + DAY_AND_MONTH)
    return F.when(c.rlike(late), F.regexp_replace(c, late, "20$1-$3-$2").try_cast("date")).when(
        c.rlike(early), F.regexp_replace(c, early, "19$1-$3-$2").try_cast("date")
    )


def parse_iso_timestamp(c: Column) -> Column:
    """ISO-8601 text as UTC wall time (F4, F11); needs a UTC session. Other spellings are NULL."""
    dated = c.rlike(rf"\A{_SPACE}{STARTS_WITH_YEAR}")
    return F.when(dated, F.try_to_timestamp(strip(c))).cast("timestamp_ntz")


def parse_time(c: Column) -> Column:
    """ISO-8601 or another common spelling as UTC wall time (F4); month comes before day in ``1/2/2024``.

    The other spellings are tried only where ISO fails; a weekday before and a UTC mark behind are dropped.
    """
    plain = F.regexp_replace(F.regexp_replace(strip(c), WEEKDAY, ""), ZONE, "")
    others = [F.try_to_timestamp(plain, F.lit(f)).cast("timestamp_ntz") for f in OTHER_TIMES]
    return F.coalesce(parse_iso_timestamp(c), *others)


def contains_ignoring_case(c: Column, text: str, wildcards: bool = False) -> Column:
    """Substring match in any case (P7, F16); ``%`` and ``_`` match themselves unless asked."""
    if not wildcards:
        for special in ("\\", "%", "_"):
            text = text.replace(special, "\\" + special)
    return c.ilike(f"%{text}%")


def raw_json(columns: Iterable[str], keep_nulls: bool = True) -> Column:
    """The row as JSON text for quarantine."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return F.to_json(F.struct(*[F.col(c) for c in columns]), options)


def surrogate_key(*parts: Column) -> Column:
    """Key that depends on its row alone (D9), so no global numbering is needed."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def inferred_id(title: Column) -> Column:
    """Identity of a member known only by its title."""
    return F.concat(F.lit(INFERRED_PREFIX), F.md5(title))
