"""Text expressions: whitespace strip, first-artist parse, blank-key defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (str.isspace).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Options that let from_json read Python-style list literals such as ['A', "B"].
_LIST_LITERAL_OPTIONS = {
    "allowSingleQuotes": "true",
    "allowBackslashEscapingAnyCharacter": "true",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_chars(c: Column | str, chars: str) -> Column:
    """Python ``str.strip(chars)``: outer characters of a set, no regex involved."""
    return F.trim(_col(c), F.lit(chars))


def strip_whitespace(c: Column | str) -> Column:
    """Python ``str.strip()``: every outer whitespace character, not just spaces."""
    return strip_chars(c, PY_WHITESPACE)


def normalize_text(c: Column | str, default: str) -> Column:
    """Cast to string, fill null with ``default``, then strip (blank stays '')."""
    return strip_whitespace(F.coalesce(_col(c).cast("string"), F.lit(default)))


def blank_default(c: Column | str, default: str) -> Column:
    """``value or default`` for a text key (null and '' both take the default)."""
    return F.coalesce(F.nullif(_col(c).cast("string"), F.lit("")), F.lit(default))


def split_fields(c: Column | str, sep: str = ",") -> Column:
    """Split a line on every separator (no quoting), keeping empty fields."""
    return F.split(_col(c), sep, -1)


def contains_any(c: Column | str, needles: list[str]) -> Column:
    """Does the lower-cased text contain any of ``needles``?

    One regex per call (needles quoted literally) instead of one lower() and
    contains() per needle: filters get no common-subexpression elimination,
    so a pushed-down rule list would otherwise lower-case the text per needle.
    """
    if not needles:
        return F.lit(False)
    pattern = "|".join(r"\Q" + n.lower() + r"\E" for n in needles)
    return F.lower(_col(c)).rlike(pattern)


def first_artist(c: Column | str) -> Column:
    """First performer of an artists cell.

    A list literal gives its first element, a quoted scalar its content;
    anything else falls back to the text before the first comma with
    brackets, spaces and quotes stripped. Null stays null, '[]' gives ''.
    """
    s = strip_whitespace(_col(c).cast("string"))
    as_list = F.from_json(s, "array<string>", _LIST_LITERAL_OPTIONS)
    from_list = F.when(
        s.startswith("[") & s.endswith("]"), strip_whitespace(F.get(as_list, 0))
    )
    wrapped = F.from_json(F.concat(F.lit("["), s, F.lit("]")), "array<string>", _LIST_LITERAL_OPTIONS)
    from_scalar = F.when(
        (s.startswith("'") | s.startswith('"')) & (F.size(wrapped) == 1),
        strip_whitespace(F.get(wrapped, 0)),
    )
    # lists that JSON rejects (None items, a trailing comma): the quoted text that opens the list
    opened = F.regexp_extract(s, r"""^\[\s*(?:'((?:[^'\\]|\\.)*+)'|"((?:[^"\\]|\\.)*+)")\s*[,\]].*\]$""", 0) != ""
    quoted = F.coalesce(*[F.nullif(F.regexp_extract(s, p, 1), F.lit("")) for p in (r"""^\[\s*'((?:[^'\\]|\\.)*+)'""", r"""^\[\s*"((?:[^"\\]|\\.)*+)\"""")], F.lit(""))
    from_opened = F.when(opened, strip_whitespace(F.regexp_replace(quoted, r"""\\(['"\\])""", "$1")))
    unbracketed = strip_chars(s, "[]")
    before_comma = F.substring_index(unbracketed, ",", 1)
    fallback = strip_chars(before_comma, " '\"")
    return F.coalesce(from_list, from_scalar, from_opened, fallback)
