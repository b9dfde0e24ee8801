"""Text cleaning, list splitting, decoding and label helpers."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from relnorm.functions._util import as_col

# Fixed values
LIST_SEPARATOR = "<SEP>"
TITLE_MAX_CHARS = 2097151
DECODE_ERROR = "invalid UTF-8 byte sequence"


def strip(c: Column) -> Column:
    # Python's str.strip() removes Unicode white space and the separators
    # \x1c-\x1f at both ends; Spark's trim only spaces, so strip with a regex.
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\A[\s\x1C-\x1F]+", ""), r"(?U)[\s\x1C-\x1F]+\z", "")


def clean_title(title) -> Column:
    """rstrip ``.`` → strip → rstrip ``:`` → strip; NULL → ``''``."""
    c = F.regexp_replace(as_col(title), r"\.+\z", "")
    c = strip(c)
    c = F.regexp_replace(c, r":+\z", "")
    return F.coalesce(strip(c), F.lit(""))


def cap_title(title, max_chars: int = TITLE_MAX_CHARS) -> Column:
    return F.substring(as_col(title), 1, max_chars)


def invert_article(title) -> Column:
    """``X, The`` → ``The X`` (case-insensitive suffix, trimmed first)."""
    t = strip(as_col(title))
    return F.regexp_replace(t, r"(?is)^(.*), the\z", "The $1")


def _decomposed() -> tuple[str, str]:
    """Latin letters that Unicode decomposes into an ASCII letter and marks, and those letters."""
    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = [c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)]
        if len(base) == 1 and base[0].isascii() and base[0].isalpha():
            pairs.append((chr(code), base[0]))
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


_ACCENTED, _PLAIN = _decomposed()

# Letters that Unicode doesn't decompose.
_SPELLED = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "þ": "th", "ð": "d", "đ": "d", "ł": "l", "ħ": "h", "ı": "i"}


def transliterate(text) -> Column:
    """Latin letters with marks, and a few others, as ASCII letters; further characters stay.

    Combining marks of decomposed text are dropped.
    """
    c = F.translate(F.regexp_replace(as_col(text), r"\p{M}+", ""), _ACCENTED, _PLAIN)
    for letter, plain in _SPELLED.items():
        c = F.replace(c, F.lit(letter), F.lit(plain))
        if len(letter.upper()) == 1 and letter.upper().lower() == letter:
            c = F.replace(c, F.lit(letter.upper()), F.lit(plain.title()))
    return c


def slug(text) -> Column:
    """ASCII slug: transliterated, lower-case, runs of other characters → ``-``, ends trimmed.

    Digits separated by a comma are joined first (``1,000`` → ``1000``).
    Letters of other scripts than Latin are dropped.
    """
    c = F.lower(transliterate(text))
    c = F.regexp_replace(c, r"'", "-")
    c = F.regexp_replace(c, r"(\d),(\d)", "$1$2")
    c = F.regexp_replace(c, r"(\d),(\d)", "$1$2")
    c = F.regexp_replace(c, r"[^a-z0-9]+", "-")
    return F.regexp_replace(c, r"^-+|-+$", "")


def split_list(text, sep: str = LIST_SEPARATOR) -> Column:
    """Split a delimited string; NULL → empty array; trailing blanks kept."""
    c = as_col(text)
    pattern = "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in sep)
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(
        F.split(c, pattern, -1))


def trim_elements(arr) -> Column:
    """Strip whitespace of every array element, order and duplicates kept."""
    return F.transform(as_col(arr), strip)


def normalise_newlines(text) -> Column:
    """CRLF / CR → LF, as text-mode reading does."""
    return F.regexp_replace(as_col(text), "\r\n?", "\n")


def decode_text(raw) -> Column:
    """Binary → ``struct<text, error>``: valid UTF-8 gives normalised text and
    NULL error; invalid bytes give ``''`` and an error message."""
    s = as_col(raw).cast("string")
    ok = F.is_valid_utf8(s)
    return F.struct(
        F.when(ok, normalise_newlines(s)).otherwise(F.lit("")).alias("text"),
        F.when(ok, F.lit(None).cast("string")).otherwise(F.lit(DECODE_ERROR)).alias("error"),
    )


def orient_pair(pair) -> Column:
    """``[a, b]`` → ``struct<label, wikidata_id>``: the element starting with
    ``Q`` is the id, the other the label."""
    p = as_col(pair)
    q_first = F.try_element_at(p, F.lit(1)).startswith("Q")
    return F.struct(
        F.when(q_first, F.try_element_at(p, F.lit(2))).otherwise(F.try_element_at(p, F.lit(1))).alias("label"),
        F.when(q_first, F.try_element_at(p, F.lit(1))).otherwise(F.try_element_at(p, F.lit(2))).alias("wikidata_id"),
    )


def name_prefix(name, sep: str = "_") -> Column:
    """Part of a name before the first ``sep`` (title abbreviation of an archive)."""
    return F.substring_index(as_col(name), sep, 1)


def strip_suffix(name, suffix: str) -> Column:
    return F.replace(as_col(name), F.lit(suffix), F.lit(""))


def blank_to_zero(value) -> Column:
    """Blank or missing numeric text → 0.0, otherwise the number (NULL if not one)."""
    c = as_col(value)
    return F.when(c.isNull() | (strip(c) == ""), F.lit(0.0)).otherwise(c.try_cast("double"))


def upper_or_null(value) -> Column:
    return F.upper(as_col(value))


def blank_fk(value) -> Column:
    """Whitespace-only, missing, zero or non-numeric key → NULL, else bigint."""
    k = F.trim(as_col(value).cast("string")).try_cast("bigint")
    return F.when(k != 0, k)


def renumber_label(label, max_number, index: int = -1, width: int | None = None) -> Column:
    """Zero-pad the ``index``-th (default last) whole number in a label.

    ``max_number`` is the largest such number over the table (a column, e.g.
    from a one-row aggregate); the width is its digit count + 1 unless a
    wider ``width`` is given.  The first occurrence of the matched digits is
    replaced, the rest of the label is kept.
    """
    lab = as_col(label)
    found = F.regexp_extract_all(lab, F.lit(r"\b\d+\b"), 0)
    match = F.try_element_at(found, F.lit(index if index < 0 else index + 1))
    digits = F.length(as_col(max_number).cast("string")) + 1
    w = digits if width is None else F.greatest(digits, F.lit(width))
    number = F.regexp_replace(match, r"^0+(?=\d)", "")  # as text: any number of digits
    padded = F.lpad(number, F.greatest(w, F.length(number)), F.lit("0"))
    pos = F.instr(lab, match)
    return F.when(match.isNull(), lab).otherwise(
        F.concat(F.substring(lab, F.lit(1), pos - 1), padded,
                 F.substring(lab, pos + F.length(match), F.lit(1 << 30))))
