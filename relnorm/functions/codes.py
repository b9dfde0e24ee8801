"""Publication / issue / item codes.

All functions return Catalyst expressions; nothing is evaluated in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relnorm.functions._util import as_col

# Legacy publication ids whose code is looked up in the
# input sub-path, with the code used when the path holds no single
# 7-digit run.
FALLBACK_PUBLICATION_CODES = {
    "NCBL1001": "0000499",
    "NCBL1002": "0000499",
    "NCBL1023": "0000152",
    "NCBL1024": "0000171",
    "NCBL1029": "0000165",
    "NCBL1034": "0000160",
    "NCBL1035": "0000185",
}

# Fixed value: a publication code is a run of seven digits.
PUBLICATION_CODE_PATTERN = r"\d{7}"
CODE_WIDTH = 7


def sole_match(text, pattern: str = PUBLICATION_CODE_PATTERN) -> Column:
    """The match of ``pattern`` in ``text`` when there is exactly one, else NULL."""
    found = F.regexp_extract_all(as_col(text), F.lit(pattern), 0)
    return F.when(F.size(found) == 1, F.try_element_at(found, F.lit(1)))


def zero_fill(code, width: int = CODE_WIDTH) -> Column:
    """Left-pad with ``0`` to ``width``; longer input is kept whole (zfill)."""
    c = as_col(code)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def _fallback_map() -> Column:
    items = []
    for k, v in FALLBACK_PUBLICATION_CODES.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def raw_publication_code(pub_id, run) -> Column:
    """The code of an id and of the only 7-digit run of the sub-path (NULL if none), not yet checked."""
    pid, run = as_col(pub_id), as_col(run)
    fallback = F.try_element_at(_fallback_map(), F.coalesce(pid, F.lit("")))
    return (
        F.when(pid.isNull() | (pid == ""), run)
        .when(F.length(pid) == CODE_WIDTH, pid)
        .when(fallback.isNotNull(), F.coalesce(run, fallback))
        .when((F.length(pid) == 4) | pid.contains("NCBL"), run)
        .otherwise(zero_fill(pid))
    )


def publication_code_error(pub_id, run, raw) -> Column:
    """What is wrong with a raw code, else NULL."""
    pid, run, raw = as_col(pub_id), as_col(run), as_col(raw)
    return (
        F.when((pid.isNull() | (pid == "")) & run.isNull(), F.lit("no publication code in id or path"))
        .when(raw.isNull(), F.lit("publication code look-up failed"))
        .when(F.length(raw) != CODE_WIDTH,
              F.concat(F.lit("publication code of wrong length: "), raw))
    )


def publication_code(pub_id, sub_path) -> Column:
    """Resolve a publication code; returns ``struct<code:string, error:string>``.

    Cascade: a 7-character id is kept; a listed legacy id takes the only
    7-digit run of the sub-path, else its fixed fallback; any other
    4-character or ``NCBL`` id takes the only run, else fails; a blank or
    absent id takes the only run, else fails; anything else is zero-filled.
    A result that is not 7 characters long fails.  Failures give a NULL code
    and an error text, so callers can quarantine instead of aborting.
    """
    run = sole_match(sub_path)
    raw = raw_publication_code(pub_id, run)
    error = publication_code_error(pub_id, run, raw)
    return F.struct(F.when(error.isNull(), raw).alias("code"), error.alias("error"))


def shard_key(code) -> Column:
    """First two digits of the code without leading zeros, ``0``-padded if one."""
    head = F.substring(F.regexp_replace(as_col(code), r"^0+", ""), 1, 2)
    return F.when(F.length(head) == 1, F.concat(F.lit("0"), head)).otherwise(head)


def issue_code(code, issue_date) -> Column:
    """``<code>-<yyyymmdd>`` with dashes removed from both parts."""
    return F.concat(F.replace(as_col(code), F.lit("-"), F.lit("")), F.lit("-"),
                    F.replace(as_col(issue_date), F.lit("-"), F.lit("")))


def item_code(issue, item_id) -> Column:
    """``<issue code>-<item id>``."""
    return F.concat(as_col(issue), F.lit("-"), as_col(item_id))


def escape_key(value) -> Column:
    """``/`` → ``---`` (only for reading or writing legacy caches)."""
    return F.replace(as_col(value), F.lit("/"), F.lit("---"))


def unescape_key(value) -> Column:
    """``---`` → ``/``."""
    return F.replace(as_col(value), F.lit("---"), F.lit("/"))
