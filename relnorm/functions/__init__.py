"""Column -> Column functions (built-in Catalyst expressions only)."""

from relnorm.functions.codes import (
    FALLBACK_PUBLICATION_CODES, issue_code, item_code, publication_code,
    shard_key, sole_match, unescape_key, escape_key, zero_fill,
)
from relnorm.functions.text import (
    clean_title, invert_article, slug, split_list, trim_elements, cap_title,
    normalise_newlines, decode_text, orient_pair, name_prefix, strip_suffix,
    blank_to_zero, upper_or_null, blank_fk, renumber_label,
)
from relnorm.functions.dates import MONTHS, month_number, assemble_date
from relnorm.functions.sizes import human_size
from relnorm.functions.predicates import (
    any_field_equals, not_blank, path_kind, within_size, has_extension,
    name_in, is_hidden,
)

__all__ = [n for n in dir() if not n.startswith("_")]
