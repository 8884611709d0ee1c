"""Text expressions shared by the parsers, the rules and the reports."""

from __future__ import annotations

import re

from landfall.functions.sql import lit

PREVIEW_CHARS = 200

# Null tokens of pipe-separated text and what replaces them,
# applied in this order.
NULL_TOKENS = (
    (r"\|null\|", "| |"),
    (r"\|null$", "| "),
    (r"^null\|", " |"),
    (r"\|NULL\|", "| |"),
    (r"\|NULL$", "| "),
    (r"\|\|", "| |"),
)


def replace_pattern(c: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({c}, {lit(pattern)}, {lit(by)})"


# The characters up to U+0020, as escapes of a SQL literal.
BLANKS = "'" + "".join(f"\\u{i:04x}" for i in range(0x21)) + "'"


def strip(c: str) -> str:
    """Drop leading and trailing characters up to U+0020, not only blanks."""
    return f"trim(BOTH {BLANKS} FROM {c})"


def strip_start(c: str) -> str:
    return f"trim(LEADING {BLANKS} FROM {c})"


def is_blank(c: str) -> str:
    """Nothing but characters up to U+0020; null for null. Looks no further than the first other one.

    Texts compare by their bytes, so what begins with another character is not below '!', and is not trimmed.
    """
    return f"({c} < '!' AND {strip_start(c)} = '')"


def split_literal(c: str, delimiter: str) -> str:
    """Split on the delimiter itself (not a pattern), keeping trailing empties."""
    return f"split({c}, {lit(re.escape(delimiter))}, -1)"


def split_quoted(c: str, delimiter: str, quote: str) -> str:
    """Split on delimiters that are not in quotes; the parts are as written, see unquoted()."""
    d, q = re.escape(delimiter), re.escape(quote)
    pattern = f"(?s){d}({q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}(?={d}|\\z)|.*?(?={d}|\\z))"
    return f"regexp_extract_all(concat({lit(delimiter)}, {c}), {lit(pattern)}, 1)"


def unquoted(parts: str, quote: str) -> str:
    """Quoted parts lose their quotes, two of them inside are one; a quote that is not closed, or not at the edges of its part, is text."""
    inner = f"replace(substring(part, 2, length(part) - 2), {lit(quote * 2)}, {lit(quote)})"
    closed = f"length(part) > 1 AND startswith(part, {lit(quote)}) AND endswith(part, {lit(quote)})"
    return f"transform({parts}, part -> CASE WHEN {closed} THEN {inner} ELSE part END)"


def unbalanced(parts: str, quote: str) -> str:
    """Whether a part begins with a quote and holds an odd number of them."""
    return f"exists({parts}, part -> startswith(part, {lit(quote)}) AND (length(part) - length(replace(part, {lit(quote)}, ''))) % 2 = 1)"


def split_list(c: str, separator: str = ";") -> str:
    """Trimmed items; empties at the end do not count, an empty text is one empty item."""
    kept = replace_pattern(c, f"(?:{re.escape(separator)})+\\z")
    return (
        f"CASE WHEN {c} = '' THEN array('') WHEN {kept} = '' THEN cast(array() as array<string>) "
        f"ELSE transform({split_literal(kept, separator)}, item -> {strip('item')}) END"
    )


def replace_null_tokens(c: str) -> str:
    """Blank out null tokens between pipes; a null line becomes an empty one."""
    out = c
    for pattern, blank in NULL_TOKENS:
        out = replace_pattern(out, pattern, blank)
    return f"CASE WHEN contains({c}, '|') THEN {out} ELSE coalesce({c}, '') END"


def replace_inner_null_tokens(c: str) -> str:
    """Null tokens between pipes inside one value of a record that is already parsed."""
    out = c
    for pattern, blank in NULL_TOKENS:
        if not pattern.startswith("^") and not pattern.endswith("$"):
            out = replace_pattern(out, pattern, blank)
    return f"CASE WHEN contains({c}, '|') THEN {out} ELSE {c} END"


def blank_null_word(c: str) -> str:
    """A value that is nothing but a null word becomes one blank."""
    return f"CASE WHEN {c} IN ('null', 'NULL') THEN ' ' ELSE {c} END"


def utf16_length(c: str) -> str:
    """Length in UTF-16 units, the unit in which feeds state their limits."""
    wide = f"cast(octet_length(encode({c}, 'UTF-16BE')) / 2 as int)"
    return f"if(octet_length({c}) = length({c}), length({c}), {wide})"


def preview(c: str, chars: int = PREVIEW_CHARS) -> str:
    return f"CASE WHEN length({c}) > {chars} THEN concat(substring({c}, 1, {chars}), '...') ELSE {c} END"


def base_name(path: str) -> str:
    return f"element_at(split({path}, '/'), -1)"


def json_quote(c: str) -> str:
    """The value as a JSON string literal; null is the empty literal."""
    listed = f"to_json(array(coalesce({c}, '')))"
    return f"substring({listed}, 2, length({listed}) - 2)"


def parse_instant(c: str) -> str:
    """ISO instant text to timestamp; blank or unreadable text is null."""
    return f"try_to_timestamp(nullif({strip(c)}, ''))"
