"""Text helpers on columns: path parts and byte-exact cleaning of loaded text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    """What follows the last slash; NULL when nothing does."""
    return F.regexp_substr(path, F.lit("[^/]+$"))


def last_segment(path: Column) -> Column:
    """The last piece of a split on slashes; an empty string after a trailing slash."""
    return F.element_at(F.split(path, "/"), -1)


def join_path(*parts: Column | str) -> Column:
    """Concatenate path pieces; NULL when any piece is NULL."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def digest(text: Column) -> Column:
    """32 bytes that stand for a text of any length, so that comparing long texts does not shuffle them."""
    return F.unhex(F.sha2(text, 256))


def decoded_file_name(metadata_name: Column) -> Column:
    """`_metadata.file_name` is percent-encoded, with a literal plus sign left as it is."""
    return F.url_decode(F.replace(metadata_name, F.lit("+"), F.lit("%2B")))


# Well-formed UTF-8 byte sequences, written over text whose characters are single bytes.
VALID_UTF8 = (
    r"(?:[\x00-\x7F]++"
    r"|[\xC2-\xDF][\x80-\xBF]"
    r"|\xE0[\xA0-\xBF][\x80-\xBF]"
    r"|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}"
    r"|\xED[\x80-\x9F][\x80-\xBF]"
    r"|\xF0[\x90-\xBF][\x80-\xBF]{2}"
    r"|[\xF1-\xF3][\x80-\xBF]{3}"
    r"|\xF4[\x80-\x8F][\x80-\xBF]{2})"
)
# Valid sequences from the end of the previous match, then one byte that starts none of them.
INVALID_BYTE = rf"(\G{VALID_UTF8}*+)[\x80-\xFF]"


def clean_bytes(raw: str, max_bytes: int | None) -> str:
    """SQL that turns byte text (one character per byte) into UTF-8 text of at most `max_bytes` bytes; None: of any length.

    Each invalid byte becomes one question mark; a character that the cut would split is left out whole.
    """
    valid = f"regexp_replace({raw}, r'{INVALID_BYTE}', '$1?')"
    if max_bytes is None:
        return f"if(octet_length({raw}) = length({raw}), {raw}, decode(encode({valid}, 'ISO-8859-1'), 'UTF-8'))"
    # The longest start within the limit that is not followed by the rest of a character.
    cut = rf"regexp_extract({valid}, r'^[\s\S]{{0,{max_bytes}}}(?![\x80-\xBF])', 0)"
    decoded = f"decode(encode({cut}, 'ISO-8859-1'), 'UTF-8')"
    return f"if(octet_length({raw}) = length({raw}), substring({raw}, 1, {max_bytes}), {decoded})"
