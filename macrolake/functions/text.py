"""Text expressions: statement screening and reply clean-up.

The screening rules come from a language whose string functions are Unicode
aware, so whitespace and word characters are spelled out instead of using the
ASCII classes of the regex engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace.
_SPACES = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
_SPACES += list(range(0x2000, 0x200B)) + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WHITESPACE = "".join(map(chr, _SPACES))

# Words that make a statement unsafe.
FORBIDDEN_WORDS = (
    "insert", "update", "delete", "drop", "alter", "create",
    "truncate", "grant", "revoke", "copy", "call",
)
# Words a statement may start with.
LEADING_WORDS = ("select", "with")

EM_DASH = "—"

_WORD_CHAR = r"[\p{L}\p{N}_]"


def strip_whitespace(text: str | Column) -> Column:
    """Drop whitespace at both ends (a character-set trim: linear in the length of the text)."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_safe_select(statement: str | Column) -> Column:
    """True for a single SELECT or WITH statement without any forbidden word."""
    body = F.rtrim(strip_whitespace(statement), F.lit(";"))
    starts = rf"^(?iu)(?:{'|'.join(LEADING_WORDS)})(?!{_WORD_CHAR})"
    forbidden = rf"(?iu)(?<!{_WORD_CHAR})(?:{'|'.join(FORBIDDEN_WORDS)})(?!{_WORD_CHAR})"
    # The anchored test comes first: it settles most texts at their first character.
    return body.rlike(starts) & ~body.contains(";") & ~body.rlike(forbidden)


def strip_code_fence(text: str | Column) -> Column:
    """Remove an opening sql fence at a line start and a closing fence at a line end, then trim."""
    fence = rf"(?imud)^```sql[{WHITESPACE}]*|```$"
    body = strip_whitespace(text)
    # Most texts have no fence; a plain search is far cheaper than the expression.
    return F.when(body.contains("```"), strip_whitespace(F.regexp_replace(body, fence, ""))).otherwise(body)


def clean_reply_text(text: str | Column) -> Column:
    """Trim a reply and put a comma in place of each em dash."""
    return F.replace(strip_whitespace(text), F.lit(EM_DASH), F.lit(","))
