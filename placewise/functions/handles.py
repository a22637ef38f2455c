"""User handles in the text of a post."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the whole text must match; greedy, so the last handle before white space.
LAST_HANDLE = r"\A.*(@\w+)\s+.*\z"

# The same in linear time: LAST_HANDLE tries the rest of the line again for each handle of
# a text with line ends. Either the text is one line, or all its line ends lie in the white
# space right after the handle.
_LAST_HANDLE = r"\A(?:(?=.*+\z).*(?=@\w+\s)|.*(?=@\w+[ \t\x0B\f]*+[\n\r]\s*+.*+\z))(@\w+)"

ANY_HANDLE = r"@\w+"


def last_handle(text: Column | str = "data.text") -> Column:
    """The last handle that white space follows; null when there is none.

    ``.`` stops at a line end, so a text of several lines matches only where the white
    space after the handle is the line end itself.
    """
    text = F.col(text) if isinstance(text, str) else text
    # Looking for the sign first spares most texts the backtracking pattern.
    return F.when(text.contains("@"), F.nullif(F.regexp_extract(text, _LAST_HANDLE, 1), F.lit("")))


def all_handles(text: Column | str = "data.text") -> Column:
    """Every handle of the text, as an array with repeats; null for a text without the sign."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.contains("@"), F.regexp_extract_all(text, F.lit(ANY_HANDLE), F.lit(0)))
