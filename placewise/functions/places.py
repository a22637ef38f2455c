"""Names of places in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A name agrees with another one if it takes at most one edit for so many letters.
LETTERS_PER_EDIT = 4
# Words of so many letters, and beginnings of so many, are what two names must share to be compared.
BLOCK_LETTERS = 3


def name_words(text: Column | str) -> Column:
    """The words of a text in lower case: runs of letters and digits. Null for a null text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def plain_name(text: Column | str) -> Column:
    """The words with one space between them: what two spellings of a name have in common."""
    return F.array_join(name_words(text), " ")


def word_runs(words: Column, longest: int) -> Column:
    """All runs of up to ``longest`` words, as ``size`` (words), ``start`` (from 0) and ``run``."""
    def of(size: Column) -> Column:
        starts = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda start: F.struct(size.alias("size"), start.alias("start"),
                                                          F.array_join(F.slice(words, start + 1, size), " ").alias("run")))

    return F.flatten(F.transform(F.sequence(F.lit(1), F.lit(longest)), of))


def _blocks(name: Column) -> Column:
    words = F.filter(F.split(name, " "), lambda word: F.length(word) >= BLOCK_LETTERS)
    return F.array_union(words, F.array(F.substring(name, 1, BLOCK_LETTERS)))


def names_agree(one: Column | str, other: Column | str, letters_per_edit: int = LETTERS_PER_EDIT) -> Column:
    """Whether two names are the same but for a few letters; null if one of them is.

    Case and the signs between words do not count. Names that share neither a word nor their beginning
    are told apart by that alone; the others by their edit distance, which is given up beyond the
    one edit for each ``letters_per_edit`` letters of the longer name.
    """
    one, other = plain_name(one), plain_name(other)
    limit = F.floor(F.greatest(F.length(one), F.length(other)) / letters_per_edit).cast("int")
    near = F.arrays_overlap(_blocks(one), _blocks(other)) & (F.levenshtein(one, other) <= limit)
    return F.when(one == other, True).otherwise(near)
