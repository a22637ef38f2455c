"""Keyword flags: does a text hold any word of a list?"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# The words and signs that make a post positive.
POSITIVE_WORDS: tuple[str, ...] = tuple("""
absolutely accepted acclaimed accomplish accomplishment achievement action active admire adorable adventure
affirmative affluent agree amazing angelic appealing approve aptitude attractive awesome beaming beautiful
believe beneficial bliss bountiful bounty brave bravo brilliant bubbly calm celebrated certain champ champion
charming cheery choice classic clean commend composed congratulation constant cool courageous creative cute
dazzling delight distinguished divine earnest easy ecstatic effective effervescent efficient effortless
electrifying elegant enchanting encouraging endorsed energetic energized engaging enthusiastic essential
esteemed ethical excellent exciting exquisite fabulous fair familiar famous fantastic favorable fetching fine
fitting flourishing fortunate free fresh friendly fun funny generous genius genuine giving glamorous glowing
good gorgeous graceful great green grin growing handsome happy harmonious healing healthy hearty heavenly
honest honorable honored hug lively lovely lucky luminous ❤ 😍 💛 😊 😂 😃
""".split())


def keyword_pattern(words: Iterable[str], ignore_case: bool = False, whole_word: bool = False) -> str:
    """One regular expression for all words, sharing their common beginnings.

    The leading look-ahead lets the matcher pass over characters no word begins with.
    """
    tree: dict = {}
    for word in words:
        node = tree
        for char in word:
            node = node.setdefault(char, {})
        node[""] = {}
    if not tree or "" in tree:
        raise ValueError("keywords must be a list of non-empty words")

    def render(node: dict) -> str:
        if "" in node and not whole_word:
            return ""  # a shorter word already matches here
        branches = [re.escape(char) + render(rest) for char, rest in node.items() if char]
        if not branches:
            return ""
        group = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        return f"(?:{group})?" if "" in node else group

    pattern = f"(?=[{''.join(re.escape(char) for char in tree)}]){render(tree)}"
    if whole_word:
        pattern = rf"(?<![\p{{L}}\p{{N}}_]){pattern}(?![\p{{L}}\p{{N}}_])"
    return ("(?iu)" if ignore_case else "") + pattern


# Letters of English words from the rarest on, down to those that a sixth of all letters of a text are.
RARE = "zqxjkvbpgwyfmcld"


def _class(chars: Iterable[str]) -> str:
    return f"[{''.join(re.escape(c) for c in sorted(set(chars)))}]"


def _ends(words: Iterable[str]) -> str:
    """What may follow a letter, as a tree of common beginnings; a longer ending that holds a shorter one is spared."""
    tree: dict = {}
    for word in words:
        node = tree
        for char in word:
            node = node.setdefault(char, {})
        node[""] = {}

    def render(node: dict) -> str:
        if "" in node:
            return ""
        branches = [re.escape(char) + render(rest) for char, rest in sorted(node.items())]
        if len(branches) == 1:
            return branches[0]
        return (f"(?={_class(node)})" if len(node) > 2 else "") + "(?:" + "|".join(branches) + ")"

    return render(tree)


def rare_letter_pattern(words: Iterable[str]) -> tuple[str | None, list[str]]:
    """A regular expression that looks for each word at its rarest letter, and the words without a rare letter.

    Most letters of a text are none of the rare ones and cost one test. A rare letter is told
    from the others by halves, then the letters on both sides of it are tested before a
    """
    words = sorted(set(words))
    if not words or "" in words:
        raise ValueError("keywords must be a list of non-empty words")
    words = [w for w in words if not any(other != w and other in w for other in words)]
    at: dict[str, list[tuple[str, str]]] = {}
    plain = []
    for word in words:
        rare = [i for i, char in enumerate(word) if char in RARE]
        if rare:
            place = min(rare, key=lambda i: (RARE.index(word[i]), i == 0))
            at.setdefault(word[place], []).append((word[:place], word[place + 1:]))
        else:
            plain.append(word)

    def around(letter: str) -> str:
        first = [after for before, after in at[letter] if not before]
        later = [(before, after) for before, after in at[letter] if before]
        branches = []
        if first:
            branches.append(_ends(first))
        if later:
            guard = f"(?<={_class(before[-1] for before, _ in later)}{letter})"
            if all(after for _, after in later):
                guard += f"(?={_class(after[0] for _, after in later)})"
            tests = "|".join(f"(?<={re.escape(before)}{letter}){re.escape(after)}" for before, after in later)
            branches.append(f"{guard}(?:{tests})")
        return letter + (branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")")

    def halves(letters: list[str]) -> str:
        if len(letters) == 1:
            return around(letters[0])
        middle = len(letters) // 2
        return "|".join(f"(?={_class(half)})(?:{halves(half)})" if len(half) > 1 else halves(half)
                        for half in (letters[:middle], letters[middle:]))

    letters = sorted(at, key=lambda char: -RARE.index(char))
    return (f"(?={_class(letters)})(?:{halves(letters)})" if letters else None), plain


def _folded(text: Column) -> Column:
    """Lower case, and the few other signs that are a letter of ASCII in another case.

    ``translate`` goes over a text sign by sign and costs twice as much as ``lower``; a byte search for
    each of the three signs is cheaper, so it is left out for texts that hold none of them.
    """
    signs = reduce(Column.__or__, (text.contains(sign) for sign in "ſıİ"))
    return F.lower(F.when(signs, F.translate(text, "ſıİ", "sii")).otherwise(text))


def has_keyword(text: Column | str = "data.text", words: Iterable[str] = POSITIVE_WORDS,
                ignore_case: bool = False, whole_word: bool = False) -> Column:
    """True if the text holds any of the words as a substring; null for a null text.

    By default case counts and words may be parts of others (``fun`` in ``funeral``).
    """
    text = F.col(text) if isinstance(text, str) else text
    words = list(words)
    if whole_word or ignore_case and not all(word.isascii() and word.islower() for word in words if word.lower() != word.upper()):
        return text.rlike(keyword_pattern(words, ignore_case, whole_word))
    # A byte search for each of the few signs leaves the pattern without surrogate pairs,
    # which slow the matcher at every character; words without a rare letter are searched in the same way.
    text = _folded(text) if ignore_case else text
    ascii_words = [word for word in words if word.isascii()]
    pattern, plain = rare_letter_pattern(ascii_words) if ascii_words else (None, [])
    found = [text.contains(word) for word in (*(word for word in words if not word.isascii()), *plain)]
    if not words:
        raise ValueError("keywords must be a list of non-empty words")
    return reduce(Column.__or__, ([text.rlike(pattern)] if pattern else []) + found)


def _escaped(word: str) -> str:
    """A word as a pattern of RE2: ASCII letters and digits as they are, every other sign by its code point."""
    return "".join(char if char.isascii() and char.isalnum() else f"\\x{{{ord(char):x}}}" for char in word)


def has_keyword_in_batches(text: Column | str = "data.text", words: Iterable[str] = POSITIVE_WORDS,
                           ignore_case: bool = False, whole_word: bool = False) -> Column:
    """``has_keyword`` with the same results, searched in Arrow batches by one automaton instead of Java's matcher.

    ``rlike`` tries its pattern anew at each sign of a text; RE2 reads each byte once. Its plan holds
    Python, so it is for streams; whole words and the other case folds are left to ``has_keyword``.
    """
    text = F.col(text) if isinstance(text, str) else text
    words = list(words)
    if not words or "" in words:
        raise ValueError("keywords must be a list of non-empty words")
    if whole_word or ignore_case and not all(word.isascii() and word.islower() for word in words if word.lower() != word.upper()):
        return has_keyword(text, words, ignore_case, whole_word)
    pattern = "|".join(map(_escaped, sorted(set(words))))

    @F.arrow_udf("boolean")
    def found(texts: pa.Array) -> pa.Array:
        return pc.match_substring_regex(texts, pattern)

    return found(_folded(text) if ignore_case else text)
