"""Text helpers that agree with Unicode-aware regular expressions and string methods, inside Spark's own functions."""

import os
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode classes and case; dot and anchors know only the line feed.
FLAGS = "(?Ud)"
IGNORE_CASE = "(?iuUd)"
SPACE = r"[\s\x1c-\x1f]"


#: The characters of SPACE one by one.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?U)[^\s\x1c-\x1f]+"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)[^\s\x1c-\x1f]+"))


def capitalize(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 2**31 - 1)))


def searched(pattern: str) -> str:
    """The pattern without the .* at its ends, which make no difference to whether a line has a match."""
    pattern = pattern.removeprefix(".*")
    return re.sub(r"(?<!\\)\.\*$", "", pattern)


def any_of(patterns: list[str]) -> str:
    return "|".join(f"(?:{searched(p)})" for p in patterns)


_TOKEN = re.compile(r"(\\.|\[(?:\\.|[^\]\\])*\]|\((?:\\.|[^()\\])*\)|.)([*+?]\??)?", re.DOTALL)
#: What lower case leaves of letters that match i or s in any case, but are not told as these by lower case.
ODD_CASES = ["\u0307", "\u0131", "\u017f"]


def telling_parts(pattern: str) -> list[str] | None:
    """Texts of which every match of a pattern, in lower case, has at least one: its longest run of plain characters, or those of a small class; None if it has neither."""
    runs, classes, run = [], [], ""
    for token, times in _TOKEN.findall(searched(pattern)):
        if token == "|":
            return None
        plain = token[-1] if len(token) == 1 and token not in ".^$" or len(token) == 2 and not token[1].isalnum() else ""
        if plain and times[:1] in ("", "+"):
            run += plain.lower()
        elif re.fullmatch(r"\[[^-^\\\]]+\]", token) and not times:
            classes.append(list(token[1:-1].lower()))
        if not plain or times:
            runs, run = [*runs, run], ""
    longest = max([*runs, run], key=len)
    return [longest] if longest else classes[0] if classes else None


def _guard(pattern: str) -> tuple[str, ...] | None:
    """The telling parts of a pattern, or one behind ^ that a line must start with."""
    own = telling_parts(pattern)
    if own is None:
        return None
    return ("^" + own[0],) if len(own) == 1 and pattern[:1] == "^" and pattern[1:].lower().startswith(own[0]) else tuple(own)


def guarded(patterns: list[str]) -> list[tuple[tuple[str, ...], list[str]]] | None:
    """Patterns with what their matches need: those whose one part begins with the same five characters share that beginning. None if one has no telling part."""
    groups: dict[tuple, list] = {}
    for pattern in patterns:
        own = _guard(pattern)
        if own is None:
            return None
        shared = len(own) == 1 and own[0][0] != "^" and len(own[0]) > 5
        groups.setdefault((own[0][:5],) if shared else own, []).append((own, pattern))
    return [((os.path.commonprefix([own[0] for own, _ in each]),) if len(key) == 1 else key, [p for _, p in each]) for key, each in groups.items()]


def has_odd_case(lower: Column) -> Column:
    return contains_any(lower, ODD_CASES)


def like_any(text: Column, lower: Column, patterns: list[str], odd: Column | None = None) -> Column:
    """Whether one of the patterns matches in any case. Only texts whose lower case has what a match needs are tried, each pattern for what it needs itself.

    odd: whether letters of ODD_CASES may be in the text, where a caller knows it of several lines.
    """
    like = lambda own: F.regexp_like(text, F.lit(IGNORE_CASE + (any_of(own) if len(own) > 1 else searched(own[0]))))
    groups = guarded(patterns)
    if groups is None:
        return like(patterns)
    found = (has_odd_case(lower) if odd is None else odd) & like(patterns)
    for parts, own in groups:
        held = F.startswith(lower, F.lit(parts[0][1:])) if parts[0][:1] == "^" and len(parts[0]) > 1 else contains_any(lower, list(parts))
        found = found | (held & like(own))
    return found


def contains_any(text: Column, parts: list[str]) -> Column:
    found = F.contains(text, F.lit(parts[0]))
    for part in parts[1:]:
        found = found | F.contains(text, F.lit(part))
    return found


def first_contained(text: Column, parts: list[str], made=F.lit) -> Column:
    """The first of the parts that the text contains, as made of it; null if none."""
    return F.coalesce(*(F.when(F.contains(text, F.lit(p)), made(p)) for p in parts), F.lit(None))


def count_contained(text: Column, parts: list[str]) -> Column:
    total = F.lit(0)
    for part in parts:
        total = total + F.contains(text, F.lit(part)).cast("int")
    return total


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body names it; keeps plans small."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
