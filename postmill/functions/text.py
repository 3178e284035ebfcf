"""Column expressions over strings. Everything stays inside the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NON_ASCII = r"[^\x00-\x7F]"


def strip(text: Column) -> Column:
    """Trim white space of any script on both ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank; ends are trimmed."""
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def or_default(text: Column, default: str) -> Column:
    """``default`` for NULL and for the empty string."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(default)).otherwise(text)


def first_filled(*texts: Column) -> Column:
    """The first non-empty text, else the empty string."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts], F.lit(""))


def _any(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _shortest(words: Iterable[str]) -> list[str]:
    """Drop every word which holds another word of the list: the test is the same without it."""
    words = list(dict.fromkeys(words))
    return [w for w in words if not any(o != w and o in w for o in words)]


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """True if one of the words occurs anywhere."""
    return _any(F.contains(text, F.lit(w)) for w in _shortest(words))


def whole_word_any(text: Column, words: Iterable[str]) -> Column:
    """True if one of the words occurs between word boundaries of any script.

    The plain substring test comes first: it is cheap and false for most texts,
    so that the pattern runs on few of them.
    """
    words = list(words)
    pattern = r"(?U)\b(?:" + "|".join(rf"\Q{w}\E" for w in words) + r")\b"
    return contains_any(text, words) & text.rlike(pattern)


def python_list_text(items: Column) -> Column:
    """An array of strings in the notation ``['a', 'b']``."""

    def quoted(s: Column) -> Column:
        s = F.replace(s, F.lit("\\"), F.lit("\\\\"))
        for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            s = F.replace(s, F.lit(raw), F.lit(shown))
        plain = F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("\\'")), F.lit("'"))
        double = F.concat(F.lit('"'), s, F.lit('"'))
        return F.when(F.contains(s, F.lit("'")) & ~F.contains(s, F.lit('"')), double).otherwise(plain)

    escaped = F.concat(F.lit("["), F.array_join(F.transform(items, quoted), ", "), F.lit("]"))
    simple = F.concat(F.lit("['"), F.array_join(items, "', '"), F.lit("']"))
    needs_care = (F.size(items) == 0) | F.array_join(items, "").rlike(r"['\\\n\r\t]")
    return F.when(needs_care, escaped).otherwise(simple)


def lookup(mapping: Mapping[str, str], key: Column) -> Column:
    """Value of a small constant mapping, NULL when absent."""
    if not mapping:
        return F.lit(None).cast("string")
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def _fold_rules() -> tuple[str, str, dict[str, str]]:
    """Letters which decompose into ASCII, by rule over the Latin blocks."""
    singles, targets, longer = [], [], {}
    for block in (range(0xA0, 0x250), range(0x1E00, 0x1F00), range(0xFB00, 0xFB07)):
        for letter in map(chr, block):
            ascii_part = unicodedata.normalize("NFKD", letter).encode("ascii", "ignore").decode()
            if len(ascii_part) == 1:
                singles.append(letter)
                targets.append(ascii_part)
            elif ascii_part:
                longer[letter] = ascii_part
    return "".join(singles), "".join(targets), longer


FOLD_FROM, FOLD_TO, FOLD_LONGER = _fold_rules()


def fold(text: Column) -> Column:
    """Lower-case key without accents; letters which have no ASCII form are deleted."""
    folded = F.translate(text, FOLD_FROM, FOLD_TO)
    for letter, ascii_part in FOLD_LONGER.items():
        folded = F.replace(folded, F.lit(letter), F.lit(ascii_part))
    folded = F.regexp_replace(folded, NON_ASCII, "")
    return F.lower(F.when(text.rlike(NON_ASCII), folded).otherwise(text))


def url_key(url: Column) -> Column:
    """The URL up to its first question mark."""
    return F.substring_index(url, "?", 1)
