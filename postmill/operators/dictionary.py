"""Labels of texts by large dictionaries: all synonyms of all labels are looked for in one pass over each text.

The synonyms become one trie whose failure links say which synonyms may still go on; it is laid out as a table of next states. A batch of
texts moves through that table together, one character of every text at a time, so that the work per character depends neither on how many synonyms
there are nor on Python code per row. The table is built once per Python worker task from the synonyms, which are curated data of a checked size.
"""

from __future__ import annotations

import unicodedata
from collections import deque
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_CHARS = 2_000_000
"""The synonyms' characters in all; their table takes some hundred bytes each."""

PART_CHARS = 4096
_WORD = {"Lu", "Ll", "Lt", "Lm", "Lo", "Nl", "Nd", "Mn", "Mc", "Me", "Pc"}
_JOINERS = "‌‍"


def is_word_char(char: str) -> bool:
    """Letters, marks, digits and connectors of any script, as word borders take them."""
    return unicodedata.category(char) in _WORD or char in _JOINERS


class Synonyms:
    """A table of next states over classes of characters. State 0 is the root, class 0 any character that no synonym holds."""

    def __init__(self, labels: Mapping[str, Iterable[str]]):
        pairs = sorted({(w, label) for label, words in labels.items() for w in words if w})
        if sum(len(w) for w, _ in pairs) > MAX_CHARS:
            raise ValueError(f"synonyms have more than {MAX_CHARS} characters")
        self.words = [w for w, _ in pairs]
        self.labels = np.array([label for _, label in pairs], dtype=object)
        self.longest = max(map(len, self.words), default=0)
        self.classes = {c: n for n, c in enumerate(sorted(set("".join(self.words))), 1)}
        table, ends = [[0] * (len(self.classes) + 1)], [[]]
        for number, word in enumerate(self.words):
            state = 0
            for c in word:
                step = self.classes[c]
                if not table[state][step]:
                    table[state][step] = len(table)
                    table.append([0] * (len(self.classes) + 1))
                    ends.append([])
                state = table[state][step]
            ends[state].append(number)
        self.next = np.array(table, dtype=np.int32)
        self._link(ends)

    def _link(self, ends: list[list[int]]) -> None:
        """Fill missing steps from the failure state, level by level, and hand its endings on."""
        fail = np.zeros(len(self.next), np.int32)
        queue = deque(int(s) for s in self.next[0] if s)
        while queue:
            state = queue.popleft()
            own = self.next[state] > 0
            fallback = self.next[fail[state]]
            fail[self.next[state][own]] = fallback[own]
            ends[state] = ends[state] + ends[fail[state]]
            queue.extend(int(s) for s in self.next[state][own])
            self.next[state] = np.where(own, self.next[state], fallback)
        self.count = np.array([len(e) for e in ends], np.int32)
        self.first = np.cumsum(self.count) - self.count
        self.ends = np.array([n for e in ends for n in e], np.int32)

    def matches(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, synonym and end of every occurrence. Long texts go in parts which overlap by the longest synonym."""
        rows, begins, sizes, codes, total = [], [], [], [], 0
        for n, text in enumerate(texts):
            codes.append(np.fromiter((self.classes.get(c, 0) for c in text), np.int32, len(text)))
            for a in range(0, max(len(text), 1), PART_CHARS):
                from_ = max(0, a - self.longest + 1)
                rows.append((n, total, from_, a))
                begins.append(total + from_)
                sizes.append(min(len(text), a + PART_CHARS) - from_)
            total += len(text)
        everything = np.concatenate([np.zeros(0, np.int32), *codes])
        order = np.argsort(-np.array(sizes, dtype=np.int64), kind="stable")
        begins, sizes, rows = np.array(begins, np.int64)[order], np.array(sizes, np.int64)[order], np.array(rows, np.int64)[order]
        state = np.zeros(len(order), np.int32)
        found = []
        for step in range(int(sizes[0]) if len(sizes) else 0):
            active = int(np.searchsorted(-sizes, -step, "left"))
            state[:active] = self.next[state[:active], everything[begins[:active] + step]]
            hit = np.flatnonzero(self.count[state[:active]])
            if len(hit):
                found.append(np.stack([hit, np.full(len(hit), step), state[hit]]))
        hit, step, state = np.concatenate([np.zeros((3, 0), np.int64), *found], axis=1).astype(np.int64)
        number = self.count[state]
        each = np.repeat(np.arange(len(hit)), number)
        inner = np.arange(len(each)) - np.repeat(np.cumsum(number) - number, number)
        synonym = self.ends[self.first[state[each]] + inner]
        end = rows[hit, 2][each] + step[each] + 1
        own = end > rows[hit, 3][each]
        return rows[hit, 0][each][own], synonym[own], end[own]


def labels_of(texts: list[str], synonyms: Synonyms, whole_words: bool) -> list[list[str]]:
    """The sorted labels of each text with a synonym in it, between word borders if asked."""
    row, synonym, end = synonyms.matches(texts)
    found: list[set[str]] = [set() for _ in texts]
    for r, s, e in zip(row.tolist(), synonym.tolist(), end.tolist(), strict=True):
        label = synonyms.labels[s]
        if label not in found[r] and (not whole_words or _bordered(texts[r], e - len(synonyms.words[s]), e)):
            found[r].add(label)
    return [sorted(f) for f in found]


def _bordered(text: str, begin: int, end: int) -> bool:
    def border(at: int) -> bool:
        before = at > 0 and is_word_char(text[at - 1])
        return before != (at < len(text) and is_word_char(text[at]))

    return border(begin) and border(end)


def label_texts(df: DataFrame, key: str, text: str, labels: Mapping[str, Iterable[str]], out: str = "labels", whole_words: bool = True) -> DataFrame:
    """``key`` and ``out``, the sorted labels which have a synonym in ``text``; none for NULL. Only these two columns cross to Python."""
    given = {label: list(words) for label, words in labels.items()}
    schema = T.StructType([df.schema[key], T.StructField(out, T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        synonyms = None
        for batch in batches:
            synonyms = synonyms or Synonyms(given)
            for a in range(0, len(batch), 1024):
                part = batch.iloc[a : a + 1024]
                texts = ["" if t is None else t for t in part[text].tolist()]
                yield pd.DataFrame({key: part[key], out: labels_of(texts, synonyms, whole_words)})

    return df.select(key, text).mapInPandas(run, schema)
