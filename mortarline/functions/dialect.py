"""Rule tables as SQL text.

A rule table (phrases, weights, buckets) becomes one SQL expression.  The Spark
dialect is what the engine runs through ``F.expr``, inside whole-stage code; the
DuckDB dialect serves to check it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass


def _escaped(phrase: str) -> str:
    return re.sub(r"([\\.^$*+?{}\[\]|()])", r"\\\1", phrase)


def _shortest(phrases: Sequence[str]) -> list[str]:
    """The phrases without those that hold another one of them: a text with such a one has the other as well."""
    distinct = list(dict.fromkeys(phrases))
    return [p for p in distinct if not any(q != p and q in p for q in distinct)]


@dataclass(frozen=True)
class Dialect:
    """SQL text for one engine."""

    name: str

    @property
    def spark(self) -> bool:
        return self.name == "spark"

    def text(self, s: str) -> str:
        """A string literal."""
        if self.spark:
            s = s.replace("\\", "\\\\")
            return "'" + s.replace("'", "\\'") + "'"
        return "'" + s.replace("'", "''") + "'"

    def matches(self, s: str, pattern: str) -> str:
        return f"({s} RLIKE {self.text(pattern)})" if self.spark else f"regexp_matches({s}, {self.text(pattern)})"

    def word(self, s: str, phrases: Iterable[str]) -> str:
        """Whether any phrase stands in the text between word boundaries.

        In Spark plain searches go before the pattern: most sentences have none of
        the phrases, and a search for a few bytes costs a tenth of the pattern.
        """
        phrases = list(phrases)
        found = self.matches(s, r"\b(?:" + "|".join(map(_escaped, phrases)) + r")\b")
        return f"({self.has(s, _shortest(phrases))} AND {found})" if self.spark else found

    def one_word(self, s: str, phrase: str) -> str:
        """As word, for one phrase."""
        return self.word(s, [phrase]) if self.spark else f"(contains({s}, {self.text(phrase)}) AND {self.word(s, [phrase])})"

    def has(self, s: str, phrases: Iterable[str]) -> str:
        """Whether any phrase is part of the text."""
        parts = [f"contains({s}, {self.text(p)})" for p in phrases]
        return "(" + " OR ".join(parts) + ")" if parts else "false"

    def first(self, rules: Sequence[tuple[str, str]], default: str) -> str:
        """The label of the first condition that holds."""
        return "CASE " + " ".join(f"WHEN {c} THEN {self.text(v)}" for c, v in rules) + f" ELSE {self.text(default)} END"

    def points(self, rules: Iterable[tuple[str, float | int]]) -> str:
        """The sum of the points of all conditions that hold."""
        return "(" + (" + ".join(f"CASE WHEN {c} THEN {p} ELSE 0 END" for c, p in rules) or "0") + ")"

    def array(self, items: Iterable[str]) -> str:
        return f"array({', '.join(items)})" if self.spark else f"[{', '.join(items)}]"

    def compact(self, items: Iterable[str]) -> str:
        """An array of the values that are not null."""
        a = self.array(items)
        return f"array_compact({a})" if self.spark else f"list_filter({a}, lambda x: x IS NOT NULL)"

    def hits(self, s: str, vocabulary: Iterable[str]) -> str:
        """The words of a vocabulary that the text has, in the vocabulary's order."""
        return self.compact(f"CASE WHEN {self.one_word(s, v)} THEN {self.text(v)} END" for v in vocabulary)

    def top(self, array: str, n: int) -> str:
        return f"slice({array}, 1, {n})" if self.spark else f"({array})[1:{n}]"

    def prefixed(self, array: str, prefix: str) -> str:
        lead = self.text(prefix)
        return f"transform({array}, x -> concat({lead}, x))" if self.spark else f"list_transform({array}, lambda x: {lead} || x)"

    def joined(self, array: str, sep: str) -> str:
        return f"array_join({array}, {self.text(sep)})" if self.spark else f"coalesce(array_to_string({array}, {self.text(sep)}), '')"

    def length(self, array: str) -> str:
        return f"size({array})" if self.spark else f"len({array})"

    def concat_arrays(self, arrays: Sequence[str]) -> str:
        return f"concat({', '.join(arrays)})" if self.spark else "(" + " || ".join(arrays) + ")"

    def at(self, values: Sequence[str], index: str) -> str:
        """The value at a 0-based index."""
        return f"element_at({self.array(map(self.text, values))}, cast({index} as int) + 1)" if self.spark else f"{self.array(map(self.text, values))}[({index})::BIGINT + 1]"

    def extract(self, s: str, pattern: str, group: int) -> str:
        """A group of the first match, '' without a match."""
        return f"regexp_extract({s}, {self.text(pattern)}, {group})"

    def extract_all(self, s: str, pattern: str) -> str:
        return f"regexp_extract_all({s}, {self.text(pattern)}, 0)"

    def replace_all(self, s: str, pattern: str, by: str) -> str:
        return f"regexp_replace({s}, {self.text(pattern)}, {self.text(by)})" if self.spark else f"regexp_replace({s}, {self.text(pattern)}, {self.text(by)}, 'g')"

    def truncated(self, x: str) -> str:
        return f"cast({x} as int)" if self.spark else f"cast(trunc({x}) as int)"

    def string(self, x: str) -> str:
        return f"cast({x} as string)" if self.spark else f"cast({x} as varchar)"

    def weights(self, key: str, table: Mapping[str, float], default: float) -> str:
        """A number looked up by key."""
        rows = " ".join(f"WHEN {self.text(k)} THEN {float(v)}D" if self.spark else f"WHEN {self.text(k)} THEN {float(v)}::DOUBLE" for k, v in table.items())
        tail = f"{float(default)}D" if self.spark else f"{float(default)}::DOUBLE"
        return f"CASE {key} {rows} ELSE {tail} END" if rows else tail


SPARK = Dialect("spark")
DUCKDB = Dialect("duckdb")
