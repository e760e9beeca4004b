"""Mapping free-entered values to a canonical list (problem 4).

The reference entries of a type, their aliases and the shortened forms of both
are paths of a trie.  A value becomes a Levenshtein automaton (adjacent
transpositions count as one edit) that walks the trie: a state holds, per number
of edits, the set of the value's positions reached, steps between states are kept
once they are made, and a branch is left as soon as no state of it is alive
within the distance that the longest name below allows.  All entries within the
distance of their length come out, the closest first.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of names that go to the tasks at once as a trie; a longer list is worked off block by block in the same scan.
BLOCK_BYTES = 4 << 20
#: A shortened word keeps at least so many characters of a word of at least LONG_WORD.
SHORTENED, LONG_WORD = 4, 7

# Letters of other scripts that look like Latin ones, and those.
LOOKALIKES = str.maketrans("аеорсхукмтнвіѕјԁһԛԝɡıαονρτκιυ", "aeopcxykmthbisjdhqwgiaovptkiu")
# What stands for no name.
PLACEHOLDERS = {"unknown", "various", "tbd", "tba", "see above", "none", "n a", "na", "null", "misc", "other", "not available", "xxx"}
_ADDITION = re.compile(r"(?:[\s,;:–—(\[#-]*(?:\b(?:lot|no|nr|number|sample|batch|ref|id|type|test|series)\b)?[\s.:#-]*\d+[a-z]?\s*[)\]]*)+$")
_BRACKETED = re.compile(r"[(\[][^)\]]*[)\]]")


def _plain(value: str) -> str:
    s = unicodedata.normalize("NFKC", value).casefold().translate(LOOKALIKES)
    return "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c)).casefold()


def _squeeze(value: str) -> str:
    return " ".join(re.findall(r"[^\W_]+", value))


def allowed_distance(length: int) -> int:
    """Edits that a name of so many characters may hold."""
    return 1 if length <= 5 else 2 if length <= 12 else 3


def writings(value: str) -> list[str]:
    """The forms in which a value is looked up: without its additions, and in the order a comma hides."""
    s = _plain(value).strip(" \t\r\n\"'`“”„’‘.,;:*_")
    forms = []
    for x in dict.fromkeys((s, _ADDITION.sub("", s), _BRACKETED.sub(" ", s))):
        forms.append(_squeeze(x))
        if "," in x:
            head, _, rest = x.partition(",")
            forms.append(_squeeze(f"{rest} {head}"))
    first = forms[0].split()
    if 1 < len(first) <= 5 and "," not in s:
        last = forms[-1].split()
        forms += [" ".join(last[i:] + last[:i]) for i in range(1, len(last))]
    return [f for f in dict.fromkeys(forms) if f and f not in PLACEHOLDERS]


class Trie:
    """Reference names, aliases and shortened forms as paths that end in entry numbers.

    Nodes are numbers from 0, the root: so a trie of any depth can be sent to the tasks.
    """

    def __init__(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.entries: list[list[tuple[int, int]]] = [[]]  # (entry, slack: edits this path may not use)
        self.longest: list[int] = [0]  # the longest name below

    def add(self, name: str, entry: int) -> None:
        plain = _plain(name)
        self._path(_squeeze(plain), entry, 0)
        words = plain.split()
        for i, w in enumerate(words):
            if len(w) >= LONG_WORD:
                for n in range(SHORTENED, len(w) - 1):
                    self._path(_squeeze(" ".join([*words[:i], w[:n], *words[i + 1 :]])), entry, 1)

    def _path(self, text: str, entry: int, slack: int) -> None:
        node = 0
        for c in text:
            self.longest[node] = max(self.longest[node], len(text))
            child = self.children[node].get(c)
            if child is None:
                child = self.children[node][c] = len(self.children)
                self.children.append({})
                self.entries.append([])
                self.longest.append(0)
            node = child
        self.longest[node] = max(self.longest[node], len(text))
        if text and (entry, slack) not in self.entries[node]:
            self.entries[node].append((entry, slack))

    def search(self, query: str) -> dict[int, int]:
        """All entries within the distance their length allows, with their smallest distance (a shortened form counts one)."""
        found: dict[int, int] = {}
        automaton = Automaton(query, allowed_distance(self.longest[0]))
        stack = [(0, 0, 0)]
        while stack:
            node, depth, state = stack.pop()
            if self.entries[node]:
                edits = automaton.edits(state)
                if edits is not None:
                    for entry, slack in self.entries[node]:
                        if edits + slack <= allowed_distance(depth) and edits + slack < found.get(entry, 99):
                            found[entry] = edits + slack
            for c, child in self.children[node].items():
                after = automaton.step(state, c)
                if after >= 0 and automaton.least[after] <= allowed_distance(self.longest[child]):
                    stack.append((child, depth + 1, after))
        return found


class Automaton:
    """The Levenshtein automaton of one text for up to ``most`` edits, made state by state as it is walked."""

    def __init__(self, text: str, most: int) -> None:
        self.most, self.end, self.whole = most, 1 << len(text), (1 << (len(text) + 1)) - 1
        #: Bit i + 1 is set where the text has the character at i.
        self.places: dict[str, int] = {}
        for i, c in enumerate(text):
            self.places[c] = self.places.get(c, 0) | 1 << (i + 1)
        # a state: per number of edits the positions reached, those before the last character, and that character
        start = tuple(((1 << (j + 1)) - 1) & self.whole for j in range(most + 1))
        self.states: list[tuple[tuple[int, ...], tuple[int, ...], str]] = [(start, (0,) * (most + 1), "")]
        self.numbers = {self.states[0]: 0}
        #: The fewest edits with which a state is alive.
        self.least = [0]
        self.steps: dict[tuple[int, str], int] = {}

    def step(self, state: int, c: str) -> int:
        """The state after one more character of a name, -1 if none is alive."""
        known = self.steps.get((state, c))
        if known is not None:
            return known
        now, before, last = self.states[state]
        here, then = self.places.get(c, 0), self.places.get(last, 0)
        out: list[int] = []
        for j in range(self.most + 1):
            reached = now[j] << 1 & here
            if j:
                # the name's character is one too many, another one, or the text has one too many; or two changed places
                reached |= now[j - 1] | now[j - 1] << 1 | out[j - 1] << 1 | before[j - 1] << 2 & here << 1 & then
            out.append(reached & self.whole)
        alive = next((j for j, x in enumerate(out) if x), -1)
        after = -1
        if alive >= 0:
            key = (tuple(out), now, c)
            after = self.numbers.get(key, -1)
            if after < 0:
                after = self.numbers[key] = len(self.states)
                self.states.append(key)
                self.least.append(alive)
        self.steps[state, c] = after
        return after

    def edits(self, state: int) -> int | None:
        """The edits between the text and the characters walked, None if they are too many."""
        return next((j for j, x in enumerate(self.states[state][0]) if x & self.end), None)


def matches(value: str, trie: Trie) -> list[tuple[int, int]]:
    """(entry, distance) of all entries that any writing of the value is near, closest first.

    Of equally close ones those of the plainer writing come first, then the
    smaller entries.
    """
    found: dict[int, tuple[int, int]] = {}
    for k, form in enumerate(writings(value)):
        for f in (form, form[:-1]) if form.endswith("s") and len(form) > 4 else (form,):
            for entry, d in trie.search(f).items():
                if entry not in found or (d, k) < found[entry]:
                    found[entry] = d, k
    return [(entry, d) for entry, (d, k) in sorted(found.items(), key=lambda x: (x[1], x[0]))]


def _tries(rows: list[tuple]) -> dict[str, Trie]:
    """A trie per kind of (entry, kind, canonical, aliases) rows."""
    tries: dict[str, Trie] = {}
    for entry, kind, canonical, aliases in rows:
        trie = tries.setdefault(kind, Trie())
        for name in dict.fromkeys([canonical, *(aliases or [])]):
            if name:
                trie.add(name, entry)
    return tries


def map_values(values: DataFrame, reference: DataFrame, key: str = "entity_id", kind: str = "entity_type", value: str = "entity_name", entry: str = "canonical_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, kind, value, canonical_id, distance, matches): the reference rows of the same kind that a value is near.

    ``matches`` has all of them with their distance, closest first; canonical_id
    and distance are those of the first.  canonical_id is 0, distance null and
    matches empty if no row is within reach (placeholders, null and blank values,
    and values of a kind that the reference does not hold, among them).  Rows that
    repeat a key are each mapped.
    """
    rows = reference.where(F.col(entry).isNotNull() & F.col(kind).isNotNull()).select(entry, kind, "canonical", "aliases")
    names = F.coalesce(F.length("canonical"), F.lit(0)) + F.coalesce(F.length(F.array_join("aliases", "")), F.lit(0))
    blocks = max(1, -(-rows.agg(F.coalesce(F.sum(names), F.lit(0))).first()[0] // block_bytes))
    sc = values.sparkSession.sparkContext
    key_type = values.schema[key].dataType.simpleString()
    mapped = values.select(key, kind, value, F.array().cast(_MATCHES).alias("matches"))
    for k in range(blocks):
        block = rows.where(F.pmod(F.xxhash64(entry), F.lit(blocks)) == k).collect()
        mapped = mapped.mapInArrow(_mapper(sc.broadcast(_tries([tuple(r) for r in block]))), f"`{key}` {key_type}, `{kind}` string, `{value}` string, matches {_MATCHES}")
    best = F.get("matches", F.lit(0))
    return mapped.select(key, kind, value, F.coalesce(best["canonical_id"], F.lit(0)).cast("bigint").alias("canonical_id"), best["distance"].alias("distance"), "matches")


_MATCHES = "array<struct<canonical_id:bigint,distance:int>>"


def _mapper(sent):  # noqa: ANN001, ANN202
    """Add the matches of one block of the reference to those there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[str, Trie] = sent.value
        known: dict[tuple[str, str], list[tuple[int, int]]] = {}
        for batch in batches:
            out = []
            for t, v, earlier in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                m = []
                if v is not None and t in tries:
                    m = known.get((t, v))
                    if m is None:
                        if len(known) > 200_000:
                            known.clear()
                        m = known[t, v] = matches(v, tries[t])
                both = [(x["canonical_id"], x["distance"]) for x in earlier or ()] + m
                out.append([{"canonical_id": e, "distance": d} for e, d in (sorted(both, key=lambda x: x[1]) if earlier else both)])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(out, pa.list_(pa.struct([("canonical_id", pa.int64()), ("distance", pa.int32())])))], ["k", "t", "v", "matches"])

    return run
