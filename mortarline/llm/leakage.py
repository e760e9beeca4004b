"""Evaluation texts leaking into training text (problem 8).

Windows of two kinds are fingerprinted, for items and documents alike: windows
as long as the smallest leak that counts (13 words, 20 characters in scripts
without spaces), and windows about as long as the item, for leaks of whole items
that were edited.  A window's SimHash is taken over its weighted shingles of five
words; its 64 bits are cut into BLOCKS blocks, and two fingerprints within the
guaranteed radius lie within NEAR (or 0) bits of each other in one block at least.
Candidates within the radius are verified by the exact weighted similarity of
their shingles.  Stretches of a document without any shingle of the items hold no
similar window and are not fingerprinted.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
WORDS = 13
CHARACTERS = 20
BLOCKS = 4
#: Bits by which a block of an item-sized window may differ: all within 4 * (2 + 1) - 1 = 11 bits are found.
NEAR = 2
SIMILARITY = 0.8
#: Item-sized windows come in lengths that grow by this factor; an item has windows at both of its ends.
GROWTH = 1.25
#: Bytes of the index that goes to the tasks; a larger item table is worked off in several passes over the documents.
INDEX_BYTES = 256 << 20
_BYTES_A_CHARACTER = 32

_WORD = re.compile(r"[^\W_]+")
_UNSPACED = re.compile("[㐀-䶿一-鿿豈-﫿぀-ヿ฀-๿]")
#: Languages whose items are cut into characters, as their words are not parted by spaces.
CHARACTER_LANGUAGES = ("zh", "ja", "th")
_BITS_A_BLOCK = 64 // BLOCKS


def words(text: str) -> list[str]:
    return _WORD.findall(unicodedata.normalize("NFKC", text).casefold())


def characters(text: str) -> list[str]:
    return list("".join(words(text)))


_hashes: dict[str, int] = {}


def _unit_hashes(units: list[str]) -> np.ndarray:
    if len(_hashes) > 500_000:
        _hashes.clear()
    out = np.empty(len(units), np.uint64)
    for i, u in enumerate(units):
        h = _hashes.get(u)
        if h is None:
            h = _hashes[u] = xxhash.xxh3_64_intdigest(u)
        out[i] = h
    return out


def shingle_hashes(units: list[str], k: int = SHINGLE) -> np.ndarray:
    """One mixed hash for each run of ``k`` units."""
    h = _unit_hashes(units)
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return out


def window_simhashes(shingles: np.ndarray, lengths: Sequence[int]) -> dict[int, np.ndarray]:
    """SimHash of every window of so many consecutive shingles, by running sums of their bits that all lengths share."""
    out = {m: np.empty(max(0, len(shingles) - m + 1), np.uint64) for m in lengths}
    most = max(lengths, default=0)
    step = max(16_384, 2 * most)
    for a in range(0, len(shingles), step):
        part = shingles[a : a + step + most - 1]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
        sums = np.zeros((len(part) + 1, 64), np.int32)
        np.cumsum(bits, axis=0, out=sums[1:])
        for m, prints in out.items():
            b = min(len(prints), a + step)
            if b > a:
                ones = sums[m : m + b - a] - sums[: b - a]
                prints[a:b] = np.packbits(2 * ones > m, axis=1, bitorder="little").view(np.uint64).reshape(-1)
    return out


def _masks(near: int) -> np.ndarray:
    """All ways to change up to ``near`` bits of a block."""
    return np.array([sum(1 << i for i in bits) for n in range(near + 1) for bits in combinations(range(_BITS_A_BLOCK), n)], np.int64)


def _block(prints: np.ndarray, b: int) -> np.ndarray:
    return ((prints >> np.uint64(b * _BITS_A_BLOCK)) & np.uint64((1 << _BITS_A_BLOCK) - 1)).astype(np.int64)


@dataclass
class WindowIndex:
    """Fingerprints of the items' windows of one length, in BLOCKS tables by block value."""

    size: int  # units of a window
    shingle: int
    radius: int
    prints: np.ndarray
    items: np.ndarray  # position of the window's item among all items
    at: np.ndarray  # position of the window in its item
    starts: list[np.ndarray]
    order: list[np.ndarray]

    @staticmethod
    def build(windows: list[tuple[int, int, int]], size: int, shingle: int, near: int) -> WindowIndex:
        """``windows``: (fingerprint, item, position in the item)."""
        prints = np.array([w[0] for w in windows], np.uint64)
        masks, starts, order = _masks(near), [], []
        for b in range(BLOCKS):
            v = (_block(prints, b)[:, None] ^ masks[None, :]).reshape(-1)
            o = np.argsort(v, kind="stable")
            order.append((o // len(masks)).astype(np.int32))
            starts.append(np.searchsorted(v[o], np.arange((1 << _BITS_A_BLOCK) + 1)).astype(np.int32))
        return WindowIndex(size, shingle, BLOCKS * (near + 1) - 1, prints, np.array([w[1] for w in windows], np.int64), np.array([w[2] for w in windows], np.int64), starts, order)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window of prints, window of the items) for all pairs within the radius."""
        left, right = [], []
        for b in range(BLOCKS):
            v = _block(prints, b)
            lo, n = self.starts[b][v], self.starts[b][v + 1] - self.starts[b][v]
            hit = np.flatnonzero(n)
            if not len(hit):
                continue
            n = n[hit]
            l = np.repeat(hit, n)  # noqa: E741
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            r = self.order[b][np.repeat(lo[hit], n) + offset]
            close = np.bitwise_count(prints[l] ^ self.prints[r]) <= self.radius
            left.append(l[close])
            right.append(r[close])
        if not left:
            return np.empty(0, int), np.empty(0, int)
        pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], 1), axis=0)
        return pairs[:, 0], pairs[:, 1]


@dataclass
class ItemIndex:
    """The items cut into one kind of units, with an index for each length of windows."""

    units: list[list[str]]
    least: int  # units of the smallest leak that counts
    windows: list[WindowIndex]
    shingles: dict[int, np.ndarray]  # by length, all shingles of the items' windows in order

    @staticmethod
    def build(units: list[list[str]], least: int) -> ItemIndex:
        found: dict[tuple[int, int, int], list[tuple[int, int, int]]] = {}
        for i, u in enumerate(units):
            n = len(u)
            if n >= least:
                prints = window_simhashes(shingle_hashes(u), [least - SHINGLE + 1])[least - SHINGLE + 1]
                found.setdefault((least, SHINGLE, 0), []).extend((int(p), i, k) for k, p in enumerate(prints))
            size = _item_size(n, least)
            if n and size != least:
                k = min(SHINGLE, n)
                prints = window_simhashes(shingle_hashes(u, k), [size - k + 1])[size - k + 1]
                # the shorter a window, the fewer shingles vote, and the less a near fingerprint says
                near = NEAR if size > least else 0
                found.setdefault((size, k, near), []).extend((int(prints[at]), i, at) for at in {0, n - size})
        lengths = {k for _, k, _ in found}
        known = {k: np.unique(np.concatenate([shingle_hashes(u, k) for u in units])) for k in lengths}
        return ItemIndex(units, least, [WindowIndex.build(w, *key) for key, w in sorted(found.items())], known)

    def stretch(self, shingles: np.ndarray, k: int, longest: int) -> tuple[int, int]:
        """From where to where a text's windows can hold a shingle of the items: no other window is similar to any of theirs."""
        known = self.shingles[k]
        at = np.searchsorted(known, shingles)
        shared = np.flatnonzero(known[np.minimum(at, len(known) - 1)] == shingles)
        return (max(0, int(shared[0]) - longest + 1), int(shared[-1]) + longest) if len(shared) else (0, 0)


def _item_size(n: int, least: int) -> int:
    """The length of an item's windows: its own if it is shorter than the smallest leak, else a power of GROWTH below it."""
    if n <= least:
        return n
    size = least
    while int(size * GROWTH) <= n:
        size = int(size * GROWTH)
    return size


def weighted_similarity(a: list[str], b: list[str]) -> float:
    """Weighted Jaccard similarity of two texts' shingles, each weighing as often as it stands there."""
    k = min(SHINGLE, len(a), len(b)) or 1
    x, y = (Counter(tuple(u[i : i + k]) for i in range(len(u) - k + 1)) for u in (a, b))
    either = sum((x | y).values())
    return sum((x & y).values()) / either if either else 0.0


def leaks_in(units: list[str], index: ItemIndex) -> dict[int, tuple[int, float, bool]]:
    """For each leaked item's position: verified windows, highest similarity, whether ``least`` units are the same one by one."""
    out: dict[int, tuple[int, float, bool]] = {}
    for k in {w.shingle for w in index.windows}:
        lengths = [w.size - k + 1 for w in index.windows if w.shingle == k]
        shingles = shingle_hashes(units, k)
        begin, end = index.stretch(shingles, k, max(lengths))
        prints = window_simhashes(shingles[begin:end], sorted(set(lengths)))
        for w in (w for w in index.windows if w.shingle == k):
            mine = prints[w.size - k + 1]
            if not len(mine):
                continue
            for at, hit in zip(*w.near(mine), strict=True):
                i, p = int(w.items[hit]), int(w.at[hit])
                x, y = units[begin + at : begin + at + w.size], index.units[i][p : p + w.size]
                exact = x == y
                similarity = 1.0 if exact else weighted_similarity(x, y)
                if similarity >= SIMILARITY:
                    n, s, e = out.get(i, (0, 0.0, False))
                    out[i] = (n + 1, max(s, similarity), e or exact and w.size >= index.least)
    return out


def by_characters(lang: str | None, text: str) -> bool:
    """Whether an item is cut into characters: by its language, or most of its letters are of a script without spaces."""
    return lang in CHARACTER_LANGUAGES or 2 * len(_UNSPACED.findall(text)) > len("".join(words(text))) > 0


def find_leaks(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", lang: str = "lang", index_bytes: int = INDEX_BYTES) -> DataFrame:
    """(doc_key, item_key, n_windows, similarity, verbatim): documents with passages of items.

    n_windows: pairs of windows of at least SIMILARITY; verbatim: the same 13
    words (for items in scripts without spaces 20 characters) stand in both,
    letter case, punctuation and white space aside.  An item shorter than that is
    found as a whole, and is not verbatim.  Null and empty texts have no passage.
    Rows that repeat a document key are reported once per row.
    """
    rows = items.where(F.col(item_key).isNotNull() & (F.length(text) > 0))
    size = rows.agg(F.coalesce(F.sum(F.length(text)), F.lit(0))).first()[0] * _BYTES_A_CHARACTER
    passes = max(1, -(-size // index_bytes))
    kinds = docs.schema[doc_key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    found = None
    for k in range(passes):
        block = rows.where(F.pmod(F.xxhash64(item_key), F.lit(passes)) == k).select(item_key, lang, text).collect()
        apart = [r for r in block if not by_characters(r[1], r[2])], [r for r in block if by_characters(r[1], r[2])]
        index = ItemIndex.build([words(r[2]) for r in apart[0]], WORDS), ItemIndex.build([characters(r[2]) for r in apart[1]], CHARACTERS)
        sent = docs.sparkSession.sparkContext.broadcast(([r[0] for part in apart for r in part], *index))
        part = docs.select(doc_key, text).mapInArrow(_finder(sent), f"`{doc_key}` {kinds[0]}, `{item_key}` {kinds[1]}, n_windows int, similarity double, verbatim boolean")
        found = part if found is None else found.unionByName(part)
    return found


def _finder(sent):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, by_word, by_character = sent.value
        ids = pa.array(item_ids) if item_ids else pa.array([], pa.int64())
        for batch in batches:
            row, item, n, similarity, verbatim = [], [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                if not t:
                    continue
                units = words(t)
                hits = list(leaks_in(units, by_word).items()) if by_word.windows else []
                if by_character.windows and _UNSPACED.search(t):
                    hits += [(j + len(by_word.units), h) for j, h in leaks_in(list("".join(units)), by_character).items()]
                for j, (a, b, c) in hits:
                    row.append(i)
                    item.append(j)
                    n.append(a)
                    similarity.append(b)
                    verbatim.append(c)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), ids.take(pa.array(item, pa.int64())), pa.array(n, pa.int32()), pa.array(similarity, pa.float64()), pa.array(verbatim, pa.bool_())], ["d", "i", "n_windows", "similarity", "verbatim"])

    return run
