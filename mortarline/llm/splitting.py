"""Splitting oversized items at natural boundaries (problem 5).

Cut positions are chosen by dynamic programming over the text's boundaries: the
sum of a penalty for the kind of each cut and of the squared deviation from an
even size is smallest among all ways to keep every piece, with its overlap,
under the limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortarline.llm.sentences import sentence_spans

LIMIT = 2000
OVERLAP = 200
KINDS = ("paragraph", "sentence", "word", "none")
#: Penalty of a cut at the end of a paragraph, sentence, word, or within a word.
PENALTIES = (0.0, 1.0, 4.0, 16.0)

_BLANK = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")
_WORD = re.compile(r"\S+")
_SPACE = re.compile(r"\s")


def _paragraphs(text: str) -> list[tuple[int, int]]:
    edges = [0, *(x for m in _BLANK.finditer(text) for x in m.span()), len(text)]
    return [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if text[a:b].strip()]


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    part = text[a:b]
    return a + len(part) - len(part.lstrip()), a + len(part.rstrip())


def _stretches(text: str, limit: int) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Per kind of break, coarsest first, the stretches between neighbouring breaks, white space at their edges aside."""
    yield KINDS[0], [_trimmed(text, a, b) for a, b in _paragraphs(text)]
    yield KINDS[1], sentence_spans(text)
    yield KINDS[2], [m.span() for m in _WORD.finditer(text)]


def _cheapest(ends: list[int], starts: list[int], penalties: list[float], limit: int, even: float, room: int) -> list[int] | None:
    """The cheapest choice of ends by dynamic programming: their indexes in order, None if no choice keeps the limit.

    A piece goes from the start that belongs to the end before it (the first one
    from the beginning) to its own end, and the last end is always chosen.
    """
    pos, start, penalty = np.array(ends), np.array(starts), np.array(penalties)
    cost, back = np.full(len(pos), np.inf), np.full(len(pos), -1)
    first = 0
    for j, p in enumerate(ends):
        if p <= limit:
            cost[j] = ((p - even) / room) ** 2
        while first < j and p - starts[first] > limit:
            first += 1
        if first < j:
            # starts grow with their ends, so the pieces that fit begin after the ends from ``first`` on
            c = cost[first:j] + penalty[first:j] + ((p - pos[first:j] - even) / room) ** 2
            c[p - start[first:j] > limit] = np.inf
            i = int(c.argmin())
            if c[i] < cost[j]:
                cost[j], back[j] = c[i], first + i
    if not len(pos) or not np.isfinite(cost[-1]):
        return None
    chosen, j = [], len(ends) - 1
    while j >= 0:
        chosen.append(j)
        j = int(back[j])
    return chosen[::-1]


def _reaches(ends: list[int], starts: list[int], limit: int) -> bool:
    """Whether the last end can be reached by pieces within the limit: the dynamic programme without costs.

    Of the ends that can be reached the last start before the limit serves the next one best.
    """
    start = 0
    for j, p in enumerate(ends):
        if p - start > limit:
            return False
        start = starts[j]
    return True


def boundary_kind(text: str, limit: int = LIMIT) -> tuple[str, list[tuple[int, int]]]:
    """The coarsest kind of break at which pieces within the limit can be cut, and each cut position with its kind's rank.

    White space at the edges of a stretch does not count towards its length.
    Breaks of a finer kind are added only within stretches that are too long.
    """
    cuts: dict[int, int] = {}
    long: list[tuple[int, int]] | None = None
    for rank, (kind, spans) in enumerate(_stretches(text, limit)):
        for _, e in spans:
            if e not in cuts and (rank < 2 or any(s < e < t for s, t in long or ())):
                cuts[e] = rank
        # pieces without overlap from stretch to stretch: there is a way if no stretch is too long by itself
        lead = spans[0][0] if spans else 0
        if _reaches([e - lead for _, e in spans], [s - lead for s, _ in spans[1:]] + [len(text)], limit):
            return kind, list(cuts.items())
        long = [(s, e) for s, e in spans if e - s > limit]
    return KINDS[3], list(cuts.items())


def _overlap_start(text: str, cut: int, overlap: int, floor: int) -> int:
    """Where a piece starts that repeats the end of the one before: at a word if there is one."""
    at = max(cut - overlap, floor)
    if at >= cut or at <= 0:
        return max(min(at, cut), 0)
    if not (text[at - 1].isspace() or text[at].isspace()):
        found = _SPACE.search(text, at, cut)
        if not found:
            return at
        at = found.start()
    while at < cut and text[at].isspace():
        at += 1
    return at


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> tuple[str, list[tuple[int, int]]]:
    """The boundary kind and the (start, end) of the pieces of a text, which cover it in order.

    Every piece but the first starts with the last ``overlap`` characters of the
    one before, or fewer to start at a word.  A text within the limit is one piece.
    """
    n = len(text)
    kind, cuts = boundary_kind(text, limit)
    if n <= limit:
        return kind, [(0, n)]
    room = limit - overlap
    ranks = {p: r for p, r in sorted(cuts, reverse=True) if 0 < p < n}
    ranks[n] = 0
    # a stretch without any boundary is cut by size; finer boundaries help where the overlap leaves too little room
    at = 0
    for p in sorted(ranks):
        if p - at > room:
            inner = [at + m.end() for m in _WORD.finditer(text[at:p])]
            for q in inner:
                ranks.setdefault(q, 2)
            edge = at
            for q in [*inner, p]:
                while q - edge > room:
                    edge += room
                    ranks.setdefault(edge, 3)
                edge = q
        at = p
    positions = sorted(ranks)
    starts = [_overlap_start(text, p, overlap, 0) for p in positions]
    even = n / max(1, -(-(n - overlap) // room))
    chosen = _cheapest(positions, starts, [PENALTIES[ranks[p]] for p in positions], limit, even, room)
    assert chosen is not None  # no two positions are further apart than a piece has room for
    return kind, [(starts[i] if i >= 0 else 0, positions[j]) for i, j in zip([-1, *chosen], chosen, strict=False)]


def split_oversized(items: DataFrame, key: str = "chunk_id", text: str = "chunk_text", limit: int = LIMIT, overlap: int = OVERLAP, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pieces of the items longer than ``limit``: key, boundary, n_chars, piece_no, n_pieces, start_pos, end_pos, piece and the item's columns ``keep``.

    piece_no counts from 1; positions are code points, end exclusive.  Items
    within the limit, null ones included, are not among them.  Rows that repeat a
    key are each cut.
    """
    kept = {c: items.schema[c].dataType.simpleString() for c in keep}

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k", "boundary", "n_chars", "piece_no", "n_pieces", "start_pos", "end_pos", "piece", *(f"keep_{i}" for i in range(len(kept)))]
        for batch in batches:
            rows: list[tuple] = []
            index: list[int] = []
            for i, t in enumerate(batch.column(1).to_pylist()):
                b, pieces = split_text(t, limit, overlap)
                rows += [(b, len(t), no, len(pieces), s, e, t[s:e]) for no, (s, e) in enumerate(pieces, 1)]
                index += [i] * len(pieces)
            types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            at = pa.array(index, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *(pa.array(c, ty) for c, ty in zip(columns, types, strict=True)), *(batch.column(2 + i).take(at) for i in range(len(kept)))], names)

    long = items.where(F.length(text) > limit).select(key, text, *keep)
    more = "".join(f", `{c}` {t}" for c, t in kept.items())
    return long.mapInArrow(split, f"`{key}` {items.schema[key].dataType.simpleString()}, boundary string, n_chars bigint, piece_no int, n_pieces int, start_pos bigint, end_pos bigint, piece string{more}")


def split_items(items: DataFrame, key: str = "chunk_id", text: str = "chunk_text", keep: tuple[str, ...] = ("doc_id", "section_guess"), limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """All items in pieces within the limit, with the columns ``keep`` of their item.

    An item within the limit is one piece and never leaves the JVM; a null text
    gives one piece that is null.
    """
    whole = items.where(F.coalesce(F.length(text), F.lit(0)) <= limit).select(key, *keep, F.lit(1).alias("piece_no"), F.lit(1).alias("n_pieces"), F.lit(0).cast("bigint").alias("start_pos"), F.length(text).cast("bigint").alias("end_pos"), F.col(text).alias("piece"))
    return whole.unionByName(split_oversized(items, key, text, limit, overlap, keep).drop("boundary", "n_chars"))
