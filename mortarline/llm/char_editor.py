"""An averaged-perceptron editor for the characters of scanned text.

For every character of a word it predicts to keep it, to delete it, to replace
it, or to insert something after it; for a mark at the end of a line it predicts
whether the line's last word is joined to the next line and the mark dropped.
It is trained on a bounded list of the corpus's own words, to which the misreadings
of scanners are applied; what is a word is judged by all of the corpus's words.
"""

from __future__ import annotations

import random
import re
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Container, Iterable, Sequence

import numpy as np
import xxhash

#: The most frequent words of the corpus that an editor is trained on, and their longest form.
MAX_WORDS = 5000
MAX_LETTERS = 32
EPOCHS = 2
#: Characters to both sides that features reach.
SIGHT = 3
#: By how much the right operation must lead for an example not to be looked at again.
CLEAR = 4.0

# What is printed and what a scanner makes of it.
MISREADINGS = [
    ("m", "rn"), ("n", "ri"), ("ri", "n"), ("u", "ii"), ("w", "vv"), ("cl", "d"), ("li", "h"), ("d", "cl"), ("h", "li"), ("rn", "m"),
    ("l", "1"), ("i", "l"), ("l", "i"), ("i", "1"), ("s", "5"), ("g", "9"), ("b", "6"), ("o", "0"), ("e", "c"), ("c", "e"),
    ("t", "f"), ("f", "t"), ("h", "b"), ("z", "2"), ("a", "4"), ("q", "9"), ("B", "8"), ("S", "5"), ("O", "0"), ("I", "l"), ("l", "I"),
]
_UNDO = sorted({(a.lower(), b.lower()) for a, b in MISREADINGS if a.lower() != b.lower()})
STRAYS = "¦|^~"
LINE_MARKS = "-¬\xad‐‑"
KEEP = "="


def _features(w: str, i: int) -> list[str]:
    p = f"^^^{w}$$$"
    j = i + 3
    return [
        "c" + p[j],
        "l1" + p[j - 1 : j + 1],
        "r1" + p[j : j + 2],
        "m1" + p[j - 1 : j + 2],
        "l2" + p[j - 2 : j + 1],
        "r2" + p[j : j + 3],
        "m2" + p[j - 2 : j + 3],
        "l3" + p[j - 3 : j + 1],
        "r3" + p[j : j + 4],
        "m3" + p[j - 3 : j + 4],
    ]


class Perceptron:
    """Averaged multi-class perceptron over string features."""

    def __init__(self) -> None:
        self.weights: dict[str, dict[str, float]] = {}
        #: For each weight, the sum of its changes times the steps before them; the mean over all steps follows from it.
        self._late: dict[tuple[str, str], float] = defaultdict(float)
        self._now = 0

    def scores(self, features: Iterable[str]) -> dict[str, float]:
        out: dict[str, float] = {}
        known = self.weights
        for f in features:
            if f in known:
                for op, x in known[f].items():
                    if op in out:
                        out[op] += x
                    else:
                        out[op] = x
        return out

    def predict(self, features: Iterable[str], default: str = KEEP) -> str:
        scores = self.scores(features)
        best, top = default, scores.get(default, 0.0)
        for op, x in scores.items():
            if x > top or x == top and best != default and op < best:
                best, top = op, x
        return best

    def learn(self, features: list[str], truth: str, default: str = KEEP) -> bool:
        """Take in an example; whether it was told right by a clear margin."""
        self._now += 1
        scores = self.scores(features)
        guess, top, rest = default, scores.get(default, 0.0), -1e9
        for op, x in scores.items():
            if op == default:
                continue
            if x > top or x == top and guess != default and op < guess:
                guess, top, rest = op, x, top
            elif x > rest:
                rest = x
        if guess == truth:
            return top - max(rest, 0.0) >= CLEAR
        late, now = self._late, self._now
        for f in features:
            w = self.weights.setdefault(f, {})
            w[truth] = w.get(truth, 0.0) + 1.0
            w[guess] = w.get(guess, 0.0) - 1.0
            late[f, truth] += now
            late[f, guess] -= now
        return False

    def average(self) -> None:
        for f, w in self.weights.items():
            for op in list(w):
                w[op] -= self._late[f, op] / max(self._now, 1)
                if not w[op]:
                    del w[op]
        self._late.clear()


def misreadings(word: str) -> list[tuple[str, list[str]]]:
    """Every single misreading of a word, and the operation that undoes it at each of its characters."""
    out = []
    for a, b in MISREADINGS:
        for m in re.finditer(re.escape(a), word):
            i = m.start()
            ops = [f"R{a}", *["D"] * (len(b) - 1)]
            out.append((word[:i] + b + word[i + len(a) :], [KEEP] * i + ops + [KEEP] * (len(word) - i - len(a))))
    return out


def strayed(word: str, rng: random.Random) -> tuple[str, list[str]]:
    """A word with a stray mark in it, or in the place of a letter."""
    i = rng.randrange(len(word))
    stray = rng.choice(STRAYS)
    if rng.random() < 0.5:
        return word[:i] + stray + word[i + 1 :], [KEEP] * i + [f"R{word[i]}"] + [KEEP] * (len(word) - i - 1)
    return word[: i + 1] + stray + word[i + 1 :], [KEEP] * (i + 1) + ["D"] + [KEEP] * (len(word) - i - 1)


def _dropped(word: str, rng: random.Random) -> tuple[str, list[str]] | None:
    """A word that lost a letter, and the insertion that brings it back."""
    if len(word) < 5:
        return None
    i = rng.randrange(1, len(word))
    return word[:i] + word[i + 1 :], [KEEP] * (i - 1) + [f"I{word[i]}"] + [KEEP] * (len(word) - i - 1)


class HashedWords:
    """A list of words of any length as sorted hashes, 8 bytes a word, those that Spark's xxhash64 gives."""

    def __init__(self, hashes: Sequence[int]) -> None:
        self.hashes = array("q")
        self.hashes.frombytes(np.sort(np.asarray(hashes, np.int64)).tobytes())

    def __len__(self) -> int:
        return len(self.hashes)

    def __contains__(self, word: str) -> bool:
        h = xxhash.xxh64_intdigest(word.encode(), 42)
        h -= (h >> 63) << 64
        i = bisect_left(self.hashes, h)
        return i < len(self.hashes) and self.hashes[i] == h


class CharEditor:
    """The trained editor with the word list by which it judges: the words of its training, or more."""

    def __init__(self, lexicon: Iterable[str], seed: int = 7, known: Container[str] | None = None) -> None:
        words = [w for w in dict.fromkeys(lexicon) if 1 < len(w) <= MAX_LETTERS][:MAX_WORDS]
        self.lexicon = frozenset(words) | {x for w in words if "-" in w for x in w.split("-") if len(x) > 1}
        self.chars, self.joins = Perceptron(), Perceptron()
        rng = random.Random(seed)
        parts = [w for w in words if len(w) > 2 and "-" not in w]
        # all examples once, then only those that were not told right by a clear margin
        unclear: list[tuple[str, int, str]] = []
        rng.shuffle(parts)
        for w in parts:
            for seen in [(w, [KEEP] * len(w)), *misreadings(w), strayed(w, rng), strayed(w, rng), _dropped(w, rng)]:
                if seen is None or (seen[0] != w and seen[0] in self.lexicon):
                    continue
                # features reach SIGHT characters: further from an edit they are those of the word itself
                edits = [i for i, op in enumerate(seen[1]) if op != KEEP]
                first, last = (edits[0] - SIGHT, edits[-1] + SIGHT + 1) if edits else (0, len(seen[0]))
                unclear += [(seen[0], i, seen[1][i]) for i in range(max(first, 0), min(last, len(seen[0]))) if not self.chars.learn(_features(seen[0], i), seen[1][i])]
        for _ in range(EPOCHS - 1):
            rng.shuffle(unclear)
            unclear = [(seen, i, op) for seen, i, op in unclear if not self.chars.learn(_features(seen, i), op)]
        breaks = [(w[:i], w[i:], "J") for w in parts if len(w) > 4 for i in range(2, len(w) - 1)]
        breaks += [(w[:i], w[i + 1 :], KEEP) for w in words for i in (m.start() for m in re.finditer("-", w)) if 0 < i < len(w) - 1] * 3
        for _ in range(EPOCHS):
            rng.shuffle(breaks)
            for left, right, truth in breaks:
                self.joins.learn(self._join_features(left, right), truth)
                self.joins.learn(self._join_features(left, ""), truth)
        self.chars.average()
        self.joins.average()
        if known is not None:
            self.lexicon = known

    def _join_features(self, left: str, right: str) -> list[str]:
        last = re.split("-", left)[-1]
        first = re.split("-", right)[0]
        known = self.lexicon
        out = ["b", "L" + last, "l3" + last[-3:], f"kl{last in known}", f"n{min(len(last), 6)}"]
        if right:
            out += ["R" + first, "r3" + first[:3], f"kr{first in known}", f"kj{last + first in known}", f"kc{left + '-' + right in known or last + '-' + first in known}", f"k{last in known}{first in known}{last + first in known}"]
        return out

    def joins_lines(self, left: str, right: str) -> bool:
        """Whether the mark between two parts of a word is the line break's own. ``right`` may be empty if unknown."""
        return self.joins.predict(self._join_features(left, right)) == "J"

    def correct(self, word: str, rounds: int = 2) -> str:
        """The word after the predicted edits; a word of the list stays as it is.

        If the most likely edits give no word of the list, the next likely ones
        are tried, one place at a time.
        """
        first = word
        for _ in range(rounds):
            if word in self.lexicon:
                return word
            out = [self._apply(c, self.chars.predict(_features(word, i))) for i, c in enumerate(word)]
            new = "".join(out)
            if new == word:
                break
            word = new
        return word if word in self.lexicon else self._next_likely(first) or word

    @staticmethod
    def _apply(c: str, op: str) -> str:
        return c if op == KEEP else "" if op == "D" else op[1:] if op[0] == "R" else c + op[1:]

    def _next_likely(self, word: str, width: int = 4) -> str | None:
        best: tuple[float, str] | None = None
        for i, c in enumerate(word):
            scores = self.chars.scores(_features(word, i))
            for op in sorted(scores, key=lambda o: (-scores[o], o))[: width + 1]:
                if op == KEEP:
                    continue
                changed = word[:i] + self._apply(c, op)
                for rest in (word[i + 1 :], word[i + 2 :]) if op[0] == "R" else (word[i + 1 :],):
                    score = scores[op] - scores.get(KEEP, 0.0)
                    if changed + rest in self.lexicon and (best is None or score > best[0]):
                        best = score, changed + rest
        return best[1] if best else self._undone(word)

    def _undone(self, word: str) -> str | None:
        """The most likely word of the list of which ``word`` is a single misreading."""
        best: tuple[float, str] | None = None
        for a, b in _UNDO:
            at = word.find(b)
            while at >= 0:
                whole = word[:at] + a + word[at + len(b) :]
                if whole in self.lexicon:
                    scores = self.chars.scores(_features(word, at))
                    score = scores.get(f"R{a}", 0.0) - scores.get(KEEP, 0.0)
                    if best is None or score > best[0]:
                        best = score, whole
                at = word.find(b, at + 1)
        return best[1] if best else None
