"""Noise in text from scanned pages (problem 6).

Words are counted over all pages; a character editor is trained on the most
frequent ones and goes to the tasks, which judge every line of the scanned
pages.  Running headers, footers and page numbers are told by their place on the
page and by what the other pages of the document have there; that evidence is
combined per document and joined back, so no document is ever in one place.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline.llm.char_editor import LINE_MARKS, MAX_WORDS, MISREADINGS, STRAYS, CharEditor, HashedWords
from mortarline.llm.repeated_lines import repeated_lines
from mortarline.plans.session import stored

EDGE_LINES = 3
HEADER_PAGES = 2
MIN_COUNT = 3
#: A word of scanned pages alone is a misreading if a single one parts it from a word so many times as frequent.
MISREAD_RATIO = 20
LONGEST_LINE = 110
#: Sound words that go to the tasks, as 8 bytes each (1 GB); a corpus of more is an error, and none is left out.
MOST_WORDS = 1 << 27

_TOKEN = re.compile(rf"[^\W_]+(?:[{re.escape(STRAYS)}'’-]+[^\W_]+)*[{re.escape(STRAYS)}]*|[{re.escape(STRAYS)}]+[^\W_]+")
_LETTERS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_STRAY = re.compile(f"[{re.escape(STRAYS)}]")
_MIXED = re.compile(r"(?=.*[a-zà-ÿ])(?=.*\d)")
_CODE = re.compile(r"^[A-Z]{1,3}-?\d|^\d+[A-Z]|^\d+(?:[.,]\d+)*[a-z]{0,2}\d?$|^v?\d+(?:\.\d+)+|/")
_BROKEN = re.compile(rf"([^\W\d_]+(?:-[^\W\d_]+)*)[{re.escape(STRAYS)}]?([{re.escape(LINE_MARKS)}])\s*$")
_CONTINUED = re.compile(rf"^\s*([^\W\d_][^\W_{re.escape(STRAYS)}]*(?:[{re.escape(STRAYS)}-]+[^\W_]+)*)")
_NUMBER = re.compile(r"^[\W_]*(?:page|pages|pg|p|seite|s|página|pág|pag)?[\W_]*(\d{1,5}|[ivxlc]{1,7})(?:\s*(?:of|/|von|de|sur)\s*\d+)?[\W_]*$", re.I)
_DIGIT = re.compile(r"\d")
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
_LEAD, _TRAIL = re.compile(r"^\W*(\d{1,5})(?:\s*[|•·/–—-]\s*|\s+)(?=\D)"), re.compile(r"(?:\s*[|•·/–—-]\s*|\s+)(\d{1,5})\W*$")


_NOT_ALNUM = bytes(c for c in range(128) if not chr(c).isalnum())
#: ASCII characters that part words become spaces; bytes of other characters stay for the exact pattern.
_PARTS = bytes(32 if c < 128 and not chr(c).isalpha() and c != 45 else c for c in range(256))


def _broken(line: str) -> re.Match | None:
    """The last word of a line that ends in a mark."""
    return _BROKEN.search(line) if line.rstrip()[-1:] in _MARKS else None


_MARKS = frozenset(LINE_MARKS)


#: A line of prose as a scanner leaves it, short and with three spaces at least, and a line with text right after it.
_SHORT_LINE = r"(?md)^(?=[^\t\n]{25,%d}$)(?=(?:[^ \n]* ){3})[^\n]*\n(?=[^\n]*\S)" % LONGEST_LINE


def scanned_page(text: Column) -> Column:
    """Whether a page is in short lines: three times a line of prose has the next one right below it."""
    return F.coalesce(F.regexp_count(text, F.lit(_SHORT_LINE)) >= 3, F.lit(False))


def roman(text: str) -> int | None:
    total, last = 0, 0
    for c in reversed(text.lower()):
        v = _ROMAN[c]
        total, last = total + (v if v >= last else -v), max(v, last)
    return total or None


def _key(text: str) -> str:
    if text.isascii():
        return text.encode().lower().translate(None, _NOT_ALNUM).decode()
    return "".join(c for c in unicodedata.normalize("NFKC", text).casefold() if c.isalnum())


def _letter_words(tokens: Counter) -> Counter:
    """The letter words in distinct tokens, counted as often as their token."""
    out: Counter = Counter()
    for token, n in tokens.items():
        for w in _LETTERS.findall(token.decode()):
            out[w] += n
    return out


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n_digital, n_scanned): letter words in lower case over all pages, combined per batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digital, scanned = Counter(), Counter()
            for t, by_scanner in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if t:
                    (scanned if by_scanner else digital).update(t.lower().encode().translate(_PARTS).split())
            digital, scanned = _letter_words(digital), _letter_words(scanned)
            words = list(digital.keys() | scanned.keys())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([digital[w] for w in words], pa.int64()), pa.array([scanned[w] for w in words], pa.int64())], ["word", "d", "s"])

    rows = pages.select("chunk_text", scanned_page(F.col("chunk_text"))).mapInArrow(count, "word string, d bigint, s bigint")
    return rows.groupBy("word").agg(F.sum("d").alias("n_digital"), F.sum("s").alias("n_scanned"))


#: Letters for letters that a scanner takes for each other, in both directions.
_SWAPS = sorted({p for a, b in MISREADINGS if (a + b).isalpha() and (a + b).islower() for p in ((a, b), (b, a))})


def printed_forms(word: str) -> set[str]:
    """The words of which ``word`` may be a single misreading in letters alone."""
    return {word[: m.start()] + a + word[m.start() + len(b) :] for a, b in _SWAPS for m in re.finditer(f"(?={b})", word)}


def sound_words(counts: DataFrame) -> DataFrame:
    """The rows of word_counts whose word is no misreading.

    Words of born-digital pages count from the second time on.  A word of scanned
    pages alone may be as frequent as it likes in a large corpus: it counts only
    if no word that it may be a misreading of is MISREAD_RATIO times as frequent.
    (A least share of the words would make the parts of broken words unknown.)
    """
    alone = counts.where((F.col("n_digital") < 2) & (F.col("n_scanned") >= 10 * MIN_COUNT))

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(w, n, f) for w, n in zip(*(c.to_pylist() for c in batch.columns), strict=True) for f in sorted(printed_forms(w))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*pairs, strict=True)) or [()] * 3, (pa.string(), pa.int64(), pa.string()), strict=True)], ["word", "n", "form"])

    printed = counts.select(F.col("word").alias("form"), (F.col("n_digital") + F.col("n_scanned")).alias("n_form"))
    pairs = alone.select("word", F.col("n_digital") + F.col("n_scanned")).mapInArrow(forms, "word string, n bigint, form string")
    misread = pairs.join(printed, "form").where(F.col("n_form") >= MISREAD_RATIO * F.col("n")).select("word").distinct()
    return counts.where("n_digital >= 2").unionByName(alone.join(misread, "word", "left_anti"))


def train_editor(pages: DataFrame, max_words: int = MAX_WORDS) -> CharEditor:
    """An editor trained on the corpus's ``max_words`` most frequent sound words, judging by all of them.

    Words of born-digital pages go first, as scanners did not touch them.  Only
    the training is a bounded sample; beyond it all sound words are known by hash.
    """
    counts = stored(sound_words(stored(word_counts(pages))).where(F.length("word") > 1))
    top = counts.orderBy(F.desc(F.col("n_digital") * 10 + F.col("n_scanned")), "word").limit(max_words).collect()
    words = counts.select("word").unionByName(counts.where("contains(word, '-')").select(F.explode(F.split("word", "-")).alias("word")).where(F.length("word") > 1))
    n = words.count()
    if n > MOST_WORDS:
        raise ValueError(f"{n} different words; more than {MOST_WORDS} are not sent to the tasks")
    hashes = words.select(F.xxhash64("word").alias("h")).distinct().toArrow()["h"]
    return CharEditor([r["word"] for r in top], known=HashedWords(hashes.to_numpy()))


def _page_lines(text: str, gone: frozenset[int]) -> list[tuple[int, str]]:
    """(line number, line) of the lines that are neither blank nor among those to leave out."""
    return [(i, x) for i, x in enumerate(text.split("\n"), 1) if i not in gone and x.strip()]


def _edge(line: str) -> tuple[str, int | None, bool]:
    """(header key, printed number, nothing but the number) of a line at a page's edge."""
    digits = _DIGIT.search(line) is not None
    m = _NUMBER.match(line) if digits or len(line) < 60 else None
    if m:
        return "", int(m[1]) if m[1].isdigit() else roman(m[1]), True
    if not digits:
        return _key(line), None, False
    number = None
    for p in (_LEAD, _TRAIL):
        n = p.search(line)
        if n:
            number = int(n[1])
            line = line[: n.start()] + line[n.end() :]
            break
    return _key(line), number, False


def _furniture_like(line: str) -> bool:
    key, number, alone = _edge(line)
    return alone or number is not None and len(key) < 60 and ("|" in line or "   " in line.strip())


class LineJudge:
    """Hyphenation and misreadings of one page's lines."""

    def __init__(self, editor: CharEditor) -> None:
        self.editor = editor
        self.known: dict[str, bool] = {}
        self.good: set[str] = set()

    def misread(self, token: str) -> bool:
        hit = self.known.get(token)
        if hit is None:
            if len(self.known) > 300_000:
                self.known.clear()
                self.good.clear()
            hit = self.known[token] = self._misread(token)
            if not hit:
                self.good.add(token)
        return hit

    def _misread(self, token: str) -> bool:
        if _STRAY.search(token):
            return any(c.isalpha() for c in token)
        low = token.lower()
        lexicon = self.editor.lexicon
        if low in lexicon or len(low) < 2 or _CODE.search(token):
            return False
        if "-" in low:
            return any(self.misread(p) for p in token.split("-") if len(p) > 1)
        if not low.isalpha() and not _MIXED.search(low):
            return False
        if len(low) < 3:
            return False
        fixed = self.editor.correct(low)
        return fixed != low and fixed in lexicon or self._pair(low)

    def _pair(self, low: str) -> bool:
        """Two words that a lost hyphen or a capital made one are not misread; a digit within letters is."""
        return bool(re.search(r"[a-zà-ÿ]\d[a-zà-ÿ]|^\d[a-zà-ÿ]{3}|[a-zà-ÿ]{3}\d$", low)) and self.editor.correct(low) != low

    def page(self, lines: list[tuple[int, str]]) -> list[tuple[int, str]]:
        found: list[tuple[int, str]] = []
        skip_first: dict[int, str] = {}  # line index -> the part of a broken word it starts with, already judged
        top = True
        for x, (no, line) in enumerate(lines):
            if _NUMBER.match(line):
                continue
            tokens = _TOKEN.findall(line)
            bad = False
            if top and not _furniture_like(line):
                # the page may begin with the rest of a word: only its characters by themselves tell
                top = False
                if tokens and tokens[0].isalpha() and tokens[0].islower():
                    tokens = tokens[1:]
            if x in skip_first and tokens:
                bad = skip_first[x] == "bad"
                tokens = tokens[1:]
            m = _broken(line)
            if m:
                # the next text line: the word goes on there in small letters; else it does on the next page
                y, c = None, None
                for k in range(x + 1, min(x + 1 + EDGE_LINES, len(lines))):
                    c = None if _furniture_like(lines[k][1]) else _CONTINUED.match(lines[k][1])
                    if c and c[1][0].islower():
                        y = k
                        break
                right = c[1] if y is not None and c else ""
                left, mark = m[1], m[2]
                whole = left + right
                if y is None or right:
                    joined = mark not in "-‐‑" or self.editor.joins_lines(left.lower(), _STRAY.sub("", right).lower())
                    if joined:
                        found.append((no, "hyphen"))
                        if tokens:
                            tokens = tokens[:-1]
                        if right and y is not None:
                            bad_left, bad_right = self._halves(left, right)
                            bad |= bad_left
                            skip_first[y] = "bad" if bad_right else "good"
                        elif _STRAY.search(whole):
                            bad = True
            if bad or not self.good.issuperset(tokens) and any(self.misread(t) for t in tokens):
                found.append((no, "ocr"))
        return found

    def _halves(self, left: str, right: str) -> tuple[bool, bool]:
        """In which part of a broken word a character is misread."""
        a, b = bool(_STRAY.search(left)), bool(_STRAY.search(right))
        if a or b:
            return a, b
        low = (left + right).lower()
        if not self.misread(low):
            return False, False
        fixed = self.editor.correct(low)
        same = next((i for i, (p, q) in enumerate(zip(low, fixed, strict=False)) if p != q), len(left))
        return same < len(left), same >= len(left)


def judged_lines(pages: DataFrame, editor: CharEditor) -> DataFrame:
    """Per line of the scanned pages: hyphen, ocr, or an edge line with what it holds.

    ``pages`` has chunk_id, doc_id, page_number, chunk_text and venue_lines (the
    numbers of the lines that are the venue's).  Columns: chunk_id, doc_id, page_number, line_no, what,
    place (lines from the edge, 0 first), top, key, number, alone, shape.
    """
    model = pages.sparkSession.sparkContext.broadcast(editor)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = LineJudge(model.value)
        names = ["chunk_id", "doc_id", "page_number", "line_no", "what", "place", "top", "key", "number", "alone", "shape"]
        types = [pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.bool_(), pa.int32()]
        none = (None,) * 6
        for batch in batches:
            index, rows = [], []
            for i, (t, v) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                if not t:
                    continue
                lines = _page_lines(t, frozenset(v or ()))
                n = len(lines)
                for no, what in judge.page(lines):
                    index.append(i)
                    rows.append((no, what, *none))
                for x in dict.fromkeys([*range(min(EDGE_LINES, n)), *range(max(0, n - EDGE_LINES), n)]):
                    no, line = lines[x]
                    key, number, alone = _edge(line)
                    index.append(i)
                    rows.append((no, "edge", min(x, n - 1 - x), x < n - 1 - x, key, number, alone, _shape(line)))
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            at = pa.array(index, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in range(3)), *(pa.array(c, ty) for c, ty in zip(columns, types, strict=True))], names)

    doc_type = pages.schema["doc_id"].dataType.simpleString()
    schema = f"chunk_id string, doc_id {doc_type}, page_number int, line_no bigint, what string, place int, top boolean, key string, number bigint, alone boolean, shape int"
    return pages.select("chunk_id", "doc_id", "page_number", "chunk_text", "venue_lines").mapInArrow(judge, schema)


def _shape(line: str) -> int:
    """How much a line looks like furniture: 0 not, 1 perhaps, 2 by its own form."""
    s = line.strip()
    if s.endswith((".", "!", "?", ";", ",")) and not re.search(r"\bal\.$", s, re.I) or _broken(s):
        return 0
    if "|" in s or re.search(r"\S {2,}\S", s) or re.search(r"\bet\s+al\b", s, re.I):
        return 2
    return 1


def furniture(lines: DataFrame) -> DataFrame:
    """(chunk_id, line_no, kind) of headers and page numbers, from the edge lines of judged_lines."""
    edges = lines.where("what = 'edge'")
    # a printed number belongs to the pages if its distance from page_number is the same on several of them
    dated = edges.where("number is not null and page_number is not null").withColumn("shift", F.col("number") - F.col("page_number"))
    shifts = dated.groupBy("doc_id", "shift").agg(F.count_distinct("chunk_id").alias("pages")).where(F.col("pages") >= 2)
    best = shifts.groupBy("doc_id").agg(F.max_by("shift", F.struct("pages", -F.col("shift"))).alias("shift"))
    numbered = edges.where("alone and place <= 2").join(best, "doc_id", "left")
    right = (F.col("number") - F.col("page_number")) == F.col("shift")
    # without other pages to compare with, a number alone on the outermost line is taken
    numbers = numbered.where(F.when(F.col("shift").isNull() | F.col("page_number").isNull(), F.col("place") == 0).otherwise(right)).select("chunk_id", "line_no", F.lit("page_number").alias("kind"))
    heads = edges.where((~F.col("alone")) & (F.col("shape") > 0) & (F.length("key") >= 4) & (F.col("place") <= 2))
    seen = heads.where(F.length("key") >= 5).groupBy("doc_id", "key").agg(F.count_distinct("chunk_id").alias("pages"))
    # a header may be misread: near ones of a document share their beginning or end and differ in few letters
    blocks = F.explode(F.array(F.xxhash64(F.lit("<"), F.substring("key", 1, 5)), F.xxhash64(F.lit(">"), F.substring(F.reverse("key"), 1, 5)))).alias("block")
    one = seen.select("doc_id", "key", "pages", blocks)
    # most lines at an edge are prose and share no block with another page: they need not be compared
    shared = one.groupBy("doc_id", "block").agg(F.sum("pages").alias("n")).where(F.col("n") >= HEADER_PAGES).select("doc_id", "block")
    one = one.join(shared, ["doc_id", "block"], "left_semi")
    other = one.select("doc_id", "block", F.col("key").alias("other"), F.col("pages").alias("other_pages"))
    most = F.greatest(F.length("key"), F.lit(6))
    close = (F.col("key") == F.col("other")) | (F.abs(F.length("key") - F.length("other")) * 6 <= most) & (F.levenshtein("key", "other") * 6 <= most)
    pairs = one.join(other, ["doc_id", "block"]).where(close).select("doc_id", "key", "other", "other_pages").distinct()
    running = pairs.groupBy("doc_id", "key").agg(F.sum("other_pages").alias("pages")).where(F.col("pages") >= HEADER_PAGES)
    near = heads.join(running.select("doc_id", "key"), ["doc_id", "key"])
    headers = near.select("chunk_id", "line_no").distinct()
    # a title or author line with the page's own number stands there as part of the run, once as well as often
    lone = heads.where("number is not null and shape = 2").join(best, "doc_id").where(right).select("chunk_id", "line_no")
    return numbers.unionByName(headers.unionByName(lone).distinct().withColumn("kind", F.lit("header")))


def scanned_with_venue_lines(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """The scanned pages with the numbers of the lines that their venue puts on its documents, as problem 1 finds them."""
    lines = repeated_lines(pages, sources).groupBy("chunk_id").agg(F.collect_set("line_no").alias("venue_lines"))
    scanned = pages.where(scanned_page(F.col("chunk_text"))).select("chunk_id", "doc_id", "page_number", "chunk_text")
    return scanned.join(lines, "chunk_id", "left")


def found_noise(pages: DataFrame, sources: DataFrame, editor: CharEditor | None = None) -> DataFrame:
    """(chunk_id, line_no, kind): hyphen, ocr, header and page_number lines of scanned pages.

    Born-digital pages, null and empty texts have none.  A line can have several
    kinds; a page without page_number is compared by its edge lines alone.
    """
    editor = editor or train_editor(pages)
    lines = stored(judged_lines(scanned_with_venue_lines(pages, sources), editor))
    direct = lines.where("what <> 'edge'").select("chunk_id", "line_no", F.col("what").alias("kind"))
    return direct.unionByName(furniture(lines)).distinct()


#: Pages of one block when the paragraphs of a document are numbered.
PAGE_BLOCK = 256


def _corrected(line: str, judge: LineJudge) -> str:
    def fix(m: re.Match) -> str:
        token = m.group()
        if not judge.misread(token):
            return token
        low = token.lower()
        new = judge.editor.correct(low)
        if new not in judge.editor.lexicon:
            new = _STRAY.sub("", new)
        return new.upper() if token.isupper() and len(token) > 1 else new.capitalize() if token[:1].isupper() else new

    return _TOKEN.sub(fix, line)


def page_paragraphs(text: str, gone: frozenset[int], judge: LineJudge) -> list[tuple[str, bool]]:
    """(paragraph, whether a word is broken at its end) of one page without the lines ``gone``."""
    out: list[tuple[str, bool]] = []
    current, broken = "", False
    blank = True
    for no, raw in enumerate(text.split("\n"), 1):
        if no in gone:
            continue
        if not raw.strip():
            blank = True
            continue
        line = raw.strip()
        m = _broken(line)
        if current and not broken and (blank or raw.startswith("   ")):
            out.append((current, False))
            current = ""
        joined = line if not current or broken else f" {line}"
        if broken and current:
            left = re.search(r"[^\W_]*$", current)[0]
            first = re.match(r"[^\W_]*", line)[0]
            fixed = _corrected(left + first, judge)
            current, joined = current[: len(current) - len(left)], fixed + line[len(first) :]
        broken = False
        if m and (m[2] not in "-‐‑" or judge.editor.joins_lines(m[1].lower(), "")):
            joined, broken = joined[: joined.rstrip().rfind(m[2])], True
        elif m:
            broken = True  # the mark belongs to the word, which goes on without a space
        current += joined
        blank = False
    if current:
        out.append((current, broken))
    return [(_corrected(p, judge), b) for p, b in out]


def repaired_paragraphs(pages: DataFrame, sources: DataFrame, editor: CharEditor | None = None) -> DataFrame:
    """(doc_id, paragraph_no, first_chunk_id, text): continuous paragraphs of every document with scanned pages.

    Pages go in the order of page_number, those without one last, ties by
    chunk_id.  Headers, page numbers and the venue's lines are left out, broken
    words joined and misread ones corrected.  A page that begins in small letters
    goes on with the paragraph before.
    """
    editor = editor or train_editor(pages)
    marked = stored(scanned_with_venue_lines(pages, sources))
    lines = stored(judged_lines(marked, editor))
    gone = furniture(lines).groupBy("chunk_id").agg(F.collect_set("line_no").alias("gone"))
    model = pages.sparkSession.sparkContext.broadcast(editor)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = LineJudge(model.value)
        for batch in batches:
            index, no, texts, broken, first = [], [], [], [], []
            for i, (t, v, g) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                for k, (p, b) in enumerate(page_paragraphs(t, frozenset(v or ()) | frozenset(g or ()), judge)):
                    index.append(i)
                    no.append(k)
                    texts.append(p)
                    broken.append(b)
                    first.append(k > 0 or not p[:1].islower())
            at = pa.array(index, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in range(3)), pa.array(no, pa.int32()), pa.array(texts, pa.string()), pa.array(broken, pa.bool_()), pa.array(first, pa.bool_())], ["chunk_id", "doc_id", "page_number", "piece", "text", "broken", "new"])

    doc_type = pages.schema["doc_id"].dataType.simpleString()
    pieces = marked.join(gone, "chunk_id", "left").select("chunk_id", "doc_id", "page_number", "chunk_text", "venue_lines", "gone").mapInArrow(repair, f"chunk_id string, doc_id {doc_type}, page_number int, piece int, text string, broken boolean, new boolean")
    page = F.coalesce("page_number", F.lit(2_147_483_647))
    # pages without a number are parted by the beginning of their chunk_id, which keeps their order
    block = F.struct(F.floor(page / PAGE_BLOCK).alias("pages"), F.when(F.col("page_number").isNull(), F.substring("chunk_id", 1, 4)).otherwise("").alias("beginning"))
    pieces = stored(pieces.withColumn("block", block).withColumn("page", page))
    # number the paragraphs of a document: within blocks of pages, then from block to block
    order = Window.partitionBy("doc_id", "block").orderBy("page", "chunk_id", "piece")
    inside = pieces.withColumn("n", F.sum(F.col("new").cast("int")).over(order))
    blocks = pieces.groupBy("doc_id", "block").agg(F.sum(F.col("new").cast("int")).alias("new_here"))
    before = blocks.withColumn("before", F.coalesce(F.sum("new_here").over(Window.partitionBy("doc_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("new_here")
    numbered = inside.join(before, ["doc_id", "block"]).withColumn("paragraph_no", F.greatest(F.col("n") + F.col("before"), F.lit(1)))
    parts = numbered.groupBy("doc_id", "paragraph_no").agg(F.sort_array(F.collect_list(F.struct("page", "chunk_id", "piece", "text", "broken"))).alias("parts"))
    text = F.aggregate("parts", F.lit(""), lambda acc, p: F.concat(acc, p["text"], F.when(p["broken"], "").otherwise(" ")))
    return parts.select("doc_id", "paragraph_no", F.element_at("parts", 1)["chunk_id"].alias("first_chunk_id"), F.rtrim(text).alias("text"))
