"""Sentence boundaries across languages and scripts (problem 10).

A segmentation rule is a pair of regular expressions for what stands before and
after a position, and says break or no break; a rule of one expression says that
no position within its matches is a break.  The characters around a position say
which script's cascade of tables decides, and for alphabets with capitals the
paragraph's language says which table of abbreviations is in it.  The first rule
that matches decides.  Positions no rule speaks of are no boundary.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Abbreviations by language, without the final full stop.
#: "number": before a number; "name": before a name or another word; "inner": never at a sentence end.
ABBREVIATIONS = {
    "en": {
        "number": "No Nos Fig Figs Tab Sect Sec Eq Ch Ref Refs Vol vol p pp approx ca vs cf art".split(),
        "name": "Dr Prof Mr Mrs Ms St Sr Jr Rev Hon Gen Col Capt Lt Sgt Messrs".split(),
        "inner": "e.g i.e cf vs viz al approx".split(),
    },
    "de": {
        "number": "Nr Abb Tab Kap Abs Bd Bsp S ca bzw vgl".split(),
        "name": "Dr Prof Hr Fr Dipl Ing".split(),
        "inner": "z. B|d. h|u. a|i. d. R|o. ä|z.B|d.h|u.a|bzw|ca|vgl|ggf|evtl|inkl|sog|zzgl|max|min".split("|"),
    },
    "fr": {
        "number": "fig tabl n env chap vol art éd p pp cf".split(),
        "name": "M MM Mme Mlle Dr Pr Me".split(),
        "inner": "p. ex|c.-à-d|cf|env|tabl|fig|par ex".split("|"),
    },
    "es": {
        "number": "fig figs pág págs núm tab cap art vol aprox n.º".split(),
        "name": "Sr Sra Srta Dr Dra D Dña Ing Lic Prof".split(),
        "inner": "p. ej|aprox|pág|fig|núm|Ud|Uds|EE. UU".split("|"),
    },
    "hi": {"number": ["सं", "पृ"], "name": ["डॉ", "श्री", "प्रो", "सुश्री", "कु"], "inner": []},
    "ar": {"number": ["ص", "ج", "رقم"], "name": ["د", "أ", "م", "أ.د", "السيد"], "inner": []},
    "ru": {"number": "рис табл стр гл разд п с".split(), "name": "г им проф акад ул".split(), "inner": "т. е|т. д|т. п|т.е|см|напр|ок|макс|мин".split("|")},
    "th": {"number": ["พ.ศ", "ค.ศ", "หน้า"], "name": ["ดร", "ศ", "รศ", "ผศ", "นพ", "นาย"], "inner": []},
}
#: Month names after a German ordinal.
MONTHS = "Januar Jänner Februar März April Mai Juni Juli August September Oktober November Dezember".split()

#: Frequent words by which a paragraph's language is told.
FREQUENT = {
    "en": "the of and to in is was were with for that on by at from as are this it be which".split(),
    "de": "der die das und ist nicht mit von den dem ein eine des im zu auf für wurde werden bei".split(),
    "fr": "le la les l d de des et en est une un dans du que pour par sur avec au qui ne pas a été".split(),
    "es": "el la los las de y que en un una del se por con para es al no fue a".split(),
    "ru": "и в на не с что по из за для как это от при до было были он она".split(),
}
CLOSERS = "\"'”’“»›)\\]}」』】）》〉"
#: Without the mark that closes in German and opens in Chinese.
WIDE_CLOSERS = CLOSERS.replace("“", "")
OPENERS = "\"'“‘„«‹(\\[{「『【（《〈¿¡"
_SPACE = r"\s 　"
_THAI = "฀-๿"
_WIDE = "぀-ヿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ"


def _words(language: str, use: str) -> str:
    return "|".join(re.escape(w) for w in sorted(ABBREVIATIONS[language][use], key=len, reverse=True))


def _abbreviation_rules(language: str) -> list[tuple[bool, str, str]]:
    start = r"(?:^|(?<=[\s (\[\"'“„«»/–—-]))"
    out = []
    for use, after in (("inner", r"[\s ]*\S"), ("name", r"[\s ]*\w"), ("number", r"[\s ]*[(\[]?\d")):
        if ABBREVIATIONS[language][use]:
            out.append((False, rf"{start}(?:{_words(language, use)})\.", after))
    return out


_SMALL = "a-zß-öø-ÿа-яё"

#: (break?, before, after): the cascade's tables, each in the order it is tried.
TABLES: dict[str, list[tuple[bool, str, str]]] = {
    # within a number, name or address, and before a word in small letters ("pH" and the like aside), nothing breaks
    "inside": [(False, r"[.!?…]", r"[^\s\u0600-\U0010ffff]")],
    "small": [(False, r"", rf"[{_SPACE}]+[{_SMALL}](?![A-Z]|[a-z][A-Z])")],
    # what holds in every alphabetic script
    "first": [
        (False, r"^\W*(?:\d+(?:\.\d+)*|[IVXLC]+|[A-Za-z])[.)]", r"[\s ]"),  # the number of a heading or list item
        (False, r"(?:^|[\s (\[“\"„«.-])[A-ZÀ-ÖØ-ÞА-Я]\.", r"[\s ]*(?:[A-ZÀ-ÖØ-ÞА-Я]|[A-Za-z]\.|[a-zß-ÿ])"),  # initials
        (False, r"(?:^|[\s (\[“\"„«])[a-zäöü]\.", r"[\s ]*[A-Za-zÄÖÜäöü]\."),  # two-letter abbreviations
        (True, r"\b(?:etc|Co|Ltd|Inc|Corp|[ap]\.m|usw)\.[" + CLOSERS + r"]*", rf"[{_SPACE}]+[{OPENERS}]*(?:[A-ZÀ-ÖØ-Þ\d]|[a-z]{{1,2}}[A-Z])"),
    ],
    "en": _abbreviation_rules("en"),
    "de": [*_abbreviation_rules("de"), (False, r"(?:^|[\s ])\d{1,2}\.", rf"[\s ]*(?:{'|'.join(MONTHS)})\b")],
    "fr": [*_abbreviation_rules("fr"), (False, r"[?!…][\s ]*", r"[\s ]*»")],
    "es": _abbreviation_rules("es"),
    "ru": _abbreviation_rules("ru"),
    "hi": _abbreviation_rules("hi"),
    "ar": _abbreviation_rules("ar"),
    # a quoted question, exclamation or sentence that the sentence goes on after
    "caseless": [
        (False, rf"[?!؟।.…][\s ]*[{CLOSERS}]+", r"[\s ]*[؀-ۿऀ-ॿ]"),
        (True, rf"[।॥؟۔?!.…]+[{CLOSERS}]*", rf"[{_SPACE}]+\S"),
    ],
    "cased": [
        (False, r"", rf"[{_SPACE}]*[,;:–—-]"),
        (True, rf"[.!?…]+(?:[{_SPACE}]*»|[{CLOSERS}])*", rf"[{_SPACE}]+[{OPENERS}]*[{_SPACE}]*(?:[^\W_{_SMALL}]|[a-z]{{1,2}}[A-Z])"),
        (True, rf"[.!?…]+(?:[{_SPACE}]*»|[{CLOSERS}])*", rf"[{_SPACE}]+[^\w\s ,;:.!?…)»”’\]]"),
    ],
    "wide": [
        (False, rf"[。！？｡!?…][{WIDE_CLOSERS}]+", rf"[^\s　{OPENERS}]"),
        (True, rf"[。！？｡!?…]+[{WIDE_CLOSERS}]*", r""),
    ],
    "th": [
        (True, rf"[{_THAI}ฯๆ][{CLOSERS}]*", rf"[  \t]+[{OPENERS}]*[{_THAI}]"),
        (True, rf"[{_THAI}][!?.…]+[{CLOSERS}]*", rf"[{_SPACE}]+\S"),
    ],
}
#: By script, what no break stands within: in wide scripts a quotation, up to the mark that closes it.
WITHIN = {"wide": r"[“「『《][^”」』》]*(?=[”」』》])"}
_CASED = {language: ("inside", "small", "first", language, "cased") for language in FREQUENT}
CASCADES = {
    **_CASED,
    # a paragraph of which the language is not clear
    "cased": ("inside", "small", "first", *FREQUENT, "cased"),
    "hi": ("inside", "first", "hi", "caseless", "small", "cased"),
    "ar": ("inside", "first", "ar", "caseless", "small", "cased"),
    "wide": ("inside", "wide"),
    "th": ("inside", "th"),
}


def _compiled(cascade: str) -> list[tuple[bool, re.Pattern, re.Pattern]]:
    """A cascade ready to run: neighbours with the same decision are tried as one where what follows is the same."""
    rules = [r for t in CASCADES[cascade] for r in TABLES[t]]
    out: list[tuple[bool, re.Pattern, re.Pattern]] = []
    i = 0
    while i < len(rules):
        j = i
        while j < len(rules) and rules[j][0] == rules[i][0]:
            j += 1
        by_after: dict[str, list[str]] = {}
        for _, before, after in rules[i:j]:
            by_after.setdefault(after, []).append(before)
        out += [(rules[i][0], re.compile(rf"(?:{'|'.join(f'(?:{x})' for x in before)})\Z"), re.compile(after)) for after, before in by_after.items()]
        i = j
    return out


_RULES = {c: _compiled(c) for c in CASCADES}
_PARAGRAPH = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")
#: Every position that may be a boundary: after end marks with what closes them, or between Thai words.
_MAYBE = re.compile(rf"[。！？｡][。！？｡!?…]*[{WIDE_CLOSERS}]*|[.!?…؟۔।॥]+(?:[{_SPACE}]*»|[{CLOSERS}])*|(?<=[{_THAI}])(?=[ \t ]+[{OPENERS}]?[{_THAI}])")
#: Characters before a position that a rule can reach: twice the longest abbreviation; what follows has no bound.
_BEFORE = 32
_WITHIN = {script: re.compile(pattern) for script, pattern in WITHIN.items()}
_LETTERS = re.compile(r"[^\W\d_]+")
_LANGUAGE_OF = {language: frozenset(words) for language, words in FREQUENT.items()}


def paragraph_language(text: str) -> str:
    """The language of an alphabet with capitals whose frequent words a paragraph has most of, or 'cased' if none leads by two."""
    words = _LETTERS.findall(text.lower())
    counts = sorted(((sum(map(frequent.__contains__, words)), language) for language, frequent in _LANGUAGE_OF.items()), reverse=True)
    return counts[0][1] if counts[0][0] >= counts[1][0] + 2 else "cased"


def _script(text: str, at: int, mark: str) -> str:
    """Which cascade decides at a position, by the characters around it; 'cased' stands for the paragraph's language."""
    if mark and mark[0] in "。！？｡":
        return "wide"
    prev = text[at - len(mark) - 1 : at - len(mark)].strip() or text[max(0, at - len(mark) - 2) : at - len(mark)].strip()[-1:]
    follows = text[at : at + 2].strip()[:1]
    if not mark or "฀" <= prev <= "๿" and mark[:1] != ".":
        return "th"
    if follows and re.match(rf"[{_WIDE}]", follows) and not text[at : at + 1].isspace():
        return "wide"
    around = (prev, follows, mark[:1])
    if any("ऀ" <= c <= "ॿ" for c in around):
        return "hi"
    return "ar" if any("؀" <= c <= "ۿ" for c in around) else "cased"


def _breaks(text: str) -> list[int]:
    """The positions of a paragraph at which a sentence ends and another begins."""
    cuts: list[int] = []
    language = ""
    within: dict[str, list[tuple[int, int]]] = {}
    for m in _MAYBE.finditer(text):
        at = m.end()
        if at >= len(text):
            break
        script = _script(text, at, m.group())
        if script in _WITHIN:
            if script not in within:
                within[script] = [x.span() for x in _WITHIN[script].finditer(text)]
            spans = within[script]
            k = bisect_left(spans, (at, 0)) - 1
            if k >= 0 and spans[k][0] < at <= spans[k][1]:
                continue
        if script == "cased":
            language = script = language or paragraph_language(text)
        for brk, before, after in _RULES[script]:
            if after.match(text, at) and before.search(text, max(0, at - _BEFORE), at):
                if brk:
                    cuts.append(at)
                break
    return cuts


def sentence_spans(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of every sentence, in code points, without outer white space."""
    spans: list[tuple[int, int]] = []
    if not text:
        return spans
    begin = 0
    for end, following in [*((m.start(), m.end()) for m in _PARAGRAPH.finditer(text)), (len(text), len(text))]:
        paragraph = text[begin:end]
        edge = 0
        for cut in [*_breaks(paragraph), len(paragraph)]:
            part = paragraph[edge:cut]
            inner = part.strip()
            if inner:
                s = begin + edge + len(part) - len(part.lstrip())
                spans.append((s, s + len(inner)))
            edge = cut
        begin = following
    return spans


def split_sentences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sentence_no, start_pos, end_pos, sentence) of every document, in order from 1.

    Positions count code points from 0, end_pos is exclusive.  Null, empty and
    blank texts have no sentences.  Rows that repeat a key are each split.
    """
    kind = docs.schema[key].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            rows, no, starts, ends, sentences, size = [], [], [], [], [], 0
            for i, t in enumerate(texts.to_pylist()):
                for k, (s, e) in enumerate(sentence_spans(t), 1):
                    rows.append(i)
                    no.append(k)
                    starts.append(s)
                    ends.append(e)
                    sentences.append(t[s:e])
                    size += e - s
                if size > 8_000_000:
                    yield _batch(keys, rows, no, starts, ends, sentences)
                    rows, no, starts, ends, sentences, size = [], [], [], [], [], 0
            yield _batch(keys, rows, no, starts, ends, sentences)

    return docs.select(key, text).mapInArrow(split, f"`{key}` {kind}, sentence_no int, start_pos bigint, end_pos bigint, sentence string")


def _batch(keys: pa.Array, rows: list, no: list, starts: list, ends: list, sentences: list) -> pa.RecordBatch:
    out = [keys.take(pa.array(rows, pa.int64())), pa.array(no, pa.int32()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(sentences, pa.string())]
    return pa.RecordBatch.from_arrays(out, ["k", "sentence_no", "start_pos", "end_pos", "sentence"])
