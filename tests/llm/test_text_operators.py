"""Sentences, splitting, scan repair, the character editor and leakage on small fixtures."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mortarline.llm import leakage as L
from mortarline.llm import scan_repair as R
from mortarline.llm.char_editor import CharEditor
from mortarline.llm.sentences import sentence_spans, split_sentences
from mortarline.llm.splitting import boundary_kind, split_items, split_text


def parts(text):
    return [text[s:e] for s, e in sentence_spans(text)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Dr. A. B. Lee met No. 5, e.g. here. It was 3.5 mm vs. 4 mm. Next.", ["Dr. A. B. Lee met No. 5, e.g. here.", "It was 3.5 mm vs. 4 mm.", "Next."]),
        ("The lot came from Halvek Ltd. It was fine. At 5 p.m. Next one.", ["The lot came from Halvek Ltd.", "It was fine.", "At 5 p.m.", "Next one."]),
        ("“Will it hold?” the engineer asked. “It failed.” That was all.", ["“Will it hold?” the engineer asked.", "“It failed.”", "That was all."]),
        ("Heading without end\n\nOne line\nwrapped. Two.", ["Heading without end", "One line\nwrapped.", "Two."]),
        ("4.2 Methods: a test\n\n1. Introduction", ["4.2 Methods: a test", "1. Introduction"]),
        ("Am 26. März, z. B. bei Regen, ca. 3 Tage. „Hält er?“, fragte sie. Gut!", ["Am 26. März, z. B. bei Regen, ca. 3 Tage.", "„Hält er?“, fragte sie.", "Gut!"]),
        ("« Tient-il ? » a demandé M. Dupont. Non ! Voir fig. 4.", ["« Tient-il ? » a demandé M. Dupont.", "Non !", "Voir fig. 4."]),
        ("¿Por qué? El Sr. Paz, p. ej. hoy, vio la pág. 3. ¡Ya!", ["¿Por qué?", "El Sr. Paz, p. ej. hoy, vio la pág. 3.", "¡Ya!"]),
        ("他认为“盐雾。不可忽视”这一批注不准确。“能承受吗？”工程师问道。好！", ["他认为“盐雾。不可忽视”这一批注不准确。", "“能承受吗？”工程师问道。", "好！"]),
        ("「耐えるか。」と尋ねた。終わり。", ["「耐えるか。」と尋ねた。", "終わり。"]),
        ("ตัวอย่าง 84 ชิ้นเสียหาย ทีมงานทดสอบ 3 MPa ต่อไป ดร.สมมติเสนอ", ["ตัวอย่าง 84 ชิ้นเสียหาย", "ทีมงานทดสอบ 3 MPa ต่อไป", "ดร.สมมติเสนอ"]),
        ("डॉ. सोनाल ने जाँच की। “क्या टिकेगा?” अभियंता ने पूछा। हाँ!", ["डॉ. सोनाल ने जाँच की।", "“क्या टिकेगा?” अभियंता ने पूछा।", "हाँ!"]),
        ("قاس د. ورفان القيمة، انظر ص. 9. قال: «هل يصمد؟» ثم بدأ. نعم!", ["قاس د. ورفان القيمة، انظر ص. 9.", "قال: «هل يصمد؟» ثم بدأ.", "نعم!"]),
        ("It rose ... then fell. pH values fell.", ["It rose ... then fell.", "pH values fell."]),
        ("", []),
        (" \n\n ", []),
    ],
)
def test_sentences(text, expected):
    assert parts(text) == expected


@given(st.text(alphabet="aB .!?\n\"”“。？ก ข1", max_size=80))
@settings(max_examples=150, deadline=None)
def test_sentences_cover_all_text(text):
    spans = sentence_spans(text)
    assert all(a < b for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))
    rest = text
    for s, e in reversed(spans):
        assert text[s:e] == text[s:e].strip()
        rest = rest[:s] + rest[e:]
    assert not rest.strip()


def test_split_sentences_table(spark):
    df = spark.createDataFrame([(1, "One. Two.", "x"), (2, None, "x"), (3, "", "x"), (1, "One.", "x")], "doc_id long, text string, sentence string")
    got = sorted((r["doc_id"], r["sentence_no"], r["start_pos"]) for r in split_sentences(df).collect())
    assert got == [(1, 1, 0), (1, 1, 0), (1, 2, 5)]


def test_boundary_kinds():
    s = "Word " * 30 + "end. "
    assert boundary_kind(s * 5 + "\n\n" + s * 5, 1000)[0] == "paragraph"
    assert boundary_kind(s * 10, 1000)[0] == "sentence"
    assert boundary_kind("word " * 300, 1000)[0] == "word"
    assert boundary_kind("a" * 1500, 1000)[0] == "none"


@pytest.mark.parametrize("seed", range(6))
def test_pieces_cover_and_overlap(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["word ", "longer-word ", "End. ", "\n\n", "x" * 260 + " "]) for _ in range(400))
    _, pieces = split_text(text, 500, 60)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for (s, e), (t, f) in zip(pieces, pieces[1:], strict=False):
        assert s < t <= e < f and e - t <= 60
        assert t == e or t == e - 60 or text[t - 1].isspace()
    assert all(e - s <= 500 for s, e in pieces)


def test_cut_at_the_best_boundary():
    text = "a" * 400 + ".\n\n" + "b" * 420 + ". Cc dd."
    _, pieces = split_text(text, 700, 50)
    assert text[: pieces[0][1]].rstrip().endswith("a.")


def test_split_items_keeps_short_and_null(spark):
    df = spark.createDataFrame([("c1", 1, "s", "short"), ("c2", 1, None, None), ("c3", 2, "s", "word " * 1000), ("c4", 2, "s", "")], "chunk_id string, doc_id long, section_guess string, chunk_text string")
    rows = split_items(df).collect()
    assert {r["chunk_id"]: r["n_pieces"] for r in rows}["c1"] == 1 and len([r for r in rows if r["chunk_id"] == "c3"]) == 3
    assert [r["piece"] for r in rows if r["chunk_id"] in ("c2", "c4")] in ([None, ""], ["", None])
    assert all(r["piece"] is None or len(r["piece"]) <= 2000 for r in rows)


WORDS = "the moisture content of concrete was reported after repeated freezing in low-oxygen storage and cross-bonded timber slab stayed exposed although compressive strength improved between readings governs laboratory reproduce specimens measured thermal transmittance".split()

MORE_WORDS = "mortar cement aggregate chloride carbonation corrosion reinforcement permeability porosity shrinkage hydration durability insulation masonry plaster asphalt membrane humidity temperature condensation ventilation foundation settlement deflection fatigue fracture delamination spalling adhesion viscosity density modulus elasticity ductility hardness polymer composite laminate sealant coating primer pigment solvent binder additive accelerator retarder".split()


@pytest.fixture(scope="module")
def editor():
    return CharEditor(WORDS)


def test_editor_held_out_accuracy():
    """Misreadings of words that the editor was not trained on; it only knows them to be words."""
    from mortarline.llm.char_editor import misreadings, strayed

    rng = random.Random(99)
    long = sorted({w for w in (*WORDS, *MORE_WORDS) if len(w) > 5 and "-" not in w})
    good = total = 0
    for fold in range(4):
        held = set(long[fold::4])
        editor = CharEditor([w for w in (*WORDS, *MORE_WORDS) if w not in held], known=frozenset(WORDS) | set(MORE_WORDS))
        for w in sorted(held):
            for seen, _ in [*rng.sample(misreadings(w), min(3, len(misreadings(w)))), strayed(w, rng)]:
                if seen not in editor.lexicon:
                    total += 1
                    good += editor.correct(seen) == w
    assert total > 200 and good / total >= 0.85, (good, total)  # trained on sixty words only


def test_editor_keeps_words_and_hyphens(editor):
    assert all(editor.correct(w) == w for w in WORDS)
    assert editor.joins_lines("conc", "rete") and not editor.joins_lines("low", "oxygen")


def test_judge(editor):
    judge = R.LineJudge(editor)
    lines = list(enumerate(["The moistiire content of conc-", "rete was reported after low-", "oxygen storage and KL-480.", "17"], 1))
    assert sorted(judge.page(lines)) == [(1, "hyphen"), (1, "ocr")]
    assert judge.misread("sla|b") and not judge.misread("slab") and not judge.misread("MU-77")


def test_found_noise(spark, editor):
    rng = random.Random(5)
    line = lambda: " ".join(rng.sample([w for w in WORDS if len(w) > 5], 5))
    pages = [(f"c{d}{p}", d, f"s{d}", p, f"Title of paper {chr(64 + d) * 3}   {p + 10}\n   {line()}\n{line()} conc¬\nrete {line()}\n{line()}.\nThe venue says this.") for d in range(1, 4) for p in range(1, 4)]
    rest = [("cn", 9, None, None, None), ("ce", 9, "s1", 1, "")] + [(f"x{d}", d, f"s{d}", 1, f"Own text {d}.\n\nThe venue says this.") for d in range(10, 40)]
    chunks = spark.createDataFrame(pages + rest, "chunk_id string, doc_id long, source_id string, page_number int, chunk_text string")
    sources = spark.createDataFrame([(f"s{d}", "V") for d in range(1, 40)], "source_id string, venue string")
    got = {(r["chunk_id"], r["line_no"], r["kind"]) for r in R.found_noise(chunks, sources, editor).collect()}
    assert {(c, 1, "header") for c, *_ in pages} <= got
    assert {(c, 3, "hyphen") for c, *_ in pages} <= got
    assert not [x for x in got if x[1] == 6]
    text = {r["doc_id"]: r["text"] for r in R.repaired_paragraphs(chunks, sources, editor).where("paragraph_no = 1").collect()}
    assert " concrete " in text[1] and "¬" not in text[1] and "Title" not in text[1] and "venue" not in text[1]


@pytest.mark.parametrize("size", [1, 20])
def test_misreadings_stay_unknown_at_any_size(spark, size):
    """Misread words are as unknown, and found as often, in a corpus of twenty times the rows."""
    rng = random.Random(8)
    words = [w for w in WORDS if len(w) > 5 and "-" not in w]
    pages = [(f"d{k}", k, f"s{k}", 1, " ".join(rng.choices(words, k=200))) for k in range(20)]
    bad = {"moisture": "moisfure", "concrete": "concrcte", "thermal": "therrnal", "strength": "sfrength"}
    for k in range(20, 60):
        lines = [rng.choices(words, k=7) for _ in range(30)]
        lines[k % 30][3] = bad[rng.choice(list(bad))]
        lines[5][2], lines[9][4] = "tells", "tells"  # sound, though on scanned pages alone
        pages.append((f"c{k}", k, f"s{k}", 1, "\n".join(map(" ".join, lines))))
    chunks = spark.createDataFrame([(f"{c}-{i}", d * 100 + i, s, p, t) for c, d, s, p, t in pages for i in range(size)], "chunk_id string, doc_id long, source_id string, page_number int, chunk_text string")
    editor = R.train_editor(chunks)
    assert not [w for w in bad.values() if w in editor.lexicon] and "tells" in editor.lexicon
    sources = spark.createDataFrame([(f"s{k}", f"V{k}") for k in range(60)], "source_id string, venue string")
    got = R.judged_lines(R.scanned_with_venue_lines(chunks, sources).withColumn("venue_lines", F.lit(None).cast("array<bigint>")), editor).where("what = 'ocr'")
    assert {(r["chunk_id"], r["line_no"]) for r in got.collect()} == {(f"c{k}-{i}", k % 30 + 1) for k in range(20, 60) for i in range(size)}


def test_words_beyond_the_training_list_are_known(spark):
    """The bound holds for the training alone: rarer words are sound, and their misreadings are found and corrected."""
    rare = ["transmittance", "laboratory", "stecl", "wärmedämmverbundsystemhersteller"]  # stecl: sound here, one edit from steel
    often = " ".join([w for w in WORDS if w not in rare] + ["steel"])
    chunks = spark.createDataFrame([(f"c{k}", k, "s", 1, often) for k in range(40)] + [(f"r{k}", 100 + k, "s", 1, " ".join([*rare, "rare-earth"])) for k in range(2)], "chunk_id string, doc_id long, source_id string, page_number int, chunk_text string")
    editor = R.train_editor(chunks, max_words=len(often.split()))
    judge = R.LineJudge(editor)
    assert all(w in editor.lexicon for w in [*rare, "rare-earth", "earth", "steel"]) and "sfeel" not in editor.lexicon and len(editor.lexicon) >= len(WORDS) + 2
    assert not judge.misread("stecl") and judge.misread("fransmittance") and editor.correct("laborafory") == "laboratory"


def test_printed_forms():
    assert {"percent"} <= R.printed_forms("percerit") & R.printed_forms("percenf") and "diurnal" in R.printed_forms("diiirnal")
    assert "chloride" in R.printed_forms("chlonde") and not R.printed_forms("x")


def test_scanned_page(spark):
    line = "a line of prose as scanners leave it"
    texts = [f"{line}\n" * 4, f"{line}\n" * 3, "one line only", "", None, "short\nlines\nhere", "Para one is a line of prose without breaks.\n\nPara two.", "1\t2\n" * 9, "x" * 900 + f"\n{line}" * 5, f"{line}\n\n" * 9, f"{line}\n \t\n" * 9]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")

    def brute(t):
        lines = (t or "").split("\n")
        return sum(25 <= len(a) <= R.LONGEST_LINE and "\t" not in a and a.count(" ") >= 3 and b.strip() != "" for a, b in zip(lines, lines[1:], strict=False)) >= 3

    assert [r[0] for r in df.orderBy("i").select(R.scanned_page(F.col("t"))).collect()] == [brute(t) for t in texts]


def test_leaks_against_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    items = [(k, "en", " ".join(rng.choices(vocab, k=40))) for k in range(6)] + [(9, "zh", "".join(rng.choices("天地玄黄宇宙洪荒日月盈昃", k=60))), (10, "en", "too short"), (12, "en", ""), (13, None, "十四天地玄黄宇宙洪荒日月盈昃寒来暑往秋收冬藏"), (11, "en", None)]
    docs = []
    for d in range(60):
        w = rng.choices(vocab, k=80)
        if d % 3 == 0:
            n, src = rng.choice([11, 12, 13, 14, 20]), items[d % 6][2].split()
            at = rng.randrange(0, len(src) - n)
            w[30:30] = [x.upper() + "," for x in src[at : at + n]]
        docs.append((d, " ".join(w)))
    docs += [(110, "x 十四天地玄黄宇宙洪荒日月盈昃寒来暑往秋收"), (111, "here it is: Too, short!")]
    docs += [(100, "x " + items[6][2][5:25] + "。"), (101, items[6][2][5:24]), (102, None), (103, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, lang string, text string")
    want = set()
    for d, t in docs:
        for k, lang, x in items:
            u, n = (L.characters, L.CHARACTERS) if lang != "en" else (L.words, L.WORDS)
            a, b = u(t or ""), u(x or "")
            have = {tuple(a[i : i + n]) for i in range(len(a) - n + 1)}
            if any(tuple(b[i : i + n]) in have for i in range(len(b) - n + 1)):
                want.add((d, k))
    got = L.find_leaks(df, it).where("verbatim")
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want and len(want) > 5
    assert (111, 10, False) in {(r["doc_id"], r["item_id"], r["verbatim"]) for r in L.find_leaks(df, it).collect()}
    passes = L.find_leaks(df, it, index_bytes=9000).where("verbatim")
    assert {(r["doc_id"], r["item_id"]) for r in passes.collect()} == want
    assert L.find_leaks(df, it.where("false")).count() == 0


def test_edited_items_are_found(spark):
    """Whole items with every tenth or so word changed: found if they are similar enough, against brute force over all windows."""
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(4000)]
    items = [(k, "en", " ".join(rng.choices(vocab, k=rng.randrange(45, 110)))) for k in range(40)]
    docs = []
    for d in range(200):
        w = items[d % 40][2].split()
        for _ in range(1 + d % 3):
            w[rng.randrange(len(w))] = "changed"
        docs.append((d, " ".join([*rng.choices(vocab, k=50), *w, *rng.choices(vocab, k=50)])))
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in L.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, lang string, text string")).collect()}
    near = same = 0
    for d, t in docs:
        item = items[d % 40][2].split()
        size = L._item_size(len(item), L.WORDS)
        u = t.split()
        best = max(L.weighted_similarity(u[i : i + size], x) for x in (item[:size], item[-size:]) for i in range(len(u) - size + 1))
        if best >= L.SIMILARITY:
            near += 1
            same += got.get((d, d % 40), 0.0) >= best
    assert near >= 60 and same / near >= 0.9, (same, near)
