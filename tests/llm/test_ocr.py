from inkspan.llm import ocr

BASE = (
    "The harbor commission opened the northern bridge on Monday after a long discussion with the merchants.\n"
    "A letter from the village states that the reservoir was examined by the visiting engineers before noon.\n"
)
PAGE = (
    "— 3 —\nTHE KETTLE COURIER — PAGE 3\nThe harb0r commission opened the north-\nern bridge on Monday aft©r a long disc-\nussion with the merchants. The two- and\nthree-part tugs were examined.\n\n--- PAGE BREAK ---\n\nii\nA letter from the vil- lage states ~that\nthe reservoir was examined."
)


def corpus(spark):
    rows = [(k, BASE, "Kettle Courier") for k in range(60)] + [(100, PAGE, "The Kettle Courier"), (101, None, "x"), (102, "", None), (100, PAGE, "The Kettle Courier")]
    return spark.createDataFrame(rows, "seq int, raw_text string, newspaper string")


def test_lines_and_repair(spark):
    df = corpus(spark).withColumnRenamed("seq", "noise")
    got = ocr.repair_pages(df, "noise", "raw_text", "newspaper").collect()
    assert len(got) == 64
    pages = [r for r in got if r[0] == 100]
    assert len(pages) == 2 and pages[0] == pages[1]
    found = {(n.line_no, n.noise) for n in pages[0][1]}
    assert found == {(1, "page_number"), (2, "header"), (3, "misread"), (3, "hyphen"), (4, "misread"), (4, "hyphen"), (10, "page_number"), (11, "hyphen"), (11, "misread")}
    text = pages[0][2]
    assert "harbor commission opened the northern bridge on Monday after a long discussion with" in text
    assert "two- and three-part" in text and "the village states that the reservoir" in text
    assert "COURIER" not in text and "PAGE BREAK" not in text
    by = {r[0]: r for r in got}
    assert by[101][1] == [] and by[101][2] is None and by[102][2] == ""


def test_empty_table(spark):
    assert ocr.repair_pages(corpus(spark).where("false"), "seq", "raw_text", "newspaper").count() == 0


def test_word_counts_leave_out_broken_words(spark):
    counts = {r.word: r.n for r in ocr.word_counts(spark.createDataFrame([("north-\nern bridge, bridge",)], "t string"), "t").collect()}
    assert counts == {"bridge": 2}


def test_distance_is_levenshtein():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    words = ["", "a", "ab", "kitten", "sitting", "abcdef", "abdef", "xbcdef", "fedcba"]
    for a in words:
        for b in words:
            assert ocr.distance(a, b, 3) == min(plain(a, b), 4)


def test_viterbi_uses_neighbours(spark):
    rows = [(f"he rose last night and sold the ship for cash {k}",) for k in range(200)] + [("the ship was lost at sea, lost at sea",)] * 20
    df = spark.createDataFrame(rows, "t string")
    lexicon = ocr.fit_pairs(df, "t", ocr.fit_lexicon(df, "t"))
    decoder = ocr.Decoder(lexicon)
    readings = decoder.viterbi(["rose", [("last", -7.0), ("lost", ocr.LOG_DOUBT)], "night"])
    assert readings == ["rose", "last", "night"]
    assert decoder.candidates("last") is None


def test_rare_words_keep_their_counts(spark, monkeypatch):
    """A name below the lexicon's share, beside a frequent word that it might be a misreading of, stands for itself; a
    single misreading of that word doesn't."""
    rows = [(k, f"the mayor halton spoke at the harbor on day {'abcdefghij'[k % 10]}", "x") for k in range(300)]
    rows += [(1000 + k, "a farmer named holton sold the wool", "x") for k in range(20)] + [(2000, "the mayor haltou spoke at the harbor", "x")]
    df = spark.createDataFrame(rows, "seq int, raw_text string, newspaper string")
    total = sum(len(r[1].split()) for r in rows)
    monkeypatch.setattr(ocr, "MIN_SHARE", 24.5 / total)
    lexicon = ocr.fit_pairs(df, "raw_text", ocr.fit_lexicon(df, "raw_text"))
    decoder = ocr.Decoder(lexicon)
    assert "holton" not in decoder.count and lexicon.rare["holton"] == 20 and decoder.candidates("holton") is None
    assert {v for v, _ in decoder.candidates("haltou")} == {"halton", "haltou"}
    got = {r.seq: r for r in ocr.repair_pages(df, "seq", "raw_text", "newspaper", lexicon).collect()}
    assert all(got[1000 + k].noise == [] and "holton" in got[1000 + k].repaired for k in range(20))
    assert [(n.line_no, n.noise) for n in got[2000].noise] == [(1, "misread")] and "halton" in got[2000].repaired


def lexicon(words, **more):
    import zlib

    import numpy as np

    order = sorted(words, key=lambda w: (-words[w], w))
    return ocr.Lexicon(sum(words.values()), zlib.compress("\n".join(order).encode()), np.array([words[w] for w in order]), {}, {}, **more)


def test_numerals_are_no_words():
    decoder = ocr.Decoder(lexicon({"civil": 50, "war": 50}))
    noise, text = decoder.text("CIVIL\nxiv\n— 12 —\nIll.\nPage lO\nMild", None)
    assert noise == [(2, "page_number"), (3, "page_number"), (5, "page_number")]
    assert text == "CIVIL Ill. Mild"


def test_two_misreadings_of_long_words():
    """Beyond LONGEST letters the search over the lexicon gives what listing all words would."""
    import random

    rng = random.Random(2)
    decoder = ocr.Decoder(lexicon({"w" * 40: 9}))
    for _ in range(200):
        v = "".join(rng.choice("abcdeilmnrw") for _ in range(rng.randint(5, 12)))
        made = {w for u, _ in ((u, 1) for u in _misread(v, decoder)) for w in _misread(u, decoder)}
        for w in rng.sample(sorted(made), min(4, len(made))):
            listed = {x for u, _ in decoder.variants(w) for x, _ in decoder.variants(u)}
            assert v in listed
            if v != w:
                assert list(decoder.between(v, 0, w, 0, 2)) or _overlapping(v, w, decoder)
    word = "donaudampfschifffahrtsgesellschaftskapitaen"
    decoder = ocr.Decoder(lexicon({word: 500}))
    assert set(decoder.readings(word.replace("m", "rn", 1).replace("k", "k").replace("sch", "seh", 1), 0)) == {word}
    assert not decoder.readings(word[:-3] + "xyz", 0)


def _misread(v, decoder):
    return [v[:k] + b + v[k + len(a) :] for a, b, _ in decoder.rules for k in range(len(v)) if v.startswith(a, k)]


def _overlapping(v, w, decoder):
    """Whether the second misreading changes what the first has made."""
    return any(w in _misread(u, decoder) for u in _misread(v, decoder))


def test_words_go_on_at_any_distance():
    decoder = ocr.Decoder(lexicon({"northern": 50, "the": 90, "bridge": 90}))
    noise, text = decoder.text("the north-\n" + "12\n" * 40 + "ern bridge", None)
    assert (1, "hyphen") in noise and text == "the northern bridge"


def test_pairs_are_counted_exactly(spark):
    df = corpus(spark)
    found = ocr.fit_pairs(df, "raw_text", ocr.fit_lexicon(df, "raw_text"))
    decoder = ocr.Decoder(found)
    assert decoder.together(ocr._pair(decoder.ids["northern"], decoder.ids["bridge"])) == 60
    assert decoder.together(ocr._pair(decoder.ids["bridge"], decoder.ids["northern"])) == 0


def test_results_do_not_depend_on_the_order(spark, sf):
    """The same noise and texts whatever a worker has read before."""
    df = spark.read.parquet(f"{sf}/issues.parquet").where("raw_text is not null")
    found = ocr.fit_pairs(df, "raw_text", ocr.fit_lexicon(df, "raw_text"))
    rows = [(r.raw_text, r.newspaper) for r in df.select("raw_text", "newspaper").collect()]
    one, other = ocr.Decoder(found), ocr.Decoder(found)
    forward = [one.text(*r) for r in rows]
    backward = [other.text(*r) for r in reversed(rows)]
    assert forward == backward[::-1] == [one.text(*r) for r in rows]
    noise, text = other.text("— the — two- masted well-known sh1p —", None)
    assert text.count("—") == 3
