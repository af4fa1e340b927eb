import random

import numpy as np

from inkspan.llm import leaks

WORDS = [f"{a}{b}{c}" for a in ("ba", "co", "du", "fi", "gre", "hol") for b in ("nt", "rd", "mp", "ss", "vel") for c in ("er", "ing", "ed", "al", "ow", "um")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def dirty(text, rng, rate=0.015):
    return "".join(rng.choice("°;01f") if c.isalpha() and rng.random() < rate else c for c in text)


def brute(data, passage, words=30):
    """Whether any run of that many words stands in data exactly."""
    parts = [leaks.letters(w) for w in passage.split()]
    return any("".join(parts[k : k + words]) in data for k in range(len(parts) - words + 1))


def test_finds_all_planted_and_nothing_else(spark):
    rng = random.Random(3)
    items = [(k, sentence(rng, 80)) for k in range(30)]
    docs, want = [], set()
    for d in range(120):
        k = rng.randrange(30)
        parts = items[k][1].split()
        n = rng.choice([12, 20, 34, 45, 80])
        at = rng.randrange(0, len(parts) - n + 1)
        leak = " ".join(parts[at : at + n])
        if d % 3 == 0:
            leak = dirty(leak, rng, 0.008)
        if d % 3 == 1:
            leak = leak.upper().replace(" ", "-\n", 1).replace(" ", "\n", 3)
        docs.append((d, sentence(rng, 60) + " " + leak + " " + sentence(rng, 60)))
        if n >= 34:
            want.add((d, k))
    df = spark.createDataFrame(docs, "item_id int, text string")
    ev = spark.createDataFrame(items, "text_id int, words string")
    got = {(r.doc, r.item_id) for r in leaks.find_leaks(df, "item_id", "text", ev, "text_id", "words").collect()}
    assert got == want
    for d, text in docs:
        for k, passage in items:
            if brute(leaks.letters(text), passage):
                assert (d, k) in got


def test_accents_and_short_texts(spark):
    rng = random.Random(4)
    passage = sentence(rng, 40)
    df = spark.createDataFrame([(1, passage.replace("o", "ö").replace("e", "É")), (2, None), (3, ""), (4, "short"), (1, passage)], "id int, text string")
    ev = spark.createDataFrame([(7, passage), (8, None), (9, "too short"), (10, passage)], "id int, text string")
    got = sorted((r.doc, r.item_id) for r in leaks.find_leaks(df, "id", "text", ev, "id", "text").collect())
    assert got == [(1, 7), (1, 7), (1, 10), (1, 10)]
    assert leaks.find_leaks(df, "id", "text", ev.where("false"), "id", "text").count() == 0
    assert leaks.find_leaks(df.where("false"), "id", "text", ev, "id", "text").count() == 0


def test_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(5)
    items = [(k, sentence(rng, 50)) for k in range(12)]
    df = spark.createDataFrame([(k, t) for k, t in items], "id int, text string")
    ev = spark.createDataFrame(items, "id int, text string")
    monkeypatch.setattr(leaks, "BLOCK", 1500)
    got = {(r.doc, r.item_id) for r in leaks.find_leaks(df, "id", "text", ev, "id", "text").collect()}
    assert got == {(k, k) for k, _ in items}


def found(docs, items):
    """(doc, item) by the index alone, the documents joined as a batch."""
    index = leaks.Passages.build(items)
    data = [leaks.letters(t) for t in docs]
    joined, begins = leaks._joined(data)
    hits = index.candidates(joined, begins)
    of = np.searchsorted(begins, [y for _, _, y in hits], "right") - 1
    ends = begins + np.array([len(x) for x in data])
    parts = index.stretches(hits, leaks._codes(joined), begins[of], ends[of])
    return {(int(d), index.ids[p]) for (p, _, _), d, part in zip(hits, of, parts, strict=True) if part}


def spoilt(text, rng, edits):
    """Letters substituted, dropped or doubled, anywhere."""
    chars = list(text)
    for k in rng.sample([k for k, c in enumerate(chars) if c.isalpha()], edits):
        chars[k] = rng.choice([rng.choice("abcdefghijklmnopqrstuvwxyz"), "", chars[k] + rng.choice("xyz"), "1"])
    return "".join(chars)


def test_thirty_words_with_misread_letters_anywhere():
    rng = random.Random(17)
    for edits in range(leaks.EDITS + 1):
        items = [(k, sentence(rng, 70)) for k in range(60)]
        docs, want = [], set()
        for d in range(180):
            k = rng.randrange(60)
            parts = items[k][1].split()
            at = rng.randrange(0, len(parts) - 30 + 1)
            docs.append(sentence(rng, rng.randrange(50)) + " " + spoilt(" ".join(parts[at : at + 30]), rng, edits) + " " + sentence(rng, rng.randrange(50)))
            want.add((d, k))
        assert found(docs, items) == want


def test_shorter_parts_and_many_errors_are_none():
    rng = random.Random(18)
    items = [(k, sentence(rng, 70)) for k in range(40)]
    docs = []
    for d in range(200):
        parts = rng.choice(items)[1].split()
        n = rng.choice([10, 20, 27])
        at = rng.randrange(0, len(parts) - n + 1)
        docs.append(sentence(rng, 40) + " " + " ".join(parts[at : at + n]) + " " + sentence(rng, 40))
    assert not found(docs, items)
    assert not found([spoilt(t, rng, 40) for _, t in items], items)


def test_reach_equals_the_whole_matrix():
    rng = random.Random(19)
    for _ in range(300):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(20)))
        b = spoilt(a, rng, min(len(a), rng.randrange(5))) + "".join(rng.choice("abc") for _ in range(rng.randrange(5)))
        least = []
        row = list(range(len(b) + 1))
        least.append(min(row))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
            row = new
            least.append(min(row))
        for step in (1, -1):
            x, y = np.array([ord(c) for c in "\1" * 20 + a[::step] + "\1" * 20]), np.array([ord(c) for c in "\0" * 20 + b[::step] + "\0" * 20])
            i, j = (20, 20) if step == 1 else (19 + len(a), 19 + len(b))
            got = leaks.reaches(x, np.array([i]), np.array([len(a)]), y, np.array([j]), np.array([len(b)]), step, 4)
            assert got[:, 0].tolist() == [max(k for k, v in enumerate(least) if v <= e) for e in range(5)]


def test_other_scripts():
    rng = random.Random(20)
    words = ["Москва", "газета", "вечер", "новый", "городской", "театр", "улица", "слово", "война", "письмо", "Ёлка", "река"]
    passage = " ".join(rng.choice(words) + rng.choice(["", "м", "ов", "ами"]) for _ in range(45))
    other = " ".join(rng.choice(words) + rng.choice(["", "у", "ой", "ах"]) for _ in range(45))
    docs = [other + " " + passage.upper().replace(" ", "\n", 3).replace("О", "0", 2) + " " + other, other + " " + " ".join(passage.split()[:25]), other]
    assert found(docs, [(1, passage)]) == {(0, 1)}


def test_rows_do_not_depend_on_neighbours(spark):
    rng = random.Random(21)
    items = [(k, sentence(rng, 60)) for k in range(20)]
    docs = []
    for d in range(160):
        parts = rng.choice(items)[1].split()
        at = rng.randrange(0, 25)
        docs.append((d, sentence(rng, rng.randrange(40)) + " " + spoilt(" ".join(parts[at : at + 33]), rng, rng.choice([5, 6, 7, 8, 9, 10]))))
    ev = spark.createDataFrame(items, "id int, text string")
    df = spark.createDataFrame(docs, "id int, text string")
    rows = [sorted(tuple(r) for r in leaks.find_leaks(x, "id", "text", ev, "id", "text").collect()) for x in (df.coalesce(1), df.repartition(16), df.orderBy("text"))]
    assert rows[0] == rows[1] == rows[2] and rows[0]
