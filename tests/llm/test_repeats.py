import random
from collections import Counter

from inkspan.llm import repeats

NOTICE = "Printed and published every week-day at 91 Front street"


def frame(spark):
    rows = []
    for k in range(20):
        text = f"Story number {'abcdefghijklmnopqrst'[k] * 9} of the day\nPage {k}\n{NOTICE if k % 2 else NOTICE.upper()}\n--- PAGE BREAK ---\n{k}"
        if k == 3:
            text = text.replace("published", "publi5hed")
        if k < 6:
            text += "\nShare this page with a friend"
        rows.append((k, text, "P", f"r{k}"))
    rows += [(50, NOTICE, "Q", "q1"), (51, NOTICE, "Q", "q1"), (52, NOTICE, "Q", "q1"), (53, NOTICE, "Q", "q1"), (60, None, "P", "n"), (61, "", None, None)]
    return spark.createDataFrame(rows, "doc int, line_no string, source string, record string")


def test_found(spark):
    got = Counter(tuple(r) for r in repeats.repeated_lines(frame(spark), "doc", "line_no", "source", "record").collect())
    want = Counter({(k, 3): 1 for k in range(20)} | {(k, 6): 1 for k in range(6)})
    assert got == want  # one record delivered four times is one record


def test_sequences(spark):
    frequent, occurrences = repeats.frequent_wordings(frame(spark), "doc", "line_no", "source", "record")
    patterns = repeats.prefix_span(occurrences, frequent).collect()
    assert sorted((len(r.pattern), r.support) for r in patterns) == [(1, 6), (1, 20), (2, 6)]


def test_sequences_of_any_length(spark):
    """A masthead of five lines is one sequence of five lines; all its parts are frequent, too."""
    head = ["The Kettle Courier of the harbor", "Founded by the printers of Ashgrove", "Delivered to every household", "Advertisements are taken at noon", "Subscriptions must be paid before winter"]
    rows = [(k, "\n".join([*head, f"Story {'abcdefghijkl'[k] * 15}"]), "P", f"r{k}") for k in range(12)]
    df = spark.createDataFrame(rows, "doc int, text string, source string, record string")
    frequent, occurrences = repeats.frequent_wordings(df, "doc", "text", "source", "record")
    patterns = repeats.prefix_span(occurrences, frequent).collect()
    assert Counter(len(r.pattern) for r in patterns) == {1: 5, 2: 10, 3: 10, 4: 5, 5: 1} and {r.support for r in patterns} == {12}
    keys = {r.wording: r.key for r in frequent.collect()}
    assert [keys[w] for r in patterns if len(r.pattern) == 5 for w in r.pattern] == ["".join(x.lower().split()) for x in head]


def test_cleaned(spark):
    df = frame(spark)
    lines = repeats.repeated_lines(df, "doc", "line_no", "source", "record")
    got = {r[0]: r[1] for r in repeats.without_lines(df, "doc", "line_no", lines).collect()}
    assert "Printed" not in got[1] and "Share" not in got[1] and got[1].startswith("Story") and got[50] == NOTICE
    assert got[60] is None and got[61] == ""


def test_empty(spark):
    assert repeats.repeated_lines(frame(spark).where("false"), "doc", "line_no", "source", "record").count() == 0


def test_numerals_and_words(spark):
    rows = [(k, f"{x}\nBody of number {'abcdefgh'[k] * 14}", "P", str(k)) for k in range(8) for x in [("CIVIL\nIll.\nxiv\nPage IV\n12\n— 7 —")]]
    df = spark.createDataFrame(rows, "doc int, text string, source string, record string")
    got = {r.line_no for r in repeats.repeated_lines(df, "doc", "text", "source", "record").collect()}
    assert got == {1, 2}


def test_copies_with_as_many_edits_as_allowed(spark):
    """Lines of which most copies are misread, at the places that hit the segments, too."""
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, want = [], set()
    for no, n in enumerate((12, 17, 18, 25, 29, 30, 31, 40, 90)):
        line = "".join(rng.choice(letters) for _ in range(n))
        most = 1 if n < 18 else 2 if n < 30 else 3
        for k in range(24):
            x = list(line)
            if k > 3:
                for at in {0: rng.sample(range(n), most), 1: [0, n - 1, n // 2][:most], 2: [2, n // 2 - 3, n - 3][:most]}[k % 3]:
                    x[at] = rng.choice([c for c in letters if c != x[at]])
                if k % 4 == 0 and most > 1:
                    x = list(line)
                    x.insert(1, "q")
                    x.pop(n // 2 + 2)
            rows.append((no * 100 + k, "".join(x) + "\n" + "".join(rng.choice(letters) for _ in range(50)), f"s{no}", str(k)))
            want.add((no * 100 + k, 1))
    df = spark.createDataFrame(rows, "doc int, text string, source string, record string")
    got = {(r.doc, r.line_no) for r in repeats.repeated_lines(df, "doc", "text", "source", "record").collect()}
    assert want <= got
