import random

import pytest

from inkspan.llm import split


def cut(text, rng):
    """The text in ranges of any size, some of them empty or of one character."""
    out, at = [], 0
    while at < len(text):
        n = rng.choice([0, 1, 2, 7, 60, 300])
        out.append(text[at : at + n])
        at += n
    return out


def brute(text, limit):
    for level, p in zip(split.LEVELS, split.PATTERNS, strict=True):
        if all(len(x.strip()) <= limit for x in p.split(text)):
            return level
    return "none"


def random_text(rng):
    kinds = ["a", "bcd ", "\n", "\n\n", " \n", "é", "\n--- PAGE BREAK ---\n", "xyzzyxyzzy", "--- PAGE", " BREAK ---", "\t", " " * rng.randint(1, 900), "\n   --- PAGE BREAK ---  \n", "\x0b", "x--- PAGE BREAK ---"]
    return "".join(rng.choice(kinds) for _ in range(rng.randint(0, 120)))


def test_tables_stitch_to_the_whole():
    rng = random.Random(5)
    for _ in range(3000):
        text = random_text(rng)
        parts = [split.table_of(x) for x in cut(text, rng)]
        t = split.stitched(parts)
        whole = split.table_of(text)
        assert t.n == len(text) and split.longest_pieces(t) == split.longest_pieces(whole)
        k = rng.randint(0, len(parts))
        assert split.longest_pieces(split.joined(split.stitched(parts[:k]), split.stitched(parts[k:]))) == split.longest_pieces(whole)
        assert split.longest_pieces(whole) == [max((len(x.strip()) for x in p.split(text)), default=0) for p in split.PATTERNS]
        for limit in (10, 30, 60):
            assert split.level_of(split.longest_pieces(t), limit) == brute(text, limit)


def test_white_space_longer_than_any_halo():
    text = "word " * 700 + "\n" + " " * 5000 + "\n" + "word " * 780
    whole = split.stitched([split.table_of(text)])
    for size in (100, 999, 4096):
        t = split.stitched(split.table_of(text[k : k + size]) for k in range(0, len(text), size))
        assert t == whole or split.longest_pieces(t) == split.longest_pieces(whole)
        assert split.level_of(split.longest_pieces(t), 4000) == "paragraph"


def test_pieces_cover_and_overlap():
    rng = random.Random(6)
    for _ in range(600):
        text, limit, over = random_text(rng) + "z", rng.choice([20, 40]), rng.choice([0, 3, 7])
        p = list(split.pieces_of(text, 0, len(text), 0, len(text), limit, over))
        assert p[0][1] == 0 and p[-1][2] == len(text) and all(len(x[4]) == x[2] - x[1] <= limit for x in p)
        assert all(c[1] == b[2] - over >= 0 and c[2] > b[2] for b, c in zip(p, p[1:], strict=False))
        # the same, however the text is cut into ranges
        at, again = 0, []
        while at < len(text):
            to = min(len(text), at + rng.choice([1, 50, 333, 2000]))
            low = max(0, at - over)
            again += split.pieces_of(text[low : to + 2 * split.SPAN * limit + limit], at, to, low, len(text), limit, over)
            at = to
        assert again == p


def test_frames(spark):
    long = "\n\n".join("word " * 150 for _ in range(12))
    rows = [(1, long), (1, long), (2, "x" * 9000), (3, None), (4, ""), (5, "short")]
    df = spark.createDataFrame(rows, "piece int, text string")
    got = sorted((r.item, r.boundary) for r in split.boundary_levels(df, "piece", "text").collect())
    assert got == [(1, "paragraph"), (1, "paragraph"), (2, "none")]
    for size in (1, 50, 10**6):
        assert sorted((r.item, r.boundary) for r in split.boundary_levels(df, "piece", "text", range_chars=size).collect()) == got
    pieces = [r for r in split.split_texts(df.where("piece <> 1"), "piece", "text").collect()]
    assert {r.item for r in pieces} == {2, 4, 5}
    assert "".join(r.piece[200 if r.piece_no > 1 else 0 :] for r in sorted(pieces, key=lambda r: r.piece_no) if r.item == 2) == "x" * 9000
    assert split.boundary_levels(df.where("false"), "piece", "text").count() == 0
    with pytest.raises(ValueError):
        split.split_texts(df, "piece", "text", limit=100, overlap=60)


def test_files_by_ranges_equal_texts(spark, tmp_path):
    rng = random.Random(7)
    texts = {
        "giant": "".join(f"Línea {k} de la página – ∫\n" + ("\n" + " " * 700 + "\n" if k % 7 == 0 else "") for k in range(4000)),
        "mixed": "".join(random_text(rng) for _ in range(60)), "empty": "", "short": "brief", "one": "x" * 5000,
    }
    paths = {}
    for name, text in texts.items():
        paths[name] = str(tmp_path / f"{name}.txt")
        with open(paths[name], "w", encoding="utf-8", newline="") as f:
            f.write(text)
    df = spark.createDataFrame([(paths[k], v) for k, v in texts.items()], "path string, text string")
    want = sorted(tuple(r) for r in split.split_texts(df, "path", "text", limit=500, overlap=20).collect())
    levels = {(r.item, r.boundary) for r in split.boundary_levels(df, "path", "text", limit=500).collect()}
    for size in (997, 8000, 1 << 20):
        tables = split.file_tables(spark, list(paths.values()), size)
        assert sorted(tuple(r) for r in split.file_pieces(tables, limit=500, overlap=20).collect()) == want
        got = {(r.item, r.chars, r.boundary) for r in split.file_levels(tables, limit=500).collect()}
        assert {(a, c) for a, _, c in got if c != "end"} == levels
        assert {(a, b) for a, b, _ in got} == {(paths[k], len(v)) for k, v in texts.items()}
