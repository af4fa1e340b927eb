"""Per-document text statistics and the verdict prose or not prose."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.llm.arrow import map_partitions, map_rows

WORD = re.compile(r"[^\W\d_]+")
LINE_END = re.compile(r"[.!?;:,…\"\u201d\u2019»)\]-]$")
STOP = re.compile(r"[.!?]")
#: First characters of bulleted or numbered entries, and what then makes the line one.
BULLETS = frozenset("-*•·◦▪–—|+>(0123456789")
BULLET = re.compile(r"[-*•·◦▪–—|+>] ?\S|\(?\d{1,4}[.)\]:]\s|\(\w{1,3}\)\s")
#: Cells, leaders and separated values.
CELLS = re.compile(r"\|.*\||\t.*\t|\S {3,}\S.*? {3,}\S|\.{4,}|_{4,}|(?:,[^\s,]+){2,}$")
PAGE_BREAK = "--- PAGE BREAK ---"
NGRAMS = (2, 3, 4)
#: Share of all words from which on a word is a common one.
COMMON = 1e-3

SCHEMA = (
    "n_chars bigint, n_words bigint, n_lines bigint, n_paragraphs bigint, mean_word_length double, symbol_ratio double, "
    "digit_ratio double, line_end_punct_share double, common_word_share double, entry_line_share double, "
    "dup_line_share double, dup_line_char_share double, dup_paragraph_share double, top_2gram_char_share double, "
    "top_3gram_char_share double, top_4gram_char_share double, prose_chars bigint, other_chars bigint, verdict string"
)
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]

#: Lines before and after that are looked at together, letters of an introduction at most, words of a headline.
WINDOW, INTRODUCTION, HEADLINE = 2, 400, 12
#: Letters of a short word: in every script with spaces the words that hold sentences together are mostly that short.
SHORT = 3
#: The rule for a window of lines: what speaks for running prose, and what against it, each by so many points for the whole
#: of its measure. Prose has more points than NEEDED. Names: share of short words in lower case (most near a third; its
#: square counts against it), letters among characters, digits, mean word length in eighths, words of one letter, vowels
#: among letters, lines that go on in lower case, words in a line in fifteenths, lines that end in a digit, commas and stops
#: by word, lines that end in a stop.
POINTS = {
    "short": 43.0, "short_squared": -51.0, "letters": 12.0, "digits": -5.0, "length": -10.0, "single": -24.0, "vowels": 12.0,
    "goes_on": 1.5, "full": 1.0, "ends_in_digit": -2.0, "commas": -17.0, "stops": 3.5, "closed": 1.0,
}
NEEDED = 12.5
#: A text of whose letters one phrase of a few words takes more than this, occurring so often, isn't running prose, whatever
#: its lines look like.
PHRASE, OFTEN = 0.3, 5
VOWELS = re.compile("[aeiouyà-åè-ïò-öø-üýÿāăąēęěīıőōųūůűаеёиоуыэюяіїєαεηιουωάέήίόύώ]", re.IGNORECASE)
#: Scripts whose vowels aren't letters or aren't known here, and scripts without spaces between words.
NO_VOWELS, NO_SPACES = re.compile(r"[\u0530-\u0dff\u0f00-\u10ff\u1200-\u1cff]"), re.compile(r"[\u0e00-\u0eff\u2e80-\ua4cf\uac00-\ud7af\uf900-\ufaff]")


def is_entry(line: str) -> bool:
    """Whether a line is laid out as an entry of a list or a row of a table."""
    x = line.lstrip()
    if x[:1] in BULLETS and BULLET.match(x):
        return True
    if "," in x or "|" in x or "\t" in x or "   " in x or "...." in x or "____" in x:
        return CELLS.search(x) is not None
    return False


def line_counts(x: str, before: str) -> tuple[int, ...]:
    """What the rule counts in a line: characters, words, letters, short words, single letters, vowels, digits, commas,
    stops, whether it goes on in lower case, ends in a digit, ends in a stop."""
    y = x.strip()
    words = WORD.findall(y)
    n, letters = len(words), sum(map(len, words))
    dense = len(y) - y.count(" ") - y.count("\t")
    capitals = sum(map(str.isupper, words)) > 0.6 * n
    short = sum(len(w) <= SHORT and (capitals or w == w.lower()) for w in words)
    if NO_VOWELS.search(y):
        vowels = 0.38 * letters
    else:
        vowels = len(VOWELS.findall(y))
    if not y.isascii() and letters and len(wide := NO_SPACES.findall(y)) * 2 > letters:
        # characters take the place of words
        n, short, vowels = letters, 0.35 * letters, 0.38 * letters
        letters = 5 * len(wide)
        dense = letters + dense - len(wide)
    goes_on = (y[:1].isalpha() and y[:1] == y[:1].lower() or capitals) and before[-1:] not in ".!?:;”\"»"
    digits = dense - letters if y.isdigit() else sum(map(y.count, "0123456789"))
    return dense, n, letters, short, sum(len(w) == 1 for w in words), vowels, digits, y.count(","), y.count(".") + y.count("!") + y.count("?"), goes_on, y[-1:].isdigit(), y[-1:] in ".!?"


def points(counts: list[tuple[int, ...]]) -> float:
    """The points of a window of lines."""
    dense, n, letters, short, single, vowels, digits, commas, stops, goes_on, in_digit, closed = map(sum, zip(*counts, strict=True))
    if not n or not letters:
        return -99.0
    lines, share = len(counts), short / n
    p = POINTS
    return (
        p["short"] * share + p["short_squared"] * share * share + p["letters"] * letters / dense + p["digits"] * digits / dense + p["length"] * min(1.0, letters / n / 8) + p["single"] * single / n
        + p["vowels"] * vowels / letters + p["goes_on"] * goes_on / lines + p["full"] * min(1.0, n / lines / 15) + p["ends_in_digit"] * in_digit / lines + p["commas"] * commas / n + p["stops"] * stops / n + p["closed"] * closed / lines
    )


def judge(lines: list[str]) -> tuple[int, int]:
    """Characters (without spaces) in prose, and in lists, tables or rubbish.

    A line counts as prose when it and its neighbours of the same kind have the points for it. Headlines and notices that
    stand alone count as neither, repeated lines count once, and one or two sentences beside other matter count as an
    introduction.
    """
    prose = other = stops = 0
    seen: set[str] = set()
    run: list[tuple[str, tuple[int, ...]]] = []
    kind = False

    def close() -> None:
        nonlocal prose, other, stops
        n = len(run)
        for k, (x, counts) in enumerate(run):
            if x in seen:
                continue
            seen.add(x)
            dense, words = counts[0], counts[1]
            if kind and words < 8:
                other += dense
                continue
            near = [counts] if kind else [c for _, c in run[max(0, k - WINDOW) : k + WINDOW + 1]]
            if points(near) > NEEDED:
                prose += dense
                stops += counts[8]
            elif n == 1 and words and counts[2] >= 0.6 * dense and words <= HEADLINE or dense <= 6:
                pass  # a headline or notice that stands alone; a page number
            else:
                other += dense
        run.clear()

    for line in lines:
        x = line.strip()
        if not x or x == PAGE_BREAK:
            close()
            continue
        entry = is_entry(line)
        if entry != kind:
            close()
            kind = entry
        run.append((x, line_counts(x, run[-1][0] if run else "")))
    close()
    if other > prose // 4 and stops <= 3 and prose < INTRODUCTION:
        prose = min(prose, other // 2)
    return prose, other


def _share(a: float, b: float) -> float:
    return a / b if b else 0.0


def phrase_shares(words: list[str], letters: int, least: int = 2) -> list[float]:
    """For each of NGRAMS, the share of a text's letters that its commonest phrase of so many words takes, if it occurs at
    least so often."""
    out = []
    for k in NGRAMS:
        grams = Counter(zip(*(words[m:] for m in range(k)), strict=False))
        gram, n = max(grams.items(), key=lambda x: (x[1], x[0])) if grams else ((), 0)
        out.append(min(1.0, _share(n * sum(map(len, gram)), letters)) if n >= least else 0.0)
    return out


def verdict_of(text: str | None) -> tuple[int, int, str]:
    """Characters of prose, of other matter, and the verdict ``prose``, ``not_prose`` or ``empty``.

    Rules: at least as much prose as other matter by the lines' layout and words (judge), and no phrase that takes most of
    the text. In both, repeated lines count once."""
    if not text or not text.strip():
        return 0, 0, "empty"
    lines = text.split("\n")
    prose, other = judge(lines)
    if prose < other or not prose:
        return prose, other, "not_prose"
    words = [w.lower() for x in dict.fromkeys(map(str.strip, lines)) for w in WORD.findall(x)]
    letters = sum(map(len, words))
    # a phrase that takes a share of the letters has a word that takes at least its part of that share
    if max((n * len(w) for w, n in Counter(words).items()), default=0) >= PHRASE / max(NGRAMS) * letters and max(phrase_shares(words, letters, OFTEN)) >= PHRASE:
        return prose, other, "not_prose"
    return prose, other, "prose"


def statistics(text: str | None, common: frozenset[str] = frozenset()) -> tuple:
    """The row of SCHEMA for one text. Null and blank texts have zeros and the verdict ``empty``."""
    t = text or ""
    if not t.strip():
        return (len(t), 0, 0, 0, *[0.0] * 12, 0, 0, "empty")
    lines = t.split("\n")
    full = [x for x in lines if x.strip()]
    stripped = [x.strip() for x in full]
    paragraphs = [p for p in (x.strip() for x in re.split(r"\n\s*\n", t)) if p]
    words = [w.lower() for w in WORD.findall(t)]
    letters = sum(map(len, words))
    digits = len(re.findall(r"\d", t))
    dense = sum(map(len, t.split()))
    counts = Counter(stripped)
    dup_lines = sum(v - 1 for v in counts.values())
    dup_chars = sum((v - 1) * len(k) for k, v in counts.items())
    dup_par = len(paragraphs) - len(set(paragraphs))
    return (
        len(t), len(words), len(full), len(paragraphs), _share(letters, len(words)), _share(dense - letters - digits, dense),
        _share(digits, dense), _share(sum(bool(LINE_END.search(x)) for x in stripped), len(full)),
        _share(sum(map(common.__contains__, words)), len(words)), _share(sum(map(is_entry, full)), len(full)),
        _share(dup_lines, len(full)), _share(dup_chars, sum(map(len, stripped))), _share(dup_par, len(paragraphs)),
        *phrase_shares(words, letters), *verdict_of(t),
    )


def common_words(df: DataFrame, text_col: str, share: float = COMMON) -> frozenset[str]:
    """The words that make up more than a share of all words of the column: 1 / share of them at most."""

    def make():
        raw: Counter = Counter()

        def go(cols):
            if cols:
                for t in cols[0]:
                    if t:
                        raw.update(w.lower() for w in WORD.findall(t))
            if cols is None or len(raw) > 200_000:
                out = list(raw.items())
                raw.clear()
                return out
            return []

        return go

    words = map_partitions(df, [text_col], make, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    total = words.agg(F.sum("n").alias("total"))
    return frozenset(r.word for r in words.crossJoin(F.broadcast(total)).where(F.col("n") > share * F.col("total")).select("word").collect())  # one row


def document_statistics(df: DataFrame, id_col: str, text_col: str, common: frozenset[str] | None = None) -> DataFrame:
    """One row per input row: the id and the columns of SCHEMA.

    common: the words that count as common ones, else those of the column itself. Null and blank texts have zeros and the
    verdict ``empty``; repeated rows and repeated ids stay rows of their own; other columns of the input, of whatever name,
    are not read. Narrow but for the common words' counts: each text is seen once, whole.
    """
    known = common_words(df, text_col) if common is None else common
    return map_rows(df, [id_col], [text_col], lambda t: statistics(t, known), SCHEMA)


def prose_verdicts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, prose_chars, other_chars, verdict) of every row, without the other statistics. No shuffle."""
    return map_rows(df, [id_col], [text_col], verdict_of, "prose_chars bigint, other_chars bigint, verdict string")
