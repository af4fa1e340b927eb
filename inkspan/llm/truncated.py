"""Texts that end before they should: cut at a field's limit or in transfer."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.llm.arrow import map_partitions, struct
from inkspan.llm.linear import Linear, hashed, train
from inkspan.llm.quality import is_entry
from inkspan.session import cut_lineage

#: Rows on which the classifier is fitted, at most, and words kept for its features (share of all words).
SAMPLE, MIN_SHARE = 12_000, 2e-6  # the sample is drawn by the ids' hashes
#: Limits that artificial cuts are made at, the commonest ones.
LIMITS = 1000
#: Share of the complete texts that teach with a signature put behind them, too.
SIGNED = 0.04
#: Rows of the table of limits that may be broadcast.
BROADCAST_ROWS = 200_000
#: What is put at the place of an artificial cut, one of them each time.
CUT_MARKS = ("", "", "", "", "", "", "…", "...", " …", " [...]", "…", "�")
TERMINAL = re.compile(r"[.!?](?:[\"'”’»“)\]]*)$")
#: What stands at a cut.
MARKS = ("[…]", "[...]", "[more]", "(more)", "…", "...", "�")
WORD = re.compile(r"[^\W_]+")


def source_limits(df: DataFrame, text_col: str, source_col: str) -> DataFrame:
    """(source, max_chars, at_chars, max_bytes, at_bytes, rows): the longest texts of a source, how many different ones
    are as long, and how many texts there are. Many texts of just the largest length mean a limit."""
    text = F.col(f"`{text_col}`")
    sizes = df.where(text.isNotNull()).select(F.coalesce(F.col(f"`{source_col}`"), F.lit("")).alias("source"), F.length(text).alias("chars"), F.octet_length(text).alias("bytes"), F.xxhash64(text).alias("h"))
    by_size = sizes.groupBy("source", "chars", "bytes").agg(F.approx_count_distinct("h").alias("n"), F.count("*").alias("rows"))
    top = by_size.groupBy("source").agg(F.max("chars").alias("max_chars"), F.max("bytes").alias("max_bytes"))
    # few sizes per source are near its largest one, whatever the number of texts
    near = by_size.join(top, "source").groupBy("source", "max_chars", "max_bytes")
    return near.agg(
        F.sum(F.when(F.col("chars") == F.col("max_chars"), F.col("n")).otherwise(0)).alias("at_chars"),
        F.sum(F.when(F.col("bytes") >= F.col("max_bytes") - 3, F.col("n")).otherwise(0)).alias("at_bytes"), F.sum("rows").alias("rows"),
    )


def word_facts(df: DataFrame, text_col: str) -> dict[str, tuple[int, float]]:
    """word -> (count, share of its occurrences that end a sentence), over the whole column; the words above
    MIN_SHARE of all, so 1 / MIN_SHARE at most."""

    def make():
        raw: Counter = Counter()

        def flush():
            n, e = Counter(), Counter()
            for token, k in raw.items():
                w = token.strip(".,;:!?\"'“”„«»()’—–-").lower()
                if w:
                    n[w] += k
                    if TERMINAL.search(token):
                        e[w] += k
            raw.clear()
            return [(w, k, e[w]) for w, k in n.items()]

        def go(cols):
            if cols is None:
                return flush()
            for t in cols[0]:
                if t:
                    raw.update(t.split()[:-1])
            return flush() if len(raw) > 200_000 else []

        return go

    words = map_partitions(df, [text_col], make, "word string, n bigint, e bigint").groupBy("word").agg(F.sum("n").alias("n"), F.sum("e").alias("e")).persist()
    try:
        total = words.agg(F.sum("n")).first()[0] or 0
        rows = words.where(F.col("n") >= max(2, math.ceil(MIN_SHARE * total))).toArrow()
    finally:
        words.unpersist()
    return {w: (n, e / n) for w, n, e in zip(*[c.to_pylist() for c in rows.columns], strict=True)}


def _unmarked(x: str) -> str:
    """The text without the mark of a cut at its end."""
    x = x.rstrip()
    return next((x[: -len(m)] for m in MARKS if x.endswith(m)), x)


def _shape(x: str) -> str:
    x = re.sub(r"[^\W\d_]", lambda m: "A" if m.group().isupper() else "a", x)
    return re.sub(r"(.)\1+", r"\1", re.sub(r"\d", "9", x))


def _coarse(x: str) -> str:
    """The kinds of a line's words: capitalised, plain, numbers; runs of a kind once."""
    x = re.sub(r"\d[\d,.]*", "9", re.sub(r"[^\W\d_][\w’'-]*", lambda m: "A" if m.group()[0].isupper() else "a", x))
    return re.sub(r"\b(\w)(?: \1)+\b", r"\1+", x)


def _bucket(x: float) -> int:
    return int(math.log2(x + 1))


def closing_features(text: str, limit: tuple[int, int, int, int] | None, words: dict) -> list[str]:
    """How a text closes: last characters, punctuation, last words, last line, length against its source's limit."""
    out: list[str] = []
    shown = text.rstrip()
    bare = _unmarked(shown)
    mark = len(bare) != len(shown)
    end = bare.rstrip()
    terminal = bool(TERMINAL.search(end)) and not mark
    state = ("mark" if mark else "") + ("space" if not mark and len(text) != len(shown) else "") + ("stop" if terminal else "")
    if limit:
        chars, at_chars, size, at_bytes = limit
        n, b = len(text), len(text.encode("utf-8", "surrogatepass"))
        if chars == n:
            out.append(f"limit chars {min(4, _bucket(at_chars))} {state}")
        if size - b <= 3:
            out.append(f"limit bytes {min(4, _bucket(at_bytes))} {state}")
    lines = shown.split("\n")
    last = _unmarked(lines[-1]).strip()
    toks = WORD.findall(last.lower())
    w = toks[-1] if toks else ""
    if not last.endswith(w) and last[-1:].isalnum():
        w = ""
    n, final = words.get(w, (0, 0.0)) if w and not w.isdigit() else (0, 0.0)
    kind = "number" if w.isdigit() else "none" if not w else f"word {min(10, _bucket(n))}"
    ending = f"{round(final * 5)}" if n >= 3 else "?"
    entry = is_entry(lines[-1])
    stops = sum(x.rstrip()[-1:] in ".,;:!?" for x in lines[:-1] if x.strip())
    verse = len(lines) > 5 and stops == 0
    context = "stop" if terminal else ("entry" if entry else "verse" if verse else "plain")
    out += [f"state {state}", f"context {context}", f"c1 {end[-1:]}", f"c2 {end[-2:]}", f"c3 {end[-3:]}", f"c4 {end[-4:]}"]
    out += [f"kind {kind} {context}", f"final {ending} {context}", f"kind {kind} {ending} {context}", f"shape {_shape(end[-12:])} {context}"]
    if not terminal:
        out += [f"w {w}", f"line {_shape(last)}", f"ww {' '.join(toks[-2:])}", f"start {' '.join(toks[:2])}"]
        previous = next((x for x in reversed(lines[:-1]) if x.strip()), "")
        out.append(f"above {context} {int(is_entry(previous))} {previous.rstrip()[-1:] if not previous.rstrip()[-1:].isalnum() else 'x'}")
        out.append(f"tokens {min(12, len(toks))} {context}")
        kinds, before = _coarse(last), [_coarse(x.strip()) for x in lines[-4:-1] if x.strip()]
        out += [f"coarse {kinds}", f"like {sum(k == kinds for k in before)} {kind.split()[0]}", f"commas {sum(k.count(',') == kinds.count(',') and len(k) < 24 for k in before)} {len(kinds) < 24}"]
        if entry or is_entry(previous):
            same = _shape(previous.strip()) == _shape(last)
            cells = [len(re.split(r"\t|\s{2,}|\||,|\.{4,}", x.strip())) for x in (previous, last)]
            out.append(f"row {int(same)} {max(-3, min(3, cells[1] - cells[0]))}")
            out.append(f"rowend {_shape(previous.strip())[-6:] == _shape(last)[-6:]} {kind.split()[0]}")
        alone = len(lines) > 1 and (previous.rstrip()[-1:] in ".!?”\"»" or not lines[-2].strip())
        out.append(f"alone {int(alone)} {min(12, len(toks))} {int(last[:1].isupper() or not last[:1].isalpha())}")
        out.append(f"alone {int(alone)} {kind} {ending}")
    paragraph = text[text.rfind("\n\n") + 1 :]
    for a, b in ("“”", "«»", "()", "„“"):
        if paragraph.count(a) > paragraph.count(b):
            out.append(f"open {a} {state}")
    return out


def cut(text: str, limits: list[tuple], rng: random.Random) -> tuple[str, tuple | None] | None:
    """The text cut at a limit or anywhere within a word, sentence or entry, and the limit it then has."""
    for _ in range(8):
        limit = rng.choice(limits) if limits and rng.random() < 0.4 else None
        if limit:
            at = limit[0] if limit[0] < len(text) else 0
        else:
            at = rng.randint(len(text) // 4, len(text) - 2)
        part = text[:at]
        if at < 20 or TERMINAL.search(part.rstrip()) or at >= len(text) - 1:
            continue
        rest = text[at:].lstrip(" ")
        if rest[:1] == "\n" and (is_entry(part.split("\n")[-1]) or not part.rstrip().endswith(",")):
            continue
        if limit:
            mark = rng.choice(("", "", "", "…"))
            return (part[:-1] + mark if mark else part), limit
        mark = rng.choice(CUT_MARKS)
        return (part if rng.random() < 0.5 else part.rstrip()) + mark, None
    return None


def signed(text: str, rng: random.Random) -> str | None:
    """A complete text with a signature after its last stop, on the same line, of names that stand in it."""
    names = re.findall(r"(?<=[a-z,] )[A-Z][a-z]{3,}", text)
    if len(names) < 2 or not TERMINAL.search(text.rstrip()):
        return None
    name = " ".join(rng.sample(names, 2))
    form = rng.choice(("{N}", "{N}, Secretary", "{N}, Secretary.", "— {N}", "{N}, Clerk"))
    return text.rstrip() + " " + form.replace("{N}", name.upper())


def _balanced(x, y, chosen) -> Linear:
    w = np.where(y[chosen] == 1, 0.5 / max(1, y[chosen].sum()), 0.5 / max(1, (1 - y[chosen]).sum()))
    return train([x[k] for k in chosen], y[chosen, None], ("cut",), w, l2=1e-5, rounds=200)


def fit(joined: DataFrame, limits_of: DataFrame, words: dict, sample: int = SAMPLE, seed: int = 7) -> Linear:
    """Logistic regression of artificially cut texts against texts as they are.

    joined: id, text, limits; limits_of: the table of limits. Of the texts as they are, some were cut, too: those the first fit gives as cut are left
    out of the second, and their share sets the offset.
    """
    share = min(1.0, sample / max(1, limits_of.agg(F.sum("rows")).first()[0] or 0))
    picked = joined.where(F.xxhash64("id", F.lit(seed)) < int((2 * share - 1) * 2**63)) if share < 1 else joined
    limits = [tuple(r) for r in limits_of.where("at_chars >= 8").select("max_chars", "at_chars", "max_bytes", "at_bytes").distinct().orderBy(F.desc("at_chars"), "max_chars").limit(LIMITS).collect()]
    limits.sort()
    shared = joined.sparkSession.sparkContext.broadcast(words)

    def make():
        def go(cols):
            out = []
            for key, text, *limit in zip(*cols, strict=True) if cols else ():
                if not text or not text.strip():
                    continue
                rng = random.Random(f"{seed} {key}")
                fold = rng.getrandbits(1)
                own = tuple(limit) if limit[0] is not None else None
                at_limit = own and (own[1] >= 8 and own[0] == len(text) or own[3] >= 8 and own[2] - len(text.encode("utf-8", "surrogatepass")) <= 3)
                if not at_limit or TERMINAL.search(text.rstrip()):  # most of the others were cut: no examples of whole texts
                    out.append((0, fold, hashed(closing_features(text, own, shared.value))))
                    extra = random.Random(f"{seed} signed {key}")
                    whole = signed(text, extra) if extra.random() < SIGNED else None
                    if whole:
                        out.append((0, fold, hashed(closing_features(whole, None, shared.value))))
                for _ in range(2):
                    got = cut(text, limits, rng) if len(text) > 60 and (TERMINAL.search(text.rstrip()) or rng.random() < 0.5) else None
                    if got:
                        at = got[1] or (own and (own[0] + len(text), *own[1:])) or None
                        out.append((1, fold, hashed(closing_features(got[0], at, shared.value))))
            return out

        return go

    rows = map_partitions(picked, ["id", "text", "max_chars", "at_chars", "max_bytes", "at_bytes"], make, "y int, fold int, x array<int>").collect()
    if not rows or len({r.y for r in rows}) < 2:
        return Linear(("cut",), np.zeros((1, 1 << 16), np.float32), np.array([-1.0]))
    rows.sort(key=lambda r: (r.y, r.x))
    x, y = [r.x for r in rows], np.array([r.y for r in rows], dtype=float)
    # texts as they are, judged by a model that hasn't seen them; fold: a text and its cuts stay together
    fold = np.array([r.fold for r in rows])
    keep = np.ones(len(rows), bool)
    for _ in range(2):
        margin = np.zeros(len(rows))
        for half in (0, 1):
            model = _balanced(x, y, np.flatnonzero(keep & (fold != half)))
            mine = np.flatnonzero(fold == half)
            margin[mine] = model.margins([x[k] for k in mine])[:, 0]
        keep = (y == 1) | (margin <= 0)
    share = float(np.clip(np.mean(margin[y == 0] > 0), 0.01, 0.5))
    model = _balanced(x, y, np.flatnonzero(keep))
    model.offsets = np.array([math.log(share / (1 - share))])
    return model


SCHEMA = "score double, cut boolean"


def truncation(df: DataFrame, id_col: str, text_col: str, source_col: str, sample: int = SAMPLE) -> DataFrame:
    """(id, source, score, cut) of every row; score is the probability that the text was cut.

    Null and blank texts are not cut (score 0); a null source counts as one source. Repeated rows stay rows.
    """
    plain = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.coalesce(F.col(f"`{source_col}`"), F.lit("")).alias("source"))
    limits = cut_lineage(source_limits(plain, "text", "source"))
    small = limits.count() <= BROADCAST_ROWS
    joined = plain.join(F.broadcast(limits.drop("rows")) if small else limits.drop("rows"), "source", "left")
    words = word_facts(plain, "text")
    model = fit(joined, limits, words, sample)
    shared = df.sparkSession.sparkContext.broadcast((model, words))

    def make():
        model, words = shared.value

        def go(cols):
            if not cols:
                return []
            found, at = [], []
            rows = list(zip(*cols, strict=True))
            for k, (_, _, text, *limit) in enumerate(rows):
                if text and text.strip():
                    found.append(hashed(closing_features(text, tuple(limit) if limit[0] is not None else None, words)))
                    at.append(k)
            score = np.zeros(len(rows))
            if at:
                score[at] = 1 / (1 + np.exp(-np.clip(model.margins(found)[:, 0], -30, 30)))
            return [(r[0], r[1], float(s), bool(s > 0.5)) for r, s in zip(rows, score, strict=True)]

        return go

    kept = [plain.schema["id"], plain.schema["source"]]
    from pyspark.sql.types import StructType

    return map_partitions(joined, ["id", "source", "text", "max_chars", "at_chars", "max_bytes", "at_bytes"], make, StructType([*kept, *struct(SCHEMA).fields]))
