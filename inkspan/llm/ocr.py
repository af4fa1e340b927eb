"""Noise of scanned pages: broken words, misread characters, running headers, page numbers.

Noisy-channel correction. A first pass counts the words of the whole corpus, a second the word pairs. Where a word is rarer than misreadings of a more frequent word would make it, the frequent words it may
stand for become candidates; a Viterbi search over each line weighs the character confusions against the n-grams.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkspan.llm.arrow import kept_fields, map_partitions, struct
from inkspan.llm.quality import PAGE_BREAK, is_entry, verdict_of

#: What a character or pair of characters is misread as. Probabilities are estimated from the corpus.
CONFUSIONS = {
    "a": "o", "b": "6 h", "c": "e", "cl": "d", "d": "cl", "e": "c ©", "f": "ſ", "g": "9", "h": "b", "i": "1 ; !", "l": "1 ! |",
    "li": "h", "m": "rn", "n": "u", "o": "0 ° ©", "r": "i", "rn": "m", "s": "5 ſ ∫", "t": "f", "u": "n", "w": "vv",
}
RULES = [(a, b) for a, x in CONFUSIONS.items() for b in x.split()]
HYPHENS = "-‐¬\xad="
#: Marks that may surround a word, and those that a misread letter may also look like.
MARKS, DOUBTFUL = ".,:?()\"“”„«»'‘’—–-[]/…", ";!"
PARTS = re.compile(r"[-–—’'/]")
ODD = re.compile(r"[^\w\s.,:;?!()\"“”„«»'‘’—–\-\[\]/…&$%€£#*•·>+@¡¿§]|_")
NUMBER = re.compile(r"[$£]?[\d.,:]*\d[\d.,:]*(?:st|nd|rd|th|s|d|er|re|e|a|o|%)?")
#: A page's number in digits, some of them misread, or as a Roman numeral, which no word is.
ROMAN = r"(?=[ivxlc])c{0,3}(?:x[cl]|l?x{0,3})(?:i[xv]|v?i{0,3})"
PAGE_NUMBER = re.compile(rf"\W*(?:page|pag|pág|p|seite|s|página|no)?\W*(?:(?-i:[\dlO]{{1,4}})|{ROMAN})\W*", re.IGNORECASE)
NOT_NAME = re.compile(r"[\W\d_]+")
HEADER_WORDS = frozenset("the page p pag no vol i ii iii iv v vi vii viii ix x xi xii xiii xiv xv xvi xvii xviii xix xx".split())
#: Words after which a hyphen stands for the part that follows later, as in "two- and three-masted".
SUSPENDED = frozenset("and or to und oder et ou y o e".split())

#: Share of all words above which a word is kept; at most 1 / MIN_SHARE words can be.
MIN_SHARE, MIN_COUNT = 1e-6, 2
#: Share of all word pairs from which on a pair is kept; at most 1 / MIN_PAIR are.
MIN_PAIR = 2e-7
FLUSH, PAIR_FLUSH = 200_000, 1 << 21
#: Misreadings may be SLACK + EXCESS times as many as expected before a word counts as a word of its own.
SLACK, EXCESS = 4.0, 8.0
PRIOR = 0.0013
#: What a word that misreadings could explain is still given as a word of its own.
DOUBT = 0.001
LOG_DOUBT = math.log(DOUBT)
#: Letters up to which all words that two misreadings may have made of a word are listed; longer ones, of which any language
#: has few, are held against the lexicon's long words instead.
LONGEST = 32
LINE_SCHEMA = "line_no int,noise string"


def core_of(token: str) -> str:
    return token.strip(MARKS).lower()


def _text_lines(text: str) -> list[list[str]]:
    """Words of the lines; of a word broken at a line end neither part."""
    out, skip = [], False
    for line in text.split("\n"):
        words = line.split()
        if not words:
            continue
        if skip:
            words = words[1:]
        skip = bool(words) and len(words[-1]) > 1 and words[-1][-1] in HYPHENS
        out.append(words[:-1] if skip else words)
    return out


def word_counts(df: DataFrame, text_col: str) -> DataFrame:
    """(word, n) over the whole column, summed within each partition first."""

    def make():
        raw: Counter = Counter()

        def flush():
            out: Counter = Counter()
            for token, n in raw.items():
                for part in PARTS.split(core_of(token).strip(DOUBTFUL)):
                    if part:
                        out[part] += n
            raw.clear()
            return list(out.items())

        def go(cols):
            if cols is None:
                return flush()
            for text in cols[0]:
                if text:
                    for words in _text_lines(text):
                        raw.update(words)
            return flush() if len(raw) > FLUSH else []

        return go

    return map_partitions(df, [text_col], make, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """Frequent words with counts, confusion probabilities, rare words whose counts matter and the table of word pairs."""

    total: int
    packed: bytes
    counts: np.ndarray
    rules: dict[tuple[str, str], float]
    rare: dict[str, int]
    pairs: np.ndarray | None = None  # of word numbers, in order, and their counts
    pair_counts: np.ndarray | None = None


def fit_lexicon(df: DataFrame, text_col: str) -> Lexicon:
    """Words above a share of all words (so at most 1 / MIN_SHARE of them reach the driver), rule probabilities, and the
    rarer words whose exact counts decide what they may be read as."""
    counted = word_counts(df, text_col).persist()
    try:
        total = counted.agg(F.sum("n")).first()[0] or 0
        least = max(MIN_COUNT, math.ceil(MIN_SHARE * total))
        kept = counted.where(F.col("n") >= least).toArrow()
        words, counts = kept.column("word").to_pylist(), kept.column("n").to_numpy()
        order = sorted(range(len(words)), key=lambda k: (-counts[k], words[k]))
        words, counts = [words[k] for k in order], np.asarray(counts, dtype=np.int64)[order] if len(order) else np.zeros(0, np.int64)
        lexicon = Lexicon(total, zlib.compress("\n".join(words).encode(), 1), counts, confusion_rates(dict(zip(words, counts.tolist(), strict=True))), {})
        lexicon.rare = rare_counts(counted.where(F.col("n") < least), lexicon)
    finally:
        counted.unpersist()
    return lexicon


def rare_counts(rare: DataFrame, lexicon: Lexicon) -> dict[str, int]:
    """Counts of the words below the lexicon's share that have other readings than a word that never occurs.

    Of the others the count makes no difference, so they needn't be known."""
    shared = rare.sparkSession.sparkContext.broadcast(lexicon)

    def make():
        decoder = _decoder(shared)

        def go(cols):
            return [(w, n) for w, n in zip(*cols, strict=True) if decoder.readings(w, n) != decoder.readings(w, 0)] if cols else []

        return go

    # up to MIN_COUNT occurrences change nothing but in the shortest words
    sought = rare.where((F.col("n") > MIN_COUNT) | (F.length("word") <= 2))
    found = map_partitions(sought, ["word", "n"], make, "word string, n bigint").toArrow()
    shared.unpersist()
    return dict(sorted(zip(found.column("word").to_pylist(), found.column("n").to_pylist(), strict=True)))


def confusion_rates(count: dict[str, int]) -> dict[tuple[str, str], float]:
    """How often each character is misread as each other: rare variants of frequent words against those words."""
    seen, chances = Counter(), Counter()
    frequent = [w for w, n in count.items() if n >= 100 and len(w) > 4]
    for rule in RULES:
        a, b = rule
        for v in frequent:
            k = v.find(a)
            while k >= 0:
                n = count.get(v[:k] + b + v[k + len(a) :], 0)
                chances[rule] += count[v]
                if n < 0.02 * count[v]:
                    seen[rule] += n
                k = v.find(a, k + 1)
    return {r: min(0.02, max(1e-5, (seen[r] + 1000 * PRIOR) / (chances[r] + 1000))) for r in RULES}


def fit_pairs(df: DataFrame, text_col: str, lexicon: Lexicon) -> Lexicon:
    """Adds the exact counts of adjacent words, of those pairs that make up MIN_PAIR of all or more."""
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    def make():
        ids = _decoder(shared).ids
        held: list[np.ndarray] = []

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
            held.clear()
            return list(zip(keys.tolist(), n.tolist(), strict=True))

        def go(cols):
            if cols is None:
                return flush()
            flat: list[str] = []
            for text in cols[0]:
                if text:
                    flat += text.lower().split()
                    flat.append("\n")
            if flat:
                n = np.fromiter((ids.get(w, 0) or ids.get(w.strip(MARKS + DOUBTFUL), 0) for w in flat), np.int64, len(flat))
                held.append(_pair(n[:-1], n[1:])[(n[:-1] > 0) & (n[1:] > 0)])
            return flush() if sum(map(len, held)) > PAIR_FLUSH else []

        return go

    counted = map_partitions(df, [text_col], make, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).persist()
    try:
        total = counted.agg(F.sum("n")).first()[0] or 0
        kept = counted.where(F.col("n") >= max(1, int(MIN_PAIR * total))).toArrow()
    finally:
        counted.unpersist()
    pairs, counts = kept.column("pair").to_numpy(), kept.column("n").to_numpy()
    order = np.argsort(pairs)
    lexicon.pairs, lexicon.pair_counts = pairs[order], np.minimum(counts[order], 2**31 - 1).astype(np.int32)
    shared.unpersist()
    return lexicon


def _pair(a, b):
    return a << 32 | b


TRACE = None
_OPEN: dict = {}


def _decoder(shared) -> Decoder:
    """The decoder of a broadcast lexicon, built once in a worker process."""
    if _OPEN.get("of") is not shared:
        _OPEN.clear()
        _OPEN.update(of=shared, decoder=Decoder(shared.value))
    return _OPEN["decoder"]


class Decoder:
    """Finds and repairs the noise of one text after another."""

    def __init__(self, lexicon: Lexicon):
        words = zlib.decompress(lexicon.packed).decode().split("\n") if len(lexicon.counts) else []
        self.count = dict(zip(words, lexicon.counts.tolist(), strict=True))
        self.rare = lexicon.rare
        self.ids = {w: k for k, w in enumerate([*words, *self.rare], 1)}
        self.total = max(1, lexicon.total)
        self.rules = [(a, b, lexicon.rules.get((a, b), PRIOR)) for a, b in RULES]
        self.by_first: dict[str, list] = {}
        for a, b, p in self.rules:
            self.by_first.setdefault(b[0], []).append((a, b, p))
        self.pairs, self.pair_counts = lexicon.pairs, lexicon.pair_counts
        self.met: dict[int, int] = {}
        self.long = [w for w in words if len(w) > LONGEST - 4]
        #: Tokens that stand for themselves wherever they are, with their words; known or not, they are read alike.
        self.clean: dict[str, list[str]] = {}
        self.parts: dict[str, list | None] = {}
        self.tokens: dict[str, tuple] = {}

    # -- words ----------------------------------------------------------------------------------------------------

    def variants(self, w: str):
        """What the word may have been before one misreading, with the probability of that misreading."""
        for k, ch in enumerate(w):
            for a, b, p in self.by_first.get(ch, ()):
                if w.startswith(b, k):
                    yield w[:k] + a + w[k + len(b) :], p

    def twice(self, w: str):
        """What the word may have been before two misreadings, with their probability."""
        if len(w) <= LONGEST:
            for u, p in self.variants(w):
                for v, q in self.variants(u):
                    yield v, p * q
            return
        for v in self.long:
            if abs(len(v) - len(w)) <= 2:
                for p in self.between(v, 0, w, 0, 2):
                    yield v, p

    def between(self, v: str, i: int, w: str, k: int, left: int):
        """The probabilities of so many misreadings that make w from place k on of v from place i on."""
        while i < len(v) and k < len(w) and v[i] == w[k]:
            i, k = i + 1, k + 1
        if left == 0:
            if i == len(v) and k == len(w):
                yield 1.0
            return
        # what is misread begins with another character than what stands for it
        for a, b, p in self.by_first.get(w[k : k + 1], ()):
            if v.startswith(a, i) and w.startswith(b, k):
                for q in self.between(v, i + len(a), w, k + len(b), left - 1):
                    yield p * q

    def own(self, w: str) -> int:
        """How often a word stands in the corpus; 0 also for rare ones whose count makes no difference."""
        return self.count.get(w) or self.rare.get(w, 0)

    def readings(self, w: str, own: int) -> dict[str, float]:
        """The frequent words that a word of so many occurrences may be a misreading of, with log probabilities."""
        odd = not (w.isalpha() and "ſ" not in w)
        out: dict[str, float] = {}
        if len(w) > 1 or odd:
            for v, p in self.variants(w):
                n = self.count.get(v, 0)
                if n >= 3 and v.isalpha() and (odd or n > own and own <= SLACK + EXCESS * p * n and (len(w) > 2 or own * 50 < n)):
                    out[v] = max(out.get(v, -99.0), math.log(p))
            if not out and (odd or own < MIN_COUNT + 1) and len(w) > 4:
                for v, p in self.twice(w):
                    if v != w and self.count.get(v, 0) >= 20 and v.isalpha():
                        out[v] = max(out.get(v, -99.0), math.log(p))
        return out

    def candidates(self, w: str) -> list[tuple[str, float]] | None:
        """None for a word that stands for itself, else its readings with the channel's log probabilities, itself
        included where that is possible. An empty list: odd, without a known reading."""
        if w in self.parts:
            return self.parts[w]
        if len(self.parts) > 400_000:
            self.parts.clear()
        odd = not (w.isalpha() and "ſ" not in w)
        out = self.readings(w, self.own(w))
        if odd:
            found = list(out.items())
        elif out:
            # the word as it stands is a state of the search, too: rare words have their say through their neighbours
            found = [*out.items(), (w, LOG_DOUBT)]
        else:
            found = None
        self.parts[w] = found
        return found

    def look(self, token: str) -> tuple:
        """(left marks, parts with their candidates, right marks, odd) of a token that isn't known to be clean.

        parts: (text, separator after it, candidates). odd: it holds a character that no text has."""
        if token in self.tokens:
            return self.tokens[token]
        if len(self.tokens) > 200_000:
            self.tokens.clear()
        low = token.lower()
        body = low.strip(MARKS)
        bare = body.strip(DOUBTFUL)
        if bare != body and not (len(body) > 2 and bare.isalpha() and not self.count.get(bare, 0) and self.candidates(body)):
            body = bare
        odd = bool(ODD.search(token)) or "§" in token
        if odd and body:
            # characters that stand beside the word and can't be a letter of it
            trimmed = body
            while trimmed and ODD.match(trimmed[0]) and not self._read(trimmed):
                trimmed = trimmed[1:]
            while trimmed and ODD.match(trimmed[-1]) and not self._read(trimmed):
                trimmed = trimmed[:-1]
            body = trimmed or body
        at = low.find(body) if body else 0
        parts, k = [], 0
        if body:
            for m in [*PARTS.finditer(body), None]:
                end = m.start() if m else len(body)
                w = body[k:end]
                cands = None
                if w and not NUMBER.fullmatch(w):
                    cands = self.candidates(w)
                    if cands == [] and not ODD.search(w) and not re.search(r"[^\W\d_][\d;!]|[\d;!][^\W\d_]", w):
                        cands = None
                parts.append((token[at + k : at + end], m.group() if m else "", cands))
                k = end + 1 if m else end
        result = (token[:at], parts, token[at + len(body) :], odd)
        self.tokens[token] = result
        if not odd and all(c is None for _, _, c in parts) and token[-1:] not in HYPHENS:
            if len(self.clean) > 400_000:
                self.clean.clear()
            self.clean[token] = [x.lower() for x, _, _ in parts]
        return result

    def _read(self, w: str) -> bool:
        return bool(self.count.get(w)) and not ODD.search(w) or any(self.count.get(v, 0) >= 3 and v.isalpha() for v, _ in self.variants(w))

    def known(self, w: str) -> bool:
        return self.own(w) >= 3 and not self.candidates(w)

    # -- lines ----------------------------------------------------------------------------------------------------

    def pair(self, a: str | None, b: str, doubtful: bool = False) -> float:
        """Log probability of b after a: pair counts, smoothed by single words. doubtful: one of the two is a
        word that misreadings could explain; its own occurrence doesn't speak for it."""
        single = 0.5 / self.total if doubtful else (self.count.get(b, 0) + 0.5) / self.total
        if a is None or self.pairs is None:
            return math.log(single)
        i, j = self.ids.get(a, 0), self.ids.get(b, 0)
        n = self.together(_pair(i, j)) if i and j else 0
        return math.log((max(0, n - 2 * doubtful) + 5.0 * single) / (self.count.get(a, 0) + 5.0))

    def together(self, pair: int) -> int:
        """How often a pair of words stands in the corpus, 0 for a rare one."""
        n = self.met.get(pair)
        if n is None:
            if len(self.met) > 400_000:
                self.met.clear()
            k = int(np.searchsorted(self.pairs, pair))
            n = self.met[pair] = int(self.pair_counts[k]) if k < len(self.pairs) and self.pairs[k] == pair else 0
        return n

    def viterbi(self, words: list) -> list[str]:
        """words: str, or a list of (reading, log probability of the channel). The likeliest reading of each."""
        states: list[tuple[float, tuple]] = [(0.0, ())]
        last: list[tuple[str | None, bool]] = [(None, False)]
        for w in words:
            options = [(w, 0.0)] if isinstance(w, str) else w
            if len(options) == 1 and len(states) == 1:
                states = [(states[0][0], (*states[0][1], options[0][0]))]
                last = [(options[0][0], False)]
                continue
            new, tails = [], []
            for o, lp in options:
                own = lp == LOG_DOUBT
                scores = [s + self.pair(x, o, own or y) for (s, _), (x, y) in zip(states, last, strict=True)]
                best = max(range(len(states)), key=scores.__getitem__)
                new.append((scores[best] + lp, (*states[best][1], o)))
                tails.append((o, own))
            states, last = new, tails
        return list(max(states, key=lambda s: s[0])[1])

    def header(self, line: str, name: str, first: tuple) -> bool:
        """Whether a line is the paper's name with nothing but page, number or date beside it."""
        low = line.lower()
        if not name or len(low) > len(name) * 2 + 45 or not any(f in low for f in first):
            return False
        rest = "".join(w for w in NOT_NAME.split(low) if w and w not in HEADER_WORDS)
        if rest == name:
            return True
        for extra in range(3):  # stray letters at the ends
            if rest[extra:] == name or rest[: len(rest) - extra] == name:
                return True
        return abs(len(rest) - len(name)) <= 3 and distance(rest, name, 3) <= 3

    def text(self, text: str, newspaper: str | None) -> tuple[list[tuple[int, str]], str]:
        """Noise by line, and the text in continuous paragraphs."""
        names = [w for w in NOT_NAME.split((newspaper or "").lower()) if w]
        name = "".join(w for w in names if w not in HEADER_WORDS)
        first = tuple(w for w in names if len(w) > 3) or tuple(names)
        lines = text.split("\n")
        noise: list[tuple[int, str]] = []
        kind: list[str] = []
        for line in lines:
            x = line.strip()
            if not x:
                kind.append("blank")
            elif x == PAGE_BREAK:
                kind.append("break")
            elif len(x) <= 14 and PAGE_NUMBER.fullmatch(x) and re.search(r"[\dA-Za-z]", x):
                kind.append("number")
            elif self.header(x, name, first):
                kind.append("header")
            else:
                kind.append("text")
        clean = self.clean
        tokens = [x.split() for x in lines]
        joined: dict[int, int] = {}  # line that ends inside a word -> line in which the word goes on
        nxt = None
        for k in range(len(lines) - 1, -1, -1):
            if kind[k] == "text":
                toks = tokens[k]
                if nxt is not None and len(toks[-1]) > 1 and toks[-1][-1] in HYPHENS and self.broken(toks[-1], tokens[nxt][0]):
                    joined[k] = nxt
                nxt = k
        targets = set(joined.values())
        paragraphs: list[list[str]] = [[]]
        carried: dict[int, bool] = {}
        for k, toks in enumerate(tokens):
            what = kind[k]
            if what == "number":
                noise.append((k + 1, "page_number"))
                if any(ODD.search(t) for t in toks):
                    noise.append((k + 1, "misread"))
                continue
            if what == "break":
                continue
            if what == "blank":
                paragraphs.append([])
                continue
            if what == "header":
                noise.append((k + 1, "header"))
            take, bad, hyphen = list(toks), carried.pop(k, False), False
            start = 0
            if k in targets and take:
                start = 1  # its first word belongs to the line before
            entry = None
            if k in joined:
                hyphen = True
                other = tokens[joined[k]][0]
                whole = take[-1][:-1] + other
                mine, theirs = self.blame(take[-1][:-1], other)
                bad |= mine
                if theirs:
                    carried[joined[k]] = True
                take[-1] = whole
            if any(t not in clean for t in take[start:]):
                out = []
                m = start
                while m < len(take):
                    t = take[m]
                    last = m == len(take) - 1
                    if t not in clean and not (last and k in joined):
                        if len(t) > 1 and t[-1] in HYPHENS and not last and self.broken(t, take[m + 1], within=True):
                            t = t[:-1] + take[m + 1]
                            hyphen = True
                            m += 1
                        _, parts, _, odd = self.look(t)
                        if odd or any(c is not None for _, _, c in parts):
                            if entry is None:
                                entry = is_entry(lines[k])
                            if odd and not any(c for _, _, c in parts) and (entry and set("|_\t") & set(t) or len(t) > 2 and len(set(t)) == 1 or len(t) > 1 and not any(map(str.isalnum, t))):
                                odd = False
                            bad |= odd
                    out.append(t)
                    m += 1
                out, wrong = self.repaired(out, what == "header")
                bad |= wrong
            else:
                out = take[start:]
            if hyphen:
                noise.append((k + 1, "hyphen"))
            if bad:
                noise.append((k + 1, "misread"))
            if what == "text":
                above = paragraphs[-1]
                if above and out and len(above[-1]) > 1 and above[-1][-1] in HYPHENS and above[-1][-2].isalpha() and out[0].lower() not in SUSPENDED:
                    above[-1] += out.pop(0)  # a compound, broken at its own hyphen
                above += out
        return noise, "\n\n".join(" ".join(p) for p in _continued(paragraphs) if p)

    def repaired(self, tokens: list[str], header: bool) -> tuple[list[str], bool]:
        """The tokens of a line as the search reads them, and whether any reading differs from what is there."""
        words: list = []
        where: list[tuple[int, int]] = []
        looks = []
        some = False
        for k, t in enumerate(tokens):
            if t in self.clean:
                looks.append(None)
                words += self.clean[t]
                where += [(k, -1)] * len(self.clean[t])
                continue
            got = self.look(t)
            looks.append(got)
            for j, (x, _, c) in enumerate(got[1]):
                words.append(c if c else x.lower())
                some |= bool(c)
                where.append((k, j))
        wrong = any(got and any(c == [] for _, _, c in got[1]) for got in looks)
        if not some and not any(got and got[3] for got in looks):
            return tokens, wrong
        read = self.viterbi(words) if some else [w if isinstance(w, str) else w[0][0] for w in words]
        # marks alone have no words
        out: list[list[str]] = [[t] if got is None or not got[1] and not got[3] else [ODD.sub("", t)] if not got[1] else [] for t, got in zip(tokens, looks, strict=True)]
        for (k, j), r, w in zip(where, read, words, strict=True):
            if j < 0:
                continue
            left, parts, right, odd = looks[k]
            x, sep, c = parts[j]
            if not isinstance(w, str) and r != x.lower():
                wrong = True
                if TRACE is not None:
                    TRACE[x.lower(), r] += 1
            elif not isinstance(w, str) and TRACE is not None:
                TRACE["=" + r, r] += 1
            if not isinstance(w, str) and r != x.lower():
                x = _cased(r, x)
            if j == 0:
                out[k].append(left if not odd else ODD.sub("", left))
            out[k].append((ODD.sub("", x) if odd else x) + sep)
            if j == len(parts) - 1:
                out[k].append(right if not odd else ODD.sub("", right))
        return [y for x in out if (y := "".join(x))], wrong

    def broken(self, a: str, b: str, within: bool = False) -> bool:
        """Whether token a, which ends in a hyphen, and token b are parts of one word."""
        left, right = a[:-1], b
        if not left[-1:].isalpha() and left[-1:] not in "©°∫ſ¦0156;!9" or not right[:1].isalnum() and right[:1] not in "©°∫ſ":
            return False
        if right[:1].isupper() and not left.isupper():
            return False
        word = core_of(PARTS.split(left)[-1] + PARTS.split(right)[0]).strip(DOUBTFUL)
        if self.known(word):
            return True
        x, y = core_of(PARTS.split(left)[-1]), core_of(PARTS.split(right)[0]).strip(DOUBTFUL)
        if self.candidates(word) and not (self.count.get(x, 0) >= 50 and self.count.get(y, 0) >= 50):
            return True
        if a[-1] != "-":
            return not within or bool(self.candidates(word))
        apart = self.count.get(x, 0) >= 3 and self.count.get(y, 0) >= 3
        return not apart and not within

    def blame(self, a: str, b: str) -> tuple[bool, bool]:
        """Whether the part before and the part after a line end hold a misread character."""
        x, y = PARTS.split(a)[-1].lower().lstrip(MARKS), PARTS.split(b)[0].lower().rstrip(MARKS)
        if self.count.get(y.rstrip(DOUBTFUL), 0) or self.count.get(x + y.rstrip(DOUBTFUL), 0):
            y = y.rstrip(DOUBTFUL)
        word = x + y
        c = self.candidates(word)
        rest = any(self.look(p)[3] or any(q is not None for _, _, q in self.look(p)[1]) for p in PARTS.split(a)[:-1] if p)
        if ODD.search(x) or ODD.search(y):
            return rest or bool(ODD.search(x)), bool(ODD.search(y))
        if c:
            r = max(c, key=lambda v: v[1] + math.log(self.count.get(v[0], 0) + 0.5))[0]
            if r == word:
                return rest, False
            same = next((k for k, (p, q) in enumerate(zip(word, r, strict=False)) if p != q), len(word) - 1)
            return rest or same < len(x), same >= len(x)
        if c == []:
            return rest or bool(re.search(r"[\d;!]", x)), bool(re.search(r"[\d;!]", y))
        return rest, False


def _cased(word: str, like: str) -> str:
    if like.isupper() and len(like) > 1:
        return word.upper()
    return word.capitalize() if like[:1].isupper() else word


def _continued(paragraphs: list[list[str]]) -> list[list[str]]:
    """Paragraphs, those that a page's end interrupted joined again."""
    out: list[list[str]] = []
    for p in paragraphs:
        if p and out and p[0][:1].islower() and out[-1] and out[-1][-1][-1:] not in ".!?”\"»":
            out[-1] = out[-1] + p
        elif p:
            out.append(p)
    return out


def repair_pages(df: DataFrame, id_col: str, text_col: str, newspaper_col: str, lexicon: Lexicon | None = None, prose_only: bool = False) -> DataFrame:
    """One row per input row: id, noise array<struct<line_no, noise>>, repaired string, verdict string.

    The noise of a line is any of ``hyphen``, ``header``, ``page_number``, ``misread``. Null texts give null, blank
    ones the empty text, both without noise; a null newspaper finds no headers. Repeated rows stay rows of their own.
    prose_only: texts whose verdict is ``not_prose`` are left as they are, without noise, for callers that don't want it.
    Without a lexicon, one is fitted on the column. Three scans, no shuffle of texts: only counts of words and
    of word pairs are.
    """
    if lexicon is None:
        lexicon = fit_pairs(df, text_col, fit_lexicon(df, text_col))
    shared = df.sparkSession.sparkContext.broadcast(lexicon)
    out = f"noise array<struct<{LINE_SCHEMA.replace(' ', ':')}>>, repaired string, verdict string"

    def make():
        decoder = _decoder(shared)

        def go(cols):
            out = []
            for key, text, name in zip(*cols, strict=True) if cols else ():
                if not text or not text.strip():
                    out.append((key, [], None if text is None else "", "empty"))
                    continue
                verdict = verdict_of(text)[2]
                noise, repaired = decoder.text(text, name) if verdict == "prose" or not prose_only else ([], text)
                out.append((key, [{"line_no": k, "noise": x} for k, x in noise], repaired, verdict))
            return out

        return go

    schema = StructType([*kept_fields(df, [id_col], out), *struct(out).fields])
    return map_partitions(df, [id_col, text_col, newspaper_col], make, schema)


def distance(a: str, b: str, most: int) -> int:
    """Edit distance, or most + 1 if it is larger; a band of the matrix suffices."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    far = most + 1
    row = [j if j <= most else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - most), min(len(b), i + most)
        new = [far] * (len(b) + 1)
        if i <= most:
            new[0] = i
        for j in range(lo, hi + 1):
            new[j] = min(row[j - 1] + (x != b[j - 1]), row[j] + 1, new[j - 1] + 1)
        if min(new[lo - 1 : hi + 1]) > most:
            return far
        row = new
    return min(row[len(b)], far)
