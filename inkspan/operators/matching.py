"""Which texts have most of a query's keywords, for many queries at once."""

from __future__ import annotations

import re

import numpy as np

#: Texts looked at together, at most; cells of a block of scores; parts of texts whose keywords are remembered.
ROWS, CELLS, REMEMBERED = 1024, 1 << 22, 1 << 19
#: Parts of a text between ASCII characters that are neither letters nor digits nor underscores: keywords have none of those.
PART = re.compile(r"[^\x00-/:-@\[-^`{-\x7f]+")
#: A rank is score * LATE + LATE - 1 - place: of equal scores the earlier text is the better one; 0 is none.
LATE = 1 << 40


class Keywords:
    """Finds the keywords that occur in a text as substrings. Each lies within one of the text's parts, and those recur:
    their substrings of the keywords' lengths are looked up once."""

    def __init__(self, words: list[str]):
        self.number = {w: k for k, w in enumerate(words)}
        self.lengths = sorted({len(w) for w in words})
        self.seen: dict[str, tuple[int, ...]] = {}

    def _of_part(self, part: str) -> tuple[int, ...]:
        number, n = self.number, len(part)
        return tuple({k for m in self.lengths if m <= n for i in range(n - m + 1) if (k := number.get(part[i : i + m])) is not None})

    def find(self, text: str) -> set[int]:
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        seen, out = self.seen, set()
        for part in set(PART.findall(text)):
            found = seen.get(part)
            if found is None:
                found = seen[part] = self._of_part(part)
            out.update(found)
        return out


class Best:
    """The best texts of each query, of texts that come one after the other. keys: the keywords of each query; one that
    stands there twice counts twice."""

    def __init__(self, keys: list[list[str]], top: int):
        number: dict[str, int] = {}
        numbered = [[number.setdefault(w, len(number)) for w in ws] for ws in keys]
        self.keywords, self.none, self.top = Keywords(list(number)), len(number), top
        self.rows = max(16, min(ROWS, 16 * CELLS // (len(number) + 1)))
        self.ranks = np.zeros((len(keys), top), np.int64)
        self.place = 0
        # blocks of queries of about as many keywords, filled up with a keyword that no text has
        self.blocks: list[tuple[np.ndarray, np.ndarray]] = []
        order = sorted((q for q, ks in enumerate(numbered) if ks), key=lambda q: len(numbered[q]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * max(self.rows, len(numbered[order[end]])) <= CELLS:
                end += 1
            longest = len(numbered[order[end - 1]])
            filled = np.array([numbered[q] + [self.none] * (longest - len(numbered[q])) for q in order[at:end]], np.int32)
            self.blocks.append((np.array(order[at:end]), np.ascontiguousarray(filled.T)))
            at = end

    def add(self, texts: list[str]) -> None:
        for k in range(0, len(texts), self.rows):
            self._add(texts[k : k + self.rows])

    def _add(self, texts: list[str]) -> None:
        has = np.zeros((self.none + 1, len(texts)), np.uint8)
        for k, text in enumerate(texts):
            has[list(self.keywords.find(text)), k] = 1
        late = LATE - 1 - self.place - np.arange(len(texts))
        for queries, columns in self.blocks:
            score = np.zeros((len(queries), len(texts)), np.uint8 if len(columns) < 256 else np.int32)
            for c in columns:
                score += has[c]
            # a later text needs a higher score than the last of the best
            better = np.flatnonzero(score.max(axis=1) > self.ranks[queries].min(axis=1) // LATE)
            for b in np.array_split(better, 1 + len(better) // 512):
                s = score[b].astype(np.int64)
                ranks = np.concatenate([self.ranks[queries[b]], np.where(s > 0, s * LATE + late, 0)], axis=1)
                self.ranks[queries[b]] = np.partition(ranks, ranks.shape[1] - self.top, axis=1)[:, -self.top :]
        self.place += len(texts)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, place of the text, score) of the best."""
        query, k = np.nonzero(self.ranks)
        rank = self.ranks[query, k]
        return query, LATE - 1 - rank % LATE, rank // LATE
