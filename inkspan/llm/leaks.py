"""Evaluation passages that stand in corpus documents, whole or in part.

Both sides are reduced to letters and digits of any script. Sampled q-grams of a document that also stand in a passage are
counted in overlapping bands of diagonals; by the q-gram lemma a passage part with few misread characters keeps a known
number of them, so bands with fewer in the length of such a part are out. What remains is aligned within the band, by the
furthest-reaching points of its diagonals for each number of edits.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkspan.llm.arrow import map_partitions, struct

#: Edits in a part of WORDS words up to which it is found, wherever they are.
WORDS, EDITS = 30, 6
#: Letters of a q-gram, distance of those looked up in a document. An edit spoils at most Q / STEP of these.
Q, STEP = 12, 4
#: Width of a band of diagonals; the bands overlap by half, so EDITS + 1 adjacent diagonals share one.
BAND = 2 * EDITS
#: Letters of the passages that are looked up at a time; more passages take more rounds over the documents.
BLOCK = 4_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FILTER_BITS = 22
#: Letters that are compared at a time, and the padding that lets comparisons run over the ends.
_LOOK, _PAD = 8, 16
_OTHER = re.compile(r"[^\W\x00-\x7f]")
_ASCII = bytes(ord(chr(k).lower()) if k < 128 else 0 for k in range(256))
_DELETE = bytes(k for k in range(256) if not chr(k).isalnum() or k >= 128)
SCHEMA = "item_id bigint, words int, passage_words int, passage_start int, passage_end int"


class _Folded(dict):
    """Character -> its lower-case letter or digit, or nothing; filled as characters are met."""

    def __missing__(self, k: int) -> str:
        x = chr(k).lower()
        self[k] = x = x[0] if x[:1].isalnum() else ""
        return x


_FOLDED = _Folded()


def letters(text: str) -> str:
    """Lower-case letters and digits of a text: accents, case, spaces, line breaks, punctuation don't count."""
    plain = text if text.isascii() else unicodedata.normalize("NFKD", text)
    if _OTHER.search(plain):
        return plain.translate(_FOLDED)
    return plain.encode("ascii", "ignore").translate(_ASCII, _DELETE).decode()


def _codes(data: str) -> np.ndarray:
    return np.frombuffer(data.encode("ascii"), np.uint8) if data.isascii() else np.frombuffer(data.encode("utf-32-le", "surrogatepass"), np.uint32)


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            with np.errstate(over="ignore"):
                cls.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, _BASE)]), dtype=np.uint64)
                cls.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, _INVERSE)]), dtype=np.uint64)
        return cls.up[:n], cls.down[:n]


def qgrams(data: str, step: int) -> np.ndarray:
    """Hashes of the q-grams at every step-th position."""
    n = len(data)
    if n < Q:
        return np.zeros(0, np.uint64)
    up, down = _Powers.of(n)
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(_codes(data) * up, dtype=np.uint64)])
        h = (total[Q::step] - total[:-Q:step][: len(total[Q::step])]) * down[: n - Q + 1 : step]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


@dataclass
class Passages:
    """Index of a block of passages: every q-gram with all the places where it stands."""

    ids: list
    texts: list[str]
    starts: list[list[int]]  # of each passage's words, in letters
    ends: list[list[int]]
    # numbers of each of these words among all, marks that stand alone included: of the first mark before it, and the last after it
    firsts: list[list[int]]
    lasts: list[list[int]]
    least: list[int]  # letters of the shortest run of WORDS words; 0: fewer words
    keys: np.ndarray
    first: np.ndarray
    count: np.ndarray
    passage: np.ndarray
    place: np.ndarray
    present: np.ndarray
    codes: np.ndarray  # the texts one after the other, apart by characters that no document has
    offsets: np.ndarray
    sizes: np.ndarray

    @classmethod
    def build(cls, rows: list[tuple], words: int = WORDS) -> Passages:
        ids, texts, starts, ends, firsts, lasts, least, hs, ps, at = [], [], [], [], [], [], [], [], [], []
        for key, text in rows:
            tokens = (text or "").split()
            found = [(k, x) for k, w in enumerate(tokens) if (x := letters(w))]
            if not found or len(tokens) < words:
                continue
            no, parts = np.array([k for k, _ in found]), [x for _, x in found]
            lo, hi = np.concatenate([[0], no[:-1] + 1]), np.concatenate([no[1:] - 1, [len(tokens) - 1]])
            data = "".join(parts)
            e = np.cumsum([len(x) for x in parts])
            b = e - [len(x) for x in parts]
            # from each word on, to the first with which there are so many
            last = np.searchsorted(hi, lo + words - 1)
            last = last[last < len(no)]
            h = qgrams(data, 1)
            hs.append(h)
            ps.append(np.full(len(h), len(ids), np.int32))
            at.append(np.arange(len(h), dtype=np.int32))
            ids.append(key)
            texts.append(data)
            starts.append(b.tolist())
            ends.append(e.tolist())
            firsts.append(lo.tolist())
            lasts.append(hi.tolist())
            least.append(int((e[last] - b[: len(last)]).min()))
        h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        keys, first, count = np.unique(h[order], return_index=True, return_counts=True)
        present = np.zeros(1 << _FILTER_BITS, bool)
        present[(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        none = np.zeros(0, np.int32)
        gap = "\1" * _PAD
        codes, sizes = _codes(gap + "".join(t + gap for t in texts)), np.array([len(t) for t in texts], dtype=np.int64)
        offsets = _PAD + np.concatenate([[0], np.cumsum(sizes + _PAD)[:-1]]).astype(np.int64) if texts else sizes
        return cls(ids, texts, starts, ends, firsts, lasts, least, keys, first, count, np.concatenate(ps)[order] if hs else none, np.concatenate(at)[order] if hs else none, present, codes, offsets, sizes)

    def candidates(self, data: str, starts: np.ndarray) -> list[tuple[int, int, int]]:
        """(passage, place in it, place in data) of one hit of each run of hits on a diagonal, in all regions that meet
        the bound. data: documents one after the other, beginning at starts, which are multiples of STEP."""
        h = qgrams(data, STEP)
        if not len(h) or not len(self.keys):
            return []
        some = np.flatnonzero(self.present[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        k = np.searchsorted(self.keys, h[some])
        k[k == len(self.keys)] = 0
        same = self.keys[k] == h[some]
        some, k = some[same], k[same]
        n = self.count[k]
        total = int(n.sum())
        if not total:
            return []
        past = np.cumsum(n)
        flat = np.repeat((self.first[k] - past + n).astype(np.int32), n) + np.arange(total, dtype=np.int32)
        passage = self.passage[flat]
        least = np.asarray(self.least, dtype=np.int32)
        needed = np.maximum(1, (least - EDITS - Q + 1) // STEP - EDITS * -(-Q // STEP)).astype(np.int32)
        # a document that shares fewer q-grams with a passage in all has no band that meets the bound
        document = np.searchsorted(starts, some * STEP, "right").astype(np.int32)
        pair = np.repeat((document - 1) * len(self.ids), n) + passage
        enough = np.flatnonzero((np.bincount(pair, minlength=len(starts) * len(self.ids)).reshape(len(starts), -1) >= needed).reshape(-1)[pair])
        passage, place = passage[enough], self.place[flat[enough]].astype(np.int64)
        where = some[np.searchsorted(past, enough, "right")].astype(np.int64) * STEP
        found = []
        for shift in (0, BAND // 2):
            p, b, x, w = _in_bands(passage, place, where, shift)
            last = np.arange(len(p)) + needed[p] - 1
            ok = last < len(p)
            i, j = np.flatnonzero(ok), last[ok]
            good = (p[j] == p[i]) & (b[j] == b[i]) & (x[j] - x[i] <= least[p[i]])
            change = np.zeros(len(p) + 1, np.int64)
            np.add.at(change, i[good], 1)
            np.add.at(change, j[good] + 1, -1)
            inside = np.cumsum(change[:-1]) > 0
            found.append((p[inside], x[inside], w[inside]))
        passage, place, where = (np.concatenate(v) for v in zip(*found, strict=True))
        if not len(place):
            return []
        # q-grams on one diagonal that touch are one run of equal letters: one of them is enough to align from
        diagonal = where - place
        order = np.lexsort((place, diagonal, passage))
        p, g, x, w = passage[order], diagonal[order], place[order], where[order]
        fresh = np.concatenate([[True], (p[1:] != p[:-1]) | (g[1:] != g[:-1]) | (x[1:] - x[:-1] > Q)])
        return list(zip(p[fresh].tolist(), x[fresh].tolist(), w[fresh].tolist(), strict=True))

    def stretches(self, hits: list[tuple[int, int, int]], data: np.ndarray, begins: np.ndarray, ends: np.ndarray, words: int = WORDS) -> list[tuple[int, int] | None]:
        """For each hit (passage, place in it, place in data): first and last word of the longest part of the passage
        through the hit that stands in data with at most EDITS edits; None for fewer than ``words`` words. Words at its
        ends are at least half right. begins, ends: of each hit's document in data."""
        p, x, y = np.array(hits, dtype=np.int64).reshape(-1, 3).T
        at = self.offsets[p]
        right = x + Q + reaches(self.codes, at + x + Q, self.sizes[p] - x - Q, data, y + Q, ends - y - Q, 1)
        left = x - reaches(self.codes, at + x - 1, x, data, y - 1, y - begins, -1)
        enough = (right[::-1] - left).max(axis=0, initial=0) >= np.asarray(self.least, dtype=np.int64)[p]
        return [self._words(int(k), int(v), lo, hi, words) if ok else None for k, v, lo, hi, ok in zip(p, x, left.T.tolist(), right.T.tolist(), enough, strict=True)]

    def _words(self, k: int, x: int, left: list[int], right: list[int], words: int) -> tuple[int, int] | None:
        starts, ends, lo, hi = self.starts[k], self.ends[k], self.firsts[k], self.lasts[k]
        best = None
        for e in range(EDITS + 1):
            i, j = self._first(left, e, starts, ends, x), self._last(right, EDITS - e, starts, ends, x + Q)
            if i <= j < len(hi) and hi[j] - lo[i] + 1 >= words and (best is None or hi[j] - lo[i] > hi[best[1]] - lo[best[0]]):
                best = (i, j)
        return best

    @staticmethod
    def _last(right: list[int], e: int, starts: list[int], ends: list[int], sure: int) -> int:
        """The last word that ends within e edits to the right."""
        j = bisect_right(ends, right[e]) - 1
        while j >= 0 and ends[j] > sure:
            cost = bisect_left(right, ends[j])
            if cost - bisect_left(right, max(sure, starts[j])) <= max(1, (ends[j] - starts[j]) // 2):
                break
            j -= 1
        return j

    @staticmethod
    def _first(left: list[int], e: int, starts: list[int], ends: list[int], sure: int) -> int:
        """The first word that begins within e edits to the left."""
        i = bisect_left(starts, left[e])
        back = [-v for v in left]
        while i < len(starts) and starts[i] < sure:
            cost = bisect_left(back, -starts[i])
            if cost - bisect_left(back, -min(sure, ends[i])) <= max(1, (ends[i] - starts[i]) // 2):
                break
            i += 1
        return i


def _in_bands(passage: np.ndarray, place: np.ndarray, where: np.ndarray, shift: int) -> tuple[np.ndarray, ...]:
    """Hits in order of passage, band of diagonals and place: (passage, band, place, where)."""
    diagonal = where - place + shift
    low = int(diagonal.min(initial=0)) // BAND
    band, off = np.divmod(diagonal - low * BAND, BAND)
    bands, places = int(band.max(initial=0)) + 1, int(place.max(initial=0)) + 1
    if (int(passage.max(initial=0)) + 1) * bands * places * BAND >= 1 << 62:  # too large for one number
        order = np.lexsort((place, band, passage))
        return passage[order], band[order], place[order], where[order]
    packed = np.sort(((passage.astype(np.int64) * bands + band) * places + place) * BAND + off)
    packed, off = np.divmod(packed, BAND)
    packed, x = np.divmod(packed, places)
    p, b = np.divmod(packed, bands)
    return p, b, x, (b + low) * BAND + off - shift + x


def _run(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """Lengths of the common runs of a from i and b from j; step -1: backwards. Both hold characters that the other
    hasn't where no run goes on."""
    out = np.zeros(len(i), np.int64)
    open_ = np.arange(len(i))
    ahead = np.arange(_LOOK) * step
    while len(open_):
        same = a[(i[open_] + step * out[open_])[:, None] + ahead] == b[(j[open_] + step * out[open_])[:, None] + ahead]
        n = np.where(same.all(axis=1), _LOOK, same.argmin(axis=1))
        out[open_] += n
        open_ = open_[n == _LOOK]
    return out


def reaches(a: np.ndarray, i: np.ndarray, n: np.ndarray, b: np.ndarray, j: np.ndarray, m: np.ndarray, step: int = 1, edits: int = EDITS) -> np.ndarray:
    """For 0, 1, ... edits (rows) and each pair of places i in a and j in b: how many letters of a from i on, n at most,
    can be aligned with b from j on, m letters at most; step -1: backwards.

    The band of 2 * edits + 1 diagonals, of each of which only the furthest-reaching cell for a number of edits is kept:
    what the whole matrix would give."""
    none = -edits - 9
    d = np.arange(-edits, edits + 1)
    most = np.minimum(n[:, None], m[:, None] - d)
    at = np.full((len(i), 2 * edits + 3), none, np.int64)  # a column of none at either side
    out = np.zeros((edits + 1, len(i)), np.int64)
    new = np.full((len(i), 2 * edits + 1), none, np.int64)
    new[:, edits] = 0
    for e in range(edits + 1):
        if e:
            # a letter of a misread; one of b too many; one of a missing
            new = np.minimum(np.maximum(np.maximum(at[:, 1:-1] + 1, at[:, :-2]), at[:, 2:] + 1), most)
        r, c = np.nonzero((new >= 0) & (new + d >= 0) & (new < most))
        v = new[r, c]
        new[r, c] = np.minimum(v + _run(a, i[r] + step * v, b, j[r] + step * (v + d[c]), step), most[r, c])
        new[(new < 0) | (new + d < 0)] = none
        at[:, 1:-1] = new
        out[e] = np.maximum(out[e - 1] if e else 0, new.max(axis=1, initial=0))
    return out


def _joined(data: list[str]) -> tuple[str, np.ndarray]:
    """The documents one after the other, and where each begins: at a multiple of STEP, after a gap that no q-gram of a
    passage spans."""
    sizes = np.array([len(x) for x in data], dtype=np.int64)
    room = sizes + _PAD + -(sizes + _PAD) % STEP
    begins = _PAD + np.concatenate([[0], np.cumsum(room)[:-1]])
    return "\0" * _PAD + "".join(x + "\0" * int(r - len(x)) for x, r in zip(data, room, strict=True)), begins


def _longest(parts: list[tuple[int, int]]) -> tuple[int, int]:
    """The longest of the parts, those that overlap taken together."""
    merged: list[list[int]] = []
    for i, j in sorted(parts):
        if merged and i <= merged[-1][1]:
            merged[-1][1] = max(j, merged[-1][1])
        else:
            merged.append([i, j])
    return tuple(max(merged, key=lambda r: r[1] - r[0]))


def find_leaks(df: DataFrame, id_col: str, text_col: str, passages: DataFrame, item_col: str, passage_col: str, words: int = WORDS) -> DataFrame:
    """(doc, item_id, words, passage_words, passage_start, passage_end): each document and item of which at least
    ``words`` consecutive words stand in it with at most EDITS edits; the longest such part of each pair, longer where
    such parts overlap. Places are letters of the passage; marks that stand alone within a part or beside it count as words
    of it, since what a document makes of marks is disregarded.

    Null or short texts on either side have no row; repeated documents and items each have theirs. The passages are
    broadcast in blocks of bounded size; documents are read once for each block and never shuffled. A document's rows
    don't depend on those beside it.
    """
    spark = df.sparkSession
    items = passages.select(F.col(f"`{item_col}`").alias("id"), F.col(f"`{passage_col}`").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK))
    out = None
    schema = StructType([df.schema[id_col].__class__("doc", df.schema[id_col].dataType, True), *struct(SCHEMA).fields])
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k)
        rows = sorted(tuple(r) for r in part.toArrow().to_pandas().itertuples(index=False, name=None))
        shared = spark.sparkContext.broadcast(Passages.build(rows, words))

        def make(shared=shared):
            index = shared.value

            def go(cols):
                if not cols or not index.ids:
                    return []
                keys, texts = cols
                data = [letters(t) if t else "" for t in texts]
                joined, begins = _joined(data)
                hits = index.candidates(joined, begins)
                if not hits:
                    return []
                document = np.searchsorted(begins, [y for _, _, y in hits], "right") - 1
                past = begins + np.array([len(x) for x in data])
                parts_of = index.stretches(hits, _codes(joined), begins[document], past[document], words)
                found: dict[tuple[int, int], list[tuple]] = {}
                for (p, _, _), d, part in zip(hits, document.tolist(), parts_of, strict=True):
                    if part:
                        found.setdefault((d, p), []).append(part)
                out = []
                for (d, p), parts in found.items():
                    i, j = _longest(parts)
                    lo, hi = index.firsts[p], index.lasts[p]
                    out.append((keys[d], index.ids[p], hi[j] - lo[i] + 1, hi[-1] + 1, index.starts[p][i], index.ends[p][j]))
                return out

            return go

        found = map_partitions(df, [id_col, text_col], make, schema)
        out = found if out is None else out.unionByName(found)
    return out
