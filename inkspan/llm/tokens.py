"""Token counts under existing vocabularies, without making the tokens.

Unigram vocabularies are counted by Viterbi over a double-array trie: text is cut into segments across which no token
reaches, and a segment's count is computed once and remembered. Byte-pair vocabularies, whose merges no best path
reproduces, are counted by their own library.
"""

from __future__ import annotations

import base64
import math
from array import array
from dataclasses import dataclass, field

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkspan.llm.arrow import kept_fields, map_partitions, struct

#: Where the public vocabularies are; always a parameter.
TOKENIZERS = "/opt/tokenizers"
DEFAULT, PIECES = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", f"{TOKENIZERS}/piece_bpe_32k.model"
#: Fixed value: how the byte-pair vocabularies cut text beforehand.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Segments that a worker remembers at most, and the length from which on they aren't.
REMEMBERED, LONGEST = 400_000, 64
#: Places tried for a node of the trie from which on the search begins further on next time.
TRIES = 64


class DoubleArrayTrie:
    """A trie over bytes in two arrays: a node's child by byte c is base[node] + c if check says so."""

    def __init__(self, keys: list[bytes]):
        order = sorted((k, i) for i, k in enumerate(keys) if k)
        self.base, self.check, self.value = array("i", [0] * 512), array("i", [-1] * 512), array("i", [-1] * 512)
        self.check[0] = 0
        self._free = 1
        # (node, first key, past last key, depth): the children of a node are placed together
        todo = [(0, 0, len(order), 0)]
        while todo:
            node, lo, hi, depth = todo.pop()
            if lo < hi and len(order[lo][0]) == depth:
                self.value[node] = order[lo][1]
                lo += 1
            groups, k = [], lo
            while k < hi:
                c, m = order[k][0][depth], k
                while k < hi and order[k][0][depth] == c:
                    k += 1
                groups.append((c + 1, m, k))
            if not groups:
                continue
            b = self._place([c for c, _, _ in groups])
            self.base[node] = b
            for c, m, n in groups:
                self.check[b + c] = node
                todo.append((b + c, m, n, depth + 1))

    def _place(self, codes: list[int]) -> int:
        b = max(1, self._free - codes[0])
        tries = 0
        while True:
            need = b + 258
            if need > len(self.check):
                more = max(need - len(self.check), len(self.check))
                self.base.extend([0] * more)
                self.check.extend([-1] * more)
                self.value.extend([-1] * more)
            if all(self.check[b + c] < 0 for c in codes):
                break
            b += 1
            tries += 1
        if tries > TRIES:
            self._free = b  # crowded: the few holes before aren't looked at again
        while self._free < len(self.check) and self.check[self._free] >= 0:
            self._free += 1
        return b

    def prefixes(self, data: bytes, at: int) -> list[tuple[int, int]]:
        """(end, key number) of all keys that data has at ``at``."""
        out, node = [], 0
        base, check, value = self.base, self.check, self.value
        for k in range(at, len(data)):
            child = base[node] + data[k] + 1
            if base[node] <= 0 or child >= len(check) or check[child] != node:
                break
            node = child
            if value[node] >= 0:
                out.append((k + 1, value[node]))
        return out


@dataclass
class Unigram:
    """Count-only Viterbi: tokens of the likeliest path, the path itself not kept."""

    pieces: list[tuple[str, float]]
    byte_fallback: bool = False
    space: str = "▁"
    prefix: bool = True
    fuse_unknown: bool = True
    trie: DoubleArrayTrie = field(init=False)

    def __post_init__(self):
        self.trie = DoubleArrayTrie([p.encode() for p, _ in self.pieces])
        self.scores = [s for _, s in self.pieces]
        self.unknown = min(self.scores, default=0.0) - 10.0

    def segments(self, text: str) -> list[str]:
        """The text with its spaces marked, cut before each mark; runs of marks stay with the word that follows."""
        if not text:
            return []
        t = (self.space if self.prefix else "") + text.replace(" ", self.space)
        return regex.findall(f"{self.space}+[^{self.space}]*|[^{self.space}]+", t)

    def count(self, segment: str) -> int:
        data = segment.encode()
        n = len(data)
        best = [-math.inf] * (n + 1)
        tokens = [0] * (n + 1)
        open_ = [False] * (n + 1)  # whether the path ends in an unknown character
        best[0] = 0.0
        for at in range(n):
            if best[at] == -math.inf or data[at] & 0xC0 == 0x80:
                continue
            width = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
            single = False
            for end, k in self.trie.prefixes(data, at):
                single |= end == at + width
                s = best[at] + self.scores[k]
                if s > best[end]:
                    best[end], tokens[end], open_[end] = s, tokens[at] + 1, False
            if not single:
                end = at + width
                s = best[at] + self.unknown
                if s > best[end]:
                    more = width if self.byte_fallback else 0 if self.fuse_unknown and open_[at] else 1
                    best[end], tokens[end], open_[end] = s, tokens[at] + more, True
        return tokens[n]


@dataclass
class Vocabulary:
    """A vocabulary file's bytes and kind, small enough to be sent to all workers."""

    kind: str
    data: bytes

    @classmethod
    def load(cls, path: str, best_path: bool = False) -> Vocabulary:
        """best_path: the pieces of a byte-pair vocabulary as a unigram one, by their ranks (see ranked)."""
        with open(path, "rb") as f:
            data = f.read()
        if best_path:
            return cls("ranked", data)
        if path.endswith(".tiktoken"):
            return cls("ranks", data)
        if path.endswith(".json"):
            return cls("json", data)
        return cls("pieces", data)

    def counter(self) -> Counter:
        return Counter(self)


def ranked(pieces: list[str]) -> list[tuple[str, float]]:
    """Pieces in order of rank with log probabilities by Zipf's law: the pieces of a byte-pair vocabulary are ranked by
    how often their merge was the commonest, and have no probabilities of their own."""
    total = math.log(sum(1 / k for k in range(1, len(pieces) + 1))) if pieces else 0.0
    return [(p, -math.log(k) - total) for k, p in enumerate(pieces, 1)]


class Counter:
    """Counts tokens of texts. Unigram counts are remembered by segment; byte-pair merges reach across words (runs of
    spaces, digits and marks), so their libraries get whole texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.known: dict[str, int] = {}
        self.unigram: Unigram | None = None
        if vocabulary.kind == "ranks":
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.data.splitlines())}
            encoding = tiktoken.Encoding("own", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.whole = lambda t: len(encoding.encode_ordinary(t))
        elif vocabulary.kind == "json":
            from tokenizers import Tokenizer

            t = Tokenizer.from_str(vocabulary.data.decode())
            t.encode_special_tokens = True  # their strings in a text are ordinary text
            self.whole = lambda s: len(t.encode(s, add_special_tokens=False).ids)
        else:
            from sentencepiece import SentencePieceProcessor
            from sentencepiece import sentencepiece_model_pb2 as pb

            model = pb.ModelProto()
            model.ParseFromString(vocabulary.data)
            sp = SentencePieceProcessor(model_proto=vocabulary.data)
            if vocabulary.kind == "ranked":
                self.unigram = Unigram(ranked([p.piece for p in model.pieces if p.type in (1, 4)]), model.trainer_spec.byte_fallback, prefix=model.normalizer_spec.add_dummy_prefix)
                self.prepare = lambda t: t
            elif model.trainer_spec.model_type == 1:
                mapped = bool(model.normalizer_spec.precompiled_charsmap)
                self.prepare = sp.normalize if mapped else lambda t: t
                kept = [(p.piece, p.score) for p in model.pieces if p.type in (1, 4)]
                self.unigram = Unigram(kept, model.trainer_spec.byte_fallback, prefix=model.normalizer_spec.add_dummy_prefix and not mapped)
            else:
                self.whole = lambda t: len(sp.encode(t, num_threads=1))

    def count(self, text: str | None) -> int:
        """Tokens of one text; of null and empty texts none."""
        if not text:
            return 0
        if self.unigram is None:
            return self.whole(text)
        known, total = self.known, 0
        for s in self.unigram.segments(self.prepare(text)):
            n = known.get(s)
            if n is None:
                n = self.unigram.count(s)
                if len(s) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[s] = n
            total += n
        return total


_OPEN: dict = {}


def _counter(shared) -> Counter:
    if _OPEN.get("of") is not shared:
        _OPEN.clear()
        _OPEN.update(of=shared, counter=shared.value.counter())
    return _OPEN["counter"]


def token_counts(df: DataFrame, keep: list[str], text_col: str, vocabulary: str = DEFAULT, best_path: bool = False) -> DataFrame:
    """The columns ``keep`` and ``tokens bigint`` of every row. Null and empty texts have 0. No shuffle.

    best_path: counted by Viterbi over the pieces of a file of pieces that is no unigram vocabulary, which only estimates
    what its own library counts."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary, best_path))
    fields = kept_fields(df, keep, "tokens bigint")

    def make():
        counter = _counter(shared)

        def go(cols):
            if not cols:
                return []
            return list(zip(*cols[:-1], [counter.count(t) for t in cols[-1]], strict=True))

        return go

    return map_partitions(df, [*keep, text_col], make, StructType([*fields, *struct("tokens bigint").fields]))


#: Slices of which totals come out: each dimension, and all together.
SLICES = (("source",), ("language",), ("domain",), ("source", "language", "domain"))
#: How languages are named in records.
LANGUAGE_CODES = {"english": "en", "french": "fr", "german": "de", "spanish": "es", "italian": "it", "portuguese": "pt", "dutch": "nl", "polish": "pl", "latin": "la"}


def language_code(x):
    """A language's code, lower case: null, empty and ``und`` give ``und``; names become codes."""
    low = F.lower(F.trim(x))
    codes = F.create_map(*[F.lit(v) for kv in [*LANGUAGE_CODES.items(), ("", "und"), ("unknown", "und")] for v in kv])
    return F.coalesce(F.try_element_at(codes, low), low, F.lit("und"))


def token_budget(counted: DataFrame) -> DataFrame:
    """(slice, source, language, domain, texts, empty_texts, tokens, mean_tokens) from source, language, domain, tokens.

    The dimensions of a slice that it isn't by are null; null values of a dimension count as ``unknown``.
    """
    dims = ("source", "language", "domain")
    clean = counted.select(*[F.coalesce(F.col(d), F.lit("unknown")).alias(d) for d in dims], "tokens")
    # one small row for each combination of the dimensions leaves a partition; the slices are made of these
    cells = clean.groupBy(*dims).agg(F.count("*").alias("texts"), F.count_if(F.col("tokens") == 0).alias("empty_texts"), F.sum("tokens").alias("tokens"))
    each = F.explode(F.array(*[F.struct(F.lit("+".join(s)).alias("slice"), *[(F.col(d) if d in s else F.lit(None).cast("string")).alias(d) for d in dims]) for s in SLICES]))
    spread = cells.select(each.alias("s"), "texts", "empty_texts", "tokens").select("s.*", "texts", "empty_texts", "tokens")
    sums = spread.groupBy("slice", *dims).agg(*[F.sum(c).alias(c) for c in ("texts", "empty_texts", "tokens")])
    return sums.withColumn("mean_tokens", F.col("tokens") / F.col("texts"))
