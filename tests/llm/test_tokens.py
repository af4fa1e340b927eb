import random

import pytest
from tokenizers import Tokenizer
from tokenizers.models import Unigram as Library

from inkspan.llm import packing, tokens

TEXTS = ["", "Hello world", "naïve😀 ſ \n\t q", "  a  b\n\n c", "x" * 5000, "8,000 to 3,000; it's"]


def test_double_array_trie():
    keys = [b"a", b"ab", b"abc", b"b", "é".encode(), b"\xff\x00", b"bca"]
    trie = tokens.DoubleArrayTrie(keys)
    for text in (b"abcd", b"bcab", "éa".encode(), b"\xff\x00", b"", b"zzz"):
        want = [(len(k), n) for n, k in sorted(enumerate(keys), key=lambda x: len(x[1])) if text.startswith(k)]
        assert trie.prefixes(text, 0) == want


def test_viterbi_counts_equal_the_library():
    rng = random.Random(0)
    vocab = {c: -rng.uniform(5, 9) for c in "abcd▁"}
    while len(vocab) < 200:
        vocab["".join(rng.choice("abcdeé▁") for _ in range(rng.randint(2, 6)))] = -rng.uniform(2, 12)
    library = Tokenizer(Library([("<unk>", 0.0), *vocab.items()], unk_id=0, byte_fallback=False))
    mine = tokens.Unigram(list(vocab.items()), prefix=False)
    for _ in range(500):
        s = "".join(rng.choice("abcdeéz▁") for _ in range(rng.randint(1, 20)))
        assert mine.count(s) == len(library.encode(s).ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_vocabularies(name):
    counter = tokens.Vocabulary.load(f"{tokens.TOKENIZERS}/{name}").counter()
    counts = [counter.count(t) for t in TEXTS]
    assert counts[0] == 0 and counter.count(None) == 0 and all(n > 0 for n in counts[1:])
    if name.startswith("byte_bpe_50k"):
        other = tokens.Vocabulary.load(f"{tokens.TOKENIZERS}/byte_bpe_50k.json").counter()
        assert counts == [other.count(t) for t in TEXTS]


def test_counts_and_slices(spark):
    rows = [(1, t, "S", "en", None) for t in TEXTS] + [(2, None, None, "", "d")]
    df = spark.createDataFrame(rows, "id int, tokens string, source string, language string, domain string")
    counted = tokens.token_counts(df.withColumnRenamed("tokens", "body"), ["id", "source", "language", "domain"], "body")
    assert counted.count() == 7
    budget = tokens.token_budget(counted).collect()
    total = sum(r.tokens for r in counted.collect())
    for part in {r.slice for r in budget}:
        assert sum(r.tokens for r in budget if r.slice == part) == total
        assert sum(r.texts for r in budget if r.slice == part) == 7
    assert tokens.token_budget(counted.where("false")).count() == 0


def test_language_codes(spark):
    df = spark.createDataFrame([("English",), ("EN",), (None,), ("",), ("und",), ("xx",)], "l string")
    assert [r.c for r in df.select(tokens.language_code(df.l).alias("c")).collect()] == ["en", "en", "und", "und", "und", "xx"]


def assigned_bins(plan, histogram):
    bins: dict[int, int] = {}
    for size, n in histogram.items():
        for rank in range(n):
            b, opened = plan.bin_of(size, rank)
            assert size <= opened in plan.lengths[size]
            bins[b] = bins.get(b, 0) + size
    return bins


def test_plan_fills_every_bin_within_the_capacity():
    rng = random.Random(1)
    for capacity, lengths in ((64, (16, 32, 64)), (100, (100,)), (2048, packing.LENGTHS)):
        for _ in range(10):
            histogram = {rng.randint(1, capacity): rng.randint(1, 30) for _ in range(rng.randint(1, 40))}
            plan = packing.plan_bins(histogram, capacity, lengths)
            bins = assigned_bins(plan, histogram)
            assert max(bins.values()) <= capacity and sorted(bins) == list(range(plan.n_bins))
            assert sum(bins.values()) == sum(s * n for s, n in histogram.items())


def test_packing_is_near_the_bound():
    rng = random.Random(2)
    histogram: dict[int, int] = {}
    for _ in range(20_000):
        s = min(2048, max(1, int(rng.lognormvariate(5.5, 0.9))))
        histogram[s] = histogram.get(s, 0) + 1
    plan = packing.plan_bins(histogram)
    assert sum(s * n for s, n in histogram.items()) / (2048 * plan.n_bins) > 0.98


def test_pack_frames(spark):
    rows = [(k, 300) for k in range(40)] + [(100, 5000), (101, 0), (102, None), (7, 300), (103, 2048)]
    df = spark.createDataFrame(rows, "bin int, size int").repartition(5)
    got = packing.pack(df, "bin", "size").collect()
    pieces = {(r.item, r.piece_no): r for r in got}
    assert [pieces[100, k].size for k in (1, 2, 3)] == [2048, 2048, 904] and pieces[100, 3].start == 4096
    assert pieces[101, 1].bin is None and pieces[102, 1].bin is None and pieces[103, 1].size == 2048
    assert len(got) == len(rows) + 2
    used: dict[int, int] = {}
    for r in got:
        if r.bin is not None:
            used[r.bin] = used.get(r.bin, 0) + r.size
    assert max(used.values()) <= 2048 and len(used) <= 11
    assert all(r.opened in packing.LENGTHS and r.opened >= used[r.bin] for r in got if r.bin is not None)
    bins = packing.bins_of(packing.pack(df, "bin", "size")).collect()
    assert {r.bin: r.used for r in bins} == used and all(r.capacity >= r.used for r in bins)
    assert packing.pack(df.where("false"), "bin", "size").count() == 0


def test_best_path_over_ranked_pieces(spark, sf):
    """The estimate of a byte-pair vocabulary's counts: near what its own library counts over a corpus, not in each text."""
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [{r.doc_id: r.tokens for r in tokens.token_counts(df, ["doc_id"], "text", tokens.PIECES, best_path=b).collect()} for b in (False, True)]
    own, estimate = (sum(r.values()) for r in rows)
    assert rows[0].keys() == rows[1].keys() and abs(estimate / own - 1) < 0.1
