"""Hashes on sequences that polynomials modulo 2**64 take for equal, and exact limits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from towerline.llm import bpe, jaccard_join, substring_dedup, suffix_dedup
from towerline.llm.bytetext import Chunk, Prefix, words
from towerline.llm.queries import vocabulary
from towerline.llm.textstats import base_counts

SCHEMA = "doc_id long, text string"


def thue_morse(n: int, first: str = "a", second: str = "b") -> tuple[str, str]:
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join(second if b else first for b in bits), "".join(first if b else second for b in bits)


def chunk(texts: list[str]) -> Chunk:
    raw = [t.encode() for t in texts]
    return Chunk(None, np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), np.ones(len(raw), bool))


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("size", [1024, 4096, 1 << 16])
def test_thue_morse_sequences_differ(seed, size):
    a, b = thue_morse(size)
    c = chunk([a, b])
    p = Prefix(c.data, seed)
    x, y = p.of(c.offsets[:-1], c.offsets[1:])
    assert x != y and p.sliding(size)[0] == x and p.sliding(size)[-1] == y
    values = np.where(np.frombuffer(a.encode(), np.uint8) == 97, np.uint64(3), np.uint64(12345678901234567))
    other = np.where(values == 3, np.uint64(12345678901234567), np.uint64(3))
    assert Prefix(values, seed, False).of(np.array([0]), np.array([size])) != Prefix(other, seed, False).of(np.array([0]), np.array([size]))


def test_equal_stretches_have_equal_hashes_wherever_they_lie():
    rng = np.random.default_rng(1)
    part = rng.integers(0, 256, 700).astype(np.uint8)
    data = np.concatenate([rng.integers(0, 256, 1000).astype(np.uint8), part, rng.integers(0, 256, 5000).astype(np.uint8), part])
    for seed in (0, 1):
        p = Prefix(data, seed)
        for n in (1, 2, 31, 64, 700):
            assert len(set(p.of(np.array([1000, 6700]), np.array([1000 + n, 6700 + n])).tolist())) == 1
            assert p.sliding(n)[1000] == p.of(np.array([6700]), np.array([6700 + n]))[0]


def test_long_words_and_lines_are_told_apart(spark):
    a, b = thue_morse(2048)
    rest = " ".join(f"w{i}" for i in range(49))
    out = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeated_passages(spark.createDataFrame([(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, f"{a} {rest}")], SCHEMA)).collect()}
    assert out == {1: 0, 2: 0, 3: 50}
    out = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeated_bytes(spark.createDataFrame([(1, a), (2, b)], SCHEMA), keep="none").collect()}
    both = [(1, a), (2, b)]
    seen: dict[str, int] = {}
    for _, t in both:
        for i in range(len(t) - 199):
            seen[t[i : i + 200]] = seen.get(t[i : i + 200], 0) + 1
    cover = {k: {j for i in range(len(t) - 199) if seen[t[i : i + 200]] > 1 for j in range(i, i + 200)} for k, t in both}
    assert out == {k: len(v) for k, v in cover.items()}
    tail = " one two three four five six seven"
    c = chunk([f"{a}{tail}\n{b}{tail}"])
    got = base_counts(c, words(c))
    assert got["n_dup_lines"].tolist() == [0] and got["n_repeat_words"].tolist() == [0]
    links = {r["doc_id"]: r["n_links"] for r in jaccard_join.near_duplicates(spark.createDataFrame([(1, a), (2, b)], SCHEMA)).collect()}
    assert links == {1: 0, 2: 0}


def test_threshold_is_exact_for_large_sets():
    assert jaccard_join.reaches(800_000, 1_000_000, 0.8) and not jaccard_join.reaches(800_000, 1_000_001, 0.8)
    both = np.array([4, 3, 800_000])
    assert jaccard_join.reaches(both, np.array([5, 4, 1_000_001]), 0.8).tolist() == [True, False, False]


def test_every_code_point_is_encoded_as_the_library_does():
    import tokenizers

    path = vocabulary()
    library, ours = tokenizers.Tokenizer.from_file(path), bpe.WordBpe(path)
    library.no_truncation()
    library.no_padding()
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    bad = []
    for lo in range(0, len(points), 2048):
        block = points[lo : lo + 2048]
        text = " ".join(f"a{chr(c)}b {chr(c)}1" for c in block)
        if library.encode(text, add_special_tokens=False).ids != ours.encode(text):
            bad += [c for c in block if library.encode(f"a{chr(c)}b {chr(c)}1", add_special_tokens=False).ids != ours.encode(f"a{chr(c)}b {chr(c)}1")]
    assert bad == []


def test_very_long_texts_pass_whole(spark):
    """A text beyond a chunk, a word beyond a thousand letters, a line of megabytes."""
    rng = np.random.default_rng(5)
    long = " ".join(f"t{i}" for i in rng.integers(0, 10**9, 150_000))
    rows = [(1, long), (2, "x" * 3000 + " " + long[: len(long) // 2]), (3, "y" * 700_000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.remove_repeated_passages(docs).collect()}
    words_2 = rows[1][1].split(" ")
    # the last word of document 2 may be cut
    shared = len(words_2) - 1 - (long.split(" ")[len(words_2) - 2] != words_2[-1])
    assert out == {1: (150_000, 0), 2: (len(words_2), shared), 3: (1, 0)}
    got = {r["doc_id"]: r["n_tokens"] for r in bpe.tokenize(docs.filter(F.col("doc_id") == 3), vocabulary()).collect()}
    assert got[3] > 0




def test_a_piece_is_merged_once_whatever_words_hold_it(monkeypatch):
    merged = []
    merge = bpe.WordBpe.merge
    monkeypatch.setattr(bpe.WordBpe, "merge", lambda self, parts: merged.append("".join(parts)) or merge(self, parts))
    coder = bpe.WordBpe(vocabulary())
    coder.encode_joined("Straße straße, (straße) straße's 'straße'")
    assert len(merged) == len(set(merged))


def test_latin_pieces_are_the_pieces():
    signs = [chr(c) for c in range(256)]
    for a in signs:
        for b in [*signs, "'s", "'re", "x'll"]:
            assert bpe.LATIN_PIECES.findall(a + b) == bpe.PIECES.findall(a + b), (a, b)
