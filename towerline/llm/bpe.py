"""Encoding and decoding with a given BPE vocabulary of words with end marks.

The vocabulary file (its path is a parameter; it is never trained here) gives the merges.
A text is cut at the special tokens, normalised (NFC, lower case), split into letter runs,
single digits, and runs of other signs, and each piece is merged with a contiguous rank
array: the part boundaries and the ranks of adjacent pairs lie side by side; the least
rank is found by a scan, its boundary is deleted, and the two neighbouring ranks are
refreshed.  Pieces beyond ``SCAN`` parts take a heap with the same order of merges, so a
very long run does not cost its length squared.  Words repeat, and the pieces of different
words do, so each worker keeps a bounded table of those that it has met.

Cases: null and empty texts have no tokens; extra columns are ignored; repeated ids give
repeated rows.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCAN = 128
REMEMBERED = 400_000
_BIG = 1 << 60

#: Code points (first, last) that are letters or numbers to newer tables and not
#: to those of the splitter.
NEWER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F),
    (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128),
    (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
_NEWER = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in NEWER)
#: The pattern of the vocabulary's splitter.
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{_NEWER}]]+|[\p{{N}}--[{_NEWER}]]|[^\p{{White_Space}}[[\p{{L}}\p{{N}}]--[{_NEWER}]]]+", regex.VERSION1)
#: The same for texts of signs below U+0100 (a plainer pattern, so a faster one).
_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", "\x09-\x0d \x85\xa0"
LATIN_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
#: Capitals with a small letter that the library's tables know and Python's do not.
CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
CAPITALS |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 27 for c in range(0x16EA0, 0x16EB9)}
#: Signs at which str.split cuts although they are no white space to the splitter.
_ODD_SPACES = regex.compile("[\x1c-\x1f]")
_END = "</w>"


def byte_signs() -> list[str]:
    """The printable sign of each byte: itself if printable in Latin-1, else the next free
    code point from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + rest.index(b)) for b in range(256)]


def is_latin(text: str) -> bool:
    """Whether all signs lie below U+0100."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _joined(got: list[tuple[str, str]]) -> tuple[str, str]:
    """Ids and tokens of several stretches; one without a token leaves no space."""
    return " ".join([i for i, _ in got if i]), " ".join([t for i, t in got if i])


class Remembered(dict):
    """Results of a function for the arguments met last: at most ``REMEMBERED``, of 64 signs at most."""

    def __init__(self, of: Callable[[str], tuple[str, str]]):
        super().__init__()
        self.of = of

    def __missing__(self, x: str) -> tuple[str, str]:
        got = self.of(x)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(x) <= 64:
            self[x] = got
        return got


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {m: i for i, m in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.signs = byte_signs()
        longest_first = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(longest_first)})") if longest_first else None
        self.pieces, self.known = Remembered(self._piece), Remembered(self.word)

    def merge(self, parts: list[str]) -> list[str]:
        """Merge adjacent parts, least rank first, the leftmost among equals."""
        if len(parts) > SCAN:
            return self._merge_long(parts)
        rank = self.ranks.get
        near = [rank(p, _BIG) for p in zip(parts, parts[1:])]
        while near and (least := min(near)) != _BIG:
            i = near.index(least)
            new = parts[i] = parts[i] + parts.pop(i + 1)
            del near[i]
            if i:
                near[i - 1] = rank((parts[i - 1], new), _BIG)
            if i < len(near):
                near[i] = rank((new, parts[i + 1]), _BIG)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        n, rank = len(parts), self.ranks.get
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, p[0], p[1]) for i, p in enumerate(zip(parts, parts[1:])) if (r := rank(p)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, ""
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (r := rank((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p]

    def _piece(self, piece: str) -> tuple[str, str]:
        parts = [self.signs[b] for b in piece.encode("utf-8")]
        parts[-1] += _END
        tokens = [t for t in self.merge(parts) if t in self.ids]
        return " ".join([str(self.ids[t]) for t in tokens]), " ".join(tokens)

    def word(self, word: str) -> tuple[str, str]:
        """Ids and tokens, each joined by spaces, of a normalised stretch without space."""
        found = (LATIN_PIECES if is_latin(word) else PIECES).findall(word)
        return self.pieces[found[0]] if len(found) == 1 else _joined([self.pieces[p] for p in found])

    def encode_joined(self, text: str) -> tuple[str, str]:
        """Decimal ids joined by spaces, and the decoded text."""
        got: list[tuple[str, str]] = []
        known = self.known
        for part in self.cut.split(text) if self.cut and "<|" in text else (text,):
            if part in self.special:
                got.append((str(self.special[part]), part))
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
                if not is_latin(part):
                    part = part.replace("Σ", "σ").translate(CAPITALS)
            part = part.lower()
            got += [known[w] for w in (PIECES.findall(part) if _ODD_SPACES.search(part) else part.split())]
        return _joined(got)

    def encode(self, text: str) -> list[int]:
        joined = self.encode_joined(text)[0]
        return [int(x) for x in joined.split(" ")] if joined else []

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens of the ids joined by spaces (the vocabulary names no other decoder)."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


@lru_cache(2)
def loaded(path: str) -> WordBpe:
    """Read once in each worker, with the words that it has met."""
    return WordBpe(path)


def tokenize(documents: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> doc_id, n_tokens, ids (decimal, joined by spaces), decoded.

    vocabulary: path of the vocabulary file on every node.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(vocabulary)
        for f in frames:
            for at in range(0, len(f), 256):
                part = f.iloc[at : at + 256]
                both = [bpe.encode_joined(t) if t else ("", "") for t in part["text"]]
                yield pd.DataFrame(
                    {"doc_id": part["doc_id"].to_numpy(), "n_tokens": [i.count(" ") + 1 if i else 0 for i, _ in both], "ids": [i for i, _ in both], "decoded": [d for _, d in both]}
                )

    return documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        run, f"doc_id {dict(documents.dtypes)[id_col]}, n_tokens long, ids string, decoded string"
    )


def digests(tokenized: DataFrame) -> DataFrame:
    return tokenized.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


