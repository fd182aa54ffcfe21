"""BPE encoding and decoding of whole texts with a given vocabulary file.

Words are encoded by a contiguous rank array: the part boundaries of the word
and the merge rank of each adjacent pair lie in two short lists; the smallest
rank is found by scanning, its boundary is deleted and the two neighbouring
ranks are looked up anew.  Words of more than ``SCAN_PARTS`` parts use a heap
over the same ranks instead, where repeated scanning would be quadratic.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from queuelake.llm.frames import map_batches

SCAN_PARTS = 96
CACHED_CHUNKS = 400_000
CACHED_WORDS = 200_000
CACHED_CHARS = 48
NO_RANK = 1 << 60

#: Fixed values of the vocabulary's split rule (lower-case contractions,
#: letters, single digits, runs of other characters).
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: str.split() also splits at these four, which are not white space to the rule.
SEPARATORS = regex.compile(r"[\x1c-\x1f]")
WHITE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {b: chr(b) for b in plain}
    for b in range(256):
        letter.setdefault(b, chr(256 + len(letter) - len(plain)))
    return [letter[b] for b in range(256)]


class WordBpe:
    """Encoder and decoder for one vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        if len(self.vocab) > 0xFFFF:
            raise ValueError("ids of more than 16 bits")
        # (left id, right id) -> rank of the merge and the id it makes, in one integer
        self.ranks: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[self.vocab[a] << 16 | self.vocab[b]] = rank << 16 | self.vocab[a + b]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.letters = byte_letters()
        self.cache: dict[str, tuple[str, str]] = {}
        self.words: dict[str, list[int]] = {}

    def _parts(self, word: str) -> list[int]:
        symbols = [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        symbols[-1] += self.suffix
        return [self.vocab[s] for s in symbols]

    def encode_word(self, word: str) -> list[int]:
        ids = self._parts(word)
        if len(ids) > SCAN_PARTS:
            return self._encode_long(ids)
        get = self.ranks.get
        ranks = [get(a << 16 | b, NO_RANK) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) != NO_RANK:
            at = ranks.index(least)
            ids[at] = new = least & 0xFFFF
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = get(new << 16 | ids[at + 1], NO_RANK)
            if at:
                ranks[at - 1] = get(ids[at - 1] << 16 | new, NO_RANK)
        return ids

    def _encode_long(self, ids: list[int]) -> list[int]:
        n, get = len(ids), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := get(ids[i] << 16 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            merge, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = merge & 0xFFFF, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if right < n and (m := get(ids[left] << 16 | ids[right])) is not None:
                    heapq.heappush(heap, (m, left, ids[left], ids[right]))
        return [x for x in ids if x >= 0]

    def _word(self, word: str) -> list[int]:
        ids = self.words.get(word)
        if ids is None:
            ids = self.encode_word(word)
            if len(word) <= CACHED_CHARS:
                if len(self.words) >= CACHED_WORDS:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def _chunk(self, chunk: str) -> tuple[str, str]:
        """Ids and tokens of a run without white space, each space-joined."""
        ids = [i for w in WORD.findall(chunk) for i in self._word(w)]
        out = " ".join(map(str, ids)), " ".join(self.token[i] for i in ids)
        if len(chunk) <= CACHED_CHARS:
            if len(self.cache) >= CACHED_CHUNKS:
                self.cache.clear()
            self.cache[chunk] = out
        return out

    def _plain(self, text: str) -> list[tuple[str, str]]:
        text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        chunks = (c for c in WHITE.split(text) if c) if SEPARATORS.search(text) else text.split()
        cache, make = self.cache, self._chunk
        return [cache.get(c) or make(c) for c in chunks]

    def encode(self, text: str) -> tuple[str, str]:
        """Space-joined decimal ids and the decoded text."""
        out: list[tuple[str, str]] = []
        for piece in self.split_special.split(text) if self.split_special else [text]:
            if piece in self.special:
                out.append((str(self.special[piece]), piece))
            elif piece:
                out.extend(self._plain(piece))
        out = [x for x in out if x[0]]
        return " ".join([x[0] for x in out]), " ".join([x[1] for x in out])

    def decode(self, ids: list[int]) -> str:
        """The vocabulary file has no decoder: tokens joined by spaces."""
        return " ".join(self.token[i] for i in ids)


def bpe_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Token count and digests of ids and decoded text, one row per document.

    A null text is an empty one: no tokens, digests of the empty string.
    Repeated rows give a row each; only doc_id and text are read; an empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(vocabulary)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                ids, decoded = bpe.encode(text or "")
                n.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
