"""Groups of spelling variants: words of one edit, found through Bloom filters.

A word is a run of Latin letters (A-Z, a-z and U+00C0-U+00FF, one byte each in
Latin-1) with A-Z lower-cased.  The words of a table, with their counts, are
the vocabulary.  Blocked Bloom filters of it, one shard for each length, are
built in slices by Spark and broadcast; their size is bounded whatever the
vocabulary (``filter_bytes``: beyond it they only let more false ones through).
Every word's edits are generated as hashes, whole matrices of words at once,
and probed: deletions against the shard of the length below, replacements
against the shard of the same length.  An insertion is the deletion of the
longer word, and a replacement by a smaller letter that of the smaller word,
so each pair is generated once and counted for both of its words.  Only edits
that the filters let through become strings and are shuffled to an exact join
with the vocabulary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelake.llm.frames import written
from queuelake.llm.words import mix64
from queuelake.session import ship_package

MIN_LETTERS = 6
MIN_COUNT = 5
FORM_RATIO = 5
DAMAGE_ONE_IN = 199

LONGEST_SHARD = 64
BITS_PER_WORD = 16
FILTER_BYTES = 64 << 20
BLOCK_BITS = 512
SLICE_BLOCKS = 1024
PROBES = 6
CHUNK = 1 << 20

RUN = "[a-zÀ-ÿ]+"

_RNG = np.random.default_rng(19700101)
_LETTER = _RNG.integers(1, 2**63, size=256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def letter_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run): every maximal run of letters of every whole text."""
    return docs.select("doc_id", F.explode(F.regexp_extract_all(lower_ascii(F.col("text").cast("string")), F.lit(RUN), 0)).alias("run"))


def damaged(doc_id: Column, run: Column, one_in: int = DAMAGE_ONE_IN) -> Column:
    """The run without one code point where the checksum of ``doc_id:run`` says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def count_words(words: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of a table of words, partial counts before the shuffle."""
    kept = words.where(F.length("word") >= min_letters)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


# ---- filters


class Layout(NamedTuple):
    """Where the shard of each length lies, in blocks."""

    first: np.ndarray  # by min(length, LONGEST_SHARD)
    blocks: np.ndarray

    @property
    def total(self) -> int:
        return int(self.blocks.sum())


def layout(lengths: dict[int, int], filter_bytes: int = FILTER_BYTES) -> Layout:
    """Shards in proportion to their words, within ``filter_bytes`` in all (and
    a block for each length at least)."""
    n = np.zeros(LONGEST_SHARD + 1, dtype=np.int64)
    for length, words in lengths.items():
        n[min(length, LONGEST_SHARD)] += words
    bits = min(BITS_PER_WORD, 8 * filter_bytes / max(1, int(n.sum())))
    blocks = np.where(n > 0, np.maximum(1, np.ceil(n * bits / BLOCK_BITS)), 0).astype(np.int64)
    return Layout(np.cumsum(blocks) - blocks, blocks)


def _block(h: np.ndarray, length: int, at: Layout) -> np.ndarray:
    k = min(length, LONGEST_SHARD)
    return int(at.first[k]) + (((h >> _U(32)) * _U(int(at.blocks[k]))) >> _U(32)).astype(np.int64)


def _bits(h: np.ndarray) -> np.ndarray:
    """The bits of each hash in its block, PROBES of nine bits each."""
    return mix64(h ^ _U(0x5851F42D4C957F2D))


def _matrices(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, letters) of the words of each length, at most ``CHUNK`` letters at
    once but for a single longer word."""
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_length.setdefault(len(w), []).append(k)
    for length, rows in by_length.items():
        step = max(1, CHUNK // length)
        for a in range(0, len(rows), step):
            part = rows[a : a + step]
            letters = np.frombuffer("".join(words[k] for k in part).encode("latin-1"), dtype=np.uint8)
            yield np.array(part), letters.reshape(len(part), length)


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, _BASE, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def raw_hash(letters: np.ndarray) -> np.ndarray:
    return (_LETTER[letters] * _powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


def _slices(vocabulary: DataFrame, at: Layout) -> DataFrame:
    """(slice, bits): the filter in pieces, each built from its own words."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in _matrices(batch.column(0).to_pylist()):
                h = mix64(raw_hash(letters))
                yield pa.RecordBatch.from_pydict({"block": _block(h, letters.shape[1], at), "h": _bits(h).view(np.int64)})

    def build(rows: pa.Table) -> pa.Table:
        block, h = rows.column("block").to_numpy(), rows.column("h").to_numpy().view(np.uint64)
        piece = int(block[0]) // SLICE_BLOCKS
        bits = np.zeros(SLICE_BLOCKS * BLOCK_BITS, dtype=np.uint8)
        for k in range(PROBES):
            bits[(block - piece * SLICE_BLOCKS) * BLOCK_BITS + ((h >> _U(9 * k)) & _U(511)).astype(np.int64)] = 1
        return pa.table({"slice": pa.array([piece], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    placed = vocabulary.select("word").mapInArrow(place, "block long, h long")
    return placed.groupBy(F.floor(F.col("block") / SLICE_BLOCKS)).applyInArrow(build, "slice long, bits binary")


def build_filter(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> tuple[Layout, np.ndarray]:
    """The filters' layout and bits (8 words of 64 bits a block).  What comes to
    the driver is bounded by ``filter_bytes``, and by LONGEST_SHARD counts."""
    shard = F.least(F.length("word"), F.lit(LONGEST_SHARD))
    at = layout({r.shard: r.n for r in vocabulary.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()}, filter_bytes)
    flat = np.zeros((math.ceil(at.total / SLICE_BLOCKS) * SLICE_BLOCKS * BLOCK_BITS) // 64, dtype=np.uint64)
    size = SLICE_BLOCKS * BLOCK_BITS // 64
    for r in _slices(vocabulary, at).toLocalIterator():
        flat[r.slice * size : (r.slice + 1) * size] = np.frombuffer(bytes(r.bits), dtype=np.uint64)
    return at, flat


def _admitted(h: np.ndarray, length: int, at: Layout, flat: np.ndarray) -> np.ndarray:
    """Indices of the raw hashes whose word of ``length`` may be in the vocabulary."""
    if not at.blocks[min(length, LONGEST_SHARD)]:
        return np.zeros(0, dtype=np.int64)
    h = mix64(h)
    block, bits, left = _block(h, length, at) * 8, _bits(h), np.arange(len(h))
    for k in range(PROBES):
        bit = (bits >> _U(9 * k)) & _U(511)
        ok = (flat[block + (bit >> _U(6)).astype(np.int64)] >> (bit & _U(63))) & _U(1) == 1
        left, block, bits = left[ok], block[ok], bits[ok]
    return left


# ---- edits


def _strings(letters: np.ndarray) -> list[str]:
    if not letters.size:
        return []
    return np.ascontiguousarray(letters.astype(np.uint32)).view(f"<U{letters.shape[1]}").ravel().tolist()


def _edits(letters: np.ndarray, alphabet: np.ndarray, min_letters: int, at: Layout, flat: np.ndarray) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(rows, near words) that the filters let through, of a matrix of words."""
    m, length = letters.shape
    power = _powers(length)
    term = _LETTER[letters] * power
    whole = term.sum(axis=1, dtype=np.uint64)
    wide = max(1, CHUNK // m)  # positions at once
    if length > min_letters:
        back = _U(pow(_BASE, -1, 2**64))
        upto = np.cumsum(term, axis=1, dtype=np.uint64)
        # the first of equal letters stands for all of them
        differs = np.ones((m, length), dtype=bool)
        differs[:, 1:] = letters[:, 1:] != letters[:, :-1]
        row, pos = np.nonzero(differs)
        h = upto[row, pos] - term[row, pos] + (whole[row] - upto[row, pos]) * back
        ok = _admitted(h, length - 1, at, flat)
        for a in range(0, len(ok), wide):
            r, p = row[ok[a : a + wide]], pos[ok[a : a + wide]]
            keep = np.ones((len(r), length), dtype=bool)
            keep[np.arange(len(r)), p] = False
            yield r, _strings(letters[r][keep].reshape(len(r), length - 1))
    for c in alphabet.tolist():
        row, pos = np.nonzero(letters < c)
        h = whole[row] - term[row, pos] + _LETTER[c] * power[pos]
        ok = _admitted(h, length, at, flat)
        for a in range(0, len(ok), wide):
            r, p = row[ok[a : a + wide]], pos[ok[a : a + wide]]
            near = letters[r]
            near[np.arange(len(r)), p] = c
            yield r, _strings(near)


def near_words(vocabulary: DataFrame, min_letters: int = MIN_LETTERS, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): both directions of all pairs of ``vocabulary``
    (word, n) that differ by one inserted, deleted or replaced letter."""
    spark = vocabulary.sparkSession
    ship_package(spark)
    at, flat = build_filter(vocabulary, filter_bytes)
    # at most 90 letters: one bit each
    masks = [F.bit_or(F.when(F.contains("word", F.lit(chr(c))), 1).otherwise(0)).alias(f"c{c}") for c in [*range(0x61, 0x7B), *range(0xC0, 0x100)]]
    used = vocabulary.agg(*masks).first().asDict()
    alphabet = np.array([int(k[1:]) for k, v in used.items() if v], dtype=np.int64)
    shared = spark.sparkContext.broadcast((at, flat, alphabet))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, bits, letters_used = shared.value
        for batch in batches:
            n = batch.column(1).to_numpy()
            words = batch.column(0).to_pylist()
            for rows, letters in _matrices(words):
                for row, near in _edits(letters, letters_used, min_letters, where, bits):
                    if len(row):
                        mine = rows[row]
                        yield pa.RecordBatch.from_pydict({"word": [words[k] for k in mine], "n": n[mine], "near": near})

    maybe = vocabulary.select("word", "n").mapInArrow(probe, "word string, n long, near string")
    pairs = written(maybe.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n"), "near-words")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last.  A form is some times as
    frequent as its word, so the steps end; each doubles the way gone."""
    way = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = written(way.join(on, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots")
        if step.where("moved").limit(1).count() == 0:
            return step.select("word", "root")
        way = step.select("word", "root")


def group_variants(words: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: int = FORM_RATIO, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The vocabulary of a table of words (``word``: Latin-1 letters, A-Z
    lower-cased) with each word's form and root.

    Returns word, form, root, n, n_near, form_n: the form is the near word of
    the greatest n (ties: the least in code-point order) if that is at least
    ``ratio`` times the word's n, else null; the root follows forms to the last.
    A null word is none; an empty table gives no rows; other columns are not read.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more: forms would not grow")
    vocabulary = written(count_words(words.select(F.col("word").cast("string").alias("word")), min_letters, min_count), "vocabulary")
    near = near_words(vocabulary, min_letters, filter_bytes)
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    found = vocabulary.join(best, "word", "left")
    form_n = -F.col("best.less")
    is_form = form_n >= ratio * F.col("n")
    rows = written(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, form_n).alias("form_n")), "forms")
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``group_variants`` over the words of whole texts, some of them damaged
    (see ``damaged``).  A null text has no words, a null doc_id counts as an
    empty one in the checksum; rows that repeat count each."""
    runs = letter_runs(docs.select("doc_id", "text"))
    return group_variants(runs.select(damaged(F.col("doc_id"), F.col("run")).alias("word")))
