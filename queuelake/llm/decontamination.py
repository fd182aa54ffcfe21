"""Benchmark decontamination by suffix arrays of the training texts.

Words are the runs of 0-9, a-z and all beyond ASCII in the text with A-Z
lower-cased.  A *window* of an item is 10 consecutive words of it; an item of
fewer words, but not none, is one window.

Documents are read in shards of a few megabytes.  A shard's words become
numbers of the items' vocabulary, and its suffixes are sorted (prefix doubling,
to the depth of the longest item).  Words and neighbouring pairs that no item
has can be in no match: they end a run, and only runs as long as the shortest
window are sorted.  Every suffix of every item is then looked up by binary
search, one word deeper at a time, all suffixes at once: where a suffix has
reached its window's length, the interval it holds is all places of the window
in the shard; the depth at which it runs empty is its longest verbatim match.

The items are read in blocks of bounded size (``BLOCK_BYTES`` of text), each
broadcast by itself; a benchmark of one block is one pass over the documents,
a larger one is a pass per block, merged by row.  Nothing about documents
reaches the driver or leaves its shard but the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelake.llm.frames import column, from_struct, map_batches, row_struct, written
from queuelake.llm.words import span_hashes

WINDOW_WORDS = 10
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20

_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True

FOUND = "n_words long, spans array<struct<start: long, length: long>>, items array<string>, longest_match long"


class Tests(NamedTuple):
    """A block of items: what a task needs to search a shard for them."""

    vocabulary: np.ndarray  # sorted word hashes; a word's number is its index + 1
    pairs: np.ndarray  # sorted (number << 32 | next number)
    words: np.ndarray  # numbers of all items, a 0 after each
    start: np.ndarray  # one query for each window: its place in ``words``,
    size: np.ndarray  # its length,
    left: np.ndarray  # the words from there to the item's end,
    window: np.ndarray  # and the number of the window among distinct ones
    item_at: np.ndarray  # items of window k: item_no[item_at[k]:item_at[k + 1]]
    item_no: np.ndarray
    names: list[str]  # sorted


def _pieces(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes, cut outside of words."""
    at = 0
    while len(data) - at > size:
        end = at + size
        while end < len(data) and _WORD[data[end]]:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of lower-cased UTF-8 bytes, and where they start."""
    hashes, starts, before = [], [], 0
    for piece in _pieces(data, SHARD_BYTES):
        b = np.frombuffer(piece, dtype=np.uint8)
        inside = np.zeros(len(b) + 2, dtype=bool)
        inside[1:-1] = _WORD[b]
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        if len(edge):
            hashes.append(span_hashes(b, edge[0::2], edge[1::2]))
            starts.append(edge[0::2] + before)
        before += len(piece)
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def _as_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def _numbers(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Numbers of the vocabulary, 0 for other words."""
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at + 1, 0).astype(np.int64)


def index_items(rows: Iterable[tuple[str | None, str | None]], window: int = WINDOW_WORDS) -> Tests | None:
    """The index of (item_id, text) rows; None when no item has a word."""
    items = [("" if name is None else str(name), h) for name, text in rows if len(h := word_hashes(_as_bytes(text))[0])]
    if not items:
        return None
    vocabulary = np.unique(np.concatenate([h for _, h in items]))
    names = sorted({name for name, _ in items})
    number = {name: k for k, name in enumerate(names)}
    parts, start, size, left, ids, members, at = [], [], [], [], [], [], 0
    known: dict[bytes, int] = {}
    for name, hashes in items:
        w = _numbers(hashes, vocabulary)
        parts += [w, np.zeros(1, dtype=np.int64)]
        k = min(window, len(w))
        for i in range(len(w) - k + 1):
            one = known.setdefault(w[i : i + k].tobytes(), len(known))
            if one == len(members):
                members.append(set())
            members[one].add(number[name])
            start.append(at + i)
            size.append(k)
            left.append(len(w) - i)
            ids.append(one)
        at += len(w) + 1
    words = np.concatenate(parts)
    both = (words[:-1] > 0) & (words[1:] > 0)
    pairs = np.unique((words[:-1][both] << 32) | words[1:][both])
    item_at = np.concatenate([[0], np.cumsum([len(m) for m in members])])
    item_no = np.array([x for m in members for x in sorted(m)], dtype=np.int64)
    return Tests(vocabulary, pairs, words, *(np.array(x, dtype=np.int64) for x in (start, size, left, ids)), item_at, item_no, names)


def _runs(numbers: np.ndarray, doc: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """Runs that can hold a match, a 0 after each, and where each word was
    (-1 for the zeros)."""
    n = len(numbers)
    if not n:
        return np.zeros(1, dtype=np.int64), np.full(1, -1)
    linked = np.zeros(n, dtype=bool)  # with the word before
    linked[1:] = (numbers[1:] > 0) & (numbers[:-1] > 0) & (doc[1:] == doc[:-1])
    at = np.flatnonzero(linked)
    if len(at):
        if len(tests.pairs):
            pair = (numbers[at - 1] << 32) | numbers[at]
            k = np.minimum(np.searchsorted(tests.pairs, pair), len(tests.pairs) - 1)
            linked[at] = tests.pairs[k] == pair
        else:
            linked[at] = False
    begins = np.flatnonzero(~linked)
    length = np.diff(np.append(begins, n))
    keep = (numbers[begins] > 0) & (length >= tests.size.min())
    begins, length = begins[keep], length[keep]
    where = np.full(int(length.sum()) + len(length) + 1, -1, dtype=np.int64)
    out_at = np.cumsum(length + 1) - (length + 1)
    steps = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    where[np.repeat(out_at, length) + steps] = np.repeat(begins, length) + steps
    return np.where(where >= 0, numbers[where], 0), where


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes that begin with a word, in the order of at least
    their first ``depth`` words (0 sorts before every word)."""
    rank, order, h = words.copy(), np.argsort(words, kind="stable"), 1
    while h < depth:
        later = np.zeros(len(rank), dtype=np.int64)
        later[:-h] = rank[h:] + 1
        key = rank * (int(rank.max()) + 2) + later
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.concatenate([[0], (np.diff(key[order]) != 0).astype(np.int64)]))
        rank = np.empty_like(new)
        rank[order] = new
        h *= 2
        if new[-1] == len(new) - 1 or h >= len(rank):
            break
    return order[words[order] > 0]


def _bound(words: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, target: np.ndarray) -> np.ndarray:
    """Per query the first place in order[lo:hi] whose word at ``depth`` is at least ``target``."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        less = words[order[mid] + depth] < target[open_]
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and which range each is of."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + lo[which], which


class Hits(NamedTuple):
    place: np.ndarray  # of an occurrence, in the shard's words
    window: np.ndarray
    longest: np.ndarray  # per query, its longest match in the shard
    reach: np.ndarray  # per word of the shard, the longest match from there (0: below the window)


def search(numbers: np.ndarray, doc: np.ndarray, tests: Tests) -> Hits:
    """All places of all windows in a shard, by binary search of the items' suffixes."""
    words, where = _runs(numbers, doc, tests)
    longest = np.zeros(len(tests.start), dtype=np.int64)
    reach = np.zeros(len(numbers), dtype=np.int64)
    order = suffix_array(words, int(tests.left.max()))
    first = np.searchsorted(words[order], np.arange(len(tests.vocabulary) + 2))
    head = tests.words[tests.start]
    live = np.flatnonzero(first[head] < first[head + 1])
    lo, hi, depth = first[head[live]], first[head[live] + 1], 1
    place, window = [], []
    while len(live):
        longest[live] = depth
        done = depth == tests.size[live]
        if done.any():
            ids, one = np.unique(tests.window[live[done]], return_index=True)
            at, which = _ranges(lo[done][one], hi[done][one])
            place.append(where[order[at]])
            window.append(ids[which])
        deep = depth >= tests.size[live]
        if deep.any():
            spans = np.unique(np.stack([lo[deep], hi[deep]], axis=1), axis=0)
            reach[where[order[_ranges(spans[:, 0], spans[:, 1])[0]]]] = depth
        more = tests.left[live] > depth
        live, lo, hi = live[more], lo[more], hi[more]
        target = tests.words[tests.start[live] + depth]
        lo = _bound(words, order, lo, hi, depth, target)
        hi = _bound(words, order, lo, hi, depth, target + 1)
        held = lo < hi
        live, lo, hi, depth = live[held], lo[held], hi[held], depth + 1
    none = np.zeros(0, dtype=np.int64)
    return Hits(np.concatenate([none, *place]), np.concatenate([none, *window]), longest, reach)


def search_texts(texts: list[str | None], tests: Tests) -> list[tuple[int, list[dict], list[str], int]]:
    """(n_words, spans of hit words, items, longest match) of each text of a shard."""
    data = [_as_bytes(t) for t in texts]
    ends = np.cumsum([len(d) + 1 for d in data])
    hashes, starts = word_hashes(b"\n".join(data))
    doc = np.searchsorted(ends, starts, side="right")
    n_words = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    found = search(_numbers(hashes, tests.vocabulary), doc, tests)
    out = [(int(n), [], [], 0) for n in n_words]
    if not len(found.place):
        return out
    size = np.zeros(len(tests.item_at) - 1, dtype=np.int64)
    size[tests.window] = tests.size
    change = np.zeros(len(doc) + 1, dtype=np.int64)
    np.add.at(change, found.place, 1)
    np.add.at(change, found.place + size[found.window], -1)
    hit = np.cumsum(change[:-1]) > 0
    begins = hit.copy()
    begins[1:] &= ~hit[:-1] | (doc[1:] != doc[:-1])
    ends_ = hit.copy()
    ends_[:-1] &= ~hit[1:] | (doc[1:] != doc[:-1])
    for a, b in zip(np.flatnonzero(begins).tolist(), np.flatnonzero(ends_).tolist()):
        out[doc[a]][1].append({"start": int(a - first[doc[a]]), "length": b - a + 1})
    pairs = np.unique(doc[found.place] * len(size) + found.window)
    owner, ids = pairs // len(size), pairs % len(size)
    cache: dict[bytes, list[str]] = {}
    for d in np.unique(owner).tolist():
        mine = ids[owner == d] if len(texts) < 8 else ids[np.searchsorted(owner, d) : np.searchsorted(owner, d, side="right")]
        key = mine.tobytes()
        if key not in cache:
            numbers = np.unique(np.concatenate([tests.item_no[tests.item_at[k] : tests.item_at[k + 1]] for k in mine]))
            cache[key] = [tests.names[k] for k in numbers]
        lo, hi = first[d], first[d] + n_words[d]
        out[d] = (out[d][0], out[d][1], cache[key], int(found.reach[lo:hi].max()))
    return out


def _shards(batches: Iterator[pa.RecordBatch], text: int, size: int) -> Iterator[tuple[pa.Table, list[str | None]]]:
    """Rows gathered to about ``size`` bytes of text; a longer text is a shard."""
    held, texts, n = [], [], 0
    for batch in batches:
        at = 0
        values = batch.column(text).to_pylist()
        for k, t in enumerate(values):
            if n and n + len(t or "") > size:
                held.append(batch.slice(at, k - at))
                yield pa.Table.from_batches(held), texts
                held, texts, n, at = [], [], 0, k
            texts.append(t)
            n += len(t or "") + 1
        held.append(batch.slice(at))
    if texts:
        yield pa.Table.from_batches(held), texts


def _searcher(tests) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(row, text) -> (row, *FOUND); ``tests`` is a broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = tests.value
        for rows, texts in _shards(batches, 1, SHARD_BYTES):
            if index is None:
                found = [(len(word_hashes(_as_bytes(t))[0]), [], [], 0) for t in texts]
            else:
                found = search_texts(texts, index)
            n_words, spans, items, longest = zip(*found)
            table = pa.table(
                {
                    "row": rows.column(0),
                    "n_words": pa.array(n_words, pa.int64()),
                    "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                    "items": pa.array(items, pa.list_(pa.string())),
                    "longest_match": pa.array(longest, pa.int64()),
                }
            )
            yield from table.combine_chunks().to_batches()

    return run


def _merged(spans: Column) -> Column:
    """Sorted spans without overlaps; touching ones join."""
    empty = F.array().cast("array<struct<start: bigint, length: bigint>>")

    def add(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        end = last["start"] + last["length"]
        joined = F.struct(last["start"].alias("start"), (F.greatest(end, x["start"] + x["length"]) - last["start"]).alias("length"))
        return F.when((F.size(acc) > 0) & (x["start"] <= end), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.array_sort(spans), empty, add)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items in blocks of about ``block_bytes`` of text, dealt by hash."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    if n > 1:
        items = written(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "items")
    for k in range(n):
        yield [(r.item_id, r.text) for r in (items.where(F.col("block") == k) if n > 1 else items).collect()]


def _found(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """(row struct, *FOUND) for every row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(row_struct(docs), column("text").cast("string").alias("text"))
    blocks = _blocks(benchmark, block_bytes)

    def one(df: DataFrame, block: list) -> DataFrame:
        schema = T.StructType([df.schema["row"], *T.StructType.fromDDL(FOUND).fields])
        return map_batches(df, _searcher(spark.sparkContext.broadcast(index_items(block, window))), schema)

    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        return one(rows, first)
    # a pass per block; what they find is merged by the number of the row
    rows = written(rows.withColumn("row", F.struct(F.monotonically_increasing_id().alias("id"), F.col("row").alias("of"))), "decontaminate")
    ids = rows.select(F.struct(F.col("row.id").alias("id")).alias("row"), "text")
    parts = None
    for block in (b for group in ([first, second], blocks) for b in group):
        part = written(one(ids, block), "found")
        parts = part if parts is None else parts.unionByName(part)
    merged = parts.groupBy(F.col("row.id").alias("id")).agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("longest_match").alias("longest_match"),
    )
    of = rows.select(F.col("row.id").alias("id"), F.col("row.of").alias("row"))
    return of.join(merged, "id").select("row", "n_words", _merged(F.col("spans")).alias("spans"), "items", "longest_match")


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, spans (runs of hit words, as start
    and length in words), items (the distinct item_ids, as sorted strings, with
    a window in the text) and longest_match (words of the longest verbatim match
    of a window or more; 0 without one).

    A null or empty text has no words and no hits; an item without words has no
    window; a null item_id counts as an empty one; items that repeat, or share an
    id, count once.  Rows that repeat are each returned.  An empty table of
    documents gives none, one of items no hits.  Other columns are not read.
    """
    found = _found(docs.select("doc_id", "text"), benchmark, window, block_bytes)
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "spans", "items", "longest_match")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that no window of an item occurs in, with their columns."""
    found = _found(docs, benchmark, window, block_bytes)
    return from_struct(found.where(F.size("spans") == 0), docs)


def contamination_digest(found: DataFrame) -> DataFrame:
    """``find_contamination`` as counts and a digest of the items."""
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "longest_match",
    )
