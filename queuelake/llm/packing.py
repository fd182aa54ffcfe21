"""Best-fit packing of token pieces into sequences under several capacities.

A bin (sequence) has three residual capacities: tokens, documents and attention
cost (the sum of squared piece lengths).  Pieces are placed longest first; of
the bins that can take a piece under every capacity the rule picks one, by the
least weighted norm of what would be left ("norm") or by the greatest weighted
dot product of the piece's demand and the bin's residual ("dot").

Full pieces are sequences by themselves.  The others are dealt into buckets of
about ``PIECES_PER_BUCKET`` by a hash and every bucket is packed alone: a bucket
has a few sequences that are not nearly full, so the loss is small, and no task
sees more than a bucket however large the input.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.llm.frames import map_batches, written

PIECES_PER_BUCKET = 8_000


class Capacity(NamedTuple):
    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.02, 0.02)
    rule: str = "norm"


def _encoder(path: str):
    """ids of a text as an array.  The rank file beside the vocabulary gives
    the same ids several times faster; without it the vocabulary is read."""
    ranks = os.path.splitext(path)[0] + ".tiktoken"
    if os.path.exists(ranks):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        end = "<|endoftext|>"
        encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={end: len(table)})
        return lambda text: encoding.encode_to_numpy(text, allowed_special={end})
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def token_pieces(docs: DataFrame, vocabulary: str, tokens: int, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and an
    end id, cut into pieces of ``tokens``; only the first may be shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary)
        for batch in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                first = len(ids) % tokens or tokens
                cuts = [0, *range(first, len(ids) + 1, tokens)]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    doc.append(doc_id)
                    piece.append(i)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(lengths: np.ndarray, cap: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece; lengths in any order."""
    limit = np.array([cap.tokens, cap.documents, cap.attention], dtype=np.float64)
    weight = np.array(cap.weights) / limit
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    left = np.empty((3, 64))  # residuals of the open bins
    name = np.empty(64, dtype=np.int64)
    n_open = n_bins = 0
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths.min()) if len(lengths) else 0
    for at in order:
        n = float(lengths[at])
        need = np.array([n, 1.0, n * n])
        rest = left[:, :n_open] - need[:, None]
        able = (rest >= 0).all(axis=0)
        if able.any():
            if cap.rule == "dot":
                score = -((weight * need / limit) @ left[:, :n_open])
            else:
                score = ((rest * weight[:, None]) ** 2).sum(axis=0)
            score[~able] = np.inf
            pick = int(np.argmin(score))
        else:
            if n_open == left.shape[1]:
                left = np.concatenate([left, np.empty_like(left)], axis=1)
                name = np.concatenate([name, np.empty_like(name)])
            pick = n_open
            left[:, pick], name[pick] = limit, n_bins
            n_open += 1
            n_bins += 1
        bins[at], offsets[at] = name[pick], cap.tokens - left[0, pick]
        left[:, pick] -= need
        if left[0, pick] < least or left[1, pick] < 1 or left[2, pick] < least * least:  # nothing fits any more
            n_open -= 1
            left[:, pick], name[pick] = left[:, n_open], name[n_open]
    return bins, offsets


def pack_documents(docs: DataFrame, vocabulary: str, cap: Capacity = Capacity()) -> DataFrame:
    """Sequence and offset of every piece of every document.

    Each piece must fit an empty sequence under every capacity.  A null text is
    empty: one piece that is the end id.  Rows that repeat a doc_id, and null
    ids, are documents of their own; other columns are not read; an empty table
    gives no rows.  sequence_id is the bucket's number and the sequence's in it.
    """
    if cap.documents < 1 or cap.attention < cap.tokens**2:
        raise ValueError("a full piece must fit an empty sequence")
    pieces = written(token_pieces(docs, vocabulary, cap.tokens), "pieces")
    whole, rest = pieces.where(F.col("length") == cap.tokens), pieces.where(F.col("length") < cap.tokens)
    parts = max(1, round(rest.count() / PIECES_PER_BUCKET))
    numbered = rest.withColumn("bucket", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = pack(pdf["length"].to_numpy(), cap)
        return pdf.drop(columns="bucket").assign(sequence_id=(pdf["bucket"].to_numpy() << 24) + bins, offset=offsets)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    packed = numbered.groupBy("bucket").applyInPandas(run, schema)
    alone = whole.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.union(alone)
