"""Document fingerprints by content-defined chunking.

A gear hash rolls over the UTF-8 bytes of a text.  Cuts are normalised: a chunk
ends at the first place after ``LEAST`` bytes whose hash meets a hard mask, past
``NORMAL`` bytes at the first that meets an easier one, and at ``MOST`` bytes at
the latest, so chunk lengths gather around ``NORMAL`` and an edit moves only the
cuts near it.  The fingerprint is the set of chunk digests with their lengths;
the containment of a text in another is the share of its distinct chunks'
length that the other has as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.llm.frames import map_batches

LEAST, NORMAL, MOST = 32, 96, 384
HARD_BITS, EASY_BITS = 8, 5
ROWS_PER_RANGE = 4_000
MAX_RANGES = 100_000

_GEAR = np.random.default_rng(20240301).integers(0, 2**32, size=256, dtype=np.uint32)


def gear_hashes(data: bytes) -> np.ndarray:
    """The rolling hash after each byte: sum of gear[byte i back] << i mod 2**32."""
    h = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    step = 1
    while step < 32:
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h


def chunk_ends(data: bytes) -> list[int]:
    n = len(data)
    if n == 0:
        return []
    h = gear_hashes(data) if n > LEAST else np.zeros(0, dtype=np.uint32)
    easy = np.flatnonzero(h >> np.uint32(32 - EASY_BITS) == 0)
    hard = easy[h[easy] >> np.uint32(32 - HARD_BITS) == 0].tolist()
    easy = easy.tolist()
    ends, start, i, j = [], 0, 0, 0
    while n - start > LEAST:
        while i < len(hard) and hard[i] + 1 < start + LEAST:
            i += 1
        if i < len(hard) and hard[i] + 1 <= start + NORMAL:
            end = hard[i] + 1
        else:
            while j < len(easy) and easy[j] + 1 <= start + NORMAL:
                j += 1
            end = min(easy[j] + 1 if j < len(easy) else n, start + MOST, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def fingerprint(text: str) -> dict[str, int]:
    """Digest -> length in bytes of the distinct chunks."""
    data = text.encode("utf-8", "surrogatepass")
    out, start = {}, 0
    for end in chunk_ends(data):
        out[hashlib.blake2b(data[start:end], digest_size=8).hexdigest()] = end - start
        start = end
    return out


def written_out(chunks: dict[str, int]) -> str:
    """Sorted "digest:length" entries, comma-joined; empty for an empty text."""
    return ",".join(f"{d}:{n}" for d, n in sorted(chunks.items()))


def read_back(line: str) -> dict[str, int]:
    return {d: int(n) for d, n in (x.split(":") for x in line.split(","))} if line else {}


def containment(a: dict[str, int], b: dict[str, int]) -> float:
    """Share of a's chunk length that b has; of nothing, 1 if b is empty too."""
    if not a:
        return float(not b)
    return sum(n for d, n in a.items() if d in b) / sum(a.values())


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ranges(docs: DataFrame) -> list[int]:
    """First doc_ids of ranges of about ``ROWS_PER_RANGE`` documents (more, where
    that would make over ``MAX_RANGES`` ranges): ids that exist, from a quantile
    sketch over all of them.  The sketch holds doubles, so where ids are beyond
    2**53 its quantiles are replaced by the least id from each of them on."""
    n, least, most = docs.agg(F.count("doc_id"), F.min("doc_id"), F.max("doc_id")).first()
    if not n:
        return []
    parts = max(1, min(round(n / ROWS_PER_RANGE), MAX_RANGES), docs.sparkSession.sparkContext.defaultParallelism)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 100 * parts)).first()[0] if parts > 1 else []
    if max(-least, most) <= 2**53 or not cuts:
        return sorted({least, *cuts})
    bounds = np.unique(np.array(cuts, dtype=np.int64))

    def leasts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.sort(batch.column(0).drop_null().to_numpy())
            parts, at = np.unique(np.searchsorted(bounds, ids, side="right"), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(parts.astype(np.int32)), pa.array(ids[at])], names=["part", "doc_id"])

    firsts = map_batches(docs.select("doc_id"), leasts, "part int, doc_id long").groupBy("part").agg(F.min("doc_id")).collect()
    return sorted(r[1] for r in firsts)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text.

    The next document is the one of the next greater doc_id (after the last,
    the first); rows that repeat a doc_id follow each other by text.  Documents
    are dealt into ranges of doc_id and read in order, and the first document
    of a range is also sent to the range before it, so a text is shuffled once
    and no task holds more than a range's current and next text.

    A null text is empty: no chunks.  A row with a null doc_id stands in no
    order: its edited text loses the half and gains nothing, and near_next is
    null.  An empty table gives no rows; only doc_id and text are read.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    firsts = np.array(_ranges(rows), dtype=np.int64)
    parts = max(1, len(firsts))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Range of each row, and again of the first rows, as followers."""
        for batch in batches:
            known = np.asarray(batch.column(0).is_valid())
            where = np.full(len(known), -1, dtype=np.int32)
            # with nulls in, the column would come as float64, which rounds ids
            exact = batch.column(0).drop_null().to_numpy()
            where[known] = np.searchsorted(firsts, exact, side="right") - 1
            where[~known] = np.arange((~known).sum()) % parts
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(where), pa.array(np.zeros(len(known), dtype=np.int32))], names=["doc_id", "text", "part", "follows"])
            edge = np.flatnonzero(known)[np.isin(exact, firsts)]
            if len(edge):
                some = batch.take(pa.array(edge))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array((where[edge] - 1) % parts), pa.array(np.ones(len(edge), dtype=np.int32))], names=["doc_id", "text", "part", "follows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

        def row(doc_id: int | None, text: str, own: dict[str, int], after: tuple[str, dict[str, int]] | None) -> tuple:
            other = edited(text, after[0] if after else "")
            theirs = fingerprint(other)
            return (doc_id, len(text), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), written_out(own), written_out(theirs),
                    containment(own, theirs), containment(own, after[1]) if after else None)

        def no_next(doc_id: int) -> RuntimeError:
            return RuntimeError(f"document {doc_id} has no next one: the table changed between two reads")

        waiting: tuple | None = None  # part, doc_id, text, chunks: wants its next
        for batch in batches:
            out = []
            for doc_id, text, part, follows in zip(*(batch.column(i).to_pylist() for i in range(4))):
                own = fingerprint(text)
                if doc_id is None:
                    out.append(row(None, text, own, None))
                    continue
                if waiting and waiting[0] == part:
                    out.append(row(*waiting[1:], (text, own)))
                    waiting = None
                if not follows:
                    if waiting:
                        raise no_next(waiting[1])
                    waiting = (part, doc_id, text, own)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)
        if waiting:
            raise no_next(waiting[1])

    dealt = map_batches(rows, places, "doc_id long, text string, part int, follows int")
    # of the followers only the first by text is the next document
    in_order = dealt.repartition(parts, "part").sortWithinPartitions("part", "follows", "doc_id", "text")
    return map_batches(in_order, run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
