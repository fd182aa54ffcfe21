"""Near-duplicate documents by circulant MinHash.

Two permutations of the 32-bit universe generate a whole signature: sigma
scatters a document's shingles once, and coordinate k is the least value of pi
after a circular shift by k, ``min(pi(sigma(s) + k mod 2**32))``.  Signatures
are cut into ``BANDS`` bands of ``ROWS`` coordinates; documents that agree on a
band are candidates, and candidates are confirmed by the exact Jaccard
similarity of the shingle sets of their whole texts.

Two texts at the threshold share a band with probability
``1 - (1 - 0.75**4)**32``, about 1 - 5e-6, and more above it.

Equal shingle sets are one node from the start.  Members of a band's bucket are
not paired with each other but with a hub, the member that shares most buckets
with others (of copies that were edited apart, the text they come from), and
the links found make components.  Where a bucket still holds several, its
members are dealt anew by their rarest shingles, of which linked texts have one
in common, so that texts that only share a frequent passage part ways.  In these
buckets hubs go on in rounds: a hub is compared with the members that are not in
its component and then leaves; a bucket is done when its members are all in one
component.  So links inside a component are never enumerated, and none between
components is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelake.llm.components import components
from queuelake.llm.frames import from_struct, map_batches, row_struct, written
from queuelake.llm.words import mix64, shingle_set

BANDS = 32
ROWS = 4
PERCENT = 75
#: Least agreeing coordinates (one byte each, of 128) for the exact check.  At
#: similarity 0.75 about 96 agree, with a standard deviation of 4.9, so fewer
#: than 70 are 5.3 deviations away.
MIN_AGREE = 70
SKETCH_SLOTS = 1 << 20
SKETCH_BLOCK = 1 << 14
BROADCAST_NODES = 250_000
CHUNK_SHINGLES = 1 << 15
NO_ID = -(2**63)


def signatures_of(sets: list[np.ndarray]) -> np.ndarray:
    """uint32 array (documents, coordinates); every set must have a member."""
    out = np.empty((len(sets), BANDS * ROWS), dtype=np.uint32)
    at = 0
    while at < len(sets):
        upto, size = at, 0
        while upto < len(sets) and (upto == at or size + len(sets[upto]) <= CHUNK_SHINGLES):
            size += len(sets[upto])
            upto += 1
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[at : upto - 1]])]).astype(np.intp)
        sigma = (mix64(np.concatenate(sets[at:upto]) + np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
        pi, tmp = np.empty_like(sigma), np.empty_like(sigma)
        for k in range(BANDS * ROWS):
            np.add(sigma, np.uint32(k), out=pi)
            for shift, factor in ((16, 0x21F0AAAD), (15, 0xD35A2D97)):
                np.right_shift(pi, np.uint32(shift), out=tmp)
                np.bitwise_xor(pi, tmp, out=pi)
                np.multiply(pi, np.uint32(factor), out=pi)
            np.right_shift(pi, np.uint32(15), out=tmp)
            np.bitwise_xor(pi, tmp, out=pi)
            out[at:upto, k] = np.minimum.reduceat(pi, starts)
        at = upto
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """int64 array (documents, bands)."""
    s = signatures.astype(np.uint64).reshape(len(signatures), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(48), s.shape[:2])
    for r in range(ROWS):
        key = mix64(key + s[:, :, r])
    return key.view(np.int64)


def _signatures(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column(1).to_pylist()]
            some = [i for i, s in enumerate(sets) if len(s)]
            sig = signatures_of([sets[i] for i in some])
            keys: list = [None] * len(sets)
            sketches: list = [None] * len(sets)
            bands: list = [None] * len(sets)
            low, band = (sig & 0xFF).astype(np.uint8), band_keys(sig)
            for row, i in enumerate(some):
                keys[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                sketches[i] = low[row].tobytes()
                bands[i] = band[row]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(sketches, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "key", "sketch", "bands"],
            )

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return map_batches(rows, run, "doc_id long, text_hash long, n_shingles long, key binary, sketch binary, bands array<long>")


def _similar_sketches(pairs: DataFrame) -> DataFrame:
    """Pairs whose signatures agree on at least ``MIN_AGREE`` coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(-1, BANDS * ROWS) for i in (2, 3))
            agree = (a == b).sum(axis=1) >= MIN_AGREE
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(agree))

    return map_batches(pairs, run, "a long, b long")


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Exact test on two sorted sets of distinct shingles."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= PERCENT * (len(x) + len(y) - common) and common > 0


def _confirmed(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b, text_a, text_b) that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}

        def of(node: int, text: str) -> np.ndarray:
            if node not in sets:
                if len(sets) >= 64:
                    sets.clear()
                sets[node] = shingle_set(text)
            return sets[node]

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = [linked(of(i, s.as_py()), of(j, t.as_py())) for i, j, s, t in zip(a, b, batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(pairs, run, "a long, b long")


def _members(nodes: DataFrame) -> DataFrame:
    """(bucket, node, n, rank, shared, comp): members of buckets of two and
    more; shared is how many places the node's buckets have for others.  Every
    node is a component still."""
    rows = nodes.select(F.explode("bands").alias("bucket"), "node", F.col("n_shingles").alias("n"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = written(rows.join(sizes, "bucket"), "members")
    shared = members.groupBy("node").agg(F.sum("size").alias("shared"))
    return members.join(shared, "node").select("bucket", "node", "n", F.lit(0).cast("long").alias("rank"), "shared", F.col("node").alias("comp"))


def _texts(docs: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(node, text): one text of each node that has a candidate.

    Up to ``BROADCAST_NODES`` of them (a few MB) the nodes are sent to the
    texts, so that only their texts are shuffled; beyond that both sides are."""
    need = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "id0", "text_hash")
    need = written(need, "need")
    if need.count() <= BROADCAST_NODES:
        need = F.broadcast(need)
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id0"), F.xxhash64("text").alias("text_hash"), "text")
    return written(rows.join(need, ["id0", "text_hash"]).groupBy("id0", "text_hash", "node").agg(F.first("text").alias("text")).select("node", "text"), "texts")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their component, of the buckets that hold several."""
    now = members.join(labels, "node", "left").select("bucket", "node", "n", "rank", "shared", F.coalesce("label", "node").alias("comp"))
    still = now.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("bucket")
    return written(now.join(still, "bucket", "left_semi"), "open")


def _hubs(members: DataFrame, each: int) -> DataFrame:
    """The first round's hub of every open bucket, or up to ``each`` of them."""
    if each == 0:
        best = members.groupBy("bucket").agg(F.max(F.struct("shared", "node", "comp", "n", "rank")).alias("h"))
    else:
        sizes = members.groupBy("bucket", "comp").agg(F.count("*").alias("size"))
        salted = members.join(sizes, ["bucket", "comp"]).withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(each)))
        best = salted.groupBy("bucket", "salt").agg(F.min(F.struct("size", "node", "comp", "n", "rank")).alias("h"))
    return written(best.select("bucket", *[F.col(f"h.{c}").alias(f"hub_{c}") for c in ("node", "comp", "n", "rank")]), "hubs")


def _pairs(members: DataFrame, hubs: DataFrame, tested: list[DataFrame]) -> DataFrame:
    """Pairs of a hub and a member of another component that can be linked.

    Linked sets have at least ``common = ceil(3/7 (n + hub_n))`` members in
    common.  If the shared shingle is the first in both their orders of rarity,
    none before it is common, so neither may have more than ``n - common``
    before it.  (Bands have rank 0, which leaves the bound on sizes.)"""
    common = F.ceil(F.lit(PERCENT) * (F.col("n") + F.col("hub_n")) / F.lit(100 + PERCENT))
    fits = (F.col("rank") <= F.col("n") - common) & (F.col("hub_rank") <= F.col("hub_n") - common)
    met = members.join(hubs, "bucket").where((F.col("comp") != F.col("hub_comp")) & fits)
    pairs = met.select(F.least("node", "hub_node").alias("a"), F.greatest("node", "hub_node").alias("b")).distinct()
    if tested:
        pairs = pairs.join(reduce(DataFrame.union, tested), ["a", "b"], "left_anti")
    return written(pairs, "pairs")


def _frequency_sketch(texts: DataFrame) -> np.ndarray:
    """Counters of a fixed number that shingles are hashed to: about how many of
    the texts hold a shingle, in eighths of a power of two, a byte each.  It only
    ranks shingles, so collisions are harmless."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH_SLOTS, dtype=np.int64)
        for batch in batches:
            for text in batch.column(1):
                np.add.at(counts, (shingle_set(text.as_py()) % np.uint64(SKETCH_SLOTS)).astype(np.int64), 1)
        some = np.flatnonzero(counts)
        for a in range(0, len(some), 1 << 16):
            at = some[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["slot", "n"])

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(SKETCH_BLOCK, dtype=np.uint8)
        out[pdf["slot"].to_numpy() % SKETCH_BLOCK] = np.minimum(8 * np.log2(1.0 + pdf["n"].to_numpy()), 255)
        return pd.DataFrame({"block": [int(pdf["slot"].iloc[0]) // SKETCH_BLOCK], "levels": [out.tobytes()]})

    counts = map_batches(texts, run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    blocks = counts.groupBy((F.col("slot") / SKETCH_BLOCK).cast("int").alias("block")).applyInPandas(block, "block long, levels binary")
    out = np.zeros(SKETCH_SLOTS, dtype=np.uint8)
    for r in blocks.collect():  # SKETCH_SLOTS bytes in all
        out[r.block * SKETCH_BLOCK : (r.block + 1) * SKETCH_BLOCK] = np.frombuffer(r.levels, dtype=np.uint8)
    return out


def _rare_members(texts: DataFrame) -> DataFrame:
    """(bucket, node, n, rank, shared): one row for each shingle among the rarest
    ``n - ceil(0.75 n) + 1`` of a text.

    Two linked texts have one of these in common whatever the order of rarity,
    as long as it is the same for all texts.  A passage that many texts share
    is not rare, so texts that have nothing else in common do not meet."""
    frequency = _frequency_sketch(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = shingle_set(text.as_py())
                order = np.lexsort((s, frequency[(s % np.uint64(SKETCH_SLOTS)).astype(np.int64)]))
                rare = s[order[: len(s) - -(-PERCENT * len(s) // 100) + 1]].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(rare), pa.array(np.full(len(rare), node)), pa.array(np.full(len(rare), len(s))), pa.array(np.arange(len(rare)))], names=["bucket", "node", "n", "rank"])

    rows = written(map_batches(texts, run, "bucket long, node long, n long, rank long"), "rare")
    several = rows.groupBy("bucket").agg(F.count("*").alias("shared")).where("shared > 1")
    return written(rows.join(several, "bucket").select("bucket", "node", "n", "rank", "shared"), "rare")


def _merge(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels after the components of both ends of every edge become one."""
    ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    known = labels.union(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label")))
    la, lb = labels.select(F.col("node").alias("a"), F.col("label").alias("la")), labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    joined = edges.join(la, "a", "left").join(lb, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    roots = components(joined).select(F.col("v").alias("label"), "root")
    return written(known.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "labels")


def _edges(pairs: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are linked: by signature first, then on full sets."""
    sketched = (
        pairs.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a")
        .join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b").select("a", "b", "sa", "sb")
    )
    likely = _similar_sketches(sketched)
    both = (
        likely.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
    )
    return written(_confirmed(both), "edges")


def _labels(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, label) for every node that is linked with another."""
    spark = docs.sparkSession
    sketches = nodes.select("node", "sketch")
    members = _members(nodes)
    texts = _texts(docs, nodes, members)
    labels = spark.createDataFrame([], "node long, label long")
    tested = [_pairs(members, _hubs(members, 0), [])]
    labels = _merge(labels, _edges(tested[-1], sketches, texts))
    undecided = texts.join(_open(members, labels).select("node").distinct(), "node", "left_semi").select("node", "text")
    members, each = _rare_members(undecided), 1
    while True:
        members = _open(members, labels)
        if members.limit(1).count() == 0:
            return labels
        hubs = _hubs(members, each)
        pairs = _pairs(members, hubs, tested)
        if pairs.limit(1).count():
            tested.append(pairs)
            edges = _edges(pairs, sketches, texts)
            if edges.limit(1).count():
                labels = _merge(labels, edges)
        members = members.join(hubs.select("bucket", F.col("hub_node").alias("node")), ["bucket", "node"], "left_anti")
        each *= 16


def _grouped(docs: DataFrame) -> DataFrame:
    """What ``near_duplicates`` gives, and group: a number for the documents of
    a component, also of one without ids; null for texts without shingles."""
    sig = written(_signatures(docs), "signatures")
    sets = sig.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("first_id"),
        F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id0"), "text_hash", "n_shingles", "sketch", "bands")).alias("one"),
    )
    nodes = written(sets.select(F.monotonically_increasing_id().alias("node"), "key", "first_id", "one.*"), "nodes")
    named = nodes.select("node", "key", "first_id").join(_labels(docs, nodes), "node", "left")
    shared = named.where("label is not null").groupBy("label").agg(F.min("first_id").alias("least"))
    least = F.when(F.col("label").isNull(), F.col("first_id")).otherwise(F.col("least"))
    named = named.join(shared, "label", "left").select("key", least.alias("component"), F.coalesce("label", "node").alias("group"))
    out = sig.select("doc_id", "text_hash", "n_shingles", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash", "group")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Component of every document: doc_id, n_shingles, component_id, kept and
    text_hash (xxhash64 of the text, to tell rows of one doc_id apart).

    component_id is the least doc_id reachable over links; kept marks that
    document.  A null or blank text has no shingles and is linked with nothing.
    A null doc_id never names a component while another id is in it; documents
    without any id in their component get a null component and are kept.  Rows
    that repeat doc_id and text are one document.  Other columns are not read;
    an empty table gives no rows.
    """
    return _grouped(docs).drop("group")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without all but one document of each
    component."""
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct()
    gone = written(gone, "dropped")
    kept = docs.select(row_struct(docs)).join(gone, F.col("row.doc_id").eqNullSafe(gone["id"]) & (F.xxhash64(F.col("row.text")) == gone["hash"]), "left_anti")
    return from_struct(kept, docs)


def keep_one_row_of_each(docs: DataFrame) -> DataFrame:
    """Like ``keep_one_of_each``, but of rows that repeat the kept doc_id, or
    that have none, one row of a component stays.  Texts without shingles are in
    no component: of these, rows that repeat doc_id and text are one document,
    and rows without doc_id all stay.

    Texts move only where ids repeat, and copies meet in a partial aggregate.
    """
    rows = written(_grouped(docs).select("doc_id", "text_hash", "kept", "group"), "grouped")
    alone = F.when(F.col("group").isNull(), F.col("text_hash"))
    kept = rows.where("kept and (group is not null or doc_id is not null)").withColumn("alone", alone)
    counts = kept.groupBy("group", "alone", "doc_id").agg(F.count("*").alias("n"), F.min("text_hash").alias("first"))
    repeated = written(counts.where("n > 1").drop("n"), "repeated")
    gone = rows.where("not kept").select("doc_id", "text_hash")
    any_repeated = repeated.limit(1).count() > 0
    if any_repeated:
        of = repeated.where("group is not null").select(F.col("group").alias("of"), "first")
        others = kept.join(of, (F.col("group") == F.col("of")) & (F.col("text_hash") != F.col("first")))
        gone = gone.union(others.select("doc_id", "text_hash"))
    gone = written(gone.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct(), "dropped")
    whole = docs.select(row_struct(docs))

    def same(other: DataFrame) -> Column:
        return F.col("row.doc_id").eqNullSafe(other["id"]) & (F.xxhash64(F.col("row.text")) == other["hash"])

    left = whole.join(gone, same(gone), "left_anti")
    if not any_repeated:
        return from_struct(left, docs)
    some = repeated.select(F.col("doc_id").alias("id"), F.col("first").alias("hash"))
    copies = whole.join(some, same(some), "left_semi")
    one = copies.groupBy(F.col("row.doc_id"), F.xxhash64("row.text")).agg(F.first("row").alias("row")).select("row")
    return from_struct(left.join(some, same(some), "left_anti").union(one), docs)
