"""Operators that compare, order or group documents."""

import collections
import hashlib
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from llm_cases import HARD, SF, docs_of  # noqa: F401
from pyspark.sql import functions as F

from queuelake.llm import catalog, chat, fingerprints, near_dedup, packing, quality, sharding, toxicity
from queuelake.llm.words import shingle_set


def crc(text):
    return zlib.crc32((text or "").encode())


# ---- sharding


def test_shards_slots_and_growth(spark, docs_of):
    texts = HARD * 3
    docs = docs_of(texts).unionByName(docs_of([(3, "again"), (3, "again"), (None, "no id"), (None, None)]))
    rows = sharding.shard_documents(docs, sharding.regular_tree(24)).collect()
    assert len(rows) == len(texts) + 4
    assert all(r.law == "key" and 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24) for r in rows)
    for r in rows[:0] + [x for x in rows if x.doc_id not in (3, None)]:
        assert (r.size, r.text_crc32) == (len((texts[r.doc_id] or "").encode()) + 8, crc(texts[r.doc_id]))
    assert len({r.shard for r in rows if r.doc_id == 3}) == len({r.shard for r in rows if r.doc_id is None}) == 1
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.shard_documents(docs.limit(0), sharding.regular_tree(24)).count() == 0


def test_draws_follow_the_weights_and_moves_stay_in_changed_subtrees(spark):
    tree = sharding.regular_tree(24)
    heavier = [x._replace(weight=3.0) if x.shard == 7 else x for x in tree]
    keys = spark.range(60_000)
    both = sharding.with_shard(sharding.with_shard(keys, F.col("id"), tree, "a"), F.col("id"), heavier, "b").toPandas()
    n = both["a"].value_counts()
    assert abs(n / 2500 - 1).max() < 0.1
    assert abs(both["b"].value_counts()[7] / (60_000 * 3 / 26) - 1) < 0.1
    moved = both[both.a != both.b]
    region = {x.shard: x.region for x in tree}
    assert len(moved) and all(region[b] == region[7] for b in moved["b"])


# ---- chat


def test_perspectives_match_the_oracle_and_join_up(spark):
    rows = [(1, t, f"r{t % 3}", f"text {t}", "x", "y") for t in range(150)]
    rows += [(1, 149, "r0", "tie", "", ""), (1, 149, "r0", "tie", "", ""), (2, 0, "system", None, "", ""), (2, None, "a", "", "", ""), (2, 1, None, "who", "", ""), (3, 0, "system", "alone", "", ""), (None, 0, "b", "x", "", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, speaker string, block string")
    out = chat.rotate_perspectives(turns).toPandas()
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text", "speaker", "block"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.execute(catalog.ORACLE["op3_chat_formatting"]).df()
    key = ["conv_id", "speaker", "block"]
    a, b = (x[sorted(x.columns)].astype(object).where(x.notna(), None).astype(str).sort_values(key).reset_index(drop=True) for x in (out, want))
    a["conv_id"], b["conv_id"] = (x["conv_id"].str.replace(".0", "", regex=False).replace("<NA>", "None") for x in (a, b))
    pd.testing.assert_frame_equal(a, b)
    one = out[(out.conv_id == 1) & (out.speaker == "r1")].sort_values("block")
    assert len(one) >= 3 and one.n_turns.sum() == 152 and one.n_turns.max() <= 64
    assert (one.rendered.str.len().cumsum().shift(fill_value=0) == one.start_char).all()
    for r in one.itertuples():
        spans = [r.rendered[int(x):int(y)] for x, y in (s.split("-") for s in r.mask_spans.split(",") if s)]
        assert all(s.endswith("<|end|>\n") for s in spans) and sum(map(len, spans)) == r.n_masked
        assert len(spans) == r.rendered.count("<|assistant|>")
    assert set(out[out.conv_id == 2].speaker) == {"a"} and not len(out[out.conv_id == 3])
    assert chat.rotate_perspectives(turns.limit(0)).count() == 0


# ---- packing


def test_pieces_and_sequences(spark, docs_of):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    theirs = Tokenizer.from_file(path)
    texts = HARD + spark.read.parquet(f"{SF}/documents.parquet").toPandas()["text"].tolist()
    out = packing.pack_documents(docs_of(texts), path).toPandas()
    for doc_id, p in out.sort_values("piece").groupby("doc_id"):
        ids = np.array(theirs.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        assert p.length.sum() == len(ids) and (p.length.iloc[1:] == 2048).all()
        assert p.piece.tolist() == list(range(len(p))) and (p.length.cumsum() - p.length == p.start).all()
        assert [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(p.start, p.length)] == p.ids_crc32.tolist()
    assert out.doc_id.nunique() == len(texts)
    seq = out.sort_values("offset").groupby("sequence_id")
    assert seq.length.sum().max() <= 2048
    assert all((s.length.cumsum() - s.length == s.offset).all() for _, s in seq)
    assert len(seq) <= 1.02 * -(-out.length.sum() // 2048) + 1
    assert packing.pack_documents(docs_of(texts).limit(0), path).count() == 0


def test_repeated_and_null_ids_are_documents_of_their_own(spark, docs_of):
    out = packing.pack_documents(docs_of([(1, "a b"), (1, "a b"), (None, None)]), public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert len(out) == 3 and len({(r.sequence_id, r.offset) for r in out}) == 3


def test_rank_file_and_vocabulary_give_the_same_ids(tmp_path):
    import shutil

    shutil.copy(public_tokenizers.path("byte_bpe_50k.json"), tmp_path / "v.json")
    slow, fast = packing._encoder(str(tmp_path / "v.json")), packing._encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in [t or "" for t in HARD]:
        assert slow(text).tolist() == fast(text).tolist()


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 2048, size=3000)
    cap = packing.Capacity(documents=3, attention=2048**2, rule=rule)
    bins, offsets = packing.pack(lengths, cap)
    used = pd.DataFrame({"b": bins, "n": lengths, "sq": lengths**2}).groupby("b").agg(n=("n", "sum"), k=("n", "size"), sq=("sq", "sum"))
    assert used.n.max() <= 2048 and used.k.max() <= 3 and used.sq.max() <= 2048**2
    assert len(used) >= max(-(-lengths.sum() // 2048), 1000)
    loose = packing.pack(lengths, packing.Capacity(rule=rule))[0]
    assert len(set(loose)) <= 1.04 * lengths.sum() / 2048 + 1


# ---- fingerprints


def test_fingerprints_match_brute_force(spark, docs_of):
    texts = HARD + spark.read.parquet(f"{SF}/documents.parquet").toPandas()["text"].tolist()
    out = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs_of(texts)).collect()}
    assert len(out) == len(texts)
    for i, text in enumerate(t or "" for t in texts):
        after = texts[(i + 1) % len(texts)] or ""
        other = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        own, theirs, following = (fingerprints.fingerprint(x) for x in (text, other, after))
        assert (out[i].n_chars, out[i].edited_sha256) == (len(text), hashlib.sha256(other.encode()).hexdigest())
        assert (out[i].fingerprint, out[i].edited_fingerprint) == (fingerprints.written_out(own), fingerprints.written_out(theirs))
        assert (out[i].near_edited, out[i].near_next) == (fingerprints.containment(own, theirs), fingerprints.containment(own, following))
        assert fingerprints.read_back(out[i].fingerprint) == own
    assert out[4].near_next == 1.0
    assert fingerprints.fingerprint_documents(docs_of(texts).limit(0)).count() == 0


def test_fingerprints_of_repeated_and_null_ids(spark, docs_of):
    out = sorted(fingerprints.fingerprint_documents(docs_of([(2, "b" * 9), (2, "a" * 9), (None, "null id"), (7, "c" * 9)])).collect(), key=lambda r: (r.doc_id or 0, r.fingerprint))
    assert len(out) == 4 and out[0].near_next is None
    want = {hashlib.sha256(x.encode()).hexdigest() for x in ("null", "aaaaabbbb", "bbbbbcccc", "cccccaaaa")}
    assert {r.edited_sha256 for r in out} == want


def test_fingerprints_of_great_ids_among_null_ids(spark, docs_of):
    rng = np.random.default_rng(7)
    ids = sorted({*(2**63 - 1 - rng.integers(0, 4000, 600)).tolist(), *rng.integers(-(2**63), 2**63 - 1, 600).tolist()})
    text = {i: f"text {i} " * 9 for i in ids}
    rows = [*text.items(), *((None, f"null id {i}") for i in range(300))]
    out = fingerprints.fingerprint_documents(docs_of([rows[i] for i in rng.permutation(len(rows))])).collect()
    assert sorted(r.doc_id for r in out if r.doc_id is not None) == ids and len(out) == len(rows)
    edits = {r.doc_id: r.edited_sha256 for r in out}
    for i, j in zip(ids, [*ids[1:], ids[0]]):
        assert edits[i] == hashlib.sha256(fingerprints.edited(text[i], text[j]).encode()).hexdigest()


def test_chunks_resist_shifts():
    rng = np.random.default_rng(2)
    text = " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(3000))
    a = fingerprints.fingerprint(text)
    assert fingerprints.containment(a, fingerprints.fingerprint("shifted by this " + text)) > 0.9
    sizes = np.diff([0, *fingerprints.chunk_ends(text.encode())])
    assert sizes.sum() == len(text) and sizes.max() <= fingerprints.MOST and sizes[:-1].min() >= fingerprints.LEAST
    assert 60 < sizes.mean() < 180
    h = fingerprints.gear_hashes(text.encode())
    slow = 0
    for i, c in enumerate(text.encode()[:500]):
        slow = ((slow << 1) + int(fingerprints._GEAR[c])) % 2**32
        assert slow == h[i]


# ---- near duplicates


def brute_components(texts):
    """doc_id -> least doc_id reachable, by comparing all pairs."""
    sets = {i: set(shingle_set(t).tolist()) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def copies(seed):
    """Texts, chains of copies of copies, star copies, families that share a
    passage, and exact copies."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 6)))
    fresh = lambda n: [word() for _ in range(n)]

    def edit(w, share):
        w = list(w)
        for at in rng.choice(len(w), max(1, int(share * len(w))), replace=False):
            w[at] = word()
        return w

    out = []
    for _ in range(4):
        base = fresh(int(rng.integers(60, 200)))
        out += [edit(base, s) for s in rng.uniform(0.005, 0.06, 25)] + [base]
        chain = base
        for _ in range(6):
            chain = edit(chain, 0.02)
            out.append(chain)
    passage = fresh(120)
    out += [fresh(int(n)) + passage for n in rng.integers(10, 90, 40)]
    out += [passage] * 3 + [fresh(3)] * 2
    order = rng.permutation(len(out))
    return {i: " ".join(out[k]) for i, k in enumerate(order)}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, docs_of, seed):
    texts = copies(seed) | {1000 + i: t for i, t in enumerate(HARD)}
    want, sizes = brute_components(texts)
    rows = near_dedup.near_duplicates(docs_of(list(texts.items()))).collect()
    assert {r.doc_id: r.component_id for r in rows} == want
    assert {r.doc_id: r.n_shingles for r in rows} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_dedup_of_nulls_and_repeats(spark, docs_of):
    a, b = "one two three four five six seven", "other words are in this text here"
    docs = docs_of([(5, a), (5, a), (None, a), (9, a.upper()), (None, b), (None, b), (4, None), (4, None)])
    rows = sorted(((str(r.doc_id), r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()), key=str)
    assert rows == [("4", 4, True)] * 2 + [("5", 5, True)] * 2 + [("9", 5, False)] + [("None", 5, False)] + [("None", None, True)] * 2
    kept = near_dedup.keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == 6
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark, docs_of):
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()
    a, b, c = (" ".join(f"{w}{k}" for w in words * 3) for k in "abc")
    rows = [*[(5, a)] * 9, (5, a.upper()), (None, a), (9, a), *[(None, b)] * 3, (None, b.upper()), (5, c), (5, c), (4, None), (4, None), (4, " "), (None, None), (None, None), (8, "x " * 90)]
    out = near_dedup.keep_one_row_of_each(docs_of(rows))
    assert out.columns == docs_of(rows).columns
    got = sorted((str(r.doc_id), (r.text or "null").lower()) for r in out.collect())
    assert got == sorted([("5", a), ("None", b), ("5", c), ("4", "null"), ("4", " "), ("None", "null"), ("None", "null"), ("8", "x " * 90)])
    import corpus_pipeline

    assert corpus_pipeline.near_dedup(spark, docs_of(rows), SF).count() == len(got)
    assert near_dedup.keep_one_row_of_each(docs_of([(1, a), (2, a), (3, b)])).count() == 2
    assert near_dedup.keep_one_row_of_each(docs_of(rows).limit(0)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    a, b = np.unique(pool[:2500]), np.unique(pool[1000:3500])
    s = near_dedup.signatures_of([a, b, pool[:1]])
    assert abs((s[0] == s[1]).mean() - 1500 / 3500) < 0.15
    assert (near_dedup.signatures_of([b])[0] == s[1]).all()


# ---- quality


def test_sketch_buckets_and_edges(spark, docs_of):
    v = [0, 1, 63, 64, 65, 127, 128, 1000, 10**7]
    got = spark.createDataFrame([(x,) for x in v], "v long").select(quality.bucket(F.col("v")).alias("b")).toPandas()["b"].tolist()
    assert all(b <= x < b * 33 / 32 + 1 for x, b in zip(v, got)) and got[:4] == [0, 1, 63, 64]
    docs = docs_of([*HARD, ("junk " * 3 + "### &&& $$$ %%% ***").strip()])
    rows = {r.doc_id: r for r in quality.quality_decisions(docs).collect()}
    assert len(rows) == len(HARD) + 1
    assert not rows[0].kept and rows[0].base_failed and rows[0].n_words == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.kept}
    assert quality.quality_decisions(docs.limit(0)).count() == 0 and quality.keep_good(docs.limit(0)).count() == 0


def test_quality_oracle(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    want = con.execute(catalog.ORACLE["op10_quality_rules"]).df().set_index("doc_id").sort_index()
    got = catalog.op10_quality_rules(spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id").sort_index()
    pd.testing.assert_frame_equal(got, want[got.columns], check_dtype=False)


def test_thresholds_adapt_to_the_group(spark):
    wordy = [(i, "plain words of a text that has ten and more " + str(i), "en", "a", 0) for i in range(150)]
    coded = [(200 + i, "x | y | z | u | v | w | a | b " + " ".join(f"{i}{k}" for k in range(9)), "en", "code", 0) for i in range(150)]
    odd = [(900, "x | y | z | u | v | w | a | b and plain words here too", "en", "a", 0), (901, "x | y | z | u | v | w | a | b and plain words here too", "en", "code", 0)]
    rows = {r.doc_id: r.kept for r in quality.quality_decisions(spark.createDataFrame(wordy + coded + odd, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert not rows.pop(900) and all(rows.values())


# ---- toxicity


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    model = toxicity.train(docs, labels.where(~held))
    marked = docs.join(labels.where(held).select("doc_id", F.col("toxic").alias("y")), "doc_id")
    r = toxicity.with_toxicity(marked, model, "t").select("y", "t.is_toxic").toPandas()
    assert r[r.y == 1].is_toxic.mean() > 0.85 and r[r.y == 0].is_toxic.mean() < 0.01


def test_toxicity_edges(spark, docs_of):
    docs = docs_of([*HARD, (None, "you idiot"), (3, "a")])
    labels = spark.createDataFrame([(0, 1, 0), (None, 1, 1), (3, None, None), (77, 1, 1)], "doc_id long, quality int, toxic int")
    assert docs.count() == toxicity.toxicity_scores(docs, labels).where("not toxic and score between 0 and 1").count()
    assert toxicity.keep_clean(docs, labels.limit(0)).columns == docs.columns
    assert toxicity.toxicity_scores(docs.limit(0), labels).count() == 0


def test_later_models_see_earlier_probabilities():
    rng = np.random.default_rng(4)
    n = 400
    has = rng.random((n, 3)) < 0.3
    row, col = np.nonzero(has)
    rows = toxicity.Rows(row, col, np.zeros((n, 2)), 3)
    targets = {"explicit": has[:, 0], "coded": has[:, 1] & ~has[:, 0], "toxic": has[:, 0] | has[:, 1]}
    weights, held_out = toxicity.fit_chain(rows, targets, np.arange(n) % 5, toxicity.Settings())
    assert [len(weights[c]) for c in toxicity.CATEGORIES] == [6, 7, 8]
    assert weights["toxic"][5] > 0 and ((held_out > 0.5) == targets["toxic"]).mean() > 0.97
    assert toxicity.choose_threshold(np.array([0.9, 0.8, 0.1]), np.array([1, 1, 0]), 0.5) == pytest.approx(0.4, abs=0.1)
    assert toxicity.choose_threshold(np.zeros(0), np.zeros(0), 0.5) == 0.5


# ---- pipeline


def test_pipeline_is_its_stages_one_after_the_other(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now, kept = docs, docs.toPandas()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns
        if name == "near_dedup":
            want, _ = brute_components(dict(zip(kept.doc_id, kept.text)))
            assert {r.doc_id for r in now.select("doc_id").collect()} == {i for i, c in want.items() if i == c}
        kept = now.toPandas()
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert set(out.doc_id) == set(kept.doc_id) and out.groupby("sequence_id").length.sum().max() <= 2048
