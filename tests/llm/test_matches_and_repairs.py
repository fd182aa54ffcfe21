"""Decontamination, spelling variants and conversation repair against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from llm_cases import HARD, docs_of  # noqa: F401
from pyspark.sql import functions as F

from queuelake.llm import catalog, decontamination, repair, variants

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- decontamination


def brute_contamination(text, items, size=10):
    words = WORD.findall(lower(text))
    hit, found, longest = set(), set(), 0
    for name, item in items:
        w = WORD.findall(lower(item))
        k = min(size, len(w))
        for i in range(len(words)) if k else ():
            for j in range(len(w) - k + 1):
                n = 0
                while i + n < len(words) and j + n < len(w) and words[i + n] == w[j + n]:
                    n += 1
                if n >= k:
                    hit.update(range(i, i + k))
                    found.add(str(name))
                    longest = max(longest, n)
    return len(words), sorted(hit), sorted(found), longest


def contamination_case():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(6)] + ["É", "日本", "x1"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 9, 10, 11, 25])))) for k in range(30)]
    items += [(3, "three again " * 6), (100, None), (101, " .. "), (102, "lone"), (None, "null id item of few words")]
    texts = []
    for _ in range(120):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))]
        for _, item in rng.sample(items[:30], rng.randint(0, 3)):
            w = item.split()
            parts += [" ".join(w[rng.randint(0, 3) :]), rng.choice([".", "\n", "other words", ", "])]
        texts.append(rng.choice([str.upper, str])(" ".join(parts)))
    return texts + HARD + ["lone", "three again " * 40, "Null ID item, of few\nwords!"], items


def check_contamination(rows, texts, items):
    named = [("" if name is None else name, text) for name, text in items]
    for r in rows:
        n, hit, found, longest = brute_contamination(texts[r.doc_id], named)
        assert (r.n_words, [p for s in r.spans for p in range(s.start, s.start + s.length)], r["items"], r.longest_match) == (n, hit, found, longest)


@pytest.mark.parametrize("block_bytes", [decontamination.BLOCK_BYTES, 500])
def test_contamination_is_that_of_brute_force(spark, docs_of, block_bytes):
    texts, items = contamination_case()
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(1)).withColumn("spans", F.lit(2))
    rows = decontamination.find_contamination(docs_of(texts), benchmark, block_bytes=block_bytes).collect()
    assert len(rows) == len(texts)
    check_contamination(rows, texts, items)


def test_a_text_is_searched_alike_whatever_the_shard(monkeypatch):
    texts, items = contamination_case()
    index = decontamination.index_items(items)
    together = decontamination.search_texts(texts, index)
    assert together == [decontamination.search_texts([t], index)[0] for t in texts]
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 16)
    assert together == decontamination.search_texts(texts, index)


def test_longest_matches_of_items_come_from_the_suffix_array():
    numbers = np.array([1, 2, 3, 4, 9, 1, 2, 3, 5, 4, 4], dtype=np.int64)
    words = [f"v{k}" for k in range(10)]
    index = decontamination.index_items([("a", "v1 v2 v3 v5 v4 v4 v8"), ("b", "v2 v3 v4")], window=3)
    ids = dict(zip(index.vocabulary.tolist(), itertools.count(1)))
    hashed = {w: int(decontamination.word_hashes(w.encode())[0][0]) for w in words}
    shard = np.array([ids.get(hashed[f"v{n}"], 0) for n in numbers])
    found = decontamination.search(shard, np.zeros(len(shard), dtype=np.int64), index)
    assert dict(zip(index.start.tolist(), found.longest.tolist())) == {0: 6, 1: 5, 2: 4, 3: 3, 4: 2, 8: 3}
    assert found.reach.tolist() == [3, 3, 0, 0, 0, 6, 5, 4, 3, 0, 0]
    order = decontamination.suffix_array(shard, 11)
    padded = shard.tolist()
    assert order.tolist() == sorted((k for k in range(len(padded)) if padded[k]), key=lambda k: padded[k:])


def test_contaminated_rows_go_and_columns_stay(spark, docs_of):
    texts, items = contamination_case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(texts).withColumn("a.b", F.lit(7)).withColumn("row", F.lit("r")).withColumn("spans", F.lit(1))
    kept = decontamination.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    named = [("" if name is None else name, text) for name, text in items]
    assert sorted(r.doc_id for r in kept.collect()) == [k for k, t in enumerate(texts) if not brute_contamination(t, named)[1]]
    assert decontamination.drop_contaminated(docs, benchmark.limit(0)).count() == len(texts)
    assert decontamination.drop_contaminated(docs.limit(0), benchmark).count() == 0
    one = decontamination.contamination_digest(decontamination.find_contamination(docs_of([(2**60, None), (2**60, None), (None, "lone")]), benchmark)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(one) == 3 and {(r.doc_id, r.n_words, r.n_hit, r.n_items) for r in one} == {(2**60, 0, 0, 0), (None, 1, 1, 1)}
    assert {r.items_sha256 for r in one} == {empty, hashlib.sha256(b"102").hexdigest()}


# ---- spelling variants


def brute_variants(words):
    n = {w: c for w, c in collections.Counter(words).items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if abs(len(a) - len(b)) != 1:
            return False
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out = {}
    for w in n:
        others = [o for o in n if near(w, o)]
        best = min(others, key=lambda o: (-n[o], o), default=None)
        out[w] = (best if best and n[best] >= 5 * n[w] else None, len(others))

    def root(w):
        return root(out[w][0]) if out[w][0] else w

    return {(w, f, root(w), n[w], k, n.get(f)) for w, (f, k) in out.items()}


def variant_words():
    rng = random.Random(11)
    letters = "abcàéÿ÷z"
    base = ["".join(rng.choices(letters, k=rng.randint(6, 9))) for _ in range(25)]
    words = []
    for b in base:
        words += [b] * rng.choice([5, 30, 400])
        for _ in range(6):
            w, i, c = b, rng.randrange(len(b)), rng.choice(letters)
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :], w[:i] + c + w[i:]])
            words += [w] * rng.choice([4, 5, 26])
            words += [w[:2] + rng.choice(letters) + w[2:]] * 5
    words += ["aaaaaa"] * 200 + ["aaaaaaa"] * 40 + ["aaaaaaaa"] * 7 + ["zzzzz"] * 50 + ["zzzzzz"] * 10
    words += ["x" * 300] * 5 + ["x" * 301] * 30 + ["y" + "x" * 300] * 6
    return words


@pytest.mark.parametrize("filter_bytes", [variants.FILTER_BYTES, 64])
def test_variants_are_those_of_brute_force_whatever_the_filter(spark, filter_bytes):
    words = variant_words()
    df = spark.createDataFrame([(w, 1) for w in [*words, None]], "word string, n long")
    rows = variants.group_variants(df, filter_bytes=filter_bytes).collect()
    assert {tuple(r) for r in rows} == brute_variants(words) and len({r.word for r in rows}) == len(rows)
    assert any(r.root not in (r.word, r.form) for r in rows)
    assert variants.group_variants(df.limit(0)).count() == 0


def test_filters_hold_every_word_and_stay_small(spark):
    words = sorted({w for w in variant_words() if len(w) >= 6})
    vocabulary = spark.createDataFrame([(w,) for w in words], "word string")
    at, flat = variants.build_filter(vocabulary)
    for rows, letters in variants._matrices(words):
        assert len(variants._admitted(variants.raw_hash(letters), letters.shape[1], at, flat)) == len(rows)
    rng = np.random.default_rng(1)
    false = len(variants._admitted(rng.integers(0, 2**63, 100_000, dtype=np.uint64), 7, at, flat))
    assert false < 5_000
    big = variants.layout({k: 10**9 for k in range(6, 200)}, filter_bytes=1 << 20)
    assert big.total * variants.BLOCK_BITS / 8 < (1 << 20) + 65 * 64


def test_words_and_damage(spark, docs_of):
    texts = HARD + ["Élan élan ÉLAN abc×def÷g, wörter-WÖRTER " * 40, "letter " * 2000, "ſtrange K Ωmega"]
    rows = variants.letter_runs(docs_of([*texts, (None, "nobody owns this letter")])).select("doc_id", "run", variants.damaged(F.col("doc_id"), F.col("run")).alias("word")).collect()
    got = collections.Counter((r.doc_id, r.word) for r in rows)
    want = collections.Counter()
    for k, t in [*enumerate(texts), (None, "nobody owns this letter")]:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            want[k, run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    assert got == want
    assert any(r.run != r.word for r in variants.letter_runs(docs_of([(k, "letter") for k in range(3000)])).select("run", variants.damaged(F.col("doc_id"), F.col("run")).alias("word")).collect())


# ---- conversation repair


def brute_repair(turns):
    """(cost, audit, repaired) of the cheapest of all edits, by trying them all."""
    best = None
    n = len(turns)

    def go(i, inserted, cost, audit, out):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == n:
            text = "".join(r[:1] for r, _ in out)
            if re.fullmatch("(s?(ua)+)?", text) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, list(out))
        if inserted < 2:
            for role in ("user", "assistant"):
                go(i, inserted + 1, cost + 2, audit + "I", [*out, (role, "")])
        if i == n:
            return
        role, text, fault = turns[i]
        go(i + 1, 0, cost + 3, audit + "D", out)
        if fault in ("blank", "duplicate"):
            return
        more = fault == "truncated"
        go(i + 1, 0, cost + more, audit + "K", [*out, (role, text)])
        for other in ("user", "assistant"):
            go(i + 1, 0, cost + 2 + more, audit + "R", [*out, (other, text)])

    go(0, 0, 0, "", [])
    return best


def random_turns(rng, n):
    roles = ["user", "assistant", "system", "tool", "user", "assistant", "unknown"]
    return [(rng.choice(roles), f"t{k}", rng.choice([None, None, None, "truncated", "blank", "duplicate"])) for k in range(n)]


def test_the_agenda_finds_the_cheapest_edits():
    rng = random.Random(2)
    for _ in range(60):
        turns = random_turns(rng, rng.randint(0, 4))
        d = repair.whole([repair.Turn(r[:1], f) for r, _, f in turns])
        cost, audit, out = brute_repair(turns)
        assert (d.cost, d.audit) == (cost, audit)
        assert repair.rebuilt([r for r, _, _ in turns], [t for _, t, _ in turns], d) == out


def test_blocks_join_up_to_the_whole():
    rng = random.Random(3)
    for _ in range(60):
        turns = [repair.Turn(r[:1], f) for r, _, f in random_turns(rng, rng.randint(1, 40))]
        joined, parts = repair._Joined(), []
        size = rng.choice([1, 2, 7])
        for a in range(0, len(turns), size):
            items = {(x, y): d for x in repair.STATES for y, d in repair.lightest(turns[a : a + size], x, repair.STATES, False).items()}
            parts.append(items)
            joined.add([{"entry": x, "exit": y, "cost": d.cost, "audit": d.audit} for (x, y), d in items.items()])
        tail, letters, path = joined.end()
        took = [items[x, y] for items, x, y in zip(parts, path, path[1:])]
        whole = repair.whole(turns)
        assert "".join(d.audit for d in took) + letters == whole.audit
        assert sum(d.cost for d in took) + 2 * len(tail) == whole.cost


def hard_turns():
    rng = random.Random(4)
    text = ["Fine.", "Fine. \n", "cut", "", " \t", "Again!", "x" * 9000 + ".", None, "é?"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "", None, "tool"]), rng.choice(text)) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(1000, t, ["user", "assistant"][t % 2], f"turn {t}.") for t in range(60)]
    rows += [(1001, t % 3, "user", "same.") for t in range(30)] + [(1002, None, "user", f"{k}?") for k in range(20)]
    rows += [(None, 3, "user", "whose?"), (None, 7, "assistant", "mine."), (2**60, 10**9, "user", "far."), (2**60, 0, "user", "near.")]
    return rows


@pytest.mark.parametrize("block_turns", [repair.BLOCK_TURNS, 3])
def test_damage_and_repair_match_the_oracle(spark, block_turns):
    rows = hard_turns()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, at int, fault string")
    out = repair.repair_damaged(df, block_turns).collect()
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.execute(catalog.ORACLE["op13_conversation_repair"]).fetchall()
    assert sorted(map(repr, (tuple(r) for r in out))) == sorted(map(repr, want))
    assert repair.repair_damaged(df.limit(0)).count() == 0
