"""Stages on tables whose other columns have any name; thresholds that adapt."""

import public_tokenizers
from llm_cases import HARD, SF, docs_of  # noqa: F401
from pyspark.sql import functions as F

from queuelake.llm import near_dedup, packing, quality, toxicity

NAMES = ["__t", "__counts", "__lang", "__source", "__kept", "__id", "__hash", "__row", "low_symbol_permille", "a.b", "counts", "toxicity", "row", "is_kept", "of_lang", "hash", "x`y"]


def test_stages_keep_columns_of_any_name(spark, docs_of):
    good = "plain words of a text that has ten and more of them in it"
    plain = docs_of([*HARD, good, good, (10**6, good + " again"), (10**6, good + " again"), (None, good)]).select("doc_id", "text", "lang", "source", "n_chars")
    docs = plain.select("*", *[F.lit(k).alias(name) for k, name in enumerate(NAMES)])
    labels = spark.createDataFrame([(0, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    stages = [quality.keep_good, lambda d: toxicity.keep_clean(d, labels), near_dedup.keep_one_of_each, near_dedup.keep_one_row_of_each]
    for stage in stages:
        out, want = stage(docs), stage(plain)
        assert out.columns == docs.columns
        rows = out.collect()
        assert sorted(map(str, ((r.doc_id, r.text) for r in rows))) == sorted(map(str, ((r.doc_id, r.text) for r in want.collect())))
        assert all(tuple(r)[5:] == tuple(range(len(NAMES))) for r in rows)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).count() > 0
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before == "10000"


def test_thresholds_differ_between_groups_and_decide(spark):
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    counted = quality.with_counts(docs, "c").select("doc_id", "lang", "source", "c.*").persist()
    limits = quality.thresholds(quality.sketch(counted)).persist()
    assert len({r.high_word_centichars for r in limits.collect()}) > 1
    mine = {r.doc_id: r.is_kept for r in quality.judged(counted, limits).collect()}
    # the limits of one language do not reproduce the others' decisions
    for lang in ("en", "de"):
        one = limits.where((F.col("lang") == lang)).limit(1).drop("lang", "source")
        moved = counted.select("lang", "source").distinct().join(one.withColumn("k", F.lit(1)), F.lit(1) == F.col("k")).drop("k")
        other = {r.doc_id: r.is_kept for r in quality.judged(counted, moved).collect()}
        assert sum(mine[k] != other[k] for k in mine) > 0
    # nor does any cutoff of the symbols alone
    kept = counted.join(spark.createDataFrame(list(mine.items()), "id long, k boolean"), F.col("doc_id") == F.col("id")).where(~quality.base_failed())
    share = [r.v for r in kept.where("k").select(quality.metric(quality.METRICS[0]).alias("v")).collect()], [r.v for r in kept.where("not k").select(quality.metric(quality.METRICS[0]).alias("v")).collect()]
    assert min(share[1]) <= max(share[0])
