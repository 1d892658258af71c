"""The pipeline's stages, each against its own input, and the whole."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.test_near_dedup import brute_force

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into each stage and comes out, over a table with odd rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(90001, None, "en", "src0", 0), (90002, "", None, None, 0), (90003, "12 34 !?", "en", None, 8),
                                 (90004, docs.first()["text"], None, None, None), (None, docs.first()["text"], None, "src1", None)], docs.schema)
    folder = tmp_path_factory.mktemp("stages")
    docs.unionByName(odd).coalesce(2).write.parquet(f"{folder}/0")
    frames = [spark.read.parquet(f"{folder}/0")]
    for k, (_, stage) in enumerate(P.STAGES, 1):
        stage(spark, frames[-1], SF).write.parquet(f"{folder}/{k}")
        frames.append(spark.read.parquet(f"{folder}/{k}"))
    return frames


def test_columns_stay(stages):
    for frame in stages[1:-1]:
        assert frame.columns == stages[0].columns


def test_language_drops_only_what_has_none(stages):
    before, after = ({r["doc_id"]: r for r in f.collect()} for f in stages[:2])
    assert before.keys() - after.keys() == {90001, 90002, 90003}


def test_exact_copies(stages):
    norm = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).digest()
    least = {}
    for r in sorted(stages[1].collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)):
        least.setdefault(norm(r["text"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(least.values())


def test_near_copies(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    kept = sorted(d for d, _, _, keep in brute_force(rows) if keep)
    assert sorted(r["doc_id"] for r in stages[3].collect()) == kept


def test_mix_repeats_at_most_twice_and_meets_targets(stages):
    before, after = stages[3].collect(), stages[4].collect()
    size = {r["doc_id"]: len(r["text"].encode().split()) for r in before}
    copies = {}
    for r in after:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert set(copies) <= set(size) and max(copies.values()) <= 2
    assert abs(sum(size[d] * n for d, n in copies.items()) / (1.5 * sum(size.values())) - 1) < 0.1


def test_pack_places_every_token_once(stages):
    tokens = sum(len(r["text"].encode().split()) + 1 for r in stages[4].collect())
    packed = stages[5].toPandas()
    assert packed["length"].sum() == tokens
    assert (packed["bin_offset"] + packed["length"] <= packed["capacity"]).all()


def test_run_gives_the_last_stage(spark):
    assert P.run(spark, SF).count() > 0


@pytest.mark.parametrize("unlearned", ["de", "fr"])
def test_language_rejects_what_was_not_learned(spark, tmp_path, unlearned):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    other = F.col("lang") == unlearned
    strange = ["q", "xx kq zz", "русский текст о погоде и людях", "これは日本語の文章です", "qzx jkw vvq xxz wqk jjz " * 8]
    odd = spark.createDataFrame([(10**6 + i, t, None, None, None) for i, t in enumerate([*strange, "the house", "the"])], docs.schema)
    docs.withColumn("lang", F.when(~other, F.col("lang"))).unionByName(odd).write.parquet(f"{tmp_path}/in")
    before = {r["doc_id"]: r["lang"] for r in docs.collect()}
    kept = {r["doc_id"] for r in P.language(spark, spark.read.parquet(f"{tmp_path}/in"), SF).collect()}
    assert not kept & {10**6 + i for i in range(len(strange))}
    assert {10**6 + len(strange), 10**6 + len(strange) + 1} <= kept
    without = [d for d, lang in before.items() if lang == unlearned]
    learned = [d for d, lang in before.items() if lang not in (None, unlearned)]
    assert len(kept & set(without)) <= 0.3 * len(without)
    assert len(kept & set(learned)) >= 0.995 * len(learned)


def test_columns_with_the_names_of_the_operators(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = {"Score": F.lit(0.5), "fits": F.lit("no"), "lang_pred": F.col("doc_id"), "key": F.lit(b"k"), "row": F.lit(1),
            "copies": F.lit(9), "size": F.col("doc_id") * 2, "members": F.lit("m")}
    docs.withColumns(more).union(docs.withColumns(more).limit(30)).write.parquet(f"{tmp_path}/0")
    frame = spark.read.parquet(f"{tmp_path}/0")
    for k, (_, stage) in enumerate(P.STAGES[:-1], 1):
        stage(spark, frame, SF).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        assert after.dtypes == frame.dtypes
        assert after.where("Score <> 0.5 OR fits <> 'no' OR lang_pred <> doc_id OR key <> X'6B' OR size <> 2 * doc_id").count() == 0
        frame = after
    assert 0 < frame.select("doc_id").distinct().count() <= docs.count()
    assert P.packed(spark, frame, SF).count() > 0


def test_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
