"""Ordinary and odd column names, odd rows and empty tables, through every operator that keeps documents whole."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from watchlens.llm import cotrain, decontaminate, lattice, middles, mixing, packing, rules, shards, simhash, similar

NAMES = ["rate", "begin", "quality", "__own", "__row", "__id", "size", "word", "kind", "n_words", "shard", "block", "first", "root", "run"]


def widened(docs):
    return docs.withColumns({name: F.concat(F.lit(name), F.lit("-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for name in NAMES})


def untouched(row):
    return all(row[name] == f"{name}-{'none' if row.doc_id is None else row.doc_id}" for name in NAMES if name != "shard")


@pytest.fixture
def wide_docs(odd_docs, make_docs):
    more = [(100 + k, f"The {k} quick brown foxes jump over all of the {k % 3} lazy dogs near the river bank today again", "en", f"s{k % 2}") for k in range(30)]
    return widened(odd_docs.unionByName(make_docs(more)))


@pytest.fixture
def marks(spark):
    rows = [(100 + k, k % 2, None, "x") for k in range(20)] + [(0, None, 1, "x"), (None, 1, 0, "x"), (100, 1, 0, "x")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("keeps", ["mixing", "similar", "good", "clean"])
def test_documents_keep_their_columns(spark, wide_docs, marks, keeps):
    benchmark = spark.createDataFrame([(1, "a leaked passage of the benchmark that nobody here has", 5)], "item_id long, text string, __row int")
    kept = {
        "mixing": lambda docs: mixing.mixed_documents(docs),
        "similar": lambda docs: similar.one_of_each(docs),
        "good": lambda docs: cotrain.good_documents(docs, cotrain.learn(docs, marks), 0.0),
        "clean": lambda docs: decontaminate.clean_documents(docs, benchmark),
    }[keeps]
    got = kept(wide_docs)
    rows = got.collect()
    assert got.columns == wide_docs.columns and rows and all(map(untouched, rows))
    assert kept(wide_docs.limit(0)).collect() == []


def test_results_do_not_depend_on_further_columns(spark, wide_docs, marks):
    plain = wide_docs.select("doc_id", "text", "lang", "source")
    vocabulary = lattice.Vocabulary(["▁", "a", "b", "c"], lattice.np.log(lattice.np.full(260, 1 / 260)))
    held = lambda docs: docs.withColumn("held", F.lit(False))
    even = shards.equal_weights(3)
    for operator in (
        mixing.mix, rules.judge, simhash.near_copies, middles.transform, similar.similar_documents,
        lambda docs: shards.shard_rows(docs, even), lambda docs: lattice.scores(held(docs), "held", vocabulary),
        lambda docs: cotrain.scores(docs, cotrain.learn(docs, marks)),
    ):
        names = operator(plain).columns
        assert sorted(map(str, operator(plain).collect())) == sorted(map(str, operator(wide_docs).select(names).collect()))


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_pipeline_over_odd_tables(spark, wide_docs, marks, tmp_path, rows):
    docs = wide_docs if rows == "odd" else wide_docs.limit(0)
    folder = str(tmp_path / "tables")
    docs.write.parquet(f"{folder}/documents.parquet")
    marks.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    result = corpus_pipeline.run(spark, folder)
    kept = result.collect()
    assert sorted(result.columns) == sorted(docs.columns)
    assert all(untouched(row) and 0 <= row.shard < corpus_pipeline.SHARDS for row in kept)
    assert (len(kept) > 0) == (rows == "odd")
