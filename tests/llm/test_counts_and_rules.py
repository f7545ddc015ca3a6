import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from watchlens.llm import bpe, queries, rules

FOLDER = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path(queries.TOKENIZER)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
RANKS = bpe.load_ranks(MODEL)
COUNT = bpe.counter(RANKS)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab the▁ \n\t.é漢🙂<s>", max_size=80)))
def test_counts_are_the_librarys(text):
    text = text.encode("utf-8", "replace").decode()
    assert COUNT(text) == len(LIBRARY.encode(text))


def test_counts_of_special_strings_and_long_words():
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh") for _ in range(5000))
    for text in ["</s><unk><0x41>", " " * 40 + "x", long, "🙂" * 500, "ab" * 3000, "a▁b", "\x00\x01"]:
        assert COUNT(text) == len(LIBRARY.encode(text))


def test_every_text_of_the_table_counts_as_in_the_library(spark):
    rows = queries.op5_token_counts(spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = len(LIBRARY.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), want, want > 4096)


def test_token_counts_of_odd_rows(spark, odd_docs):
    rows = bpe.token_counts(odd_docs, RANKS).collect()
    assert len(rows) == odd_docs.count()
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    for r in rows:
        if r.doc_id is not None:
            assert r.n_tokens == len(LIBRARY.encode(texts[r.doc_id] or ""))
    assert bpe.token_counts(odd_docs.limit(0), RANKS).count() == 0


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered.update(range(i, i + 8))
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def measures(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words


def test_base_measures_equal_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op4_quality_rules(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert measures(r) == (want := brute(texts[r.doc_id]))
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_base_measures_of_odd_rows(spark, odd_docs):
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    rows = rules.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r.doc_id is not None:
            assert measures(r) == brute(texts[r.doc_id])
    assert rules.judge(odd_docs.limit(0)).count() == 0


def test_verdicts_keep_good_documents_and_reject_junk(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = [r for r in queries.op4_quality_rules(spark, FOLDER).collect() if r.doc_id in labels and not r.base_failed]
    good, junk = ([r.kept for r in rows if labels[r.doc_id] == mark] for mark in (1, 0))
    assert sum(good) / len(good) > 0.99 and sum(junk) / len(junk) < 0.1


def test_sketches_merge_to_the_sketch_of_all_and_give_near_quantiles(spark):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    values = [(rng.choice("ab"), rng.lognormvariate(0, 1)) for _ in range(4000)]
    rows = spark.createDataFrame(values, "part string, x double")
    parts = rules.sketch(rows, ("part",), {"x": F.col("x")})
    whole = rules.sketch(rows.withColumn("part", F.lit("all")), ("part",), {"x": F.col("x")})
    merged = rules.merge(parts.withColumn("part", F.lit("all")), ("part",))
    assert sorted(map(tuple, merged.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    got = rules.quantiles(merged, ("part",), {"q1": 0.1, "q5": 0.5, "q9": 0.9}).first()
    order = sorted(v for _, v in values)
    for name, q in (("q1", 0.1), ("q5", 0.5), ("q9", 0.9)):
        assert got[name] == pytest.approx(order[int(q * len(order)) - 1], rel=0.06)


def test_limits_follow_each_source(make_docs):
    line = lambda k, j: [f"{chr(97 + i)}{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + j)}word" for i in range(9)]
    text = lambda between, k: "\n".join(between.join(line(k, j)) for j in range(6))
    plain, signs = " ", " | "
    rows = [(k, text(plain, k), "en", "prose") for k in range(300)] + [(1000 + k, text(signs, k), "en", "tables") for k in range(300)]
    rows.append((5000, text(signs, 5), "en", "prose"))
    kept = {r.doc_id: (r.base_failed, r.kept) for r in rules.judge(make_docs(rows)).collect()}
    # Tables are normal in the one source and odd in the other.
    assert kept[1000 + 5] == (False, True) and kept[5000] == (False, False) and kept[5] == (False, True)
