import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from watchlens.llm import cotrain, lattice, queries, secret_crf, toxicity

FOLDER = "/root/testdata/sf0.01"


def auc(scores, marks):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    ones = np.array(marks) == 1
    return (ranks[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


# Toxicity


@pytest.mark.parametrize(
    "text", ["Stupid!", "stup1d", "5tup1d", "STUPID***", "ѕtuріd", "ｓｔｕｐｉｄ", "\"stupid\",", "$tupid", "st!upid"],
)
def test_disguises_fold_to_the_word(text):
    want = " stiupid " if "!u" in text else " stupid "
    assert toxicity.fold(f"{text}".encode()) == want


def test_signs_after_a_word_are_no_letters():
    assert toxicity.fold(b"the end$$$ of!! it|") == " the end of it "


def test_phrases_shield_terms_and_stems_count_from_the_second_word():
    lexicon = toxicity.Lexicon({"trash": 2.0, "achl*": 1.0}, ("trash can",), -1.0)
    matcher = lexicon.matcher()
    hits = lambda text: toxicity.hits(toxicity.fold(text.encode()), matcher)
    assert hits("the trash can is trash") == Counter(trash=1)
    assert hits("achlbe and") == Counter() and hits("achlbe achlin achlor") == Counter({"achl*": 2})
    assert hits("trashy atrash") == Counter()


def test_longer_texts_need_more_hits():
    lexicon = toxicity.Lexicon({"scum": 8.0}, (), -2.0)
    short, long = (toxicity.score(toxicity.fold(b"scum " + b"word " * n), lexicon, lexicon.matcher()) for n in (5, 5000))
    assert long < short


def test_held_out_toxicity(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = queries.op6_toxicity(spark, FOLDER).collect()
    assert len(rows) == 1000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert auc([r.score for r in held], [labels[r.doc_id] for r in held]) > 0.85
    clean = [r.predicted for r in held if labels[r.doc_id] == 0]
    assert sum(clean) / len(clean) < 0.02


def test_toxicity_of_odd_rows_and_without_labels(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    lexicon = toxicity.learn(odd_docs, none)
    rows = toxicity.scores(odd_docs, lexicon).collect()
    assert len(rows) == odd_docs.count() and all(r.score < 0.5 for r in rows)
    marks = spark.createDataFrame([(3, 1), (4, 0), (5, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.scores(odd_docs.limit(0), toxicity.learn(odd_docs, marks)).count() == 0


# Quality


def test_held_out_quality(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = queries.op7_quality(spark, FOLDER).collect()
    assert len(rows) == 1000
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.kept == bool(labels[r.doc_id]) for r in held) / len(held) > 0.95
    assert auc([r.score for r in held], [labels[r.doc_id] for r in held]) > 0.97


def test_good_documents_keep_their_rows(spark, odd_docs):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = cotrain.learn(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = {r.doc_id: r.score for r in cotrain.scores(docs, model).collect()}
    kept = cotrain.good_documents(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, v in scores.items() if v >= 0.5}
    assert cotrain.scores(odd_docs, model).count() == odd_docs.count()
    assert cotrain.good_documents(odd_docs, model).columns == odd_docs.columns
    assert cotrain.scores(odd_docs.limit(0), model).count() == 0


def test_quality_without_labels_keeps_all(spark, odd_docs):
    model = cotrain.learn(odd_docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert cotrain.good_documents(odd_docs, model).count() == odd_docs.count()


def test_views_teach_each_other():
    rng = np.random.default_rng(2)
    marks = rng.integers(0, 2, 3000).astype(float)
    content = marks[:, None] * 2.5 + rng.normal(size=(3000, 3))
    page = marks[:, None] * 2.5 + rng.normal(size=(3000, 2))
    few = slice(0, 24)
    model = cotrain.co_train(content[few], page[few], marks[few], cotrain.pool_of(content[24:2000], page[24:2000]))
    right = ((model.score(content[2000:], page[2000:])[:, 2] > 0.5) == marks[2000:]).mean()
    assert right > 0.97


def test_every_unlabelled_document_takes_part(spark):
    """The model from Spark's sums is that of all documents' views at hand, and unlabelled documents change it."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality IS NOT NULL")
    marked = {r.doc_id: r.quality for r in labels.collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    order = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id"), "doc_id").collect() if r.doc_id in rows]
    views = lambda r: (cotrain.content_view((r.text or "").encode()), cotrain.page_view((r.text or "").encode(), r.lang, r.source))
    content, page = (np.array([views(rows[k])[v] for k in order]) for v in (0, 1))
    pool = {(r.text, r.lang, r.source): views(r) for r in rows.values() if r.doc_id not in marked}
    sides = [np.array([v[k] for v in pool.values()], np.float32).astype(float) for k in (0, 1)]
    marks = np.array([marked[k] for k in order], float)
    plain = cotrain.co_train(content, page, marks, cotrain.pool_of(*sides))
    model = cotrain.learn(docs, labels)
    for own, other in zip(model.views, plain.views, strict=True):
        assert np.abs(own.weights - other.weights).max() < 1e-4
    assert np.abs(model.blend - plain.blend).max() < 1e-3
    alone = cotrain.co_train(content, page, marks, cotrain.pool_of(sides[0][:0], sides[1][:0]))
    assert any(np.abs(a.weights - b.weights).max() > 1e-2 for a, b in zip(plain.views, alone.views, strict=True))


# Language model


def test_lattice_arcs_and_classes_at_once():
    pieces = ["\u2581", "\u2581a", "a", "b", "ab", "ba", "abab", "\u00e9", "\u00e9b"]
    own = lattice.Lattice(pieces)
    rng = random.Random(4)
    words = ["".join(rng.choice("ab\u00e9x") for _ in range(rng.randrange(0, 9))) for _ in range(200)]
    arcs = own.arcs(words)
    got = sorted(zip(arcs["start"].tolist(), arcs["end"].tolist(), arcs["piece"].tolist(), strict=True))
    want = []
    for word, begin in zip(words, arcs["begin"].tolist(), strict=True):
        marked = lattice.BLANK + word
        for a in range(len(marked)):
            want += [(begin + a, begin + a + len(p), k) for k, p in enumerate(pieces) if marked.startswith(p, a)]
            want += [(begin + a, begin + a + 1, len(pieces) + 256)] if marked[a] == "x" else []
    assert got == sorted(want)
    weights = np.log(np.random.default_rng(1).dirichlet(np.ones(len(pieces) + 256), 3).T)
    kinds = np.arange(len(words)) % 3
    each = [own.expected([w for w, k in zip(words, kinds, strict=True) if k == kind], weights[:, kind]) for kind in range(3)]
    assert np.allclose(own.expected_by_class(words, kinds, weights), np.stack(each, axis=1))


def test_lattice_sums_over_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba"]
    weights = np.log(np.append(np.arange(1, 8), np.full(256, 0.01)))
    weights -= np.logaddexp.reduce(weights)
    place = {p: k for k, p in enumerate(pieces)}

    def brute(text):
        if not text:
            return 1.0
        total = 0.0
        for n in range(1, len(text) + 1):
            if text[:n] in place:
                total += math.exp(weights[place[text[:n]]]) * brute(text[n:])
        if text[0] not in place:
            own = math.prod(math.exp(weights[len(pieces) + byte]) for byte in text[0].encode())
            total += own * brute(text[1:])
        return total

    words = ["a", "b", "ab", "abba", "baab", "aé", "é\nb", ""]
    got = lattice.Lattice(pieces).log_probabilities(words, weights[:, None])[:, 0]
    assert np.allclose(got, [math.log(brute("▁" + w)) for w in words])


def test_expected_uses_are_the_slopes_of_the_log_probability():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba"]
    weights = np.log(np.append(np.arange(1, 7), np.full(256, 0.01)))
    own = lattice.Lattice(pieces)
    uses = own.expected(["abab", "ba"], weights)
    for k in range(len(pieces)):
        moved = weights.copy()
        moved[k] += 1e-6
        slope = (own.log_probabilities(["abab", "ba"], moved[:, None]).sum() - own.log_probabilities(["abab", "ba"], weights[:, None]).sum()) / 1e-6
        assert uses[k] == pytest.approx(slope, abs=1e-4)


def test_scores_of_the_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op3_lattice_scores(spark, FOLDER).collect()
    counts, ends = Counter(), 0
    for k, text in docs.items():
        if crc32(str(k).encode()) % 5 != 1:
            counts.update(text.encode().lower().split())
            ends += 1
    tokens, kinds = sum(counts.values()) + ends, len(counts) + 1
    below = tokens + 0.5 * (kinds + 1)
    assert len(rows) == len(docs)
    for r in rows:
        words = docs[r.doc_id].encode().lower().split()
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words) + 1, sum(w in counts for w in words) + 1, tokens)
        base = sum(math.log10((counts[w] + 0.5) / below) for w in words) + math.log10((ends + 0.5) / below)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    known = [r for r in rows if not r.held_out]
    assert sum(r.score for r in known) > sum(r.base_score for r in known)


def test_scores_of_odd_rows(spark, odd_docs):
    from pyspark.sql import functions as F

    vocabulary = lattice.load_vocabulary(public_tokenizers.path(queries.TOKENIZER))
    for held in (F.lit(False), F.lit(True), F.col("doc_id") % 2 == 0):
        rows = lattice.scores(odd_docs.withColumn("held", held), "held", vocabulary).collect()
        assert len(rows) == odd_docs.count() and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
        assert len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1
    assert lattice.scores(odd_docs.limit(0).withColumn("held", F.lit(False)), "held", vocabulary).count() == 0


# Secrets


def test_viterbi_equals_brute_force():
    from itertools import product

    rng = np.random.default_rng(5)
    model = secret_crf.Field({}, rng.normal(size=(3, 3)), rng.normal(size=3))
    emits = [rng.normal(size=(n, 3)) for n in (4, 0, 1, 6, 3)]

    def value(emit, tags):
        return model.begin[tags[0]] + sum(e[t] for e, t in zip(emit, tags)) + sum(model.steps[a, b] for a, b in zip(tags, tags[1:]))

    for emit, tags in zip(emits, secret_crf.viterbi(emits, model), strict=True):
        assert len(tags) == len(emit)
        if len(emit):
            assert tuple(tags) == max(product(range(3), repeat=len(emit)), key=lambda t: value(emit, t))


def test_training_learns_tags():
    kind = secret_crf.token_class
    rows = [([kind("password"), kind("="), kind("Xk9fjQ2mm4"), kind("the")], [2, 2, 0, 2], ["f"]) for _ in range(60)]
    rows += [([kind("the"), kind("word"), kind("is"), kind("here")], [2, 2, 2, 2], ["f"]) for _ in range(60)]
    model = secret_crf.train(rows)
    assert secret_crf.Tagger(model).spans(["the password = Zq8rtY3nn1 the"], [None]) != [[]]
    assert secret_crf.Tagger(model).spans(["the word is here"], [None]) == [[]]


def brute_base(text):
    import re

    assign = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans)]


def test_secrets_of_the_table(spark):
    from hashlib import sha256

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op10_secrets(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_base(texts[r.doc_id])
        assert [s for s in r.spans.split(",") if s and not s.startswith("crf")] == want
        assert r.base_sha256 == sha256(",".join(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex"))
    again = {r.doc_id: r.spans for r in queries.op10_secrets(spark, FOLDER).repartition(3).collect()}
    assert again == {r.doc_id: r.spans for r in rows}


def test_field_adds_secrets_that_the_patterns_miss(make_docs):
    rows = [(k, f"line {k} some words password = \"k{k}Zt9fQx{k * 7}Lm2\" and then more words here", "en", "s") for k in range(60)]
    rows += [(1000 + k, "plain words without anything to hide in them " * 3, "en", "s") for k in range(60)]
    model = secret_crf.learn(make_docs(rows))
    found = {r.doc_id: r.spans for r in secret_crf.scan(make_docs([
        (1, "some words password Hq7Zt9fQx31Lm2 and then more words", "en", "s"),
        (2, "plain words without anything to hide", "en", "s"),
    ]), model).collect()}
    assert found[1].startswith("crf:20:34") and found[2] == ""


def test_secrets_of_odd_rows(spark, odd_docs):
    model = secret_crf.learn(odd_docs)
    assert secret_crf.scan(odd_docs, model).count() == odd_docs.count()
    assert secret_crf.scan(odd_docs.limit(0), secret_crf.learn(odd_docs.limit(0))).count() == 0
