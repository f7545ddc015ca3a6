import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from watchlens.llm import decontaminate, queries, similar, simhash
from watchlens.llm.components import components

FOLDER = "/root/testdata/sf0.01"


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + k, 1001 + k) for k in range(60)]
    edges += [(-5, k) for k in range(2000, 2040)] + [(None, 7), (9, 9)]
    sets = Sets()
    for a, b in edges:
        if a is not None and a != b:
            sets.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: sets.find(x) for x in sets.up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**12 - 1), min_size=1, max_size=80), st.integers(0, 3))
def test_tree_joins_what_lies_within_the_radius(values, radius):
    tree, sets = simhash.BKTree(radius), Sets()
    for n, value in enumerate(values):
        for k in tree.add(value):
            assert (tree.values[k] ^ value).bit_count() <= radius
    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= radius:
                sets.join(a, b)
    for a in range(len(values)):
        for b in range(a):
            assert (tree.root(a) == tree.root(b)) == (sets.find(a) == sets.find(b))


@pytest.mark.parametrize("count", [10, 10_000, 10**7, 10**10])
def test_some_mask_keeps_every_difference_within_the_radius(count):
    rng = random.Random(count)
    masks = [m & (2**64 - 1) for m in simhash._masks(count, 4)]
    for _ in range(500):
        other = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not other & m for m in masks)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components_of_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op8_near_copies(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    prints = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    for k in random.Random(1).sample(sorted(texts), 60):
        assert prints[k] == brute_fingerprint(texts[k])
    ids = sorted(prints)
    values = np.array([prints[k] for k in ids], np.uint64)
    sets = Sets()
    for n, k in enumerate(ids):
        differing = np.unpackbits((values[n:] ^ values[n]).view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1)
        for m in np.flatnonzero(differing <= 4):
            sets.join(k, ids[n + int(m)])
    assert {r.doc_id: r.component_id for r in rows} == {k: sets.find(k) for k in ids}


def test_thick_clusters_over_several_trees_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TREE_ROWS", 20)
    rng = random.Random(3)
    centre = [rng.getrandbits(64) for _ in range(4)]
    values = set()
    for c in centre:
        for _ in range(80):
            values.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))))
    prints = spark.createDataFrame([(simhash.signed(v),) for v in values], "fingerprint long")
    sets = Sets()
    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= 4:
                sets.join(simhash.signed(a), simhash.signed(b))
    got = {r.node: r.root for r in components(simhash.links(prints, 4, len(values))).collect()}
    assert {k: v for k, v in got.items()} == {k: sets.find(k) for k in sets.up}


def test_copies_of_odd_rows(spark, odd_docs):
    rows = simhash.near_copies(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by[k].component_id for k in (0, 1, 2)} == {0} and by[0].fingerprint == "0" * 16
    assert by[3].component_id == by[4].component_id == 3 and by[5].component_id == by[6].component_id == 5
    assert simhash.near_copies(odd_docs.limit(0)).count() == 0
    kept = similar.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([0, 3, 5, 7, 8, 9, 10])
    assert similar.one_of_each(odd_docs.limit(0)).count() == 0


def shingles(text):
    words = text.encode().lower().split()
    return {b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def test_similar_documents_equal_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    own, where = {k: shingles(t) for k, t in texts.items()}, defaultdict(list)
    for k, found in own.items():
        for s in found:
            where[s].append(k)
    shared = Counter((a, b) for ids in where.values() if len(ids) < 200 for a in ids for b in ids if a < b)
    sets = Sets()
    for k in texts:
        sets.find(k)
    for (a, b), n in shared.items():
        if n / (len(own[a]) + len(own[b]) - n) >= 0.8:
            sets.join(a, b)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert {r.doc_id: r.component_id for r in similar.similar_documents(docs).collect()} == {k: sets.find(k) for k in texts}


def test_edited_copies_go_and_others_stay(make_docs):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = []
    for k in range(40):
        base = [word() for _ in range(300)]
        rows.append((k, " ".join(base), "en", "s"))
        for copy in range(3):
            edited = list(base)
            for at in rng.sample(range(300), 4):
                edited[at] = word()
            rows.append((100 + 10 * k + copy, " ".join(edited), "en", "s"))
    kept = {r.doc_id for r in similar.one_of_each(make_docs(rows)).collect()}
    assert kept == set(range(40))


def test_repeated_lines_do_not_part_copies(make_docs):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = []
    for k in range(30):
        base, line = [word() for _ in range(200)], [word() for _ in range(20)]
        rows += [(k, " ".join(base + line), "en", "s"), (100 + k, " ".join(base + line * 20), "en", "s")]
    assert all(len(shingles(a[1]) & shingles(b[1])) >= 0.8 * len(shingles(b[1])) for a, b in zip(rows[::2], rows[1::2], strict=True))
    assert {r.doc_id for r in similar.one_of_each(make_docs(rows)).collect()} == set(range(30))


def test_long_texts_are_judged_by_their_whole_sets(make_docs):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    rows, kept = [], set()
    for k in range(120):
        # Two texts of 1,000 shingles each that share just under, or just over, four fifths of all.
        share, base = 880 if k % 2 else 898, [word() for _ in range(1004)]
        other = base[: share + 4] + [word() for _ in range(1000 - share)]
        rows += [(k, " ".join(base), "en", "s"), (1000 + k, " ".join(other), "en", "s")]
        kept |= {k, 1000 + k} if k % 2 else {k}
    assert {r.doc_id for r in similar.one_of_each(make_docs(rows)).collect()} == kept


# Leaks


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=9), st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=12))
def test_common_words_are_the_longest_common_subsequence(item, region):
    table = [[0] * (len(region) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item):
        for j, b in enumerate(region):
            table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
    assert decontaminate.common_words(item, region) == table[-1][-1]


def test_leaks_of_the_table_are_those_of_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    want = set()
    for k, text in texts.items():
        words = decontaminate.split_words(text.encode())
        for item, own in items.items():
            own = decontaminate.split_words(own.encode())
            grams = {tuple(own[n : n + 4]) for n in range(len(own) - 3)}
            if sum(tuple(words[n : n + 4]) in grams for n in range(len(words) - 3)) >= 0.7 * len(grams):
                want.add((k, item))
    rows = queries.op2_benchmark_leaks(spark, FOLDER).collect()
    assert want and {(r.doc_id, r.item_id) for r in rows} == want


def test_paraphrases_are_found_and_clean_documents_left(spark, make_docs):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(4000)]
    plain = lambda n: [rng.choice(vocabulary[:200] if rng.random() < 0.5 else vocabulary) for _ in range(n)]
    items = [(k, " ".join(plain(rng.randrange(15, 60))).capitalize() + ".") for k in range(30)]
    rows, leaked = [], {}
    for k in range(200):
        words = plain(rng.randrange(20, 800))
        if k % 4 == 0:
            item, own = rng.choice(items)[0], None
            own = [w for w in items[item][1].split() if rng.random() > 0.1]
            for at in range(0, len(own), 11):
                own.insert(at, rng.choice(vocabulary))
            place = rng.randrange(len(words))
            words[place:place] = own
            leaked[k] = item
        rows.append((k, " ".join(words), "en", "s"))
    docs, benchmark = make_docs(rows), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert found == set(leaked.items())
    kept = decontaminate.clean_documents(docs, benchmark)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(200)) - set(leaked)


@pytest.mark.parametrize("size", [100, 400, 1000])
def test_long_items_are_found_wherever_they_stand(spark, make_docs, size):
    rng = random.Random(size)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(4000)]
    plain = lambda n: [rng.choice(vocabulary[:200] if rng.random() < 0.5 else vocabulary) for _ in range(n)]
    items = {k: plain(size if k < 6 else 30) for k in range(12)}
    rows, leaked = [], set()
    for k in range(108):
        words, item = plain(rng.randrange(20, 2500)), k % 12
        if k < 72:
            own = list(items[item])
            if k % 2:
                own = [w for w in own if rng.random() > 0.1]
                for at in range(0, len(own), 11):
                    own.insert(at, rng.choice(vocabulary))
            place = (0, len(words) // 2, len(words))[k // 12 % 3]
            words[place:place] = own
            leaked.add((k, item))
        rows.append((k, " ".join(words), "en", "s"))
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(make_docs(rows), benchmark).collect()} == leaked


def test_all_documents_shape_the_space(spark, make_docs):
    rng = random.Random(3)
    words = ["amber", "birch", "cedar", "dahlia", "elm", "fern"]
    rows = [[rng.choice(words[: 2 + k % 5]) for _ in range(rng.randrange(1, 14))] for k in range(1800)]
    items = decontaminate.Items([1], [[w.encode() for w in words]], [[b"fern"]], [False], {w.encode(): k for k, w in enumerate(words)})
    docs = make_docs([(k, " ".join(own), "en", "s") for k, own in enumerate(rows)])
    finder = decontaminate._finder(docs, items)
    idf = np.array([np.log(1801 / (sum(w in own for own in rows) + 1)) + 0.05 for w in words])
    different = np.array([[own.count(w) for w in words] for own in {tuple(own) for own in rows}]) * idf
    gram = different.T @ different
    # With as many directions as words the space is known: the inverse of all different passages' products, evened.
    space = finder.rows / idf[:, None]
    known = np.linalg.inv(gram + decontaminate.EVENING * np.trace(gram) / len(words) * np.eye(len(words)))
    assert np.allclose(space @ space.T, known, rtol=1e-3, atol=1e-3 * np.abs(known).max())


def test_passages_reach_the_end_of_a_text():
    items = decontaminate.Items([1], [[b"w%d" % k for k in range(90)]], [[b"w89"]], [False], {b"w%d" % k: k for k in range(90)})
    finder = decontaminate.Finder(items, np.eye(90), np.ones(90))
    for before in range(0, 400, 7):
        found = [b"x"] * before + items.words[0]
        ends = [step + size for step, size, _ in finder.candidates(found)[0]]
        assert max(ends) * decontaminate.STEP >= len(found)


def test_numbers_are_those_of_words_without_their_signs():
    words = [b"a", b"the", b"the\0", b"a\0b", b"\0", "\u00e9t\u00e9".encode(), b"x" * 8, b"x" * 9, b"y" * 64, b"y" * 65]
    place = {w: 3 * k for k, w in enumerate(words)}
    rng = random.Random(8)
    signs = ["", "", ".", "--", "(", "|", "!?"]
    pool = [w.decode() for w in words] + ["The", "\u00c9T\u00c9", "thes", "x" * 7, "y" * 66, "-", "...", "a-the"]
    made = [" \t\n\v\f\r"[rng.randrange(6)].join(rng.choice(signs) + rng.choice(pool) + rng.choice(signs) for _ in range(n)) for n in range(60)]
    data = [text.encode() for text in ["", " ", "  the  ", *made]] + [b"\xff the \xc3"]
    for text, (at, numbers, count) in zip(data, decontaminate.Numbers(place).passages(data), strict=True):
        found = decontaminate.raw_words(text)
        want = [(k, place[w]) for k, word in enumerate(found) for w in decontaminate.bare([word]) if w in place]
        assert list(zip(at.tolist(), numbers.tolist(), strict=True)) == want and count == len(found)


def test_items_are_only_searched_where_their_words_stand_close():
    words = [b"w%d" % k for k in range(16)]
    items = decontaminate.Items([1], [words], [words[-3:]], [False], {w: k for k, w in enumerate(words)})
    finder = decontaminate.Finder(items, np.eye(16), np.ones(16))
    # Ten of sixteen words must stand within 60.
    apart = lambda n: [b"x"] * 50 + [w for word in words for w in (word, *[b"x"] * n)] + [b"x"] * 50
    assert finder.candidates(apart(6)) == {} and list(finder.candidates(apart(5))) == [0]
    assert list(finder.matches([b" ".join(apart(6)), b" ".join(apart(0))]))[0] == []


@pytest.mark.parametrize("cut", [0.2, 0.3])
def test_items_without_their_end_are_found(spark, make_docs, cut):
    rng = random.Random(40)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(4000)]
    items = [[rng.choice(vocabulary) for _ in range(40)] for _ in range(12)]
    rows = []
    for k in range(72):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 900))]
        own = items[k % 12][: round(40 * (1 - cut))] if k < 36 else []
        place = (0, len(words) // 2, len(words))[k // 12 % 3]
        words[place:place] = own
        rows.append((k, " ".join(words), "en", "s"))
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(make_docs(rows), benchmark).collect()}
    assert found == {(k, k % 12) for k in range(36)}


def test_common_words_without_the_end_stand_close():
    item = [b"w%d" % k for k in range(10)]
    assert decontaminate.dense_words(item, [b"x"] * 30 + item[:8] + [b"x"] * 30) == 8
    scattered = [w for word in item[:8] for w in (word, *[b"x"] * 6)]
    assert decontaminate.common_words(item, scattered) == 8 and decontaminate.dense_words(item, scattered) <= 3


def test_an_answer_must_be_there(spark, make_docs):
    item = "which of these green stones is found on the long northern shore every dark winter"
    rng = random.Random(2)
    others = [(100 + k, " ".join(rng.choice(item.split() + ["amber", "it", "was", "he"]) for _ in range(30))) for k in range(60)]
    others += [(300 + k, f"other {k} words {k * 7} that say nothing") for k in range(300)]
    docs = make_docs([(1, f"they asked {item} and it was amber said he"), (2, f"they asked {item} and nobody knew"), *others])
    benchmark = spark.createDataFrame([(0, item, "amber")], "item_id long, text string, answer string")
    assert [r.doc_id for r in decontaminate.leaks(docs, benchmark).collect()] == [1]


def test_leaks_of_odd_rows(spark, odd_docs):
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "word"), (3, "word"), (None, "a b c")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(odd_docs, odd).collect()}
    assert {(3, 3), (4, 3)} <= found and not any(k in (0, 1, 2) for k, _ in found)
    assert decontaminate.leaks(odd_docs, odd.limit(0)).count() == 0
    assert decontaminate.leaks(odd_docs.limit(0), odd).count() == 0
    assert decontaminate.clean_documents(odd_docs, odd.limit(0)).count() == odd_docs.count()


# Pipeline


def test_pipeline_stages_do_their_part(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources", "sharding",
    ]
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == [*docs.columns, "shard"]
    out = Counter(r.doc_id for r in rows.collect())
    assert out and max(out.values()) <= 3
    assert not [k for k in out if labels.get(k) == 0]
    leaked = {r.doc_id for r in queries.op2_benchmark_leaks(spark, FOLDER).collect()}
    assert not leaked & set(out)
    assert len({texts[k] for k in out}) == len(out)
    assert len({r.shard for r in rows.collect()}) == 24
