import hashlib
import random
import re
import struct
from collections import defaultdict
from itertools import product
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from watchlens.llm import middles, packing, prefix_trie, queries

PATH = public_tokenizers.path(queries.PACKED_TOKENIZER)


# Packing


def library_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [[*one.ids, 1] for one in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_the_library():
    rng = random.Random(5)
    parts = ["Word", "a", "’s", "'s", "naïve", "ẖ", "H̱", "̈", "ΣΑΣ", "12", "漢字", "🙂", "<|endoftext|>", "<|ENDOFTEXT|>", "!!", " ", "\x1c", "\x85", "﻿", "x" * 200, "İX", "DŽ", "Ⅷ", "ªb", "क़", "É.", "é,", "e\u0301.", "Q.", "<|x,", "I'M", "9.", " ", "\t", "\n\n", "\v", "\f", "\r\n"]
    texts = ["", " ", *("".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(400))]
    encode = packing.Encoder(packing.load_tokenizer(PATH))
    for _ in range(2):
        got = [list(struct.unpack(f"<{len(ids) // 2}H", ids)) + [1] for ids in encode.ids([text.encode() for text in texts])]
        assert got == library_ids(texts)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        packing.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("row_ids", [3, 1 << 16])
def test_pieces_and_sequences_hold_every_id_once(spark, make_docs, odd_docs, monkeypatch, row_ids):
    monkeypatch.setattr(packing, "ROW_IDS", row_ids)
    monkeypatch.setattr(packing, "BLOCK", 2)
    rng = random.Random(7)
    many = make_docs([(100 + k, " ".join(rng.choices(["of", "the", "naïve", "cat's", "42"], k=rng.randint(0, 90))), "en", "s") for k in range(60)])
    docs = odd_docs.unionByName(many).repartition(7).withColumns({"part": F.lit("p"), "begin": F.lit(1), "ids": F.lit("x"), "sequence_id": F.lit(0)})
    docs.write.parquet(path := spark.conf.get("spark.checkpoint.dir") + f"/pack-{row_ids}")
    docs = spark.read.parquet(path)
    cut = packing.windows(docs, packing.load_tokenizer(PATH), 1, 64)
    rows = packing.pieces(cut).collect()
    want = sorted((-1 if r.doc_id is None else r.doc_id, ids) for r, ids in zip(docs.collect(), library_ids([r.text or "" for r in docs.collect()]), strict=True))
    total = sum(len(ids) for _, ids in want)

    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    assert sorted(by_sequence) == list(range(-(-total // 64)))
    for sequence, own in by_sequence.items():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) == (64 if sequence < total // 64 else total % 64)

    whole = {r.sequence_id: r for r in packing.sequences(cut, 64).collect()}
    assert sorted(whole) == sorted(by_sequence)
    row = []
    for sequence in sorted(whole):
        ids = struct.unpack(f"<{whole[sequence].length}I", whole[sequence].ids)
        length = len(ids)
        assert whole[sequence].padded_length == (length if length & (length - 1) == 0 else 64)
        row += ids
        for r, s in zip(by_sequence[sequence], sorted(whole[sequence].segments, key=lambda s: s.offset), strict=True):
            assert (r.doc_id, r.start, r.length, r.offset, r.doc_tokens) == (s.doc_id, s.start, s.length, s.offset, s.doc_tokens)
            mine = ids[r.offset : r.offset + r.length]
            assert r.ids_crc32 == crc32(struct.pack(f"<{len(mine)}I", *mine))
    # The row of all ids falls back into the documents, with none lost or doubled.
    places = [(r.sequence_id * 64 + r.offset, r) for r in rows]
    got, at = [], 0
    for place, r in sorted(places, key=lambda p: p[0]):
        assert place == at
        if r.start == 0:
            got.append((-1 if r.doc_id is None else r.doc_id, []))
        assert len(got[-1][1]) == r.start
        got[-1][1].extend(row[place : place + r.length])
        at += r.length
    assert sorted(got) == want


def test_words_of_plain_letters_are_read_without_a_look_at_each(monkeypatch):
    looked = []
    monkeypatch.setattr(packing, "_stem", lambda word, own=packing._stem: looked.append(word) or own(word))
    tokenizer = packing.load_tokenizer(PATH)
    encode = packing.Encoder(tokenizer)
    texts = ["The the THE running Running, x! a.b " + "Long" * 20, "the \u00c9t\u00e9 \u00e9t\u00e9. <| " + "Long" * 20 + " ...", ""]
    for _ in range(2):
        got = [np.frombuffer(ids, encode.kind).tolist() for ids in encode.ids([text.encode() for text in texts])]
        assert got == [one.ids for one in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert looked and not any(word.isalpha() for word in looked)
    assert max(map(len, [*encode.known, *encode.stems])) <= packing.LONGEST_WORD


def test_a_batch_asks_for_each_part_of_a_word_once():
    asked = []

    class Known(dict):
        def get(self, part, default=None):
            asked.append(part)
            return super().get(part, default)

    encode = packing.Encoder(packing.load_tokenizer(PATH))
    encode.known = Known()
    texts = [" The the THE, the!? (the) 2019; 2019 l\u2019\u00e9t\u00e9, \u00e9t\u00e9 \u00e9t\u00e9&&& " * 20, "the,\n" * 30, ""] * 10
    got = [np.frombuffer(ids, encode.kind).tolist() for ids in encode.ids([text.encode() for text in texts])]
    assert got == [one.ids for one in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert 0 < len(asked) == len(set(asked)) <= 12


def test_signs_after_any_character_equal_the_library(monkeypatch):
    ends = ["", "\u00e9", "\u00c9", "\u0130", "\u0131", "\u03a3", "\u03c2", "\u00df", "\u017f", "\u01c5", "e\u0301", "\u0345", "\u00aa", "\u00b2", "\u2167", "\u0663", "\u6f22", "\x7f", "\x1c", "\xa0", "\u2019", "9", "Z"]
    signs = [",", "!!", "'s", "'", "<|", "|>", "<|endoftext|>", "&&&", ".'", "=\u0338", "-"]
    words = [start + end + sign for start, end, sign in product(["", "a", "X1", "\u00d1"], ends, signs)]
    encode = packing.Encoder(packing.load_tokenizer(PATH))
    monkeypatch.setattr(packing, "REMEMBERED", 300)
    monkeypatch.setattr(packing, "REMEMBERED_STEMS", 10)
    for k in range(4):
        texts = [" ".join(random.Random(k).sample(words, 40)) for _ in range(3)] + words[k::4]
        got = [np.frombuffer(ids, encode.kind).tolist() + [1] for ids in encode.ids([text.encode() for text in texts])]
        assert got == library_ids(texts)
    broken = [b"a\xff, the\xc3 \xe2\x82. b", b"\xc3", b"fine"]
    got = [np.frombuffer(ids, encode.kind).tolist() + [1] for ids in encode.ids(broken)]
    assert got == library_ids([text.decode("utf-8", "replace") for text in broken])


def test_packing_an_empty_table(spark, make_docs):
    cut = packing.windows(make_docs([]), packing.load_tokenizer(PATH), 1)
    assert packing.pieces(cut).collect() == [] and packing.sequences(cut).collect() == []


def test_starts_over_blocks_of_partitions(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 3)
    lengths = {part: [part + 1, 2] for part in range(11) if part != 4}
    rows = spark.createDataFrame([(p, n) for p, ns in lengths.items() for n in ns], "part int, length long")
    got = {r.part: r.begin for r in packing.partition_starts(rows).collect()}
    assert got == {p: sum(sum(ns) for q, ns in lengths.items() if q < p) for p in lengths}


# Fill-in-the-middle

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]")


@pytest.mark.parametrize("step", [7, 1 << 20])
def test_skip_list_finds_every_rank(monkeypatch, step):
    monkeypatch.setattr(middles, "STEP_BYTES", step)
    rng = random.Random(step)
    texts = ["", "a", "é", "🙂" * 70, "word " * 3000, "x" * 5000, "\n\x00\x7f"]
    texts += ["".join(rng.choices(["abc", "Z", " ", "é", "漢", "🙂", "1", "\n", "{", "@", "`", "["], k=rng.randint(1, 1500))) for _ in range(12)]
    for text in texts:
        units = UNITS.findall(text)
        lists = middles.SkipList(text.encode())
        assert len(lists) == len(units)
        for rank in {0, 1, len(units), *(rng.randint(0, len(units)) for _ in range(50))} & set(range(len(units) + 1)):
            before = "".join(units[:rank])
            assert lists.find(rank) == (len(before), len(before.encode()))


def by_hand(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    p, m, s = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_middles_equal_a_plain_computation(spark, make_docs, odd_docs):
    rng = random.Random(11)
    parts = ["abc", "Z", " ", "é", "漢", "🙂", "1", "\n", "<", "P", ">", "S>", "<M", "<S"]
    more = [(200 + k, "".join(rng.choices(parts, k=rng.randint(0, 60))), "en", "s") for k in range(300)]
    docs = odd_docs.unionByName(make_docs(more)).withColumns({"form": F.lit("f"), "h1": F.lit(1), "output": F.lit(1), "n": F.lit(1)})
    order = lambda row: tuple((value is not None, value) for value in row)
    want = sorted(((r.doc_id, *by_hand(r.doc_id, r.text)) for r in docs.collect()), key=order)
    cut = middles.transform(docs)
    assert sorted((tuple(r) for r in cut.collect()), key=order) == want
    forms = {row[2] for row in want}
    assert forms == {"plain", "psm", "spm"}
    back = cut.select("doc_id", middles.restore(F.col("output"), F.col("form"))).collect()
    assert sorted(map(tuple, back), key=order) == sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=order)
    assert middles.transform(make_docs([])).collect() == []


def test_bytes_that_are_no_text(spark):
    docs = spark.range(8).selectExpr("id AS doc_id", "CAST(unhex('61FF62C3') AS STRING) AS text")
    for row in middles.transform(docs).collect():
        assert (row.n, *row[2:]) == by_hand(row.doc_id, "a�b�")[0:1] + by_hand(row.doc_id, "a�b�")[1:]


# Conversation trie


def nodes_by_hand(paths):
    """paths: conv_id -> [(role, text)]."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, path in paths.items():
        ends[tuple(path)].append(conv)
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(conv)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[c] for c in children[p])
    return sorted(
        (min(own), len(p), min(members[p[:-1]]) if p else -1, len(own), len(children[p]), leaves[p], saved[p])
        + (hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),)
        for p, own in members.items()
    )


def rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {conv: [t for _, t in sorted(ts, key=lambda t: t[0])] for conv, ts in turns.items()}
    heads = {c: crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - c % 20, [])[: heads[c]] + own[c][heads[c] :] for c in own}


def trie(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {"path": F.lit(1), "key": F.lit("k"), "t": F.lit(0), "digest": F.lit(2)}
    )
    result = prefix_trie.prefix_trie(prefix_trie.shared_heads(prefix_trie.conversations(turns)))
    assert result.columns == ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *r[3:]) for r in result.collect())


@pytest.mark.parametrize(("shard", "listed", "broadcast"), [(5, 3, 0), (40, 1024, 10**5), (10**6, 7, 10**5)])
def test_trie_equals_all_prefixes(spark, monkeypatch, shard, listed, broadcast):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard)
    monkeypatch.setattr(prefix_trie, "LISTED_IDS", listed)
    monkeypatch.setattr(prefix_trie, "BROADCAST_NODES", broadcast)
    rng = random.Random(shard)
    words = ["", "one", "two words", "a b  c", "naïve x"]
    rows = []
    for conv in range(150):
        if conv % 3 == 0:  # a large group of copies
            own = [("user", "one"), ("assistant", "two words"), ("user", "a b  c"), ("user", "end")]
        else:
            own = [(rng.choice(["user", None, ""]), rng.choice([*words, None])) for _ in range(rng.randint(1, 7))]
        rows += [(conv, None if k == 0 and conv % 2 else k, *turn) for k, turn in enumerate(own)]
    del rows[:4]  # conversation 0 is absent, so its followers start with nothing
    rows += [(None, 0, "user", "lost"), (-7, 0, "user", "one")] + [(5000, k, "user", "long") for k in range(700)]
    rng.shuffle(rows)
    assert trie(spark, rows) == nodes_by_hand(rebuilt(rows))


def test_trie_of_few_rows(spark):
    assert trie(spark, []) == []
    rows = [(21, 0, "user", "gone")]  # its head comes from an absent conversation
    assert trie(spark, rows) == nodes_by_hand(rebuilt(rows))
    assert [len(p) for p in rebuilt(rows).values()] == [0 if crc32(b"21") % 4 else 1]


def test_ternary_tree_stays_level():
    tree = prefix_trie.TernaryTree()
    paths = [list(p) for p in product(range(9), repeat=3)]
    for k in prefix_trie.medians(len(paths)):
        tree.insert(paths[k], [1, 1, 1])
    depth, most = {tree.root: 1}, 0
    for node in range(len(tree.number)):
        for link in (tree.low[node], tree.high[node]):
            if link >= 0:
                depth[link] = depth.get(node, 1) + 1
                most = max(most, depth[link])
    assert most <= 5 and sum(1 for _ in tree.walk()) == 9 + 81 + 729
