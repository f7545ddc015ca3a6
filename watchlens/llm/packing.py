"""Packing documents into token sequences of one length: concatenate and cut.

All documents' ids, each closed by an end id, form one long row of ids that is cut into
windows. The first pass tokenises and adds up ids by partition; prefix sums over those totals
say where every partition begins. In the second pass each task cuts its own stretch:
windows inside the stretch are whole, and what lies in the windows that the stretch shares with its
neighbours becomes boundary records, the only ones that `sequences` has to put together.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchlens.llm.text import bound_batches, texts
from watchlens.session import materialize, shared_folder

#: Most ids of a document in one row between the passes; longer documents take several rows.
ROW_IDS = 1 << 16
#: Parts of words after which a Python worker starts a new table beside the one before, stems of odd words after
#: which it starts anew, and the longest part that it remembers.
REMEMBERED, REMEMBERED_STEMS, LONGEST_WORD = 600_000, 200_000, 64
#: Stems that the tokenizer reads together, and what ends the last piece of a word.
TOGETHER, WORD_END = 200, "</w>"
#: Signs that are cut off a word's end before it is looked up: all of ASCII's.
SIGNS = bytes(sign for sign in range(33, 127) if not chr(sign).isalnum())
#: For each byte, whether it is an ASCII letter or digit.
PLAIN = np.array([chr(byte).isalnum() and byte < 128 for byte in range(256)])
#: Partitions whose totals are added up in one window task, and how many starts are broadcast at most.
BLOCK, BROADCAST_STARTS = 1024, 1 << 20
#: Bytes of an id in packed sequences (little-endian, unsigned).
ID_BYTES = 4


class Encoder:
    """Ids of whole texts by a tokenizer that reads words between blanks one by one.

    `load_tokenizer` refuses others. A batch's different words are found and cut into stem and signs in Arrow, and
    put together again there; only their different parts are looked up one by one. A stem goes in lower case, and
    without the signs at its end, where that is sure to give the same ids; stems of small letters alone need no
    normalising and are read many at a time, as each gives just one piece that ends a word.
    """

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(tokenizer)
        bare = json.loads(tokenizer)
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        bare |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]}}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        self.kind = id_kind(self.tokenizer.get_vocab_size())
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends_word[number] = token.endswith(WORD_END)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.stems: dict[bytes, bytes] = {}

    def _one_by_one(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([word.decode("utf-8", "replace") for word in words], add_special_tokens=False)
        return [np.array(one.ids, self.kind).tobytes() for one in found]

    def _letters(self, stems: list[bytes]) -> dict[bytes, bytes]:
        width, here = np.dtype(self.kind).itemsize, {}
        groups = [stems[k : k + TOGETHER] for k in range(0, len(stems), TOGETHER)]
        for group, one in zip(groups, self.bare.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(one.ids, self.kind)
            ends = ((np.flatnonzero(self.ends_word[ids]) + 1) * width).tolist()
            if len(ends) != len(group):
                here.update(zip(group, self._one_by_one(group), strict=True))
                continue
            data = ids.tobytes()
            here.update((stem, data[begin:end]) for stem, begin, end in zip(group, [0, *ends[:-1]], ends, strict=True))
        return here

    def _learn(self, parts: list[bytes]) -> dict[bytes, bytes]:
        if len(self.stems) > REMEMBERED_STEMS:
            self.stems.clear()
        # Parts of small letters a-z need no look at their characters.
        letters = [part for part in parts if part.isalpha() and part.islower()]
        others = list(set(parts).difference(letters))
        cut = list(map(_stem, others))
        new = set(chain.from_iterable(cut)).difference(self.stems).difference(letters, (b"",))
        more = [stem for stem in new if _is_small_letters(stem)]
        rest = list(new.difference(more))
        here = dict(zip(rest, self._one_by_one(rest), strict=True)) if rest else {}
        here.update(self._letters([*letters, *more]))
        known = self.stems.get
        find = lambda part: known(part) or here.get(part, b"")
        out = {part: here[part] for part in letters}
        out.update((part, find(stem) + find(sign) if sign else find(stem)) for part, (stem, sign) in zip(others, cut, strict=True))
        _remember(self.stems, {stem: here[stem] for stem in new.difference(out)})
        return out

    def _find(self, parts: list[bytes]) -> list[bytes]:
        """The ids of different parts, looked up or learnt."""
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        found = list(map(self.known.get, parts))
        gaps = [k for k, ids in enumerate(found) if ids is None]
        unknown = {parts[k] for k in gaps}
        here = {part: self.older[part] for part in unknown.intersection(self.older)} if self.older else {}
        here |= self._learn(list(unknown.difference(here)))
        for k in gaps:
            found[k] = here[parts[k]]
        _remember(self.known, here)
        return found

    def ids(self, data: list[bytes]) -> Iterator[bytes]:
        """Each text's ids, as bytes."""
        texts = pa.array(data, pa.large_binary()).view(pa.large_string())
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            data = [text.decode("utf-8", "replace").encode() for text in data]
            texts = pa.array(data, pa.large_binary()).view(pa.large_string())
        words = pc.ascii_split_whitespace(texts)
        codes = words.flatten().dictionary_encode()
        parts = _parts(codes.dictionary).dictionary_encode()
        found = self._find(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        ends, ids = _buffers(pa.array(found, pa.large_binary()).take(parts.indices))
        # A word's parts lie side by side, so that every other end is a word's.
        by_word = pa.Array.from_buffers(pa.large_binary(), len(codes.dictionary), [None, pa.py_buffer(ends[::2].copy()), pa.py_buffer(ids)])
        ends, ids = _buffers(by_word.take(codes.indices))
        ends = ends[words.offsets.to_numpy()].tolist()
        return (bytes(ids[begin:end]) for begin, end in zip(ends[:-1], ends[1:], strict=True))


def _buffers(values: pa.LargeBinaryArray) -> tuple[np.ndarray, memoryview]:
    """Where values begin and end in their bytes, and those bytes."""
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, np.int64)[values.offset : values.offset + len(values) + 1] if ends else np.zeros(1, np.int64)
    return ends, memoryview(data or b"")


def _parts(words: pa.LargeStringArray) -> pa.LargeBinaryArray:
    """Two parts a word, whose ids together are the word's: a stem and its last signs, or the whole word and nothing.

    Stems have a-z for A-Z. What `_stem` says of one word holds here for many; words with characters from U+0300 on, which
    may change when they are normalised, with U+0130, or with other characters than letters beyond ASCII are left to it.
    """
    stems = pc.ascii_rtrim(words, SIGNS.decode())
    ends, data = _buffers(words)
    lengths = pc.binary_length(stems).to_numpy()
    cuts = ends[:-1] + lengths
    ascii_only = pc.string_is_ascii(words).to_numpy(zero_copy_only=False)
    last = np.frombuffer(data, np.uint8)[np.maximum(cuts - 1, 0)] if len(data) else np.zeros(len(words), np.uint8)
    special = pc.match_substring(words, "<|").to_numpy(zero_copy_only=False)
    sure = ascii_only & (PLAIN[last] | (cuts == ends[1:])) & ~special
    other = np.flatnonzero(~ascii_only)
    beyond = stems.take(pa.array(other))
    letters = pc.and_(pc.utf8_is_alpha(beyond), pc.invert(pc.match_substring_regex(beyond, r"[\x{130}\x{300}-\x{10ffff}]")))
    sure[other] = letters.to_numpy(zero_copy_only=False)
    sure |= lengths == 0
    both = np.empty(2 * len(words) + 1, np.int64)
    both[::2], both[1::2] = ends, np.where(sure, cuts, ends[1:])
    small = pc.if_else(pa.array(sure), pc.ascii_lower(words), words)
    begins, data = _buffers(small)
    return pa.Array.from_buffers(pa.large_binary(), 2 * len(words), [None, pa.py_buffer(both - ends[0] + begins[0]), pa.py_buffer(data)])


def _remember(known: dict[bytes, bytes], here: dict[bytes, bytes]) -> None:
    known.update(here)
    for word in here:
        if len(word) > LONGEST_WORD:
            known.pop(word)


def _is_small_letters(stem: bytes) -> bool:
    if stem.isalpha():
        return stem.islower()
    text = stem.decode("utf-8", "replace")
    return text.isalpha() and text.lower() == text and unicodedata.is_normalized("NFC", text)


def _stem(word: bytes) -> tuple[bytes, bytes]:
    """A word as stem and last signs, whose ids together are the word's; the whole word where that is not sure.

    Signs after a letter or digit are a piece of their own, and A-Z become small, as long as the characters stay as they are when
    they are normalised. Small U+0130 ends in a mark that is read with the signs.
    """
    stem = word.rstrip(SIGNS) or word
    small, sign = stem.lower(), word[len(stem) :]
    if stem.isalpha():
        return small, sign
    if stem.isascii():
        sure = b"<|" not in stem and (not sign or stem[-1:].isalnum())
    else:
        try:
            text = stem.decode()
        except UnicodeDecodeError:
            return word, b""
        sure = "<|" not in text and (not sign or text[-1].isalpha() and text[-1] != "\u0130")
        sure = sure and unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", small.decode())
    return (small, sign) if sure else (word, b"")


_encoders: dict[str, Encoder] = {}


def encoder(tokenizer: str) -> Encoder:
    """This worker's encoder, kept from task to task with the words it has met."""
    if tokenizer not in _encoders:
        _encoders.clear()
        _encoders[tokenizer] = Encoder(tokenizer)
    return _encoders[tokenizer]


def id_kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def load_tokenizer(path: str) -> str:
    """A tokenizer file's text, if no token of it reaches across the blanks between words."""
    text = Path(path).read_text()
    how = json.loads(text)
    steps = (how.get("pre_tokenizer") or {}).get("pretokenizers") or []
    blanks_cut = bool(steps) and steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and r"[^\s" in steps[0]["pattern"].get("Regex", "")
    byte_level = all(step["type"] == "ByteLevel" and not step["add_prefix_space"] and not step["use_regex"] for step in steps[1:])
    normal = {step["type"] for step in (how.get("normalizer") or {}).get("normalizers", [])} == {"NFC", "Replace", "Lowercase"}
    stretched = [t for t in how.get("added_tokens", []) if t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(" \t\n\v\f\r")]
    ends = (how.get("model") or {}).get("end_of_word_suffix") == WORD_END
    if not ends or not normal or not blanks_cut or not byte_level or stretched or how.get("truncation") or how.get("padding"):
        raise ValueError(f"{path} does not read words between blanks one by one")
    return text


def tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Rows of ids: `part` and `place` (ids before it in its partition), document, `start`, `length`, `ids`."""
    from tokenizers import Tokenizer

    bound_batches(docs.sparkSession)
    kind = id_kind(max(Tokenizer.from_str(tokenizer).get_vocab_size(), end_id + 1))
    end, width = np.array([end_id], kind).tobytes(), np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer)
        encode.kind = kind
        for batch in batches:
            rows, at, starts, lengths, totals, ids = [], [], [], [], [], []
            for row, encoded in enumerate(encode.ids(texts(batch))):
                encoded += end
                total = len(encoded) // width
                for start in range(0, total, ROW_IDS):
                    length = min(ROW_IDS, total - start)
                    rows.append(row)
                    at.append(place)
                    starts.append(start)
                    lengths.append(length)
                    totals.append(total)
                    ids.append(encoded[start * width : (start + length) * width])
                    place += length
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(rows), pa.int32()),
                    pa.array(at, pa.int64()),
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["part", "place", "doc_id", "start", "length", "doc_tokens", "ids"],
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"part int, place long, doc_id {doc_id}, start long, length long, doc_tokens long, ids binary"
    )


def partition_starts(rows: DataFrame) -> DataFrame:
    """(part, begin): the ids in all partitions before, added up in blocks and over the blocks' totals."""
    totals = rows.groupBy("part").agg(F.sum("length").alias("total")).withColumn("block", F.floor(F.col("part") / BLOCK))
    before = (Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("total").alias("total"))
    earlier = F.coalesce(F.sum("total").over(Window.orderBy("block").rowsBetween(*before)), F.lit(0))
    within = F.coalesce(F.sum("total").over(Window.partitionBy("block").orderBy("part").rowsBetween(*before)), F.lit(0))
    return (
        totals.withColumn("within", within)
        .join(blocks.select("block", earlier.alias("earlier")), "block")
        .select("part", (F.col("earlier") + F.col("within")).alias("begin"))
    )


def cut(rows: DataFrame, length: int, kind: str) -> DataFrame:
    """Windows of `length` ids from rows (begin, doc_id, start, doc_tokens, ids), each as far as a task has it.

    `first` is the record's place in its window, `whole` says that nothing is missing. Rows
    that follow each other in a task go on in one record; after any gap a new record begins.
    """
    doc_id = rows.schema["doc_id"].dataType.simpleString()
    segment = f"struct<doc_id: {doc_id}, start: bigint, length: bigint, doc_tokens: bigint, offset: bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, expected = None, -1
        done: list[tuple] = []

        def batch_of(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
            flat = [piece for record in done for piece in record[2]]
            ends = np.cumsum([0, *(len(record[2]) for record in done)])
            fields = [pa.array([piece[0] for piece in flat], id_type), *(pa.array([piece[k] for piece in flat], pa.int64()) for k in range(1, 5))]
            pieces = pa.StructArray.from_arrays(fields, names=["doc_id", "start", "length", "doc_tokens", "offset"])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([record[0] for record in done], pa.int64()),
                    pa.array([record[1] for record in done], pa.int64()),
                    pa.array([sum(map(len, record[3])) == length * ID_BYTES for record in done], pa.bool_()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces),
                    pa.array([b"".join(record[3]) for record in done], pa.binary()),
                ],
                names=["sequence_id", "first", "whole", "segments", "ids"],
            )

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            columns = [batch.column(name).to_pylist() for name in ("begin", "doc_id", "start", "doc_tokens", "ids")]
            for begin, doc, start, total, data in zip(*columns, strict=True):
                ids = np.frombuffer(data, kind).astype("<u4").tobytes()
                if begin != expected and open_:
                    done.append(open_)
                    open_ = None
                expected = at = begin
                expected += len(ids) // ID_BYTES
                while at < expected:
                    sequence, offset = divmod(at, length)
                    size = min(expected - at, length - offset)
                    if open_ is None:
                        open_ = (sequence, offset, [], [])
                    open_[2].append((doc, start + at - begin, size, total, offset))
                    open_[3].append(ids[(at - begin) * ID_BYTES : (at - begin + size) * ID_BYTES])
                    at += size
                    if offset + size == length:
                        done.append(open_)
                        open_ = None
                if len(done) >= 1000:
                    yield batch_of(done, id_type)
                    done = []
        if open_:
            done.append(open_)
        if done:
            yield batch_of(done, id_type)

    return rows.select("begin", "doc_id", "start", "doc_tokens", "ids").mapInArrow(
        run, f"sequence_id long, first long, whole boolean, segments array<{segment}>, ids binary"
    )


def windows(docs: DataFrame, tokenizer: str, end_id: int, length: int = 2048) -> DataFrame:
    """The windows of the documents' ids in the order of the table, boundary records beside whole ones.

    A null text is empty and gives its end id alone; an empty table gives no window. Equal rows
    are packed one by one, and rows with a null id too. Other columns are not read. Long texts
    are cut anywhere; no row between the passes holds over `ROW_IDS` ids.
    """
    from tokenizers import Tokenizer

    kind = id_kind(max(Tokenizer.from_str(tokenizer).get_vocab_size(), end_id + 1))
    rows = materialize(tokenized(docs, tokenizer, end_id), "token-rows")
    starts = materialize(partition_starts(rows), "token-starts")
    small = starts.count() <= BROADCAST_STARTS
    placed = rows.join(F.broadcast(starts) if small else starts, "part")
    return cut(placed.withColumn("begin", F.col("begin") + F.col("place")), length, kind)


def pieces(cut_windows: DataFrame) -> DataFrame:
    """One row for each document's stretch in a sequence, with the checksum of its ids."""
    piece = F.col("piece")
    at = (piece["offset"] - F.col("first")) * ID_BYTES + 1
    own = F.substring(F.col("ids"), at.cast("int"), (piece["length"] * ID_BYTES).cast("int"))
    return cut_windows.select("sequence_id", "first", "ids", F.explode("segments").alias("piece")).select(
        piece["doc_id"].alias("doc_id"),
        piece["start"].alias("start"),
        piece["length"].alias("length"),
        F.crc32(own).alias("ids_crc32"),
        piece["doc_tokens"].alias("doc_tokens"),
        "sequence_id",
        piece["offset"].alias("offset"),
    )


def sequences(cut_windows: DataFrame, length: int = 2048) -> DataFrame:
    """Whole sequences: `ids` (little-endian, four bytes each), `segments` by offset, and the length to pad to.

    Only boundary records are shuffled; a sequence has at most `length` of them. The last sequence
    may be shorter and is padded, unless its length is a power of two.
    """
    spark = cut_windows.sparkSession
    path = shared_folder(spark, "token-windows")
    cut_windows.write.partitionBy("whole").parquet(path)
    stored = spark.read.schema(cut_windows.schema).parquet(path)
    parts = F.array_sort(F.collect_list(F.struct("first", "ids", "segments")))
    joined = stored.where(~F.col("whole")).groupBy("sequence_id").agg(parts.alias("parts"))
    joined = joined.select(
        "sequence_id",
        F.flatten(F.col("parts")["segments"]).alias("segments"),
        F.aggregate(F.col("parts")["ids"], F.lit(b""), lambda whole, part: F.concat(whole, part)).alias("ids"),
    )
    all_of = stored.where("whole").select("sequence_id", "segments", "ids").unionByName(joined)
    count = (F.octet_length("ids") / ID_BYTES).cast("long")
    return all_of.withColumn("length", count).withColumn(
        "padded_length", F.when(F.bit_count("length") == 1, F.col("length")).otherwise(F.lit(length))
    )
