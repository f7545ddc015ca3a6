"""Benchmark decontamination by latent semantic retrieval.

Passages are weighed by TF-IDF over the benchmark's own words (other words cannot tell items
apart) with document frequencies of the whole corpus. A randomised SVD, whose products run as
Spark jobs over passages and items, gives a latent space in which a passage and an item that
share rare words in other inflections or another order still lie close. Every passage of every
document is held against the items there: its part along an item must be close in direction
(cosine) and large enough (energy). The pairs that pass are verified on the words themselves: by
the longest common subsequence, and, where the benchmark gives one, by the item's answer.

Items are few against the corpus; they are taken ITEMS at a time, so that what tasks hold of
them is bounded.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Hashable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchlens.llm.text import bound_batches, texts
from watchlens.session import materialize

#: Items in one pass over the corpus.
ITEMS = 5000
#: Latent directions, spare ones in the random start, power steps.
RANK, SPARE, POWERS = 96, 16, 2
#: Words in a step between passages, and steps in the shortest passage; sizes double up to the longest item's.
STEP, SHORTEST = 12, 2
#: More passages than these weigh as much as these, so that what items weigh beside them does not fall as a corpus grows.
FULL_WEIGHT = 18_000
#: Words of an item that shape the space as one row, so that long items do not outweigh the others.
FIT_WORDS = 96
#: Steps in the passages that shape the space.
PASSAGE = 4
#: How close a candidate is, and how large its part along the item (as a share of the item's length).
LEAST_COSINE, LEAST_ENERGY = 0.35, 0.3
#: Items weigh so much more than passages in the space; share of the mean spread that every direction has at least.
ITEM_WEIGHT, EVENING = 6.0, 0.05
#: Of an item's words, the share in the common subsequence; of its answer's words, the share found.
LEAST_COMMON, LEAST_ANSWER = 0.6, 0.5
#: Of an item without an answer of its own, this last part of its words is reported in its place; without it the rest must stand close together.
ANSWER_PART = 0.2
#: Bytes of texts whose words are numbered together; machine words of eight bytes by which a word is known, longer ones are looked up.
TOGETHER, LANES = 1 << 19, 8
#: Words of the vocabulary, the most frequent first, whose part in products is a dense matrix.
DENSE = 512
#: Cells of a table of texts' words by items that is added up at a time.
CELLS = 1 << 22

_EDGES = b".,;:!?\"'`()[]{}<>*#$%&|_-"
#: Of each byte: 0 within words, 1 a sign that words lose at their edges, 2 a blank.
_KINDS = np.zeros(256, np.uint8)
_KINDS[np.frombuffer(_EDGES, np.uint8)], _KINDS[np.frombuffer(b" \t\n\v\f\r", np.uint8)] = 1, 2
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15 + 0x632BE59BD9B4E018 * k & (1 << 64) - 1 for k in range(LANES)], np.uint64)


def bare(words: Iterable[bytes]) -> list[bytes]:
    """Words without signs at their edges; words of signs only are left out."""
    return [w for word in words if (w := word.strip(_EDGES))]


def _lowered(data: bytes) -> bytes:
    return data.lower() if data.isascii() else data.decode("utf-8", "replace").lower().encode()


def raw_words(data: bytes) -> list[bytes]:
    """Lower-case words, letters of all scripts folded."""
    return _lowered(data).split()


def split_words(data: bytes) -> list[bytes]:
    return bare(raw_words(data))


def passage_sizes(longest: float) -> np.ndarray:
    """Steps in a passage, by doubling, so that an item of `longest` steps has one next to its own size."""
    return SHORTEST << np.arange(1 + max(0, math.ceil(math.log2(max(longest, 1) / SHORTEST))))


class Numbers:
    """Vocabulary numbers of words as they stand in texts, many texts at a time.

    A word is known by its bytes, eight to a machine word: these choose a slot, and are compared with all of the slot's words.
    """

    def __init__(self, place: dict[bytes, int]) -> None:
        self.lengths = np.array([len(w) for w in place], np.int64)
        self.numbers = np.array(list(place.values()), np.int64)
        self.long = {w: n for w, n in place.items() if len(w) > 8 * LANES}
        self.longest = min(8 * LANES, int(self.lengths.max(initial=0)))
        own = np.frombuffer(b"".join(w[: 8 * LANES].ljust(8 * LANES, b"\0") for w in place), "<u8").reshape(-1, LANES)
        self.lanes = own.T.copy()
        self.shift = np.uint64(64 - max(12, (16 * len(place)).bit_length()))
        slots = self._slots(np.minimum(self.lengths, 8 * LANES), lambda k, which: self.lanes[k][which])
        self.order = np.argsort(slots, kind="stable")
        filled = np.bincount(slots, minlength=1 << (64 - int(self.shift)))
        self.first, self.filled = (np.cumsum(filled) - filled).astype(np.int32), np.minimum(filled, 1 << 30).astype(np.int32)

    def _slots(self, lengths: np.ndarray, lane: Callable) -> np.ndarray:
        """The slot of each word; `lane(k, which)` gives eight bytes of the words `which`, zero beyond their ends."""
        which = np.arange(len(lengths))
        keys = lane(0, which) * _MULTIPLIERS[0]
        for k in range(1, LANES):
            which = which[lengths[which] > 8 * k]
            if not len(which):
                break
            keys[which] = (keys[which] ^ (keys[which] >> np.uint64(29)) ^ lane(k, which)) * _MULTIPLIERS[k]
        return ((keys ^ (keys >> np.uint64(32))) * _MULTIPLIERS[0] >> self.shift).astype(np.int64)

    def _find(self, whole: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of the words that stand at `start`, -1 of others."""
        out = np.full(len(start), -1, np.int64)
        short = np.flatnonzero((length > 0) & (length <= self.longest))
        start, length = start[short], length[short]
        eight = np.ndarray((len(whole) - 7,), "<u8", whole, strides=(1,))
        lane = lambda k, which: eight[start[which] + 8 * k] & _MASKS[np.minimum(length[which] - 8 * k, 8)]
        slots = self._slots(length, lane)
        left = np.flatnonzero(self.filled[slots])
        chain = 0
        while len(left):
            word = self.order[self.first[slots[left]] + chain]
            same = self.lengths[word] == length[left]
            own, word = left[same], word[same]
            for k in range(LANES):
                more = length[own] > 8 * k
                if not more.any():
                    break
                equal = np.ones(len(own), bool)
                equal[more] = self.lanes[k][word[more]] == lane(k, own[more])
                own, word = own[equal], word[equal]
            out[short[own]] = self.numbers[word]
            chain += 1
            left = left[self.filled[slots[left]] > chain]
        return out

    def passages(self, data: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Of each text: place and vocabulary number of each word that the vocabulary has, and the number of words."""
        begin = 0
        while begin < len(data):
            end, size = begin + 1, len(data[begin])
            while end < len(data) and size + len(data[end]) <= TOGETHER:
                size += len(data[end])
                end += 1
            yield from self._passages([_lowered(text) for text in data[begin:end]])
            begin = end

    def _passages(self, lowered: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        whole = np.frombuffer(b"".join([b" ", *(part for text in lowered for part in (text, b" ")), b" " * 8 * LANES]), np.uint8)
        kinds = _KINDS[whole]
        blank = kinds == 2
        turns = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        start, end = turns[::2].copy(), turns[1::2].copy()
        heads, tails = np.flatnonzero(kinds[start] == 1), np.flatnonzero(kinds[end - 1] == 1)
        words = np.searchsorted(start, np.cumsum([1, *(len(text) + 1 for text in lowered)]))
        if len(heads) or len(tails):
            # Signs at a word's edges are no part of it; of signs only, nothing is left.
            solid = np.concatenate([[-1], np.flatnonzero(kinds == 0), [len(whole)]])
            start[heads], end[tails] = solid[np.searchsorted(solid, start[heads])], solid[np.searchsorted(solid, end[tails]) - 1] + 1
        numbers = self._find(whole, start, end - start)
        for k in np.flatnonzero(end - start > 8 * LANES) if self.long else ():
            numbers[k] = self.long.get(whole[start[k] : end[k]].tobytes(), -1)
        there = np.flatnonzero(numbers >= 0)
        numbers = numbers[there]
        parts = np.searchsorted(there, words)
        for k in range(len(lowered)):
            own = slice(parts[k], parts[k + 1])
            yield there[own] - words[k], numbers[own], int(words[k + 1] - words[k])


def common_words(item: Sequence[Hashable], region: Sequence[Hashable]) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    masks: dict[Hashable, int] = {}
    for k, word in enumerate(item):
        masks[word] = masks.get(word, 0) | 1 << k
    full = (1 << len(item)) - 1
    row, find = full, masks.get
    for word in region:
        mask = find(word)
        if mask:
            both = row & mask
            row = (row + both | row - both) & full
    return len(item) - row.bit_count()


def dense_words(item: Sequence[bytes], region: Sequence[bytes]) -> int:
    """The longest common subsequence within some stretch half as long again as the item."""
    wide, step = len(item) * 3 // 2 + 1, max(1, len(item) // 2)
    return max(common_words(item, region[at : at + wide]) for at in range(0, max(1, len(region) - wide + step), step))


@dataclass
class Items:
    """Benchmark items: ids, words, answers' words, whether the benchmark gave the answer, and the vocabulary."""

    ids: list
    words: list[list[bytes]]
    answers: list[list[bytes]]
    given: list[bool]
    place: dict[bytes, int]


def read_items(rows: Sequence) -> Items:
    words = [split_words((row.text or "").encode()) for row in rows]
    keep = [k for k, w in enumerate(words) if w]
    own = [split_words((row.answer or "").encode()) for row in rows]
    tail = lambda w: w[-max(1, round(len(w) * ANSWER_PART)) :]
    vocabulary = sorted({w for k in keep for w in words[k] + own[k]})
    return Items(
        [rows[k].item_id for k in keep],
        [words[k] for k in keep],
        [own[k] or tail(words[k]) for k in keep],
        [bool(own[k]) for k in keep],
        {w: n for n, w in enumerate(vocabulary)},
    )


def numbered(docs: DataFrame, place: dict[bytes, int]) -> DataFrame:
    """A row a document: the vocabulary numbers of its words, a list a passage of PASSAGE steps.

    Written once, so that texts are taken apart once for all that is learned from them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Numbers(place)
        for batch in batches:
            parts, words, sizes = [], [], []
            for at, numbers, _ in own.passages(texts(batch)):
                heads = np.flatnonzero(np.diff(at // (STEP * PASSAGE), prepend=-1))
                parts.append(len(heads))
                sizes.append(np.diff(heads, append=len(numbers)))
                words.append(numbers)
            if parts:
                inner = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), pa.int32()), pa.array(np.concatenate(words), pa.int32())
                )
                outer = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(parts)]), pa.int32()), inner)
                yield pa.RecordBatch.from_arrays([outer], names=["passages"])

    return materialize(docs.select("text").mapInArrow(cut, "passages array<array<int>>"), "passages")


def document_frequencies(numbers: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many documents each word of the vocabulary occurs, and how many documents there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size + 1, np.int64)
        for batch in batches:
            passages = batch.column(0).flatten()
            lengths = np.diff(passages.offsets.to_numpy())
            owner = np.repeat(np.repeat(np.arange(batch.num_rows), np.diff(batch.column(0).offsets.to_numpy())), lengths)
            once = np.unique(owner * size + passages.flatten().to_numpy())
            counts[:-1] += np.bincount(once % max(size, 1), minlength=size)
            counts[-1] += batch.num_rows  # the last counts documents
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], names=["word", "docs"])

    sums = numbers.mapInArrow(run, "word long, docs long").groupBy("word").agg(F.sum("docs").alias("docs"))
    counts = np.zeros(size + 1)
    for row in sums.collect():  # a row a word of the benchmark at most
        counts[row.word] = row.docs
    return counts[:-1], int(counts[-1])


def _dense_part(heads: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages by words below DENSE (the most frequent), how often each has each; then owner and number of all other words."""
    owner = np.repeat(np.arange(len(heads)), np.diff(heads, append=len(numbers)))
    frequent = numbers < DENSE
    cells = np.bincount(owner[frequent] * DENSE + numbers[frequent], minlength=len(heads) * DENSE)
    rest = ~frequent
    return cells.astype(np.float32).reshape(len(heads), DENSE), owner[rest], numbers[rest]


def _along(parts: tuple, weighted: np.ndarray) -> np.ndarray:
    """Products of passages, each a row of word numbers, with `weighted`, a row a word."""
    cells, owner, numbers = parts
    out = cells[:, : len(weighted)] @ weighted[:DENSE]
    if len(owner):
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        out[owner[heads]] += np.add.reduceat(weighted[numbers], heads, axis=0)
    return out


def _gram_product(parts: tuple, weighted: np.ndarray, out: np.ndarray) -> None:
    """Add to `out` what passages give times their own product with `weighted`."""
    cells, owner, numbers = parts
    along = _along(parts, weighted)
    out[:DENSE] += cells[:, : len(out)].T @ along
    if len(owner):
        order = np.argsort(numbers, kind="stable")
        words = numbers[order]
        first = np.flatnonzero(np.diff(words, prepend=-1))
        out[words[first]] += np.add.reduceat(along[owner[order]], first, axis=0)


def latent_space(numbers: DataFrame, items: Items, idf: np.ndarray) -> np.ndarray:
    """Latent directions (vocabulary by rank) of passages and items, by randomised SVD.

    Products with the passages of all documents run in Spark; what comes back is one row a
    word of the vocabulary. Items, which all tasks know, are added at the end.
    """
    size = len(items.place)
    rank = min(RANK, size)
    columns = min(rank + SPARE, size)
    rows = [
        np.array([items.place[w] for w in words[at : at + FIT_WORDS]], np.int64)
        for words in items.words
        for at in range(0, len(words), FIT_WORDS)
    ]

    def item_product(basis: np.ndarray) -> np.ndarray:
        out = np.zeros((size, basis.shape[1]))
        for row in rows:
            value = idf[row]
            along = (value[:, None] * basis[row]).sum(axis=0) * ITEM_WEIGHT**2
            np.add.at(out, row, value[:, None] * along)
        return out

    # A passage counts once, however many documents share it, so that a much repeated leak does not shape the space.
    passages = materialize(numbers.select(F.explode("passages").alias("numbers")).distinct(), "different-passages")
    share = min(1.0, FULL_WEIGHT / max(1, passages.count()))
    # Every task gives a row a word: as many tasks as there are cores, however many passages.
    tasks = numbers.sparkSession.sparkContext.defaultParallelism

    # In products words stand by how many documents have them.
    order = np.argsort(idf, kind="stable")
    ranks = np.argsort(order)

    def over_passages(add: Callable, shape: tuple[int, int]) -> np.ndarray:
        """The sum of what `add` gives over the passages of all documents; rows that are zero are not sent."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(shape)
            for batch in batches:
                column = batch.column(0)
                heads = np.concatenate([[0], np.cumsum(np.diff(column.offsets.to_numpy()))[:-1]])
                if len(column):
                    add(_dense_part(heads, ranks[column.flatten().to_numpy()]), out)
            there = np.flatnonzero(np.abs(out).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(there), *(pa.array(out[there, k]) for k in range(out.shape[1]))],
                names=["row", *(f"v{k}" for k in range(out.shape[1]))],
            )

        names = [f"v{k}" for k in range(shape[1])]
        each = passages.coalesce(tasks).mapInArrow(run, ", ".join(["row long", *[f"{n} double" for n in names]]))
        found = each.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
        out = np.zeros(shape)
        if len(found):
            out[found["row"].to_numpy()] = found[names].to_numpy()
        return out * share

    def corpus_product(basis: np.ndarray) -> np.ndarray:
        weighted = (idf[:, None] * basis).astype(np.float32)[order]
        return idf[:, None] * over_passages(lambda parts, out: _gram_product(parts, weighted, out), basis.shape)[ranks]

    def corpus_inside(basis: np.ndarray) -> np.ndarray:
        """The passages' own products along the basis."""
        weighted = (idf[:, None] * basis).astype(np.float32)[order]

        def add(parts: tuple, out: np.ndarray) -> None:
            along = _along(parts, weighted)
            out += along.T @ along

        return over_passages(add, (basis.shape[1], basis.shape[1]))

    basis = np.random.default_rng(12).standard_normal((size, columns))
    for _ in range(POWERS):
        basis = np.linalg.qr(corpus_product(basis) + item_product(basis))[0]
    corpus = corpus_inside(basis)
    inner = corpus + basis.T @ item_product(basis)
    values, turns = np.linalg.eigh((inner + inner.T) / 2)
    turns = turns[:, np.argsort(-values)[:rank]]
    # Directions in which the corpus varies most (its languages' common words) tell least about an
    # item: as when queries are folded into a latent space, each is divided by its singular value.
    spread = turns.T @ corpus @ turns
    values, axes = np.linalg.eigh((spread + spread.T) / 2)
    floor = max(EVENING * float(values.mean()), 1e-12)
    return basis @ turns @ (axes / np.sqrt(np.maximum(values, 0) + floor))


class Finder:
    """Holds a document's passages against the items."""

    def __init__(self, items: Items, space: np.ndarray, idf: np.ndarray) -> None:
        self.items = items
        self.numbers = Numbers(items.place)
        self.rows = (idf[:, None] * space).astype(np.float32)
        # Where no answer must be there, the least beginning that verifies is searched by itself too:
        # the item's end may weigh more than all the rest.
        begins = [k for k, given in enumerate(items.given) if not given]
        self.owner = np.array([*range(len(items.words)), *begins])
        searched = [*items.words, *(items.words[k][: math.ceil(len(items.words[k]) * LEAST_COMMON)] for k in begins)]
        vectors = np.array([self.rows[[items.place[w] for w in words]].sum(axis=0) for words in searched])
        self.lengths = np.linalg.norm(vectors, axis=1)
        self.unit = vectors / np.maximum(self.lengths, 1e-9)[:, None]
        want = np.array([len(words) / STEP for words in searched])
        sizes = passage_sizes(want.max())
        self.size = sizes[np.abs(np.log2(sizes[None] / np.maximum(want[:, None], 0.1))).argmin(axis=1)]
        # How often each item has each word, and how many words in common the least verified match has.
        kind = np.int16 if max(map(len, items.words)) < 1 << 15 else np.int32
        self.times = np.zeros((len(items.place), len(items.words)), kind)
        for k, words in enumerate(items.words):
            np.add.at(self.times[:, k], [items.place[w] for w in words], 1)
        self.least = np.array([math.ceil(LEAST_COMMON * len(words) - 1e-9) for words in items.words])
        self.groups = [(size, np.flatnonzero(self.size == size)) for size in np.unique(self.size).tolist()]
        # Each item's words, and how often it has each.
        self.words, self.often = zip(*(np.unique([items.place[w] for w in words], return_counts=True) for words in items.words), strict=True)
        # The widest region in which an item is verified.
        self.width = [2 * self._reach(k, max(self.size[self.owner == k].tolist())) for k in range(len(items.words))]
        self.turn = np.full(len(items.place), -1)

    def _reach(self, item: int, size: int) -> int:
        """Words before and after a passage's middle in which an item is verified."""
        return max(len(self.items.words[item]), size * STEP) * 3 // 4 + STEP

    def _of_item(self, numbers: np.ndarray, item: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words are the item's, and which of its words they are."""
        self.turn[self.words[item]] = np.arange(len(self.words[item]))
        turns = self.turn[numbers]
        self.turn[self.words[item]] = -1
        own = np.flatnonzero(turns >= 0)
        return own, turns[own]

    def possible(self, at: np.ndarray, numbers: np.ndarray, item: int) -> bool:
        """Whether enough of an item's words for a match stand in any region as wide as it is verified in.

        What is left out here could not be verified.
        """
        own, turns = self._of_item(numbers, item)
        least, width, stands = int(self.least[item]), self.width[item], at[own]
        if len(own) < least or not (stands[least - 1 :] - stands[: len(own) - least + 1] < width).any():
            return False
        # Every region lies in one of the stretches that are twice as wide, each half over the next one.
        part, kinds = stands // width, len(self.often[item])
        cells = np.bincount(part * kinds + turns, minlength=(int(part[-1]) + 2) * kinds).reshape(-1, kinds) > 0
        enough = np.flatnonzero((cells[:-1] | cells[1:]) @ self.often[item] >= least)
        ends = np.searchsorted(part, [enough, enough + 2]).T.tolist()
        return any(self._close(stands[a:b].tolist(), turns[a:b].tolist(), item) for a, b in ends)

    def _close(self, stands: list[int], turns: list[int], item: int) -> bool:
        least, width, left = int(self.least[item]), self.width[item], self.often[item].tolist()
        first = have = 0
        for place, word in zip(stands, turns, strict=True):
            while stands[first] <= place - width:
                left[turns[first]] += 1
                have -= left[turns[first]] > 0
                first += 1
            left[word] -= 1
            have += left[word] >= 0
            if have >= least:
                return True
        return False

    def _enough(self, numbers: Sequence[np.ndarray]) -> list[list[int]]:
        """Of each text: the items that have enough words for a match in it, wherever they stand."""
        out: list[list[int]] = [[]] * len(numbers)
        size, most = len(self.times), max(1, CELLS // len(self.least))
        once = [np.flatnonzero(np.bincount(own, minlength=size)) if 4 * len(own) > size else np.unique(own) for own in numbers]
        lists = [k for k, own in enumerate(once) if len(own)]
        ends = np.cumsum([len(once[k]) for k in lists])
        at = 0
        while at < len(lists):
            begin = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, begin + most, side="right")))
            heads = np.concatenate([[0], ends[at : to - 1] - begin])
            # No sum is over an item's number of words.
            sums = np.add.reduceat(self.times[np.concatenate([once[k] for k in lists[at:to]])], heads, axis=0)
            there = sums >= self.least
            for k in np.flatnonzero(there.any(axis=1)).tolist():
                out[lists[at + k]] = np.flatnonzero(there[k]).tolist()
            at = to
        return out

    def possible_items(self, read: Sequence[tuple[np.ndarray, np.ndarray, int]]) -> list[list[int]]:
        """Of each text: the items of which enough words for a match stand close enough together."""
        found = self._enough([numbers for _, numbers, _ in read])
        return [[item for item in items if self.possible(at, numbers, item)] for items, (at, numbers, _) in zip(found, read, strict=True)]

    def candidates(self, found: Sequence[bytes]) -> dict[int, list[tuple[int, int, float]]]:
        """Item number -> passages (first step, steps, cosine) that come close to it."""
        read = list(self.numbers.passages([b" ".join(found)]))
        return self._candidates(*read[0], self.possible_items(read)[0])

    def _candidates(self, at: np.ndarray, numbers: np.ndarray, words: int, items: list[int]) -> dict[int, list[tuple[int, int, float]]]:
        if not items:
            return {}
        steps, count = at // STEP, words // STEP + 1
        heads = np.flatnonzero(np.diff(steps, prepend=-1))
        sums = np.zeros((count + 1, self.rows.shape[1]), np.float32)
        sums[steps[heads] + 1] = np.add.reduceat(self.rows[numbers], heads, axis=0)
        sums = np.cumsum(sums, axis=0, dtype=np.float64)
        close: dict[int, list[tuple[int, int, float]]] = {}
        for size, mine in self.groups:
            mine = mine[np.isin(self.owner[mine], items)]
            if not len(mine):
                continue
            last = max(0, count - size)  # a passage ends where the text does
            start = np.append(np.arange(0, last, size // 2), last)
            passages = sums[np.minimum(start + size, count)] - sums[start]
            along = passages @ self.unit[mine].T
            norms = np.maximum(np.linalg.norm(passages, axis=1), 1e-9)
            good = (along >= LEAST_COSINE * norms[:, None]) & (along >= LEAST_ENERGY * self.lengths[mine][None])
            for at_, item in zip(*(found.tolist() for found in np.nonzero(good)), strict=True):
                close.setdefault(int(self.owner[mine[item]]), []).append((int(start[at_]), size, float(along[at_, item] / norms[at_])))
        return close

    def matches(self, data: Sequence[bytes]) -> Iterator[list[tuple[int, float, float, float]]]:
        """Of each text: (item number, cosine, share of the item in common, share of its answer found) of verified items."""
        read = list(self.numbers.passages(data))
        for text, own, items in zip(data, read, self.possible_items(read), strict=True):
            close = self._verifiable(*own[:2], self._candidates(*own, items))
            yield self._verified(raw_words(text), close) if close else []

    def _verifiable(self, at: np.ndarray, numbers: np.ndarray, close: dict[int, list[tuple[int, int, float]]]) -> dict[int, list[tuple[int, int, float]]]:
        """The candidates with enough of the item's words in order around them, read off the vocabulary numbers."""
        out = {}
        for item, places in close.items():
            own, _ = self._of_item(numbers, item)
            stands, words = at[own].tolist(), numbers[own].tolist()
            of_item, least = [self.items.place[w] for w in self.items.words[item]], int(self.least[item])
            good = []
            for step, size, cosine in places:
                middle = step * STEP + size * STEP // 2
                reach = self._reach(item, size)
                begin, end = bisect_left(stands, middle - reach), bisect_left(stands, middle + reach)
                if end - begin >= least and common_words(of_item, words[begin:end]) >= least:
                    good.append((step, size, cosine))
            if good:
                out[item] = good
        return out

    def _verified(self, found: Sequence[bytes], close: dict[int, list[tuple[int, int, float]]]) -> list[tuple[int, float, float, float]]:
        out = []
        for item, places in sorted(close.items()):
            words, answer = self.items.words[item], Counter(self.items.answers[item])
            best = None
            for step, size, cosine in places:
                middle = step * STEP + size * STEP // 2
                reach = self._reach(item, size)
                region = bare(found[max(0, middle - reach) : middle + reach])
                common = common_words(words, region) / len(words)
                if common < LEAST_COMMON:
                    continue
                has = Counter(region)
                told = sum(min(n, has[w]) for w, n in answer.items()) / sum(answer.values())
                if told < LEAST_ANSWER and not self.items.given[item]:
                    # Quoted without its end: what is common then stands close together.
                    common = dense_words(words, region) / len(words)
                    if common < LEAST_COMMON:
                        continue
                elif told < LEAST_ANSWER:
                    continue
                best = max(best or (0.0, 0.0, 0.0), (round(common, 6), round(told, 6), round(cosine, 4)))
            if best:
                out.append((item, best[2], best[0], best[1]))
        return out


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items, ITEMS at a time, in order of their ids; items without words are left out."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text"), answer.alias("answer")).distinct()
    whole = rows.withColumn("__hash", F.xxhash64("item_id", "text"))
    blocks = max(1, math.ceil(whole.count() / ITEMS * 1.1))
    for k in range(blocks):
        part = whole.where(F.pmod("__hash", F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        items = read_items(part)
        if items.ids:
            yield items


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold a benchmark item: (doc_id, item_id, cosine, common, answer), a row for each pair.

    `benchmark` has item_id, text and, if there, answer. Null and empty texts hold nothing and are
    held nowhere. Equal rows give equal rows; without documents or items there are no rows. Whole
    texts are read, other columns are not.
    """
    bound_batches(docs.sparkSession)
    kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, cosine double, common double, answer double"
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = None
    for items in _blocks(benchmark):
        finder = _finder(rows, items)
        part = rows.mapInArrow(_search(finder, items), schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def _finder(rows: DataFrame, items: Items) -> Finder:
    numbers = numbered(rows, items.place)
    counts, documents = document_frequencies(numbers, len(items.place))
    idf = np.log((documents + 1) / (counts + 1)) + 0.05
    return Finder(items, latent_space(numbers, items, idf), idf)


def _search(finder: Finder, items: Items) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, hits = [], []
            for row, found in enumerate(finder.matches(texts(batch))):
                for hit in found:
                    at.append(row)
                    hits.append(hit)
            if hits:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at, pa.int64())),
                        pa.array([items.ids[h[0]] for h in hits]),
                        *(pa.array([h[k] for h in hits], pa.float64()) for k in (1, 2, 3)),
                    ],
                    names=["doc_id", "item_id", "cosine", "common", "answer"],
                )

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns; every row is judged by its own text."""
    bound_batches(docs.sparkSession)
    names = docs.columns
    inside = docs.select(F.struct(*[F.col(c) for c in names]).alias("__row"), "doc_id", F.col("text").cast("string").alias("text"))
    for items in _blocks(benchmark):
        finder = _finder(inside.select("doc_id", "text"), items)

        def run(batches: Iterator[pa.RecordBatch], finder: Finder = finder) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not found for found in finder.matches(texts(batch))], pa.bool_()))

        inside = inside.mapInArrow(run, inside.schema)
    return inside.select("__row.*")
