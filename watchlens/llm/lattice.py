"""Language-model scores by the lattice of all subword segmentations.

The vocabulary is that of an existing tokenizer. Its piece scores give the starting weights,
which expectation maximisation fits to the training words: the expected number of times that a
piece is used, over all segmentations, becomes its new weight. A word's probability is the sum
over all ways to cut it into pieces, by a forward recursion over its characters in log space; a
whole word seen in training is one more arc of its lattice, weighted by its discounted count,
and what the discount frees goes to the pieces. Words begin with a blank piece sign, so no
segmentation reaches across words and every distinct word is worked out once. A text is its
words and one end.

Weights are fitted for each class of training texts (their language). A text's probability is
the sum over the classes too, so its own class is never asked for.

Texts are dealt into blocks of a bounded size. A block sends its distinct words to be counted
and scored, and gets them back with their figures.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchlens.llm.text import bound_batches, pieces_of, slices, texts
from watchlens.session import materialize

BLANK = "▁"
#: Bytes of text in a block, about; words whose lattices are worked out together; rounds of fitting.
BLOCK_BYTES, GROUP_WORDS, ROUNDS = 24 << 20, 6000, 3
#: Most classes of texts; the rarer ones share the last.
CLASSES = 8
#: What every piece counts besides its expected uses.
SMOOTHING = 0.02


@dataclass
class Vocabulary:
    """Pieces with log weights; the last 256 are the bytes, for characters that no piece holds."""

    pieces: list[str]
    weights: np.ndarray


def load_vocabulary(path: str) -> Vocabulary:
    """Pieces of a sentencepiece model. A score that is a rank r counts as weight 1 / (r + 3)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = np.array([model.get_score(i) for i in ids])
    weights = 1 / (3 - scores) if scores.min() < -100 else np.exp(scores)
    weights = np.append(weights, np.full(256, weights.min() / 10))
    return Vocabulary([model.id_to_piece(i) for i in ids], np.log(weights / weights.sum()))


class Lattice:
    """All segmentations of a group of words at once."""

    def __init__(self, pieces: Sequence[str]) -> None:
        self.count = len(pieces)
        self.single = {p for p in pieces if len(p) == 1}
        # A tree of the pieces' characters: children by (node, character), sorted by hash slots, and the piece that ends at a node.
        letters = {c: k for k, c in enumerate(sorted(set("".join(pieces))))}
        self.letter = np.full(0x110000, -1, np.int32)
        self.letter[[ord(c) for c in letters]] = range(len(letters))
        self.letters, children, ends = max(1, len(letters)), {}, [-1]
        for k, piece in enumerate(pieces):
            node = 0
            for c in piece:
                key = node * self.letters + letters[c]
                node = children.setdefault(key, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = k
        self.ends = np.array(ends, np.int64)
        keys = np.fromiter(children.keys(), np.int64, len(children))
        self.shift = np.uint64(64 - (4 * len(keys)).bit_length())
        order = np.argsort(self._slots(keys), kind="stable")
        self.keys, self.nodes = keys[order], np.fromiter(children.values(), np.int64, len(children))[order]
        self.filled = np.bincount(self._slots(keys), minlength=1 << (64 - int(self.shift)))
        self.first = np.cumsum(self.filled) - self.filled

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _children(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The nodes' children along letters, -1 where there are none."""
        keys, out = node * self.letters + letter, np.full(len(node), -1, np.int64)
        slots = self._slots(keys)
        left = np.flatnonzero((self.filled[slots] > 0) & (letter >= 0))
        chain = 0
        while len(left):
            at = self.first[slots[left]] + chain
            same = self.keys[at] == keys[left]
            out[left[same]] = self.nodes[at[same]]
            chain += 1
            left = left[~same]
            left = left[self.filled[slots[left]] > chain]
        return out

    def _pieces_in(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and number of every piece that stands in `letters`; all places go down the tree together."""
        starts, ends, found = [], [], []
        at, node, depth = np.arange(len(letters)), np.zeros(len(letters), np.int64), 0
        while len(at):
            node = self._children(node, letters[at + depth])
            depth += 1
            on = node >= 0
            at, node = at[on], node[on]
            whole = self.ends[node] >= 0
            starts.append(at[whole])
            ends.append(at[whole] + depth)
            found.append(self.ends[node[whole]])
            inside = at + depth < len(letters)
            at, node = at[inside], node[inside]
        return tuple(np.concatenate(part) if part else np.zeros(0, np.int64) for part in (starts, ends, found))

    def arcs(self, words: Sequence[str]) -> dict:
        """Arcs of the words' lattices; characters are numbered through, with a gap after each word."""
        marked = [BLANK + w for w in words]
        lengths = np.array([len(w) for w in marked], np.int64)
        begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        joined = "\n".join(marked)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = self.letter[chars]
        letters[(begin + lengths)[:-1]] = -1
        start, end, piece = self._pieces_in(letters)
        # A character outside the vocabulary is one more piece, made of its bytes.
        others = [c for c in set(joined) - self.single if c != "\n" or any("\n" in w for w in words)]
        extra: list[str] = []
        if others:
            inside = np.ones(len(joined), bool)
            inside[(begin + lengths)[:-1]] = False
            for c in sorted(others):
                at = np.flatnonzero((chars == ord(c)) & inside)
                start, end = np.append(start, at), np.append(end, at + 1)
                piece = np.append(piece, np.full(len(at), self.count + 256 + len(extra)))
                extra.append(c)
        word = np.repeat(np.arange(len(marked)), lengths + 1)[start]
        return {"start": start, "end": end, "piece": piece, "word": word, "begin": begin, "lengths": lengths, "extra": extra}

    def _bytes(self, character: str) -> np.ndarray:
        """The pieces that spell a character in UTF-8."""
        return self.count + np.frombuffer(character.encode("utf-8", "replace"), np.uint8).astype(np.int64)

    def log_weights(self, arcs: dict, weights: np.ndarray) -> np.ndarray:
        """Log weights (arcs by classes) out of the pieces' (pieces by classes)."""
        spelt = [weights[self._bytes(c)].sum(axis=0) for c in arcs["extra"]]
        return (np.concatenate([weights, spelt]) if spelt else weights)[arcs["piece"]]

    @staticmethod
    def _sweep(level: np.ndarray, to: np.ndarray, frm: np.ndarray, gain: np.ndarray, values: np.ndarray) -> None:
        """values[to] = log sum over arcs of exp(values[from] + gain), level by level."""
        order = np.argsort(level * (int(to.max(initial=0)) + 1) + to)
        level, to, frm, gain = level[order], to[order], frm[order], gain[order]
        steps = np.flatnonzero(np.diff(level, prepend=-1))
        for a, b in zip(steps, np.append(steps[1:], len(level)), strict=True):
            heads = np.flatnonzero(np.diff(to[a:b], prepend=-1))
            terms = values[frm[a:b]] + gain[a:b]
            # What no path reaches stays at minus infinity; its terms weigh nothing.
            most = np.maximum(np.maximum.reduceat(terms, heads, axis=0), -1e300)
            terms -= np.repeat(most, np.diff(heads, append=b - a), axis=0)
            values[to[a:b][heads]] = most + np.log(np.add.reduceat(np.exp(terms), heads, axis=0))

    def forward(self, arcs: dict, gain: np.ndarray) -> np.ndarray:
        values = np.full((int(arcs["begin"][-1] + arcs["lengths"][-1] + 1), gain.shape[1]), -np.inf)
        values[arcs["begin"]] = 0.0
        self._sweep(arcs["end"] - arcs["begin"][arcs["word"]], arcs["end"], arcs["start"], gain, values)
        return values

    def log_probabilities(self, words: Sequence[str], weights: np.ndarray) -> np.ndarray:
        """Each word's log probability under every class's weights."""
        if not len(words):
            return np.zeros((0, weights.shape[1]))
        arcs = self.arcs(words)
        values = self.forward(arcs, self.log_weights(arcs, weights))
        return values[arcs["begin"] + arcs["lengths"]]

    def expected(self, words: Sequence[str], weights: np.ndarray) -> np.ndarray:
        """How often each piece is used, over all segmentations of words that occur once each."""
        return self.expected_by_class(words, np.zeros(len(words), np.int64), weights[:, None])[:, 0]

    def expected_by_class(self, words: Sequence[str], kinds: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """`expected` of words that each belong to a class, under its weights (pieces by classes)."""
        arcs, classes = self.arcs(words), weights.shape[1]
        spelt = [weights[self._bytes(c)].sum(axis=0) for c in arcs["extra"]]
        kind = kinds[arcs["word"]]
        gain = (np.concatenate([weights, spelt]) if spelt else weights)[arcs["piece"], kind][:, None]
        ahead = self.forward(arcs, gain)
        behind = np.full(ahead.shape, -np.inf)
        last = arcs["begin"] + arcs["lengths"]
        behind[last] = 0.0
        self._sweep(last[arcs["word"]] - arcs["start"], arcs["start"], arcs["end"], gain, behind)
        share = np.exp((ahead[arcs["start"]] + gain + behind[arcs["end"]] - ahead[last][arcs["word"]])[:, 0])
        size = self.count + 256 + len(arcs["extra"])
        uses = np.bincount(arcs["piece"] * classes + kind, share, size * classes).reshape(size, classes)
        for k, c in enumerate(arcs["extra"]):
            np.add.at(uses, self._bytes(c), uses[self.count + 256 + k])
        return uses[: self.count + 256]


def _strings(batch: pa.RecordBatch) -> list[str]:
    return [word.decode("utf-8", "replace") for word in batch.column(0).to_pylist()]


def fit(counted: DataFrame, classes: int, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Log weights (pieces by classes) fitted to the distinct words of each class.

    `counted` has one row a word: word (binary) and its uses u0, u1 ... in the classes. All words
    count. A round's sums are one row a piece and class, bounded by the vocabulary.
    """
    pieces, size = vocabulary.pieces, len(vocabulary.pieces) + 256
    weights = np.repeat(vocabulary.weights[:, None], classes, axis=1)
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], weights: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            lattice, total = Lattice(pieces), np.zeros((size, classes))
            for batch in batches:
                for part in slices(batch, GROUP_WORDS):
                    words = _strings(part)
                    # A word counts once in each class that has it.
                    used = np.stack([part.column(k + 1).to_numpy(zero_copy_only=False) for k in range(classes)], axis=1) > 0
                    own, kinds = np.nonzero(used)
                    if len(own):
                        total += lattice.expected_by_class([words[i] for i in own.tolist()], kinds, weights)
            piece, kind = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece, pa.int32()), pa.array(kind, pa.int32()), pa.array(total[piece, kind])],
                names=["piece", "class", "uses"],
            )

        each = counted.select("word", *[f"u{k}" for k in range(classes)]).mapInArrow(run, "piece int, class int, uses double")
        uses = np.full((size, classes), SMOOTHING)
        for row in each.groupBy("piece", "class").agg(F.sum("uses").alias("uses")).collect():
            uses[row["piece"], row["class"]] += row["uses"]
        weights = np.log(uses / uses.sum(axis=0))
    # Sums of doubles depend on their order in the last digits; rounding them off makes reruns agree.
    return np.round(weights, 8)


def _block_words(docs: DataFrame, classes: int) -> DataFrame:
    """Distinct words of every block with their uses in the training texts of each class."""
    names = ["block", "word", *[f"u{k}" for k in range(classes)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        training: dict[int, list[Counter]] = defaultdict(lambda: [Counter() for _ in range(classes)])
        other: dict[int, set] = defaultdict(set)
        for batch in batches:
            for block, kind, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch), strict=True):
                words = data.lower().split()
                if kind is None:
                    other[block].update(words)
                else:
                    training[block][kind].update(words)
        for block in sorted(training.keys() | other.keys()):
            counts = training.pop(block, None) or [Counter() for _ in range(classes)]
            words = list(other.pop(block, set()).union(*counts))
            for a in range(0, len(words), 1 << 16):
                part = words[a : a + (1 << 16)]
                uses = [pa.array([c[w] for w in part], pa.int32()) for c in counts]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(part), pa.int64()), pa.array(part, pa.binary()), *uses], names=names)

    return docs.select("block", "class", "text").mapInArrow(
        run, ", ".join(["block long", "word binary", *[f"u{k} int" for k in range(classes)]])
    )


def _classes(rows: DataFrame) -> tuple[list, DataFrame]:
    """The classes with their numbers of training texts, and `class`: its number, null for held-out texts."""
    found = rows.where(~F.col("held_out")).groupBy("kind").count().orderBy(F.col("count").desc(), "kind")
    known = [(row.kind, row["count"]) for row in found.limit(CLASSES + 1).collect()]
    named = known[: CLASSES - 1] if len(known) > CLASSES else known
    number = F.lit(len(named))
    for k, (kind, _) in enumerate(named):
        number = F.when(F.col("kind").eqNullSafe(F.lit(kind)), k).otherwise(number)
    rows = rows.withColumn("class", F.when(~F.col("held_out"), number).cast("int")).drop("kind")
    counts = [count for _, count in named]
    if len(known) > CLASSES:
        counts.append(rows.where(F.col("class") == len(named)).count())
    return counts or [0], rows


def scores(docs: DataFrame, held_out: str, vocabulary: Vocabulary, kind: str | None = "lang", rounds: int = ROUNDS) -> DataFrame:
    """Model and word-count scores of every document, learnt from those whose `held_out` is false.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10). `kind` names
    the column that classes the training texts (null is a class; none: one class). Null texts are
    empty: one end token. Without training texts the vocabulary's own weights score. Equal rows
    score alike, an empty table gives no rows, further columns are not read.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    group = F.col(kind).cast("string") if kind else F.lit(None).cast("string")
    rows = docs.select("doc_id", F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"), group.alias("kind"), text.alias("text"))
    training, rows = _classes(rows)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first().bytes
    blocks, count = pieces_of(size, BLOCK_BYTES), len(training)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    names = [f"u{k}" for k in range(count)]
    # A word has one row a block here, so that no word is more rows than there are blocks.
    same = Window.partitionBy("word")
    words = _block_words(rows.repartition(blocks, "block"), count).withColumn(
        "first", F.row_number().over(same.orderBy("block")) == 1
    )
    words = materialize(words.withColumns({n: F.sum(n).over(same) for n in names}), "lattice-words")
    once = words.where("first")
    uses = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    sums = [F.coalesce(F.sum(uses), F.lit(0)).alias("uses"), F.coalesce(F.sum((uses > 0).cast("int")), F.lit(0)).alias("kinds")]
    for n in names:
        sums += [F.coalesce(F.sum(n), F.lit(0)).alias(f"n_{n}")]
        sums += [F.count(F.when(F.col(n) == times, 1)).alias(f"n{times}_{n}") for times in (1, 2)]
        sums += [F.count(F.when(F.col(n) > 0, 1)).alias(f"v_{n}")]
    known = once.agg(*sums).first()
    # The end is a token like any other, once a training text.
    ends = sum(training)
    tokens, below = known.uses + ends, known.uses + ends + 0.5 * (known.kinds + (ends > 0) + 1)
    base_end = math.log10((ends + 0.5) / below)
    pieces, weights = vocabulary.pieces, fit(once, count, vocabulary, rounds)
    total = np.array([known[f"n_{n}"] + t for n, t in zip(names, training, strict=True)], float)
    discount = np.array([known[f"n1_{n}"] / max(1, known[f"n1_{n}"] + 2 * known[f"n2_{n}"]) for n in names]).clip(0.1, 0.95)
    freed = np.array([known[f"v_{n}"] for n in names]) * discount
    # A class without words leaves its words to the pieces.
    bare = total - np.array(training) <= 0
    total = np.where(total > 0, total, 2.0)
    freed = np.where(bare, 1.0, freed)
    end_weights = np.log(np.where(bare, np.maximum(training, 1) / (np.maximum(training, 1) + 1.0), np.array(training) / total))
    total = np.where(bare, np.maximum(training, 1) + 1.0, total)
    prior = np.log(np.maximum(np.array(training, float), 1e-300) / max(ends, 1)) if ends else np.zeros(count)
    log_freed = np.log(freed / total)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces)
        for batch in batches:
            for part in slices(batch, GROUP_WORDS * 4):
                words, seen = part.column(1).to_pylist(), {}
                at = [seen.setdefault(w, len(seen)) for w in words]
                distinct = [w.decode("utf-8", "replace") for w in seen]
                cut = [lattice.log_probabilities(distinct[a : a + GROUP_WORDS], weights) for a in range(0, len(distinct), GROUP_WORDS)]
                own = np.stack([part.column(k + 2).to_numpy(zero_copy_only=False) for k in range(count)], axis=1)
                with np.errstate(divide="ignore"):
                    whole = np.log(np.maximum(own - discount, 0) / total)
                values = np.logaddexp(whole, np.concatenate(cut)[at] + log_freed).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(own.sum(axis=1), pa.int64()), *(pa.array(v) for v in values.T)],
                    names=["block", "word", "uses", *names],
                )

    figures = words.select("block", "word", *names).mapInArrow(
        weigh, ", ".join(["block long", "word binary", "uses long", *[f"{n} float" for n in names]])
    )

    def score(block: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        place = {word: k for k, word in enumerate(right.column("word").to_pylist())}
        uses = right.column("uses").to_numpy()
        base = np.log10((uses + 0.5) / below)
        model = np.stack([right.column(n).to_numpy() for n in names], axis=1).astype(float)
        out: dict[str, list] = {name: [] for name in ("n_tokens", "n_known", "base_score", "score")}
        for data in left.column("text").cast(pa.binary()).to_pylist():
            found = data.lower().split()
            at = np.fromiter(map(place.__getitem__, found), np.int64, len(found))
            out["n_tokens"].append(len(at) + 1)
            out["n_known"].append(int((uses[at] > 0).sum()) + (ends > 0))
            out["base_score"].append(float(base[at].sum() + base_end))
            by_class = model[at].sum(axis=0) + end_weights + prior
            out["score"].append(float(np.logaddexp.reduce(by_class) / math.log(10)))
        kinds = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
        made = {name: pa.array(out[name], kinds[name]) for name in kinds}
        train = {"train_tokens": pa.array([tokens] * left.num_rows, pa.int64())}
        return pa.table({"doc_id": left.column("doc_id"), "held_out": left.column("held_out"), **made, **train})

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, train_tokens long"
    sides = rows.drop("class").repartition(blocks, "block").groupBy("block").cogroup(figures.groupBy("block"))
    return sides.applyInArrow(score, schema)
