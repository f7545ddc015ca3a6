"""A quality classifier by co-training two views of a document.

One view reads the text's words, the other the page's data: language, source, size, layout and
the mix of characters. Each is a logistic model. Both start from labelled documents; in every
round each view labels the unlabelled documents of which it is surest and hands them to the
other. At the end the views are calibrated on labelled documents that took no part in the fit,
and combined into one score.

Of labelled documents a bounded sample (LABELLED) is fitted, taken by a hash of the id. All unlabelled documents take part in every round:
how many are handed over is a share of them, found from counts of the views' scores, and what a fit needs of them are
sums of gradients and curvatures, added up by Spark. Equal texts of one source count once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq, itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchlens.llm.text import bound_batches, texts
from watchlens.session import materialize

#: Labelled documents in the fit, rounds, share of the unlabelled that is handed over a round more, how sure a view must be.
LABELLED, ROUNDS, HANDED, SURE = 20_000, 4, 0.02, 0.95
#: Most steps of a fit within a round, and buckets of scores: logits of -16 to 16, 8 buckets each.
STEPS, REACH, FINE = 12, 16, 8
#: Of the labelled documents, one in so many calibrates.
CALIBRATING = 4
LANG_SLOTS, SOURCE_SLOTS = 8, 16

_LETTERS = bytes(c for c in range(256) if c >= 128 or chr(c).isalpha())
_CAPITALS = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>{}[]\\^~=_"
_SHOUTS = b"!?"
_STOPS = b".,;:"


def content_view(data: bytes) -> list[float]:
    """Numbers about a text's words; all 0 without words."""
    words = data.split()
    count = len(words)
    if not count:
        return [0.0] * 9
    kinds = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, count)
    last, first = bytes(map(itemgetter(-1), words)), bytes(map(itemgetter(0), words))
    return [
        math.log1p(count),
        math.log(len(kinds)) / math.log(count + 1),
        len(kinds) / count,
        max(kinds.values()) / count,
        sum(map(eq, words, words[1:])) / count,
        math.log1p(float(lengths.mean())),
        math.log1p(float(lengths.std())),
        1 - len(last.translate(None, _LETTERS)) / count,
        1 - len(first.translate(None, _LETTERS)) / count,
    ]


def page_view(data: bytes, lang: str | None, source: str | None) -> list[float]:
    """Numbers about a page: size, layout, characters, and slots for language and source."""
    size = max(1, len(data))
    lines = data.split(b"\n")
    share = lambda of: (len(data) - len(data.translate(None, of))) / size
    slots = [0.0] * (LANG_SLOTS + SOURCE_SLOTS)
    slots[crc32((lang or "").encode()) % LANG_SLOTS] = 1.0
    slots[LANG_SLOTS + crc32((source or "").encode()) % SOURCE_SLOTS] = 1.0
    return [
        math.log1p(len(data)),
        math.log1p(len(lines)),
        math.log1p(size / len(lines)),
        len(set(lines)) / len(lines),
        math.sqrt(share(_SYMBOLS)),
        math.sqrt(share(_SHOUTS)),
        math.sqrt(share(_CAPITALS)),
        share(_DIGITS),
        share(_STOPS),
        share(b" \t\r\n"),
        *slots,
    ]


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def logit(self, rows: np.ndarray) -> np.ndarray:
        scaled = np.clip((rows - self.mean) / self.scale, -8, 8)
        return scaled @ self.weights[1:] + self.weights[0]


def _design(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(rows)), np.clip((rows - mean) / scale, -8, 8)])


def _sums(x: np.ndarray, marks: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Loss (the negative log likelihood), gradient and curvature of rows, as one vector."""
    logits = x @ weights
    p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
    loss = (np.logaddexp(0, logits) - marks * logits).sum()
    return np.concatenate([[loss], x.T @ (marks - p), (x.T @ (x * (p * (1 - p) + 1e-9)[:, None])).ravel()])


def _ridge(size: int, penalty: float) -> np.ndarray:
    ridge = penalty * np.eye(size)
    ridge[0, 0] = 1e-6
    return ridge


def _step(sums: np.ndarray, weights: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """The penalised loss, and a Newton step from there."""
    size, ridge = len(weights), _ridge(len(weights), penalty)
    gradient, curve = sums[1 : 1 + size], sums[1 + size :].reshape(size, size)
    loss = sums[0] + weights @ ridge @ weights / 2
    return float(loss), np.clip(np.linalg.solve(curve + ridge, gradient - ridge @ weights), -4, 4)


def fit_logistic(rows: np.ndarray, marks: np.ndarray, penalty: float = 1.0, scaling: tuple | None = None) -> Logistic:
    """A penalised logistic fit by Newton steps."""
    mean, scale = scaling or (rows.mean(axis=0), rows.std(axis=0))
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = _design(rows, mean, scale)
    weights = np.zeros(x.shape[1])
    for _ in range(25):
        _, step = _step(_sums(x, marks, weights), weights, penalty)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, scale, weights)


@dataclass
class Model:
    """Both views, and the bias and weights of their calibrated logits; `views` is None where nothing could be learnt."""

    views: tuple[Logistic, Logistic] | None
    blend: np.ndarray

    def score(self, content: np.ndarray, page: np.ndarray) -> np.ndarray:
        """(documents by 3): the views' own probabilities and the combined one."""
        if self.views is None:
            return np.full((len(content), 3), float(self.blend[0]))
        logits = np.column_stack([self.views[0].logit(content), self.views[1].logit(page)]).clip(-20, 20)
        both = self.blend[0] + logits @ self.blend[1:]
        return 1 / (1 + np.exp(-np.column_stack([logits, both]).clip(-30, 30)))


#: Sums over all unlabelled documents of a function of both their views (rows by columns each), as one vector.
Pool = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray]], np.ndarray]


def pool_of(content: np.ndarray, page: np.ndarray) -> Pool:
    """Unlabelled documents that are at hand."""
    return lambda function: function(content, page)


def _limits(counts: np.ndarray, share: float) -> float:
    """The logit from which on at most this share of the documents lies, and at least one bucket's, however few that is."""
    above = np.cumsum(counts[::-1])[::-1]
    fits = np.flatnonzero(above <= max(share * counts.sum(), 1))
    at = fits[0] if len(fits) else len(counts) - 1
    return max((at - REACH * FINE) / FINE, math.log(SURE / (1 - SURE)))


def co_train(content: np.ndarray, page: np.ndarray, marks: np.ndarray, pool: Pool) -> Model:
    """Train both views on marked rows (0 or 1) and on what they hand each other of the pool.

    In round n each view hands on the documents it is surest of: n times the share HANDED of all, split by the marks' rates, and none of which
    it is less sure than SURE. Together they weigh no more than the marked rows.
    Without rows of both marks there is nothing to learn: all score 1, or 0 if all marks are 0.
    """
    if len(set(marks.tolist())) < 2:
        return Model(None, np.array([float(marks[0]) if len(marks) else 1.0]))
    held = np.arange(len(marks)) % CALIBRATING == CALIBRATING - 1
    if len(set(marks[~held].tolist())) < 2 or len(set(marks[held].tolist())) < 2:
        held = np.zeros(len(marks), bool)
    sides, own = (content, page), marks[~held]
    widths = [side.shape[1] for side in sides]
    views = [fit_logistic(side[~held], own) for side in sides]
    designs = [_design(side[~held], view.mean, view.scale) for side, view in zip(sides, views, strict=True)]
    base = own.mean()

    def spread(*both: np.ndarray) -> np.ndarray:
        """How many documents each view gives which logit, from both ends."""
        logits = [view.logit(side).clip(-REACH, REACH - 1e-6) for view, side in zip(views, both, strict=True)]
        return np.concatenate([np.bincount(((sign * logit).clip(-REACH, REACH - 1e-6) * FINE + REACH * FINE).astype(int), minlength=2 * REACH * FINE) for logit in logits for sign in (1, -1)])

    for turn in range(1, ROUNDS + 1):
        counts = pool(spread).reshape(2, 2, -1)
        if not counts.sum():
            break
        limits = [[_limits(counts[k, mark], turn * HANDED * rate) for mark, rate in ((0, base), (1, 1 - base))] for k in (0, 1)]
        givers = list(views)

        def handed(*both: np.ndarray) -> np.ndarray:
            parts = []
            for k in (0, 1):
                sure = givers[1 - k].logit(both[1 - k])
                good, bad = sure >= limits[1 - k][0], -sure >= limits[1 - k][1]
                mine = good | bad
                x = _design(both[k][mine], views[k].mean, views[k].scale)
                parts += [[mine.sum()], _sums(x, good[mine].astype(float), views[k].weights)]
            return np.concatenate(parts)

        # Newton steps from the weights of the round before; one that makes things worse is halved.
        begun = [(math.inf, view.weights, np.zeros(len(view.weights))) for view in views]
        for _ in range(STEPS):
            sums, at, largest = pool(handed), 0, 0.0
            for k in (0, 1):
                now, end = views[k].weights, at + 2 + (widths[k] + 1) * (widths[k] + 2)
                weight = min(1.0, len(own) / sums[at]) if sums[at] else 0.0
                loss, step = _step(_sums(designs[k], own, now) + weight * sums[at + 1 : end], now, 1.0)
                if loss > begun[k][0] + 1e-9:
                    loss, now, step = begun[k][0], begun[k][1], begun[k][2] / 2
                begun[k], at = (loss, now, step), end
                # Sums of doubles depend on their order in the last digits; rounding them off makes reruns agree.
                views[k] = Logistic(views[k].mean, views[k].scale, np.round(now + step, 8))
                largest = max(largest, float(np.abs(step).max()))
            if largest < 1e-3:
                break
    judged = held if held.any() else ~held
    logits = np.column_stack([views[k].logit(sides[k][judged]) for k in (0, 1)]).clip(-20, 20)
    blend = fit_logistic(logits, marks[judged], penalty=0.5)
    weights = blend.weights[1:] / blend.scale
    return Model((views[0], views[1]), np.round(np.concatenate([[blend.weights[0] - blend.mean @ weights], weights]), 9))


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data = texts(batch)
    langs, sources = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("lang", "source"))
    content = np.array([content_view(d) for d in data]).reshape(len(data), -1)
    page = np.array([page_view(d, g, s) for d, g, s in zip(data, langs, sources, strict=True)]).reshape(len(data), -1)
    return content, page


def _inputs(docs: DataFrame, *more: str) -> DataFrame:
    column = lambda n: (F.col(n).cast("string") if n in docs.columns else F.lit(None).cast("string")).alias(n)
    return docs.select("doc_id", *more, column("text"), column("lang"), column("source"))


def _sample(docs: DataFrame, marks: DataFrame) -> list:
    """Both views of the documents with the ids of `marks` (doc_id, quality), in the order of a hash of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, page = _views(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(content), pa.list_(pa.float64())), pa.array(list(page), pa.list_(pa.float64()))],
                names=["doc_id", "quality", "content", "page"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _inputs(docs).join(F.broadcast(marks), "doc_id")  # the marks are bounded
    rows = rows.select("doc_id", "quality", "text", "lang", "source")
    found = rows.mapInArrow(run, f"doc_id {kind}, quality int, content array<double>, page array<double>")
    one = found.groupBy("doc_id").agg(F.min(F.struct("quality", "content", "page")).alias("row"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").select("row.*").collect()


def _unlabelled(docs: DataFrame, labels: DataFrame) -> Pool:
    """Both views of all documents without a label, as a table that every sum reads."""
    kinds = "content array<float>, page array<float>"

    def views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = batch.column(batch.schema.get_field_index("same"))
            lists = [pa.array(list(side.astype(np.float32)), pa.list_(pa.float32())) for side in _views(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), same, *lists], names=["doc_id", "same", "content", "page"])

    rows = _inputs(docs).withColumn("same", F.xxhash64("text", "lang", "source"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Labels are taken out after the texts have become a few numbers, so that no text is shuffled.
    each = rows.mapInArrow(views, f"doc_id {kind}, same long, {kinds}")
    each = each.join(labels.select("doc_id").where(F.col("doc_id").isNotNull()).distinct(), "doc_id", "left_anti")
    each = each.groupBy("same").agg(F.first("content").alias("content"), F.first("page").alias("page"))
    table = materialize(each.select("content", "page"), "quality-views")

    def pool(function: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    sides = [batch.column(k).flatten().to_numpy().astype(float).reshape(batch.num_rows, -1) for k in (0, 1)]
                    found = function(*sides)
                    total = found if total is None else total + found
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.astype(float))], names=["place", "value"])

        # A row a place of the vector: some 1,500 at most, whatever the number of documents.
        sums = table.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(1 + max((row.place for row in sums), default=-1))
        for row in sums:
            out[row.place] = row.value
        return out if len(sums) else function(np.zeros((0, len(content_view(b"")))), np.zeros((0, len(page_view(b"", None, None)))))

    return pool


def learn(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """Train on `labels` (doc_id, quality 0 or 1; other values are no label) and all documents without a row there.

    An id with two labels counts as 0, an id of several documents as one of them; null ids and labels are left out.
    Further columns of either table are not read. Without labels every document scores alike.
    """
    bound_batches(docs.sparkSession)
    marks = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    marks = marks.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    known = _sample(docs, marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled))
    if len({row.quality for row in known}) < 2:
        return co_train(np.zeros((len(known), 1)), np.zeros((len(known), 1)), np.array([row.quality for row in known], float), pool_of)
    side = lambda name: np.array([row[name] for row in known], float)
    return co_train(side("content"), side("page"), np.array([row.quality for row in known], float), _unlabelled(docs, labels))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, content_score, page_score and the combined score (0 to 1, higher is better) of every document.

    Null texts, languages and sources count as empty. Equal rows score alike, an empty table gives
    no rows, further columns are not read.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = model.score(*_views(batch))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(found[:, k]) for k in range(3))],
                    names=["doc_id", "content_score", "page_score", "score"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _inputs(docs).mapInArrow(run, f"doc_id {kind}, content_score double, page_score double, score double")


def good_documents(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents that score `least` or more, with all their columns.

    Every row is judged by its own text, language and source, so equal ids do not matter.
    """
    bound_batches(docs.sparkSession)
    names = docs.columns
    inside = _inputs(docs.withColumn("__row", F.struct(*[F.col(c) for c in names])), "__row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = model.score(*_views(batch))[:, 2] >= least
                yield batch.select(["__row"]).filter(pa.array(keep))

    return inside.mapInArrow(run, inside.select("__row").schema).select("__row.*")
