"""Secret scans: fixed patterns, and a linear-chain conditional random field beside them.

The field tags every token as the begin of a secret, inside one, or outside. Its features are the
token's shape, the neighbouring words and the file it stands in; the best tags are found by
Viterbi. It is trained on a bounded sample of documents, labelled by the patterns, and by what it
learns from their surroundings finds secrets whose spelling the patterns do not know.

Tokens that look alike share one class, so a text becomes a row of class numbers. The Viterbi
recursion runs over all texts of a batch at once, one token of each a step.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchlens.llm.text import bound_batches, texts

# The patterns by kind, and the least length of what they must hold.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "crf")
_SIGNS = re.compile(r"passw|secret|token|api_?key", re.ASCII | re.IGNORECASE)

BEGIN, INSIDE, OUTSIDE = range(3)
#: Documents with and without pattern matches in the training sample; tokens kept round a match; steps.
SAMPLE, AROUND, STEPS = 800, 20, 160
#: Words whose class a task remembers.
REMEMBERED = 400_000

_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_KEYWORDS = re.compile(r"pass(word|wd|phrase|code)?|secret|token|api[_-]?key|credential|auth|bearer|private|access[_-]?key|pwd", re.I)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the patterns' matches in code points, leftmost and apart in each kind."""
    spans = []
    if _SIGNS.search(text):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    spans += [(m.start(), m.end(), 2) for m in LONG_HEX.finditer(text)]
    return sorted(spans)


def _length(n: int) -> int:
    return bisect_right((3, 6, 9, 14, 20, 28, 40, 64), n)


def _keyword(token: str) -> bool:
    return len(token) < 60 and _KEYWORDS.search(token) is not None


def token_class(token: str) -> tuple:
    """What the field sees of a token: kinds of characters, their mixing, length, key words, edges."""
    core = token.strip("\"'`,;:()[]{}<>*#$%&!|.")
    if core.isalpha() and token[0].isalpha() and core[1:].islower():  # nearly all tokens: the same, in short
        return (_length(len(core)), 0, 0, 0, 0, False, _keyword(token), False, False, core.isascii())
    digits = sum(c.isdigit() for c in core)
    upper = sum(c.isupper() for c in core[1:])
    other = sum(not c.isalnum() for c in core)
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(core, core[1:], strict=False))
    hexes = bool(core) and all(c in "0123456789abcdefABCDEF" for c in core)
    return (
        _length(len(core)),
        0 if not digits else 1 if digits == len(core) else 2 if digits * 5 < len(core) else 3,
        0 if not upper else 1 if upper == len(core) - 1 else 2,
        min(other, 3),
        min(changes, 6) // 2,
        hexes and digits > 0,
        _keyword(token),
        token[-1] in "=:" or "=" in token[:-1],
        token[0] in "\"'`",
        core.isascii(),
    )


def _own(kind: tuple) -> list[str]:
    if kind == ("edge",):
        return ["edge"]
    names = [f"{k}:{v}" for k, v in enumerate(kind)]
    return names + [f"0+1+4:{kind[0]},{kind[1]},{kind[4]}", f"0+5:{kind[0]},{kind[5]}", f"1+2:{kind[1]},{kind[2]}"]


def _near(kind: tuple) -> list[str]:
    return ["edge"] if kind == ("edge",) else [f"6:{kind[6]}", f"7:{kind[7]}", f"0:{kind[0]}", f"1:{kind[1]}"]


def _file(text_digits: float, lang: str | None) -> list[str]:
    return [f"digits:{min(int(text_digits * 40), 4)}", f"lang:{lang}"]


@dataclass
class Field:
    """A trained field: feature weights (name -> three tags) and the weights of tag after tag."""

    weights: dict[str, np.ndarray]
    steps: np.ndarray
    begin: np.ndarray
    rows: dict[tuple, np.ndarray] = field(default_factory=dict)

    def row(self, names: Sequence[str]) -> np.ndarray:
        none = np.zeros(3)
        return sum((self.weights.get(n, none) for n in names), none.copy())


def _features(kinds: Sequence[tuple], file: Sequence[str]) -> list[list[str]]:
    padded = [("edge",), *kinds, ("edge",)]
    return [
        [f"own {n}" for n in _own(padded[k])]
        + [f"before {n}" for n in _near(padded[k - 1])]
        + [f"after {n}" for n in _near(padded[k + 1])]
        + [f"file {n}" for n in file]
        for k in range(1, len(padded) - 1)
    ]


def tokens(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


def values(text: str) -> list[tuple[int, int]]:
    """Where the matches of the patterns hold the secret itself."""
    found = {m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]} if _SIGNS.search(text) else set()
    found |= {(a, b) for a, b, kind in base_spans(text) if kind}
    return sorted(found)


def _tags(spans: Sequence[tuple[int, int]], marked: Sequence[tuple[int, int]]) -> list[int]:
    """Tags of tokens by the secrets that reach them; both lists are in order."""
    tags, last, k = [], None, 0
    for start, end in spans:
        while k < len(marked) and marked[k][1] <= start:
            k += 1
        hit = marked[k] if k < len(marked) and marked[k][0] < end else None
        tags.append(OUTSIDE if hit is None else INSIDE if hit == last else BEGIN)
        last = hit
    return tags


def _variants(words: list[str], tags: list[int]) -> Iterator[tuple[list[str], list[int]]]:
    """The words as they are; without separators between name and secret; with another spelling of the secret."""
    yield words, tags
    if all(tag == OUTSIDE for tag in tags):
        return
    kept = [k for k, w in enumerate(words) if tags[k] != OUTSIDE or w not in ("=", ":", ":=", "=>")]
    yield [words[k] for k in kept], [tags[k] for k in kept]
    other = list(words)
    for k, tag in enumerate(tags):
        if tag != OUTSIDE:
            spelt = base64.b64encode(sha256(words[k].encode()).digest()).decode()
            other[k] = spelt[: max(12, min(40, len(words[k])))]
    yield other, tags
    yield [other[k] for k in kept], [tags[k] for k in kept]


def sequences(text: str, lang: str | None) -> list[tuple[list[tuple], list[int], list[str]]]:
    """Training sequences of a document: the stretches round its secrets, or one from its middle."""
    spans = tokens(text)
    tags = _tags(spans, values(text))
    file = _file(sum(c.isdigit() for c in text) / max(1, len(text)), lang)
    middles = [k for k, tag in enumerate(tags) if tag != OUTSIDE] or [len(spans) // 2]
    out, until = [], 0
    for k in middles:
        a, b = max(until, k - AROUND), min(len(spans), k + AROUND)
        if k < until or a >= b:
            continue
        for words, own in _variants([text[s:e] for s, e in spans[a:b]], tags[a:b]):
            out.append(([token_class(w) for w in words], own, file))
        until = b
    return out


def train(rows: Sequence[tuple[list[tuple], list[int], list[str]]]) -> Field:
    """Fit a field by the likelihood of the tags, with the gradient of forward and backward sums."""
    index: dict[str, int] = {}
    data = []
    for kinds, tags, file in rows:
        data.append(([[index.setdefault(n, len(index)) for n in names] for names in _features(kinds, file)], tags))
    steps, begin = np.zeros((3, 3)), np.zeros(3)
    if not data:
        return Field({}, steps, np.array([0.0, -9.0, 9.0]))
    longest, count = max(len(t) for _, t in data), len(data)
    width = max(len(names) for features, _ in data for names in features)
    there = np.zeros((count, longest), bool)
    own = np.full((count, longest, width), len(index))
    gold = np.full((count, longest), OUTSIDE)
    for n, (features, tags) in enumerate(data):
        there[n, : len(tags)] = True
        gold[n, : len(tags)] = tags
        for k, names in enumerate(features):
            own[n, k, : len(names)] = names
    weights = np.zeros((len(index) + 1, 3))
    drift = [np.zeros_like(v) for v in (weights, steps, begin)]
    spread = [np.zeros_like(v) for v in (weights, steps, begin)]
    one_hot = np.eye(3)[gold] * there[..., None]
    gold_pairs = np.einsum("nti,ntj,nt->ij", one_hot[:, :-1], one_hot[:, 1:], there[:, 1:].astype(float))
    for turn in range(1, STEPS + 1):
        emit = weights[own].sum(axis=2)
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = begin + emit[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(ahead[:, t - 1, :, None] + steps, axis=1) + emit[:, t]
            ahead[:, t] = np.where(there[:, t, None], new, ahead[:, t - 1])
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        pairs = np.zeros((3, 3))
        for t in range(longest - 2, -1, -1):
            on = there[:, t + 1, None]
            reach = steps[None] + (emit[:, t + 1] + behind[:, t + 1])[:, None, :]
            behind[:, t] = np.where(on, np.logaddexp.reduce(reach, axis=2), 0.0)
            pairs += (np.exp(ahead[:, t, :, None] + reach - total[:, None, None]) * on[..., None]).sum(axis=0)
        share = np.exp(ahead + behind - total[:, None, None]) * there[..., None]
        slopes = [np.zeros_like(weights), (gold_pairs - pairs) / count, (one_hot[:, 0] - share[:, 0]).sum(axis=0) / count]
        gap = (one_hot - share).reshape(-1, 3)
        flat = own.reshape(-1, width)
        for tag in range(3):
            slopes[0][:, tag] = np.bincount(flat.ravel(), np.repeat(gap[:, tag], width), len(weights)) / count
        slopes[0] -= 1e-4 * weights
        for value, slope, first, second in zip((weights, steps, begin), slopes, drift, spread, strict=True):
            first += 0.1 * (slope - first)
            second += 0.02 * (slope**2 - second)
            value += 0.06 * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.98**turn)) + 1e-6)
        weights[-1] = 0
    return Field({n: np.round(weights[k], 6) for n, k in index.items()}, np.round(steps, 6), np.round(begin, 6))


def viterbi(emits: Sequence[np.ndarray], model: Field) -> list[np.ndarray]:
    """The best tags of several sequences (each an array of tokens by tags), all stepped together."""
    order = sorted(range(len(emits)), key=lambda n: -len(emits[n]))
    lengths = np.array([len(emits[n]) for n in order])
    live = int((lengths > 0).sum())
    if not live:
        return [np.zeros(0, np.int8) for _ in emits]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    flat = np.concatenate([emits[n] for n in order])
    back = np.zeros((len(flat), 3), np.int8)
    best = model.begin + flat[starts[:live]]
    last = np.zeros((len(emits), 3))
    last[:live] = best
    active = np.searchsorted(-lengths, -np.arange(lengths[0] + 1), "left")  # sequences longer than t
    for t in range(1, int(lengths[0])):
        now = int(active[t])
        reach = last[:now, :, None] + model.steps
        choice = reach.argmax(axis=1)
        at = starts[:now] + t
        back[at] = choice
        last[:now] = np.take_along_axis(reach, choice[:, None, :], axis=1)[:, 0] + flat[at]
    tags = np.zeros(len(flat), np.int8)
    tag = last.argmax(axis=1)
    for t in range(int(lengths[0]) - 1, -1, -1):
        now = int(active[t])
        at = starts[:now] + t
        tags[at] = tag[:now]
        tag[:now] = back[at, tag[:now]]
    out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(emits)
    for k, n in enumerate(order):
        out[n] = tags[starts[k] : starts[k] + lengths[k]]
    return out


class Tagger:
    """Adds a field's spans to those of the patterns, a batch of texts at a time."""

    def __init__(self, model: Field) -> None:
        self.model = model
        self.classes: dict[tuple, int] = {("edge",): 0}
        self.known: dict[str, int] = {}
        self.own, self.before, self.after = ([self._row(part, ("edge",))] for part in ("own", "before", "after"))

    def _row(self, part: str, kind: tuple) -> np.ndarray:
        names = _own(kind) if part == "own" else _near(kind)
        return self.model.row([f"{part} {n}" for n in names])

    def number(self, token: str) -> int:
        kind = token_class(token)
        place = self.classes.get(kind)
        if place is None:
            place = self.classes[kind] = len(self.own)
            for part, rows in (("own", self.own), ("before", self.before), ("after", self.after)):
                rows.append(self._row(part, kind))
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(token) <= 64:
            self.known[token] = place
        return place

    def spans(self, many: Sequence[str], langs: Sequence[str | None]) -> list[list[tuple[int, int, int]]]:
        find, rows = self.known.get, []
        for text in many:
            row = list(map(find, parts := _TOKEN.findall(text)))
            if None in row:
                row = [self.number(token) if place is None else place for token, place in zip(parts, row, strict=True)]
            rows.append(np.array(row, np.int64))
        own, before, after = np.array(self.own), np.array(self.before), np.array(self.after)
        emits = []
        for row, text, lang in zip(rows, many, langs, strict=True):
            digits = len(text) - len(text.translate(_NO_DIGITS)) if text.isascii() else sum(map(text.count, "0123456789"))
            file = self.model.row([f"file {n}" for n in _file(digits / max(1, len(text)), lang)])
            padded = np.concatenate([[0], row, [0]])
            emits.append(own[row] + before[padded[:-2]] + after[padded[2:]] + file)
        out = []
        for text, tags in zip(many, viterbi(emits, self.model), strict=True):
            spans = base_spans(text)
            if (tags != OUTSIDE).any():
                spans = sorted(spans + self._added(text, tags, spans))
            out.append(spans)
        return out

    @staticmethod
    def _added(text: str, tags: np.ndarray, base: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Tagged spans that touch no pattern's span: from a begin tag over the inside tags after it."""
        places, found = tokens(text), []
        for k in np.flatnonzero(tags != OUTSIDE):
            if tags[k] == INSIDE and found and found[-1][2] == k - 1:
                found[-1] = (found[-1][0], places[k][1], k)
            else:
                found.append((*places[k], k))
        return [(a, b, 3) for a, b, _ in found if not any(s < b and a < e for s, e, _ in base)]


_NO_DIGITS = str.maketrans("", "", "0123456789")


def learn(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """Train a field on `sample` documents with pattern matches and as many without, by a hash of the id."""
    bound_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    hint = r"(?i)passw|secret|token|api_?key|AKIA|[0-9a-f]{24}"
    rows = docs.select("doc_id", text.alias("text"), lang.alias("lang")).where(F.col("doc_id").isNotNull())
    # Ids are chosen first, so that the texts of no more documents than these are moved.
    hints = rows.groupBy("doc_id").agg(F.max(F.col("text").rlike(hint)).alias("hint"))
    order = (F.xxhash64("doc_id", F.lit(11)), "doc_id")
    ids = [hints.where(F.col("hint") == on).orderBy(*order).limit(sample).select("doc_id") for on in (True, False)]
    taken = rows.join(F.broadcast(ids[0].unionByName(ids[1])), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("row"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1).to_pylist()
            found = [repr(sequences(d.decode("utf-8", "replace"), g)) for d, g in zip(texts(batch), langs, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["found"])

    parts = taken.select("row.text", "row.lang").mapInArrow(cut, "found string")
    import ast

    found = sorted(row.found for row in parts.collect())
    return train([seq for row in found for seq in ast.literal_eval(row)])


def scan(docs: DataFrame, model: Field) -> DataFrame:
    """Every document's spans, counts by pattern and digest of the patterns' spans.

    Columns: doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end by start, then kind, in
    code points). Null texts are empty and have none; equal rows give equal rows, an empty table none;
    other columns than text and lang are not read.
    """
    bound_batches(docs.sparkSession)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    shown = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            many = [data.decode("utf-8", "replace") for data in texts(batch)]
            found = tagger.spans(many, batch.column(2).to_pylist())
            counts = [[sum(k == kind for _, _, k in spans) for spans in found] for kind in range(3)]
            base = [shown([s for s in spans if s[2] < 3]) for spans in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([sha256(b.encode()).hexdigest() for b in base], pa.string()),
                    pa.array([shown(spans) for spans in found], pa.string()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), lang.alias("lang"))
    schema = f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return rows.mapInArrow(run, schema)
