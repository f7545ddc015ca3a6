"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded texts.

Folding undoes the usual disguises: case, look-alike letters of other scripts, digits and
signs in place of letters, punctuation round words. The lexicon is learnt: terms that labelled
toxic documents hold more often than others are candidates, whole words as well as beginnings
that a document's words share (`stem*`, counted from their second word on), and a regularised logistic fit
gives them their weights, which also tells marks of toxicity from words that merely keep it
company. Phrases in which a term is harmless do not count as hits. A text's score is the
logistic value of its summed weights over a power of its length.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchlens.llm.text import bound_batches, texts
from watchlens.session import materialize

#: Most terms of the lexicon, most exception phrases, most labelled documents that it is learnt from.
TERMS, PHRASES, FIT_ROWS = 400, 400, 40_000
#: Lengths of shared beginnings, and the most that one term counts in a text.
STEMS, MOST_HITS = range(4, 9), 6
#: A candidate term occurs in so many toxic documents at least.
LEAST_TOXIC = 3
#: Hits are divided by (words + LENGTH_BASE) ** LENGTH_POWER.
LENGTH_BASE, LENGTH_POWER = 20.0, 0.25

# Letters that stand for a Latin one, and digits and signs that do.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ї": "i", "ј": "j", "ԁ": "d", "ɡ": "g", "һ": "h", "ո": "n", "ս": "u",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ł": "l", "ø": "o", "ѵ": "v", "ԛ": "q", "ԝ": "w", "ʏ": "y", "ʟ": "l", "ɴ": "n", "ɪ": "i",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "+": "t"}
HARMLESS = ("trash can", "trash bin", "trash bag", "clown fish", "scum line", "pond scum")

_SIGN_INSIDE = re.compile(rb"(?<=[a-z0-9])[@$!|+](?=[a-z0-9])|(?<![^ \t\r\n])[@$](?=[a-z])")
_OTHER_SCRIPTS = re.compile(rb"[\xc4-\xef]")
_GLYPHS = {ord(a): b for a, b in HOMOGLYPHS.items()}


def _table() -> bytes:
    out = bytearray(range(256))
    for code in range(128):
        letter = chr(code)
        out[code] = ord(DIGITS.get(letter, letter.lower())) if letter.isalnum() else 32
    return bytes(out)


_TABLE = _table()


def fold(data: bytes) -> str:
    """A text's folded words, one blank between them and round them, a character a byte.

    Signs count as letters only between letters or digits, and `@` and `$` before a word's first
    letter: a word's trailing signs are not its own.
    """
    low = data.lower()
    if _OTHER_SCRIPTS.search(low):
        plain = unicodedata.normalize("NFKC", low.decode("utf-8", "replace")).lower().translate(_GLYPHS)
        low = plain.encode()
    if _SIGN_INSIDE.search(low):
        low = _SIGN_INSIDE.sub(lambda m: SIGNS[m[0].decode()].encode(), low)
    return (b" " + b" ".join(low.translate(_TABLE).split()) + b" ").decode("latin-1")


def words(folded: str) -> list[str]:
    return [word for word in folded.split(" ") if word]


@dataclass
class Lexicon:
    weights: dict[str, float]
    phrases: tuple[str, ...]
    bias: float

    def matcher(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        found = ahocorasick.Automaton()
        for phrase in self.phrases:
            found.add_word(f" {phrase} ", (len(phrase), 0, None))
        for term in self.weights:
            if term.endswith("*"):
                found.add_word(f" {term[:-1]}", (len(term) - 1, 1, term))
            else:
                found.add_word(f" {term} ", (len(term), 0, term))
        found.make_automaton()
        return found


def hits(folded: str, matcher: ahocorasick.Automaton | None) -> Counter:
    """Lexicon terms of a folded text with their counts, without those inside exception phrases."""
    if matcher is None:
        return Counter()
    terms, shields = [], []
    for end, (size, past, term) in matcher.iter(folded):
        span = (end + past - size, end + past)
        if term is None:
            shields.append(span)
        else:
            terms.append((*span, term))
    if shields:
        terms = [t for t in terms if not any(a <= t[0] and t[1] <= b for a, b in shields)]
    counts = Counter(term for _, _, term in terms)
    return Counter({term: n for term, count in counts.items() if (n := count - term.endswith("*"))})


def _scale(count: int) -> float:
    return (count + LENGTH_BASE) ** LENGTH_POWER


def score(folded: str, lexicon: Lexicon, matcher: ahocorasick.Automaton | None) -> float:
    found = hits(folded, matcher)
    raw = sum(lexicon.weights[t] * min(n, MOST_HITS) for t, n in sorted(found.items()))
    return float(1 / (1 + np.exp(-np.clip(lexicon.bias + raw / _scale(folded.count(" ")), -30, 30))))


def _terms(folded: str) -> set[str]:
    own = {w for w in words(folded) if 3 <= len(w) <= 40}
    stems = Counter(w[:size] + "*" for w in own for size in STEMS if size <= len(w))
    return own | {stem for stem, count in stems.items() if count > 1}


def _term_counts(labelled: DataFrame) -> DataFrame:
    """Documents of each label that hold a term, counted in the tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (Counter(), Counter())
            marks = batch.column(batch.schema.get_field_index("toxic")).to_pylist()
            for data, mark in zip(texts(batch), marks, strict=True):
                counts[mark].update(_terms(fold(data)))
            terms = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_pydict(
                {"term": terms, "clean": [counts[0][t] for t in terms], "toxic": [counts[1][t] for t in terms]}
            )

    each = labelled.mapInArrow(run, "term string, clean long, toxic long")
    return each.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _candidates(labelled: DataFrame, clean: int, toxic: int) -> list[str]:
    """The terms that mark toxic documents best: by count times log odds, which must be over 1 surely.

    Of nested beginnings with the same counts, the longest stands for all.
    """
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    doubt = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    rows = _term_counts(labelled).where(F.col("toxic") >= LEAST_TOXIC).withColumn("odds", odds)
    rows = rows.where(F.col("odds") - doubt > 1)
    stem = F.when(F.col("term").endswith("*"), F.substring("term", 1, STEMS[0])).otherwise(F.col("term"))
    longest = F.max_by("term", F.length("term"))
    rows = rows.groupBy(stem.alias("stem"), "toxic", "odds").agg(longest.alias("term")).orderBy((F.col("toxic") * F.col("odds")).desc(), "term")
    return [row.term for row in rows.select("term").limit(TERMS).collect()]


def _found(labelled: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Hits of every labelled document, and the two-word phrases round them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, own = lexicon.matcher(), lexicon.weights
        for batch in batches:
            out = {"words": [], "terms": [], "counts": [], "phrases": []}
            for data in texts(batch):
                folded = fold(data)
                there = hits(folded, matcher)
                out["words"].append(folded.count(" "))
                out["terms"].append(sorted(there))
                out["counts"].append([there[t] for t in sorted(there)])
                seen: set[str] = set()
                if there:
                    row = words(folded)
                    for a, b in zip(row, row[1:], strict=False):
                        if a in own or b in own:
                            seen.add(f"{a} {b}")
                out["phrases"].append(sorted(seen))
            names = ["doc_id", "toxic"]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            kinds = {"words": pa.int64(), "terms": pa.list_(pa.string()), "counts": pa.list_(pa.int64()), "phrases": pa.list_(pa.string())}
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(out[n], kinds[n]) for n in kinds], names=names + list(kinds)
            )

    kind = labelled.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, toxic int, words long, terms array<string>, counts array<long>, phrases array<string>"
    return labelled.select("doc_id", "toxic", "text").mapInArrow(run, schema)


def _fit(rows: Sequence, terms: Sequence[str]) -> tuple[np.ndarray, float]:
    """Logistic weights of terms and bias, by gradient steps with a penalty on large weights."""
    place = {t: k for k, t in enumerate(terms)}
    at, column, value = [], [], []
    for n, row in enumerate(rows):
        for term, count in zip(row.terms, row.counts, strict=True):
            at.append(n)
            column.append(place[term])
            value.append(min(count, MOST_HITS) / _scale(row.words))
    at, column, value = np.array(at, int), np.array(column, int), np.array(value)
    y = np.array([row.toxic for row in rows], float)
    weights, bias, count = np.zeros(len(terms)), 0.0, len(rows)
    seen_w, seen_b = np.full(len(terms), 1e-8), 1e-8
    for _ in range(400):
        z = bias + np.bincount(at, weights[column] * value, count)
        gap = 1 / (1 + np.exp(-z)) - y
        slope = np.bincount(column, gap[at] * value, len(terms)) / count + 1e-5 * weights
        slope_b = gap.mean()
        seen_w += slope**2
        seen_b += slope_b**2
        weights -= 1.0 * slope / np.sqrt(seen_w)
        bias -= 0.5 * slope_b / np.sqrt(seen_b)
    return weights, float(bias)


def learn(docs: DataFrame, labels: DataFrame, harmless: Sequence[str] = HARMLESS) -> Lexicon:
    """Learn a lexicon from `labels` (doc_id, toxic 0 or 1; other values are no label).

    At most FIT_ROWS labelled ids are taken, by a hash of the id; with that bound they are sent to
    where the texts are. Without toxic or without clean documents the lexicon is empty.
    """
    bound_batches(docs.sparkSession)
    marks = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    labelled = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(marks), "doc_id")
    labelled = materialize(labelled, "toxicity")
    totals = {row.toxic: row["count"] for row in labelled.groupBy("toxic").count().collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not clean or not toxic:
        return Lexicon({}, (), -30.0 if not toxic else 30.0)
    terms = _candidates(labelled, clean, toxic)
    known = Lexicon(dict.fromkeys(terms, 1.0), (), 0.0)
    found = _found(labelled, known)
    both = found.select("toxic", F.explode("phrases").alias("phrase")).groupBy("phrase")
    mild = both.agg(
        F.sum(F.when(F.col("toxic") == 0, 1).otherwise(0)).alias("clean"), F.sum("toxic").alias("toxic")
    ).where((F.col("clean") >= 3) & (F.col("toxic") == 0))
    learnt = [row.phrase for row in mild.orderBy(F.col("clean").desc(), "phrase").limit(PHRASES).collect()]
    phrases = tuple(dict.fromkeys([fold(p.encode()).strip() for p in harmless] + learnt))
    one = found.groupBy("doc_id").agg(F.min(F.struct("toxic", "words", "terms", "counts")).alias("row"))
    weights, bias = _fit(one.orderBy("doc_id").select("row.*").collect(), terms)
    own = {t: round(float(w), 6) for t, w in zip(terms, weights, strict=True) if w > 0.05}
    return Lexicon(own, phrases, round(bias, 6))


def scores(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """`score` in 0..1 of every document beside its id and held_out, by whole texts.

    Null and empty texts have no hits and get the score of the bias alone. Equal texts get equal
    scores, an empty table gives no rows, and no other column plays a part.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for batch in batches:
            values = [score(fold(data), lexicon, matcher) for data in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
