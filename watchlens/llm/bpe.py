"""Token counts by byte-pair merging with a heap and a linked list.

A text's symbols are merged pair by pair, always the pair of lowest rank, leftmost first; the
count is the number of initial symbols less the number of merges. No identifiers are made.

No piece holds a blank after another character, so no merge crosses the start of a word:
words are counted one by one, and counts of words seen before are kept in a bounded table.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchlens.llm.text import bound_batches, texts

BLANK = "▁"
#: Words whose counts a task remembers; beyond it the table starts anew.
REMEMBERED = 400_000


def load_ranks(path: str) -> dict[str, float]:
    """Piece -> rank (lower merges first) of a sentencepiece BPE model file.

    Only models that take texts as they are (no normalisation, blanks kept, one blank put in
    front) with byte fallback are supported, and only pieces in which blanks come first.
    """
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    how, kind = model.normalizer_spec, model.trainer_spec
    plain = how.name == "identity" and how.add_dummy_prefix and not how.remove_extra_whitespaces and how.escape_whitespaces
    if not plain or kind.model_type != proto.TrainerSpec.BPE or not kind.byte_fallback:
        raise ValueError(f"{path} is no BPE model with byte fallback over unchanged texts")
    if any(p.type in (p.USER_DEFINED, p.UNUSED) for p in model.pieces):
        raise ValueError(f"{path} has user-defined or unused pieces")
    ranks = {p.piece: -p.score for p in model.pieces if p.type == p.NORMAL}
    if any(BLANK in piece.lstrip(BLANK) or "\n" in piece for piece in ranks):
        raise ValueError(f"{path} has pieces across words or lines")
    return ranks


def merged_count(symbols: str, ranks: dict[str, float]) -> int:
    """Tokens of one stretch of text. A symbol that no piece holds counts its UTF-8 bytes."""
    count = len(symbols)
    piece: list[str | None] = list(symbols)
    before, after = list(range(-1, count - 1)), list(range(1, count + 1))
    find = ranks.get
    heap = []
    for i in range(count - 1):
        rank = find(symbols[i : i + 2])
        if rank is not None:
            heap.append((rank, i, 2))
    heapq.heapify(heap)
    last = count
    while heap:
        _, i, size = heapq.heappop(heap)
        left = piece[i]
        if left is None or after[i] >= last:
            continue
        j = after[i]
        right = piece[j]
        if len(left) + len(right) != size:
            continue  # one of the two has grown since
        joined = left + right
        piece[i], piece[j] = joined, None
        count -= 1
        k = after[i] = after[j]
        if k < last:
            before[k] = i
            rank = find(joined + piece[k])
            if rank is not None:
                heapq.heappush(heap, (rank, i, size + len(piece[k])))
        h = before[i]
        if h >= 0:
            rank = find(piece[h] + joined)
            if rank is not None:
                heapq.heappush(heap, (rank, h, len(piece[h]) + size))
    return count + sum(len(s.encode()) - 1 for s in piece if s is not None and s not in ranks)


def counter(ranks: dict[str, float]) -> Callable[[str], int]:
    """A function that counts the tokens of a whole text."""
    stretches = re.compile(f"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+|\n").findall
    known: dict[str, int] = {}

    def count(text: str) -> int:
        if not text:
            return 0
        total, find = 0, known.get
        for stretch in stretches(BLANK + text.replace(" ", BLANK)):
            tokens = find(stretch)
            if tokens is None:
                tokens = merged_count(stretch, ranks)
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(stretch) <= 64:
                    known[stretch] = tokens
            total += tokens
        return total

    return count


def token_counts(docs: DataFrame, ranks: dict[str, float]) -> DataFrame:
    """`n_bytes` and `n_tokens` of every document, beside its id.

    Null texts are empty and have no bytes and no tokens. Equal rows stay equal rows, an empty
    table gives no rows, other columns are not read. Ranks are bounded by the vocabulary.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks)
        for batch in batches:
            data = texts(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(text) for text in data], pa.int64()),
                    pa.array([count(text.decode("utf-8", "replace")) for text in data], pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long"
    )
