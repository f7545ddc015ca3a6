"""Quality rules whose thresholds follow each language and source.

Fixed cut-offs suit one kind of text and fail another, so every measure gets its limits from
the documents of the same language and source. Their distribution is kept as a quantile
sketch: the values' logarithms are rounded to buckets, so that a quantile is right within
`GAMMA`, and a sketch is one count a bucket. Sketches merge by adding counts, in any order and
with the same result, which is how sources make up a language, and languages everything.

All of it is made of Spark's own expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchlens.llm.text import BLANKS
from watchlens.session import materialize

#: Ratio of neighbouring bucket borders, and the value below which all is one bucket.
GAMMA, SMALLEST = 1.05, 1e-4
#: Words in a window that counts as repeated; fewest words; per cent of repeated words.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: As many documents as a source's language (or a language's whole) counts for beside its own.
DRAWN = 30
#: A limit lies this many spreads beyond the median.
SPREADS = 4.0
#: Smallest spread of each measure (in the measure's unit), and whether low values count too.
MEASURES = {
    "symbols_per_word": (0.06, False),
    "shouts_per_word": (0.06, False),
    "capitals_per_letter": (0.08, False),
    "repeated_lines": (0.08, False),
    "repeated_words": (0.1, False),
    "stutters_per_word": (0.04, False),
    "letters_per_word": (1.5, True),
}


def base_measures(docs: DataFrame, keep: Sequence[str] = ("doc_id", "lang", "source")) -> DataFrame:
    """One row a document with the counts that the rules use.

    Null and empty texts have no words and only zeros. Whole texts are read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(F.col("__text"), F.lit(" \t\n\x0b\x0c\r"))
    rows = docs.select(*[F.col(c) for c in keep], text.alias("__text"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{BLANKS}+"))
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    without = lambda pattern: F.length("__text") - F.length(F.regexp_replace("__text", pattern, ""))
    rows = rows.withColumns(
        {
            "__words": words,
            "__lines": lines,
            "n_symbols": without(r"[#*$%&|<>]+").cast("long"),
            "n_shouts": without(r"[!?]+").cast("long"),
            "n_capitals": without(r"\p{Lu}+").cast("long"),
        }
    ).drop("__text")
    windows = F.when(
        F.size("__words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.size("__words") - (WINDOW - 1)),
            lambda start: F.xxhash64(F.slice("__words", start, WINDOW)),
        ),
    )
    # Words equal to the one before: equal neighbours of the text's list of words.
    stutters = F.size(
        F.filter(F.sequence(F.lit(0), F.size("__words") - 1), lambda k: F.get("__words", k) == F.get("__words", k - 1))
    )
    rows = rows.select(
        *keep,
        F.when(F.size("__words") > 1, stutters).otherwise(F.lit(0)).cast("long").alias("n_stutters"),
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        "n_shouts",
        "n_capitals",
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("__windows"),
    )
    # Only texts with a window found twice are sorted: equal windows are then neighbours.
    repeated = F.size(F.array_distinct("__windows")) < F.size("__windows")
    pairs = F.transform("__windows", lambda window, at: F.struct(window.alias("window"), at.alias("at")))
    rows = rows.withColumn("__sorted", F.when(repeated, F.sort_array(pairs))).drop("__windows")
    there = F.sequence(F.lit(0), F.size("__sorted") - 1)

    def twice(k: Column) -> Column:
        own = F.get("__sorted", k)["window"]
        before, after = F.get("__sorted", k - 1)["window"], F.get("__sorted", k + 1)["window"]
        return F.coalesce(own == before, F.lit(False)) | F.coalesce(own == after, F.lit(False))

    starts = F.sort_array(F.transform(F.filter(there, twice), lambda k: F.get("__sorted", k)["at"]))
    rows = rows.withColumn("__starts", F.when(F.size("__sorted") > 0, starts)).drop("__sorted")
    covered = F.aggregate(
        "__starts",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("words")),
        lambda so_far, start: F.struct(
            (start + WINDOW).alias("end"),
            (so_far["words"] + F.least(F.lit(WINDOW), start + WINDOW - so_far["end"])).alias("words"),
        ),
        lambda so_far: so_far["words"],
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__starts")


def _ratio(above: Column, below: Column) -> Column:
    return F.when(below > 0, above / below).otherwise(F.lit(0.0))


def measures() -> dict[str, Column]:
    return {
        "symbols_per_word": _ratio(F.col("n_symbols"), F.col("n_words")),
        "shouts_per_word": _ratio(F.col("n_shouts"), F.col("n_words")),
        "capitals_per_letter": _ratio(F.col("n_capitals"), F.col("word_chars")),
        # A few lines more, so that one line said twice is nothing in a short text.
        "repeated_lines": _ratio(F.col("n_dup_lines"), F.col("n_lines") + 4),
        "repeated_words": _ratio(F.col("n_repeat_words"), F.col("n_words")),
        "stutters_per_word": _ratio(F.col("n_stutters"), F.col("n_words")),
        "letters_per_word": _ratio(F.col("word_chars"), F.col("n_words")),
    }


def sketch(rows: DataFrame, keys: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    """Quantile sketches of several measures: rows (keys, measure, bucket, rows)."""
    bucket = {
        name: F.when(value < SMALLEST, F.lit(0)).otherwise(F.ceil(F.log(value / SMALLEST) / F.log(F.lit(GAMMA))))
        for name, value in columns.items()
    }
    each = F.inline(
        F.array(*[F.struct(F.lit(name).alias("measure"), b.cast("int").alias("bucket")) for name, b in bucket.items()])
    )
    return rows.select(*keys, each).groupBy(*keys, "measure", "bucket").agg(F.count(F.lit(1)).alias("rows"))


def merge(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge sketches into coarser ones of `keys`."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("rows").alias("rows"))


def quantiles(sketches: DataFrame, keys: Sequence[str], wanted: dict[str, float]) -> DataFrame:
    """Quantiles out of sketches: rows (keys, measure, rows, one column a quantile)."""
    group = Window.partitionBy(*keys, "measure")
    so_far = F.sum("rows").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    value = F.when(F.col("bucket") > 0, SMALLEST * F.pow(F.lit(GAMMA), F.col("bucket") - 0.5)).otherwise(F.lit(0.0))
    ranked = sketches.withColumns({"__below": so_far, "__all": F.sum("rows").over(group), "__value": value})
    return ranked.groupBy(*keys, "measure").agg(
        F.first("__all").alias("rows"),
        *[F.min(F.when(F.col("__below") >= F.lit(q) * F.col("__all"), F.col("__value"))).alias(n) for n, q in wanted.items()],
    )


def _limits(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each group with a `<measure>_low` and `<measure>_high`.

    The spread is taken below the median, where junk, which has more symbols, capitals and
    repeats than others, does not reach even if it makes up nearly half of a source.
    """
    found = quantiles(sketches, keys, {"middle": 0.5, "low": 0.1})
    limits = []
    for name, (least, both) in MEASURES.items():
        spread = F.greatest(F.col("middle") - F.col("low"), F.lit(least)) * SPREADS
        low = F.col("middle") - spread if both else F.lit(-1.0)
        limits += [
            F.max(F.when(F.col("measure") == name, F.col("middle") + spread)).alias(f"{name}_high"),
            F.max(F.when(F.col("measure") == name, low)).alias(f"{name}_low"),
        ]
    return found.groupBy(*keys).agg(F.max("rows").alias("rows"), *limits)


def judge(docs: DataFrame) -> DataFrame:
    """Measures and verdict of every document: `base_failed`, and `kept` by the limits of its group.

    A group is a language and source (null is one of each). Its limits are drawn to those of its language, which count for
    DRAWN documents beside its own, and a language's to those of all documents: so a group of few goes by its
    language, one of many by itself, and none changes at once as it grows. The sketches hold the documents that pass the base rules. Null and empty texts fail these.
    Equal rows are judged alike, an empty table gives no rows, further columns are ignored.
    """
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = materialize(base_measures(docs).withColumn("base_failed", failed), "rules")
    fine = materialize(sketch(rows.where(~F.col("base_failed")), ("lang", "source"), measures()), "rules-sketch")
    by_source = _limits(fine, ("lang", "source"))
    by_lang = _limits(merge(fine, ("lang",)), ("lang",))
    overall = _limits(merge(fine.withColumn("whole", F.lit(0)), ("whole",)), ("whole",))
    names = [f"{m}_{end}" for m in MEASURES for end in ("low", "high")]

    def level(limits: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
        return limits.select(
            *[F.col(c).alias(f"{prefix}_{c}") for c in keys], *[F.col(n).alias(f"{prefix}_{n}") for n in ("rows", *names)]
        )

    def drawn(own: str, to: Column) -> Column:
        """A limit of a group (s or g), drawn to that of the next larger one."""
        rows_ = F.col(f"{own[0]}_rows")
        return F.coalesce((rows_ * F.col(own) + DRAWN * to) / (rows_ + DRAWN), to)

    s, g = level(by_source, ("lang", "source"), "s"), level(by_lang, ("lang",), "g")
    # One row at most, so it is a value of the query and no join.
    whole = overall.select(F.struct(*names)).scalar()
    joined = (
        rows.join(s, rows["lang"].eqNullSafe(s["s_lang"]) & rows["source"].eqNullSafe(s["s_source"]), "left")
        .join(g, rows["lang"].eqNullSafe(g["g_lang"]), "left")
        .withColumn("__whole", whole)
    )
    inside = F.lit(True)
    for name, value in measures().items():
        low, high = (drawn(f"s_{name}_{end}", drawn(f"g_{name}_{end}", F.col(f"__whole.{name}_{end}"))) for end in ("low", "high"))
        inside = inside & F.coalesce((value >= low) & (value <= high), F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & inside).select(*rows.columns, "kept")
