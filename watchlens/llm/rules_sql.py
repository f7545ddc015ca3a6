"""The quality rules in DuckDB SQL, to check the operator against."""

from __future__ import annotations

from watchlens.llm.rules import (
    DRAWN, GAMMA, LEAST_WORDS, MEASURES, MOST_REPEATED, SMALLEST, SPREADS, WINDOW,
)

_RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "shouts_per_word": ("n_shouts", "n_words"),
    "capitals_per_letter": ("n_capitals", "word_chars"),
    "repeated_lines": ("n_dup_lines", "n_lines + 4"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "stutters_per_word": ("n_stutters", "n_words"),
    "letters_per_word": ("word_chars", "n_words"),
}


def _value(name: str) -> str:
    above, below = _RATIOS[name]
    return f"CASE WHEN {below} > 0 THEN ({above})::DOUBLE / ({below}) ELSE 0.0 END"


def _limits(level: str, keys: str) -> str:
    """Quantiles and limits of one level of groups, out of the bucket counts."""
    group = f"{keys}, " if keys else ""
    by = f"{keys}, measure" if keys else "measure"
    columns = []
    for name, (least, both) in MEASURES.items():
        spread = f"greatest(middle - low, {least}::DOUBLE) * {SPREADS}::DOUBLE"
        columns.append(f"max(CASE WHEN measure = '{name}' THEN middle + {spread} END) AS {name}_high")
        low = f"middle - {spread}" if both else "-1.0::DOUBLE"
        columns.append(f"max(CASE WHEN measure = '{name}' THEN {low} END) AS {name}_low")
    return f"""{level}_counts AS (SELECT {group}measure, bucket, count(*) AS n FROM buckets GROUP BY ALL),
{level}_ranks AS (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY bucket) AS below, sum(n) OVER (PARTITION BY {by}) AS total,
  CASE WHEN bucket > 0 THEN {SMALLEST}::DOUBLE * pow({GAMMA}::DOUBLE, bucket - 0.5::DOUBLE) ELSE 0.0 END AS v FROM {level}_counts),
{level}_found AS (SELECT {group}measure, max(total) AS total, min(v) FILTER (below >= 0.5::DOUBLE * total) AS middle,
  min(v) FILTER (below >= 0.1::DOUBLE * total) AS low FROM {level}_ranks GROUP BY ALL),
{level} AS (SELECT {group}max(total) AS documents, {', '.join(columns)} FROM {level}_found {f'GROUP BY {keys}' if keys else ''})"""


def _inside() -> str:
    tests = []
    for name in MEASURES:
        def drawn(level: str, to: str, column: str) -> str:
            return f"coalesce(({level}.documents * {level}.{column} + {DRAWN} * {to}) / ({level}.documents + {DRAWN}), {to})"

        low, high = (drawn("s", drawn("g", f"a.{name}_{end}", f"{name}_{end}"), f"{name}_{end}") for end in ("low", "high"))
        tests.append(f"coalesce({_value(name)} BETWEEN {low} AND {high}, true)")
    return "\n  AND ".join(tests)


SQL = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
windows AS (SELECT rid, i, array_to_string(words[i : i + {WINDOW - 1}], ' ') AS g
  FROM (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w WHERE len(words) >= {WINDOW})),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, {WINDOW})) AS k) GROUP BY 1),
base AS (SELECT w.rid, doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
    length(t) - length(regexp_replace(t, '[!?]+', '', 'g')) AS n_shouts,
    length(t) - length(regexp_replace(t, '\\p{{Lu}}+', '', 'g')) AS n_capitals,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_stutters,
    coalesce(covered.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered ON covered.rid = w.rid),
judged AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM base),
vals AS ({' UNION ALL '.join(f"SELECT lang, source, '{name}' AS measure, {_value(name)} AS v FROM judged WHERE NOT base_failed" for name in MEASURES)}),
buckets AS (SELECT lang, source, measure,
  CASE WHEN v < {SMALLEST}::DOUBLE THEN 0 ELSE CAST(ceil(ln(v / {SMALLEST}::DOUBLE) / ln({GAMMA}::DOUBLE)) AS INTEGER) END AS bucket FROM vals),
{_limits('by_source', 'lang, source')},
{_limits('by_lang', 'lang')},
{_limits('overall', '')}
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND {_inside()} AS kept
FROM judged
LEFT JOIN by_source s ON s.lang IS NOT DISTINCT FROM judged.lang AND s.source IS NOT DISTINCT FROM judged.source
LEFT JOIN by_lang g ON g.lang IS NOT DISTINCT FROM judged.lang
CROSS JOIN overall a"""
