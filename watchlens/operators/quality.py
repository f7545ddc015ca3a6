"""Data-quality checks. Each reads its table once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchlens.schemas import TableSpec


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def rules_of(spec: TableSpec, columns: list[str]) -> dict[str, Column]:
    """The rules a table's definition implies for the given columns, as `true when broken`."""
    rules: dict[str, Column] = {}
    for name in spec.required:
        if name in columns:
            rules[f"{name}:required"] = F.col(name).isNull()
    for name, values in spec.domains.items():
        if name in columns:
            rules[f"{name}:domain"] = ~F.col(name).isin(*values)
    for name, length in spec.max_length.items():
        if name in columns:
            rules[f"{name}:length"] = F.length(name) > length
    for name, (low, high) in spec.ranges.items():
        if name in columns:
            rules[f"{name}:range"] = ~F.col(name).between(low, high)
    return rules


def rule_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule: rows checked and rows that break it. NULL breaks only `required` rules."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__checked"),
        *[F.count_if(F.coalesce(broken, F.lit(False))).alias(rule) for rule, broken in rules.items()],
    )
    return counts.unpivot(["__checked"], list(rules), "rule", "violations").withColumnRenamed("__checked", "checked")


def distribution(df: DataFrame, column: str, targets: dict[str, float]) -> DataFrame:
    """Share of each target value in percent, its target and their distance; other values as `(other)`."""
    value = F.col(column)
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(value == name).alias(name) for name in targets],
        F.count_if(F.coalesce(~value.isin(*targets), F.lit(True))).alias("(other)"),
    )
    target = F.create_map(*[item for name, percent in targets.items() for item in (F.lit(name), F.lit(percent))])
    percent = F.coalesce(F.try_divide(F.col("count") * 100.0, F.col("__rows")), F.lit(0.0))
    return (
        counts.unpivot(["__rows"], [*targets, "(other)"], "value", "count")
        .withColumn("target_percent", F.coalesce(F.try_element_at(target, F.col("value")), F.lit(0.0)))
        .withColumn("percent", F.round(percent, 2))
        .withColumn("distance", F.round(F.abs(percent - F.col("target_percent")), 2))
        .drop("__rows")
    )


def orphan_rows(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key the dimension does not hold."""
    return df.join(dimension.select(key), key, "left_anti")


def orphan_keys(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys the dimension does not hold, with their rows; rows shrink to keys before the join."""
    used = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dimension.select(key), key, "left_anti")


def known_rows(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key the dimension holds, each once."""
    return df.join(dimension.select(key), key, "left_semi")


def schema_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per column, expected or found: types, `ok`/`type`/`missing`/`extra`, and values that are not NULL."""
    expected = {f.name: f.dataType.simpleString() for f in spec.columns}
    found = dict(df.dtypes)
    counts = df.agg(*[F.count(F.col(name)).alias(name) for name in found])
    lines = []
    for name in [*expected, *[n for n in found if n not in expected]]:
        want, have = expected.get(name), found.get(name)
        status = "missing" if have is None else "extra" if want is None else "ok" if want == have else "type"
        lines.append(
            F.struct(
                F.lit(spec.name).alias("table_name"),
                F.lit(name).alias("column_name"),
                F.lit(want).cast("string").alias("expected_type"),
                F.lit(have).cast("string").alias("found_type"),
                F.lit(status).alias("status"),
                (F.col(name) if have else F.lit(0).cast("bigint")).alias("filled"),
            )
        )
    return counts.select(F.inline(F.array(*lines)))
