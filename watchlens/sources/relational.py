"""Relational databases over JDBC, and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
    split_by: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 16,
) -> DataFrame:
    """A table; with a numeric `split_by` and its bounds, in parallel reads."""
    if split_by and bounds:
        return spark.read.jdbc(
            url, table, column=split_by, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=partitions, properties=properties,
        )
    return spark.read.jdbc(url, table, properties=properties)


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
    connections: int = 16, batch_size: int = 1000,
) -> None:
    """Append rows, over at most `connections` connections, `batch_size` rows a statement."""
    options = {"batchsize": str(batch_size), "rewriteBatchedStatements": "true", **(properties or {})}
    # numPartitions makes the writer coalesce when there are more tasks than connections.
    df.write.option("numPartitions", connections).jdbc(url, table, mode="append", properties=options)


def replace_statements(table: str, staging: str, columns: list[str], key: list[str]) -> list[str]:
    """Plain SQL that replaces the rows of `table` whose keys are in `staging` by the rows there; NULL matches NULL."""
    same = " AND ".join(
        f"({table}.{name} = {staging}.{name} OR ({table}.{name} IS NULL AND {staging}.{name} IS NULL))" for name in key
    )
    names = ", ".join(columns)
    return [
        f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} WHERE {same})",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
    ]


def replace_jdbc(
    df: DataFrame, url: str, table: str, key: list[str], staging: str,
    properties: dict[str, str] | None = None, connections: int = 16,
) -> None:
    """Put rows into a table at their key: through a staging table, in one transaction of the database."""
    options = {"truncate": "true", "rewriteBatchedStatements": "true", **(properties or {})}
    df.write.option("numPartitions", connections).jdbc(url, staging, mode="overwrite", properties=options)
    jvm = df.sparkSession.sparkContext._jvm
    login = jvm.java.util.Properties()
    for name, value in (properties or {}).items():
        login.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, login)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for text in replace_statements(table, staging, df.columns, key):
            statement.executeUpdate(text)
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines in UTF-8; text of any script stays as it is."""
    df.write.mode(mode).option("encoding", "UTF-8").option("ignoreNullFields", "false").json(path)
