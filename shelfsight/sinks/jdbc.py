"""Writing to a database over JDBC; the driver must be on the class path of the session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.sinks.encode import encode_nested


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 10_000, **options: str
) -> None:
    """Append to or overwrite a table, with one connection for each partition."""
    (
        encode_nested(df).write.format("jdbc").mode(mode)
        .options(url=url, dbtable=table, batchsize=str(batchsize), **options).save()
    )


def upsert_statements(table: str, staging: str, key: str, columns: Sequence[str]) -> list[str]:
    """The SQL that moves a staged batch into its table, to be run in one transaction."""
    names = ", ".join(f'"{c}"' for c in columns)
    return [
        f'DELETE FROM {table} WHERE "{key}" IN (SELECT "{key}" FROM {staging} WHERE "{key}" IS NOT NULL)',
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
    ]


def upsert_jdbc(df: DataFrame, url: str, table: str, key: str | None, **options: str) -> None:
    """Replace all rows of the keys in ``df``; without a key column, replace the table.

    A partitioned write cannot be one transaction. The batch goes into a staging table first, and the
    database itself then deletes and inserts in one.
    """
    if key is None or key not in df.columns:
        write_jdbc(df, url, table, mode="overwrite", **options)
        return
    staging = f"{table}_staging"
    write_jdbc(df.where(F.lit(False)), url, table, mode="append", **options)
    write_jdbc(df, url, staging, mode="overwrite", **options)
    jvm = df.sparkSession._jvm
    properties = jvm.java.util.Properties()
    for name, value in options.items():
        properties.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in upsert_statements(table, staging, key, df.columns):
            statement.executeUpdate(sql)
        connection.commit()
    finally:
        connection.close()
