"""JDBC sink for an external warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str, batch_rows: int = 50_000, connections: int = 32
) -> dict[str, str]:
    """Writer options: append without transactions, in large batches over few connections."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "isolationLevel": "NONE",
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
    }


def append_jdbc(df: DataFrame, options: dict[str, str]) -> None:
    """Append a frame to a table. An empty frame writes nothing; an error is raised, not logged.

    Appending is not idempotent: a retried task may repeat rows, and the target must merge
    them by key and version, as the file warehouse does when it is read.
    """
    df.write.format("jdbc").options(**options).mode("append").save()
