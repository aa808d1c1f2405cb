"""Writing and upserting database tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from vedrina.operators.latest import latest_per_key
from vedrina.operators.rows import with_values


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: dict[str, str] | None = None,
    connections: int = 16,
) -> None:
    """Write a DataFrame to a database table from the executors, at most ``connections`` at once."""
    options = {"batchsize": "10000", **(properties or {})}
    for_connections(df, connections).write.jdbc(url, table, mode=mode, properties=options)


def for_connections(df: DataFrame, connections: int) -> DataFrame:
    """The rows in one part per connection. They are shuffled to these parts, so what comes before runs in as many tasks
    as it would; the writer's own ``numPartitions`` would run all of it in one task per connection."""
    return df.repartition(connections)


def upsert_statement(table: str, staging: str, columns: list[str], keys: list[str]) -> str:
    """One set-based statement that upserts all staged rows. A task that was run again may have staged
    its rows twice, hence the DISTINCT."""
    names = ", ".join(columns)
    updates = ", ".join(f"{name} = EXCLUDED.{name}" for name in columns if name not in keys)
    action = f"DO UPDATE SET {updates}" if updates else "DO NOTHING"
    return (
        f"INSERT INTO {table} ({names}) SELECT DISTINCT {names} FROM {staging} "
        f"WHERE true ON CONFLICT ({', '.join(keys)}) {action}"
    )


def upsert_table(
    batch: DataFrame,
    url: str,
    table: str,
    staging: str,
    keys: list[str],
    order: list[str | Column],
    execute: Callable[[str], None],
    columns: list[str],
    properties: dict[str, str] | None = None,
    connections: int = 16,
) -> None:
    """Upsert a batch: the executors fill the staging table with one row per key, then the database
    moves it in one statement. ``execute`` runs a statement on the caller's own connection, in one
    transaction. Rows without a key must have been set aside before."""
    values = [name for name in columns if name not in keys]
    latest = latest_per_key(with_values(batch, keys), keys, order, values).select(*columns)
    staged = {"truncate": "true", **(properties or {})}
    write_table(latest, url, staging, "overwrite", staged, connections)
    execute(upsert_statement(table, staging, columns, keys))
