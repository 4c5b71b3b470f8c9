"""State stores of streaming queries: RocksDB with changelog checkpoints, and a view of what a query holds."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Stateful processors need RocksDB; with the changelog a batch uploads its changes, not whole files.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside use RocksDB state; a query keeps the settings it was started with."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None,
               variable: str | None = None) -> DataFrame:
    """What a query's stateful operator holds after a micro-batch (default: the last one), as a table.

    ``key`` and ``value`` (or the columns of a processor's ``variable``) and the partition of the state store. The query
    need not run; nothing is changed.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    if variable is not None:
        reader = reader.option("stateVarName", variable)
    with rocksdb_state(spark):
        return reader.load(checkpoint)
