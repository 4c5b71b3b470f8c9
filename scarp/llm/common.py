"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scarp.session import checkpoint_root

# texts are handled in groups of about this many characters, which bounds a task's memory
GROUP_CHARS = 2_000_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, but as compressed Parquet whose columns can be pruned;
    the files are on shared storage, so they outlive any executor. The shuffle files of the write are
    removed when it is done (nothing reads them again), not when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table of :func:`scratch_table` that nothing reads any more (its readers have been written themselves)."""
    spark = table.sparkSession
    files = table.inputFiles()
    if not files:                                            # an empty table: nothing to free
        return
    folder = files[0].rsplit("/", 1)[0]
    if "/llm/" not in folder:
        raise ValueError("only scratch tables are deleted")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; any other column is ignored."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its columns are called (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_groups(batch: pa.RecordBatch, column: str = "text", chars: int = GROUP_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(offset, texts) runs of a batch holding about ``chars`` characters each; null reads as empty."""
    group: list[str] = []
    size = start = 0
    for k, value in enumerate(batch.column(column)):
        text = value.as_py() or ""
        group.append(text)
        size += len(text)
        if size >= chars:
            yield start, group
            group, size, start = [], 0, k + 1
    if group:
        yield start, group


def map_texts(df: DataFrame, make: Callable[[], Callable[[list[str]], Iterable[pa.Array]]], schema: str,
              column: str = "text") -> DataFrame:
    """Add columns computed from one text column, group by group, in Arrow batches.

    ``make()`` runs once per task and returns a function from a list of texts to the new columns as Arrow
    arrays, in the order of ``schema``. All other columns pass through untouched (nulls and types kept).
    """
    keep = [c for c in df.columns if c != column]
    out_schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != column] + [schema])
    names = keep + [part.split()[0].strip("`") for part in _top_level(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at, texts in text_groups(batch, column):
                rest = [batch.column(c).slice(at, len(texts)) for c in keep]
                yield pa.RecordBatch.from_arrays(rest + list(work(texts)), names=names)

    return df.mapInArrow(run, out_schema)


def _top_level(schema: str) -> list[str]:
    """Split a DDL schema at the commas outside angle brackets."""
    parts, depth, last = [], 0, 0
    for k, ch in enumerate(schema):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            parts.append(schema[last:k].strip())
            last = k + 1
    return parts + [schema[last:].strip()]
