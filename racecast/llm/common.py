"""Reading tables, intermediate tables in the shared folder, and Arrow columns as numpy arrays."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 2_000_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Files of shuffles go with the query that made them, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Scratch:
    """Intermediate tables in a folder of ``spark.checkpoint.dir``, which all nodes share.

    Where that setting is unset (tests on one machine) the context's own checkpoint folder or a new
    temporary folder is taken. ``let_go`` deletes tables that nothing reads any more, ``close`` all that was written.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if base is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
            base = tempfile.mkdtemp(prefix="llm-")
        self.path = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
        self.kept: list[tuple[DataFrame, str]] = []

    def new(self) -> str:
        return f"{self.path}/{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, plain: tuple[str, ...] = ()) -> DataFrame:
        """``df`` computed once: written, and read back; its shuffles go. No dictionary is tried for columns ``plain``."""
        path = self.new()
        with shuffles_end(self.spark):
            df.write.options(**{f"parquet.enable.dictionary#{c}": "false" for c in plain}).parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.kept.append((table, path))
        return table

    def let_go(self, *tables: DataFrame) -> None:
        """Delete tables that ``keep`` gave; nothing may read them afterwards."""
        for path in [path for table, path in self.kept if any(table is x for x in tables)]:
            self.drop(path)
        self.kept = [(table, path) for table, path in self.kept if not any(table is x for x in tables)]

    def drop(self, path: str) -> None:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def close(self) -> None:
        self.kept = []
        self.drop(self.path)


def one_chunk(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def string_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values, UTF-8 of text, and where each starts (one more entry than values); NULL is empty."""
    column = one_chunk(column)
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    elif pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    n, at = len(column), column.offset
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1 + at)[at:] if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole values that hold about ``limit`` bytes each, or one value that is longer."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def text_column(batch: pa.RecordBatch | pa.Table, name: str) -> list[str]:
    return [t or "" for t in batch.column(name).to_pylist()]


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the workers this package, as ``--py-files`` would, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    where = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(where, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(where))
    _shipped.add(context.applicationId)


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Place of a public vocabulary file, in ``folder`` or where it is installed on every node."""
    if folder is not None:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``text`` compressed as ``_packed``, which makes shuffles of it smaller; NULL stays NULL."""
    names = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            data, edges = string_bytes(batch.column(text))
            own, nulls = memoryview(data), batch.column(text).is_null().to_pylist()
            values = (None if null else pack(own[a:b]) for null, a, b in zip(nulls, edges.tolist(), edges[1:].tolist()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(values, pa.binary())], [*names, "_packed"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text)
    return df.mapInArrow(run, (f"{schema}, " if schema else "") + "_packed binary")


def unpack(column: pa.Array) -> list[str]:
    back = zstandard.ZstdDecompressor().decompress
    return ["" if b is None else back(b).decode() for b in column.to_pylist()]
