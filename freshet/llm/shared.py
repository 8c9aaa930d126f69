"""What several operators need: tables, the shared folder, words as hashes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession

#: Words are runs of characters other than space, tab, line feed, vertical tab,
#: form feed and carriage return.
WORD = "[^\\x20\\x09-\\x0D]"
WORD_GAP = "[\\x20\\x09-\\x0D]+"


#: Rows of a batch between the JVM and Python.
BATCH_ROWS = 1000


def ship_package(spark: SparkSession) -> None:
    """Hands this package to the session's Python workers, once a session, for
    workers that do not have it on their path."""
    # Small batches: a worker and its JVM hold a few megabytes of text, not tens.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if any(f.startswith("freshet-package") for f in context._python_includes):
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="freshet-")
    archive = f"{folder}/freshet-package-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, Path(root.name) / path.relative_to(root))
    context.addPyFile(archive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir, which all executors share.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set")
        root = tempfile.mkdtemp(prefix="freshet-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/freshet-llm-{uuid.uuid4().hex}"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front of those that df already has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: computed once, lineage cut."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables of up to so many narrow rows are laid in one partition.
SMALL_ROWS = 200_000


def laid(table: DataFrame) -> DataFrame:
    """A written table of a few numbers a row; counted, and in one partition if it
    is small, so that joins and sums of it need no shuffle. This is what adaptive
    execution makes of it after a shuffle; a larger table stays spread."""
    return table.coalesce(1) if table.count() <= SMALL_ROWS else table


def flat_bytes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of the texts end to end, and where each begins (n + 1 offsets).

    Lone surrogates, which no valid column holds, become question marks.
    """
    parts = [(t or "").encode("utf-8", "replace") for t in texts]
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=at[1:])
    return np.frombuffer(b"".join(parts), np.uint8), at


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser of 64-bit hashes: every bit of x reaches every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(batches, most_bytes: int = 1 << 20):
    """Record batches in slices of about so many bytes, one row at least.

    Keeps the memory of a Python worker bounded by the longest single row.
    """
    for batch in batches:
        start, n = 0, batch.num_rows
        if not n:
            continue
        step = max(1, int(n * most_bytes / max(1, batch.nbytes)))
        while start < n:
            part = batch.slice(start, step)
            while part.num_rows > 1 and part.nbytes > 2 * most_bytes:
                part = part.slice(0, max(1, part.num_rows // 2))
            yield part
            start += part.num_rows
