"""Intermediate tables in the shared folder, and small schema helpers.

Column names that begin with `__llm_` are reserved for the operators' own use.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; a scratch folder only for local masters."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = _scratch()
    return folder


@lru_cache(maxsize=1)
def _scratch() -> str:
    return tempfile.mkdtemp(prefix="llm-shared-")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = f"{tempfile.mkdtemp(prefix='package-')}/{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: later stages reread the table instead of recomputing, also
    after an executor is lost. The tables stay until the folder is cleaned.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of at most BATCH_BYTES go to Python, in all that is run inside.

    Of rows with whole texts, a batch of Spark's own size takes some hundred MB in the JVM and in Python, for every task.
    """
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(limit, before)


def doc_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the whole text, null text as empty; any further columns stay out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
