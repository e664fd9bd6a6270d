"""Small pieces shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import re
import sys

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from geonet.session import settle

WORD = r"[^\x20\x09-\x0D]+"
#: The same class as a literal in Spark SQL text.
WORD_SQL = r"'[^\\x20\\x09-\\x0D]+'"
WORD_RE = re.compile(WORD)
#: Texts that a Python worker gets at once.
TEXT_ROWS = 2_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Text that names a row: its id, or its content where the id is null.  Equal rows share it."""
    return F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text), F.lit("")))))


def content_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Text that names a row by its id and content together; null and empty texts count as equal."""
    body = F.md5(F.coalesce(F.col(text), F.lit("")))
    return F.concat(F.coalesce(F.concat(F.lit("id:"), F.col(doc_id).cast("string")), F.lit("text")), F.lit(":"), body)


def few_at_once(docs: DataFrame) -> DataFrame:
    """Lower the session's rows per Arrow batch to TEXT_ROWS, if it is higher, before texts go to Python workers.

    Texts are long, and a worker holds a batch of them several times over.
    """
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= TEXT_ROWS:
        conf.set(name, str(TEXT_ROWS))
    return docs


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back."""
    return settle(df, name)


def give_back() -> None:
    """Freed memory of the worker goes back to the system."""
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def worker_store(name: str) -> dict:
    """A dict that lives on in the Python worker from task to task, until an operator asks for another one.

    The memory of the one before goes back to the system, so that stages do not add up in a worker.
    """
    stores = vars(sys.modules[sys.__name__]).setdefault("_geonet_llm", {})
    if name not in stores:
        stores.clear()
        stores[name] = {}
        gc.collect()
        give_back()
    return stores[name]
