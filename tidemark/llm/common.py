"""Helpers shared by the operators."""

from __future__ import annotations

import ctypes
import gc
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_run_dir, remove_dir

_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage: whatever is computed from the result reads the written
    files, also after an executor is lost.
    """
    path = f"{new_run_dir(df.sparkSession, label)}/table"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete the files of a ``saved`` frame that nothing will read again, such as those of the round before."""
    path = _FOLDERS.pop(df, None) if df is not None else None
    if path:
        remove_dir(df.sparkSession, path)


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def row_key(id_col: str, text_col: str) -> Column:
    """Tells rows apart that repeat an id with another text; rows that repeat both are copies of one row."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")),
                       F.xxhash64(text_or_empty(text_col)).cast("string"))


def freeing(run):
    """``run`` for mapInArrow; its task gives freed memory back to the system when it ends.

    Python workers live on from stage to stage, and the allocators of Arrow and C keep what was freed.
    """

    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
        if trim is not None:
            trim(0)

    return wrapped
