"""Reading, shared scratch tables and small helpers of the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's ``spark.checkpoint.dir``.

    Only a single-process session (``local[...]``, as in tests) may go without the setting and gets
    a temporary folder; any other session without it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="corpus-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


#: Folders, below the shared one, of the scopes that are open.
_scopes: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it back.

    The stored table outlives any executor, so later jobs never recompute what came before. Inside :func:`scratch` it is
    removed at the end of the scope.
    """
    return _stored(df, name, _scopes[-1] if _scopes else f"{shared_folder(df.sparkSession)}/corpus")


def _stored(df: DataFrame, name: str, folder: str) -> DataFrame:
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables written inside the scope go when it ends; the function given stores a table that stays."""
    outer = _scopes[-1] if _scopes else f"{shared_folder(spark)}/corpus"
    own = f"{outer}/scratch-{uuid.uuid4().hex}"
    _scopes.append(own)
    try:
        yield lambda df, name: _stored(df, name, outer)
    finally:
        _scopes.remove(own)
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(name: str, *frames: DataFrame) -> str:
    """``name`` with as many marks added as make it differ, in any case of letters, from all columns of ``frames``."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text (null: empty), so other columns and their names do not matter."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
