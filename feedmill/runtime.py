"""Sessions, tables and shared scratch space.

Lineage is cut by writing a Parquet table below ``spark.checkpoint.dir``, the
folder that driver and executors share.  Only when that setting is absent and
the master is local (tests, laptops) is a temporary folder used instead.

Python workers outlive the tasks and stages that they serve, with the memory that these leave.
Functions for Arrow batches are passed through :func:`tidied`, which gives it back.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_ROOT: list[str] = []
_WRITTEN: dict[str, SparkSession] = {}
#: What empties a cache that a worker keeps between the tasks of one stage.
FORGET: list[Callable[[], None]] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="feedmill-"))
    return f"file://{_LOCAL_ROOT[0]}"


def new_path(spark: SparkSession) -> str:
    """A fresh folder below the shared root, removed when the driver ends."""
    path = f"{scratch_root(spark)}/feedmill-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_sweep)
    _WRITTEN[path] = spark
    return path


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    _WRITTEN.pop(path, None)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def settled(df: DataFrame, made: list[str]) -> DataFrame:
    """The same columns, with ``made`` behind a generator of one row.

    The optimizer puts expressions in place of the names of columns that later projections
    read, once for each reading; it does not move them over a generator.
    """
    rest = [c for c in df.columns if c not in made]
    kept = df.select(*rest, F.explode(F.array(F.struct(*made))).alias("_settled"))
    return kept.select(*[F.col(c) if c in rest else F.col(f"_settled.{c}").alias(c) for c in df.columns])


def give_back() -> None:
    """Return free memory of this process to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidied(run: Callable[[Iterator], Iterator], keep: bool = False) -> Callable[[Iterator], Iterator]:
    """``run``, a function of an iterator of batches, that leaves no memory behind in its worker.

    What a worker keeps for the tasks of another stage goes first, unless ``keep`` says that this is that stage.
    """

    @functools.wraps(run)
    def tidy(batches: Iterator) -> Iterator:
        if not keep:
            for forget in FORGET:
                forget()
        give_back()
        yield from run(batches)
        give_back()

    return tidy


def discard(df: DataFrame) -> None:
    """Delete the table behind a frame made by :func:`cut`."""
    path = getattr(df, "_scratch_path", None)
    if path:
        delete(df.sparkSession, path)


def _sweep() -> None:
    for path, spark in list(_WRITTEN.items()):
        try:
            delete(spark, path)
        except Exception:  # the session is gone; the folder belongs to the cluster's own cleaner
            break
    if _LOCAL_ROOT:
        import shutil

        shutil.rmtree(_LOCAL_ROOT[0], ignore_errors=True)
