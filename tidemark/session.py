"""Where intermediate tables go, and how they get there."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir` of the session.

    Only where the setting is absent (local tests) a temporary folder is made and set.
    """
    place = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        place = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes what `written` wrote inside, but for tables it was told to keep.

    Only for steps whose result no longer reads the rest.
    """
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            fs, at = hadoop_fs(spark, path)
            fs.delete(at, True)
        give_back(spark)


def give_back(spark: SparkSession) -> None:
    """Lets plans that nothing refers to any more give their shuffle files and broadcasts back."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, name: str = "cut", keep: bool = False) -> DataFrame:
    """df, written as Parquet in the shared folder and read again.

    Cuts the lineage: a lost executor costs no more than a new read, and no branch that
    uses the result computes it twice.
    """
    path = fresh_dir(df.sparkSession, name)
    if _scratch and not keep:
        _scratch[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, table: DataFrame) -> None:
    """Removes the files of a table from `written` that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        fs, at = hadoop_fs(spark, path)
        fs.delete(at, True)


def hadoop_fs(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop has them."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the Python workers this package, once per application, wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
