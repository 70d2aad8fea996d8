"""Lineage cuts and work folders that survive lost executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Only on one machine may it be unset: then a folder that goes with the process."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/tidemark-{name}-{uuid.uuid4().hex}"


#: Files of a thin table: for each core that the cluster offers, and at least one for so many shuffle partitions.
FILES_PER_CORE, PARTITIONS_PER_FILE = 4, 8


def stored(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """df written as Parquet in the shared folder and read back.

    Thin tables (keys, counts, hashes: some ten bytes a row, a fraction of the texts) go to few files, as a store is
    not served by many small ones: FILES_PER_CORE a core or an eighth of the session's shuffle partitions, which are
    set for the data's size, whichever is more. Wide tables, and those whose rows cost much to make, keep their
    partitions, so tasks do not grow with the input.
    """
    spark = df.sparkSession
    at = work_dir(spark, name)
    files = max(FILES_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_PER_FILE)
    out = df if wide else df.coalesce(files)
    out.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt evenly, or by keys, to the session's shuffle partitions, or to FILES_PER_CORE a core if that is more, for work that costs more than moving its rows.

    A file of one row group is one task whatever its size, and adaptive execution joins small partitions unless their number is given.
    """
    spark = df.sparkSession
    return df.repartition(max(FILES_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def remove_stored(spark: SparkSession) -> int:
    """Deletes all tidemark-* folders of the shared folder and returns their number; call it when results are written."""
    root = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    own = [x.getPath() for x in fs.listStatus(root) if x.getPath().getName().startswith("tidemark-")]
    for path in own:
        fs.delete(path, True)
    return len(own)
