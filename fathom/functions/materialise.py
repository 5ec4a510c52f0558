"""Results of a step in the shared folder, so that loops neither repeat work nor grow their plan."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` below ``spark.checkpoint.dir`` and cut its lineage.

    A local session without that setting gets a temporary folder; any other must name one,
    as its executors share no local folder.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="fathom-checkpoint-"))
    return df.checkpoint(eager=True)


def dropped(df: DataFrame) -> None:
    """Delete what ``cut`` has written for ``df``, which nothing may read any more."""
    spark = df.sparkSession
    file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file.get())
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
