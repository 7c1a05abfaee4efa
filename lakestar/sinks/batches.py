"""Tables that grow by whole batches."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Fixed value: the mark that Spark leaves in a folder when a write is whole.
WHOLE = "_SUCCESS"


def batches(spark: SparkSession, path: str) -> tuple[list[str], str]:
    """Folders of the whole batches in order, and that of the next one.

    A batch that a broken run left without its mark doesn't count; the next one overwrites it.
    """
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    whole: list[str] = []
    while files.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/batch-{len(whole):06d}/{WHOLE}")):
        whole.append(f"{path}/batch-{len(whole):06d}")
    return whole, f"{path}/batch-{len(whole):06d}"
