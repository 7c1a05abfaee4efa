"""Session set-up and the shared folder in which long lineages are cut."""

from __future__ import annotations

import io
import tempfile
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(
    app_name: str = "lakestar", zone: str = "UTC", delta: bool = False, **conf: str
) -> SparkSession:
    """A session with adaptive execution; ``conf`` keys use ``__`` for dots.

    ``delta=True`` registers the Delta extension and needs its jars on the class path.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", zone)
    )
    if delta:
        builder = builder.config(
            "spark.sql.extensions", "io.delta.sql.DeltaSparkSessionExtension"
        ).config(
            "spark.sql.catalog.spark_catalog", "org.apache.spark.sql.delta.catalog.DeltaCatalog"
        )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without one gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="lakestar-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/lakestar-{label}-{uuid4().hex}"


# Spark's options for the shuffle files of a finished execution and for the codec of Parquet files.
_CLEANUP, _CODEC = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.parquet.compression.codec"
#: Codec of tables for which neither their options nor the session name one: hash keys in hex take half of their length.
CODEC = "zstd"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Deletes the shuffle files of each execution inside when it ends, as nothing reads them once its result is
    stored or collected. Spark would keep them until the driver's memory is swept, beside those of later steps.

    A frame that is collected has to be made inside, as it remembers the option as it was then. Spark before 4.1 does not know the option, and keeps them as ever.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def parquet_options(spark: SparkSession, options: Mapping[str, str] | None = None) -> dict[str, str]:
    """``options`` with a codec, if neither they nor the session name one."""
    options = dict(options or {})
    named = spark.conf.get(_CODEC, None) or {k.lower() for k in options} & {"compression", "parquet.compression"}
    return options if named else {"compression": CODEC, **options}


def drop_table(spark: SparkSession, path: str) -> None:
    """Removes a scratch table; for those that no frame reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@dataclass(frozen=True)
class Stored:
    """A frame that was written to the shared folder, with the rows and bytes seen on the way."""

    df: DataFrame
    rows: int
    size_bytes: int
    path: str = ""

    def drop(self) -> None:
        """Removes the table; for those that no returned frame reads."""
        drop_table(self.df.sparkSession, self.path)


def row_width(df: DataFrame) -> Column:
    """Bytes of a row in memory, on the safe side."""
    width = F.lit(32)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + F.lit(16)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(field.name)), F.lit(0)) + F.lit(64)
        else:
            width = width + F.lit(16)
    return width


def store(df: DataFrame, label: str, measured: Sequence[str] | None = None) -> Stored:
    """Write ``df`` to the shared folder, read it back, and tell how much it was.

    The result survives the loss of executors, is computed once however often it is used, and its
    file sizes give the optimizer real statistics. Rows and bytes are observed during the write, so
    they cost no job of their own; the bytes are those of the ``measured`` columns, by default all.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(row_width(df.select(*(measured or df.columns)))).alias("bytes"))
    with shuffles_released(spark):
        observed.write.options(**parquet_options(spark)).parquet(path)
    return Stored(spark.read.schema(df.schema).parquet(path), seen.get["rows"], seen.get["bytes"] or 0, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """:func:`store` without the figures."""
    path = scratch_path(df.sparkSession, label)
    with shuffles_released(df.sparkSession):
        df.write.options(**parquet_options(df.sparkSession)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives executors this package, once per application, as an archive in the shared folder.

    Functions that run in tasks are sent by name, so workers have to find their modules: they may run
    where the repository isn't.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for module in sorted(package.rglob("*.py")):
            archive.write(module, module.relative_to(package.parent))
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'code')}.zip")
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    out.write(packed.getvalue())
    out.close()
    spark.sparkContext.addPyFile(place.toString())
    _shipped.add(application)
