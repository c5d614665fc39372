"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "billrisk", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_COMPILED_BYTES = 8000  # the JVM interprets longer methods for good


def compiled_methods(spark: SparkSession) -> None:
    """Have Spark generate several methods in place of one that the JVM would never compile.

    Steps over dozens of columns or conditions exceed what the JVM compiles,
    and run several times slower then; Spark's own limit is that of the class
    file.  A lower limit that the session already has is kept.
    """
    if int(spark.conf.get(_METHOD_LIMIT)) > _COMPILED_BYTES:
        spark.conf.set(_METHOD_LIMIT, str(_COMPILED_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read, as named by ``spark.checkpoint.dir``.

    Only a purely local session may fall back to a temporary folder: on a
    cluster such a folder would exist on one machine only.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="billrisk-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Scratch:
    """Owns the tables and checkpoints written while it is open.

    ``free`` deletes one as soon as nothing will read it any more, ``close``
    all that are left.  Frames that read them are of no use afterwards.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: set[str] = set()

    def delete(self, path: str) -> None:
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        self.paths.discard(path)

    def keep(self, df: DataFrame) -> DataFrame:
        """Hand the table of ``df`` over to the scope around this one, if there is one."""
        path = getattr(df, "_scratch_path", None)
        if path in self.paths:
            self.paths.discard(path)
            around = _open[:_open.index(self)]
            if around:
                around[-1].paths.add(path)
        return df

    def close(self) -> None:
        for path in sorted(self.paths):
            self.delete(path)


def tidy(spark: SparkSession) -> None:
    """Let go of the shuffle files of steps that no frame refers to any more.

    Spark removes them once the driver's collector has seen that they are
    unreachable, which on a quiet driver can take longer than a whole job.
    """
    gc.collect()
    spark._jvm.System.gc()


_open: list[Scratch] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Whatever is written inside is deleted at the end; results have to be read, or written elsewhere, before."""
    scope = Scratch(spark)
    _open.append(scope)
    try:
        yield scope
    finally:
        _open.remove(scope)
        scope.close()


def _owned(spark: SparkSession, path: str) -> str:
    if _open:
        _open[-1].paths.add(path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path inside the shared folder that no other run uses; an open ``scratch`` owns it."""
    return _owned(spark, f"{shared_dir(spark)}/billrisk/{label}-{uuid.uuid4().hex}")


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder (compact, for wide rows)."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def checkpoint_dir(spark: SparkSession) -> None:
    """Have the shared folder take checkpoints."""
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint.

    Needed wherever two later steps must see the very same row placement.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    out = df.checkpoint(eager=True)
    file = out._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        out._scratch_path = _owned(spark, file.get())
    return out


def free(*frames: DataFrame) -> None:
    """Delete what ``written`` or ``materialize`` wrote for these frames; others are left alone.

    Only for frames that no later step reads, not even to compute a lost part anew.
    """
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path is not None:
            Scratch(df.sparkSession).delete(path)
            for scope in _open:
                scope.paths.discard(path)
