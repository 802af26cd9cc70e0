"""Session-level helpers: the shared scratch folder, written stage tables and file moves."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import Future
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        v = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - missing key raises on some versions
        v = None
    if not v:
        try:
            v = spark.sparkContext.getConf().get(key, None)
        except Exception:  # noqa: BLE001 - no SparkContext (Connect)
            v = None
    return v or None


def _is_local(spark: SparkSession) -> bool:
    return (_conf(spark, "spark.master") or "").split("[")[0] == "local"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Unset, it is an error on a cluster: executors would each write to their own
    disk. Only a single-JVM session (tests) gets a folder of its own.
    """
    root = _conf(spark, "spark.checkpoint.dir")
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001
            root = None
    if not root:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="cellar-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/cellar/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def configured(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Session settings (dots written as ``__``) for the time of a block."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def beside(spark: SparkSession, work: Callable[[], T]) -> Future[T]:
    """Run ``work`` in a thread of its own, with the caller's job group and tags."""
    from pyspark import inheritable_thread_target

    done: Future[T] = Future()

    def run() -> None:
        try:
            done.set_result(work())
        except BaseException as e:  # noqa: BLE001 - handed to whoever asks for the result
            done.set_exception(e)

    threading.Thread(target=inheritable_thread_target(spark)(run), daemon=True).start()
    return done


def write_stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder; the table read back, and its
    path for ``delete_path`` once no plan reads it any more."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


# ---- files, through the file system that owns the path -------------------------


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p  # noqa: SLF001


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a glob pattern meets."""
    fs, p = _file_system(spark, pattern)
    return [str(s.getPath()) for s in fs.globStatus(p) or []]


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _file_system(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):  # noqa: SLF001
        raise OSError(f"could not rename {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one go."""
    write_bytes(spark, path, text.encode("utf-8"))


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file in one go."""
    fs, p = _file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    fs, p = _file_system(spark, path)
    source = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode("utf-8")  # noqa: SLF001
    finally:
        source.close()


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, p = _file_system(spark, path)
    return int(fs.getContentSummary(p).getLength())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it is not there."""
    fs, p = _file_system(spark, path)
    return [str(s.getPath().getName()) for s in fs.listStatus(p)] if fs.exists(p) else []
