"""Small files and folder names on a shared file system: written whole, claimed once."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class NameTaken(FileExistsError):
    """Another writer was first."""


def hadoop(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(p), fs


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = hadoop(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def move(spark: SparkSession, src: str, dst: str, over: bool = False) -> None:
    """Rename a file or folder in one step. ``over``: in place of a file that is there; otherwise an existing name raises ``NameTaken``.

    The file context's rename is used: the plain one moves a folder *into* one that has appeared meanwhile, and may need the old
    file to be deleted first, so that a crash leaves none.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    a, _ = hadoop(spark, src)
    b, _ = hadoop(spark, dst)
    kind = getattr(fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE if over else kind.NONE
    context = fs.FileContext.getFileContext(b.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    try:
        context.rename(a, b, how)
    except Exception as e:
        if not over and "FileAlreadyExistsException" in str(e):
            raise NameTaken(dst) from None
        raise


def write(spark: SparkSession, path: str, text: str, over: bool = True) -> None:
    """A small file, seen whole or not at all: written under another name, then renamed. Without ``over`` an existing one raises ``NameTaken``."""
    head, _, name = path.rpartition("/")
    temp = f"{head}/.{name}-{uuid.uuid4().hex}.tmp"
    p, fs = hadoop(spark, temp)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        move(spark, temp, path, over)
    except BaseException:
        fs.delete(p, False)
        raise
