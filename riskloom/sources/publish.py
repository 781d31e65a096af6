"""Publishing files and folders so that only one writer can be first.

What is written goes to a name of its own and gets its public name in one step, which fails if the
name is taken. That step is all that concurrent writers need to agree on. It needs a file system
that renames atomically (local or shared disks, HDFS); on object stores without it the store's own
table format has to take its place.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(where)


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _path(spark, path)
    return system.exists(where)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file, or a folder and all in it; False where there was none."""
    system, where = _path(spark, path)
    return system.delete(where, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    system, where = _path(spark, folder)
    return sorted(f.getPath().getName() for f in system.listStatus(where)) if system.exists(where) else []


def sizes(spark: SparkSession, folder: str) -> dict[str, int]:
    """Data files of a folder and their bytes; markers and checksums are left out."""
    system, where = _path(spark, folder)
    return {f.getPath().getName(): f.getLen() for f in system.listStatus(where) if f.getPath().getName()[0] not in "._"}


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _path(spark, path)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Rename unless the target is there, by the file system's own rule."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, target)[1].toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(_path(spark, source)[1], _path(spark, target)[1], none)
        return True
    except Exception as problem:
        if "FileAlreadyExists" in str(problem):
            return False
        raise


def published(spark: SparkSession, source: str, target: str) -> bool:
    """Give a finished file or folder its public name. False, and nothing changed, if another was first."""
    system, where = _path(spark, target)
    system.mkdirs(where.getParent())
    if where.toUri().getScheme() != "file":
        return _renamed(spark, source, target)
    # A local rename replaces files; a link and a folder that is not empty do not give way.
    old, new = _path(spark, source)[1].toUri().getPath(), where.toUri().getPath()
    try:
        if os.path.isdir(old):
            if os.path.exists(new):
                return False
            os.rename(old, new)
        else:
            os.link(old, new)
            system.delete(_path(spark, source)[1], False)
    except FileExistsError:
        return False
    except OSError:
        if os.path.isdir(new):
            return False
        raise
    return True


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """A small file with this content, unless there is one of that name."""
    system, draft = _path(spark, f"{path.rsplit('/', 1)[0]}/_drafts/{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    done = published(spark, draft.toString(), path)
    if not done:
        system.delete(draft, False)
    return done
