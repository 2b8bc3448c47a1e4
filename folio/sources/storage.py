"""Path questions answered by the Hadoop file system of the path itself.

A path without a scheme belongs to the cluster's default file system, not to the driver's
disk. Only "there is no such path" means absent; every other error is raised. Small metadata
files are read and written here without a Spark job.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

HEADER_THREADS = 16


def _conf(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(_conf(spark)), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return bool(fs.exists(target))


def has_match(spark: SparkSession, pattern: str) -> bool:
    """Whether any file or folder matches a glob."""
    fs, target = _resolve(spark, pattern)
    return bool(fs.globStatus(target))


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist. For metadata folders, never for data."""
    fs, target = _resolve(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Size of all files below a folder, from the file system's own summary; 0 if it does not exist."""
    fs, target = _resolve(spark, folder)
    return int(fs.getContentSummary(target).getLength()) if fs.exists(target) else 0


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that appears whole or not at all; False if another writer was first.

    It is written under a hidden name and renamed; the rename refuses an existing target.
    """
    jvm, conf = spark._jvm, _conf(spark)
    fs, target = _resolve(spark, path)
    if fs.exists(target):
        return False
    fs.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    refuse = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), conf)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), refuse)
        return True
    except Py4JJavaError as failed:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(failed.java_exception):
            return False
        raise


def remove(spark: SparkSession, path: str) -> None:
    """Delete one metadata file; an absent one is fine."""
    fs, target = _resolve(spark, path)
    fs.delete(target, False)


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str | None]:
    """The first line of each file, None for an empty one; only the first block of a file is touched.

    For the files of one micro-batch, whose number is bounded; compressed files are read through their codec.
    """
    jvm, conf = spark._jvm, _conf(spark)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def head(path: str) -> str | None:
        target = jvm.org.apache.hadoop.fs.Path(path)
        stream = target.getFileSystem(conf).open(target)
        try:
            codec = codecs.getCodec(target)
            plain = codec.createInputStream(stream) if codec is not None else stream
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
        finally:
            stream.close()
        return line.removeprefix("﻿") if line is not None else None

    with ThreadPoolExecutor(max_workers=HEADER_THREADS) as pool:
        return dict(zip(paths, pool.map(head, paths), strict=True))
