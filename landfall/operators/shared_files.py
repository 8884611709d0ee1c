"""Small files in a shared folder, through the file system Spark itself uses: listing, whole-file creation, claims."""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.sql import SparkSession


class RunClaimed(RuntimeError):
    """Another attempt holds the run."""


def quoted(name: str) -> str:
    return quote(name, safe="")


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what the folder holds; of a folder that is not there, none."""
    files, path = _at(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []


def create_file(spark: SparkSession, path: str, text: str = "") -> None:
    """The file appears whole: it is written beside its place and renamed."""
    files, target = _at(spark, path)
    folder = target.getParent()
    files.mkdirs(folder)
    draft = spark._jvm.org.apache.hadoop.fs.Path(folder, f".draft-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(text.encode())
    out.close()
    if not files.rename(draft, target):
        files.delete(draft, False)
        raise OSError(f"cannot create {path}")


def read_file(spark: SparkSession, path: str) -> str:
    files, target = _at(spark, path)
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    files, target = _at(spark, path)
    files.delete(target, True)


@contextmanager
def claimed(spark: SparkSession, location: str, run: str, hours: float) -> Iterator[None]:
    """Holds the run for one attempt, until it ends or ``hours`` have passed.

    A claim is a file that names when it expires. Whoever sees another live claim beside its own withdraws;
    as claims are written before they are looked for, no two attempts can both see none. Two that began at the same time try
    again after a random pause, one that meets a claim for the second time is refused.
    """
    folder, met = f"{location.rstrip('/')}/_claims/{quoted(run)}", set()
    while True:
        own = f"{int((time.time() + hours * 3600) * 1000)}-{uuid.uuid4().hex}"
        create_file(spark, f"{folder}/{own}")
        now = time.time() * 1000
        others = {n for n in names_in(spark, folder) if n != own and not n.startswith(".") and int(n.split("-")[0]) > now}
        if not others:
            break
        delete(spark, f"{folder}/{own}")
        if others & met:
            raise RunClaimed(f"run {run} is being landed by another attempt")
        met = others
        time.sleep(random.uniform(0.1, 0.6))
    try:
        yield
    finally:
        delete(spark, f"{folder}/{own}")
