"""A run's folder on shared storage: what each stage left, and a manifest.

A stage writes into a folder of its own under ``_pending``. When it is done
the folder is renamed to ``<stage>-<fingerprint>``, and a record (stage,
fingerprint, folder, facts, seconds) is renamed into ``manifest``. A record
is there or not, never half; a stage without one has not happened. The
fingerprint covers the run's input version, the stage's settings and the
fingerprints before it, so a run that is started again after a lost driver,
or with one setting changed, takes up exactly the stages that still hold.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventana.functions.exprs import col
from ventana.sources.io import path_exists


def fingerprint(*parts: object) -> str:
    return sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:16]


def frame_version(df: DataFrame) -> str:
    """A fingerprint of a frame's rows whatever their order; one scan."""
    h = F.xxhash64(*[col(c) for c in df.columns])
    r = df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first()
    return fingerprint(df.dtypes, *r)


def path_version(spark: SparkSession, path: str) -> str:
    """A fingerprint of a file's or folder's files by name, size and time; nothing is read."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, files = fs.listFiles(p, True), []
    while found.hasNext():
        f = found.next()
        files.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return fingerprint(sorted(files))


class RunStore:
    """The folder of one run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.path}/manifest"))
        self.done: list[str] = []     # stages that ran, not those taken up

    def record(self, stage: str) -> dict | None:
        """What is known of a finished stage."""
        file = f"{self.path}/manifest/{stage}.json"
        if not path_exists(self.spark, file):
            return None
        return json.loads("\n".join(r.value for r in self.spark.read.text(file).collect()))

    def write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def _move(self, source: str, target: str) -> None:
        if self._fs.exists(self._path(target)):  # of an attempt that got no record, or of another fingerprint
            self._fs.delete(self._path(target), True)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} could not be renamed to {target}")

    def stage(self, name: str, print_: str, make: Callable[[str], dict | None]) -> dict:
        """The record of stage ``name``: the one that is there, if its
        fingerprint is ``print_`` and its facts name no ``error``, else that of ``make(folder)``, which writes
        into the folder what it wants kept and returns facts."""
        old = self.record(name)
        if old and old["fingerprint"] == print_ and "error" not in old["facts"]:
            return old
        pending, final = f"{self.path}/_pending/{name}-{uuid.uuid4().hex[:12]}", f"{self.path}/{name}-{print_}"
        begin = time.time()
        facts = make(pending) or {}
        if self._fs.exists(self._path(pending)):
            self._move(pending, final)
        record = {"stage": name, "fingerprint": print_, "folder": final, "facts": facts, "seconds": round(time.time() - begin, 3)}
        note = f"{self.path}/_pending/{name}-{uuid.uuid4().hex[:12]}.json"
        self.write_text(note, json.dumps(record, default=float))
        self._move(note, f"{self.path}/manifest/{name}.json")
        self.done.append(name)
        return record

    def records(self) -> list[dict]:
        found = self._fs.listStatus(self._path(f"{self.path}/manifest"))
        names = sorted(s.getPath().getName()[:-5] for s in found if s.getPath().getName().endswith(".json"))
        return [self.record(n) for n in names]
