"""Versioned model artifacts, committed last.

``path/v<number>-<tag>/`` holds one saved model; its ``MANIFEST.json`` lists every
file with length and checksum, and the fingerprint of the training table. The
manifest is written under another name and renamed when all files are there, so
a version either is whole or does not count: a killed save leaves the version
before it in use, and two writers never meet in one folder. A version that lost
or changed a file, or was fitted on other rows, is not loaded.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "MANIFEST.json"
#: Committed versions that stay; older ones are deleted after a commit.
KEEP = 2


def fingerprint(training: DataFrame) -> str:
    """Digest of a table's columns and rows (repeated ones too), whatever their order: one aggregation of row hashes."""
    cols = [F.col(c) for c in training.columns]
    r = training.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("s"),
                     F.bit_xor(F.xxhash64(F.lit(1), *cols)).alias("x")).first()
    return sha256(json.dumps([training.dtypes, r["n"], str(r["s"]), r["x"]]).encode()).hexdigest()


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _files(spark: SparkSession, folder: str) -> dict[str, list]:
    """Relative path -> [length, sha256] of the data files below a version (checksums are taken by the cluster)."""
    root, fs = _fs(spark, folder)
    names, walk = [], fs.listFiles(root, True)
    while walk.hasNext():
        names.append(walk.next().getPath().toString())
    names = [n for n in names if n.rsplit("/", 1)[1] not in (MANIFEST, MANIFEST + ".new") and not n.endswith(".crc")]
    if not names:
        return {}
    base = fs.makeQualified(root).toString().rstrip("/") + "/"
    plain = lambda n: re.sub(r"^file:/+", "/", n)
    rows = spark.read.format("binaryFile").load(names).select("path", "length", F.sha2("content", 256).alias("sum")).collect()
    return {plain(r["path"]).removeprefix(plain(base)): [r["length"], r["sum"]] for r in rows}


def versions(spark: SparkSession, path: str) -> list[tuple[int, str, bool]]:
    """(number, folder, committed) of what is there, newest first."""
    root, fs = _fs(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        folder = status.getPath()
        m = re.fullmatch(r"v(\d+)-[0-9a-f]+", folder.getName())
        if m:
            manifest = _fs(spark, f"{folder.toString()}/{MANIFEST}")[0]
            found.append((int(m[1]), folder.toString(), fs.exists(manifest)))
    return sorted(found, reverse=True)


def publish(spark: SparkSession, path: str, model, save: Callable[[SparkSession, object, str], None], training_mark: str | None = None) -> str:
    """Save a model as a new version; returns its folder. Nothing that exists is touched before the commit."""
    number = max((v[0] for v in versions(spark, path)), default=0) + 1
    folder = f"{path.rstrip('/')}/v{number:06d}-{uuid.uuid4().hex}"
    save(spark, model, folder)
    manifest = {"files": _files(spark, folder), "training": training_mark}
    new, fs = _fs(spark, f"{folder}/{MANIFEST}.new")
    out = fs.create(new)
    out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    out.close()
    if not fs.rename(new, _fs(spark, f"{folder}/{MANIFEST}")[0]):
        raise OSError(f"the version could not be committed: {folder}")
    for _, old, _ in [v for v in versions(spark, path) if v[2]][KEEP:]:
        fs.delete(_fs(spark, old)[0], True)
    return folder


def _manifest(spark: SparkSession, folder: str) -> dict:
    return json.loads(spark.read.text(f"{folder}/{MANIFEST}", wholetext=True).first()[0])


def newest_whole(spark: SparkSession, path: str, training_mark: str | None = None) -> str | None:
    """Folder of the newest committed version whose files are as written and that was fitted on the marked table."""
    for _, folder, committed in versions(spark, path):
        if not committed:
            continue
        manifest = _manifest(spark, folder)
        if training_mark is not None and manifest["training"] != training_mark:
            continue
        if manifest["files"] == _files(spark, folder):
            return folder
    return None


def load_or_fit_version(spark: SparkSession, path: str, load: Callable[[SparkSession, str], object], fit: Callable[[], object],
                        save: Callable[[SparkSession, object, str], None], training: DataFrame | None = None):
    """The newest whole version fitted on the same training rows, else fit, publish and return the new one.

    Errors of ``load`` are raised: what a whole version holds must be readable.
    """
    mark = fingerprint(training) if training is not None else None
    folder = newest_whole(spark, path, mark)
    if folder is not None:
        return load(spark, folder)
    model = fit()
    publish(spark, path, model, save, mark)
    return model
