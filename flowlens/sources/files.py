"""File selection and header peeking for the CSV datasets.

Listing goes through Spark's ``binaryFile`` source with only the ``path``
column selected, so it works on any Hadoop file system, never reads file
contents and gives fully qualified paths. Header lines are read by tasks, one
job for all files, each reading a file's first line only. What reaches the
driver is what planning the read needs: file names and header lines.

Tasks open single files through ``pyarrow.fs`` (local, HDFS, S3, GCS and
Azure paths); a path without a scheme is qualified by Spark's listing first.
"""

from __future__ import annotations

import io
import posixpath
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# tasks run functions of this module; they travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def file_system(path: str):
    """(file system, path in it) of a qualified path."""
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def open_input(path: str) -> io.BufferedReader:
    """A seekable binary reader of one file; nothing is loaded ahead."""
    system, where = file_system(path)
    return io.BufferedReader(system.open_input_file(where))


def open_output(path: str):
    """A binary writer of one file, whose folder is made if need be."""
    system, where = file_system(path)
    system.create_dir(posixpath.dirname(where), recursive=True)
    return system.open_output_stream(where)


def text_bytes(texts: pa.Array) -> memoryview:
    """All texts of an Arrow string array one after another, as UTF-8: a part of its own buffer."""
    if not len(texts):
        return memoryview(b"")
    offsets = memoryview(texts.buffers()[1]).cast("q" if pa.types.is_large_string(texts.type) else "i")
    return memoryview(texts.buffers()[2])[offsets[texts.offset]:offsets[texts.offset + len(texts)]]


def list_files(spark: SparkSession, directory: str, exts=(".csv", ".zip"),
               name_contains: str | None = None) -> list[str]:
    """Files directly in ``directory`` whose lower-cased name ends with one
    of ``exts`` (and contains ``name_contains``), sorted; [] if it is missing."""
    try:
        rows = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "false")
            .load(directory)
            .select("path")
            .collect()
        )
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return []
        raise
    out = []
    for r in rows:
        p = r["path"]
        name = posixpath.basename(p)
        if not name.lower().endswith(tuple(exts)):
            continue
        if name_contains and name_contains not in name:
            continue
        out.append(p)
    return sorted(out)


def _first_line(batches):
    for batch in batches:
        lines = []
        for path in batch.column(0).to_pylist():
            with open_input(path) as fh:
                lines.append(fh.readline().decode("utf-8", errors="replace").rstrip("\r\n"))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string())], names=["path", "line"])


def first_lines(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """The whole first line of each file (empty string for an empty file)."""
    if not files:
        return {}
    paths = spark.createDataFrame([(f,) for f in files], "path string").repartition(len(files), "path")
    return {r.path: r.line for r in paths.mapInArrow(_first_line, "path string, line string").collect()}


def group_by_first_line(spark: SparkSession, files: list[str], key=lambda line: line) -> dict:
    """Files grouped by ``key`` of their first line, each group in file order."""
    groups: dict = {}
    heads = first_lines(spark, files)
    for f in files:
        groups.setdefault(key(heads[f]), []).append(f)
    return groups


def qualified(spark: SparkSession, files: list[str]) -> list[str]:
    """``files`` as Spark's file system names them, sorted."""
    if not files:
        return []
    return sorted(r.path for r in spark.read.format("binaryFile").load(list(files)).select("path").collect())


# Dataset folders under the data root.
CICIDS_DIR = "CIC-IDS-2017"
UNSW_DIR = "UNSW-NB15"
UNSW_NAME = "UNSW-NB15_"
CICDOS_DIRS = ("CIC-DDoS2019/01-12", "CIC-DDoS2019/03-11")


def sort_dataset_files(paths: list[str]) -> dict[str, list[str]]:
    """S4 over known paths: the dataset files directly in the datasets' folders."""
    out: dict[str, list[str]] = {"cicids": [], "unsw": [], "cicdos": []}
    for p in sorted(paths):
        folder, name = posixpath.split(p)
        own = name.lower()
        if folder.endswith(f"/{CICIDS_DIR}") and own.endswith((".csv", ".zip")):
            out["cicids"].append(p)
        elif folder.endswith(f"/{UNSW_DIR}") and own.endswith(".csv") and UNSW_NAME in name:
            out["unsw"].append(p)
        elif folder.endswith(tuple(f"/{d}" for d in CICDOS_DIRS)) and own.endswith(".csv"):
            out["cicdos"].append(p)
    return out


def dataset_files(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The files of each dataset under ``root``."""
    root = root.rstrip("/")
    cicdos = []
    for d in CICDOS_DIRS:
        cicdos += list_files(spark, f"{root}/{d}", (".csv",))
    return {
        "cicids": list_files(spark, f"{root}/{CICIDS_DIR}", (".csv", ".zip")),
        "unsw": list_files(spark, f"{root}/{UNSW_DIR}", (".csv",), name_contains=UNSW_NAME),
        "cicdos": cicdos,
    }
