"""Members of ZIP and TAR archives as rows, with unsafe names and links refused."""

from __future__ import annotations

import io
import posixpath
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

MEMBERS = "archive string, path string, content binary"


def safe_name(name: str) -> str:
    """A relative path without leading dots; one that leaves its folder is an error."""
    clean = posixpath.normpath(name.replace("\\", "/"))
    if clean.startswith(("/", "../")) or clean in ("..", ".") or ":" in clean.split("/")[0]:
        raise ValueError(f"unsafe member name: {name}")
    return clean


def members(raw: bytes, nested: bool = True) -> Iterator[tuple[str, bytes]]:
    """(path, content) of the regular files of an archive; resource forks are skipped, inner ZIPs expanded."""
    if zipfile.is_zipfile(io.BytesIO(raw)):
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            for info in z.infolist():
                name = safe_name(info.filename) if not info.is_dir() else ""
                if info.external_attr >> 28 == 0xA:
                    raise ValueError(f"link in archive: {info.filename}")
                if not name or name.startswith("__MACOSX/") or posixpath.basename(name).startswith("._"):
                    continue
                content = z.read(info)
                if nested and name.lower().endswith(".zip"):
                    yield from ((f"{name[:-4]}/{inner}", x) for inner, x in members(content, nested))
                else:
                    yield name, content
        return
    with tarfile.open(fileobj=io.BytesIO(raw)) as t:
        for info in t:
            if info.issym() or info.islnk():
                raise ValueError(f"link in archive: {info.name}")
            if info.isfile() and not posixpath.basename(info.name).startswith("._"):
                yield safe_name(info.name), t.extractfile(info).read()


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every member of the archives below a folder; an unsafe archive fails the job."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{zip,tar,gz,tgz}").load(folder).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in batch.itertuples(index=False):
                for name, inner in members(bytes(content)):
                    yield pd.DataFrame({"archive": [path], "path": [name], "content": [inner]})

    return files.mapInPandas(run, MEMBERS)
