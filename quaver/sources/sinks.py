"""Sinks: content-addressed views, JSON lines, NPY exports and immutable snapshots.

Tables are written by Spark as Parquet in place and committed by its committer. Manifests are small
and written by the driver through the Hadoop file system, so that any store works.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPLETE = "manifest.json"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def canonical_json(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def write_bytes(spark: SparkSession, path: str, raw: bytes, overwrite: bool = True) -> str:
    """Write a small file at once (to a temporary name, then renamed) and return its sha256."""
    fs, where = _fs(spark, path)
    if fs.exists(where) and not overwrite:
        raise FileExistsError(path)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(path + ".building")
    out = fs.create(temporary, True)
    out.write(bytearray(raw))
    out.close()
    fs.delete(where, False)
    if not fs.rename(temporary, where):
        raise OSError(f"cannot write {path}")
    return hashlib.sha256(raw).hexdigest()


def write_json(spark: SparkSession, path: str, value) -> str:
    return write_bytes(spark, path, (json.dumps(value, indent=2, sort_keys=True) + "\n").encode())


def read_json(spark: SparkSession, path: str):
    return json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))


def write_json_lines(df: DataFrame, path: str, order: list[str]) -> str:
    """JSON lines in total order, as one file per range of the order, and the digest of their lines.

    The digest hashes the ordered digests of the lines' partitions: no task sees all lines.
    """
    ordered = df.orderBy(*order)
    ordered.write.mode("errorifexists").json(path)
    return table_digest(df, order)


def table_digest(df: DataFrame, order: list[str]) -> str:
    """A digest of a table's rows that does not depend on how they are partitioned.

    The sums of two 32-bit halves of every row's sha256, with the row count: order-free, so the
    order only has to be part of the rows.
    """
    text = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    half = lambda a: F.conv(F.substring(F.sha2(text, 256), a, 8), 16, 10).cast("decimal(38,0)")
    row = df.agg(F.count("*"), *[F.coalesce(F.sum(half(1 + 8 * k)), F.lit(0)) for k in range(8)]).first()
    return hashlib.sha256(",".join(str(int(x)) for x in row).encode()).hexdigest()


def file_identities(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes, sha256) of the files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_view(tables: dict[str, DataFrame], folder: str, facts: dict) -> dict:
    """Parquet tables and a manifest that names them by their digests; the manifest comes last."""
    spark = next(iter(tables.values())).sparkSession
    entries = {}
    for name, df in sorted(tables.items()):
        df.write.mode("errorifexists").parquet(f"{folder}/{name}")
        back = spark.read.parquet(f"{folder}/{name}")
        entries[name] = {"rows": back.count(), "digest": table_digest(back, back.columns), "columns": back.columns}
    manifest = {"facts": facts, "tables": entries}
    manifest["manifest_sha256"] = hashlib.sha256(canonical_json(manifest).encode()).hexdigest()
    write_json(spark, f"{folder}/{COMPLETE}", manifest)
    return manifest


def verify_view(spark: SparkSession, folder: str) -> DataFrame:
    """One row per table of a view whose contents are not what its manifest says."""
    manifest = read_json(spark, f"{folder}/{COMPLETE}")
    bad = []
    for name, entry in manifest["tables"].items():
        back = spark.read.parquet(f"{folder}/{name}")
        if back.count() != entry["rows"] or table_digest(back, back.columns) != entry["digest"]:
            bad.append((name,))
    return spark.createDataFrame(bad, "table string")


def write_snapshot(tables: dict[str, DataFrame], folder: str, facts: dict) -> dict:
    """An immutable view: built under another name and renamed when it is whole; an existing one is refused."""
    spark = next(iter(tables.values())).sparkSession
    fs, where = _fs(spark, folder)
    if fs.exists(where):
        raise FileExistsError(folder)
    building = folder.rstrip("/") + ".building"
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(building), True)
    manifest = write_view(tables, building, facts)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(building), where):
        raise OSError(f"cannot publish {folder}")
    return manifest


def npy_header(shape: tuple[int, ...], kind: str) -> bytes:
    """The header of an NPY file, version 1."""
    text = f"{{'descr': '{kind}', 'fortran_order': False, 'shape': {shape!r}, }}"
    text += " " * (-(len(text) + 11) % 64) + "\n"
    return b"\x93NUMPY\x01\x00" + struct.pack("<H", len(text)) + text.encode()


def npy_parts(blocks: DataFrame, ids: str = "ids", index: str = "window_index", kind: str = "<i8", shape: tuple[int, ...] | None = None) -> DataFrame:
    """(first, rows, npy): some of the blocks, all of one size, as the bytes of an NPY file, of `shape` each if given.

    Parts follow the global index, so a reader concatenates them in order of `first`.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.array([np.stack(v) if len(v) and isinstance(v[0], (list, np.ndarray)) else np.asarray(v) for v in batch[ids]], kind)
                x = x if shape is None else x.reshape(len(x), *shape)
                yield pd.DataFrame({"first": [int(batch[index].iloc[0])], "rows": [len(x)], "npy": [npy_header(x.shape, kind) + x.tobytes()]})

    return blocks.select(index, ids).repartitionByRange(index).sortWithinPartitions(index).mapInPandas(run, "first long, rows long, npy binary")


def write_npy(parts: DataFrame, folder: str) -> list[str]:
    """The files of npy_parts, named by their first row; they pass the driver one at a time."""
    spark, names = parts.sparkSession, []
    for first, _, raw in parts.toLocalIterator():
        names.append(f"{folder}/part-{first:012d}.npy")
        write_bytes(spark, names[-1], bytes(raw), overwrite=False)
    return sorted(names)


def write_int64_npy(spark: SparkSession, path: str, values: list[int]) -> str:
    """A small one-dimensional index."""
    x = np.asarray(values, "<i8")
    return write_bytes(spark, path, npy_header(x.shape, "<i8") + x.tobytes())


def write_report(spark: SparkSession, path: str, title: str, df: DataFrame, most: int = 1000) -> str:
    """A Markdown table of a summary; a table of more than `most` rows is no summary and refused."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]
    return write_bytes(spark, path, ("\n".join(lines) + "\n").encode())
