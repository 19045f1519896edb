"""FASTQ files as a Spark data source, and FASTQ text as a sink."""

from __future__ import annotations

import fnmatch
import gzip
import io
import itertools
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "read_id string, seq string, qual string, file string, ord long"
_SUFFIXES = (".fastq.gz", ".fq.gz", ".fastq", ".fq")


def natural_key(path: str) -> list:
    """Sorts digits in names by their value."""
    return [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.split(r"(\d+)", os.path.basename(path)) if x]


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address and the path in it; an address without a scheme is a path of this machine."""
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), os.path.abspath(uri))


def discover(paths: Sequence[str]) -> list[str]:
    """FASTQ files of the given files, patterns and folders (not below them) in natural order; repeats are an error.

    Addresses may name any file system that pyarrow knows; all executors must reach it.
    """
    found: list[str] = []
    for path in paths:
        system, at = _open(path)
        head = path[: len(path) - len(at)] if "://" in path else ""
        parent, _, name = at.rpartition("/")
        if system.get_file_info(at).type == fs.FileType.Directory:
            inside = system.get_file_info(fs.FileSelector(at))
            found += [head + f.path for f in inside if f.is_file and f.path.endswith(_SUFFIXES)]
        elif any(c in name for c in "*?["):
            found += [head + f.path for f in system.get_file_info(fs.FileSelector(parent or "/")) if f.is_file and fnmatch.fnmatch(f.base_name, name)]
        else:
            found.append(head + at)
    real = [f if "://" in f else os.path.realpath(f) for f in found]
    if len(set(real)) < len(real):
        raise ValueError("a FASTQ file is named twice")
    return sorted(real, key=natural_key)


def _record(lines: list[bytes], path: str) -> tuple[str, str, str]:
    head, seq, plus, qual = (x.rstrip(b"\r\n").decode() for x in lines)
    if not head.startswith("@") or not plus.startswith("+"):
        raise ValueError(f"malformed FASTQ record in {path}: {head[:60]}")
    if len(seq) != len(qual):
        raise ValueError(f"sequence and qualities differ in length in {path}: {head[:60]}")
    return (head[1:].split() or [""])[0], seq, qual


def _first_record(source, start: int) -> int:
    """Place of the first record that begins at or behind `start`: an @ line with a + line two below, its lengths alike."""
    if start:
        source.seek(start - 1)
        source.readline()
    places, lines = [], []
    while True:
        places.append(source.tell())
        lines.append(source.readline())
        if len(lines) >= 4 or not lines[-1]:
            for i in range(len(lines)):
                four = lines[i : i + 4]
                whole = len(four) == 4 and four[0][:1] == b"@" and four[2][:1] == b"+" and len(four[1].rstrip(b"\r\n")) == len(four[3].rstrip(b"\r\n"))
                if whole:
                    return places[i]
            if not lines[-1]:
                return places[-1]
            places, lines = places[-3:], lines[-3:]


def records(path: str, start: int = 0, end: int | None = None) -> Iterator[tuple[str, str, str, int]]:
    """(id, sequence, qualities, place) of a file, streamed; gzip files may have several members.

    Of a plain file the records that begin from byte `start` up to `end` come, so that parts of a file can be read apart.
    """
    system, at = _open(path)
    if path.endswith(".gz"):
        source = gzip.open(system.open_input_file(at), "rb")
    else:
        source = io.BufferedReader(pa.PythonFile(system.open_input_file(at), "r"), 1 << 20)
        if start:
            source.seek(_first_record(source, start))
    with source:
        place = source.tell()
        while end is None or place < end:
            head = source.readline()
            if not head:
                break
            if head.strip():
                yield *_record([head, *(source.readline() for _ in range(3))], path), place
            place = source.tell()


@dataclass
class _Part(InputPartition):
    path: str
    start: int = 0
    end: int | None = None


#: Bytes of a plain file that one task reads.
SPLIT = 128 << 20
_ROWS = 5_000


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths = options["path"].split(",")
        self.split = int(options.get("split", SPLIT))

    def partitions(self) -> list[_Part]:
        out: list[_Part] = []
        for path in discover(self.paths):
            if path.endswith(".gz"):
                out.append(_Part(path))
                continue
            system, at = _open(path)
            size = system.get_file_info(at).size
            out += [_Part(path, s, min(s + self.split, size)) for s in range(0, size, self.split)] or [_Part(path)]
        return out

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        rows = records(partition.path, partition.start, partition.end)
        numbers = itertools.count()
        while block := list(itertools.islice(rows, _ROWS)):
            names, seqs, quals, places = zip(*block)
            if partition.path.endswith(".gz"):
                places = list(itertools.islice(numbers, len(block)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(seqs, pa.string()), pa.array(quals, pa.string()), pa.array([partition.path] * len(block), pa.string()), pa.array(places, pa.int64())],
                names=["read_id", "seq", "qual", "file", "ord"],
            )


class FastqSource(DataSource):
    """`spark.read.format("fastq").load(path)`: plain files in parts of `split` bytes, gzip files, which can't be split, whole.

    `ord` grows along a file: in gzip files it is the number of the record, in plain ones its first byte.
    """

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def read_fastq(spark: SparkSession, *paths: str, split: int = SPLIT) -> DataFrame:
    spark.dataSource.register(FastqSource)
    return spark.read.format("fastq").option("split", split).load(",".join(paths))


def fastq_text(read_id: Column, seq: Column, qual: Column) -> Column:
    return F.concat(F.lit("@"), read_id, F.lit("\n"), seq, F.lit("\n+\n"), qual)


def write_fastq(reads: DataFrame, path: str, by: str | None = None) -> None:
    """Gzip text files of four-line records; `by` names a column whose values get a folder each."""
    text = reads.select(fastq_text(F.col("read_id"), F.col("seq"), F.col("qual")).alias("value"), *([by] if by else []))
    writer = text.write.mode("errorifexists").option("compression", "gzip")
    (writer.partitionBy(by) if by else writer).text(path)
