"""Packed token files as a data source: ``spark.read.format("packed")`` and ``df.write.format("packed")``.

Rows are (split, block_id, record): records of 16-bit tokens. A folder holds binary files and a
manifest of parts, the runs of records with consecutive block ids. Only what the manifest lists has been written:
it is replaced in one step after all tasks have ended, and files of attempts that failed, were repeated or
were replaced are removed then.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from tokenmill import constants as C
from tokenmill import schemas
from tokenmill.sources.files import filesystem, qualified

RECORDS = "split STRING, block_id BIGINT, record ARRAY<INT>"
READ_BYTES = 16 << 20
PARTS = pa.schema(
    [("split", pa.string()), ("path", pa.string()), ("first_block", pa.int64()), ("records", pa.int64())]
    + [("record_tokens", pa.int32()), ("first_token", pa.int64())]
)


@dataclass
class Ranges(InputPartition):
    """Parts, or ranges of them, that one task reads: (split, path, first block, first token, records, record tokens)."""

    ranges: list[tuple[str, str, int, int, int, int]]


@dataclass
class Written(WriterCommitMessage):
    parts: list[tuple[str, str, int, int, int, int]]


def manifest_file(store: fs.FileSystem, folder: str) -> str | None:
    """The newest manifest of a folder."""
    names = store.get_file_info(fs.FileSelector(f"{folder}/manifest", allow_not_found=True))
    files = [f.path for f in names if f.path.endswith(".parquet")]
    return max(files, key=lambda path: int(path.rsplit("/", 1)[1].split("-")[0]), default=None)


class PackedReader(DataSourceReader):
    def __init__(self, path: str, read_bytes: int, split: str | None, tasks: int):
        self.path, self.read_bytes, self.split, self.tasks = path, read_bytes, split, tasks

    def partitions(self) -> list[Ranges]:
        """Ranges of about ``read_bytes``, less where that would keep some of ``tasks`` idle: large parts are cut at records,
        small ones share a task."""
        store, folder = filesystem(self.path)
        found = manifest_file(store, folder)
        if found is None:
            raise FileNotFoundError(f"no manifest under {self.path}")
        parts = pq.read_table(found, filesystem=store).to_pylist()
        parts = [p for p in parts if self.split is None or p["split"] == self.split]
        total = sum(2 * p["records"] * p["record_tokens"] for p in parts)
        each = min(self.read_bytes, -(-total // self.tasks))
        tasks, current, size = [], [], 0
        for part in parts:
            width, done = part["record_tokens"], 0
            while done < part["records"]:
                take = min(part["records"] - done, max(1, (each - size) // (2 * width)))
                current.append(
                    (part["split"], part["path"], part["first_block"] + done, part["first_token"] + done * width, take, width)
                )
                size, done = size + 2 * width * take, done + take
                if size + 2 * width > each:
                    tasks.append(Ranges(current))
                    current, size = [], 0
        return [*tasks, Ranges(current)] if current or not tasks else tasks

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for split, path, block, first, records, width in partition.ranges:
            store, inner = filesystem(path)
            with store.open_input_file(inner) as source:
                tokens = np.frombuffer(source.read_at(2 * width * records, 2 * first), "<u2").astype(np.int32)
            starts = pa.array(np.arange(records + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([split] * records),
                    pa.array(np.arange(block, block + records)),
                    pa.ListArray.from_arrays(starts, pa.array(tokens)),
                ],
                ["split", "block_id", "record"],
            )


class PackedWriter(DataSourceArrowWriter):
    """Each task attempt writes files of its own: one for each run of records, one for all single records."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = filesystem(self.path)
        store.create_dir(folder)
        attempt = f"{self.job}-{uuid.uuid4().hex}"
        files = _Files(lambda name: store.open_output_stream(f"{folder}/{name}-{attempt}.bin"))
        try:
            for batch in iterator:
                splits, blocks, records = (batch.column(i) for i in range(3))
                tokens = records.flatten().to_numpy(zero_copy_only=False)
                if tokens.size and not 0 <= tokens.min() <= tokens.max() <= C.MAX_TOKEN_ID:
                    raise ValueError("token id does not fit 16 bits")
                data, at = memoryview(tokens.astype("<u2").tobytes()), 0
                for split, block, width in zip(splits.to_pylist(), blocks.to_pylist(), records.value_lengths().to_pylist(), strict=True):
                    files.add(split, block, width, data[2 * at : 2 * (at + width)])
                    at += width
            files.end_run()
        finally:
            files.close()
        return Written([(s, f"{self.path}/{name}-{attempt}.bin", *rest) for s, name, *rest in files.parts])

    def commit(self, messages: list[Written | None]) -> None:
        """Publishes the new manifest by a rename, then removes what no manifest lists."""
        store, folder = filesystem(self.path)
        store.create_dir(f"{folder}/manifest")
        before = manifest_file(store, folder)
        parts = [dict(zip(("split", "path", "first_block", "records", "record_tokens", "first_token"), p)) for m in messages if m for p in m.parts]
        if before and not self.overwrite:
            parts = pq.read_table(before, filesystem=store).to_pylist() + parts
        number = int(before.rsplit("/", 1)[1].split("-")[0]) + 1 if before else 0
        parts.sort(key=lambda p: (p["split"], p["first_block"]))
        staged = f"{folder}/_manifest-{self.job}"
        pq.write_table(pa.Table.from_pylist(parts, schema=PARTS), staged, filesystem=store)
        store.move(staged, f"{folder}/manifest/{number:06d}-{self.job}.parquet")
        listed = {filesystem(p["path"])[1] for p in parts}
        old = [before] if before else []
        self._remove(store, old + [f for f in self._files(store, folder) if f not in listed])

    def abort(self, messages: list[Written | None]) -> None:
        """Removes all files of this write; what was there before stays."""
        store, folder = filesystem(self.path)
        self._remove(store, [f for f in self._files(store, folder) if f"-{self.job}-" in f])

    def _files(self, store: fs.FileSystem, folder: str) -> list[str]:
        """Files of this write; of a replaced folder all."""
        found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return [f.path for f in found if f.path.endswith(".bin") and (self.overwrite or f"-{self.job}-" in f.path)]

    @staticmethod
    def _remove(store: fs.FileSystem, paths: list[str]) -> None:
        for path in paths:
            store.delete_file(path)


class _Files:
    """The files of one attempt; ``parts`` are [split, file name, first block, records, record tokens, first token]."""

    def __init__(self, open_file: Callable[[str], pa.NativeFile]):
        self.open_file, self.parts = open_file, []
        self.run = self.first = self.out = self.loose = None
        self.loose_tokens = 0

    def add(self, split: str, block: int, width: int, record: memoryview) -> None:
        if self.run == (split, block, width):
            if self.out is None:  # the second record of a run opens its file
                name = f"{split}-{block - 1:010d}-{width}"
                self.out = self.open_file(name)
                self.out.write(self.first)
                self.parts.append([split, name, block - 1, 1, width, 0])
            self.out.write(record)
            self.parts[-1][3] += 1
        else:
            self.end_run()
            self.first = record
        self.run = split, block + 1, width

    def end_run(self) -> None:
        if self.out is not None:
            self.out.close()
        elif self.run is not None:
            split, after, width = self.run
            self.loose = self.loose or self.open_file("loose")
            self.loose.write(self.first)
            self.parts.append([split, "loose", after - 1, 1, width, self.loose_tokens])
            self.loose_tokens += width
        self.run = self.out = None

    def close(self) -> None:
        for file in (self.out, self.loose):
            if file is not None:
                file.close()


class PackedSource(DataSource):
    """Options: ``path`` (with scheme), ``read_bytes`` for a task, ``tasks`` to keep busy, ``split`` to read one split only."""

    @classmethod
    def name(cls) -> str:
        return "packed"

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema: StructType) -> PackedReader:
        read_bytes, tasks = int(self.options.get("read_bytes", READ_BYTES)), int(self.options.get("tasks", 1))
        return PackedReader(self.options["path"], read_bytes, self.options.get("split"), tasks)

    def writer(self, schema: StructType, overwrite: bool) -> PackedWriter:
        return PackedWriter(self.options["path"], overwrite)


def write_records(records: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Writes (split, block_id, record); rows that follow each other in a partition become one part."""
    spark = records.sparkSession
    spark.dataSource.register(PackedSource)
    rows = records.select("split", "block_id", "record")
    rows.write.format("packed").mode(mode).save(qualified(spark, folder))


def read_records(spark: SparkSession, folder: str, split: str | None = None, read_bytes: int = READ_BYTES) -> DataFrame:
    spark.dataSource.register(PackedSource)
    tasks = 2 * spark.sparkContext.defaultParallelism
    reader = spark.read.format("packed").option("read_bytes", read_bytes).option("tasks", tasks)
    return (reader.option("split", split) if split else reader).load(qualified(spark, folder))


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest: one row per part."""
    return spark.read.schema(schemas.PACKED_PARTS).parquet(f"{folder}/manifest")
