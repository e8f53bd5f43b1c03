"""Block-gzip text as a Spark data source and sink.

A block-gzip file is a chain of gzip members of at most 64 KiB of text, each with its own length in an extra field, so
it can be entered at any block. Reading: every file is cut into ranges of compressed bytes, a partition each. A task looks
for the first block at or after the start of its range, unpacks block after block and yields lines; a line belongs to
the range in which the block that holds the end of the line before it begins, so a task skips up to the first line end
(but for the start of a file) and reads past its range until its last line is complete. Lines may cross any number of
blocks. Writing: each task writes one part file of blocks, ended by the empty block that marks a complete file.

Files are opened through pyarrow's file systems by their address (a plain path is a local one).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Fixed values of the format: a member's first bytes (gzip, deflate, extra field), and the empty block that ends a file.
MAGIC = b"\x1f\x8b\x08\x04"
END_OF_FILE = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
MOST_TEXT = 0xFF00
MOST_BLOCK = 1 << 16
RANGE = 8 << 20
NAME = "block_gzip"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def block_size(head: bytes) -> int | None:
    """Length of the block that begins with head, from its BC field; None if none begins there."""
    if len(head) < 18 or head[:4] != MAGIC:
        return None
    extra = head[12 : 12 + struct.unpack_from("<H", head, 10)[0]]
    at = 0
    while at + 4 <= len(extra):
        n = struct.unpack_from("<H", extra, at + 2)[0]
        if extra[at : at + 2] == b"BC" and n == 2 and at + 6 <= len(extra):
            return struct.unpack_from("<H", extra, at + 4)[0] + 1
        at += 4 + n
    return None


def unpack(block: bytes) -> bytes:
    """Text of one block; its checksum and length must be right."""
    text = zlib.decompress(block, wbits=31)
    if len(text) != struct.unpack_from("<I", block, len(block) - 4)[0]:
        raise ValueError("a block's length differs from its text")
    return text


def pack(text: bytes) -> bytes:
    """One block of at most MOST_TEXT bytes of text."""
    body = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = body.compress(text) + body.flush()
    if len(data) + 26 > MOST_BLOCK:  # text that does not shrink is stored
        body = zlib.compressobj(0, zlib.DEFLATED, -15)
        data = body.compress(text) + body.flush()
    return MAGIC + bytes(4) + b"\x00\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(data) + 25) + data + struct.pack("<II", zlib.crc32(text), len(text))


def is_blocked(path: str) -> bool:
    """Whether a file begins with a block."""
    files, at = filesystem(path)
    with files.open_input_file(at) as f:
        return block_size(f.read(64)) is not None


def first_block(f: pa.NativeFile, start: int, size: int) -> int:
    """Offset of the first block at or after start: one whose length leads to another block, or to the end of the file."""
    if start == 0:
        return 0
    at, held = start, b""
    while at < size:
        f.seek(at)
        held = f.read(2 * MOST_BLOCK)
        i = held.find(MAGIC)
        while i >= 0:
            n = block_size(held[i : i + 300])
            if n:
                f.seek(at + i + n)
                if at + i + n == size or block_size(f.read(64)):
                    return at + i
            i = held.find(MAGIC, i + 1)
        at += len(held) - len(MAGIC) if len(held) > len(MAGIC) else len(held) or size
    return size


def blocks(f: pa.NativeFile, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, text) of the blocks from offset at on."""
    f.seek(at)
    while at < size:
        head = f.read(64)
        n = block_size(head)
        if n is None:
            raise ValueError(f"no block begins at byte {at}: the file is not block-gzip or is damaged")
        block = head[:n] + f.read(n - len(head)) if n > len(head) else head[:n]
        if len(block) < n:
            raise ValueError(f"the block at byte {at} is cut off")
        yield at, unpack(block)
        at += n
        f.seek(at)


def lines(path: str, start: int, stop: int) -> Iterator[list[str]]:
    """The lines of a range, a list for each block that completes some."""
    files, at = filesystem(path)
    with files.open_input_file(at) as f:
        size = f.size()
        begin = first_block(f, start, size)
        if begin >= stop:
            return
        skipping, rest = begin > 0, []
        for offset, text in blocks(f, begin, size):
            over = offset >= stop
            if skipping:
                cut = text.find(b"\n")
                if over and cut < 0 or cut < 0:
                    if over:
                        return  # the whole range lies within one line, which an earlier range reads
                    continue
                if over:
                    return
                text, skipping = text[cut + 1 :], False
            if over:
                cut = text.find(b"\n")
                if cut < 0:
                    rest.append(text)
                    continue
                yield [(b"".join(rest) + text[:cut]).decode()]
                return
            found = text.split(b"\n")
            if len(found) > 1:
                yield [(b"".join(rest) + found[0]).decode(), *[x.decode() for x in found[1:-1]]]
                rest = []
            if found[-1]:
                rest.append(found[-1])
        if b"".join(rest):
            yield [b"".join(rest).decode()]


@dataclass
class Range(InputPartition):
    path: str
    start: int
    stop: int


def found(paths: list[str]) -> Iterator[tuple[str, int]]:
    """(address, bytes) of the files of each path: itself, or the visible files of a folder."""
    for path in paths:
        files, at = filesystem(path)
        info = files.get_file_info(at)
        prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        inside = [info] if info.is_file else files.get_file_info(fs.FileSelector(at))
        yield from sorted((prefix + x.path, x.size) for x in inside if x.is_file and x.size and not x.base_name.startswith(("_", ".")))


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = options["paths"].split("\n") if "paths" in options else [options["path"]]
        self.range = int(options.get("range_bytes", RANGE))

    def partitions(self) -> list[Range]:
        return [Range(p, at, min(at + self.range, size)) for p, size in found(self.paths) for at in range(0, size, self.range)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        size = 0
        for some in lines(part.path, part.start, part.stop):
            held += [x.removesuffix("\r") for x in some]
            size += sum(map(len, some))
            if size > 4 << 20:
                yield self._batch(held, part.path)
                held, size = [], 0
        if held:
            yield self._batch(held, part.path)

    @staticmethod
    def _batch(held: list[str], path: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array([path] * len(held), pa.string())], names=["value", "file"])


@dataclass
class Part(WriterCommitMessage):
    path: str


class Writer(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.job = options["path"].rstrip("/"), overwrite, uuid.uuid4().hex
        files, at = filesystem(self.path)
        files.create_dir(at, recursive=True)
        if not overwrite and any(not x.base_name.startswith(("_", ".")) for x in files.get_file_info(fs.FileSelector(at))):
            raise FileExistsError(f"{self.path} has files; use mode overwrite")

    def write(self, rows: Iterator) -> Part:
        from pyspark import TaskContext

        files, at = filesystem(self.path)
        task = TaskContext.get()
        name = f"{at}/_{self.job}-{task.partitionId():05d}-{task.taskAttemptId()}"
        held = bytearray()
        with files.open_output_stream(name, compression=None) as out:
            for r in rows:
                held += r[0].encode() + b"\n"
                while len(held) >= MOST_TEXT:
                    out.write(pack(bytes(held[:MOST_TEXT])))
                    del held[:MOST_TEXT]
            if held:
                out.write(pack(bytes(held)))
            out.write(END_OF_FILE)
        return Part(name)

    def commit(self, messages: list[Part | None]) -> None:
        files, at = filesystem(self.path)
        if self.overwrite:
            for x in files.get_file_info(fs.FileSelector(at)):
                if x.is_file and not x.base_name.startswith(f"_{self.job}"):
                    files.delete_file(x.path)
        for i, m in enumerate(m for m in messages if m):
            files.move(m.path, f"{at}/part-{i:05d}-{self.job}.bgz")
        self._clean(files, at)
        with files.open_output_stream(f"{at}/_SUCCESS") as out:
            out.write(b"")

    def abort(self, messages: list[Part | None]) -> None:
        self._clean(*filesystem(self.path))

    def _clean(self, files: fs.FileSystem, at: str) -> None:
        for x in files.get_file_info(fs.FileSelector(at)):
            if x.base_name.startswith(f"_{self.job}"):
                files.delete_file(x.path)


class BlockGzip(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string, file string"

    def reader(self, schema) -> Reader:
        return Reader(self.options)

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options, overwrite)


def read_lines(spark: SparkSession, paths: list[str], range_bytes: int = RANGE) -> DataFrame:
    """(value, file): the lines of block-gzip files or folders of them, in as many partitions as there are ranges."""
    spark.dataSource.register(BlockGzip)
    return spark.read.format(NAME).option("paths", "\n".join(paths)).option("range_bytes", range_bytes).load()


def write_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The one text column of df as block-gzip part files, in the order of its partitions."""
    df.sparkSession.dataSource.register(BlockGzip)
    df.write.format(NAME).mode(mode).save(path)
