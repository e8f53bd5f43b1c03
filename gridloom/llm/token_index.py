"""Token ids of a corpus as binary shards with a minimal perfect hash index.

Format of a shard: NAME.tok holds the ids of its documents in ascending key order, each a little-endian unsigned
integer of the shard's width (2 bytes where the vocabulary has at most 65,536 ids, else 4), nothing else. NAME.idx holds
"MPHI", the number of keys n, of buckets b and the width (unsigned 32-bit), b pilots (signed 32-bit), then n slots of
(fingerprint u32, n_ids u32, offset u64). A key's hash chooses its bucket; a pilot p >= 0 sends the key to slot mix(hash, p) mod n, and p < 0 names slot -p-1 outright. Every key has its own slot and no
slot is free; the stored fingerprint tells keys that were never written. Beside the shards lies `directory`, a Parquet
table of one row a shard: its name, its first and last key and the number of ids in it, by which a key finds its shard.

The folder must be on a file system that pyarrow opens by its URI (a shared mount, HDFS, an object store), as raw
binary files are written and read by position.

Cases: null text counts as empty; very long texts are encoded whole and lie in one shard; documents with an equal doc_id
are numbered by text and each keeps its ids, under the keys (doc_id, 0), (doc_id, 1), ...; a null doc_id comes first;
columns other than doc_id and text are not read, whatever their names; an empty table gives no shard, an empty
directory and an empty manifest.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.llm.bpe import END_ID, default_tokenizer, encoder
from gridloom.llm.common import cut, scratch_path, text_batches, text_or_empty

HEADER = "<4sIII"
SLOT = np.dtype([("fingerprint", "<u4"), ("n_ids", "<u4"), ("offset", "<u8")])
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
DIRECTORY = "shard_no long, shard string, first_id long, first_copy int, last_id long, last_copy int, n_keys long, n_ids long"
MANIFEST = "doc_id long, copy int, shard string, shard_no long, offset long, n_tokens long"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def key_hash(ids: list[int | None], copies: list[int]) -> np.ndarray:
    """64 bits of (doc_id, copy); distinct keys of one shard have distinct hashes unless 64 bits collide."""
    a = np.array([-(2**63) if i is None else i for i in ids], dtype=np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        return _mix(_mix(a + np.uint64(0x9E3779B97F4A7C15)) + np.array(copies, dtype=np.uint64))


def _slot(h: np.ndarray, pilot: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_mix(h + pilot.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)


def build_index(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pilots, slot of each key). Buckets of several keys search a pilot, largest first; single keys take what is free."""
    n = len(hashes)
    b = max(1, (n + 2) // 3)
    pilots, taken, place = np.zeros(b, np.int32), np.zeros(n, bool), np.zeros(n, np.int64)
    bucket = (hashes >> np.uint64(32)) % np.uint64(b)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(b + 1, dtype=np.uint64))
    sizes = np.diff(starts)
    tries = np.arange(64)
    single = []
    for k in np.argsort(-sizes, kind="stable"):
        own = order[starts[k] : starts[k + 1]]
        if len(own) < 2:
            single += [(k, own[0])] if len(own) else []
            continue
        base = 0
        while True:
            at = _slot(hashes[own][:, None], (base + tries)[None, :], n)
            free = ~taken[at].any(0)
            at_sorted = np.sort(at, axis=0)
            free &= (np.diff(at_sorted, axis=0) != 0).all(0)
            if free.any():
                t = int(np.argmax(free))
                pilots[k] = base + t
                place[own] = at[:, t]
                taken[at[:, t]] = True
                break
            base += 64
            if base > 2**30:
                raise ValueError("two keys of a shard have one hash")
    for (k, own), slot in zip(single, np.flatnonzero(~taken)):
        pilots[k], place[own] = -slot - 1, slot
    return pilots, place


class ShardIndex:
    """The .idx bytes of a shard, ready for lookups."""

    def __init__(self, data: bytes):
        magic, self.n, self.b, self.width = struct.unpack_from(HEADER, data)
        if magic != b"MPHI":
            raise ValueError("not a shard index")
        self.pilots = np.frombuffer(data, "<i4", self.b, struct.calcsize(HEADER))
        self.slots = np.frombuffer(data, SLOT, self.n, struct.calcsize(HEADER) + 4 * self.b)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, offset in ids, number of ids) of each key, in constant time a key."""
        if not self.n:
            zero = np.zeros(len(hashes), np.int64)
            return zero.astype(bool), zero, zero
        pilot = self.pilots[((hashes >> np.uint64(32)) % np.uint64(self.b)).astype(np.int64)]
        at = np.where(pilot < 0, -pilot.astype(np.int64) - 1, _slot(hashes, np.maximum(pilot, 0), self.n))
        slot = self.slots[at]
        return slot["fingerprint"] == (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32), slot["offset"].astype(np.int64), slot["n_ids"].astype(np.int64)


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _put(folder: str, name: str, data: bytes) -> None:
    files, root = _open(folder)
    with files.open_output_stream(f"{root}/{name}") as out:
        out.write(data)


def write_shards(docs: DataFrame, folder: str, tokenizer: str | None = None, shard_ids: int = 16_000_000, cache_entries: int = 900_000) -> DataFrame:
    """Write the ids of every document below folder (any file system pyarrow opens) and return the manifest.

    Documents are dealt by ranges of doc_id, so shards ascend with the partition number and each task streams one
    range; a shard is closed at shard_ids ids, which bounds its index. A task that is run again writes files of its
    own name first and renames them when they are whole. The manifest is materialised before it is returned.
    """
    spark, path = docs.sparkSession, tokenizer or default_tokenizer()
    text_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    rows = rows.withColumn("part", F.spark_partition_id())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, files, root = encoder(path, cache_entries), *_open(folder)
        width = 2 if max(encode.tokenizer.get_vocab_size(), END_ID + 1) <= 1 << 16 else 4
        files.create_dir(root, recursive=True)
        roll, state, last = 0, None, (object(), -1)

        def close(s: dict) -> pa.RecordBatch:
            s["out"].close()
            hashes = key_hash(s["ids"], s["copies"])
            pilots, place = build_index(hashes)
            slots = np.zeros(len(hashes), SLOT)
            slots["fingerprint"][place] = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            slots["n_ids"][place], slots["offset"][place] = s["n"], s["offset"]
            _put(folder, f"{s['tmp']}.idx", struct.pack(HEADER, b"MPHI", len(hashes), len(pilots), width) + pilots.tobytes() + slots.tobytes())
            for end in ("tok", "idx"):
                if files.get_file_info(f"{root}/{s['name']}.{end}").type.name != "NotFound":
                    files.delete_file(f"{root}/{s['name']}.{end}")
                files.move(f"{root}/{s['tmp']}.{end}", f"{root}/{s['name']}.{end}")
            k = len(s["ids"])
            return pa.record_batch([pa.array(s["ids"], pa.int64()), pa.array(s["copies"], pa.int32()), pa.array([s["name"]] * k), pa.array([s["no"]] * k, pa.int64()), pa.array(s["offset"], pa.int64()), pa.array(s["n"], pa.int64())], names=["doc_id", "copy", "shard", "shard_no", "offset", "n_tokens"])

        for batch in batches:
            d = batch.to_pydict()
            for doc, ids in zip(d["doc_id"], encode.encode_many(d["text"])):
                if state is None:
                    no = d["part"][0] * 1_000_000 + roll
                    name = f"shard-{no:012d}"
                    state = {"no": no, "name": name, "tmp": f".{name}-{uuid.uuid4().hex}", "ids": [], "copies": [], "n": [], "offset": [], "at": 0}
                    state["out"] = files.open_output_stream(f"{root}/{state['tmp']}.tok")
                last = (doc, last[1] + 1 if doc == last[0] else 0)
                n = len(ids) // 4 + 1
                state["out"].write(np.append(np.frombuffer(ids, "<u4"), np.uint32(END_ID)).astype(f"<u{width}").tobytes())
                for k, v in (("ids", doc), ("copies", last[1]), ("n", n), ("offset", state["at"])):
                    state[k].append(v)
                state["at"] += n
                if state["at"] >= shard_ids:
                    yield close(state)
                    roll, state = roll + 1, None
        if state:
            yield close(state)

    manifest = cut(rows.mapInArrow(write, MANIFEST), "manifest")
    write_directory(folder, manifest)
    return manifest


def write_directory(folder: str, manifest: DataFrame) -> None:
    """One row a shard with its key range from the manifest and its number of ids from the files themselves."""
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "copy")
    ranges = manifest.groupBy("shard_no", "shard").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("n_keys"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        for batch in batches:
            n = [files.get_file_info(f"{root}/{s}.tok").size // _index_of(folder, s).width for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], names=[*batch.schema.names, "n_ids"])

    flat = ranges.select("shard_no", "shard", F.col("first.doc_id").alias("first_id"), F.col("first.copy").alias("first_copy"), F.col("last.doc_id").alias("last_id"), F.col("last.copy").alias("last_copy"), "n_keys")
    flat.mapInArrow(measured, DIRECTORY).coalesce(1).write.mode("overwrite").parquet(f"{folder}/directory")


def directory(spark: SparkSession, folder: str) -> DataFrame:
    """The directory with base, the ids in all earlier shards. One row a shard: the one-task window is over files."""
    d = spark.read.schema(DIRECTORY).parquet(f"{folder}/directory")
    return d.withColumn("base", F.sum("n_ids").over(W.orderBy("shard_no")) - F.col("n_ids"))


class KeyedReader:
    """Reads the ids of documents by key: the directory gives the shard, its index the place, and the payload the ids."""

    def __init__(self, folder: str):
        import pyarrow.parquet as pq

        self.folder = folder
        files, root = _open(folder)
        rows = pq.read_table(f"{root}/directory", filesystem=files).to_pylist()
        order = lambda i, c: (i is not None, i or 0, c)
        self.shards = sorted((order(r["last_id"], r["last_copy"]), order(r["first_id"], r["first_copy"]), r["shard"]) for r in rows)
        self.lasts = [r[0] for r in self.shards]

    def find(self, doc_id: int | None, copy: int = 0) -> str | None:
        """The shard whose key range holds the key."""
        key = (doc_id is not None, doc_id or 0, copy)
        i = bisect_left(self.lasts, key)
        return self.shards[i][2] if i < len(self.shards) and self.shards[i][1] <= key else None

    def get(self, doc_id: int | None, copy: int = 0) -> np.ndarray | None:
        """The ids of one document; None if it was never written."""
        shard = self.find(doc_id, copy)
        return None if shard is None else lookup(self.folder, shard, doc_id, copy)


@lru_cache(4)
def _index_of(folder: str, shard: str) -> ShardIndex:
    files, root = _open(folder)
    with files.open_input_file(f"{root}/{shard}.idx") as f:
        return ShardIndex(f.read())


def _ids(payload, width: int, offset: int, n: int) -> np.ndarray:
    return np.frombuffer(payload.read_at(width * n, width * offset), f"<u{width}").astype("<u4")


def lookup(folder: str, shard: str, doc_id: int | None, copy: int = 0) -> np.ndarray | None:
    """The ids of one document, read by its key alone; None if the shard never had the key."""
    index = _index_of(folder, shard)
    found, offset, n = index.find(key_hash([doc_id], [copy]))
    if not found[0]:
        return None
    files, root = _open(folder)
    with files.open_input_file(f"{root}/{shard}.tok") as f:
        return _ids(f, index.width, int(offset[0]), int(n[0]))


def read_back(folder: str, keys: DataFrame) -> DataFrame:
    """For (doc_id, copy, shard, ...) rows: adds at, n_read and ids_crc32, found through the index and read from the payload."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        for batch in batches:
            d = batch.to_pydict()
            hashes = key_hash(d["doc_id"], d["copy"])
            at, n_read, crc = (np.zeros(len(hashes), np.int64) for _ in range(3))
            shards = np.array(d["shard"])
            for shard in dict.fromkeys(d["shard"]):
                rows = np.flatnonzero(shards == shard)
                index = _index_of(folder, shard)
                found, offset, n = index.find(hashes[rows])
                if not found.all():
                    raise ValueError(f"{shard} lacks a key of its manifest")
                with files.open_input_file(f"{root}/{shard}.tok") as f:
                    for r, o, k in zip(rows, offset, n):
                        at[r], n_read[r], crc[r] = o, k, zlib.crc32(_ids(f, index.width, int(o), int(k)).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at), pa.array(n_read), pa.array(crc)], names=[*batch.schema.names, "at", "n_read", "ids_crc32"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema)
    return keys.mapInArrow(read, f"{kinds}, at long, n_read long, ids_crc32 long")


def op3_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, "shards")
    keys = write_shards(docs, folder).select("doc_id", "copy", "shard", "shard_no")
    bases = directory(spark, folder).select("shard_no", "base")  # one row a shard
    back = read_back(folder, keys).join(bases, "shard_no")
    return back.select("doc_id", (F.col("base") + F.col("at")).alias("start"), F.col("n_read").alias("n_tokens"), "ids_crc32", "shard")
