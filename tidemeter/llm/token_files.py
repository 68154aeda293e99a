"""Token ids in files of independent zstandard frames.

A file is a row of zstandard frames, each readable alone, and ends in a seek table: a skippable frame with the sizes
and a checksum of every frame. A frame holds whole documents: their number, for each its id and number of tokens, and then
all ids. A stored index has a row for each frame, with the range of its ids. ``read_documents`` seeks to the frames whose
ranges hold requested ids and decompresses nothing else; ``read_token_files`` reads all.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemeter.llm.pieces import encode_words
from tidemeter.llm.shared import by_ids, prepared, stored

# Fixed values of the seekable zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_BYTES = 1 << 20
LEVEL = 1
# Packed bytes that a reading task takes.
READ_BYTES = 64 << 20
INDEX_SCHEMA = (
    "part int, file string, frame int, at bigint, packed bigint, size bigint, check bigint, docs bigint, tokens bigint, "
    "unknown bigint, first_id bigint, last_id bigint"
)
# Ranges of ids by which requested ids meet frames.
CUTS = 256
ENTRY = np.dtype([("known", "u1"), ("id", "<i8"), ("tokens", "<u4")])


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def frame_bytes(ids: list[int | None], tokens: list[np.ndarray]) -> bytes:
    entries = np.zeros(len(ids), dtype=ENTRY)
    entries["known"] = [i is not None for i in ids]
    entries["id"] = [i or 0 for i in ids]
    entries["tokens"] = [len(t) for t in tokens]
    return struct.pack("<I", len(ids)) + entries.tobytes() + b"".join(t.astype("<u4").tobytes() for t in tokens)


def frame_documents(data: bytes) -> list[tuple[int | None, np.ndarray]]:
    (count,) = struct.unpack_from("<I", data)
    entries = np.frombuffer(data, dtype=ENTRY, count=count, offset=4)
    ids = np.frombuffer(data, dtype="<u4", offset=4 + count * ENTRY.itemsize)
    ends = np.cumsum(entries["tokens"], dtype=np.int64)
    return [(int(e["id"]) if e["known"] else None, ids[b - e["tokens"] : b]) for e, b in zip(entries, ends)]


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    """Trailing skippable frame of (packed size, size, checksum) entries."""
    body = b"".join(struct.pack("<III", *f) for f in frames) + struct.pack("<IBI", len(frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(source) -> list[tuple[int, int, int]]:
    """Entries from the end of an open file."""
    size = source.size()
    source.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
        raise ValueError("no seek table")
    source.seek(size - 9 - 12 * count)
    return list(struct.iter_unpack("<III", source.read(12 * count)))


def checked(packed: bytes, size: int, check: int) -> bytes:
    data = zstandard.ZstdDecompressor().decompress(packed, max_output_size=size)
    if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
        raise ValueError("a frame does not match its checksum")
    return data


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write files in ascending id order, one for each range of ids; returns the stored index, a row for each frame.

    Null ids come first, equal ids in the order of their texts; null texts are empty. Each attempt of a task writes to a
    name of its own and only the successful attempt's name is in the index, so lost executors leave no broken file
    in use. The index has each frame's number of null ids and its first and last other id (null: none). A document larger than a frame gets a frame of its own. Empty input gives an empty index.
    """
    prepared(docs.sparkSession)
    if dict(docs.dtypes)[id_col] not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError("ids of token files are integers")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ranged = texts.repartitionByRange("id").sortWithinPartitions("id", "text")
    located = ranged.select(F.spark_partition_id().alias("part"), "id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        rows, table, at, part, name, out = [], [], 0, None, f"{uuid.uuid4().hex}.zst", None
        packer = zstandard.ZstdCompressor(level=LEVEL)
        ids, tokens, held = [], [], 0

        def flush() -> None:
            nonlocal at, ids, tokens, held
            data = frame_bytes(ids, tokens)
            packed, check = packer.compress(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF
            out.write(packed)
            table.append((len(packed), len(data), check))
            known = [i for i in ids if i is not None]
            bounds = (min(known), max(known)) if known else (None, None)
            counted = len(ids), sum(map(len, tokens)), len(ids) - len(known)
            rows.append((part, name, len(rows), at, len(packed), len(data), check, *counted, *bounds))
            at += len(packed)
            ids, tokens, held = [], [], 0

        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    part = batch["part"][0].as_py()
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                made, _ = encode_words(batch["text"], tokenizer)
                for doc_id, found in zip(batch["id"].to_pylist(), made):
                    found = found if end_id is None else np.append(found, np.uint32(end_id))
                    if held and held + 4 * len(found) > FRAME_BYTES:
                        flush()
                    ids.append(doc_id)
                    tokens.append(found)
                    held += 4 * len(found)
            if out is not None:
                flush()
                out.write(seek_table(table))
        finally:
            if out is not None:
                out.close()
        names = [f.split()[0] for f in INDEX_SCHEMA.split(", ")]
        kinds = [pa.int32(), pa.string(), pa.int32()] + [pa.int64()] * 9
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return stored(located.mapInArrow(write, INDEX_SCHEMA), "token-index")


def _started(index: DataFrame) -> DataFrame:
    """The index and ``start``: the number of token ids before each frame."""
    before = Window.partitionBy("part").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row by file: their number is the number of tasks that wrote.
    files = index.groupBy("part").agg(F.sum("tokens").alias("all"))
    bases = files.select("part", F.coalesce(F.sum("all").over(order), F.lit(0)).alias("base"))
    starts = index.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))).join(bases, "part")
    return starts.withColumn("start", F.col("base") + F.col("start")).drop("base")


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """All documents of the files: id, start (ids of all documents before it), n_tokens, ids_crc32, tokens.

    Frames are read in parallel, each at its place in the file, and checked against their checksums.
    """
    return _read_frames(_started(index), folder)


def requested_frames(index: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the index, with ``start``, whose frames can hold ``ids`` (column ``id``; null asks for the null ids).

    Ids and frames meet by ranges between quantiles of the frames' first ids, so that not every id meets every frame.
    """
    frames = stored(_started(index), "frames")
    fractions = F.array(*(F.lit(i / CUTS) for i in range(1, CUTS)))
    found = frames.agg(F.percentile_approx("first_id", fractions)).first()[0] or []  # CUTS numbers at most
    cuts = F.array(*(F.lit(c).cast("long") for c in sorted(set(found)))).cast("array<bigint>")

    def cell(value: Column) -> Column:
        return F.size(F.filter(cuts, lambda c: c <= value))

    known = frames.where("first_id IS NOT NULL").select(
        "part", "frame", "first_id", "last_id", F.explode(F.sequence(cell(F.col("first_id")), cell(F.col("last_id")))).alias("cell")
    )
    asked = ids.select(F.col("id").cast("long").alias("asked")).distinct().withColumn("cell", cell(F.col("asked")))
    held = known.join(asked, (known["cell"] == asked["cell"]) & F.col("asked").between(F.col("first_id"), F.col("last_id")), "left_semi")
    chosen = held.select("part", "frame")
    if not ids.where("id IS NULL").isEmpty():
        chosen = chosen.union(frames.where("unknown > 0").select("part", "frame"))
    return frames.join(chosen.distinct(), ["part", "frame"], "left_semi")


def read_documents(index: DataFrame, folder: str, ids: DataFrame) -> DataFrame:
    """The documents of ``ids`` (column ``id``, integers), as of ``read_token_files``. Only frames that can hold them are read.

    An id that no document has gives no row, an id asked for twice gives its documents once, a null those without id.
    """
    asked = stored(ids.select(F.col("id").cast("long").alias("id")).distinct(), "asked")
    found = _read_frames(requested_frames(index, asked), folder)
    wanted = stored(asked.where("id IS NOT NULL"), "wanted")
    rows = by_ids(found, wanted, "id", "left_semi")
    if not asked.where("id IS NULL").isEmpty():
        rows = rows.unionByName(found.where("id IS NULL"))
    return rows


def _read_frames(frames: DataFrame, folder: str) -> DataFrame:
    """The documents of the given rows of the index."""
    wanted = frames.select("file", "at", "packed", "size", "check", "start")
    packed = wanted.agg(F.sum("packed")).first()[0] or 0
    tasks = max(wanted.sparkSession.sparkContext.defaultParallelism, -(-packed // READ_BYTES))
    dealt = wanted.repartition(tasks, F.col("file"), F.col("at"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base}/{row['file']}") as source:
                    source.seek(row["at"])
                    packed = source.read(row["packed"])
                docs = frame_documents(checked(packed, row["size"], row["check"]))
                counts = np.array([len(t) for _, t in docs], dtype=np.int64)
                offsets = np.concatenate([[0], np.cumsum(counts)])
                crc = [zlib.crc32(t.tobytes()) for _, t in docs]
                ids = np.concatenate([t for _, t in docs]) if docs else np.zeros(0, "<u4")
                tokens = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in docs], pa.int64()), pa.array(row["start"] + offsets[:-1]), pa.array(counts), pa.array(crc, pa.int64()), tokens],
                    ["id", "start", "n_tokens", "ids_crc32", "tokens"],
                )

    return dealt.mapInArrow(read, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, tokens array<int>")


def token_index(spark: SparkSession, folder: str, file: str) -> list[tuple[int, int, int]]:
    """Seek table of one file, for readers without the stored index."""
    store, base = open_store(folder)
    with store.open_input_file(f"{base}/{file}") as source:
        return read_seek_table(source)
