"""Token-ID files: independent zstandard frames, a trailing seek table, a checksum for each frame.

A file holds one frame for each document, in ascending id order, so a reader decompresses only the
documents it wants. After the frames come two skippable frames, which ordinary zstandard readers
pass over: the document ids, then the seek table of the public seekable format (compressed size,
size and low 32 bits of the XXH64 of each frame's content). Ids are little-endian and as narrow as
the vocabulary allows; the width stands with the document ids.

The writer sorts the table by range of id and writes a file in each task, of about FILE_BYTES of
text, through pyarrow's file systems into a folder that all nodes share. Every attempt of a task
writes a file of its own; the table of files, a line for each, comes from the attempts that Spark
counts, and files of others are removed once it is there. Only those lines reach the driver.

Edge cases: a null or empty text is the end id alone; a null id sorts first; rows that share an id
stand together, ordered by the hash of the text and then by the text, and may go over several files;
ids are stored as 64-bit numbers, so one that is none counts as null;
an empty table gives no files and an empty result; texts are encoded whole; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.common import scratch_dir, small_batches
from tallygrain.llm.pretokens import as_text, gathered_batches, rule_units
from tallygrain.llm.token_counts import MergeTable

#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: The skippable frame of document ids.
IDS = 0x184D2A50
CHECKSUMS = 0x80
LEVEL = 3
#: Bytes of text for a file, and bytes that the reader of whole files asks for at once.
FILE_BYTES, READ_BYTES = 256 << 20, 8 << 20
MANIFEST = "file string, n_docs long, n_ids long, n_bytes long"


@lru_cache(2)
def _encoder(path: str) -> tuple[MergeTable, int]:
    table = MergeTable(path)
    return table, 2 if table.pairs.width <= 1 << 16 else 4


def encode_texts(texts: pa.Array, path: str, end_id: int) -> list[bytes]:
    """Ids of each whole text, as the tokenizers library gives them, with the end id; little-endian."""
    table, width = _encoder(path)
    cut = rule_units(as_text(texts), table.special)
    flat, start, size = table.encode_units(cut)
    ids, bounds = cut.gathered(flat.astype(f"<u{width}"), start, size)
    raw, at, end = ids.tobytes(), (bounds * width).tolist(), np.array([end_id], f"<u{width}").tobytes()
    return [raw[a:b] + end for a, b in zip(at, at[1:], strict=False)]


class FrameWriter:
    """Writes a file of frames to an open stream."""

    def __init__(self, sink, width: int):
        self.sink, self.width = sink, width
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.table: list[bytes] = []
        self.ids: list[int | None] = []
        self.n_ids = self.n_bytes = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if len(ids) >= 1 << 32:
            raise ValueError("a frame of the seekable format holds less than 4 GB")
        frame = self.packer.compress(ids)
        self.table.append(struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.n_ids += len(ids) // self.width
        self._put(frame)

    def _put(self, b: bytes) -> None:
        self.sink.write(b)
        self.n_bytes += len(b)

    def close(self) -> None:
        known = np.array([x is not None for x in self.ids], np.uint8)
        ids = np.array([x or 0 for x in self.ids], "<i8")
        body = struct.pack("<BI", self.width, len(ids)) + known.tobytes() + ids.tobytes()
        self._put(struct.pack("<II", IDS, len(body)) + body)
        body = b"".join(self.table) + struct.pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE)
        self._put(struct.pack("<II", SKIPPABLE, len(body)) + body)


class FrameReader:
    """Random access to a file of frames; reads the tables first, then only what is asked for."""

    def __init__(self, file):
        self.file = file
        end = file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("no seek table")
        top = end - 9 - 12 * n - 8
        if struct.unpack("<II", self._at(top, 8)) != (SKIPPABLE, 12 * n + 9):
            raise ValueError("damaged seek table")
        self.table = np.frombuffer(self._at(top + 8, 12 * n), "<u4").reshape(-1, 3).astype(np.int64)
        self.start = np.r_[0, np.cumsum(self.table[:, 0])]
        at = int(self.start[-1])
        head = self._at(at, 13)
        magic, size, self.width, count = struct.unpack("<IIBI", head)
        if magic != IDS or count != n or at + 8 + size != top:
            raise ValueError("damaged document ids")
        body = self._at(at + 13, 9 * n)
        known = np.frombuffer(body[:n], np.uint8)
        self.ids = [int(x) if k else None for x, k in zip(np.frombuffer(body[n:], "<i8"), known, strict=True)]
        self.unpacker = zstandard.ZstdDecompressor()

    def _at(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def __len__(self) -> int:
        return len(self.table)

    def frames(self) -> Iterator[bytes]:
        """All frames in order, many of them with each request."""
        k = 0
        while k < len(self):
            low = int(self.start[k])
            end = max(k + 1, int(np.searchsorted(self.start, low + READ_BYTES, "right")) - 1)
            held = self._at(low, int(self.start[end]) - low)
            for i in range(k, end):
                yield self._unpacked(i, held[int(self.start[i]) - low : int(self.start[i + 1]) - low])
            k = end

    def frame(self, k: int) -> bytes:
        return self._unpacked(k, self._at(int(self.start[k]), int(self.table[k, 0])))

    def _unpacked(self, k: int, packed: bytes) -> bytes:
        _, size, check = self.table[k].tolist()
        b = self.unpacker.decompress(packed, max_output_size=size)
        if len(b) != size or xxhash.xxh64_intdigest(b) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} fails its checksum")
        return b


def write_token_files(docs: DataFrame, path: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[str, DataFrame]:
    """Writes the files; their folder and a table with a row for each file: file, n_docs, n_ids, n_bytes."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or scratch_dir(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():08d}-{uuid.uuid4().hex}.ids.zst"
        writer = None
        for held in gathered_batches(b for b in batches if b.num_rows):
            if writer is None:
                fs.create_dir(base, recursive=True)
                sink = fs.open_output_stream(f"{base}/{name}", compression=None)  # or it would go by the name
                writer = FrameWriter(sink, _encoder(path)[1])
            t = pa.Table.from_batches(held).combine_chunks()
            texts = t["text"].chunk(0)
            for doc_id, ids in zip(t["doc_id"].to_pylist(), encode_texts(texts, path, end_id), strict=True):
                writer.add(doc_id, ids)
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "n_docs": len(writer.ids), "n_ids": writer.n_ids, "n_bytes": writer.n_bytes}])

    rows = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("h"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    files = max(-(-int(size) // FILE_BYTES), spark.sparkContext.defaultParallelism)
    placed = rows.repartitionByRange(files, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    done = sorted(placed.mapInArrow(write, MANIFEST).collect())
    fs, base = pafs.FileSystem.from_uri(folder)
    known = {r["file"] for r in done}
    for f in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)):
        if f.is_file and f.base_name.endswith(".ids.zst") and f.base_name not in known:
            fs.delete_file(f.path)
    return folder, spark.createDataFrame(done, MANIFEST)


def read_token_files(folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, read frame by frame."""
    spark = manifest.sparkSession
    offset, plan = 0, []
    for r in sorted(manifest.collect()):  # a line for each file
        plan.append((r["file"], offset))
        offset += r["n_ids"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = pafs.FileSystem.from_uri(folder)
        for pdf in batches:
            for name, start in zip(pdf["file"], pdf["start"], strict=True):
                with fs.open_input_file(f"{base}/{name}") as f:
                    reader, rows = FrameReader(f), []
                    for k, (doc_id, frame) in enumerate(zip(reader.ids, reader.frames(), strict=True)):
                        ids = np.frombuffer(frame, f"<u{reader.width}").astype("<u4")
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000 or k + 1 == len(reader):
                            cols = list(zip(*rows, strict=True))
                            yield pd.DataFrame({"doc_id": pd.array(cols[0], "Int64"), "start": cols[1], "n_tokens": cols[2], "ids_crc32": cols[3]})
                            rows = []

    files = spark.createDataFrame(plan, "file string, start long")
    return files.repartition(max(1, len(plan))).mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(folder: str, name: str, wanted: list[int]) -> dict[int, np.ndarray]:
    """The ids of some documents of one file; no other frame is read."""
    fs, base = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{base}/{name}") as f:
        r, ask = FrameReader(f), set(wanted)
        return {d: np.frombuffer(r.frame(k), f"<u{r.width}") for k, d in enumerate(r.ids) if d in ask}
