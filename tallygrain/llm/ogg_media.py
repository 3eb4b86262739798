"""Media columns in Ogg: payloads muxed into pages, and read back with all checks.

A file multiplexes two logical streams. Stream 1 holds the payload as 8-bit samples, a packet for
each 576 of them; stream 2 holds a note with the number of unpadded bytes. The reader finds pages by
their capture pattern, verifies each page's checksum, its stream's sequence numbers and the
continuation flags, reassembles packets from the lacing values (also over pages), demultiplexes by
serial number and derives times from granule positions (samples at the end of the page's last
complete packet).

Edge cases: a null or empty text is a payload of 576 bytes of 255; texts of any length are stored
whole; equal texts give equal bytes; repeated rows give repeated rows; an empty table gives an empty
table; a damaged file makes the reader raise; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.common import materialise, small_batches

#: Samples of a packet, samples a second, the streams' serial numbers, lacing values of a page.
FRAME, RATE, SAMPLES, NOTE, LACES = 576, 8_000, 1, 2, 255
#: Fixed values of the format: header and its flags.
HEAD, CONTINUED, FIRST, LAST = struct.Struct("<4sBBqIIIB"), 1, 2, 4
NO_GRANULE = -1
FLIP = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def page_crc(page: bytes) -> int:
    """CRC-32 of polynomial 0x04C11DB7, high bit first, from 0, nothing inverted: zlib's CRC of the
    same polynomial on bytes with their bits in reverse order, without zlib's two inversions."""
    crc = zlib.crc32(page.translate(FLIP), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(crc.to_bytes(4, "little").translate(FLIP), "big")


def page(serial: int, sequence: int, flags: int, granule: int, laces: bytes, body: bytes) -> bytes:
    head = HEAD.pack(b"OggS", 0, flags, granule, serial, sequence, 0, len(laces)) + laces
    crc = page_crc(head + body)
    return head[:22] + struct.pack("<I", crc) + head[26:] + body


def stream_pages(serial: int, packets: list[tuple[bytes, int]]) -> Iterator[bytes]:
    """Pages of a logical stream of (packet, granule position at its end)."""
    laces, bodies, ends = bytearray(), [], []
    for data, granule in packets:
        laces += b"\xff" * (len(data) // 255) + bytes([len(data) % 255])
        bodies.append(data)
        ends.append((len(laces), granule))
    body, at, k, sequence, size = b"".join(bodies), 0, 0, 0, np.frombuffer(bytes(laces), np.uint8)
    for start in range(0, len(laces), LACES):
        own = laces[start : start + LACES]
        n, granule = int(size[start : start + LACES].sum(dtype=np.int64)), NO_GRANULE
        while k < len(ends) and ends[k][0] <= start + len(own):
            granule, k = ends[k][1], k + 1
        flags = CONTINUED * (start > 0 and laces[start - 1] == 255) | FIRST * (start == 0) | LAST * (start + LACES >= len(laces))
        yield page(serial, sequence, flags, granule, bytes(own), body[at : at + n])
        at, sequence = at + n, sequence + 1


def mux(payload: bytes, n_bytes: int) -> bytes:
    """An Ogg file of the payload, whose length is a multiple of FRAME."""
    head = b"\x01samples8" + struct.pack("<II", RATE, FRAME)
    parts = [(head, 0), *((payload[k : k + FRAME], k + FRAME) for k in range(0, len(payload), FRAME))]
    samples = list(stream_pages(SAMPLES, parts))
    note = list(stream_pages(NOTE, [(f"n_bytes={n_bytes}".encode(), len(payload))]))
    return b"".join([samples[0], *note, *samples[1:]])  # first pages of all streams stand first


@dataclass
class Stream:
    packets: list[bytes] = field(default_factory=list)
    times: list[int] = field(default_factory=list)
    pages: int = 0
    part: bytes | None = None
    ended: bool = False


def demux(data: bytes) -> dict[int, Stream]:
    """The logical streams by serial number; times: granule positions of the pages that have one."""
    at, out = 0, {}
    while at < len(data):
        if len(data) - at < HEAD.size:
            raise ValueError("cut off in a header")
        magic, version, flags, granule, serial, sequence, crc, n = HEAD.unpack_from(data, at)
        if magic != b"OggS" or version:
            raise ValueError(f"no page at {at}")
        laces = data[at + HEAD.size : at + HEAD.size + n]
        size = np.frombuffer(laces, np.uint8).astype(np.int64)
        top = at + HEAD.size + n
        end = top + int(size.sum())
        if len(laces) < n or end > len(data):
            raise ValueError("cut off in a page")
        if page_crc(data[at : at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != crc:
            raise ValueError(f"the page at {at} fails its checksum")
        s = out.setdefault(serial, Stream())
        if s.ended or sequence != s.pages or bool(flags & FIRST) != (s.pages == 0) or bool(flags & CONTINUED) != (s.part is not None):
            raise ValueError(f"the page at {at} is out of order")
        s.pages, s.ended = s.pages + 1, bool(flags & LAST)
        # a packet ends at a lacing value below 255
        stop = np.cumsum(size)
        done = stop[size < 255].tolist()
        begin = 0
        for e in done:
            piece = data[top + begin : top + e]
            s.packets.append(piece if s.part is None else s.part + piece)
            s.part, begin = None, e
        if top + begin < end or (n and size[-1] == 255):
            s.part = (s.part or b"") + data[top + begin : end]
        if (granule == NO_GRANULE) != (not done):
            raise ValueError(f"the page at {at} has a wrong granule position")
        if done:
            s.times.append(granule)
        at = end
    if any(not s.ended or s.part is not None for s in out.values()):
        raise ValueError("a stream has no end")
    return out


def read(data: bytes) -> tuple[bytes, int, str]:
    """Payload, number of unpadded bytes and features of a file."""
    streams = demux(data)
    samples, note = streams[SAMPLES], streams[NOTE]
    payload = b"".join(samples.packets[1:])
    rate, frame = struct.unpack("<II", samples.packets[0][-8:])
    if samples.times[-1] != len(payload) or len(payload) % frame:
        raise ValueError("granule positions and samples disagree")
    n_bytes = int(note.packets[0].split(b"=")[1])
    x = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    level = np.arange(256) - 128
    mean = int((x * level).sum()) / len(payload)
    power = int((x * level * level).sum()) / len(payload)
    seconds = [t / rate for t in samples.times if t]
    pages = sum(s.pages for s in streams.values())
    first = min(seconds, default=0)
    return payload, n_bytes, f"streams={len(streams)};pages={pages};packets={len(samples.packets) - 1};seconds={seconds[-1]:.6f};first_page={first:.6f};mean={mean:.6f};rms={power**0.5:.6f};peak={int(np.abs(level[x > 0]).max())}"


def payload_of(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\xff" * (-len(raw) % FRAME if raw else FRAME), len(raw)


def to_ogg(text: Column) -> Column:
    """Column binary: the whole text as an Ogg file."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([mux(*payload_of(t)) for t in texts.tolist()], dtype=object)

    return run(text)


DIGEST = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def digest(media: Column) -> Column:
    """Column struct: what a stored file holds, read back with all checks."""

    @F.pandas_udf(DIGEST)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for files in batches:
            rows = []
            for data in map(bytes, files.tolist()):
                payload, n, feature = read(data)
                rows.append((n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in DIGEST.split(", ")])

    return run(media)


def media_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the text's Ogg file as media."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), to_ogg(F.col(text_col)).alias("media"))


def stored(media: DataFrame) -> DataFrame:
    """The media, written to the shared folder and read from there."""
    return materialise(media)


def media_digests(media: DataFrame) -> DataFrame:
    """doc_id and the fields of DIGEST, a row for each row of media."""
    return media.select("doc_id", digest(F.col("media")).alias("_d")).select("doc_id", "_d.*")
