"""Media columns: MPEG transport streams written, taken apart and described.

A stream has packets of 188 bytes. Its program tables say which packets carry
the one elementary stream; that is cut into packetised units with time stamps,
and a unit where decoding may start is marked as a random-access point.

``mux`` stores a payload losslessly, one access unit for each UNIT bytes.
``demux`` reads any such stream: it follows the tables, checks each packet's
continuity counter, puts the units together again and collects their stamps.

Defined cases: a null text is empty; an empty payload is filled to one unit;
equal texts give equal streams; a stream with lost or repeated packets is read
as far as whole packets go and its errors are counted; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PACKET = 188
SYNC = 0x47
UNIT = 576
FILL = 255
PAT_PID, PMT_PID, DATA_PID = 0, 0x100, 0x101
PRIVATE_STREAM = 0x06
STREAM_ID = 0xBD
#: Ticks of the 90 kHz clock in a unit, and units from one random-access point to the next.
TICKS = 3003
ACCESS_EVERY = 16
NULL_PID = 0x1FFF


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = ((c << 1) ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


CRC_TABLE = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ CRC_TABLE[(c >> 24) ^ b]
    return c


def section(table: int, number: int, body: bytes) -> bytes:
    """A program table's section with its check sum."""
    head = bytes([table]) + (0xB000 | (len(body) + 9)).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\0\0"
    return head + body + crc32_mpeg(head + body).to_bytes(4, "big")


def table_packet(pid: int, data: bytes) -> bytes:
    return (bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10, 0]) + data).ljust(PACKET, b"\xff")


TABLES = table_packet(PAT_PID, section(0, 1, b"\0\1" + (0xE000 | PMT_PID).to_bytes(2, "big"))) + table_packet(
    PMT_PID, section(2, 1, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\0" + bytes([PRIVATE_STREAM]) + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\0")
)
#: A unit: header of 14 bytes and UNIT bytes, over four packets; what is free is stuffing behind the first packet's header.
HEADER = 14
ROOM = PACKET - 4
PER_UNIT = -(-(HEADER + UNIT + 8) // ROOM)
STUFFING = PER_UNIT * ROOM - HEADER - UNIT


def mux(payload: bytes) -> bytes:
    """A transport stream of a payload of whole units."""
    units = len(payload) // UNIT
    out = np.full((units, PER_UNIT, PACKET), 255, np.uint8)
    k = np.arange(units, dtype=np.int64)
    out[:, :, 0] = SYNC
    out[:, :, 1] = DATA_PID >> 8
    out[:, 0, 1] |= 0x40
    out[:, :, 2] = DATA_PID & 255
    out[:, :, 3] = 0x10 | (np.arange(units * PER_UNIT).reshape(units, PER_UNIT) & 15)
    out[:, 0, 3] |= 0x20
    # adaptation field of the first packet: length, flags, program clock, stuffing
    out[:, 0, 4] = STUFFING - 1
    out[:, 0, 5] = np.where(k % ACCESS_EVERY == 0, 0x50, 0x10)
    clock = k * TICKS
    for i in range(4):
        out[:, 0, 6 + i] = clock >> (25 - 8 * i) & 255
    out[:, 0, 10] = (clock & 1) << 7 | 0x7E
    out[:, 0, 11] = 0
    body = np.empty((units, HEADER + UNIT), np.uint8)
    body[:, :9] = np.frombuffer(bytes([0, 0, 1, STREAM_ID]) + (HEADER - 6 + UNIT).to_bytes(2, "big") + bytes([0x84, 0x80, 5]), np.uint8)
    stamp = clock + TICKS
    body[:, 9] = 0x21 | (stamp >> 30 & 7) << 1
    body[:, 10] = stamp >> 22 & 255
    body[:, 11] = (stamp >> 15 & 127) << 1 | 1
    body[:, 12] = stamp >> 7 & 255
    body[:, 13] = (stamp & 127) << 1 | 1
    body[:, 14:] = np.frombuffer(payload, np.uint8).reshape(units, UNIT)
    first = ROOM - STUFFING
    out[:, 0, 4 + STUFFING :] = body[:, :first]
    out[:, 1:, 4:] = body[:, first:].reshape(units, PER_UNIT - 1, ROOM)
    return TABLES + out.tobytes()


@dataclass
class Stream:
    payload: bytes = b""
    packets: int = 0
    programs: dict[int, int] = field(default_factory=dict)
    streams: dict[int, int] = field(default_factory=dict)
    table_errors: int = 0
    continuity_errors: int = 0
    sync_errors: int = 0
    stamps: list[int] = field(default_factory=list)
    #: Numbers of the units where decoding may start, and of the packets they begin in.
    access_units: list[int] = field(default_factory=list)
    access_packets: list[int] = field(default_factory=list)


def _table(packet: bytes, table: int) -> bytes | None:
    """The body of the section that a packet holds, None if broken."""
    data = packet[4 + (1 + packet[4] if packet[3] & 0x20 else 0) :]
    data = data[1 + data[0] :] if data else b""
    size = int.from_bytes(data[1:3], "big") & 0xFFF if len(data) > 3 else 0
    whole = data[: 3 + size]
    if len(whole) < 12 or whole[0] != table or len(whole) < 3 + size or crc32_mpeg(whole) != 0:
        return None
    return whole[8:-4]


def demux(data: bytes) -> Stream:
    """Read a transport stream: its first program's first elementary stream."""
    out = Stream()
    whole = len(data) // PACKET
    p = np.frombuffer(data, np.uint8, whole * PACKET).reshape(whole, PACKET)
    good = p[:, 0] == SYNC
    out.packets, out.sync_errors = whole, int((~good).sum()) + (len(data) % PACKET > 0)
    pid = np.where(good, (p[:, 1].astype(np.int32) & 31) << 8 | p[:, 2], NULL_PID)
    for i in np.flatnonzero((pid == PAT_PID) & (p[:, 1] & 0x40 > 0)):
        body = _table(p[i].tobytes(), 0)
        out.table_errors += body is None
        for k in range(0, len(body or b""), 4):
            out.programs[int.from_bytes(body[k : k + 2], "big")] = int.from_bytes(body[k + 2 : k + 4], "big") & 0x1FFF
    for where in out.programs.values():
        for i in np.flatnonzero((pid == where) & (p[:, 1] & 0x40 > 0)):
            body = _table(p[i].tobytes(), 2)
            out.table_errors += body is None
            k = 4 + (int.from_bytes(body[2:4], "big") & 0xFFF) if body else 0
            while body and k + 5 <= len(body):
                out.streams[int.from_bytes(body[k + 1 : k + 3], "big") & 0x1FFF] = body[k]
                k += 5 + (int.from_bytes(body[k + 3 : k + 5], "big") & 0xFFF)
    if not out.streams:
        return out
    at = np.flatnonzero(pid == next(iter(out.streams)))
    q = p[at]
    carries = (q[:, 3] & 0x10) > 0
    counter = (q[:, 3] & 15).astype(np.int64)
    same = np.zeros(len(at), bool)
    if len(at) > 1:
        want = (counter[:-1] + carries[1:]) & 15
        same[1:] = carries[1:] & (counter[1:] == counter[:-1]) & (q[1:] == q[:-1]).all(1)
        out.continuity_errors = int(((counter[1:] != want) & ~same[1:]).sum())
    extra = np.where(q[:, 3] & 0x20, 1 + q[:, 4].astype(np.int64), 0)
    use = carries & ~same & (extra <= ROOM)
    access = (q[:, 3] & 0x20 > 0) & (q[:, 4] > 0) & (q[:, 5] & 0x40 > 0)
    starts = (q[:, 1] & 0x40) > 0
    unit = np.cumsum(starts & use) - 1
    out.access_units = unit[access & use & starts].tolist()
    out.access_packets = at[access & use & starts].tolist()
    keep = use & (unit >= 0)
    mask = (np.arange(PACKET)[None] >= 4 + extra[:, None]) & keep[:, None]
    sizes = np.bincount(unit[keep], (PACKET - 4 - extra)[keep], int(unit.max()) + 1 if len(unit) else 0).astype(np.int64)
    flat = q[mask]
    begin = np.cumsum(sizes) - sizes
    begin, sizes = begin[sizes >= HEADER], sizes[sizes >= HEADER]
    if not len(begin):
        return out
    head = flat[begin[:, None] + np.arange(HEADER)[None]].astype(np.int64)
    fine = (head[:, 0] == 0) & (head[:, 1] == 0) & (head[:, 2] == 1)
    stamped = fine & (head[:, 7] & 0x80 > 0)
    stamp = (head[:, 9] >> 1 & 7) << 30 | head[:, 10] << 22 | (head[:, 11] >> 1) << 15 | head[:, 12] << 7 | head[:, 13] >> 1
    out.stamps = stamp[stamped].tolist()
    length = np.where(head[:, 4] << 8 | head[:, 5], (head[:, 4] << 8 | head[:, 5]) + 6, sizes)
    first = begin + 9 + head[:, 8]
    last = begin + np.minimum(length, sizes)
    n = np.where(fine, np.maximum(last - first, 0), 0)
    ends = np.cumsum(n)
    out.payload = flat[np.repeat(first - ends + n, n) + np.arange(int(ends[-1]))].tobytes()
    return out


def feature(s: Stream) -> str:
    """What was read: packets, tables, errors, units, stamps, random-access points."""
    gaps = np.diff(s.stamps)
    steady = int(gaps[0]) if len(gaps) and (gaps == gaps[0]).all() else 0
    first, last = (s.stamps[0], s.stamps[-1]) if s.stamps else (-1, -1)
    points = zlib.crc32(",".join(f"{u}:{p}" for u, p in zip(s.access_units, s.access_packets, strict=True)).encode())
    return f"packets={s.packets};programs={len(s.programs)};streams={len(s.streams)};errors={s.sync_errors + s.table_errors + s.continuity_errors};units={len(s.stamps)};first={first};last={last};step={steady};access={len(s.access_units)};access_crc32={points}"


def padded(raw: bytes) -> bytes:
    return raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT), bytes([FILL]))


def store(docs: DataFrame, with_media: bool = True) -> DataFrame:
    """Of each document: the stream (media), its read-back digests and features, stamps and random-access points."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "access_units"]

    names += ["media"] * with_media
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                rows = []
                for doc_id, raw in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    media = mux(padded(raw))
                    back = demux(media)
                    row = [doc_id, len(raw), len(back.payload), hashlib.sha256(back.payload).hexdigest(), zlib.crc32(back.payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(back), back.access_units]
                    rows.append(row + [media] if with_media else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, access_units array<int>"
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text")).mapInArrow(run, schema + ", media binary" * with_media)
