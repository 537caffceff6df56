"""Ogg containers: pages with checksums, packets by lacing values, logical streams, granule times.

A payload is stored as 8-bit mono samples. Each container holds two logical
streams, multiplexed page by page: the samples (`pcm8`) and a one-packet note
with the payload's unpadded length (`note`). Reading verifies every page
checksum, takes packets together again across page ends, separates the streams
by serial number, and derives times from granule positions.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed by the container format: capture pattern, header layout, flags, segments a page, largest lacing value.
CAPTURE = b"OggS"
HEADER, HEADER_BYTES = "<4sBBqIIIB", 27
CONTINUED, FIRST, LAST = 1, 2, 4
MAX_SEGMENTS, LACE = 255, 255
NO_PACKET_ENDS = -1

_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
_PCM, _NOTE = "<4sIBB", "<4sQ"


class OggError(ValueError):
    """The bytes are no valid container."""


def page_checksum(page: bytes) -> int:
    """CRC-32 of polynomial 0x04C11DB7, most significant bit first, no initial or final inversion."""
    reflected = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(reflected.to_bytes(4, "little").translate(_REVERSED), "big")


def _lacing(size: int) -> list[int]:
    return [LACE] * (size // LACE) + [size % LACE]


def stream_pages(serial: int, packets: list[bytes], granules: list[int]) -> list[bytes]:
    """Pages of one logical stream; the first packet (its header) has a page to itself. granules: position at each packet's end."""
    pages: list[bytes] = []
    groups = [(packets[:1], granules[:1]), (packets[1:], granules[1:])]
    for body, ends in groups:
        laces, closing, at = [], [], 0
        for packet, granule in zip(body, ends, strict=True):
            laces += _lacing(len(packet))
            closing.append((len(laces), granule))
        data, n = b"".join(body), 0
        for lo in range(0, len(laces), MAX_SEGMENTS):
            part = laces[lo : lo + MAX_SEGMENTS]
            granule = NO_PACKET_ENDS
            while n < len(closing) and closing[n][0] <= lo + len(part):
                granule, n = closing[n][1], n + 1
            flags = (CONTINUED if lo and laces[lo - 1] == LACE else 0) | (0 if pages else FIRST)
            flags |= LAST if (body is groups[1][0] or not groups[1][0]) and lo + MAX_SEGMENTS >= len(laces) else 0
            size = sum(part)
            head = struct.pack(HEADER, CAPTURE, 0, flags, granule, serial, len(pages), 0, len(part)) + bytes(part)
            page = head + data[at : at + size]
            pages.append(page[:22] + page_checksum(page).to_bytes(4, "little") + page[26:])
            at += size
    return pages


def multiplex(streams: list[list[bytes]]) -> bytes:
    """Header pages first, then the streams' pages in turn."""
    out = [pages[0] for pages in streams]
    for i in range(1, max(map(len, streams))):
        out += [pages[i] for pages in streams if i < len(pages)]
    return b"".join(out)


@dataclass
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    granules: list[int] = field(default_factory=list)  # of pages on which a packet ends
    n_pages: int = 0
    ended: bool = False


def demultiplex(data: bytes) -> dict[int, Stream]:
    """Logical streams by serial number, in order of appearance. Raises OggError at any damage."""
    streams: dict[int, Stream] = {}
    open_packets: dict[int, bytes | None] = {}
    at = 0
    while at < len(data):
        if len(data) - at < HEADER_BYTES:
            raise OggError(f"page header cut at byte {at}")
        capture, version, flags, granule, serial, sequence, checksum, n = struct.unpack_from(HEADER, data, at)
        laces = data[at + HEADER_BYTES : at + HEADER_BYTES + n]
        end = at + HEADER_BYTES + n + sum(laces)
        if capture != CAPTURE or version or len(laces) < n or end > len(data):
            raise OggError(f"no whole page at byte {at}")
        page = data[at:end]
        if page_checksum(page[:22] + b"\0\0\0\0" + page[26:]) != checksum:
            raise OggError(f"checksum of the page at byte {at}")
        s = streams.setdefault(serial, Stream(serial))
        carried = open_packets.get(serial)
        if sequence != s.n_pages or bool(flags & FIRST) != (s.n_pages == 0) or bool(flags & CONTINUED) != (carried is not None) or s.ended:
            raise OggError(f"page order at byte {at}")
        s.n_pages += 1
        s.ended = bool(flags & LAST)
        pos, begin, closed = HEADER_BYTES + n, HEADER_BYTES + n, False
        for lace in laces:
            pos += lace
            if lace < LACE:
                s.packets.append((carried or b"") + page[begin:pos])
                carried, begin, closed = None, pos, True
        if begin < pos or (n and laces[-1] == LACE):
            carried = (carried or b"") + page[begin:pos]
        open_packets[serial] = carried
        if closed != (granule != NO_PACKET_ENDS):
            raise OggError(f"granule position at byte {at}")
        if closed:
            s.granules.append(granule)
        at = end
    if any(x is not None for x in open_packets.values()) or not all(s.ended for s in streams.values()):
        raise OggError("a stream has no end")
    return streams


def store_samples(payload: bytes, n_bytes: int, rate: int = 8000, packet_bytes: int = 4800) -> bytes:
    """A container of the payload's bytes as 8-bit samples; it depends on these arguments only."""
    serial = zlib.crc32(payload) & 0x7FFFFFFF
    chunks = [payload[i : i + packet_bytes] for i in range(0, len(payload), packet_bytes)]
    ends = [min(i + packet_bytes, len(payload)) for i in range(0, len(payload), packet_bytes)]
    sound = stream_pages(serial, [struct.pack(_PCM, b"pcm8", rate, 1, 8), *chunks], [0, *ends])
    note = stream_pages(serial + 1, [b"note", struct.pack(_NOTE, b"size", n_bytes)], [0, len(payload)])
    return multiplex([sound, note])


def read_samples(data: bytes) -> dict:
    """payload, n_bytes and what the container says of its streams and times."""
    sound = note = None
    streams = demultiplex(data)
    for s in streams.values():
        kind = s.packets[0][:4]
        sound = s if kind == b"pcm8" else sound
        note = s if kind == b"note" else note
    if sound is None or note is None:
        raise OggError("a logical stream is missing")
    _, rate, channels, bits = struct.unpack(_PCM, sound.packets[0])
    payload = b"".join(sound.packets[1:])
    return {"payload": payload, "n_bytes": struct.unpack(_NOTE, note.packets[1])[1], "rate": rate, "channels": channels, "bits": bits, "n_streams": len(streams), "n_pages": sum(s.n_pages for s in streams.values()), "n_packets": len(sound.packets) - 1, "times": [g / rate for g in sound.granules]}


def _feature(read: dict) -> str:
    x = np.frombuffer(read["payload"], np.uint8).astype(np.int64) - 128
    turns = int(np.count_nonzero((x[1:] >= 0) != (x[:-1] >= 0)))
    return f"streams={read['n_streams']};pages={read['n_pages']};packets={read['n_packets']};end={read['times'][-1]:.6f};mean={x.mean():.6f};rms={np.sqrt((x * x).mean()):.6f};crossings={turns}"


def text_to_media(docs: DataFrame, block: int = 192, keep_media: bool = False) -> DataFrame:
    """Store each text's UTF-8 bytes, padded with spaces to a positive multiple of `block`, and read them back.

    A null text counts as empty. Gives doc_id, n_bytes, payload_bytes,
    payload_sha256 and tail_crc32 (both of the bytes read back), media_bytes,
    media_sha256, feature and, with keep_media, media itself. Equal texts give
    equal values. Repeated rows give repeated results, an empty table an empty
    result; other columns are ignored. A text of any length is handled on its
    own, in memory of a few times its size.
    """
    fields = [("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
    fields += [("media", pa.binary())] if keep_media else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in fields]
            for text in batch.column("text"):
                raw = text.as_py() or b""
                size = max(block, -(-len(raw) // block) * block)
                media = store_samples(raw.ljust(size, b" "), len(raw))
                read = read_samples(media)
                payload = read["payload"]
                row = [read["n_bytes"], len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), _feature(read), media]
                for column, value in zip(out, row, strict=False):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, kind) for v, (_, kind) in zip(out, fields, strict=True))], ["doc_id", *(n for n, _ in fields)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    spec = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string" + ", media binary" * keep_media
    return docs.select("doc_id", F.encode(F.col("text").cast("string"), "UTF-8").alias("text")).mapInArrow(run, f"doc_id {kind}, {spec}")
