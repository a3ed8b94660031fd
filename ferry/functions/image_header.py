"""Image width/height from the file header.

Like opening an image lazily: the format is recognised from its first
bytes and the size read from its header, without decoding pixels. Reads
only the bytes it needs through ``read(offset, n)``; JPEG is walked segment
by segment to its frame header, however far that is. Unknown or truncated
data gives ``None`` (the caller's "unidentified").
"""

from __future__ import annotations

import struct
from collections.abc import Callable

Reader = Callable[[int, int], bytes]

# JPEG start-of-frame markers (baseline, extended, progressive,
# lossless; arithmetic variants), which carry the frame size.
JPEG_SOF = {0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF}


def image_size(read: Reader) -> tuple[int, int] | None:
    try:
        return _size(read)
    except struct.error:  # truncated inside a header
        return None


def _size(read: Reader) -> tuple[int, int] | None:
    head = read(0, 32)
    if head[:8] == b"\x89PNG\r\n\x1a\n" and head[12:16] == b"IHDR" and len(head) >= 24:
        return struct.unpack(">II", head[16:24])
    if head[:6] in (b"GIF87a", b"GIF89a") and len(head) >= 10:
        return struct.unpack("<HH", head[6:10])
    if head[:2] == b"BM" and len(head) >= 26:
        w, h = struct.unpack("<ii", head[18:26])
        return w, abs(h)
    if head[:4] == b"RIFF" and head[8:12] == b"WEBP":
        return _webp(head, read)
    if head[:2] == b"\xff\xd8":
        return _jpeg(read)
    if head[:4] in (b"II*\x00", b"MM\x00*") and len(head) >= 8:
        return _tiff(head, read)
    if head[:4] == b"\x00\x00\x01\x00" and len(head) >= 22:
        return head[6] or 256, head[7] or 256
    return None


def _tiff(head: bytes, read: Reader) -> tuple[int, int] | None:
    """Tags 256 (width) and 257 (height) of the first directory."""
    order = "<" if head[:2] == b"II" else ">"
    at = struct.unpack(order + "I", head[4:8])[0]
    count = read(at, 2)
    if len(count) < 2:
        return None
    size = {}
    n = struct.unpack(order + "H", count)[0]
    entries = read(at + 2, 12 * n)
    for i in range(0, len(entries) - 11, 12):
        tag, kind = struct.unpack(order + "HH", entries[i:i + 4])
        if tag in (256, 257) and kind in (3, 4):
            value = entries[i + 8:i + 12]
            size[tag] = struct.unpack(order + ("HH" if kind == 3 else "I"), value)[0]
    return (size[256], size[257]) if size.keys() == {256, 257} else None


def _webp(head: bytes, read: Reader) -> tuple[int, int] | None:
    kind = head[12:16]
    if kind == b"VP8 ":
        b = read(26, 4)
        if len(b) == 4:
            w, h = struct.unpack("<HH", b)
            return w & 0x3FFF, h & 0x3FFF
    elif kind == b"VP8L":
        b = read(21, 4)
        if len(b) == 4:
            bits = struct.unpack("<I", b)[0]
            return (bits & 0x3FFF) + 1, ((bits >> 14) & 0x3FFF) + 1
    elif kind == b"VP8X":
        b = read(24, 6)
        if len(b) == 6:
            return (1 + int.from_bytes(b[0:3], "little"), 1 + int.from_bytes(b[3:6], "little"))
    return None


def _jpeg(read: Reader) -> tuple[int, int] | None:
    pos = 2
    while True:
        m = read(pos, 2)
        if len(m) < 2 or m[0] != 0xFF:
            return None
        marker = m[1]
        if marker == 0xFF:  # fill byte
            pos += 1
            continue
        if marker in (0x01, 0xD8) or 0xD0 <= marker <= 0xD7:
            pos += 2
            continue
        if marker == 0xD9:  # end of image before a frame
            return None
        seg = read(pos + 2, 7)
        if len(seg) < 2:
            return None
        length = struct.unpack(">H", seg[:2])[0]
        if marker in JPEG_SOF:
            if len(seg) < 7:
                return None
            h, w = struct.unpack(">HH", seg[3:7])
            return w, h
        pos += 2 + length
