"""PNG bytes to arrays and back: 8-bit grey, RGB, grey-alpha and RGBA without interlacing.

Used when no imaging library is installed on the executors.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Fixed values of the PNG format: signature, and channels by colour type.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}
COLOUR_TYPES = {1: 0, 3: 2, 2: 4, 4: 6}


def encode_png(pixels: np.ndarray) -> bytes:
    """PNG bytes of a height x width x channels array of bytes."""
    height, width, channels = pixels.shape
    header = struct.pack(">IIBBBBB", width, height, 8, COLOUR_TYPES[channels], 0, 0, 0)
    lines = np.zeros((height, 1 + width * channels), dtype=np.uint8)
    lines[:, 1:] = pixels.reshape(height, -1)
    parts = ((b"IHDR", header), (b"IDAT", zlib.compress(lines.tobytes())), (b"IEND", b""))
    return SIGNATURE + b"".join(
        struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
        for kind, body in parts
    )


def decode_png(content: bytes) -> np.ndarray:
    """A height x width x channels array of bytes; ValueError for anything else."""
    if not content.startswith(SIGNATURE):
        raise ValueError("not a PNG image")
    header, packed, at = None, [], len(SIGNATURE)
    while at + 8 <= len(content):
        (length,) = struct.unpack(">I", content[at : at + 4])
        kind, body = content[at + 4 : at + 8], content[at + 8 : at + 8 + length]
        check = content[at + 8 + length : at + 12 + length]
        if len(check) < 4 or struct.unpack(">I", check)[0] != zlib.crc32(kind + body):
            raise ValueError("damaged PNG image")
        if kind == b"IHDR":
            if length != 13:
                raise ValueError("damaged PNG image")
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        elif kind == b"IEND":
            break
        at += 12 + length
    if header is None or not packed:
        raise ValueError("damaged PNG image")
    width, height, depth, colour, _, _, interlace = header
    if depth != 8 or colour not in CHANNELS or interlace:
        raise ValueError("unsupported PNG image")
    channels = CHANNELS[colour]
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(packed)), dtype=np.uint8)
    except zlib.error as error:
        raise ValueError("damaged PNG image") from error
    if raw.size != height * (1 + width * channels):
        raise ValueError("damaged PNG image")
    lines = raw.reshape(height, 1 + width * channels)
    return _unfilter(lines[:, 0], lines[:, 1:].astype(np.int32), channels).reshape(height, width, channels)


def _unfilter(kinds: np.ndarray, lines: np.ndarray, step: int) -> np.ndarray:
    if set(kinds.tolist()) & {3, 4}:
        return _unfilter_lanes(kinds, lines, step)
    done = np.zeros_like(lines)
    above = np.zeros(lines.shape[1], dtype=np.int32)
    for row, kind in enumerate(kinds):
        line = lines[row]
        if kind == 0:
            current = line
        elif kind == 2:
            current = (line + above) & 255
        elif kind == 1:
            current = np.cumsum(line.reshape(-1, step), axis=0).reshape(-1) & 255
        else:
            raise ValueError("damaged PNG image")
        done[row] = above = current
    return done.astype(np.uint8)


def _unfilter_lanes(kinds: np.ndarray, lines: np.ndarray, step: int) -> np.ndarray:
    """Rows that look left and up: all bytes on one diagonal depend on earlier diagonals only.

    Byte ``x`` of row ``y`` lies on diagonal ``x + y``; the rows of a diagonal are computed together.
    """
    if set(kinds.tolist()) - {0, 1, 2, 3, 4}:
        raise ValueError("damaged PNG image")
    height, width = len(lines), lines.shape[1] // step
    # A frame of zeros above and left; one column of pixels per place.
    done = np.zeros((height + 1, width + 1, step), dtype=np.int32)
    given = lines.reshape(height, width, step)
    for diagonal in range(height + width - 1):
        y = np.arange(max(0, diagonal - width + 1), min(height, diagonal + 1))
        x = diagonal - y
        left, over, corner = done[y + 1, x], done[y, x + 1], done[y, x]
        target = left + over - corner
        away = np.stack([np.abs(target - left), np.abs(target - over), np.abs(target - corner)])
        nearest = np.choose(away.argmin(axis=0), [left, over, corner])
        kind = kinds[y][:, None]
        guess = np.select([kind == 1, kind == 2, kind == 3, kind == 4], [left, over, (left + over) // 2, nearest], 0)
        done[y + 1, x + 1] = (given[y, x] + guess) & 255
    return done[1:, 1:].astype(np.uint8)
