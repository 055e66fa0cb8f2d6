"""Pixel preparation for readers, in numpy: from the orientation that a camera noted to crop, sharpening and PNG.

Needs no imaging library: an image is an array (height, width, 3) of uint8.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

_ORIENTATION = 0x0112  # the tag's number in a TIFF directory


def orientation(data: bytes) -> int:
    """1 to 8 as an image file says it (JPEG, TIFF, PNG); 1 where it says nothing that makes sense."""
    try:
        if data[:2] == b"\xff\xd8":
            return _in_jpeg(data)
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return _in_png(data)
        return _in_tiff(data)
    except (struct.error, IndexError):  # the file ends too early
        return 1


def _in_jpeg(data: bytes) -> int:
    at = 2
    while data[at] == 0xFF:
        marker = data[at + 1]
        if marker in (0xD9, 0xDA):  # the image's data, or its end
            return 1
        if marker == 0xFF or 0xD0 <= marker <= 0xD8 or marker == 0x01:  # fillers and markers without a length
            at += 1 if marker == 0xFF else 2
            continue
        (size,) = struct.unpack_from(">H", data, at + 2)
        if marker == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
            return _in_tiff(data[at + 10 : at + 2 + size])
        at += 2 + size
    return 1


def _in_png(data: bytes) -> int:
    at = 8
    while at < len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        if kind == b"eXIf":
            return _in_tiff(data[at + 8 : at + 8 + size])
        if kind == b"IEND":
            return 1
        at += 12 + size
    return 1


def _in_tiff(data: bytes) -> int:
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    if order is None:
        return 1
    (at,) = struct.unpack_from(order + "I", data, 4)
    (n,) = struct.unpack_from(order + "H", data, at)
    for i in range(n):
        tag, kind, _ = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        if tag == _ORIENTATION:
            (value,) = struct.unpack_from(order + ("I" if kind == 4 else "H"), data, at + 10 + 12 * i)
            return value if 1 <= value <= 8 else 1
    return 1


def upright(image: np.ndarray, turned: int) -> np.ndarray:
    """The image as it is meant to be seen, of one stored with this orientation."""
    if turned >= 5:
        image = image.swapaxes(0, 1)
    down, across = turned in (3, 4, 7, 8), turned in (2, 3, 6, 7)
    return image[:: -1 if down else 1, :: -1 if across else 1]


def png(image: np.ndarray) -> bytes:
    """An array of uint8, gray or with three channels, as a PNG file."""
    height, width = image.shape[:2]
    rows = np.ascontiguousarray(image).reshape(height, -1)
    raw = np.concatenate([np.zeros((height, 1), np.uint8), rows], 1).tobytes()  # each row unfiltered

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    header = struct.pack(">IIBBBBB", width, height, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def crop(image: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """The part of an image by relative corners x1, y1, x2, y2."""
    h, w = image.shape[:2]
    x1, y1, x2, y2 = (int(v * s) for v, s in zip(box, (w, h, w, h), strict=True))
    return image[y1:y2, x1:x2]


def channel(image: np.ndarray, name: str) -> np.ndarray:
    """The red channel, or the mean of all."""
    return (image[..., 0] if name == "R" else image.mean(2)).astype(np.float64)


def stretch(gray: np.ndarray, low: float = 2, high: float = 98) -> np.ndarray:
    """Contrast between two percentiles spread over 0 to 255; an image in which they are equal stays."""
    a, b = np.percentile(gray, [low, high])
    return np.clip((gray - a) * (255 / (b - a)), 0, 255) if b > a else gray


def median(gray: np.ndarray, size: int) -> np.ndarray:
    """The median of the square of an odd size around every place, edges repeated."""
    h, w = gray.shape
    padded = np.pad(gray, size // 2, mode="edge")
    return np.median(np.stack([padded[i : i + h, j : j + w] for i in range(size) for j in range(size)]), 0)


def enlarge(gray: np.ndarray, factor: int) -> np.ndarray:
    """Bilinear enlargement by a whole factor."""
    if factor == 1:
        return gray
    h, w = gray.shape
    y, x = (np.clip((np.arange(n * factor) + 0.5) / factor - 0.5, 0, n - 1) for n in (h, w))
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    return (gray[y0][:, x0] * (1 - fx) + gray[y0][:, x1] * fx) * (1 - fy) + (gray[y1][:, x0] * (1 - fx) + gray[y1][:, x1] * fx) * fy


def sharpen(gray: np.ndarray) -> np.ndarray:
    padded = np.pad(gray, 1, mode="edge")
    around = sum(padded[i : i + gray.shape[0], j : j + gray.shape[1]] for i in range(3) for j in range(3)) - gray
    return np.clip((32 * gray - 2 * around) / 16, 0, 255)


def prepare(image: np.ndarray, settings: dict) -> np.ndarray:
    """Crop, channel, enlargement, contrast, median and sharpening as a config says."""
    gray = channel(crop(image, tuple(settings.get("roi", (0, 0, 1, 1)))), settings.get("channel", "gray"))
    gray = stretch(enlarge(gray, settings.get("scale", 1)), *settings.get("contrast", (2, 98)))
    if settings.get("median"):
        gray = median(gray, settings["median"])
    for _ in range(2 * bool(settings.get("sharpen"))):
        gray = sharpen(gray)
    return gray.round().astype(np.uint8)


def remove_stamp(image: np.ndarray, redness: int = 45, least_red: int = 120) -> np.ndarray:
    """The red channel with red stamps turned white and its contrast spread."""
    red, other = image[..., 0].astype(int), image[..., 1:].max(2).astype(int)
    gray = np.where((red - other > redness) & (red > least_red), 255, red).astype(np.float64)
    return stretch(gray).round().astype(np.uint8)
