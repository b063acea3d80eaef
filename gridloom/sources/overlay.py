"""Boxes of recognised items drawn over page images: PNG in, PNG out, with numpy and zlib only."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import page_name

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples a pixel by colour type: grey, RGB, palette, grey and alpha, RGB and alpha.
SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
BOX, LABEL = (0, 180, 0), (255, 0, 0)
LABEL_SCALE, LABEL_TOP = 2, 18
#: Rows of 3 x 5 digits and the point, as bits.
DIGITS = {"0": (7, 5, 5, 5, 7), "1": (2, 6, 2, 2, 7), "2": (7, 1, 7, 4, 7), "3": (7, 1, 7, 1, 7), "4": (5, 5, 7, 1, 1), "5": (7, 4, 7, 1, 7), "6": (7, 4, 7, 5, 7), "7": (7, 1, 1, 2, 2), "8": (7, 5, 7, 5, 7), "9": (7, 5, 7, 1, 7), ".": (0, 0, 0, 0, 2), "-": (0, 0, 7, 0, 0)}


def _parts(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    if not content.startswith(SIGNATURE):
        raise ValueError("no PNG image")
    at = len(SIGNATURE)
    while at + 8 <= len(content):
        size, kind = struct.unpack_from(">I4s", content, at)
        body = content[at + 8 : at + 8 + size]
        if len(body) < size or at + 12 + size > len(content):
            raise ValueError("the image ends early")
        if zlib.crc32(kind + body) != struct.unpack_from(">I", content, at + 8 + size)[0]:
            raise ValueError("a part of the image is damaged")
        yield kind, body
        at += 12 + size


def _line(kind: int, raw: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """A line of bytes out of its filtered form and the line above; ``step`` bytes a pixel."""
    if kind == 0:
        return raw
    if kind == 1:
        return np.cumsum(raw.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)
    if kind == 2:
        return raw + above
    if kind not in (3, 4):
        raise ValueError(f"no line filter {kind}")
    out, up, given = bytearray(len(raw)), above.tolist(), raw.tolist()
    for i, x in enumerate(given):
        left = out[i - step] if i >= step else 0
        if kind == 3:
            out[i] = (x + (left + up[i]) // 2) & 255
        else:
            corner = up[i - step] if i >= step else 0
            a, b, c = abs(up[i] - corner), abs(left - corner), abs(left + up[i] - 2 * corner)
            out[i] = (x + (left if a <= b and a <= c else up[i] if b <= c else corner)) & 255
    return np.frombuffer(bytes(out), np.uint8)


def decode(content: bytes) -> np.ndarray:
    """Height x width x 3 samples of a PNG image of 8 bits a sample, not interlaced; alpha is dropped."""
    head, data, palette = None, [], None
    for kind, body in _parts(bytes(content)):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data.append(body)
    if head is None or not data:
        raise ValueError("no image in the file")
    width, height, depth, colour, _, _, interlaced = head
    if depth != 8 or interlaced or colour not in SAMPLES:
        raise ValueError(f"images of depth {depth}, colour type {colour}, interlacing {interlaced} are not read")
    step = SAMPLES[colour]
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8)
    if len(lines) != height * (width * step + 1):
        raise ValueError("the image has too few or too many lines")
    lines = lines.reshape(height, width * step + 1)
    if lines[:, 0].any():
        above, out = np.zeros(width * step, np.uint8), np.empty((height, width * step), np.uint8)
        for y in range(height):
            out[y] = above = _line(int(lines[y, 0]), lines[y, 1:], above, step)
    else:  # no line is filtered
        out = np.ascontiguousarray(lines[:, 1:])
    pixels = out.reshape(height, width, step)
    if colour == 3:
        return palette[pixels[:, :, 0]]
    return np.repeat(pixels[:, :, :1], 3, axis=2) if colour in (0, 4) else np.ascontiguousarray(pixels[:, :, :3])


def encode(pixels: np.ndarray) -> bytes:
    """A PNG image of height x width x 3 samples."""
    height, width, _ = pixels.shape
    lines = np.zeros((height, 3 * width + 1), np.uint8)
    lines[:, 1:] = pixels.reshape(height, 3 * width)
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return SIGNATURE + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(lines.tobytes(), 6)) + part(b"IEND", b"")


def corners(box: Sequence[Sequence[float]] | None) -> np.ndarray | None:
    """A box's corners in whole pixels; None unless there are at least four, of two numbers each."""
    if box is None or len(box) < 4 or any(p is None or len(p) != 2 or any(v is None or not np.isfinite(v) for v in p) for p in box):
        return None
    return np.array(box, np.float64).astype(np.int64)


def draw_line(pixels: np.ndarray, a: np.ndarray, b: np.ndarray, colour: tuple[int, int, int], reach: float = 1.0) -> None:
    """Colours the pixels within ``reach`` of the stretch from ``a`` to ``b`` (x, y)."""
    height, width, _ = pixels.shape
    low = np.maximum(np.minimum(a, b) - int(reach) - 1, 0)
    high = np.minimum(np.maximum(a, b) + int(reach) + 1, [width - 1, height - 1])
    if (low > high).any():
        return
    y, x = np.mgrid[low[1] : high[1] + 1, low[0] : high[0] + 1]
    along = b - a
    length = float(along @ along)
    t = np.clip(((x - a[0]) * along[0] + (y - a[1]) * along[1]) / length, 0, 1) if length else np.zeros(x.shape)
    near = (x - a[0] - t * along[0]) ** 2 + (y - a[1] - t * along[1]) ** 2 <= reach**2 + 1e-9
    pixels[low[1] : high[1] + 1, low[0] : high[0] + 1][near] = colour


def draw_number(pixels: np.ndarray, text: str, x: int, y: int, colour: tuple[int, int, int]) -> None:
    """Digits with their lower left corner at (x, y), as far as the image goes."""
    for c in text:
        glyph = np.array([[bits >> (2 - k) & 1 for k in range(3)] for bits in DIGITS.get(c, (0,) * 5)], bool)
        glyph = np.kron(glyph, np.ones((LABEL_SCALE, LABEL_SCALE), bool))
        top, left = max(y - len(glyph), 0), max(x, 0)
        part = pixels[top : top + len(glyph), left : left + glyph.shape[1]]
        part[glyph[: part.shape[0], : part.shape[1]]] = colour
        x += 4 * LABEL_SCALE


def drawn(image: bytes, items: Sequence[dict] | None, labels: bool = True) -> tuple[bytes, int]:
    """The image with its items' boxes, and with their scores above them, and how many boxes there are."""
    pixels, n = decode(image).copy(), 0
    for item in items or ():
        box = corners(item.get("bbox"))
        if box is None:
            continue
        n += 1
        for a, b in zip(box, np.roll(box, -1, axis=0), strict=True):
            draw_line(pixels, a, b, BOX)
        if labels:
            draw_number(pixels, f"{item.get('score') or 0:.3f}", int(box[:, 0].min()), max(LABEL_TOP, int(box[:, 1].min()) - 6), LABEL)
    return encode(pixels), n


def overlays(pages: DataFrame, labels: bool = True) -> DataFrame:
    """file_name, page_no, image, boxes and error of each page (file_name, page_no, image, items); a bad image is an error row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            images, boxes, errors = [], [], []
            for image, items in zip(batch.column(2), batch.column(3), strict=True):
                try:
                    made, n = drawn(image.as_py() or b"", items.as_py(), labels)
                except Exception as e:  # noqa: BLE001  one bad page must not end the job
                    made, n = None, None
                    errors.append(f"{type(e).__name__}: {e}")
                else:
                    errors.append(None)
                images.append(made), boxes.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(images, pa.binary()), pa.array(boxes, pa.int32()), pa.array(errors, pa.string())], names=["file_name", "page_no", "image", "boxes", "error"])

    narrow = pages.select("file_name", F.col("page_no").cast("int").alias("page_no"), "image", "items")
    return narrow.mapInArrow(run, "file_name string, page_no int, image binary, boxes int, error string")


def overlay_files(made: DataFrame) -> DataFrame:
    """(name, content) of the drawn pages."""
    name = F.concat("file_name", F.lit("/"), page_name(F.col("page_no")), F.lit("_boxes.png"))
    return made.where("error IS NULL").select(name.alias("name"), F.col("image").alias("content"))
