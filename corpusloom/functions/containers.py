"""Whether the bytes of an image file hold together, from its header to its end.

Each walker follows its format's structure: chunk lengths and checksums, marker
segments, sub-blocks, directory offsets.  PNG pixel data is inflated, in parts
of bounded size, and measured against the header; the entropy-coded data of
the other formats is not decoded.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable

PART = 1 << 16
PNG_CHANNELS = {0: (1, (1, 2, 4, 8, 16)), 2: (3, (8, 16)), 3: (1, (1, 2, 4, 8)), 4: (2, (8, 16)), 6: (4, (8, 16))}
ADAM7 = [(0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2)]
TIFF_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
BMP_BITS = {1, 4, 8, 16, 24, 32}


class Broken(ValueError):
    """The bytes contradict their format."""


def _need(condition: bool, what: str) -> None:
    if not condition:
        raise Broken(what)


def _at(data: bytes, form: str, place: int) -> tuple:
    try:
        return struct.unpack_from(form, data, place)
    except struct.error:
        raise Broken("truncated") from None


def _png_rows(width: int, height: int, bits: int, interlaced: bool) -> list[tuple[int, int]]:
    """Number of scan lines and bytes of one, for each pass."""
    passes = ADAM7 if interlaced else [(0, 0, 1, 1)]
    sizes = [(-(-(height - y) // dy), -(-(width - x) // dx)) for x, y, dx, dy in passes if width > x and height > y]
    return [(lines, 1 + (pixels * bits + 7) // 8) for lines, pixels in sizes if lines > 0 and pixels > 0]


def png(data: bytes) -> None:
    at, header, palette, ended = 8, None, False, False
    inflate, made, over = zlib.decompressobj(), 0, False
    while not ended:
        size, kind = _at(data, ">I4s", at)
        _need(size < 1 << 31, "length")
        body = data[at + 8: at + 8 + size]
        _need(len(body) == size, "truncated")
        _need(_at(data, ">I", at + 8 + size)[0] == zlib.crc32(body, zlib.crc32(kind)), "checksum")
        _need((kind == b"IHDR") == (header is None), "header")
        if kind == b"IHDR":
            _need(size == 13, "header")
            width, height, depth, colour, packing, method, interlaced = _at(body, ">IIBBBBB", 0)
            _need(0 < width < 1 << 31 and 0 < height < 1 << 31 and packing == method == 0 and interlaced < 2, "header")
            _need(colour in PNG_CHANNELS and depth in PNG_CHANNELS[colour][1], "header")
            header = _png_rows(width, height, depth * PNG_CHANNELS[colour][0], interlaced == 1)
            wanted, three = sum(lines * row for lines, row in header), colour == 3
        elif kind == b"PLTE":
            palette = size % 3 == 0 and 0 < size <= 768
            _need(palette, "palette")
        elif kind == b"IDAT":
            _need(palette or not three, "palette")
            while body and not over:
                try:
                    part = inflate.decompress(body, PART)
                except zlib.error:
                    raise Broken("pixels") from None
                made, body, over = made + len(part), inflate.unconsumed_tail, inflate.eof
                _need(made <= wanted, "pixels")
        ended, at = kind == b"IEND", at + 12 + size
    _need(over and made == wanted, "pixels")


def jpeg(data: bytes) -> None:
    at, framed, scanned = 2, False, False
    marker = re.compile(rb"\xff+[^\x00\xff\xd0-\xd7]")
    while True:
        start, = _at(data, "B", at)
        _need(start == 0xFF, "marker")
        while _at(data, "B", at)[0] == 0xFF:
            at += 1
        code, = _at(data, "B", at)
        at += 1
        if code == 0xD9:
            _need(framed and scanned, "no picture")
            return
        if code == 1 or 0xD0 <= code <= 0xD8:
            _need(code != 0xD8, "marker")
            continue
        _need(code >= 0xC0, "marker")
        size, = _at(data, ">H", at)
        _need(size >= 2, "length")
        _need(at + size <= len(data), "truncated")
        if 0xC0 <= code <= 0xCF and code not in (0xC4, 0xC8, 0xCC):
            depth, _, width, parts = _at(data, ">BHHB", at + 2)
            _need(depth in (8, 12, 16) and width > 0 and parts > 0 and size == 8 + 3 * parts, "frame")
            framed = True
        at += size
        if code == 0xDA:
            _need(framed, "frame")
            follows = marker.search(data, at)
            _need(follows is not None, "truncated")
            at, scanned = follows.start(), True


def _sub_blocks(data: bytes, at: int) -> tuple[int, int]:
    """Where a list of sub-blocks ends, and how many bytes it holds."""
    held = 0
    while True:
        size, = _at(data, "B", at)
        at += 1 + size
        if size == 0:
            return at, held
        held += size


def gif(data: bytes) -> None:
    width, height, flags = _at(data, "<HHB", 6)
    at, pictures = 13 + (3 << (1 + (flags & 7)) if flags & 0x80 else 0), 0
    while True:
        kind, = _at(data, "B", at)
        if kind == 0x3B:
            _need(pictures > 0, "no picture")
            return
        if kind == 0x21:
            at, _ = _sub_blocks(data, at + 2)
            continue
        _need(kind == 0x2C, "block")
        _, _, own_width, own_height, flags = _at(data, "<HHHHB", at + 1)
        _need(own_width > 0 and own_height > 0, "picture")
        at += 10 + (3 << (1 + (flags & 7)) if flags & 0x80 else 0)
        bits, = _at(data, "B", at)
        _need(1 <= bits <= 11, "picture")
        at, held = _sub_blocks(data, at + 1)
        _need(held > 0, "picture")
        pictures += 1


def webp(data: bytes) -> None:
    size, = _at(data, "<I", 4)
    _need(size + 8 <= len(data), "truncated")
    end, at, pictures = size + 8, 12, 0
    while at < end:
        kind, size = _at(data, "<4sI", at)
        body = at + 8
        _need(body + size <= end, "truncated")
        if kind == b"VP8 ":
            _need(size >= 10 and data[body + 3: body + 6] == b"\x9d\x01\x2a", "frame")
            width, height = _at(data, "<HH", body + 6)
            _need(width & 0x3FFF and height & 0x3FFF, "frame")
            pictures += 1
        elif kind == b"VP8L":
            _need(size >= 5 and data[body] == 0x2F, "frame")
            pictures += 1
        elif kind == b"ANMF":
            pictures += 1
        at = body + size + (size & 1)
    _need(pictures > 0, "no picture")


def bmp(data: bytes) -> None:
    start, own = _at(data, "<II", 10)
    if own == 12:
        width, height, planes, bits = _at(data, "<HHHH", 18)
        packing = 0
    else:
        width, height, planes, bits, packing, packed = _at(data, "<iiHHII", 18)
    _need(width > 0 and height != 0 and planes == 1 and start >= 14 + own, "header")
    _need(bits in BMP_BITS or packing in (4, 5), "header")
    held = len(data) - start
    if packing in (0, 3, 6):
        _need((bits * width + 31) // 32 * 4 * abs(height) <= held, "truncated")
    else:
        _need(0 < packed <= held, "truncated")


def tiff(data: bytes) -> None:
    order = "<" if data[:2] == b"II" else ">"
    at, = _at(data, f"{order}I", 4)
    seen: set[int] = set()
    while at:
        _need(at not in seen, "loop")
        seen.add(at)
        entries, = _at(data, f"{order}H", at)
        _need(entries > 0, "directory")
        tags: dict[int, tuple] = {}
        for i in range(entries):
            tag, kind, count, value = _at(data, f"{order}HHII", at + 2 + 12 * i)
            size = TIFF_SIZES.get(kind, 1) * count
            place = at + 10 + 12 * i if size <= 4 else value
            _need(place + size <= len(data), "truncated")
            if tag in (256, 257, 273, 279, 324, 325):
                _need(kind in (3, 4) and count > 0, "directory")
                tags[tag] = _at(data, f"{order}{count}{'H' if kind == 3 else 'I'}", place)
        _need(256 in tags and 257 in tags and tags[256][0] > 0 and tags[257][0] > 0, "directory")
        places, sizes = (tags.get(273), tags.get(279)) if 273 in tags else (tags.get(324), tags.get(325))
        _need(places is not None and sizes is not None and len(places) == len(sizes), "directory")
        _need(all(p + s <= len(data) for p, s in zip(places, sizes)) and sum(sizes) > 0, "truncated")
        at, = _at(data, f"{order}I", at + 2 + 12 * entries)
    _need(bool(seen), "directory")


# The first bytes of each format.
WALKERS: list[tuple[str, re.Pattern, Callable[[bytes], None]]] = [
    ("png", re.compile(rb"\x89PNG\r\n\x1a\n"), png),
    ("jpeg", re.compile(rb"\xff\xd8\xff"), jpeg),
    ("gif", re.compile(rb"GIF8[79]a"), gif),
    ("webp", re.compile(rb"RIFF[\s\S]{4}WEBP"), webp),
    ("bmp", re.compile(rb"BM[\s\S]{4}\0\0\0\0"), bmp),
    ("tiff", re.compile(rb"II\*\0|MM\0\*"), tiff),
]


def image_state(data: bytes | None) -> tuple[str, str | None]:
    """The format of some bytes and what is wrong with them, None if nothing is."""
    if not data:
        return "none", "empty"
    for name, begins, walk in WALKERS:
        if begins.match(data):
            try:
                walk(data)
            except Broken as problem:
                return name, str(problem)
            return name, None
    return "unknown", "format"
