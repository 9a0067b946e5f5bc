"""Walks over image files, whole, cut off and damaged."""

import struct
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.containers import image_state
from corpusloom.sources import images


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def make_png(width=5, height=4, depth=8, colour=2, interlaced=0, lines=None, parts=1, palette=b""):
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    if lines is None:
        row = (width * depth * channels + 7) // 8
        lines = b"".join(b"\0" + bytes((x * 7 + y) % 256 for x in range(row)) for y in range(height))
    packed = zlib.compress(lines)
    step = -(-len(packed) // parts)
    body = b"".join(chunk(b"IDAT", packed[i:i + step]) for i in range(0, len(packed), step))
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, interlaced))
            + (chunk(b"PLTE", palette) if palette else b"") + body + chunk(b"IEND", b""))


def make_jpeg():
    def part(code, body):
        return bytes([0xFF, code]) + struct.pack(">H", len(body) + 2) + body
    return (b"\xff\xd8" + part(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0") + part(0xDB, bytes(65))
            + part(0xC0, struct.pack(">BHHB", 8, 3, 4, 1) + b"\x01\x11\0") + part(0xC4, bytes(19) + b"\x01")
            + part(0xDA, b"\x01\x01\0\0\x3f\0") + b"\x12\xff\x00\x34\xff\xd0\x56\x78" + b"\xff\xd9")


def make_gif(pictures=2):
    own = b"," + struct.pack("<HHHHB", 0, 0, 2, 2, 0x80) + bytes(6) + b"\x02" + b"\x03abc" + b"\x01d" + b"\0"
    return (b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0x81, 0, 0) + bytes(12)
            + b"!\xf9\x04\0\0\0\0\0" + own * pictures + b"!\xfe\x02hi\0" + b";")


def make_bmp(width=5, height=-3, bits=24):
    row = (bits * width + 31) // 32 * 4
    return (b"BM" + struct.pack("<IHHI", 54 + row * abs(height), 0, 0, 54)
            + struct.pack("<IiiHHIIiiII", 40, width, height, 1, bits, 0, row * abs(height), 0, 0, 0, 0) + bytes(row * abs(height)))


def make_webp(kind=b"VP8L"):
    body = b"\x2f" + bytes(6) if kind == b"VP8L" else bytes(3) + b"\x9d\x01\x2a" + struct.pack("<HH", 9, 8) + b"xyz"
    inner = b"WEBP" + b"VP8X" + struct.pack("<I", 10) + bytes(10) + kind + struct.pack("<I", len(body)) + body + bytes(len(body) & 1)
    return b"RIFF" + struct.pack("<I", len(inner)) + inner


def make_tiff(order="<"):
    entries = [(256, 3, 1, 4), (257, 3, 1, 2), (273, 4, 1, 100), (279, 4, 1, 8)]
    mark = b"II*\0" if order == "<" else b"MM\0*"
    body = mark + struct.pack(f"{order}I", 8) + struct.pack(f"{order}H", len(entries))
    for tag, kind, count, value in entries:
        body += struct.pack(f"{order}HHI", tag, kind, count) + (
            struct.pack(f"{order}HH", value, 0) if kind == 3 else struct.pack(f"{order}I", value))
    return (body + struct.pack(f"{order}I", 0)).ljust(100, b"\0") + bytes(8)


SOUND = {
    "png": make_png(), "png parts": make_png(40, 30, parts=7), "png grey": make_png(9, 9, 1, 0),
    "png palette": make_png(6, 5, 2, 3, palette=bytes(12)),
    "png interlaced": make_png(3, 3, 8, 0, 1, lines=b"\0a" + b"\0b" + b"\0cd" + b"\0e\0f" + b"\0ghi"),
    "jpeg": make_jpeg(), "gif": make_gif(), "bmp": make_bmp(), "bmp up": make_bmp(7, 2, 1), "webp": make_webp(),
    "webp lossy": make_webp(b"VP8 "), "tiff": make_tiff(), "tiff big": make_tiff(">"),
}


@pytest.mark.parametrize("name", SOUND)
def test_whole_files_are_sound(name):
    assert image_state(SOUND[name]) == (name.split()[0], None)


@pytest.mark.parametrize("name", SOUND)
def test_every_cut_is_noticed(name):
    data = SOUND[name]
    for size in range(len(data)):
        assert image_state(data[:size])[1] is not None, size


def test_every_changed_byte_of_a_png_is_noticed():
    for name in ("png", "png palette", "png interlaced"):
        data = SOUND[name]
        for at in range(len(data)):
            assert image_state(data[:at] + bytes([data[at] ^ 0x55]) + data[at + 1:])[1] is not None, at


@pytest.mark.parametrize("data", [
    make_png(lines=b"\0" * 10), make_png(lines=b"\0" * 1000), make_png(0, 4), make_png(depth=3), make_png(6, 5, 2, 3),
    make_gif(0), make_bmp(0, 3), make_bmp(5, 0), make_webp().replace(b"VP8L", b"ICCP"), make_jpeg().replace(b"\xff\xc0", b"\xff\xe1"),
    make_jpeg().replace(b"\xff\xda", b"\xff\xe2"), make_tiff()[:4] + struct.pack("<I", 0) + make_tiff()[8:],
    b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 1) + bytes(12) + struct.pack("<I", 8), b"plain text", b"", None,
])
def test_damage_of_other_kinds(data):
    assert image_state(data)[1] is not None


def test_rows_are_dropped_with_a_count(spark):
    files = [(i, bytearray(data)) for i, data in enumerate(SOUND.values())]
    cut = [(100 + i, bytearray(data[:-1])) for i, data in enumerate(SOUND.values())]
    df = spark.createDataFrame(files + cut + [(200, None), (201, bytearray(b"text"))], "i int, image binary")
    assert sorted(r.i for r in images.keep_sound(df).collect()) == list(range(len(files)))
    report = {(r.format, r.problem is None): 0 for r in images.damage_report(df).collect()}
    for r in images.damage_report(df).collect():
        report[r.format, r.problem is None] += r.n_rows
    assert report == {
        ("png", True): 5, ("png", False): 5, ("jpeg", True): 1, ("jpeg", False): 1, ("gif", True): 1, ("gif", False): 1,
        ("bmp", True): 2, ("bmp", False): 2, ("webp", True): 2, ("webp", False): 2, ("tiff", True): 2, ("tiff", False): 2,
        ("none", False): 1, ("unknown", False): 1}
    paths = spark.createDataFrame([(0, "a"), (1, "gone"), (2, None)], "i int, image string")
    found = spark.createDataFrame([("a", files[0][1])], "path string, content binary")
    assert [r.i for r in images.keep_sound(paths, files=found).collect()] == [0]
    packed = df.select("i", F.struct(F.col("image").alias("bytes"), F.lit(None).cast("string").alias("path")).alias("image"))
    assert images.keep_sound(packed).count() == len(files)
    with pytest.raises(ValueError):
        images.image_states(paths)


def test_the_reader_of_the_engine_agrees(spark, tmp_path):
    """Files that hold together are decoded by the image source; it drops those that are cut off inside the pixels."""
    for name in ("png", "png parts", "png grey", "png palette", "bmp"):
        (tmp_path / f"{name.replace(' ', '_')}.png").write_bytes(SOUND[name])
    (tmp_path / "cut.png").write_bytes(SOUND["png"][:60])
    assert images.read_images(spark, str(tmp_path)).count() == 5
