"""Orientation in all eight ways and from three kinds of files, crops, review pages, and the store of texts."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from attestor.schema import SCAN_RESULT, conform
from attestor.sources import images, sinks


def tiff(turned, order="<", kind=3):
    entry = struct.pack(order + "HHI", 0x0112, kind, 1) + (struct.pack(order + "HH", turned, 0) if kind == 3 else struct.pack(order + "I", turned))
    other = struct.pack(order + "HHII", 0x010F, 2, 4, 0)
    return (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(order + "IH", 8, 2) + other + entry + struct.pack(order + "I", 0)


def jpeg(body):
    exif = b"Exif\0\0" + body
    return b"\xff\xd8" + b"\xff\xe0" + struct.pack(">H", 6) + b"JFIF" + b"\xff" + b"\xff\xe1" + struct.pack(">H", 2 + len(exif)) + exif + b"\xff\xda\0\0"


@pytest.mark.parametrize("turned", range(1, 9))
def test_orientation(turned):
    for order in "<>":
        for kind in (3, 4):
            assert images.orientation(tiff(turned, order, kind)) == images.orientation(jpeg(tiff(turned, order, kind))) == turned
    plain = images.png(np.zeros((2, 2), np.uint8))
    assert images.orientation(plain) == 1
    body = tiff(turned)
    with_exif = plain[:33] + struct.pack(">I", len(body)) + b"eXIf" + body + b"\0\0\0\0" + plain[33:]
    assert images.orientation(with_exif) == turned
    # How each is stored: the seen image's rows and columns as the standard names them.
    seen = np.arange(6).reshape(2, 3)
    stored = {1: seen, 2: seen[:, ::-1], 3: seen[::-1, ::-1], 4: seen[::-1], 5: seen.T, 6: np.rot90(seen, 1), 7: seen[::-1, ::-1].T, 8: np.rot90(seen, -1)}[turned]
    assert (images.upright(stored, turned) == seen).all()


def test_files_that_say_nothing():
    for data in (b"", b"\xff\xd8", b"\xff\xd8\xff\xe1\0", b"II*\0\xff\xff\xff\xff", jpeg(tiff(9)), jpeg(b"junk"), b"\x89PNG\r\n\x1a\n\0\0", b"GIF89a", tiff(3)[:20]):
        assert images.orientation(data) == 1


def pixels(data):
    """The array of a PNG without row filters."""
    width, height, _, kind = struct.unpack(">IIBB", data[16:26])
    at = data.index(b"IDAT")
    (size,) = struct.unpack(">I", data[at - 4 : at])
    rows = np.frombuffer(zlib.decompress(data[at + 4 : at + 4 + size]), np.uint8).reshape(height, -1)[:, 1:]
    return rows.reshape(height, width, 3) if kind == 2 else rows


def test_crops_and_review_pages(spark):
    page = np.random.default_rng(1).integers(0, 256, (40, 60, 3), np.uint8)
    lying = np.rot90(page, 1)  # orientation 6
    files = {"image1.png": jpeg(tiff(6)), "image2.png": jpeg(tiff(1)), "image3.png": b"broken"}

    def decode(data):
        if data == b"broken":
            raise OSError("no image")
        return lying if data == files["image1.png"] else page

    content = spark.createDataFrame([("a", n, b) for n, b in files.items()], "source_docx string, image_name string, content binary")
    rows = [("a", "image1.png", "a_1_mol", "a_1_permit", "permit_lower"), ("a", "image2.png", "", "a_2_permit", "permit_upper"), ("a", "image3.png", "a_3_mol", "", "mol"), ("a", "image9.png", "a_9_mol", "", "mol")]
    results = conform(spark.createDataFrame(rows, "source_docx string, image_name string, mol_crop string, permit_crop string, hit_roi string"), SCAN_RESULT)
    got = {r["crop"]: (r["content"], r["error"]) for r in sinks.crops(results, content, decode).collect()}
    assert sorted(got) == ["a_1_mol", "a_1_permit", "a_2_permit", "a_3_mol"]
    for name, box in (("a_1_mol", "mol"), ("a_1_permit", "permit_lower"), ("a_2_permit", "permit_upper")):
        assert (pixels(bytes(got[name][0])) == images.crop(page, sinks.REGIONS[box])).all()
    assert got["a_3_mol"] == (None, "OSError: no image")
    pages = spark.createDataFrame([("a", f"image{i}.png", i, "large") for i in (1, 2, 3)] + [("b", "image3.png", 3, "small")], "source_docx string, image_name string, image_index int, docx_class string")
    both = content.unionByName(content.where("image_name = 'image3.png'").withColumn("source_docx", F.lit("b")))
    assert sorted((r["source_docx"], r["image_name"]) for r in sinks.review_pages(pages, both).collect()) == [("a", "image2.png"), ("b", "image3.png")]


def test_texts_are_stored_once(spark, tmp_path):
    path = f"file://{tmp_path}/texts"
    rows = spark.createDataFrame([("a", "image1.png", "one\ntwo"), ("a", "image1.png", "one\ntwo"), ("a", "image2.png", "")], "source_docx string, image_name string, text string")
    assert [sinks.write_texts(rows, path, run) for run in ("1", "1", "2")] == [2, 0, 0]
    assert sorted((r["image_name"], r["text"]) for r in sinks.texts(spark, path).rows().collect()) == [("image1.png", "one\ntwo"), ("image2.png", "")]
