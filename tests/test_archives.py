"""Archives by range: what is read is what the tier needs, and damage stays with its page."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from attestor.sources import archives, documents

SIZE = 20_000


def page(name, doc):
    """Bytes that don't shrink when packed, so that bytes read tell which pages were."""
    import hashlib

    seed, out = f"{doc}/{name}".encode(), b""
    while len(out) < SIZE:
        seed = hashlib.sha256(seed).digest()
        out += seed
    return name.encode() + b"|" + doc.encode() + b"|" + out


def docx(folder, doc, names, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(folder / doc, "w", method) as z:
        z.writestr("word/document.xml", b"<x/>" * 50_000)
        for n in names:
            z.writestr(f"word/media/{n}", page(n, doc))
    return (folder / doc).stat().st_size


@pytest.fixture
def reader():
    def read(content, settings):  # sent to the workers by value
        name, doc, _ = content.split(b"|", 2)
        return ("No. izin: 1234", 80.0) if (name, doc) == (b"image2.png", b"sure one.docx") else ("", 0.0)

    return read


NAMES = [f"image{i}.png" for i in range(1, 9)]


def test_a_tier_reads_its_share(spark, tmp_path, reader):
    sizes = {d: docx(tmp_path, d, NAMES) for d in ("sure one.docx", "open+%41.docx")}
    docx(tmp_path, "small.docx", NAMES[:2])
    readings, read = archives.scan(spark, f"file://{tmp_path}", documents.config_table(spark), reader)
    pages = {}
    for r in read.collect():
        pages.setdefault(r["source_docx"], {})[r["image_name"]] = (r["bytes_read"], r["error"])
    assert sorted(pages["sure one.docx"]) == ["", "image2.png", "image5.png", "image6.png"]
    assert sorted(pages["open+%41.docx"]) == ["", *NAMES]
    assert sorted(pages["small.docx"]) == ["", "image1.png", "image2.png"]
    assert all(SIZE < given < SIZE + 400 for d in pages.values() for n, (given, _) in d.items() if n)
    assert sum(b for b, _ in pages["sure one.docx"].values()) < 3.2 / 8 * sizes["sure one.docx"] + 2_000
    assert {r["source_docx"] for r in readings.where("text <> ''").collect()} == {"sure one.docx"}
    everything, read = archives.scan(spark, f"file://{tmp_path}", documents.config_table(spark), reader, whole=True)
    assert read.where("image_name <> ''").count() == 18
    assert sorted(r["source_docx"] for r in everything.select("source_docx", "image_name").distinct().collect()) == sorted(["small.docx"] * 2 + ["sure one.docx"] * 8 + ["open+%41.docx"] * 8)


def test_one_document_and_one_image(spark, tmp_path, reader):
    docx(tmp_path, "a.docx", NAMES)
    docx(tmp_path, "b.docx", NAMES)
    configs = documents.config_table(spark, "mol")
    _, read = archives.scan(spark, f"file://{tmp_path}", configs, reader, source="b.docx")
    assert {r["source_docx"] for r in read.collect()} == {"b.docx"}
    readings, read = archives.scan(spark, f"file://{tmp_path}", configs, reader, source="b.docx", image="image5.png")
    assert sorted(r["image_name"] for r in read.collect()) == ["", "image5.png"]
    assert {r["image_name"] for r in readings.collect()} == {"image5.png"}
    with pytest.raises(ValueError, match="name that too"):
        archives.scan(spark, f"file://{tmp_path}", configs, reader, image="image5.png")
    none, _ = archives.scan(spark, f"file://{tmp_path}", configs, reader, source="b.docx", image="image77.png")
    assert none.count() == 0


def test_lists_and_contents_agree_with_whole_files(spark, tmp_path):
    docx(tmp_path, "packed.docx", NAMES)
    docx(tmp_path, "stored.docx", NAMES[:3], zipfile.ZIP_STORED)
    docx(tmp_path, "odd.docx", NAMES[:1], zipfile.ZIP_LZMA)
    (tmp_path / "no.docx").write_bytes(b"no archive")
    (tmp_path / "empty.docx").write_bytes(b"")
    cut = docx(tmp_path, "damaged.docx", NAMES[:2])
    raw = bytearray((tmp_path / "damaged.docx").read_bytes())
    at = raw.index(b"image1.png") + 200
    raw[at : at + 40] = os.urandom(40)
    (tmp_path / "damaged.docx").write_bytes(raw)
    assert cut == len(raw)
    folder = f"file://{tmp_path}"
    listed = archives.page_list(archives.files(spark, folder))
    got = {(r["source_docx"], r["image_name"]): (r["content"], r["error"] == "") for r in archives.page_contents(listed).collect()}
    whole = {(r["source_docx"], r["image_name"]): (r["content"], r["error"] == "") for r in documents.page_images(documents.documents(spark, folder)).collect()}
    odd = ("odd.docx", "image1.png")
    assert whole.pop(odd)[1] and got.pop(odd) == (None, False)
    assert got == whole
    assert got["damaged.docx", "image1.png"] == (None, False) and got["damaged.docx", "image2.png"][1]
    assert not got["no.docx", ""][1]
    assert listed.where(F.col("source_docx") == "packed.docx").agg(F.sum("bytes_read")).first()[0] < 2_000
