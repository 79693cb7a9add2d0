import base64
import hashlib
import io
import zipfile

import pytest
from oracle import compare, connect

from retainframe.llm import warc
from retainframe.llm.queries import QUERIES, SQL


class Memory:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at : at + n]


def archive(wide, comment=b""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, body in (("a.txt", b"first"), ("dir/b.bin", bytes(range(256)) * 10)):
            with z.open(name, "w", force_zip64=wide) as member:
                member.write(body)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("wide", [False, True])
def test_members_are_found_and_read_by_range(wide):
    directory = warc.ZipDirectory(Memory(archive(wide, b"PK\x05\x06 in a comment")))
    assert list(directory.members) == ["a.txt", "dir/b.bin"]
    assert directory.read("a.txt") == b"first"
    assert directory.read("dir/b.bin", 255, 3) == b"\xff\x00\x01"
    with pytest.raises(ValueError):
        directory.read("a.txt", 3, 9)


def test_zip64_directory_with_very_many_members():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for i in range(66_000):
            z.writestr(str(i), b"")
        z.writestr("last", b"found")
    directory = warc.ZipDirectory(Memory(out.getvalue()))
    assert len(directory.members) == 66_001 and directory.read("last") == b"found"


def test_broken_and_compressed_archives_are_refused():
    with pytest.raises(ValueError):
        warc.ZipDirectory(Memory(b"no archive"))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 100)
    with pytest.raises(ValueError):
        warc.ZipDirectory(Memory(out.getvalue())).read("a")


ROWS = [
    (1, "http://a/ b\n", "same"), (2, None, "same"), (3, "http://c", None), (4, "http://d", ""), (5, "http://e", "é😀" * 1000),
    (None, "http://f", "same"), (None, "http://g", "alone"), (7, "http://h", "twice"), (7, "http://h", "twice"),
]


@pytest.mark.parametrize("wide", [False, True])
def test_round_trip(spark, tmp_path, wide):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, sha1 string").repartition(3)
    manifest = warc.write_archives(pages, f"file://{tmp_path}/w", wide=wide)
    got = warc.read_archives(manifest).collect()
    assert len(got) == len(ROWS) == sum(r["records"] for r in manifest.collect())
    by = {}
    for r in got:
        by.setdefault(r["id"], []).append(r)
    digest = base64.b32encode(hashlib.sha1(b"same").digest()).decode()
    assert (by["1"][0]["record_type"], by["1"][0]["refers_to"], by["1"][0]["payload"], by["1"][0]["payload_digest"], by["1"][0]["payload_bytes"]) == ("revisit", "2", None, digest, 4)
    assert (by["2"][0]["record_type"], by["2"][0]["payload"]) == ("response", b"same")
    assert (by["3"][0]["record_type"], by["3"][0]["refers_to"], by["3"][0]["payload_bytes"]) == ("revisit", "4", 0)
    assert by["5"][0]["payload"] == ("é😀" * 1000).encode()
    assert sorted(r["record_type"] for r in by[None]) == ["response", "revisit"]
    assert [r["record_type"] for r in by["7"]] == ["response", "response"]
    large = warc.write_archives(pages, f"file://{tmp_path}/large", least_bytes=5)
    assert {r["id"] for r in warc.read_archives(large).where("record_type = 'revisit'").collect()} == set()


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(pages, f"file://{tmp_path}/n")).count() == 0


def test_archives_are_zip_files(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string")
    path = warc.write_archives(pages, f"file://{tmp_path}/z").first()["path"]
    with zipfile.ZipFile(path.removeprefix("file://")) as z:
        assert z.namelist() == [warc.DATA, warc.INDEX] and z.testzip() is None


def test_query_matches_sql(spark, sf_dir):
    equal, message = compare(QUERIES["op2_zip_archives"](spark, sf_dir), connect(sf_dir), SQL["op2_zip_archives"])
    assert equal, message
