import hashlib

import pytest
import zstandard
from pyarrow import fs

from tidemark.llm import warc
from tidemark.session import work_dir


def pages():
    big = "<p>" + "x" * 200 + "é</p>"
    return [
        (3, "http://a/3", big), (1, "http://a/1\r\nX: y", big), (2, None, "small"), (4, "", "small"), (5, "http://ü/5", None), (6, "u", ""),
        (7, "u", big), (7, "u", big), (None, "n", big), (8, "u", "y" * 100), (9, "u", "y" * 100), (10, "u", "y" * 99 + "z"), (11, "u", "long " * 200_000),
        (1, "http://a/1", big),
    ]


@pytest.fixture
def archive(spark):
    folder = "file://" + work_dir(spark, "warc-test")
    df = spark.createDataFrame([(*p, "clash", 1) for p in pages()], "page_id bigint, url string, html string, payload string, refers_to int")
    index = warc.write(warc.with_revisits(df.repartition(3), "page_id", "url", "html"), folder, frame_bytes=300, bundle_bytes=5000)
    return index, folder


def test_round_trip(spark, archive):
    index, folder = archive
    got = warc.read(index, folder).collect()
    assert len(got) == len(pages()) == index.count()
    by_text = {}
    for number, _, text in pages():
        if number is not None and len((text or "").encode()) >= 100:
            by_text[text] = min(number, by_text.get(text, number))
    want = []
    for number, url, text in pages():
        raw = (text or "").encode()
        first = by_text.get(text)
        copy = first is not None and number is not None and number > first
        want.append((str(number), "revisit" if copy else "response", url or None, len(raw), hashlib.sha256(raw).hexdigest(), first if copy else None, None if copy else raw))
    rows = [(str(r.record_id), r.record_type, r.target, r.payload_bytes, r.payload_digest, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(rows, key=repr) == sorted(want, key=repr)


def test_single_records_by_seek(archive):
    index, folder = archive
    got = {row[0]: row for row in warc.lookup(index, folder, [8, 9, 11])}
    assert got[8][1] == "response" and got[8][6] == b"y" * 100
    assert (got[9][1], got[9][5], got[9][6]) == ("revisit", 8, None) and len(got[11][6]) == 1_000_000


def test_bundles_are_plain_zstandard_with_a_seek_table(archive):
    index, folder = archive
    system, path = fs.FileSystem.from_uri(folder)
    for row in index.select("bundle").distinct().collect():
        data = system.open_input_stream(f"{path}/{row.bundle}", compression=None).read()
        with system.open_input_file(f"{path}/{row.bundle}") as file:
            frames = warc.seek_table(file, len(data))
        whole = b"".join(zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read(-1) for _ in (0,))
        assert whole.startswith(b"WARC/1.1\r\n") and len(whole) == sum(plain for _, _, plain in frames)
        for at, packed, plain in frames:
            assert zstandard.get_frame_parameters(data[at:]).content_size == plain
    assert index.select("bundle").distinct().count() > 1


def test_empty_table_and_damage(spark, archive):
    folder = "file://" + work_dir(spark, "warc-none")
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    index = warc.write(warc.with_revisits(none, "page_id", "url", "html"), folder)
    assert index.count() == 0 and warc.read(index, folder).count() == 0
    record = warc._record("2024-05-01T12:00:00Z", 1, "u", 3, "0" * 64, None, b"abc")
    with pytest.raises(ValueError, match="digest"):
        list(warc._parsed(record))


def test_records_have_the_mandatory_fields(spark):
    """The four fields that the format asks of every record, and those it asks of revisits."""
    folder = "file://" + work_dir(spark, "warc-fields")
    df = spark.createDataFrame(pages(), "page_id bigint, url string, html string")
    index = warc.write(warc.with_revisits(df, "page_id", "url", "html"), folder, date="2024-05-01T12:00:00Z")
    system, path = fs.FileSystem.from_uri(folder)
    seen = set()
    for (name,) in index.select("bundle").distinct().collect():
        with system.open_input_file(f"{path}/{name}") as file:
            plain = zstandard.ZstdDecompressor().stream_reader(file.read(), read_across_frames=True).read()
        while plain:
            head, _, rest = plain.partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines)
            assert version == "WARC/1.1" and {"WARC-Record-ID", "Content-Length", "WARC-Date", "WARC-Type"} <= set(fields)
            assert fields["WARC-Date"] == "2024-05-01T12:00:00Z" and len(fields) == len(lines)
            if fields["WARC-Type"] == "revisit":
                assert "WARC-Profile" in fields and "WARC-Payload-Digest" in fields
            seen.add(fields["WARC-Type"])
            plain = rest[int(fields["Content-Length"]) + 4 :]
    assert seen == {"response", "revisit"}
    now = warc.write(warc.with_revisits(df.limit(1), "page_id", "url", "html"), "file://" + work_dir(spark, "warc-now"))
    assert now.count() == 1
