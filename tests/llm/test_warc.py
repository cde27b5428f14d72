import hashlib

import pytest
from pyspark.sql import functions as F

from perigee.llm.warc import ARC_FIELDS, Stream, arc_to_warc, archive_files, read_arc, read_warc, warc_rows, write_arc
from perigee.session import scratch_path

TRAP = "WARC/1.1\r\n\r\nhttp://x 1.1.1.1 20200101000000 text/html 5\n\r\n\r\n" * 30
PAGES = [
    (1, "http://a/1", "x" * 1500), (2, "http://a/2", "x" * 1500), (3, None, "x" * 1500), (4, "http://a b\n/4", TRAP), (5, "http://é/", TRAP),
    (6, "u", None), (7, "u", ""), (8, "u", "x" * 999), (9, "u", "x" * 999), (9, "u", "x" * 999), (None, "u", "y" * 2000), (11, "u", "z" * 2000), (11, "u", "z" * 2000),
    (12, "u", "é\r\n\t 😀" * 300),
]


@pytest.mark.parametrize("version", ["1", "2"])
def test_round_trip(spark, version):
    pages = spark.createDataFrame([(*p, "q", 1) for p in PAGES], "page_id bigint, url string, html string, digest string, block int").repartition(3)
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, version)
    blocks = []
    for r in archive_files(spark, arc).collect():
        for head, block in read_arc(bytes(r["content"])):
            assert tuple(head) == ARC_FIELDS[version] and int(head["Archive-length"]) == len(block)
            blocks.append(block.split(b"\r\n\r\n", 1)[1])
    assert sorted(blocks) == sorted((h or "").encode() for _, _, h in PAGES)
    arc_to_warc(spark, arc, warc)
    ids = [h["warc-record-id"] for r in archive_files(spark, warc).collect() for h, _ in read_warc(bytes(r["content"]))]
    assert len(ids) == len(PAGES)
    got = sorted((tuple(r) for r in warc_rows(spark, warc).collect()), key=repr)
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "").encode() == data and p is not None]
        first = max(same, default=None) if len(data) >= 1000 else page
        refers = first if page != first else None
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers))
    assert got == sorted(want, key=repr)


def test_streams_over_member_and_piece_limits():
    import gzip
    import random

    rng = random.Random(2)
    lines = [bytes(rng.choices(range(32, 127), k=rng.choice([0, 5, 300_000]))) for _ in range(20)]
    stream = Stream(b"".join(gzip.compress(x + b"\n") for x in lines))
    assert [stream.line() for _ in lines] == lines and stream.line() is None
    with pytest.raises(ValueError):
        Stream(gzip.compress(b"abc")).take(4)


def test_no_pages(spark):
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(spark.createDataFrame([], "page_id bigint, url string, html string"), arc)
    arc_to_warc(spark, arc, warc)
    assert warc_rows(spark, warc).agg(F.count("*")).first()[0] == 0
