import io
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from streamtab.llm import warc
from tests.llm.helpers import listed

PAGES = [
    (5, "http://a\r\nX: y", "<p>é\r\n\r\n</p>", "k"),
    (3, "http://b", "<p>é\r\n\r\n</p>", "k"),
    (9, None, "<p>é\r\n\r\n</p>", "k"),
    (3, "http://b", "<p>é\r\n\r\n</p>", "k"),
    (1, "http://c", None, "k"),
    (2, "http://d", "", "k"),
    (None, "http://e", "", "k"),
    (None, "http://f", "only", "k"),
    (-7, "http://g", "x" * 300000, "k"),
]
SCHEMA = "page_id long, url string, html string, refers_to string"


def expected(least):
    out = []
    for page, _, html, _ in PAGES:
        data = (html or "").encode()
        first = min([p for p, _, h, _ in PAGES if (h or "") == (html or "") and p is not None], default=None)
        revisit = len(data) >= least and page is not None and first < page
        out.append((page, len(data), warc.digest(data), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least,max_bytes", [(0, 1 << 30), (5, 1 << 30), (0, 200)])
def test_round_trip(spark, least, max_bytes):
    df = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    manifest = warc.write_archives(spark, warc.mark_revisits(spark, df, least), max_bytes=max_bytes)
    got = warc.read_archives(manifest)
    assert listed(got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == expected(least)
    texts = {(r["page_id"], bytes(r["payload"]).decode()) for r in got.where("record_type = 'response'").collect()}
    assert texts <= {(p, h or "") for p, _, h, _ in PAGES}


def test_empty_table(spark):
    manifest = warc.write_archives(spark, warc.mark_revisits(spark, spark.createDataFrame([], SCHEMA)))
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0


def packed(*records):
    out = b""
    for r in records:
        pack = zlib.compressobj(6, wbits=31)
        out += pack.compress(r) + pack.flush()
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=300), min_size=1, max_size=4), st.integers(1, 64))
def test_members_whatever_the_chunk(payloads, chunk):
    records = [warc.record(i, "u", p, None, "d", False) for i, p in enumerate(payloads)]
    got = [warc.parse(raw) for raw in warc.members(io.BytesIO(packed(*records)), chunk)]
    assert [g["payload"] for g in got] == payloads and [g["page_id"] for g in got] == list(range(len(payloads)))


def test_damage_is_noticed():
    record = warc.record(1, "u", b"payload", None, "d", False)
    for broken in (record.replace(b"payload\r\n", b"pay1oad\r\n"), record[:-1], record + b"x", record.replace(b"Content-Length: 7", b"Content-Length: 8")):
        with pytest.raises(ValueError):
            warc.parse(broken)
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(packed(record)[:-4])))
