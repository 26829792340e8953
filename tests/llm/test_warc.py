import gzip
import hashlib
import io
import zlib
from pathlib import Path

import pytest

from tidemark.llm import warc

PAGES = "page_id long, url string, html string, digest string, payload string"


def pages(spark):
    big, other = "x" * 1000 + "é", "y" * 5000
    rows = [(1, "http://a/1", big), (7, "http://a/7", big), (3, None, big), (4, "http://b c\r\nX: 1", other), (5, "u", other),
            (5, "u", other), (8, "u", "short"), (9, "u", "short"), (10, "u", ""), (11, "u", None), (None, "u", "z" * 2000),
            (None, "u", "z" * 2000), (None, "u", big)]
    return spark.createDataFrame([(*r, "d", "p") for r in rows], PAGES)


def wanted(rows):
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == body and p is not None]
        keeper = max(same, default=None)
        revisit = len(body) >= 1000 and keeper is not None and page != keeper
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("roll", [1, 1 << 20])
def test_round_trip(spark, scratch, roll):
    df = pages(spark)
    listing = warc.write_archives(warc.plan_records(df, "page_id", "url", "html"), f"{scratch}/in", "2020-01-01T00:00:00Z", roll)
    index = warc.normalise(listing, f"{scratch}/in", f"{scratch}/out")
    found = warc.read_records(index, f"{scratch}/out").drop("url", "payload").collect()
    rows = [(r.page_id, r.url, r.html) for r in df.collect()]
    assert sorted(map(tuple, found), key=str) == wanted(rows)
    for file in Path(f"{scratch}/out").glob("*.warc.gz"):
        data, sidecar = file.read_bytes(), Path(str(file)[: -len(".warc.gz")] + ".idx").read_text().splitlines()
        assert b"".join(gzip.decompress(data[int(o): int(o) + int(n)]) for o, n, *_ in (x.split("\t") for x in sidecar)) == gzip.decompress(data)


def test_members_and_pieces():
    rows = [{"id": i, "url": None, "payload": b"ab" * i * 300, "digest": "d", "size": 600 * i, "type": "response", "refers_to": None} for i in range(20)]
    records = [warc.record_bytes(r, "D") for r in rows]
    one = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = one.compress(b"".join(records[:10])) + one.flush() + b"".join(map(gzip.compress, records[10:]))
    found = [b"".join(raw) for _, raw in warc.split_records(warc.inflate(io.BytesIO(whole), 50))]
    assert found == records


def test_damage_is_noticed():
    record = warc.record_bytes({"id": 1, "url": "u", "payload": b"abc", "digest": "d", "size": 3, "type": "response", "refers_to": None}, "D")
    with pytest.raises(ValueError):
        list(warc.split_records(iter([record[:-6]])))
    with pytest.raises(ValueError):
        list(warc.split_records(iter([b"nonsense\r\n\r\n"])))


def test_empty_table(spark, scratch):
    listing = warc.write_archives(warc.plan_records(pages(spark).limit(0), "page_id", "url", "html"), f"{scratch}/in", "D")
    assert warc.read_records(warc.normalise(listing, f"{scratch}/in", f"{scratch}/out"), f"{scratch}/out").count() == 0
