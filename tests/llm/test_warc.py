"""Archives: exact round trip, one member per record, revisits."""

import gzip
import hashlib
import io
import json
import tempfile
import zlib

from fitloom.llm import warc
from fitloom.llm.store import saved


def test_round_trip(spark):
    big = "é" * 700
    pages = [(1, "http://a", big), (2, None, big), (3, "http://b\nx", None), (4, "u", ""), (None, "u", "x"), (5, "u", "short"), (6, "v", "short"),
             (7, "u", "WARC/1.0\r\n\r\nContent-Length: 3\r\n\r\n"), (8, "u", "z" * 3_000_000), (2, None, big)]
    frame = spark.createDataFrame([(*p, "e") for p in pages], "page_id long, url string, html string, archive string").repartition(2)
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = saved(warc.write_monolithic(frame, folder, roll_bytes=2_000_000), "t")
    done = saved(warc.normalise(warc.revisits(rows), folder), "t")
    got = sorted(map(tuple, warc.read_members(done, folder).collect()), key=str)
    want = []
    for page, _, html in pages:
        body = (html or "").encode()
        again = len(body) >= 1000 and body == big.encode() and page != 2
        want.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", 2 if again else None))
    assert got == sorted(want, key=str)
    for r in done.collect():  # the index gives whole members, and the file as a whole is still one gzip stream
        raw = open(f"{folder}/{r.archive}", "rb").read()
        lines = [json.loads(x) for x in open(f"{folder}/{r.archive}.idx")]
        assert len(lines) == r.n and sum(x["length"] for x in lines) == len(raw)
        members = [zlib.decompress(raw[x["offset"] : x["offset"] + x["length"]], 31) for x in lines]
        assert b"".join(members) == gzip.decompress(raw)
        assert list(warc.records(io.BytesIO(raw))) == members
    assert warc.write_monolithic(frame.limit(0), folder + "/none").count() == 0
