import base64
import gzip
import hashlib
import os

from brute import rows_of
from daybook.llm import warc

FIELDS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def want(pages, least=0):
    out = []
    for page, html in pages:
        data = (html or "").encode()
        equal = [p for p, h in pages if p is not None and (h or "").encode() == data and len(data) >= least]
        last = max(equal, default=None)
        again = page is not None and last is not None and last > page
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "revisit" if again else "response", last if again else None))
    return out


def frame(spark, pages):
    rows = [(p, f"http://x/{p}", h, "extra", 1) for p, h in pages]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, payload string, again int").repartition(3)


PAGES = [
    (1, "<p>é</p>"),
    (2, "<p>é</p>"),
    (3, None),
    (4, ""),
    (5, "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nb"),
    (7, "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nb"),
    (6, "one\nonly\r\n\r\n"),
    (9, "<p>é</p>"),
    (None, "<p>é</p>"),
    (9, "<p>é</p>"),
    (10, "x" * 3_000_000),
    (11, "\x00\x01 � 漢"),
]


def test_round_trip(spark, tmp_path):
    got = warc.deduplicated(frame(spark, PAGES))
    assert rows_of(got.select(*FIELDS)) == rows_of(spark.createDataFrame(want(PAGES), got.select(*FIELDS).schema))
    assert all(r.sound for r in got.collect())
    assert warc.deduplicated(frame(spark, [])).count() == 0


def test_records(spark, tmp_path):
    path = str(tmp_path / "warc")
    pages = spark.createDataFrame([(1, "http://x/\r\nbad: 1", "same"), (2, None, "same")], warc.PAGE)
    warc.write_archives(pages, path, date="2026-02-03T04:05:06Z")
    held = {}
    for name in os.listdir(path):
        if name.endswith(".gz"):
            for fields, block in warc.parse(gzip.open(f"{path}/{name}").read()):
                held[fields["Page-ID"]] = (fields, block)
    first, second = held["1"], held["2"]
    assert first[0]["WARC-Type"] == "revisit" and first[0]["WARC-Profile"] == warc.PROFILE
    assert first[0]["WARC-Refers-To"] == second[0]["WARC-Record-ID"]
    assert first[0]["WARC-Target-URI"] == "http://x/bad:1" and "WARC-Target-URI" not in second[0]
    assert second[1].endswith(b"\r\n\r\nsame") and first[1].endswith(b"\r\n\r\n")
    assert {f["WARC-Date"] for f, _ in held.values()} == {"2026-02-03T04:05:06Z"}
    # Payloads below the least size are not replaced.
    warc.write_archives(pages, path + "2", least=5)
    assert {r.record_type for r in warc.read_headers(spark, path + "2").collect()} == {"response"}
