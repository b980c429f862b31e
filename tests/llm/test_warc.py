import base64
import glob
import gzip
import hashlib

import pytest

from tickbars.llm.warc import Gap, Record, WarcSpec, _member, _row, read_archive, read_archives, record_bytes, write_archives
from tickbars.sources.paths import scratch_dir

SPEC = WarcSpec()
BIG = "x" * 1200


def test_pages_come_back(spark):
    rows = [
        (1, "http://a/", BIG), (2, "http://b c/é\n", BIG), (3, None, BIG), (3, "http://d/", BIG), (None, "n", BIG),
        (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", "WARC/1.1\r\nWARC-Type: x\r\n\r\n"),
        (9, "u", "ß" * 200_000), (10, "u", BIG + "y"),
    ]
    folder = scratch_dir(spark, "warc-test")
    write_archives(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int"), folder, WarcSpec(records=3))
    records, gaps = read_archives(spark, folder)
    want = []
    for page_id, url, html in rows:
        payload = (html or "").encode()
        revisit = html == BIG and page_id != 3
        want.append((page_id, url, "revisit" if revisit else "response", 3 if revisit else None, hashlib.sha1(payload).hexdigest(), len(payload)))
    found = records.select("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert gaps.count() == 0
    # Any gzip reader takes the archives.
    files = glob.glob(folder + "/part-*")
    assert len(files) > 3
    whole = b"".join(gzip.decompress(open(f, "rb").read()) for f in files)
    assert whole.count(b"WARC-Record-ID") == len(rows)


def test_no_pages(spark):
    folder = scratch_dir(spark, "warc-test")
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    records, gaps = read_archives(spark, folder)
    assert records.count() == gaps.count() == 0


def archive(packed):
    records = [record_bytes(i, "u", f"payload {i} WARC/1.1 ".encode() * 40, None, SPEC) for i in range(6)]
    return [_member(r) if packed else r for r in records]


@pytest.mark.parametrize("packed", [True, False])
def test_damage_costs_the_damaged_records_only(packed):
    parts = archive(packed)
    starts = [sum(map(len, parts[:k])) for k in range(7)]
    whole = bytearray(b"".join(parts))
    middle = starts[2] + len(parts[2]) // 2
    whole[middle : middle + 3] = b"\0\xff\0"
    found = list(read_archive(bytes(whole)))
    assert [_row(r)[0] for r in found if isinstance(r, Record)] == [0, 1, 3, 4, 5]
    assert [(g.start, g.end) for g in found if isinstance(g, Gap)] == [(starts[2], starts[3])]


@pytest.mark.parametrize("packed", [True, False])
def test_truncated_and_mixed_archives(packed):
    parts = archive(packed)
    cut = b"".join(parts)[:-30]
    found = list(read_archive(b"junk" + cut))
    assert [_row(r)[0] for r in found if isinstance(r, Record)] == [0, 1, 2, 3, 4]
    gaps = [(g.start, g.end) for g in found if isinstance(g, Gap)]
    assert gaps == [(0, 4), (4 + len(cut) - len(parts[5]) + 30, 4 + len(cut))]
    assert list(read_archive(b"")) == [] and list(read_archive(b"\r\n\r\n")) == []
    assert [type(x) for x in read_archive(b"no archive")] == [Gap]


def test_both_forms_in_one_archive():
    found = list(read_archive(archive(True)[0] + archive(False)[1] + b"\r\n" + archive(True)[2]))
    assert [_row(r)[0] for r in found] == [0, 1, 2]


def foreign(*headers, block=b"HTTP/1.1 200 OK\r\n\r\nbody"):
    lines = [b"WARC/1.1", *headers, b"WARC-Record-ID: <urn:uuid:1>", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_digests_and_targets_of_other_writers():
    sha = hashlib.sha1(b"body")
    stated = [b"sha1:" + sha.hexdigest().encode(), b"SHA1:" + sha.hexdigest().upper().encode(), b"sha1:" + base64.b32encode(sha.digest()), b"md5:abc", b"sha1:?", b"no colon"]
    rows = [_row(next(iter(read_archive(foreign(b"WARC-Type: revisit", b"WARC-Payload-Digest: " + d))))) for d in stated]
    assert [r[4] for r in rows] == [sha.hexdigest()] * 3 + [None] * 3
    for text in (b"%%%", b"/w=="):
        record = next(iter(read_archive(foreign(b"WARC-Type: response", b"X-Target-Text: " + text, b"WARC-Target-URI: http://a/"))))
        assert _row(record)[1] == "http://a/"


def test_archives_of_any_name_are_read(spark, tmp_path):
    (tmp_path / "crawl-0001.warc.gz").write_bytes(b"".join(archive(True)))
    (tmp_path / "plain.warc").write_bytes(b"".join(archive(False)) + b"rubbish")
    records, gaps = read_archives(spark, str(tmp_path))
    assert records.count() == 12 and gaps.count() == 1
