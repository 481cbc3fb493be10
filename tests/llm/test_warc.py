import base64
import glob
import gzip
import hashlib
import io
import random
import zlib

import pytest

from thalweg.llm.warc import Inflated, archive_pages, http_parts, mark_copies, normalise, parse_record, payload_digest, read_archives, record_bytes, write_streams


def test_pages_come_back_with_one_response_a_payload(spark, tmp_path):
    r = random.Random(4)
    bodies = [None, "", "x" * 200_000, "é\r\n\r\nWARC/1.1"] + ["".join(r.choice("<p>ab ") for _ in range(r.randint(0, 12))) for _ in range(120)]
    rows = [(i, f"http://a/{i}\nb", b, "extra") for i, b in enumerate(bodies)] + [(7, "again", bodies[7], "extra"), (None, None, "x" * 200_000, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(3)
    folder = f"file://{tmp_path}/w"
    got = archive_pages(pages, folder, archive_bytes=50_000).collect()
    first = {}
    for page, _, body, _ in rows:
        if page is not None:
            first[body or ""] = min(page, first.get(body or "", 1 << 60))
    assert len(got) == len(rows)
    seen = {}
    for x in got:
        seen.setdefault(x.page_id, []).append(x)
    for page, _, body, _ in rows:
        raw = (body or "").encode()
        for x in seen[page]:
            assert x.payload_bytes == len(raw) and x.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        kinds = sorted((x.record_type, x.refers_to) for x in seen[page])
        low = first[body or ""]
        want = {7: [("response", None), ("revisit", 7)] if low == 7 else [("revisit", low)] * 2}.get(page, [("response", None)] if page == low else [("revisit", low)])
        assert kinds == want
    # records are as the format wants them
    ids, refer = {}, []
    for path in glob.glob(f"{tmp_path}/w/members/*.warc.gz"):
        stream = io.BufferedReader(Inflated(open(path, "rb")))
        while (found := parse_record(stream)) is not None:
            headers, block = found
            assert headers["Content-Type"] == "application/http; msgtype=response" and block.startswith(b"HTTP/1.1 200 OK\r\n") and headers["WARC-Target-URI"]
            size, payload = http_parts(block)
            if headers["WARC-Type"] == "response":
                assert size == len(payload) and "sha1:" + payload_digest(payload) == headers["WARC-Payload-Digest"]
                ids[headers["WARC-Record-ID"]] = headers["WARC-Payload-Digest"]
            else:
                assert not payload and headers["WARC-Profile"].endswith("/revisit/identical-payload-digest")
                refer.append((headers["WARC-Refers-To"], headers["WARC-Payload-Digest"]))
    assert refer and all(ids[i] == d for i, d in refer)
    # every record is a gzip member of its own, at the place that the sidecar gives
    for path in glob.glob(f"{tmp_path}/w/members/*.warc.gz"):
        data = open(path, "rb").read()
        places = [tuple(map(int, line.split())) for line in open(path.replace(".warc.gz", ".idx"))]
        assert sum(n for _, _, n in places) == len(data)
        for _, at, n in places:
            engine = zlib.decompressobj(31)
            assert engine.decompress(data[at : at + n]).startswith(b"WARC/1.1") and engine.eof and not engine.unused_data


def test_many_archives_go_to_many_tasks(spark, tmp_path):
    pages = spark.range(400).selectExpr("id AS page_id", "'http://a/' AS url", "repeat(cast(id AS string), 200) AS html").repartition(2)
    manifest = write_streams(pages, f"file://{tmp_path}/s", archive_bytes=10_000)
    assert manifest.select("archive").distinct().count() > 20
    archives = normalise(mark_copies(manifest), f"file://{tmp_path}/s", f"file://{tmp_path}/m")
    # each task of the rewriting wrote a file of its own
    assert len({x.path for x in archives.selectExpr("input_file_name() AS path").distinct().collect()}) > 10
    records = read_archives(archives, f"file://{tmp_path}/m")
    assert records.count() == 400 and len({x.path for x in records.selectExpr("input_file_name() AS path").distinct().collect()}) > 10


def test_a_revisit_that_differs_is_refused(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "same"), (2, "u", "same")], "page_id long, url string, html string").coalesce(1)
    manifest = write_streams(pages, f"file://{tmp_path}/s")
    normalise(mark_copies(manifest), f"file://{tmp_path}/s", f"file://{tmp_path}/m")
    (path,), (index,) = glob.glob(f"{tmp_path}/m/*.warc.gz"), glob.glob(f"{tmp_path}/m/*.idx")
    places = [tuple(map(int, line.split())) for line in open(index)]
    data = open(path, "rb").read()
    members = [gzip.decompress(data[at : at + n]) for _, at, n in places]
    members[1] = members[1].replace(b"Content-Length: 4\r\n", b"Content-Length: 5\r\n")
    packed = [gzip.compress(m) for m in members]
    open(path, "wb").write(b"".join(packed))
    at = 0
    with open(index, "w") as f:
        for k, m in enumerate(packed):
            f.write(f"{k} {at} {len(m)}\n")
            at += len(m)
    with pytest.raises(ValueError, match="revisit"):
        read_archives(spark.createDataFrame([(path.split("/")[-1][: -len(".warc.gz")],)], "archive string"), f"file://{tmp_path}/m").collect()


def test_an_empty_table(spark):
    assert archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_streams_are_read_across_members_and_broken_ones_refused():
    records = [record_bytes([("WARC-Type", "response")], bytes([k]) * 1000) for k in range(5)]
    whole = gzip.compress(b"".join(records[:3])) + gzip.compress(records[3]) + gzip.compress(records[4])
    stream = io.BufferedReader(Inflated(io.BytesIO(whole)))
    blocks = []
    while (found := parse_record(stream)) is not None:
        blocks.append(found[1])
    assert blocks == [bytes([k]) * 1000 for k in range(5)]
    with pytest.raises(ValueError):
        io.BufferedReader(Inflated(io.BytesIO(whole[:-12]))).read()
