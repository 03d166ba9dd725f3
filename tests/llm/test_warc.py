import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from parcelyze.llm import files, warc

SCHEMA = "page_id long, url string, html string"


def rows():
    big, small = "<html>" + "x" * 1500 + "</html>", "<p>hi</p>"
    out = [(i, f"http://h{i % 3}.example/{i}", f"<html>{i}" + "é🙂" * (i * 40) + "</html>") for i in range(30)]
    out += [(100 + i, f"http://dup.example/{i}", big) for i in range(6)] + [(200 + i, None, small) for i in range(4)]
    out += [(300, "http://x\r\nEvil: 1", None), (301, "", ""), (None, "http://n", big), (None, None, None),
            (103, "http://dup.example/3", big), (105, "http://dup.example/5", big), (-7, "http://neg", "\r\n\r\n" * 400),
            (400, "http://long", "<b>" * 200_000)]
    return out


def want(data):
    out = []
    for page, _, html in data:
        b = (html or "").encode()
        same = [p for p, _, h in data if p is not None and (h or "").encode() == b]
        to = max(same) if len(b) >= 1000 and page is not None and page < max(same) else None
        out.append((page, "response" if to is None else "revisit", to, len(b), hashlib.sha1(b).hexdigest()))
    return sorted(out, key=str)


def write(spark, data, partitions=5, **kw):
    folder = files.new_folder(spark, "test-warc")
    df = spark.createDataFrame(data, SCHEMA).repartition(partitions).withColumn("id", F.lit("clash")).withColumn("digest", F.lit(0))
    return folder, warc.write(df, folder, **kw)


@pytest.mark.parametrize("file_bytes", [16 << 20, 2000])
def test_round_trip(spark, file_bytes):
    data = rows()
    folder, listed = write(spark, data, file_bytes=file_bytes)
    got = warc.read(spark, folder).collect()
    assert sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got), key=str) == want(data)
    for r in got:
        if r.record_type == "response":
            assert len(r.payload) == r.payload_bytes and hashlib.sha1(r.payload).hexdigest() == r.payload_digest
        else:
            assert r.payload is None
    assert sum(e["records"] for e in listed) == len(data)
    if file_bytes == 2000:
        assert len(listed) > 5


def contents(folder, listed):
    fs, p = files.resolve(folder)
    return [(e["name"], fs.open_input_stream(f"{p}/{e['name']}", compression=None).read()) for e in listed]


def test_same_bytes_every_time_and_valid_gzip(spark):
    a, b = write(spark, rows(), partitions=3), write(spark, list(reversed(rows())), partitions=3)
    whole = lambda x: b"".join(d for _, d in contents(*x))
    strip = lambda raw: b"".join(sorted(gzip.decompress(raw).split(b"WARC/1.1\r\n")))
    assert strip(whole(a)) == strip(whole(b))
    raw = gzip.decompress(contents(*a)[0][1])
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and b"\nEvil" not in raw


def test_range_order_across_files(spark):
    folder, listed = write(spark, rows(), file_bytes=3000)
    ids = []
    for _, raw in contents(folder, listed):
        for m in gzip.decompress(raw).split(b"WARC/1.1\r\n"):
            for line in m.split(b"\r\n\r\n")[0].split(b"\r\n"):
                if line.startswith(b"Page-Id: "):
                    ids.append(int(line[9:]))
    assert ids == sorted(ids) and len(ids) == sum(p is not None for p, *_ in rows())


def test_damage_is_noticed(spark):
    folder, listed = write(spark, [(1, "http://a", "hello world " * 200)])
    fs, p = files.resolve(folder)
    name, raw = contents(folder, listed)[0]
    for bad in (raw[:-9], raw.replace(gzip.compress(b""), b"") + b"junk"):
        with fs.open_output_stream(f"{p}/{name}", compression=None) as f:
            f.write(bad)
        with pytest.raises(Exception):
            warc.read(spark, folder).collect()


def test_uncommitted_files_are_not_read(spark):
    folder, listed = write(spark, [(1, "http://a", "x")])
    fs, p = files.resolve(folder)
    with fs.open_output_stream(f"{p}/pages-999999-0000.warc.gz", compression=None) as f:
        f.write(b"left by a lost attempt")
    assert warc.read(spark, folder).count() == 1


def test_empty_table(spark):
    folder, listed = write(spark, [])
    assert warc.read(spark, folder).count() == 0 and sum(e["records"] for e in listed) == 0
