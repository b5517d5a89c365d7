from __future__ import annotations

import base64
import gzip
import hashlib
import random

import pytest

from matchday.llm import shared, warc


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return df.selectExpr("*", "1 as kind", "'x' as payload", "2 as sha")


def brute(rows, least):
    best = {}
    for page_id, _, html in rows:
        body = (html or "").encode()
        if page_id is not None and len(body) >= least:
            best[body] = max(page_id, best.get(body, page_id))
    found = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        response = best.get(body)
        revisit = response is not None and response != page_id
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        found.append((page_id, len(body), sha, "revisit" if revisit else "response", response if revisit else None))
    return found


def sample():
    rng = random.Random(1)
    bodies = [None, "", "<p>\u00e9</p>", "x" * 100_000, "a\r\n\r\nb", *[f"<b>{i}</b>" * 20 for i in range(6)]]
    rows = [(i * 2, rng.choice([None, f"http://a.b/{i} \u00e9\r\n", f"https://c/{i}?x=%20"]), rng.choice(bodies)) for i in range(80)]
    return [*rows, rows[3], (rows[3][0], "u", "other"), (None, "n", bodies[5]), (None, None, "only here"), (None, None, "only here")]


@pytest.mark.parametrize("least, roll", [(0, 2**28), (0, 2_000), (50, 2**28)])
def test_round_trip(spark, least, roll):
    rows = sample()
    folder = shared.new_folder(spark, "archives")
    manifest = warc.write_archives(pages(spark, rows), folder, least, roll)
    found = [tuple(r) for r in warc.read_archives(manifest, folder).collect()]
    assert sorted(map(str, found)) == sorted(map(str, brute(rows, least)))
    if roll == 2_000:
        assert manifest.groupBy("shard").count().where("count > 1").count()
    files = manifest.orderBy("shard", "number").collect()
    last = [f.last_page for f in files if f.last_page is not None]
    assert last == sorted(last)
    # ids are in order within the files, too
    system, base = shared.open_folder(folder)
    seen = []
    for f in files:
        data = gzip.decompress(system.open_input_stream(f"{base}/{f.file}", compression=None).read())
        assert data.count(b"WARC/1.1\r\n") == f.n_records
        seen += [line for line in data.split(b"\r\n") if line.startswith(b"WARC-Record-ID")]
    numbers = [warc.page_of(line.decode().split(": ")[1]) for line in seen]
    assert [n for n in numbers if n is not None] == sorted(n for n in numbers if n is not None)


def test_payloads_and_reruns(spark):
    rows = sample()
    contents = []
    for _ in range(2):
        folder = shared.new_folder(spark, "archives")
        manifest = warc.write_archives(pages(spark, rows), folder)
        kept = warc.read_archives(manifest, folder, with_payload=True).where("record_type = 'response'").collect()
        assert {bytes(r.payload) for r in kept} == {(html or "").encode() for _, _, html in rows}
        system, base = shared.open_folder(folder)
        contents.append([
            (f.file, system.open_input_stream(f"{base}/{f.file}", compression=None).read())
            for f in manifest.orderBy("shard", "number").collect()
        ])
    assert contents[0] == contents[1]


def test_same_bytes_on_any_cluster(spark, monkeypatch):
    """Shards depend on the rows alone, not on partitions or samples."""
    monkeypatch.setattr(warc, "SHARD_BYTES", (3_000, 2**30))
    monkeypatch.setattr(warc, "RANGES", 3)
    rng = random.Random(4)
    rows = [(rng.choice([i, i * 10**6, -(2**62) + i]), f"u{i}", "y" * rng.randrange(400)) for i in range(300)]
    rows += [(7, "u", "z" * 9_000), (None, "n", "w"), (2**63 - 1, "m", "last")]
    written = []
    for partitions in ("3", "17"):
        monkeypatch.setattr(warc, "SHARDS", 1024)
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            folder = shared.new_folder(spark, "archives")
            manifest = warc.write_archives(pages(spark, rows).repartition(int(partitions)), folder)
            system, base = shared.open_folder(folder)
            written.append({
                f.file: system.open_input_stream(f"{base}/{f.file}", compression=None).read() for f in manifest.collect()
            })
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    assert written[0] == written[1] and len(written[0]) > 8
    found = [tuple(r) for r in warc.read_archives(manifest, folder).collect()]
    assert sorted(map(str, found)) == sorted(map(str, brute(rows, 0)))


def test_attempts_do_not_harm_each_other(spark):
    """One attempt is lost before its rename, one wins, a late one puts the same file in its place."""
    folder = shared.new_folder(spark, "archives")
    system, base = shared.open_folder(folder)
    data = [warc.record(i, None, b"x" * i, None) for i in range(5)]

    def attempt() -> warc.Archive:
        archive = warc.Archive(folder, 10**6)
        assert not [row for i, one in enumerate(data) for row in archive.add(3, i, one)]
        return archive

    lost, late = attempt(), attempt()
    (row,) = attempt().close()
    content = system.open_input_stream(f"{base}/{row[2]}", compression=None).read()
    assert [tuple(again) for again in late.close()] == [row]
    assert system.open_input_stream(f"{base}/{row[2]}", compression=None).read() == content
    assert lost.out is not None
    assert gzip.decompress(content) == b"".join(data)


def test_stores():
    assert shared.open_folder("/a/b")[1] == "/a/b"
    assert shared.open_folder("file:/a/b")[1] == shared.open_folder("file:///a/b")[1] == "/a/b"
    for path in ("dbfs:/x", "abfss://c@a/x"):
        with pytest.raises(ValueError, match="no access"):
            shared.open_folder(path)
    system, base = shared.open_folder("s3a://bucket/some/folder?region=eu-west-1")
    assert (system.type_name, base) == ("s3", "bucket/some/folder")


def test_empty_and_damaged(spark):
    folder = shared.new_folder(spark, "archives")
    manifest = warc.write_archives(pages(spark, []), folder)
    assert manifest.collect() == [] and warc.read_archives(manifest, folder).collect() == []
    good = warc.record(1, "http://a/", b"payload", None)
    assert warc.parse(good)[6] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(good.replace(b"payload\r\n", b"pay1oad\r\n"))
