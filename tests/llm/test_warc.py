import base64
import gzip
import hashlib
import os
import random

import pytest

from costwatch.llm import warc

SCHEMA = "page_id long, url string, html string"
HARD = [
    (1, "http://a/1", "<p>one</p>"), (1, "http://a/1", "<p>one</p>"), (1, "http://a/0", "<p>one</p>"),
    (2, None, None), (None, "http://b/\r\nX: 1", ""), (None, None, None), (None, None, None),
    (3, "http://ü/漢 字%20", "ü🙂 \r\n\r\n\x00"), (-4, "", "x" * 300_000), (5, "u", "<p>one</p>"),
    (None, "z", "only without an id"), (None, "y", "only without an id"),
]


def many():
    rng = random.Random(2)
    rows = [(i, f"http://h{i % 7}/{i}", "".join(rng.choices("abc <>", k=rng.randint(0, 900)))) for i in range(200)]
    return rows + [(1000 - i, "http://copy", "the same page") for i in range(60)]


def brute(rows, min_bytes=0):
    last = lambda x: (x is None, x if x is not None else 0)
    groups, out = {}, []
    for page_id, url, html in sorted(rows, key=lambda r: (*last(r[0]), r[1] is None, (r[1] or "").encode())):
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = len(payload) < min_bytes or payload not in groups
        ids = None if first else groups[payload]
        groups.setdefault(payload, page_id)
        out.append((page_id, len(payload), digest, "response" if first else "revisit", ids))
    return sorted(out, key=repr)


def rows_of(frame):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def frame_of(spark, rows, tmp_path, parts=3):
    path = str(tmp_path / f"pages{parts}")
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "page_id AS shard", "url AS key", "page_id AS at")
    frame.repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def small_files(monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(warc, "FILE_BYTES", 6_000)


@pytest.mark.parametrize("rows", [many() + HARD, HARD, HARD[:1]])
def test_against_brute_force(spark, tmp_path, small_files, rows):
    assert rows_of(warc.archive_digest(frame_of(spark, rows, tmp_path))) == brute(rows)


def test_files(spark, tmp_path, small_files):
    rows = many() + HARD
    folder = str(tmp_path / "out")
    manifest = warc.write_archive(frame_of(spark, rows, tmp_path), folder, min_bytes=14).collect()
    assert rows_of(warc.read_archive(spark, folder)) == brute(rows, 14)
    assert sum(r["records"] for r in manifest) == len(rows)
    assert len({r["shard"] for r in manifest}) > 3 and max(r["number"] for r in manifest) > 0
    assert sorted(os.listdir(folder)) == sorted([r["name"] for r in manifest] + ["manifest"])
    seen, kept = [], set()
    for r in sorted(manifest, key=lambda r: r["name"]):
        data = open(f"{folder}/{r['name']}", "rb").read()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r["bytes"], r["sha256"])
        text = gzip.decompress(data)  # members one after another are a gzip file
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        seen += [line for line in text.split(b"\r\n") if line.startswith(b"X-Page: ")]
        kept |= {line for line in text.split(b"\r\n") if line.startswith(b"WARC-Record-ID")}
    assert len(kept) == len(rows) + len(manifest)  # every record has an id of its own
    ids = [warc.json.loads(line[8:])["page_id"] for line in seen]
    assert ids == sorted(ids, key=lambda i: (i is None, i or 0))  # order over all shards
    back = {(r["page_id"], r["url"], r["html"]) for r in warc.read_archive(spark, folder).collect() if r["html"] is not None}
    assert back <= {(i, u, h or "") for i, u, h in rows}
    with pytest.raises(ValueError, match="holds an archive"):
        warc.write_archive(frame_of(spark, rows, tmp_path, 4), folder)


def test_reruns_give_equal_files(spark, tmp_path, small_files):
    rows, found = many() + HARD, []
    for parts in (1, 7):
        folder = str(tmp_path / f"out{parts}")
        names = [(r["name"], r["sha256"]) for r in warc.write_archive(frame_of(spark, rows, tmp_path, parts), folder).collect()]
        found.append(sorted(names))
        random.Random(3).shuffle(rows)
    assert found[0] == found[1]


def test_files_of_lost_attempts_are_left_out(spark, tmp_path, small_files):
    folder = tmp_path / "out"
    (folder / "_temporary" / "lost").mkdir(parents=True)
    (folder / "_temporary" / "lost" / "pages-000000-00000.warc.gz").write_bytes(b"half a fi")
    warc.write_archive(frame_of(spark, HARD, tmp_path), str(folder))
    assert rows_of(warc.read_archive(spark, str(folder))) == brute(HARD)


def test_damage_is_noticed(spark, tmp_path, small_files):
    folder = tmp_path / "out"
    name = warc.write_archive(frame_of(spark, many(), tmp_path), str(folder)).first()["name"]
    data = (folder / name).read_bytes()
    (folder / name).write_bytes(data[: len(data) // 2])
    with pytest.raises(Exception, match="cut off|manifest|records"):
        warc.read_archive(spark, str(folder)).collect()
    record = warc.info_record("x")
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record.replace(b"Format 1.1", b"Format 1.0"))


def test_empty(spark, tmp_path):
    assert warc.archive_digest(frame_of(spark, [], tmp_path)).collect() == []
