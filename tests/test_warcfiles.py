"""WARC files: cuts at any byte, damaged and odd members, types, ranges, the writer's commit."""

import gzip

import pytest

from prosemill.sources import warcfiles


def record(kind, url, payload):
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload + b"\r\n\r\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("warc")
    made, at = [], 0
    with open(root / "many.warc.gz", "wb") as out:
        for k in range(300):
            # Payloads hold header lines, the mark of a member, empty bodies, long ones.
            payload = [b"", b"WARC/1.0\r\n\r\nWARC-Type: x\r\n\r\n", b"\x1f\x8b\x08" * 50, b"x\n" * (40 * k)][k % 4]
            data = gzip.compress(record("request" if k % 5 == 0 else "response", f"u{k}", payload), 0 if k % 7 == 0 else 6)
            made.append((f"u{k}", at, len(data), payload))
            at += out.write(data)
    (root / "one.warc.gz").write_bytes(gzip.compress(record("warcinfo", "a", b"1") + record("response", "b", b"22")))
    (root / "plain.warc").write_bytes(record("response", "c", b"333") + record("response", "d", b""))
    (root / "_hidden.warc.gz").write_bytes(b"nothing")
    (root / "empty.warc.gz").write_bytes(b"")
    return root, made


@pytest.mark.parametrize("split", [0, 37, 1000, 1 << 20])
def test_every_record_is_in_one_part_wherever_files_are_cut(folder, split):
    root, made = folder
    reader = warcfiles.WarcReader({"path": str(root), "splitBytes": str(split)})
    got = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    many = [(r["url"], r["offset"], r["length"], r["payload"]) for r in got if r["filename"].endswith("many.warc.gz")]
    assert sorted(many) == sorted(made)
    others = {r["url"]: (r["length"], r["payload"]) for r in got if not r["filename"].endswith("many.warc.gz")}
    assert others == {"a": (None, b"1"), "b": (None, b"22"), "c": (None, b"333"), "d": (None, b"")}


def test_types_and_ranges(spark, folder):
    root, made = folder
    rows = warcfiles.read_warc(spark, str(root), splitBytes=20_000)
    assert rows.rdd.getNumPartitions() > 4
    assert sorted(r["url"] for r in rows.where("warc_type = 'request'").collect()) == sorted(f"u{k}" for k in range(0, 300, 5))
    assert rows.where("url = 'u7'").count() == 1  # the same frame, another test
    assert sorted(r["url"] for r in warcfiles.read_warc(spark, str(root), types="warcinfo,request").collect()) == sorted([f"u{k}" for k in range(0, 300, 5)] + ["a"])
    index = spark.createDataFrame([("many.warc.gz", at, n) for _, at, n, _ in made[::3]] * 2 + [(None, 1, 1), ("many.warc.gz", None, 3)], "filename string, offset long, length long")
    got = warcfiles.ranged_records(index, str(root), part=3000)
    assert sorted((r["url"], r["offset"], r["length"], bytes(r["payload"])) for r in got.collect()) == sorted(made[::3])
    bad = spark.createDataFrame([("many.warc.gz", made[1][1] + 1, 20), ("many.warc.gz", made[2][1], made[2][2] - 3), ("many.warc.gz", made[3][1], made[3][2])], index.schema)
    assert [r["url"] for r in warcfiles.ranged_records(bad, str(root), lenient=True).collect()] == ["u3"]
    with pytest.raises(Exception, match="many.warc.gz at"):
        warcfiles.ranged_records(bad, str(root)).collect()


def test_damaged_members(tmp_path):
    parts = [gzip.compress(record("response", f"u{k}", b"x" * 5000 + bytes(range(256)))) for k in range(5)]
    parts[1] = parts[1][: len(parts[1]) // 2]
    parts[3] = parts[3][:20] + b"\xff" * 9 + parts[3][29:]
    (tmp_path / "f.warc.gz").write_bytes(b"".join(parts) + b"\0" * 100)
    options = {"path": str(tmp_path), "mode": "DROPMALFORMED", "splitBytes": "64"}
    reader = warcfiles.WarcReader(options)
    assert [r["url"] for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()] == ["u0", "u2", "u4"]
    reader = warcfiles.WarcReader({"path": str(tmp_path)})
    with pytest.raises(ValueError, match="f.warc.gz at"):
        list(reader.read(reader.partitions()[0]))
    with pytest.raises(ValueError, match="not a record"):
        list(warcfiles.records(open(__file__, "rb")))


def test_written_files_are_seen_when_the_job_commits(spark, tmp_path):
    rows = [("response", "u\n1", "2024-01-02T03:04:05Z", bytearray(b"a\r\n\r\nb")), ("request", None, None, None), ("response", "u2", None, bytearray())]
    df = spark.createDataFrame(rows, "warc_type string, url string, warc_date string, payload binary")
    warcfiles.write_warc(df, str(tmp_path))
    warcfiles.write_warc(df.limit(0), str(tmp_path))
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]
    got = sorted((r["warc_type"], r["url"] or "", bytes(r["payload"])) for r in warcfiles.read_warc(spark, str(tmp_path)).collect())
    assert got == [("request", "", b""), ("response", "u 1", b"a\r\n\r\nb"), ("response", "u2", b"")]
    failing = df.selectExpr("warc_type", "url", "warc_date", "if(url = 'u2', raise_error('no'), payload) AS payload")
    with pytest.raises(Exception, match="no"):
        warcfiles.write_warc(failing.coalesce(1), str(tmp_path))
    assert warcfiles.read_warc(spark, str(tmp_path)).count() == 3
