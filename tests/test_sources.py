"""Feed decoding modes, malformed snapshots, the binaryFile landing folder, GTFS loading."""

import gzip
import zlib

import pytest

from stopwise.functions import gtfs_rt
from stopwise.sources import feed as fd
from stopwise.sources import gtfs as gl
from stopwise.sources import positions as ps

ENTS = [{"entity_id": "e1", "vehicle_id": "V1", "entity_ts": 100, "lat": 59.5, "lon": 18.25, "trip_id": "T1"},
        {"entity_id": "e2", "vehicle_id": None, "entity_ts": None, "lat": None, "lon": None, "trip_id": None},
        {"entity_id": "e3", "has_vehicle": False}]
RAW = gtfs_rt.encode_snapshot(1700000000, ENTS)


def _raw_deflate(b):
    c = zlib.compressobj(wbits=-zlib.MAX_WBITS)
    return c.compress(b) + c.flush()


@pytest.mark.parametrize("mode,enc,body,ok", [
    ("NONE", None, RAW, True),
    ("GZIP", None, gzip.compress(RAW), True),
    ("DEFLATE", None, zlib.compress(RAW), True),
    ("DEFLATE", None, _raw_deflate(RAW), True),
    ("AUTO", "gzip", gzip.compress(RAW), True),
    ("AUTO", " X-GZIP ", gzip.compress(RAW), True),
    ("AUTO", "deflate", _raw_deflate(RAW), True),
    ("AUTO", "identity", RAW, True),
    ("AUTO", "br", RAW, True),           # unknown encoding: body as is
    ("TRY_SMART", None, gzip.compress(RAW), True),
    ("TRY_SMART", None, zlib.compress(RAW), True),
    ("TRY_SMART", None, RAW, True),
    ("bogus", "gzip", gzip.compress(RAW), True),   # unknown mode falls back to AUTO
])
def test_decompress_modes(mode, enc, body, ok):
    assert gtfs_rt.decompress(body, enc, mode) == RAW


def test_decode_snapshot_fields():
    h, rows = gtfs_rt.decode_snapshot(RAW)
    assert h == 1700000000
    assert rows[0] == (0, "e1", True, "V1", 100, 59.5, 18.25, "T1")
    assert rows[1] == (1, "e2", True, None, None, None, None, None)
    assert rows[2] == (2, "e3", False, None, None, None, None, None)


def test_bad_snapshots_are_set_apart(spark):
    bodies = [("f", 1, RAW, "identity"), ("f", 2, gzip.compress(RAW)[:20], "gzip"), ("f", 3, RAW[:7], "identity"),
              ("f", 4, b"\x00\x01garbage", "identity")]
    df = spark.createDataFrame(bodies, "feed string, snapshot_no long, body binary, content_encoding string")
    p = fd.parse_snapshots(fd.decode_body(df))
    ents = fd.explode_feed(p)
    assert sorted(r.snapshot_no for r in fd.explode_feed(p).select("snapshot_no").distinct().collect()) == [1]
    assert ents.count() == 3
    assert sorted(r.snapshot_no for r in fd.bad_snapshots(p).collect()) == [2, 3, 4]


def test_landing_folder_binary_files(spark, tmp_path):
    d = tmp_path / "vehicle-positions"
    d.mkdir()
    (d / "000000000001.pb").write_bytes(RAW)
    (d / "000000000002.gz").write_bytes(gzip.compress(RAW))
    (d / "000000000003.zz").write_bytes(zlib.compress(RAW))
    snaps = fd.read_landing_folder(spark, str(tmp_path))
    got = {(r.snapshot_no, r.content_encoding) for r in snaps.collect()}
    assert got == {(1, "identity"), (2, "gzip"), (3, "deflate")}
    ents = fd.explode_feed(fd.parse_snapshots(fd.decode_body(snaps)))
    assert ents.count() == 9 and ents.where("feed = 'vehicle-positions'").count() == 9


def test_gtfs_missing_dependency(spark, tmp_path):
    t = {"trips": spark.createDataFrame([("T1", "R1", "C1")], "trip_id string, route_id string, service_id string")}
    gl.write_gtfs(t, str(tmp_path))
    with pytest.raises(gl.MissingDependency):
        gl.load_gtfs(spark, str(tmp_path))
    assert set(gl.load_gtfs(spark, str(tmp_path), require_dependencies=False)) == {"trips"}


def test_parse_lines_keeps_bad_apart(spark):
    lines = spark.createDataFrame([('{"agency":"SL","ts_ms":5}',), ('{"agency":',), ("not json",)], "value string")
    good, bad = ps.parse_lines(lines, ps.POSITION_SCHEMA)
    assert good.count() == 1 and bad.count() == 2


def test_snapshot_stream_goes_on_behind_its_offset(spark, tmp_path):
    """Fetch order by number, a bounded batch, restart from the checkpoint; earlier files may be gone, late ones are not read."""
    import json
    import os

    from stopwise.sources.snapshot_source import SnapshotReader, read_snapshots
    from stopwise.streaming import runner
    root, out, ckpt = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/ckpt"
    for feed in ("a", "b"):
        (root / feed).mkdir(parents=True)
    stale = 10**9
    for i in (3, 1, 2):          # landed out of order, with misleading file times
        p = root / "a" / f"{i:012d}.pb"
        p.write_bytes(RAW)
        os.utime(p, (stale - i, stale - i))
    (root / "b" / "7.gz").write_bytes(gzip.compress(RAW))
    (root / "a" / "README").write_text("no snapshot")
    runner.run_available_now(read_snapshots(spark, str(root)), out, ckpt)
    got = {(r.feed, r.snapshot_no, r.content_encoding, bytes(r.body)) for r in spark.read.parquet(out).collect()}
    assert got == {("a", i, "identity", RAW) for i in (1, 2, 3)} | {("b", 7, "gzip", (root / "b" / "7.gz").read_bytes())}
    for p in (root / "a").iterdir():
        p.rename(tmp_path / p.name)                                   # archived
    (root / "a" / "000000000002.pb").write_bytes(RAW)                 # late: its number is behind the offset
    (root / "a" / "000000000010.pb").write_bytes(b"broken")
    runner.run_available_now(read_snapshots(spark, str(root)), out, ckpt)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 5 and ("a", 10) in {(r.feed, r.snapshot_no) for r in rows}
    offsets = sorted(int(f) for f in os.listdir(f"{ckpt}/offsets") if f.isdigit())
    last = json.loads((tmp_path / "ckpt" / "offsets" / str(offsets[-1])).read_text().splitlines()[-1])
    assert last["a"] == {"snapshot_no": 10, "header_ts": None} and last["b"] == {"snapshot_no": 7, "header_ts": 1700000000}
    # one batch takes at most so many snapshots of a feed
    (root / "b" / "8.pb").write_bytes(RAW)
    (root / "b" / "9.pb").write_bytes(RAW)
    reader = SnapshotReader(str(root), 2)
    assert reader.latestOffset()["b"]["snapshot_no"] == 8 and reader.latestOffset()["b"]["snapshot_no"] == 9


def test_entities_do_not_stay_python_objects():
    """Parsing and encoding a batch needs memory for its Arrow columns, not for a dict per entity."""
    import tracemalloc

    import pyarrow as pa
    ents = [{"entity_idx": i, "entity_id": f"e{i}", "has_vehicle": True, "vehicle_id": f"V{i}", "entity_ts": i, "lat": 1.0, "lon": 2.0, "trip_id": f"T{i}"}
            for i in range(20)]
    raw = gtfs_rt.encode_snapshot(1, ents)
    n = 5000
    tracemalloc.start()
    try:
        out = fd._parse_udf.func(pa.array([raw] * (n - 2) + [b"broken", None]))
        assert tracemalloc.get_traced_memory()[1] < 20e6
        tracemalloc.reset_peak()
        bodies = fd._encode_udf.func(pa.array([1] * n), pa.array([ents], pa.list_(fd._ENTITY)).take(pa.array([0] * n)), pa.array(["identity"] * n))
        assert tracemalloc.get_traced_memory()[1] < 20e6
    finally:
        tracemalloc.stop()
    assert out[0].as_py() == {"header_ts": 1, "entities": ents, "error": None}
    assert out[n - 2]["entities"].as_py() is None and out[n - 2]["error"].as_py() and out[n - 1]["error"].as_py() == "no payload"
    assert bodies[n - 1].as_py() == raw


def test_a_snapshot_with_a_time_that_fits_no_column_is_a_bad_one():
    import pyarrow as pa
    out = fd._parse_udf.func(pa.array([gtfs_rt.encode_snapshot(2**63, []), gtfs_rt.encode_snapshot(5, [])]))
    assert out[0]["error"].as_py() and out[1].as_py() == {"header_ts": 5, "entities": [], "error": None}
