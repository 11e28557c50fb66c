"""GTFS-Realtime vehicle-position messages: descriptor built in code, encode and decode.

Only the messages and fields the ingest reads are declared; other fields of a real
feed are skipped by the protobuf parser as unknown fields.
"""

from __future__ import annotations

import gzip
import zlib

from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

# Message layout from the public GTFS-Realtime specification (proto2).
# (message, [(field, number, type, label, message type)])
_F = descriptor_pb2.FieldDescriptorProto
_OPT, _REQ, _REP = _F.LABEL_OPTIONAL, _F.LABEL_REQUIRED, _F.LABEL_REPEATED
LAYOUT = {
    "FeedMessage": [("header", 1, _F.TYPE_MESSAGE, _REQ, "FeedHeader"),
                    ("entity", 2, _F.TYPE_MESSAGE, _REP, "FeedEntity")],
    "FeedHeader": [("gtfs_realtime_version", 1, _F.TYPE_STRING, _REQ, None),
                   ("timestamp", 3, _F.TYPE_UINT64, _OPT, None)],
    "FeedEntity": [("id", 1, _F.TYPE_STRING, _REQ, None),
                   ("is_deleted", 2, _F.TYPE_BOOL, _OPT, None),
                   ("vehicle", 4, _F.TYPE_MESSAGE, _OPT, "VehiclePosition")],
    "VehiclePosition": [("trip", 1, _F.TYPE_MESSAGE, _OPT, "TripDescriptor"),
                        ("position", 2, _F.TYPE_MESSAGE, _OPT, "Position"),
                        ("timestamp", 5, _F.TYPE_UINT64, _OPT, None),
                        ("vehicle", 8, _F.TYPE_MESSAGE, _OPT, "VehicleDescriptor")],
    "TripDescriptor": [("trip_id", 1, _F.TYPE_STRING, _OPT, None)],
    "Position": [("latitude", 1, _F.TYPE_FLOAT, _REQ, None),
                 ("longitude", 2, _F.TYPE_FLOAT, _REQ, None)],
    "VehicleDescriptor": [("id", 1, _F.TYPE_STRING, _OPT, None)],
}
PACKAGE = "transit_realtime"

_classes: dict | None = None


def _messages() -> dict:
    global _classes
    if _classes is None:
        fdp = descriptor_pb2.FileDescriptorProto(name="stopwise_gtfs_rt.proto", package=PACKAGE, syntax="proto2")
        for msg, fields in LAYOUT.items():
            m = fdp.message_type.add(name=msg)
            for name, num, typ, label, ref in fields:
                f = m.field.add(name=name, number=num, type=typ, label=label)
                if ref:
                    f.type_name = f".{PACKAGE}.{ref}"
        pool = descriptor_pool.DescriptorPool()
        pool.Add(fdp)
        _classes = {m: message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{PACKAGE}.{m}"))
                    for m in LAYOUT}
    return _classes


def encode_snapshot(header_ts: int | None, entities: list[dict]) -> bytes:
    """Entities as dicts: entity_id, vehicle_id, entity_ts, lat, lon, trip_id, has_vehicle (None = absent)."""
    FeedMessage = _messages()["FeedMessage"]
    fm = FeedMessage()
    fm.header.gtfs_realtime_version = "2.0"
    if header_ts is not None:
        fm.header.timestamp = int(header_ts)
    for e in entities:
        ent = fm.entity.add()
        ent.id = e["entity_id"]
        if not e.get("has_vehicle", True):
            continue
        v = ent.vehicle
        v.SetInParent()
        if e.get("vehicle_id") is not None:
            v.vehicle.id = e["vehicle_id"]
        if e.get("trip_id") is not None:
            v.trip.trip_id = e["trip_id"]
        if e.get("entity_ts") is not None:
            v.timestamp = int(e["entity_ts"])
        if e.get("lat") is not None and e.get("lon") is not None:
            v.position.latitude = float(e["lat"])
            v.position.longitude = float(e["lon"])
    return fm.SerializeToString()


def decode_snapshot(body: bytes) -> tuple[int, list[tuple]]:
    """(header_ts, entities as (idx, id, has_vehicle, vehicle_id, entity_ts, lat, lon, trip_id)).

    Raises on a malformed message (missing required fields included)."""
    fm = _messages()["FeedMessage"]()
    fm.ParseFromString(body)
    if not fm.IsInitialized():
        raise ValueError("message missing required fields")
    header_ts = fm.header.timestamp if fm.HasField("header") else 0
    out = []
    for i, ent in enumerate(fm.entity):
        if not ent.HasField("vehicle"):
            out.append((i, ent.id, False, None, None, None, None, None))
            continue
        v = ent.vehicle
        vid = v.vehicle.id if v.HasField("vehicle") and v.vehicle.HasField("id") else None
        ts = v.timestamp if v.HasField("timestamp") else None
        lat = v.position.latitude if v.HasField("position") else None
        lon = v.position.longitude if v.HasField("position") else None
        trip = v.trip.trip_id if v.HasField("trip") and v.trip.HasField("trip_id") else None
        out.append((i, ent.id, True, vid, ts, lat, lon, trip))
    return header_ts, out


# --- body decompression ---------------------------------------------------------------------------
# Decompression modes and content encodings understood by the fetcher.
MODES = ("AUTO", "GZIP", "DEFLATE", "NONE", "TRY_SMART")


def _inflate(b: bytes) -> bytes:
    try:
        return zlib.decompress(b)
    except zlib.error:
        return zlib.decompress(b, -zlib.MAX_WBITS)


def decompress(body: bytes, content_encoding: str | None, mode: str) -> bytes:
    """Decode a fetched body. Unknown modes fall back to AUTO (the profile default)."""
    mode = (mode or "AUTO").strip().upper()
    if mode not in MODES:
        mode = "AUTO"
    if mode == "NONE":
        return body
    if mode == "GZIP":
        return gzip.decompress(body)
    if mode == "DEFLATE":
        return _inflate(body)
    if mode == "TRY_SMART":
        if len(body) >= 2 and body[0] == 0x1F and body[1] == 0x8B:
            return gzip.decompress(body)
        if len(body) >= 2 and body[0] == 0x78:
            return _inflate(body)
        return body
    enc = (content_encoding or "").strip().lower()
    if enc in ("", "identity"):
        return body
    if enc in ("gzip", "x-gzip"):
        return gzip.decompress(body)
    if enc == "deflate":
        return _inflate(body)
    return body
