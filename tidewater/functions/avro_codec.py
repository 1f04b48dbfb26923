"""Avro binary encoding, the per-row helper behind ``sources.avro``.

Used only inside Spark tasks (``mapInArrow``) when Spark's own Avro package
is not on the classpath.  It covers what the pipelines carry: records,
``["null", T]`` unions, string, bytes, boolean, int, long, float, double and
``timestamp-millis``; object container files with the ``null`` and
``deflate`` codecs.  Schemas are compiled once per task into closures.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterator

MAGIC = b"Obj\x01"
SYNC_SIZE = 16

_D = struct.Struct("<d")
_F = struct.Struct("<f")


class AvroError(ValueError):
    pass


# --- primitives -------------------------------------------------------------

def read_long(buf: bytes, pos: int) -> tuple[int, int]:
    b = buf[pos]
    pos += 1
    n = b & 0x7F
    shift = 7
    while b & 0x80:
        b = buf[pos]
        pos += 1
        n |= (b & 0x7F) << shift
        shift += 7
    return (n >> 1) ^ -(n & 1), pos


def write_long(n: int, out: bytearray) -> None:
    n = (n << 1) ^ (n >> 63)
    while n & ~0x7F:
        out.append((n & 0x7F) | 0x80)
        n >>= 7
    out.append(n)


def _read_bytes(buf, pos):
    n, pos = read_long(buf, pos)
    end = pos + n
    if n < 0 or end > len(buf):
        raise AvroError("truncated bytes value")
    return bytes(buf[pos:end]), end


def _write_bytes(b: bytes, out: bytearray) -> None:
    write_long(len(b), out)
    out += b


# --- schema -----------------------------------------------------------------

def parse_schema(avsc: str | dict) -> dict:
    s = json.loads(avsc) if isinstance(avsc, str) else avsc
    return s


def _type_name(t) -> str:
    if isinstance(t, str):
        return t
    if isinstance(t, list):
        return "union"
    return t["type"] if isinstance(t["type"], str) else "nested"


def compile_reader(t) -> Callable:
    """Schema → ``read(buf, pos) -> (value, pos)``; records decode to dicts."""
    if isinstance(t, list):
        branches = [compile_reader(b) for b in t]

        def read_union(buf, pos):
            i, pos = read_long(buf, pos)
            if not 0 <= i < len(branches):
                raise AvroError(f"union branch {i} out of range")
            return branches[i](buf, pos)
        return read_union
    if isinstance(t, dict) and not isinstance(t.get("type"), str):
        return compile_reader(t["type"])
    name = _type_name(t)
    if name == "null":
        return lambda buf, pos: (None, pos)
    if name == "boolean":
        return lambda buf, pos: (buf[pos] != 0, pos + 1)
    if name in ("int", "long"):
        return read_long
    if name == "double":
        return lambda buf, pos: (_D.unpack_from(buf, pos)[0], pos + 8)
    if name == "float":
        return lambda buf, pos: (_F.unpack_from(buf, pos)[0], pos + 4)
    if name == "bytes":
        return _read_bytes
    if name == "string":
        def read_string(buf, pos):
            b, pos = _read_bytes(buf, pos)
            return b.decode("utf-8"), pos
        return read_string
    if name == "record":
        fields = [(f["name"], compile_reader(f["type"])) for f in t["fields"]]

        def read_record(buf, pos):
            out = {}
            for fname, rd in fields:
                out[fname], pos = rd(buf, pos)
            return out, pos
        return read_record
    raise AvroError(f"unsupported Avro type {name}")


def compile_writer(t) -> Callable:
    """Schema → ``write(value, out: bytearray)``."""
    if isinstance(t, list):
        names = [_type_name(b) for b in t]
        writers = [compile_writer(b) for b in t]
        null_at = names.index("null") if "null" in names else None
        other = [i for i, n in enumerate(names) if n != "null"]
        if len(other) != 1:
            raise AvroError("only [null, T] unions are supported for writing")

        def write_union(v, out):
            if v is None:
                if null_at is None:
                    raise AvroError("null for a non-null union")
                write_long(null_at, out)
            else:
                write_long(other[0], out)
                writers[other[0]](v, out)
        return write_union
    if isinstance(t, dict) and not isinstance(t.get("type"), str):
        return compile_writer(t["type"])
    name = _type_name(t)
    if name == "null":
        return lambda v, out: None
    if name == "boolean":
        return lambda v, out: out.append(1 if v else 0)
    if name in ("int", "long"):
        return lambda v, out: write_long(int(v), out)
    if name == "double":
        return lambda v, out: out.extend(_D.pack(float(v)))
    if name == "float":
        return lambda v, out: out.extend(_F.pack(float(v)))
    if name == "bytes":
        return lambda v, out: _write_bytes(bytes(v), out)
    if name == "string":
        return lambda v, out: _write_bytes(str(v).encode("utf-8"), out)
    if name == "record":
        fields = [(f["name"], compile_writer(f["type"])) for f in t["fields"]]

        def write_record(v, out):
            for fname, wr in fields:
                wr(v.get(fname), out)
        return write_record
    raise AvroError(f"unsupported Avro type {name}")


def decode_one(reader: Callable, buf: bytes) -> dict:
    value, pos = reader(buf, 0)
    if pos != len(buf):
        raise AvroError(f"{len(buf) - pos} trailing bytes")
    return value


def resolve(record: dict, reader_fields: list[str], defaults: dict) -> dict:
    """Writer record → reader field set: absent fields take their default."""
    return {f: record[f] if f in record else defaults.get(f) for f in reader_fields}


# --- object container files -------------------------------------------------

def write_container(schema: dict, records: list[dict], codec: str = "null",
                    sync: bytes = b"\x00" * SYNC_SIZE, block_records: int = 1000) -> bytes:
    """One Avro object container holding ``records``."""
    if codec not in ("null", "deflate"):
        raise AvroError(f"codec {codec} not supported")
    out = bytearray(MAGIC)
    meta = {"avro.schema": json.dumps(schema).encode(), "avro.codec": codec.encode()}
    write_long(len(meta), out)
    for k, v in meta.items():
        _write_bytes(k.encode(), out)
        _write_bytes(v, out)
    write_long(0, out)
    out += sync
    writer = compile_writer(schema)
    for start in range(0, len(records), block_records):
        chunk = records[start:start + block_records]
        body = bytearray()
        for r in chunk:
            writer(r, body)
        data = bytes(body)
        if codec == "deflate":
            c = zlib.compressobj(6, zlib.DEFLATED, -15)
            data = c.compress(data) + c.flush()
        write_long(len(chunk), out)
        write_long(len(data), out)
        out += data
        out += sync
    return bytes(out)


def read_header(buf: bytes) -> tuple[dict, str, bytes, int]:
    """(writer schema, codec, sync marker, position of the first block)."""
    if buf[:4] != MAGIC:
        raise AvroError("not an Avro object container")
    pos = 4
    meta = {}
    while True:
        n, pos = read_long(buf, pos)
        if n == 0:
            break
        if n < 0:
            n = -n
            _, pos = read_long(buf, pos)
        for _ in range(n):
            k, pos = _read_bytes(buf, pos)
            v, pos = _read_bytes(buf, pos)
            meta[k.decode()] = v
    sync = bytes(buf[pos:pos + SYNC_SIZE])
    if len(sync) != SYNC_SIZE:
        raise AvroError("truncated header")
    pos += SYNC_SIZE
    schema = json.loads(meta["avro.schema"].decode())
    codec = meta.get("avro.codec", b"null").decode()
    return schema, codec, sync, pos


def iter_blocks(buf: bytes, pos: int, sync: bytes) -> Iterator[tuple[int, bytes]]:
    """(record count, raw block data) for each block; checks sync markers."""
    while pos < len(buf):
        count, pos = read_long(buf, pos)
        size, pos = read_long(buf, pos)
        data = buf[pos:pos + size]
        if len(data) != size:
            raise AvroError("truncated block")
        pos += size
        if bytes(buf[pos:pos + SYNC_SIZE]) != sync:
            raise AvroError("corrupt sync marker")
        pos += SYNC_SIZE
        yield count, data


def block_records(data: bytes, count: int, codec: str, reader: Callable) -> Iterator[dict]:
    if codec == "deflate":
        data = zlib.decompress(data, -15)
    elif codec != "null":
        raise AvroError(f"codec {codec} not supported")
    pos = 0
    for _ in range(count):
        rec, pos = reader(data, pos)
        yield rec
    if pos != len(data):
        raise AvroError("block has trailing bytes")


def read_container(buf: bytes) -> tuple[dict, Iterator[dict]]:
    schema, codec, sync, pos = read_header(buf)
    reader = compile_reader(schema)

    def records():
        for count, data in iter_blocks(buf, pos, sync):
            yield from block_records(data, count, codec, reader)
    return schema, records()
