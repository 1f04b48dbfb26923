"""Avro on Spark: schemaless, registry-framed and container data.

Routing, framing, grouping and joins stay in Spark expressions; only the
Avro body codec runs in Python, batched through Arrow with ``mapInArrow``
(one compiled codec per task, no per-row JVM↔Python hop).  When Spark's own
Avro package is on the classpath, ``spark_avro_available`` reports it and
callers may use ``from_avro``/``to_avro`` for the schemaless case instead.

Every decoder emits an ``_avro_error`` column (NULL when the record decoded)
so bad records can be routed to rejects rather than failing the job.
"""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import avro_codec as codec
from tidewater.functions import wire
from tidewater.session import ship_package

ERROR = "_avro_error"


def spark_avro_available(spark: SparkSession) -> bool:
    try:
        jvm = spark.sparkContext._jvm
        jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst", True,
                                    jvm.Thread.currentThread().getContextClassLoader())
        return True
    except Exception:
        return False


# --- Avro schema → Spark / Arrow types --------------------------------------

def _is_ts_millis(t) -> bool:
    return isinstance(t, dict) and t.get("logicalType") == "timestamp-millis" and t.get("type") == "long"


def spark_type(t, field: dict | None = None) -> T.DataType:
    """Avro type → Spark type.  ``timestamp-millis`` on the type itself
    becomes TIMESTAMP_NTZ (UTC wall clock); on the field only, it is a long."""
    if isinstance(t, list):
        rest = [b for b in t if b != "null"]
        return spark_type(rest[0])
    if _is_ts_millis(t):
        return T.TimestampNTZType()
    if isinstance(t, dict):
        if t["type"] == "record":
            return T.StructType([T.StructField(f["name"], spark_type(f["type"], f)) for f in t["fields"]])
        return spark_type(t["type"])
    return {
        "string": T.StringType(), "bytes": T.BinaryType(), "boolean": T.BooleanType(),
        "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
        "double": T.DoubleType(), "null": T.NullType(),
    }[t]


def record_struct(schema: dict) -> T.StructType:
    return spark_type(schema)


def _arrow_type(dt: T.DataType) -> pa.DataType:
    if isinstance(dt, T.StructType):
        return pa.struct([pa.field(f.name, _arrow_type(f.dataType)) for f in dt.fields])
    return {
        T.StringType: pa.string(), T.BinaryType: pa.binary(), T.BooleanType: pa.bool_(),
        T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.FloatType: pa.float32(),
        T.DoubleType: pa.float64(), T.TimestampNTZType: pa.timestamp("us"),
        T.ShortType: pa.int16(), T.ByteType: pa.int8(),
    }[type(dt)]


def _to_arrow_value(v, dt: T.DataType):
    if v is None:
        return None
    if isinstance(dt, T.TimestampNTZType):
        return int(v) * 1000          # millis → micros
    if isinstance(dt, T.StructType):
        return {f.name: _to_arrow_value(v.get(f.name), f.dataType) for f in dt.fields}
    return v


def _defaults(schema: dict) -> dict:
    return {f["name"]: f.get("default") for f in schema["fields"]}


def _columns(recs: list, names: list[str], defaults: dict, rs: T.StructType) -> list[pa.Array]:
    """Decoded records (``None`` for a failed one) → one Arrow array per
    reader field; writer fields the reader lacks are dropped, reader fields
    the writer lacks take their default."""
    import pyarrow.compute as pc
    out = []
    for n in names:
        dt, d = rs[n].dataType, defaults.get(n)
        vals = [None if r is None else r.get(n, d) for r in recs]
        if isinstance(dt, T.TimestampNTZType):
            out.append(pc.multiply(pa.array(vals, pa.int64()), 1000).cast(pa.timestamp("us")))
        elif isinstance(dt, T.StructType):
            out.append(pa.array([_to_arrow_value(v, dt) for v in vals], _arrow_type(dt)))
        else:
            out.append(pa.array(vals, _arrow_type(dt)))
    return out


# --- encode -----------------------------------------------------------------

def encode(df: DataFrame, schema: dict, keep: list[str] = [], out_col: str = "value") -> DataFrame:
    """Rows (columns named as the record fields, timestamps as epoch ms) →
    ``keep`` + Avro body bytes."""
    ship_package(df.sparkSession)
    names = [f["name"] for f in schema["fields"]]
    schema_json = json.dumps(schema)
    out_schema = T.StructType([df.schema[k] for k in keep] + [T.StructField(out_col, T.BinaryType())])

    def run(batches):
        writer = codec.compile_writer(json.loads(schema_json))
        for b in batches:
            rows = b.select(names).to_pylist()
            bodies = []
            for r in rows:
                out = bytearray()
                writer(r, out)
                bodies.append(bytes(out))
            cols = [b.column(k) for k in keep] + [pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, out_col])

    return df.select(*keep, *[c for c in names if c not in keep]).mapInArrow(run, out_schema)


# --- decode -----------------------------------------------------------------

def _decoded_schema(df: DataFrame, keep: list[str], reader: dict, extra: list[T.StructField]):
    rs = record_struct(reader)
    return rs, T.StructType([df.schema[k] for k in keep] + extra + list(rs.fields)
                            + [T.StructField(ERROR, T.StringType())])


def decode(df: DataFrame, value: str, reader: dict, writer: dict | None = None,
           keep: list[str] = []) -> DataFrame:
    """Schemaless Avro bodies → ``keep`` + reader fields + ``_avro_error``."""
    ship_package(df.sparkSession)
    rs, out_schema = _decoded_schema(df, keep, reader, [])
    reader_json, writer_json = json.dumps(reader), json.dumps(writer or reader)

    def run(batches):
        rschema = json.loads(reader_json)
        rd = codec.compile_reader(json.loads(writer_json))
        names = [f["name"] for f in rschema["fields"]]
        defaults = _defaults(rschema)
        for b in batches:
            recs, errs = [], []
            for body in b.column(value).to_pylist():
                try:
                    recs.append(codec.decode_one(rd, body))
                    errs.append(None)
                except Exception as e:  # noqa: BLE001 - any decode failure is a reject
                    recs.append(None)
                    errs.append(f"avro decode failed: {e}")
            arrays = [b.column(k) for k in keep] + _columns(recs, names, defaults, rs)
            arrays.append(pa.array(errs, pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in out_schema.fields])

    return df.select(*keep, value).mapInArrow(run, out_schema)


def registry_from(df: DataFrame) -> dict[int, str]:
    """(schema_id, subject, avsc) rows → {id: avsc}; one row per schema version."""
    return {int(r[0]): r[1] for r in df.select("schema_id", "avsc").collect()}


def decode_framed(df: DataFrame, registry: dict[int, str], reader: dict,
                  keep: list[str] = [], value: str = "value") -> DataFrame:
    """``0x00`` + schema id + body → ``keep`` + schema_id + reader fields + error.

    Magic byte and id are read by Spark expressions; the body is decoded with
    its writer schema from ``registry`` and resolved to ``reader`` by field
    name (fields the writer lacks take the reader default)."""
    ship_package(df.sparkSession)
    framed = df.select(*keep, wire.frame_magic_ok(value).alias("_magic"),
                       wire.frame_schema_id(value).alias("schema_id"),
                       wire.frame_body(value).alias("_body"))
    rs, out_schema = _decoded_schema(framed, keep, reader,
                                     [T.StructField("schema_id", T.IntegerType())])
    reader_json, reg_json = json.dumps(reader), json.dumps({str(k): v for k, v in registry.items()})

    def run(batches):
        rschema = json.loads(reader_json)
        reg = {int(k): v for k, v in json.loads(reg_json).items()}
        readers: dict[int, object] = {}
        names = [f["name"] for f in rschema["fields"]]
        defaults = _defaults(rschema)
        for b in batches:
            recs, errs = [], []
            for ok, sid, body in zip(b.column("_magic").to_pylist(), b.column("schema_id").to_pylist(),
                                     b.column("_body").to_pylist()):
                rec, err = None, None
                if not ok:
                    err = "wrong magic byte"
                elif sid not in reg:
                    err = f"unknown schema id {sid}"
                else:
                    try:
                        if sid not in readers:
                            readers[sid] = codec.compile_reader(codec.parse_schema(reg[sid]))
                        rec = codec.decode_one(readers[sid], body)
                    except Exception as e:  # noqa: BLE001
                        err = f"avro decode failed: {e}"
                recs.append(rec)
                errs.append(err)
            arrays = [b.column(k) for k in keep] + [b.column("schema_id")]
            arrays += _columns(recs, names, defaults, rs)
            arrays.append(pa.array(errs, pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in out_schema.fields])

    return framed.mapInArrow(run, out_schema)


def frame_column(body: str | Column, schema_id: str | Column) -> Column:
    return wire.frame(body, schema_id)


# --- object containers ------------------------------------------------------

def to_containers(df: DataFrame, schema: dict, stage_col: str, codec_name: str = "deflate",
                  block_records: int = 1000) -> DataFrame:
    """Rows → one Avro container per (stage value, Spark partition).

    Output ``(stage_id, part, container)``: the staging table of the
    reference, with a logical file split into one container per task so no
    container grows with the data."""
    ship_package(df.sparkSession)
    names = [f["name"] for f in schema["fields"]]
    schema_json = json.dumps(schema)
    out_schema = T.StructType([T.StructField("stage_id", T.IntegerType()),
                               T.StructField("part", T.IntegerType()),
                               T.StructField("container", T.BinaryType())])

    def run(batches):
        from pyspark import TaskContext
        sch = json.loads(schema_json)
        groups: dict[int, list] = {}
        for b in batches:
            stages = b.column(stage_col).to_pylist()
            for st, rec in zip(stages, b.select(names).to_pylist()):
                groups.setdefault(st, []).append(rec)
        part = TaskContext.get().partitionId()
        for st in sorted(groups):
            blob = codec.write_container(sch, groups[st], codec=codec_name,
                                         sync=hashlib.md5(f"{st}/{part}".encode()).digest(),
                                         block_records=block_records)
            yield pa.RecordBatch.from_arrays(
                [pa.array([st], pa.int32()), pa.array([part], pa.int32()), pa.array([blob], pa.binary())],
                names=["stage_id", "part", "container"])

    return df.select(F.col(stage_col).cast("int").alias(stage_col), *names).mapInArrow(run, out_schema)


def split_containers(staged: DataFrame, reader: dict, id_col: str = "stage_id",
                     content_col: str = "container", part_col: str | None = "part") -> DataFrame:
    """Container blobs → one row per record.

    Output ``(container_id, container_part, avro_obj_id, avro, validity)``;
    ``avro`` is a struct in the reader schema (fields a v1 writer lacks are
    NULL), ``validity`` is ``OK`` or the error that stopped the container."""
    ship_package(staged.sparkSession)
    rs = record_struct(reader)
    out_schema = T.StructType([
        T.StructField("container_id", T.IntegerType()),
        T.StructField("container_part", T.IntegerType()),
        T.StructField("avro_obj_id", T.IntegerType()),
        T.StructField("avro", rs),
        T.StructField("validity", T.StringType()),
    ])
    reader_json = json.dumps(reader)
    cols = [F.col(id_col).cast("int").alias("_id"),
            (F.col(part_col).cast("int") if part_col else F.lit(0)).alias("_part"),
            F.col(content_col).alias("_blob")]

    def run(batches):
        rschema = json.loads(reader_json)
        names = [f["name"] for f in rschema["fields"]]
        defaults = _defaults(rschema)
        at = _arrow_type(rs)
        for b in batches:
            ids, parts, objs, recs, valid = [], [], [], [], []
            for cid, part, blob in zip(b.column("_id").to_pylist(), b.column("_part").to_pylist(),
                                       b.column("_blob").to_pylist()):
                n = 0
                try:
                    _, records = codec.read_container(blob)
                    for rec in records:
                        n += 1
                        ids.append(cid); parts.append(part); objs.append(n)
                        recs.append(_to_arrow_value(codec.resolve(rec, names, defaults), rs))
                        valid.append("OK")
                except Exception as e:  # noqa: BLE001
                    ids.append(cid); parts.append(part); objs.append(None)
                    recs.append(None); valid.append(f"invalid container: {e}")
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int32()), pa.array(parts, pa.int32()), pa.array(objs, pa.int32()),
                 pa.array(recs, at), pa.array(valid, pa.string())],
                names=[f.name for f in out_schema.fields])

    return staged.select(*cols).mapInArrow(run, out_schema)


# --- SQL surface: container split as a table function -----------------------

def register_container_split(spark: SparkSession, reader: dict,
                             name: str = "avro_container_split") -> None:
    """Register U1 for SQL: ``SELECT t.* FROM stage, LATERAL
    avro_container_split(stage_id, container) t`` (one row per record, with
    ``avro`` as a JSON text of the record in the reader schema and the
    validity text).  The DataFrame path (``split_containers``) is the batched
    one; this is the SQL-callable form."""
    ship_package(spark)
    from pyspark.sql.functions import udtf

    reader_json = json.dumps(reader)

    @udtf(returnType="container_id int, avro_obj_id int, avro string, validity string")
    class ContainerSplit:
        def __init__(self):
            self.rschema = json.loads(reader_json)
            self.names = [f["name"] for f in self.rschema["fields"]]
            self.defaults = _defaults(self.rschema)

        def eval(self, container_id, blob):
            n = 0
            try:
                _, records = codec.read_container(bytes(blob))
                for rec in records:
                    n += 1
                    yield container_id, n, json.dumps(codec.resolve(rec, self.names, self.defaults)), "OK"
            except Exception as e:  # noqa: BLE001
                yield container_id, None, None, f"invalid container: {e}"

    spark.udtf.register(name, ContainerSplit)


# --- container files read by block (large files, many tasks) ----------------

def _open_input(path: str):
    """Random-access file handle for a local, HDFS or object-store path."""
    from pyarrow import fs as pafs
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    if "://" in path:
        filesystem, inner = pafs.FileSystem.from_uri(path)
        return filesystem.open_input_file(inner)
    return pafs.LocalFileSystem().open_input_file(path)


def container_blocks(files_df: DataFrame, path_col: str = "path", id_col: str | None = None) -> DataFrame:
    """One row per data block of each container file: the header is read and
    block headers are walked by seeking past block data, so this pass reads a
    few bytes per block, not the file."""
    ship_package(files_df.sparkSession)
    out_schema = T.StructType([
        T.StructField("container_id", T.IntegerType()), T.StructField("path", T.StringType()),
        T.StructField("block_no", T.IntegerType()), T.StructField("block_offset", T.LongType()),
        T.StructField("block_records", T.LongType()), T.StructField("records_before", T.LongType()),
        T.StructField("block_size", T.LongType()),
        T.StructField("header_end", T.LongType()), T.StructField("error", T.StringType()),
    ])

    def run(batches):
        for b in batches:
            out = {f.name: [] for f in out_schema.fields}
            ids = b.column("_id").to_pylist()
            for cid, path in zip(ids, b.column("_path").to_pylist()):
                try:
                    with _open_input(path) as f:
                        size = f.size()
                        head = f.read_at(min(size, 1 << 20), 0)
                        while True:
                            try:
                                _, _, sync, pos = codec.read_header(head)
                                break
                            except (IndexError, KeyError, codec.AvroError):
                                if len(head) >= size:
                                    raise
                                head = f.read_at(min(size, len(head) * 4), 0)
                        header_end, n, before = pos, 0, 0
                        while pos < size:
                            probe = f.read_at(min(20, size - pos), pos)
                            count, p1 = codec.read_long(probe, 0)
                            nbytes, p2 = codec.read_long(probe, p1)
                            start = pos + p2
                            if f.read_at(codec.SYNC_SIZE, start + nbytes) != sync:
                                raise codec.AvroError("corrupt sync marker")
                            n += 1
                            for k, v in (("container_id", cid), ("path", path), ("block_no", n),
                                         ("block_offset", start), ("block_records", count),
                                         ("records_before", before), ("block_size", nbytes), ("header_end", header_end),
                                         ("error", None)):
                                out[k].append(v)
                            before += count
                            pos = start + nbytes + codec.SYNC_SIZE
                except Exception as e:  # noqa: BLE001
                    for k, v in (("container_id", cid), ("path", path), ("block_no", None),
                                 ("block_offset", None), ("block_records", None), ("records_before", None),
                                 ("block_size", None),
                                 ("header_end", None), ("error", f"invalid container: {e}")):
                        out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], _arrow_type(f.dataType)) for f in out_schema.fields],
                names=[f.name for f in out_schema.fields])

    ids = F.col(id_col).cast("int") if id_col else F.lit(None).cast("int")
    return files_df.select(ids.alias("_id"), F.col(path_col).alias("_path")).mapInArrow(run, out_schema)


def read_container_files(files_df: DataFrame, reader: dict, path_col: str = "path",
                         id_col: str | None = None, slices: int | None = None) -> DataFrame:
    """Records of Avro container files, decoded block by block in parallel.

    Blocks are spread over ``slices`` tasks (default: shuffle partitions), so a
    single large file is decoded by many tasks.  Output as of
    ``split_containers``; ``container_part`` is the block number, ``avro_obj_id``
    (long) counts the records of the file from 1."""
    spark = files_df.sparkSession
    blocks = container_blocks(files_df, path_col, id_col)
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rs = record_struct(reader)
    out_schema = T.StructType([
        T.StructField("container_id", T.IntegerType()), T.StructField("container_part", T.IntegerType()),
        T.StructField("avro_obj_id", T.LongType()), T.StructField("avro", rs),
        T.StructField("validity", T.StringType()),
    ])
    reader_json = json.dumps(reader)

    def run(batches):
        rschema = json.loads(reader_json)
        names = [f["name"] for f in rschema["fields"]]
        defaults = _defaults(rschema)
        at = _arrow_type(rs)
        headers: dict = {}
        for b in batches:
            cols = {k: [] for k in ("id", "part", "obj", "rec", "valid")}

            def emit(cid, part, obj, rec, valid):
                cols["id"].append(cid); cols["part"].append(part); cols["obj"].append(obj)
                cols["rec"].append(rec); cols["valid"].append(valid)
            for row in b.to_pylist():
                if row["error"] is not None:
                    emit(row["container_id"], None, None, None, row["error"])
                    continue
                try:
                    with _open_input(row["path"]) as f:
                        if row["path"] not in headers:
                            schema, cname, _, _ = codec.read_header(f.read_at(row["header_end"], 0))
                            headers[row["path"]] = (codec.compile_reader(schema), cname)
                        rd, cname = headers[row["path"]]
                        data = f.read_at(row["block_size"], row["block_offset"])
                    for i, rec in enumerate(codec.block_records(data, row["block_records"], cname, rd), row["records_before"] + 1):
                        emit(row["container_id"], row["block_no"], i,
                             _to_arrow_value(codec.resolve(rec, names, defaults), rs), "OK")
                except Exception as e:  # noqa: BLE001
                    emit(row["container_id"], row["block_no"], None, None, f"invalid block: {e}")
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols["id"], pa.int32()), pa.array(cols["part"], pa.int32()),
                 pa.array(cols["obj"], pa.int64()), pa.array(cols["rec"], at),
                 pa.array(cols["valid"], pa.string())],
                names=[f.name for f in out_schema.fields])

    return blocks.repartition(n).mapInArrow(run, out_schema)


def write_container_files(staged: DataFrame, root: str) -> DataFrame:
    """Write each staged container (``stage_id, part, container``) as an
    ``.avro`` file under ``root`` from the task that holds it; returns the
    manifest rows ``(stage_id, path)``.  Names are deterministic, so a retried
    task overwrites its own file."""
    ship_package(staged.sparkSession)
    out_schema = T.StructType([T.StructField("stage_id", T.IntegerType()),
                               T.StructField("path", T.StringType())])

    def run(batches):
        from pyarrow import fs as pafs
        for b in batches:
            ids, paths = [], []
            for st, part, blob in zip(b.column("stage_id").to_pylist(), b.column("part").to_pylist(),
                                      b.column("container").to_pylist()):
                target = f"{root.rstrip('/')}/stage={st}/part-{part:05d}.avro"
                if "://" in target and not target.startswith("file:"):
                    filesystem, inner = pafs.FileSystem.from_uri(target)
                else:
                    filesystem, inner = pafs.LocalFileSystem(), target.replace("file:", "", 1)
                filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with filesystem.open_output_stream(inner) as out:
                    out.write(blob)
                ids.append(st); paths.append(target)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(paths, pa.string())],
                                             names=["stage_id", "path"])

    return staged.mapInArrow(run, out_schema)
