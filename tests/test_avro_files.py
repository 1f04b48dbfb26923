"""Avro codec and containers (S5, S6, S10, K8, U1) and file sources/sinks."""

import glob
import os

from pyspark.sql import functions as F

from conftest import positions_df
from tidewater.functions import avro_codec as codec
from tidewater.schemas import AVRO_POSITION, AVRO_PRODUCT_V1, AVRO_PRODUCT_V2
from tidewater.sources import avro, files


def test_codec_roundtrip_all_types():
    schema = {"type": "record", "name": "R", "fields": [
        {"name": "s", "type": "string"}, {"name": "i", "type": "int"}, {"name": "l", "type": "long"},
        {"name": "d", "type": "double"}, {"name": "f", "type": "float"}, {"name": "b", "type": "boolean"},
        {"name": "y", "type": "bytes"}, {"name": "n", "type": ["null", "string"]},
        {"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}}]}
    rec = {"s": "héllo", "i": -5, "l": 2 ** 40, "d": 1e-4, "f": 0.5, "b": True, "y": b"\x00\x01",
           "n": None, "t": -1}
    out = bytearray()
    codec.compile_writer(schema)(rec, out)
    assert codec.decode_one(codec.compile_reader(schema), bytes(out)) == rec


def test_container_codecs_blocks_and_corruption():
    recs = [{"product_id": str(i), "name": "n", "price": 1.5, "category": "c", "ts": i} for i in range(25)]
    for name in ("null", "deflate"):
        blob = codec.write_container(AVRO_PRODUCT_V1, recs, codec=name, block_records=10)
        schema, it = codec.read_container(blob)
        assert list(it) == recs and schema["name"] == "Product"
    blob = bytearray(codec.write_container(AVRO_PRODUCT_V1, recs, block_records=10))
    blob[-1] ^= 0xFF                                        # last sync marker
    _, it = codec.read_container(bytes(blob))
    try:
        list(it)
        raise AssertionError("corruption not detected")
    except codec.AvroError as e:
        assert "sync" in str(e)
    _, it = codec.read_container(codec.write_container(AVRO_PRODUCT_V1, []))
    assert list(it) == []


def test_split_resolves_v1_to_v2(spark):
    v1 = codec.write_container(AVRO_PRODUCT_V1, [
        {"product_id": "a", "name": "n", "price": 2.0, "category": "c", "ts": 1000}])
    v2 = codec.write_container(AVRO_PRODUCT_V2, [
        {"product_id": "b", "name": "m", "price": 3.0, "category": "c", "ts": 2000,
         "description": "d", "subcategory": None, "discount_pct": 25.0}], codec="deflate")
    staged = spark.createDataFrame([(1, bytearray(v1)), (2, bytearray(v2)), (3, bytearray(b"junk"))],
                                   "stage_id int, container binary")
    rows = {r["container_id"]: r for r in avro.split_containers(staged, AVRO_PRODUCT_V2, part_col=None).collect()}
    assert rows[1]["avro"]["discount_pct"] is None and rows[1]["validity"] == "OK"
    assert rows[1]["avro"]["ts"].year == 1970
    assert rows[2]["avro"]["discount_pct"] == 25.0 and rows[2]["avro_obj_id"] == 1
    assert rows[3]["validity"].startswith("invalid container")


def test_framed_decode_routes_bad_frames(spark):
    rows = positions_df(spark, 4).select(
        "offset", "icao24", "callsign", "latitude", "longitude", "altitude", "velocity", "heading",
        "vertical_rate", "on_ground", "squawk", F.col("ts_ms").alias("ts"))
    bodies = avro.encode(rows, AVRO_POSITION, keep=["offset"])
    framed = bodies.select("offset", F.when(F.col("offset") == 1, F.lit(9)).otherwise(1).alias("sid"), "value")
    framed = framed.select("offset", F.when(F.col("offset") == 2, F.concat(F.unhex(F.lit("01")), F.col("value")))
                           .when(F.col("offset") == 3, F.substring(avro.frame_column("value", "sid"), 1, 9))
                           .otherwise(avro.frame_column("value", "sid")).alias("value"))
    out = {r["offset"]: r for r in avro.decode_framed(framed, {1: __import__("json").dumps(AVRO_POSITION)},
                                                      AVRO_POSITION, keep=["offset"]).collect()}
    assert out[0][avro.ERROR] is None and out[0]["icao24"] == "4ca87a"
    assert out[1][avro.ERROR] == "unknown schema id 9"
    assert out[2][avro.ERROR] == "wrong magic byte"
    assert out[3][avro.ERROR].startswith("avro decode failed")


def test_one_file_per_message_and_header_per_file(spark, tmp_path):
    from conftest import text_messages
    root = str(tmp_path / "csv")
    docs = ["station_id,v\r\nEGLL,1\r\nEHAM,2\r\n", "station_id,v\r\nKJFK,3"]
    files.write_hour_folders(text_messages(spark, docs), root)
    written = sorted(glob.glob(os.path.join(root, "landing_date=*", "landing_hour=*", "batch=*", "part-*")))
    assert len(written) == 2
    contents = sorted(open(p, "rb").read() for p in written)
    assert contents == sorted([docs[0].encode(), docs[1].encode() + b"\n"])
    scan = files.read_csv_folder(spark, ["station_id", "v"], root=root)
    assert sorted(r["station_id"] for r in scan.collect()) == ["EGLL", "EHAM", "KJFK"]
    assert {r["landing_hour"] for r in scan.collect()} == {"12"}
    listing = files.list_objects(spark, root, "part-*")
    assert listing.count() == 2 and "content" not in listing.columns


def test_dated_layout_and_path_segments(spark, tmp_path):
    import datetime as dt
    from conftest import text_messages
    root = str(tmp_path / "raw")
    for _ in range(2):      # a retried batch replaces its own folder
        files.write_hour_folders(text_messages(spark, ["h\r\nx"]), root, layout=files.DATED, batch_name="b1")
    hours = files.hours_between(dt.datetime(2026, 6, 22, 11, 30), dt.datetime(2026, 6, 22, 13, 0))
    paths = files.hour_paths(root, hours, files.DATED)
    assert paths[-1].endswith("2026-06-22/12") and len(paths) == 2
    assert files.existing(spark, paths) == paths[-1:]
    df = files.read_csv_folder(spark, ["h"], paths=paths[-1:], layout=files.DATED)
    assert df.count() == 1
    r = df.first()
    assert (r["h"], r["landing_date"], r["landing_hour"]) == ("x", "2026-06-22", "12")
    seg = df.select(*files.path_segments("path", root)).first()
    assert (seg["var1"], seg["var2"], seg["var3"]) == ("2026-06-22", "12", "b1")


def test_manifest_whole_file_read(spark, tmp_path):
    v1 = tmp_path / "product_v1.avro"
    v1.write_bytes(codec.write_container(AVRO_PRODUCT_V1, [
        {"product_id": "a", "name": "n", "price": 2.0, "category": "c", "ts": 1}]))
    manifest = tmp_path / "manifest.txt"
    manifest.write_text(f"1|{v1}\n2|{tmp_path / 'missing.avro'}\n")
    staged = {r["stage_id"]: r for r in files.load_manifest_files(spark, str(manifest)).collect()}
    assert staged[1]["error"] is None and bytes(staged[1]["container"])[:4] == b"Obj\x01"
    assert staged[2]["container"] is None and "missing.avro" in staged[2]["error"]


def test_manifest_paths_of_every_spelling(spark, tmp_path):
    """Schemes, doubled slashes, relative paths, one file twice, and files that
    the manifest does not name."""
    (tmp_path / "in" / "deep").mkdir(parents=True)
    for name, body in (("a.bin", b"aa"), ("b.bin", b"bb"), ("e.bin", b""), ("deep/c d%20.bin", b"\x00\xff"), ("unlisted.bin", b"zz")):
        (tmp_path / "in" / name).write_bytes(body)
    root = tmp_path / "in"
    lines = [f"1|{root}/a.bin", f"2|file://{root}/b.bin", f"3|file:{root}//deep/c d%20.bin", f"4|{root}/a.bin", f"5|{root}/none.bin", "6|", f"7|{root}/e.bin"]
    manifest = tmp_path / "manifest.txt"
    manifest.write_text("\n".join(lines) + "\n")
    for how in ({}, {"root": str(root)}):
        got = {r["stage_id"]: (None if r["container"] is None else bytes(r["container"]), r["error"]) for r in files.load_manifest_files(spark, str(manifest), **how).collect()}
        assert {k: v[0] for k, v in got.items()} == {1: b"aa", 2: b"bb", 3: b"\x00\xff", 4: b"aa", 5: None, 6: None, 7: None}, how
        assert {k for k, v in got.items() if v[1]} == {5, 6, 7}
    manifest.write_text("1|a.bin\n2|deep/c d%20.bin\n")
    got = {r["stage_id"]: bytes(r["container"]) for r in files.load_manifest_files(spark, str(manifest), root=str(root)).collect()}
    assert got == {1: b"aa", 2: b"\x00\xff"}
    manifest.write_text("1|/nowhere/at/all.bin\n")
    assert [r["container"] for r in files.load_manifest_files(spark, str(manifest)).collect()] == [None]


def test_scoped_load_lists_only_its_folders(spark, tmp_path):
    import datetime as dt
    from conftest import text_messages
    from tidewater.operators.warehouse import PartitionedTable
    from tidewater.schemas import WEATHER_CSV_FIELDS, WEATHER_OBS, struct_of
    from tidewater.streaming import pipelines as P

    header = ",".join(WEATHER_CSV_FIELDS)
    line = "EGLL,2026-06-22 {h:02d}:10:00,12.5,10,270,9999,0.00,1013.2,VFR"
    bad = ["EGLL,2026-06-22 11:11:00,hot,10,270,9999,0.00,1013.2,VFR", "EGLL,2026-06-22 11:12:00", header, f" {header.replace(',', ' , ')} ", ",,,,,,,,"]
    for layout in (files.HIVE, files.DATED):
        root = str(tmp_path / layout)
        for k, h in enumerate((10, 11, 12)):
            lines = [header, line.format(h=h), *(bad if h == 11 else [])]
            msgs = text_messages(spark, ["\r\n".join(lines) + "\r\n"]).withColumn("timestamp", F.lit(dt.datetime(2026, 6, 22, h, 30)))
            files.write_hour_folders(msgs, root, layout=layout, batch_name=f"b{k}")
        hours = files.hours_between(dt.datetime(2026, 6, 22, 11), dt.datetime(2026, 6, 22, 14))
        paths = files.existing(spark, files.hour_paths(root, hours, layout))
        assert len(paths) == 2                         # 13 o'clock is not there
        scan = files.read_csv_folder(spark, WEATHER_CSV_FIELDS, root=root, paths=paths, layout=layout, corrupt=True)
        listed = scan.inputFiles()
        assert listed and all(("landing_hour=10" not in f) and ("/22/10/" not in f) and ("-22/10/" not in f) for f in listed)
        schema = struct_of(WEATHER_OBS).add("landing_date", "string").add("landing_hour", "string")
        table = PartitionedTable(spark, str(tmp_path / f"obs-{layout}"), schema, P.HOUR_KEYS)
        quarantine = P.hour_rejects(spark, str(tmp_path / f"bad-{layout}"))
        for _ in range(2):
            P.load_hours(spark, root, WEATHER_CSV_FIELDS, WEATHER_OBS, table, hours, layout, quarantine)
        assert sorted((r["landing_hour"], str(r["observation_ts"])[11:16]) for r in table.read().collect()) == [("11", "11:10"), ("12", "12:10")]
        told = sorted((r["error_stage"], r["error_column"], r["line"]) for r in quarantine.read().collect())
        assert [x[:2] for x in told] == [("CAST", "station_id"), ("CAST", "temperature_c"), ("PARSE", None)]
        assert told[2][2].startswith("EGLL,2026-06-22 11:12:00") and told[0][2] == ",,,,,,,,"
        none = files.read_csv_folder(spark, WEATHER_CSV_FIELDS, root=root, paths=[], layout=layout, corrupt=True)
        assert none.count() == 0 and none.columns == scan.columns


def test_container_files_read_by_block(spark, tmp_path):
    recs = [{"product_id": str(i), "name": "n", "price": float(i), "category": "c", "ts": i} for i in range(250)]
    staged = spark.createDataFrame(
        [(1, 0, bytearray(codec.write_container(AVRO_PRODUCT_V1, recs, codec="deflate", block_records=40))),
         (2, 0, bytearray(codec.write_container(AVRO_PRODUCT_V2, [
             {"product_id": "x", "name": "m", "price": 1.0, "category": "c", "ts": 1,
              "description": "d", "subcategory": "s", "discount_pct": 30.0}])))],
        "stage_id int, part int, container binary")
    manifest = avro.write_container_files(staged, str(tmp_path / "out")).collect()
    assert len(manifest) == 2
    files_df = spark.createDataFrame([(r["stage_id"], r["path"]) for r in manifest], "stage_id int, path string")
    blocks = avro.container_blocks(files_df, id_col="stage_id")
    assert blocks.where("container_id = 1").count() == 7          # 250 records, 40 per block
    rows = avro.read_container_files(files_df, AVRO_PRODUCT_V2, id_col="stage_id", slices=4)
    assert rows.where("validity = 'OK'").count() == 251
    got = sorted(int(r["avro"]["product_id"]) for r in rows.where("container_id = 1").collect())
    assert got == list(range(250))
    # one number per record of the file, across its blocks
    assert sorted(r["avro_obj_id"] for r in rows.where("container_id = 1").collect()) == list(range(1, 251))
    assert rows.where("container_id = 2").first()["avro"]["discount_pct"] == 30.0


def test_avro_blob_pipeline_reports_missing_file(spark, tmp_path):
    from tidewater.streaming.pipelines import avro_blob_load
    v1 = tmp_path / "product_v1.avro"
    v1.write_bytes(codec.write_container(AVRO_PRODUCT_V1, [
        {"product_id": str(i), "name": "n", "price": 2.0, "category": "c", "ts": i} for i in range(30)]))
    manifest = tmp_path / "manifest.txt"
    manifest.write_text(f"1|{v1}\n2|{tmp_path / 'missing.avro'}\n")
    out = avro_blob_load(spark, str(manifest), AVRO_PRODUCT_V2, str(tmp_path / "avro_product"))
    counts = {r["validity"][:7]: r["count"] for r in out.groupBy("validity").count().collect()}
    assert counts["OK"] == 30 and counts["invalid"] == 1
