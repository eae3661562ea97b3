import gzip
import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tallyforge.sources import binary, delimited, messages, sinks


def _png(path, rows):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    height, width = len(rows), len(rows[0])
    raw = b"".join(b"\x00" + bytes(v for px in row for v in px) for row in rows)
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_digits(spark, tmp_path):
    pixels = [[0, 1, 2, 3, 4, 200], [255, 128, 127, 9, 8, 7]]
    body = struct.pack(">iiii", 2051, 2, 2, 3) + bytes(sum(pixels, []))
    (tmp_path / "train-images-idx3-ubyte").write_bytes(body)
    (tmp_path / "test-images-idx3-ubyte.gz").write_bytes(gzip.compress(body))
    for name, labels in (("train", (7, 3)), ("test", (1, 2))):
        (tmp_path / f"{name}-labels-idx1-ubyte").write_bytes(struct.pack(">ii", 2049, 2) + bytes(labels))
    images = binary.read_digit_images(spark, f"{tmp_path}/*images*")
    labels = binary.read_digit_labels(spark, f"{tmp_path}/*labels*")
    got = {(r.set, r.idx): (r.label, r.features) for r in binary.labelled_digits(images, labels).collect()}
    assert got == {
        ("train", 0): (7.0, pixels[0]), ("train", 1): (3.0, pixels[1]),
        ("test", 0): (1.0, pixels[0]), ("test", 1): (2.0, pixels[1]),
    }
    with pytest.raises(Exception, match="magic number"):
        binary.read_digit_images(spark, f"{tmp_path}/train-labels*").collect()


def test_pictures(spark, tmp_path):
    _png(tmp_path / "a.png", [[(255, 0, 0), (0, 255, 0)], [(0, 0, 255), (255, 255, 255)]])
    (row,) = binary.read_pictures(spark, str(tmp_path), 2, 2).collect()
    assert row.features == [76.0, 150.0, 29.0, 255.0]
    (big,) = binary.read_pictures(spark, str(tmp_path), 4, 4).collect()
    assert len(big.features) == 16 and big.features[:4] == [76.0, 76.0, 150.0, 150.0]
    assert binary.read_files(spark, str(tmp_path)).select("length").first()[0] > 0


def test_delimited(spark, tmp_path):
    (tmp_path / "u").write_text("1|24|M|technician|85711\n")
    assert tuple(delimited.read_users(spark, str(tmp_path / "u")).first()) == (1, 24, "M", "technician", "85711")
    (tmp_path / "r").write_text("196\t242\t3\t881250949\n")
    assert tuple(delimited.read_ratings(spark, str(tmp_path / "r")).first()) == (196, 242, 3.0)
    flags = "|".join(["0"] * 18 + ["1"])
    (tmp_path / "i").write_bytes(f"543|Misérables, Les (1995)|01-Jan-1995||url|{flags}\n267|unknown||||{flags}\n".encode("latin-1"))
    items = {r.item_id: r for r in delimited.read_items(spark, str(tmp_path / "i")).collect()}
    assert items[543].title == "Misérables, Les (1995)" and items[267].release == "" and sum(items[543].flags) == 1
    (tmp_path / "g").write_text("unknown|0\nAction|1\n\n")
    assert sorted(map(tuple, delimited.read_dictionary(spark, str(tmp_path / "g")).collect())) == [(0, "unknown"), (1, "Action")]
    (tmp_path / "l").write_text('"u"\t"1"\t"{}"\t"news"\t"0.5"\t"?"\t"-2"\t"1"\n')
    assert tuple(delimited.read_labelled(spark, str(tmp_path / "l")).first()) == (1.0, "news", [0.5, 0.0, -2.0])
    (tmp_path / "p").write_text("1 2\n3 4\n")
    assert [r[0] for r in delimited.read_points(spark, str(tmp_path / "p")).collect()] == [[1, 2], [3, 4]]
    assert delimited.from_rows(spark, [(1, 2.0)], "a int, b double").first().b == 2.0


def test_sinks(spark, tmp_path):
    df = spark.range(10).select("id", F.array(F.col("id") * 1.0, F.col("id") * 2.0).alias("v")).repartition(4)
    flat = sinks.spread(df, "v", ["x", "y"])
    sinks.write_single(flat, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    sinks.write_delimited(flat, str(tmp_path / "many"), " ")
    back = delimited.read_centres(spark, str(tmp_path / "many"))
    assert sorted(r.id for r in back.collect()) == list(range(10))


def test_broker_options():
    o = messages.subscribe("h:1", ["b", "a"], {"a": {1: 5, 0: -1}}, per_trigger=10)
    assert o["subscribe"] == "b,a" and json.loads(o["startingOffsets"]) == {"a": {"0": -1, "1": 5}}
    assert o["maxOffsetsPerTrigger"] == "10"
    assert messages.subscribe("h:1", ["a"])["startingOffsets"] == "latest"
    assert json.loads(messages.assign("h:1", {"a": {2: 7}})["assign"]) == {"a": [2]}


def test_json_rows(spark):
    rows = [
        ('{"rowKey":"k","rowData":{"loginfo":{"content":"c","level":"INFO"}}}',),
        ('{"rowKey":"m","rowData":{"other":{"x":"y"}}}',),
        ('{"rowKey":',),
    ]
    parsed = messages.parsed_rows(spark.createDataFrame(rows, "value string"))
    good, bad = messages.good_and_bad(parsed)
    got = {r.row_key: (r.content, r.level) for r in messages.log_columns(good).collect()}
    assert got == {"k": ("c", "INFO"), "m": (None, None)} and bad.count() == 1
