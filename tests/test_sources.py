"""Sources and sinks on temporary folders."""
import os
import struct
import zlib

from pyspark.sql import functions as F

from quarry.sources import readers as rd
from quarry.sources import sinks as sk


def test_lines_and_documents(spark, tmp_dir):
    for topic, name, text in [("sport", "a.txt", "x y\nz"), ("tech", "b.txt", "hello")]:
        os.makedirs(os.path.join(tmp_dir, topic), exist_ok=True)
        with open(os.path.join(tmp_dir, topic, name), "w") as f:
            f.write(text)
    assert rd.read_lines(spark, tmp_dir + "/*/*").count() == 3
    docs = {r["topic"]: r["text"] for r in rd.read_documents(spark, tmp_dir + "/*/*").collect()}
    assert docs == {"sport": "x y\nz", "tech": "hello"}


def test_delimited_typed_and_ragged(spark, tmp_dir):
    p = os.path.join(tmp_dir, "r.tsv")
    with open(p, "w") as f:
        f.write("1\t10\t4.5\n2\tbad\t3\n3\t30\n")
    typed = rd.read_delimited(spark, p, "\t", "user int, item int, rating double").collect()
    assert typed[1]["item"] is None and typed[2]["rating"] is None
    ragged = [r[0] for r in rd.read_delimited(spark, p, "\t").collect()]
    assert [len(x) for x in ragged] == [3, 3, 2]


def test_libsvm_roundtrip(spark, tmp_dir):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(1.0, Vectors.sparse(5, [0, 3], [1.5, 2.0])), (0.0, Vectors.dense([0, 1, 0, 0, 2]))],
                               ["label", "features"])
    out = os.path.join(tmp_dir, "svm")
    df.write.format("libsvm").save(out)
    back = rd.read_libsvm(spark, out, 5).orderBy("label").collect()
    assert back[1]["features"][3] == 2.0 and back[0]["features"].size == 5


def test_part_files_ignore_decoys_and_ids_per_file(spark, tmp_dir):
    sep = rd.PART_SEP
    rows1 = [sep.join([str(i)] + ["x"] * 8 + [("0-956955-" if i % 2 else "other") + str(i)]) for i in range(6)]
    with open(os.path.join(tmp_dir, "part-00000"), "w") as f:
        f.write("\n".join(rows1) + "\n")
    with open(os.path.join(tmp_dir, "part-00001"), "w") as f:
        f.write(sep.join(["77"] + ["y"] * 8 + ["a0-956955"]) + "\n")
    with open(os.path.join(tmp_dir, "_SUCCESS"), "w") as f:
        f.write(sep.join(["99"] + ["z"] * 8 + ["0-956955"]) + "\n")
    ids = {os.path.basename(r["file_path"]): r["ids"] for r in rd.category_ids(spark, tmp_dir, "0-956955").collect()}
    assert ids == {"part-00000": "1,3,5", "part-00001": "77"}


def _png(path, w, h, value):
    raw = b"".join(b"\x00" + bytes([value, value, value]) * w for _ in range(h))
    def chunk(t, d):
        return struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + \
        chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    with open(path, "wb") as f:
        f.write(png)


def test_images_to_pixels(spark, tmp_dir):
    from quarry.operators.reduce import pixel_vectors
    os.makedirs(os.path.join(tmp_dir, "p1"))
    _png(os.path.join(tmp_dir, "p1", "a.png"), 8, 6, 200)
    _png(os.path.join(tmp_dir, "p1", "b.png"), 4, 4, 10)
    with open(os.path.join(tmp_dir, "p1", "broken.png"), "wb") as f:
        f.write(b"no image")
    assert rd.read_images(spark, tmp_dir + "/*/*").where(F.col("image.height") < 0).count() == 1
    imgs = rd.read_images(spark, tmp_dir + "/*/*", drop_invalid=True)
    px = {os.path.basename(r["origin"]): r["pixels"] for r in pixel_vectors(imgs, 5, 5).collect()}
    assert len(px["a.png"]) == 25 and set(px["a.png"]) == {200.0} and set(px["b.png"]) == {10.0}


def test_sinks(spark, tmp_dir):
    df = spark.createDataFrame([("0.2 0.2 0.2", 0), ("8 8 8", 1)], "line string, cluster int")
    out = os.path.join(tmp_dir, "lines")
    from quarry.operators.shape import annotate_line
    sk.write_lines(df.select(annotate_line("line", "cluster")), out)
    assert sorted(r[0] for r in spark.read.text(out).collect()) == ["0.2 0.2 0.2 0", "8 8 8 1"]
    csv = os.path.join(tmp_dir, "csv")
    sk.write_csv(spark.createDataFrame([(1, 2.5)], "i int, value double"), csv)
    assert spark.read.option("header", True).csv(csv).first()["value"] == "2.5"
    kf = sk.kafka_frame(df, "line")
    assert kf.columns == ["key", "value"] and kf.where(F.col("key").isNull()).count() == 2


def test_images_written_and_read_again(spark, tmp_dir):
    from quarry.operators.reduce import pixel_vectors
    rows = [(i, bytes((i * 7 + j * 11) % 256 for j in range(12))) for i in range(20)] + [(99, None)]
    df = spark.createDataFrame(rows, "id long, raw binary").repartition(3)
    out = os.path.join(tmp_dir, "img")
    assert sk.write_images(df, out, "id", "raw", 4, 3) == 20
    back = pixel_vectors(rd.read_images(spark, out), 4, 3).collect()
    got = {int(os.path.basename(r["origin"])[:-4]): r["pixels"] for r in back}
    assert got == {i: [float(x) for x in raw] for i, raw in rows if raw is not None}


def test_kafka_shapes(spark):
    from quarry.streaming import streams as st
    df = spark.createDataFrame([("a", 1), (None, 2)], "value string, n int")
    assert [tuple(r) for r in sk.kafka_frame(df).collect()] == [(None, "a"), (None, None)]
    wire = spark.createDataFrame([(bytearray(b"k"), bytearray("é,1".encode()), "topic")], "key binary, value binary, topic string")
    assert [tuple(r) for r in st.kafka_values(wire).collect()] == [("é,1",)]


def test_literal_rows(spark):
    df = rd.from_rows(spark, [("a", 1), (None, None)], "w string, n int")
    assert df.columns == ["w", "n"] and df.count() == 2 and rd.from_rows(spark, [], "w string").count() == 0
