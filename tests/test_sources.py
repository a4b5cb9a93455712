"""Readers and writers."""

import glob
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rankflow.operators.batching import assign_shards, train_valid_split
from rankflow.operators.ordering import sort_by_position
from rankflow.session import session_settings
from rankflow.sources import labels, records, text

CSV = """{header}
a,b,NL,"x, y",4,5,6,7,8,9,10,11,12,13,{stamp}
a,b,,x,4,5,6,7,8,9,10,11,12,13,7
"""


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as file:
        file.write(content)
    return path


def test_csv_headers_nulls_and_quotes(spark, fresh_dir):
    header = ",".join(f"c{i}" for i in range(15))
    for name, stamp in (("one", 5), ("two", 3)):
        put(f"{fresh_dir}/in/{name}.csv", CSV.format(header=header, stamp=stamp))
    table = text.read_table(spark, fresh_dir + "/in")
    assert {kind for _, kind in table.dtypes} == {"string"}
    rows = sort_by_position(table, 2, 14).collect()
    assert [(r["c2"], r["c14"]) for r in rows] == [(None, "7"), (None, "7"), ("NL", "3"), ("NL", "5")]
    assert rows[2]["c3"] == "x, y"


def test_short_csv_rows_give_nulls(spark, fresh_dir):
    path = put(fresh_dir + "/in.csv", "a,b,c\n1,2\n")
    assert tuple(text.read_table(spark, path, schema="a string, b string, c string").first()) == ("1", "2", None)


def test_repeated_paths_count_twice(spark, fresh_dir):
    one, two = put(fresh_dir + "/1", "x\ny\n"), put(fresh_dir + "/2", "z\n")
    values = [r[0] for r in text.read_lines(spark, one, two, one).collect()]
    assert sorted(values) == ["x", "x", "y", "y", "z"]


def test_rank_lines(spark, fresh_dir):
    ranks = spark.createDataFrame([("a", 1.0), ("b", 0.575)], "node string, rank double")
    text.write_ranks(ranks, fresh_dir + "/out", single=True)
    assert len(glob.glob(fresh_dir + "/out/part-*")) == 1
    assert sorted(r[0] for r in spark.read.text(fresh_dir + "/out").collect()) == ["(a,1.0)", "(b,0.575)"]


@pytest.mark.parametrize("single", [True, False])
def test_sorted_output_is_in_file_order(spark, fresh_dir, single):
    df = spark.range(200).select(F.lpad(F.pmod(F.col("id") * 37, F.lit(200)).cast("string"), 3, "0").alias("k"))
    text.write_lines(df, fresh_dir + "/lines", ["k"], "k", single=single)
    text.write_table(df.orderBy("k"), fresh_dir + "/table", single=single)
    expected = [f"{i:03d}" for i in range(200)]
    parts = sorted(glob.glob(fresh_dir + "/lines/part-*"))
    assert (len(parts) == 1) == single
    assert [line for part in parts for line in open(part).read().split()] == expected
    parts = sorted(glob.glob(fresh_dir + "/table/part-*"))
    assert [line for part in parts for line in open(part).read().split() if line != "k"] == expected


def test_files_with_headers_of_their_own(spark, fresh_dir):
    put(f"{fresh_dir}/in/1.csv", "k,v\r\n1,a\r\nk,v\r\n")
    put(f"{fresh_dir}/in/2.csv", "key,other\n2,b\nkey,other\n1,a\n\n")
    put(f"{fresh_dir}/in/3.csv", "k,v")
    rows = text.read_raw_table(spark, fresh_dir + "/in", fresh_dir + "/in/1.csv")
    got = sorted((str(r["k"]), str(r["v"]), r["line"]) for r in rows.collect())
    first = [("1", "a", "1,a"), ("k", "v", "k,v")]
    assert got == sorted(2 * first + [("2", "b", "2,b"), ("key", "other", "key,other"), ("1", "a", "1,a"), ("None", "None", "")])


def test_places_are_byte_offsets_in_small_blocks(spark, fresh_dir):
    content = [f"line {i} " + "é" * (i % 7) for i in range(500)]
    put(f"{fresh_dir}/in/a.txt", "\n".join(content) + "\n")
    put(f"{fresh_dir}/in/b.txt", "\n".join(reversed(content)))
    settings = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.execution.arrow.maxRecordsPerBatch": "9"}
    with session_settings(spark, settings):
        rows = text.read_placed_lines(spark, fresh_dir + "/in").collect()
    ordered = [r["value"] for r in sorted(rows, key=lambda r: r["place"])]
    assert ordered == content + content[::-1]
    assert len({(r["place"]["file"], r["place"]["block"]) for r in rows}) > 20
    # Offsets of a block's lines follow from the lengths of those before them.
    blocks = {}
    for r in sorted(rows, key=lambda r: r["place"]):
        key = r["place"]["file"], r["place"]["block"]
        assert r["place"]["offset"] == blocks.get(key, 0)
        blocks[key] = blocks.get(key, 0) + len(r["value"].encode()) + 1


def test_one_file_is_written_by_many_tasks(spark, fresh_dir):
    df = spark.range(1000).repartition(7).select(F.col("id").alias("a"), (F.col("id") * 2).alias("b"))
    text.write_table(df, fresh_dir + "/table", single=True)
    (path,) = glob.glob(fresh_dir + "/table/part-*")
    lines = open(path).read().split()
    assert lines[0] == "a,b" and sorted(lines[1:]) == sorted(f"{i},{2 * i}" for i in range(1000))
    shown = [name for name in os.listdir(fresh_dir + "/table") if not name.startswith(".")]
    assert sorted(shown) == ["_SUCCESS", "part-00000.csv"]
    assert not glob.glob(fresh_dir + "/table/_parts*")
    assert text.read_table(spark, fresh_dir + "/table").count() == 1000
    text.write_table(df.filter("false"), fresh_dir + "/none", single=True)
    assert open(fresh_dir + "/none/part-00000.csv").read() == "a,b\n"
    text.write_lines(df.filter("false").select(F.col("a").cast("string")), fresh_dir + "/empty", ["a"], "a", single=True)
    assert spark.read.text(fresh_dir + "/empty").count() == 0


def test_half_a_label_map_is_absent(spark, fresh_dir):
    broken = spark.createDataFrame([(i, "x") for i in range(50)], "label int, name string").repartition(5).withColumn(
        "name", F.when(F.col("label") == 17, F.raise_error(F.lit("broken"))).otherwise(F.col("name"))
    )
    with pytest.raises(PySparkException):
        labels.write_label_map(broken, fresh_dir)
    # What a task of a lost job leaves.
    put(f"{fresh_dir}/labels.txt/part-00000-lost.txt", "9:lost\n")
    assert not labels.has_label_map(spark, fresh_dir)
    built = labels.load_or_build(spark, fresh_dir, lambda: spark.createDataFrame([(1, "a")], "label int, name string"))
    assert [tuple(r) for r in built.collect()] == [(1, "a")] and labels.has_label_map(spark, fresh_dir)
    put(f"{fresh_dir}/labels.txt/part-99999-late.txt", "9:late\n")
    assert [tuple(r) for r in labels.read_label_map(spark, fresh_dir).collect()] == [(1, "a")]
    put(fresh_dir + "/plain/labels.txt", "3:c\n")
    assert [tuple(r) for r in labels.read_label_map(spark, fresh_dir + "/plain").collect()] == [(3, "c")]


def test_class_folders_of_a_written_table(spark, fresh_dir):
    df = spark.createDataFrame([("x", "a+b:c"), ("y", None), ("z", "a+b:c")], "value string, class string")
    df.write.partitionBy("class").text(fresh_dir + "/table")
    rows = records.read_class_folders(spark, fresh_dir + "/table", "class").collect()
    found = {}
    for r in rows:
        found.setdefault(r["class"], []).append(bytes(r["content"]).decode())
    assert sorted("".join(found["a+b:c"])) == sorted("x\nz\n") and found[None] == ["y\n"] and len(found) == 2


def test_label_map_is_built_once(spark, fresh_dir):
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([(0, "a:b"), (1, "c")], "label int, name string")

    assert not labels.has_label_map(spark, fresh_dir)
    for _ in range(2):
        assert dict(labels.load_or_build(spark, fresh_dir, build).collect()) == {0: "a:b", 1: "c"}
    assert len(built) == 1


def test_class_folders(spark, fresh_dir):
    for name in ("rose/1.jpg", "rose/2.jpg", "tulip/1.jpg"):
        put(f"{fresh_dir}/photos/{name}", name)
    rows = records.read_class_folders(spark, fresh_dir + "/photos").collect()
    assert sorted((r["class"], bytes(r["content"]).decode()) for r in rows) == [
        ("rose", "rose/1.jpg"), ("rose", "rose/2.jpg"), ("tulip", "tulip/1.jpg"),
    ]


def test_split_dataset(spark, fresh_dir):
    df = spark.range(60).select(
        "id",
        F.when(F.col("id") > 5, F.encode(F.lit("x"), "utf-8")).alias("content"),
        F.when(F.col("id") > 7, F.lit("jpg")).alias("format"),
        F.when(F.col("id") > 9, F.lit(3)).cast("bigint").alias("label"),
    )
    sharded = assign_shards(train_valid_split(df, "id", 20), "id")
    records.write_splits(sharded, fresh_dir + "/data")
    train = records.read_split(spark, fresh_dir + "/data", "train")
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    rows = train.collect() + records.read_split(spark, fresh_dir + "/data", "validation").collect()
    assert len(rows) == 60
    for r in rows:
        assert bytes(r["content"]) == (b"x" if r["id"] > 5 else b"")
        assert r["format"] == ("jpg" if r["id"] > 7 else "png")
        assert r["label"] == (3 if r["id"] > 9 else 0)
    with pytest.raises(ValueError):
        records.read_split(spark, fresh_dir + "/data", "test")


def test_boxes(spark):
    df = spark.createDataFrame(
        [([1.0, 5.0], [2.0, 6.0], [3.0, 7.0], [4.0, 8.0], None)],
        "y0 array<float>, x0 array<float>, y1 array<float>, x1 array<float>, format string",
    )
    boxes = df.select(records.zip_boxes(*[F.col(c) for c in ("y0", "x0", "y1", "x1")]).alias("b")).first()["b"]
    assert [b.asDict() for b in boxes] == [
        dict(ymin=1.0, xmin=2.0, ymax=3.0, xmax=4.0), dict(ymin=5.0, xmin=6.0, ymax=7.0, xmax=8.0),
    ]
    record = records.with_defaults(
        df.select(F.lit(None).cast("binary").alias("content"), "format",
                  F.lit(None).cast("bigint").alias("label"), F.lit(None).cast("string").alias("text")),
        records.BOXED_DEFAULTS,
    ).first()
    assert (bytes(record["content"]), record["format"], record["label"], record["text"]) == (b"", "jpeg", -1, "")


def test_synthetic_images(spark):
    df = records.synthetic_images(spark, 2, 3, seed=4)
    summary = df.agg(
        F.count("*"), F.count_distinct(F.xxhash64("image")), F.min("label"), F.max("label"), F.min(F.size("image"))
    ).first()
    assert summary[0] == 6 and summary[1] == 1 and summary[2] == summary[3] and summary[4] == 256 * 256 * 3
    assert 0 <= summary[2] < 1000
    cells = df.limit(1).select(F.explode("image").alias("v")).agg(F.avg("v"), F.stddev("v")).first()
    assert abs(cells[0]) < 0.02 and abs(cells[1] - 1) < 0.02
    assert records.synthetic_images(spark, 2, 3, train=False).count() == 1
