"""The landing copy, file by file."""

import gzip
import hashlib
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from strata.sources import landing
from strata.sources.landing import ALL_FILES, copy_files, land, land_dataset, list_files, relative

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def lay(root, files):
    for name, raw in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(raw)


def lines(*rows):
    return "".join(f'{{"a": {a}, "b": "{b}"}}\n' for a, b in rows).encode()


def test_a_broken_file_is_one_row(spark, tmp_dir):
    src, whole = f"{tmp_dir}/src", gzip.compress(lines(*[(i, "x" * 50) for i in range(5000)]))
    spark.range(100).coalesce(1).write.parquet(f"{tmp_dir}/p")
    parquet = next(open(f"{tmp_dir}/p/{n}", "rb").read() for n in os.listdir(f"{tmp_dir}/p") if n.endswith(".parquet"))
    files = {"one.json": lines((1, "é"), (2, "y")), "sub/two.json.gz": gzip.compress(lines((3, "z"))), "sub/deep/empty.json": b"",
             "twice.json.gz": gzip.compress(lines((4, "p"))) + gzip.compress(lines((5, "q"))), "whole.json.gz": whole,
             "short.json.gz": whole[:-20], "junk.json.gz": b"not compressed at all", "good.parquet": parquet,
             "bad.parquet": parquet[:200] + b"\0" * (len(parquet) - 400) + parquet[-200:], "short.parquet": parquet[:-50]}
    lay(src, files)
    out = copy_files(spark, {"d": src, "none": f"{tmp_dir}/nowhere"}, f"{tmp_dir}/out", f"{tmp_dir}/log", wait=0)
    dead = {(r.dataset, r.file_path): r.error for r in out.dead_letter.collect()}
    assert set(dead) == {("d", "short.json.gz"), ("d", "junk.json.gz"), ("d", "bad.parquet"), ("d", "short.parquet"), ("none", ALL_FILES)}
    assert "ends within a member" in dead["d", "short.json.gz"] and all(dead.values())
    good = {r.file_path: r for r in out.good.collect()}
    assert set(good) == set(files) - {p for _, p in dead}
    for name, r in good.items():
        with open(f"{tmp_dir}/out/d/{name}", "rb") as f:
            copy = f.read()
        assert copy == files[name] and r.bytes == len(copy) and r.sha256 == hashlib.sha256(copy).hexdigest()
    left = [f for _, _, names in os.walk(f"{tmp_dir}/out") for f in names]
    assert len(left) == len(good)  # nothing half-written stays
    again = copy_files(spark, {"d": src}, f"{tmp_dir}/out", f"{tmp_dir}/log2", wait=0)
    assert again.good.count() == len(good)


def test_land_dataset_gives_all_other_rows(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    lay(src, {"a.json": lines((1, "x")) + b'{"a": 2, "b"\n', "b.json.gz": gzip.compress(lines(*[(i, "y") for i in range(10, 900)]))[:-30],
              "c.json.gz": gzip.compress(lines((3, "z")))})
    got = land_dataset(spark, "d", src, SCHEMA, f"{tmp_dir}/out", f"{tmp_dir}/log")
    assert sorted(map(tuple, got.good.collect())) == [(1, "x"), (3, "z")]
    dead = sorted((r.file_path.rsplit("/", 1)[-1], r.record) for r in got.dead_letter.collect())
    assert dead == [("a.json", '{"a": 2, "b"'), ("b.json.gz", None)]
    with pytest.raises(Exception):  # what the same folder does to a plain read
        spark.read.schema(SCHEMA).json(src).collect()
    nothing = land_dataset(spark, "n", f"{tmp_dir}/nope", SCHEMA, f"{tmp_dir}/out", f"{tmp_dir}/log3")
    assert nothing.good.count() == 0 and [r.file_path for r in nothing.dead_letter.collect()] == [ALL_FILES]


def test_unreadable_and_vanished_files(spark, tmp_dir, monkeypatch):
    tries = []

    def flaky(source, size, target, staging, check):
        tries.append(source)
        if len(tries) < 3:
            raise OSError("connection reset")
        return size, "sum"

    one = landing._copier(f"{tmp_dir}/out", True, 3, 0.0)
    import pyarrow as pa

    def outcome(path, size):
        batch = pa.RecordBatch.from_pylist([{"dataset": "d", "root": tmp_dir, "path": path, "bytes": size, "error": None}])
        return next(iter(one([batch]))).to_pylist()[0]

    assert "FileNotFoundError" in outcome(f"{tmp_dir}/gone.txt", 5)["error"]
    lay(tmp_dir, {"grown.txt": b"12345"})
    assert "read 5 bytes of 9" in outcome(f"{tmp_dir}/grown.txt", 9)["error"]
    monkeypatch.setattr(landing, "_copy", flaky)
    assert outcome(f"{tmp_dir}/grown.txt", 5)["sha256"] == "sum" and len(tries) == 3


def test_only_listing_failures_become_all_files(spark, tmp_dir):
    lay(f"{tmp_dir}/s", {"a.json": lines((1, "x"))})
    with pytest.raises((AnalysisException, Exception), match="nosuchformat"):
        land(spark, "d", f"{tmp_dir}/s", SCHEMA, fmt="nosuchformat")
    assert land(spark, "d", f"{tmp_dir}/missing", SCHEMA).dead_letter.first().file_path == ALL_FILES


def test_listing(spark, tmp_dir):
    lay(f"{tmp_dir}/s", {"x/a.bin": b"123", "b.bin": b"", "_hidden/c": b"1", ".d": b"1"})
    rows = list_files(spark, {"d": f"{tmp_dir}/s"})
    assert sorted((relative(r.path, r.root), r.bytes) for r in rows.collect()) == [("b.bin", 0), ("x/a.bin", 3)]
    assert list_files(spark, {}).count() == 0


def test_relative_paths():
    assert relative("/a/b/c.txt", "/a/b") == "c.txt" and relative("file:/a/b/x/c.txt", "file:/a/b/") == "x/c.txt"
    assert landing._uri("file:/a/b") == "file:///a/b" and landing._uri("/a") == "file:///a" and landing._uri("hdfs://h/a") == "hdfs://h/a"
