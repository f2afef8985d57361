"""File checksums (D14): files of any size, odd names and bytes, one read of files named twice, ignored files."""

import hashlib
import os
import random

import pytest

from strata.operators.reconcile import compare_checksums, file_checksums


def _write(folder, files):
    for name, data in files.items():
        os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
        with open(os.path.join(folder, name), "wb") as f:
            f.write(data)
    return {name: (len(data), hashlib.md5(data).hexdigest()) for name, data in files.items()}


def _got(df):
    rows = df.collect()
    assert len({r.file_name for r in rows}) == len(rows)
    return {r.file_name: (r.size, r.md5) for r in rows}


def test_a_file_of_more_than_2_gib(spark, tmp_dir):
    path = os.path.join(tmp_dir, "big.parquet")
    with open(path, "wb") as f:  # holes: takes no disk
        f.truncate(2 ** 31)
        f.seek(0, os.SEEK_END)
        f.write(b"x")
    with open(path, "rb") as f:
        md5 = hashlib.file_digest(f, "md5").hexdigest()
    assert _got(file_checksums(spark, f"{tmp_dir}/*.parquet")) == {"big.parquet": (2 ** 31 + 1, md5)}


def test_a_file_is_not_held_as_one_value(spark, tmp_dir):
    want = _write(tmp_dir, {"a": bytes(range(256)) * 40})
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        assert _got(file_checksums(spark, tmp_dir)) == want
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)


def test_odd_names_and_bytes(spark, tmp_dir):
    rnd = random.Random(1)
    want = _write(tmp_dir, {
        "bom": b"\xef\xbb\xbfa\n\r\n", "not compressed.gz": b"plain", "50%25 a#b?c=d": b"1",
        "größe": b"2", "[a]{b,c}*": b"3", "buffer": rnd.randbytes(1 << 20), "buffer_and_1": rnd.randbytes((1 << 20) + 1),
        "sub/x y/part-0": rnd.randbytes(3 << 20)})
    assert _got(file_checksums(spark, tmp_dir)) == want
    assert _got(file_checksums(spark, f"file://{tmp_dir}/")) == want


def test_files_named_on_both_sides_are_read_once(spark, tmp_dir):
    _write(tmp_dir, {"a.parquet": b"1", "b.parquet": b"2"})
    both = compare_checksums(*(file_checksums(spark, f"{tmp_dir}/*.parquet") for _ in "st"))
    assert sorted((r.file_name, r.status) for r in both.collect()) == [("a.parquet", "MATCH"), ("b.parquet", "MATCH")]
    assert "ReusedExchange" in both._jdf.queryExecution().executedPlan().toString()


def test_settings_made_during_the_session_reach_the_digest(spark, tmp_dir):
    want = _write(tmp_dir, {"a": b"1"})
    file_checksums(spark, tmp_dir).collect()
    store = "checksums" + os.path.basename(tmp_dir).rsplit("-", 1)[-1].replace("_", "")
    spark.sparkContext._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{store}.link./in", f"file://{tmp_dir}")
    assert _got(file_checksums(spark, f"viewfs://{store}/in/*")) == want
    # a session beside this one has functions of its own
    assert _got(file_checksums(spark.newSession(), tmp_dir)) == want


def test_unreadable_files_fail_or_are_ignored_as_the_session_says(spark, tmp_dir):
    want = _write(tmp_dir, {"good": b"1"})
    _write(tmp_dir, {"bad": b"2" * 600, ".bad.crc": b"crc\x00\x00\x00\x02\x00" + b"\x00" * 8})
    with pytest.raises(Exception, match="bad"):
        file_checksums(spark, tmp_dir).collect()
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "true")
    try:
        assert _got(file_checksums(spark, tmp_dir)) == want
    finally:
        spark.conf.unset("spark.sql.files.ignoreCorruptFiles")
