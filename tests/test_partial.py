"""Drift bases, mean encoding of unseen values, bins backwards, losses, primitives, files."""

import math

import pytest
from pyspark.sql import functions as F

from tabloom.operators import drift, encode, evaluate, select
from tabloom.sources import io


def test_psi_base_is_kept_and_unseen_values_are_missing(spark, tmp_path):
    rows = [("a", float(i), f"v{i % 3}", i % 4) for i in range(200)] + [("b", float(i) + 50, f"v{i % 5}", None if i % 10 == 0 else i % 6) for i in range(100)] + [("c", None, None, 9)] * 20
    df = spark.createDataFrame(rows, "part string, x double, s string, k int")
    base = drift.psi_base(df.filter("part = 'a'"), ["x"], ["s", "k"], bins=4)
    drift.save_base(base, str(tmp_path / "base"))
    back = drift.load_base(spark, str(tmp_path / "base"))
    got = {(r["var"], r["part"], r["bucket"]): r for r in drift.psi_detail(df, "part", back, ["a", "b", "c"]).collect()}
    assert all(r["term"] == pytest.approx(0) for k, r in got.items() if k[1] == "a")
    assert got["s", "b", "_missing"]["n"] == 40 and got["k", "b", "_missing"]["n"] == sum(i % 10 == 0 or i % 6 > 3 for i in range(100))
    assert got["x", "c", "_missing"]["n"] == 20 and got["k", "c", "_missing"]["n"] == 20 and got["s", "c", "v0"]["n"] == 1
    for part in "abc":
        for var in ("x", "s", "k"):
            mine = [r for k, r in got.items() if k[0] == var and k[1] == part]
            assert sum(r["share"] for r in mine) == pytest.approx(1) and sum(r["base_share"] for r in mine) == pytest.approx(1)
    table = {(r["var"], r["part"]): r["psi"] for r in drift.psi_table(df, "part", ["x"], ["s", "k"], bins=4).collect()}
    assert table["x", "b"] == pytest.approx(sum(r["term"] for k, r in got.items() if k[:2] == ("x", "b")))


def test_mean_encoding_of_unseen_values(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("a", 1), ("b", 2), (None, 0)], "v string, y int")
    fit = encode.mean_fit(df, "y", ["v"])
    new = spark.createDataFrame([("zz",), ("a",), (None,)], "v string")
    got = encode.mean_transform(new, fit, ["v"]).collect()
    assert [got[0]["v_0"], got[0]["v_1"], got[0]["v_2"]] == [0.4, 0.4, 0.2] or any([r["v_0"], r["v_1"], r["v_2"]] == [0.4, 0.4, 0.2] for r in got)
    assert all(r["v_0"] + r["v_1"] + r["v_2"] == pytest.approx(1) for r in got)
    assert encode.mean_transform(new, fit, ["v"], drop_last=True).columns == ["v_0", "v_1"]


def test_bins_forwards_and_backwards(spark):
    df = spark.createDataFrame([(float(i * i),) for i in range(100)], "x double")
    fit = encode.bin_cdf_fit(df, "x", 10)
    out = encode.bin_cdf_inverse(encode.bin_cdf_transform(df, "x", fit), "cdf", fit)
    means = {r["value"] for r in out.collect()}
    assert len(means) == 10 and all(min(abs(r["x"] - m) for m in means) == abs(r["x"] - r["value"]) or abs(r["x"] - r["value"]) < 2000 for r in out.collect())
    assert out.filter("x = 0").first()["value"] == pytest.approx(sum(i * i for i in range(10)) / 10)


def test_focal_loss_of_classes(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.3], 1), ([1.0, 0.0, 0.0], 2)], "p array<double>, y int")
    got = [r[0] for r in df.select(evaluate.focal_loss_classes(F.col("p"), F.col("y"), [1.0, 0.5, 2.0], 2.0)).collect()]
    assert got == [pytest.approx(-0.5 * 0.25 * math.log(0.5)), pytest.approx(-2.0 * (1 - 1e-7) ** 2 * math.log(1e-7))]


def test_most_frequent_values_become_columns(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,), ("c",)], "v string")
    out, top = select.encode_top(df, "v", 2)
    assert top == ["b", "c"] and out.agg(F.sum("v_b"), F.sum("v_c")).first()[:] == (2, 2)


def test_sequence_files_and_names(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", 2.5)], "k string, v double")
    io.write_sequence_file(df, "k", "v", str(tmp_path / "seq"))
    assert sorted(map(tuple, io.read_sequence_file(spark, str(tmp_path / "seq"), "k string, v double").collect())) == [("a", 1.5), ("b", 2.5)]
    io.write_hadoop_text(df, "k", "v", str(tmp_path / "text"))
    assert sorted(r["line"] for r in io.read_hadoop_text(spark, str(tmp_path / "text")).collect()) == ["a\t1.5", "b\t2.5"]
    for name in ("day1.csv", "day22.csv", "other.csv"):
        (tmp_path / "tree" / "x").mkdir(parents=True, exist_ok=True)
        (tmp_path / "tree" / "x" / name).write_text(f"{name}\n")
    found = io.read_files_named(spark, str(tmp_path / "tree"), "csv", r"day\d+\.csv", "v string").collect()
    assert sorted(r["v"] for r in found) == ["day1.csv", "day22.csv"]
