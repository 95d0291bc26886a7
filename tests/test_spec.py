"""Mixed-column processors: limits, unseen values, save and load, many values."""

import time

import pytest
from pyspark.sql import functions as F

from tabloom.operators import spec as fs


@pytest.fixture(scope="module")
def df(spark):
    rows = [(i, "ab"[i % 2] if i % 10 else None, f"v{i % 40}", None if i % 25 else "x", "same", float(i % 7), 3.0, None if i % 30 else 2.0, float((i % 20) ** 9) if i % 8 else None) for i in range(200)]
    return spark.createDataFrame(rows, "id int, two string, forty string, rare string, one string, num double, flat double, thin double, tail double").repartition(3).cache()


def collected(df):
    return {r["id"]: r.asDict() for r in df.collect()}


def test_ids_scales_and_dropped_columns(df):
    sp = fs.fit(df, exclude=["id"], conf={"skew_double": True, "skew_threshold": 2.0, "skew_bins": 4, "drop_cat_na_ratio": 0.9, "log_transform": False}, shared_ids=True)
    assert set(sp.drop_cols) == {"rare", "thin", "flat"} and sp.skew_cols == ["tail"] and sp.double_cols == ["num"]
    assert sp.size == {"two": 3, "forty": 40, "one": 1, "num": 1, "tail": len(sp.skew_bins["tail"]) + 2}
    assert sp.start == {"two": 0, "forty": 3, "one": 43, "num": 44, "tail": 45} and sp.feature_dim == 45 + sp.size["tail"] and sp.field_dim == 5
    got = collected(fs.transform(df, sp))
    order = sorted(["-999", "a", "b"])
    for i, r in got.items():
        assert r["two"] == order.index("ab"[i % 2] if i % 10 else "-999") and r["one"] == 43
        assert r["forty"] == 3 + sorted(f"v{k}" for k in range(40)).index(f"v{i % 40}")
        assert r["tail"] == (45 + len(sp.skew_bins["tail"]) + 1 if i % 8 == 0 else 45 + sum(e < float((i % 20) ** 9) for e in sp.skew_bins["tail"]))
    assert list(fs.transform(df, sp).columns) == ["id", "two", "forty", "one", "num", "tail"]
    own = fs.fit(df, exclude=["id"], conf={"drop_cat_na_ratio": 0.9})
    assert set(own.start.values()) == {0}


def test_unseen_and_missing(spark, df):
    sp = fs.fit(df.select("id", "two", "num"), exclude=["id"])
    new = spark.createDataFrame([(1, "z", None), (2, None, 100.0)], "id int, two string, num double")
    got = collected(fs.model_input(fs.transform(new, sp), sp, "id"))
    assert got[1]["xi"][0] == -1 and got[2]["xi"][0] == 0 and got[1]["xv"] == [1.0, 0.0]
    with pytest.raises(ValueError, match="missing features"):
        fs.transform(new.drop("num"), sp)
    assert fs.transform(df.select("id", "two", "num").limit(0), sp).count() == 0


def test_save_and_load(spark, df, tmp_path):
    sp = fs.fit(df, exclude=["id"], conf={"skew_double": True, "skew_threshold": 2.0}, shared_ids=True)
    fs.save(sp, str(tmp_path / "spec"), spark)
    back = fs.load(spark, str(tmp_path / "spec"))
    assert collected(fs.transform(df, back)) == collected(fs.transform(df, sp))


def test_many_values_cost_no_more_than_few(spark):
    rows = spark.range(15_000)

    def seconds(n):
        wide = rows.select("id", F.concat(F.lit("v"), (F.col("id") % n).cast("string")).alias("x"))
        sp = fs.fit(wide, exclude=["id"])
        fs.transform(wide, sp).count()
        t = time.perf_counter()
        assert fs.transform(wide, sp).agg(F.count_distinct("x")).first()[0] == n
        return time.perf_counter() - t

    assert seconds(15_000) < 2 * seconds(1_500) + 1


def test_network_input(df):
    sp = fs.network_fit(df, exclude=["id"], most_categories=30, skew_threshold=2.0)
    assert set(sp.drop_cols) == {"rare", "thin", "one", "forty"} and sp.double_cols == ["num", "flat"]
    assert sp.bins.names["tail"][-1] == "null"
    out = fs.network_transform(df, sp, keep=["id"])
    hot = [c for c in out.columns if c.startswith(("two_", "tail_"))]
    assert {"two_-99", "two_a", "two_b"} <= set(hot)
    for i, r in collected(out).items():
        assert sum(r[c] for c in hot) == 2 and r["two_-99"] == (i % 10 == 0) and r["tail_null"] == (i % 8 == 0)
    plain = fs.network_fit(df, exclude=["id"], discretize=False, kind="min-max")
    assert "tail" in plain.double_cols and fs.network_transform(df, plain, keep=["id"]).agg(F.max("num")).first()[0] == 1.0


def test_fm_input(spark, df):
    sp = fs.fm_fit(df, exclude=["id"], skew_threshold=2.0)
    assert set(sp.drop_cols) == {"rare", "thin", "flat", "forty"} and sp.order == ["two", "one", "num", "tail"]
    new = spark.createDataFrame([(1, "a", "same", 3.0, 1.0), (2, "new", "other", None, None)], "id int, two string, one string, num double, tail double")
    got = collected(fs.fm_transform(new, sp, "id"))
    assert got[1]["xv"][0] == 1.0 and got[2]["xv"][:2] == [0.0, 0.0] and got[2]["xi"][:2] == [min(sp.ids["two"].values()), min(sp.ids["one"].values())]
    assert got[2]["xv"][2] == pytest.approx(0.0) and got[1]["xi"][2] == sp.ids["num"]
    whole = fs.fm_transform(df, sp, "id")
    assert whole.count() == 200 and whole.agg(F.max(F.array_max("xi"))).first()[0] == sp.feature_dim - 1
