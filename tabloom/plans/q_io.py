"""Source/sink round trips over the driver tables (IO*) and scoring jobs that write
partitioned tables (M7, M12-M14)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import score
from ..session import scratch_path
from ..sources import io
from .fixtures import SCORED_SQL, scored, table, with_sql
from .registry import register, round_doubles


@register("text_roundtrip_lines", ["IO1", "IO3", "IO9"], sql="""
SELECT count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM (
  SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""")
def text_roundtrip_lines(spark, sf):
    path = scratch_path(spark, "docs-text")
    io.write_text(table(spark, sf, "documents"), "text", path, compression="bzip2")
    lines = io.read_lines(spark, path)
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))


@register("whole_files_pages", ["IO2", "IO15"], sql="""
SELECT count(*) AS n_files, CAST(sum(length(html)) AS BIGINT) AS n_chars FROM pages""")
def whole_files_pages(spark, sf):
    path = scratch_path(spark, "pages-html")
    p = table(spark, sf, "pages").select(F.regexp_replace("html", "\n", " ").alias("html"))
    io.save(p.repartition(4), path, fmt="text", mode="overwrite")
    w = io.read_whole_files(spark, path)
    lines = w.select(F.explode(F.split(F.regexp_replace("content", "\n$", ""), "\n")).alias("l"))
    return lines.agg(F.count(F.lit(1)).alias("n_files"), F.sum(F.length("l")).alias("n_chars"))


@register("json_csv_roundtrip", ["IO4", "IO5", "IO6"], sql="""
SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def json_csv_roundtrip(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    jp, cp = scratch_path(spark, "events-json"), scratch_path(spark, "events-csv")
    io.save(e, jp, fmt="json", mode="overwrite")
    io.save(e.withColumn("_c0", F.col("event_id")).withColumnRenamed("value", "val"), cp, fmt="csv", mode="overwrite",
            header="true")
    j = spark.read.schema("event_id long, event_type string, value double").json(jp)
    c = (spark.read.option("header", "true").schema("event_id long, event_type string, val double, _c0 long").csv(cp)
         .drop("_c0").withColumnRenamed("val", "value"))  # IO6: stray index column dropped, label renamed
    both = j.join(c.select("event_id", F.col("value").alias("v2")), "event_id")
    return both.filter(F.col("value") == F.col("v2")).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@register("orc_partitioned_sql_on_file", ["IO10", "IO11", "IO14", "IO15", "IO16"], sql="""
SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 4) AS qty FROM lineitem
WHERE l_linestatus = 'F' GROUP BY 1""")
def orc_partitioned_sql_on_file(spark, sf):
    path = scratch_path(spark, "lineitem-orc")
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    io.save(li, path, fmt="orc", mode="overwrite", partition_by="l_linestatus")
    io.save(li.limit(0), path, fmt="orc", mode="append", partition_by="l_linestatus")  # append mode, no rows
    io.save(li, path, fmt="orc", mode="ignore", partition_by="l_linestatus")  # existing: left as is
    df = spark.sql(f"SELECT * FROM orc.`{path}` WHERE l_linestatus = 'F'")  # partition pruning
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4).alias("qty"))


@register("sequence_and_hadoop_files", ["IO7", "IO8"], sql="""
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, count(*) AS lines, CAST(sum(length(o_orderpriority)) AS BIGINT) AS chars FROM orders GROUP BY 1""")
def sequence_and_hadoop_files(spark, sf):
    """Prices by status through a sequence file, priorities by status through Hadoop's text formats."""
    o = table(spark, sf, "orders")
    one, two = scratch_path(spark, "orders-seq"), scratch_path(spark, "orders-hadoop")
    io.write_sequence_file(o.withColumn("p", F.col("o_totalprice").cast("double")), "o_orderstatus", "p", one)
    io.write_hadoop_text(o, "o_orderstatus", "o_orderpriority", two)
    a = io.read_sequence_file(spark, one, "o_orderstatus string, p double").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("p"), 2).alias("total"))
    lines = io.read_hadoop_text(spark, two).select(F.split("line", "\t").alias("f")).select(F.col("f")[0].alias("o_orderstatus"), F.col("f")[1].alias("v"))
    return a.join(lines.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("v")).cast("long").alias("chars")), "o_orderstatus")


@register("rows_from_program_data", ["IO12"], sql="""
SELECT n_name, CASE n_regionkey WHEN 0 THEN 'AF' WHEN 1 THEN 'AM' WHEN 2 THEN 'AS' WHEN 3 THEN 'EU' WHEN 4 THEN 'ME' END AS code, n_regionkey * 10 AS weight, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def rows_from_program_data(spark, sf):
    """Tables made from a list, from pandas and from rows with a struct type, met by a table that was read."""
    import pandas as pd
    from pyspark.sql import Row
    from pyspark.sql import types as T
    codes = spark.createDataFrame([(0, "AF"), (1, "AM"), (2, "AS"), (3, "EU"), (4, "ME")], "key int, code string")
    weights = spark.createDataFrame(pd.DataFrame({"key": range(5), "weight": [0, 10, 20, 30, 40]}), "key int, weight long")
    names = table(spark, sf, "region").select("r_regionkey", "r_name").collect()  # five rows
    regions = spark.createDataFrame([Row(r["r_regionkey"], r["r_name"]) for r in names], T.StructType([T.StructField("key", T.IntegerType()), T.StructField("r_name", T.StringType())]))
    n = table(spark, sf, "nation").select("n_name", F.col("n_regionkey").cast("int").alias("key"))
    return n.join(codes, "key").join(weights, "key").join(regions, "key").select("n_name", "code", "weight", "r_name")


@register("save_modes", ["IO15"], sql="""
SELECT o_orderstatus, 2 * count(*) AS appended, count(*) AS overwritten, true AS refused FROM orders GROUP BY 1""")
def save_modes(spark, sf):
    """Append adds the rows again, overwrite leaves them once, ignore changes nothing, error refuses."""
    from pyspark.errors import AnalysisException
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    one, two = scratch_path(spark, "modes-a"), scratch_path(spark, "modes-b")
    io.save(o, one)
    io.save(o, one, mode="append")
    io.save(o, one, mode="ignore")
    io.save(o.limit(10), two)
    io.save(o, two, mode="overwrite")
    try:
        io.save(o, two)
        refused = False
    except AnalysisException:
        refused = True
    count = lambda path, name: spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias(name))
    return count(one, "appended").join(count(two, "overwritten"), "o_orderstatus").withColumn("refused", F.lit(refused))


@register("recursive_scan_regex", ["IO21"], sql="SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def recursive_scan_regex(spark, sf):
    """Files of a tree whose names match a regular expression; the others hold rows that must not be read."""
    root = scratch_path(spark, "events-tree")
    e = table(spark, sf, "events").select("event_id", "event_type")
    io.save(e, f"{root}/a/b", fmt="csv", header="true")
    io.save(e, f"{root}/c", fmt="csv", header="true", compression="gzip")
    df = io.read_files_named(spark, root, "csv", r"part-[0-9]+-.*\.csv", "event_id long, event_type string", header="true")
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("recursive_scan_glob", ["IO21"], sql="""
SELECT event_type, count(*) AS n FROM events GROUP BY 1""")
def recursive_scan_glob(spark, sf):
    root = scratch_path(spark, "events-chunks")
    e = table(spark, sf, "events").select("event_id", "event_type")
    io.save(e, f"{root}/a/b", fmt="csv", mode="overwrite", header="true")
    io.save(e.limit(0), f"{root}/skip", fmt="json", mode="overwrite")
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").option("header", "true") \
        .schema("event_id long, event_type string").csv(root)
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("fitted_state_roundtrip", ["IO22", "IO23", "N6"], sql=with_sql(SCORED_SQL, """
tot AS (SELECT sum(y) AS gpos, count(*) - sum(y) AS gneg FROM scored),
w AS (SELECT coalesce(priority, '-99') AS value, ln((sum(y) + 1.0) / (count(*) - sum(y) + 1.0)) - ln((max(gpos) + 2.0) / (max(gneg) + 2.0)) AS woe FROM scored, tot GROUP BY 1)""") + """
SELECT CASE WHEN CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || ':' || '4'), 1, 8)) AS BIGINT) / 4294967296.0 < 0.8
            THEN 'train' ELSE 'test' END AS split, count(*) AS n, round(sum(woe), 4) AS woe FROM scored JOIN w ON coalesce(priority, '-99') = value GROUP BY 1""")
def fitted_state_roundtrip(spark, sf):
    """A fit and a split that were saved, read back and used."""
    from ..operators import core
    from ..operators.encode import woe_fit, woe_transform
    df = scored(spark, sf)
    fit_path, split_path = scratch_path(spark, "woe-fit"), scratch_path(spark, "splits")
    woe_fit(df, "y", ["priority"]).write.mode("overwrite").parquet(fit_path)
    s = core.random_split(df, [0.8, 0.2], "id", seed=4).withColumn(
        "split", F.when(F.col("split") == 0, "train").otherwise("test"))
    io.save(s, split_path, mode="overwrite", partition_by="split")
    back = woe_transform(spark.read.parquet(split_path), spark.read.parquet(fit_path), ["priority"])
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("priority"), 4).alias("woe"))


@register("foreach_partition_json", ["IO25", "IO26", "P3"], sql="""
SELECT count(*) AS n, CAST(sum(length(json_object('o_orderkey', o_orderkey, 'o_orderstatus', o_orderstatus,
                                             'o_orderpriority', o_orderpriority)::VARCHAR)) AS BIGINT) AS n_chars FROM orders""")
def foreach_partition_json(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    j = io.to_json_rows(o)
    acc = spark.sparkContext.accumulator(0)

    def count_rows(rows):  # side-effect sink
        n = 0
        for _ in rows:
            n += 1
        acc.add(n)

    j.foreachPartition(count_rows)
    return j.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("json")).alias("n_chars"))


# ------------------------------------------------------------------ scoring jobs --
@register("deepfm_score_users", ["M7", "D5", "D6", "N19"])
def deepfm_score_users(spark, sf):
    feats = score.user_sparse_features(table(spark, sf, "events"))
    return round_doubles(score.deepfm_score(feats))


@register("daily_partition_scoring", ["M12", "IO17", "IO18"], sql="""
SELECT strftime(min(ts), '%Y%m%d') AS dayno, count(DISTINCT user_id) AS n_scored FROM events
WHERE ts::DATE = (SELECT max(ts)::DATE FROM events)""")
def daily_partition_scoring(spark, sf):
    e = table(spark, sf, "events").withColumn("dayno", F.date_format("ts", "yyyyMMdd"))
    last = e.agg(F.max("dayno")).first()[0]
    name = f"score_{uuid.uuid4().hex[:8]}"
    io.create_partitioned_table(spark, name, "user_id BIGINT, score DOUBLE, dayno STRING", "dayno", fmt="orc")
    day = e.filter(F.col("dayno") == last)                       # partition of one day
    feats = score.user_sparse_features(day)
    scored_day = score.fm_score(feats, score.fm_weights(spark, n_index=score.index_size(feats))).withColumn("dayno", F.lit(last))
    io.overwrite_partition(scored_day, name)
    io.overwrite_partition(scored_day, name)                     # re-run replaces, no duplicates
    t = spark.table(name)
    return t.groupBy("dayno").agg(F.count(F.lit(1)).alias("n_scored"))


@register("adhoc_scoring_ctas", ["M13", "N18", "IO19", "T22", "P21"], sql="""
SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1""")
def adhoc_scoring_ctas(spark, sf):
    from ..functions.scalar import log_squash
    from ..operators.core import MODEL_PREFIXES, prefix_bucket
    c = table(spark, sf, "customer").filter(F.col("c_mktsegment").isNotNull())
    prep = (c.na.fill({"c_name": "-999"})
            .withColumn("name_bucket", prefix_bucket(F.col("c_name"), MODEL_PREFIXES))
            .withColumn("bal", log_squash(F.col("c_acctbal"), "serve")))
    m = prep.agg(F.avg("bal").alias("m"), F.stddev_samp("bal").alias("s")).first()
    prep = prep.withColumn("bal", (F.col("bal") - m["m"]) / (m["s"] + 1e-8))
    scored_c = prep.select("c_custkey", "c_mktsegment", (1 / (1 + F.exp(-F.col("bal")))).alias("prob"))
    name = f"adhoc_{uuid.uuid4().hex[:8]}"
    out = io.create_table_as(scored_c, name, mode="error")
    io.create_table_as(scored_c.limit(0), name, mode="ignore")   # explicit no-op re-run
    return out.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@register("scored_table_attach", ["M14"], sql=with_sql(SCORED_SQL) + """
SELECT id, y, round(p, 6) AS p FROM scored""")
def scored_table_attach(spark, sf):
    """Scores keep their id and label columns: no positional re-attach."""
    return round_doubles(scored(spark, sf).select("id", "y", "p"))
