import gzip
import os

import pytest
from pyspark.sql import functions as F

from helpers import event, month, raw, tuples
from shopmonth.sources import catalog, files, sinks, storage
from shopmonth.sources.month_table import MonthTable
from shopmonth.sources.schema import RAW_EVENTS
from shopmonth.sources.workdir import new_folder, shared_root, stage, work_folder

HEADER = ",".join(RAW_EVENTS.names)


def land(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") if path.endswith(".gz") else open(path, "w") as handle:
        handle.write("\n".join((HEADER, *lines)) + "\n")


LINE = "2019-10-01 00:00:00 UTC,view,1,a.b,acme,10.5,7,s1"


def test_csv_types_and_nulls(spark, folder):
    land(f"{folder}/2019-Oct.csv.gz", LINE, "x,view,2,,NA,oops,,")
    df = files.read_landed_month(spark, folder, month(2019, 10))
    assert df.schema == RAW_EVENTS
    assert tuples(df) == [("2019-10-01 00:00:00 UTC", "view", 1, "a.b", "acme", 10.5, 7, "s1"),
                          ("x", "view", 2, None, "NA", None, None, None)]
    named = files.read_events_csv(spark, f"{folder}/2019-Oct.csv.gz", null_value="NA")
    assert (None,) in tuples(named, "brand")


def test_missing_month_raises(spark, folder):
    with pytest.raises(FileNotFoundError):
        files.read_landed_month(spark, folder, month(2019, 11))


def test_folder_scan(spark, folder):
    land(f"{folder}/2019-Oct.csv.gz", LINE)
    land(f"{folder}/deep/er/2019-Nov.csv", LINE, LINE)
    land(f"{folder}/deep/EXTRA.CSV", LINE)
    land(f"{folder}/deep/notes.txt", LINE)
    got = tuples(files.read_landed_folder(spark, folder).groupBy("source_file", "month").count())
    assert got == [("2019-Oct.csv.gz", month(2019, 10), 1), ("deep/EXTRA.CSV", None, 1),
                   ("deep/er/2019-Nov.csv", month(2019, 11), 2)]


def test_month_tables(spark, folder):
    path = f"{folder}/t"
    both = spark.createDataFrame([(1, month(2019, 10)), (2, month(2019, 11))], "v int, month date")
    sinks.write_months(both, path)
    sinks.write_month(spark.createDataFrame([(3,), (4,)], "v int"), path, month(2019, 11))
    assert tuples(spark.read.parquet(path)) == [(1, month(2019, 10)), (3, month(2019, 11)), (4, month(2019, 11))]
    one = files.read_month(spark.read.parquet(path), month(2019, 10))
    assert tuples(one, "v") == [(1,)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert sinks.drop_path_month(spark, path, month(2019, 10))
    assert not sinks.drop_path_month(spark, path, month(2019, 10))
    assert tuples(spark.read.parquet(path), "v") == [(3,), (4,)]


def test_catalog_table(spark):
    df = spark.createDataFrame([(1, month(2019, 10)), (2, month(2019, 11))], "v int, month date")
    sinks.save_catalog_table(df, "data_published")
    try:
        assert tuples(catalog.tables_like(spark, "data%")) == [("data_published",)]
        sinks.drop_table_month(spark, "data_published", month(2019, 10))
        sinks.drop_table_month(spark, "data_published", month(2019, 10))
        assert tuples(spark.table("data_published"), "v") == [(2,)]
        sinks.save_catalog_table(spark.createDataFrame([(month(2019, 12), 3)], "month date, v int"), "data_published")
        sinks.save_catalog_table(spark.createDataFrame([(4, month(2019, 11))], "v int, month date"), "data_published")
        assert tuples(spark.table("data_published"), "v", "month") == [(3, month(2019, 12)), (4, month(2019, 11))]
        with pytest.raises(ValueError):
            sinks.save_catalog_table(spark.createDataFrame([(month(2019, 12),)], "month date"), "data_published")
    finally:
        spark.sql("DROP TABLE data_published")


def test_monthly_names(spark):
    names = ["data_2019-Oct.csv.gz", "data_2020-Jan.csv.gz", "data_2019-Foo.csv.gz", "data_2019_oct", "x"]
    df = spark.createDataFrame([(n,) for n in names], "table_name string")
    got = [tuple(r) for r in catalog.monthly_names(df).collect()]
    assert got == [("data_2020-Jan.csv.gz", month(2020, 1)), ("data_2019-Oct.csv.gz", month(2019, 10))]


def test_csv_keeps_blanks_and_microseconds(spark, folder):
    df = spark.sql("""SELECT '  a ' AS s, TIMESTAMP_NTZ'2019-10-01 01:02:03.123456' AS n,
                             TIMESTAMP'2019-10-01 01:02:03.000001' AS t, CAST(NULL AS STRING) AS e""")
    sinks.export_csv(df, f"{folder}/out")
    assert tuples(files.read_exported_csv(spark, f"{folder}/out", df.schema)) == tuples(df)
    sinks.append_csv(df, f"{folder}/out")
    assert files.read_exported_csv(spark, f"{folder}/out", df.schema).count() == 2


def test_csv_keeps_line_breaks_and_quotes(spark, folder):
    df = spark.createDataFrame([("x\ny", 1), ('a "b", c', 2), ("back\\slash", 3), (None, 4)], "s string, n int")
    sinks.export_csv(df, f"{folder}/out")
    assert tuples(files.read_exported_csv(spark, f"{folder}/out", df.schema)) == tuples(df)


def test_columns_go_by_name(spark, folder):
    swapped = "user_id,brand,category_code,category_id,event_time,event_type,product_id,price,user_session"
    os.makedirs(f"{folder}/sp ace/2019-Oct/part+1")
    with open(f"{folder}/sp ace/2019-Oct/part+1/a.csv", "w") as handle:
        handle.write(swapped + "\n7,acme,a.b,99,2019-10-01 00:00:00 UTC,view,1,10.5,s1\n")
    land(f"{folder}/sp ace/2019-Oct.csv.gz", LINE)
    got = files.read_landed_month(spark, f"{folder}/sp ace", month(2019, 10))
    assert got.columns == [*RAW_EVENTS.names, "category_id"]
    row = ("2019-10-01 00:00:00 UTC", "view", 1, "a.b", "acme", 10.5, 7, "s1")
    assert tuples(got) == [(*row, None), (*row, "99")]
    named = tuples(files.read_landed_folder(spark, f"{folder}/sp ace"), "source_file", "month")
    assert named == [("2019-Oct.csv.gz", month(2019, 10)), ("2019-Oct/part+1/a.csv", month(2019, 10))]
    with open(f"{folder}/bad.csv", "w") as handle:
        handle.write("event_time,price\nx,1\n")
    with pytest.raises(ValueError, match="user_id"):
        files.read_events_csv(spark, f"{folder}/bad.csv")
    with open(f"{folder}/twice.csv", "w") as handle:
        handle.write(HEADER + ",Brand\n")
    with pytest.raises(ValueError, match="twice"):
        files.read_events_csv(spark, f"{folder}/twice.csv")


def test_single_file_export(spark, folder):
    df = raw(spark, [event(product=i) for i in range(20)]).repartition(4)
    path = sinks.export_csv_file(df, folder, "cleaned_2019-Oct.csv.gz")
    assert [n for n in sorted(os.listdir(folder)) if not n.startswith(".")] == ["cleaned_2019-Oct.csv.gz"]
    assert tuples(files.read_events_csv(spark, path)) == tuples(df)
    sinks.export_csv_file(df.limit(3), folder, "cleaned_2019-Oct.csv.gz")
    assert files.read_events_csv(spark, path).count() == 3


def test_append_and_empty(spark, folder):
    df = raw(spark, [event()])
    sinks.append_rows(df, f"{folder}/t")
    sinks.append_rows(df, f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 2
    sinks.empty_table(spark, f"{folder}/t", RAW_EVENTS)
    assert spark.read.schema(RAW_EVENTS).parquet(f"{folder}/t").count() == 0


def test_jdbc_needs_its_driver(spark):
    """No database is started here: the writer must get as far as loading the given driver."""
    with pytest.raises(Exception, match="no.such.Driver"):
        sinks.write_jdbc(raw(spark, [event()]), "jdbc:none://host/db", "data_2019_oct", {"driver": "no.such.Driver"})


def test_reports(spark):
    df = raw(spark, [event(product=i) for i in range(3)])
    assert files.row_count(df).first()[0] == 3
    assert tuples(files.schema_report(df))[0] == (0, "event_time", "string")
    assert [r.product_id for r in files.head_rows(df, 2, "product_id").collect()] == [0, 1]
    assert files.head_rows(df, 2).count() == 2


def test_storage(spark, folder):
    assert storage.list_names(spark, f"{folder}/none") == []
    with open(f"{folder}/b", "w"), open(f"{folder}/a", "w"):
        pass
    assert [n for n in storage.list_names(spark, folder)] == ["a", "b"]
    assert storage.path_exists(spark, f"{folder}/a") and not storage.path_exists(spark, f"{folder}/z")
    with pytest.raises(OSError):
        storage.move_path(spark, f"{folder}/zzz", f"{folder}/y")


def test_stage_keeps_rows_and_cuts_lineage(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("m")).groupBy("m").count()
    stored = stage(df, "test")
    assert tuples(stored) == tuples(df)
    assert "Aggregate" not in stored._jdf.queryExecution().optimizedPlan().toString()
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_work_folder_is_deleted(spark):
    with work_folder(spark, "test") as folder:
        assert stage(spark.range(3), "a", folder).count() == 3
        assert storage.list_names(spark, folder) == ["a"]
    assert not storage.path_exists(spark, folder)


def test_work_folder_comes_from_the_session(spark, monkeypatch):
    class Session:
        def __init__(self, **settings):
            self.conf = self
            self.settings = {k.replace("_", "."): v for k, v in settings.items()}

        def get(self, name, default=None):
            return self.settings.get(name, default)

    assert shared_root(Session(spark_checkpoint_dir="hdfs://c/x/")) == "hdfs://c/x"
    assert shared_root(Session(spark_master="local[2]")).startswith("/")
    with pytest.raises(RuntimeError):
        shared_root(Session(spark_master="yarn"))
    with pytest.raises(RuntimeError):
        shared_root(Session(spark_master="local-cluster[2,1,1024]"))


def test_months_without_rows_are_emptied(spark, folder):
    path = f"{folder}/t"
    both = spark.createDataFrame([(1, month(2019, 10)), (2, month(2019, 11))], "v int, month date")
    sinks.write_months(both, path)
    sinks.write_month(spark.createDataFrame([], "v int"), path, month(2019, 11))
    assert tuples(spark.read.parquet(path)) == [(1, month(2019, 10))]
    sinks.write_month(spark.createDataFrame([], "v int"), path, month(2020, 1))
    sinks.write_month(spark.createDataFrame([(5,)], "v int"), path, month(2019, 11))
    sinks.write_months(both.where("v = 1"), path, months=[month(2019, 10)])
    assert tuples(spark.read.parquet(path)) == [(1, month(2019, 10)), (5, month(2019, 11))]


def test_catalog_months_without_rows_are_dropped(spark):
    both = spark.createDataFrame([(1, month(2019, 10)), (2, month(2019, 11))], "v int, month date")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    try:
        sinks.save_catalog_table(both, "data_emptied")
        sinks.save_catalog_table(both.where("v = 9"), "data_emptied", months=[month(2019, 11), month(2019, 12)])
        assert tuples(spark.table("data_emptied")) == [(1, month(2019, 10))]
        sinks.save_catalog_table(both.where("v = 9"), "data_emptied")
        sinks.save_catalog_table(both.selectExpr("v + 10 AS v", "month"), "data_emptied", months=[month(2019, 10), month(2019, 11)])
        assert tuples(spark.table("data_emptied")) == [(11, month(2019, 10)), (12, month(2019, 11))]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    finally:
        spark.sql("DROP TABLE IF EXISTS data_emptied")


def test_month_table(spark, folder):
    rows = lambda *values: spark.createDataFrame(list(values), "v int, month date")
    table = MonthTable(spark, f"{folder}/m", rows((1, month(2019, 10))).schema)
    october, november = month(2019, 10), month(2019, 11)
    assert tuples(table.rows()) == []
    table.replace(rows((1, october), (2, november)), [october, november])
    table.replace(rows((3, november)), [november])
    assert tuples(table.rows()) == [(1, october), (3, november)]
    seen = table.rows()
    rows((9, october)).withColumn("version", F.lit("half")).write.mode("append").partitionBy("month", "version").parquet(table.data)
    assert tuples(table.rows()) == [(1, october), (3, november)] == tuples(seen)
    assert table.vacuum() == 2
    table.replace(rows((7, october)).where("v = 0"), [october])
    assert tuples(table.rows()) == [(3, november)]
    table.drop([november])
    assert tuples(table.rows()) == [] and table.vacuum() == 2
    for bad in ((1, november), (1, None)):
        with pytest.raises(Exception, match="another month"):
            table.replace(rows(bad), [october])
    table.replace(rows((4, october)), [october])
    assert tuples(table.rows()) == [(4, october)]
    with pytest.raises(ValueError):
        table.replace(rows(), [])
