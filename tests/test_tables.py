import datetime as dt

import pytest
from fleet import d
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetpulse.constants import NON_FAILURE_CATEGORIES
from assetpulse import functions as fn
from assetpulse import schemas, sources
from assetpulse.operators import joins
from assetpulse.operators import reference_tables as ref


def test_csv_and_id_list(spark, tmp_path):
    source = tmp_path / "work.csv"
    source.write_text("customer_asset_identifier,date,working_unit\n1,2020-01-01,5\n2,2020-01-02,\n")
    df = sources.read_csv(spark, str(source), schemas.DAILY_WORK)
    assert [tuple(row) for row in df.collect()] == [(1, d("2020-01-01"), 5), (2, d("2020-01-02"), None)]
    assert [tuple(row) for row in sources.drop_any_null(df).collect()] == [(1, d("2020-01-01"), 5)]
    listed = tmp_path / "ids.csv"
    for header, text in ((True, "0\n7\n 9 \n"), (True, "id\n7\nx\n9\n"), (False, "7\n9\n")):
        listed.write_text(text)
        assert sorted(row.id for row in sources.read_id_list(spark, str(listed), header).collect()) == [7, 9]


def test_csv_by_name(spark, tmp_path):
    """More columns, in another order; the row id comes first."""
    source = tmp_path / "work.csv"
    source.write_text("id,partner,customer_asset_identifier,date,working_unit\n1,4,76,2020-01-01,5\n")
    df = sources.read_csv(spark, str(source), schemas.DAILY_WORK)
    assert [tuple(row) for row in df.collect()] == [(76, d("2020-01-01"), 5)]
    source.write_text("id,date,working_unit\n1,2020-01-01,5\n")
    with pytest.raises(ValueError, match="customer_asset_identifier"):
        sources.read_csv(spark, str(source), schemas.DAILY_WORK)


def test_csv_folder_of_unlike_headers(spark, tmp_path):
    """Each file's columns are found by its own header."""
    folder = tmp_path / "a folder"
    folder.mkdir()
    (folder / "1.csv").write_text("customer_asset_identifier,date,working_unit\n2,2020-01-01,9\n")
    (folder / "2.csv").write_text("working_unit,date,customer_asset_identifier\n8,2020-01-02,3\n,2020-01-03,4\n")
    (folder / "3.csv").write_text('x,"customer_asset_identifier",date,working_unit\n0,5,2020-01-04,7\n')
    (folder / "4.csv").write_text("customer_asset_identifier,date,working_unit\n")
    (folder / "5.csv").write_text("")
    got = sorted(map(tuple, sources.read_csv(spark, str(folder), schemas.DAILY_WORK).collect()))
    assert got == [(2, d("2020-01-01"), 9), (3, d("2020-01-02"), 8), (4, d("2020-01-03"), None), (5, d("2020-01-04"), 7)]
    (folder / "6.csv").write_text("date,working_unit\n2020-01-01,1\n")
    with pytest.raises(ValueError, match="6.csv lacks"):
        sources.read_csv(spark, str(folder), schemas.DAILY_WORK)
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "1.csv").write_text("")
    assert sources.read_csv(spark, str(tmp_path / "empty"), schemas.DAILY_WORK).collect() == []


def test_rows_are_published_once(spark, tmp_path):
    """The staging sink gets the rows of some tasks twice, as after a lost executor; the table gets each row once, equal rows
    as often as they were given, and a run once."""
    import duckdb

    schema = T.StructType([T.StructField("asset", T.LongType(), False), T.StructField("kind", T.StringType())])
    rows = [(i % 40, None if i % 5 else "x") for i in range(100)]
    df = spark.createDataFrame(rows, "asset long, kind string").repartition(5)
    target = duckdb.connect()
    target.execute("CREATE TABLE visits (asset BIGINT, kind VARCHAR)")

    def stage(staged, options, name):
        folder = f"{options['url']}/{name}"
        staged.write.mode("overwrite").parquet(folder)
        staged.where(F.spark_partition_id() % 2 == 0).write.mode("append").parquet(folder)  # tasks that run again
        target.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM read_parquet('{folder}/*.parquet')")
        assert target.execute(f"SELECT count(*) FROM {name}").fetchone()[0] > len(rows)

    def publish(session, options, statements):
        for part, whole in zip(statements, (False, True, False), strict=True):
            if whole:
                target.execute("BEGIN")
            try:
                for text in part:
                    target.execute(text)
            except duckdb.Error:
                target.execute("ROLLBACK")
                raise
            if whole:
                target.execute("COMMIT")

    def load(run):
        sources.append_once(df, schema, {"url": str(tmp_path)}, "visits", run, writers=3, stage=stage, publish=publish)
        return sorted(target.execute("SELECT * FROM visits").fetchall(), key=repr)

    assert load("r1") == sorted(rows, key=repr)
    with pytest.raises(duckdb.Error):
        load("r1")
    assert sorted(target.execute("SELECT * FROM visits").fetchall(), key=repr) == sorted(rows, key=repr)
    assert load("r2") == sorted(rows * 2, key=repr)
    with pytest.raises(ValueError):
        load("r; DROP")


def test_written_files(spark, tmp_path):
    df = spark.createDataFrame([(2, d("2020-01-01"), 1), (1, d("2020-01-02"), 2), (1, d("2020-01-01"), 3)], schemas.DAILY_WORK)
    sources.write_facts(df, str(tmp_path / "facts"))
    back = sources.read_csv(spark, str(tmp_path / "facts"), schemas.DAILY_WORK).collect()
    assert sorted(map(tuple, back)) == sorted(map(tuple, df.collect()))
    target = str(tmp_path / "dated")
    sources.write_dated(df, target, "2020-02-01")
    sources.write_dated(df.limit(1), target, "2020-02-02")
    sources.write_dated(df.limit(2), target, "2020-02-01")
    sizes = {str(r["as_of"]): r["count"] for r in spark.read.parquet(target).groupBy("as_of").count().collect()}
    assert sizes == {"2020-02-01": 2, "2020-02-02": 1}


def test_valid_dates(spark):
    rows = [(1, 1, "2020-01-01 10:00:00"), (1, 2, "0000-00-00 00:00:00"), (1, 3, None), (1, 4, "2020-02-01")]
    df = sources.valid_dates(spark.createDataFrame(rows, schemas.FIRMWARE_HISTORY), "created_date")
    assert [(r[1], r[2]) for r in df.collect()] == [(1, dt.datetime(2020, 1, 1, 10)), (4, dt.datetime(2020, 2, 1))]


def test_sink_checks(spark):
    schema = T.StructType(
        [T.StructField("id", T.LongType(), False), T.StructField("text", T.StringType(), False, {"max_length": 3})]
    )
    good = spark.createDataFrame([(1, "abc")], "id int, text string")
    assert sources.checked_for_sink(good, schema).dtypes == [("id", "bigint"), ("text", "string")]
    assert sources.checked_for_sink(good, schema).collect() == [(1, "abc")]
    for bad in [(None, "abc"), (1, None), (1, "abcd")]:
        with pytest.raises(SparkRuntimeException):
            sources.checked_for_sink(spark.createDataFrame([bad], "id int, text string"), schema).collect()


def test_width_policies(spark):
    schema = T.StructType([T.StructField("text", T.StringType(), False, {"max_length": 3})])
    df = spark.createDataFrame([("abcd",)], "text string")
    assert sources.checked_for_sink(df, schema, "truncate").first()["text"] == "abc"
    assert sources.checked_for_sink(df, schema, "widen").first()["text"] == "abcd"
    with pytest.raises(ValueError):
        sources.checked_for_sink(df, schema, "cut")


def test_fixed_categories_fit_their_sink(spark):
    limit = {f.name: f.metadata.get("max_length") for f in schemas.SERVICE_REQUEST_HISTORY.fields}["incident_category"]
    assert max(map(len, NON_FAILURE_CATEGORIES)) <= limit


def test_jdbc_options():
    partition = {"partitionColumn": "id", "lowerBound": 1, "upperBound": 9, "numPartitions": 4}
    options = sources.jdbc_read_options({"url": "jdbc:x"}, "t", partition)
    assert options["fetchsize"] == "10000" and options["numPartitions"] == "4" and options["dbtable"] == "t"
    with pytest.raises(ValueError):
        sources.jdbc_read_options({}, "t", {"partitionColumn": "id"})
    with pytest.raises(ValueError):
        sources.extract_tables(None, {}, "out", {})


def test_every_reference_table_fits_its_sink(spark):
    day = d("2020-01-01")
    request = spark.createDataFrame([(1, day, "Cleaning", "Open", "High", "SN")], schemas.SERVICE_REQUESTS)
    event = spark.createDataFrame([(1, "SN", 1, day, "1", 5, 1, 1, "x")], schemas.ERROR_EVENTS)
    asset = spark.createDataFrame([(1, day, "Active", 7, "SN", 1)], schemas.ASSETS)
    work = spark.createDataFrame([(1, day, 4)], schemas.DAILY_WORK)
    order = spark.createDataFrame([(10, 1, day, 2)], schemas.SERVICE_ORDERS)
    visit = spark.createDataFrame([(10, 3.0, "Tech", "2020-01-02")], schemas.FIELD_ACTIVITY)
    tables = [
        (ref.service_request_history(request), schemas.SERVICE_REQUEST_HISTORY),
        (ref.asset_error_codes(event), schemas.ASSET_ERROR_CODES),
        (ref.periodic_work(work, asset), schemas.PERIODIC_WORK),
        (ref.technician_history(visit, order, asset), schemas.TECHNICIAN_HISTORY),
    ]
    for df, schema in tables:
        assert set(df.columns) == set(schema.fieldNames())
        assert sources.checked_for_sink(df, schema).count() == 1
    row = sources.checked_for_sink(tables[3][0], schemas.TECHNICIAN_HISTORY).first()
    assert (row["technician_id"], row["serial_order_date"]) == (3, "2020-01-01")


def test_error_code_counts(spark):
    day = d("2020-01-01")
    rows = [(1, "SN", 1, day, "1", 5, 1, 1, "x", 100), (1, "SN", 1, day, "2", 5, 1, 1, "x", 100), (1, "SN", 1, day, "3", 5, 1, 1, "x", 101)]
    schema = T.StructType([*schemas.ERROR_EVENTS.fields, T.StructField("order_id", T.LongType())])
    got = ref.asset_error_codes(spark.createDataFrame(rows, schema)).first()
    assert (got["code_id"], got["value"], got["asset_serial_number"]) == (5, 2, "SN")


def test_joins_keep_or_drop_unknown_assets(spark):
    day = d("2020-01-01")
    asset = spark.createDataFrame([(1, day, "Active", 7, "SN", 1)], schemas.ASSETS)
    work = spark.createDataFrame([(1, day, 4), (2, day, 5)], schemas.DAILY_WORK)
    assert ref.periodic_work(work, asset, "left").count() == 2
    assert ref.periodic_work(work, asset, "inner").count() == 1
    order = spark.createDataFrame([(10, 1, day, 2), (11, 2, day, 2)], schemas.SERVICE_ORDERS)
    visit = spark.createDataFrame([(10, None, "T", "x"), (11, 3.0, "T", "x"), (None, 3.0, "T", "x")], schemas.FIELD_ACTIVITY)
    left = {r["customer_asset_identifier"]: r["technician_id"] for r in ref.technician_history(visit, order, asset).collect()}
    assert left == {1: None, 2: 3}
    assert ref.technician_history(visit, order, asset, "inner").count() == 1


@pytest.mark.parametrize(
    "listed, want",
    [([], [1, 2, None]), ([1], [2]), ([1, 1, 3], [2]), ([1, None], []), ([None], [])],
)
def test_not_in_follows_sql(spark, listed, want):
    keys = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    ids = spark.createDataFrame([(x,) for x in listed], "other long")
    got = [row.id for row in joins.not_in(keys, "id", ids, "other").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_not_in_plan_has_no_unbounded_broadcast(spark):
    keys = spark.range(10).select("id")
    ids = spark.range(5).withColumnRenamed("id", "other")
    plan = joins.not_in(keys, "id", ids, "other")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_encode_and_restrict(spark):
    df = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "k long, name string")
    code = spark.createDataFrame([("a", 1), ("a", 4), ("b", 2)], "name string, id int")
    assert sorted((r.k, r.name) for r in joins.encode(df, code, "name").collect()) == [(1, 4), (2, None), (3, None)]
    listed = spark.createDataFrame([(1,), (1,)], "id long")
    assert [r.k for r in joins.restrict_to(df, listed, "k").collect()] == [1]


def test_scalar_functions(spark):
    row = spark.range(1).select(
        fn.weekday_sunday0(fn.as_date("2020-01-05")).alias("sunday"),
        fn.weekday_sunday0(fn.as_date("2020-01-11")).alias("saturday"),
        fn.ratio(F.lit(1), F.lit(0)).alias("none"),
        fn.at_most(F.lit(30), 30).alias("one"),
        fn.at_most(F.lit(31), 30).alias("zero"),
        fn.parse_date(F.lit("2020-01-05 10:00:00")).alias("day"),
        fn.parse_date(F.lit("0000-00-00 00:00:00")).alias("bad"),
        fn.date_label(fn.as_date("2020-01-05")).alias("text"),
        fn.infinite_to_null(F.lit(float("-inf"))).alias("inf"),
        fn.infinite_to_null(F.lit(2.0)).alias("two"),
    ).first()
    assert tuple(row) == (0, 6, None, 1, 0, d("2020-01-05"), None, "2020-01-05", None, 2.0)
    df = spark.createDataFrame([(float("inf"), None, "x"), (float("nan"), 3, None)], "a double, b int, c string")
    assert [tuple(r) for r in fn.numbers_filled(df).collect()] == [(0.0, 0, "x"), (0.0, 3, None)]
