from datetime import date

import pytest
from pyspark.errors import AnalysisException

from clickmill.functions import date_parts
from clickmill.operators import activity_by_product
from clickmill.plans import jobs
from clickmill.plans.clicks import clicks
from clickmill.schema import ACTIVITY, ACTIVITY_BY_PRODUCT, INGEST_DATE, TABLES
from clickmill.session import CLUSTER_CONF, STREAM_CONF, configure, new_folder
from clickmill.sources import (
    create_tables,
    list_columns,
    list_databases,
    list_tables,
    publish,
    state_cutoff,
    stated_cutoff,
    swap_table,
    text_lines,
    write_table,
)
from clickmill.sources.folders import children


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{tmp_path.name}"
    create_tables(spark, name, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


def counts(spark, *rows):
    return spark.createDataFrame(rows, ACTIVITY_BY_PRODUCT)


def test_create_and_list(spark, database, tmp_path):
    create_tables(spark, database, str(tmp_path / "db"))
    assert {r.tableName for r in list_tables(spark, database).collect()} == set(TABLES)
    columns = list_columns(spark, database).collect()
    # Speed tables have the day as well.
    assert len(columns) == sum(len(schema) + name.startswith("stream_") for name, schema in TABLES.items())
    assert ("batch_visitors_by_product", 2, "unique_visitors", "bigint") in columns
    assert (database,) in [tuple(r) for r in list_databases(spark).collect()]
    properties = spark.sql(f"SHOW TBLPROPERTIES {database}.batch_activity_by_product").collect()
    assert ("primary_key", "product,timestamp_hour") in [tuple(r) for r in properties]


def test_insert_rows_and_selects(spark, database):
    table = f"{database}.batch_activity_by_product"
    spark.sql(f"INSERT INTO {table} VALUES ('a', 0, 1, 2, 3)")
    counts(spark, ("b", 0, 4, 5, 6)).createOrReplaceTempView("more")
    spark.sql(f"INSERT INTO {table} BY NAME SELECT page_view_count, purchase_count, "
              "add_to_cart_count, timestamp_hour, product FROM more")
    assert rows_of(spark.table(table)) == [("a", 0, 1, 2, 3), ("b", 0, 4, 5, 6)]


def test_batch_job_points_the_tables_at_each_version(spark, sf_dir, database, tmp_path):
    rows = clicks(spark, sf_dir)
    rows.select(*ACTIVITY.names, *date_parts(date(2024, 2, 1))).write.partitionBy(*INGEST_DATE).parquet(str(tmp_path / "landed"))
    table = f"{database}.batch_activity_by_product"
    for _ in range(2):
        jobs.batch(spark, str(tmp_path / "landed"), str(tmp_path / "db"), database=database)
    assert rows_of(spark.table(table)) == rows_of(activity_by_product(rows))
    for file in spark.table(table).inputFiles():
        keys = [(r.product, r.timestamp_hour) for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)


def test_swap_replaces_the_table(spark, database):
    for name, product in (("serving", "old"), ("serving_temp", "new")):
        counts(spark, (product, 0, 1, 1, 1)).write.saveAsTable(f"{database}.{name}")
    for _ in range(2):
        swap_table(spark, f"{database}.serving_temp", f"{database}.serving")
        assert spark.table(f"{database}.serving").first().product == "new"
        spark.table(f"{database}.serving").write.saveAsTable(f"{database}.serving_temp")


def test_publish_moves_readers_to_the_new_version(spark, database, tmp_path):
    table, location = f"{database}.serving", str(tmp_path / "serving")
    first = publish(counts(spark, ("a", 0, 1, 1, 1)), table, location)
    before = spark.table(table)
    assert rows_of(before) == [("a", 0, 1, 1, 1)]
    second = publish(counts(spark, ("b", 0, 2, 2, 2)), table, location)
    assert rows_of(spark.table(table)) == [("b", 0, 2, 2, 2)]
    assert first != second and spark.read.parquet(first).count() == 1
    assert rows_of(before) == [("a", 0, 1, 1, 1)]
    for n in range(4):
        publish(counts(spark, ("c", n, 0, 0, 0)), table, location)
        assert len(children(spark, location)) == 2


def test_batch_states_its_cutoff(spark, database):
    table = f"{database}.batch_activity_by_product"
    assert stated_cutoff(spark, table) is None
    for hour in (5, None, 7_200_000):
        state_cutoff(spark, table, hour)
        assert stated_cutoff(spark, table) == (hour or 5)


def test_serve_needs_to_know_what_the_tables_share(spark, database, tmp_path):
    rows = counts(spark, ("a", 0, 1, 0, 0))
    for options in ({}, {"cutoff_hour": 5, "additive": True}):
        with pytest.raises(ValueError, match="additive"):
            jobs.serve(rows, rows, f"{database}.serving", str(tmp_path / "s"), **options)


def test_serving_table_can_be_rebuilt_from_itself(spark, database, tmp_path):
    table, location = f"{database}.serving", str(tmp_path / "serving")
    publish(counts(spark, ("a", 0, 1, 0, 0)), table, location)
    for _ in range(2):
        jobs.serve(spark.table(table), counts(spark, ("a", 0, 1, 0, 0)), table, location, additive=True)
    assert rows_of(spark.table(table)) == [("a", 0, 3, 0, 0)]


def test_published_files_hold_products_in_ranges_newest_hour_first(spark, sf_dir, database, tmp_path):
    table = f"{database}.serving"
    rows = activity_by_product(clicks(spark, sf_dir))
    path = jobs.serve(rows, rows, table, str(tmp_path / "s"), additive=True)
    for file in spark.read.parquet(path).inputFiles():
        keys = [(r.product, -r.timestamp_hour) for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(counts(spark, ("a", 0, 1, 1, 1)), path)
    assert write_table(counts(spark, ("b", 0, 1, 1, 1)), path).first().product == "b"
    assert write_table(counts(spark, ("c", 0, 1, 1, 1)), path, "append").count() == 2
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_table(counts(spark, ("d", 0, 1, 1, 1)), path, "errorifexists")


def test_text_lines_are_opaque(spark, tmp_path):
    (tmp_path / "products").write_text('Trident,"White Gum, Spearmint"\nA,B\nA,B\n')
    lines = text_lines(spark, str(tmp_path / "products"), "product").collect()
    assert sorted(r.product for r in lines) == ["A,B", "A,B", 'Trident,"White Gum, Spearmint"']


def test_new_folders_lie_in_one_shared_folder(spark):
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    shared = spark.conf.get("spark.checkpoint.dir")
    assert first != second
    assert first.startswith(f"{shared}/") and second.startswith(f"{shared}/")


def test_configure_applies_settings_in_order():
    class Builder(dict):
        def config(self, key, value):
            self[key] = value
            return self

    built = configure(Builder(), STREAM_CONF)
    assert dict(built) == CLUSTER_CONF | STREAM_CONF
