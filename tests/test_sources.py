from tillroll.sources import CatalogTables, ParquetTables, read_files, write_outputs
from tillroll.sources.publish import publish_table


def test_read_files_formats(spark, tmp_path):
    df = spark.range(5).selectExpr("id", "cast(id * 2 as string) as v")
    df.write.option("header", True).csv(str(tmp_path / "c"))
    df.write.json(str(tmp_path / "j"))
    csv = read_files(spark, str(tmp_path / "c"))                       # header CSV, all strings
    assert {t for _, t in csv.dtypes} == {"string"} and csv.count() == 5
    typed = read_files(spark, str(tmp_path / "c"), schema="id bigint, v string")
    assert dict(typed.dtypes)["id"] == "bigint"
    js = read_files(spark, str(tmp_path / "j"), "json", options={})
    assert sorted(r.id for r in js.collect()) == [0, 1, 2, 3, 4]


def test_parquet_and_catalog_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "orders"))
    assert ParquetTables(spark, str(tmp_path)).table("orders").count() == 3
    publish_table(spark.range(4), str(tmp_path / "ext"), "src_db", "things")
    assert CatalogTables(spark, "src_db").table("things").count() == 4


def test_concurrent_writes_equal_sequential(spark, tmp_path):
    outs = {f"t{i}": spark.range(i * 10) for i in range(1, 5)}
    seq = write_outputs(outs, str(tmp_path / "seq"))
    par = write_outputs(outs, str(tmp_path / "par"), concurrency=3)
    assert seq == par == {"t1": 10, "t2": 20, "t3": 30, "t4": 40}
    assert spark.read.parquet(str(tmp_path / "par" / "t3")).count() == 30
