import pytest
from pyspark.errors import AnalysisException

from medallion.sources.files import (
    MissingInput,
    SchemaMismatch,
    input_coverage,
    month_path,
    parse_months,
    read_lookup,
    read_months,
    require_inputs,
)

from tests.conftest import plan


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    one = spark.createDataFrame([(1, 1.0), (2, 2.0)], "id int, fee double")
    one.write.parquet(month_path(folder, "2025-01"))
    spark.createDataFrame([(3,)], "id int").write.parquet(month_path(folder, "2025-02"))
    one.write.parquet(month_path(folder, "2024-12"))
    return folder


def test_parse_months():
    assert parse_months(" 2025-01, ,2025-02,") == ["2025-01", "2025-02"]


def test_layout(root):
    assert month_path("r/", "2025-01") == "r/year2025/yellow_tripdata_2025-01.parquet"


def test_months_read_as_one_table(spark, root):
    assert read_months(spark, root, ["2024-12", "2025-01"]).count() == 4


def test_months_with_other_columns_are_refused(spark, root):
    with pytest.raises(SchemaMismatch, match="fee: double in 2025-01; missing in 2025-02"):
        read_months(spark, root, ["2025-01", "2025-02"])
    with pytest.raises(SchemaMismatch, match="fee: missing in 2025-02; double in 2025-01"):
        read_months(spark, root, ["2025-02", "2025-01"])


def test_fill_adds_the_columns_it_names(spark, root):
    table = read_months(spark, root, ["2025-02", "2025-01"], fill={"fee": "double", "new": "int"})
    assert sorted((r.id, r.fee, r.new) for r in table.collect() if r.fee) == [(1, 1.0, None), (2, 2.0, None)]
    assert table.filter("fee is null").count() == 1


def test_fill_covers_no_other_column(spark, root):
    with pytest.raises(SchemaMismatch, match="fee"):
        read_months(spark, root, ["2025-01", "2025-02"], fill={"other": "int"})


def test_another_type_needs_fill(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, 1.5)], "ID long, fee double").write.parquet(month_path(folder, "2025-01"))
    spark.createDataFrame([(2, "2.5")], "id int, fee string").write.parquet(month_path(folder, "2025-02"))
    months = ["2025-01", "2025-02"]
    with pytest.raises(SchemaMismatch, match="id: bigint in 2025-01; int in 2025-02"):
        read_months(spark, folder, months, fill={"fee": "double"})
    table = read_months(spark, folder, months, fill={"fee": "double", "id": "bigint"})
    assert sorted(map(tuple, table.collect())) == [(1, 1.5), (2, 2.5)]
    spark.createDataFrame([(3, "much")], "id long, fee string").write.parquet(month_path(folder, "2025-03"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_months(spark, folder, ["2025-01", "2025-03"], fill={"fee": "double"}).collect()


def test_one_scan_per_schema(spark, root):
    table = read_months(spark, root, ["2024-12", "2025-01", "2025-02"], fill={"fee": "double"})
    assert plan(table).count("FileScan") == 2


def test_missing_and_no_months(spark, root):
    with pytest.raises(AnalysisException):
        read_months(spark, root, ["2025-01", "2025-09"])
    with pytest.raises(MissingInput):
        read_months(spark, root, [])


def test_coverage(spark, root):
    months = ["2024-12", "2025-01", "2025-03", "2025-04"]
    rows = {r.month: r for r in input_coverage(spark, root, months).collect()}
    assert {m: r.found for m, r in rows.items()} == dict(zip(months, [True, True, False, False]))
    assert rows["2025-01"].length > 0 and rows["2025-03"].files == 0
    with pytest.raises(MissingInput, match="2025-03, 2025-04"):
        require_inputs(spark, root, months)
    assert require_inputs(spark, root, months[:2]).count() == 2
    with pytest.raises(MissingInput):
        require_inputs(spark, root + "/nowhere", months)
    with pytest.raises(MissingInput):
        require_inputs(spark, root, [])


def test_lookup_is_all_text(spark, tmp_path):
    file = tmp_path / "zones.csv"
    file.write_text('"LocationID","Borough"\n1,"EWR"\n2," N/A "\n3,""\n4,\n')
    rows = read_lookup(spark, str(file), ["LocationID", "Borough"]).collect()
    # An empty field is NULL, quoted or not: what the CSV source does by default.
    assert [tuple(r) for r in rows] == [("1", "EWR"), ("2", " N/A "), ("3", None), ("4", None)]


def test_lookup_header_must_match(spark, tmp_path):
    file = tmp_path / "zones.csv"
    file.write_text("Borough,LocationID\nEWR,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_lookup(spark, str(file), ["LocationID", "Borough"]).collect()
