from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from daymill.operators.conform import SourceSpec, conform
from daymill.session import clear_scratch, scratch_path, scratch_root
from daymill.sources import (
    period_paths,
    promote,
    read_delimited,
    read_layer,
    read_parquet,
    scan_period,
    scan_text_period,
    write_table,
)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def write_text(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_delimited_text_is_typed_by_name(spark, tmp_path):
    path = write_text(tmp_path / "a.psv", "extra|value|Year", "x|1.5|2022", "y|T|2023", "z||2023")
    df = read_delimited(spark, path, {"Year": "string", "value": "double"}, "|")
    assert dict(df.dtypes) == {"Year": "string", "value": "double"}
    assert [tuple(r) for r in df.collect()] == [("2022", 1.5), ("2023", None), ("2023", None)]
    assert "extra" not in plan_of(df)


def test_delimited_text_without_types_stays_text(spark, tmp_path):
    path = write_text(tmp_path / "a.csv", "yr,vol", "2022,7")
    df = read_delimited(spark, path)
    assert dict(df.dtypes) == {"yr": "string", "vol": "string"}
    assert df.first().asDict() == {"yr": "2022", "vol": "7"}


def test_files_with_another_header_are_not_shifted(spark, tmp_path):
    write_text(tmp_path / "in" / "1.csv", "a,b", "1,2")
    write_text(tmp_path / "in" / "2.csv", "b,a", "2,1")
    with pytest.raises(Exception, match="header"):
        read_delimited(spark, str(tmp_path / "in"), {"a": "int"}).collect()


def test_yearly_text_files_keep_their_own_header(spark, tmp_path):
    write_text(tmp_path / "2022.psv", "a|b", "1|2")
    write_text(tmp_path / "2023.psv", "b|c|a", "4|0|3")
    df = scan_text_period(spark, f"{tmp_path}/{{period}}.psv", ["2022", "2023"], {"a": "int", "b": "int"}, "|")
    assert sorted(map(tuple, df.collect())) == [(1, 2), (3, 4)]


SPEC = SourceSpec("s", {"Id": "long", "fee": "double"}, {"Id": "item", "Fee": "fee"})


def monthly_files(spark, root):
    layouts = [("2022-10", "Id", "fee", "int"), ("2022-11", "Id", "Fee", "double"), ("2022-12", "Id", "fee", "int")]
    for n, (month, identity, fee, kind) in enumerate(layouts):
        frame = spark.range(n * 10, n * 10 + 5).select(
            F.lit(n).cast(kind).alias(fee), F.col("id").cast("int").alias(identity)
        )
        write_table(frame, f"{root}/{month}.parquet")


def test_period_scan_conforms_files_that_drift(spark, tmp_path):
    monthly_files(spark, tmp_path)
    template = f"{tmp_path}/{{period}}.parquet"
    assert period_paths(template, ["2022-10"]) == {"2022-10": f"{tmp_path}/2022-10.parquet"}

    def read(periods, stamp=None):
        return scan_period(spark, template, periods, lambda df: conform(df, SPEC, ("item", "fee")), stamp)

    everything = read(["2022-10", "2022-11", "2022-12"])
    assert dict(everything.dtypes) == {"item": "bigint", "fee": "double"}
    expected = sorted((n * 10 + i, float(n)) for n in range(3) for i in range(5))
    assert sorted(map(tuple, everything.collect())) == expected
    assert plan_of(everything).count("FileScan") == 2  # one per layout
    assert read(["2022-11"]).count() == 5
    stamped = read(["2022-10", "2022-12"], stamp="period")
    assert plan_of(stamped).count("FileScan") == 1
    counts = stamped.groupBy("period").count().collect()
    assert sorted(map(tuple, counts)) == [("2022-10", 5), ("2022-12", 5)]


def test_missing_month_is_an_error(spark, tmp_path):
    monthly_files(spark, tmp_path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_period(spark, f"{tmp_path}/{{period}}.parquet", ["2023-01"], lambda df: df)


def test_missing_months_can_be_skipped(spark, tmp_path):
    monthly_files(spark, tmp_path)
    template = f"{tmp_path}/{{period}}.parquet"
    some = scan_period(spark, template, ["2022-10", "2023-01"], lambda df: df, missing="skip")
    assert some.count() == 5
    with pytest.raises(FileNotFoundError):
        scan_period(spark, template, ["2023-01"], lambda df: df, missing="skip")
    with pytest.raises(ValueError):
        scan_period(spark, template, ["2022-10"], lambda df: df, missing="ignore")


TYPES = {"item": "long", "fee": "double"}


def test_promotion_keeps_sources_and_other_months(spark, tmp_path):
    def rows(month, fee, count=4):
        return spark.range(count).select(
            F.col("id").alias("item"), F.lit(fee).alias("fee"), F.lit(month).alias("period")
        )

    root = str(tmp_path / "raw")
    a = promote(rows("2022-10", 1.0).unionByName(rows("2022-11", 2.0)), root, "a", rebalance=True)
    b = promote(rows("2022-10", 3.0), root, "b")
    promote(rows("2022-10", 9.0, count=2), root, "a")
    assert a != b
    assert sorted(r["fee"] for r in read_layer(spark, a, TYPES).collect()) == [2.0] * 4 + [9.0] * 2
    assert [r["fee"] for r in read_layer(spark, b, TYPES).collect()] == [3.0] * 4


def test_an_emptied_month_leaves_no_old_rows(spark, tmp_path):
    rows = spark.range(8).select(
        F.col("id").alias("item"), F.lit(1.0).alias("fee"), F.concat(F.lit("2022-1"), F.col("id") % 2).alias("period")
    )
    path = promote(rows, str(tmp_path / "raw"), "a")
    promote(rows.filter("period = '2022-10' AND item > 2"), str(tmp_path / "raw"), "a", periods=["2022-10", "2022-11", "2022-12"])
    assert sorted(r["item"] for r in read_layer(spark, path, TYPES).collect()) == [4, 6]
    assert read_layer(spark, path, TYPES, ["2022-11", "2022-12"]).count() == 0


def test_a_crowded_period_is_split_on_promotion(spark, tmp_path):
    """One month holds a third of all rows; rebalancing spreads it over several tasks."""
    month = F.when(F.col("id") % 3 == 0, F.lit("2022-10")).otherwise(
        F.concat(F.lit("2023-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0"))
    )
    rows = spark.range(0, 300_000, 1, 8).select(
        F.col("id").alias("item"), F.rand(1).alias("fee"), month.alias("period")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        path = promote(rows, str(tmp_path / "raw"), "a", rebalance=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {folder.name: len(list(folder.glob("*.parquet"))) for folder in (tmp_path / "raw" / "a").glob("period=*")}
    assert files["period=2022-10"] > 2
    assert sum(files.values()) < 60
    assert read_layer(spark, path, TYPES, ["2022-10"]).count() == 100_000


def test_layer_read_prunes_periods_and_columns(spark, tmp_path):
    rows = spark.range(20).select(
        F.col("id").alias("item"),
        F.lit(1.0).alias("fee"),
        F.concat(F.lit("2022-1"), F.col("id") % 3).alias("period"),
    )
    path = promote(rows, str(tmp_path / "raw"), "a")
    some = read_layer(spark, path, TYPES, ["2022-10", "2022-12"])
    assert some.columns == ["item", "fee"]
    assert sorted(r["item"] for r in some.collect()) == [i for i in range(20) if i % 3 != 1]
    plan = plan_of(some.select("item"))
    assert "PartitionFilters: [period" in plan and "ReadSchema: struct<item:bigint>" in plan


def test_write_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(3), path)
    assert read_parquet(spark, path).count() == 3


def test_scratch_is_below_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_can_be_removed(spark):
    root = Path(scratch_root(spark).removeprefix("file:"))
    one, two = scratch_path(spark, "x"), scratch_path(spark, "y")
    write_table(spark.range(3), one)
    write_table(spark.range(3), two)
    clear_scratch(spark, one)
    assert not (root / one.rsplit("/", 1)[1]).exists() and read_parquet(spark, two).count() == 3
    with pytest.raises(ValueError):
        clear_scratch(spark, "/tmp/elsewhere")
    clear_scratch(spark, two)
    assert not (root / two.rsplit("/", 1)[1]).exists()


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Unset:
        def get(self, key, default):
            return default

    cluster = SimpleNamespace(conf=Unset(), sparkContext=SimpleNamespace(master="yarn", applicationId="a"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(cluster, "x")
    local = SimpleNamespace(conf=Unset(), sparkContext=SimpleNamespace(master="local[2]", applicationId="a"))
    assert scratch_path(local, "x").rsplit("/", 1)[0] == scratch_path(local, "y").rsplit("/", 1)[0]
