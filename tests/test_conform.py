import pytest
from pyspark.sql import functions as F

from daymill.operators.conform import SourceSpec, cast_columns, conform, union_sources

A = SourceSpec(
    name="a",
    types={"Id": "long", "price": "double", "Fee": "double"},
    rename={"Id": "item_id", "a_time": "time", "Fee": "fee"},
    drop=("flag",),
)
B = SourceSpec(
    name="b",
    types={"Id": "long", "price": "double"},
    rename={"Id": "item_id", "b_time": "time"},
    drop=("flag", "kind"),
    constants={"fee": (0, "double")},
)
COLUMNS = ("item_id", "time", "price", "fee")


def test_casts_ignore_case_and_turn_misfits_null(spark):
    df = spark.createDataFrame([("7", "1.5", "x"), ("T", "", "y")], "ID string, p string, rest string")
    typed = cast_columns(df, {"id": "int", "P": "double", "absent": "double"})
    assert dict(typed.dtypes) == {"ID": "int", "p": "double", "rest": "string"}
    assert [tuple(r) for r in typed.collect()] == [(7, 1.5, "x"), (None, None, "y")]


@pytest.mark.parametrize("spelling", ["Fee", "fee", "FEE"])
def test_spelling_of_the_result_is_fixed(spark, spelling):
    df = spark.createDataFrame(
        [("1", "t", 2, 0.5, "f")], f"Id string, a_time string, price int, {spelling} double, flag string"
    )
    result = conform(df, A, COLUMNS)
    assert result.columns == list(COLUMNS)
    assert dict(result.dtypes) == {
        "item_id": "bigint",
        "time": "string",
        "price": "double",
        "fee": "double",
    }


def test_result_does_not_depend_on_column_order(spark):
    df = spark.createDataFrame(
        [("1", "t", 2.0, 0.5, "f")], "Id string, a_time string, price double, fee double, flag string"
    )
    turned = df.select(*reversed(df.columns))
    assert conform(df, A, COLUMNS).collect() == conform(turned, A, COLUMNS).collect()


def test_sources_unite_by_name(spark):
    a = spark.createDataFrame(
        [(1, "t1", 2.0, 0.5, "f")], "Id long, a_time string, price double, fee double, flag string"
    )
    b = spark.createDataFrame(
        [("k", 3.0, "f", "t2", 2)], "kind string, price double, flag string, b_time string, Id long"
    )
    united = union_sources([conform(a, A), conform(b, B)]).select(*COLUMNS)
    assert sorted(map(tuple, united.collect())) == [(1, "t1", 2.0, 0.5), (2, "t2", 3.0, 0.0)]


def test_conform_is_one_projection(spark, tmp_path):
    df = spark.range(5).select(
        F.col("id").alias("Id"), F.lit("t").alias("b_time"), F.lit(1).alias("price"), F.lit("k").alias("kind")
    )
    df.write.parquet(str(tmp_path / "b"))
    plan = conform(spark.read.parquet(str(tmp_path / "b")), B, COLUMNS)
    optimized = plan._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("Project") == 1
    assert "kind" not in plan._jdf.queryExecution().executedPlan().toString()
