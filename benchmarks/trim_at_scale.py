"""Time the outlier trim on many copies of the trip rows, against the plain recipe.

    python benchmarks/trim_at_scale.py SCRATCH_FOLDER [COPIES]

Copies differ in their distances. The plain recipe takes two actions per column over
the whole table; both ways must keep the same rows.
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from bench import plain_trim  # noqa: E402
from daymill.operators.outliers import trim_outliers  # noqa: E402
from daymill.period import Period  # noqa: E402
from daymill.plans import trips  # noqa: E402
from daymill.queries import daily_tables  # noqa: E402
from daymill.session import get_session, scratch_path  # noqa: E402

SF_DIR = "/root/testdata/sf0.1"
WHOLE = Period.of("1995-01-01", "2001-12-31")
COLUMNS = [c for c in trips.TRIMMED_COLUMNS if c != "improvement_surcharge"]


def main(scratch: str, copies: int) -> None:
    spark = get_session(
        "trim-at-scale",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": scratch,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = f"{scratch}/copies-{copies}"
    if not Path(path).exists():
        copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        landing, raw = daily_tables.landing_trips(spark, SF_DIR), scratch_path(spark, "raw")
        trips.promote_trips(spark, landing, raw, WHOLE, "{source}/period={period}", missing="skip")
        whole = trips.read_raw_trips(spark, raw, WHOLE)
        rows = whole.repartition(32).withColumn("copy", copy)
        longer = F.col("trip_distance") * (1 + F.col("copy") / 7)
        rows.withColumn("trip_distance", longer).drop("copy").write.parquet(path)
    table = spark.read.parquet(path)
    valid = trips.validate_trips(table, WHOLE)
    result = {"rows": table.count(), "valid": valid.count()}
    for name, trim in (("split", trim_outliers), ("plain", plain_trim)):
        started = time.perf_counter()
        kept = trim(valid, COLUMNS)
        result[f"{name}_sec"] = round(time.perf_counter() - started, 1)
        result[f"{name}_kept"] = kept.count()
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 40)
