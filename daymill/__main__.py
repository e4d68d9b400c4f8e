"""Build the daily tables from the command line; see ``python -m daymill --help``."""

from __future__ import annotations

import argparse

from daymill.period import Period
from daymill.plans import observations, trips, volumes
from daymill.plans.model import build_model
from daymill.session import get_session


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="daymill")
    tables = parser.add_subparsers(dest="table", required=True)
    for name, landing in (
        ("trips", "folder with yellow_taxi/YYYY-MM.parquet and green_taxi/YYYY-MM.parquet"),
        ("observations", "path of the yearly text files, {period} standing for the year"),
        ("volumes", "path of the text file"),
    ):
        table = tables.add_parser(name)
        table.add_argument("--landing", required=True, help=landing)
        table.add_argument("--raw", required=True, help="where typed rows are kept")
        table.add_argument("--curated", required=True, help="where the daily table goes")
        table.add_argument("--start", required=True, help="first day, YYYY-MM-DD")
        table.add_argument("--end", required=True, help="last day, YYYY-MM-DD")
        table.add_argument("--on-null-stddev", choices=("skip", "error"), default="skip")
        table.add_argument("--on-non-finite", choices=("drop", "error", "keep"), default="drop")
    tables.choices["trips"].add_argument("--prefix", default="", help="put before the table names")
    tables.choices["trips"].add_argument(
        "--last-day", choices=("whole_day", "midnight"), default="whole_day"
    )
    tables.choices["trips"].add_argument(
        "--keep-differing-totals", action="store_true", help="compare totals without dropping rows"
    )
    tables.choices["observations"].add_argument(
        "--as-written", action="store_true", help="do not pad months and days to two digits"
    )
    model = tables.add_parser("model")
    for name in ("zone-days", "volumes", "observations"):
        model.add_argument(f"--{name}", required=True, help="path of the curated daily table")
    model.add_argument("--zones", required=True, help="Parquet table of zone and borough")
    model.add_argument("--zone", default="pu_location_id", help="zone column")
    model.add_argument("--borough", default="boro", help="borough column")
    model.add_argument("--out", required=True, help="folder for features, coefficients, scores")
    model.add_argument("--features", required=True, nargs="+")
    model.add_argument("--label", required=True)
    model.add_argument("--training", required=True, nargs=2, metavar=("FIRST", "LAST"))
    model.add_argument("--scored", required=True, nargs=2, metavar=("FIRST", "LAST"))
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    spark = get_session()
    if options.table == "model":
        paths = {"zone_days": options.zone_days, "volumes": options.volumes, "observations": options.observations}
        build_model(
            spark,
            paths,
            spark.read.parquet(options.zones),
            options.out,
            options.features,
            options.label,
            Period.of(*options.training),
            Period.of(*options.scored),
            zone=options.zone,
            borough=options.borough,
        )
        return
    period = Period.of(options.start, options.end)
    trim = {"on_null_stddev": options.on_null_stddev, "on_non_finite": options.on_non_finite}
    places = (options.landing, options.raw, options.curated, period)
    if options.table == "trips":
        trips.promote_trips(spark, options.landing, options.raw, period)
        trips.build_trip_tables(
            spark,
            options.raw,
            options.curated,
            period,
            options.prefix,
            last_day=options.last_day,
            enforce_total=not options.keep_differing_totals,
            **trim,
        )
    elif options.table == "observations":
        observations.build_observation_table(spark, *places, pad=not options.as_written, **trim)
    else:
        volumes.build_volume_table(spark, *places, **trim)


if __name__ == "__main__":
    main()
