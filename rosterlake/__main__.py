"""``spark-submit`` entry of the daily run.

python -m rosterlake --root hdfs:///people \\
    --dump workday/employees=hdfs:///dumps/workers \\
    --dump greenhouse/job_applications=hdfs:///dumps/applications
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from rosterlake.plans.daily import RunConfig, run_daily


def parse(args: list[str] | None = None) -> RunConfig:
    parser = argparse.ArgumentParser(prog="rosterlake")
    parser.add_argument("--root", required=True, help="folder of all tables and dumps on their way")
    parser.add_argument("--dump", action="append", default=[], metavar="SOURCE/ENTITY=PATH")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="ISO date, today in UTC by default")
    parser.add_argument("--lenient", action="store_true", help="admit the valid records of a batch")
    parser.add_argument("--drift-raw", action="store_true", help="look for drift before mapping")
    parser.add_argument("--drift-sample", type=int, metavar="N", help="look at the first N records only")
    parser.add_argument("--corrected", action="store_true", help="attrition by mean headcount, over all leavers")
    parser.add_argument("--prefix", default="", help="begins the names of the catalog schemas")
    given = parser.parse_args(args)
    dumps: dict[str, dict[str, str]] = {}
    for item in given.dump:
        name, _, path = item.partition("=")
        source, _, entity = name.partition("/")
        if not (source and entity and path):
            parser.error(f"not SOURCE/ENTITY=PATH: {item}")
        dumps.setdefault(source, {})[entity] = path
    now = dt.datetime.now(dt.timezone.utc)
    return RunConfig(
        root=given.root,
        dumps=dumps,
        as_of=given.as_of or now.date(),
        run_ts=now,
        strict=not given.lenient,
        drift_raw=given.drift_raw,
        drift_sample=given.drift_sample,
        corrected=given.corrected,
        prefix=given.prefix,
    )


def main() -> None:
    # The tables live in the catalog, so a run has to find those of the run before.
    spark = SparkSession.builder.appName("rosterlake").enableHiveSupport().getOrCreate()
    result = run_daily(spark, parse())
    for stats in result.stats:
        print(stats)
    print(f"drift events: {result.drift_events}; {result.alert or 'no PII drift'}")


if __name__ == "__main__":
    main()
