"""spark-submit entry of the air-quality job."""

import argparse
import sys

from hourstar.operators.star import PERIODS
from hourstar.plans.air_quality import Job, run
from hourstar.session import build_session
from hourstar.sources.landing import LAYOUTS
from hourstar.sources.lists import entities_from_text


def parse(args: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser("hourstar", description="Landed documents become an audited, published star schema.")
    parser.add_argument("provinces", help="comma-separated names")
    parser.add_argument("raw", help="folder of the landed documents")
    parser.add_argument("out", help="folder of the star schema's versions")
    parser.add_argument("start", help="first hour, a wall time of the session's zone")
    parser.add_argument("end", help="last hour")
    parser.add_argument("--layout", choices=LAYOUTS, default="file", help="where a document's province is named")
    parser.add_argument("--database", help="catalog schema whose names shall stand for the published tables")
    parser.add_argument("--record-id-type", choices=("int", "bigint"), default="int", help="bigint for a fact beyond 2^31 rows")
    parser.add_argument("--period", choices=sorted(PERIODS), help="split the fact's files by it")
    parser.add_argument("--time-zone", default="Asia/Bangkok")
    return parser.parse_args(args)


def main(args: list[str]) -> int:
    given = parse(args)
    spark = build_session("hourstar air quality", given.time_zone)
    try:
        job = Job(given.raw, given.out, given.start, given.end, layout=given.layout, record_id_type=given.record_id_type,
                  database=given.database, period=given.period)
        run(spark, entities_from_text(spark, given.provinces), job)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
