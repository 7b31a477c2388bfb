"""Run a whole flow on stored inputs and replace its output by a CSV table.

    spark-submit --py-files gleanframe.zip run.py rent  --payloads P --pages D --out O
    spark-submit --py-files gleanframe.zip run.py sale  --payloads P --pages S --out O
    spark-submit --py-files gleanframe.zip run.py account --pages D --out O [--rejects R]

P holds page_num and body; D holds url and html; S holds url, attempt and html (parquet).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from gleanframe.operators import details
from gleanframe.plans import flows
from gleanframe.plans.counters import RunCounters
from gleanframe.session import Stored
from gleanframe.sources.csv_table import sink_csv_overwrite
from gleanframe.sources.payloads import src_listing_payloads


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("flow", choices=["rent", "sale", "account"])
    parser.add_argument("--payloads", help="listing responses")
    parser.add_argument("--pages", required=True, help="stored pages")
    parser.add_argument("--out", required=True)
    parser.add_argument("--rejects", help="where the rejected account pages go")
    parser.add_argument("--site", default="", help="put in front of relative advert URLs")
    parser.add_argument("--stat-phrase", default="", help="marks the time a seller is on the site")
    parser.add_argument("--counters", help="where the counts of a rent run go")
    parser.add_argument("--header", action="append", default=[], metavar="COLUMN=NAME",
                        help="another name for a column of the written table")
    return parser.parse_args(argv)


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    pages = spark.read.parquet(options.pages)
    counters = RunCounters() if options.counters and options.flow == "rent" else None
    if options.flow == "account":
        # walked once; the two tables are cut from what that gave
        audited = Stored(details.account_audit(pages), "account").rows
        records = audited.filter("failed_field is null").drop("failed_field")
        if options.rejects:
            rejects = audited.filter("failed_field is not null").select("url", "failed_field")
            sink_csv_overwrite(rejects, options.rejects, rejects.columns)
    else:
        payloads = src_listing_payloads(spark.read.parquet(options.payloads))
        if options.flow == "rent":
            records = flows.rent_listing_flow(payloads, pages, options.site, options.stat_phrase, counters)
        else:
            records = flows.sale_listing_flow(payloads, pages, options.site)
    header = dict(pair.split("=", 1) for pair in options.header)
    sink_csv_overwrite(records, options.out, records.columns, header)
    if counters:
        report = counters.table(spark)
        sink_csv_overwrite(report, options.counters, report.columns)


if __name__ == "__main__":
    from gleanframe.session import build_session

    run(build_session(), arguments())
