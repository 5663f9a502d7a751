"""Command-line entry to the batch jobs and the shipped queries.

    spark-submit -m tessera.plans.cli bronze --changes <json dir> --bronze <root> --quarantine <dir> --batch <name> [--set-aside]
    spark-submit -m tessera.plans.cli silver --bronze <root> --silver <root> [--mode overwrite|append] [--latest]
    spark-submit -m tessera.plans.cli gold   --silver <root> --gold <root>
    spark-submit -m tessera.plans.cli sql    --gold <root> (--query q03 | --text "SELECT ...") [--out <dir>]

(or ``python -m tessera.plans.cli ...`` with a local master).  ``sql``
registers the gold folders under the catalog names the shipped SQL uses.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from ..session import get_session
from ..sinks import lake as sink
from ..sources import lake as src
from . import medallion
from . import queries as Q


def run(argv: list[str], spark: SparkSession | None = None) -> dict:
    p = argparse.ArgumentParser(prog="tessera")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bronze")
    b.add_argument("--changes", required=True)
    b.add_argument("--bronze", required=True)
    b.add_argument("--quarantine", required=True)
    b.add_argument("--batch", required=True, help="name of this batch; the same name again replaces its output")
    b.add_argument("--set-aside", action="store_true", help="set files aside that can't be read, and land the others")
    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    s.add_argument("--latest", action="store_true")
    g = sub.add_parser("gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--gold", required=True)
    q = sub.add_parser("sql")
    q.add_argument("--gold", required=True)
    which = q.add_mutually_exclusive_group(required=True)
    which.add_argument("--query", choices=sorted(Q.QUERIES))
    which.add_argument("--text", help="SQL over the gold tables")
    q.add_argument("--out", required=True, help="folder for the whole result")
    a = p.parse_args(argv)
    spark = spark or get_session()
    if a.cmd == "bronze" and a.set_aside:
        return medallion.bronze_files_job(spark, src.change_files(spark, a.changes), a.bronze, a.quarantine, a.batch)
    if a.cmd == "bronze":
        return medallion.bronze_job(src.read_changes(spark, a.changes), a.bronze, a.quarantine, a.batch)
    if a.cmd == "silver":
        return medallion.silver_job(spark, a.bronze, a.silver, a.mode, a.latest)
    if a.cmd == "gold":
        return medallion.gold_job(spark, a.silver, a.gold)
    if a.text:
        medallion.register_gold(spark, a.gold)
        sink.run_sql_to(spark, a.text, a.out)
    else:
        sink.write_gold(Q.QUERIES[a.query](medallion.read_gold(spark, a.gold)), a.out)
    return {"out": a.out}


def main() -> None:
    import sys
    print(json.dumps(run(sys.argv[1:]), default=str))


if __name__ == "__main__":
    main()
