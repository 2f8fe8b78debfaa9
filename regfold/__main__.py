"""Command line: ``python -m regfold <command>`` (submit the same with ``spark-submit``).

  daily      expand landed archives, load, fan out and publish every detail table
  retention  list (or, with --delete, remove) drop files at least 21 days old
"""

from __future__ import annotations

import argparse
import json


def _archive_dirs(pairs: list[str]) -> dict:
    """``registry:version=folder`` -> {registry: {version: folder}}."""
    out: dict = {}
    for p in pairs:
        key, folder = p.split("=", 1)
        registry, version = key.split(":", 1)
        out.setdefault(registry, {})[version] = folder
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="regfold")
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily", help="load one daily drop")
    d.add_argument("--archives", nargs="+", required=True, metavar="REGISTRY:VERSION=DIR",
                   help="folders of landed zip archives, e.g. egrul:new=/landing/egrul/new")
    d.add_argument("--out", required=True, help="root of the published tables")
    d.add_argument("--run-date", required=True, help="yyyy-MM-dd, for the audit")
    d.add_argument("--parallel", type=int, default=8, help="detail tables written at once")
    d.add_argument("--again", action="store_true", help="load archive entries that earlier runs have loaded, too")
    d.add_argument("--drops", metavar="DIR", help="also write the run's slices as flat drop files")
    d.add_argument("--bucket-name", help="passed on in the manifest")
    d.add_argument("--pilot-name", help="passed on in the manifest")
    r = sub.add_parser("retention", help="drop files at least 21 days old")
    r.add_argument("--names", required=True, help="folder of drop files to check")
    r.add_argument("--now", required=True, help="yyyy-MM-dd HH:mm:ss")
    r.add_argument("--delete", action="store_true", help="remove the expired drop files")
    a = ap.parse_args(argv)

    from pyspark.sql import functions as F

    from regfold.session import get_session

    spark = get_session()
    if a.cmd == "daily":
        from regfold.plans.daily import daily_run

        res = daily_run(spark, _archive_dirs(a.archives), a.out, a.run_date, parallel=a.parallel, once=not a.again,
                        drop_dir=a.drops, bucket_name=a.bucket_name, pilot_name=a.pilot_name)
        for row in res.report.collect():  # 50 rows: one per table
            print(json.dumps(row.asDict()))
        n_fail = res.audit.count()
        print(json.dumps({"failures": n_fail}))
        return 0
    if a.cmd == "retention":
        from regfold.plans.publish import expire_drops

        for row in expire_drops(spark, a.names, F.to_timestamp(F.lit(a.now)),
                                delete=a.delete).toLocalIterator():
            print(json.dumps({"drop_name": row.drop_name, "age_days": row.age_days, "expired": row.expired,
                              "deleted": bool(a.delete and row.expired)}))
        return 0
    return 2


if __name__ == "__main__":
    raise SystemExit(main())
