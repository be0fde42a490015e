"""Command line for the three jobs; suitable for ``spark-submit``.

    python -m memberpulse service-report --memberships ROOT --app-events T --web-events T \\
        --out DIR --as-of 2024-01-22 --active "event_name = 'click'"
    python -m memberpulse newsletter-kpis --member-pages DIR --post-pages DIR --kpi-root DIR \\
        --archive-root DIR --as-of 2024-01-22
    python -m memberpulse member-upkeep --member-pages DIR --registry T --out DIR \\
        --now "2024-01-22 05:00:00" --member-limit 1000 --seed 7 [--deleted-ids T] \\
        [--failed-invites T] [--fresh-member-pages DIR]

Tables (T) are catalog names or parquet paths; the registry may be a ``registry_table``,
which is then changed in place.  Each command prints the written locations, and what its
reads counted, as one JSON object.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from memberpulse.functions.temporal import DEFAULT_TZ
from memberpulse.plans import jobs
from memberpulse.session import DEFAULT_SHUFFLE_BYTES, get_session, input_bytes, sizing_conf


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="memberpulse")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("service-report", help="weekly and monthly membership + engagement reports")
    s.add_argument("--memberships", required=True, help="folder holding all_members_{date}.csv")
    s.add_argument("--app-events", required=True)
    s.add_argument("--web-events", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--as-of", required=True, help="run date, local calendar (YYYY-MM-DD)")
    s.add_argument("--active", required=True, help="SQL condition over web events that counts as active use")
    s.add_argument("--null-period", choices=("epoch", "drop"), default="epoch")
    s.add_argument("--max-rejected", type=int, help="fail if more rows have no identity, or bad dates or amounts")

    n = sub.add_parser("newsletter-kpis", help="member, subscriber and newsletter KPIs per language")
    n.add_argument("--member-pages", required=True)
    n.add_argument("--post-pages", required=True)
    n.add_argument("--kpi-root", default="", help="folder of the KPI tables; without it they are catalog tables")
    n.add_argument("--archive-root", required=True)
    n.add_argument("--as-of", required=True)

    m = sub.add_parser("member-upkeep", help="deletion candidates, invites and registry sync")
    m.add_argument("--member-pages", required=True)
    m.add_argument("--registry", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--now", required=True, help="job time, UTC (YYYY-MM-DD HH:MM:SS)")
    m.add_argument("--member-limit", required=True, type=int)
    m.add_argument("--seed", required=True)
    m.add_argument("--deleted-ids")
    m.add_argument("--failed-invites")
    m.add_argument("--fresh-member-pages")
    m.add_argument("--max-rejected", type=int, help="fail if more registry rows have no email")
    for sp in (n, m):
        sp.add_argument("--page", default="page", help="the landed documents' field with their page number, 'file name', or 'none'")

    for sp in (s, n, m):
        sp.add_argument("--tz", default=DEFAULT_TZ)
        sp.add_argument("--input-bytes", type=int, default=0, help="size of the input, which sizes scan splits and shuffles; else that of the input paths")
        sp.add_argument("--master", default=None, help="only outside spark-submit, e.g. local[8]")
    return p


def _inputs(args: argparse.Namespace) -> list[str]:
    """The input paths of a command; catalog names have none."""
    given = vars(args)
    names = ("memberships", "app_events", "web_events", "member_pages", "post_pages", "registry", "fresh_member_pages")
    return [given[n] for n in names if given.get(n) and "/" in given[n]]


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = get_session(args.master)
    size = args.input_bytes or input_bytes(spark, _inputs(args))
    if size > DEFAULT_SHUFFLE_BYTES:                       # below, Spark's own settings are as large
        for key, value in sizing_conf(size).items():
            spark.conf.set(key, value)
    page = None if getattr(args, "page", None) == "none" else getattr(args, "page", None)
    if args.job == "service-report":
        out = jobs.run_service_report(spark, args.memberships, args.app_events, args.web_events, args.out,
                                      args.as_of, F.expr(args.active), args.tz, args.null_period, args.max_rejected)
    elif args.job == "newsletter-kpis":
        out = jobs.run_newsletter_kpis(spark, args.member_pages, args.post_pages, args.kpi_root,
                                       args.archive_root, args.as_of, args.tz, page=page)
    else:
        out = jobs.run_member_upkeep(spark, args.member_pages, args.registry, args.out, args.now,
                                     args.member_limit, args.seed, args.deleted_ids, args.failed_invites,
                                     args.fresh_member_pages, page, args.max_rejected)
    print(json.dumps({**out, "metrics": getattr(out, "metrics", {})}))
    return out


if __name__ == "__main__":
    main()
