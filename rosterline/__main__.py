"""Command line: ``python -m rosterline <command>``.

    list                               the registered query keys
    query KEY --data DIR --out PATH    run one registered query, write parquet (or --csv)
    sync --config conf.json            run the sync pipeline on the configured tables

The sync configuration is JSON::

    {"tables": {"roster":   {"path": "...", "fmt": "parquet"},
                "accounts": {"path": "..."}, "logons": {"path": "..."},
                "people":   {"path": "..."}},
     "params": {"dept_map": [{"dept": "BUILDING", "factory": "1060"}], "tasks": {...}},
     "out": "<folder for results and report>"}

Table versions are written under ``spark.checkpoint.dir`` (the shared folder
the cluster names); results and the report text go to ``out``.
"""

from __future__ import annotations

import argparse
import json
import sys


_MASTER = None


def _spark():
    from rosterline.session import checkpoint_dir, get_spark
    local = bool(_MASTER and _MASTER.startswith("local"))
    spark = get_spark(_MASTER, shuffle_partitions=8 if local else None)
    checkpoint_dir(spark)
    return spark


def cmd_list(_args) -> int:
    from rosterline import plans
    for k in plans.queries():
        print(k)
    return 0


def cmd_query(args) -> int:
    from rosterline import plans
    spark = _spark()
    df = plans.queries()[args.key](spark, args.data)
    w = df.write.mode("overwrite")
    (w.option("header", "true").csv(args.out) if args.csv else w.parquet(args.out))
    return 0


def cmd_sync(args) -> int:
    from rosterline.params import SyncParams
    from rosterline.plans.sync import run_sync, sync_report
    from rosterline.sources.tables import TableSpec, read_table
    with open(args.config, encoding="utf-8") as f:
        conf = json.load(f)
    spark = _spark()
    tables = {name: read_table(spark, TableSpec(path=t["path"], fmt=t.get("fmt", "parquet"),
                                                options=tuple((t.get("options") or {}).items())))
              for name, t in conf["tables"].items()}
    params = SyncParams.from_config(conf["params"]) if conf.get("params") else SyncParams()
    paths = {}
    _, results = run_sync(spark, tables, params, paths=paths)
    out = conf.get("out")
    if out:
        results.write.mode("overwrite").parquet(f"{out}/results")
        sync_report(results).write.mode("overwrite").json(f"{out}/report")
    for r in results.orderBy("step").collect():          # one row per task (metadata)
        print(f"{r.step} {r.task}: {'ok' if r.success else 'FAILED'} {r.affected_rows} rows, {r.duration_ms} ms")
    for k, v in sorted(paths.items()):
        print(f"{k}: {v}")
    return 0 if all(r.success for r in results.collect()) else 1


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="rosterline")
    ap.add_argument("--master", default=None, help="e.g. local[8]; on a cluster leave it to spark-submit")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    q = sub.add_parser("query")
    q.add_argument("key")
    q.add_argument("--data", required=True)
    q.add_argument("--out", required=True)
    q.add_argument("--csv", action="store_true")
    s = sub.add_parser("sync")
    s.add_argument("--config", required=True)
    args = ap.parse_args(argv)
    global _MASTER
    _MASTER = args.master
    return {"list": cmd_list, "query": cmd_query, "sync": cmd_sync}[args.cmd](args)


if __name__ == "__main__":
    sys.exit(main())
