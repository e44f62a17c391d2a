"""Run one layer job, as a launcher (spark-submit) would.

    python -m strata plain_bronze --topic-path T --bronze B --checkpoint C [--trigger "500 milliseconds"]
    python -m strata plain_silver --bronze B --table db.plain_silver [--mode incremental --checkpoint C]
    python -m strata plain_gold   --table db.plain_silver --gold G [--store K] [--location L]
    python -m strata po_bronze    --topic-path T --bronze B --checkpoint C [--audit A]
    python -m strata po_silver    --bronze B --table db.po_silver [--money float]
    python -m strata po_gold      --table db.po_silver --gold G [--level order] [--store K] [--location L]

Sessions need not share a metastore: ``--location`` of a silver job is where its
table lies, the same ``--location`` lets a gold job of another session find it.
``--bootstrap-servers`` makes the topic a Kafka topic.  The session comes
from the launcher; locations are arguments, nothing is tied to one machine.
"""

from __future__ import annotations

import argparse

from strata.plans import jobs
from strata.session import build_session
from strata.sources.topic import PLAIN_TOPIC, PO_TOPIC, Topic


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="strata")
    p.add_argument("job", choices=["plain_bronze", "plain_silver", "plain_gold", "po_bronze", "po_silver", "po_gold"])
    p.add_argument("--topic-path")
    p.add_argument("--bootstrap-servers")
    p.add_argument("--bronze")
    p.add_argument("--checkpoint")
    p.add_argument("--trigger", default=None, help='interval such as "500 milliseconds", or availableNow')
    p.add_argument("--audit")
    p.add_argument("--table")
    p.add_argument("--location")
    p.add_argument("--mode", default="incremental", choices=jobs.MODES)
    p.add_argument("--money", default="double", choices=["float", "double", "decimal"])
    p.add_argument("--using", default="parquet")
    p.add_argument("--gold")
    p.add_argument("--store", help="folder of the key-value store that gold items are put into")
    p.add_argument("--level", default="line", choices=["line", "order"])
    a = p.parse_args(argv)

    spark = build_session(app_name=f"strata-{a.job}")
    name = PLAIN_TOPIC if a.job.startswith("plain") else PO_TOPIC
    topic = Topic(name, path=a.topic_path, bootstrap_servers=a.bootstrap_servers)
    if a.job == "plain_bronze":
        jobs.plain_bronze(spark, topic, a.bronze, a.checkpoint, a.trigger or "500 milliseconds")
    elif a.job == "po_bronze":
        jobs.po_bronze(spark, topic, a.bronze, a.checkpoint, a.trigger or "500 milliseconds", a.audit)
    elif a.job == "plain_silver":
        jobs.plain_silver(spark, a.bronze, a.table, a.mode, a.checkpoint, a.using, a.location)
    elif a.job == "po_silver":
        jobs.po_silver(spark, a.bronze, a.table, a.mode, a.checkpoint, a.money, a.using, a.location)
    elif a.job == "plain_gold":
        print(jobs.plain_gold(spark, a.table, a.gold, a.store, a.location))
    else:
        print(jobs.po_gold(spark, a.table, a.gold, a.level, a.store, a.location))


if __name__ == "__main__":
    main()
