"""Headline queries over documents staged from the driver's tables; prints one JSON line.

The documents are written once per corpus (``stage`` seconds), as they would lie in a
corpus folder. Each query then runs from the documents to its whole result.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

from lineweft.adapters.calcviews import calcview_docs
from lineweft.adapters.events import event_lines
from lineweft.adapters.reports import layout_docs
from lineweft.adapters.scripts import chain_metadata, lineage_facts, script_files, star_chains
from lineweft.operators import calcviews, diagnostics, events, metadata, reports, scripts
from lineweft.session import build_session, shared_folder
from lineweft.sources.calcviews import parse_calcviews
from lineweft.sources.events import parse_events

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

STAGED = {
    "events": event_lines,
    "scripts": script_files,
    "facts": lineage_facts,
    "chain_metadata": chain_metadata,
    "chains": star_chains,
    "views": calcview_docs,
    "layouts": layout_docs,
}


def script_links(read):
    refs = scripts.table_refs(scripts.statements(read("scripts")))
    facts = scripts.prepare_facts(read("facts"))
    return scripts.script_links(refs, facts, scripts.script_columns(facts))


QUERIES = {
    "event_links": lambda read: events.event_links(events.derive(parse_events(read("events")))),
    "dataset_flow": lambda read: events.dataset_flow(events.derive(parse_events(read("events")))),
    "event_problems": lambda read: diagnostics.event_problems(parse_events(read("events"))),
    "file_summary": lambda read: diagnostics.file_summary(parse_events(read("events"))),
    "script_links": script_links,
    "star_fixpoint": lambda read: metadata.star_fixpoint(read("chain_metadata"), read("chains")),
    "view_dataset_flow": lambda read: calcviews.view_dataset_flow(calcviews.derive(parse_calcviews(read("views")))),
    "view_links": lambda read: calcviews.view_links(calcviews.derive(parse_calcviews(read("views")))),
    "report_links": lambda read: reports.report_links(reports.derive(reports.parse_layouts(read("layouts")))),
}


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(CPUS)),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "20g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = f"{shared_folder(spark)}/bench-{uuid.uuid4().hex}"
    stage, documents = {}, {}
    for name, adapter in STAGED.items():
        start = time.perf_counter()
        adapter(spark, FOLDER).repartition(2 * int(CPUS)).write.parquet(f"{base}/{name}")
        stage[name] = round(time.perf_counter() - start, 2)
        print("stage", name, stage[name], file=sys.stderr, flush=True)
        documents[name] = spark.read.parquet(f"{base}/{name}").count()

    def read(name):
        return spark.read.parquet(f"{base}/{name}")

    seconds = {}
    for name, query in QUERIES.items():
        start = time.perf_counter()
        query(read).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 2)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "lineage headline queries, documents to result",
                "value": round(sum(seconds.values()), 2),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "stage": stage,
                "documents": documents,
                "events_per_sec": round(documents["events"] / seconds["event_links"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
