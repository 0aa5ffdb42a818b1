"""Command line: ``python -m quillspan [options] [input]`` extracts claims of one text, ``python -m quillspan evidence BATCH --exporter-revision R``
exports a corpus batch as evidence records (``--source-spans``: as its source spans)."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import evidence
from .plans.extract import Extraction
from .sources import config as C
from .sources import corpus, documents


def _rows(df: DataFrame) -> list[dict]:
    """The rows of one text's tables, as JSON objects."""
    return [json.loads(r.j) for r in df.select(F.to_json(F.struct(*df.columns)).alias("j")).collect()]


def extract(spark: SparkSession, argv: list[str]) -> str:
    args, config = C.from_arguments(argv)
    text = Path(args.input).read_text() if args.input else sys.stdin.read()
    docs = documents.from_texts(spark, [{"id": args.id, "kind": args.kind, "title": args.title, "authors": args.author or None, "language": args.language, "uri": args.uri, "text": text}])
    run = Extraction(docs, config)
    if run.ingested.isEmpty():
        raise SystemExit("the input is empty")
    artifacts = run.write()
    if config.stages[-1] != "worldview":
        out: object = {"runId": run.ingested.first().run_id, "candidates": [], "relations": [], "worldview": None, "stages": _rows(run.summaries().orderBy("place")), "artifacts": artifacts}
    else:
        worldview = json.loads(run.worldviews().first().worldview)
        out = worldview if args.worldview_only else {
            "runId": run.ingested.first().run_id, "candidates": _rows(run.index.orderBy("pos")), "relations": _rows(run.relations.orderBy("from_id", "to_id", "kind")), "worldview": worldview,
            "diagnostics": _rows(run.diagnostics), "stages": _rows(run.summaries().orderBy("place")), "artifacts": artifacts,
        }
    result = json.dumps(out, ensure_ascii=False, indent=2 if args.pretty else None)
    if args.output:
        Path(args.output).write_text(result + "\n")
    return result


def export(spark: SparkSession, argv: list[str]) -> str:
    p = argparse.ArgumentParser(prog="quillspan evidence")
    p.add_argument("batch")
    p.add_argument("--exporter-revision", default="")
    p.add_argument("--schema", default=corpus.SCHEMA)
    p.add_argument("--source-spans", action="store_true")
    args = p.parse_args(argv)
    batch = corpus.read_batch(corpus.lines_of(spark, Path(args.batch).read_text()), args.schema)
    if args.source_spans:
        return json.dumps({"schema": "source_span_interchange", "schemaVersion": 1, "producer": batch.producer, "sources": _rows(batch.sources.orderBy("pos")), "spans": _rows(batch.spans.orderBy("source_id", "sequence"))}, ensure_ascii=False, indent=2)
    return evidence.export(batch, args.exporter_revision)


def main(argv: list[str] | None = None) -> None:
    argv = sys.argv[1:] if argv is None else argv
    spark = SparkSession.builder.appName("quillspan").getOrCreate()
    print(export(spark, argv[1:]) if argv[:1] == ["evidence"] else extract(spark, argv))


if __name__ == "__main__":
    main()
