"""Command line: python -m lodestone.cli STAGE --in PATH --out PATH [options]; tables are JSON lines."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from . import schemas
from .operators import canonical, catalog, chunks, claims, entities, graph, validation
from .sources import files, jsonl


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lodestone", description=__doc__)
    sub = p.add_subparsers(dest="stage", required=True)
    one = sub.add_parser("chunk", help="document versions to chunks")
    one.add_argument("--size", type=int, default=1200)
    one.add_argument("--overlap", type=int, default=200)
    two = sub.add_parser("claims", help="chunks to rule claims")
    two.add_argument("--threshold", type=float, default=0.8)
    three = sub.add_parser("entities", help="chunks to mentions, with decisions if a catalog is given")
    three.add_argument("--catalog")
    for x in (one, two, three):
        x.add_argument("--in", dest="source", required=True)
        x.add_argument("--out", required=True)
    four = sub.add_parser("graph", help="chunks, claims and entities to the evidence graph")
    for name in ("chunks", "claims", "entities", "out"):
        four.add_argument(f"--{name}", required=True)
    four.add_argument("--source-id")
    four.add_argument("--claim-min", type=float, default=0.6)
    four.add_argument("--entity-min", type=float, default=0.7)
    four.add_argument("--max-anomalies", type=int, default=0)
    return p


def counted(g: graph.Graph) -> dict[str, int]:
    return {f"{r['kind']}:{r['type']}": r["n"] for r in graph.counts(g).collect()}  # a row a type


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    o = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("lodestone").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if o.stage == "chunk":
        versions = jsonl.read(spark, o.source, schemas.VERSION)
        found = chunks.chunked(versions, chunks.ChunkConfig(o.size, o.overlap))
        print(jsonl.append_new(found, o.out, ["source_id", "source_document_id", "document_checksum", "chunk_index"]), "chunks added")
    elif o.stage == "claims":
        found = claims.rule_claims(jsonl.read(spark, o.source, schemas.CHUNK), o.threshold)
        print(jsonl.append_new(found, o.out, ["claim_id"]), "claims added")
    elif o.stage == "entities":
        found = entities.ensemble_mentions(jsonl.read(spark, o.source, schemas.CHUNK))
        if o.catalog:
            found = catalog.resolved(found, catalog.checked_seed(files.catalog_seed(spark, o.catalog)))
        print(jsonl.append_new(found, o.out, ["entity_id"]), "mentions added")
    else:
        for label in ("chunks", "claims", "entities"):
            files.require_file(spark, getattr(o, label), label)
        bad = validation.anomalies(*(jsonl.lines(spark, p) for p in (o.chunks, o.claims, o.entities)))
        cl, en = jsonl.read(spark, o.claims, schemas.CLAIM), canonical.canonical_entities(jsonl.read(spark, o.entities, schemas.MENTION))
        g = graph.evidence_graph(canonical.canonical_claims(cl, en), en, o.source_id)
        limits = graph.Thresholds(o.claim_min, o.entity_min)
        kept = graph.filtered(g, limits)
        files.write_graph(g.nodes, g.edges, f"{o.out}/full")
        files.write_graph(kept.nodes, kept.edges, f"{o.out}/filtered")
        bad.write.mode("overwrite").json(f"{o.out}/anomalies")
        print({"stats": counted(g), "filtered_stats": counted(kept), "anomalies": {r["category"]: r["n"] for r in validation.by_category(bad).collect()}})
        return validation.exit_code(bad, o.max_anomalies)
    return 0


if __name__ == "__main__":
    sys.exit(main())
