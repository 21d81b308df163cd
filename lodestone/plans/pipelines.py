"""End-to-end plans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import canonical, catalog, claims, entities, graph
from ..operators.chunks import ChunkConfig, chunked


@dataclass
class Evidence:
    chunks: DataFrame
    claims: DataFrame
    mentions: DataFrame
    canonical_entities: DataFrame
    canonical_claims: DataFrame
    graph: graph.Graph


def evidence(versions: DataFrame, seed: DataFrame | None = None, config: ChunkConfig = ChunkConfig(), segmenter: str = "sentencizer", k: int = 5) -> Evidence:
    """Document versions to the evidence graph: chunks, rule claims, ensemble mentions, decisions against the catalog, links."""
    c = chunked(versions, config, segmenter)
    return evidence_of(c, seed, k)


def evidence_of(chunks: DataFrame, seed: DataFrame | None = None, k: int = 5) -> Evidence:
    cl = claims.rule_claims(chunks)
    m = entities.ensemble_mentions(chunks)
    if seed is not None:
        m = catalog.resolved(m, seed, k)
    ce = canonical.canonical_entities(m)
    cc = canonical.canonical_claims(cl, ce)
    return Evidence(chunks, cl, m, ce, cc, graph.evidence_graph(cc, ce))
