"""Extension points: what a part of one's own must offer to take a built-in part's place. All work on whole DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame

from .operators import catalog, chunks, claims, entities
from .operators.graph import Graph
from .sources import files, web


@runtime_checkable
class Chunker(Protocol):
    def __call__(self, versions: DataFrame) -> DataFrame:
        """schemas.VERSION rows to schemas.CHUNK rows."""


@runtime_checkable
class ClaimExtractor(Protocol):
    def __call__(self, chunks: DataFrame) -> DataFrame:
        """schemas.CHUNK rows to schemas.CLAIM rows."""


@runtime_checkable
class EntityExtractor(Protocol):
    def __call__(self, chunks: DataFrame) -> DataFrame:
        """schemas.CHUNK rows to schemas.MENTION rows."""


@runtime_checkable
class MentionRetriever(Protocol):
    def __call__(self, mentions: DataFrame, catalog: DataFrame, k: int) -> DataFrame:
        """Each mention's k best catalog rows, as `catalog.retrieved` returns them."""


@runtime_checkable
class Judge(Protocol):
    def __call__(self, mentions: DataFrame, candidates: DataFrame) -> DataFrame:
        """A decision on each mention, as `catalog.judged` returns it."""


@runtime_checkable
class GraphSink(Protocol):
    def __call__(self, graph: Graph, path: str) -> None:
        """Writes the graph."""


def parquet_sink(graph: Graph, path: str) -> None:
    files.write_graph(graph.nodes, graph.edges, path)


class Registry:
    """Parts by name; a name is taken once."""

    def __init__(self, what: str):
        self.what, self.parts = what, {}

    def add(self, name: str, part: Callable) -> Callable:
        if name in self.parts:
            raise ValueError(f"there is a {self.what} {name!r} already")
        self.parts[name] = part
        return part

    def __getitem__(self, name: str) -> Callable:
        if name not in self.parts:
            raise ValueError(f"unknown {self.what} {name!r}; known: {', '.join(sorted(self.parts))}")
        return self.parts[name]


CHUNKERS, CLAIM_EXTRACTORS, ENTITY_EXTRACTORS = Registry("chunker"), Registry("claim extractor"), Registry("entity extractor")
RETRIEVERS, JUDGES, GRAPH_SINKS, SOURCES = Registry("retriever"), Registry("judge"), Registry("graph sink"), Registry("source strategy")

CHUNKERS.add("windows", chunks.chunked)
CLAIM_EXTRACTORS.add("rules", claims.rule_claims)
ENTITY_EXTRACTORS.add("rules", entities.rule_mentions)
ENTITY_EXTRACTORS.add("gazetteer", entities.gazetteer_mentions)
ENTITY_EXTRACTORS.add("ensemble", entities.ensemble_mentions)
RETRIEVERS.add("hybrid", catalog.retrieved)
JUDGES.add("deterministic", catalog.judged)
GRAPH_SINKS.add("parquet", parquet_sink)
SOURCES.add("sitemap", web.sitemap_entries)
