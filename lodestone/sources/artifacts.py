"""Graph artifacts for people: one sorted JSON document, a summary, and an HTML page with the filtered graph in it.

These are for graphs that a browser can show; larger ones stay in Parquet (`files.write_graph`), and asking for more
than `most` rows raises before anything is collected.
"""

from __future__ import annotations

import json
from html import escape
from pathlib import Path

from pyspark.sql import functions as F

from ..operators.graph import Graph, Thresholds, counts

SCHEMA_VERSION = "1.0.0"


def artifact(graph: Graph, generated_at: str, thresholds: Thresholds = Thresholds(), most: int = 200_000) -> dict:
    size = graph.nodes.limit(most + 1).count() + graph.edges.limit(most + 1).count()
    if size > most:
        raise ValueError(f"the graph has more than {most} nodes and edges; write it as tables")
    nodes = [{"id": r["id"], "type": r["type"], "label": r["label"], "properties": json.loads(r["properties"])} for r in graph.nodes.orderBy("id").collect()]
    edges = [{"id": r["id"], "type": r["type"], "source": r["source"], "target": r["target"], "properties": json.loads(r["properties"])} for r in graph.edges.orderBy("id").collect()]
    stats = {f"{r['kind']}:{r['type']}": r["n"] for r in counts(graph).collect()}
    return {"schema_version": SCHEMA_VERSION, "generated_at": generated_at, "thresholds": {"claim_confidence_min": thresholds.claim, "entity_confidence_min": thresholds.entity}, "stats": stats, "nodes": nodes, "edges": edges}


def summary(full: dict, kept: dict, anomalies, most_anomalies: int = 0) -> dict:
    """Counts of both graphs and of anomalies by category; exit_code is 1 if there are too many."""
    found = {r["category"]: r["n"] for r in anomalies.groupBy("category").agg(F.count("*").alias("n")).collect()}
    return {"stats": full["stats"], "filtered_stats": kept["stats"], "anomalies": found, "exit_code": int(sum(found.values()) > most_anomalies)}


def save(document: dict, path: str | Path) -> None:
    Path(path).write_text(json.dumps(document, sort_keys=True, indent=2, ensure_ascii=True), encoding="utf-8")


PAGE = """<!doctype html><html lang="en"><head><meta charset="utf-8"><title>{title}</title><style>
body{{font:14px sans-serif;margin:2em}} td,th{{border-bottom:1px solid #ccc;padding:.3em;text-align:left}} input{{padding:.3em;width:30em}}
</style></head><body><h1>{title}</h1><p><input id="q" placeholder="filter"></p><table><thead><tr><th>publisher</th><th>claim</th><th>mentions</th></tr></thead><tbody id="rows"></tbody></table>
<script type="application/json" id="graph">{data}</script><script>
const g=JSON.parse(document.getElementById("graph").textContent),n=Object.fromEntries(g.nodes.map(x=>[x.id,x])),by={{}};
g.edges.filter(e=>e.type==="MENTIONS").forEach(e=>(by[e.source]??=[]).push(n[e.target]?.label??""));
const rows=g.edges.filter(e=>e.type==="RAISED").map(e=>[n[e.source]?.label??"",n[e.target]?.label??"",(by[e.target]??[]).join(", ")]);
function show(q){{const t=document.getElementById("rows");t.replaceChildren(...rows.filter(r=>r.join(" ").toLowerCase().includes(q)).map(r=>{{const tr=document.createElement("tr");r.forEach(c=>{{const td=document.createElement("td");td.textContent=c;tr.append(td)}});return tr}}))}}
document.getElementById("q").oninput=e=>show(e.target.value.toLowerCase());show("");
</script></body></html>"""


def viewer(document: dict, title: str = "Evidence graph") -> str:
    return PAGE.format(title=escape(title), data=json.dumps(document, sort_keys=True).replace("</", "<\\/"))
