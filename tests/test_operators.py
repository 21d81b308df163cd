"""Operators on small rows with known results."""

import re

import pytest
from pyspark.sql import functions as F

from lodestone.functions import ids, text, urls
from lodestone.operators import acquisition, canonical, catalog, chunks, claims, datasets, entities, graph, ml, spans, validation
from lodestone.plans.pipelines import evidence
from lodestone.schemas import CATALOG, CHUNK, MENTION
from lodestone.sources import files, jsonl, web
from lodestone.streaming import stages


def chunk_df(spark, *texts):
    return spark.createDataFrame([(f"k{i}", "acme_press", "https://a.example/d", "sum", i, 0, len(t), t) for i, t in enumerate(texts)], CHUNK)


# Text


def scan(t):
    """The sentence scanner restated."""
    out, start = [], 0
    ends = [i + 1 for i, c in enumerate(t) if c in "!?" or c == "." and not (0 < i < len(t) - 1 and t[i - 1].isdigit() and t[i + 1].isdigit())]
    for end in [*ends, len(t)]:
        piece = t[start:end]
        if kept := piece.strip():
            a = start + len(piece) - len(piece.lstrip())
            out.append((kept, a, a + len(kept)))
        start = end
    return out


SENTENCES = ["One. Two! Three? Four", " v1.2.3 is 5. x ... y", "", "  ", "é 3.5 km.  Z", "no end", "a.b.c", "10. 11.5.", "!?.", "Tab\tand\nline. \x1cx"]


def test_sentences(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(SENTENCES)], "i int, t string").select("i", text.sentences(F.col("t")).alias("s"), text.sentence_count(F.col("t")).alias("n"))
    for r in df.collect():
        assert [tuple(x) for x in r["s"]] == scan(SENTENCES[r["i"]])
        assert r["n"] == len(r["s"])


def test_last_decimal_of_an_unfinished_text(spark):
    """As in the SQL, whose pattern gives back the last decimals of a text that ends without a mark."""
    cases = {"Up 2.5 now. It is 1.25 and 3.75 more": ["Up 2.5 now.", "It is 1.25 and 3.", "75 more"], "at 3.5": ["at 3.", "5"], "at 3.5.": ["at 3.5."], "1.2.3": ["1.2.", "3"]}
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", text.sentences(F.col("t")).alias("s"), text.sentence_count(F.col("t")).alias("n"))
    for r in df.collect():
        assert [x["text"] for x in r["s"]] == cases[r["t"]] == [r["t"][a:b] for a, b in chunks.spans(r["t"], "scanner")]
        assert r["n"] == len(cases[r["t"]])


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(text.normalized(F.lit(" a  b\n\tc "))) == "a b c"
    assert one(text.canonical_name(F.lit("The  Clean-Energy Act!"))) == "clean energy act"
    assert one(text.match_value(F.lit("A.B, c"))) == "a b c"
    assert one(text.human_date(F.lit("18  December 2025"))) == "2025-12-18T00:00:00"
    assert one(text.human_date(F.lit("soon"))) is None
    assert one(text.iso_timestamp(F.lit("2024-01-02T03:04:05Z"))).isoformat()[:19] == "2024-01-02T03:04:05"
    assert one(text.iso_timestamp(F.lit("tomorrow"))) is None
    assert one(text.without_acknowledgements(F.lit("a\n\n b \nAcknowledgements\nc"))) == "a\nb"
    assert one(text.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c")))) == pytest.approx(1 / 3)
    assert one(text.has_quantity(F.lit("50% of it"))) is False and one(text.has_quantity(F.lit("in 1997"))) is True
    assert one(text.quoted(F.lit('"A line."')))
    assert one(text.catalog_tokens(F.lit("A_b c-A"))) == ["a", "b", "c"]
    assert tuple(one(text.found_at(F.lit("x a b y"), F.lit("a  b")))) == (2, 5)


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTPS://Example.ORG/a/b/?utm_source=x&b=2&a=1&c=#top", "https://example.org/a/b?b=2&a=1"), ("http://x.org", "http://x.org/"), ("http://x.org///", "http://x.org/"),
        (" http://x.org/p?gclid=1 ", "http://x.org/p"), ("http://x.org/p?q=a%20b&r=c+d", "http://x.org/p?q=a+b&r=c+d"),
    ],
)
def test_url_identity(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(urls.identity(F.col("u"), exact=True)).first()[0] == want


def test_detail_urls(spark):
    df = spark.createDataFrame([("https://www.x.org/publications/a",), ("https://x.org/publications/a/",), ("https://www.x.org/publications//a",), ("https://www.x.org/news/a",)], "u string")
    f = lambda hosts, keep: [r[0] for r in df.select(urls.is_detail(F.col("u"), hosts, "publications", keep)).collect()]
    assert f(["www.x.org"], False) == [True, False, True, False]
    assert f(["www.x.org", "x.org"], True) == [True, True, False, False]


# Chunks


def version(spark, body):
    return spark.createDataFrame([("s", "d", "c", body)], "source_id string, source_document_id string, checksum string, normalized_text string")


def test_chunk_overlap(spark):
    body = "One short sentence. Two short sentence. Three short sentence. Four short sentence."
    got = chunks.chunked(version(spark, body), chunks.ChunkConfig(45, 25)).orderBy("chunk_index").collect()
    assert [(r["start_char"], r["end_char"]) for r in got] == [(0, 39), (20, 61), (40, 82)]
    assert all(r["chunk_text"] == body[r["start_char"] : r["end_char"]] and r["chunk_id"].startswith("chunk_") for r in got)


def test_chunk_of_one_long_sentence(spark):
    got = chunks.chunked(version(spark, "A" * 80 + "."), chunks.ChunkConfig(20, 5)).collect()
    assert [(r["start_char"], r["end_char"]) for r in got] == [(0, 81)]
    assert chunks.chunked(version(spark, "  ")).collect() == []


@pytest.mark.parametrize("config", [(0, 0), (10, -1), (10, 10)])
def test_chunk_config(config):
    with pytest.raises(ValueError, match="chunk_"):
        chunks.ChunkConfig(*config).check()


# Claims


def test_rule_claims(spark):
    c = chunk_df(spark, "The report shows mixed public sentiment.", "Leaders must act. This increases cost by $5.", "References. Table 2: x. Must:")
    got = claims.rule_claims(c, threshold=0.8).collect()
    assert sorted((r["chunk_id"], r["evidence_text"]) for r in got) == [("k1", "Leaders must act."), ("k1", "This increases cost by $5.")]
    assert all(r["claim_type"] is None and 0 < r["confidence"] <= 1 for r in got)


def test_aligned_claims(spark):
    c = chunk_df(spark, "aa aa  b")
    given = F.array(F.lit("aa"), F.lit("aa"), F.lit("aa b"), F.lit(" "), F.lit("zz"))
    assert sorted((r["start_char"], r["end_char"]) for r in claims.aligned_claims(c, given, "v").collect()) == [(0, 2), (3, 5)]
    asked = claims.asked_claims(c, lambda: lambda texts: [["aa"] for _ in texts], "v").collect()
    assert [(r["start_char"], r["end_char"]) for r in asked] == [(0, 2)]


# Entities


def test_entity_types(spark):
    c = chunk_df(spark, "The Clean Energy Act was discussed by Australia Institute in Queensland.", "The Climate Institute Policy must be implemented.", "Dr Ann Lee met John Smith in South Australia.")
    got = sorted((r["chunk_id"], r["start_char"], r["entity_type"], r["mention_text"]) for r in entities.rule_mentions(c).collect())
    assert [g[2:] for g in got if g[0] == "k0"] == [("POLICY", "Clean Energy Act"), ("ORG", "Australia Institute"), ("JURISDICTION", "Queensland")]
    assert [g[2:] for g in got if g[0] == "k1"] == [("POLICY", "Climate Institute Policy")]
    assert [g[2:] for g in got if g[0] == "k2"] == [("PERSON", "Dr Ann Lee"), ("JURISDICTION", "South Australia")]


def test_ensemble_prefers_the_recogniser(spark):
    c = chunk_df(spark, "Acme Bank spoke.")
    seen = spark.createDataFrame([("k0", 0, 9, "ORG", "Acme")], "chunk_id string, start_char int, end_char int, label string, coref string")
    rules = entities.EntityRules(boundary=0.0, cue=0.9, thresholds=dict.fromkeys(["POLICY", "ORG", "PERSON", "JURISDICTION", "PROGRAM"], 0.9))
    got = entities.ensemble_mentions(c, rules, seen).collect()
    assert [(r["metadata"]["channel"], r["metadata"]["spacy_label"], r["extractor_version"]) for r in got] == [("spacy", "ORG", "ensemble-v1")]


def test_greedy_spans(spark):
    rows = spark.createDataFrame([("a", 0, 5, 0.5), ("a", 4, 9, 0.9), ("a", 9, 12, 0.1), ("b", 0, 1, 0.2)], "g string, start_char int, end_char int, c double")
    got = spans.select_greedy(rows, ["g"], [-F.col("c")], ["start_char", "end_char"])
    assert sorted(map(tuple, got.collect())) == [("a", 4, 9), ("a", 9, 12), ("b", 0, 1)]


def test_greedy_equals_brute_force(spark, sf_dir):
    from lodestone.queries.catalogue import QUERIES

    e = spark.read.parquet(f"{sf_dir}/events.parquet").collect()
    want = set()
    groups = {}
    for r in e:
        a = r["event_id"] % 10 * 3
        groups.setdefault(r["event_id"] // 10, []).append((-r["value"], r["event_id"], a, a + 1 + r["user_id"] % 7))
    for g, rows in groups.items():
        kept = []
        for _, i, a, b in sorted(rows):
            if not any(a < y and x < b for _, x, y in kept):
                kept.append((i, a, b))
        want |= {(g, a, b, i) for i, a, b in kept}
    assert set(map(tuple, QUERIES["entity_overlap_resolution"](spark, sf_dir).select("chunk_id", "start_char", "end_char", "event_id").collect())) == want


# Catalog and decisions


@pytest.fixture
def seed(spark):
    return spark.createDataFrame([("c1", "Clean Energy Act", "POLICY", ["CEA", " cea", "Clean  Act"]), ("c2", "Energy Agency", "ORG", None), ("c3", "Dental Plan", "PROGRAM", ["x"])], CATALOG)


def mention(spark, name, kind="POLICY"):
    return spark.createDataFrame([("e1", "k0", "s", "d", "c", 0, len(name), name, name, kind, 1.0, "v", None, None)], MENTION)


def test_catalog_import(spark, seed):
    got = {r["canonical_entity_key"]: r["aliases"] for r in catalog.imported(seed, seed.where("canonical_entity_key = 'c3'")).collect()}
    assert got == {"c1": ["CEA", "Clean Act"], "c2": []}
    with pytest.raises(Exception, match="without canonical_name"):
        catalog.checked_seed(seed.withColumn("canonical_name", F.lit(" "))).collect()


def test_retrieval(spark, seed):
    got = catalog.retrieved(mention(spark, "clean energy act"), seed, 2).orderBy("rank").collect()
    assert [r["canonical_entity_key"] for r in got] == ["c1", "c2"]
    with pytest.raises(ValueError, match="positive"):
        catalog.retrieved(mention(spark, "x"), seed, 0)


@pytest.mark.parametrize(("name", "status"), [("Clean Energy Act", "linked"), ("clean energy thing", "needs_review"), ("Quite Other", "new_candidate"), ("ab", "abstain")])
def test_decisions(spark, name, status):
    seed = spark.createDataFrame([("c1", "Clean Energy Act", "POLICY", []), ("c3", "Dental Plan", "PROGRAM", [])], CATALOG)
    r = catalog.resolved(mention(spark, name), seed).first()
    assert r["metadata"]["decision_status"] == status
    assert r["canonical_entity_key"] == ("c1" if status == "linked" else None)
    assert catalog.queued(catalog.resolved(mention(spark, name), seed)).count() == (status != "linked")


# Canonical rows and graph


def claim_rows(spark):
    c = chunk_df(spark, "The Clean Energy Act must reduce cost. Nothing else. Policy talk must follow.")
    return claims.rule_claims(c), entities.rule_mentions(c)


def test_links_by_span_then_text(spark):
    cl, m = claim_rows(spark)
    extra = mention(spark, "Policy").withColumn("source_id", F.lit("acme_press")).withColumn("start_char", F.lit(500)).withColumn("end_char", F.lit(506))
    ce = canonical.canonical_entities(m.unionByName(extra))
    got = canonical.canonical_claims(cl, ce).collect()
    assert sorted(x["link_method"] for r in got for x in r["linked_entities"]) == ["span_overlap", "text_match_fallback"]
    assert all(r["canonicalization"]["stage"] == "claim" for r in got)


def test_stale_inputs(spark):
    cl, m = claim_rows(spark)
    ce = canonical.canonical_entities(m)
    canonical.check_fresh(cl, ce, "canon-v1")
    for bad, version in ((ce.withColumn("source_id", F.lit("z")), None), (ce.withColumn("document_checksum", F.lit("z")), None), (ce.limit(0), None), (ce, "other")):
        with pytest.raises(ValueError, match="stale|missing"):
            canonical.check_fresh(cl, bad, version)


def test_graph(spark):
    cl, m = claim_rows(spark)
    ce = canonical.canonical_entities(m)
    g = graph.evidence_graph(canonical.canonical_claims(cl, ce), ce)
    n = {(r["kind"], r["type"]): r["n"] for r in graph.counts(g).collect()}
    assert n == {("node", "PublisherOrganization"): 1, ("node", "Claim"): 2, ("node", "MentionedEntity"): 1, ("edge", "RAISED"): 2, ("edge", "MENTIONS"): 1}
    assert g.nodes.where("type = 'PublisherOrganization'").first()["label"] == "Acme Press"
    f = graph.filtered(g)
    assert f.nodes.count() == 3 and f.edges.count() == 2
    stats = {r["name"]: r["n"] for r in graph.filter_stats(g).collect()}
    assert stats["disconnected_claim_nodes"] == 1 and stats["filtered_edges"] == 2
    assert graph.evidence_graph(cl, m, "nobody").nodes.count() == 0


def test_anomalies(spark):
    lines = lambda name, *ls: spark.createDataFrame([(name, i + 1, x) for i, x in enumerate(ls)], "source_path string, line_number long, line string")
    a = validation.anomalies(lines("c", '{"chunk_id": "k"}', "", "nope"), lines("l", '{"chunk_id": "k"}', "[1]"), lines("e", "{" + ", ".join(f'"{f}": null' if f != "chunk_id" else '"chunk_id": "z"' for f in validation.ENTITY_FIELDS) + "}"))
    got = {r["category"]: r["n"] for r in validation.by_category(a).collect()}
    assert got == {"json_decode_error": 1, "json_not_object": 1, "missing_claim_fields": 1, "orphan_entity_chunk": 1}
    assert "claim_id, confidence" in a.where("category = 'missing_claim_fields'").first()["message"]
    assert validation.exit_code(a, 3) == 1 and validation.exit_code(a, 4) == 0


# Datasets


def test_evaluation(spark):
    s = "chunk_id string, start_char int, end_char int, entity_type string"
    gold = spark.createDataFrame([("k", 0, 1, "ORG"), ("k", 2, 3, "ORG")], s)
    pred = spark.createDataFrame([("k", 0, 1, "ORG"), ("k", 2, 3, "ORG"), ("k", 5, 6, "ORG")], s)
    r = datasets.evaluated(gold, pred).where("scope = 'micro'").first()
    assert (r["tp"], r["fp"], r["fn"]) == (2, 1, 0) and r["precision"] == pytest.approx(2 / 3) and r["recall"] == 1


def test_split_is_the_global_hash_order(spark):
    rows = spark.range(500).withColumnRenamed("id", "key")
    got = {r["key"]: r["split"] for r in datasets.split(rows, "key").collect()}
    import hashlib

    order = sorted(range(500), key=lambda k: hashlib.sha256(f"42:{k}".encode()).hexdigest())
    assert [got[k] for k in order] == ["train"] * 400 + ["dev"] * 50 + ["test"] * 50
    with pytest.raises(ValueError, match="sum"):
        datasets.split(rows, "key", (0.5, 0.1, 0.1))
    assert {r["key"] for r in datasets.sample(rows, "key", 7).collect()} == set(order[:7])


def test_aggregated_claim_rows(spark):
    rows = spark.createDataFrame([("k", "x" * 40, "r1", [(0, 10)], 1), ("k", "x" * 40, "r2", [(0, 10), (11, 32), (5, 99)], 2)], "chunk_id string, chunk_text string, run string, silver_claims array<struct<start_char:int,end_char:int>>, position int")
    r = datasets.aggregated(rows, "position").collect()
    assert [(x["run"], [tuple(s) for s in x["silver_claims"]]) for x in r] == [("r1", [(0, 10), (11, 32)])]


def test_token_model(spark):
    c = chunk_df(spark, *["Costs must fall now. Birds sing." for _ in range(6)])
    gold = spark.createDataFrame([(f"k{i}", 0, 20) for i in range(6)], "chunk_id string, start_char int, end_char int")
    got = ml.token_claims(c, ml.trained(c, gold)).collect()
    assert len(got) == 6 and {(r["start_char"], r["end_char"]) for r in got} == {(0, 20)}


def test_sentences_by_batch_equal_the_expressions(spark):
    odd = [*SENTENCES, "Costs must rise by 5%x. It leads to 3 kt! Table 3: x. 'Quoted.' > cited. a | b. References. It STATES that $5.", "It must. " * 40, "Fig. 2 - 4:", "a\x0bb\u3000must.\x1c É 3,5 MT", "w" * 600 + " must 5 tons"]
    c = chunk_df(spark, *odd).unionByName(chunk_df(spark, "x").withColumn("chunk_text", F.lit(None).cast("string")))
    s = c.select("chunk_id", F.posexplode(text.scored_sentences(F.col("chunk_text"))).alias("position", "s"))
    columns = ("chunk_id", "position", "text", "start_char", "end_char", "skipped", "cues", "score")
    assert sorted(claims.scored_rows(c).select(*columns).collect()) == sorted(s.select("chunk_id", "position", "s.*").select(*columns).collect())


def test_a_sentence_met_again_is_kept(spark):
    """Each distinct short sentence is looked at once in a task, wherever it stands."""
    seen = spark.sparkContext.accumulator(0)

    def make():
        def f(sentence):
            seen.add(1)
            return [(0, len(sentence), sentence)]

        return f

    df = spark.createDataFrame([("One. Two.",)] * 50 + [(None,), (" ",)], "t string").coalesce(1)
    rows = df.select(F.explode(claims.by_sentence(make, "x string")(F.col("t"))).alias("s")).select("s.*").collect()
    assert sorted(set(map(tuple, rows))) == [(0, 0, 4, "One."), (1, 5, 9, "Two.")] and len(rows) == 100 and seen.value == 2


def test_alike_catalog_rows_meet_mentions_as_one_class(spark, sf_dir):
    """The best rows are those of all pairs, whatever the copies, and no mention is stored for it."""
    from lodestone.queries.catalogue import asked_mentions

    rows = [(f"k{i:03d}", ("Green Act", "Blue Act", "Red Plan")[i % 3], ("POLICY", "ORG")[i % 2], [f"a{i % 4}"]) for i in range(99, -1, -1)]
    asked = [("Green Act", "POLICY"), ("Blue a1", "ORG"), ("none", "PERSON")]
    got = catalog.best_rows(spark.createDataFrame(asked, "normalized_mention_text string, entity_type string"), spark.createDataFrame(rows, CATALOG).repartition(5), 4)
    want = set()
    for name, kind in asked:
        q, scored = set(name.lower().split()), []
        for key, canonical_name, row_kind, (alias,) in rows:
            t = {*canonical_name.lower().split(), alias}
            scored.append((-round(min(1.0, len(q & t) / len(q | t) + 0.1 * (kind == row_kind)), 6), key))
        want |= {(name, kind, key, rank, -f) for rank, (f, key) in enumerate(sorted(scored)[:4], 1)}
    assert {(r["normalized_mention_text"], r["entity_type"], r["canonical_entity_key"], r["rank"], r["fused_score"]) for r in got.collect()} == want
    assert not asked_mentions(spark, sf_dir).storageLevel.useMemory


def test_the_graph_is_kept_without_properties(spark, sf_dir):
    from lodestone.queries import catalogue

    whole, slim = catalogue.full_graph(spark, sf_dir), catalogue.slim_graph(spark, sf_dir)
    assert not any(x.storageLevel.useMemory for x in (whole.nodes, whole.edges)) and all(x.storageLevel.useMemory for x in (slim.nodes, slim.edges))
    assert "properties" not in slim.nodes.columns + slim.edges.columns and slim.nodes.count() == whole.nodes.count()
    spark.catalog.clearCache()


def test_tokens_meet_their_neighbours_without_a_shuffle(spark):
    t = spans.token_rows(chunk_df(spark, "A b. C", "x"), "chunk_id", "chunk_text")
    assert "Window" not in t._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in t.orderBy("chunk_id", "position").select("token", "previous", "following").collect()] == [("A", "<START>", "b"), ("b", "a", "."), (".", "b", "c"), ("C", ".", "<END>"), ("x", "<START>", "<END>")]


def test_chunks_are_made_of_few_documents_at_a_time(spark):
    assert chunks.SLICE <= 64
    v = spark.createDataFrame([("s", f"d{i}", "c", f"Text {i}. More.") for i in range(300)], "source_id string, source_document_id string, checksum string, normalized_text string").coalesce(1)
    assert sorted(r["source_document_id"] for r in chunks.chunked(v).collect()) == sorted(f"d{i}" for i in range(300))


# Acquisition and sources


def test_versions_and_runs(spark):
    met = spark.createDataFrame([("s", "http://x.org/a", b"1", "text one", None, None, "r"), ("s", "http://x.org/b", b"2", " ", None, None, "r"), ("s", "http://x.org/c", b"3", "x", None, "timeout", "r"), ("s", "http://x.org/d", b"4", "text", None, None, "r")], "source_id string, source_url string, content binary, extracted_text string, published_at string, error string, run_id string")
    stored = spark.createDataFrame([("s", "http://x.org/d", "old", "1"), ("s", "http://x.org/a", None, "1")], "source_id string, source_document_id string, checksum string, created_at string").withColumn("checksum", F.when(F.col("source_document_id") == "http://x.org/a", F.sha2(F.lit("1"), 256)).otherwise("old"))
    out = acquisition.outcomes(met, stored)
    assert {r["source_url"][-1]: r["status"] for r in out.collect()} == {"a": "unchanged", "b": "failed", "c": "failed", "d": "ingested"}
    assert acquisition.new_versions(out, "now").count() == 1
    r = acquisition.run_report(out).first()
    assert (r["processed_urls"], r["ingested_documents"], r["failed_documents"], r["run_status"]) == (4, 1, 2, "completed_with_failures")


def test_outcomes_of_odd_rows(spark):
    """Null sources meet, each version of the newest time counts as stored, and a blank text may count as short."""
    met = spark.createDataFrame([(None, "http://x.org/a", b"1", "text"), ("s", "http://x.org/b", b"2", "text"), ("s", "http://x.org/b", b"3", "text"), ("s", "http://x.org/c", b"4", " "), ("s", "http://x.org/d", None, None)], "source_id string, source_url string, content binary, extracted_text string").withColumn("error", F.lit(None).cast("string"))
    stored = spark.createDataFrame([(None, "http://x.org/a", b"1", "1"), ("s", "http://x.org/b", b"2", "1"), ("s", "http://x.org/b", b"3", "1"), ("s", "http://x.org/b", b"0", "0"), ("s", "http://x.org/d", None, "1")], "source_id string, source_document_id string, content binary, created_at string").select("source_id", "source_document_id", F.sha2("content", 256).alias("checksum"), "created_at")
    out = acquisition.outcomes(met, stored, 2, blank="skipped").select("source_url", "status").collect()
    assert sorted((r[0][-1], r[1]) for r in out) == [("a", "unchanged"), ("b", "unchanged"), ("b", "unchanged"), ("c", "skipped"), ("d", "unchanged")]


def test_keep_latest(spark):
    e = spark.createDataFrame([("u", "2024-01-01", 0), ("u", "2024-01-01T10:00:00+12:00", 1), ("u", "bad", 2), ("v", None, 3)], "source_url string, published_at string, position int")
    assert sorted(map(tuple, acquisition.keep_latest(e).select("source_url", "published_at").collect()), key=str) == [("u", "2024-01-01"), ("v", None)]
    assert acquisition.limited(e, -1).count() == 0
    with pytest.raises(ValueError, match="greater"):
        acquisition.cutoff_of(0)


def test_sitemaps(spark):
    xml = '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>http://x.org/a?b=1&amp;c=2</loc><lastmod>2024-01-02</lastmod></url><url><loc>http://x.org/b</loc><lastmod>soon</lastmod></url></urlset>'
    index = "<sitemapindex><sitemap><loc>http://x.org/s1.xml</loc></sitemap><sitemap><loc>http://x.org/other.xml</loc></sitemap></sitemapindex>"
    df = spark.createDataFrame([(xml,), (index,)], "xml string")
    assert [r[0] for r in df.select(web.is_sitemap_index(F.col("xml"))).collect()] == [False, True]
    e = web.sitemap_entries(df)
    assert sorted(map(tuple, e.select("source_url", "published_at").collect())) == [("http://x.org/a?b=1&c=2", "2024-01-02"), ("http://x.org/b", None)]
    assert [r["loc"] for r in web.child_sitemaps(df, pattern="s1").collect()] == ["http://x.org/s1.xml"]
    assert web.merged_sitemap(e).first()["xml"].count("<url>") == 2


def test_article_and_pdf_links(spark):
    page = '<html><body><p>out</p><main><h1>T</h1><p>a  b</p><nav>menu</nav><p>Acknowledgements</p><p>thanks</p></main><a href="x/appendix.pdf">Appendix</a><a href="/r.PDF">The <b>Full Report</b></a><a href="y.html">y</a></body></html>'
    df = spark.createDataFrame([("http://x.org/d/", page)], "url string, html string")
    r = df.select(web.article_text(F.col("html")).alias("t"), web.pdf_links(F.col("url"), F.col("html")).alias("p")).first()
    assert r["t"] == "T\na b" and r["p"] == ["http://x.org/r.PDF", "http://x.org/d/x/appendix.pdf"]


def test_references_of_an_article(spark):
    df = spark.createDataFrame([("<article><h1>A &amp;&amp</h1><p>1 &lt; 2 &#x27;q&#39; &amp;lt;</p></article>",)], "html string")
    assert df.select(web.article_text(F.col("html"))).first()[0] == "A &&amp\n1 < 2 'q' &lt;"


def test_jsonl(spark, tmp_path):
    p = tmp_path / "rows"
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    assert jsonl.append_new(rows, str(p), ["k"]) == 2
    assert jsonl.append_new(rows.unionByName(spark.createDataFrame([("c", 3), ("c", 3)], "k string, n int")), str(p), ["k"]) == 1
    (p / "more.json").write_text('\n{"k": "d", "n": 4}\n{oops\n')
    assert sorted(r["k"] for r in jsonl.read(spark, str(p), "k string, n int").collect()) == ["a", "b", "c", "d"]
    assert jsonl.lines(spark, str(p / "more.json")).orderBy("line_number").collect()[1]["line"] == '{"k": "d", "n": 4}'
    with pytest.raises(Exception, match="FAILFAST|MALFORMED|malformed"):
        jsonl.read_strict(spark, str(p), "k string, n int").collect()


def test_published_runs(spark, tmp_path):
    for name in ("r1", "r2", "r3"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f").write_text(name)
    assert files.publish(spark, f"file://{tmp_path}", "r3", 2) == ["r3", "r2"]
    assert (tmp_path / "latest" / "f").read_text() == "r3" and not (tmp_path / "r1").exists()


# Streams and plans


def test_streamed_claims_equal_batch(spark, tmp_path):
    c = chunk_df(spark, "Leaders must act.", "Nothing.", "Costs must fall.")
    c.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = stages.claim_stream(spark.readStream.schema(c.schema).parquet(str(tmp_path / "in")))
    for _ in range(2):
        stages.append_new_batches(stream, str(tmp_path / "out"), ["claim_id"], str(tmp_path / "check")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["claim_id"] for r in got.collect()) == sorted(r["claim_id"] for r in claims.rule_claims(c).collect())


def test_topics(spark):
    seen = []
    t = stages.Topics()
    t.subscribe("claims", lambda df: seen.append(df.count()))
    t.publish(spark.createDataFrame([("claims", 1), ("entities", 2)], "topic string, n int"))
    assert seen == [1]
    with pytest.raises(ValueError, match="topic"):
        t.publish(spark.createDataFrame([(None, 1)], "topic string, n int"))


def test_evidence_plan_and_partitions(spark, seed):
    body = "The Clean Energy Act must reduce cost. Dr Ann Lee argues it."
    v = version(spark, body)
    out = []
    for n in ("2", "5"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        e = evidence(v, seed)
        out.append(sorted(r["id"] for r in e.graph.edges.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1] and len(out[0]) == 2


def test_hot_paths_stay_in_the_jvm(spark):
    plan = claims.rule_claims(chunk_df(spark, "x"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert ids.claim_id is not None


def test_catalog_metadata(spark, seed):
    m = {r["key"]: r["value"] for r in catalog.metadata(seed, "v1").collect()}
    again = {r["key"]: r["value"] for r in catalog.metadata(seed.orderBy("canonical_name").repartition(3), "v1").collect()}
    assert m == again and m["row_count"] == "3" and len(m["seed_hash"]) == 64
    assert catalog.seed_hash(seed.limit(2)).first()[0] != m["seed_hash"]


def test_command_line(spark, tmp_path, capsys):
    from lodestone import cli
    from lodestone.sources import artifacts

    v = version(spark, "The Clean Energy Act must reduce cost. Dr Ann Lee argues it.")
    full = v.selectExpr("source_id", "source_document_id", "'u' AS source_url", "checksum", "normalized_text")
    full.write.json(str(tmp_path / "v"))
    at = lambda name: str(tmp_path / name)
    for _ in range(2):
        assert cli.main(["chunk", "--in", at("v"), "--out", at("c")], spark) == 0
        assert cli.main(["claims", "--in", at("c"), "--out", at("l")], spark) == 0
        assert cli.main(["entities", "--in", at("c"), "--out", at("e")], spark) == 0
    assert capsys.readouterr().out.splitlines() == ["1 chunks added", "1 claims added", "2 mentions added", "0 chunks added", "0 claims added", "0 mentions added"]
    code = cli.main(["graph", "--chunks", at("c"), "--claims", at("l"), "--entities", at("e"), "--out", at("g"), "--max-anomalies", "99"], spark)
    assert code == 0
    g = graph.Graph(spark.read.parquet(at("g/filtered/nodes")), spark.read.parquet(at("g/filtered/edges")))
    doc = artifacts.artifact(g, "now")
    assert [n["type"] for n in doc["nodes"]].count("Claim") == 1 and doc["schema_version"] == "1.0.0"
    artifacts.save(doc, at("graph.json"))
    page = artifacts.viewer(doc)
    assert "Clean Energy Act" in page and page.startswith("<!doctype html>")
    with pytest.raises(ValueError, match="more than 1"):
        artifacts.artifact(g, "now", most=1)


def pdf_file(pages, packed):
    """A small PDF of those pages' content streams; packed: streams compressed, pages in an object stream."""
    import zlib

    def stream(data, more=b""):
        body = zlib.compress(data) if packed else data
        return b"<< /Length %d%s%s >>\nstream\n%s\nendstream" % (len(body), b" /Filter /FlateDecode" if packed else b"", more, body)

    kids = b" ".join(b"%d 0 R" % (20 - i) for i in range(len(pages)))  # pages stand in the file in another order
    dicts = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [%s] /Count %d >>" % (kids, len(pages))}
    dicts |= {20 - i: b"<< /Type /Page /Parent 2 0 R /Contents %s >>" % (b"[%d 0 R]" % (40 + i) if i else b"40 0 R") for i in range(len(pages))}
    objects = {40 + i: stream(p) for i, p in enumerate(pages)}
    if packed:
        order = sorted(dicts)
        places, data = [], b""
        for n in order:
            places.append(b"%d %d" % (n, len(data)))
            data += dicts[n] + b"\n"
        head = b" ".join(places) + b"\n"
        objects[60] = stream(head + data, b" /Type /ObjStm /N %d /First %d" % (len(order), len(head)))
    else:
        objects |= dicts
    return b"%PDF-1.5\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (n, objects[n]) for n in sorted(objects)) + b"%%EOF"


@pytest.mark.parametrize("packed", [False, True])
def test_pdf_text(spark, packed):
    one = b"BT /F1 12 Tf 72 700 Td (Annual \\(draft\\) report) Tj 0 -14 Td [(Emis) 20 (sions) -300 (fell)] TJ T* <48656C6C6F> Tj ET"
    two = b"q BT (Caf\\351) Tj ET Q (not shown) pop BT <FEFF00E900E8> Tj ET"
    df = spark.createDataFrame([(pdf_file([one, b"", two], packed),), (None,), (b"no pdf",)], "content binary")
    assert [r[0] for r in df.select(files.pdf_text("content")).collect()] == ["Annual (draft) report\nEmissions fell\nHello\nCaf\u00e9\n\u00e9\u00e8", None, ""]


def test_sqlite_catalog(spark, tmp_path):
    import sqlite3

    with sqlite3.connect(tmp_path / "catalog.db") as db:
        db.execute("CREATE TABLE entity_catalog (canonical_entity_key TEXT, canonical_name TEXT, entity_type TEXT, aliases_json TEXT, source TEXT)")
        db.executemany("INSERT INTO entity_catalog VALUES (?, ?, ?, ?, 'seed')", [("k1", "Green Council", "ORG", '["GC"]'), ("k2", "Clean Act", "POLICY", "[]")])
    got = sorted(map(tuple, files.sqlite_catalog(spark, str(tmp_path / "catalog.db")).collect()))
    assert got == [("k1", "Green Council", "ORG", ["GC"]), ("k2", "Clean Act", "POLICY", [])]


def test_strict_reader_names_the_line(spark, tmp_path):
    p = tmp_path / "rows.json"
    p.write_text('{"k": "a"}\n\n{"k": " "}\n')
    with pytest.raises(Exception, match="Row 3 has invalid k"):
        jsonl.read_strict(spark, str(p), "k string", ("k",)).collect()
    p.write_text('{"k": "a"}\n[1]\n')
    with pytest.raises(Exception, match="Chunk row 2 is malformed"):
        jsonl.read_strict(spark, str(p), "k string", what="Chunk row").collect()


def test_required_inputs(spark, tmp_path):
    with pytest.raises(ValueError, match="claims input path does not exist"):
        files.require_file(spark, str(tmp_path / "none"), "claims")
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="claims input path is not a file"):
        files.require_file(spark, str(tmp_path / "empty"), "claims")
    (tmp_path / "one").write_text("{}")
    files.require_file(spark, str(tmp_path / "one"), "claims")


def test_artifacts_are_stored_once(spark, tmp_path):
    rows = spark.createDataFrame([(b"a",), (b"b",), (b"a",)], "content binary")
    for _ in range(2):
        files.store_artifacts(rows, str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2


def test_starts_of_many_pieces(spark):
    words = [f"w{i}. " for i in range(700)]
    df = spark.createDataFrame([("".join(words),), ("",), (None,), ("a. b",)], "t string")
    got = [r[0] for r in df.select(text.sentences(F.col("t"))).collect()]
    at, want = 0, []
    for w in words:
        want.append((w.strip(), at, at + len(w) - 1))
        at += len(w)
    assert [tuple(x) for x in got[0]] == want and got[1] == got[2] == [] and [tuple(x) for x in got[3]] == [("a.", 0, 2), ("b", 3, 4)]


def test_classifiers_of_constant_labels(spark):
    chunks = spark.createDataFrame([("c1", "s", "d", "x", "We must act now"), ("c2", "s", "d", "x", "Nothing here")], "chunk_id string, source_id string, source_document_id string, document_checksum string, chunk_text string")
    none = spark.createDataFrame([], "chunk_id string, start_char int, end_char int")
    assert ml.token_claims(chunks, ml.trained(chunks, none)).collect() == []


def test_fallback_rules_of_a_recogniser(spark):
    chunks = spark.createDataFrame([("c1", "s", "d", "x", "The Green Act and Perth"), ("c2", "s", "d", "x", "The Blue Council sat")], "chunk_id string, source_id string, source_document_id string, document_checksum string, chunk_text string")
    spans = spark.createDataFrame([("c1", 18, 23, "GPE"), ("c2", 0, 3, "DATE")], "chunk_id string, start_char int, end_char int, label string")
    got = {(r["chunk_id"], r["mention_text"], r["entity_type"]) for r in entities.recognised_mentions(chunks, spans, fallback=True).collect()}
    assert got == {("c1", "Perth", "JURISDICTION"), ("c2", "Blue Council", "ORG")}
    assert entities.recognised_mentions(chunks, spans).count() == 1


def test_extension_points():
    from lodestone import ports

    assert ports.CHUNKERS["windows"] and isinstance(ports.CLAIM_EXTRACTORS["rules"], ports.ClaimExtractor)
    with pytest.raises(ValueError, match="already"):
        ports.SOURCES.add("sitemap", len)
    with pytest.raises(ValueError, match="unknown judge"):
        ports.JUDGES["none"]


BESIDE = ("The Green Act must reduce costs by 3 million. Dr Ada Stone of the Reef Institute argues that Victoria needs the Green Plan.", "Prices rose by $5. The Blue Council and the Blue Council must act!", "Nothing here", "", "The Green Act must reduce costs by 3 million. Dr Ada Stone of the Reef Institute argues that Victoria needs the Green Plan.")


def rows_of(df):
    return sorted(map(str, df.collect()))


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_links_beside_equal_joined_ones(spark):
    c = chunk_df(spark, *BESIDE)
    status = lambda t: F.when(t == "POLICY", "needs_review").otherwise("linked")
    m = entities.rule_mentions(c)
    cl, ce = claims.rule_claims(c), canonical.canonical_entities(m).withColumn("decision_status", status(F.col("entity_type")))
    rows = canonical.beside(c, lambda x: status(x["entity_type"]))
    links = claims.each(canonical.claims_beside(rows), F.col("links"), "claim_id", name="x").select("claim_id", "x.entity_id", "x.canonical_entity_key", "x.decision_status", "x.link_method")
    want = canonical.claim_links(cl, ce).select("claim_id", "entity_id", "canonical_entity_key", "decision_status", "link_method")
    assert rows_of(links) == rows_of(want) and want.count() >= 4 and exchanges(links) == 0
    assert rows_of(graph.counts_beside(rows)) == rows_of(graph.evidence_counts(canonical.canonical_claims(cl, ce), ce))


def test_rows_beside_equal_joined_ones(spark):
    c = chunk_df(spark, *BESIDE)
    m, cl = entities.rule_mentions(c), claims.rule_claims(c)
    found = entities.rule_spans()(F.col("chunk_text"))
    assert rows_of(entities.type_counts_beside(c, found)) == rows_of(entities.type_counts(m, c)) and exchanges(entities.type_counts_beside(c, found)) == 0
    got, want = datasets.silver_entities_beside(c, found), datasets.silver_entity_rows(c, m)
    assert rows_of(got) == rows_of(want.select(*got.columns)) and exchanges(got) == 0
    stored = claims.rule_claims(c.where("chunk_index = 0"))
    assert rows_of(claims.report_beside(c, claims.rule_spans()(F.col("chunk_text")), stored)) == rows_of(claims.report(c, cl, stored))
    tags = claims.each(c, entities.gold_tags(("POLICY", "ORG"))(F.col("chunk_text")), "chunk_id").select("chunk_id", "s.start_char", "s.end_char", "s.tag")
    spans_ = m.where("entity_type IN ('POLICY', 'ORG')").select("chunk_id", "start_char", "end_char")
    joined = spans.bio_tags(spans.token_rows(c, "chunk_id", "chunk_text"), spans_, "chunk_id").where("tag <> 'O'").select("chunk_id", "start_char", "end_char", "tag")
    assert rows_of(tags) == rows_of(joined) and joined.count() > 8 and exchanges(tags) == 0


def test_ensemble_without_shuffle_equals_merged_channels(spark):
    c = chunk_df(spark, *BESIDE)
    rules = entities.EntityRules(version="e-rule")
    want = entities.merged_mentions({"gazetteer": entities.gazetteer_mentions(c, "e-gazetteer"), "rule": entities.rule_mentions(c, rules)}, "e")
    got = entities.ensemble_mentions(c, version="e")
    assert rows_of(got) == rows_of(want) and want.count() > 8 and exchanges(got) == 0


def test_sentences_are_looked_at_once(spark):
    plan = entities.rule_mentions(chunk_df(spark, *BESIDE))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_languages_without_sentences_have_no_row(spark, tmp_path):
    from lodestone.queries.catalogue import QUERIES

    rows = spark.createDataFrame([(1, "One. Two", "en"), (2, " ", "de"), (3, None, "fr")], "doc_id long, text string, lang string")
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    assert [tuple(r) for r in QUERIES["sentence_counts_by_lang"](spark, str(tmp_path)).collect()] == [("en", 2)]
