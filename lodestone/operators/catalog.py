"""The entity catalog: import, retrieval of candidates, decisions, and the review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, text


def clean_aliases(aliases: Column) -> Column:
    """White space collapsed, blanks dropped, the first of those equal in lower case kept."""
    n = F.filter(F.transform(aliases, text.normalized), lambda a: a.isNotNull() & (a != ""))
    lows = F.transform(n, F.lower)
    return F.filter(n, lambda a, i: F.array_position(lows, F.lower(a)) == i + 1)


def checked_seed(seed: DataFrame) -> DataFrame:
    """Seed rows with their aliases cleaned and types in upper case; rows without key, name or type raise where they are read."""
    for c in ("canonical_entity_key", "canonical_name", "entity_type"):
        seed = seed.withColumn(c, F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.raise_error(F.lit(f"catalog row without {c}"))).otherwise(F.trim(c)))
    return seed.select("canonical_entity_key", "canonical_name", F.upper("entity_type").alias("entity_type"), F.coalesce(clean_aliases(F.col("aliases")), F.array().cast("array<string>")).alias("aliases"))


def imported(seed: DataFrame, stored: DataFrame) -> DataFrame:
    """Seed rows whose key isn't stored; of equal keys the one of the smallest name."""
    one = Window.partitionBy("canonical_entity_key").orderBy("canonical_name", "entity_type")
    fresh = checked_seed(seed).withColumn("_n", F.row_number().over(one)).where("_n = 1").drop("_n")
    return fresh.join(stored.select("canonical_entity_key"), "canonical_entity_key", "left_anti")


def import_report(seed: DataFrame, stored: DataFrame, version: str) -> DataFrame:
    """One row: catalog_version, seed_hash, processed_records, inserted_records, vectors_written of an import of seed; vectors are made anew for every seed row."""
    rows = checked_seed(seed)
    n = rows.agg(F.count("*").alias("processed_records")).withColumn("vectors_written", F.col("processed_records"))
    new = imported(seed, stored).agg(F.count("*").alias("inserted_records"))
    digest = seed_hash(rows)
    one = lambda df: df.withColumn("_k", F.lit(1))
    return one(n).join(one(new), "_k").join(one(digest), "_k").select(F.lit(version).alias("catalog_version"), "seed_hash", "processed_records", "inserted_records", "vectors_written")


def catalog_vectors(catalog: DataFrame) -> DataFrame:
    """The sidecar: each row's whitespace tokens of name and aliases."""
    words = F.concat_ws(" ", F.col("canonical_name"), F.col("aliases"))
    return catalog.select("canonical_entity_key", "entity_type", text.vector_tokens(words).alias("tokens"))


def rounded(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits)


ANSWERS = 20_000  # distinct answers up to which they are sent to every task


def small(rows: DataFrame) -> DataFrame:
    """Rows kept once, and broadcast by what joins them if they are few."""
    kept = rows.persist()
    return F.broadcast(kept) if kept.limit(ANSWERS + 1).count() <= ANSWERS else kept


ASKED = ["normalized_mention_text", "entity_type"]


def retrieved(mentions: DataFrame, catalog: DataFrame, k: int = 5, vectors: DataFrame | None = None, lexical_weight: float = 0.6, vector_weight: float = 0.4, bonus: float = 0.1) -> DataFrame:
    """For each mention (entity_id, normalized_mention_text, entity_type) its k best catalog rows with fused, lexical and vector scores and rank."""
    top = best_rows(mentions.select(*ASKED).distinct(), catalog, k, vectors, lexical_weight, vector_weight, bonus)
    return mentions.select("entity_id", *ASKED).join(small(top), ASKED).drop(*ASKED)


def best_rows(asked: DataFrame, catalog: DataFrame, k: int = 5, vectors: DataFrame | None = None, lexical_weight: float = 0.6, vector_weight: float = 0.4, bonus: float = 0.1) -> DataFrame:
    """For each row of asked (normalized_mention_text and entity_type, distinct) its k best catalog rows.

    Every catalog row has a score, if only its type's bonus, but few share a token with a mention. Tokens are joined by
    hash and counted; what shares none ties, so for each type the first k keys stand for the rest. Rows of equal
    tokens and type have one score, so they meet the mentions as one class with its k smallest keys.
    """
    if k <= 0:
        raise ValueError("top_k must be positive")
    lexical = text.catalog_tokens(F.concat_ws(" ", F.col("canonical_name"), F.col("aliases")))
    rows = catalog.select("canonical_entity_key", "canonical_name", F.col("entity_type").alias("row_type"), lexical.alias("row_tokens"))
    if vectors is not None:
        rows = rows.join(vectors.select("canonical_entity_key", F.array_distinct("tokens").alias("vec")), "canonical_entity_key", "left").withColumn("vec", F.coalesce("vec", "row_tokens"))
    else:
        rows = rows.withColumn("vec", F.col("row_tokens"))
    alike = ["row_tokens", "vec", "row_type"]
    member = F.struct("canonical_entity_key", "canonical_name")
    # k keys of a class at a time: rows are dealt into parts first, so that no list holds a whole class
    part = rows.withColumn("_p", F.spark_partition_id())
    place = F.row_number().over(Window.partitionBy(*alike, "_p").orderBy("canonical_entity_key"))
    few = part.withColumn("_n", place).where(F.col("_n") <= k)
    first_k = few.groupBy(*alike).agg(F.slice(F.array_sort(F.collect_list(member)), 1, k).alias("members"))
    classes = first_k.withColumn("key", F.get("members", F.lit(0))["canonical_entity_key"]).persist()
    asked = asked.select(F.col("normalized_mention_text").alias("asked"), F.col("entity_type").alias("asked_type")).withColumn("asked_tokens", text.catalog_tokens(F.col("asked"))).withColumn("n", F.size("asked_tokens")).persist()
    # a posting says in which of the two lists its token is, so that one count gives both intersections
    token = F.explode(F.transform(F.array_union("row_tokens", "vec"), lambda t: F.struct(t.alias("token"), F.array_contains("row_tokens", t).cast("int").alias("lex"), F.array_contains("vec", t).cast("int").alias("vec")))).alias("t")
    postings = classes.select("key", token).select("key", "t.*")
    keys = ["asked", "asked_type", "n", "key"]
    hits = asked.select("asked", "asked_type", "n", F.explode("asked_tokens").alias("token")).join(postings, "token").select(*keys, "lex", "vec")
    first = Window.partitionBy("row_type").orderBy("key")
    tail = classes.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= 2 * k).select("key", "row_type")
    heads = tail.groupBy().agg(F.array_sort(F.collect_list("key")).alias("keys"))  # 2k classes a type
    rest = asked.select("asked", "asked_type", "n").join(F.broadcast(heads), F.lit(True)).select("asked", "asked_type", "n", F.explode("keys").alias("key"), F.lit(0).alias("lex"), F.lit(0).alias("vec"))
    shared = hits.unionByName(rest).groupBy(*keys).agg(F.sum("lex").alias("lex"), F.sum("vec").alias("vec"))
    sizes = classes.select("key", "row_type", F.size("row_tokens").alias("n_lex"), F.size("vec").alias("n_vec"))
    share = lambda both, m: F.when((F.col("n") == 0) | (F.col(m) == 0), 0.0).otherwise(F.col(both) / (F.col("n") + F.col(m) - F.col(both)))
    scored = shared.join(sizes, "key").withColumn("vecs", share("vec", "n_vec")).withColumn("lex", share("lex", "n_lex"))
    fused = F.least(F.lit(1.0), lexical_weight * F.col("lex") + vector_weight * F.col("vecs") + F.when(F.col("row_type") == F.col("asked_type"), bonus).otherwise(0.0))
    scored = scored.select("asked", "asked_type", "key", F.col("row_type").alias("candidate_type"), rounded(fused).alias("fused_score"), rounded(F.col("lex")).alias("lexical_score"), rounded(F.col("vecs")).alias("vector_score"))
    best = lambda key: Window.partitionBy("asked", "asked_type").orderBy(F.desc("fused_score"), F.desc("lexical_score"), F.desc("vector_score"), key)
    # the k best rows are among the k best classes, which begin with their smallest keys
    some = scored.withColumn("rank", F.row_number().over(best("key"))).where(F.col("rank") <= k)
    each = some.join(classes.select("key", "members"), "key").select("*", F.explode("members").alias("m")).select(*(c for c in scored.columns if c != "key"), "m.*")
    top = each.withColumn("rank", F.row_number().over(best("canonical_entity_key"))).where(F.col("rank") <= k)
    return top.select(F.col("asked").alias("normalized_mention_text"), F.col("asked_type").alias("entity_type"), "canonical_entity_key", "canonical_name", "candidate_type", "fused_score", "lexical_score", "vector_score", "rank")


def judged(mentions: DataFrame, candidates: DataFrame, linked: float = 0.85, review: float = 0.60) -> DataFrame:
    """entity_id, decision_status, decision_score, reason_codes, selected_candidate_key, top_candidates of each mention."""
    c = F.struct("rank", "canonical_entity_key", "canonical_name", F.col("candidate_type").alias("entity_type"), "fused_score", "lexical_score", "vector_score")
    top = candidates.where("rank <= 3").groupBy("entity_id").agg(F.array_sort(F.collect_list(c)).alias("top"))
    m = mentions.select("entity_id", "normalized_mention_text", "entity_type", "confidence").join(top, "entity_id", "left").withColumn("first", F.get("top", F.lit(0))).withColumn("second", F.get("top", F.lit(1)))
    margin = F.col("first.fused_score") - F.col("second.fused_score")
    same, exact = F.col("first.entity_type") == F.col("entity_type"), F.lower("first.canonical_name") == F.lower("normalized_mention_text")
    alone = F.col("second").isNull()
    score = F.col("first.fused_score") + F.when(same, 0.05).otherwise(-0.10)
    score = F.when(exact, score + 0.05).otherwise(score)
    score = F.when(alone | (margin >= 0.15), score + 0.05).when(margin < 0.05, score - 0.05).otherwise(score)
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), rounded(score)))
    none = F.col("first").isNull()
    n = F.trim("normalized_mention_text")
    new = (F.length(n) >= 4) & n.rlike(r"\p{L}") & (F.col("confidence") >= 0.5)
    status = F.when(none, "abstain").when(F.col("score") >= linked, "linked").when(F.col("score") >= review, "needs_review").when(new, "new_candidate").otherwise("abstain")
    codes = F.filter(
        F.array(
            F.when(none, "no_candidates").otherwise("base_fused_score"), F.when(none, None).when(same, "entity_type_match").otherwise("entity_type_mismatch"), F.when(~none & exact, "exact_name_match"),
            F.when(none, None).when(alone, "single_candidate").when(margin >= 0.15, "clear_margin").when(margin < 0.05, "ambiguous_margin"),
            F.when(none, None).when(status == "linked", "threshold_linked").when(status == "needs_review", "threshold_review").when(status == "new_candidate", "threshold_new_candidate").otherwise("threshold_abstain"),
        ),
        lambda x: x.isNotNull(),
    )
    evidence = F.transform(F.coalesce("top", F.array().cast(top.schema["top"].dataType)), lambda t: F.struct(*(t[x].alias(x) for x in ("canonical_entity_key", "canonical_name", "entity_type", "fused_score", "lexical_score", "vector_score"))))
    key = F.when(status.isin("linked", "needs_review"), F.col("first.canonical_entity_key"))
    return m.withColumn("score", F.when(none, 0.0).otherwise(score)).select("entity_id", status.alias("decision_status"), F.col("score").alias("decision_score"), codes.alias("reason_codes"), key.alias("selected_candidate_key"), evidence.alias("top_candidates"))


def resolved(mentions: DataFrame, catalog: DataFrame, k: int = 5, vectors: DataFrame | None = None, linked: float = 0.85, review: float = 0.60) -> DataFrame:
    """The mentions with their decisions in the metadata; the catalog's key is taken over only where the decision is to link."""
    fields = ("decision_status", "decision_score", "reason_codes", "selected_candidate_key", "top_candidates")
    keys = [*ASKED, "confidence"]  # a decision depends on these alone
    one = mentions.select(*keys).distinct().withColumn("entity_id", F.to_json(F.struct(*keys))).persist()
    d = judged(one, retrieved(one, catalog, k, vectors), linked, review)
    decided = one.join(d, "entity_id").select(*(F.col(c).alias(f"_{c}") for c in keys), *fields)
    joined = mentions.join(small(decided), F.col("normalized_mention_text").eqNullSafe(F.col("_normalized_mention_text")) & F.col("entity_type").eqNullSafe(F.col("_entity_type")) & F.col("confidence").eqNullSafe(F.col("_confidence")))
    meta = F.struct(*(F.col(f"metadata.{f}").alias(f) for f in ("channel", "spacy_label", "coref_canonical")), *(F.col(f) for f in fields))
    key = F.when(F.col("decision_status") == "linked", F.col("selected_candidate_key")).otherwise(F.col("canonical_entity_key"))
    return joined.withColumn("metadata", meta).withColumn("canonical_entity_key", key).select(*mentions.columns)


UNRESOLVED = ("needs_review", "new_candidate", "abstain")


def queued(resolved_mentions: DataFrame) -> DataFrame:
    """The mentions that a reviewer should see, as review items."""
    m = resolved_mentions.where(F.col("metadata.decision_status").isin(*UNRESOLVED))
    return m.select(F.col("entity_id").alias("mention_entity_id"), "chunk_id", "mention_text", "entity_type", F.col("metadata.decision_status").alias("decision_status"), F.col("metadata.decision_score").alias("decision_score"), F.col("metadata.selected_candidate_key").alias("selected_candidate_key"))


DECISION = ("decision_status", "decision_score", "selected_candidate_key")


def upserted(items: DataFrame, stored: DataFrame, now: str) -> DataFrame:
    """Review items after an upsert by mention: new decisions set the state to pending and keep created_at; others stay. Of several new decisions on a mention the one of the largest score counts, then by status and key."""
    new = items.withColumn("review_state", F.lit("pending")).withColumn("created_at", F.lit(now)).withColumn("updated_at", F.lit(now))
    both = new.select("*", F.lit(1).alias("_new")).unionByName(stored.select("*", F.lit(0).alias("_new")))
    w = Window.partitionBy("mention_entity_id")
    last = w.orderBy(F.desc("_new"), F.desc("decision_score"), "decision_status", "selected_candidate_key")
    kept = both.withColumn("created_at", F.min("created_at").over(w)).withColumn("_n", F.row_number().over(last))
    return kept.where("_n = 1").drop("_n", "_new")


def review_list(stored: DataFrame) -> DataFrame:
    """The state of the queue, by mention."""
    return stored.select("mention_entity_id", "decision_status", "decision_score", "review_state").orderBy("mention_entity_id")


def resolved_and_queued(mentions: DataFrame, catalog: DataFrame, stored_items: DataFrame, stored_events: DataFrame, now: str, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A resolution run: the resolved mentions, the queue after it, and the events that its log lacks."""
    done = resolved(mentions, catalog, **options)
    items = queued(done)
    return done, upserted(items, stored_items, now), review_events(items, stored_events)


def event_hash(*fields: Column) -> Column:
    return ids.full_hash(*fields)


def review_events(items: DataFrame, stored: DataFrame) -> DataFrame:
    """One event for each decision that the log doesn't hold yet."""
    e = items.select("mention_entity_id", *DECISION, event_hash(F.col("mention_entity_id"), *(F.col(c) for c in DECISION)).alias("event_hash")).dropDuplicates(["event_hash"])
    return e.join(stored.select("event_hash"), "event_hash", "left_anti").select("event_hash", "mention_entity_id", *DECISION)


def seed_hash(catalog: DataFrame) -> DataFrame:
    """One row: the digest of the catalog's rows as JSON, sorted by key. Rows are digested where they are; only digests meet."""
    row = F.sha2(F.to_json(F.struct("canonical_entity_key", "canonical_name", "entity_type", "aliases"), {"ignoreNullFields": "false"}), 256)
    parts = catalog.select("canonical_entity_key", row.alias("h")).groupBy(F.substring(F.sha2("canonical_entity_key", 256), 1, 3).alias("b"))
    buckets = parts.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("canonical_entity_key", "h"))), lambda x: x["h"]), ""), 256).alias("h"))
    return buckets.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: x["h"]), ""), 256).alias("seed_hash"))


def metadata(catalog: DataFrame, version: str) -> DataFrame:
    """key, value: catalog_version, seed_hash, row_count."""
    n = catalog.agg(F.count("*").cast("string").alias("row_count"))
    both = seed_hash(catalog).withColumn("k", F.lit(1)).join(n.withColumn("k", F.lit(1)), "k").withColumn("catalog_version", F.lit(version))
    return both.select(F.explode(F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in ("catalog_version", "seed_hash", "row_count")))).alias("x")).select("x.key", "x.value")
