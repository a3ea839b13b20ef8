"""Gold questions: relevance from spans, chunkability, dataset rules and lints, signals of answers and validity of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.governance import codes, violations
from quarry.operators.lint import exactly_one


def span_qrels(gold: DataFrame, chunks: DataFrame) -> DataFrame:
    """(qid, group_id, doc_id, chunk_index, grade, required): every chunk that overlaps an annotated span.

    ``gold``: qid, n (place in the question), doc_id, start, end, grade, required, evidence_group (null: a group of its own).
    ``chunks``: doc_id, chunk_index, start, end, half-open offsets. A span that meets no chunk stays, with a null chunk_index, so a required group that nothing can
    satisfy keeps its place in the denominator. Chunks of one group get the greatest grade.
    """
    g = gold.withColumn("group_id", F.coalesce("evidence_group", F.concat(F.lit("span:"), F.col("n").cast("string"))))
    c = chunks.select(F.col("doc_id").alias("__doc"), "chunk_index", F.col("start").alias("__a"), F.col("end").alias("__z"))
    met = g.join(c, (F.col("doc_id") == F.col("__doc")) & (F.col("__a") < F.col("end")) & (F.col("__z") > F.col("start")), "left")
    return met.groupBy("qid", "group_id", "doc_id", "chunk_index").agg(F.max("grade").alias("grade"), F.bool_or("required").alias("required"))


def relevance_failures(qrels: DataFrame) -> DataFrame:
    """(qid, reason) of the questions that cannot be scored: without a required group, or with one that has no chunk."""
    g = qrels.where("required").groupBy("qid", "group_id").agg(F.count("chunk_index").alias("n"))
    per = g.groupBy("qid").agg(F.count_if(F.col("n") == 0).alias("empty"))
    all_ = qrels.select("qid").distinct().join(per, "qid", "left")
    reason = F.when(F.col("empty").isNull(), "no required group").when(F.col("empty") > 0, "required group without chunk")
    return all_.select("qid", reason.alias("reason")).where("reason is not null")


def chunkable(gold: DataFrame, chunks: DataFrame) -> DataFrame:
    """``gold`` (doc_id) with ``chunkable``: whether its document has any chunk; each document is judged once."""
    has = chunks.select(F.col("doc_id").alias("__doc")).distinct().withColumn("__has", F.lit(True))
    return gold.join(has, F.col("doc_id") == F.col("__doc"), "left").withColumn("chunkable", F.coalesce("__has", F.lit(False))).drop("__doc", "__has")


def span_lint(gold: DataFrame, docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """(qid, n, code): gold spans (qid, n, doc_id, start, end, quote) whose document is missing, that do not slice back to their quote, or that no
    chunk covers in part."""
    d = docs.select(F.col("doc_id").alias("__doc"), F.col("text").alias("__text"))
    c = chunks.select(F.col("doc_id").alias("__cd"), F.col("start").alias("__a"), F.col("end").alias("__z"))
    met = gold.join(c, (F.col("doc_id") == F.col("__cd")) & (F.col("__a") < F.col("end")) & (F.col("__z") > F.col("start")), "left_semi").select("qid", "n").withColumn("__met", F.lit(True))
    j = gold.join(d, F.col("doc_id") == F.col("__doc"), "left").join(met, ["qid", "n"], "left")
    cut = F.substring(F.col("__text"), F.col("start") + 1, F.col("end") - F.col("start"))
    checks = {
        "document_missing": F.col("__doc").isNull(),
        "empty_span": F.col("end") <= F.col("start"),
        "quote_differs": F.col("__doc").isNotNull() & ~cut.eqNullSafe(F.col("quote")),
        "uncovered": F.col("__doc").isNotNull() & F.col("__met").isNull(),
    }
    return violations(j, ["qid", "n"], checks)


def citation_lint(questions: DataFrame, docs: DataFrame, holdout: DataFrame, earlier: DataFrame) -> DataFrame:
    """(qid, code): citation questions whose document is not the cited act, and documents outside the holdout.

    ``questions``: qid, doc_id, tokens (array). ``docs``: doc_id, number, code, title, text; a token must occur in one of the
    first three or in the first 800 characters of the text. ``holdout`` and ``earlier``: doc_id; a holdout that lacks an earlier
    one's document gives a row with a null qid.
    """
    hay = F.replace(F.concat_ws(" ", F.coalesce("number", F.lit("")), F.coalesce("code", F.lit("")), F.coalesce("title", F.lit("")), F.substring(F.coalesce("text", F.lit("")), 1, 800)), F.lit("–"), F.lit("-"))
    d = docs.select(F.col("doc_id").alias("__doc"), hay.alias("__hay"))
    h = holdout.select(F.col("doc_id").alias("__held")).distinct()
    j = questions.join(d, F.col("doc_id") == F.col("__doc"), "left").join(h, F.col("doc_id") == F.col("__held"), "left")
    checks = {
        "no_citation": F.size("tokens") <= 0,
        "document_missing": F.col("__doc").isNull(),
        "token_not_found": F.exists("tokens", lambda t: ~F.contains(F.col("__hay"), t)),
        "not_in_holdout": F.col("__held").isNull(),
    }
    lost = earlier.select("doc_id").join(h, F.col("doc_id") == F.col("__held"), "left_anti").limit(1)
    return violations(j, ["qid"], checks).unionByName(lost.select(F.lit(None).cast(dict(questions.dtypes)["qid"]).alias("qid"), F.lit("holdout_not_a_superset").alias("code")))


def adapt_questions(questions: DataFrame) -> DataFrame:
    """One gold row a piece of evidence of nested questions: qid, query_type, n, doc_id, start, end, grade, required, evidence_group.

    ``questions``: qid, tags (array), groups (array of struct(name, required, evidence: array of struct(doc_id, start, end, grade))). The first tag that is no
    risk tag is the type, else v3.
    """
    kind = F.coalesce(F.try_element_at(F.filter("tags", lambda t: ~t.startswith("risk_")), F.lit(1)), F.lit("v3"))
    g = questions.select("qid", kind.alias("query_type"), F.explode("groups").alias("g"))
    e = g.select("qid", "query_type", F.col("g.name").alias("evidence_group"), F.col("g.required").alias("required"), F.posexplode("g.evidence").alias("n", "e"))
    return e.select("qid", "query_type", "n", "e.doc_id", "e.start", "e.end", "e.grade", "required", "evidence_group")


def question_rules(q: DataFrame) -> DataFrame:
    """(qid, code) of questions that break a rule.

    ``q``: qid, tags, as_of, identifiers (array), required_groups, documents (counts), lineages, families (arrays), reviewers (count of different ones),
    agree (boolean), adjudicated (boolean).
    """
    has = lambda t: F.array_contains("tags", t)
    risky = F.size(F.filter("tags", lambda t: t.startswith("risk_")))
    checks = {
        "risk_tag_count": risky != 1,
        "lookup_xor_cases": has("exact_lookup") & has("cases_applying"),
        "current_xor_historical": ~exactly_one([has("current"), has("historical")]),
        "as_of_iff_historical": F.col("as_of").isNotNull() != has("historical"),
        "identifiers_iff_heavy": (F.size("identifiers") > 0) != has("identifier_heavy"),
        "multi_evidence_groups": has("multi_evidence") & (F.col("required_groups") < 2),
        "conflicting_documents": has("conflicting_authorities") & (F.col("documents") < 2),
        "lineage_outside_family": F.size(F.array_except("lineages", "families")) > 0,
        "reviewer_count": F.col("reviewers") != 2,
        "adjudicator_iff_disagreement": F.col("adjudicated") == F.col("agree"),
    }
    return violations(q, ["qid"], checks)


def translation_lint(translations: DataFrame, gold: DataFrame, language: Column, target_language: Column) -> DataFrame:
    """(qid, code) of translations (qid, query, target) that do not fit gold (qid, text): unknown, drifted, or in the wrong language.

    ``language`` is of ``query`` and ``target_language`` of ``target``; English goes to Georgian.
    """
    g = gold.select(F.col("qid").alias("__q"), F.col("text").alias("__t"))
    j = translations.join(g, F.col("qid") == F.col("__q"), "left")
    checks = {
        "unknown_question": F.col("__q").isNull(),
        "query_drifted": F.col("__q").isNotNull() & (F.col("query") != F.col("__t")),
        "source_not_english": language != "en",
        "target_not_georgian": target_language != "ka",
    }
    return violations(j, ["qid"], checks)


def answer_signals(hits: DataFrame, queries: DataFrame, groups: DataFrame, k: int = 10, threshold: float = 0.92) -> DataFrame:
    """Signals of each question's answer: first document and its lead, whether it is the gold one, coverage of the evidence, and whether it is confidently wrong.

    ``hits``: qid, rank, score, doc_id, chunk_index. ``queries``: qid, gold_doc, known_item. ``groups``: qid, group_id, doc_id, chunk_index (null: nothing satisfies
    it). A question without hits scores 0 and stays.
    """
    best = hits.groupBy("qid", "doc_id").agg(F.max("score").alias("score"), F.min("rank").alias("at"))
    best = best.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy("at", "doc_id")))
    of = lambda r, c: F.max(F.when(F.col("r") == r, F.col(c)))
    gold = best.join(queries.select("qid", "gold_doc"), "qid")
    top = gold.groupBy("qid").agg(of(1, "doc_id").alias("top_doc"), of(1, "score").alias("top_score"), of(2, "score").alias("second_score"), F.bool_or((F.col("doc_id") == F.col("gold_doc")) & (F.col("r") <= k)).alias("in_k"))
    first = hits.groupBy("qid", "doc_id", "chunk_index").agg(F.min("rank").alias("rank"))
    first = first.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy("rank", "doc_id", "chunk_index"))).where(F.col("r") <= k)
    met = groups.join(first, ["qid", "doc_id", "chunk_index"]).select("qid", "group_id").distinct().groupBy("qid").agg(F.count("*").alias("met"))
    size = groups.groupBy("qid").agg(F.count_distinct("group_id").alias("size"))
    j = queries.join(top, "qid", "left").join(size, "qid", "left").join(met, "qid", "left")
    score, right = F.coalesce("top_score", F.lit(0.0)), F.coalesce(F.col("top_doc") == F.col("gold_doc"), F.lit(False))
    cover = F.coalesce(F.coalesce("met", F.lit(0)) / F.col("size"), F.lit(0.0))
    return j.select(
        "qid", "top_doc", F.round(score, 6).alias("top_score"), F.round(score - F.coalesce("second_score", F.lit(0.0)), 6).alias("margin"), right.alias("identity_at_1"),
        F.coalesce("in_k", F.lit(False)).alias("identity_at_k"), F.round(cover, 6).alias("span_coverage"), (cover >= 1).alias("fully_grounded"),
        (F.col("known_item") & (score >= threshold) & ~right).alias("confident_wrong"),
    )


def run_validity(scores: DataFrame, runs: DataFrame) -> DataFrame:
    """(mode, reasons) of each run: why its figures cannot pass a gate; none is an empty array.

    ``scores``: mode, failed, recall50, recall80. ``runs``: mode, deterministic, repeats, production, strict.
    """
    s = scores.groupBy("mode").agg(F.bool_or("failed").alias("bad"), F.bool_and(F.col("recall50").isNotNull() & F.col("recall80").isNotNull()).alias("whole"))
    j = runs.join(s, "mode", "left")
    checks = {
        "failed_or_degraded_queries": F.col("bad"),
        "non_deterministic_results": ~F.col("deterministic"),
        "production_track_not_repeated": F.col("production") & (F.col("repeats") < 2),
        "candidate_metrics_incomplete": F.col("strict") & ~F.coalesce("whole", F.lit(False)),
    }
    return j.select("mode", codes(checks).alias("reasons"))


def outcome_counts(outcomes: DataFrame, by: str, errors: list[str]) -> DataFrame:
    """By candidate: answers, clusters, and for each error the clusters in which any answered member has it."""
    c = outcomes.where("answered").groupBy(by, "cluster").agg(F.count("*").alias("n"), *[F.bool_or(e).alias(e) for e in errors])
    return c.groupBy(by).agg(F.sum("n").alias("answers"), F.count("*").alias("clusters"), *[F.count_if(F.col(e)).alias(e) for e in errors])


def cited_subset(citations: DataFrame, evidence: DataFrame) -> DataFrame:
    """(candidate, cited, missing, digest): the evidence that answers cite, how much of it is unknown, and a digest of the known set.

    ``citations``: candidate, evidence_id. ``evidence``: evidence_id, hash. The digest is of counts and sums over hashes, so no set is gathered; equal sets have equal digests.
    """
    c = citations.select("candidate", "evidence_id").distinct().join(evidence, "evidence_id", "left")
    word = F.conv(F.substring(F.sha2(F.concat_ws("|", F.col("evidence_id").cast("string"), "hash"), 256), 1, 12), 16, 10).cast("decimal(38,0)")
    known = F.col("hash").isNotNull()
    g = c.groupBy("candidate").agg(F.count("*").alias("cited"), F.count_if(~known).alias("missing"), F.sum(F.when(known, word)).alias("x"))
    return g.select("candidate", "cited", "missing", F.sha2(F.concat_ws("|", (F.col("cited") - F.col("missing")).cast("string"), F.coalesce("x", F.lit(0)).cast("string")), 256).alias("digest"))


def outcome_features(items: DataFrame, branches: DataFrame) -> DataFrame:
    """Features of answers for calibration.

    ``items``: qid, rank, score, confidence, certain (boolean). ``branches``: qid, branch, hit_id. Per question: the least confidence (1 without any), the lead of the first item, the
    share of branches that agree on their commonest hit, likeness of the branches ``original`` and ``translated`` (1 without both), and the share of certain versions.
    """
    of = lambda r: F.max(F.when(F.col("rank") == r, F.col("score")))
    i = items.groupBy("qid").agg(F.coalesce(F.min("confidence"), F.lit(1.0)).alias("identity_confidence"), F.round(of(1) - of(2), 6).alias("margin"), F.round(F.avg(F.col("certain").cast("double")), 6).alias("version_certainty"))
    b = branches.distinct()
    each = b.groupBy("qid", "hit_id").agg(F.count("*").alias("n"), F.bool_or(F.col("branch") == "original").alias("o"), F.bool_or(F.col("branch") == "translated").alias("t"))
    lines = b.groupBy("qid").agg(F.count_distinct("branch").alias("branches"))
    a = each.groupBy("qid").agg(F.max("n").alias("most"), F.count_if(F.col("o") & F.col("t")).alias("both"), F.count_if(F.col("o") | F.col("t")).alias("any"), F.bool_or("o").alias("o"), F.bool_or("t").alias("t")).join(lines, "qid")
    agree = F.when(F.col("o") & F.col("t"), F.round(F.col("both") / F.col("any"), 6)).otherwise(1.0)
    return i.join(a, "qid", "left").select("qid", "identity_confidence", "margin", F.coalesce(F.round(F.col("most") / F.col("branches"), 6), F.lit(0.0)).alias("route_agreement"), F.coalesce(agree, F.lit(1.0)).alias("translation_agreement"), "version_certainty")
