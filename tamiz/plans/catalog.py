"""The queries of the core: every operator over the whole of the tables it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions import text as tx
from tamiz.operators import chunks as ch
from tamiz.operators import enrich, incremental, pages, qa, tables
from tamiz.plans import oracle
from tamiz.plans.durable import durable, once, spread
from tamiz.sources.files import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Repeated lines: the share of a source's pages.
REPEATED = 0.02


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text", "lang", "source", "page"))


def _sourced(spark: SparkSession, d: str) -> DataFrame:
    """Documents; those without a source are of the source ''."""
    return _documents(spark, d).withColumn("source", F.coalesce("source", F.lit("")))


def _records(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    rows = table(spark, d, "raw").filter(F.col("qa_id").isNotNull()).select("qa_id", F.struct(*columns).alias("_v"), "row_no")
    return rows.groupBy("qa_id").agg(F.min_by("_v", "row_no").alias("_v")).select("qa_id", "_v.*")


def _split(c: str = "split"):
    s = F.lower(F.trim(c))
    return F.when(s.isin("train", "training"), "train").when(s.isin("validation", "valid", "val", "dev"), "validation").when(s.isin("test", "testing"), "test")


# ---- text ----
@query
def text_normalize(spark, d):
    return _documents(spark, d).select("doc_id", tx.normalize("text").alias("norm"))


@query
def text_slugify(spark, d):
    return table(spark, d, "inventory").select("pdf_id", tx.slugify("source_pdf").alias("slug"))


@query
def word_and_token_counts(spark, d):
    return _documents(spark, d).select("doc_id", tx.word_count("text").alias("words"), tx.estimate_tokens("text").alias("tokens"))


@query
def clean_text_chain(spark, d):
    return _documents(spark, d).select("doc_id", tx.clean("text").alias("cleaned"))


@query
def lm_text(spark, d):
    return _documents(spark, d).select("doc_id", tx.collapse(tx.clean("text")).alias("lm"))


def _lines(spark, d):
    rows = _documents(spark, d).select("doc_id", F.explode(tx.nonblank_lines("text")).alias("line"))
    return once(once(rows, p=tx.plain("line")), n=tx.normalize_plain(F.col("p")))


@query
def noise_line_flags(spark, d):
    noise = tx.is_noise(F.col("line"), F.col("p"), F.col("n"))
    return _lines(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.count_if(noise).alias("noise"))


@query
def heading_lines(spark, d):
    return _lines(spark, d).groupBy("doc_id").agg(F.count_if(tx.is_heading("line")).alias("headings"))


@query
def reference_ratio_and_markers(spark, d):
    return _documents(spark, d).select("doc_id", tx.reference_ratio("text").alias("ratio"), tx.reference_markers("text").alias("markers"))


@query
def suspicious_and_numeric_ratios(spark, d):
    return _documents(spark, d).select(
        "doc_id", tx.suspicious_ratio("text").alias("suspicious"), tx.numeric_ratio("text").alias("numeric"), tx.decimal_count("text").alias("decimals")
    )


def _scored(rows: DataFrame, text: str = "text") -> DataFrame:
    rows = once(rows, _n=tx.normalize(text), _w=tx.word_count(text), _r=tx.reference_ratio(text))
    return once(rows, score=tx.clinical_score(F.col("_n"), F.col("_w"), F.col("_r")), tokens=tx.tokens_of(F.col("_w"))).drop("_n", "_w", "_r")


@query
def lexicon_score(spark, d):
    return _scored(_documents(spark, d)).select("doc_id", "score")


@query
def quality_flags(spark, d):
    return _scored(_documents(spark, d)).select("doc_id", F.array_join(ch.quality_flags("text", F.col("tokens"), F.col("score")), ",").alias("flags"))


@query
def paragraph_split(spark, d):
    rows = once(_documents(spark, d), p=ch.paragraphs("text"))
    return rows.select("doc_id", F.size("p").alias("paragraphs"), F.coalesce(F.array_max(F.transform("p", lambda x: F.length(x))), F.lit(0)).alias("longest"))


@query
def strip_lm_noise(spark, d):
    return _documents(spark, d).select("doc_id", tx.strip_exam_noise("text").alias("stripped"))


@query
def detect_language(spark, d):
    return _documents(spark, d).select("doc_id", tx.detect_language("text").alias("detected"))


@query
def language_confusion(spark, d):
    rows = _documents(spark, d).select(F.coalesce("lang", F.lit("unknown")).alias("lang"), tx.detect_language("text").alias("detected"))
    return rows.groupBy("lang", "detected").agg(F.count(F.lit(1)).alias("n"))


@query
def looks_spanish(spark, d):
    return _documents(spark, d).select("doc_id", tx.looks_spanish("text").alias("spanish"))


@query
def clinical_density(spark, d):
    return _documents(spark, d).select("doc_id", tx.clinical_density("text").alias("density"))


@query
def document_fingerprint(spark, d):
    return table(spark, d, "inventory").select("pdf_id", tx.fingerprint("text_sample").alias("fingerprint"))


@query
def doc_type_classify(spark, d):
    return table(spark, d, "inventory").select("pdf_id", tx.document_type("source_pdf", "text_sample").alias("doc_type"))


@query
def meta_reference_flags(spark, d):
    rows = _records(spark, d, "pregunta", "respuesta")
    marks = F.regexp_count(F.coalesce("pregunta", F.lit("")), F.lit("[?¿]"))
    return rows.select("qa_id", tx.has_meta_reference("pregunta").alias("question_meta"), tx.has_meta_reference("respuesta").alias("answer_meta"),
                       marks.alias("question_marks"), tx.token_count("respuesta").alias("answer_words"))


@query
def llm_json_parse(spark, d):
    """Verdicts as a judge would send them, fenced or within prose, read back."""
    rows = _records(spark, d, "faithfulness", "quality_verdict")
    sent = F.to_json(F.struct(F.col("faithfulness").alias("score"), F.col("quality_verdict").alias("verdict")))
    wrapped = F.when(F.pmod(F.xxhash64("qa_id"), F.lit(2)) == 0, F.concat(F.lit("```json\n"), sent, F.lit("\n```"))).otherwise(F.concat(F.lit("Here it is: "), sent, F.lit(" Done.")))
    parsed = F.from_json(tx.json_object(wrapped), "score double, verdict string")
    return rows.select("qa_id", parsed.alias("p")).select("qa_id", "p.score", "p.verdict")


# ---- chunks as they are given ----
@query
def enrich_chunks(spark, d):
    out = enrich.enriched(spread(table(spark, d, "chunks")), "text", "section")
    return out.select("chunk_id", "section_type", "content_role", "language", "topic_count")


@query
def topic_tags(spark, d):
    rows = spread(table(spark, d, "chunks")).select("chunk_id", tx.normalize("text").alias("n"))
    return rows.select("chunk_id", F.explode(tx.topics(F.col("n"))).alias("topic"))


@query
def accepted_for_lm_reasons(spark, d):
    rows = spread(table(spark, d, "chunks"))
    return rows.select("chunk_id", ch.reject_reason("text", F.col("token_estimate"), F.col("clinical_score")).alias("reason"))


@query
def accepted_histogram(spark, d):
    rows = once(spread(table(spark, d, "chunks")), reason=ch.reject_reason("text", F.col("token_estimate"), F.col("clinical_score")))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def dedupe_exact_near(spark, d):
    order = [(-F.coalesce("clinical_score", F.lit(0))), (-F.coalesce("token_estimate", F.lit(0))), F.col("source_pdf"), F.col("chunk_id")]
    rows = table(spark, d, "chunks").select("chunk_id", "text", "clinical_score", "token_estimate", "source_pdf")
    return ch.best_of_duplicates(rows, "text", order).select("chunk_id")


@query
def dedupe_audit_cross_source(spark, d):
    return ch.duplicate_audit(_documents(spark, d), "text", "source", "doc_id")


@query
def chunk_ids(spark, d):
    rows = table(spark, d, "chunks").select("chunk_id", "source_pdf", "pages")
    first = F.coalesce(F.array_min("pages"), F.lit(0))
    out = ch.numbered(rows.withColumnRenamed("chunk_id", "old_id"), tx.slugify("source_pdf"), [first.asc(), F.col("old_id").asc()])
    return out.select("old_id", "chunk_id")


@query
def filter_lm_chunks(spark, d):
    return enrich.for_language_models(table(spark, d, "chunks")).select("chunk_id")


@query
def content_role_filter_stats(spark, d):
    return enrich.role_filter_stats(table(spark, d, "chunks"), "content_role")


@query
def topic_coverage_ratio(spark, d):
    return enrich.topic_coverage(table(spark, d, "chunks"), "topics", "content_role")


@query
def pairs_per_chunk(spark, d):
    return table(spark, d, "chunks").select("chunk_id", qa.pairs_per_chunk(F.col("token_estimate"), F.col("clinical_score")).alias("pairs"))


@query
def cost_estimate(spark, d):
    return qa.cost_estimate(table(spark, d, "chunks"), F.col("token_estimate"), F.col("clinical_score"))


@query
def build_report_distributions(spark, d):
    rows = table(spark, d, "chunks").select("pdf_id", "doc_type", "content_role", F.coalesce("language", F.lit("unknown")).alias("language"), "topics")
    kinds = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in ("pdf_id", "doc_type", "content_role", "language")])
    topics = F.transform(F.coalesce("topics", F.array().cast("array<string>")), lambda t: F.struct(F.lit("topic").alias("dimension"), t.alias("value")))
    return rows.select(F.explode(F.concat(kinds, topics)).alias("x")).groupBy("x.dimension", "x.value").agg(F.count(F.lit(1)).alias("n"))


@query
def lm_record_validation(spark, d):
    rows = table(spark, d, "chunks").select("chunk_id", "text", "section", "language")
    errors = F.array_compact(F.array(F.when(tx.collapse("text") == "", "empty text"), F.when(F.col("section").isNull(), "missing section"), F.when(F.col("language").isNull(), "missing language")))
    return rows.select("chunk_id", F.explode(errors).alias("error"))


@query
def split_greedy_documents(spark, d):
    return ch.split_by_document(table(spark, d, "chunks").select("pdf_id"), "pdf_id")


@query
def split_report(spark, d):
    split = ch.split_by_document(table(spark, d, "chunks").select("pdf_id"), "pdf_id")
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("chunks"))


# ---- pages ----
@query
def repeated_lines_by_source(spark, d):
    return pages.repeated_lines(_documents(spark, d), "source", "doc_id", "text", REPEATED)


@query
def repeated_lines_removed(spark, d):
    out = pages.without_repeated_lines(_sourced(spark, d), "source", "doc_id", "text", REPEATED)
    return out.select("doc_id", "removed_lines", F.length("text").alias("left_chars"))


@query
def section_carry_forward(spark, d):
    return pages.with_sections(_sourced(spark, d), "source", ["page", "doc_id"], "text").select("doc_id", "section")


@query
def page_classification(spark, d):
    out = pages.classify_pages(_documents(spark, d), "text", "page")
    return out.select("doc_id", "char_count", "word_count", "line_count", "clinical_score", "reference_marker_count", "drop_reason")


@query
def page_drop_histogram(spark, d):
    return pages.classify_pages(_documents(spark, d), "text", "page").groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))


@query
def cleaning_report(spark, d):
    return pages.cleaning_report(pages.classify_pages(_documents(spark, d), "text", "page"))


def _chunks(spark, d, overlap, most=1200):
    rows = pages.with_sections(_sourced(spark, d), "source", ["page", "doc_id"], "text")
    out = ch.chunk_records(rows, "source", "section", "page", "doc_id", "text", most, overlap)
    return out.select("source", "section", "chunk", F.md5("text").alias("text_md5"), F.array_join("pages", ",").alias("pages"), "token_estimate", "clinical_score", F.array_join("quality_flags", ",").alias("flags"))


@query
def chunk_fold(spark, d):
    return _chunks(spark, d, 0)


@query
def chunk_parity_mode(spark, d):
    """The same with what a chunk over the limit hands on to the next."""
    return _chunks(spark, d, 80)


@query
def chunk_small(spark, d):
    """Chunks so small that many paragraphs exceed them."""
    return _chunks(spark, d, 80, 100)


@query
def table_grid_quality(spark, d):
    """Runs of tabbed lines as grids."""
    rows = _documents(spark, d).select("doc_id", F.filter(tx.nonblank_lines("text"), lambda x: F.contains(x, F.lit("\t"))).alias("l")).filter(F.size("l") > 0)
    grid = rows.select("doc_id", tables.normalized_grid(F.transform("l", lambda x: F.split(x, "\t"))).alias("grid"))
    out = tables.with_grid_quality(grid, "grid")
    return out.select("doc_id", "row_count", "col_count", "non_empty_density", "numeric_ratio", "avg_words_per_cell", "max_words_cell", "short_cell_ratio", "empty_row_ratio", "is_header_like", "is_layout")


# ---- inventory ----
@query
def inclusion_status(spark, d):
    return table(spark, d, "inventory").select(
        "pdf_id", enrich.inclusion_reason(F.col("page_count"), F.col("file_size"), F.col("text_sample")).alias("reason"),
        enrich.ocr_status(F.col("needs_ocr_pages"), F.col("page_count")).alias("ocr"),
    )


@query
def inclusion_evaluated(spark, d):
    return table(spark, d, "inventory").select("pdf_id", enrich.evaluated_inclusion(F.col("ocr_status.ocr_ratio"), F.col("clinical_term_ratio"), F.col("page_count")).alias("reason"))


@query
def exclusion_report(spark, d):
    return enrich.exclusion_report(table(spark, d, "inventory"), "pdf_id", "inclusion_status", "exclusion_reason")


@query
def manifest_histograms(spark, d):
    rows = table(spark, d, "inventory").select(F.explode(F.array(F.struct(F.lit("doc_type").alias("dimension"), F.col("doc_type").alias("value")), F.struct(F.lit("ocr").alias("dimension"), F.col("ocr_status.status").alias("value")))).alias("x"))
    return rows.groupBy("x.dimension", "x.value").agg(F.count(F.lit(1)).alias("n"))


@query
def excluded_pages_antijoin(spark, d):
    out = table(spark, d, "inventory").filter(F.col("inclusion_status").isin("excluded", "excluded_with_reason")).select(F.col("source_pdf").alias("source"))
    return _documents(spark, d).join(out, "source", "left_anti").select("doc_id")


@query
def page_manifest_join(spark, d):
    of = table(spark, d, "inventory").select(F.col("source_pdf").alias("source"), "pdf_id", "doc_type", "inclusion_status", F.col("ocr_status.status").alias("ocr"))
    return _documents(spark, d).select("doc_id", "source").join(of, "source", "left").select("doc_id", "pdf_id", "doc_type", "inclusion_status", "ocr")


@query
def audit_source_balance(spark, d):
    return _documents(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("lang").alias("languages"))


@query
def top_sources_topk(spark, d):
    return _documents(spark, d).filter("source is not null").groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "source").limit(10)


@query
def incremental_changed_files(spark, d):
    out = incremental.changed_files(table(spark, d, "inventory").select("source_path", "source_pdf", "file_size"), table(spark, d, "processed_files"))
    return out.select("source_path", "change")


@query
def manifest_upsert(spark, d):
    files = table(spark, d, "inventory").select("source_pdf", "source_path", "file_size", F.lit(0).cast("long").alias("mtime_ns"))
    return incremental.replaced(table(spark, d, "processed_files"), files, "source_path", "source_path").select("source_path", "file_size", "mtime_ns")


@query
def incremental_upsert(spark, d):
    """Pages of the sources whose size changed are delivered anew, the others stay."""
    changed = incremental.changed_files(table(spark, d, "inventory").select("source_path", "source_pdf", "file_size"), table(spark, d, "processed_files"))
    old = _documents(spark, d).select("doc_id", "source", F.lit("old").alias("batch"))
    new = old.join(changed.select(F.col("source_pdf").alias("source")), "source", "left_semi").select("doc_id", "source", F.lit("new").alias("batch"))
    return incremental.replaced(old, new, "source", "source").groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("source").alias("sources"))


@query
def incremental_append_chunks(spark, d):
    """Pages delivered as new chunks beside the given ones."""
    new = _sourced(spark, d).filter("text is not null").select("text", F.col("source").alias("source_pdf"), "doc_id")
    out = incremental.appended(table(spark, d, "chunks").select("chunk_id", "text"), new, "text", "source_pdf", [F.col("doc_id")])
    return out.select("doc_id", "chunk_id")


# ---- questions and answers ----
@query
def grounding_overlap(spark, d):
    rows = _records(spark, d, "chunk_id", "contexto_fuente", "respuesta")
    return qa.grounding_by_chunk(rows, "chunk_id", "contexto_fuente", "respuesta")


@query
def quality_gate(spark, d):
    rows = _records(spark, d, "faithfulness", "answer_relevancy", "roundtrip_consistency", "quality_verdict")
    return rows.select("qa_id", qa.gated_verdict(F.col("quality_verdict")).alias("verdict"))


@query
def qa_ids(spark, d):
    """The ids that numbering the records of each chunk anew would give."""
    rows = _records(spark, d, "chunk_id")
    out = ch.ranked(rows, ["chunk_id"], [F.col("qa_id").asc()], "n")
    return out.select("qa_id", qa.qa_id(F.col("chunk_id"), F.col("n")).alias("new_id"))


def _messages(spark, d):
    rows = _records(spark, d, "pregunta", "respuesta", "contexto_fuente", "faithfulness", "quality_verdict")
    return rows.withColumn("messages", qa.sft_messages(F.lit("Responde."), F.col("pregunta"), F.col("respuesta")))


def _flat(c):
    return F.array_join(F.transform(c, lambda m: F.concat(m.role, F.lit("="), m.content)), "|")


@query
def grounded_variant(spark, d):
    return _messages(spark, d).select("qa_id", _flat(qa.grounded_messages(F.col("messages"), F.col("contexto_fuente"))).alias("messages"))


@query
def closed_book_variant(spark, d):
    return _messages(spark, d).select("qa_id", _flat(F.col("messages")).alias("messages"))


@query
def prompt_completion_split(spark, d):
    rows = _messages(spark, d).select("qa_id", qa.prompt_completion(F.col("messages")).alias("x"))
    return rows.select("qa_id", _flat(F.col("x.prompt")).alias("prompt"), _flat(F.col("x.completion")).alias("completion"))


@query
def extract_question_reference(spark, d):
    rows = _messages(spark, d).withColumn("messages", qa.grounded_messages(F.col("messages"), F.col("contexto_fuente")))
    return rows.select("qa_id", qa.asked_question(F.col("messages")).alias("question"), qa.reference_answer(F.col("messages")).alias("reference"))


@query
def drop_quality_fields(spark, d):
    rows = _records(spark, d, "tipo", "faithfulness", "quality_verdict").select("qa_id", F.struct("tipo", "faithfulness", "quality_verdict").alias("metadata"))
    return qa.without_fields(rows).select("qa_id", F.to_json("metadata").alias("metadata"))


@query
def variant_counts(spark, d):
    rows = _records(spark, d, "chunk_id", "split").withColumn("split", _split())
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("records"), F.countDistinct("chunk_id").alias("chunks"), F.countDistinct(F.regexp_extract("chunk_id", "^(.*)_[0-9]+$", 1)).alias("documents"))


@query
def split_leakage_audit(spark, d):
    rows = _records(spark, d, "chunk_id", "split").select(F.regexp_extract("chunk_id", "^(.*)_[0-9]+$", 1).alias("pdf_id"), _split().alias("split"))
    return ch.leakage(rows, "pdf_id", "split").select("pdf_id", F.array_join("splits", ",").alias("splits"))


@query
def topic_coverage_sets(spark, d):
    return enrich.split_topics(_records(spark, d, "topics", "split").withColumn("split", _split()), "topics", "split")


@query
def eval_summary(spark, d):
    rows = _records(spark, d, "faithfulness", "answer_relevancy", "roundtrip_consistency", "quality_verdict")
    return qa.score_summary(rows, ("faithfulness", "answer_relevancy", "roundtrip_consistency"), "quality_verdict")


@query
def qa_text_stats(spark, d):
    return qa.text_stats(_records(spark, d, "pregunta", "respuesta"), "pregunta", "respuesta")


@query
def qa_type_histogram(spark, d):
    return _records(spark, d, "tipo", "dificultad").groupBy("tipo", "dificultad").agg(F.count(F.lit(1)).alias("n"))


@query
def eval_merge_three_way(spark, d):
    raw = table(spark, d, "raw").filter("qa_id is not null")
    report = lambda c: raw.filter(F.col(c).isNotNull()).select("qa_id", F.col(c).alias("value"), F.col("row_no").alias("at"))
    names = ("faithfulness", "answer_relevancy", "roundtrip_consistency")
    out = qa.merged_scores(raw.select("qa_id").distinct(), "qa_id", {c: report(c) for c in names})
    return out.select("qa_id", *names)


@query
def chunk_lookup_fallback_join(spark, d):
    texts = table(spark, d, "chunks").filter("text is not null").groupBy("chunk_id").agg(F.max("text").alias("_text"))
    rows = _records(spark, d, "chunk_id", "contexto_fuente").join(texts, "chunk_id", "left")
    return rows.select("qa_id", F.length(F.coalesce("_text", "contexto_fuente", F.lit(""))).alias("context_chars"))


@query
def pending_resume_antijoin(spark, d):
    done = _records(spark, d, "chunk_id", "quality_verdict").filter("quality_verdict = 'accept'")
    return incremental.pending(table(spark, d, "chunks").select("chunk_id"), done, "chunk_id")


@query
def sample_per_group(spark, d):
    return ch.sample_per_group(_documents(spark, d).select("doc_id", "source"), "source", "doc_id", 5)


@query
def stratified_sample_quota(spark, d):
    return ch.stratified_quotas(_documents(spark, d).select(F.coalesce("source", F.lit("unknown")).alias("source")), "source", 200)


@query
def stratified_sample_rows(spark, d):
    return ch.stratified_sample(_documents(spark, d).select("doc_id", F.coalesce("source", F.lit("unknown")).alias("source")), "source", "doc_id", 200)


@query
def semantic_similarity_topk(spark, d):
    """The five nearest of all vectors to every vector whose id is divisible by 100."""
    out = qa.nearest(table(spark, d, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 100 == 0)
    return out.select("query", "neighbour", "rank")


@query
def generation_statuses(spark, d):
    out = qa.generated(table(spark, d, "chunks"), qa.extractive_pairs, ["text"])
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("pairs")).alias("pairs"))


@query
def streaming_incremental_docs(spark, d):
    """Documents as a stream of files, several to a source and one file to a batch: first old states of every third source, then all rows in
    six files. Rows of a source that come in different batches stay together; the old states, of other ids, are replaced."""
    from uuid import uuid4

    from tamiz.streaming.incremental import staging, upsert_by_source

    with staging(spark, keep=True) as at:
        docs = _documents(spark, d).select("doc_id", "source", F.lit("new").alias("state"))
        third = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(3)) == 0
        docs.filter(third).withColumn("state", F.lit("old")).coalesce(1).write.parquet(f"{at}/in/a")
        docs.repartition(6, "doc_id").write.parquet(f"{at}/in/b")
        run = upsert_by_source(spark, f"{at}/in", docs.schema, f"{at}/table", f"{at}/state", "source", append="doc_id", files_per_batch=1)
        run.awaitTermination()
        rows = durable(spark.read.schema("doc_id long, source string, state string").parquet(f"{at}/table"))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query
def event_windows(spark, d):
    from tamiz.streaming.incremental import windowed_counts

    return windowed_counts(table(spark, d, "events"), "ts", "event_type").select("start", "event_type", "n", F.round("total", 4).alias("total"))


# ---- all together ----
@query
def pipeline_split_report(spark, d):
    """Pages to splits: cleaned, classified, packed into chunks, accepted, deduplicated and split by document."""
    kept = pages.classify_pages(_sourced(spark, d), "text", "page").filter("is_kept").select("doc_id", "source", "page", F.col("cleaned").alias("text"))
    rows = pages.with_sections(durable(kept), "source", ["page", "doc_id"], "text")
    rows = ch.chunk_records(rows, "source", "section", "page", "doc_id", "text")
    good = once(rows, reason=ch.reject_reason("text", F.col("token_estimate"), F.col("clinical_score"), min_score=1)).filter("reason = ''").drop("reason")
    order = [-F.col("clinical_score"), -F.col("token_estimate"), F.col("source"), F.col("section"), F.col("chunk")]
    best = durable(ch.best_of_duplicates(good, "text", order).select("source", "token_estimate"))
    split = ch.split_by_document(best, "source", 0.1, 0.1, least=1)
    return best.join(split.drop("n"), "source").groupBy("split").agg(F.countDistinct("source").alias("documents"), F.count(F.lit(1)).alias("chunks"), F.sum("token_estimate").alias("tokens"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tamiz.plans import more  # noqa: F401  registers its queries

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from tamiz.plans import more

    return oracle.sql(REPEATED) | more.sql()
