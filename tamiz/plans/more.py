"""More queries of the core, each beside the SQL that it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from tamiz.functions import lexicon as lx
from tamiz.functions import text as tx
from tamiz.operators import chunks as ch
from tamiz.operators import duplicates, enrich, evaluation, extraction, incremental, pages, qa, records, reports, tables
from tamiz.plans import oracle as o
from tamiz.plans.catalog import _documents, _records, _sourced, _split, query
from tamiz.plans.durable import durable, spread
from tamiz.sources import files
from tamiz.sources.files import table
from tamiz.streaming.incremental import progress, resumable, staging

SQL: dict[str, Callable[[], str]] = {}


def sql() -> dict[str, str]:
    return {n: f() for n, f in SQL.items()}


def expects(text: Callable[[], str] | str):
    """Registers a query with its SQL."""

    def register(f):
        SQL[f.__name__] = text if callable(text) else lambda: text
        return query(f)

    return register


# ---- paragraphs and chunks ----
def _paragraph_sql() -> str:
    """``para(doc_id, nth, t)``: blocks between blank lines, or lines joined until a heading or 120 words."""
    block = f"\\n{tx.WS}*\\n"
    return f"""d AS MATERIALIZED (SELECT doc_id, [z FOR z IN [{o.strip('y')} FOR y IN regexp_split_to_array(coalesce(text, ''), {o.q(block)})] IF z <> ''] AS blocks, {o.nonblank('text')} AS lines FROM documents),
ln AS MATERIALIZED (SELECT doc_id, i, line, {o.heading('line')} AS h, {o.count('line', tx.NWS + '+')} AS n FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM d WHERE len(blocks) <= 1)),
fo AS (SELECT doc_id, i, 1 AS p, n AS held FROM ln WHERE i = 1 UNION ALL
  SELECT ln.doc_id, ln.i, CASE WHEN ln.h OR fo.held >= 120 THEN p + 1 ELSE p END, CASE WHEN ln.h OR fo.held >= 120 THEN ln.n ELSE held + ln.n END FROM fo JOIN ln ON ln.doc_id = fo.doc_id AND ln.i = fo.i + 1),
para AS MATERIALIZED (SELECT doc_id, p AS nth, string_agg(line, ' ' ORDER BY i) AS t FROM fo JOIN ln USING (doc_id, i) GROUP BY 1, 2
  UNION ALL SELECT doc_id, unnest(range(1, len(blocks) + 1)), unnest(blocks) FROM d WHERE len(blocks) > 1)"""


SQL["paragraph_split"] = lambda: f"""WITH RECURSIVE {_paragraph_sql()}
SELECT doc_id, count(nth)::int AS paragraphs, coalesce(max(length(t)), 0)::int AS longest FROM documents LEFT JOIN para USING (doc_id) GROUP BY 1"""


def _chunk_sql(overlap: int, most: int = 1200) -> str:
    tok = lambda n: f"greatest(1, ceil(({n}) * 1.35::double))"
    flags = ", ".join(f"CASE WHEN {c} THEN {o.q(n)} END" for n, c in [
        ("short_chunk", "tokens < 180"), ("long_chunk", "tokens > 1500"), ("low_clinical_score", "score < 5"), ("reference_heavy", "rr >= 0.3"),
        ("reference_markers", f"{o.markers('text')} >= 4"), ("corrupt_extraction", f"{o.suspicious('text')} >= 0.012"),
        ("numeric_or_table_heavy", f"{o.numeric('text')} >= 0.38"), ("decimal_table_like", f"{o.decimals('text')} >= 12"),
        ("low_vocabulary_variety", "len(list_distinct([w FOR w IN string_split(n, ' ') IF w <> ''])) < 35"),
    ])
    trimmed = o.sub("hd", "^[ :-]+|[ :-]+$")
    return f"""WITH RECURSIVE {_paragraph_sql()},
h AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, page, [z FOR z IN ({o.lines('text')})[1:10] IF {o.heading('z')} AND NOT {o.among(o.norm('z'), lx.INDEX_TERMS)}][1] AS hd FROM documents),
s AS MATERIALIZED (SELECT doc_id, source, page, coalesce(last_value(nullif({trimmed}, '') IGNORE NULLS) OVER (PARTITION BY source ORDER BY page, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'Sin seccion') AS section FROM h),
x AS MATERIALIZED (SELECT source, section, coalesce(page, 0) AS page, doc_id, nth, trim({o.sub('t', tx.WS + '+', ' ')}) AS t FROM para JOIN s USING (doc_id)),
p AS MATERIALIZED (SELECT *, {o.words('t')} AS w, row_number() OVER (PARTITION BY source, section ORDER BY page, doc_id, nth) AS i FROM x WHERE t <> ''),
f AS (SELECT source, section, i, doc_id, w AS held, 1 AS chunk, 0::bigint AS carried FROM p WHERE i = 1 UNION ALL
  SELECT source, section, i, doc_id, CASE WHEN c THEN k + w ELSE held + w END, CASE WHEN c THEN chunk + 1 ELSE chunk END, CASE WHEN c THEN k ELSE carried END FROM (
    SELECT p.source, p.section, p.i, p.doc_id, p.w, f.held, f.chunk, f.carried, CASE WHEN {tok('f.held')} > {most} THEN least({overlap}, f.held) ELSE 0 END AS k,
      (p.doc_id <> f.doc_id AND {tok('f.held')} >= {most}) OR {tok('f.held + p.w')} > {most} AS c FROM f JOIN p ON p.source = f.source AND p.section = f.section AND p.i = f.i + 1)),
c AS MATERIALIZED (SELECT source, section, chunk, any_value(carried) AS carried, sum(w) AS w, string_agg(t, ' ' ORDER BY i) AS own, list(page ORDER BY i) AS pages FROM f JOIN p USING (source, section, i) GROUP BY ALL),
t AS (SELECT source, section, chunk + 1 AS chunk, array_to_string(string_split(own, ' ')[-{max(overlap, 1)}:], ' ') AS tail, pages[-1] AS last FROM c WHERE {overlap} > 0 AND {tok('w + carried')} > {most}),
j AS MATERIALIZED (SELECT source, section, chunk, trim(concat_ws(' ', tail, own)) AS text, [q FOR q IN list_sort(list_distinct(coalesce(pages, []) || [last])) IF q > 0] AS pages FROM c FULL JOIN t USING (source, section, chunk)),
m AS MATERIALIZED (SELECT *, {o.norm('text')} AS n, {o.words('text')} AS words, {o.ratio_references('text')} AS rr FROM j),
k AS MATERIALIZED (SELECT *, {tok('words')}::int AS tokens, {o.score('n', 'words', 'rr')} AS score FROM m)
SELECT source, section, chunk, md5(text) AS text_md5, array_to_string(pages, ',') AS pages, tokens AS token_estimate, score AS clinical_score, array_to_string([x FOR x IN [{flags}] IF x IS NOT NULL], ',') AS flags FROM k"""


SQL["chunk_fold"] = lambda: _chunk_sql(0)
SQL["chunk_parity_mode"] = lambda: _chunk_sql(80)
SQL["chunk_small"] = lambda: _chunk_sql(80, 100)


@expects(lambda: f"SELECT doc_id, array_to_string(string_split(trim({o.sub(o.full('text'), tx.WS + '+', ' ')}), ' ')[-80:], ' ') AS tail FROM documents")
def tail_of_text(spark, d):
    return _documents(spark, d).select("doc_id", tx.tail_words("text", 80).alias("tail"))


# ---- splits and samples ----
def _split_sql() -> str:
    """``sp(pdf_id, n, split)``: documents taken one by one, always the one that brings a holdout nearest its target."""
    def take(name: str, pool: str) -> str:
        return f"""{name} AS (SELECT 0 AS k, 0::double AS total, []::varchar[] AS taken UNION ALL
  SELECT k + 1, total + best.n, list_append(taken, best.id) FROM (
    SELECT k, total, taken, goal, min({{'d': abs(goal - total - n), 'n': n::double, 'id': pdf_id}}) FILTER (k > 0 OR n <= greatest(1, round_even(goal * 0.75::double, 0)) OR n = least_) AS best
    FROM {name}, {pool}, g WHERE NOT list_contains(taken, pdf_id) GROUP BY k, total, taken, goal)
  WHERE best IS NOT NULL AND goal > 0 AND NOT (k >= 3 AND abs(goal - total - best.n) >= abs(goal - total)))"""

    first, second = take("va", "z"), take("te", "y")
    goal = "g AS MATERIALIZED (SELECT round_even(sum(n) * 0.05::double, 0) AS goal, min(n) AS least_ FROM z)"
    return f"""z AS MATERIALIZED (SELECT pdf_id, count(*) AS n FROM chunks GROUP BY 1), {goal}, {first}, vl AS MATERIALIZED (SELECT arg_max(taken, k) AS l FROM va),
y AS MATERIALIZED (SELECT z.* FROM z, vl WHERE NOT list_contains(l, pdf_id)), {second}, tl AS MATERIALIZED (SELECT arg_max(taken, k) AS l FROM te),
sp AS (SELECT pdf_id, n, CASE WHEN list_contains(vl.l, pdf_id) THEN 'validation' WHEN list_contains(tl.l, pdf_id) THEN 'test' ELSE 'train' END AS split FROM z, vl, tl)"""


SQL["split_greedy_documents"] = lambda: f"WITH RECURSIVE {_split_sql()} SELECT * FROM sp"
SQL["split_report"] = lambda: f"WITH RECURSIVE {_split_sql()} SELECT split, count(*) AS documents, sum(n)::bigint AS chunks FROM sp GROUP BY 1"
SQL["sample_per_group"] = lambda: "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id::varchar), doc_id) <= 5"
SQL["stratified_sample_rows"] = lambda: """WITH s AS (SELECT coalesce(source, 'unknown') AS source, count(*) AS n FROM documents GROUP BY 1), t AS (SELECT sum(n) AS a, count(*) AS g FROM s),
q AS (SELECT source, CASE WHEN 200 >= a THEN n WHEN floor(200 * n / a::double) = 0 AND g <= 200 THEN 1 ELSE floor(200 * n / a::double) END AS quota FROM s, t),
r AS (SELECT doc_id, coalesce(source, 'unknown') AS source, md5('42:' || doc_id::varchar) AS h FROM documents),
k AS (SELECT doc_id, source, h, row_number() OVER (PARTITION BY source ORDER BY h, doc_id) > quota AS later FROM r JOIN q USING (source))
SELECT doc_id, source FROM k QUALIFY row_number() OVER (ORDER BY later, h, doc_id) <= 200"""
SQL["generation_statuses"] = lambda: """WITH c AS (SELECT least(2, len([x FOR x IN [trim(y) FOR y IN string_split(replace(coalesce(text, ''), chr(10), ' '), '. ')] IF len(regexp_extract_all(x, '[^\\s]+')) >= 8])) AS p FROM chunks)
SELECT CASE WHEN p > 0 THEN 'ok' ELSE 'empty' END AS status, count(*) AS n, sum(p)::bigint AS pairs FROM c GROUP BY 1"""


@expects("""WITH c AS (SELECT chunk_id, pdf_id, row_number() OVER w AS i, count(*) OVER (PARTITION BY pdf_id) AS n, ('0x' || substr(md5('42:' || pdf_id), 1, 8))::bigint % 10 AS k FROM chunks
  WINDOW w AS (PARTITION BY pdf_id ORDER BY coalesce(list_min(pages), 0), chunk_id)) SELECT chunk_id, CASE WHEN n > 2 AND (i - 1 + k) % 10 = 0 THEN 'validation' ELSE 'train' END AS split FROM c""")
def block_split(spark, d):
    rows = table(spark, d, "chunks").select("chunk_id", "pdf_id", F.coalesce(F.array_min("pages"), F.lit(0)).alias("first"))
    return ch.block_split(rows, "pdf_id", [F.col("first").asc(), F.col("chunk_id").asc()]).select("chunk_id", "split")


# ---- records ----
_TOPICS = "CASE WHEN len(topics) > 0 THEN topics ELSE coalesce(topic_tags, []) END"


@expects(lambda: f"""SELECT chunk_id, trim({o.sub(o.exam_noise('text'), tx.WS + '+', ' ')}) AS text, coalesce(section, '') AS section, coalesce(doc_type, 'unknown') AS doc_type, coalesce(language, 'unknown') AS language,
array_to_string({_TOPICS}, '|') AS topics, coalesce(topic_count, len({_TOPICS}))::int AS topic_count, 'obstetrics_spanish' AS source, '' AS split FROM chunks""")
def lm_records(spark, d):
    m = lambda c: F.col(f"metadata.{c}").alias(c)
    out = records.lm_records(table(spark, d, "chunks"))
    return out.select(m("chunk_id"), "text", *map(m, ("section", "doc_type", "language")), F.array_join("metadata.topics", "|").alias("topics"), m("topic_count"), m("source"), m("split"))


@expects(lambda: f"""WITH c AS (SELECT row_number() OVER (ORDER BY chunk_id) AS line, trim({o.sub(o.exam_noise('text'), tx.WS + '+', ' ')}) AS t FROM chunks)
SELECT line, 'empty text' AS error FROM c WHERE t = '' ORDER BY line LIMIT 50""")
def lm_record_errors(spark, d):
    rows = records.lm_records(table(spark, d, "chunks")).withColumn("id", F.col("metadata.chunk_id"))
    return records.lm_record_errors(rows, "id")


def _generated(spark, d):
    """Chunks with the pairs of their records, and the qualities of the first two alone."""
    rows = _records(spark, d, "chunk_id", "pregunta", "respuesta", "tipo", "dificultad", "contexto_fuente", *lx.QUALITY_FIELDS).filter("chunk_id is not null")
    pair = F.struct("pregunta", "respuesta", "tipo", "dificultad", "contexto_fuente")
    one = rows.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("qa_id", pair.alias("p"), F.struct(*lx.QUALITY_FIELDS).alias("q")))).alias("l"))
    one = one.select("chunk_id", F.transform("l", lambda x: x.p).alias("pairs"), F.slice(F.transform("l", lambda x: x.q), 1, 2).alias("qualities"))
    return table(spark, d, "chunks").withColumn("split", F.lit(None).cast("string")).join(one, "chunk_id")


def _numbered_sql() -> str:
    cols = ("chunk_id", "pregunta", "respuesta", "tipo", "contexto_fuente", *lx.QUALITY_FIELDS)
    return f"""{o.records(*cols)}, n AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY qa_id) AS i FROM r WHERE chunk_id IS NOT NULL),
k AS (SELECT n.chunk_id || '_qa_' || lpad(i::varchar, 3, '0') AS new_id, n.*, c.section AS c_section, c.source_pdf AS c_source FROM n JOIN chunks c USING (chunk_id))"""


@expects(lambda: f"""WITH {_numbered_sql()} SELECT new_id AS qa_id, 'Responde.|' || coalesce(pregunta, '') || '|' || coalesce(respuesta, '') AS messages, coalesce(c_section, '') AS section, tipo,
CASE WHEN i <= 2 THEN faithfulness END AS faithfulness, CASE WHEN i <= 2 THEN quality_verdict END AS quality_verdict FROM k""")
def sft_records(spark, d):
    out = records.sft_records(_generated(spark, d), "pairs", "qualities")
    m = lambda c: F.col(f"metadata.{c}").alias(c)
    return out.select(m("qa_id"), F.array_join(F.transform("messages", lambda x: x.content), "|").alias("messages"), *map(m, ("section", "tipo", "faithfulness", "quality_verdict")))


@expects(lambda: f"""WITH {_numbered_sql()} SELECT new_id AS qa_id, coalesce(c_source, '') AS source_pdf, pregunta, respuesta, contexto_fuente, CASE WHEN i <= 2 THEN answer_relevancy END AS answer_relevancy,
CASE WHEN i <= 2 THEN quality_reason END AS quality_reason FROM k""")
def raw_records(spark, d):
    return records.flat_records(_generated(spark, d), "pairs", "qualities").select("qa_id", "source_pdf", "pregunta", "respuesta", "contexto_fuente", "answer_relevancy", "quality_reason")


def _merged(spark, d):
    rows = _records(spark, d, "chunk_id", "source_pdf", "section", "split", "topics")
    return records.merged_metadata(rows, table(spark, d, "chunks"))


def _merged_sql() -> str:
    return f"""{o.records('chunk_id', 'source_pdf', 'section', 'split', 'topics')}, mm AS (SELECT qa_id, split, coalesce(r.source_pdf, c.source_pdf) AS source_pdf, coalesce(r.section, c.section) AS section,
c.doc_type, c.content_role, coalesce(r.topics, c.topics) AS topics FROM r LEFT JOIN chunks c USING (chunk_id))"""


@expects(lambda: f"WITH {_merged_sql()} SELECT qa_id, source_pdf, section, doc_type, content_role FROM mm")
def merged_metadata(spark, d):
    return _merged(spark, d).select("qa_id", "source_pdf", "section", "doc_type", "content_role")


@expects(lambda: f"""WITH {_merged_sql()}, e AS (SELECT 'source' AS m, source_pdf AS k, {o.split_of('split')} AS s FROM mm UNION ALL SELECT 'kind', doc_type, {o.split_of('split')} FROM mm)
SELECT m AS measure, coalesce(k, 'unknown') AS key, count(*)::double AS value FROM e GROUP BY ALL UNION ALL SELECT m || ':' || s, coalesce(k, 'unknown'), count(*)::double FROM e WHERE s IS NOT NULL GROUP BY ALL""")
def source_balance(spark, d):
    return reports.source_balance(_merged(spark, d), _split())


@expects(lambda: f"""WITH {o.records('pregunta', 'respuesta', 'contexto_fuente')} SELECT qa_id AS id, CASE WHEN contains(pregunta, 'Pregunta:') THEN {o.strip("substring(pregunta, position('Pregunta:' IN pregunta) + 9)")} ELSE {o.strip(o.full('pregunta'))} END AS question, {o.strip(o.full('respuesta'))} AS generated_answer,
{o.strip(o.full('respuesta'))} AS reference_answer, coalesce(contexto_fuente, '') AS source_context, 'system: Responde.' || chr(10) || 'user: ' || coalesce(pregunta, '') AS prompt_text FROM r""")
def prediction_records(spark, d):
    rows = _records(spark, d, "pregunta", "respuesta", "contexto_fuente")
    rows = rows.select(qa.sft_messages(F.lit("Responde."), F.col("pregunta"), F.col("respuesta")).alias("messages"), "respuesta", F.struct("qa_id", "contexto_fuente").alias("metadata"))
    return records.prediction_records(rows, "messages", "respuesta", "metadata").select("id", "question", "generated_answer", "reference_answer", "source_context", "prompt_text")


@expects(lambda: f"""WITH c AS (SELECT chunk_id, doc_type, trim({o.sub(o.full('text'), tx.WS + '+', ' ')}) AS t FROM chunks ORDER BY chunk_id LIMIT 10)
SELECT chunk_id, doc_type, CASE WHEN length(t) <= 120 THEN t ELSE rtrim(t[1:117]) || '...' END AS text_preview FROM c""")
def head_examples(spark, d):
    """The first ten chunks, as a report shows them."""
    first = table(spark, d, "chunks").select("chunk_id", "doc_type", "text").orderBy("chunk_id").limit(10)
    return first.select("chunk_id", "doc_type", records.preview("text", 120).alias("text_preview"))


@expects("SELECT row_no, trim(coalesce(nullif(source_pdf, ''), nullif(chunk_id, ''), '')) AS source, trim(coalesce(nullif(content_role, ''), nullif(section_type, ''), '')) AS role FROM raw")
def row_source_keys(spark, d):
    """Fields by their first name, or by another where that is empty."""
    return table(spark, d, "raw").select("row_no", records.first_filled("source_pdf", "chunk_id").alias("source"), records.first_filled("content_role", "section_type").alias("role"))


@expects(lambda: """SELECT pdf_id, coalesce(file_size, 0) AS file_size, coalesce(doc_type, 'unknown') AS doc_type, CASE WHEN inclusion_status = 'excluded_with_reason' THEN 'excluded' ELSE coalesce(inclusion_status, 'unknown') END AS inclusion_status,
coalesce(ocr_status.status, 'unknown') AS ocr, round(coalesce(clinical_term_ratio, 0), 4) AS ratio, """ + ", ".join(f"nullif(metadata.{c}, '') AS {c}" for c in lx.METADATA_FIELDS) + " FROM inventory")
def manifest_entries(spark, d):
    """Entries stored and read back."""
    out = records.read_entries(records.manifest_entries(table(spark, d, "inventory")))
    return out.select("pdf_id", "file_size", "doc_type", "inclusion_status", F.col("ocr_status").alias("ocr"), F.col("clinical_term_ratio").alias("ratio"), "metadata.*")


@expects("SELECT pdf_id, source_path FROM inventory WHERE doc_type = 'article' AND inclusion_status = 'included'")
def manifest_by_type(spark, d):
    return table(spark, d, "inventory").filter("doc_type = 'article' and inclusion_status = 'included'").select("pdf_id", "source_path")


@expects(lambda: f"SELECT pdf_id, {o.cases([(k, o.has('n', p)) for k, p in lx.FILENAME_TYPES.items()], o.q('unknown'))} AS doc_type FROM (SELECT pdf_id, {o.norm('source_pdf')} AS n FROM inventory)")
def filename_types(spark, d):
    return table(spark, d, "inventory").select("pdf_id", tx.filename_type("source_pdf").alias("doc_type"))


# ---- filters ----
def _looks_spanish() -> str:
    low = "' ' || lower(coalesce(text, '')) || ' '"
    return "(" + " + ".join(f"contains({low}, ' {w} ')::int" for w in lx.SPANISH_SIGNALS) + f" + CASE WHEN regexp_matches({low}, '[áéíóúñü]') THEN 2 ELSE 0 END >= 4)"


@expects(lambda: f"SELECT chunk_id FROM chunks WHERE CASE WHEN trim(coalesce(language, '')) <> '' THEN lower(trim(language)) = 'es' ELSE {_looks_spanish()} END")
def language_filter(spark, d):
    return table(spark, d, "chunks").filter(enrich.language_matches("text", "language")).select("chunk_id")


@expects("SELECT chunk_id FROM chunks WHERE coalesce(clinical_score, 0) >= 9")
def min_score_filter(spark, d):
    return enrich.of_least_score(table(spark, d, "chunks"), "clinical_score", 9).select("chunk_id")


@expects(lambda: f"SELECT chunk_id FROM chunks WHERE {o.among('content_role', lx.TRAINING_ROLES)}")
def role_filter(spark, d):
    return enrich.of_roles(table(spark, d, "chunks"), "content_role").select("chunk_id")


# ---- duplicates ----
def _fingerprint_sql() -> str:
    return f"""p AS (SELECT pdf_id, array_to_string([w FOR w IN string_split({o.norm('text_sample')}, ' ') IF length(w) > 3][1:100], ' ') AS f FROM inventory WHERE coalesce(pdf_id, '') <> '' AND coalesce(text_sample, '') <> ''),
e AS (SELECT pdf_id, min(pdf_id) OVER (PARTITION BY f) AS first, count(*) OVER (PARTITION BY f) AS n FROM p)"""


@expects(lambda: f"WITH {_fingerprint_sql()} SELECT pdf_id AS id, first FROM e WHERE n > 1")
def equal_documents(spark, d):
    return duplicates.equal_documents(duplicates.fingerprints(table(spark, d, "inventory"), "pdf_id", "text_sample"))


@query
def duplicate_documents(spark, d):
    """Links of documents to earlier ones that they repeat, exactly or nearly."""
    return duplicates.duplicate_documents(table(spark, d, "inventory"), "pdf_id", "text_sample")


@expects(lambda: f"WITH {_fingerprint_sql()} SELECT chunk_id FROM chunks WHERE pdf_id NOT IN (SELECT pdf_id FROM e WHERE pdf_id <> first)")
def chunks_without_duplicates(spark, d):
    """Chunks of the documents that repeat no earlier one exactly."""
    gone = duplicates.equal_documents(duplicates.fingerprints(table(spark, d, "inventory"), "pdf_id", "text_sample")).filter("id <> first").select("id")
    return ch.remove_documents(table(spark, d, "chunks"), "pdf_id", gone).select("chunk_id")


# ---- extraction ----
@expects(lambda: f"""WITH c AS MATERIALIZED (SELECT doc_id, source, coalesce(text, '') AS f, coalesce(substring(text, 1, 90), '') AS p FROM documents), a AS MATERIALIZED (SELECT *, {o.clean('p')} AS ca, {o.clean('f')} AS cf FROM c),
b AS (SELECT doc_id, source, length(ca) < 120 AND length(cf) > length(ca) AS use, ca, cf FROM a)
SELECT doc_id, CASE WHEN use THEN 'fallback' ELSE 'primary' END AS extraction_method, length(CASE WHEN use THEN cf ELSE ca END)::int AS char_count, length(CASE WHEN use THEN cf ELSE ca END) < 80 AS needs_ocr FROM b""")
def extraction_fallback(spark, d):
    """Pages of which the first extractor gives the first 90 characters alone, and the fallback all."""
    rows = _documents(spark, d).withColumn("p", F.substring("text", 1, 90)).withColumnRenamed("text", "f")
    return extraction.with_fallback(rows, "p", "f").select("doc_id", "extraction_method", "char_count", "needs_ocr")


@expects("""WITH t AS (SELECT coalesce(source, '') AS source, page, doc_id, trim(text) AS t FROM documents WHERE trim(coalesce(text, '')) <> ''),
u AS (SELECT *, coalesce(sum(length(t) + 1) OVER (PARTITION BY source ORDER BY page, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - 1 AS before FROM t)
SELECT source, substring(string_agg(t, ' ' ORDER BY page, doc_id), 1, 2000) AS text_sample FROM u WHERE before < 3000 GROUP BY 1""")
def text_samples(spark, d):
    return extraction.text_samples(_sourced(spark, d), "source", [F.col("page"), F.col("doc_id")], F.col("text"))


@expects("SELECT pdf_id, count(*) AS page_count, count(*) FILTER (p.needs_ocr) AS needs_ocr_pages, sum(p.char_count)::bigint AS chars FROM (SELECT pdf_id, unnest(page_ocr_status) AS p FROM inventory) GROUP BY 1")
def document_roll_up(spark, d):
    each = table(spark, d, "inventory").select("pdf_id", F.explode("page_ocr_status").alias("p")).select("pdf_id", "p.*", F.lit("primary").alias("extraction_method"))
    return extraction.document_roll_up(each, "pdf_id").select("pdf_id", "page_count", "needs_ocr_pages", "chars")


@expects(lambda: f"SELECT doc_id, array_to_string([z FOR z IN [trim({o.sub('y', tx.WS + '+', ' ')}) FOR y IN string_split(coalesce(text, ''), chr(10))] IF z <> ''], chr(10)) AS text FROM documents")
def html_text(spark, d):
    """Texts wrapped in a page of HTML, with a script and a menu, and read back."""
    safe = F.replace(F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(F.lit("<html><script>var x = '<p>no</p>';</script><nav><a href='/'>menu</a></nav><div>"), F.replace(safe, F.lit("\n"), F.lit("</div>\n<div class='l'>")), F.lit("</div><!-- end --></html>"))
    return _documents(spark, d).select("doc_id", tx.html_text(page).alias("text"))


# ---- pages ----
@expects(lambda: f"WITH {o.page_sql()} SELECT doc_id, CASE WHEN char_count < 180 AND length(coalesce(text, '')) < 150 THEN 'needs_ocr' ELSE drop_reason END AS drop_reason FROM pages JOIN documents USING (doc_id)")
def page_ocr_override(spark, d):
    """Short pages count as in need of OCR, whatever else would drop them."""
    rows = _documents(spark, d).withColumn("needs_ocr", F.length(F.coalesce("text", F.lit(""))) < 150)
    return pages.classify_pages(rows, "text", "page", "needs_ocr").select("doc_id", "drop_reason")


@expects(lambda: f"WITH {o.page_sql()} SELECT coalesce(source, '') AS source, count(*) AS pages, count(*) FILTER (drop_reason = '') AS kept FROM pages GROUP BY 1")
def kept_by_source(spark, d):
    out = pages.classify_pages(_sourced(spark, d), "text", "page")
    return out.groupBy("source").agg(F.count(F.lit(1)).alias("pages"), F.count_if("is_kept").alias("kept"))


@expects(lambda: f"WITH {o.page_sql()} SELECT doc_id FROM pages WHERE drop_reason = ''")
def kept_pages(spark, d):
    return pages.classify_pages(_documents(spark, d), "text", "page").filter("is_kept").select("doc_id")


# ---- files: written below the staging folder, and read back ----
@expects("SELECT chunk_id, section, token_estimate, array_to_string(pages, ',') AS pages FROM chunks")
def jsonl_roundtrip(spark, d):
    rows = table(spark, d, "chunks").select("chunk_id", "section", "token_estimate", "pages")
    with staging(spark) as at:
        files.write_jsonl(rows, f"{at}/chunks")
        back = files.read_jsonl(spark, f"{at}/chunks", rows.schema)
        return durable(back.withColumn("pages", F.array_join("pages", ",")))


@expects("SELECT 'written' AS step, count(*) AS n FROM chunks WHERE token_estimate >= 400 UNION ALL SELECT 'appended', count(*) FROM chunks WHERE token_estimate < 400 UNION ALL SELECT 'read', count(*) FROM chunks WHERE token_estimate IS NOT NULL")
def jsonl_append(spark, d):
    """Rows counted while they are written and appended, and when they are read."""
    rows = table(spark, d, "chunks").select("chunk_id", "token_estimate")
    with staging(spark) as at:
        first = files.write_jsonl(rows.filter("token_estimate >= 400"), f"{at}/chunks")
        second = files.write_jsonl(rows.filter("token_estimate < 400"), f"{at}/chunks", "append")
        n = files.read_jsonl(spark, f"{at}/chunks", rows.schema).count()
    return spark.createDataFrame([("written", first), ("appended", second), ("read", n)], "step string, n long")


@expects("SELECT DISTINCT chunk_id FROM raw WHERE row_no % 10 <> 0 AND trim(coalesce(chunk_id, '')) <> ''")
def tolerant_ids(spark, d):
    """The ids in JSON lines every tenth of which is cut short; and none from a file that isn't there."""
    rows = table(spark, d, "raw").select("row_no", F.to_json(F.struct("chunk_id", "pregunta")).alias("j"))
    lines = rows.select(F.when(F.col("row_no") % 10 == 0, F.expr("substring(j, 1, length(j) - 3)")).otherwise(F.col("j")).alias("value"))
    with staging(spark) as at:
        lines.write.text(f"{at}/lines")
        return durable(files.processed_ids(spark, f"{at}/lines").unionByName(files.processed_ids(spark, f"{at}/none")))


@expects(lambda: f"SELECT {o.split_of('split')} AS split, count(*) AS n FROM raw WHERE {o.split_of('split')} IS NOT NULL GROUP BY 1")
def splits_read(spark, d):
    """Three files of JSON lines, one for each split, read as one table."""
    rows = table(spark, d, "raw").select("qa_id", "pregunta", _split().alias("split")).filter("split is not null")
    with staging(spark) as at:
        paths = {}
        for s in reports.SPLITS:
            paths[s] = f"{at}/{s}"
            files.write_jsonl(rows.filter(F.col("split") == s).drop("split"), paths[s])
        return durable(files.read_splits(spark, paths, "qa_id string, pregunta string").groupBy("split").agg(F.count(F.lit(1)).alias("n")))


@expects("SELECT count(*) AS chunks, count(DISTINCT pdf_id) AS documents FROM chunks")
def report_roundtrip(spark, d):
    """A report written as one JSON document, and read."""
    chunks = table(spark, d, "chunks")
    with staging(spark) as at:
        files.write_report(reports.measures(chunks, {"chunks": F.count(F.lit(1)), "documents": F.countDistinct("pdf_id")}), f"{at}/report.json")
        return durable(files.read_json(spark, f"{at}/report.json", "chunks long, documents long"))


@expects("SELECT chunk_id, 'ok' AS status FROM chunks")
def resumable_run(spark, d):
    """Chunks in several files, some chunks in more than one, worked on once each; a second run finds nothing to do."""
    rows = table(spark, d, "chunks").select("chunk_id")
    with staging(spark) as at:
        rows.repartition(3).write.parquet(f"{at}/in/a")
        rows.filter("crc32(encode(chunk_id, 'utf-8')) % 3 = 0").coalesce(1).write.parquet(f"{at}/in/b")
        for _ in range(2):
            resumable(spark, f"{at}/in", rows.schema, f"{at}/out", f"{at}/state", "chunk_id", lambda df: df.withColumn("status", F.lit("ok"))).awaitTermination()
        return durable(spark.read.schema("chunk_id string, status string").parquet(f"{at}/out"))


# ---- tables ----
def _grid_sql() -> str:
    ratio = lambda a, b: f"coalesce(({a})::double / nullif({b}, 0), 0)"
    words = o.count("c", tx.NWS + "+")
    return f"""gl AS (SELECT doc_id, coalesce(source, '') AS source, [x FOR x IN {o.nonblank('text')} IF contains(x, chr(9))] AS l FROM documents),
gc AS (SELECT doc_id, source, [[{o.strip('c')} FOR c IN string_split(x, chr(9))] FOR x IN l] AS g FROM gl WHERE len(l) > 0),
gw AS (SELECT *, list_max([len(r) FOR r IN g]) AS width FROM gc), gp AS MATERIALIZED (SELECT doc_id, source, width, list_transform(g, lambda r: list_resize(r, width, '')) AS g FROM gw),
gf AS MATERIALIZED (SELECT *, flatten(g) AS flat, [c FOR c IN flatten(g) IF c <> ''] AS filled, [c FOR c IN g[1] IF c <> ''] AS head FROM gp),
gq AS MATERIALIZED (SELECT doc_id, source, filled, len(g)::int AS row_count, len(g[1])::int AS col_count, {ratio('len(filled)', 'len(flat)')} AS non_empty_density,
  {ratio("len([c FOR c IN filled IF regexp_matches(c, '[0-9]')])", 'len(filled)')} AS numeric_ratio, {ratio(f"list_sum([{words} FOR c IN filled])", 'len(filled)')} AS avg_words_per_cell,
  coalesce(list_max([{words} FOR c IN filled]), 0)::int AS max_words_cell, {ratio("len([c FOR c IN filled IF regexp_full_match(c, '[\\p{L}\\p{N}_]{1,3}')])".replace(chr(92) * 2, chr(92)), 'len(filled)')} AS short_cell_ratio,
  {ratio("len([r FOR r IN g IF len([c FOR c IN r IF c <> '']) = 0])", 'len(g)')} AS empty_row_ratio, len(head) >= 2 AND len([c FOR c IN head IF {words} > 6]) = 0 AS is_header_like FROM gf),
gt AS MATERIALIZED (SELECT *, (col_count >= 6 AND row_count >= 30 AND numeric_ratio < 0.08) OR (avg_words_per_cell > 8 AND numeric_ratio < 0.1) OR max_words_cell > 45 OR (short_cell_ratio > 0.55 AND numeric_ratio < 0.1)
  OR non_empty_density < 0.35 AS is_layout, CASE WHEN col_count >= 3 THEN 'lines' ELSE 'text' END AS strategy FROM gq),
ga AS (SELECT * FROM gt WHERE row_count >= 2 AND col_count >= 2 AND len(filled) >= 4 AND NOT is_layout AND (strategy <> 'text' OR (numeric_ratio >= 0.18 AND (numeric_ratio >= 0.12 OR (is_header_like AND avg_words_per_cell <= 4)))))"""


SQL["table_grid_quality"] = lambda: f"""WITH {_grid_sql()} SELECT doc_id, row_count, col_count, non_empty_density, numeric_ratio, avg_words_per_cell, max_words_cell, short_cell_ratio, empty_row_ratio, is_header_like, is_layout FROM gt"""


def _tables(spark, d):
    rows = _sourced(spark, d).select("doc_id", "source", F.filter(tx.nonblank_lines("text"), lambda x: F.contains(x, F.lit("\t"))).alias("l")).filter(F.size("l") > 0)
    grid = rows.select("doc_id", "source", tables.normalized_grid(F.transform("l", lambda x: F.split(x, "\t"))).alias("grid"))
    out = tables.with_grid_quality(grid, "grid").withColumn("strategy", F.when(F.col("col_count") >= 3, "lines").otherwise("text"))
    return tables.accepted_tables(out, "grid", "strategy")


@expects(lambda: f"WITH {_grid_sql()} SELECT doc_id, strategy, row_count, col_count FROM ga")
def accepted_tables(spark, d):
    return _tables(spark, d).select("doc_id", "strategy", "row_count", "col_count")


@expects(lambda: f"WITH {_grid_sql()}, k AS (SELECT doc_id, strategy, row_count, col_count, gp.g FROM ga JOIN gp USING (doc_id)) SELECT min(doc_id) AS doc_id, row_count, col_count FROM k GROUP BY row_count, col_count, g[1]")
def tables_deduplicated(spark, d):
    """One of the tables of equal size and first row."""
    out = tables.first_of_equal(_tables(spark, d), [F.col("row_count"), F.col("col_count"), F.to_json(F.struct(F.get("grid", F.lit(0))))], F.col("doc_id"))
    return out.select("doc_id", "row_count", "col_count")


@expects(lambda: f"WITH {_grid_sql()} SELECT doc_id, array_to_string(gp.g[1], '|') AS header, len(gp.g) - 1 AS body_rows FROM ga JOIN gp USING (doc_id)")
def table_headers(spark, d):
    return _tables(spark, d).select("doc_id", F.array_join(tables.header("grid"), "|").alias("header"), F.size(tables.body("grid")).cast("long").alias("body_rows"))


@expects(lambda: f"""WITH {_grid_sql()} SELECT s.source, count(doc_id) AS tables, count(DISTINCT doc_id) AS pages_with_tables, count(*) FILTER (strategy = 'lines') AS by_lines, count(*) FILTER (strategy = 'text') AS by_text
FROM (SELECT DISTINCT coalesce(source, '') AS source FROM documents) s LEFT JOIN ga USING (source) GROUP BY 1""")
def table_report(spark, d):
    return reports.table_report(_tables(spark, d), _sourced(spark, d), "source", "doc_id", "strategy")[0]


@expects(lambda: f"""WITH {_grid_sql()} SELECT 'documents' AS measure, '' AS key, count(DISTINCT coalesce(source, ''))::double AS value FROM documents UNION ALL SELECT 'documents_with_tables', '', count(DISTINCT source) FROM ga
UNION ALL SELECT 'tables', '', count(*) FROM ga UNION ALL SELECT 'by_lines', '', count(*) FILTER (strategy = 'lines') FROM ga UNION ALL SELECT 'by_text', '', count(*) FILTER (strategy = 'text') FROM ga""")
def table_totals(spark, d):
    return reports.table_report(_tables(spark, d), _sourced(spark, d), "source", "doc_id", "strategy")[1]


@expects(lambda: f"WITH {_grid_sql()} SELECT source, count(*) AS tables, count(DISTINCT doc_id) AS pages_with_tables FROM ga GROUP BY 1 ORDER BY tables DESC, source LIMIT 10")
def top_tables(spark, d):
    per = reports.table_report(_tables(spark, d), _sourced(spark, d), "source", "doc_id", "strategy")[0]
    return per.filter("tables > 0").orderBy(F.col("tables").desc(), "source").limit(10).select("source", "tables", "pages_with_tables")


# ---- reports ----
def _chunk_splits(spark, d):
    """Chunks with the split of their records (the least where they are in several)."""
    of = _records(spark, d, "chunk_id", "split").withColumn("s", _split()).groupBy("chunk_id").agg(F.min("s").alias("_s"))
    return spread(table(spark, d, "chunks").drop("split")).join(of, "chunk_id", "left")


@expects(lambda: f"""WITH {o.records('chunk_id', 'split')}, g AS (SELECT chunk_id, min({o.split_of('split')}) AS s FROM r GROUP BY 1), b AS MATERIALIZED (SELECT *, {o.exam_noise('text')} AS bare FROM chunks),
x AS MATERIALIZED (SELECT b.*, s, {o.rejection('text')} AS reason FROM b LEFT JOIN g USING (chunk_id)), a AS (SELECT * FROM x WHERE reason = ''), n AS (SELECT s, count(*) AS n, count(DISTINCT pdf_id) AS d FROM a WHERE s IS NOT NULL GROUP BY 1),
e AS (SELECT 'document' AS m, pdf_id AS k, s FROM a UNION ALL SELECT 'topic', unnest(topics), s FROM a UNION ALL SELECT 'role', content_role, s FROM a UNION ALL SELECT 'doc_type', doc_type, s FROM a UNION ALL SELECT 'language', language, s FROM a)
SELECT 'candidates' AS measure, '' AS key, count(*)::double AS value FROM x UNION ALL SELECT 'accepted', '', count(*) FROM a UNION ALL SELECT 'mean_tokens', '', round(avg(token_estimate), 2) FROM a
UNION ALL SELECT 'rejected', reason, count(*) FROM x WHERE reason <> '' GROUP BY ALL UNION ALL SELECT 'records', s, n FROM n UNION ALL SELECT 'documents', s, d FROM n UNION ALL SELECT 'ratio', s, round(n / (SELECT sum(n) FROM n)::double, 4) FROM n
UNION ALL SELECT 'leakage_documents', '', count(*) FROM (SELECT pdf_id FROM a WHERE s IS NOT NULL GROUP BY 1 HAVING count(DISTINCT s) > 1)
UNION ALL SELECT m, coalesce(k, 'unknown'), count(*) FROM e GROUP BY ALL UNION ALL SELECT m || ':' || s, coalesce(k, 'unknown'), count(*) FROM e WHERE s IS NOT NULL GROUP BY ALL""")
def build_report(spark, d):
    return reports.build_report(_chunk_splits(spark, d), ch.reject_reason("text", F.col("token_estimate"), F.col("clinical_score")), F.col("_s"), "pdf_id")


@expects(lambda: f"""WITH {o.records('chunk_id', 'split', 'topics')}, x AS (SELECT regexp_extract(chunk_id, '^(.*)_[0-9]+$', 1) AS pdf_id, {o.split_of('split')} AS s, topics FROM r),
y AS (SELECT x.*, c.language FROM x LEFT JOIN (SELECT pdf_id, min(language) AS language FROM chunks GROUP BY 1) c USING (pdf_id) WHERE s IS NOT NULL), p AS (SELECT pdf_id, list_distinct(list(s)) AS l FROM y GROUP BY 1),
e AS (SELECT 'topic' AS m, unnest(topics) AS k, s FROM y UNION ALL SELECT 'language', language, s FROM y), v AS (SELECT unnest(['train', 'validation', 'test']) AS s)
SELECT 'pages' AS measure, '' AS key, count(*)::double AS value FROM documents UNION ALL SELECT 'documents_with_pages', '', count(DISTINCT source) FROM documents
UNION ALL SELECT 'pages_needing_ocr', '', count(*) FILTER (q.needs_ocr) FROM (SELECT unnest(page_ocr_status) AS q FROM inventory) UNION ALL SELECT 'chunks', '', count(*) FROM chunks UNION ALL SELECT 'mean_tokens', '', round(avg(coalesce(token_estimate, 0)), 2) FROM chunks
UNION ALL SELECT 'records:' || v.s, '', count(y.s) FROM v LEFT JOIN y USING (s) GROUP BY v.s UNION ALL SELECT 'documents:' || s, '', (SELECT count(*) FROM p WHERE list_contains(l, s)) FROM v UNION ALL SELECT 'overlapping_documents', '', count(*) FILTER (len(l) > 1) FROM p
UNION ALL SELECT 'chunks_of', coalesce(source_pdf, 'unknown'), count(*) FROM chunks GROUP BY ALL UNION ALL SELECT m, coalesce(k, 'unknown'), count(*) FROM e GROUP BY ALL UNION ALL SELECT m || ':' || s, coalesce(k, 'unknown'), count(*) FROM e GROUP BY ALL
UNION ALL SELECT 'doc_type', coalesce(doc_type, 'unknown'), count(*) FROM inventory GROUP BY ALL UNION ALL SELECT 'inclusion', coalesce(inclusion_status, 'unknown'), count(*) FROM inventory GROUP BY ALL UNION ALL SELECT 'ocr', coalesce(ocr_status.status, 'unknown'), count(*) FROM inventory GROUP BY ALL
UNION ALL SELECT 'exclusion', coalesce(exclusion_reason, 'unknown'), count(*) FROM inventory WHERE inclusion_status = 'excluded_with_reason' GROUP BY ALL""")
def audit_report(spark, d):
    of = table(spark, d, "chunks").groupBy(F.col("pdf_id").alias("_p")).agg(F.min("language").alias("language"))
    rows = _records(spark, d, "chunk_id", "split", "topics").withColumn("pdf_id", F.regexp_extract("chunk_id", "^(.*)_[0-9]+$", 1)).join(of, F.col("pdf_id") == F.col("_p"), "left")
    return reports.audit_report(_documents(spark, d), table(spark, d, "chunks"), rows, table(spark, d, "inventory"), _split(), "pdf_id")


@expects(lambda: f"""WITH {o.records('split')}, c AS (SELECT coalesce(language, 'unknown') AS language, count(*) AS n FROM chunks GROUP BY 1 UNION ALL SELECT coalesce(lang, 'unknown'), count(*) FROM documents GROUP BY 1)
SELECT language, sum(n)::bigint AS n FROM c GROUP BY 1""")
def multiset_sum(spark, d):
    """Languages of chunks and of documents, counted together."""
    one = table(spark, d, "chunks").groupBy(F.coalesce("language", F.lit("unknown")).alias("language")).agg(F.count(F.lit(1)).alias("n"))
    two = _documents(spark, d).groupBy(F.coalesce("lang", F.lit("unknown")).alias("language")).agg(F.count(F.lit(1)).alias("n"))
    return reports.multiset_sum(one.unionByName(two), ["language"])


@expects("SELECT '{' || string_agg('\"' || doc_type || '\": ' || n, ', ' ORDER BY doc_type) || '}' AS doc_types FROM (SELECT coalesce(doc_type, 'unknown') AS doc_type, count(*) AS n FROM inventory GROUP BY 1)")
def sorted_map(spark, d):
    counts = table(spark, d, "inventory").groupBy("doc_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(reports.sorted_map(counts, "doc_type", "n").alias("doc_types"))


def _grounded_sql() -> str:
    word = lambda c: f"list_distinct(regexp_extract_all(lower(coalesce({c}, '')), {o.q(tx.WORD)}))"
    return f"coalesce(len(list_intersect({word('contexto_fuente')}, {word('respuesta')}))::double / nullif(len({word('contexto_fuente')}), 0), 0)"


@expects(lambda: f"""WITH {o.records('chunk_id', 'contexto_fuente', 'respuesta', *lx.QUALITY_FIELDS[:4])}, g AS (SELECT chunk_id, {_grounded_sql()} AS o FROM r), c AS (SELECT chunk_id, count(*) AS pairs, floor(round(avg(o) * 10000, 6) + 0.5) / 10000 AS overlap, count(*) FILTER (o < 0.15) AS low FROM g GROUP BY 1),
q AS (SELECT * FROM r WHERE faithfulness IS NOT NULL)
SELECT 'overlap' AS measure, '' AS key, round(sum(overlap * pairs) / sum(pairs), 4)::double AS value FROM c UNION ALL SELECT 'low_pairs', '', sum(low) FROM c UNION ALL SELECT 'pairs', '', sum(pairs) FROM c
UNION ALL SELECT 'low_rate', '', round(sum(low) / sum(pairs)::double, 4) FROM c UNION ALL SELECT 'evaluated', '', count(*) FROM q UNION ALL SELECT 'acceptance', '', round(avg((coalesce(quality_verdict, '') = 'accept')::int), 4) FROM q
UNION ALL SELECT 'mean_faithfulness', '', round(avg(faithfulness), 4) FROM q UNION ALL SELECT 'mean_answer_relevancy', '', round(avg(answer_relevancy), 4) FROM q UNION ALL SELECT 'mean_roundtrip_consistency', '', round(avg(roundtrip_consistency), 4) FROM q""")
def generation_rollup(spark, d):
    rows = _records(spark, d, "chunk_id", "contexto_fuente", "respuesta", *lx.QUALITY_FIELDS[:4])
    return reports.generation_rollup(qa.grounding_by_chunk(rows, "chunk_id", "contexto_fuente", "respuesta"), rows, "quality_verdict", lx.QUALITY_FIELDS[:3])


@expects(lambda: f"""WITH {o.records('faithfulness', 'answer_relevancy', 'quality_reason')} SELECT 'evaluated' AS measure, '' AS key, count(*)::double AS value FROM r UNION ALL SELECT 'with_error', '', count(*) FILTER (coalesce(quality_reason, '') <> '') FROM r
UNION ALL SELECT 'mean_faithfulness', '', round(avg(faithfulness), 4) FROM r UNION ALL SELECT 'mean_answer_relevancy', '', round(avg(answer_relevancy), 4) FROM r""")
def predictions_summary(spark, d):
    return reports.predictions_summary(_records(spark, d, "faithfulness", "answer_relevancy", "quality_reason"), ("faithfulness", "answer_relevancy"), "quality_reason")


@expects(lambda: f"WITH {o.records('split')} SELECT {o.split_of('split')} AS split, count(*) AS raw, count(*) AS sft, count(*) AS grounded, true AS equal FROM r GROUP BY 1")
def variant_check(spark, d):
    rows = _records(spark, d, "pregunta", "respuesta", "contexto_fuente", "split").withColumn("split", _split())
    sft = rows.select("split", qa.sft_messages(F.lit("Responde."), F.col("pregunta"), F.col("respuesta")).alias("m"), "contexto_fuente")
    return reports.variant_check({"raw": rows, "sft": sft, "grounded": sft.select("split", qa.grounded_messages(F.col("m"), F.col("contexto_fuente")))}, "split")


@expects(lambda: f"WITH {o.records('respuesta')} " + " UNION ALL ".join(f"SELECT {i} AS pattern, count(*) FILTER (regexp_matches(lower(coalesce(respuesta, '')), {o.q(p)})) AS n FROM r" for i, p in enumerate(lx.META_ANSWERS)))
def meta_reference_counts(spark, d):
    return reports.meta_reference_counts(_records(spark, d, "respuesta"), "respuesta", lx.META_ANSWERS)


# ---- incremental runs ----
@expects("""WITH i AS (SELECT source_path, source_pdf, row_number() OVER (ORDER BY pdf_id) % 5 AS k FROM inventory)
SELECT source_path, source_pdf, 'old' AS batch FROM i WHERE k NOT IN (0, 1) UNION ALL SELECT source_path, 'renamed-' || source_pdf, 'new' FROM i WHERE k = 0 UNION ALL SELECT 'moved/' || source_path, source_pdf, 'new' FROM i WHERE k = 1""")
def replaced_by_path_or_name(spark, d):
    """Files that are known by another name, or by another path: both take the place of their old rows."""
    rows = ch.ranked(table(spark, d, "inventory").select("pdf_id", "source_path", "source_pdf"), [], [F.col("pdf_id").asc()], "k").withColumn("k", F.col("k") % 5)
    old = rows.select("source_path", "source_pdf", F.lit("old").alias("batch"))
    renamed = rows.filter("k = 0").select("source_path", F.concat(F.lit("renamed-"), "source_pdf").alias("source_pdf"), F.lit("new").alias("batch"))
    moved = rows.filter("k = 1").select(F.concat(F.lit("moved/"), "source_path").alias("source_path"), "source_pdf", F.lit("new").alias("batch"))
    return incremental.replaced(old, renamed.unionByName(moved), "source_path", "source_pdf")


@expects("SELECT a.doc_id, b.page AS raw_page FROM documents a JOIN documents b USING (doc_id) WHERE b.page IS NOT NULL AND b.doc_id % 2 = 0 UNION ALL SELECT doc_id, NULL FROM documents WHERE doc_id % 2 = 1 OR page IS NULL")
def suffix_join(spark, d):
    """Reports and the raw files of the same run, told by the end of their names; a report without one stays."""
    rows = _documents(spark, d)
    left = rows.select("doc_id", F.concat(F.lit("runs/report_"), "doc_id", F.lit(".json")).alias("path"))
    right = rows.filter("doc_id % 2 = 0").select("page", F.concat(F.lit("raw/raw_"), "doc_id", F.lit(".jsonl")).alias("path"))
    return records.joined_by_suffix(left, right, "path").select("doc_id", F.col("page").alias("raw_page"))


@expects("SELECT source_path, file_size FROM inventory WHERE source_pdf IN (SELECT source FROM documents)")
def bootstrap_manifest(spark, d):
    known = table(spark, d, "inventory").select("source_path", "source_pdf", "file_size")
    return incremental.bootstrapped(known, _documents(spark, d).select(F.col("source").alias("source_pdf")), "source_pdf").select("source_path", "file_size")


@expects("SELECT i.source_path, CASE WHEN p.source_path IS NULL THEN 'new' ELSE 'changed' END AS change FROM inventory i LEFT JOIN processed_files p USING (source_path) WHERE p.source_path IS NULL OR p.file_size IS DISTINCT FROM i.file_size OR p.mtime_ns % 2 = 1")
def changed_by_time(spark, d):
    """Files whose size or time differs; every file whose known time is odd counts as touched since."""
    state = table(spark, d, "processed_files")
    now = table(spark, d, "inventory").select("source_path", "source_pdf", "file_size").join(state.select("source_path", (F.col("mtime_ns") + F.col("mtime_ns") % 2).alias("mtime_ns")), "source_path", "left")
    return incremental.changed_files(now, state, fields=("file_size", "mtime_ns")).select("source_path", "change")


@expects(lambda: f"""WITH {o.records('quality_verdict')}, s AS (SELECT CASE quality_verdict WHEN 'accept' THEN 'ok' WHEN 'reject' THEN 'failed' END AS s FROM r)
SELECT count(*) FILTER (s = 'ok') AS done, count(*) FILTER (s = 'failed') AS failed, count(*) FILTER (s = 'ok') AS ok, 0::bigint AS empty, 0::bigint AS refused, 100000 - count(*) FILTER (s = 'ok') AS pending,
count(*) FILTER (s = 'ok') / 60.0::double AS per_second, (100000 - count(*) FILTER (s = 'ok')) / (count(*) FILTER (s = 'ok') / 60.0::double) AS seconds_left FROM s""")
def run_progress(spark, d):
    rows = _records(spark, d, "quality_verdict").select(F.when(F.col("quality_verdict") == "accept", "ok").when(F.col("quality_verdict") == "reject", "failed").alias("status"))
    return progress(rows, "status", 100_000, 60.0)


# ---- judging, with a judge that compares words ----
def _judged_sql() -> str:
    word = lambda c: f"list_distinct(regexp_extract_all(lower({c}), {o.q(tx.WORD)}))"
    share = lambda a, b: f"coalesce(len(list_intersect({word(a)}, {word(b)}))::double / nullif(len({word(a)}), 0), 0)"
    return f"""{o.records('pregunta', 'respuesta', 'contexto_fuente')}, w AS (SELECT qa_id, coalesce(pregunta, '') AS q, coalesce(respuesta, '') AS a, coalesce(contexto_fuente, '') AS c FROM r),
j AS (SELECT qa_id, {share('a', 'c')} AS f, {share('q', 'a')} AS v, {share('a', "string_split(c, '. ')[1]")} AS t FROM w)"""


@expects(lambda: f"WITH {_judged_sql()} SELECT qa_id, f AS faithfulness, v AS answer_relevancy, NULL::varchar AS error FROM j")
def answers_evaluated(spark, d):
    rows = _records(spark, d, "pregunta", "respuesta", "contexto_fuente")
    return evaluation.evaluated(rows, "qa_id", ("pregunta", "respuesta", "contexto_fuente"), evaluation.word_judge, ("faithfulness", "answer_relevancy"))


@expects(lambda: f"WITH {_judged_sql()} SELECT qa_id, f AS faithfulness, v AS answer_relevancy, t AS roundtrip_consistency, CASE WHEN f >= 0.2 THEN 'accept' ELSE 'reject' END AS quality_verdict, 'words' AS quality_reason FROM j")
def pair_quality(spark, d):
    rows = _records(spark, d, "pregunta", "respuesta", "contexto_fuente")
    return evaluation.pair_quality(rows, "qa_id", ("pregunta", "respuesta", "contexto_fuente"), evaluation.word_judge)


@expects(lambda: f"WITH {_judged_sql()} SELECT qa_id, f AS faithfulness, v AS answer_relevancy, CASE WHEN len(regexp_extract_all(a, {o.q(tx.WORD)})) > 0 THEN 1.0::double ELSE 0 END AS answer_correctness, NULL::varchar AS error FROM j JOIN w USING (qa_id)")
def predictions_evaluated(spark, d):
    """Every answer as its own reference."""
    rows = _records(spark, d, "pregunta", "respuesta", "contexto_fuente")
    return evaluation.predictions_evaluated(rows, "qa_id", evaluation.word_judge, "respuesta", "respuesta").drop("semantic_similarity")


