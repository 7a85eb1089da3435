"""What the queries must give, as SQL for DuckDB. Patterns and word lists are the fixed values of the core; the rest is
written for itself."""

from __future__ import annotations

from tamiz.functions import lexicon as lx
from tamiz.functions import text as tx


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def full(t: str) -> str:
    return f"coalesce({t}, '')"


def plain(t: str) -> str:
    return f"strip_accents({full(t)})"


def norm(t: str) -> str:
    x = f"translate({plain(t)}, {q(tx.COMPATIBLE)}, {q(tx.ASCII)})"
    for a, b in tx.LIGATURES:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"


def sub(t: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({t}, {q(pattern)}, {q(by)}, 'g')"


def has(t: str, pattern: str) -> str:
    return f"regexp_matches({t}, {q(pattern)})"


def count(t: str, pattern: str) -> str:
    return f"len(regexp_extract_all({full(t)}, {q(pattern)}))"


def strip(t: str) -> str:
    return sub(t, f"^{tx.WS}+|{tx.WS}+$")


def words(t: str) -> str:
    return count(t, tx.WORD)


def tokens(n: str) -> str:
    return f"greatest(1, ceil({n} * 1.35::double))::int"


def lines(t: str) -> str:
    return f"regexp_split_to_array({full(t)}, {q(tx.SPLIT_LINES)})"


def nonblank(t: str) -> str:
    return f"[x FOR x IN [{strip('y')} FOR y IN {lines(t)}] IF x <> '']"


def among(x: str, values) -> str:
    return f"{x} IN ({', '.join(map(q, values))})"


def contained(t: str, terms) -> str:
    return "(" + " + ".join(f"contains({t}, {q(x)})::int" for x in terms) + ")"


def any_of(t: str, terms) -> str:
    return f"({contained(t, terms)} > 0)"


def ratio_references(t: str) -> str:
    ls = nonblank(plain(t))
    return f"coalesce(len([z FOR z IN {ls} IF {has('z', tx.REFERENCE)}])::double / nullif(len({ls}), 0), 0)"


def markers(t: str) -> str:
    return (
        f"({count(plain(t), tx.REFERENCE)} + {count(t, tx.URL)} + {count(t, tx.BROKEN_URL)} + {count(t, tx.DOI)}"
        f" + {count(plain(t), '(?i)' + chr(92) + 'b(?:referencias|bibliografia)' + chr(92) + 'b')})"
    )


def suspicious(t: str) -> str:
    weird = f"length({t}) - length(translate({t}, {q(lx.WEIRD_CHARACTERS)}, ''))"
    quotes = f"""length({t}) - length(replace({t}, '"', ''))"""
    return f"CASE WHEN {full(t)} = '' THEN 0 ELSE ({weird} + greatest(0, {quotes} - 4))::double / length({t}) END"


def numeric(t: str) -> str:
    return f"coalesce({count(t, tx.NWS + '*[0-9]' + tx.NWS + '*')}::double / nullif({count(t, tx.NWS + '+')}, 0), 0)"


def decimals(t: str) -> str:
    return count(t, r"\b[0-9]+[.,][0-9]+\b")


def score(n: str, w: str, r: str) -> str:
    hits = " + ".join(f"{2 if ' ' in t else 1} * contains({n}, {q(t)})::int" for t in lx.CLINICAL_TERMS)
    acts = " + ".join(f"contains({n}, {q(t)})::int" for t in lx.ACTION_TERMS)
    return f"greatest(0, {hits} + {acts} + CASE WHEN {w} >= 350 THEN 4 WHEN {w} >= 120 THEN 2 ELSE 0 END - CASE WHEN {r} >= 0.35 THEN 3 ELSE 0 END)::int"


def noise(line: str) -> str:
    p, n = plain(line), norm(line)
    person = f"({has(line, tx.SURNAME)} AND {count(line, tx.NWS + '+')} > 5 AND NOT {has(n, '|'.join(lx.CLINICAL_TERMS))})"
    tests = [has(line, x) for x in (tx.BROKEN_URL, tx.URL, tx.EMAIL, tx.DOI)] + [has(p, tx.PHONE), has(p, tx.ADMIN)]
    numbered = f"({has(line, '^ *[0-9]{1,3}' + chr(92) + '. +')} AND {has(p, tx.REFERENCE)})"
    return "(" + " OR ".join([among(n, lx.DROP_HEADINGS), *tests, numbered, person]) + ")"


def heading(line: str) -> str:
    b = sub(line, "^[ :-]+|[ :-]+$")
    n, letters, small = norm(b), count(b, r"\p{L}"), count(b, r"\p{Ll}")
    many = count(b, tx.NWS + "+")
    start = has(n, r"^(capitulo|cap|tema|seccion|anexo)\b")
    return (
        f"({b} <> '' AND length({b}) <= 110 AND {many} <= 14 AND ({among(n, (*lx.DROP_HEADINGS, *lx.INDEX_TERMS))} OR {start}"
        f" OR ({has(b, tx.SECTION_NUMBER)} AND {many} <= 12) OR ({letters} >= 6 AND {letters} - {small} >= {letters} * 0.72::double)))"
    )


def clean(t: str) -> str:
    """A query expression: lines are cleaned one by one in a list."""
    x = sub(full(t), tx.LINE_BREAK, "\n")
    x = sub(x, r"[\x{FEFF}\x{200B}\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}]")
    for pattern in (tx.BROKEN_URL, tx.URL, tx.DOI, tx.EMAIL):
        x = sub(x, pattern)
    x = sub(x, rf"([{tx.LETTER}])- *\n *([{tx.LETTER}])", r"\1\2")
    x = sub(sub(x, "[•◦▪·]", "- "), r"[ \t]+", " ")
    keep = f"z = '' OR NOT ({has('z', tx.PAGE_NUMBER)} OR {has('z', tx.PAGE_LABEL)} OR {noise('z')})"
    x = f"array_to_string([z FOR z IN [{strip('y')} FOR y IN string_split({x}, chr(10))] IF {keep}], chr(10))"
    return strip(f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def exam_noise(t: str) -> str:
    x = full(t)
    for pattern in (tx.EXAM_HEADER, tx.ANSWER_NUMBERED, tx.ANSWER_PLAIN):
        x = sub(x, pattern, " ")
    dense = f"length({sub('z', '[.0-9]|' + tx.WS)}) < 40"
    return f"array_to_string([z FOR z IN {nonblank(x)} IF NOT ({has('z', chr(92) + '.{4,}')} AND (length(z) >= 40 OR {dense}))], chr(10))"


def split_of(s: str) -> str:
    return f"CASE WHEN lower(trim({s})) IN ('train','training') THEN 'train' WHEN lower(trim({s})) IN ('validation','valid','val','dev') THEN 'validation' WHEN lower(trim({s})) IN ('test','testing') THEN 'test' END"


def records(*columns: str) -> str:
    """Rows of raw, the earliest delivery of each qa_id."""
    return f"r AS (SELECT qa_id, {', '.join(columns)} FROM raw WHERE qa_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY qa_id ORDER BY row_no) = 1)"


def cases(rules, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {q(n)}" for n, c in rules) + f" ELSE {otherwise} END"


def document_type(name: str, text: str) -> str:
    low, sample = f"lower({full(name)})", f"substring(lower({full(text)}), 1, 5000)"
    s = {k: contained(sample, v) for k, v in lx.TEXT_TYPES.items()}
    best = f"greatest({', '.join(s.values())})"
    rules = [(k, any_of(low, v)) for k, v in lx.NAME_TYPES.items()] + [(k, f"{best} >= 2 AND {x} = {best}") for k, x in s.items()]
    return cases([*rules, ("book", any_of(low, lx.CHAPTER_WORDS))], "'unknown'")


def language(t: str) -> str:
    w = f"string_split({norm(t)}, ' ')"
    es, en = (f"len([w FOR w IN {w} IF {among('w', m)}])" for m in (lx.SPANISH_MARKERS, lx.ENGLISH_MARKERS))
    return f"CASE WHEN {es} = 0 AND {en} = 0 THEN 'unknown' WHEN {es} >= {en} THEN 'es' ELSE 'en' END"


def rejection(t: str, min_score: int = 4) -> str:
    tok, sc = "token_estimate", "clinical_score"
    return cases([
        ("too_short_after_noise_cleanup", f"{tokens(words('bare'))} < 180"), ("too_short", f"{tok} < 180"), ("low_clinical_score", f"{sc} < {min_score}"),
        ("reference_heavy", f"{ratio_references(t)} >= 0.45 OR {markers(t)} >= 4"), ("corrupt_extraction", f"{suspicious(t)} >= 0.012"),
        ("admin_or_contact_text", any_of(norm(t), lx.ADMIN_TERMS)), ("numeric_or_table_heavy", f"({numeric(t)} >= 0.38 OR {decimals(t)} >= 12) AND {sc} < 9"),
        ("exam_answer_key", has("bare", tx.ANSWER_KEY)), ("toc_or_layout_noise", f"{has(full(t), chr(92) + '.{4,}')} AND {sc} < 10"),
    ], "''")


def page_sql() -> str:
    """Documents as classified pages: ``pages``."""
    lead = r"\.{3,}\s*[0-9]+$"
    n = norm("substring(cleaned, 1, 2500)")
    reason = cases([
        ("too_short", "char_count < 180 OR word_count < 25"), ("corrupt_extraction", "suspicious >= 0.018"),
        ("cover_or_credits", f"page <= 2 AND {any_of('start', ('isbn', 'copyright', 'editorial'))} AND clinical_score < 3"),
        ("non_clinical_section", f"len([x FOR x IN ls[1:15] IF {among(norm('x'), lx.DROP_HEADINGS)}]) > 0"),
        ("index_or_table_of_contents", f"{any_of('substring(start, 1, 800)', lx.INDEX_TERMS)} AND (len([x FOR x IN ls IF {has('x', lead)}]) >= 3 OR clinical_score < 4)"),
        ("non_clinical_section", " OR ".join(f"starts_with(start, {q(t)})" for t in lx.DROP_HEADINGS)), ("reference_heavy", "rr >= 0.45 AND clinical_score < 6"),
        ("reference_heavy", "reference_marker_count >= 5 AND clinical_score < 10"),
        ("fragmented_text", "line_count >= 12 AND len([x FOR x IN ls IF length(x) <= 28]) >= line_count * 0.72::double AND clinical_score < 5"),
    ], "''")
    return f"""c AS MATERIALIZED (SELECT doc_id, source, page, {clean('text')} AS cleaned FROM documents),
m AS MATERIALIZED (SELECT *, {norm('cleaned')} AS n, {words('cleaned')} AS w, {ratio_references('cleaned')} AS rr, {nonblank('cleaned')} AS ls, {n} AS start FROM c),
k AS MATERIALIZED (SELECT *, length(cleaned)::int AS char_count, w::int AS word_count, len(ls)::int AS line_count, {score('n', 'w', 'rr')} AS clinical_score,
  {suspicious('cleaned')} AS suspicious, {markers('cleaned')}::int AS reference_marker_count FROM m),
pages AS MATERIALIZED (SELECT *, {reason} AS drop_reason FROM k)"""


def sql(repeated: float) -> dict[str, str]:
    doc = lambda expr: f"SELECT doc_id, {expr} FROM documents"
    scored = f"d AS MATERIALIZED (SELECT doc_id, text, {norm('text')} AS n, {words('text')} AS w, {ratio_references('text')} AS rr FROM documents), s AS MATERIALIZED (SELECT *, {score('n', 'w', 'rr')} AS score, {tokens('w')} AS tokens FROM d)"
    flags = [
        ("short_chunk", "tokens < 180"), ("long_chunk", "tokens > 1500"), ("low_clinical_score", "score < 5"), ("reference_heavy", "rr >= 0.3"),
        ("reference_markers", f"{markers('text')} >= 4"), ("corrupt_extraction", f"{suspicious('text')} >= 0.012"),
        ("numeric_or_table_heavy", f"{numeric('text')} >= 0.38"), ("decimal_table_like", f"{decimals('text')} >= 12"),
        ("low_vocabulary_variety", "len(list_distinct([w FOR w IN string_split(n, ' ') IF w <> ''])) < 35"),
    ]
    lined = f"l AS MATERIALIZED (SELECT doc_id, unnest({nonblank('text')}) AS line FROM documents)"
    sections = {k: v for k, v in lx.SECTION_TYPES.items()}
    types = cases([(k, any_of(x, v)) for x in ("head", "start") for k, v in sections.items()] + [("clinical_content", "first >= 5")], "'unknown'")
    roles = {
        r: f"({contained('opening', v)} + CASE WHEN section_type IN ({', '.join(q(s) for s, x in lx.DEFAULT_ROLES.items() if x == r) or 'NULL'}) THEN 2 ELSE 0 END)"
        for r, v in lx.CONTENT_ROLES.items()
    }
    best = f"greatest({', '.join(roles.values())})"
    role = cases([*((r, f"{best} >= 2 AND {x} = {best}") for r, x in roles.items()), ("evidence", "sc >= 8"), ("background", "sc >= 4")], "'unknown'")
    half = "substring(coalesce(text, ''), 1, 500)"
    topic_count = " + ".join(any_of("n", v) + "::int" for v in lx.TOPICS.values())
    enriched = f"""e AS MATERIALIZED (SELECT chunk_id, text, {norm('text')} AS n, {words('text')} AS w, {ratio_references('text')} AS rr, {norm('section')} AS head,
  {norm(half)} AS sample, {norm("substring(coalesce(text, ''), 1, 2000)")} AS opening, {words(half)} AS sw, {ratio_references(half)} AS srr FROM chunks),
f AS MATERIALIZED (SELECT *, substring(sample, 1, 500) AS start, {score('n', 'w', 'rr')} AS sc, {score('sample', 'sw', 'srr')} AS first FROM e),
g AS MATERIALIZED (SELECT *, {types} AS section_type FROM f)"""
    near = norm("text")
    first240 = f"array_to_string(string_split({near}, ' ')[1:240], ' ')"
    repeats_of = lambda source, where: f"""rl AS MATERIALIZED (SELECT {source} AS source, doc_id, unnest([{strip('y')} FOR y IN {lines('text')}]) AS line, unnest(range(len({lines('text')}))) AS pos FROM documents WHERE {where}),
rs AS MATERIALIZED (SELECT *, CASE WHEN length({norm('line')}) < 4 OR {has(norm('line'), '^[0-9]+$')} THEN '' ELSE {norm('line')} END AS signature FROM rl),
rp AS MATERIALIZED (SELECT source, signature, count(DISTINCT doc_id) AS pages, arg_min(line, doc_id * 1000000 + pos) AS line FROM rs WHERE signature <> '' AND length(line) <= 120 GROUP BY ALL),
rr AS (SELECT rp.* FROM rp JOIN (SELECT {source} AS source, count(*) AS n FROM documents GROUP BY 1) t USING (source) WHERE pages >= greatest(3, ceil(n * {repeated}::double)))"""  # noqa: E731
    heads = f"h AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, page, [z FOR z IN ({lines('text')})[1:10] IF {heading('z')} AND NOT {among(norm('z'), lx.INDEX_TERMS)}][1] AS hd FROM documents)"
    w240 = "array_to_string(string_split(trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9áéíóúüñ]', ' ', 'g'), ' +', ' ', 'g')), ' ')[1:240], ' ')"
    low_ws = f"array_to_string(string_split(lower(trim(regexp_replace(t, {q(tx.WS + '+')}, ' ', 'g'))), ' ')[1:240], ' ')"
    gate = " OR ".join(f"coalesce({c} < {v}, false)" for c, v in lx.QUALITY_GATE.items())
    slug = "CASE WHEN s = '' THEN 'document' ELSE s END"
    stem = lambda c: f"replace({norm(f'regexp_replace({c}, {q(chr(92) + chr(46) + chr(91) + chr(94) + chr(46) + chr(93) + chr(43) + chr(36))}, {q(str())})')}, ' ', '_')"
    tokens_q, tokens_a = count("pregunta", tx.NWS + "+"), count("respuesta", tx.NWS + "+")
    pairs = "least(greatest(CASE WHEN clinical_score >= 20 THEN least(n + 1, 5) ELSE n END, 2), 5)"
    n_pairs = "CASE WHEN token_estimate < 400 THEN 2 WHEN token_estimate < 700 THEN 3 ELSE 4 END"
    message = "'system=Responde.|user=' || {u} || '|assistant=' || coalesce(respuesta, '')"
    asked = "'Contexto fuente:' || chr(10) || trim(coalesce(contexto_fuente, '')) || chr(10) || chr(10) || 'Pregunta:' || chr(10) || coalesce(pregunta, '')"
    meta = lambda c: any_of(f"lower(coalesce({c}, ''))", lx.META_PATTERNS)
    word_list = lambda c: f"list_distinct(regexp_extract_all(lower(coalesce({c}, '')), {q(tx.WORD)}))"
    grounded = f"coalesce(len(list_intersect({word_list('contexto_fuente')}, {word_list('respuesta')}))::double / nullif(len({word_list('contexto_fuente')}), 0), 0)"
    prices = ", ".join(f"('{m}', {i}::double, {o}::double)" for m, (i, o) in lx.PRICES.items())
    sample_markers = contained("lower(coalesce(text_sample, ''))", lx.SAMPLE_MARKERS)
    signals = " + ".join(f"contains(low, ' {w} ')::int" for w in lx.SPANISH_SIGNALS)
    density = f"[w FOR w IN string_split({norm('text')}, ' ') IF w <> '']"
    out = {
        "text_normalize": doc(f"{norm('text')} AS norm"),
        "text_slugify": f"SELECT pdf_id, {slug} AS slug FROM (SELECT pdf_id, {stem('source_pdf')} AS s FROM inventory)",
        "word_and_token_counts": doc(f"{words('text')}::int AS words, {tokens(words('text'))} AS tokens"),
        "clean_text_chain": doc(f"{clean('text')} AS cleaned"),
        "lm_text": f"WITH c AS MATERIALIZED ({doc(clean('text') + ' AS t')}) SELECT doc_id, trim({sub('t', tx.WS + '+', ' ')}) AS lm FROM c",
        "noise_line_flags": f"WITH {lined} SELECT doc_id, count(*) AS lines, count(*) FILTER ({noise('line')}) AS noise FROM l GROUP BY 1",
        "heading_lines": f"WITH {lined} SELECT doc_id, count(*) FILTER ({heading('line')}) AS headings FROM l GROUP BY 1",
        "reference_ratio_and_markers": doc(f"{ratio_references('text')} AS ratio, {markers('text')}::int AS markers"),
        "suspicious_and_numeric_ratios": doc(f"{suspicious('text')} AS suspicious, {numeric('text')} AS numeric, {decimals('text')}::int AS decimals"),
        "lexicon_score": f"WITH {scored} SELECT doc_id, score FROM s",
        "quality_flags": f"WITH {scored} SELECT doc_id, array_to_string([x FOR x IN [{', '.join(f'CASE WHEN {c} THEN {q(n)} END' for n, c in flags)}] IF x IS NOT NULL], ',') AS flags FROM s",
        "strip_lm_noise": doc(f"{exam_noise('text')} AS stripped"),
        "detect_language": doc(f"{language('text')} AS detected"),
        "language_confusion": f"SELECT coalesce(lang, 'unknown') AS lang, {language('text')} AS detected, count(*) AS n FROM documents GROUP BY ALL",
        "looks_spanish": f"WITH d AS (SELECT doc_id, ' ' || lower(coalesce(text, '')) || ' ' AS low FROM documents) SELECT doc_id, {signals} + CASE WHEN regexp_matches(low, '[áéíóúñü]') THEN 2 ELSE 0 END >= 4 AS spanish FROM d",
        "clinical_density": doc(f"coalesce(len([w FOR w IN {density} IF {among('w', lx.DENSITY_TERMS)}])::double / nullif(len({density}), 0), 0) AS density"),
        "document_fingerprint": f"SELECT pdf_id, array_to_string([w FOR w IN string_split({norm('text_sample')}, ' ') IF length(w) > 3][1:100], ' ') AS fingerprint FROM inventory",
        "doc_type_classify": f"SELECT pdf_id, {document_type('source_pdf', 'text_sample')} AS doc_type FROM inventory",
        "meta_reference_flags": f"WITH {records('pregunta', 'respuesta')} SELECT qa_id, {meta('pregunta')} AS question_meta, {meta('respuesta')} AS answer_meta, {count('pregunta', '[?¿]')}::int AS question_marks, {tokens_a}::int AS answer_words FROM r",
        "llm_json_parse": f"WITH {records('faithfulness', 'quality_verdict')} SELECT qa_id, faithfulness AS score, quality_verdict AS verdict FROM r",
        "enrich_chunks": f"WITH {enriched} SELECT chunk_id, section_type, {role} AS content_role, {language('substring(text, 1, 4000)')} AS language, ({topic_count})::int AS topic_count FROM g",
        "topic_tags": f"WITH c AS MATERIALIZED (SELECT chunk_id, {norm('text')} AS n FROM chunks) " + " UNION ALL ".join(f"SELECT chunk_id, {q(t)} AS topic FROM c WHERE {any_of('n', v)}" for t, v in lx.TOPICS.items()),
        "accepted_for_lm_reasons": f"WITH c AS MATERIALIZED (SELECT *, {exam_noise('text')} AS bare FROM chunks) SELECT chunk_id, {rejection('text')} AS reason FROM c",
        "accepted_histogram": f"WITH c AS MATERIALIZED (SELECT *, {exam_noise('text')} AS bare FROM chunks), x AS (SELECT {rejection('text')} AS reason FROM c) SELECT reason, count(*) AS n FROM x GROUP BY 1",
        "dedupe_exact_near": f"SELECT chunk_id FROM (SELECT chunk_id, row_number() OVER (PARTITION BY {first240} ORDER BY coalesce(clinical_score, 0) DESC, coalesce(token_estimate, 0) DESC, source_pdf NULLS FIRST, chunk_id) AS k FROM chunks WHERE trim(coalesce(text, '')) <> '') WHERE k = 1",
        "dedupe_audit_cross_source": f"""WITH b AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS s, {strip(full('text'))} AS t FROM documents), x AS (SELECT *, {low_ws} AS near FROM b WHERE t <> ''),
e AS (SELECT s, row_number() OVER w AS k, first_value(s) OVER w AS own FROM x WINDOW w AS (PARTITION BY t ORDER BY doc_id)), n AS (SELECT s, row_number() OVER w AS k, first_value(s) OVER w AS own FROM x WINDOW w AS (PARTITION BY near ORDER BY doc_id))
SELECT 'exact' AS kind, count(*) FILTER (k > 1) AS detected, count(*) FILTER (s <> own) AS cross_source FROM e UNION ALL SELECT 'near', count(*) FILTER (k > 1), count(*) FILTER (s <> own) FROM n""",
        "chunk_ids": f"""WITH c AS (SELECT chunk_id AS old_id, {stem('source_pdf')} AS s, coalesce(list_min(pages), 0) AS p FROM chunks), d AS (SELECT old_id, {slug} AS s, p FROM c)
SELECT old_id, s || '_' || lpad((row_number() OVER (PARTITION BY s ORDER BY p, old_id))::varchar, 5, '0') AS chunk_id FROM d""",
        "filter_lm_chunks": f"SELECT chunk_id FROM chunks WHERE coalesce(content_role, 'unknown') NOT IN ({', '.join(map(q, lx.EXCLUDED_ROLES))}) AND lower(coalesce(language, 'unknown')) IN ('es', 'unknown')",
        "content_role_filter_stats": f"SELECT coalesce(content_role, 'unknown') AS role, count(*) AS n, {among('role', lx.TRAINING_ROLES)} AS kept FROM chunks GROUP BY ALL",
        "topic_coverage_ratio": f"WITH t AS (SELECT unnest(topics) AS topic, coalesce({among('content_role', lx.TRAINING_ROLES)}, false) AS k FROM chunks), s AS (SELECT topic, count(*) AS original, count(*) FILTER (k) AS filtered FROM t GROUP BY 1) SELECT *, filtered::double / original AS ratio, filtered::double / original < 0.3::double AS below FROM s",
        "pairs_per_chunk": f"WITH c AS (SELECT chunk_id, clinical_score, {n_pairs} AS n FROM chunks) SELECT chunk_id, ({pairs})::int AS pairs FROM c",
        "cost_estimate": f"""WITH c AS (SELECT token_estimate, clinical_score, {n_pairs} AS n FROM chunks), s AS (SELECT sum({pairs})::bigint AS pairs, sum(coalesce(token_estimate, 500))::bigint AS input_tokens FROM c)
SELECT model, pairs, input_tokens, pairs * {lx.OUTPUT_TOKENS_PER_PAIR} AS output_tokens, (input_tokens * i + pairs * {lx.OUTPUT_TOKENS_PER_PAIR} * o) / 1e6::double AS cost FROM s, (VALUES {prices}) p(model, i, o)""",
        "build_report_distributions": "SELECT 'pdf_id' AS dimension, pdf_id AS value, count(*) AS n FROM chunks GROUP BY ALL UNION ALL SELECT 'doc_type', doc_type, count(*) FROM chunks GROUP BY ALL UNION ALL SELECT 'content_role', content_role, count(*) FROM chunks GROUP BY ALL UNION ALL SELECT 'language', coalesce(language, 'unknown'), count(*) FROM chunks GROUP BY ALL UNION ALL SELECT 'topic', t, count(*) FROM (SELECT unnest(topics) AS t FROM chunks) GROUP BY ALL",
        "lm_record_validation": "SELECT chunk_id, 'empty text' AS error FROM chunks WHERE trim(coalesce(text, '')) = '' UNION ALL SELECT chunk_id, 'missing section' FROM chunks WHERE section IS NULL UNION ALL SELECT chunk_id, 'missing language' FROM chunks WHERE language IS NULL",
        "repeated_lines_by_source": f"WITH {repeats_of('source', 'source IS NOT NULL')} SELECT source, signature, line, pages FROM rr",
        "repeated_lines_removed": f"""WITH {repeats_of("coalesce(source, '')", 'true')}, x AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, unnest({lines('text')}) AS line, unnest(range(len({lines('text')}))) AS pos, len({lines('text')}) AS n FROM documents),
y AS MATERIALIZED (SELECT x.*, rr.signature IS NOT NULL AS gone FROM x LEFT JOIN rr ON x.source = rr.source AND rr.signature = CASE WHEN length({norm('x.line')}) < 4 OR {has(norm('x.line'), '^[0-9]+$')} THEN '' ELSE {norm('x.line')} END WHERE NOT (pos = n - 1 AND x.line = '')),
z AS (SELECT doc_id, count(*) FILTER (gone) AS removed, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS t FROM y GROUP BY 1)
SELECT d.doc_id, coalesce(removed, 0)::int AS removed_lines, length(coalesce({strip("regexp_replace(t, '\\n{3,}', chr(10) || chr(10), 'g')")}, ''))::int AS left_chars FROM documents d LEFT JOIN z USING (doc_id)""",
        "section_carry_forward": f"WITH {heads} SELECT doc_id, coalesce(last_value(nullif({sub('hd', '^[ :-]+|[ :-]+$')}, '') IGNORE NULLS) OVER (PARTITION BY source ORDER BY page, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS section FROM h",
        "page_classification": f"WITH {page_sql()} SELECT doc_id, char_count, word_count, line_count, clinical_score, reference_marker_count, drop_reason FROM pages",
        "page_drop_histogram": f"WITH {page_sql()} SELECT drop_reason, count(*) AS n FROM pages GROUP BY 1",
        "cleaning_report": f"WITH {page_sql()} SELECT 'total_pages' AS measure, count(*) AS n FROM pages UNION ALL SELECT 'kept_pages', count(*) FILTER (drop_reason = '') FROM pages UNION ALL SELECT 'dropped_pages', count(*) FILTER (drop_reason <> '') FROM pages UNION ALL SELECT 'drop:' || drop_reason, count(*) FROM pages WHERE drop_reason <> '' GROUP BY 1",
        "inclusion_status": f"""SELECT pdf_id, CASE WHEN page_count < 3 THEN 'empty' WHEN file_size < 1024 THEN 'corrupted' WHEN coalesce(text_sample, '') <> '' AND {count('text_sample', chr(10) + chr(10))}::double / greatest(1, length(text_sample)) > 0.8 THEN 'empty'
  WHEN length(coalesce(text_sample, '')) > 200 AND {sample_markers} < 3 THEN 'wrong_language' END AS reason,
CASE WHEN coalesce(page_count, 0) = 0 THEN 'unknown' WHEN coalesce(needs_ocr_pages, 0) = 0 THEN 'clean' WHEN needs_ocr_pages::double / page_count <= 0.2 THEN 'minor' WHEN needs_ocr_pages::double / page_count <= 0.5 THEN 'needs_ocr' ELSE 'dominated' END AS ocr FROM inventory""",
        "inclusion_evaluated": "SELECT pdf_id, CASE WHEN ocr_status.ocr_ratio > 0.5 THEN 'ocr_dominated' WHEN clinical_term_ratio < 0.1 THEN 'low_clinical_density' WHEN page_count < 3 THEN 'empty' END AS reason FROM inventory",
        "exclusion_report": """WITH x AS (SELECT coalesce(exclusion_reason, 'unknown') AS reason, pdf_id FROM inventory WHERE inclusion_status IN ('excluded', 'excluded_with_reason'))
SELECT reason, NULL::varchar AS document, count(*) AS n, count(*)::double / (SELECT count(*) FROM inventory) AS rate FROM x GROUP BY 1 UNION ALL SELECT reason, pdf_id, 1, NULL FROM x""",
        "manifest_histograms": "SELECT 'doc_type' AS dimension, doc_type AS value, count(*) AS n FROM inventory GROUP BY ALL UNION ALL SELECT 'ocr', ocr_status.status, count(*) FROM inventory GROUP BY ALL",
        "excluded_pages_antijoin": "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM inventory i WHERE i.source_pdf = d.source AND inclusion_status IN ('excluded', 'excluded_with_reason'))",
        "page_manifest_join": "SELECT doc_id, pdf_id, doc_type, inclusion_status, ocr_status.status AS ocr FROM documents d LEFT JOIN inventory i ON i.source_pdf = d.source",
        "audit_source_balance": "SELECT source, count(*) AS n, count(DISTINCT lang) AS languages FROM documents GROUP BY 1",
        "top_sources_topk": "SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1 ORDER BY n DESC, source LIMIT 10",
        "incremental_changed_files": "SELECT i.source_path, CASE WHEN p.source_path IS NULL THEN 'new' ELSE 'changed' END AS change FROM inventory i LEFT JOIN processed_files p USING (source_path) WHERE p.source_path IS NULL OR p.file_size IS DISTINCT FROM i.file_size",
        "manifest_upsert": "SELECT source_path, file_size, 0::bigint AS mtime_ns FROM inventory UNION ALL SELECT source_path, file_size, mtime_ns FROM processed_files WHERE source_path NOT IN (SELECT source_path FROM inventory)",
        "incremental_upsert": "WITH c AS (SELECT i.source_pdf FROM inventory i LEFT JOIN processed_files p USING (source_path) WHERE p.source_path IS NULL OR p.file_size IS DISTINCT FROM i.file_size), x AS (SELECT source, CASE WHEN source IN (SELECT source_pdf FROM c) THEN 'new' ELSE 'old' END AS batch FROM documents) SELECT batch, count(*) AS n, count(DISTINCT source) AS sources FROM x GROUP BY 1",
        "incremental_append_chunks": f"""WITH b AS (SELECT doc_id, text, coalesce(source, '') AS source, {first240} AS k, {w240} AS k2 FROM documents WHERE text IS NOT NULL AND trim(regexp_replace(text, {q(tx.WS + '+')}, ' ', 'g')) <> ''),
f AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id) = 1), g AS (SELECT * FROM f WHERE k2 <> '' AND k2 NOT IN (SELECT {w240} FROM chunks WHERE coalesce(text, '') <> '') QUALIFY row_number() OVER (PARTITION BY k2 ORDER BY doc_id) = 1),
m AS (SELECT regexp_extract(chunk_id, '^(.+)_([0-9]{{5}})$', 1) AS s, max(regexp_extract(chunk_id, '^(.+)_([0-9]{{5}})$', 2)::bigint) AS top FROM chunks GROUP BY 1), h AS (SELECT doc_id, {stem('source')} AS s FROM g), j AS (SELECT doc_id, {slug} AS s FROM h)
SELECT doc_id, j.s || '_' || lpad((row_number() OVER (PARTITION BY j.s ORDER BY doc_id) + coalesce(top, 0))::varchar, 5, '0') AS chunk_id FROM j LEFT JOIN m ON j.s = m.s""",
        "grounding_overlap": f"WITH {records('chunk_id', 'contexto_fuente', 'respuesta')}, o AS (SELECT chunk_id, {grounded} AS o FROM r) SELECT chunk_id, count(*) AS pairs, floor(round(avg(o) * 10000, 6) + 0.5) / 10000 AS overlap, count(*) FILTER (o < 0.15) AS low FROM o GROUP BY 1",
        "quality_gate": f"WITH {records('faithfulness', 'answer_relevancy', 'roundtrip_consistency', 'quality_verdict')} SELECT qa_id, CASE WHEN {gate} THEN 'reject' WHEN lower(trim(quality_verdict)) IN ('accept', 'reject') THEN lower(trim(quality_verdict)) ELSE 'reject' END AS verdict FROM r",
        "qa_ids": f"WITH {records('chunk_id')} SELECT qa_id, chunk_id || '_qa_' || lpad((row_number() OVER (PARTITION BY chunk_id ORDER BY qa_id))::varchar, 3, '0') AS new_id FROM r",
        "grounded_variant": f"WITH {records('pregunta', 'respuesta', 'contexto_fuente')} SELECT qa_id, {message.format(u=asked)} AS messages FROM r",
        "closed_book_variant": f"WITH {records('pregunta', 'respuesta')} SELECT qa_id, {message.format(u=full('pregunta'))} AS messages FROM r",
        "prompt_completion_split": f"WITH {records('pregunta', 'respuesta')} SELECT qa_id, 'system=Responde.|user=' || coalesce(pregunta, '') AS prompt, 'assistant=' || coalesce(respuesta, '') AS completion FROM r",
        "extract_question_reference": f"WITH {records('pregunta', 'respuesta', 'contexto_fuente')}, m AS (SELECT *, {strip(asked)} AS t FROM r) SELECT qa_id, {strip("substring(t, position('Pregunta:' IN t) + 9)")} AS question, {strip(full('respuesta'))} AS reference FROM m",
        "drop_quality_fields": f"WITH {records('tipo')} SELECT qa_id, CASE WHEN tipo IS NULL THEN '{{}}' ELSE to_json({{'tipo': tipo}})::varchar END AS metadata FROM r",
        "variant_counts": f"WITH {records('chunk_id', 'split')} SELECT {split_of('split')} AS split, count(*) AS records, count(DISTINCT chunk_id) AS chunks, count(DISTINCT regexp_extract(chunk_id, '^(.*)_[0-9]+$', 1)) AS documents FROM r GROUP BY 1",
        "split_leakage_audit": f"WITH {records('chunk_id', 'split')}, s AS (SELECT DISTINCT regexp_extract(chunk_id, '^(.*)_[0-9]+$', 1) AS pdf_id, {split_of('split')} AS split FROM r) SELECT pdf_id, string_agg(split, ',' ORDER BY split) AS splits FROM s WHERE split IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
        "topic_coverage_sets": f"""WITH {records('topics', 'split')}, t AS (SELECT unnest(topics) AS topic, {split_of('split')} AS s FROM r), c AS (SELECT topic, bool_or(s = 'train') AS a, bool_or(s = 'validation') AS b, bool_or(s = 'test') AS c FROM t WHERE s IS NOT NULL GROUP BY 1)
SELECT topic, CASE WHEN a AND b AND c THEN 'shared' WHEN a AND NOT b THEN 'train_not_validation' WHEN b AND NOT a THEN 'validation_not_train' WHEN c AND NOT a AND NOT b THEN 'test_only' ELSE '' END AS coverage FROM c""",
        "eval_summary": f"WITH {records('faithfulness', 'answer_relevancy', 'roundtrip_consistency', 'quality_verdict')} "
        + " UNION ALL ".join(f"SELECT '{c}' AS metric, count({c}) AS scored, avg({c}) AS mean, min({c}) AS least, max({c}) AS most FROM r" for c in ("faithfulness", "answer_relevancy", "roundtrip_consistency"))
        + " UNION ALL SELECT 'acceptance', count(faithfulness), avg((coalesce(quality_verdict, '') = 'accept')::int) FILTER (faithfulness IS NOT NULL), NULL::double, NULL::double FROM r",
        "qa_text_stats": f"""WITH {records('pregunta', 'respuesta')} SELECT avg({tokens_q}) AS avg_question_words, avg({tokens_a}) AS avg_answer_words, min({tokens_a})::int AS min_answer_words, max({tokens_a})::int AS max_answer_words,
count(*) FILTER (regexp_matches(lower(coalesce(respuesta, '')), '\\b(el fragmento|el contexto|el texto|seg[uú]n el|de acuerdo con|con base en)\\b')) AS meta_answer_refs, count(*) FILTER (contains(lower(coalesce(pregunta, '')), ' y ')) AS questions_with_y FROM r""",
        "qa_type_histogram": f"WITH {records('tipo', 'dificultad')} SELECT tipo, dificultad, count(*) AS n FROM r GROUP BY ALL",
        "eval_merge_three_way": "SELECT qa_id, " + ", ".join(f"arg_max({c}, row_no) FILTER ({c} IS NOT NULL) AS {c}" for c in ("faithfulness", "answer_relevancy", "roundtrip_consistency")) + " FROM raw WHERE qa_id IS NOT NULL GROUP BY 1",
        "chunk_lookup_fallback_join": f"WITH {records('chunk_id', 'contexto_fuente')} SELECT qa_id, length(coalesce(c.text, contexto_fuente, ''))::int AS context_chars FROM r LEFT JOIN (SELECT chunk_id, max(text) AS text FROM chunks GROUP BY 1) c USING (chunk_id)",
        "pending_resume_antijoin": f"WITH {records('chunk_id', 'quality_verdict')} SELECT chunk_id FROM chunks WHERE chunk_id NOT IN (SELECT chunk_id FROM r WHERE quality_verdict = 'accept' AND chunk_id IS NOT NULL)",
        "stratified_sample_quota": "WITH s AS (SELECT coalesce(source, 'unknown') AS source, count(*) AS rows FROM documents GROUP BY 1), t AS (SELECT sum(rows) AS n, count(*) AS g FROM s) SELECT source, rows, (CASE WHEN 200 >= n THEN rows WHEN floor(200 * rows / n::double) = 0 AND g <= 200 THEN 1 ELSE floor(200 * rows / n::double) END)::bigint AS quota FROM s, t",
        "semantic_similarity_topk": "WITH v AS (SELECT vec_id, embedding::double[] AS e FROM embeddings), p AS (SELECT a.vec_id AS query, b.vec_id AS neighbour, list_cosine_similarity(a.e, b.e) AS s FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id) SELECT query, neighbour, row_number() OVER (PARTITION BY query ORDER BY s DESC, neighbour) AS rank FROM p QUALIFY rank <= 5",
        "streaming_incremental_docs": "SELECT source, count(*) AS n FROM documents GROUP BY 1",
        "event_windows": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    }
    return out
