import random

import pytest
from pyspark.sql import functions as F

from tamiz.operators import chunks as ch
from tamiz.operators import enrich, incremental, pages, qa, tables
from tamiz.operators.ordered import carried_forward, ranked
from tamiz.plans.durable import once


def test_ranks_of_a_hot_group(spark):
    rng = random.Random(1)
    rows = [("a" if rng.random() < 0.6 else rng.choice("bcd") if rng.random() < 0.9 else None, rng.randrange(20), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(7)
    got = {r["i"]: r["k"] for r in ranked(df, ["g"], [F.col("v").desc(), F.col("i").asc()], "k").collect()}
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        assert [got[r[2]] for r in own] == list(range(1, len(own) + 1))
    assert len(got) == len(rows)


def test_ranks_of_nothing(spark):
    assert ranked(spark.createDataFrame([], "g string, i int"), ["g"], [F.col("i")]).count() == 0


def test_values_are_carried_over_task_borders(spark):
    rng = random.Random(2)
    rows = [("a" if i < 1500 else "b", i, str(i) if rng.random() < 0.01 else None) for i in range(2000)]
    got = {r["i"]: r["c"] for r in carried_forward(spark.createDataFrame(rows, "g string, i int, v string"), ["g"], [F.col("i")], "v", "c").collect()}
    last = {}
    for g, i, v in rows:
        last[g] = v or last.get(g)
        assert got[i] == last[g]


def test_once_keeps_rows_and_replaces_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in once(df, b=F.coalesce("b", F.lit("-")), c=F.col("a") + 1).orderBy("a").collect()] == [(1, "-", 2), (2, "x", 3)]


def test_repeated_lines_need_three_pages(spark):
    rows = [("s", p, f"Pie de página\nTexto {p} propio" + ("\nDos veces" if p < 2 else "")) for p in range(4)] + [(None, 9, "Pie de página"), ("s", 5, None)]
    df = spark.createDataFrame(rows, "source string, page int, text string")
    got = [tuple(r) for r in pages.repeated_lines(df, "source", "page", "text", 0.28).select("signature", "line", "pages").collect()]
    assert got == [("pie de pagina", "Pie de página", 4)]
    left = {r["page"]: r["text"] for r in pages.without_repeated_lines(df, "source", "page", "text", 0.28).collect()}
    assert left[0] == "Texto 0 propio\nDos veces" and left[9] == "Pie de página" and left[5] == ""


def test_page_rules(spark):
    prose = "La paciente con embarazo recibe tratamiento y control prenatal en la consulta de riesgo. " * 6
    cases = [(1, "corto", "too_short"), (2, prose, ""), (3, "Referencias de la guía\n" + prose, "non_clinical_section"), (4, None, "too_short")]
    cases.append((5, "Contenido general\n" + "\n".join(f"Capítulo número {i} del libro de texto .... {i}" for i in range(12)), "index_or_table_of_contents"))
    out = pages.classify_pages(spark.createDataFrame([(p, t) for p, t, _ in cases], "page int, text string"), "text", "page")
    assert {r["page"]: r["drop_reason"] for r in out.collect()} == {p: x for p, _, x in cases}
    report = {r["measure"]: r["n"] for r in pages.cleaning_report(out).collect()}
    assert report["total_pages"] == report["kept_pages"] + report["dropped_pages"] == 5


def test_paragraphs(spark):
    texts = ["uno\n\ndos\n \ntres", "a\nb\nCAPÍTULO UNO\nc", None, "\n".join(["diez palabras en esta línea que se repite mucho aquí"] * 13)]
    got = [r["p"] for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", ch.paragraphs("t").alias("p")).orderBy("i").collect()]
    assert got[0] == ["uno", "dos", "tres"] and got[1] == ["a b", "CAPÍTULO UNO c"] and got[2] == []
    assert [len(p.split()) for p in got[3]] == [120, 10] or [len(p.split()) for p in got[3]] == [120, 10]


def test_fold_closes_before_overflow_and_after_full_pages(spark):
    rows = [("s", 1, 0, 500), ("s", 1, 1, 500), ("s", 2, 0, 10), ("s", 3, 0, 2000), ("s", 3, 1, 5), ("t", 1, 0, 900), ("t", 2, 0, 1)]
    df = spark.createDataFrame(rows, "source string, doc int, pos int, words int")
    got = {(r["source"], r["doc"], r["pos"]): (r["chunk"], r["carried"]) for r in ch.fold(df, ["source"], ["doc", "pos"], "doc", "words", max_tokens=1200).collect()}
    assert [got["s", 1, 0], got["s", 1, 1], got["s", 2, 0], got["s", 3, 0], got["s", 3, 1]] == [(1, 0), (2, 0), (2, 0), (3, 0), (4, 80)]
    assert [got["t", 1, 0], got["t", 2, 0]] == [(1, 0), (2, 80)]


def test_dedupe_keeps_the_best(spark):
    rows = [("a", "Texto común número uno", 3), ("b", "TEXTO comun numero uno!", 9), ("c", "otro texto", 1), ("d", "  ", 99), ("e", None, 99)]
    df = spark.createDataFrame(rows, "id string, text string, score int")
    kept = {r["id"] for r in ch.best_of_duplicates(df, "text", [-F.col("score"), F.col("id")]).collect()}
    assert kept == {"b", "c"}
    again = ch.best_of_duplicates(df.filter(F.col("id").isin(*kept)), "text", [-F.col("score"), F.col("id")])
    assert {r["id"] for r in again.collect()} == kept


def test_duplicate_audit(spark):
    rows = [(1, "s", "igual"), (2, "s", "igual"), (3, "t", "igual"), (4, "t", "Igual"), (5, "u", None)]
    out = {r["kind"]: (r["detected"], r["cross_source"]) for r in ch.duplicate_audit(spark.createDataFrame(rows, "i int, s string, t string"), "t", "s", "i").collect()}
    assert out == {"exact": (2, 1), "near": (3, 2)}


def by_hand_holdout(sizes, target, least, share=0.75):
    remaining, chosen, total = dict(sizes), [], 0
    while remaining and target > 0:
        pool = remaining
        if not chosen:
            small = {d: n for d, n in remaining.items() if n <= max(1, round(target * share))}
            pool = small or remaining
        best = min(pool, key=lambda d: (abs(target - total - pool[d]), pool[d], d))
        if len(chosen) >= least and chosen and abs(target - total - remaining[best]) >= abs(target - total):
            break
        chosen.append(best)
        total += remaining.pop(best)
    return chosen


@pytest.mark.parametrize("seed", range(3))
def test_split_by_document_is_the_greedy_one(spark, seed):
    rng = random.Random(seed)
    sizes = {f"d{i:02d}": rng.choice([1, 2, 3, 5, 8, 20, 40]) for i in range(40)}
    df = spark.createDataFrame([(d,) for d, n in sizes.items() for _ in range(n)], "doc string")
    got = {r["doc"]: r["split"] for r in ch.split_by_document(df, "doc", 0.1, 0.1).collect()}
    total = sum(sizes.values())
    validation = by_hand_holdout(sizes, round(total * 0.1), 3)
    test = by_hand_holdout({d: n for d, n in sizes.items() if d not in validation}, round(total * 0.1), 3)
    assert {d for d, s in got.items() if s == "validation"} == set(validation)
    assert {d for d, s in got.items() if s == "test"} == set(test) and set(got) == set(sizes)
    with pytest.raises(ValueError):
        ch.split_by_document(df, "doc", 0.6, 0.5)


def test_samples(spark):
    df = spark.createDataFrame([(i, "a" if i < 90 else "b" if i < 99 else "c") for i in range(100)], "i int, g string")
    per = {r["g"]: r["n"] for r in ch.sample_per_group(df, "g", "i", 5).groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert per == {"a": 5, "b": 5, "c": 1}
    quotas = {r["g"]: r["quota"] for r in ch.stratified_quotas(df, "g", 20).collect()}
    assert quotas == {"a": 18, "b": 1, "c": 1}
    for n in (0, 20, 100, 500):
        rows = [r["i"] for r in ch.stratified_sample(df, "g", "i", n).collect()]
        assert len(rows) == len(set(rows)) == min(n, 100)


def test_ocr_and_inclusion(spark):
    df = spark.createDataFrame([(0, 0, 10, ""), (5, 0, 5000, "x"), (10, 2, 500, "x"), (10, 5, 5000, "zzz " * 80), (10, 9, 5000, None)], "p int, n int, size long, t string")
    out = df.select(enrich.ocr_status(F.col("n"), F.col("p")).alias("o"), enrich.inclusion_reason(F.col("p"), F.col("size"), F.col("t")).alias("r")).collect()
    assert [tuple(r) for r in out] == [("unknown", "empty"), ("clean", None), ("minor", "corrupted"), ("needs_ocr", "wrong_language"), ("dominated", None)]


def test_pairs_and_gate(spark):
    df = spark.createDataFrame([(399, 5), (400, 5), (700, 5), (100, 20), (5000, 50)], "t int, s int")
    assert [r[0] for r in df.select(qa.pairs_per_chunk(F.col("t"), F.col("s"))).collect()] == [2, 3, 4, 3, 5]
    rows = [(0.8, 0.75, 0.75, "accept"), (0.79, 1.0, 1.0, "accept"), (None, None, None, "ACCEPT "), (0.9, 0.9, 0.9, "maybe"), (7.0, 0.9, -1.0, "accept")]
    df = spark.createDataFrame(rows, "faithfulness double, answer_relevancy double, roundtrip_consistency double, v string")
    assert [r[0] for r in df.select(qa.gated_verdict(F.col("v"))).collect()] == ["accept", "reject", "accept", "reject", "reject"]


def test_messages(spark):
    kind = "id int, m array<struct<role: string, content: string>>"
    rows = [(1, [("system", "s"), ("user", "Contexto: x Pregunta: ¿qué?"), ("assistant", " a "), ("user", "más")]), (2, [("user", "u")]), (3, [("assistant", "a")]), (4, None)]
    out = spark.createDataFrame(rows, kind).select("id", qa.prompt_completion(F.col("m")).alias("p"), qa.asked_question(F.col("m")).alias("q"), qa.reference_answer(F.col("m")).alias("r")).orderBy("id").collect()
    assert [len(out[0]["p"]["prompt"]), len(out[0]["p"]["completion"])] == [2, 2] and [r["p"]["error"] for r in out] == [None, "no assistant message", "no message before the assistant's", "no messages"]
    assert out[0]["q"] == "más" and out[0]["r"] == "a" and out[1]["r"] == ""
    grounded = spark.createDataFrame(rows[:1], kind).select(qa.grounded_messages(F.col("m"), F.lit(" ctx ")).alias("g")).head()["g"]
    assert grounded[1]["content"].startswith("Contexto fuente:\nctx\n\nPregunta:\nContexto") and grounded[0]["content"] == "s"


def test_quality_fields_are_dropped_at_any_depth(spark):
    df = spark.createDataFrame([(1, (0.5, ([(0.1, "x")],)), 0.7)], "id int, m struct<faithfulness: double, n: struct<l: array<struct<quality_reason: double, k: string>>>>, faithfulness double")
    out = qa.without_fields(df)
    assert out.columns == ["id", "m"] and out.schema["m"].dataType.simpleString() == "struct<n:struct<l:array<struct<k:string>>>>"


def test_records_and_generation(spark):
    chunks = spark.createDataFrame([("c_1", "Una frase bastante larga que tiene más de ocho palabras. Otra."), ("c_2", ""), ("c_3", "no"), ("c_4", "falla")], "chunk_id string, text string")

    def generate(row):
        if row["text"] == "no":
            raise PermissionError
        if row["text"] == "falla":
            raise RuntimeError
        return qa.extractive_pairs(row)

    out = qa.generated(chunks, generate, ["text"], attempts=2)
    assert {r["chunk_id"]: r["status"] for r in out.collect()} == {"c_1": "ok", "c_2": "empty", "c_3": "refused", "c_4": "failed"}
    assert [r["qa_id"] for r in qa.raw_records(out.filter("status = 'ok'"), "pairs").collect()] == ["c_1_qa_001"]


def test_merge_takes_the_last_report(spark):
    base = spark.createDataFrame([("a", 0.1), ("b", 0.2)], "qa_id string, f double")
    report = spark.createDataFrame([("a", 0.5, 1), ("a", None, 2)], "qa_id string, value double, at int")
    assert {r["qa_id"]: r["f"] for r in qa.merged_scores(base, "qa_id", {"f": report}).collect()} == {"a": None, "b": 0.2}


def test_nearest_is_exact(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(200, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(900, None), (901, []), (902, [0.0] * 8)]
    got = qa.nearest(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", F.col("id") % 50 == 0, k=3, blocks=3).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for query in (0, 50, 100, 150):
        order = [j for j in np.argsort(-(unit @ unit[query])) if j != query][:3]
        assert [r["neighbour"] for r in sorted((r for r in got if r["query"] == query), key=lambda r: r["rank"])] == order


def test_incremental(spark):
    files = spark.createDataFrame([("p/a", 1), ("p/b", 2), ("p/c", 3)], "source_path string, file_size long")
    state = spark.createDataFrame([("p/a", 1), ("p/b", 9)], "source_path string, file_size long")
    assert {(r["source_path"], r["change"]) for r in incremental.changed_files(files, state).collect()} == {("p/b", "changed"), ("p/c", "new")}
    assert incremental.changed_files(files, state, force=True).count() == 3
    old = spark.createDataFrame([("p/a", "a", 1), (None, "b", 2), ("p/z", "c", 3), ("", None, 4)], "path string, name string, v int")
    new = spark.createDataFrame([("p/a", "x", 10), ("", "b", 20)], "path string, name string, v int")
    assert {r["v"] for r in incremental.replaced(old, new, "path", "name").collect()} == {3, 4, 10, 20}
    done = spark.createDataFrame([("k1",), (" ",), (None,)], "k string")
    assert {r["k"] for r in incremental.pending(spark.createDataFrame([("k1",), ("k2",), (None,)], "k string"), done, "k").collect()} == {"k2", None}


def test_appended_chunks_go_on_numbering(spark):
    old = spark.createDataFrame([("guia_00007", "texto conocido"), ("x", None)], "chunk_id string, text string")
    new = spark.createDataFrame([(1, "Texto conocido", "Guía.pdf"), (2, "texto nuevo", "Guía.pdf"), (3, "TEXTO nuevo", "Guía.pdf"), (4, None, "Guía.pdf")], "i int, text string, s string")
    got = {r["i"]: r["chunk_id"] for r in incremental.appended(old, new, "text", "s", [F.col("i")]).collect()}
    assert got == {2: "guia_00008"}


def test_grids(spark):
    grid = [["Fármaco", " Dosis "], ["a", None, "3 mg"], [None]]
    df = spark.createDataFrame([(1, grid, "lines"), (2, [["uno", "dos"], ["tres", "cuatro"]], "text"), (3, [], "lines"), (4, None, "lines")], "i int, g array<array<string>>, s string")
    out = tables.with_grid_quality(df.withColumn("g", tables.normalized_grid(F.col("g"))), "g").orderBy("i").collect()
    assert out[0]["g"] == [["Fármaco", "Dosis", ""], ["a", "", "3 mg"], ["", "", ""]] and out[0]["is_header_like"] and out[0]["non_empty_density"] == pytest.approx(4 / 9)
    kept = tables.accepted_tables(tables.with_grid_quality(df.withColumn("g", tables.normalized_grid(F.col("g"))), "g"), "g", "s")
    assert {r["i"] for r in kept.collect()} == {1}
    assert tables.first_of_equal(df.select("i", "s"), [F.col("s")], F.col("i")).count() == 2


def test_topics_over_splits(spark):
    rows = [(["a", "b"], "train"), (["a"], "validation"), (["a"], "test"), (["c"], "test"), (["d"], None), (None, "train")]
    out = {r["topic"]: r["coverage"] for r in enrich.split_topics(spark.createDataFrame(rows, "t array<string>, s string"), "t", "s").collect()}
    assert out == {"a": "shared", "b": "train_not_validation", "c": "test_only"}


def test_enriched_chunks_get_ids_and_tags(spark):
    rows = [("a", "La paciente con hemorragia recibe transfusión.", "Manejo", "Guía Uno.pdf", None), ("b", None, None, "x.pdf", "own")]
    out = {r["chunk_id"]: r for r in enrich.enriched(spark.createDataFrame(rows, "chunk_id string, text string, section string, source_pdf string, pdf_id string"), "text", "section").collect()}
    assert out["a"]["pdf_id"] == "guia_uno" and out["b"]["pdf_id"] == "own" and out["a"]["topic_tags"] == out["a"]["topics"] == ["hemorrhage"] and out["b"]["topic_count"] == 0
