"""Records, reports, judging, extraction, duplicates and the stream, against results worked out by hand or by brute force."""

import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tamiz.functions import text as tx
from tamiz.operators import chunks as ch
from tamiz.operators import alike, duplicates, enrich, evaluation, extraction, incremental, qa, records, reports
from tamiz.operators.ordered import running_total
from tamiz.sources import files
from tamiz.streaming.incremental import progress, staging, upsert_by_source


def test_chunk_records_by_hand(spark):
    """Limit 10 tokens: 7 words (ceil(7 * 1.35) = 10) fit, 8 don't. Overlap 3."""
    rows = [
        ("s", "A", 1, 1, "uno dos tres\n\ncuatro cinco"), ("s", "A", 2, 2, "seis siete\n\nocho"), ("s", "B", 3, 3, " ".join(f"b{i}" for i in range(9)) + "\n\n" + "fin ya"),
        ("s", None, 4, 4, "suelto aquí"), (None, "A", 1, 5, "sin fuente"), ("s", "C", 9, 6, None), ("s", "D", 7, 7, " ".join(f"d{i}" for i in range(9)) + "\n\n  \n"),
    ]
    df = spark.createDataFrame(rows, "source string, section string, page int, id long, text string").withColumn("chunk", F.lit("clash"))
    got = {(r["source"], r["section"], r["chunk"]): (r["text"], r["pages"], r["token_estimate"]) for r in ch.chunk_records(df, "source", "section", "page", "id", "text", 10, 3).collect()}
    assert got == {
        ("s", "A", 1): ("uno dos tres cuatro cinco seis siete", [1, 2], 10), ("s", "A", 2): ("ocho", [2], 2),
        ("s", "B", 1): ("b0 b1 b2 b3 b4 b5 b6 b7 b8", [3], 13), ("s", "B", 2): ("b6 b7 b8 fin ya", [3], 7),
        ("s", "Sin seccion", 1): ("suelto aquí", [4], 3), ("", "A", 1): ("sin fuente", [1], 3),
        ("s", "D", 1): ("d0 d1 d2 d3 d4 d5 d6 d7 d8", [7], 13), ("s", "D", 2): ("d6 d7 d8", [7], 5),
    }
    assert ch.chunk_records(df.filter("false"), "source", "section", "page", "id", "text").count() == 0
    plain = ch.chunk_records(df, "source", "section", "page", "id", "text", 10, 0)
    assert {r["text"] for r in plain.filter("section = 'B'").collect()} == {"b0 b1 b2 b3 b4 b5 b6 b7 b8", "fin ya"}


def test_holdouts_in_runs_are_the_ones_taken_singly():
    def singly(sizes, target, least, share=0.75):
        left, taken, total, count = dict(sizes), {}, 0, 0
        while target > 0 and any(left.values()):
            pool = [s for s, n in left.items() if n]
            if not count:
                pool = [s for s in pool if s <= max(1, round(target * share))] or pool
            best = min(pool, key=lambda s: (abs(target - total - s), s))
            if count >= least and count and abs(target - total - best) >= abs(target - total):
                break
            left[best] -= 1
            taken[best] = taken.get(best, 0) + 1
            total, count = total + best, count + 1
        return taken

    rng = random.Random(5)
    for _ in range(400):
        sizes = {rng.randrange(1, 30): rng.randrange(0, 40) for _ in range(rng.randrange(1, 8))}
        target, least = rng.randrange(0, 300), rng.randrange(0, 5)
        assert ch.holdout_sizes(sizes, target, least) == singly(sizes, target, least), (sizes, target, least)
    assert sum(ch.holdout_sizes({1: 10**9}, 10**8, 3).values()) == 10**8  # no turn for every document


def test_running_totals_over_tasks(spark):
    rows = [("a" if i % 3 else "b", i, i % 5 if i % 7 else None) for i in range(900)]
    got = {r["i"]: r["s"] for r in running_total(spark.createDataFrame(rows, "g string, i int, v int"), ["g"], [F.col("i").asc()], "v", "s").collect()}
    sums = {}
    for g, i, v in rows:
        sums[g] = sums.get(g, 0) + (v or 0)
        assert got[i] == sums[g]


def test_text_samples_and_fallback(spark):
    rows = [("s", p, "x" * 1400 + str(p)) for p in range(5)] + [("t", 1, None), ("t", 2, "  "), ("u", 1, "corto")]
    df = spark.createDataFrame(rows, "source string, page int, text string")
    got = {r["source"]: r["text_sample"] for r in extraction.text_samples(df, "source", [F.col("page")], F.col("text"), 3000, 2000).collect()}
    assert got == {"s": ("x" * 1400 + "0 " + "x" * 1400 + "1")[:2000], "u": "corto"}
    pages = spark.createDataFrame([(1, "breve", "un texto bastante más largo que el primero"), (2, "p" * 130, "q" * 500), (3, None, None), (4, "igual", "corto")], "id int, p string, f string")
    out = {r["id"]: (r["extraction_method"], r["char_count"], r["needs_ocr"]) for r in extraction.with_fallback(pages, "p", "f").collect()}
    assert out == {1: ("fallback", 42, True), 2: ("primary", 130, False), 3: ("primary", 0, True), 4: ("primary", 5, True)}


def test_records_by_hand(spark):
    schema = "chunk_id string, pdf_id string, text string, source_pdf string, source_path string, doc_type string, pages array<int>, section string, token_estimate int, clinical_score int, section_type string, content_role string, language string, topics array<string>, topic_tags array<string>, topic_count int, split string, pairs array<struct<pregunta:string,respuesta:string,tipo:string,dificultad:string,contexto_fuente:string>>, qualities array<struct<faithfulness:double,answer_relevancy:double,roundtrip_consistency:double,quality_verdict:string,quality_reason:string>>"
    pair = ("¿Q?", "R.", "t", "d", "c")
    rows = [("c1", "p", "Un  texto\n largo", "p.pdf", None, None, None, None, None, None, None, None, None, [], ["x"], None, None, [pair, pair], [(0.5, 0.4, None, "accept", "bien")]), (None, None, None, None, None, None, [2, 1], "S", 7, 3, None, None, "es", ["a", "b"], None, 9, "test", [None, pair], None)]
    df = spark.createDataFrame(rows, schema)
    lm = {r["metadata"]["chunk_id"]: r for r in records.lm_records(df).collect()}
    assert lm["c1"]["text"] == "Un texto largo" and lm["c1"]["metadata"]["topics"] == ["x"] and lm["c1"]["metadata"]["topic_count"] == 1 and lm["c1"]["metadata"]["doc_type"] == "unknown"
    assert lm[""]["text"] == "" and lm[""]["metadata"]["topic_count"] == 9 and lm[""]["metadata"]["pages"] == [2, 1]
    faults = [tuple(r) for r in records.lm_record_errors(records.lm_records(df).withColumn("id", F.col("metadata.chunk_id")), "id").collect()]
    assert faults == [(1, "empty text")]
    sft = {r["metadata"]["qa_id"]: r for r in records.sft_records(df, "pairs", "qualities").collect()}
    assert set(sft) == {"c1_qa_001", "c1_qa_002", "qa_002"}
    assert sft["c1_qa_001"]["metadata"]["faithfulness"] == 0.5 and sft["c1_qa_002"]["metadata"]["faithfulness"] is None and [m["role"] for m in sft["qa_002"]["messages"]] == ["system", "user", "assistant"]
    flat = {r["qa_id"]: r for r in records.flat_records(df, "pairs", "qualities").collect()}
    assert flat["c1_qa_001"]["quality_reason"] == "bien" and flat["c1_qa_002"]["quality_reason"] is None and flat["qa_002"]["topics"] == ["a", "b"]
    assert records.flat_records(df, "pairs").count() == 3
    texts = spark.createDataFrame([("  a  b ",), ("abcdefghij",), (None,), ("abcdefg   hijk",)], "t string").select(records.preview("t", 10).alias("p"), tx.tail_words("t", 1).alias("w")).collect()
    assert [tuple(r) for r in texts] == [("a b", "b"), ("abcdefghij", "abcdefghij"), ("", ""), ("abcdefg...", "hijk")]


def test_merged_metadata_and_manifest(spark):
    rows = spark.createDataFrame([("q1", "c1", None, "S"), ("q2", "c9", "own", None), ("q3", None, None, None)], "qa_id string, chunk_id string, source_pdf string, section string")
    chunks = spark.createDataFrame([("c1", "p.pdf", "gpc", "T"), ("", "no", "no", "no")], "chunk_id string, source_pdf string, doc_type string, section string")
    got = {r["qa_id"]: (r["source_pdf"], r["section"], r["doc_type"]) for r in records.merged_metadata(rows, chunks).collect()}
    assert got == {"q1": ("p.pdf", "S", "gpc"), "q2": ("own", None, None), "q3": (None, None, None)}


def test_filters(spark):
    df = spark.createDataFrame([("a", "la de el en que", None, None), ("b", "the of and", " ES ", 3), ("c", "the of and", "", 9), ("d", None, "en", None)], "id string, t string, lang string, score int")
    assert {r["id"] for r in df.filter(enrich.language_matches("t", "lang")).collect()} == {"a", "b"}
    assert {r["id"] for r in df.filter(enrich.language_matches("t", "lang", ("en",))).collect()} == {"a", "c", "d"}
    assert enrich.of_least_score(df, "score", 0).count() == 4 and {r["id"] for r in enrich.of_least_score(df, "score", 4).collect()} == {"c"}
    names = [("Guia de practica clinica.pdf", "gpc"), ("manual-2020.pdf", "manual"), ("Rev_Medica vol 3.pdf", "article"), ("libro.pdf", "book"), ("guía rápida.pdf", "guide"), ("x.pdf", "unknown"), (None, "unknown")]
    assert [r[0] for r in spark.createDataFrame([(i, n) for i, (n, _) in enumerate(names)], "i int, n string").orderBy("i").select(tx.filename_type("n")).collect()] == [t for _, t in names]


def test_judges_that_fail(spark):
    calls = []

    def flaky(row):
        calls.append(1)
        if len(calls) < 3:
            raise evaluation.Retryable("busy")
        return {"a": 2.5}

    waits = []
    assert evaluation.called(flaky, {}, sleep=waits.append) == {"a": 2.5} and len(calls) == 3 and 2 <= waits[0] <= 3 and 4 <= waits[1] <= 5
    with pytest.raises(ValueError):
        evaluation.called(lambda r: (_ for _ in ()).throw(ValueError("no")), {}, sleep=waits.append)
    assert len(waits) == 2

    def judge(row):
        if row["t"] is None:
            raise ValueError("nothing")
        return {"faithfulness": row["t"], "answer_relevancy": "x", "roundtrip_consistency": -1, "verdict": " Accept ", "reason": "r"} if row["t"] != "bad" else {"verdict": "?"}

    df = spark.createDataFrame([("1", "0.4"), ("2", None), ("3", "7"), ("4", "bad")], "id string, t string")
    got = {r["id"]: tuple(r)[1:] for r in evaluation.evaluated(df, "id", ["t"], judge, ("faithfulness", "answer_relevancy")).collect()}
    assert got == {"1": (0.4, None, None), "2": (None, None, "ValueError: nothing"), "3": (1.0, None, None), "4": (None, None, None)}
    got = {r["id"]: tuple(r)[1:] for r in evaluation.pair_quality(df, "id", ["t"], judge).collect()}
    assert got["1"] == (0.4, 0.0, 0.0, "accept", "r") and got["2"][:4] == (0.0, 0.0, 0.0, "reject") and got["4"][3] == "reject"
    assert evaluation.evaluated(df.filter("false"), "id", ["t"], judge, ("faithfulness",)).count() == 0


def test_grounding_by_hand(spark):
    """Of the four words of the first context the answer has two, of the second one of eight (0.125 < 0.15), of the third none."""
    rows = [("c", "uno dos tres cuatro", "dos y uno"), ("c", "a b c d e f g h", "a"), ("d", None, "x"), ("d", "sí", "SÍ, sí")]
    got = {r["chunk_id"]: (r["pairs"], r["overlap"], r["low"]) for r in qa.grounding_by_chunk(spark.createDataFrame(rows, "chunk_id string, c string, a string"), "chunk_id", "c", "a").collect()}
    assert got == {"c": (2, 0.3125, 1), "d": (2, 0.5, 1)}
    per = spark.createDataFrame([("c", 2, 0.3125, 1), ("d", 4, 0.5, 1)], "chunk_id string, pairs long, overlap double, low long")
    rated = spark.createDataFrame([(0.9, "accept"), (0.6, "reject"), (None, "accept")], "f double, v string")
    m = {r["measure"]: r["value"] for r in reports.generation_rollup(per, rated, "v", ("f",)).collect()}
    assert m == {"overlap": 0.4375, "low_pairs": 2.0, "pairs": 6.0, "low_rate": 0.3333, "evaluated": 2.0, "acceptance": 0.5, "mean_f": 0.75}


def test_variant_check_and_report_file(spark, tmp_path):
    one = spark.createDataFrame([("train",), ("train",), ("test",)], "split string")
    got = {r["split"]: (r["a"], r["b"], r["equal"]) for r in reports.variant_check({"a": one, "b": one.filter("split = 'train'")}, "split").collect()}
    assert got == {"train": (2, 2, True), "test": (1, 0, False)}
    path = str(tmp_path / "report.json")
    files.write_report(reports.histograms(one, {"split": F.col("split")}).unionByName(reports.measures(one, {"rows": F.count(F.lit(1))})), path)
    assert json.loads(open(path, encoding="utf-8").read()) == {"rows": 3, "split": {"test": 1, "train": 2}}


def test_splits_and_named_files(spark, tmp_path):
    for s in ("train", "test"):
        (tmp_path / f"{s}.jsonl").write_text('{"a": 1}\n')
    paths = {s: str(tmp_path / f"{s}.jsonl") for s in ("train", "test")}
    assert {r["split"] for r in files.read_splits(spark, paths, "a int").collect()} == {"train", "test"}
    with pytest.raises(FileNotFoundError, match="validation"):
        files.read_splits(spark, paths | {"validation": str(tmp_path / "none")}, "a int")
    (tmp_path / "x.pdf").write_bytes(b"1")
    (tmp_path / "y.txt").write_bytes(b"22")
    assert [r["source_pdf"] for r in files.discover(spark, str(tmp_path), files=[str(tmp_path / "y.txt")]).collect()] == ["y.txt"]
    assert files.discover(spark, str(tmp_path), files=[]).count() == 0


def test_duplicate_documents_against_every_pair(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(4, 10))) for _ in range(600)]
    # Up to 200 characters: beyond, the ratio leaves out frequent characters, and only equal fingerprints are alike.
    base = [[rng.choice(words) for _ in range(24)] for _ in range(25)]
    texts = []
    for b in base:
        for _ in range(4):
            copy = list(b)
            for _ in range(rng.choice((0, 1, 2, 3, 9))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    df = spark.createDataFrame([(f"d{i:03d}", t) for i, t in enumerate(texts)] + [("", texts[0]), (None, texts[0]), ("z", None), ("zz", "a b")], "id string, t string")
    got = {(r["duplicate_of"], r["id"]) for r in duplicates.duplicate_documents(df, "id", "t").collect()}
    want = {(f"d{i:03d}", f"d{j:03d}") for i in range(100) for j in range(i + 1, 100) if SequenceMatcher(None, texts[i], texts[j]).ratio() >= 0.85}
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(t, f"d{i:03d}")
    stands = lambda d: first[texts[int(d[1:])]]
    want_of_classes = {tuple(sorted((stands(a), stands(b)))) for a, b in want if stands(a) != stands(b)}
    got_of_classes = {tuple(sorted((stands(a), stands(b)))) for a, b in got if stands(a) != stands(b)}
    assert got_of_classes <= want_of_classes and len(got_of_classes) >= 0.9 * len(want_of_classes) and len(want_of_classes) > 20
    assert {(a, b) for a, b in got if stands(a) == stands(b)} == {(stands(f"d{i:03d}"), f"d{i:03d}") for i in range(100) if stands(f"d{i:03d}") != f"d{i:03d}"}
    assert duplicates.duplicate_documents(df.filter("false"), "id", "t").count() == 0


def test_stream_keeps_other_sources_of_a_bucket(spark, tmp_path):
    """Two sources in the one bucket, in two batches; then the first again, and a source spread over batches."""
    src, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "i long, s string"
    put = lambda rows, name: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/{name}")
    run = lambda **k: upsert_by_source(spark, src, schema, target, state, "s", buckets=1, **k).awaitTermination()
    rows = lambda: sorted((r["i"], r["s"]) for r in spark.read.schema(schema).parquet(target).collect())
    put([(1, "a"), (2, "a")], "x1")
    run()
    put([(3, "b")], "x2")
    run()
    assert rows() == [(1, "a"), (2, "a"), (3, "b")]
    put([(9, "a")], "x3")
    run()
    assert rows() == [(3, "b"), (9, "a")]
    put([(10, "a"), (3, "b")], "x4")
    run(append="i")
    assert rows() == [(3, "b"), (9, "a"), (10, "a")]
    with staging(spark) as at:
        spark.range(3).write.parquet(f"{at}/t")
        assert files.exists(spark, f"{at}/t")
    assert not files.exists(spark, f"{at}/t")


def test_bootstrap_and_progress(spark):
    known = spark.createDataFrame([("a.pdf", 1), ("b.pdf", 2)], "source_pdf string, file_size long")
    pages = spark.createDataFrame([("b.pdf",), ("b.pdf",), ("gone.pdf",), (None,), ("",)], "source_pdf string")
    assert [r["source_pdf"] for r in incremental.bootstrapped(known, pages, "source_pdf").collect()] == ["b.pdf"]
    row = progress(spark.createDataFrame([("ok",), ("empty",), ("failed",), (None,)], "s string"), "s", 10, 4.0).head()
    assert (row["done"], row["failed"], row["pending"], row["per_second"], row["seconds_left"]) == (2, 1, 8, 0.5, 16.0)
    assert progress(spark.createDataFrame([], "s string"), "s", 10, 4.0).head()["seconds_left"] is None


def test_block_split_and_samples_agree_on_reruns(spark):
    rows = [("a", i) for i in range(30)] + [("b", 1), ("b", 2), (None, 1), (None, 2), (None, 3)]
    df = spark.createDataFrame(rows, "d string, i int")
    got = ch.block_split(df, "d", [F.col("i").asc()])
    split = {(r["d"], r["i"]): r["split"] for r in got.collect()}
    held = [i for d, i in rows if d == "a" and split[d, i] == "validation"]
    assert len(held) == 3 and held[1] - held[0] == held[2] - held[1] == 10 and split["b", 1] == split["b", 2] == "train" and len(split) == len(rows)


def _edited(rng, words):
    """Twelve documents of 3 to 60 words, and copies of each with letters changed, left out and put in, all over or at one place."""
    out = []
    for n in (3, 8, 15, 22, 24, 26, 28, 30, 34, 40, 50, 60):
        base = " ".join(rng.choice(words) for _ in range(n))
        out += [base, base[: len(base) * 4 // 5], base[: len(base) // 2] + "xx" + base[len(base) // 2 :], base[1:]]
        for share in (0.01, 0.02, 0.04, 0.06, 0.08, 0.1, 0.12, 0.14):
            copy = list(base)
            for k in rng.sample(range(len(copy)), int(len(copy) * share)):
                copy[k] = rng.choice(("", "x", "q", copy[k] + "e", "a")) if copy[k] != " " else " "
            out.append("".join(copy))
    return list(dict.fromkeys(out))


def test_near_documents_are_all_found(spark):
    """Edits spread over all words, few of which stay in common: every pair that difflib finds alike, in one group or in many."""
    rng = random.Random(7)
    texts = _edited(rng, ["".join(rng.choice("aeiourstnlcdmpbgv") for _ in range(rng.randrange(6, 10))) for _ in range(300)])
    ids = [f"d{i:03d}" for i in rng.sample(range(1000), len(texts))]
    ordered = sorted(zip(ids, texts, strict=True))
    want = {(a, b): r for i, (a, x) in enumerate(ordered) for b, y in ordered[i + 1 :] if (r := SequenceMatcher(None, x, y).ratio()) >= 0.85}
    assert len(want) > 50 and any(len(y) >= 200 for b, y in ordered if b in {w[1] for w in want})
    prints = spark.createDataFrame(list(zip(ids, texts, strict=True)), "id string, fingerprint string")
    for group in (4096, 7):
        got = [(r["id_a"], r["id_b"], r["similarity"]) for r in duplicates.near_documents(prints, group=group).collect()]
        assert sorted(r[:2] for r in got) == sorted(want) and all(abs(r[2] - want[r[:2]]) < 1e-4 for r in got)


def test_few_documents_are_compared_in_full():
    """Texts made of the same few sentences share many words, yet next to none are left for difflib."""
    rng = random.Random(3)
    sentences = [" ".join("".join(rng.choice("aeiourstnlcdmpbgv") for _ in range(rng.randrange(4, 11))) for _ in range(13)) for _ in range(25)]
    names = ["".join(rng.choice("bcdfglmnprstvaeio") for _ in range(10)) for _ in range(400)]
    texts = alike.Texts([" ".join(f"{s} {rng.choice(names)}" for s in rng.sample(sentences, 3)) for _ in range(1500)])
    left = sum(len(i) for i, _ in alike.candidates(texts, texts, 0.85, itself=True))
    assert left < 0.001 * 1500 * 1499 / 2
