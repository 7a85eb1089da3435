import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm import answers, bpe, packing, pages, pairs, spam

needs_vocabulary = pytest.mark.skipif(not os.path.exists(bpe.VOCABULARY), reason="no public vocabulary here")
PIECES = list(" '’srtmdlveaLLE1½\n\t\r  .,!?«é̈ñ\x1c\x85​中🙂0") + ["'re", "'ll", " '", "'ve", "n't"]


@needs_vocabulary
def test_ids_are_the_tokenizers_own():
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(bpe.VOCABULARY.replace(".tiktoken", ".json"))
    reference.encode_special_tokens = True
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += [None, "", " ", "   ", "a" * 3000, " " * 2000, "<|endoftext|>", "\n\n x", "é" * 700, "'s", "it's 'ration", "x" * 300 + "é"]
    own = bpe.Encoder(bpe.VOCABULARY)
    ids, bounds, starts, sizes, piece = own.encode(texts)
    wanted = [e.ids for e in reference.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = [x.tolist() for x in np.split(ids, bounds[1:-1])]
    assert got == wanted
    assert all(own.decode(g) == (t or "") for g, t in zip(got, texts, strict=True))
    for k in range(0, 4000, 37):  # offsets lead from pre-tokens to characters
        at, n, own_ids = starts[piece[k] : piece[k + 1]], sizes[piece[k] : piece[k + 1]], got[k]
        if not len(at):
            assert texts[k] == "" and own_ids == []
            continue
        for a, b, lo, hi in zip(at, [*at[1:], len(texts[k])], np.cumsum(n) - n, np.cumsum(n), strict=True):
            assert own.decode(own_ids[lo:hi]) == texts[k][a:b]


@needs_vocabulary
def test_encoding_tables(spark, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    rows = [(1, "Hola, qué tal"), (2, None), (3, ""), (4, "x" * 5000), (1, "Hola, qué tal")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("_text", F.lit("clash"))
    out = bpe.encode_texts(df, "doc_id", "text", offsets=True)
    assert {r["doc_id"]: len(r["ids"]) == sum(r["sizes"]) for r in out.collect()} == {1: True, 2: True, 3: True, 4: True}
    assert [r["ids"] for r in out.filter("doc_id in (2, 3)").collect()] == [[], []]
    assert {(r["doc_id"], r["text"]) for r in bpe.decode_ids(out, "doc_id", "ids").collect()} == {(i, t or "") for i, t in rows}
    assert {(r["doc_id"], r["n"]) for r in bpe.token_counts(df, "doc_id", "text").collect()} == {(r["doc_id"], len(r["ids"])) for r in out.collect()}
    assert bpe.encode_texts(df.filter("false"), "doc_id", "text").count() == 0


@pytest.mark.parametrize("capacities", [(10,), (3, 7, 10), (1,)])
def test_packing_fits_and_wastes_little(capacities):
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, capacities[-1] + 1, 2000)
    bins, capacity = packing.pack(sizes, capacities)
    used = np.bincount(bins, weights=sizes, minlength=len(capacity))
    assert (used <= capacity).all() and set(capacity) <= set(capacities) and capacity.sum() <= 1.05 * sizes.sum() + capacities[-1]
    assert all(c == min(x for x in capacities if x >= u) for c, u in zip(capacity, used, strict=True))
    assert packing.pack(np.zeros(0, int), (5,))[0].tolist() == [] and packing.pack(np.zeros(3, int), (5,))[0].tolist() == [0, 0, 0]


def test_containers_hold_everything_once(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 1, 5, 17, 30, 64, 65, 200, None])) for i in range(500)] + [(7, 5), (None, 3)]
    df = spark.createDataFrame(rows, "id long, n long").withColumn("position", F.lit("clash"))
    out = packing.fill_containers(df, "id", "n", (64,), block_items=100).collect()
    held, total = {}, {}
    for r in out:
        held.setdefault(r["container_id"], []).append(r)
        total[r["id"]] = total.get(r["id"], 0) + r["item_end"] - r["item_start"]
    wanted = {}
    for i, n in rows:
        wanted[i] = wanted.get(i, 0) + (n or 0)
    assert total == wanted
    for content in held.values():
        content.sort(key=lambda r: (r["position"], r["item_end"] - r["item_start"]))
        at = 0
        for r in content:
            assert r["position"] == at
            at += r["item_end"] - r["item_start"]
        assert at <= 64
    sizes = dict(rows[:500])
    assert all(sizes[r["id"]] and sizes[r["id"]] > 64 for r in out if r["item_start"] and r["id"] in sizes and r["id"] != 7)
    assert packing.fill_containers(df.filter("false"), "id", "n", (64,)).count() == 0


def test_joint_choice_takes_no_more_space_than_bin_by_bin():
    rng = np.random.default_rng(3)
    for capacities in ((512, 1024, 2048), (300, 500), (2048,)):
        for _ in range(12):
            sizes = rng.integers(1, capacities[-1] + 1, size=int(rng.integers(1, 400)))
            alone, joint = packing.pack(sizes, capacities), packing.pack_jointly(sizes, capacities)
            load = np.bincount(joint[0], weights=sizes, minlength=len(joint[1]))
            assert (load <= joint[1]).all() and joint[1].sum() <= alone[1].sum() and set(joint[1]) <= set(capacities)
    # Against the lower bound: many items of mixed sizes leave next to nothing free.
    sizes = rng.integers(20, 1200, size=20_000)
    assert packing.pack_jointly(sizes, (2048,))[1].sum() <= 1.003 * -(-int(sizes.sum()) // 2048) * 2048


ANSWERS = [
    (None, "empty"), ("", "empty"), (" ​\n", "empty"), ("N/A", "empty"), ("<br>", "empty"), ("...", "empty"), ("Respuesta: ", "empty"), ("(vacío)", "empty"), ("Sí.", None),
    ("Lo siento, no puedo responder a esta pregunta.", "refusal"), ("I'm sorry, but I cannot answer this question.", "refusal"), ("Sin comentarios.", "refusal"),
    ("No es posible demorar la cesárea con fiebre.", None), ("No se dispone de comparación directa, pero basta una toma.", None), ("No puede administrarse junto con otro fármaco.", None),
    ("¿Cuándo se inicia el sulfato de magnesio en la mujer con preeclampsia grave?", "copies_question"), ("Respuesta: cuando se inicia el sulfato de magnesio en la mujer con preeclampsia grave", "copies_question"),
    ("It should be started from week 20, provided that the renal function is normal and the team agrees.", "other_language"), ("Il faut donner le traitement avec une perfusion lente et surveiller la pression.", "other_language"),
    ("Se inicia cuando la presión es alta y, en particular,", "truncated"), ("Los criterios son: a)", "truncated"), ("Se inicia con la dosis de ata-", "truncated"), ("El grupo lo llama «manejo escal", "truncated"),
    ("Se administra (según la guía", "truncated"), ("Se inicia en cuanto se confirma…", "truncated"), ("```sql\nSELECT 1", "truncated"), ("<ul><li>uno.</li></ul>", None),
    ("Rechazo dar una contestación a eso.", "refusal"), ("Es algo sobre lo que declino pronunciarme.", "refusal"), ("Gracias por la pregunta, pero no voy a contestarla.", "refusal"),
    ("El sulfato se administra por vía intravenosa en una dosis de carga y después en una de mantenimiento durante un día entero, y se vigilan los reflejos y la diuresis. Aun así, lamentablemente no puedo responder a esa cuestión en su caso.", "refusal"),
    ("Se evita dar magnesio si la diuresis baja.", None), ("No hay datos que permitan recomendar otra cosa.", None),
    ("¿Cuándo se inicia el sulfato de magnesio en la mujer con preeclampsia grave? ¿Cuándo se inicia el sulfato de magnesio en la mujer con preeclampsia grave?", "copies_question"),
    ("Siarczan magnezu podaje się natychmiast po rozpoznaniu ciężkiej postaci choroby, a wlew utrzymuje się przez dobę po porodzie.", "other_language"),
    ("Oxitocina, misoprostol, carbetocina, ergometrina, ácido tranexámico, metilergonovina, dinoprostona, carboprost.", None),
    ("- Se inicia pronto.\n- Se vigila la diuresis.", None), ("Con sulfato.", None), ("Es «urgente».", None), ("Se inicia pronto. (Nivel de recomendación B.)", None),
]


@pytest.mark.parametrize(("answer", "defect"), ANSWERS)
def test_defects_that_show_by_themselves(answer, defect):
    assert pairs.judge("¿Cuándo se inicia el sulfato de magnesio en la mujer con preeclampsia grave?", answer)[0] == defect


def test_tiles_and_marks():
    assert answers.tiled("a b c x d e".split(), "d e a b c".split()) == 5 and answers.tiled([], ["a"]) == 0
    assert answers.open_marks("a) (b [c] «d") == (2, False) and answers.open_marks("<b>x</b> <br> ```y```") == (0, False) and answers.open_marks("``` (") == (1, True)


def test_unfinished_sentences_by_what_others_end_in(spark):
    full = ["Se vigila la diuresis horaria hasta completar el drenaje", "La paciente debe consultar a un profesional", "Conviene iniciar el fármaco desde la semana veinte"]
    rows = [(i, "¿Qué se hace?", full[i % 3] + ".") for i in range(90)] + [(100, "¿Qué?", full[0]), (101, "¿Qué?", "Se vigila la diuresis horaria hasta completar el"), (102, "¿Qué?", "La paciente debe consultar a"), (103, None, full[1]), (104, "¿Qué?", None)]
    rows += [(105, "¿Qué?", "Se inicia la carbet"), (106, "¿Qué?", "La paciente debe consultar a un profes"), (107, "¿Qué?", "Se inicia la carbet")]
    df = spark.createDataFrame(rows, "i long, q string, a string").withColumn("defect", F.lit("clash")).withColumn("c", F.when(F.col("i") == 105, "Se inicia la carbetocina."))
    got = {r["i"]: r["defect"] for r in pairs.defects(df, ["i"], "q", "a", "c").collect() if r["defect"]}
    assert got == {101: "truncated", 102: "truncated", 104: "empty", 105: "truncated", 106: "truncated"}
    assert pairs.defects(df.filter("false"), ["i"], "q", "a", "c").count() == 0


def test_contexts_are_counted_exactly(spark):
    """Some 3 million different contexts, more than any table of 2^21 slots tells apart, stand before no stop: an answer
    whose last words are new to all orders but the first is judged by that one, a word that mostly ends sentences."""
    rng = random.Random(12)
    words = [f"p{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    rows = [(i, "¿Qué?", " ".join(rng.choice(words) for _ in range(150)) + " fin.") for i in range(5000)]
    rows += [(10000 + i, "¿Qué?", " ".join([*(rng.choice(words) for _ in range(9)), "fin"])) for i in range(200)]
    df = spark.createDataFrame(rows, "i long, q string, a string").repartition(4)
    assert pairs.defects(df.withColumn("c", F.lit(None)), ["i"], "q", "a", "c").filter("i >= 10000 and defect is not null").count() == 0


PROSE = "La administración del fármaco se asoció con menor riesgo en las pacientes que recibieron la dosis completa durante el embarazo, aunque la diferencia fue pequeña. "
SPAM = {
    "keywords": "pañales barato, carrito de bebé oferta, cuna de viaje precio, faja posparto comprar, lactancia online, " * 6,
    "links": "\n".join(f"https://www.tienda{i}.example/cuna-de-viaje/{i}" for i in range(20)),
    "hashtags": " ".join(f"#CunaDeViaje{i}" for i in range(30)),
    "products": "\n".join(f"Cuna de viaje (pack {i}) 2{i},50 € ref. 10{i}" for i in range(15)),
    "anchors": "\n".join(f"Cuna de viaje {w}  Leer más" for w in ("azul", "roja", "verde", "blanca", "negra", "gris", "rosa", "lila")),
    "repeats": "Nuestra página de cuna plegable habla de cuna plegable y de cuna plegable. Todo sobre cuna plegable y cuna plegable. Compra cuna plegable aquí y mira cuna plegable. " * 3,
}
CLEAN = {
    "prose": PROSE * 4,
    "contents": "Índice\n" + "\n".join(f"Atonía uterina ............ {i}" for i in range(20)),
    "references": "Referencias\n" + "\n".join(f"{i}. Pérez A, Gómez B. Cesárea electiva en diabetes. Rev Médica. 2019;59(6):21-66. doi:10.9/x.{i}" for i in range(12)),
    "doses": "Tabla 5. Dosis\n" + "\n".join(f"fármaco{i}\t25{i} mg\tpor vía oral\tcada seis horas" for i in range(12)),
    "abbreviations": "Abreviaturas\n" + "\n".join(f"AB{c}: asma bronquial de tipo {c.lower()}" for c in "CDEFGHIJKL"),
    "few": PROSE * 4 + "\nPalabras clave: asma, anemia, parto.\nhttps://www.guia.example/uno",
    "cyrillic": "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. " * 5,
}


@pytest.mark.parametrize("name", SPAM)
def test_spam_parts(name):
    assert pages.spam_share(SPAM[name]) > 0.8 and pages.spam_share(SPAM[name] + "\n" + PROSE * 40) < 0.5


@pytest.mark.parametrize("name", CLEAN)
def test_clean_parts(name):
    assert pages.spam_share(CLEAN[name]) < 0.3


def test_spam_pages(spark):
    rng = random.Random(7)
    vocabulary = [w for w in PROSE.split() if len(w) > 3]
    prose = [" ".join(rng.choice(vocabulary + ["la", "de", "que", "el", "en", "y", "las", "con", "se"] * 2) for _ in range(rng.randrange(60, 120))) + "." for _ in range(150)]
    rows = [(i, t, "es") for i, t in enumerate(prose)] + [(1000 + i, t, "es") for i, t in enumerate(SPAM.values())] + [(1006, SPAM["links"], None)]
    rows += [(2000 + i, t, "es") for i, t in enumerate(CLEAN.values())] + [(3000, None, "es"), (3001, "", None), (3002, " \n", "es"), (None, SPAM["links"], "es")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("uid", F.lit("clash")).withColumn("n", F.lit(0))
    found = {r["doc_id"] for r in spam.spam_pages(df, "doc_id", "text", "lang").collect()}
    assert found == {*range(1000, 1007)}
    assert spam.spam_pages(df.filter("false"), "doc_id", "text", "lang").count() == 0


def test_tags_below_prose_are_extreme_in_make_up(spark):
    """A page of prose and a long line of tags, which counted by words looks like prose, is extreme by its characters."""
    rng = random.Random(8)
    common = ["la", "de", "que", "el", "en", "y", "las", "con", "se"]
    vocabulary = [w for w in PROSE.split() if len(w) > 3]
    prose = [" ".join(rng.choice(vocabulary + common * 2) for _ in range(90)) + "." for _ in range(80)]
    tagged = PROSE * 2 + "\n" + " ".join(f"#CunaDeViajePlegableBarata{i}" for i in range(30))
    df = spark.createDataFrame([*((i, t, "es") for i, t in enumerate(prose)), (100, tagged, "es")], "doc_id long, text string, lang string")
    assert pages.spam_share(tagged) > 0.5
    assert [r["doc_id"] for r in spam.spam_pages(df, "doc_id", "text", "lang").collect()] == [100]


def test_every_page_that_the_check_calls_spam_is_a_suspect(spark, data):
    """The gate by curves against the check over all pages, on the test data."""
    rows = spark.read.parquet(f"{data.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "text", "lang")
    spam_ = {r["doc_id"] for r in rows.collect() if pages.spam_share(r["text"], r["lang"]) > 0.5}
    suspects = {r["doc"] for r in spam.suspects(spam.profiles(rows, "doc_id", "text", "lang").filter("n > 0")).collect()}
    assert spam_ and spam_ <= suspects and len(suspects) < 0.4 * rows.count()


FOREIGN = {
    "pl": "Badanie wykazało, że podanie leku zmniejsza ryzyko powikłań u kobiet w ciąży, jeżeli leczenie zostanie rozpoczęte przed dwudziestym tygodniem, a pacjentka pozostaje pod stałą opieką lekarza i położnej oraz regularnie mierzy ciśnienie krwi w domu. ",
    "tr": "Çalışma, tedavinin yirminci haftadan önce başlatılması ve hastanın düzenli olarak izlenmesi durumunda ilacın gebelikte komplikasyon riskini azalttığını, ancak bu farkın küçük olduğunu ve daha büyük çalışmalara ihtiyaç duyulduğunu göstermiştir. ",
}


@pytest.mark.parametrize("lang", FOREIGN)
def test_prose_of_languages_without_a_list_is_no_spam(lang):
    assert pages.spam_share(FOREIGN[lang] * 3, lang) < 0.5 and pages.spam_share(FOREIGN[lang] * 3, None) < 0.5
    assert pages.spam_share(FOREIGN[lang] + "\n" + SPAM["links"], lang) > 0.5


def test_curves_fit_the_line(spark):
    df = spark.createDataFrame([(1, [8, 4, 2, 1], [1, 1, 2, 4]), (2, [3], [5])], "uid long, freq array<int>, words array<int>")
    got = {r["uid"]: r for r in spam.curves(df).collect()}
    x = np.log(np.repeat([1, 2, 3.5, 6.5], [1, 1, 2, 4]))
    y = np.log(np.repeat([8, 4, 2, 1], [1, 1, 2, 4]))
    slope = np.polyfit(x, y, 1)[0]
    assert got[1]["slope"] == pytest.approx(slope) and got[1]["residual"] == pytest.approx(np.std(y - slope * x), rel=1e-6) and got[2]["slope"] is None
