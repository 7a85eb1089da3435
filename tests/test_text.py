import unicodedata
import re

import pytest
from pyspark.sql import functions as F

from tamiz.functions import text as tx

TEXTS = [
    None, "", "   ", "...!?", "Árbol de Navidad, año 2024", "ß ﬁ ½ ²x º", "éxito", "línea\r\notra más\x85fin", "﻿BOM​ y cero", "𝒜b c_d", "x" * 3000,
    "palabra " * 19, "palabra " * 20, "palabra " * 21, "Ёлка й", "ŐŰ ş ç",
]


def values(spark, expr, texts=TEXTS):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.select("i", expr.alias("v")).orderBy("i").select("v").collect()]


def by_hand(value):
    text = "".join(c for c in unicodedata.normalize("NFKD", value or "") if not unicodedata.combining(c)).lower()
    return " ".join(re.findall("[a-z0-9]+", text))


def test_normalize_is_nfkd_without_marks(spark):
    texts = [t for t in TEXTS if t is None or "𝒜" not in t]
    assert values(spark, tx.normalize("t"), texts) == [by_hand(t) for t in texts]


def test_normalize_on_documents(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("text", tx.normalize("text").alias("n")).collect()
    assert [r for r in rows if r["n"] != by_hand(r["text"])] == []


def test_word_and_token_counts(spark):
    words = [len(re.findall(r"\w+", t or "")) for t in TEXTS]
    assert values(spark, tx.word_count("t")) == words
    import math

    assert values(spark, tx.estimate_tokens("t")) == [max(1, math.ceil(w * 1.35)) for w in words]


@pytest.mark.parametrize(("name", "slug"), [("Guía Clínica.pdf", "guia_clinica"), ("a/b/Ñandú v2.0.PDF", "nandu_v2_0"), (None, "document"), ("¡!.pdf", "document"), ("sin_punto", "sin_punto")])
def test_slugify(spark, name, slug):
    assert values(spark, tx.slugify("t"), [name]) == [slug]


def test_clean_drops_links_noise_and_page_numbers(spark):
    text = "Texto pre-\nvio con https://a.b/c y x@y.org\r\nPágina 12\n 7 \nTeléfono: 555 123 4567\n• punto\n\n\n\nReferencias\nfin"
    assert values(spark, tx.clean("t"), [text, None, "\x00"]) == ["Texto previo con y\n- punto\n\nfin", "", ""]


def test_heading_rules(spark):
    lines = ["Capítulo 3", "1.2 Manejo inicial", "TRATAMIENTO ACTIVO", "una frase cualquiera en minúsculas", "Índice", "", "a" * 111]
    assert values(spark, tx.is_heading("t"), lines) == [True, True, True, False, True, False, False]


def test_ratios_of_empty_texts_are_zero(spark):
    for f in (tx.reference_ratio, tx.suspicious_ratio, tx.numeric_ratio, tx.clinical_density):
        assert values(spark, f("t"), [None, "", "  "]) == [0.0, 0.0, 0.0]


def test_reference_ratio_and_markers(spark):
    text = "Smith et al, Revista 2001;12\nuna línea\n\nISBN 123"
    assert values(spark, tx.reference_ratio("t"), [text])[0] == pytest.approx(2 / 3)
    assert values(spark, tx.reference_markers("t"), ["ver https://x.org y doi: 10.1234/abc", "bibliografía"]) == [4, 1]


def test_language_rules(spark):
    texts = [None, "the women and the birth", "la mujer y el parto", "xyz", "la the"]
    assert values(spark, tx.detect_language("t"), texts) == ["unknown", "en", "es", "unknown", "es"]
    assert values(spark, tx.looks_spanish("t"), ["la casa de los niños", "the house"]) == [True, False]


def test_document_type_order(spark):
    assert values(spark, tx.document_type(F.col("t"), F.lit("resumen objetivo métodos")), ["gpc manual.pdf", "Manual.pdf", "x.pdf", "capítulo.pdf"]) == ["gpc", "manual", "article", "article"]
    assert values(spark, tx.document_type(F.col("t"), F.lit(None).cast("string")), ["capítulo.pdf", None]) == ["book", "unknown"]


def test_json_object_and_html(spark):
    assert values(spark, tx.json_object("t"), ["```json\n{\"a\": 1}\n```", "no", None, "x {\"a\": {\"b\": 2}} y"]) == ['{"a": 1}', None, None, '{"a": {"b": 2}}']
    page = "<html><nav>menu</nav><script>x()</script><p>uno &amp; dos</p><div>tres<br>cuatro</div></html>"
    assert values(spark, tx.html_text("t"), [page, None]) == ["uno & dos\ntres\ncuatro", ""]


def test_exam_noise(spark):
    text = "RESPUESTAS ENARM\n12. RESPUESTA CORRECTA: B COMENTARIO: explica\n\nAnemia ........................................ 14\ntexto"
    assert values(spark, tx.strip_exam_noise("t"), [text, None]) == ["explica\ntexto", ""]
