"""What chunks and source documents are: sections, roles, topics, languages, document types, inclusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions import lexicon as lx
from tamiz.functions import text as tx
from tamiz.plans.durable import once


def enriched(chunks: DataFrame, text: str, section: str) -> DataFrame:
    """``chunks`` with ``section_type``, ``content_role``, ``language``, ``topics``, ``topic_tags`` (the same) and ``topic_count``, replacing columns of
    these names, and with ``pdf_id`` from ``source_pdf`` where it is missing."""
    t = F.coalesce(F.col(text), F.lit(""))
    sample = F.substring(t, 1, 500)
    out = once(
        chunks, _norm=tx.normalize(t), _head=tx.normalize(section), _sample=tx.normalize(sample), _opening=tx.normalize(F.substring(t, 1, 2000)),
        _words=tx.word_count(t), _refs=tx.reference_ratio(t), _few=tx.word_count(sample), _srefs=tx.reference_ratio(sample),
    )
    out = once(out, _score=tx.clinical_score(F.col("_norm"), F.col("_words"), F.col("_refs")), _first=tx.clinical_score(F.col("_sample"), F.col("_few"), F.col("_srefs")))
    out = once(out, section_type=tx.section_type(F.col("_head"), F.substring("_sample", 1, 500), F.col("_first")))
    out = once(
        out, content_role=tx.content_role(F.col("_opening"), F.col("section_type"), F.col("_score")), language=tx.detect_language(F.substring(t, 1, 4000)),
        topics=tx.topics(F.col("_norm")),
    )
    if "source_pdf" in chunks.columns:
        own = F.nullif(F.col("pdf_id"), F.lit("")) if "pdf_id" in chunks.columns else F.lit(None).cast("string")
        out = out.withColumn("pdf_id", F.coalesce(own, tx.slugify("source_pdf")))
    return out.withColumn("topic_tags", F.col("topics")).withColumn("topic_count", F.size("topics")).drop("_norm", "_head", "_sample", "_opening", "_words", "_refs", "_few", "_srefs", "_score", "_first")


def for_language_models(chunks: DataFrame, languages: tuple[str, ...] = ("es", "unknown")) -> DataFrame:
    """Chunks of wanted languages (all if none are named) and of no navigation or administrative role; null counts as unknown."""
    keep = ~F.coalesce(F.col("content_role"), F.lit("unknown")).isin(*lx.EXCLUDED_ROLES)
    if languages:
        keep = keep & F.lower(F.coalesce(F.col("language"), F.lit("unknown"))).isin(*languages)
    return chunks.filter(keep)


def language_matches(text: Column | str, language: Column | str, allowed: tuple[str, ...] = ("es",)) -> Column:
    """By the language's name if there is one; else a text passes that looks Spanish, if Spanish is allowed, or any text if it isn't."""
    name = F.lower(F.trim(F.coalesce(F.col(language) if isinstance(language, str) else language, F.lit(""))))
    return F.when(name != "", name.isin(*allowed)).otherwise(tx.looks_spanish(text) if "es" in allowed else F.lit(True))


def of_least_score(chunks: DataFrame, score: str, least: int) -> DataFrame:
    """Chunks of at least that score (null counts as 0); all if it is not above 0."""
    return chunks.filter(F.coalesce(F.col(score), F.lit(0)) >= least) if least > 0 else chunks


def of_roles(chunks: DataFrame, role: str, allowed: tuple[str, ...] = lx.TRAINING_ROLES) -> DataFrame:
    """Chunks of the allowed roles; null counts as unknown."""
    return chunks.filter(F.coalesce(F.col(role), F.lit("unknown")).isin(*allowed))


def role_filter_stats(chunks: DataFrame, role: str, allowed: tuple[str, ...] = lx.TRAINING_ROLES) -> DataFrame:
    """(``role``, ``kept``, ``n``): how many chunks of each role a filter by role keeps."""
    own = F.coalesce(F.col(role), F.lit("unknown"))
    return chunks.groupBy(own.alias("role")).agg(F.count(F.lit(1)).alias("n")).withColumn("kept", F.col("role").isin(*allowed))


def topic_coverage(chunks: DataFrame, topics: str, role: str, allowed: tuple[str, ...] = lx.TRAINING_ROLES, least: float = 0.30) -> DataFrame:
    """(``topic``, ``original``, ``filtered``, ``ratio``, ``below``): what a filter by role leaves of each topic."""
    rows = chunks.select(F.explode(topics).alias("topic"), F.coalesce(F.col(role).isin(*allowed), F.lit(False)).alias("_kept"))
    out = rows.groupBy("topic").agg(F.count(F.lit(1)).alias("original"), F.count_if("_kept").alias("filtered"))
    return out.withColumn("ratio", F.col("filtered").cast("double") / F.col("original")).withColumn("below", F.col("ratio") < least)


def ocr_status(needs: Column, pages: Column) -> Column:
    ratio = F.try_divide(F.coalesce(needs, F.lit(0)).cast("double"), pages)
    return tx.cascade([("unknown", F.coalesce(pages, F.lit(0)) == 0), ("clean", ratio == 0), ("minor", ratio <= 0.2), ("needs_ocr", ratio <= 0.5)], "dominated")


def inclusion_reason(pages: Column, size: Column, sample: Column, min_pages: int = 3, max_empty: float = 0.8) -> Column:
    """Why a document is excluded; null if it is included."""
    text = F.coalesce(sample, F.lit(""))
    empty = F.regexp_count(text, F.lit("\n\n")).cast("double") / F.greatest(F.lit(1), F.length(text))
    return tx.cascade([
        ("empty", pages < min_pages), ("corrupted", size < 1024), ("empty", (text != "") & (empty > max_empty)),
        ("wrong_language", (F.length(text) > 200) & (tx.contained(F.lower(text), lx.SAMPLE_MARKERS) < 3)),
    ], None)


def evaluated_inclusion(ocr_ratio: Column, density: Column, pages: Column) -> Column:
    """The other rule: too much OCR, too few clinical words, too few pages; null if included."""
    return tx.cascade([("ocr_dominated", ocr_ratio > 0.5), ("low_clinical_density", density < 0.10), ("empty", pages < 3)], None)


def exclusion_report(inventory: DataFrame, document: str, status: str, reason: str) -> DataFrame:
    """(``reason``, ``document``, ``n``, ``rate``): a row for each reason with a null document, its number and its rate of all documents,
    and a row for each excluded document. However many there are, no row holds more than one."""
    total = inventory.agg(F.count(F.lit(1)).alias("_all"))
    out = inventory.filter(F.col(status).isin("excluded", "excluded_with_reason")).select(F.coalesce(F.col(reason), F.lit("unknown")).alias("reason"), F.col(document).alias("document"))
    per = out.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(total))
    whole = per.select("reason", F.lit(None).cast("string").alias("document"), "n", (F.col("n").cast("double") / F.col("_all")).alias("rate"))
    return whole.unionByName(out.select("reason", "document", F.lit(1).cast("long").alias("n"), F.lit(None).cast("double").alias("rate")))


def split_topics(rows: DataFrame, topics: str, split: str) -> DataFrame:
    """(``topic``, ``coverage``): in every split, or in which of them alone (train, validation, test), else ''."""
    t, v, s = (F.max(F.col("_s") == x).alias(x) for x in ("train", "validation", "test"))
    per = rows.select(F.explode(topics).alias("topic"), F.col(split).alias("_s")).filter(F.col("_s").isNotNull()).groupBy("topic").agg(t, v, s)
    train, validation, test = F.col("train"), F.col("validation"), F.col("test")
    kind = tx.cascade([
        ("shared", train & validation & test), ("train_not_validation", train & ~validation), ("validation_not_train", validation & ~train),
        ("test_only", test & ~train & ~validation),
    ])
    return per.select("topic", kind.alias("coverage"))
