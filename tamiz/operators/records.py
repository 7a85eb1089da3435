"""Records that the stages hand on: language-model records, chat records, flat records, predictions, manifest entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions import lexicon as lx
from tamiz.functions import text as tx
from tamiz.operators.qa import asked_question, qa_id, reference_answer, sft_messages


def preview(text: Column | str, most: int) -> Column:
    """White space collapsed; a text over ``most`` characters is cut to that length with three dots at its end."""
    flat = tx.collapse(text)
    return F.when(F.length(flat) <= most, flat).otherwise(F.concat(F.rtrim(F.substring(flat, 1, most - 3)), F.lit("...")))


def first_filled(*fields: Column | str) -> Column:
    """The first field that is neither null nor empty, trimmed; '' if there is none. Canonical names come before older ones."""
    filled = [F.nullif((F.col(f) if isinstance(f, str) else f).cast("string"), F.lit("")) for f in fields]
    return F.trim(F.coalesce(*filled, F.lit("")))


def topics_of(topics: str = "topics", tags: str = "topic_tags") -> Column:
    """The topics, or the topic tags where there are none; an empty array without either."""
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(F.size(topics), F.lit(0)) > 0, F.col(topics)).otherwise(F.coalesce(F.col(tags), none))


def lm_records(chunks: DataFrame, split: Column | None = None) -> DataFrame:
    """``text`` and ``metadata`` of each chunk: exam noise stripped, white space collapsed, a default for every missing field."""
    own = topics_of()
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    unknown = lambda c: F.coalesce(F.col(c), F.lit("unknown"))
    fields = {
        "source": F.lit(lx.LM_SOURCE), "pdf_id": text("pdf_id"), "source_pdf": F.col("source_pdf"), "source_path": text("source_path"), "doc_type": unknown("doc_type"),
        "pages": F.coalesce("pages", F.array().cast("array<int>")), "section": text("section"), "chunk_id": text("chunk_id"),
        "token_estimate": F.coalesce("token_estimate", F.lit(0)), "clinical_score": F.coalesce("clinical_score", F.lit(0)), "section_type": unknown("section_type"),
        "content_role": unknown("content_role"), "language": unknown("language"), "topics": own, "topic_tags": own, "topic_count": F.coalesce("topic_count", F.size(own)),
        "split": F.coalesce(split, F.lit("")) if split is not None else F.lit(""),
    }
    return chunks.select(tx.collapse(tx.strip_exam_noise("text")).alias("text"), F.struct(*[c.alias(n) for n, c in fields.items()]).alias("metadata"))


def lm_record_errors(records: DataFrame, order: str, most: int = 50) -> DataFrame:
    """(``line``, ``error``): the first ``most`` faults of records in order: messages where none belong, no text, no metadata."""
    from tamiz.operators.ordered import ranked

    has = F.col("messages").isNotNull() if "messages" in records.columns else F.lit(False)
    faults = F.array_compact(F.array(
        F.when(has, "unexpected messages field"), F.when(tx.collapse("text") == "", "empty text"), F.when(F.col("metadata").isNull(), "missing metadata"),
    ))
    placed = ranked(records.select(order, faults.alias("_f")), [], [F.col(order).asc()], "line")
    found = placed.filter(F.size("_f") > 0).select(F.col("line").cast("long").alias("line"), F.posexplode("_f").alias("_at", "error"))
    return found.orderBy("line", "_at").limit(most).select("line", "error")


def sft_records(chunks: DataFrame, pairs: str, qualities: str | None = None) -> DataFrame:
    """One chat record per pair of each chunk: ``messages`` and ``metadata`` with ids by place and the quality at the same place
    (null where there is none). ``chunks`` has the chunk's fields beside the arrays ``pairs`` and ``qualities``."""
    quality = F.get(F.col(qualities), F.col("_i")) if qualities else F.lit(None)
    out = chunks.select("*", F.posexplode(pairs).alias("_i", "_p")).filter(F.col("_p").isNotNull()).withColumn("_q", quality)
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    fields = {
        "source": F.lit(lx.SFT_SOURCE), "source_pdf": text("source_pdf"), "chunk_id": text("chunk_id"), "qa_id": qa_id(F.col("chunk_id"), F.col("_i") + 1),
        "pages": F.coalesce("pages", F.array().cast("array<int>")), "section": text("section"), "section_type": text("section_type"), "content_role": text("content_role"),
        "topics": topics_of(), "split": text("split"), "clinical_score": F.coalesce("clinical_score", F.lit(0)), "token_estimate": F.coalesce("token_estimate", F.lit(0)),
        **{c: F.col(f"_p.{c}") for c in ("tipo", "dificultad", "contexto_fuente")},
        **{c: F.col(f"_q.{c}") if qualities else F.lit(None) for c in lx.QUALITY_FIELDS[:4]},
    }
    messages = sft_messages(F.lit(lx.SFT_SYSTEM), F.col("_p.pregunta"), F.col("_p.respuesta"))
    return out.select(messages.alias("messages"), F.struct(*[c.alias(n) for n, c in fields.items()]).alias("metadata"))


def flat_records(chunks: DataFrame, pairs: str, qualities: str | None = None) -> DataFrame:
    """As :func:`sft_records`, one flat row per pair, with the reason of its quality."""
    quality = F.get(F.col(qualities), F.col("_i")) if qualities else F.lit(None)
    out = chunks.select("*", F.posexplode(pairs).alias("_i", "_p")).filter(F.col("_p").isNotNull()).withColumn("_q", quality)
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return out.select(
        qa_id(F.col("chunk_id"), F.col("_i") + 1).alias("qa_id"), *map(text, ("chunk_id", "source_pdf", "section", "section_type", "content_role")), topics_of().alias("topics"),
        text("split"), F.coalesce("pages", F.array().cast("array<int>")).alias("pages"), F.coalesce("clinical_score", F.lit(0)).alias("clinical_score"),
        F.coalesce("token_estimate", F.lit(0)).alias("token_estimate"), *[F.col(f"_p.{c}").alias(c) for c in ("pregunta", "respuesta", "tipo", "dificultad", "contexto_fuente")],
        *[(F.col(f"_q.{c}") if qualities else F.lit(None)).alias(c) for c in lx.QUALITY_FIELDS],
    )


def merged_metadata(rows: DataFrame, chunks: DataFrame, key: str = "chunk_id", fields: tuple[str, ...] = lx.CHUNK_FIELDS) -> DataFrame:
    """``rows`` with ``fields`` filled, where they are missing or null, from the chunk of the same key; of chunks with equal keys
    one counts. Rows without a chunk keep what they have."""
    here = [c for c in fields if c in chunks.columns]
    known = chunks.filter(F.coalesce(F.col(key), F.lit("")) != "").groupBy(F.col(key).alias("_k")).agg(F.max(F.struct(*here)).alias("_c"))
    out = rows.join(known, F.col(key) == F.col("_k"), "left")
    for c in here:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_c.{c}")) if c in rows.columns else F.col(f"_c.{c}"))
    return out.drop("_k", "_c")


def prediction_records(examples: DataFrame, messages: str, generated: str, metadata: str) -> DataFrame:
    """What a model answered to each example beside what it was asked and should have said. The prompt is the messages before the answer."""
    m, meta = F.col(messages), F.col(metadata)
    answer = tx.strip(F.coalesce(F.col(generated), F.lit("")))
    prompt = F.array_join(F.transform(F.filter(m, lambda x: x.role != "assistant"), lambda x: F.concat(x.role, F.lit(": "), x.content)), "\n")
    return examples.select(
        meta["qa_id"].alias("id"), asked_question(m).alias("question"), answer.alias("generated_answer"), reference_answer(m).alias("reference_answer"),
        F.coalesce(meta["contexto_fuente"], F.lit("")).alias("source_context"), prompt.alias("prompt_text"), answer.alias("generated"), m.alias("reference_messages"), meta.alias("metadata"),
    )


def document_metadata(metadata: Column) -> Column:
    """The eight fields of a document's metadata, empty ones null; all null without metadata."""
    return F.struct(*[F.nullif(metadata[c], F.lit("")).alias(c) for c in lx.METADATA_FIELDS])


def manifest_entries(inventory: DataFrame) -> DataFrame:
    """Entries as they are stored: an excluded document is ``excluded_with_reason``, unknown types and states are named, the share of
    clinical terms is rounded to four digits, and empty metadata are null."""
    status = F.when(F.col("inclusion_status") == "excluded", "excluded_with_reason").otherwise(F.coalesce("inclusion_status", F.lit("unknown")))
    return inventory.select(
        "pdf_id", "source_pdf", "source_path", F.coalesce("file_size", F.lit(0)).alias("file_size"), F.coalesce("page_count", F.lit(0)).alias("page_count"),
        F.coalesce("doc_type", F.lit("unknown")).alias("doc_type"), status.alias("inclusion_status"), "exclusion_reason",
        F.coalesce(F.col("ocr_status.status"), F.lit("unknown")).alias("ocr_status"), F.round(F.coalesce("clinical_term_ratio", F.lit(0.0)), 4).alias("clinical_term_ratio"),
        document_metadata(F.col("metadata")).alias("metadata"),
    )


def read_entries(entries: DataFrame) -> DataFrame:
    """Stored entries read back: ``excluded_with_reason`` is an excluded document again."""
    return entries.withColumn("inclusion_status", F.when(F.col("inclusion_status") == "excluded_with_reason", "excluded").otherwise(F.col("inclusion_status")))


def joined_by_suffix(left: DataFrame, right: DataFrame, path: str) -> DataFrame:
    """``left`` with the columns of the row of ``right`` whose file's name ends alike: what stands between the last underscore and the
    extension. Rows of ``left`` without one stay."""
    suffix = F.regexp_extract(F.col(path), r"_([^_/.]+)\.[^/]*$", 1)
    of = right.withColumn("_s", suffix).drop(path)
    return left.withColumn("_t", suffix).join(of, (F.col("_t") == F.col("_s")) & (F.col("_t") != ""), "left").drop("_s", "_t")
