"""Question-answer data: how many pairs to ask for, grounding, gates, records, variants and evaluation."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions import lexicon as lx
from tamiz.functions import text as tx
from tamiz.operators.ordered import ranked

#: Fixed value: the user message of the grounded variant.
GROUNDED = "Contexto fuente:\n{context}\n\nPregunta:\n{question}"


def pairs_per_chunk(tokens: Column, score: Column, least: int = 2, most: int = 5) -> Column:
    """More pairs for longer and clinically richer chunks, within the limits."""
    n = F.when(tokens < 400, least).when(tokens < 700, least + 1).otherwise(max(least + 1, most - 1))
    return F.least(F.greatest(F.when(score >= 20, F.least(n + 1, F.lit(most))).otherwise(n), F.lit(least)), F.lit(most))


def cost_estimate(chunks: DataFrame, tokens: Column, score: Column, least: int = 2, most: int = 5) -> DataFrame:
    """(``model``, ``pairs``, ``input_tokens``, ``output_tokens``, ``cost``) for each model of the price list."""
    sums = chunks.agg(F.sum(pairs_per_chunk(tokens, score, least, most)).alias("pairs"), F.sum(F.coalesce(tokens, F.lit(500))).alias("input_tokens"))
    sums = sums.withColumn("output_tokens", F.col("pairs") * lx.OUTPUT_TOKENS_PER_PAIR)
    prices = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(i).alias("i"), F.lit(o).alias("o")) for m, (i, o) in lx.PRICES.items()])
    cost = (F.col("input_tokens") * F.col("p.i") + F.col("output_tokens") * F.col("p.o")) / F.lit(1e6)
    return sums.withColumn("p", F.explode(prices)).select("p.model", "pairs", "input_tokens", "output_tokens", cost.alias("cost"))


def grounding(context: Column | str, answer: Column | str) -> Column:
    """The share of the context's distinct words that the answer holds; 0 for a context without words."""
    own = tx.word_set(context)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(own, tx.word_set(answer))).cast("double"), F.size(own)), F.lit(0.0))


def grounding_by_chunk(pairs: DataFrame, chunk: str, context: str, answer: str, low: float = 0.15) -> DataFrame:
    """(chunk, ``pairs``, ``overlap``, ``low``): the mean overlap of each chunk's pairs, rounded to four digits, and how many are below ``low``."""
    rows = pairs.select(chunk, grounding(context, answer).alias("_o"))
    return rows.groupBy(chunk).agg(F.count(F.lit(1)).alias("pairs"), (F.floor(F.round(F.avg("_o") * 10000, 6) + 0.5) / 10000).alias("overlap"), F.count_if(F.col("_o") < low).alias("low"))


def gated_verdict(verdict: Column, gate: dict[str, float] | None = None) -> Column:
    """Reject if any score is below its threshold; unknown verdicts are rejects; a missing score passes no judgement."""
    low = F.lit(False)
    for c, least in (gate or lx.QUALITY_GATE).items():
        low = low | F.coalesce(F.greatest(F.least(F.col(c), F.lit(1.0)), F.lit(0.0)) < least, F.lit(False))
    known = F.lower(F.trim(F.coalesce(verdict, F.lit(""))))
    return F.when(low, "reject").when(known.isin("accept", "reject"), known).otherwise("reject")


def qa_id(chunk_id: Column, number: Column) -> Column:
    padded = F.when(number >= 1000, number.cast("string")).otherwise(F.lpad(number.cast("string"), 3, "0"))
    name = F.concat(F.lit("qa_"), padded)
    return F.when(F.coalesce(chunk_id, F.lit("")) == "", name).otherwise(F.concat(chunk_id, F.lit("_"), name))


def raw_records(chunks: DataFrame, pairs: str, qualities: str | None = None) -> DataFrame:
    """One row per pair of ``chunks``: ids by place, the pair's and the chunk's fields, and the quality at the same place (null if missing)."""
    zipped = F.arrays_zip(F.col(pairs).alias("pair"), F.col(qualities).alias("quality")) if qualities else F.transform(pairs, lambda p: F.struct(p.alias("pair")))
    out = chunks.select("*", F.posexplode(zipped).alias("_i", "_z")).filter(F.col("_z.pair").isNotNull())
    extra = ["_z.quality.*"] if qualities else []
    rest = [c for c in chunks.columns if c not in (pairs, qualities)]
    return out.select(qa_id(F.col("chunk_id"), F.col("_i") + 1).alias("qa_id"), *rest, "_z.pair.*", *extra)


def sft_messages(system: Column, question: Column, answer: Column) -> Column:
    role = lambda r, c: F.struct(F.lit(r).alias("role"), F.coalesce(c, F.lit("")).alias("content"))
    return F.array(role("system", system), role("user", question), role("assistant", answer))


def grounded_messages(messages: Column, context: Column) -> Column:
    """The second message asks with the context before the question."""
    before, between = GROUNDED.split("{context}")[0], GROUNDED.split("{context}")[1].split("{question}")[0]
    asked = lambda m: F.concat(F.lit(before), F.trim(F.coalesce(context, F.lit(""))), F.lit(between), m.content)
    return F.transform(messages, lambda m, i: F.struct(m.role.alias("role"), F.when(i == 1, asked(m)).otherwise(m.content).alias("content")))


def without_fields(df: DataFrame, names: Iterable[str] = lx.QUALITY_FIELDS) -> DataFrame:
    """``df`` without columns and nested fields of these names, at any depth of structs and arrays."""
    drop = set(names)

    def pruned(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            kept = [f for f in kind.fields if f.name not in drop]
            return F.when(c.isNotNull(), F.struct(*[pruned(c[f.name], f.dataType).alias(f.name) for f in kept])) if kept else F.lit(None)
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
            return F.transform(c, lambda x: pruned(x, kind.elementType))
        return c

    return df.select(*[pruned(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields if f.name not in drop])


def _last_assistant(messages: Column) -> Column:
    """The 1-based place of the last assistant message, 0 if there is none."""
    at = F.array_position(F.reverse(F.transform(messages, lambda m: m.role)), "assistant")
    return F.when(at > 0, F.size(messages) - at + 1).otherwise(0)


def prompt_completion(messages: Column) -> Column:
    """A struct of ``prompt`` and ``completion``, cut at the last assistant message, and ``error`` where that can't be."""
    at = _last_assistant(messages)
    error = F.when(messages.isNull(), "no messages").when(at == 0, "no assistant message").when(at == 1, "no message before the assistant's")
    good = error.isNull()
    return F.struct(
        F.when(good, F.slice(messages, F.lit(1), (at - 1).cast("int"))).alias("prompt"),
        F.when(good, F.slice(messages, F.greatest(at, F.lit(1)).cast("int"), F.size(messages))).alias("completion"), error.alias("error"),
    )


def asked_question(messages: Column) -> Column:
    """The last user message, after its first ``Pregunta:`` if it has one; '' without a user message."""
    last = F.try_element_at(F.filter(messages, lambda m: m.role == "user"), F.lit(-1)).content
    text = tx.strip(F.coalesce(last, F.lit("")))
    at = F.locate("Pregunta:", text)
    return F.when(at > 0, tx.strip(F.substr(text, at + 9))).otherwise(text)


def reference_answer(messages: Column) -> Column:
    return tx.strip(F.coalesce(F.try_element_at(F.filter(messages, lambda m: m.role == "assistant"), F.lit(-1)).content, F.lit("")))


def score_summary(rows: DataFrame, scores: Iterable[str], verdict: str | None = None) -> DataFrame:
    """(``metric``, ``scored``, ``mean``, ``least``, ``most``) over non-null values, and the acceptance among scored rows as a metric."""
    scores = list(scores)
    aggregates = [f(c).alias(f"{n}_{c}") for c in scores for n, f in (("n", F.count), ("a", F.avg), ("l", F.min), ("m", F.max))]
    one = rows.agg(*aggregates, *([F.avg(F.when(F.col(scores[0]).isNotNull(), (F.coalesce(F.col(verdict), F.lit("")) == "accept").cast("double"))).alias("_v")] if verdict else []))
    each = [F.struct(F.lit(c).alias("metric"), F.col(f"n_{c}").alias("scored"), F.col(f"a_{c}").cast("double").alias("mean"), F.col(f"l_{c}").cast("double").alias("least"), F.col(f"m_{c}").cast("double").alias("most")) for c in scores]
    if verdict:
        none = F.lit(None).cast("double")
        each.append(F.struct(F.lit("acceptance").alias("metric"), F.col(f"n_{scores[0]}").alias("scored"), F.col("_v").alias("mean"), none.alias("least"), none.alias("most")))
    return one.select(F.explode(F.array(*each)).alias("x")).select("x.*")


def text_stats(rows: DataFrame, question: str, answer: str) -> DataFrame:
    """One row: words of questions and answers, answers that speak of their source, questions with ' y '."""
    q, a = tx.token_count(question), tx.token_count(answer)
    low = F.lower(F.coalesce(F.col(answer), F.lit("")))
    meta = low.rlike(r"\b(el fragmento|el contexto|el texto|seg[uú]n el|de acuerdo con|con base en)\b")
    return rows.agg(
        F.avg(q).alias("avg_question_words"), F.avg(a).alias("avg_answer_words"), F.min(a).alias("min_answer_words"), F.max(a).alias("max_answer_words"),
        F.count_if(meta).alias("meta_answer_refs"), F.count_if(F.contains(F.lower(F.coalesce(F.col(question), F.lit(""))), F.lit(" y "))).alias("questions_with_y"),
    )


def merged_scores(base: DataFrame, key: str, reports: dict[str, DataFrame]) -> DataFrame:
    """``base`` with a column for each report (``key``, ``value``, ``at``): the last value by ``at`` where the report has the key, else the base's own column of that name."""
    out = base
    for name, report in reports.items():
        last = report.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct("value"), "at").alias("_v"))
        out = out.join(last, out[key] == F.col("_k"), "left")
        own = F.col(name) if name in base.columns else F.lit(None).cast("double")
        out = out.withColumn(name, F.when(F.col("_v").isNotNull(), F.col("_v.value")).otherwise(own)).drop("_k", "_v")
    return out


def nearest(vectors: DataFrame, id_col: str, vector: str, wanted: Column, k: int = 5, blocks: int | None = None) -> DataFrame:
    """(``query``, ``neighbour``, ``similarity``, ``rank``): the ``k`` most similar rows by cosine to each row that is ``wanted``.

    All rows are searched, in blocks: rows lie in one block each, queries go to every block, and a block's similarities
    are one matrix product per slice, of which only the best ``k`` leave it. Rows without a vector (null, empty, zero)
    are neither asked nor found; ties go to the lower id. Vectors of one table must have one length.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), wanted.alias("w")).filter(F.size("v") > 0)
    if blocks is None:
        # A block's vectors lie in one task's memory: about 64 MB of them each.
        size = rows.agg(F.sum(F.size("v")).alias("s")).head()["s"] or 0
        blocks = max(2, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size * 8 // (64 << 20)))
    stored = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "id", "v")
    asked = rows.filter("w").select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "v")

    def unit(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids, v = t["id"].to_numpy(), np.array(t["v"].to_pylist(), dtype=float).reshape(t.num_rows, -1)
        norm = np.sqrt((v * v).sum(axis=1))
        return ids[norm > 0], v[norm > 0] / norm[norm > 0, None]

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            (ids, v), (qids, q) = unit(left), unit(right)
            order = np.argsort(ids, kind="stable")
            ids, v = ids[order], v[order]
            for i in range(0, len(qids), 256):
                sims = q[i : i + 256] @ v.T
                for qid, s in zip(qids[i : i + 256], sims, strict=True):
                    s[ids == qid] = -2
                    for j in np.argsort(-s, kind="stable")[:k]:
                        if s[j] > -2:
                            out.append((int(qid), int(ids[j]), float(s[j])))
        return pa.Table.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["query", "neighbour", "similarity"])

    near = stored.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(best, "query long, neighbour long, similarity double")
    return ranked(near, ["query"], [F.col("similarity").desc(), F.col("neighbour").asc()]).filter(F.col("rank") <= k)


def generated(chunks: DataFrame, generate: Callable[[dict], list[dict]], columns: Iterable[str], key: str = "chunk_id", attempts: int = 5) -> DataFrame:
    """(key, ``status``, ``pairs``): what a generator gives for each chunk. Statuses ``ok``, ``empty`` and ``refused`` are
    final, ``failed`` may be tried again. A generator that raises ``PermissionError`` refuses; a ``Retryable`` error (a rate limit, a failure
    of the service) is tried up to ``attempts`` times with growing pauses, any other fails at once."""
    from tamiz.operators.evaluation import called

    pair = "struct<pregunta:string,respuesta:string,tipo:string,dificultad:string,contexto_fuente:string>"
    names = list(dict.fromkeys([key, *columns]))

    def one(row: dict) -> tuple[str, list]:
        try:
            pairs = [p for p in called(generate, row, attempts) if str(p.get("pregunta") or "").strip() and str(p.get("respuesta") or "").strip()]
            return ("ok" if pairs else "empty"), pairs
        except PermissionError:
            return "refused", []
        except Exception:  # noqa: BLE001
            return "failed", []

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            results = [one(r) for r in frame.to_dict("records")]
            fields = ("pregunta", "respuesta", "tipo", "dificultad", "contexto_fuente")
            yield pd.DataFrame({key: frame[key], "status": [s for s, _ in results], "pairs": [[{f: p.get(f) for f in fields} for p in ps] for _, ps in results]})

    return chunks.select(*names).mapInPandas(run, f"{key} string, status string, pairs array<{pair}>")


def extractive_pairs(row: dict) -> list[dict]:
    """A stand-in for a language model: each of the first sentences of a text as an answer. Its output says nothing of any model's quality."""
    sentences = [s.strip() for s in str(row.get("text") or "").replace("\n", " ").split(". ") if len(s.split()) >= 8][:2]
    return [{"pregunta": f"¿Qué se afirma en el punto {i}?", "respuesta": s, "tipo": "factual", "dificultad": "basico", "contexto_fuente": s} for i, s in enumerate(sentences, 1)]
