"""Judging answers: interfaces for judges and answerers that are called row by row within Arrow batches, and offline stand-ins.

A judge is a function from a row (dict) to a dict of scores. What it gives is clamped to 0..1; what it raises becomes an error
in its row, after ``attempts`` tries where the error may pass, and no row is lost. Stand-ins compare words: they say nothing
of any model's quality.
"""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions import lexicon as lx

_WORDS = re.compile(r"[\w]+")


class Retryable(Exception):
    """An error that may pass (a rate limit, a failure of the service): the call is tried again after a pause."""


def called(f: Callable[[dict], dict], row: dict, attempts: int = 5, pause: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """``f(row)``; after a :class:`Retryable` error again, up to ``attempts`` times, with pauses that double and vary by up to a second."""
    for k in range(attempts):
        try:
            return f(row)
        except Retryable:
            if k == attempts - 1:
                raise
            sleep(pause * 2**k + random.random())
    return {}


def _clamped(value) -> float | None:
    try:
        value = float(value)
    except (TypeError, ValueError):
        return None
    return None if value != value else min(1.0, max(0.0, value))


def evaluated(rows: DataFrame, key: str, columns: Sequence[str], judge: Callable[[dict], dict], scores: Sequence[str], attempts: int = 5) -> DataFrame:
    """(key, ``scores`` clamped to 0..1, ``error``): a score that is missing is null; a judge that fails gives an error and null scores."""
    names = list(dict.fromkeys([key, *columns]))
    schema = T.StructType([rows.schema[key], *[T.StructField(s, T.DoubleType()) for s in scores], T.StructField("error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.astype(object).where(frame.notna(), None).to_dict("records"):
                try:
                    given, error = called(judge, row, attempts), None
                except Exception as e:  # noqa: BLE001
                    given, error = {}, f"{type(e).__name__}: {e}"
                out.append([row[key], *[_clamped(given.get(s)) for s in scores], error])
            yield pd.DataFrame(out, columns=schema.names)

    return rows.select(*names).mapInPandas(run, schema)


def pair_quality(rows: DataFrame, key: str, columns: Sequence[str], judge: Callable[[dict], dict], attempts: int = 5) -> DataFrame:
    """(key, three scores, ``quality_verdict``, ``quality_reason``): as :func:`evaluated`, but a judge that fails gives zeros and a
    reject, and a verdict that isn't known is a reject."""
    scores = lx.QUALITY_FIELDS[:3]

    def text(row: dict) -> dict:
        given = judge(row)
        return given | {"_verdict": str(given.get("verdict") or "").strip().lower(), "_reason": given.get("reason")}

    names = list(dict.fromkeys([key, *columns]))
    schema = T.StructType([rows.schema[key], *[T.StructField(s, T.DoubleType()) for s in scores], *[T.StructField(c, T.StringType()) for c in lx.QUALITY_FIELDS[3:]]])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.astype(object).where(frame.notna(), None).to_dict("records"):
                try:
                    given = called(text, row, attempts)
                    verdict = given["_verdict"] if given["_verdict"] in ("accept", "reject") else "reject"
                    out.append([row[key], *[_clamped(given.get(s)) or 0.0 for s in scores], verdict, given["_reason"]])
                except Exception as e:  # noqa: BLE001
                    out.append([row[key], 0.0, 0.0, 0.0, "reject", f"{type(e).__name__}: {e}"])
            yield pd.DataFrame(out, columns=schema.names)

    return rows.select(*names).mapInPandas(run, schema)


def share_of_words(of: str | None, there: str | None) -> float:
    """The share of the distinct words of one text that another has; 0 without words."""
    own = set(_WORDS.findall((of or "").lower()))
    return len(own & set(_WORDS.findall((there or "").lower()))) / len(own) if own else 0.0


def word_judge(row: dict) -> dict:
    """A stand-in for a judge: how much of the answer stands in the context, of the question in the answer, and of the answer in a second
    answer, the context's first sentence."""
    context, question, answer = (str(row.get(c) or "") for c in ("contexto_fuente", "pregunta", "respuesta"))
    out = {"faithfulness": share_of_words(answer, context), "answer_relevancy": share_of_words(question, answer), "roundtrip_consistency": share_of_words(answer, context.split(". ")[0])}
    return out | {"verdict": "accept" if out["faithfulness"] >= 0.2 else "reject", "reason": "words"}


def predictions_evaluated(rows: DataFrame, key: str, judge: Callable[[dict], dict], generated: str, reference: str, similarity: str | None = None) -> DataFrame:
    """(key, faithfulness, relevancy, ``answer_correctness``, ``semantic_similarity``, ``error``) of predictions: the judge's scores, and where
    it gives none for correctness the overlap of the answer's and the reference's words; ``similarity`` names a column of cosines."""
    from tamiz.operators.qa import grounding

    got = evaluated(rows, key, [c for c in rows.columns if c != key], judge, ("faithfulness", "answer_relevancy", "answer_correctness"))
    own = rows.select(F.col(key).alias("_k"), grounding(reference, generated).alias("_c"), (F.col(similarity) if similarity else F.lit(None).cast("double")).alias("semantic_similarity"))
    out = got.join(own, F.col(key) == F.col("_k"))
    return out.select(key, "faithfulness", "answer_relevancy", F.coalesce("answer_correctness", "_c").alias("answer_correctness"), "semantic_similarity", "error")
