"""Problem 4: broken prompt and response pairs."""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence, Set

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm import answers
from tamiz.llm.postings import folded
from tamiz.llm.wordsets import mix, slices, word_hashes, words_in_order
from tamiz.plans.durable import durable

ORDERS = 6
#: Bits of the bitmap of contexts that are asked; it only keeps others out of the shuffle, never decides.
ASKED_BITS = 27
#: A context must have been met so often to be asked; below the share of sentence ends an answer without a final stop breaks off.
LEAST_SEEN, LEAST_FINAL = 8, 0.15
#: Words in fewer of the texts stand for their class, as names and word fragments do; those in fewer than KNOWN_SHARE aren't
#: known at all.
RARE_SHARE, KNOWN_SHARE = 0.003, 0.0005
_RARE, _NUMBER, _BEGIN = np.uint64(11), np.uint64(22), np.uint64(33)


def _contexts(texts: list, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every word its contexts of one to ORDERS words (64-bit hashes), its text, whether a stop follows and whether
    it is its text's last. Words not in ``common``, numbers and sentence beginnings stand for their class."""
    owner, hashes, digit, stop = words_in_order(texts)
    place = np.searchsorted(common, hashes)
    kept = (common[np.minimum(place, len(common) - 1)] == hashes) if len(common) else np.zeros(len(hashes), bool)
    word = np.where(kept, hashes + np.uint64(64), _RARE)
    word[digit] = _NUMBER
    last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
    begins = np.append(True, (owner[1:] != owner[:-1]) | stop[:-1]) if len(owner) else np.zeros(0, bool)
    place = np.arange(len(word)) - np.maximum.accumulate(np.where(begins, np.arange(len(word)), 0))
    contexts = np.zeros((ORDERS, len(word)), dtype=np.uint64)
    key = np.zeros(len(word), dtype=np.uint64)
    for k in range(ORDERS):
        before = np.full(len(word), _BEGIN)
        before[k:] = np.where(place[k:] >= k, word[: len(word) - k] if k else word, _BEGIN)
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + before + np.uint64(k + 1))
        contexts[k] = key
    return contexts, owner, stop, last


def common_words(rows: DataFrame, text: str) -> tuple[list[str], list[str]]:
    """The words, ascending, that enough of the texts hold to be known, and not to be rare. They are counted exactly; as each is
    in KNOWN_SHARE of the texts (or the texts are few), there are at most words per text / KNOWN_SHARE of them."""
    one = rows.select(F.col(text).cast("string").alias("t"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                counts.update(set(answers.tokens(t)))
                if len(counts) > 1 << 18:
                    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
                    counts.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    total = one.count()
    counts = one.mapInArrow(words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = sorted(map(tuple, counts.filter(F.col("n") >= max(4.0, KNOWN_SHARE * total)).collect()))
    return [w for w, _ in found], [w for w, n in found if n >= max(4.0, RARE_SHARE * total)]


def _asked(contexts: np.ndarray) -> np.ndarray:
    return (contexts & np.uint64((1 << ASKED_BITS) - 1)).astype(np.int64)


def sentence_ends(rows: DataFrame, text: str, common: np.ndarray, asked: DataFrame) -> DataFrame:
    """(``context``, ``met``, ``final``): how often each context that may be ``asked`` (a column ``context``) was met in all
    texts, and how often a stop followed. Counted exactly, by the contexts' 64 bits."""

    def mark(own: np.ndarray, batch: pa.RecordBatch) -> None:
        at = _asked(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        np.bitwise_or.at(own, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))

    bitmap = folded(asked.select("context"), mark, 1 << (ASKED_BITS - 3), "uint8", "bitwise_or")
    shared = rows.sparkSession.sparkContext.broadcast((common, bitmap))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, bitmap = shared.value
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in slices(texts):
                contexts, _, stop, last = _contexts(texts[lo:hi], common)
                known = ~last | stop
                every, final = contexts[:, known].reshape(-1), np.tile(stop[known], ORDERS)
                at = _asked(every)
                hit = (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
                context, place = np.unique(every[hit], return_inverse=True)
                met, final = (np.bincount(place, w, len(context)).astype(np.int64) for w in (None, final[hit]))
                yield pa.RecordBatch.from_arrays([pa.array(context.view(np.int64)), pa.array(met), pa.array(final)], ["context", "met", "final"])

    counts = rows.select(F.col(text).cast("string").alias("t")).mapInArrow(ends, "context long, met long, final long")
    return counts.groupBy("context").agg(F.sum("met").alias("met"), F.sum("final").alias("final"))


def defects(rows: DataFrame, carry: list[str], question: str, answer: str, context: str) -> DataFrame:
    """``carry`` columns and ``defect`` of every row: null, or the first that holds of

    * ``empty``: null, blank, marks or markup only, or a placeholder;
    * ``refusal``: declines by the grammar of refusals, wherever in the answer;
    * ``copies_question``: greedy string tiling covers nearly all of the answer by the question, said once or more;
    * ``other_language``: the function words (or the script) of both are clearly of different languages, or the answer is
      of no known language and has next to no word of the question, the context or the other answers;
    * ``truncated``: marks show that more must follow (a pushdown parse leaves something open, or the text ends in a
      hyphen, comma, colon, ellipsis or list mark), or there is no final stop and the last word is only the beginning of a
      word of the context or of the other answers, or the last words, up to six, are followed by a stop in less than 15 %
      of the sentences of all answers that hold them.
    """
    common, frequent = common_words(rows, answer)
    hashes = np.sort(word_hashes(frequent)[1])
    shared = rows.sparkSession.sparkContext.broadcast((common, frozenset(common), frozenset(frequent), hashes))
    text = [F.col(c).cast("string").alias(f"_{i}") for i, c in enumerate((question, answer, context))]
    pairs = rows.select(*carry, *text)
    own = [T.StructField("defect", T.StringType()), T.StructField("_contexts", T.ArrayType(T.LongType()))]
    schema = T.StructType([*(pairs.schema[c] for c in carry), *own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, known, frequent, hashes = shared.value
        for batch in batches:
            out: list = []
            open_: list[tuple[int, str]] = []
            for q, a, c in zip(*(batch.column(len(carry) + i).to_pylist() for i in range(3)), strict=True):
                defect, undecided = judge(q, a, c, common, known, frequent)
                if undecided:
                    open_.append((len(out), a))
                out.append(defect)
            asked: list = [None] * len(out)
            texts = [answers._HIDDEN.sub("", t) for _, t in open_]
            for lo, hi in slices(texts):
                contexts, owner, _, last = _contexts(texts[lo:hi], hashes)
                at = np.flatnonzero(last)
                for i, each in zip(owner[at], contexts[:, at].view(np.int64).T.tolist(), strict=True):
                    asked[open_[lo + int(i)][0]] = each
            arrays = [*(batch.column(i) for i in range(len(carry))), pa.array(out, pa.string()), pa.array(asked, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, [*carry, "defect", "_contexts"])

    judged = durable(pairs.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()))
    undecided = judged.filter(F.col("_contexts").isNotNull())
    asked = undecided.select("_row", F.posexplode("_contexts").alias("order", "context"))
    # The longest context that was met often enough decides; if none was, the answer counts as complete.
    ends = sentence_ends(rows, answer, hashes, asked).filter(F.col("met") >= LEAST_SEEN)
    share = asked.join(ends, "context").groupBy("_row").agg(F.max_by(F.col("final") / F.col("met"), "order").alias("share"))
    broken = share.filter(F.col("share") < LEAST_FINAL).select("_row", F.lit("truncated").alias("_broken"))
    settled = judged.filter(F.col("_contexts").isNull()).select(*carry, "defect")
    return settled.unionByName(undecided.join(broken, "_row", "left").select(*carry, F.col("_broken").alias("defect")))


def judge(
    question: str | None, answer: str | None, context: str | None = None, common: Sequence[str] = (), known: Set[str] = frozenset(), frequent: Set[str] = frozenset()
) -> tuple[str | None, bool]:
    """The defect that a pair shows by itself and against the words of all answers, those ``common`` enough to be known
    (ascending, and as the set ``known``) and the ``frequent``, and whether only the last words can tell if the answer breaks off."""
    words = answers.tokens(answer)
    if answers.is_empty(answer, words):
        return "empty", False
    if answers.is_refusal(answer, words):
        return "refusal", False
    asked = answers.tokens(question)
    if asked and answers.copies(asked, words):
        return "copies_question", False
    if answers.other_language(asked, words):
        return "other_language", False
    if question and answers.foreign_script(question, answer):
        return "other_language", False
    if asked and len(words) >= 8 and sum(map(answers._SPEAKS.__contains__, words)) < 0.35 * len(words):
        if answers.unknown_language(asked, words, known | set(asked) | set(answers.tokens(context))):
            return "other_language", False
    how = answers.ending(answer)
    if how != "word" or not words:
        return ("truncated" if how == "broken" else None), False
    if _begins_a_word(words, asked, context, common, frequent):
        return "truncated", False
    return None, True


def _begins_a_word(words: list[str], asked: list[str], context: str | None, common: Sequence[str], frequent: Set[str]) -> bool:
    """Whether the last word is rare, but the beginning of a word that is known."""
    last = words[-1]
    if last in frequent or last[0].isdigit() or last in asked or last in words[:-1]:
        return False
    of = answers.tokens(context)
    if last in of:
        return False
    at = bisect_right(common, last)
    return any(len(w) > len(last) + 1 and w.startswith(last) for w in (*common[at : at + 4], *of, *asked))
