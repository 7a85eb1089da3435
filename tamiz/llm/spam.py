"""Problem 9: keyword-stuffed and link-list pages.

A page's words, by falling frequency, follow a curve. Its slope and residual (fitted with window functions over the page's
frequency spectrum), the divergence of its words from those of its language, and that of its make-up (the characters in
links, tags, prices, numbers, separators, function words and other words) are held against prose of the same language and
comparable length. Only a page that is extreme in one of the four, or too short for a curve, can be spam; such a page is
then checked part by part: it is spam if more than half of it is keywords, links, product tags or sentences written only to
repeat a term.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.pages import FUNCTION_WORDS, make_up, spam_share
from tamiz.llm.postings import folded
from tamiz.llm.wordsets import mix
from tamiz.plans.durable import durable

_WORDS = re.compile(r"[^\W_]+")
_BINS = {w: i + 1 for i, w in enumerate(sorted(FUNCTION_WORDS))}
_PROFILE = "uid long, doc long, lang string, n int, share double, freq array<int>, words array<int>, bin array<int>, count array<int>, parts array<int>"
_PARTS = 7
#: Pages of fewer words have no curve worth fitting and are suspects.
CURVE_WORDS = 20
#: A language needs so many pages for statistics of its own; at most LANGUAGES of them have any.
LANGUAGE_PAGES, LANGUAGES = 50, 64
#: Share of function words from which a page may serve as prose to compare with.
PROSE_SHARE = 0.22
#: Robust deviations from which a page is extreme. In 110,000 pages each of the 4,766 that the check calls spam is at least 7.2 off in
#: one of the four measures or too short for a curve, so that this leaves room; a fifth of the pages are checked.
EXTREME = 3.0
#: Bits of the bitmap of suspects, whatever the data; the fuller it is, the more prose is checked in vain.
SUSPECT_BITS = 26
MEASURES = ("slope", "residual", "divergence", "make_up")


def profiles(pages: DataFrame, id_col: str, text: str, lang: str) -> DataFrame:
    """Each page's frequency spectrum (``words`` words occur ``freq`` times, falling), its counts of function words and the
    characters of each kind of its make-up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n", "share", "freq", "words", "bin", "count", "parts")}
            for t in batch.column(3).to_pylist():
                t = t or ""
                t = t if t.isascii() else unicodedata.normalize("NFC", t)
                counts = Counter(_WORDS.findall(t.lower()))
                spectrum = sorted(Counter(counts.values()).items(), reverse=True)
                known = [(_BINS[w], c) for w, c in counts.items() if w in _BINS]
                n = counts.total()
                out["n"].append(n)
                out["share"].append(sum(c for _, c in known) / n if n else 0.0)
                out["freq"].append([f for f, _ in spectrum])
                out["words"].append([m for _, m in spectrum])
                out["bin"].append([b for b, _ in known])
                out["count"].append([c for _, c in known])
                out["parts"].append(make_up(t, counts))
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(out["n"], pa.int32()), pa.array(out["share"], pa.float64()),
                 *(pa.array(out[k], ints) for k in ("freq", "words", "bin", "count", "parts"))],
                ["uid", "doc", "lang", "n", "share", "freq", "words", "bin", "count", "parts"],
            )

    rows = pages.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc"),
        F.coalesce(F.lower(F.trim(F.col(lang))), F.lit("unknown")).alias("lang"), F.col(text).cast("string").alias("t"),
    )
    return rows.mapInArrow(run, _PROFILE)


def curves(profile: DataFrame) -> DataFrame:
    """(``uid``, ``slope``, ``residual``) of the line through log frequency over log rank, each word counting once.

    A run of words of equal frequency stands at the middle of its ranks.
    """
    runs = profile.select("uid", F.explode(F.arrays_zip("freq", "words")).alias("r")).select("uid", "r.freq", "r.words")
    upto = Window.partitionBy("uid").orderBy(F.col("freq").desc()).rowsBetween(Window.unboundedPreceding, 0)
    points = runs.select(
        "uid", F.col("words").cast("double").alias("w"), F.log(F.col("freq").cast("double")).alias("y"),
        F.log(F.sum("words").over(upto) - (F.col("words") - 1) / 2).alias("x"),
    )
    s = points.groupBy("uid").agg(
        F.sum("w").alias("w"), *[F.sum(F.col("w") * e).alias(n) for n, e in {
            "x": F.col("x"), "y": F.col("y"), "xx": F.col("x") * F.col("x"), "xy": F.col("x") * F.col("y"), "yy": F.col("y") * F.col("y")}.items()],
    )
    vx, vy = F.col("w") * F.col("xx") - F.col("x") ** 2, F.col("w") * F.col("yy") - F.col("y") ** 2
    cov = F.col("w") * F.col("xy") - F.col("x") * F.col("y")
    slope = F.when(vx > 1e-9, cov / vx)
    rest = F.sqrt(F.greatest(vy - cov * slope, F.lit(0.0))) / F.col("w")
    return s.select("uid", slope.alias("slope"), rest.alias("residual"))


def _jensen_shannon(p: np.ndarray, r: np.ndarray, rest: float = 0.0) -> float:
    """Between two distributions; ``rest`` is the share of the second on what the first lacks and isn't listed."""
    m, used = (p + r) / 2, p > 0
    return float((p[used] * np.log(p[used] / m[used])).sum() + (r * np.log(r / m)).sum() + rest * np.log(2)) / 2


def measures(profile: DataFrame) -> DataFrame:
    """(``uid``, ``doc``, ``n``, ``share``, ``language``, ``band`` and the four MEASURES) of every page. Languages of fewer than
    LANGUAGE_PAGES pages, or beyond the LANGUAGES most frequent, are held against the prose of all languages together."""
    sc = profile.sparkSession.sparkContext
    sizes = profile.groupBy("lang").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= LANGUAGE_PAGES)
    known = sorted(r["lang"] for r in sizes.orderBy(F.col("c").desc(), "lang").limit(LANGUAGES).collect())
    number = {x: i for i, x in enumerate(known)}
    width = len(_BINS) + 1 + _PARTS
    size = -(-(len(known) + 1) * width // 64) * 64

    def add(own: np.ndarray, batch: pa.RecordBatch) -> None:
        for lang, n, share, bins, counts, parts in zip(*(batch.column(c).to_pylist() for c in ("lang", "n", "share", "bin", "count", "parts")), strict=True):
            if n >= CURVE_WORDS and share >= PROSE_SHARE:
                for base in {number.get(lang, len(known)) * width, len(known) * width}:
                    own[base + np.array(bins)] += counts
                    own[base] += n - sum(counts)
                    own[base + width - _PARTS : base + width] += parts

    totals = folded(profile.select("lang", "n", "share", "bin", "count", "parts"), add, size, "int64")[: (len(known) + 1) * width].reshape(-1, width)
    words, parts = totals[:, :-_PARTS], totals[:, -_PARTS:]
    smooth = lambda x: (x + 0.5) / (x.sum(axis=1, keepdims=True) + 0.5 * x.shape[1])
    reference = sc.broadcast((number, smooth(words), smooth(parts)))

    def diverge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, words, parts = reference.value
        for batch in batches:
            one, two = [], []
            for lang, n, bins, counts, own in zip(*(batch.column(c).to_pylist() for c in ("lang", "n", "bin", "count", "parts")), strict=True):
                at = number.get(lang, len(number))
                r = words[at][[0, *bins]]
                # Words of the language that the page lacks contribute half their share each.
                one.append(_jensen_shannon(np.array([n - sum(counts), *counts], dtype=float) / max(n, 1), r, 1 - r.sum()))
                two.append(_jensen_shannon(np.array(own, dtype=float) / max(sum(own), 1), parts[at]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("uid", "doc", "lang", "n", "share")), pa.array(one), pa.array(two)], ["uid", "doc", "lang", "n", "share", "divergence", "make_up"])

    rows = profile.select("uid", "doc", "lang", "n", "share", "bin", "count", "parts").mapInArrow(diverge, "uid long, doc long, lang string, n int, share double, divergence double, make_up double")
    band = F.floor(F.log2(F.greatest(F.col("n"), F.lit(1)).cast("double"))).cast("int")
    language = F.when(F.col("lang").isin(known), F.col("lang")).otherwise("other") if known else F.lit("other")
    return rows.join(curves(profile), "uid", "left").select("uid", "doc", "n", "share", *MEASURES, language.alias("language"), band.alias("band"))


def deviations(facts: DataFrame) -> DataFrame:
    """``facts`` with ``off``: by how many robust deviations a page is off in the measure in which it is off most (the
    divergences count only if they are above), null if it is too short for a curve or there is no prose to compare with."""
    prose = facts.filter((F.col("share") >= PROSE_SHARE) & (F.col("n") >= CURVE_WORDS))

    def medians(rows: DataFrame, keys: list[str], of: dict[str, str]) -> DataFrame:
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_pages"), *[F.percentile_approx(e, 0.5, 10_000).alias(c) for c, e in of.items()])

    # Statistics by language and length, by length alone where those are of few pages: as many rows as there are
    # languages (bounded) times powers of two of lengths, so the tables may be broadcast.
    stats = None
    for keys in (["language", "band"], ["band"]):
        centre = medians(prose, keys, {f"{c}_m": c for c in MEASURES})
        away = prose.join(F.broadcast(centre.drop("_pages")), keys)
        spread = medians(away, keys, {f"{c}_d": F.abs(F.col(c) - F.col(f"{c}_m")) for c in MEASURES}).drop("_pages")
        own = centre.filter(F.col("_pages") >= LANGUAGE_PAGES).drop("_pages").join(F.broadcast(spread), keys)
        own = own.select(*keys, F.struct(*[f"{c}_{x}" for c in MEASURES for x in "md"]).alias(f"s{len(keys)}"))
        stats = facts.join(F.broadcast(own), keys, "left") if stats is None else stats.join(F.broadcast(own), keys, "left")
    stats = stats.withColumn("_s", F.coalesce("s2", "s1"))
    off = []
    for c in MEASURES:
        from_ = F.col(c) - F.col(f"_s.{c}_m")
        off.append((F.abs(from_) if c in ("slope", "residual") else from_) / (1.4826 * F.greatest(F.col(f"_s.{c}_d"), F.lit(1e-6))))
    judged = F.col("_s").isNotNull() & (F.col("n") >= CURVE_WORDS) & F.col("slope").isNotNull()
    return stats.select(*facts.columns, F.when(judged, F.greatest(*off)).alias("off"))


def suspects(profile: DataFrame) -> DataFrame:
    """(``doc``) of the pages that are extreme in one of the measures, or too short for a curve."""
    return deviations(durable(measures(profile))).filter(F.col("off").isNull() | (F.col("off") > EXTREME)).select("doc")


def spam_pages(pages: DataFrame, id_col: str, text: str, lang: str, share: float = 0.5) -> DataFrame:
    """(id, ``spam_share``) of the pages of which more than ``share`` is spam. Null, empty and blank texts are no spam; rows
    without an id are left out; copies are judged alike; of rows with the same id each is judged. Pages that aren't extreme
    in any measure are prose and not read again."""
    rows = pages.filter(F.col(id_col).isNotNull()).select(F.col(id_col), F.col(text).cast("string").alias("_text"), F.col(lang).alias("_lang"))
    profile = durable(profiles(rows, id_col, "_text", "_lang").filter("n > 0"))
    found = durable(suspects(profile).distinct())
    hit = _bitmap(found)
    schema = T.StructType([rows.schema[id_col], T.StructField("spam_share", T.DoubleType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(hit(batch.column(3).to_numpy(zero_copy_only=False))))
            shares = [spam_share(t, x) for t, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            keep = pa.array([x > share for x in shares], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shares, pa.float64())], [id_col, "spam_share"]).filter(keep)

    # Texts aren't shuffled: a bitmap of the suspects leaves out the most of the other pages, and what is spam meets the suspects.
    judged = rows.select(id_col, "_text", "_lang", F.col(id_col).cast("long").alias("_doc")).mapInArrow(read, schema)
    return judged.join(found, F.col(id_col).cast("long") == F.col("doc"), "left_semi")


def _bitmap(ids: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """A test that all of ``ids`` pass, and few others: a bitmap of fixed size, broadcast."""
    bits = lambda x: (mix(x.view(np.uint64)) & np.uint64((1 << SUSPECT_BITS) - 1)).astype(np.int64)

    def mark(own: np.ndarray, batch: pa.RecordBatch) -> None:
        at = bits(batch.column(0).to_numpy(zero_copy_only=False))
        np.bitwise_or.at(own, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))

    shared = ids.sparkSession.sparkContext.broadcast(folded(ids, mark, 1 << (SUSPECT_BITS - 3), "uint8", "bitwise_or"))

    def hit(x: np.ndarray) -> np.ndarray:
        at = bits(x)
        return (shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    return hit
