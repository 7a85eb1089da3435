"""Chunks: paragraphs packed to a number of tokens, accepted, numbered, deduplicated and split."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions import lexicon as lx
from tamiz.functions import text as tx
from tamiz.operators.ordered import ranked
from tamiz.plans.durable import durable, once


def paragraphs(text: Column | str) -> Column:
    """Blocks between blank lines; in a text of one block, lines joined until a heading or 120 words."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    blocks = F.filter(F.transform(F.split(t, rf"\n{tx.WS}*\n"), tx.strip), lambda x: x != "")
    lines = F.transform(tx.nonblank_lines(t), lambda x: F.struct(x.alias("l"), tx.is_heading(x).alias("h"), tx.token_count(x).alias("n")))
    empty = F.struct(F.lit("").alias("now"), F.lit(0).alias("n"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        breaks, n = x.h & (acc.now != ""), acc.n + x.n
        joined = F.when(acc.now == "", x.l).otherwise(F.concat(acc.now, F.lit(" "), x.l))
        full = ~breaks & (n >= 120)
        return F.struct(
            F.when(breaks, x.l).when(full, "").otherwise(joined).alias("now"), F.when(breaks, x.n).when(full, 0).otherwise(n).alias("n"),
            F.when(breaks, F.array_append(acc.out, acc.now)).when(full, F.array_append(acc.out, joined)).otherwise(acc.out).alias("out"),
        )

    folded = F.aggregate(lines, empty, step, lambda a: F.when(a.now == "", a.out).otherwise(F.array_append(a.out, a.now)))
    return F.when(F.size(blocks) > 1, blocks).otherwise(folded)


def fold(pieces: DataFrame, groups: Sequence[str], order: Sequence[str], page: str, words: str, max_tokens: int = 1200, overlap: int = 80) -> DataFrame:
    """``pieces`` with the number of the chunk (``chunk``, from 1 in each group) that each belongs to and ``carried``, the
    words that this chunk repeats from the one before.

    A chunk is closed before a piece that would take it over ``max_tokens``, and after a page that filled it; if what is
    closed is over the limit, its last ``overlap`` words open the next. Pieces stream through sorted partitions, so a
    group of any length takes no memory; a group is one task's work because each chunk depends on the one before.
    Only numbers travel: :func:`chunk_texts` joins the text afterwards.
    """
    keep = [*groups, *order, page, words]
    keep = list(dict.fromkeys(keep))
    rows = pieces.select(*keep)
    schema = T.StructType([*rows.schema.fields, T.StructField("chunk", T.IntegerType()), T.StructField("carried", T.IntegerType())])
    tokens = lambda n: max(1, ceil(n * 1.35))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_group = last_page = None
        chunk, held, carried, open_ = 1, 0, 0, False
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in [*groups, page, words]]
            chunks, carries = [], []
            for *group, at, n in zip(*columns, strict=True):
                n = n or 0
                if group != last_group:
                    last_group, last_page, chunk, held, carried, open_ = group, at, 1, 0, 0, False
                close = False
                if at != last_page:
                    close, last_page = open_ and tokens(held) >= max_tokens, at
                if open_ and not close and tokens(held + n) > max_tokens:
                    close = True
                if close:
                    carried = min(overlap, held) if tokens(held) > max_tokens else 0
                    chunk, held = chunk + 1, carried
                held, open_ = held + n, True
                chunks.append(chunk)
                carries.append(carried)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(chunks, pa.int32()), pa.array(carries, pa.int32())], [*keep, "chunk", "carried"]
            )

    sorted_ = rows.repartition(*groups).sortWithinPartitions(*groups, *order)
    return sorted_.mapInArrow(run, schema)


def chunk_records(
    pages: DataFrame, source: str, section: str, page: str, key: str, text: str, max_tokens: int = 1200, overlap: int = 80
) -> DataFrame:
    """Chunks of up to ``max_tokens``: (source, section, ``chunk``, ``text``, ``pages``, ``token_estimate``, ``clinical_score``, ``quality_flags``).

    Pages of one source and section, in the order of ``page`` and then ``key`` (unique), are cut into paragraphs and packed
    (see :func:`fold`). A page without a section is of 'Sin seccion', one without a source of the source ''. A chunk over the
    limit, which only a single long paragraph makes, hands its last ``overlap`` words and its last page to the next; if it is
    the section's last, these words are a chunk of their own. Pages should be cleaned; white space is collapsed. Sections are
    folded side by side; a section's own chunks depend on one another, so it is one task's work, of numbers only.
    """
    rows = pages.select(
        F.coalesce(F.col(source), F.lit("")).alias("_source"), F.coalesce(F.nullif(F.col(section), F.lit("")), F.lit("Sin seccion")).alias("_section"),
        F.coalesce(F.col(page), F.lit(0)).alias("_page"), F.col(key).alias("_key"), F.posexplode(paragraphs(text)).alias("_at", "_t"),
    )
    rows = once(rows, _text=tx.collapse("_t")).drop("_t").filter("_text <> ''")
    rows = durable(once(rows, _words=tx.word_count("_text")))
    group = ["_source", "_section"]
    placed = fold(rows.select(*group, "_page", "_key", "_at", "_words"), group, ["_page", "_key", "_at"], "_key", "_words", max_tokens, overlap)
    of = placed.select(*group, "_key", "_at", "chunk", "carried").join(rows, [*group, "_key", "_at"])
    one = of.groupBy(*group, "chunk").agg(
        F.array_sort(F.collect_list(F.struct("_page", "_key", "_at", "_text"))).alias("_l"), F.sum("_words").alias("_words"), F.max("carried").alias("carried")
    )
    own = F.array_join(F.transform("_l", lambda x: x._text), " ")
    one = durable(one.select(
        *group, "chunk", "carried", "_words", own.alias("_own"), F.transform("_l", lambda x: x._page).alias("_pages"), F.element_at("_l", -1)._page.alias("_last"),
    ))
    over = tokens_over(F.col("_words") + F.col("carried"), max_tokens)
    before = one.filter(over).select(*group, (F.col("chunk") + 1).alias("chunk"), tx.tail_words("_own", overlap).alias("_tail"), F.col("_last").alias("_from")) if overlap else None
    out = one.select(*group, "chunk", "_own", "_pages")
    if before is not None:
        out = out.join(before, [*group, "chunk"], "full")
    else:
        out = out.withColumn("_tail", F.lit("")).withColumn("_from", F.lit(None).cast("int"))
    pages_ = F.filter(F.array_sort(F.array_distinct(F.concat(F.coalesce("_pages", F.array().cast("array<int>")), F.array("_from")))), lambda x: x > 0)
    out = out.select(
        F.col("_source").alias(source), F.col("_section").alias(section), "chunk", F.trim(F.concat_ws(" ", "_tail", "_own")).alias("text"), F.array_compact(pages_).alias("pages")
    )
    out = once(out, _n=tx.normalize("text"), _w=tx.word_count("text"), _r=tx.reference_ratio("text"))
    out = once(out, token_estimate=tx.tokens_of(F.col("_w")), clinical_score=tx.clinical_score(F.col("_n"), F.col("_w"), F.col("_r"))).drop("_n", "_w", "_r")
    return once(out, quality_flags=quality_flags("text", F.col("token_estimate"), F.col("clinical_score")))


def tokens_over(words: Column, most: int) -> Column:
    return tx.tokens_of(words) > most


def reject_reason(text: str, tokens: Column, score: Column, min_tokens: int = 180, min_score: int = 4) -> Column:
    """Why a chunk is not accepted, '' if it is; the first rule that holds counts."""
    t = F.coalesce(F.col(text), F.lit(""))
    bare = tx.strip_exam_noise(t)
    numeric = (tx.numeric_ratio(t) >= 0.38) | (tx.decimal_count(t) >= 12)
    return tx.cascade([
        ("too_short_after_noise_cleanup", tx.estimate_tokens(bare) < min_tokens),
        ("too_short", tokens < min_tokens),
        ("low_clinical_score", score < min_score),
        ("reference_heavy", (tx.reference_ratio(t) >= 0.45) | (tx.reference_markers(t) >= 4)),
        ("corrupt_extraction", tx.suspicious_ratio(t) >= 0.012),
        ("admin_or_contact_text", tx.any_of(tx.normalize(t), lx.ADMIN_TERMS)),
        ("numeric_or_table_heavy", numeric & (score < 9)),
        ("exam_answer_key", bare.rlike(tx.ANSWER_KEY)),
        ("toc_or_layout_noise", t.rlike(r"\.{4,}") & (score < 10)),
    ])


def quality_flags(text: str, tokens: Column, score: Column) -> Column:
    t = F.coalesce(F.col(text), F.lit(""))
    variety = F.size(F.array_distinct(F.filter(F.split(tx.normalize(t), " "), lambda w: w != "")))
    flags = [
        ("short_chunk", tokens < 180), ("long_chunk", tokens > 1500), ("low_clinical_score", score < 5), ("reference_heavy", tx.reference_ratio(t) >= 0.3),
        ("reference_markers", tx.reference_markers(t) >= 4), ("corrupt_extraction", tx.suspicious_ratio(t) >= 0.012),
        ("numeric_or_table_heavy", tx.numeric_ratio(t) >= 0.38), ("decimal_table_like", tx.decimal_count(t) >= 12), ("low_vocabulary_variety", variety < 35),
    ]
    return F.array_compact(F.array(*[F.when(holds, name) for name, holds in flags]))


def numbered(chunks: DataFrame, prefix: Column, order: Sequence[Column], name: str = "chunk_id", width: int = 5, start: DataFrame | None = None) -> DataFrame:
    """``chunks`` with ids ``{prefix}_{number}``, numbered in ``order`` within a prefix; ``start`` (``_prefix``, ``_from``) continues older numbers."""
    out = ranked(chunks.withColumn("_prefix", prefix), ["_prefix"], order, "_number")
    number = F.col("_number")
    if start is not None:
        out = out.join(start, "_prefix", "left")
        number = number + F.coalesce("_from", F.lit(0))
    padded = F.when(F.length(number.cast("string")) >= width, number.cast("string")).otherwise(F.lpad(number.cast("string"), width, "0"))
    return out.withColumn(name, F.concat("_prefix", F.lit("_"), padded)).drop("_prefix", "_number", "_from")


def best_of_duplicates(chunks: DataFrame, text: str, order: Sequence[Column]) -> DataFrame:
    """The first chunk, in ``order``, of those that share their first 240 normalised words; chunks without text are dropped.

    Equal texts have equal keys, so one key suffices. The least row by ``order`` is found by a hash aggregate over the
    key's hash, with partial aggregation before the shuffle, so a text copied into a third of the rows doesn't gather.
    """
    rows = chunks.filter(tx.collapse(text) != "")
    key = F.sha2(tx.first_words(tx.normalize(text)), 256)
    least = F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*chunks.columns).alias("_row")))
    return rows.groupBy(key.alias("_key")).agg(least.alias("_m")).select("_m._row.*")


def duplicate_audit(rows: DataFrame, text: str, source: str, order: str) -> DataFrame:
    """How many rows repeat an earlier text exactly, or its first 240 words, and how many of an earlier one of another source."""
    base = rows.select(tx.strip(F.coalesce(F.col(text), F.lit(""))).alias("_t"), F.coalesce(F.col(source), F.lit("")).alias("_s"), F.col(order).alias("_o"))
    base = base.filter("_t <> ''")
    near = F.array_join(F.slice(F.split(F.lower(F.trim(F.regexp_replace("_t", rf"{tx.WS}+", " "))), " "), 1, 240), " ")
    out = None
    for name, key in (("exact", F.col("_t")), ("near", near)):
        # Rows of one source and text are counted before they meet others, so copies don't gather.
        per = base.groupBy(F.sha2(key, 256).alias("_k"), "_s").agg(F.count(F.lit(1)).alias("n"), F.min("_o").alias("_o"))
        owned = per.groupBy("_k").agg(F.sum("n").alias("n"), F.min_by(F.struct("_s", "n"), "_o").alias("_own"))
        counts = owned.agg(
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("detected"), F.coalesce(F.sum(F.col("n") - F.col("_own.n")), F.lit(0)).alias("cross_source")
        ).select(F.lit(name).alias("kind"), "detected", "cross_source")
        out = counts if out is None else out.unionByName(counts)
    return out


def holdout_sizes(sizes: dict[int, int], target: int, least: int, share: float = 0.75) -> dict[int, int]:
    """How many documents of each size a holdout of about ``target`` chunks takes: always the one that brings it nearest
    (ties: smaller), the first not larger than ``share`` of the target if there is such, until it gets no nearer."""
    left, taken, total, count = {s: n for s, n in sizes.items() if n > 0}, {}, 0, 0
    order = sorted(left)

    def nearest(gap: int, upto: int | None = None) -> int:
        """The size with documents left that is nearest ``gap`` (ties: smaller), of those up to ``upto`` if there are such."""
        at = bisect_left(order, gap)
        near = [s for s in order[max(0, at - 1) : at + 1]]
        if upto is not None and (low := order[: bisect_right(order, upto)]):
            near = [s for s in near if s <= upto] or [low[-1]]
        return min(near, key=lambda s: (abs(gap - s), s))

    while target > 0 and order:
        best = nearest(target - total, None if count else max(1, round(target * share)))
        gap = target - total
        if count >= least and count and abs(gap - best) >= abs(gap):
            break
        # While the gap stays above the largest size, the largest is always nearest: taken in one run.
        run = 1
        if count and best == order[-1] and gap > best:
            run = max(1, min(left[best], (gap - best) // best if best else 1))
        left[best] -= run
        taken[best] = taken.get(best, 0) + run
        total, count = total + run * best, count + run
        if not left[best]:
            del order[bisect_left(order, best)]
    return taken


def split_by_document(chunks: DataFrame, document: str, validation: float = 0.05, test: float = 0.05, least: int = 3) -> DataFrame:
    """(document, ``n``, ``split``): whole documents in one split each, near the wanted shares of chunks.

    Only the number of documents of each size comes to the driver (at most the square root of twice the chunks);
    documents of one size are taken in the order of their ids.
    """
    if validation < 0 or test < 0 or validation + test >= 1:
        raise ValueError("shares must be at least 0 and sum to less than 1")
    per = chunks.groupBy(document).agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["n"]: r["c"] for r in per.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    total = sum(n * c for n, c in sizes.items())
    first = holdout_sizes(sizes, round(total * validation), least)
    second = holdout_sizes({s: c - first.get(s, 0) for s, c in sizes.items()}, round(total * test), least)
    table = [(s, first.get(s, 0), first.get(s, 0) + second.get(s, 0)) for s in sizes if first.get(s) or second.get(s)]
    bounds = chunks.sparkSession.createDataFrame(table, "_size long, _a long, _b long")
    placed = ranked(per, ["n"], [F.col(document).asc_nulls_first()], "_rank").join(bounds, F.col("n") == F.col("_size"), "left")
    split = F.when(F.col("_rank") <= F.col("_a"), "validation").when(F.col("_rank") <= F.col("_b"), "test").otherwise("train")
    return placed.select(document, "n", split.alias("split"))


def leakage(rows: DataFrame, document: str, split: str) -> DataFrame:
    """(document, ``splits``): documents in more than one split."""
    per = rows.filter(F.col(split).isNotNull()).groupBy(document).agg(F.sort_array(F.collect_set(split)).alias("splits"))
    return per.filter(F.size("splits") > 1)


def hashed(key: str, seed: int) -> Column:
    """A hash of a key and a seed, the same in every engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_per_group(rows: DataFrame, group: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows of each group, chosen by a hash of ``key`` and the seed (not by position, so reruns agree)."""
    picked = rows.withColumn("_h", hashed(key, seed))
    return ranked(picked, [group], [F.col("_h").asc(), F.col(key).asc()], "_rank").filter(F.col("_rank") <= n).drop("_h", "_rank")


def stratified_quotas(rows: DataFrame, group: str, n: int) -> DataFrame:
    """(group, ``rows``, ``quota``): each group's share of ``n`` rows, rounded down, at least 1 if there are no more groups than ``n``."""
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("rows"))
    total = sizes.agg(F.sum("rows").alias("_all"), F.count(F.lit(1)).alias("_groups"))
    base = F.floor(F.lit(n) * F.col("rows") / F.col("_all"))
    quota = F.when(F.lit(n) >= F.col("_all"), F.col("rows")).when((base == 0) & (F.col("_groups") <= n), F.lit(1)).otherwise(base)
    return sizes.crossJoin(F.broadcast(total)).select(group, "rows", quota.cast("long").alias("quota"))


def stratified_sample(rows: DataFrame, group: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows: each group's quota by hash order, and what is missing from the other rows by hash order; a surplus is cut by hash."""
    order = [hashed(key, seed).asc(), F.col(key).asc()]
    quotas = stratified_quotas(rows, group, n).select(F.col(group).alias("_group"), "quota")
    placed = ranked(rows, [group], order, "_rank").join(quotas, F.col(group).eqNullSafe(F.col("_group")))
    placed = placed.withColumn("_later", (F.col("_rank") > F.col("quota")).cast("int"))
    out = ranked(placed, [], [F.col("_later").asc(), *order], "_place")
    return out.filter(F.col("_place") <= n).select(*rows.columns)


def block_split(chunks: DataFrame, document: str, order: list[Column], ratio: float = 0.10, seed: int = 42) -> DataFrame:
    """``chunks`` with ``split``: of each document's chunks in order every ``round(1 / ratio)``-th is for validation, from an offset that the
    document and the seed give; a document of one or two chunks is for training alone."""
    block = max(1, round(1 / ratio))
    placed = ranked(chunks, [document], order, "_place")
    sizes = chunks.groupBy(F.col(document).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    placed = placed.join(sizes, F.col(document).eqNullSafe(F.col("_d")))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(document), F.lit("")))), 1, 8), 16, 10).cast("long") % block
    chosen = (F.col("_n") > 2) & ((F.col("_place") - 1 + offset) % block == 0)
    return placed.withColumn("split", F.when(chosen, "validation").otherwise("train")).drop("_d", "_n", "_place")


def remove_documents(rows: DataFrame, document: str, removed: DataFrame) -> DataFrame:
    """``rows`` whose document isn't among ``removed`` (one column of ids)."""
    ids = removed.select(F.col(removed.columns[0]).alias("_gone")).distinct()
    return rows.join(ids, F.col(document) == F.col("_gone"), "left_anti")
