"""Problem 6: near-duplicate records with small edits.

Two sets of ``n`` and ``m`` words with overlap (Jaccard) of at least ``t`` differ in at most ``(1-t)/(1+t) * (n+m)``
words. The universe of words is partitioned by hash: every rare word is a segment of its own, the middling words are
hashed into ``m`` segments, the commonest are left out. By the pigeonhole principle two such sets share a rare word,
or all their rare words are among the differences, and then what is left of the bound is spread over the ``m``
segments: with ``2m`` more than that, some segment differs in one word at most, so that its content, or its content
with one word deleted, is the same on both sides. Sets are signed by these contents and one-deletion neighbourhoods.

As the number of sets grows, a vocabulary that doesn't grow with it has fewer words whose sets can all be compared. Words
above that, yet in a small share of the sets, are *scarce*: a set is signed by every two of them, which few sets share. Two
sets without such a signature in common have one scarce word in common at most, so that all others of either set are among
the differences. Long sets would have very many pairs: they have their scarce words hashed into colours, twice as many at
twice the size, and are signed by pairs of one colour; such sets may have one scarce word of every colour in common.

The budget of a set is what the bound leaves it after its own rare words and its scarce ones but one a colour; ``m`` depends on the larger budget of a
pair, so sets are signed for the band of their own budget and for the higher bands. A set of budget ``b`` in a band of
``m`` needs only the first ``floor((b + m) / 2) + 1`` segments: all differences of a pair number less than that many
twos, so that one of the segments that both have indexed differs in one word at most. The frequency at which a word
counts as rare, the bands and the share of common words left out are allocated by costs counted over all sets.
Candidates pass the bound on sizes and on the parity of a 128-bit sketch (both necessary conditions) and are then
verified exactly.

A set's record (key, size, sketch) travels once to each task that one of its signatures goes to. So that these are
few, a segment's signatures go where the rarest word of their contents leads, which is one place for the whole
content and all deletions but one; equal contents have the same rarest word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.forest import components
from tamiz.llm.postings import bucket_of, distinct_sets, document_counts, exchange, folded, partitions_for, sketches, verified
from tamiz.llm.wordsets import mix
from tamiz.plans.durable import durable

#: Bits of the bitmap of signatures of the sparsely populated higher bands. It spares postings and decides nothing: where
#: it is full, every set of a higher band's reach sends all its postings for it.
BITMAP_BITS = 27
#: Share of the sets that the first band holds at least.
FIRST_BAND = 0.975
#: Scarce words: the share of the sets that one may be in, how many a set may have on average, how many comparisons a set they may
#: cost if words meet by chance, and the size of set from whose double on they have colours. Any choice finds the same pairs.
SCARCE_SHARE, SCARCE_WORDS, SCARCE_PAIRS, COLOUR_WORDS = 0.0005, 12.0, 50.0, 128
#: Sets whose postings one task may hold (about 200 postings a set at most, 60 bytes each while they are sorted).
TASK_SETS = 35_000
_BUDGETS = 4096
_DOC = np.dtype([("key", np.int64), ("n", np.int32), ("s0", np.uint64), ("s1", np.uint64)])


@dataclass(frozen=True)
class Allocation:
    """How words are classed and sets are signed. ``kinds`` by bucket of words: 0 in one set only, 1 rare, 2 middling, 3 left out, 4 scarce;
    ``rarity`` by bucket: the logarithm of the number of sets, in quarters of a power of two."""

    threshold: float
    kinds: np.ndarray
    rarity: np.ndarray
    bands: tuple[int, ...] = ()
    colour_words: int = COLOUR_WORDS

    @property
    def slack(self) -> float:
        return (1 - self.threshold) / (1 + self.threshold)


def word_kinds(counts: np.ndarray, sets: int, pairs_per_set: float = 250.0, middling: float = 75.0) -> np.ndarray:
    """Rare: as many of the rarest words as cost at most ``pairs_per_set`` comparisons a set. Scarce: the next ones, within the
    bounds of scarce words. Middling: the next ones, up to ``middling`` words a set. Cost-based and counted over all sets; any
    choice finds the same pairs."""
    used = np.sort(counts[counts > 0]).astype(np.float64)
    if not len(used):
        return np.zeros(len(counts), dtype=np.uint8)
    pairs = np.cumsum(used * (used - 1) / 2)
    rare = used[max(0, np.searchsorted(pairs, pairs_per_set * sets, side="right") - 1)]
    rare = max(1.0, min(rare, max(1.0, 0.01 * sets)))
    above = used[(used > rare) & (used <= SCARCE_SHARE * sets)]
    fit = (np.cumsum(above) <= SCARCE_WORDS * sets) & (np.cumsum(above**2) ** 2 <= 4 * SCARCE_PAIRS * float(sets) ** 3)
    ends = np.flatnonzero(fit & np.append(above[1:] != above[:-1], True)) if len(above) else above
    scarce = max(rare, above[ends[-1]]) if len(ends) else rare
    weight = np.cumsum(np.where(used > scarce, used, 0)) / max(sets, 1)
    upto = used[min(np.searchsorted(weight, middling), len(used) - 1)]
    kinds = np.full(len(counts), 3, dtype=np.uint8)
    kinds[counts <= max(upto, scarce)] = 2
    kinds[counts <= scarce] = 4
    kinds[counts <= rare] = 1
    kinds[counts <= 1] = 0
    return kinds


def _coloured(plan: Allocation, size: np.ndarray, owner: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Set and colour of scarce words as one number, in the colours of a set of ``size`` words; those of a larger one divide them."""
    level = np.log2(np.maximum(size / plan.colour_words, 1)).astype(np.uint64)
    colour = mix(tokens ^ np.uint64(0x3C6EF372FE94F82B)) & ((np.uint64(1) << level[owner]) - np.uint64(1))
    return (owner.astype(np.uint64) << np.uint64(32)) | colour


def _budgets(plan: Allocation, bounds: np.ndarray, kinds: np.ndarray, owner: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    size, scarce = np.diff(bounds), kinds == 4
    apart = np.append(0, np.cumsum((kinds <= 1) | scarce))
    # The partner may be larger and have more colours.
    colours = np.unique(_coloured(plan, size / plan.threshold, owner[scarce], tokens[scarce])) >> np.uint64(32)
    return plan.slack * size - (apart[bounds[1:]] - apart[bounds[:-1]]) + np.bincount(colours.astype(np.int64), minlength=len(size))


def _scarce_pairs(plan: Allocation, size: np.ndarray, owner: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, their destinations (hashes) and set numbers: every two scarce words of a set that have one colour, sent where the
    rarer of them leads. ``owner`` and ``tokens`` are the scarce words."""
    group = _coloured(plan, size, owner, tokens)
    order = np.lexsort((tokens, plan.rarity[bucket_of(tokens)], group))
    group, tokens, owner = group[order], tokens[order], owner[order]
    place = np.arange(len(group))
    more = np.searchsorted(group, group, side="right") - place - 1
    first = np.repeat(place, more)
    second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(more) - more, more)
    lead = mix(tokens ^ np.uint64(0xA54FF53A5F1D36F1))
    return mix(lead[first] ^ tokens[second]), lead[first], owner[first]


def choose_bands(histogram: np.ndarray, largest: int = 0) -> tuple[int, ...]:
    """Upper ends of the budget bands: the first holds FIRST_BAND of the sets, the next end at twice the one before until they end above
    the largest budget, which the histogram's last bucket may hide: every set owns a band."""
    if not histogram.sum():
        return (1,)
    share = np.cumsum(histogram) / histogram.sum()
    most = max(int(np.flatnonzero(histogram).max()), largest) + 1
    bands = [min(most, max(1, int(np.searchsorted(share, FIRST_BAND)) + 1))]
    while bands[-1] < most:
        bands.append(min(most, 2 * bands[-1]))
    return tuple(bands)


def _segments(plan: Allocation, band: int, budget: np.ndarray, owner: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures, their destinations (hashes), set numbers and deletion flags of sets in a band, given the sets' budgets;
    ``owner`` and ``tokens`` are their middling words."""
    m, sets = plan.bands[band], len(budget)
    wanted = np.minimum(np.floor((budget + m) / 2).astype(np.int64) + 1, m)
    place = ((mix(tokens + np.uint64(7919 * (band + 1))) >> np.uint64(33)) % np.uint64(m)).astype(np.int64)
    use = place < wanted[owner]
    owner, tokens, place = owner[use], tokens[use], place[use]
    base = np.append(0, np.cumsum(wanted))
    cell = base[owner] + place
    # Within a cell the rarest word comes first, of equally rare ones that of the lowest hash.
    order = np.lexsort((tokens, plan.rarity[bucket_of(tokens)], cell))
    owner, tokens, place, cell = owner[order], tokens[order], place[order], cell[order]
    value = mix(tokens ^ np.uint64(0x6A09E667F3BCC909))
    salt = mix(np.arange(m, dtype=np.uint64) + np.uint64(1000003 * (band + 1)))
    seg = np.arange(base[-1]) - np.repeat(base[:-1], wanted)
    content, to = np.zeros(base[-1], dtype=np.uint64), salt[seg]
    first = np.append(True, cell[1:] != cell[:-1]) if len(cell) else np.zeros(0, bool)
    to_deleted = np.zeros(0, np.uint64)
    if len(cell):
        at = np.flatnonzero(first)
        content[cell[at]] = np.add.reduceat(value, at)
        leads = mix(value ^ salt[place])
        to[cell[at]] = leads[at]
        # Without its rarest word a content goes where the second leads, if there is one.
        second = np.minimum(at + 1, len(cell) - 1)
        alone = (second == at) | (cell[second] != cell[at])
        to_deleted = to[cell]
        to_deleted[at] = np.where(alone, salt[place[at]], leads[second])
    whole = mix(content ^ salt[seg])
    without = mix((content[cell] - value) ^ salt[place])
    doc = np.concatenate([np.repeat(np.arange(sets), wanted), owner])
    deleted = np.concatenate([np.zeros(len(whole), bool), np.ones(len(owner), bool)])
    return np.concatenate([whole, without]), np.concatenate([to, to_deleted]), doc, deleted


def _read(plan: Allocation, batch: pa.RecordBatch) -> tuple:
    keys, bounds, tokens = distinct_sets(batch)
    owner = np.repeat(np.arange(len(keys)), np.diff(bounds))
    kinds = plan.kinds[bucket_of(tokens)]
    budget = _budgets(plan, bounds, kinds, owner, tokens)
    band = np.searchsorted(np.asarray(plan.bands), np.maximum(budget, 0), side="right") if plan.bands else np.zeros(len(keys), int)
    return keys, bounds, tokens, owner, kinds, budget, band


def _some(chosen: np.ndarray, owner: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chosen sets' numbers, and their words with owners numbered among them."""
    at = np.flatnonzero(chosen)
    number = np.zeros(len(chosen), dtype=np.int64)
    number[at] = np.arange(len(at))
    mask = chosen[owner]
    return at, number[owner[mask]], tokens[mask]


def _emit(plan: Allocation, bitmap: np.ndarray | None):
    def emit(batch: pa.RecordBatch) -> tuple:
        keys, bounds, tokens, owner, kinds, budget, band = _read(plan, batch)
        rare = kinds == 1
        sigs, docs, values = [mix(tokens[rare] ^ np.uint64(0xBB67AE8584CAA73B))], [owner[rare]], [np.zeros(rare.sum(), np.uint8)]
        places = [sigs[0]]
        if (scarce := kinds == 4).any():
            for x, own in zip(_scarce_pairs(plan, np.diff(bounds), owner[scarce], tokens[scarce]), (sigs, places, docs), strict=True):
                own.append(x)
            values.append(np.zeros(len(sigs[1]), np.uint8))
        middling = kinds == 2
        mo, mt = owner[middling], tokens[middling]
        for k, top in enumerate(plan.bands):
            # A partner that owns the band has budget enough for it, thus so many words, and this set not far fewer.
            near = plan.slack * np.diff(bounds) >= plan.threshold * (plan.bands[k - 1] if k else 0) - 1e-9
            chosen = (band <= k) & (budget + top >= 0) & near
            at, o, t = _some(chosen, mo, mt)
            if not len(at):
                continue
            sig, to, doc, deleted = _segments(plan, k, budget[at], o, t)
            doc = at[doc]
            other = band[doc] < k
            if k and bitmap is not None:
                hit = _bits(bitmap, sig)
                sig, to, doc, deleted, other = (x[hit | ~other] for x in (sig, to, doc, deleted, other))
            sigs.append(sig)
            places.append(to)
            docs.append(doc)
            values.append(deleted.astype(np.uint8) + 2 * other.astype(np.uint8))
        table = np.zeros(len(keys), dtype=_DOC)
        table["key"], table["n"] = keys, np.diff(bounds)
        table["s0"], table["s1"] = sketches(bounds, tokens)
        return np.concatenate(sigs), np.concatenate(places), np.concatenate(docs), np.concatenate(values), table

    return emit


def _bits(bitmap: np.ndarray, sig: np.ndarray) -> np.ndarray:
    at = sig & np.uint64((1 << BITMAP_BITS) - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _reduce(plan: Allocation):
    """Pairs within each signature that pass the bounds; a pair needs one whole content and, above the first band, one
    set that owns the band. Within a signature postings lie in the order: owners' whole contents, owners' deletions,
    others' whole contents, others' deletions. The first meet all that come after, the second the third alone. Groups of
    any size are walked in vectors of one pair a posting, so memory stays flat."""

    def reduce(sig: np.ndarray, doc: np.ndarray, value: np.ndarray, docs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(docs) >= 1 << 30:
            raise ValueError("too many sets in one partition: raise spark.sql.shuffle.partitions")
        # A value is 1 for a deletion, and 2 more for a set that doesn't own the band.
        word = (sig.astype(np.uint64) << np.uint64(32)) | (value.astype(np.uint64) << np.uint64(30)) | doc.astype(np.uint64)
        word = np.sort(word)
        doc = (word & np.uint64((1 << 30) - 1)).astype(np.int64)
        kind = (word >> np.uint64(30)).astype(np.uint64)  # signature and value
        ends = np.flatnonzero(np.append(kind[1:] >> np.uint64(2) != kind[:-1] >> np.uint64(2), True))
        last = np.repeat(ends, np.diff(np.append(-1, ends)))
        place = np.arange(len(kind))
        # By posting, so that the pairs of one step read neighbouring memory.
        n, s0, s1 = docs["n"][doc], docs["s0"][doc], docs["s1"][doc]
        most = (plan.slack * np.arange(2 * int(n.max(initial=0)) + 1) + 1e-9).astype(np.int32)
        own = kind & np.uint64(3)
        whole = np.flatnonzero((own == 0) & (last > place))
        deleted = np.flatnonzero(own == 1)
        others = np.searchsorted(kind, (kind[deleted] | np.uint64(3)) - np.uint64(1))  # the first of the others' whole contents
        until = np.searchsorted(kind, kind[deleted] | np.uint64(3)) - 1
        got, size = [], 0
        for active, begin, end in ((whole, whole + 1, last[whole]), (deleted, others, until)):
            keep = begin <= end
            active, j, end = active[keep], begin[keep], end[keep]
            while len(active):
                odd = np.bitwise_count(s0[active] ^ s0[j]) + np.bitwise_count(s1[active] ^ s1[j])
                ok = np.flatnonzero(odd <= most[n[active] + n[j]])
                a, b = doc[active[ok]], doc[j[ok]]
                na, nb = n[active[ok]], n[j[ok]]
                ok = (a != b) & (np.minimum(na, nb) >= plan.threshold * np.maximum(na, nb) - 1e-9)
                if ok.any():
                    got.append((a[ok], b[ok]))
                    size += int(ok.sum())
                if size > 1 << 20:
                    yield np.concatenate([x for x, _ in got]), np.concatenate([x for _, x in got])
                    got, size = [], 0
                j = j + 1
                more = j <= end
                active, j, end = active[more], j[more], end[more]
        if got:
            yield np.concatenate([x for x, _ in got]), np.concatenate([x for _, x in got])

    return reduce


def similar_sets(sets: DataFrame, threshold: float) -> DataFrame:
    """All pairs (``a`` < ``b``, ``common``, ``na``, ``nb``) of different sets whose overlap is at least ``threshold``."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    sc = sets.sparkSession.sparkContext
    counts, total = document_counts(sets), sets.count()
    rarity = np.rint(4 * np.log2(np.maximum(counts, 1))).astype(np.uint8)
    plan = Allocation(threshold, word_kinds(counts, total), rarity, colour_words=COLOUR_WORDS)
    shared = sc.broadcast(plan)

    def histogram(own: np.ndarray, batch: pa.RecordBatch) -> None:
        budget = _read(shared.value, batch)[5]
        own += np.bincount(np.clip(budget, 0, _BUDGETS - 1).astype(np.int64), minlength=_BUDGETS)

    def most(own: np.ndarray, batch: pa.RecordBatch) -> None:
        np.maximum.at(own, 0, _read(shared.value, batch)[5].max(initial=0).astype(np.int64))

    budgets = folded(sets.select("key", "tokens"), histogram, _BUDGETS, "int64")
    # The last bucket holds all the larger budgets too; only then is it asked how large they are.
    largest = int(folded(sets.select("key", "tokens"), most, 64, "int64", "maximum")[0]) if budgets[-1] else 0
    plan = Allocation(threshold, plan.kinds, rarity, choose_bands(budgets, largest), COLOUR_WORDS)
    shared, bitmap = sc.broadcast(plan), None
    if len(plan.bands) > 1:

        def mark(own: np.ndarray, batch: pa.RecordBatch) -> None:
            _, _, tokens, owner, kinds, budget, band = _read(shared.value, batch)
            for k in range(1, len(shared.value.bands)):
                at, o, t = _some(band == k, owner[kinds == 2], tokens[kinds == 2])
                if len(at):
                    bit = _segments(shared.value, k, budget[at], o, t)[0] & np.uint64((1 << BITMAP_BITS) - 1)
                    np.bitwise_or.at(own, (bit >> np.uint64(3)).astype(np.int64), np.left_shift(1, bit & np.uint64(7)).astype(np.uint8))

        bitmap = sc.broadcast(folded(sets.select("key", "tokens"), mark, 1 << (BITMAP_BITS - 3), "uint8", "bitwise_or"))
    emit = lambda batch: _emit(shared.value, bitmap and bitmap.value)(batch)
    reduce = lambda *x: _reduce(shared.value)(*x)
    pairs = exchange(sets.select("key", "tokens"), emit, reduce, _DOC, np.uint8, partitions_for(sets, total, TASK_SETS))
    pairs = durable(pairs.distinct())
    found = verified(sets, pairs)
    return found.filter(F.col("common") >= F.lit(threshold) * (F.col("na") + F.col("nb") - F.col("common")) - 1e-9)


def near_duplicate_groups(sets: DataFrame, id_col: str, order_col: str, threshold: float) -> DataFrame:
    """(``id``, ``group_key``, ``links``): one row per id that is in a group of at least two ids.

    ``sets`` comes from ``word_set_table`` with ``id_col`` and ``order_col`` carried; of several rows of one id the one
    lowest in ``order_col`` counts. Ids are linked if the overlap of their sets is at least ``threshold``; ids with
    the same set are linked too; a group is whatever links connect. ``links`` counts the different sets linked to an
    id's set. Sets without a word link to nothing.
    """
    sets = durable(sets)
    members = sets.groupBy(F.col(id_col).alias("id")).agg(F.min_by("key", order_col).alias("key")).filter(F.col("id").isNotNull())
    members = durable(members)
    alive = members.select("key").distinct()
    links = similar_sets(sets, threshold).join(alive.withColumnRenamed("key", "a"), "a", "left_semi").join(alive.withColumnRenamed("key", "b"), "b", "left_semi")
    links = durable(links.select("a", "b"))
    roots = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    of = members.join(roots.join(degree, "node"), members["key"] == F.col("node"), "left")
    of = of.select("id", F.coalesce("root", "key").alias("group_key"), F.coalesce("links", F.lit(0)).alias("links"))
    many = of.groupBy("group_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("group_key")
    return of.join(many, "group_key", "left_semi").select("id", "group_key", "links")


def pairs_of(groups: DataFrame) -> DataFrame:
    """All pairs (``a`` < ``b``) of ids in one group: as many rows as the groups demand, and no other."""
    left = groups.select("group_key", F.col("id").alias("a"))
    right = groups.select("group_key", F.col("id").alias("b"))
    return left.join(right, "group_key").filter("a < b").select("a", "b")
