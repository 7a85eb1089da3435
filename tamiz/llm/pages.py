"""Which parts of a page are keywords, links, product tags or sentences written only to repeat a term."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

#: Function words of the languages that pages come in; keyword phrases have few of them. Words for 'more'
#: are left out, since links say them.
FUNCTION_WORDS = frozenset(
    """a al ante antes aquí aquel así aunque bajo cada como con contra cuando de del desde después donde durante e el ella ellas ellos en entre era
    es esa ese eso esta este esto fue fueron ha han hasta la las le les lo los me mi muy ni no nos o para pero por porque pues que qué se
    según ser si sin sobre son su sus también tan te todo todos tras tu un una unas uno unos y ya
    about after all an and are as at be been before but by for from had has have he her his how if in into is it its not of on or our she
    than that the their them there these they this to was we were what when which who will with you your
    au aux avec ce ces dans des donc du elle elles est et il ils je leur mais ne nous on ont ou par pas pour qu qui sa sont sur une vous
    ao aos às com da das do dos em foi isso já mas na nas nem nos num numa o os ou pela pelo quando quem são seu sua um uma à é
    aber als am auch auf aus bei bis das dem den der die durch ein eine einer es für hat ich im ist mit nach nicht oder sich sie sind und von
    vor war wie wird zu zum zur
    alla che chi ci come dal dalla degli dei della delle di gli il i ma nel nella non per più sono suo tra""".split()
)
_BREAKS = re.compile(r"[\r\n\x0b\x0c\x1c-\x1e\x85  ]+")
_HIDDEN = re.compile("[­​-‏‪-‮⁠-⁤﻿]")
_HYPHENATED = re.compile(r"(?<=[^\W\d_])-[ \t]*[\r\n ]+[ \t]*(?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")
_LINK = re.compile(r"(?:https?://|www\.)\S+|\bindex\.php\S*|(?<!\S)(?:\.\.?)?/[^\s/]+/\S*|(?<!\S)\S+\.(?:html?|php|aspx?)\b\S*", re.IGNORECASE)
_TAG = re.compile(r"(?<!\w)#\w+")
_PRICE = re.compile(r"(?:[€$£]\s?\d[\d.,]*|\d[\d.,]*\s?(?:[€$£]|eur\b|usd\b))", re.IGNORECASE)
_PRODUCT = re.compile(r"\b(?:ref|sku|cod|código|art|ean|stock|unid|uds?)\b\.?", re.IGNORECASE)
_LEADER = re.compile(r"(?:\.\s?){4,}|(?:[—–…·_-]\s?){4,}")
_PAGE_NUMBER = re.compile(r"(?:\s[—–-]\s*|,\s*|\s{2,}|\t)\d{1,4}(?:\s*[,;-]\s*\d{1,4})*\s*$")
_NUMBERED = re.compile(r"^\s*(?:\[?\d{1,3}[\].)]|\d{1,2}(?:\.\d{1,2})+\.?|[☐☑☒□✓✔]|\[[ xX]\])\s+")
_CITATION = re.compile(r"\b(?:19|20)\d\d\s*;\s*\d+|\bdoi:\s*10\.|\bet al\b|\b\d+\(\d+\):\s?\d+")
_UNITS = re.compile(r"\b\d+(?:[.,]\d+)?\s*(?:mg|mcg|µg|g|ml|ui|iu|mmol|mmhg|%|h|horas?|hours?|heures?|días?|days?)\b", re.IGNORECASE)
_ABBREVIATION = re.compile(r"^\s*[A-ZÁÉÍÓÚÑ0-9]{2,12}\s*[:=–—-]\s")
_ITEMS = re.compile(r"\s*(?:[,;·•|»›>]|\s[/\-–—]\s|\s{2,}|\t)\s*")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+")
_HYPHEN = re.compile(r"\w-\w")
_LABEL = re.compile(r"^\s*[^\W\d_][^:]{0,28}:\s*")
#: The languages whose function words are listed, and letters that none of them has.
LISTED, _UNLISTED = frozenset(("es", "en", "fr", "pt", "it", "de")), re.compile("[ąćčďđěęğıłńňőřśşșšťțůűźżž]")
_LINK_SIGNS, _PRICE_SIGNS = ("www.", "index.php", ".htm", ".php", ".asp"), ("€", "$", "£", "eur", "usd")

PROSE, STRUCTURE, SPAM, BARE = range(4)


def _function_share(words: list[str], short: bool = False) -> float:
    """The share of function words; in a language that isn't listed (``short``) words of up to three letters stand for them."""
    return sum(w in FUNCTION_WORDS or (short and len(w) <= 3 and not w.isdigit()) for w in words) / len(words) if words else 0.0


def unlisted(text: str, lang: str | None) -> bool:
    """Whether a page is of a language without a list of function words: by its label, without one by its letters."""
    lang = (lang or "").strip().lower()[:2]
    if lang in LISTED:
        return False
    return lang not in ("", "un") or len(_UNLISTED.findall(text.lower())) > 0.01 * len(text)


def make_up(text: str, counts: Counter) -> list[int]:
    """A page's characters in links, tags, prices, other digits, separators, function words and other words."""
    low = text.lower()
    links = sum(map(len, _LINK.findall(text))) if "/" in low or any(x in low for x in _LINK_SIGNS) else 0
    tags = sum(map(len, _TAG.findall(text))) if "#" in text else 0
    prices = sum(map(len, _PRICE.findall(text))) if any(x in low for x in _PRICE_SIGNS) else 0
    words = function = digits = 0
    for w, c in counts.items():
        n = len(w) * c
        words += n
        if w in FUNCTION_WORDS:
            function += n
        elif w.isdigit():
            digits += n
    marks = sum(map(text.count, ",;·•|»›>/-–—\t\n"))
    return [links, tags, prices, digits, marks, function, words - function - digits]


def segment_kind(segment: str, short: bool = False) -> int:
    """PROSE, STRUCTURE (contents, references, doses, abbreviations ...), SPAM, or BARE (a short line, undecided)."""
    words = [w.lower() for w in _WORD.findall(segment)]
    if not words:
        return PROSE
    if sum(w[0] > "\u024f" for w in words) > 0.5 * len(words) and "://" not in segment and "#" not in segment:
        return PROSE  # function words of other scripts aren't known here
    # Each pattern is tried only on segments with a sign that it needs.
    digits = any(map(str.isdigit, segment))
    low = segment.lower()
    links = _LINK.findall(segment) if "/" in segment or any(x in low for x in _LINK_SIGNS) else ()
    tags = _TAG.findall(segment) if "#" in segment else ()
    citation = bool((digits or "et al" in segment) and _CITATION.search(segment))
    if links or tags:
        rest = [w.lower() for w in _WORD.findall(_TAG.sub(" ", _LINK.sub(" ", segment)))]
        marked = len(words) - len(rest)
        if not citation and (marked >= 0.5 * len(words) or (len(rest) <= 8 and _function_share(rest, short) < 0.34 and marked >= 2)):
            return SPAM
    if citation or _LEADER.search(segment) or _NUMBERED.match(segment) or _ABBREVIATION.match(segment):
        return STRUCTURE
    if digits and any(x in low for x in _PRICE_SIGNS) and _PRICE.search(segment) and (_PRODUCT.search(segment) or (len(words) <= 14 and _function_share(words, short) < 0.3)):
        return SPAM
    if "\t" in segment and "€" not in segment and digits and _UNITS.search(segment):
        return STRUCTURE
    if digits and len(words) <= 14 and _PAGE_NUMBER.search(segment):
        return STRUCTURE
    share = _function_share(words, short)
    body = _LABEL.sub("", segment, count=1) if ":" in segment[:30] else segment
    items = [n for x in _ITEMS.split(body.strip(" .;,|»")) if (n := len(_WORD.findall(x)))]
    if len(items) >= 4 and sum(items) / len(items) <= 6 and share < 0.27:
        return SPAM
    joined = [w for w in body.split() if _HYPHEN.search(w)] if body.count("-") >= 4 else ()
    if len(joined) >= 4 and len(joined) >= 0.6 * len(body.split()):
        return SPAM
    if len(words) <= 12 and segment.rstrip()[-1:] not in ".?!:" and share < 0.3:
        return BARE
    if len(items) >= 3 and sum(items) / len(items) <= 5 and share < 0.2:
        return BARE
    if len(words) >= 25 and share < 0.12 and not short and not _UNITS.search(segment):
        return SPAM
    return PROSE


def repeated_term(segments: list[list[str]]) -> tuple[str, ...] | None:
    """The phrase of one to four words that a page's sentences are written to repeat, if there is one."""
    best, most = None, 0.0
    total = sum(map(len, segments))
    single = Counter(w for words in segments for w in words if w not in FUNCTION_WORDS)
    if not single or single.most_common(1)[0][1] < max(4, 0.03 * total):
        return None
    for n in (1, 2, 3, 4):
        counts: Counter = Counter()
        holding: Counter = Counter()
        for words in segments:
            own = Counter(
                g for i in range(len(words) - n + 1)
                if (g := tuple(words[i : i + n]))[0] not in FUNCTION_WORDS and g[-1] not in FUNCTION_WORDS and not g[0].isdigit()
            )
            counts.update(own)
            holding.update(own.keys())
        for g, c in counts.most_common(5):
            weight = c * n
            if c >= 4 and c >= 1.6 * holding[g] and weight >= 0.12 * total and weight > most * 1.05:
                best, most = g, weight
    return best


def spam_share(text: str | None, lang: str | None = None) -> float:
    """The share of a page's characters in keywords, links, product tags or sentences that repeat a term (0 to 1)."""
    if not text or text.isspace():
        return 0.0
    text = _HYPHENATED.sub("", _HIDDEN.sub("", unicodedata.normalize("NFC", text)))
    short = unlisted(text, lang)
    segments: list[tuple[str, int]] = []
    for line in _BREAKS.split(text):
        if not line.strip():
            continue
        kind = segment_kind(line, short)
        if kind != SPAM and len(line) > 60:
            segments += [(s, segment_kind(s, short)) for s in _SENTENCE.split(line) if s.strip()]
        else:
            segments.append((line, kind))
    kinds = [k for _, k in segments]
    i = 0
    while i < len(kinds):  # short lines are a link list if many follow one another, else headings
        if kinds[i] in (BARE, SPAM):
            j = i
            while j < len(kinds) and kinds[j] in (BARE, SPAM):
                j += 1
            run = [w.lower() for s, k in segments[i:j] if k == BARE for w in _WORD.findall(s)]
            bare = sum(k == BARE for k in kinds[i:j])
            spam = (bare >= 4 or j - i > bare) and _function_share(run, short) < 0.3
            for k in range(i, j):
                if kinds[k] == BARE:
                    kinds[k] = SPAM if spam else STRUCTURE
            i = j
        i += 1
    words = [[w.lower() for w in _WORD.findall(s)] if k == PROSE else [] for (s, _), k in zip(segments, kinds, strict=True)]
    if (term := repeated_term([w for w in words if w])) is not None:
        n = len(term)
        for k, w in enumerate(words):
            if any(tuple(w[x : x + n]) == term for x in range(len(w) - n + 1)):
                kinds[k] = SPAM
    total = sum(len(s.strip()) for s, _ in segments)
    return sum(len(s.strip()) for (s, _), k in zip(segments, kinds, strict=True) if k == SPAM) / total if total else 0.0
