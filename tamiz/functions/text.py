"""Column functions over text: normalising, cleaning, counting and scoring, all inside the JVM.

Python's Unicode rules are kept where the engines differ: white space is the class ``WS``, a word is ``WORD``, and
patterns with word boundaries look at the text without accents (``plain``).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions import lexicon as lx

WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
NWS = r"[^\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]+"
LETTER = "A-Za-zÁÉÍÓÚÜÑáéíóúüñ"
URL = rf"(?i)https?://{NWS}+|www\.{NWS}+"
BROKEN_URL = rf"(?i)https?{WS}*:{WS}*/{WS}*/{WS}*{NWS}+|www{WS}*\.{WS}*{NWS}+"
#: What no link, whole or broken, is without.
LINK_SIGN = r"(?i)http|www"
DOI = rf"(?i)\b(?:doi{WS}*:?{WS}*)?10\.[0-9]{{4,9}}/{NWS}+"
EMAIL = r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+(?:\.[\p{L}\p{N}_-]+)+"
PHONE = r"(?i)\b(?:tel(?:e?fono)?|fax|lada sin costo|conmutador)\b|(?:\+?[0-9]{1,3}[ \t-]?)?(?:\(?[0-9]{2,4}\)?[ \t-]?){2,}[0-9]{2,4}"
PAGE_NUMBER = r"(?i)^ *(?:pag(?:ina)?\.? *)?[0-9]{1,4} *$"
PAGE_LABEL = r"(?i)^ *p *[aá] *g *i *n *a *\|? *[0-9]{1,4} *$"
SECTION_NUMBER = r"^ *(?:[0-9]{1,2}(?:\.[0-9]{1,3}){0,4}|[IVXLCDM]{1,8})[\). -]+"
REFERENCE = (
    r"(?i)\b(?:doi|isbn|issn|pmid|revista|journal|vol\.?|ed\.?|editorial)\b|\([0-9]{4}\)|\b[0-9]{4};[0-9]+|\bet\s+al\b|\bdisponible en\b"
    r"|\bconsultad[oa]\b|\bcitad[oa]\b"
)
ADMIN = (
    r"(?i)\b(?:isbn|issn|copyright|derechos reservados|agradecimientos?|directorio|relacion general de autores|autores|afiliacion|correspondencia"
    r"|primera edicion|segunda edicion|editorial|comisionado|director(?:a)?|subdirector(?:a)?|grupo de trabajo|correo electronico|e-?mail|telefono"
    r"|fax|lada sin costo|conflicto de interes|financiamiento)\b"
)
SURNAME = rf"^ *[A-ZÁÉÍÓÚÜÑ][{LETTER}' -]{{2,}}, *[A-ZÁÉÍÓÚÜÑ]"
ANSWER_KEY = r"(?i)\bRESPUESTA\s+CORRECTA\s*:\s*[A-E]\b"
ANSWER_NUMBERED = r"(?i)(?:^|\s)[0-9]{1,3}\.\s*RESPUESTA\s+CORRECTA\s*:\s*[A-E]\s*(?:COMENTARIO\s*:)?\s*"
ANSWER_PLAIN = r"(?i)(?:^|\s)RESPUESTA\s+CORRECTA\s*:\s*[A-E]\s*(?:COMENTARIO\s*:)?\s*"
EXAM_HEADER = r"(?i)\bRESPUESTAS?\s+ENARM\b"
LINE_BREAK = r"\r\n|\r|\x{2028}|\x{2029}"
SPLIT_LINES = r"\r\n|[\n\r\x{0B}\x{0C}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"


def _accents() -> tuple[str, str]:
    """Every character of the basic plane that is one character and marks, and that character; by rule."""
    pairs = []
    for code in range(0xC0, 0x10000):
        if not (0xD800 <= code <= 0xDFFF or 0xAC00 <= code <= 0xD7A3):
            base = [c for c in unicodedata.normalize("NFD", chr(code)) if not unicodedata.category(c).startswith("M")]
            if len(base) == 1 and base[0] != chr(code):
                pairs.append((chr(code), base[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def _compatible() -> tuple[str, str]:
    """Every character of the basic plane that is a compatibility form of one ASCII letter or digit; by rule."""
    pairs = [
        (chr(code), x) for code in range(0xA0, 0x10000)
        if not 0xD800 <= code <= 0xDFFF and len(x := unicodedata.normalize("NFKD", chr(code))) == 1 and x.isascii() and x.isalnum()
    ]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, UNACCENTED = _accents()
COMPATIBLE, ASCII = _compatible()
#: Compatibility forms of several characters that occur in texts taken from PDF files.
LIGATURES = (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("½", "1 2"), ("¼", "1 4"), ("¾", "3 4"), ("™", "TM"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once. Inside higher-order functions nothing else keeps an expression
    that is named several times from being evaluated as often."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def plain(text: Column | str) -> Column:
    """Without accents and other marks; a null text is empty."""
    return F.translate(F.regexp_replace(F.coalesce(_col(text), F.lit("")), r"\p{M}+", ""), ACCENTED, UNACCENTED)


def normalize(text: Column | str) -> Column:
    """For comparing: no accents, lower case, words of a-z and 0-9 with one space between them; null gives ''."""
    bare = F.regexp_replace(F.coalesce(_col(text), F.lit("")), r"\p{M}+", "")
    return _words(F.translate(bare, ACCENTED + COMPATIBLE, UNACCENTED + ASCII))


def normalize_plain(without_accents: Column) -> Column:
    return _words(F.translate(without_accents, COMPATIBLE, ASCII))


def _words(out: Column) -> Column:
    for a, b in LIGATURES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(F.lower(out), "[^a-z0-9]+", " "))


def slugify(name: Column | str) -> Column:
    """A file name's stem as an identifier; ``document`` if nothing is left."""
    base = F.regexp_replace(F.coalesce(_col(name), F.lit("")), r"^.*/", "")
    stem = F.when(base.rlike(r"^[^.].*\.[^.]+$") | base.rlike(r"^\.[^.]*\..*[^.]$"), F.regexp_replace(base, r"\.[^.]+$", "")).otherwise(base)
    return F.coalesce(F.nullif(F.regexp_replace(normalize(stem), " ", "_"), F.lit("")), F.lit("document"))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{WS}+|{WS}+$", "")


def collapse(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(_col(text), F.lit("")), rf"{WS}+", " "))


def word_count(text: Column | str) -> Column:
    return F.regexp_count(F.coalesce(_col(text), F.lit("")), F.lit(WORD))


def token_count(text: Column | str) -> Column:
    return F.regexp_count(F.coalesce(_col(text), F.lit("")), F.lit(f"{NWS}+"))


def tokens_of(words: Column) -> Column:
    """Estimated tokens of a number of words."""
    return F.greatest(F.lit(1), F.ceil(words * F.lit(1.35))).cast("int")


def estimate_tokens(text: Column | str) -> Column:
    return tokens_of(word_count(text))


def lines_of(text: Column | str) -> Column:
    """Lines as Python's splitlines() cuts them, but for an empty last one."""
    cut = lambda x: F.when(F.element_at(x, -1) == "", F.slice(x, F.lit(1), F.size(x) - 1)).otherwise(x)
    return let(F.split(F.coalesce(_col(text), F.lit("")), SPLIT_LINES), cut)


def nonblank_lines(text: Column | str) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(_col(text), F.lit("")), SPLIT_LINES), strip), lambda x: x != "")


def any_of(text: Column, terms: Iterable[str]) -> Column:
    """Whether one of the terms is a part of ``text``; plain searches, which pass a text far faster than a pattern of
    alternatives does."""
    listed = F.array(*map(F.lit, terms))
    return let(text, lambda t: F.exists(listed, lambda x: F.contains(t, x)))


def is_noise(line: Column, bare: Column, normal: Column) -> Column:
    """Whether a line is contact data, credits, a reference or such; ``bare`` and ``normal`` are its plain and normalised forms."""
    person = line.rlike(SURNAME) & (token_count(line) > 5) & ~any_of(normal, lx.CLINICAL_TERMS)
    # Each pattern only where the line has what it can't do without.
    link, at, ten = line.rlike(LINK_SIGN), F.contains(line, F.lit("@")), F.contains(line, F.lit("10."))
    return (
        normal.isin(*lx.DROP_HEADINGS) | (link & (line.rlike(BROKEN_URL) | line.rlike(URL))) | (at & line.rlike(EMAIL)) | (ten & line.rlike(DOI)) | bare.rlike(PHONE)
        | bare.rlike(ADMIN) | (line.rlike(r"^ *[0-9]{1,3}\. +") & bare.rlike(REFERENCE)) | person
    )


def clean(text: Column | str) -> Column:
    """Extracted text without control characters, links, addresses, page numbers and noise lines; null gives ''."""
    out = F.regexp_replace(F.coalesce(_col(text), F.lit("")), LINE_BREAK, "\n")
    out = F.regexp_replace(out, r"[\x{FEFF}\x{200B}\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}]", "")
    for pattern in (BROKEN_URL, URL, DOI, EMAIL):
        out = F.regexp_replace(out, pattern, "")
    out = F.regexp_replace(out, rf"([{LETTER}])- *\n *([{LETTER}])", "$1$2")
    out = F.regexp_replace(F.regexp_replace(out, "[•◦▪·]", "- "), r"[ \t]+", " ")
    # A line's forms are made once and kept beside it; in one lambda they would be made again for every test.
    each = F.transform(F.transform(F.split(out, "\n"), strip), lambda x: F.struct(x.alias("l"), plain(x).alias("p")))
    each = F.transform(each, lambda x: F.struct(x.l.alias("l"), x.p.alias("p"), normalize_plain(x.p).alias("n")))
    keep = F.filter(each, lambda x: (x.l == "") | ~(x.l.rlike(PAGE_NUMBER) | x.l.rlike(PAGE_LABEL) | is_noise(x.l, x.p, x.n)))
    joined = F.array_join(F.transform(keep, lambda x: x.l), "\n")
    return strip(F.regexp_replace(joined, r"\n{3,}", "\n\n"))


def line_signature(line: Column) -> Column:
    """What makes two lines the same line; '' for lines too short or of digits only."""
    return let(normalize(line), lambda n: F.when((F.length(n) < 4) | n.rlike("^[0-9]+$"), "").otherwise(n))


def is_heading(line: Column | str) -> Column:
    def rule(x: Column) -> Column:
        bare, normal, words = x.b, x.n, x.w
        letters, small = F.regexp_count(bare, F.lit(r"\p{L}")), F.regexp_count(bare, F.lit(r"\p{Ll}"))
        return (
            normal.isin(*lx.DROP_HEADINGS, *lx.INDEX_TERMS) | normal.rlike(r"^(capitulo|cap|tema|seccion|anexo)\b")
            | (bare.rlike(SECTION_NUMBER) & (words <= 12)) | ((letters >= 6) & ((letters - small) >= letters * F.lit(0.72)))
        )

    def short(bare: Column) -> Column:
        words = token_count(bare)
        fits = (bare != "") & (F.length(bare) <= 110) & (words <= 14)
        return F.when(fits, let(F.struct(bare.alias("b"), normalize(bare).alias("n"), words.alias("w")), rule)).otherwise(F.lit(False))

    return let(F.regexp_replace(_col(line), "^[ :-]+|[ :-]+$", ""), short)


def first_heading(text: Column | str) -> Column:
    """The first heading among a page's first ten lines that doesn't name an index; null if there is none."""
    found = F.filter(F.slice(lines_of(text), 1, 10), lambda x: is_heading(x) & ~normalize(x).isin(*lx.INDEX_TERMS))
    return F.regexp_replace(F.get(found, F.lit(0)), "^[ :-]+|[ :-]+$", "")


def reference_ratio(text: Column | str) -> Column:
    """The share of non-blank lines that look like references; 0 without lines."""
    share = lambda ls: F.try_divide(F.size(F.filter(ls, lambda x: x.rlike(REFERENCE))).cast("double"), F.size(ls))
    return F.coalesce(let(nonblank_lines(plain(text)), share), F.lit(0.0))


def reference_markers(text: Column | str) -> Column:
    t, p = F.coalesce(_col(text), F.lit("")), plain(text)
    zero = F.lit(0)
    links = F.when(t.rlike(LINK_SIGN), F.regexp_count(t, F.lit(URL)) + F.regexp_count(t, F.lit(BROKEN_URL))).otherwise(zero)
    dois = F.when(F.contains(t, F.lit("10.")), F.regexp_count(t, F.lit(DOI))).otherwise(zero)
    words = let(p, lambda x: F.regexp_count(x, F.lit(REFERENCE)) + F.regexp_count(x, F.lit(r"(?i)\b(?:referencias|bibliografia)\b")))
    return words + links + dois


def suspicious_ratio(text: Column | str) -> Column:
    t = F.coalesce(_col(text), F.lit(""))
    weird = F.length(t) - F.length(F.translate(t, lx.WEIRD_CHARACTERS, ""))
    quotes = F.length(t) - F.length(F.translate(t, '"', ""))
    return F.when(t == "", 0.0).otherwise((weird + F.greatest(F.lit(0), quotes - 4)).cast("double") / F.length(t))


def numeric_ratio(text: Column | str) -> Column:
    t = F.coalesce(_col(text), F.lit(""))
    digits = F.regexp_count(t, F.lit(rf"{NWS}*[0-9]{NWS}*"))
    return F.coalesce(F.try_divide(digits.cast("double"), token_count(t)), F.lit(0.0))


def decimal_count(text: Column | str) -> Column:
    return F.regexp_count(F.coalesce(_col(text), F.lit("")), F.lit(r"\b[0-9]+[.,][0-9]+\b"))


def lexicon_hits(normal: Column, weights: dict[str, int]) -> Column:
    """The sum of the weights of the terms that are a part of ``normal``, which must be a column that is there already:
    it is looked at once for each term."""
    of = {w: [t for t, x in weights.items() if x == w] for w in sorted(set(weights.values()))}
    return sum((F.size(F.filter(F.array(*map(F.lit, terms)), lambda t: F.contains(normal, t))) * w for w, terms in of.items()), F.lit(0))


def clinical_weights() -> dict[str, int]:
    out: dict[str, int] = {}
    for term in lx.CLINICAL_TERMS:
        out[term] = out.get(term, 0) + (2 if " " in term else 1)
    for term in lx.ACTION_TERMS:
        out[term] = out.get(term, 0) + 1
    return out


def clinical_score(normal: Column, words: Column, references: Column) -> Column:
    """At least 0: two for each phrase and one for each word of the lexicon, more for long texts, less for references."""
    long_ = F.when(words >= 350, 4).when(words >= 120, 2).otherwise(0)
    return F.greatest(F.lit(0), lexicon_hits(normal, clinical_weights()) + long_ - F.when(references >= 0.35, 3).otherwise(0))


def strip_exam_noise(text: Column | str) -> Column:
    """Without exam headers, answer keys, blank lines and lines of a table of contents."""
    out = F.coalesce(_col(text), F.lit(""))
    for pattern in (EXAM_HEADER, ANSWER_NUMBERED, ANSWER_PLAIN):
        out = F.regexp_replace(out, pattern, " ")
    dense = lambda x: F.length(F.regexp_replace(x, rf"[.0-9]|{WS}", ""))
    contents = lambda x: x.rlike(r"\.{4,}") & ((F.length(x) >= 40) | (dense(x) < 40))
    return F.array_join(F.filter(nonblank_lines(out), lambda x: ~contents(x)), "\n")


def fingerprint(text: Column | str, words: int = 100) -> Column:
    """A document's first words of more than three letters."""
    return F.array_join(F.slice(F.filter(F.split(normalize(text), " "), lambda w: F.length(w) > 3), 1, words), " ")


def first_words(normal: Column, n: int = 240) -> Column:
    return F.array_join(F.slice(F.split(normal, " "), 1, n), " ")


def detect_language(text: Column | str) -> Column:
    """es or en by marker words (ties: es), unknown without any."""
    hits = lambda words, of: F.size(F.filter(words, lambda w: w.isin(*of)))
    counts = let(F.split(normalize(text), " "), lambda ws: F.struct(hits(ws, lx.SPANISH_MARKERS).alias("es"), hits(ws, lx.ENGLISH_MARKERS).alias("en")))
    return let(counts, lambda c: F.when((c.es == 0) & (c.en == 0), "unknown").when(c.es >= c.en, "es").otherwise("en"))


def looks_spanish(text: Column | str) -> Column:
    low = F.concat(F.lit(" "), F.lower(F.coalesce(_col(text), F.lit(""))), F.lit(" "))
    score = sum((F.when(F.contains(low, F.lit(f" {w} ")), 1).otherwise(0) for w in lx.SPANISH_SIGNALS), F.when(low.rlike("[áéíóúñü]"), 2).otherwise(0))
    return score >= 4


def clinical_density(text: Column | str) -> Column:
    """Hits per word, not rounded; 0 without words."""
    share = lambda ws: F.try_divide(F.size(F.filter(ws, lambda w: w.isin(*lx.DENSITY_TERMS))).cast("double"), F.size(ws))
    return F.coalesce(let(F.filter(F.split(normalize(text), " "), lambda w: w != ""), share), F.lit(0.0))


def cascade(rules: Sequence[tuple[str, Column]], otherwise: Column | str | None = "") -> Column:
    """The name of the first rule that holds; a rule that is null doesn't."""
    out = None
    for name, holds in rules:
        out = F.when(holds, name) if out is None else out.when(holds, name)
    return out.otherwise(otherwise)


def contained(text: Column, terms: Iterable[str]) -> Column:
    """How many of the terms are a part of ``text``."""
    return sum((F.when(F.contains(text, F.lit(t)), 1).otherwise(0) for t in terms), F.lit(0))


def document_type(name: Column | str, text: Column | str) -> Column:
    """By the file name, else by at least two markers of one kind in the text (ties: first kind), else by chapter words."""
    low, sample = F.lower(F.coalesce(_col(name), F.lit(""))), F.substring(F.lower(F.coalesce(_col(text), F.lit(""))), 1, 5000)
    scores = {k: contained(sample, terms) for k, terms in lx.TEXT_TYPES.items()}
    best = F.greatest(*scores.values())
    rules = [(k, contained(low, terms) > 0) for k, terms in lx.NAME_TYPES.items()]
    rules += [(k, (best >= 2) & (s == best)) for k, s in scores.items()]
    return cascade([*rules, ("book", contained(low, lx.CHAPTER_WORDS) > 0)], "unknown")


def section_type(head: Column, start: Column, score: Column) -> Column:
    """By keywords of the normalised heading, else of the normalised beginning of the text, else by its clinical score."""
    rules = [(k, any_of(x, terms)) for x in (head, start) for k, terms in lx.SECTION_TYPES.items()]
    return cascade([*rules, ("clinical_content", score >= 5)], "unknown")


def content_role(opening: Column, section: Column, score: Column) -> Column:
    """The role of most keywords in the normalised opening, with two more for the section's own role; at least two must
    speak for it (ties: first role), else the clinical score decides."""
    scores = {
        role: lexicon_hits(opening, dict.fromkeys(terms, 1)) + F.when(section.isin(*[s for s, r in lx.DEFAULT_ROLES.items() if r == role]), 2).otherwise(0)
        for role, terms in lx.CONTENT_ROLES.items()
    }
    best = F.greatest(*scores.values())
    return cascade([*((k, (best >= 2) & (s == best)) for k, s in scores.items()), ("evidence", score >= 8), ("background", score >= 4)], "unknown")


def topics(normal: Column) -> Column:
    return F.array_compact(F.array(*[F.when(any_of(normal, terms), topic) for topic, terms in lx.TOPICS.items()]))


def has_meta_reference(text: Column | str) -> Column:
    return contained(F.lower(F.coalesce(_col(text), F.lit(""))), lx.META_PATTERNS) > 0


def word_set(text: Column | str) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(_col(text), F.lit(""))), F.lit(WORD), F.lit(0)))


def json_object(text: Column | str) -> Column:
    """The JSON object in an answer that may be fenced or surrounded by prose; null if there is none."""
    return F.nullif(F.regexp_extract(F.coalesce(_col(text), F.lit("")), r"(?s)\{.*\}", 0), F.lit(""))


def html_text(html: Column | str) -> Column:
    """The readable text of a page of HTML: no scripts, styles, navigation or tags, blocks on lines of their own."""
    out = F.regexp_replace(F.coalesce(_col(html), F.lit("")), r"(?is)<(script|style|nav|noscript|template)\b.*?</\1\s*>|<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?i)</?(p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|blockquote|pre)\b[^>]*>", "\n")
    out = F.regexp_replace(out, r"<[^>]*>", "")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(char))
    return F.array_join(F.filter(F.transform(F.split(out, "\n"), lambda x: collapse(x)), lambda x: x != ""), "\n")


def filename_type(name: Column | str) -> Column:
    """The document type by the file name alone, for documents without text; ``unknown`` if no pattern fits."""
    return let(normalize(name), lambda n: cascade([(k, n.rlike(p)) for k, p in lx.FILENAME_TYPES.items()], "unknown"))


def tail_words(text: Column | str, n: int) -> Column:
    """The last ``n`` words, with one space between them; '' without words."""
    return let(F.split(collapse(text), " "), lambda w: F.array_join(F.slice(w, F.greatest(F.size(w) - n + 1, F.lit(1)), F.lit(n)), " "))
