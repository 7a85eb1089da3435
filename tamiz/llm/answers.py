"""What is wrong with one answer: placeholders, refusals, copies, languages, and the nesting of marks."""

from __future__ import annotations

import re
import unicodedata
from math import log

#: What stands in a field that holds no answer, as words.
PLACEHOLDERS = frozenset((
    "a", "answer", "blank", "empty", "en blanco", "n a", "n d", "na", "nan", "nd", "nil", "no answer", "no aplica", "no disponible", "none",
    "not available", "null", "pendiente", "r", "respuesta", "sin contenido", "sin dato", "sin datos", "sin respuesta", "tbd", "todo", "undefined",
    "vacia", "vacio",
))
#: The grammar of refusals, over words without accents. A sentence declines outright if somebody speaks of
#: himself (ABLE or WILL) and then names the act of answering (ACT), or if it is one of OUTRIGHT; wherever it stands, that is a
#: refusal. It declines by the way if, after any OPENINGS, it begins with one of EVASIONS.
OPENINGS = (
    r"lo siento( mucho)?", r"lo lamento", r"lamentablemente", r"desgraciadamente", r"disculpe( usted)?", r"disculpa", r"perdon", r"me temo que",
    r"como (asistente|modelo( de lenguaje)?|ia|inteligencia artificial)( de \w+| virtual)?", r"con la informacion (dada|disponible|facilitada)", r"en este caso", r"por desgracia",
    r"agradezco (la|su|tu) (pregunta|consulta)", r"gracias por (la|su|tu) (pregunta|consulta)", r"pero", r"de modo que", r"asi que", r"por (eso|ello|tanto)",
    r"(i m|i am) (very )?(sorry|afraid)( but| that)?", r"sorry( but)?", r"unfortunately", r"apologies( but)?", r"as an? (ai|assistant)( language)?( model| assistant)?",
    r"(with|given) the information (given|available|provided)", r"i regret( that)?", r"pardon( me)?", r"(thank you|thanks) for (your|the) question", r"but", r"so", r"therefore",
)
ABLE = (
    r"no (puedo|podria|podre|podemos|podriamos|podremos|sabria|sabriamos)", r"no me (es|resulta) (posible|facil)", r"me (es|resulta|seria) imposible", r"(soy|somos) incapaz(es)? de",
    r"no estoy (en condiciones de|autorizad[oa] (a|para)|capacitad[oa] para|facultad[oa] para)", r"no estamos (en condiciones de|autorizad[oa]s (a|para))",
    r"i (can ?not|can t|could not|couldn t|am not able to|m not able to|am unable to|m unable to|am not in a position to)", r"we (can ?not|can t|are not able to|are unable to)",
    r"it is (not possible|impossible) for (me|us) to",
)
WILL = (
    r"no (voy|vamos) a", r"no (quiero|queremos|deseo|debo|debemos)", r"(prefiero|preferimos|preferiria) no", r"(debo|tengo que|he de|prefiero|prefiriria|quisiera) (abstenerme de|declinar|evitar|rechazar|negarme a|no)",
    r"me (abstengo|abstendre) de", r"nos abstenemos de", r"me (niego|negare) a", r"(declino|declinare|declinamos|rechazo|rechazare|rehuso|rehusare|evito|evitare|evitaremos|eludo|eludire|renuncio a|renunciare a)",
    r"i (won t|will not|would rather not|prefer not to|decline to|refuse to|must decline to|must refrain from|have to decline to|must not|should not|am going to refrain from)",
)
ACT = (
    r"respond\w*", r"contest\w*", r"opin\w*", r"pronunci\w*", r"ayud\w*", r"ofrec\w*", r"dar(te|le|les|os)?", r"proporcion\w*", r"facilit\w*", r"asist\w*", r"atend\w*", r"aconsej\w*", r"asesor\w*",
    r"decir(te|le|lo)?", r"indic\w*", r"coment\w*", r"hacer(lo)?", r"entrar", r"valorar(lo)?", r"recomend\w*", r"determin\w*", r"asegur\w*", r"orient\w*",
    r"answer\w*", r"repl(y|ies|ying)", r"respon(d|ding|se)", r"help\w*", r"advis\w*", r"say\w*", r"giv(e|ing)", r"provid\w*", r"offer\w*", r"comment\w*", r"recommend\w*", r"assist\w*", r"tell\w*",
    r"do (so|that|this)", r"discuss\w*", r"determin\w*", r"speculat\w*",
)
OUTRIGHT = (
    r"no (ofrezco|doy|facilito|proporciono) (pautas|consejos?|recomendaciones|indicaciones|respuestas?|opiniones)", r"(mis|las|nuestras) (normas|politicas|instrucciones|directrices|reglas) (no )?(me |nos )?(impiden|permiten|prohiben)",
    r"no (es )?respondible", r"no (dispongo|cuento|disponemos|contamos) (de|con) (\w+ )?(datos|informacion|elementos|conocimientos)", r"no (tengo|tenemos) (\w+ )?(datos|informacion|acceso|respuesta|conocimientos?)",
    r"(carezco de|desconozco|ignoro) (\w+ )?(la )?(datos|informacion|respuesta|elementos)", r"no (sabria|se) (que )?(decir|responder|contestar)\w*", r"como (modelo de lenguaje|asistente virtual|inteligencia artificial)", r"as an? (ai|language model)",
    r"my (guidelines|rules|policies|instructions) (forbid|prevent|do not|don t)", r"i (do not|don t) (have|know) (\w+ )?(information|data|answer|access|enough)", r"i have no (data|information|answer)", r"i (would not|wouldn t) know",
    r"(question|it|consulta|pregunta) (can ?not be answered|no (se )?puede (ser )?(respond\w*|contest\w*))",
)
EVASIONS = (
    r"no me (es|resulta) posible", r"me (es|resulta) imposible", r"no estoy seguro", r"(la|una) respuesta no (puede|se puede|cabe|es posible)( \w+)?",
    r"(el|la|este|ese) (fragmento|texto|contexto|pasaje|documento|extracto|material) (facilitado |disponible )?no (aporta|permite|contiene|ofrece|menciona|incluye|dice|da|basta|aclara)",
    r"(esa|esta|su|la) (consulta|pregunta|cuestion) (queda|esta|excede|cae|escapa)( \w+)? (fuera )?(de )?mi(s)? (alcance|competencias?|posibilidades)", r"sin comentarios$",
    r"es un (asunto|tema) (delicado|sensible) que debe valorar (su|un) \w+", r"(debe|deberia|conviene que) consult\w+ (a |con )?(su|un) (medico|profesional|especialista)$",
    r"it is (not possible|impossible) for me", r"(the|this|that) (passage|text|context|excerpt|fragment|document|material) (given )?(does not|doesn t) (say|give|contain|allow|mention|provide|include|clarify|make it clear)",
    r"(the|an) answer (can ?not|can t) be", r"(that|this|your) (question|query|request) (is|lies|falls) (outside|beyond)", r"no comment$", r"(no puedo|no podria|no podre|i can ?not|i can t)",
)
_SAY = "(?:" + "|".join(ABLE + WILL) + r")(?: \w+){0,3}? (?:" + "|".join(ACT) + ")"
_OUTRIGHT = re.compile(r"(?:" + _SAY + "|" + "|".join(OUTRIGHT) + r")\b")
_EVASION = re.compile("(?:(?:" + "|".join(OPENINGS) + r")(?: sobre( \w+){1,8}?)? )*(?:" + "|".join(EVASIONS) + r")\b")
_SENTENCES = re.compile(r"(?<=[.!?;:…])\s+|\n+")
#: Words with which alone what declines outright begins, and words one of which every evasion has; without them no grammar is tried.
_FIRST = frozenset(
    """no me nos soy somos i we it prefiero preferimos preferiria prefiriria quisiera debo tengo he declino declinare declinamos rechazo rechazare rehuso
    rehusare evito evitare evitaremos eludo eludire renuncio renunciare mis las nuestras carezco desconozco ignoro como as my question consulta pregunta""".split()
)
_EVASIVE = re.compile(
    r"\b(?:me (?:es|resulta)|seguro|respuesta no|consult\w*|pregunta|cuestion|comentarios|asunto|tema|puedo|podria|podre|possible|impossible|comment|can|question|query|request"
    r"|answer|(?:fragmento|texto|contexto|pasaje|documento|extracto|material) (?:\w+ )?no|(?:passage|text|context|excerpt|fragment|document|material) (?:given )?do)"
)
#: Function words by language, without accents; those of one language only tell it apart.
LANGUAGE_WORDS = {
    "es": "a al ante antes aqui asi aun aunque bajo cada como con contra cual cuales cuando cuanto cuantas cuantos de del desde despues donde durante e el ella ellas ellos en entre era eran es esa ese eso esta estan estas este esto estos fue fueron ha habia han hasta hay junto la las le les lo los mas me mediante menos mientras muy ni no nos o otra otro para pero por porque pues que quien se segun ser si siempre sin sobre solo son su sus tal tambien tan tiene todo todos tras tu u un una unas uno unos y ya",
    "en": "the of and to in is are was were be been by with from that which for on at as it its this these has had have not or when what how why who whom whose does do did should would could into after before between than their them they there if provided once over under while until about against among",
    "fr": "a afin apres au aux avant avec c car cas ce ces cet cette chez comme d dans de des donc du elle elles en ensuite entre est et faut il ils je jusqu l la le les leur lors mais meme moins n ne nous on ont ou par pas peut plus pour puis qu que quel quelle qui s sa sans se selon ses si son sont sous sur tout toutes un une vous",
    "pt": "a ao aos antes apos as ate com como da das de deve depois do dos e ela ele em entre era essa esse esta este foi foram ha houve isso ja lhe mais mas menos muito na nao nas nem no nos num numa o os ou para pela pelas pelo pelos pois por preciso quais qual quando que quem sao se segundo seja sem ser seu si sob sobre sua tem um uma umas uns",
    "it": "a ad ai al alla alle anche che chi ci come con cui da dal dalla dei del della delle di dopo e ed era fra gli ha hanno i il in la le lo ma meno nei nel nella nelle nello non nella o ogni per perche piu poi prima quale quando quanto questa questo se secondo si sono stata stato su sua sul sulla suo tra un una uno viene",
    "de": "aber alle als also am an auch auf aus bei beim bis damit dann das dass dem den der des die diesem dieser doch durch ein eine einem einen einer eines er es fur gibt hat ich im in ist kann man mehr mit nach nicht noch nur ob oder ohne pro sein sich sie sind so uber um und unter vom von vor war wenn werden wie wird zu zum zur zwischen",
}
_LANGUAGES = tuple(LANGUAGE_WORDS)
#: How much each word speaks for each language: the fewer languages share it, the more.
_SPEAKS = {
    w: (tuple(i for i, k in enumerate(_LANGUAGES) if w in LANGUAGE_WORDS[k].split()),)
    for w in {w for words in LANGUAGE_WORDS.values() for w in words.split()}
}
_SPEAKS = {w: (of, log(len(_LANGUAGES) / len(of)) + 0.3) for w, (of,) in _SPEAKS.items()}
_MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u20d0-\u20ff\ufe20-\ufe2f]+")
_TOKENS = re.compile("[a-z0-9]+")
_TAGS = re.compile(r"</?[A-Za-z][^<>]{0,80}>|&[a-z]+;")
_HIDDEN = re.compile("[­​-‏‪-‮⁠-⁤﻿]")
_NESTING = re.compile(r"```|<(/?)([A-Za-z][A-Za-z0-9]*)[^<>]*?(/?)>|[()\[\]{}«»“”]")
_MARKED = re.compile(r"[`<()\[\]{}«»“”]")
_PAIRS = {")": "(", "]": "[", "}": "{", "»": "«", "”": "“"}
_VOID = frozenset(("br", "hr", "img", "input", "meta", "link"))
_ENUMERATOR = re.compile(r"(?:^|[\s:;,.])(?:[a-zA-Z]|\d{1,2}|[ivx]{1,4})[).]$")
_PREFIX = re.compile(r"^(?:(?:respuesta|la pregunta es|pregunta|answer|the question is|question|r|a|p|q) )+")


def normalised(text: str) -> str:
    return (text if text.isascii() else _MARKS.sub("", unicodedata.normalize("NFKD", text))).lower()


def tokens(text: str | None) -> list[str]:
    return _TOKENS.findall(normalised(_HIDDEN.sub("", text))) if text else []


def is_empty(text: str | None, words: list[str]) -> bool:
    """Nothing that answers: blank, marks or markup only, or a placeholder."""
    if text is None:
        return True
    bare = _TAGS.sub(" ", _HIDDEN.sub("", text))
    own = words if len(bare) == len(text) else tokens(bare)
    if not own:
        return not any(c.isalnum() for c in bare)
    return len(own) <= 3 and " ".join(own) in PLACEHOLDERS


def is_refusal(text: str, words: list[str]) -> bool:
    """Declines by the grammar of refusals: words anywhere that decline outright, or sentences that decline by the way and
    are the first or at least half of the words of the answer, however long it is."""
    for i, w in enumerate(words):
        if w in _FIRST and _OUTRIGHT.match(" ".join(words[i : i + 16])):
            return True
    said = " ".join(words)
    if not _EVASIVE.search(said):
        return False
    if _EVASION.match(said):
        return True
    each = [tokens(sentence) for sentence in _SENTENCES.split(text)]
    evasive = sum(len(own) for own in each if _EVASION.match(" ".join(own)))
    return evasive > 0 and 2 * evasive >= len(words)


def tiled(words: list[str], of: list[str], least: int = 2) -> int:
    """Greedy string tiling: how many of ``words`` are covered by tiles, the longest first, that also stand in ``of``."""
    free_a, free_b, covered = [True] * len(words), [True] * len(of), 0
    places: dict[str, list[int]] = {}
    for j, w in enumerate(of):
        places.setdefault(w, []).append(j)
    while True:
        best, found = least - 1, []
        for i in range(len(words)):
            if not free_a[i]:
                continue
            for j in places.get(words[i], ()):
                k = 0
                while i + k < len(words) and j + k < len(of) and free_a[i + k] and free_b[j + k] and words[i + k] == of[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k == best and k >= least:
                    found.append((i, j))
        if best < least or not found:
            return covered
        for i, j in found:
            if all(free_a[i : i + best]) and all(free_b[j : j + best]):
                free_a[i : i + best] = [False] * best
                free_b[j : j + best] = [False] * best
                covered += best


def copies(question: list[str], answer: list[str]) -> bool:
    """Says no more than the question: nearly all of the answer is tiles of a question that it takes up at least half of."""
    body = _PREFIX.sub("", " ".join(answer)).split()
    if len(body) < 4 or len(body) < 0.5 * len(question):
        return False
    there, question = set(question), question * -(-len(body) // max(1, len(question)))  # said twice it says no more
    if sum(w in there for w in body) < 0.8 * len(body):
        return False
    return tiled(body, question) >= 0.85 * len(body) or (tiled(body, question, 1) >= 0.93 * len(body) and len(body) >= 8)


def language_scores(words: list[str]) -> tuple[list[float], int]:
    """How much the function words speak for each language, and how many there are."""
    scores, hits = [0.0] * len(_LANGUAGES), 0
    for w in words:
        if (x := _SPEAKS.get(w)) is not None:
            hits += 1
            for i in x[0]:
                scores[i] += x[1]
    return scores, hits


def other_language(asked: list[str], words: list[str], clear: float = 1.25) -> bool:
    """The answer is clearly of one language, and the question clearly more of another than of that one."""
    scores, hits = language_scores(words)
    if hits < 3 or hits < 0.12 * len(words):
        return False
    best = max(scores)
    i = scores.index(best)
    if any(x * clear > best for j, x in enumerate(scores) if j != i):
        return False
    scores, hits = language_scores(asked)
    return hits >= 3 and max(scores) >= clear * max(scores[i], 1e-9) and max(scores) > scores[i]


def unknown_language(asked: list[str], words: list[str], known: set[str]) -> bool:
    """The question is of a known language, and of the answer's words next to none are function words of any, or words of the
    question, the source and the other answers (``known``); short answers and lists of names are not judged."""
    if len(words) < 8 or len(set(words)) < 6:
        return False
    scores, hits = language_scores(asked)
    if hits < 3 or hits < 0.2 * len(asked):
        return False
    best = scores.index(max(scores))
    own = sum((x := _SPEAKS.get(w)) is not None and best in x[0] for w in words)
    return own <= 0.1 * len(words) and sum(w in known or w[0].isdigit() for w in words) <= 0.2 * len(words) and sum(len(w) <= 3 for w in words) >= 0.1 * len(words)


def foreign_script(question: str, answer: str) -> bool:
    """Most letters of the answer are of scripts that are not the question's."""
    def share(t: str) -> float:
        letters = [c for c in t if c.isalpha()]
        return sum(c > "ɏ" for c in letters) / len(letters) if letters else 0.0

    return not answer.isascii() and abs(share(answer) - share(question)) > 0.5


def open_marks(text: str) -> tuple[int, bool]:
    """A pushdown parse of fences, brackets, quotations and markup: how many are open at the end, and whether a fence is."""
    stack: list[str] = []
    for m in _NESTING.finditer(text):
        t = m.group()
        if t == "```":
            if "```" in stack:
                del stack[stack.index("```") :]
            else:
                stack.append(t)
        elif "```" in stack:
            continue
        elif t[0] == "<" and m.group(2):
            tag = "<" + m.group(2).lower()
            if m.group(1):
                if tag in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(tag) :]
            elif not m.group(3) and tag[1:] not in _VOID:
                stack.append(tag)
        elif t in _PAIRS.values():
            stack.append(t)
        elif t in _PAIRS and _PAIRS[t] in stack:  # a closing mark that closes nothing is an enumerator or noise
            del stack[len(stack) - 1 - stack[::-1].index(_PAIRS[t]) :]
    return len(stack), "```" in stack


def ending(text: str) -> str:
    """How a text ends by its marks: 'stop', 'broken' (a mark that more must follow, or something left open) or 'word'."""
    text = _HIDDEN.sub("", text).rstrip()
    left, fence = open_marks(text) if _MARKED.search(text) else (0, False)
    if fence or _ENUMERATOR.search(text[-6:]) and not re.search(r"\d\.$", text):
        return "broken"
    bare = text.rstrip("\"'»”)]}*_` \t")
    if text.endswith(("…", "...")) or bare.endswith(("…", "...")):
        return "broken"
    if bare[-1:] in (".", "!", "?"):
        return "stop"
    if left or text[-1:] in "-–—‐,:;(/[{«“¿¡+=&":
        return "broken"
    return "stop" if bare != text and bare[-1:] in "!?." else "word"
