"""Defective question-answer pairs (problem 6): clauses tagged by a conditional random field, aggregated to a defect.

An answer is cut into clauses. Each clause has features: refusal wording, share of its word pairs that the question has,
its language against the question's, and how finished its end looks (open brackets and quotations, list markers, and
the chance, learnt from the corpus, that a sentence ends after its last words). A linear-chain field over the labels
answer, refusal, echo, foreign and unfinished is trained on the whole table: its clean pairs as they are, and the same
pairs cut off, answered by the question itself, or asked in another language. Rows whose clauses have the same features
are one example with a weight, so that what the field is trained on is small.
"""

from __future__ import annotations

import gc
import re
import unicodedata
from collections import Counter, _count_elements
from functools import cached_property
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.functions.text import fold, words
from tallymill.llm.sentences import _LIST, _MACHINE, _QUOTED, _THAI, BOUND_ABBREVIATIONS, FINAL_ABBREVIATIONS, LONG, _closing, _opening, sentence_ends
from tallymill.session import discard, materialize

_PER = 10_000  # texts for which the counts of words and word runs that the model of endings needs are named
_WORD_LEAST = 8
_WINDOW = 12  # clauses of an example; longer answers are several
_STEPS = 8  # of the share of word pairs that a clause has in common with the question
_HELD = 100_000  # counts that a task holds before it passes them on
_ID_BITS = 21  # of a token's number, so that a run of three fits into 63
LABELS = ("answer", "refusal", "echo", "foreign", "unfinished")

# Function words that tell four languages apart.
FUNCTION_WORDS = {
    "fr": "le les du des une est et dans sur pour que qui ce cette par au aux pas ne il elle nous vous avec sans près lors dès depuis pourquoi comment oui je côté été après à où voir fiche environ".split(),
    "en": "the of and is with that on this by for at from it not are we you without when while how why yes since near about see which of to has i was until between because there".split(),
    "de": "der die das dass den dem ein eine ist und mit auf bei nicht wir sehen es heißt wie ja seit für von zur zum im am ohne ab über nein warum siehe rund kann ich gegenüber laut wer".split(),
    "es": "el los las del una con por que y es en no se al para como sin desde hacia según hasta frente sí entre esta nuestro qué vea unos ¿por durante junto lo cuándo pese".split(),
}
_OF_LANGUAGE = {w: k for k, ws in FUNCTION_WORDS.items() for w in ws if sum(w in o for o in FUNCTION_WORDS.values()) == 1}
_SCRIPTS = (
    ("ja", regex.compile(r"[\p{Hiragana}\p{Katakana}]")),
    ("zh", regex.compile(r"\p{Han}")),
    ("ru", regex.compile(r"\p{Cyrillic}")),
    ("ar", regex.compile(r"\p{Arabic}")),
    ("hi", regex.compile(r"\p{Devanagari}")),
    ("th", regex.compile(r"\p{Thai}")),
    ("ko", regex.compile(r"\p{Hangul}")),
    ("el", regex.compile(r"\p{Greek}")),
)
_OTHER_SCRIPT = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Cyrillic}\p{Arabic}\p{Devanagari}\p{Thai}\p{Hangul}\p{Greek}]")
_BEYOND_LATIN = re.compile("[\u0370-\U0010ffff]")
_LATIN = regex.compile(r"\p{Latin}")
# Names of languages as a question may ask for them.
ASKED = {
    "fr": "français|french|französisch|francés|francese|francais",
    "en": "anglais|english|englisch|inglés|ingles|inglese",
    "de": "allemand|german|deutsch|alemán|aleman|tedesco",
    "es": "espagnol|spanish|spanisch|español|espanol|spagnolo",
    "ja": "japonais|japanese|japanisch|japonés",
    "zh": "chinois|chinese|chinesisch|chino",
    "ru": "russe|russian|russisch|ruso",
    "ar": "arabe|arabic|arabisch|árabe",
    "hi": "hindi",
    "th": "thaï|thai|thailändisch|tailandés",
}
_ASKS = [(k, re.compile(rf"\b(?:en|in|auf|ins|al|into|vers l')\s*(?:l')?(?:{v})\b", re.I)) for k, v in ASKED.items()]
_MAY_ASK = tuple(fold(v) for v in "|".join(ASKED.values()).split("|"))
# Wording that declines to reply, after folded text of which every match of it holds some.
_REFUSALS = (
    ((" pas ",), r"ne (?:peux|pouvons|puis|saurais|saurions) pas (?:\w+ ){0,3}?(?:répondre|donner|traiter|aider|communiquer|fournir|aborder|discuter|parler|commenter|divulguer|satisfaire|accéder)"),
    (("pas autorisé", "pas habilité", "pas en mesure", "pas permis"), r"pas (?:autorisé|habilité|en mesure|permis)"),
    ((" décliner", " refuser", " m'abstenir", " ne pas"), r"(?:dois|devons|préfère|préférons) (?:décliner|refuser|m'abstenir|ne pas)"),
    (("prononcer", "impossible"), r"ne pas me prononcer|m'est impossible|nous est impossible"),
    (("refuse",), r"refuse de (?:répondre|traiter|donner)|me refuse|dois refuser"),
    (("sort de ce que",), r"sort de ce que (?:j'ai|je)"),
    (("hors de mon ",), r"hors de mon (?:champ|domaine|périmètre)"),
    (("droit d'aborder", "n'ai pas le droit", "pas mon rôle", "m'abstiens"), r"droit d'aborder|n'ai pas le droit|pas mon rôle|m'abstiens"),
    (("cannot", "can't", "can not", "won't", "unable to", "not able to"), r"cannot|can't|can not|won't|unable to|not able to"),
    (("not allowed", "not permitted", "not authori", "not comfortable", "rather not", "prefer not"), r"not allowed|not permitted|not authori[sz]ed|rather not|prefer not|not comfortable"),
    (("decline", "refuse to", "at liberty to", "no permission to"), r"must decline|have to decline|decline to|refuse to|at liberty to|no permission to"),
    ((" what i",), r"outside (?:of )?what i"),
    (("no puedo", "no podemos", "no estoy autorizad", "no me es", "no tengo", "no me est"), r"no (?:puedo|podemos|estoy autorizad\w|me es posible|tengo permitido|me está permitido)|no tengo (?:permiso|autorización)"),
    (("prefiero no", "debo ", "me es imposible", "fuera de lo que"), r"prefiero no|debo (?:rechazar|declinar)|me es imposible|fuera de lo que"),
    (("no me corresponde", "declino", "me niego", "me abstengo", "no voy a "), r"no me corresponde|declino|me niego|me abstengo|no voy a (?:responder|contestar|hablar)"),
    (("nicht",), r"(?:kann|darf|möchte|werde|können|dürfen|will) (?:ich|wir|mich)[^.;]{0,40}\bnicht\b|(?:ich|wir) (?:kann|darf|möchte|werde|können|dürfen|will)[^.;]{0,60}\bnicht\b"),
    (("nicht ",), r"nicht (?:befugt|berechtigt|beantworten|äußern|erlaubt)|nicht möglich"),
    (("ablehnen",), r"muss ich[^.;]{0,60}ablehnen|ablehnen muss"),
    (("ausserhalb dessen", "keine a"), r"außerhalb dessen|keine (?:auskunft|auskünfte|angaben|antwort) (?:\w+ ){0,2}?(?:geben|machen|erteilen)"),
)
REFUSAL = re.compile("|".join(p for _, p in _REFUSALS), re.I)
_REFUSED = tuple((tuple(map(fold, ws)), re.compile(p, re.I)) for ws, p in _REFUSALS)
# Parts of such words that are met less often than their longest.
_RAREST = {fold(e): c for e, c in ((" ne pas", " ne "), ("pas en mesure", "pas "), ("n'ai pas le droit", "n'ai "), ("hors de mon ", " mon "), ("pas mon rôle", " mon "), ("no me es", " me "), ("no me est", " me "), ("bien reçu", " reçu"))}
_DECLINING = frozenset(
    words(fold("pas impossible refuse refuser décliner sort droit abstenir cannot can won unable able allowed permitted authorised authorized decline rather prefer comfortable outside "
    "no puedo podemos prefiero debo rechazar declinar declino imposible fuera corresponde nicht ablehnen außerhalb"))
)
# Wording that only softens.
SOFTENER = re.compile(r"désolé|regrette|malheureusement|hélas,|merci (?:pour|de) votre|comprends l'|navré|sorry|unfortunately|afraid|thank you for|regret|lo siento|lamentablemente|gracias por|tut mir leid|leider|bedaure|danke|bien reçu|was received|ha llegado|eingegangen", re.I)
# Folded text of which every match of SOFTENER holds some.
_SOFT = tuple(map(fold, ("désolé", "regret", "malheureusement", "hélas,", "merci ", "comprends l'", "navré", "sorry", "unfortunately", "afraid", "thank you for", "lo siento", "lamentablemente", "gracias por", "tut mir leid", "leider", "bedaure", "danke", "bien reçu", "was received", "ha llegado", "eingegangen")))
_MARKS_END = re.compile(r"[.!?。！？।؟]+[\s\"'”’»)\]}」』…*_–-]*$|[\"”»)\]}」』>]\s*[.!?]*$")
_LOOSE = " \t\r\n\xa0\u200b\"”»“«'’`…*."
_LIST_END = re.compile(r"(?:^|\n\s*|[;,:]\s+)(?:\d{1,2}[.)]|[a-z]\)|[-•*–—])\s*$|[\s\w]\s\d{1,2}\)\s*$")
_OPEN_END = re.compile(r"[,;:(\[{=«„“/]\s*$")
_SIGNED = re.compile(r"(?:^|\n)\s*(?:cordialement|bien à vous|salutations|regards|sincerely|best|un saludo|saludos|atentamente|mit freundlichen|viele grüße|contact\s*:|nir\s*:|tél)", re.I)
_TOKEN = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*['’]?|\d+|[^\w\s]")
_CODE = re.compile(r"(?:[A-Za-z0-9]{2,5}-)+\d{2,4}\b|\b[A-Za-z]\d{1,4}\b|\w+_\w+\.\w+|\d+(?:[.,:/+]\d+)+")
_CODED = re.compile(r"[\d_]")  # every match of _CODE has one
_STOP = frozenset(".?!…")
_MARKS = frozenset(",.;:")
_CF = regex.compile(r"\p{Cf}+")
# What makes the layout or the quotations of an answer matter to its units, or ends a unit without a blank.
_LAID_OUT = re.compile("[\t\n\r\x0b\x0c\x85\u2028\u2029。！？｡．…।॥؟" + _QUOTED.pattern[1:-1] + _THAI.pattern[1:-1] + "]")
_LONGER = 1 + max(map(len, BOUND_ABBREVIATIONS | FINAL_ABBREVIATIONS))
_STOPPED = re.compile(r"[.!?]+[’']*(?=\s)")


class _Known(dict):
    """What `make` gives for a key, kept."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        out = self[key] = self.make(key)
        return out


def visible(text: str | None) -> str | None:
    """A text without invisible format characters, letters composed."""
    if not text or text.isascii():
        return text
    return unicodedata.normalize("NFC", text if text.isprintable() else _CF.sub("", text))


def _folded(text: str) -> str:
    """fold() of a visible text."""
    return text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).casefold()


def _cores(entry: str) -> list[str]:
    """Parts of a wording that lie between blanks, with the blanks that they have in it."""
    parts = entry.split(" ")
    return [f"{' ' * (i > 0)}{p}{' ' * (i < len(parts) - 1)}" for i, p in enumerate(parts) if p]


# Of every wording of refusal and softening the part with most letters: a text that holds the wording has it in a piece.
_CORES = tuple(sorted({_RAREST.get(e) or max(_cores(e), key=lambda c: len(c.strip())) for ws in (_SOFT, *(ws for ws, _ in _REFUSED)) for e in ws}))
_SCENTS: dict[str, set[str]] = {}
for _c in (*_CORES, *_MAY_ASK):
    _SCENTS.setdefault(_c[0], set()).add(re.escape(_c[1:5]))
_SCENT = re.compile("|".join(f"{re.escape(c)}(?:{'|'.join(sorted(rest))})" for c, rest in sorted(_SCENTS.items())))  # how one of them or a language's name begins
_HOLDING: set[str] = set()  # pieces met that have one of them
_NAMING: set[str] = set()  # pieces met that have a language's name


def _piece(piece: str) -> tuple[str, ...]:
    """words(fold()) of a piece of text without blanks, which is put into the sets it belongs to."""
    folded = piece.lower() if piece.isascii() else fold(piece)
    odd = "ı" in piece or "İ" in piece  # match i in a pattern and don't fold to it
    if odd or _SCENT.search(padded := f" {folded} "):
        if odd or any(map(padded.__contains__, _CORES)):
            _HOLDING.add(piece)
        if odd or any(map(padded.__contains__, _MAY_ASK)):
            _NAMING.add(piece)
    return (folded,) if folded.isalnum() else tuple(words(folded))


_KNOWN = _Known(_piece)


def _read(text: str) -> tuple[list[str], list[str]]:
    """words(fold()) and blank-separated pieces of a text; no word spans a blank, so pieces that are met again are known."""
    if len(_KNOWN) >= _HELD:
        for known in (_KNOWN, _HOLDING, _NAMING):
            known.clear()
    pieces = text.split()
    return list(chain.from_iterable(map(_KNOWN.__getitem__, pieces))), pieces


def _words_of(text: str) -> list[str]:
    return _read(text)[0]


def _may_decline(folded: str, of: list | None = None) -> list:
    """Patterns of refusal, of those named, whose own words a folded text holds."""
    return [(ws, p) for ws, p in (_REFUSED if of is None else of) if any(map(folded.__contains__, ws))]


def declines(text: str, folded: str, of: list | None = None) -> bool:
    """Whether a text with this folded form holds wording of refusal; `of`: the patterns that can match in it."""
    if "ı" in text or "İ" in text:  # letters that match i in a pattern and don't fold to it
        return bool(REFUSAL.search(text))
    return any(p.search(text) for _, p in _may_decline(folded, of))


def softens(text: str, folded: str, of: list | tuple = _SOFT) -> bool:
    """Whether a text with this folded form holds wording that only softens; `of`: the words of it that it can hold."""
    return (any(map(folded.__contains__, of)) or "ı" in text or "İ" in text) and bool(SOFTENER.search(text))


def language(text: str, folded: list[str] | None = None) -> str | None:
    """Language of a text by script and function words; None where it can't be told."""
    if not text.isascii() and _BEYOND_LATIN.search(text) and _OTHER_SCRIPT.search(text):
        other = len(_OTHER_SCRIPT.findall(text))
        if other * 3 > len(_LATIN.findall(text)) or other > 12:
            for name, pattern in _SCRIPTS:
                if pattern.search(text):
                    return name
    return _language_of(folded if folded is not None else words(fold(text)))


def _language_of(folded: list[str]) -> str | None:
    """Language by function words."""
    return _most(list(filter(None, map(_OF_LANGUAGE.get, folded))))


def _most(told: list[str]) -> str | None:
    """The language that most function words are of, if they are twice those of any other."""
    if not told:
        return None
    if told.count(told[0]) == len(told):
        return told[0]
    ranked = sorted(((told.count(k), k) for k in set(told)), reverse=True)
    if len(ranked) > 1 and ranked[0][0] < 2 * ranked[1][0]:
        return None
    return ranked[0][1]


def common_words(seen: dict[str, int], texts: int) -> frozenset[str]:
    """Words frequent enough to stand for themselves: a share of the texts, so that they don't grow with the table."""
    return frozenset(w for w, n in seen.items() if n >= _WORD_LEAST * max(1, texts / _PER) and not w.isdigit())


class EndModel:
    """Chance that a sentence ends after its last three tokens, by backed-off counts over all sentences."""

    def __init__(self, texts: list[str] | None = None, vocabulary: frozenset[str] | None = None):
        self._told: tuple[dict[str, list[str]], dict[str, list[str]]] = ({}, {})
        self.grams: dict[str, tuple[int, float]] = {}
        self.vocabulary = common_words(Counter(w for t in texts for w in words(fold(t))), len(texts)) if vocabulary is None else vocabulary
        if texts:
            met: dict[str, int] = {}
            ended: dict[str, int] = {}
            for t in texts:
                self.count(t, met, ended)
            self.take(((g, n, ended.get(g, 0)) for g, n in met.items()), len(texts))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_told": ({}, {})}

    @staticmethod
    def least(length: int, texts: int) -> float:
        """Times that a run of so many tokens must be met to count, a share of the texts."""
        return length * max(1, texts / _PER)

    def take(self, counts, texts: int) -> None:
        """Keeps the runs of (run, times met, times at an end) that are met often enough; as many ends as one word needs are chance."""
        self.grams = {g: (n, max(0, e - self.least(1, texts))) for g, n, e in counts if n >= self.least(g.count(" ") + 1, texts)}

    def count(self, text: str, met: dict[str, int], ended: dict[str, int]) -> None:
        """Adds a text's runs of up to three tokens to counts of how often they are met, and end a sentence."""
        body: list[str] = []
        runs: list[str] = []
        tokens = self.tokens(text.replace("...", "…"))  # three dots end no sentence: cut texts have them
        tokens.append("")
        for w in tokens:
            if w and w not in _STOP:
                body.append(w)
                continue
            two = [f"{a} {b}" for a, b in zip(body, body[1:])]
            three = [f"{a} {b}" for a, b in zip(two, body[2:])]
            runs += body
            runs += two
            runs += three
            if len(body) >= 3 and w and w != "…":
                for g in (body[-1], two[-1], three[-1]):
                    ended[g] = ended.get(g, 0) + 1
            body = []
        _count_elements(met, runs)

    def tokens(self, text: str) -> list[str]:
        mixed = not (text.isupper() or text.islower() or text.istitle())
        return [t for piece in text.split() for t in self._of_piece(piece, mixed)]  # no token spans a blank

    def _of_piece(self, piece: str, mixed: bool) -> list[str]:
        told = self._told[mixed]
        if (tokens := told.get(piece)) is None:
            if len(told) >= _HELD:
                told.clear()
            tokens = told[piece] = self._tokens(piece, mixed)
        return tokens

    def _tokens(self, piece: str, mixed: bool) -> list[str]:
        if _CODED.search(piece):
            piece = _CODE.sub(" ¤ ", piece)
        return [self._token(w, mixed) for w in _TOKEN.findall(piece)]

    def _last(self, text: str) -> list[str]:
        """The last three tokens of a text before its closing stops, or more of them."""
        mixed = not (text.isupper() or text.islower() or text.istitle())
        body: list[str] = []
        for piece in reversed(text.split()):
            tokens = self._of_piece(piece, mixed)
            if not body:
                tokens = list(tokens)
                while tokens and tokens[-1] in _STOP:
                    tokens.pop()
            body = [*tokens, *body]
            if len(body) >= 3:
                break
        return body

    def _token(self, w: str, mixed: bool) -> str:
        low = w.casefold().replace("’", "'")
        if w[0].isdigit():
            return f"#{min(len(w), 5)}"
        if low in self.vocabulary or not w[0].isalpha():
            return low
        if "'" in low and low.split("'")[0] + "'" in ("d'", "l'", "qu'", "n'", "s'", "jusqu'", "m'", "j'") and low.split("'", 1)[1] in self.vocabulary:
            return low
        if mixed and w[0].islower():
            return "~" + low[-3:]
        return ("^-" if "-" in w else "^") + low[-3:]

    def chance(self, text: str) -> float:
        body = self._last(text[-120:])
        p = 0.02
        for n, weight in ((1, 1.0), (2, 3.0), (3, 6.0)):
            if len(body) < n:
                break
            seen, ended = self.grams.get(" ".join(body[-n:]), (0, 0))
            p = (ended + weight * (p if seen or n > 1 else 0.001)) / (seen + weight)
        return p


N_FEATURES = 17


def _unit_ends(text: str) -> list[int]:
    """sentence_ends(); in one plain line without quotations all spans weigh the same, so every end that isn't a loss is taken."""
    if len(text) >= LONG or not text[:1].isalpha() or _LAID_OUT.search(text) or _LIST.match(text) or _MACHINE.match(text):
        return sentence_ends(text)
    stop = len(text.rstrip())
    out = []
    for m in _STOPPED.finditer(text, 0, stop):
        at, end = m.span()
        if m[0] == "." and at >= _LONGER and text[at - _LONGER : at].isalpha() and text[end + 1 : end + 2].isupper():
            out.append(end)  # a word that no abbreviation is as long as, and a capital
            continue
        close = _closing(text, 0, m.start(), m.end(), stop)
        if close > -20.0 and close + _opening(text, m.end(), stop) >= 0.0:
            out.append(m.end())
    out.append(stop)
    return out


def clauses(answer: str) -> list[str]:
    """Sentence units of an answer, parted further at semicolons."""
    out, a = [], 0
    for e in _unit_ends(answer):
        unit = answer[a:e].strip()
        a = e
        if "; " in unit and ":" not in unit and "=" not in unit:
            out.extend(p for p in unit.split("; ") if p.strip())
        elif unit:
            out.append(unit)
    return out


class Asked:
    """What a question, as a visible text, gives to compare its answer's clauses with."""

    def __init__(self, question: str | None):
        self.text = question or ""
        self.words, pieces = _read(self.text)
        named = not _NAMING.isdisjoint(pieces)
        self.known = frozenset(self.words)
        self._pairs: set[tuple[str, str]] | None = None
        self.language = language(self.text, self.words)
        self.wanted = {k for k, p in _ASKS if p.search(self.text)} if named else set()

    @property
    def pairs(self) -> set[tuple[str, str]]:
        if self._pairs is None:
            self._pairs = set(zip(self.words, self.words[1:]))
        return self._pairs

    def repeats(self, ws: list[str], share: float) -> bool:
        """At least this share of the word pairs of ws stand in the question too."""
        if sum(map(self.known.__contains__, ws)) < share * len(ws):
            return False
        return sum(map(self.pairs.__contains__, zip(ws, ws[1:]))) >= share * len(ws)


class Answer:
    """What an answer, as a visible text, says as a whole; no word goes over the border of two clauses."""

    def __init__(self, text: str, parts: list[str], ends: EndModel, told: dict):
        self.text = text
        self.beyond = not text.isascii() and bool(_BEYOND_LATIN.search(text) and _OTHER_SCRIPT.search(text))
        self.words: list[str] = []
        self.holds = False  # else no wording of refusal or softening stands in it
        of: list[str] = []
        for part in parts:
            if (said := told.get(part)) is None:
                said = told[part] = self._clause(part)
            self.words += said[3]
            self.holds |= said[4]
            of += said[5]
        self.language = (language(text, self.words) if self.beyond else None) or _most(of)
        self.stop = _stop(text, ends)

    @cached_property
    def folded(self) -> str:
        return _folded(self.text)

    @cached_property
    def may_say(self) -> tuple[list, list[str]]:
        """Patterns of refusal and softening words that can stand in it; what the whole doesn't hold no clause does."""
        return _may_decline(self.folded), [w for w in _SOFT if w in self.folded]

    def _clause(self, part: str) -> tuple:
        """What a clause says by itself: refusal, softening, language, words, whether it may hold such wording, languages of its function words."""
        ws, pieces = _read(part)
        refusing = soft = False
        if holds := not _HOLDING.isdisjoint(pieces):
            f = _folded(part)
            of = self.may_say if f in self.folded else (None, _SOFT)
            refusing, soft = declines(part, f, of[0]), softens(part, f, of[1])
        told = list(filter(None, map(_OF_LANGUAGE.get, ws)))
        return refusing, soft, language(part, ws) if self.beyond else _most(told), ws, holds, told


_UNSAID = bytes(8)
_ROWS: dict[tuple, bytes] = {}  # features of a clause but its end's, by what they say


def features(asked: Asked, answer: str, parts: list[str], ends: EndModel, told: dict | None = None) -> list[bytes]:
    """Features of each clause in steps; `told` keeps what clauses and answers say by themselves. Texts are visible ones."""
    told = {} if told is None else told
    whole = _whole(answer, parts, ends, told)
    known, rows = asked.pairs, []
    for part in parts:
        refusing, soft, lang, ws, *_ = told[part]
        n, share = len(ws), 0.0
        if known and n > 1:
            share = sum(map(known.__contains__, compress(zip(ws, ws[1:]), map(asked.known.__contains__, ws)))) / (n - 1)
        lang = lang or whole.language
        other = bool(lang and asked.language and lang != asked.language and lang not in asked.wanted)
        signs = (refusing, soft, share >= 0.55, share >= 0.8, other, other and whole.language == lang, n <= 8)
        if (row := _ROWS.get((signs, steps := int(share * _STEPS)))) is None:
            row = _ROWS[signs, steps] = bytes([int(v * _STEPS) for v in (1, *signs[:2])] + [steps] + [_STEPS * v for v in signs[2:]])
        rows.append(row + _UNSAID)
    rows[-1] = row + bytes([int(v * _STEPS) for v in _ending(whole.stop, parts[-1])])
    return rows


def _whole(answer: str, parts: list[str], ends: EndModel, told: dict) -> Answer:
    if (whole := told.get((answer,))) is None:
        whole = told[(answer,)] = Answer(answer, parts, ends, told)
    return whole


def _stop(answer: str, ends: EndModel) -> tuple:
    """How an answer ends, whatever its last clause: text, full end, chance of an end, open bracket, list marker, open mark."""
    text = answer.strip()
    body = text.rstrip(_LOOSE)
    lost, tail = text[len(body) :], text[-40:]
    stopped = lost.replace("...", "…").split("…")[0]
    full = tail[-1:] in ")]}>" or bool(_MARKS_END.search(tail)) and not ("…" in lost or "..." in lost) or "." in stopped or body.endswith(("?", "!", "。", "।", "؟"))
    if not full and _SIGNED.search(text[-160:]):
        full = True
    if text[:1] in "{[":
        return text, None, 0.0, False, False, False
    opened = text.count("(") > text.count(")") or text.count("[") > text.count("]") or text.count("«") > text.count("»") or text.count("„") > text.count("“")
    if text.count('"') % 2 and not text.startswith('"') and not text.endswith('"'):
        opened = True
    listed = len(text) > 12 and bool(_LIST_END.search(tail[-8:]))
    dangling = not full and bool(_OPEN_END.search(body[-6:]))
    return text, full, 1.0 if full else ends.chance(body), opened, listed, dangling


def _ending(stop: tuple, part: str) -> list[float]:
    text, full, p, opened, listed, dangling = stop
    if full is None:  # begins as a record
        return [1.0, 0.0, 0.0, 0.0, 0.0, float(text[-1:] not in "}]" and not text.rstrip("\"'»”").endswith(("}", "]"))), 0.0, 0.0]
    fielded = (":" in text or "=" in text) and (part.count(":") + part.count("=") >= 3 or len(re.findall(r"\w\s?[:=] ", text)) >= 4)
    if fielded and not listed and not dangling and not opened:
        p = max(p, 0.3)
    return [1.0, float(full), float(p < 0.004), float(0.004 <= p < 0.02), float(0.02 <= p < 0.06), float(opened), float(listed or dangling), float(fielded)]


class Pair:
    """A pair of visible texts and what is found out about it, each once."""

    def __init__(self, q: str | None, a: str | None, ends: EndModel):
        self.q, self.a, self.ends, self.told = visible(q), visible(a), ends, {}

    @cached_property
    def asked(self) -> Asked:
        return Asked(self.q)

    @cached_property
    def parts(self) -> list[str]:
        return clauses(self.a)

    @cached_property
    def whole(self) -> Answer:
        return _whole(self.a, self.parts, self.ends, self.told)

    @cached_property
    def features(self) -> list[bytes]:
        return features(self.asked, self.a, self.parts, self.ends, self.told)


class Field:
    """Linear-chain conditional random field: label weights on features and on neighbouring labels."""

    def __init__(self, w: np.ndarray, t: np.ndarray):
        self.w, self.t = w, t

    @staticmethod
    def train(data: list[tuple[np.ndarray, list[int], float]], rounds: int = 90, rate: float = 0.4, decay: float = 1e-3) -> Field:
        """Field trained on (features, labels, weight) of examples."""
        k, n = len(LABELS), sum(weight for *_, weight in data)
        size = max(len(y) for _, y, _ in data)
        x = np.zeros((len(data), size, N_FEATURES))
        y = np.zeros((len(data), size), dtype=np.int64)
        mask = np.zeros((len(data), size), dtype=bool)
        times = np.array([weight for *_, weight in data])[:, None, None]
        for i, (f, labels, _) in enumerate(data):
            x[i, : len(labels)], y[i, : len(labels)], mask[i, : len(labels)] = f, labels, True
        live = [np.flatnonzero(m) for m in mask.T]  # examples that are so long
        gold = np.eye(k)[y] * mask[..., None] * times
        both = mask[:, :-1] & mask[:, 1:]
        gold_t = np.einsum("nti,ntj->ij", gold[:, :-1] * both[..., None], gold[:, 1:] / times)
        w, t = np.zeros((N_FEATURES, k)), np.zeros((k, k))
        gw, gt = np.full_like(w, 1e-6), np.full_like(t, 1e-6)

        def lse(a: np.ndarray, axis: int) -> np.ndarray:
            m = a.max(axis=axis, keepdims=True)
            return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)

        for _ in range(rounds):
            e = x @ w
            alpha, beta = np.zeros_like(e), np.zeros_like(e)
            alpha[:, 0] = e[:, 0]
            for i in range(1, size):
                alpha[:, i] = alpha[:, i - 1]
                alpha[live[i], i] = e[live[i], i] + lse(alpha[live[i], i - 1, :, None] + t, 1)
            z = lse(alpha[:, -1], 1)
            for i in range(size - 2, -1, -1):
                after = live[i + 1]
                beta[after, i] = lse(t[None] + (e[after, i + 1] + beta[after, i + 1])[:, None, :], 2)
            p = np.exp(np.clip(alpha + beta - z[:, None, None], -50, 0)) * mask[..., None] * times
            pair = alpha[:, :-1, :, None] + t + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]
            pt = (np.exp(np.clip(pair, -50, 0)) * (both[..., None] * times)[..., None]).sum(axis=(0, 1))
            dw = np.einsum("ntf,ntk->fk", x, gold - p) / n - decay * w
            dt = (gold_t - pt) / n - decay * t
            gw += dw * dw
            gt += dt * dt
            w += rate * dw / np.sqrt(gw)
            t += rate * dt / np.sqrt(gt)
        return Field(w, t)

    def tag(self, x: np.ndarray) -> list[int]:
        e = x @ self.w
        if len(e) == 1:
            return [int(e[0].argmax())]
        best, back = e[0], []
        for i in range(1, len(e)):
            score = best[:, None] + self.t
            back.append(score.argmax(axis=0))
            best = score.max(axis=0) + e[i]
        out = [int(best.argmax())]
        for b in reversed(back):
            out.append(int(b[out[-1]]))
        return out[::-1]


def holds_any(answer: str | None) -> bool:
    """Whether an answer has a letter or digit."""
    return bool(answer) and any(map(str.isalnum, answer))


def shows_sign(pair: Pair) -> bool:
    """Whether an answer that isn't empty shows a sign of any label but answer."""
    whole, asked = pair.whole, pair.asked
    return bool(
        (asked.language and whole.language and whole.language != asked.language)
        or not _DECLINING.isdisjoint(whole.words)
        or whole.holds and declines(whole.text, whole.folded)
        or asked.repeats(whole.words, 0.3)
        or any(_ending(whole.stop, whole.text[-80:])[2:7])
    )


class PairJudge:
    """Defect of a pair, from the tagged clauses of its answer."""

    def __init__(self, field: Field, ends: EndModel):
        self.field, self.ends = field, ends

    def defect(self, q: str | None, a: str | None, every: bool = False) -> str | None:
        """Defect or None; `every` sends answers through the field that show no sign of any label but answer, too."""
        if not holds_any(a):
            return "empty"
        pair = Pair(q, a, self.ends)
        if not (every or shows_sign(pair)) or not pair.parts:
            return None  # no clause can carry another label far enough to decide the pair
        return self.decide(_matrix(b"".join(pair.features)), [max(1, len(p)) for p in pair.parts])

    def decide(self, x: np.ndarray, sizes: list[int]) -> str | None:
        """Defect or None, from the features and sizes of an answer's clauses."""
        tags = self.field.tag(x)
        total = sum(sizes)
        share = [sum(s for s, t in zip(sizes, tags) if t == k) / total for k in range(len(LABELS))]
        if tags[-1] == 4 and len(tags) > 1 and tags[-2] in (2, 3):
            share[tags[-2]] += sizes[-1] / total
        if share[1] > 0:
            content = sum(s for s, t, soft in zip(sizes, tags, x[:, 2]) if t == 0 and not soft)
            if content <= 0.6 * (content + share[1] * total):
                return "refusal"
        if share[2] >= 0.6:
            return "copied"
        if share[3] >= 0.6:
            return "other_language"
        return "truncated" if tags[-1] == 4 else None


def _matrix(key: bytes) -> np.ndarray:
    """Features of clauses from their steps."""
    return np.frombuffer(key, dtype=np.uint8).reshape(-1, N_FEATURES) / _STEPS


def _example(kind: bytes, x: list[bytes] | np.ndarray, labels: list[int]) -> list[bytes]:
    """An example's kind, labels and features (steps, or as numbers) as bytes, in windows of bounded length from the end."""
    if isinstance(x, np.ndarray):
        x = [row.tobytes() for row in (x * _STEPS).astype(np.uint8)]
    out, stop = [], len(labels)
    while stop > 0:
        a = max(0, stop - _WINDOW)
        out.append(kind + bytes([stop - a, *labels[a:stop]]) + b"".join(x[a:stop]))
        stop = a
    return out


def examples(q: str | None, a: str | None, ends: EndModel, pair: Pair | None = None) -> list[bytes]:
    """What the field learns from a pair: a clean one as it is and once broken on purpose, or a refusal; else nothing."""
    pair = pair or Pair(q, a, ends)
    q, a = pair.q, pair.a
    if not q or not holds_any(a):
        return []
    asked, parts, told = pair.asked, pair.parts, pair.told
    if not parts:
        return []
    x = pair.features
    if any(r[1] for r in x):
        return _example(b"r", x, [1 if r[1] else (1 if r[2] else 0) for r in x])
    end = x[-1]
    if any(r[3] >= _STEPS // 2 or r[6] for r in x) or not (end[10] and not end[14] or not any(end[11:16])):
        return []
    out = _example(b"c", x, [0] * len(x))
    draw = xxhash.xxh64_intdigest(f"{q}\x1f{a}".encode("utf-8", "surrogatepass"))  # what is broken and where hangs on the texts alone
    kind, draw = draw % 5, draw // 5
    half, odd, draw = draw % 2, draw // 2 % 2, draw // 4
    if kind == 0:
        lost = 4 + draw % (max(5, min(60, len(a) // 2)) - 4)
        broken = a[: len(a) - lost].rstrip()
        if not (broken and broken[-1].isalpha() and ends.chance(broken) < 0.05):
            return out
        labels = [0, 4]
    elif kind == 1:
        first = parts[0][:25]
        if half:
            broken = a.rstrip(" .!?") + (" (" if odd else " « ") + first
        else:
            broken = a + (" 1) " + first + " ; 2)" if odd else "\n- " + first + "\n-")
        labels = [0, 4]
    elif kind == 4:
        broken = (parts[-1] if half else a).rstrip(" .!")
        if ends.chance(broken) <= 0.02:
            return out
        labels = [0, 0]
    elif kind == 2:
        broken, labels = q, [2, 2]
    else:
        broken, labels = a, [3, 3]
        asked = Asked(None)
        asked.language = "another"  # the answer as a question of another language would meet it
    p = parts if broken is a else clauses(broken)
    if not p:
        return out
    f = features(asked, broken, p, ends, told)
    if kind == 3 and not all(r[6] for r in f):
        return out
    return out + _example(b"b", f, [labels[0]] * (len(p) - 1) + [labels[1]])


def fit_field(counts: dict[bytes, int]) -> Field:
    """Field from counted examples; refusals weigh together at least a third of the clean pairs."""
    total = {k: sum(n for e, n in counts.items() if e[:1] == k) for k in (b"c", b"r")}
    more = max(1.0, max(400, total[b"c"] / 3) / max(1, total[b"r"]))
    data = []
    for e, n in sorted(counts.items()):
        size = e[1]
        data.append((_matrix(e[2 + size :]), list(e[2 : 2 + size]), n * (more if e[:1] == b"r" else 1.0)))
    for kind, label, on in ((b"r", 1, [0, 1, 8, 9, 10]), (b"c", 0, [0, 9, 10])):
        if not total[kind]:  # a table without such pairs still needs the label's meaning
            f = np.zeros((1, N_FEATURES))
            f[0, on] = 1.0
            data.append((f, [label], 20.0))
    return Field.train(data)


def train_judge(pairs: list[tuple[str | None, str | None]]) -> PairJudge:
    """Judge from unlabelled pairs: clean ones as they are and the same ones broken on purpose."""
    ends = EndModel([visible(t) for t in sorted({t for p in pairs for t in p if t})])
    return PairJudge(fit_field(Counter(e for q, a in pairs for e in examples(q, a, ends))), ends)


def _summed(batches, add, size: int):
    """(key, c0, ...) counts that add(counts, batch) gathers, passed on whenever a task holds many."""
    counts: dict = {}

    def rows():
        keys = list(counts)
        kind = pa.binary() if keys and isinstance(keys[0], bytes) else pa.string()
        columns = [pa.array([counts[k][i] for k in keys], pa.int64()) for i in range(size)]
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), *columns], names=["key", *(f"c{i}" for i in range(size))])

    for b in batches:
        for k in range(0, b.num_rows, 500):
            add(counts, b.slice(k, 500))
            if len(counts) >= _HELD:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def _strings(column: pa.Array) -> list[str | None]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _counted_words(batches):
    """(key, c0) counts of words but numbers; pieces between blanks are counted first, and those met equally seldom taken apart at once."""
    counts: dict[str, int] = {}
    known = _Known(lambda piece: words(fold(piece)))

    def rows():
        keys = [w for w in counts if not w.isdigit()]
        out = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([counts[w] for w in keys], pa.int64())], names=["key", "c0"])
        counts.clear()
        return out

    for b in batches:
        for part in _slices(b.column(0), 50 * _HELD):
            met = pc.value_counts(pc.utf8_split_whitespace(part).flatten())
            pieces, times = met.field(0), met.field(1).to_numpy()
            for n in range(1, 6):
                ws = words(fold(" ".join(_strings(pieces.filter(pa.array(times == n))))))
                if n == 1:
                    _count_elements(counts, ws)
                else:
                    for w, k in Counter(ws).items():
                        counts[w] = counts.get(w, 0) + n * k
            often = times > 5
            for piece, n in zip(_strings(pieces.filter(pa.array(often))), times[often].tolist()):
                for w in known[piece]:
                    counts[w] = counts.get(w, 0) + n
            if len(known) >= _HELD:
                known.clear()
            if len(counts) >= _HELD:
                yield rows()
    yield rows()


def _slices(texts: pa.Array, most: int):
    """Parts of a column of texts that have at most so many bytes, or one text."""
    stops = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(stops, (stops[a - 1] if a else 0) + most, side="right")))
        yield texts.slice(a, b - a)
        a = b


def _run_rows(keys, met, ended) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(met, pa.int64()), pa.array(ended, pa.int64())], names=["key", "c0", "c1"])


class _Runs:
    """Counts of runs of up to three tokens, as EndModel.count() gives them, over numbers of tokens."""

    def __init__(self, ends: EndModel):
        self.ends = ends
        self.clear()

    def clear(self) -> None:
        self.names = ["", "…", ".", "?", "!"]  # the end of a text, and stops
        self.ids = {w: i for i, w in enumerate(self.names)}
        self.told = [_Known(lambda piece, mixed=mixed: self._numbers(piece, mixed)) for mixed in (False, True)]
        self.sums = [np.zeros((3, 0), dtype=np.int64) for _ in range(3)]  # of each length: runs, times met, times at an end

    def _numbers(self, piece: str, mixed: bool) -> tuple[int, ...]:
        out = []
        stem, mark = (piece[:-1], piece[-1]) if piece[-1:] in _MARKS else (piece, "")
        if stem.isascii() and stem.replace("-", "").isalpha() and "--" not in stem and stem[0] != "-" != stem[-1]:  # one word
            tokens = [self.ends._token(stem, mixed), mark] if mark else [self.ends._token(stem, mixed)]
        else:
            tokens = self.ends._tokens(visible(piece).replace("...", "…"), mixed)  # three dots end no sentence: cut texts have them
        for w in tokens:
            if (i := self.ids.get(w)) is None:
                i = self.ids[w] = len(self.names)
                self.names.append(w)
            out.append(i)
        return tuple(out)

    def _tokens(self, texts: pa.Array) -> np.ndarray:
        """Numbers of the tokens of texts, each text with its end behind it; two ends stand before them."""
        mixed = np.array([not (t.isupper() or t.islower() or t.istitle()) for t in map(visible, _strings(texts))], dtype=np.int64)
        split = pc.utf8_split_whitespace(texts)
        n = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        pieces = split.flatten().dictionary_encode()
        alike = pc.replace_substring_regex(pieces.dictionary, "[0-9]", "0").dictionary_encode()  # which digits a number has makes no other token
        met = alike.indices.to_numpy().astype(np.int64)[pieces.indices.to_numpy()] * 2 + np.repeat(mixed, n)
        met = np.insert(met, np.cumsum(n), -1)
        pieces = _strings(alike.dictionary)
        kinds = np.flatnonzero(np.bincount(met[met >= 0], minlength=2 * len(pieces)))
        numbers = [self.told[k & 1][pieces[k >> 1]] for k in kinds.tolist()]
        flat = np.array([0, *chain.from_iterable(numbers)], dtype=np.int64)
        size, start = np.zeros((2, 2 * len(pieces) + 1), dtype=np.int64)
        size[kinds] = list(map(len, numbers))
        start[kinds] = 1 + np.cumsum(size[kinds]) - size[kinds]
        size[-1] = 1  # the end of a text
        size = size[met]
        at = np.arange(size.sum()) + np.repeat(start[met] - (np.cumsum(size) - size), size)
        for told in self.told:
            if len(told) >= _HELD:
                told.clear()
        return np.concatenate([[0, 0], flat[at]])

    def add(self, texts: pa.Array) -> None:
        t = self._tokens(texts)
        inside = t >= 5
        ending = np.zeros(len(t), dtype=bool)
        ending[2:-1] = inside[:-3] & inside[1:-2] & inside[2:-1] & (t[3:] >= 2) & ~inside[3:]  # the last of three before a stop
        run, whole = t, inside
        for k in range(3):
            if k:
                run = run[:-1] << _ID_BITS | t[k:]
                whole = whole[:-1] & inside[k:]
            keys, met = np.unique(run[whole], return_counts=True)
            closing, times = np.unique(run[ending[k:]], return_counts=True)
            ended = np.zeros_like(met)
            ended[np.searchsorted(keys, closing)] = times
            self.sums[k] = self._merged(self.sums[k], np.stack([keys, met, ended]))

    @staticmethod
    def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        both = np.concatenate([a, b], axis=1)
        both = both[:, np.argsort(both[0], kind="stable")]
        first = np.flatnonzero(np.diff(both[0], prepend=-1))
        return np.stack([both[0][first], *(np.add.reduceat(x, first) for x in both[1:])]) if len(first) else both

    def full(self) -> bool:
        return max(len(self.names), sum(s.shape[1] for s in self.sums)) >= 4 * _HELD

    def rows(self) -> pa.RecordBatch:
        names, low = self.names, (1 << _ID_BITS) - 1
        keys = []
        for k, s in enumerate(self.sums):
            parts = [[names[i] for i in (s[0] >> _ID_BITS * (k - j) & low).tolist()] for j in range(k + 1)]
            keys += map(" ".join, zip(*parts))
        met, ended = np.concatenate(self.sums, axis=1)[1:]
        self.clear()
        return _run_rows(keys, met, ended)


def _counted_runs(ends: EndModel):
    """(key, c0, c1): how often each run of tokens is met, and ends a sentence."""

    def run(batches):
        runs = _Runs(ends)
        for b in batches:
            for texts in _slices(b.column(0), 15 * _HELD):
                if texts.nbytes > 16 * _HELD and len(texts) == 1:  # may have more tokens than there are numbers left
                    met: dict[str, int] = {}
                    ended: dict[str, int] = {}
                    ends.count(visible(texts[0].as_py()), met, ended)
                    yield _run_rows(list(met), list(met.values()), [ended.get(g, 0) for g in met])
                    continue
                runs.add(texts)
                if runs.full():
                    yield runs.rows()
        yield runs.rows()

    return run


def _examples_in(ends: EndModel):
    def add(counts: dict[bytes, list[int]], b: pa.RecordBatch) -> None:
        for q, a in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for e in examples(q, a, ends):
                counts.setdefault(e, [0])[0] += 1

    return add


def _sums(df: DataFrame, counted, size: int, key: str = "string") -> DataFrame:
    columns = [f"c{i}" for i in range(size)]
    made = df.mapInArrow(counted, f"key {key}, " + ", ".join(f"{c} bigint" for c in columns))
    return made.groupBy("key").agg(*(F.sum(c).alias(c) for c in columns))


def _ends_on(pairs: DataFrame) -> EndModel:
    """Model of endings: words and runs of tokens counted over all different texts; those met in a share of them reach the driver."""
    texts = materialize(pairs.select(F.explode(F.array("q", "a")).alias("t")).where("t != ''").distinct(), "pair-texts")
    n = texts.count()
    seen = _sums(texts, _counted_words, 1).where(F.col("c0") >= _WORD_LEAST * max(1, n / _PER)).collect()
    ends = EndModel(vocabulary=common_words({r.key: r.c0 for r in seen}, n))
    runs = _sums(texts, _counted_runs(ends), 2)
    length = F.size(F.split("key", " "))
    ends.take(((r.key, r.c0, r.c1) for r in runs.where(F.col("c0") >= length * max(1, n / _PER)).collect()), n)
    discard(texts)
    return ends


def _texts(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("q").cast("string").alias("q"), F.col("a").cast("string").alias("a"))


def judge_on(rows: DataFrame) -> PairJudge:
    """Judge fitted on all rows: examples are taken of every row and reach the driver once each, with their number."""
    pairs = _texts(rows)
    ends = _ends_on(pairs)
    found = _sums(pairs, lambda batches: _summed(batches, _examples_in(ends), 1), 1, "binary").collect()
    return PairJudge(fit_field({bytes(r.key): r.c0 for r in found}), ends)


_LOOKED = "line_no bigint, key binary, n bigint, sizes array<int>"


def _look(ends: EndModel):
    """Examples with their numbers n, and of the rows that may be defective, without n, the clauses' features and sizes."""

    def run(batches):
        counts: dict[bytes, int] = {}

        def batch(lines, keys, n, sizes):
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((lines, keys, n, sizes), kinds)], names=["line_no", "key", "n", "sizes"])

        def counted():
            out = batch([None] * len(counts), list(counts), list(counts.values()), [None] * len(counts))
            counts.clear()
            return out

        def look(b):
            lines, keys, sizes = [], [], []
            for line, q, a in zip(b.column(0).to_pylist(), _strings(b.column(1)), _strings(b.column(2))):
                if not holds_any(a):
                    key, size = b"", []
                else:
                    pair = Pair(q, a, ends)
                    for e in examples(q, a, ends, pair):
                        counts[e] = counts.get(e, 0) + 1
                    if not shows_sign(pair) or not pair.parts:
                        continue
                    key, size = b"".join(pair.features), [max(1, len(p)) for p in pair.parts]
                lines.append(line)
                keys.append(key)
                sizes.append(size)
            return batch(lines, keys, [None] * len(lines), sizes)

        for b in batches:
            pausing = gc.isenabled()
            gc.disable()  # nothing that is made of a row refers to itself
            try:
                out = look(b)
            finally:
                if pausing:
                    gc.enable()
            yield out
            if len(counts) >= _HELD:
                yield counted()
        yield counted()

    return run


def _judged(rows: DataFrame) -> DataFrame:
    """(line_no, defect) by a judge fitted on all rows; each row is looked at once for both."""
    ends = _ends_on(_texts(rows))
    looked = materialize(rows.select(F.col("line_no").cast("bigint").alias("line_no"), F.col("q").cast("string"), F.col("a").cast("string")).mapInArrow(_look(ends), _LOOKED), "pair-clauses")
    found = looked.where("n IS NOT NULL").groupBy("key").agg(F.sum("n").alias("n")).collect()
    judge = PairJudge(fit_field({bytes(r.key): r.n for r in found}), ends)

    def run(batches):
        for b in batches:
            lines, defects = [], []
            for line, key, sizes in zip(*(c.to_pylist() for c in b.columns)):
                d = judge.decide(_matrix(key), sizes) if sizes else "empty"
                if d:
                    lines.append(line)
                    defects.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.int64()), pa.array(defects, pa.string())], names=["line_no", "defect"])

    return looked.where("n IS NULL").select("line_no", "key", "sizes").mapInArrow(run, "line_no bigint, defect string")


def find_defects(rows: DataFrame, judge: PairJudge | None = None) -> DataFrame:
    """(line_no, defect) of every defective row: empty, refusal, copied, other_language or truncated, in that order.

    A null or blank question can't be copied and has no language; a null answer is empty. Texts are read whole, repeated
    rows each count, and other columns aren't read.
    """
    if judge is None:
        return _judged(rows)

    def run(batches):
        for b in batches:
            lines, defects = [], []
            for line, q, a in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                d = judge.defect(q, a)
                if d:
                    lines.append(line)
                    defects.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.int64()), pa.array(defects, pa.string())], names=["line_no", "defect"])

    return rows.select(F.col("line_no").cast("bigint").alias("line_no"), "q", "a").mapInArrow(run, "line_no bigint, defect string")
