"""Personal information in free text (problem 5): labelers vote, expectation-maximisation weighs them, a classifier decides.

Shapes propose spans: formats of numbers, addresses and addresses of mail; for names the words after a title, after
wording that introduces a person, or around a given name. For each kind several weak labelers (format, gazetteer, word
before, word after, contrary context) vote on every proposed span; the lists of names only vote. The labelers'
reliabilities come from expectation-maximisation over a bounded sample of rows; the resulting probabilities train a
logistic span classifier on the votes and the words around, once with and once without the votes of the lists, so that a
name on no list is judged by its context. The classifier then decides over every row.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "phone", "id_number", "address", "name")
FIT_ROWS = 6_000  # the bound of the sample the classifier is fitted on
_BUCKETS = 512
_W = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
_S = r"[\s.\-/]"

# Given names of the languages at hand.
GIVEN = (
    "Adam Adrien Alain Alba Alice Amélie Ana Andrea Anke Anna Antoine Antonio Arthur Aurélie Ben Birgit Camille Carla Carlos Carmen Caroline "
    "Charles Charlotte Chloé Clara Claire Claudia Daniel David Diego Dieter Eduardo Élise Elena Emma Emily Emil Erik Eva Fatima Felix Fernando "
    "Florian François Frank Gabriel George Grace Greta Guillaume Hannah Hans Harry Heike Hélène Hugo Inès Ingrid Isabel Isabelle Jack James Jan "
    "Javier Jean Jeanne Jens John Jonas Jorge José Juan Jules Julia Julie Julien Jürgen Karim Karin Klara Klaus Lara Laura Laurent Léa Lena Leon "
    "Liam Louis Louise Luc Lucas Lucía Luis Lukas Manon Manuel Marc Maria María Marie Marion Marta Martin Mathieu Max Mehdi Mia Michael Michel "
    "Miguel Mohamed Nadia Nathalie Nicolas Nina Noah Nora Oliver Olivia Omar Pablo Patrick Paul Paula Pedro Peter Petra Philippe Pierre Rachid "
    "Rémi Robert Rosa Sabine Samira Samuel Sarah Sébastien Sergio Sofia Sophie Stefan Stéphane Susanne Sven Théo Thomas Tim Tom Uwe Valérie "
    "Victor Wolfgang Yasmine Youssef Zoé"
).split()
# Words around a mention, by kind.
CUES = {
    "phone": "portable tél tel téléphone appel rappeler joignable ou au phone mobile call back on ring ask ms mr unter anrufen handy telefon al llame móvil teléfono".split(),
    "id_number": "nir sociale agent insurance number is documento dni nie ausweisnummer steuernummer ssn identité security".split(),
    "address": "habite chez adresse livré domicile live at ship to address wohne und wohnhaft vivo vive en espera domicilio dirección".split(),
    "email": "à to an a par at me contact mail courriel joignable write schreiben escriba écrivez".split(),
    "name": "appelle appelé rappeler contact cordialement technicien name is regards call ask heiße grüßen bitte frau herr saludo llame soy chez sincerely atentamente bonjour chère cher dear".split(),
}
AGAINST = {
    "phone": "compteur référence fiche consigne dossier pose numéro code série version lot requête boîtier passerelle export tronçon link count batch station sheet instruction".split(),
    "id_number": "référence compteur fiche consigne pose série code lot version".split(),
    "address": [],
    "email": [],
    "name": "rue avenue boulevard quai chemin impasse allée place pont calle plaza avenida street road lane de à vers station route".split(),
}
AFTER = "attend joignable reach und hat espera unter au al back wohne a s".split()
_TITLE = r"M\.|Mme|Mmes|Mlle|Monsieur|Madame|Mr\.?|Mrs\.?|Ms\.?|Miss|Dr\.?|Dre|Pr\.|Prof\.|Sr\.|Sra\.|Srta\.|Señora?|Don|Doña|Dra\.|Herrn?|Frau|Hr\.|Fr\."
_SURNAME = re.compile(r"(?:ier|ek|ini|mann|quin|ard|ez|sby|ot|on|au|el|ault|son|sen|ski|eau|ien|oux|inger|berg|ing|etti|elli|ova|ov)s?$", re.I)

# Wording that introduces a person; the first group may be followed by a single name.
_STRONG = r"m['’]appelle|name is|hei(?:ß|ss)e|mein name ist|me llamo|mi nombre es|зовут"
_CASELESS = r"我叫|私は|名前は|اسمي|मेरा नाम"
_WEAK = (
    r"call|ask(?: for)?|contact(?:e[rz]|o)?|rappeler|rappelez|joindre|appele[rz]|llame a|pregunte por|bitte|cordialement|salutations|regards|sincerely|saludos?"
    r"|gr(?:ü|ue)(?:ß|ss)en?|bien à vous|atentamente|technicien(?:ne)?|technician|techniker(?:in)?|técnic[oa]"
)
# Words that are no name however they are written.
_NO_NAME = frozenset(
    "le la les un une des du de au aux et ou on il elle nous vous je ce cette ces mon ma votre notre pour dans sur par avec sans est en the a an of and or in on at to for with we you he she it this that is are our your "
    "der die das ein eine und oder in im am zu zur zum für mit wir sie er es ich ist bei von el los las una y o en por para con es se del al que qui si pas service équipe team office support direction "
    "back me us here now please unter bitte herr frau tout toute tous".split()
)

_SIGN = r"(?:\s?@\s?|\s?[\[(]\s?(?:at|arobase|arroba|ät|chez)\s?[\])]\s?)"
_DOT = r"(?:\.|\s\.\s|\s?[\[(]\s?(?:dot|point|punto|punkt)\s?[\])]\s?|\s(?:point|punto|punkt|dot)\s)"
_TLD = r"com|org|net|edu|gov|info|io|eu|fr|de|es|uk|us|ca|be|ch|it|test|example|invalid|local"
EMAIL = re.compile(
    rf"[\w.+%-]*\w(?:{_SIGN}[\w-]+(?:{_DOT}[\w-]+){{0,3}}?{_DOT}(?:{_TLD}|[a-z]{{2,}}(?=[>\])\"'.,;:!?]|$))"
    rf"|\s(?:at|arobase|arroba)\s[\w-]+(?:{_DOT}[\w-]+){{0,3}}?{_DOT}(?:{_TLD}))(?![\w-])"
    # plainly written, under any ending
    r"|[\w.+%-]*\w@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,24}(?![\w-]|\s?[\[(]|\s(?:dot|point|punto|punkt)\s|\s\.\s)",
    re.I,
)
PHONE = re.compile(
    r"(?<![\w+\-/.])(?:"
    rf"(?:(?:\+|00)33{_S}*(?:\(0\){_S}*)?|0)[1-9](?:{_S}?\d\d){{4}}"
    rf"|(?:\+?1{_S}*)?(?:\(\d{{3}}\){_S}*|\d{{3}}[\s.\-])\d{{3}}[\s.\-]\d{{4}}"
    rf"|(?:\+|00)\d{{2}}{_S}*(?:\(0\){_S}*)?\d{{2,5}}(?:{_S}?\d{{2,8}}){{1,4}}"
    rf"|\(0\d{{2,4}}\)[\s\-/]*\d{{3,8}}(?:[\s\-]\d{{2,5}})*"
    r"|0\d{2,4}[\s\-/]\d{3,8}(?:[\s\-]\d{2,5})*"
    r"|[6789]\d{2}(?:[\s.]\d{2,3}){2,3}"
    r"|0\d{9,10}"
    r")(?!\w|[-/.]\d)"
)
ID_NUMBER = re.compile(
    r"(?<![\w\-/.])(?:"
    rf"[12]{_S}?\d\d{_S}?(?:0[1-9]|1[0-2]|[2-9]\d){_S}?(?:\d\d|2[AB]){_S}?\d{{3}}{_S}?\d{{3}}(?:{_S}?\d\d)?"
    r"|\d{3}-\d\d-\d{4}"
    r"|\d{2}\.?\d{3}\.?\d{3}\s?-?\s?[A-Z]|[XYZ]-?\d{7}-?[A-Z]"
    r")(?![\w]|[-/.]\d)",
    re.I,
)
LETTERED_ID = re.compile(r"\b(?:[A-Z]{2}\s?\d\d\s?\d\d\s?\d\d\s?[A-D]|[CFGHJKLMNPRTVWXYZ]\d[CFGHJKLMNPRTVWXYZ0-9]{7,8})(?![\w]|[-/.]\d)")
_FR = r"rue|avenue|av\.|boulevard|bd|quai|chemin|impasse|allée|allee|place|cours|route|square|passage|sentier|ruelle|esplanade"
_EN = r"Street|Road|Lane|Close|Avenue|Drive|Way|Court|Place|Square|Crescent|Gardens|Terrace|Row|Walk|Grove|Hill"
_ES = r"Calle|Avenida|Av\.|Plaza|Paseo|Camino|Ronda|Travesía|Carretera|C/"
FRENCH = re.compile(rf"(?<![\w\-])\d{{1,4}}(?:\s?(?:bis|ter|quater|[a-d]\b))?,?\s+(?:{_FR})\s+(?:{_W}\s+){{0,5}}?{_W}\s*(?:,\s*|\s[-–]\s+|\s+)\d{{5}}\s+{_W}", re.I)
ENGLISH = re.compile(rf"(?<![\w\-])\d{{1,4}}[a-z]?,?\s+(?:{_W}\s+){{1,3}}(?:{_EN}),\s+{_W}")
GERMAN = re.compile(rf"(?:\b(?:Am|Im|An\sder|In\sder|Auf\sder|Zum|Zur)\s+)?\b(?:{_W}-)?[^\W\d_]+(?:straße|strasse|str\.|weg|platz|gasse|allee|ufer|ring|damm)\s+\d{{1,4}}\s?[a-z]?,\s+\d{{5}}\s+{_W}", re.I)
SPANISH = re.compile(rf"\b(?:{_ES})\s+(?:{_W}\s+){{1,4}}\d{{1,4}}[a-z]?,\s+\d{{5}}\s+{_W}", re.I)
_GIVEN_SET = frozenset(n.casefold() for n in GIVEN)
_MORE = rf"(?:[^\S\n]+({_W}))?"
_BY_GIVEN = re.compile(r"\b(" + "|".join(sorted(GIVEN, key=len, reverse=True)) + rf")\b{_MORE}", re.I)
_BY_TITLE = re.compile(rf"(?<![\w.])({_TITLE})\s+({_W}){_MORE}", re.I)
_BY_CUE = re.compile(rf"(?<!\w)(?:((?:{_STRONG})(?!\w)|{_CASELESS})|(?:{_WEAK})(?!\w))\s*[:,(]?\s*({_W}){_MORE}", re.I)
# Folded words one of which every cue holds.
_CUE_WORDS = frozenset(
    "appelle name heisse llamo nombre зовут call ask contact contacter contactez contacto rappeler rappelez joindre appeler appelez llame pregunte bitte cordialement salutations regards sincerely saludo saludos "
    "grüssen gruessen grüsse bien atentamente technicien technicienne technician techniker technikerin técnico técnica".split()
)
_NO_CASE = re.compile(_CASELESS)
_GERMAN_TITLES = frozenset("herr herrn frau hr. fr.".split())
_WORD = re.compile(r"[^\W\d_]+")
_AT = re.compile(rf"@|[\[(]\s?(?:at|arobase|arroba|ät)|arobase|arroba|\sat\s[\w.-]+\.(?:{_TLD})\b", re.I)
_CLUSTER = re.compile(r"(?:\d[\s.\-/()]{0,3}){8}")
_FIVE = re.compile(r"(?<!\d)\d{5}(?!\d)")
_TITLE_WORDS = frozenset("m mm mme mmes mlle monsieur madame mr mrs ms miss dr dre prof sr sra srta señor señora don doña dra herr herrn frau hr fr".split())
_EN_WORDS = frozenset(w.lower() for w in _EN.split("|"))
_FR_WORDS = frozenset(w.strip(".\\").lower() for w in _FR.split("|"))
_ES_WORDS = frozenset("calle avenida av plaza paseo camino ronda travesía carretera c".split())
_DE_STREET = re.compile(r"(?:stra(?:ß|ss)e|str\.|weg|platz|gasse|allee|ufer|ring|damm)\s\d", re.I)


def _near(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    left = [w.casefold() for w in _WORD.findall(text[max(0, start - 40) : start])][-3:]
    right = [w.casefold() for w in _WORD.findall(text[end : end + 24])][:2]
    return left, right


def _votes(kind: str, text: str, s: int, e: int, extra: int = 0) -> list[int]:
    """+1, 0 or -1 of each labeler: format, gazetteer, word before, contrary word before, word after."""
    span = text[s:e]
    left, right = _near(text, s, e)
    cue = 1 if any(w in CUES[kind] for w in left[-2:]) else 0
    contra = -1 if any(w in AGAINST[kind] for w in left[-2:]) else 0
    after = 1 if right and right[0] in AFTER else 0
    if kind == "email":
        return [1, 1 if re.search(r"(?:com|org|net|fr|de|es|uk|test|example|invalid|eu|io)$", span, re.I) else 0, cue, 0, 0]
    if kind == "phone":
        digits = re.sub(r"\D", "", span)
        shape = 1 if span[0] in "+(" or span.startswith("00") or len(re.findall(r"[\s.\-/()]", span)) >= 2 else 0
        return [shape, 1 if 9 <= len(digits) <= 14 else -1, cue, contra, after]
    if kind == "id_number":
        digits = sum(c.isdigit() for c in span)
        return [1 if digits in (13, 15) or any(c.isalpha() for c in span) else 0, 1 if digits >= 6 else -1, cue, contra, 0]
    if kind == "address":
        return [1, 1 if re.search(r"\d{5}", span) else 0, cue, contra, 0]
    words = _WORD.findall(span)
    given = 1 if any(w.casefold() in _GIVEN_SET for w in words) else 0
    surname = 1 if _SURNAME.search(span) else 0
    shape = 1 if all(w[0].isupper() for w in words) else 0 if not any(w[0].islower() for w in words) else -1
    return [given, surname, cue or (1 if extra else 0), contra, after or shape]


def candidates(text: str) -> list[tuple[int, int, str, list[int]]]:
    """Proposed spans (start, end, kind, votes); spans of different kinds may overlap."""
    out: list[tuple[int, int, str, list[int]]] = []

    def propose(kind: str, pattern: re.Pattern, digits: int = 0) -> None:
        for m in pattern.finditer(text):
            if not digits or sum(c.isdigit() for c in m[0]) >= digits:
                out.append((m.start(), m.end(), kind, _votes(kind, text, m.start(), m.end())))

    if _AT.search(text):
        propose("email", EMAIL)
    if _CLUSTER.search(text):
        propose("phone", PHONE, 9)
        propose("id_number", ID_NUMBER, 6)
    propose("id_number", LETTERED_ID, 6)
    met = set(_WORD.findall(text.casefold()))
    if _FIVE.search(text):
        if not met.isdisjoint(_FR_WORDS):
            propose("address", FRENCH)
        if not met.isdisjoint(_ES_WORDS):
            propose("address", SPANISH)
        if _DE_STREET.search(text):
            propose("address", GERMAN)
    if not met.isdisjoint(_EN_WORDS):
        propose("address", ENGLISH)
    names: dict[tuple[int, int], int] = {}
    if not met.isdisjoint(_GIVEN_SET):
        for m in _BY_GIVEN.finditer(text):
            end = m.end(2) if _joins(m[1], m[2]) else m.end(1)
            if text[end : end + 1] in ("_", "@") or text[m.start() - 1 : m.start()] in (".", "_", "@", "+") and m.start():
                continue
            names[m.start(1), end] = 0
    if not met.isdisjoint(_TITLE_WORDS) or "Pr." in text:
        for m in _BY_TITLE.finditer(text):
            if not (_nameable(m[2]) or m[2].casefold() in _GIVEN_SET or _SURNAME.search(m[2]) and not m[2].casefold() in _NO_NAME):
                continue
            end = m.end(2)
            # a German noun may follow a name without being part of it
            if _joins(m[2], m[3]) and (m[1].lower() not in _GERMAN_TITLES or m[2].casefold() in _GIVEN_SET or m[3].isupper()):
                end = m.end(3)
            names[m.start(2), end] = 1
    if not met.isdisjoint(_CUE_WORDS) or _NO_CASE.search(text):
        at = 0
        while m := _BY_CUE.search(text, at):
            at = m.start(2)  # a cue may stand right behind a cue
            spans = [m.span(k) for k in (2, 3) if m[k] is not None]
            good = 0
            while good < len(spans) and _nameable(text[slice(*spans[good])]):
                good += 1
            last = spans[good - 1][1] if good else 0
            single = good == 1 and (m[1] is not None or not text[spans[0][0]].isupper())
            if (good > 1 or single) and text[last : last + 1] not in ("_", "@", "-", "/", "'", "’") and not text[last : last + 2].lstrip(" \xa0").isdigit():
                names.setdefault((spans[0][0], last), 1)
    for (s, e), introduced in names.items():
        # of two readings that begin alike the longer one holds the other
        if not any(s2 == s and e2 > e for s2, e2 in names):
            out.append((s, e, "name", _votes("name", text, s, e, introduced)))
    return out


def _nameable(word: str) -> bool:
    """Whether a word is written like a name: a capital, or a short word of a script without case."""
    low = word.casefold()
    if low in _NO_NAME or low in _TITLE_WORDS or low.replace("’", "'").startswith(("l'", "qu'", "n'", "j'", "c'")):
        return False
    if word[0].isupper():
        return len(word) > 1
    return not word[0].islower() and 2 <= len(word) <= (4 if word[0] >= "\u2e80" else 12)


def _joins(first: str, second: str | None) -> bool:
    """Whether the word after a name belongs to it."""
    if not second:
        return False
    if first[0].islower():
        return bool(_SURNAME.search(second)) and second.casefold() not in _NO_NAME
    return second[0].isupper() and (bool(_SURNAME.search(second)) or _nameable(second))


def em_reliability(votes: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each span holds, and each labeler's probability of each vote given the truth (2 x labelers x 3).

    Starts from the majority of votes; the estimates are smoothed so that a labeler that never errs stays finite.
    """
    n, m = votes.shape
    p = 1 / (1 + np.exp(-1.5 * (votes.sum(axis=1) - 0.5)))
    table = np.zeros((2, m, 3))
    for _ in range(rounds):
        prior = (p.sum() + 1) / (n + 2)
        for y, weight in ((0, 1 - p), (1, p)):
            for v in (-1, 0, 1):
                table[y, :, v + 1] = ((votes == v) * weight[:, None]).sum(axis=0) + (0.5 + 0.5 * (v * (2 * y - 1) > 0))
        table /= table.sum(axis=2, keepdims=True)
        cols = np.arange(m)
        score = np.log(prior / (1 - prior)) + sum(np.log(table[1, c, votes[:, c] + 1]) - np.log(table[0, c, votes[:, c] + 1]) for c in cols)
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return p, table


def _features(kind: str, text: str, s: int, e: int, votes: list[int]) -> list[int]:
    left, right = _near(text, s, e)
    keys = [f"v{i}{v}" for i, v in enumerate(votes)] + [f"v2{i}{j}{votes[i]}{votes[j]}" for i in range(len(votes)) for j in range(i)]
    keys += [f"l{w}" for w in left[-2:]] + [f"l1{w}" for w in left[-1:]] + [f"r{w}" for w in right[:1]]
    return [zlib.crc32(k.encode()) % _BUCKETS for k in keys]


def _unlisted(kind: str, votes: list[int]) -> list[int]:
    """Votes without those of the lists of names."""
    return [0, 0, *votes[2:]] if kind == "name" else votes


class SpanClassifier:
    """Logistic weights of each kind; of a kind that the sample never proposes, the sum of votes decides."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = {k: w.tolist() for k, w in weights.items()}

    def holds(self, kind: str, text: str, s: int, e: int, votes: list[int]) -> bool:
        w = self.weights.get(kind)
        if w is None:
            return sum(votes) >= 1
        return w[-1] + sum(w[f] for f in _features(kind, text, s, e, votes)) > 0

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """Accepted spans in order, none overlapping another; longer kinds of evidence go first."""
        if not text:
            return []
        taken: list[tuple[int, int, str]] = []
        found = [(s, e, k) for s, e, k, v in candidates(text) if self.holds(k, text, s, e, v)]
        rank = {"email": 0, "address": 1, "id_number": 2, "phone": 3, "name": 4}
        for s, e, k in sorted(found, key=lambda c: (rank[c[2]], c[0] - c[1], c[0])):
            if all(e <= a or s >= b for a, b, _ in taken):
                taken.append((s, e, k))
        return sorted(taken)


def fit(texts: list[str]) -> SpanClassifier:
    """Classifier from unlabelled texts: votes, expectation-maximisation, logistic regression on its probabilities."""
    by: dict[str, tuple[list, list]] = {k: ([], []) for k in KINDS}
    for t in texts:
        for s, e, k, v in candidates(t):
            by[k][0].append(v)
            by[k][1].append([_features(k, t, s, e, v), _features(k, t, s, e, _unlisted(k, v))])
    weights = {}
    for kind, (votes, feats) in by.items():
        if not votes:
            continue
        p, _ = em_reliability(np.array(votes))
        p = np.repeat(p, 2)
        x = np.zeros((2 * len(feats), _BUCKETS + 1))
        for i, f in enumerate(f for both in feats for f in both):
            np.add.at(x[i], f, 1.0)
        x[:, -1] = 1.0
        w = np.zeros(_BUCKETS + 1)
        for step in range(300):
            g = x.T @ (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) - p) / len(p) + 1e-4 * w
            w -= 0.5 * g
        weights[kind] = w
    return SpanClassifier(weights)


def fit_on(rows: DataFrame, key: str = "line_no", bound: int = FIT_ROWS) -> SpanClassifier:
    """Classifier fitted on about `bound` rows picked by the hash of their key, spread over the whole table."""
    n = rows.count()
    base = rows.select(F.col(key).alias("k"), "q", "a")
    part = base if n <= bound else base.where(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < int((1 << 30) * bound / n))
    got = part.select("q", "a").limit(2 * bound).collect()
    return fit(sorted({t for r in got for t in r if t}))


def find_personal(rows: DataFrame, model: SpanClassifier | None = None) -> DataFrame:
    """(line_no, field, kind, span) of every mention in q and a.

    A span stands as written, without surrounding brackets or closing marks; the same one counts once per row, field and
    kind. Null and empty texts have none, texts are read whole, and other columns aren't read.
    """
    model = model or fit_on(rows)

    def run(batches):
        for b in batches:
            lines, fields, kinds, spans = [], [], [], []
            for line, q, a in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                for field, text in (("q", q), ("a", a)):
                    if text:
                        for kind, span in sorted({(k, text[s:e]) for s, e, k in model.spans(text)}):
                            lines.append(line)
                            fields.append(field)
                            kinds.append(kind)
                            spans.append(span)
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.int64()), *(pa.array(x, pa.string()) for x in (fields, kinds, spans))], names=["line_no", "field", "kind", "span"])

    return rows.select(F.col("line_no").cast("bigint").alias("line_no"), "q", "a").mapInArrow(run, "line_no bigint, field string, kind string, span string")


def redact_personal(rows: DataFrame, model: SpanClassifier | None = None) -> DataFrame:
    """(line_no, q, a) with every mention replaced by a typed placeholder such as [EMAIL]; null texts stay null."""
    model = model or fit_on(rows)

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for s, e, kind in model.spans(text):
            out += [text[at:s], f"[{kind.upper()}]"]
            at = e
        return "".join(out) + text[at:]

    def run(batches):
        for b in batches:
            cols = [pa.array([clean(t) for t in b.column(i).to_pylist()], pa.string()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["line_no", "q", "a"])

    return rows.select(F.col("line_no").cast("bigint").alias("line_no"), "q", "a").mapInArrow(run, "line_no bigint, q string, a string")
