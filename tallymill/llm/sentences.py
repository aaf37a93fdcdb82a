"""Sentence units of texts in any language, script and layout (problem 9), by semi-Markov dynamic programming.

A text is first divided into runs that no unit crosses: blank lines, list items, lines of machine output or signs, and
spoken turns. Within a run every place after a closing mark, and in Thai every blank, is a possible end. Whole spans
between such places are scored jointly by how they close (mark, last word), how the next one opens (case, digit,
quotation, script, first word), how long they are, and whether quotations and brackets inside them are balanced; the best
sequence of spans wins. The weights of first words, last words and lengths are log odds counted over all of the
texts. Beyond LONG characters a span's length weighs the same, so the programme is linear in the length of a run.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.session import discard, materialize

# Words before a full stop that are followed by what they belong to.
BOUND_ABBREVIATIONS = frozenset(
    "m mme mmes mlle mr mrs ms dr dre pr prof me st ste sr sra srta dra hr fr frl ing no nr num núm nro pág pag art chap sect fig tab "
    "cf vgl voir resp env approx aprox ca circa ex bzw ggü ggf bspw zb dh inkl exkl max vs vgl ed eds rev gen sen rep gov hon mgr col cap "
    "напр стр прибл см рис табл ул г-н г-на им пр обл тыс млн млрд डॉ श्री सं د أ م ص ee".split()
)
# Abbreviations and units that may also end a sentence.
FINAL_ABBREVIATIONS = frozenset("etc usw uu km kg min h s t l pm am д г др п co inc ltd jr мм км".split())
# Month names after an ordinal day.
MONTHS = frozenset(
    "januar februar märz april mai juni juli august september oktober november dezember jänner "
    "january february march may june july october december janvier février mars avril juin juillet août septembre octobre novembre décembre".split()
)
_LEAST, _EVERY = 5, 200  # a word or length weighs from so many places on, and from one place in so many texts on
_HELD = 100_000  # counts that a task holds before it passes them on
LONG = 1024  # characters from which on a span's length weighs the same
_MOST = 0.75  # the most that a word or a length weighs
_UNBALANCED = 6.0
_SURE = 3.0  # score of an end that needs no word or length to be told
_OPEN = "«‹„「『（([{【《〈"
_CLOSE = "»›」』）)]}】》〉”"
_ENDS = re.compile(r"[.!?…。！？।॥؟．｡]+(?:[   ]?[»›]|[\"”’')\]」』）】“])*")
_LIST = re.compile(r"\s*(?:[-•*‣◦▪●·–]|\(?\d{1,3}[.)]|\(?[A-Za-z][)])[ \t ]+\S")
_TURN = re.compile(r"\s*[—―–][ \t ]*\S")
_MACHINE = re.compile(
    r"\s*(?:[{\[].*[}\]]\s*$|(?:SELECT|INSERT|UPDATE|DELETE|CREATE|WITH|DROP|ALTER)\s+\S|(?:TRACE|DEBUG|INFO|WARN|WARNING|ERROR|FATAL)\b[ :\[]"
    r"|[$#>]\s|```|<[/!?a-zA-Z])"
)
_TAIL = re.compile(r"(?:[^\W\d_]+|\d+)$")
_DEVANAGARI = re.compile(r"[ऀ-ॿ]+$")
_LETTERED = re.compile(r"[^\W\d_]")
_THAI = re.compile(r"[฀-๿຀-໿]")
_QUOTED = re.compile("[" + re.escape(_OPEN + _CLOSE) + "“\"]")
_LINE = re.compile(r"[^\n\r  \x0b\x0c\x85]+")
_CAMEL = re.compile(r"[a-z]{1,3}[A-Z]")
_WORD = re.compile(r"[^\W\d_]+")
_OPENING_WORD = re.compile(r"[\W_]{0,8}([^\W\d_]+)")
_BLANKS = re.compile(r"\s+")
_SYMBOL = re.compile(r"\s*[☀-➿⬀-⯿\U0001f000-\U0001faff]")


def _opening(text: str, at: int, stop: int) -> float:
    """How well a unit starts at the first non-blank from `at`."""
    while at < stop and text[at].isspace():
        at += 1
    if at >= stop:
        return 5.0
    c = text[at]
    if c.isupper() or c.istitle():
        return 2.0
    if c.islower():
        return 2.0 if _CAMEL.match(text, at, stop) else -7.0
    if c.isdigit():
        return 1.0
    if c in "¿¡\"" or c in _OPEN or c == "“":
        k = at + 1
        while k < stop and (text[k].isspace() or text[k] in "¿¡\""):
            k += 1
        return -1.0 if k < stop and text[k].islower() else 1.5
    if c in "—–-":
        k = at + 1
        while k < stop and text[k].isspace():
            k += 1
        return -7.0 if k < stop and text[k].islower() else 0.5
    if c in ",;:)]}»”’%/。！？" or c in _CLOSE:
        return -7.0
    return 2.0 if c.isalpha() else 0.5


def _closing(text: str, begin: int, at: int, end: int, stop: int) -> float:
    """How well a unit ends with the marks text[at:end]."""
    marks = text[at:end]
    first = marks[0]
    nxt = text[end : end + 1]
    wide = first in "。！？｡．"
    if nxt and end < stop and not nxt.isspace() and not wide:
        return -20.0
    closers = marks.lstrip(".!?…。！？।॥؟．｡")
    score = 3.0
    if closers:
        k = end
        while k < stop and text[k].isspace():
            k += 1
        follow = text[k : k + 1] if k < stop else ""
        if follow and follow.isalpha() and not (follow.isupper() or follow.islower()):
            return -20.0  # without letter case a quoted end inside a sentence looks like its own; the sentence goes on
    body = marks[: len(marks) - len(closers)] if closers else marks
    if "…" in body or "..." in body or body == "..":
        return score - 2.0
    if body == ".":
        if closers and closers.strip() in (")", "]"):
            score -= 1.0
        word = _TAIL.search(text, max(begin, at - 24), at) or None
        if word is None:
            word = _DEVANAGARI.search(text, max(begin, at - 24), at)
        if word is None:
            return score - 0.5
        w = word[0]
        low = w.lower()
        if w.isdigit():
            k = end
            while k < stop and text[k].isspace():
                k += 1
            after = _WORD.match(text, k, stop)
            if len(w) <= 2 and after and after[0].lower() in MONTHS and text[word.start() - 1 : word.start()] in (" ", " ", "\n", ""):
                return -20.0
            return score - 1.0
        if len(w) == 1 and (w.isupper() or w in BOUND_ABBREVIATIONS):
            return -20.0
        if low in FINAL_ABBREVIATIONS:
            return score - 2.0 if low in ("etc", "usw") else score - 1.0
        if low in BOUND_ABBREVIATIONS:
            return -20.0
        if len(w) == 1:
            return -20.0
    return score


def _balance(text: str, a: int, b: int, low_open: bool) -> tuple[int, int]:
    depth = quotes = 0
    for m in _QUOTED.finditer(text, a, b):
        c = m[0]
        if c == '"':
            quotes ^= 1
        elif c in _OPEN:
            depth += 1
        elif c == "“":
            depth += -1 if low_open else 1
        else:
            depth -= 1
    return depth, quotes


class Weights:
    """Log odds of first words, last words and lengths (by powers of two of their characters); none known weighs nothing."""

    def __init__(self, first: dict[str, float] | None = None, last: dict[str, float] | None = None, length: list[float] | None = None):
        self.first, self.last = first or {}, last or {}
        self.length = length or [0.0] * (LONG.bit_length() + 1)

    def span(self, n: int) -> float:
        return self.length[n.bit_length()] if n < LONG else self.length[-1]


def _first_word(text: str, at: int, stop: int) -> str:
    m = _OPENING_WORD.match(text, at, stop)
    return m[1].lower() if m else ""


def _last_word(text: str, begin: int, at: int) -> str:
    m = _TAIL.search(text, max(begin, at - 24), at)
    return m[0].lower() if m else ""


def _thai(text: str, a: int, b: int) -> bool:
    """Whether most letters of a run are Thai or Lao."""
    return 2 * len(_THAI.findall(text, a, b)) >= sum(map(str.isalpha, text[a:b]))


def _candidates(text: str, a: int, b: int) -> tuple[list[int], list[float], list[int]]:
    """Possible ends inside a run, what closing and opening there score, and where the marks begin."""
    places, scores, marks_at = [], [], []
    if _THAI.search(text, a, b):
        mostly = _thai(text, a, b)
        for m in _BLANKS.finditer(text, a, b):
            if mostly or _THAI.match(text, m.start() - 1) and _THAI.match(text, m.end()):
                places.append(m.start())
                scores.append(_SURE + 2.0)
                marks_at.append(m.start())
        if mostly:
            return places, scores, marks_at
    for m in _ENDS.finditer(text, a, b):
        end = m.end()
        if end >= b:
            break
        marks = m[0]
        if "“" in marks and "„" not in text[a : m.start()]:  # an opening mark of the next unit
            end = m.start() + marks.index("“")
        if marks[-1] == '"' and text[m.start() : end].count('"') == 1 and text.count('"', a, end) & 1:
            end -= 1
        close = _closing(text, a, m.start(), end, b)
        if close <= -20.0:
            continue
        places.append(end)
        scores.append(close + _opening(text, end, b))
        marks_at.append(m.start())
    if places and places[0] < a + 1 or any(p >= q for p, q in zip(places, places[1:])):
        order = sorted({p: (x, m) for p, x, m in zip(places, scores, marks_at)}.items())
        return [p for p, _ in order], [x for _, (x, _) in order], [m for _, (_, m) in order]
    return places, scores, marks_at


def _trim(text: str, a: int, b: int) -> tuple[int, int]:
    while b > a and text[b - 1].isspace():
        b -= 1
    while a < b and text[a].isspace():
        a += 1
    return a, b


_NONE = (-1e18, 0)


def _best_spans(starts: list[int], scores: list[float], state: list, weights: Weights) -> list[int]:
    """Indexes 1..n of the ends of the best sequence of spans; starts[i] is where a span after end i begins.

    Spans up to LONG characters are tried one by one; of the longer ones only the best of each state of quotations can
    win, so one value a state stands for all of them.
    """
    n = len(scores)
    best, back = [0.0] * (n + 1), [0] * (n + 1)
    span, near = weights.span, 0
    far: dict = {}
    far_best = _NONE
    for j in range(1, n + 1):
        end, here = starts[j], state[j]
        while end - starts[near] >= LONG and near < j - 1:
            value = best[near]
            if value > far.get(state[near], _NONE)[0]:
                far[state[near]] = (value, near)
            if value > far_best[0]:
                far_best = (value, near)
            near += 1
        top, at = -1e18, j - 1
        for i in range(j - 1, near - 1, -1):
            s = best[i] + span(end - starts[i])
            if state[i] != here:
                s -= _UNBALANCED
            if s > top:
                top, at = s, i
        if far:
            tail = weights.length[-1]
            same = far.get(here, _NONE)
            if same[0] + tail > top:
                top, at = same[0] + tail, same[1]
            if far_best[0] + tail - _UNBALANCED > top:
                top, at = far_best[0] + tail - _UNBALANCED, far_best[1]
        best[j], back[j] = top + scores[j - 1], at
    ends, j = [], n
    while j:
        ends.append(j)
        j = back[j]
    return ends[::-1]


def _run(text: str, a: int, b: int, out: list[int], weights: Weights) -> None:
    """Ends of the units of text[a:b], a run without layout borders inside."""
    a, b = _trim(text, a, b)
    if b <= a:
        return
    places, scores, marks_at = _candidates(text, a, b)
    first, last = weights.first, weights.last
    if first or last:
        scores = [x + first.get(_first_word(text, p, b), 0.0) + last.get(_last_word(text, a, m), 0.0) for x, p, m in zip(scores, places, marks_at)]
    places.append(b)
    scores.append(0.0)
    state: list = [0] * (len(places) + 1)
    if len(places) > 1 and _QUOTED.search(text, a, b):
        low_open = "„" in text[a:b]
        depth, quotes, left = 0, 0, a
        state = [(0, 0)]
        for p in places:
            d, q = _balance(text, left, p, low_open)
            depth, quotes, left = depth + d, quotes ^ q, p
            state.append((depth, quotes))
    out.extend(places[j - 1] for j in _best_spans([a, *places], scores, state, weights))


def _count(text: str, counts: dict[tuple[str, str], list[int]]) -> None:
    """Adds a text's sure non-ends and sure ends to counts of (kind, key), and both to the kind's total."""

    def add(kind: str, key: str, sure: int) -> None:
        for k in ((kind, key), ("all " + kind, "")):
            counts.setdefault(k, [0, 0])[sure] += 1

    for a, b, kind in layout_runs(text):
        if kind != "run":
            continue
        a, b = _trim(text, a, b)
        begin = a
        for p, x, m in zip(*_candidates(text, a, b)):
            if abs(x) < _SURE:
                continue
            sure = int(x > 0)
            add("first", _first_word(text, p, b), sure)
            add("last", _last_word(text, a, m), sure)
            add("length", str(min(LONG, p - begin).bit_length()), sure)
            if sure:
                begin = p


def _weights(counts: dict[tuple[str, str], tuple[int, int]]) -> Weights:
    """Weights from counts of sure non-ends and sure ends."""

    def odds(kind: str) -> dict[str, float]:
        all_no, all_yes = counts.get(("all " + kind, ""), (0, 0))
        base = np.log((all_yes + 1) / (all_no + 1))
        return {w: max(-_MOST, min(_MOST, float(np.log((yes + 1) / (no + 1)) - base))) for (k, w), (no, yes) in sorted(counts.items()) if k == kind and w}

    length = odds("length")
    return Weights(odds("first"), odds("last"), [length.get(str(k), 0.0) for k in range(LONG.bit_length() + 1)])


def _least(texts: int) -> int:
    """Places from which on a word or length weighs: a share of the texts, so that the weights don't grow with them."""
    return max(_LEAST, -(-texts // _EVERY))


def fit_weights(texts: list[str]) -> Weights:
    """Weights from the sure ends and sure non-ends of unlabelled texts."""
    counts: dict[tuple[str, str], list[int]] = {}
    for text in texts:
        _count(text, counts)
    return _weights({k: (no, yes) for k, (no, yes) in counts.items() if no + yes >= _least(len(texts)) or k[0].startswith("all ")})


def layout_runs(text: str | None):
    """(start, stop, kind) of the parts of a text that no unit crosses: "run", or "item" for a part that is one unit."""
    if not text or text.isspace():
        return
    start = stop = -1  # the run of plain lines being gathered
    for m in _LINE.finditer(text):
        a, b = m.span()
        if start >= 0:
            gap = text[stop:a]
            if gap.count("\n") + gap.count("\u2028") > 1 or gap.count("\r") > 1 and "\n" not in gap:
                yield start, stop, "run"
                start = -1
        line = m[0]
        if line.isspace():
            if start >= 0:
                yield start, stop, "run"
                start = -1
            continue
        c = line.lstrip()[0]
        kind = "text"
        if c in "—―–":
            kind = "turn" if _TURN.match(line) and not (c == "–" and _LIST.match(line)) else "item"
        elif (not c.isalpha() or c.isascii()) and _LIST.match(line):
            kind = "item"
        elif "\t" in line.strip() or _MACHINE.match(line) or _SYMBOL.match(line) or not _LETTERED.search(line):
            kind = "item"
        if kind == "text":
            if start < 0:
                start = a
            stop = b
            continue
        if start >= 0:
            yield start, stop, "run"
            start = -1
        if kind == "item":
            yield a, a + len(line.rstrip()), "item"
        else:
            start, stop = a, b
    if start >= 0:
        yield start, stop, "run"


def sentence_ends(text: str | None, weights: Weights | None = None) -> list[int]:
    """End of each unit, as the number of code points up to its last character; none for null, empty and blank texts."""
    out: list[int] = []
    weights = weights or _PLAIN
    for a, b, kind in layout_runs(text):
        if kind == "item":
            out.append(b)
        else:
            _run(text, a, b, out, weights)
    return out


_PLAIN = Weights()


def _ends(weights: Weights):
    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 2000):
                part = b.slice(k, 2000)
                found = [sentence_ends(t, weights) for t in part.column(1).to_pylist()]
                counts = np.array([len(f) for f in found], dtype=np.int64)
                flat = np.fromiter((e for f in found for e in f), dtype=np.int64, count=int(counts.sum()))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(np.repeat(np.arange(len(found)), counts))), pa.array(flat)], names=["doc_id", "end_pos"])

    return run


def _counted(batches):
    """(kind, key, no, yes): counts of a task's texts."""
    counts: dict[tuple[str, str], list[int]] = {}

    def rows():
        keys, values = list(counts), list(counts.values())
        columns = [[k for k, _ in keys], [w for _, w in keys], [no for no, _ in values], [yes for _, yes in values]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["kind", "key", "no", "yes"])

    for b in batches:
        for text in b.column(0).to_pylist():
            counts.setdefault(("all texts", ""), [0, 0])[1] += 1
            _count(text, counts)
            if len(counts) >= _HELD:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def weights_of(documents: DataFrame, text: str = "text") -> Weights:
    """Weights from all documents; what reaches the driver is bounded by the share of the texts that a word must be in."""
    texts = documents.select(F.col(text).cast("string").alias("t")).where("t is not null")
    counted = materialize(texts.mapInArrow(_counted, "kind string, key string, no bigint, yes bigint").groupBy("kind", "key").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes")), "sentence-words")
    totals = {(r.kind, ""): (r.no, r.yes) for r in counted.where("kind like 'all %'").collect()}
    least = _least(totals.get(("all texts", ""), (0, 0))[1])
    often = counted.where("kind not like 'all %'").where(F.col("no") + F.col("yes") >= least).collect()
    discard(counted)
    return _weights(totals | {(r.kind, r.key): (r.no, r.yes) for r in often})


def sentence_units(documents: DataFrame, key: str = "doc_id", text: str = "text", weights: Weights | None = None) -> DataFrame:
    """(doc_id, end_pos), one row per sentence unit of every document.

    A unit starts at the first non-blank character after the one before. Null, empty and blank texts have no unit; whole
    texts of any length are read, repeated rows each give their units, and other columns aren't read.
    """
    run = _ends(weights or weights_of(documents, text))
    return documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, end_pos bigint")
