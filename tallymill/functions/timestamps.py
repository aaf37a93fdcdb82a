"""Vectorised conversion of mixed timestamp spellings to UTC.

Each value is reduced to its mask of character classes (a digit becomes 9, a run of letters A). Every distinct mask is
mapped once to the layouts it can hold; all values of the mask are then taken apart by those layouts, each in one Arrow
regular expression, until none fits what is left. Wall times go through transition tables drawn from the installed zone
database and known by its version.
"""

from __future__ import annotations

import functools
import re
import zoneinfo
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Month names of the sources' languages, by the letters that tell them apart.
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8,
    "september": 9, "october": 10, "november": 11, "december": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
    "janvier": 1, "février": 2, "mars": 3, "avril": 4, "mai": 5, "juin": 6, "juillet": 7, "août": 8,
    "septembre": 9, "octobre": 10, "novembre": 11, "décembre": 12,
    "januar": 1, "februar": 2, "märz": 3, "juni": 6, "juli": 7, "oktober": 10, "dezember": 12,
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8,
    "septiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
    "janv": 1, "févr": 2, "fév": 2, "avr": 4, "juil": 7, "déc": 12, "jän": 1, "mär": 3, "okt": 10, "dez": 12, "ene": 1, "abr": 4, "ago": 8, "dic": 12,
}
# Minutes east of UTC of zone abbreviations.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120,
    "EEST": 180, "MSK": 180, "JST": 540, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420, "RET": 240,
}
CANONICAL = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$"

# Each part of a layout: how it reads in a value, and in a mask.
_DATES = (
    (r"(?P<y>\d{4})[-/.](?P<mo>\d{1,2})[-/.](?P<d>\d{1,2})", r"9999[-/.]99?[-/.]99?"),
    (r"(?P<y>\d{4})(?P<mo>\d{2})(?P<d>\d{2})", r"9{8}"),
    (r"(?P<y>\d{4})-(?P<doy>\d{3})", r"9999-999"),
    (r"(?P<y>\d{4})-W(?P<wk>\d{2})-(?P<wd>\d)", r"9999-A99-9"),
    (r"(?P<p1>\d{1,2})/(?P<p2>\d{1,2})/(?P<y>\d{4}|\d{2})", r"99?/99?/99(?:99)?"),
    (r"(?P<d>\d{1,2})\.(?P<mo>\d{1,2})\.(?P<y>\d{4}|\d{2})", r"99?\.99?\.99(?:99)?"),
    (r"(?P<d>\d{1,2})(?:\.|er)?[- ](?P<mon>\p{L}+)\.?[- ](?P<y>\d{4})", r"99?(?:\.|A)?[- ]A\.?[- ]9999"),
    (r"(?P<d>\d{1,2}) de (?P<mon>\p{L}+) del? (?P<y>\d{4})", r"99? A A A 9999"),
    (r"(?P<mon>\p{L}+)\.? (?P<d>\d{1,2})(?:st|nd|rd|th)?,? (?P<y>\d{4})", r"A\.? 99?A?,? 9999"),
)
_WEEKDAY = (r"(?:\p{L}+\.?,? )?", r"(?:A\.?,? )?")
_GAP = (r"(?:T|t| |, | à | um | at | a las )", r"(?:A| |, | A | A A )")
_TIME = (
    r"(?:(?P<h>\d{1,2})(?::|h)(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<f>\d+))?)?|(?P<h2>\d{2})(?P<mi2>\d{2})(?P<s2>\d{2})(?:[.,](?P<f2>\d+))?)",
    r"(?:99?[:A]99(?::99(?:[.,]9+)?)?|9{6}(?:[.,]9+)?)",
)
_HALF = (r"(?: ?(?P<ap>AM|PM|am|pm|[ap]\.m\.))?", r"(?: ?A(?:\.A\.)?)?")
_ZONE = (
    r"(?: ?Uhr)?(?: ?(?:(?P<sg>[+-])(?P<oh>\d{2}):?(?P<om>\d{2})?|(?P<z>\p{Lu}{1,5}|z))(?:\[[^\]]+\])?| ?\[?(?P<iana>\p{L}+(?:/[\p{L}_+-]+)+)\]?)?",
    r"(?: ?A)?(?: ?(?:[+-]99:?(?:99)?|A)(?:\[[^\]]+\])?| ?\[?A(?:[/_+-]+A)+\]?)?",
)
# the date of the C library's form stands around the time
_CTIME = (
    r"\p{L}+ (?P<mon>\p{L}+) +(?P<d>\d{1,2}) (?P<h>\d{2}):(?P<mi>\d{2}):(?P<s>\d{2})(?: (?P<z>\p{Lu}{1,5}))? (?P<y>\d{4})",
    r"A A +99? 99:99:99(?: A)? 9999",
)
_NUMBER = (r"(?P<n>\d+)(?:\.(?P<nf>\d+))?", r"9+(?:\.9+)?")
_UNITS = (1, 1_000, 1_000_000, 1_000_000_000)  # parts of a second in which bare numbers may count


def _layouts() -> list[tuple[str, str]]:
    """(value pattern, mask pattern) of every layout, in the order in which they are tried."""
    after = ["(?:" + _GAP[k] + _TIME[k] + _HALF[k] + _ZONE[k] + ")?" for k in (0, 1)]
    dated = [tuple(_WEEKDAY[k] + date[k] + after[k] for k in (0, 1)) for date in _DATES]
    return [tuple("^" + p + "$" for p in layout) for layout in (_NUMBER, *dated, _CTIME)]


LAYOUTS = _layouts()


@functools.lru_cache(maxsize=4096)
def layouts_of(mask: str) -> tuple[str, ...]:
    """Patterns of the layouts that a value of this mask may have; a function of the mask alone, found once a process."""
    import regex

    return tuple(value for value, shape in LAYOUTS if regex.fullmatch(shape[1:-1], mask))


@functools.lru_cache(maxsize=1)
def zone_version() -> str:
    """Version of the zone database the tables are drawn from."""
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        pass
    for folder in zoneinfo.TZPATH:
        for name in ("tzdata.zi", "+VERSION"):
            try:
                with open(f"{folder}/{name}") as f:
                    return f.readline().removeprefix("# version").strip()
            except OSError:
                continue
    return "system"


def transitions(zone: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Transition table of a zone in the installed version of the database; None for an unknown zone."""
    return _table(zone, zone_version())


@functools.lru_cache(maxsize=1024)
def _table(zone: str, version: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Wall-clock thresholds (s) at which an offset ends, and the offsets (s) before, between and after them.

    The threshold of a change is the instant plus the larger offset, so that a repeated wall time keeps the earlier
    offset and a skipped one the offset in force just before.
    """
    try:
        tz = zoneinfo.ZoneInfo(zone)
    except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError):
        return None
    off = lambda t: int(datetime.fromtimestamp(t, timezone.utc).astimezone(tz).utcoffset().total_seconds())
    step, end = 7 * 86400, 4_102_444_800
    at, now = -2_208_988_800, 0
    now = off(at)
    thresholds, offsets = [], [now]
    while at < end:
        nxt = at + step
        new = off(nxt)
        if new != now:
            lo, hi = at, nxt
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (lo, mid) if off(mid) == new else (mid, hi)
            thresholds.append(hi + max(now, new))
            offsets.append(new)
            now = new
        at = nxt
    return np.array(thresholds, dtype=np.int64), np.array(offsets, dtype=np.int64)


_LENGTHS = np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31], dtype=np.int64)


def _leap(y: np.ndarray) -> np.ndarray:
    return (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Days since 1970-01-01 of civil dates."""
    months = ((y - 1970) * 12 + (m - 1)).astype("datetime64[M]")
    return months.astype("datetime64[D]").astype(np.int64) + d - 1


def _micros(text: pa.Array) -> np.ndarray:
    """First six digits of a fraction, padded with zeros."""
    cut = pc.utf8_slice_codeunits(pc.fill_null(text, ""), 0, 6)
    return pc.cast(pc.utf8_rpad(cut, 6, "0"), pa.int64()).to_numpy(zero_copy_only=False)


def _convert(values: pa.Array, zones: np.ndarray, orders: np.ndarray, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Microseconds since 1970 in UTC, and which of them hold."""
    parts = pc.extract_regex(values, pattern=pattern)
    names = {parts.type.field(i).name for i in range(parts.type.num_fields)}
    n = len(values)
    ok = pc.is_valid(parts).to_numpy(zero_copy_only=False).copy()

    def text(k: str) -> pa.Array:
        return pc.fill_null(parts.field(k), "") if k in names else pa.array([""] * n, pa.string())

    def number(k: str, missing: int = 0) -> np.ndarray:
        x = text(k)
        x = pc.if_else(pc.equal(x, ""), pa.scalar(str(missing)), x)
        return pc.cast(x, pa.int64()).to_numpy(zero_copy_only=False).copy()

    if "n" in names:
        big = pc.greater(pc.utf8_length(text("n")), 19)
        ok &= ~big.to_numpy(zero_copy_only=False)
        v = pc.cast(pc.if_else(big, pa.scalar("0"), text("n")), pa.uint64()).to_numpy(zero_copy_only=False).astype(np.float64)
        whole = pc.cast(pc.if_else(big, pa.scalar("0"), text("n")), pa.decimal128(20)).cast(pa.int64(), safe=False).to_numpy(zero_copy_only=False)
        us = np.zeros(n, dtype=np.int64)
        known = np.zeros(n, dtype=bool)
        for per_second in _UNITS:
            mine = ~known & (v >= 946_684_800.0 * per_second) & (v < 4_102_444_800.0 * per_second)
            known |= mine
            if per_second <= 1_000_000:
                us[mine] = whole[mine] * (1_000_000 // per_second)
            else:
                us[mine] = whole[mine] // (per_second // 1_000_000)
            if per_second == 1:
                us[mine] += _micros(text("nf"))[mine]
        return us, ok & known

    y = number("y")
    y = np.where(pc.equal(pc.utf8_length(text("y")), 2).to_numpy(zero_copy_only=False), y + 2000, y)
    if "doy" in names:
        doy = number("doy")
        ok &= (doy >= 1) & (doy <= 365 + _leap(y))
        day = _days(y, np.ones(n, np.int64), np.ones(n, np.int64)) + doy - 1
    elif "wk" in names:
        wk, wd = number("wk"), number("wd")
        first = _days(y, np.ones(n, np.int64), np.full(n, 4, np.int64))
        monday = first - (first + 3) % 7
        after = _days(y + 1, np.ones(n, np.int64), np.full(n, 4, np.int64))
        weeks = (after - (after + 3) % 7 - monday) // 7
        ok &= (wk >= 1) & (wk <= weeks) & (wd >= 1) & (wd <= 7)
        day = monday + (wk - 1) * 7 + wd - 1
    else:
        if "p1" in names:
            p1, p2 = number("p1"), number("p2")
            month_first = orders == "mdy"
            mo, d = np.where(month_first, p1, p2), np.where(month_first, p2, p1)
        elif "mon" in names:
            words = pc.utf8_lower(text("mon")).to_pylist()
            mo, d = np.array([MONTHS.get(w, 0) for w in words], dtype=np.int64), number("d")
        else:
            mo, d = number("mo"), number("d")
        fits = (mo >= 1) & (mo <= 12) & (y >= 1)
        mo = np.where(fits, mo, 1)
        ok &= fits & (d >= 1) & (d <= _LENGTHS[mo] + ((mo == 2) & _leap(y)))
        day = _days(np.where(fits, y, 1970), mo, d)
    h = number("h") + number("h2")
    mi, s = number("mi") + number("mi2"), number("s") + number("s2")
    half = pc.utf8_lower(pc.utf8_slice_codeunits(text("ap"), 0, 1)).to_numpy(zero_copy_only=False)
    am, pm = half == "a", half == "p"
    ok &= ~((am | pm) & ((h < 1) | (h > 12)))
    h = np.where(am | pm, h % 12 + 12 * pm, h)
    ok &= (h <= 23) & (mi <= 59) & (s <= 59)
    wall = day * 86400 + h * 3600 + mi * 60 + s
    us = _micros(text("f")) + _micros(text("f2"))

    sign = text("sg").to_numpy(zero_copy_only=False)
    has_offset = (sign == "+") | (sign == "-")
    oh, om = number("oh"), number("om")
    ok &= ~(has_offset & ((oh > 18) | (om > 59)))
    offset = np.where(sign == "-", -1, 1) * (oh * 3600 + om * 60)
    abbr, iana = text("z").to_numpy(zero_copy_only=False), text("iana").to_numpy(zero_copy_only=False)
    has_abbr = ~has_offset & (abbr != "")
    if has_abbr.any():
        for w in set(abbr[has_abbr]):
            mine = has_abbr & (abbr == w)
            if w.upper() in ABBREVIATIONS:
                offset[mine] = ABBREVIATIONS[w.upper()] * 60
            else:
                ok[mine] = False
    by_zone = ~has_offset & ~has_abbr
    zone = np.where(iana != "", iana, zones)
    for name in {z for z in zone[by_zone & ok] if z is not None}:
        mine = by_zone & (zone == name)
        rule = transitions(name)
        if rule is None:
            ok[mine] = False
            continue
        thresholds, offsets = rule
        offset[mine] = offsets[np.searchsorted(thresholds, wall[mine], side="right")]
    ok &= ~(by_zone & np.array([z is None for z in zone], dtype=bool))
    return (wall - offset) * 1_000_000 + us, ok


def to_utc(stamps: pa.Array, zones: pa.Array, orders: pa.Array) -> pa.Array:
    """`YYYY-MM-DDTHH:MM:SS.ffffffZ` of each stamp, null where it denotes no instant."""
    if isinstance(stamps, pa.ChunkedArray):
        stamps, zones, orders = stamps.combine_chunks(), zones.combine_chunks(), orders.combine_chunks()
    stamps = pc.utf8_trim_whitespace(stamps.cast(pa.string()))
    masks = pc.replace_substring_regex(pc.replace_substring_regex(stamps, r"\p{L}+", "A"), r"[0-9]", "9").dictionary_encode()
    codes = pc.fill_null(masks.indices, -1).to_numpy(zero_copy_only=False)
    zone, order = zones.to_numpy(zero_copy_only=False), orders.to_numpy(zero_copy_only=False)
    us = np.zeros(len(stamps), dtype=np.int64)
    ok = np.zeros(len(stamps), dtype=bool)
    # what a value becomes depends on the value alone: every layout its mask may hold is tried on it, in a fixed order
    fits = [layouts_of(mask) for mask in masks.dictionary.to_pylist()]
    open_ = np.array([bool(f) for f in fits] + [False], dtype=bool)[codes]
    for pattern, _ in LAYOUTS:
        may = np.array([pattern in f for f in fits] + [False], dtype=bool)[codes]
        rows = np.flatnonzero(open_ & may)
        if not len(rows):
            continue
        taken = stamps.take(pa.array(rows))
        read = pc.match_substring_regex(taken, pattern).to_numpy(zero_copy_only=False).astype(bool)
        rows = rows[read]
        open_[rows] = False
        us[rows], ok[rows] = _convert(taken.filter(pa.array(read)), zone[rows], order[rows], pattern)
    low, high = -62_135_596_800_000_000, 253_402_300_800_000_000
    ok &= (us >= low) & (us < high)
    text = np.char.add(np.datetime_as_string(np.where(ok, us, 0).astype("datetime64[us]"), unit="us"), "Z")
    return pa.array(text.astype(object), pa.string(), mask=~ok)
