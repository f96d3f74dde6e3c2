"""Personal data in texts, also when it is disguised, as spans of the source text.

Detectors for e-mail addresses, IP numbers, payment cards and phone numbers run twice: on the text as it is
(the base spans) and on a normalised text. Normalisation is a chain of transducers, each a list of edits
(source start, source end, replacement): look-alike characters become ASCII, invisible ones vanish, bracketed or
spelled "at" and "dot" become the characters, runs of spelled digits become digits. The edits map every
place of the normalised text back, so a span found there is reported as the source characters it stands for. A
span counts as added when normalisation changed something inside it and no base span of its kind overlaps it.

Every detector is linear in the text. Null text is empty text and has no spans; repeated rows are scanned
each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lectern.llm.words import pieces

KINDS = ("email", "ip", "card", "phone")

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_DOTTED = re.compile(r"\.[0-9]+\.[0-9]")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # The part before an @ is the run of its characters, so it is found backwards from the @.
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            floor = m.end()
        at = text.find("@", max(at + 1, floor))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _is_byte(digits: str) -> bool:
    """At most 255; any number of zeros may stand before it."""
    digits = digits.lstrip("0")
    return len(digits) < 3 or len(digits) == 3 and digits <= "255"


def detect(text: str) -> list[Span]:
    """Spans of each kind, leftmost first and without overlaps within a kind, by kind and start."""
    out = [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(_is_byte(p) for p in m.groups())] if _DOTTED.search(text) else []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGIT.findall(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


# Letters of other scripts that look like ASCII ones, characters without width, number words.
LOOK_ALIKES = {
    "a": "аαɑ", "b": "Ьƅ", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іιɩ", "j": "јϳ", "k": "κк", "l": "ӏ",
    "m": "м", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "t": "т", "u": "υս", "v": "νѵ", "w": "ԝѡ", "x": "хχ", "y": "уγү",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ",
    "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ", ".": "․。", "-": "‐‑‒–−", "+": "＋", "@": "＠﹫",
}
INVISIBLE = "​‌‍⁠﻿­"
NUMBER_WORDS = {
    "0": "zero oh null zéro cero", "1": "one eins un uno", "2": "two zwei zwo deux dos", "3": "three drei trois tres",
    "4": "four vier quatre cuatro", "5": "five fünf cinq cinco", "6": "six sechs seis", "7": "seven sieben sept siete",
    "8": "eight acht huit ocho", "9": "nine neun neuf nueve",
}
AT_DOT = {"at": "dot", "arroba": "punto", "arobase": "point", "ät": "punkt"}
AT_WORDS, DOT_WORDS = tuple(AT_DOT), tuple(AT_DOT.values())
PLUS_WORDS = ("plus", "más")

_DIGIT_OF = {word: d for d, words in NUMBER_WORDS.items() for word in words.split()}
_NUMBER = "|".join(sorted(_DIGIT_OF, key=len, reverse=True))
_AT, _DOT, _PLUS = "|".join(AT_WORDS), "|".join(DOT_WORDS), "|".join(PLUS_WORDS)
# These run on lower-cased text.
_BRACKETED = re.compile(rf"[\[({{<][ \t]?(?:(?P<at>{_AT}|@)|(?P<dot>{_DOT}|\.))[ \t]?[\])}}>]")
_SPELLED_RUN = re.compile(rf"\b(?:{_NUMBER})(?:[ \t,-]{{1,2}}(?:{_NUMBER})){{2,}}(?!\w)")
_SPELLED_PLUS = re.compile(rf"(?:{_PLUS})[ \t]{{1,3}}(?=[0-9])")
_SPELLED_WORD = re.compile(rf"(?:{_NUMBER})(?!\w)")
# Letters that look like digits.
_DIGIT_LIKE = {"O": "0", "o": "0", "I": "1", "l": "1"}
_MIXED_DIGITS = re.compile(r"(?<![A-Za-z0-9])(?:[0-9]++[OoIl]|[OoIl]++[0-9])[0-9OoIl]*+(?![A-Za-z0-9])")
_ANY_AT = re.compile(rf"(?<=[a-z0-9_%+-])(?:@|[ \t]{{1,3}}(?P<word>{_AT})[ \t]{{1,3}})(?=[a-z0-9])")
_ADDRESS_DOMAIN = {
    at: re.compile(rf"[a-z0-9-]++(?:(?:[ \t]{{1,3}}(?:{dot})[ \t]{{1,3}}|\.)[a-z0-9-]++)++")
    for at, dot in (*AT_DOT.items(), (None, _DOT))
}
#: A name that is no plain word: it has a digit, a point or an underscore after a letter.
_HANDLE = re.compile(r"[a-z][a-z%+-]*+[0-9._]")
_NAME = frozenset("abcdefghijklmnopqrstuvwxyz0123456789_%+-")
_SPELLED_DOT = re.compile(rf"[ \t]{{1,3}}(?:{_DOT})[ \t]{{1,3}}")
_SPELLED_NUMBER = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:[ \t]{{1,3}}(?:{_DOT})[ \t]{{1,3}}[0-9]{{1,3}}){{3}}(?![0-9])")


@cache
def _alike() -> dict[int, str]:
    """ASCII for each single character that stands for one: by compatibility, by digit value, by looks."""
    table = {}
    for c in (*range(0x80, 0x3000), *range(0xFE50, 0xFF5F), *range(0x1D400, 0x1D800), *range(0x104A0, 0x104AA)):
        ch = chr(c)
        plain = unicodedata.normalize("NFKC", ch)
        if unicodedata.category(ch) == "Nd":
            table[c] = str(unicodedata.digit(ch))
        elif len(plain) == 1 and "!" <= plain <= "~":
            table[c] = plain
    table |= {ord(ch): plain for plain, looks in LOOK_ALIKES.items() for ch in looks}
    return table


@cache
def _odd() -> np.ndarray:
    """Whether normalisation changes a code point by itself."""
    table = np.zeros(sys.maxunicode + 1, bool)
    table[list(_alike())] = True
    table[[ord(c) for c in INVISIBLE]] = True
    return table


def _lower(text: str) -> str:
    """Lower case, character by character, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class Normalised:
    """A text after edits, and where its places came from."""

    def __init__(self, text: str):
        self.source = self.text = text
        self.at, self.low, self.high, self.copied = [0], [0], [len(text)], [True]

    def back(self, start: int, end: int) -> tuple[int, int]:
        return self._start(start), self._end(end)

    def _start(self, place: int) -> int:
        k = bisect_right(self.at, place) - 1
        return self.low[k] + (place - self.at[k] if self.copied[k] else 0)

    def _end(self, place: int) -> int:
        k = bisect_right(self.at, place - 1) - 1
        return self.low[k] + (place - self.at[k]) if self.copied[k] else self.high[k]

    def edited(self) -> set[int]:
        """Places of the present text where replacements begin."""
        return {a for a, same in zip(self.at, self.copied, strict=True) if not same}

    def edit(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply edits of the present text, in order and without overlaps."""
        if not edits:
            return
        at, low, high, copied, parts, size, done = [], [], [], [], [], 0, 0
        ends = [*self.at[1:], len(self.text)]

        def copy(a: int, b: int) -> None:
            nonlocal size
            k = bisect_right(self.at, a) - 1
            while a < b:
                stop = min(b, ends[k])
                if stop > a:
                    at.append(size)
                    low.append(self.low[k] + (a - self.at[k] if self.copied[k] else 0))
                    high.append(self.low[k] + (stop - self.at[k]) if self.copied[k] else self.high[k])
                    copied.append(self.copied[k])
                    size += stop - a
                a, k = stop, k + 1

        for a, b, new in edits:
            copy(done, a)
            parts += (self.text[done:a], new)
            if new:
                at.append(size)
                low.append(self._start(a))
                high.append(self._end(b))
                copied.append(False)
                size += len(new)
            done = b
        copy(done, len(self.text))
        parts.append(self.text[done:])
        self.text = "".join(parts)
        self.at, self.low, self.high, self.copied = at or [0], low or [0], high or [0], copied or [True]


def _is_handle(text: str, end: int) -> bool:
    start = end
    while start and (text[start - 1] in _NAME or text[start - 1] == "."):
        start -= 1
    return _HANDLE.match(text, start, end) is not None


def _name_dots(text: str, floor: int, end: int, dot: str) -> list[tuple[int, int, str]]:
    """Edits for the spelled dots of the name that ends at ``end``, walked label by label as far as labels go."""
    edits: list[tuple[int, int, str]] = []
    while True:
        start = end
        while start > floor and text[start - 1] in _NAME:
            start -= 1
        if start == end:  # no label: what seemed a dot of the name is none
            return edits[::-1] if not edits or edits[-1][0] != end else edits[-2::-1]
        if start > floor and text[start - 1] == ".":
            end = start - 1
            continue
        after = _blanks_before(text, floor, start)
        before = _blanks_before(text, floor, after - len(dot))
        if after == start or not text.endswith(dot, floor, after) or before == after - len(dot):
            return edits[::-1]
        edits.append((before, start, "."))
        end = before


def _blanks_before(text: str, floor: int, end: int) -> int:
    """Where one to three blanks before ``end`` begin; ``end`` without any."""
    start = end
    while start > floor and end - start < 3 and text[start - 1] in " \t":
        start -= 1
    return start


def _address_edits(text: str, disguised: set[int]) -> list[tuple[int, int, str]]:
    """Edits for names and domains around an "at".

    A spelled "at" counts when a dot of its domain is spelled or was ``disguised`` by brackets, or when the name before it
    is no plain word; an @ when a dot after it is spelled.
    """
    edits, done = [], 0
    for at in _ANY_AT.finditer(text):
        word = at["word"]
        if at.start() < done or not (domain := _ADDRESS_DOMAIN[word].match(text, at.end())):
            continue
        dots = [(*d.span(), ".") for d in _SPELLED_DOT.finditer(text, *domain.span())]
        if not dots and (word is None or not (any(i in disguised for i in range(*domain.span())) or _is_handle(text, at.start()))):
            continue
        if word:
            edits += _name_dots(text, done, at.start(), AT_DOT[word])
        edits += [(*at.span(), "@")] if word else []
        edits += dots
        done = domain.end()
    return edits


def _with_blanks(text: str, a: int, b: int) -> tuple[int, int]:
    """A bracket and one blank on either side of it."""
    return a - (a > 0 and text[a - 1] in " \t"), b + (b < len(text) and text[b] in " \t")


def _bracket_edits(text: str, low: str) -> list[tuple[int, int, str]]:
    edits, done = [], 0
    for m in _BRACKETED.finditer(low):
        a, b = _with_blanks(text, *m.span())
        edits.append((max(a, done), b, "@" if m["at"] else "."))
        done = b
    return edits


def _digit_edits(low: str) -> list[tuple[int, int, str]]:
    """Runs of three or more number words, with a plus word before them."""
    edits = []
    for m in _SPELLED_RUN.finditer(low):
        words = list(_SPELLED_WORD.finditer(low, *m.span()))
        start = m.start()
        for plus in PLUS_WORDS:
            before = low[max(0, start - len(plus) - 1) : start]
            if before.rstrip() == plus:
                start -= len(plus) + 1
                edits.append((start, start + len(plus) + 1, "+"))
        edits.append((m.start(), m.end(), "".join(_DIGIT_OF.get(w.group(), "") for w in words)))
    return edits


def normalise(text: str) -> Normalised:
    out = Normalised(text)
    if not text.isascii() and _odd()[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any():
        out.edit([(m.start(), m.end(), "") for m in re.finditer(f"[{INVISIBLE}]", out.text)])
        out.text = out.text.translate(_alike())  # one character for one: places stay
    low = _lower(out.text)
    steps = (
        lambda: _bracket_edits(out.text, low),
        lambda: [(*d.span(), ".") for m in _SPELLED_NUMBER.finditer(low) for d in _SPELLED_DOT.finditer(low, *m.span())],
        lambda: _address_edits(low, out.edited()),
        lambda: _digit_edits(low),
        lambda: [(*m.span(), "+") for m in _SPELLED_PLUS.finditer(low)],
        lambda: [(i, i + 1, _DIGIT_LIKE[out.text[i]]) for m in _MIXED_DIGITS.finditer(out.text) for i in range(*m.span()) if out.text[i] in _DIGIT_LIKE],
    )
    dots = any(f"{b}{w}" in low for w in DOT_WORDS for b in " \t")
    ats = any(f"{b}{w}" in low for w in AT_WORDS for b in " \t")
    for step, needed in zip(steps, (True, dots, dots or ats, True, any(w in low for w in PLUS_WORDS), True), strict=True):
        if needed and (edits := step()):
            out.edit(edits)
            low = _lower(out.text)
    return out


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans; both by kind and start."""
    base = detect(text)
    plain = normalise(text)
    if plain.text == text:
        return base, base
    added, held = [], {k: [s for s in base if s[0] == k] for k in KINDS}
    starts = {k: [s[1] for s in spans] for k, spans in held.items()}
    for kind, a, b in detect(plain.text):
        start, end = plain.back(a, b)
        before = bisect_left(starts[kind], end)  # base spans of a kind do not overlap: only the last of these can reach in
        if text[start:end] == plain.text[a:b] or before and held[kind][before - 1][2] > start:
            continue
        added.append((kind, start, end))
    everything = sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return base, everything


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text", 1 << 22):
            found = [find(t or "") for t in part.column("text").to_pylist()]
            counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS]
            digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
            spans = [written(every) for _, every in found]
            added = [len(every) - len(base) for base, every in found]
            columns = [part.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, their digest, all spans, and how many were added."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(_scan, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long")


def mask(text: str, fill: str = "*") -> str:
    """The text with every span, base or added, replaced character by character."""
    out = list(text)
    for _, a, b in find(text)[1]:
        out[a:b] = fill * (b - a)
    return "".join(out)
