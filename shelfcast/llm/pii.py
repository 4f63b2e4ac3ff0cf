"""Personal data with offset-preserving deobfuscation.

Four kinds of identifiers are found in the text as it stands (the base spans) and
in a normalised copy. The copy is made by a transducer of rewriting rules:
lookalike letters and digits of other scripts become ASCII, invisible characters
go, "[at]", "(dot)" and "name at host dot com" become @ and ".", runs of spelled
digits become digits and "plus" before a number becomes "+". The transducer keeps,
for every character it writes, the source span it came from, so a span found in
the copy maps back to source characters. A mapped span is added if a rewriting
took part in it and no base span of its kind covers it.

Patterns run in linear time on any text: an email is looked for around each @, and
runs of digits are entered at their start only.

Defined results: null and empty texts hold nothing; offsets count code points, end
exclusive; masking replaces overlapping spans by one mark, of the kind that begins
first. Repeated rows are treated alike. Only the named columns are read.
"""
from __future__ import annotations

import re
from bisect import bisect_right

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")

# Lookalikes (source characters above the ASCII ones they imitate).
LOOKALIKES = dict(zip(
    "АВЕКМНОРСТУХаеорсухіјѕԁ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονικα" "＠．＋－（）０１２３４５６７８９" "٠١٢٣٤٥٦٧٨٩" "۰۱۲۳۴۵۶۷۸۹" "०१२३४५६७८९" "․。–‐‑−",
    "ABEKMHOPCTYXaeopcyxijsd" "ABEZHIKMNOPTYXovika" "@.+-()0123456789" "0123456789" "0123456789" "0123456789" "..----",
    strict=True)) | {chr(c): chr(c - 0xFEE0) for r in (range(0xFF21, 0xFF3B), range(0xFF41, 0xFF5B)) for c in r}
INVISIBLE = "".join(map(chr, (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)))
# Digits, at and dot in the languages of the corpus (en, de, fr, es).
DIGIT_WORDS = {w: str(d) for d, words in enumerate((
    "zero oh null zéro cero", "one eins un uno", "two zwei deux dos", "three drei trois tres",
    "four vier quatre cuatro", "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete",
    "eight acht huit ocho", "nine neun neuf nueve")) for w in words.split()}
AT_WORDS, DOT_WORDS = ("at", "arroba", "arobase"), ("dot", "punkt", "point", "punto")

_AT, _DOT = (f"(?i:{'|'.join(words)})" for words in (AT_WORDS, DOT_WORDS))
_DIGIT = f"(?i:{'|'.join(sorted(DIGIT_WORDS, key=len, reverse=True))})"
_NAME = r"[A-Za-z0-9][A-Za-z0-9-]{0,62}"
_GAP = r"\s{1,3}"  # a short run of white space stands around at and dot
_AFTER_DOT = f"(?i:{'|'.join(rf'(?<={w}{r'\s' * n})' for w in DOT_WORDS for n in (1, 2, 3))})"
_CHAR = f"[{re.escape(''.join(LOOKALIKES))}]"
RULES = re.compile("|".join((
    rf"(?P<char>{_CHAR})", rf"(?P<gone>[{INVISIBLE}])",
    rf"\s{{0,3}}[\[({{<]\s{{0,3}}(?:(?P<at>{_AT}|@)|(?P<dot>{_DOT}|\.))\s{{0,3}}[\])}}>]\s{{0,3}}",
    rf"(?P<bare>\s(?<=[A-Za-z0-9]\s)\s{{0,2}}{_AT}{_GAP}(?={_NAME}{_GAP}{_DOT}{_GAP}(?!{_DOT}\b){_NAME}))",
    rf"(?P<baredot>\s(?<=[A-Za-z0-9]\s)\s{{0,2}}{_DOT}{_GAP}(?=[A-Za-z0-9]))",
    rf"\b(?P<plus>(?i:plus)[ ])(?=[0-9]|{_DIGIT}\b)",
    rf"\b(?={_DIGIT}\b)(?P<spelled>{_DIGIT}\b(?:[ -]{_DIGIT}\b){{2,}}|{_DIGIT}\b(?:[ -]{_DIGIT}\b)?(?={_GAP}{_DOT}{_GAP}(?:[0-9]|{_DIGIT}\b))"
    rf"|{_AFTER_DOT}{_DIGIT}\b(?:[ -]{_DIGIT}\b)?)")))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append(("email", start, end := m.end()))
        at = text.find("@", max(at + 1, end))
    return out


def spans_of(text: str) -> list[Span]:
    """The spans of all kinds, in the order of KINDS and then of their starts."""
    out = emails(text) if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (g.lstrip("0") for g in m.groups())):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if 13 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


class Normalised:
    """A rewritten text and, segment by segment, where it came from."""

    def __init__(self, source: str):
        self.source, self.pieces = source, []
        self.at: list[int] = []       # start of each segment in the copy
        self.origin: list[tuple[int, int, bool]] = []  # its source span; whether it was rewritten
        self.size = 0
        done = 0
        self.rewritten = False
        for m in RULES.finditer(source):
            self._add(source[done:m.start()], done, m.start(), False)
            done, self.rewritten = m.end(), True
            if m["char"]:
                self._add(LOOKALIKES.get(m[0], m[0]), m.start(), m.end(), True)
            elif m["at"] or m["bare"]:
                self._add("@", m.start(), m.end(), True)
            elif m["dot"] or m["baredot"]:
                self._add(".", m.start(), m.end(), True)
            elif m["plus"]:
                self._add("+", m.start(), m.end(), True)
            elif m["spelled"]:
                for w in re.finditer(r"\w+", m[0]):
                    a = m.start() + w.start()
                    self._add(DIGIT_WORDS.get(w[0].lower(), w[0]), a, a + len(w[0]), True)
        self._add(source[done:], done, len(source), False)
        self.text = "".join(self.pieces)

    def _add(self, piece: str, start: int, end: int, rewritten: bool) -> None:
        if piece:
            self.pieces.append(piece)
            self.at.append(self.size)
            self.origin.append((start, end, rewritten))
            self.size += len(piece)

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """The source span of a span of the copy, and whether a rewriting took part."""
        i, j = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        a, _, first = self.origin[i]
        _, b, last = self.origin[j]
        if not first:
            a += start - self.at[i]
        if not last:
            b = self.origin[j][0] + end - self.at[j]
        # invisible characters leave no segment, but a gap between two
        changed = any(r for _, _, r in self.origin[i:j + 1]) or b - a != end - start
        return a, b, changed


def detect(text: str | None) -> tuple[list[Span], list[Span]]:
    """The base spans and all spans (base and added), each in order of kind and start."""
    text = text or ""
    base = spans_of(text)
    copy = Normalised(text)
    if not copy.rewritten:
        return base, base
    added = []
    for kind, start, end in spans_of(copy.text):
        a, b, changed = copy.back(start, end)
        if changed and not any(k == kind and s <= a and b <= e for k, s, e in base):
            added.append((kind, a, b))
    return base, sorted({*base, *added}, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def written_out(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in angle brackets."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])
