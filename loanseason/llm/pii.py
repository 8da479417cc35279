"""Personal data in texts, also in disguise, with spans in the text as it is written."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loanseason.llm.common import without

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like these.
_LOOKALIKES = {
    "a": "аɑα", "b": "Ь", "c": "сϲ", "d": "ԁ", "e": "еє", "g": "ɡ", "h": "һ", "i": "іı", "j": "ј", "k": "κ", "l": "ӏ",
    "m": "м", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "t": "τ", "u": "υս", "v": "ν", "w": "ԝ", "x": "х",
    "y": "у", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν",
    "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "Υ", "Z": "Ζ",
    "-": "‐‑‒–—−", ".": "。․", " ": "     ", "": "​‌‍⁠﻿­",
}
# Digits as words of four languages.
_DIGIT_WORDS = {
    "0": "zero oh null zéro cero", "1": "one eins un uno", "2": "two zwei deux dos", "3": "three drei trois tres",
    "4": "four vier quatre cuatro", "5": "five fünf cinq cinco", "6": "six sechs seis", "7": "seven sieben sept siete",
    "8": "eight acht huit ocho", "9": "nine neun neuf nueve", "+": "plus más",
}


def _plain_signs() -> dict[str, str]:
    """Sign to plain ASCII: the lookalikes, and letters, digits and marks that Unicode calls compatible."""
    signs = {odd: plain for plain, odds in _LOOKALIKES.items() for odd in odds}
    for first, last in ((0xFF01, 0xFF5E), (0x1D400, 0x1D7FF), (0x2460, 0x2468), (0x2070, 0x2089)):
        for code in range(first, last + 1):
            plain = unicodedata.normalize("NFKC", chr(code))
            if len(plain) == 1 and "!" <= plain <= "~":
                signs[chr(code)] = plain
    return signs


_PLAIN = _plain_signs()
_ODD = re.compile("[" + "".join(map(re.escape, _PLAIN)) + "]")
_DIGIT_OF = {word: digit for digit, words in _DIGIT_WORDS.items() for word in words.split()}
_WORD_DIGIT = "|".join(sorted(_DIGIT_OF, key=len, reverse=True))
#: A chain of digits and digit words with gaps of up to two signs. It gives nothing back, so a text is passed once.
#: A digit word with another one or no letter behind it.
_DIGIT_CELL = rf"(?:{_WORD_DIGIT})(?:(?={_WORD_DIGIT})|(?![^\W\d_]))"
_CHAIN = re.compile(rf"(?i)(?<!\w)(?:{_DIGIT_CELL}|[0-9+]++)(?:[ ,.-]{{0,2}}(?:{_DIGIT_CELL}|[0-9+]++))*+")
_CELL = re.compile(rf"(?i){_DIGIT_CELL}|[0-9+]+|[ ,.-]+")
_SPELLED_ONE = re.compile(rf"(?i)(?<!\w)(?:{_WORD_DIGIT})(?!\w)")
_WORD_SIGN = re.compile(r"\w")
_LETTER_DIGIT_HINT = re.compile(r"[0-9][OoIl]")
_LETTER_DIGIT = re.compile(r"(?<=[0-9])[OoIl](?=[ -]?[0-9])")
_DOT = r"(?:\s?[(\[{<]\s?(?:dot|punkt|point|punto|\.)\s?[)\]}>]\s?|\s(?:dot|punkt|punto)\s|\s?\.)"
_AT = r"(?:\s?[(\[{<]\s?(?:at|@|arroba)\s?[)\]}>]\s?|\s(?:at|arroba|@)\s|\s?@\s?)"
_DISGUISED = re.compile(
    rf"(?i)(?<![\w.%+-])((?>[\w.%+-]{{1,64}})(?:(?!\.){_DOT}(?>[\w%+-][\w.%+-]{{0,63}})){{0,4}})({_AT})([a-z0-9-]{{1,63}}(?:{_DOT}[a-z0-9-]{{1,63}}){{1,8}})(?![\w-]|{_AT})"
)
#: Every match of _DISGUISED holds one of these: its at sign, a label, a dot sign and a sign of the next label.
_DISGUISE_HINT = re.compile(
    rf"(?i)[@\s(\[{{<](?:(?<=@)\s?|\s?(?:at|arroba|@)\s?[)\]}}>\s]\s?)[a-z0-9-]{{1,63}}{_DOT}[a-z0-9-]"
)
_DOT_SIGN = re.compile(rf"(?i){_DOT}")
#: What prose writes too: a word, `at`, and a domain with plain dots.
_PROSE = re.compile(r"(?i)[^\W\d_]+\sat\s[a-z0-9-]+(?:\.[a-z0-9-]+)+")


def _emails(text: str) -> Iterator[Span]:
    """Every ``@`` with the run before it and a domain behind it, in one pass over the text."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _addresses(text: str) -> Iterator[Span]:
    """Numbers joined by dots, four at a time from the left."""
    for m in _NUMBERS.finditer(text):
        parts = m[0].split(".")
        start = m.start()
        for k in range(0, len(parts) - 3, 4):
            stop = start + sum(map(len, parts[k : k + 4])) + 3
            if all(map(_byte_sized, parts[k : k + 4])):
                yield "ip", start, stop
            start = stop + 1


def _byte_sized(part: str) -> bool:
    bare = part.lstrip("0")
    return len(bare) <= 3 and int(bare or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost spans of each kind as written; matches that fail their test are dropped."""
    found = list(_emails(text))
    found += _addresses(text)
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(map(str.isdigit, m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    return in_order(found)


def in_order(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


@dataclass
class Rewritten:
    """A text after rewriting, with the source span and a mark of change for each of its signs."""

    text: str
    starts: np.ndarray
    ends: np.ndarray
    changed: np.ndarray

    @classmethod
    def of(cls, text: str) -> Rewritten:
        places = np.arange(len(text))
        return cls(text, places, places + 1, np.zeros(len(text), dtype=bool))

    def apply(self, edits: Iterable[tuple[int, int, str]]) -> Rewritten:
        """Replace spans, in order and without overlap. A deleted sign belongs to the one before it."""
        texts, starts, ends, changed, at = [], [], [], [], 0

        def copy(upto: int) -> None:
            texts.append(self.text[at:upto])
            starts.append(self.starts[at:upto])
            ends.append(self.ends[at:upto])
            changed.append(self.changed[at:upto])

        for start, stop, new in edits:
            copy(start)
            texts.append(new)
            starts.append(np.full(len(new), self.starts[start]))
            ends.append(np.full(len(new), self.ends[stop - 1]))
            changed.append(np.ones(len(new), dtype=bool))
            if not new and starts[-2].size:
                changed[-2] = changed[-2].copy()
                changed[-2][-1] = True
            at = stop
        if not texts:
            return self
        copy(len(self.text))
        return Rewritten("".join(texts), *map(np.concatenate, (starts, ends, changed)))

    def source(self, start: int, stop: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.ends[stop - 1])


def _spelled_runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of three or more digits, one at least as a word, that end where a word can end."""
    for chain in _CHAIN.finditer(text):
        if not _SPELLED_ONE.search(chain[0]):
            continue
        stop, units = None, 0
        for cell in _CELL.finditer(text, chain.start(), chain.end()):
            bare = cell[0].rstrip("+")
            if cell[0][0] in " ,.-":
                continue
            single = cell[0].lower() in _DIGIT_OF
            here = cell.start() + len(bare)
            if bare and units + (1 if single else len(bare)) >= 3 and not _WORD_SIGN.match(text, here):
                stop = here
            units += 1 if single else len(cell[0])
        if stop is not None and _SPELLED_ONE.search(text[chain.start() : stop]):
            yield chain.start(), stop


def _spelled_edits(text: str) -> Iterator[tuple[int, int, str]]:
    """Words of such a run become digits, gaps between its digits go."""
    for start, stop in _spelled_runs(text):
        cells = list(_CELL.finditer(text, start, stop))
        for k, cell in enumerate(cells):
            word = _DIGIT_OF.get(cell[0].lower())
            if word is not None:
                yield cell.start(), cell.end(), word
            elif not cell[0][0].isdigit() and cell[0][0] != "+" and 0 < k < len(cells) - 1:
                yield cell.start(), cell.end(), ""


def _address_edits(text: str) -> Iterator[tuple[int, int, str]]:
    """Written-out at and dot signs, where what is around them reads as an address.

    ``look at example.com`` is prose, whatever else the text holds.
    """
    for m in _DISGUISED.finditer(text):
        if _PROSE.fullmatch(m[0]):
            continue
        for dot in _DOT_SIGN.finditer(text, m.start(1), m.end(1)):
            if dot[0] != ".":
                yield dot.start(), dot.end(), "."
        if m[2] != "@":
            yield m.start(2), m.end(2), "@"
        for dot in _DOT_SIGN.finditer(text, m.start(3), m.end(3)):
            if dot[0] != ".":
                yield dot.start(), dot.end(), "."


def plain_form(text: str) -> Rewritten | None:
    """The text with disguises undone; None if there is nothing to undo."""
    odd = not text.isascii() and not _PLAIN.keys().isdisjoint(set(text))
    spread = bool(_DISGUISE_HINT.search(text))
    spelled = next(_spelled_runs(text), None) is not None
    if not (odd or spread or spelled or _LETTER_DIGIT_HINT.search(text)):
        return None
    first = now = Rewritten.of(text)
    if odd:
        now = now.apply((m.start(), m.end(), _PLAIN[m[0]]) for m in _ODD.finditer(text))
    if odd or spread:
        now = now.apply(list(_address_edits(now.text)))
    if odd or spelled:
        now = now.apply(list(_spelled_edits(now.text)))
    if _LETTER_DIGIT_HINT.search(now.text):
        now = now.apply([(m.start(), m.end(), "0" if m[0] in "Oo" else "1") for m in _LETTER_DIGIT.finditer(now.text)])
    return None if now is first else now


def find_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Spans as written, and all spans with those that show only in the plain form.

    A span of the plain form counts if a sign of it was rewritten and it overlaps no span of its
    kind as written.
    """
    if not text:
        return [], []
    base = base_spans(text)
    plain = plain_form(text)
    if plain is None:
        return base, base
    added = []
    for kind, start, stop in base_spans(plain.text):
        if plain.changed[start:stop].any():
            begin, end = plain.source(start, stop)
            if not any(k == kind and s < end and begin < e for k, s, e in base):
                added.append((kind, begin, end))
    return base, in_order([*base, *added])


def _written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{stop}" for kind, start, stop in spans)


def _result(batch: pa.RecordBatch, names: list[str], at: int) -> pa.RecordBatch:
    base, every = [], []
    for text in batch.column(at).to_pylist():
        mine, all_of = find_spans(text)
        base.append(mine)
        every.append(all_of)
    counts = [pa.array([sum(s[0] == kind for s in spans) for spans in every], pa.int64()) for kind in KINDS]
    digests = [hashlib.sha256(_written(spans).encode()).hexdigest() for spans in base]
    return pa.RecordBatch.from_arrays(
        [
            *batch.columns,
            *counts,
            pa.array(digests, pa.string()),
            pa.array([_written(spans) for spans in every], pa.string()),
            pa.array([len(spans) for spans in base], pa.int64()),
        ],
        names=[*names, *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_base"],
    )


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every input row with the personal data of its text.

    Adds ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (all spans of the kind), ``spans`` (all of
    them as kind:start:end), ``n_base`` and ``base_sha256`` (number and digest of those found
    without undoing disguises). Columns of these names are replaced. Offsets count code points of
    the text as it is; NULL and empty texts have no spans. Every row is judged alone and whole,
    each detector passes over the text once.
    """
    made = [*(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_base"]
    kept = without(docs, *made)
    names, at = kept.columns, kept.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    new = ", ".join(f"n_{kind} long" for kind in KINDS) + ", base_sha256 string, spans string, n_base long"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _result(batch, names, at)

    return kept.mapInArrow(search, f"{schema}, {new}")
