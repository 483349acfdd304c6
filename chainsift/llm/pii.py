"""Personal data in whole texts, also where it is disguised, as spans of the source text.

A text is searched twice.  First as it is: these are the base spans.  Then a transducer normalises it
(look-alike, full-width, mathematical and circled characters, digits of other scripts, invisible characters, spelled digits,
bracketed or spelled "at" and "dot" in any mix) and writes, along with the normalised text, where each piece came from.  Identifiers found there
that cover a normalised place are mapped back to source characters and added.  Base spans always stay.

Kinds, leftmost and non-overlapping for each kind, failing matches dropped without another try: email, ip (parts at most 255),
card (13 to 19 digits that pass Luhn's test), phone (9 to 15 digits after a plus).  Spans count code points, end exclusive.
All scans are linear in the text, whatever the number of labels, blanks or line breaks inside a disguise.  A plain "at" after a verb or
pronoun that stands before places ("look at example dot com", ``NOT_NAMES``) is no sign.  A spelled point before an address joins the word
before it to the name ("jane dot doe at ...").

Null and empty texts have no spans; repeated rows each get a row; an empty table gives an empty table; columns travel in a struct.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import start, table, text_or_empty

KINDS = ("email", "ip", "card", "phone")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL_SET:
            begin -= 1
        m = _DOMAIN.match(text, at) if begin < at else None
        if m:
            yield begin, m.end()
            last = m.end()
            at = text.find("@", last)
        else:  # nothing before this sign can start a match that passes it
            last = at + 1
            at = text.find("@", last)


def find(text: str) -> list[tuple[int, int, int]]:
    """``(kind number, start, end)`` of all identifiers, in that order."""
    spans = [(0, a, b) for a, b in _emails(text)]
    if "." in text:
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                spans.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                spans.append((3, m.start(), m.end()))
    return spans


# ---------------------------------------------------------------- the normalising transducer

# Characters that look like ASCII ones, each followed by what it stands for.
LOOK_ALIKES = ("аaеeоoрpсcуyхxіiјjѕsԁdһhԛqԝwАAВBЕEКKМMНHОOРPСCТTХXІIЈJЅSУY"
               "αaοoνvρpτtυuιiıiΑAΒBΕEΖZΗHΙIΚKΜMΝNΟOΡPΤTΥYΧX"
               "օoսuհhոnցgյjզqՕOՏSԼL"
               "ӏlкkмmтt"
               "‐-‑-‒-–-—-−-․.。.｡.﹒.﹫@⁺+﬩+")
# Spelled digits.
DIGIT_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")


def _replacements() -> dict[int, str]:
    found = {}
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        kind = unicodedata.category(c)
        if kind == "Nd":
            found[ord(c)] = str(unicodedata.decimal(c))
        elif kind == "Zs":
            found[ord(c)] = " "
        elif kind == "Cf":
            found[ord(c)] = ""
        elif 0xFF01 <= ord(c) <= 0xFF5E:
            found[ord(c)] = chr(ord(c) - 0xFEE0)
        elif unicodedata.decomposition(c).startswith("<"):  # letters in other forms: mathematical, circled, raised and so on
            plain = unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and plain.isascii() and plain.isalpha():
                found[ord(c)] = plain
        else:  # small capitals
            name, _, letter = unicodedata.name(c, "").rpartition(" ")
            if name == "LATIN LETTER SMALL CAPITAL" and len(letter) == 1:
                found[ord(c)] = letter.lower()
    found[0xAD] = ""
    return found | {ord(a): b for a, b in zip(LOOK_ALIKES[::2], LOOK_ALIKES[1::2], strict=True)}


REPLACEMENTS = _replacements()
_REPLACED = {chr(c): new for c, new in REPLACEMENTS.items()}
_DIGIT = "(?ai:" + "|".join(DIGIT_WORDS) + ")"  # ASCII letters of either case only; look-alikes are replaced before
# No repeat is bounded.  Possessive repeats, and starts at the first blank of a run only, keep every scan linear.
_SPELLED = re.compile(rf"(?<![^\W\d_]){_DIGIT}(?:[\s,-]*+(?:{_DIGIT}|[0-9]))+(?![^\W\d_])", re.A)
_ONE_DIGIT = re.compile(rf"({_DIGIT})|[\s,-]+", re.A)
_PLUS = re.compile(rf"(?<![^\W\d_])(?ai:plus)\s++(?=[0-9]|{_DIGIT}(?![^\W\d_]))", re.A)
_INNER = r"[\[({<]\s*+(%s)\s*+[\])}>]\s*+"
_BRACKETED = re.compile(r"(?<!\s)\s*+" + _INNER % "at|dot|[@.]", re.I | re.A)
_LABEL = "[A-Za-z0-9-]++"
_DOT_WORD = r"\s++dot\s++"
_HIDDEN_DOT = r"\s*+" + _INNER.replace("(%s)", r"(?:dot|\.)") + "|" + _DOT_WORD
# a plain "at" needs a domain with a disguised point; an "@" between blanks one that ends in letters
_SPELLED_AT = re.compile(rf"(?<=[A-Za-z0-9])(\s++(at|@)\s++)(?={_LABEL}(?:\.{_LABEL})*+(?:{_HIDDEN_DOT})[A-Za-z0-9-])", re.I | re.A)
_SPACED_SIGN = re.compile(rf"(?<=[A-Za-z0-9])(\s++@\s++)(?=({_LABEL}(?:\.{_LABEL})++))", re.A)
_SPELLED_DOTS = re.compile(rf"(?<=[A-Za-z0-9._%+-])@{_LABEL}((?:\.{_LABEL})*+(?:{_DOT_WORD}{_LABEL}(?:\.{_LABEL})*+)++)", re.I | re.A)
_SPELLED_LOCAL = re.compile(rf"[A-Za-z0-9._%+-]++((?:{_DOT_WORD}[A-Za-z0-9._%+-]++)*+)(@)?", re.I | re.A)
_SPELLED_DOT = re.compile(_DOT_WORD, re.I | re.A)
_DOTTED_DIGITS = re.compile(r"(?<=[0-9])\s++(?ai:dot|point)\s++(?=[0-9])", re.A)
_OCTET = rf"(?:{_DIGIT}|[0-9]++)"
_POINT = r"(?:\.|\s++(?ai:dot|point)\s++)"
_SPELLED_IP = re.compile(rf"(?<![^\W_])(?<!\.){_OCTET}(?:{_POINT}{_OCTET}){{3}}(?![^\W_])", re.A)  # four parts, as addresses have
_IP_PIECE = re.compile(rf"({_DIGIT})|\s++(?ai:dot|point)\s++", re.A)
# Words that stand before a plain "at" in sentences about places and sites ("look at example dot com").
NOT_NAMES = ("look", "looks", "looked", "looking", "see", "seen", "met", "meet", "work", "works", "worked", "working", "be", "is", "are", "was",
             "were", "been", "me", "us", "you", "him", "her", "it", "them", "here", "there", "and", "or", "not", "only", "also", "available",
             "found", "hosted", "located", "based", "live", "lives", "lived", "stay", "arrive", "arrived", "online", "site", "website")
_NOT_NAME = re.compile(r"(?<![A-Za-z0-9._%+-])(?:" + "|".join(NOT_NAMES) + r")\Z", re.I | re.A)
_LONGEST = max(map(len, NOT_NAMES)) + 1

Edit = tuple[int, int, str]


class Mapped:
    """A normalised text with the source span of every piece of it."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.at = self.src = np.zeros(1, np.int64)  # piece starts in this text and in the source
        self.copied = np.ones(1, bool)  # a piece copied as it is, or one put for a whole source span
        self.end = len(text)

    def edited(self, edits: list[Edit]) -> Mapped:
        """The same with non-overlapping, sorted spans of this text replaced."""
        out, pieces, last, n = [], [], 0, 0
        for a, b, new in edits:
            if a > last:
                out.append(self.text[last:a])
                pieces += self._copy(last, a, n)
                n += a - last
            out.append(new)
            if new:
                pieces.append((n, self.source(a), False))
            n += len(new)
            last = b
        if last < len(self.text):
            out.append(self.text[last:])
            pieces += self._copy(last, len(self.text), n)
        new_text = Mapped("".join(out))
        if pieces:
            new_text.at = np.array([p[0] for p in pieces], np.int64)
            new_text.src = np.array([p[1] for p in pieces], np.int64)
            new_text.copied = np.array([p[2] for p in pieces], bool)
        new_text.end = self.end
        return new_text

    def _copy(self, a: int, b: int, n: int) -> list[tuple[int, int, bool]]:
        i = int(np.searchsorted(self.at, a, side="right")) - 1
        k = int(np.searchsorted(self.at, b, side="left"))
        return [(n + max(0, int(self.at[j]) - a), self.source(max(a, int(self.at[j]))), bool(self.copied[j])) for j in range(i, k)]

    def source(self, p: int) -> int:
        """Where position ``p`` begins in the source."""
        i = int(np.searchsorted(self.at, p, side="right")) - 1
        return int(self.src[i]) + (p - int(self.at[i]) if self.copied[i] else 0)

    def source_end(self, p: int) -> int:
        """Where the character before ``p`` ends in the source."""
        i = int(np.searchsorted(self.at, p - 1, side="right")) - 1
        if self.copied[i]:
            return int(self.src[i]) + p - int(self.at[i])
        return int(self.ends[i])

    @cached_property
    def ends(self) -> np.ndarray:
        return np.append(self.src[1:], self.end)

    def changed(self, a: int, b: int) -> bool:
        i = int(np.searchsorted(self.at, a, side="right")) - 1
        k = int(np.searchsorted(self.at, b, side="left"))
        if not self.copied[i:k].all():
            return True
        return bool(self.source_end(b) - self.source(a) != b - a)  # something was left out inside


def _spelled(text: str) -> list[Edit]:
    edits = []
    for m in _SPELLED.finditer(text):
        for d in _ONE_DIGIT.finditer(text, m.start(), m.end()):
            edits.append((d.start(), d.end(), str(DIGIT_WORDS.index(d.group(1).lower())) if d.group(1) else ""))
    return edits


def _octets(text: str) -> list[Edit]:
    """Addresses of four parts with single spelled digits, at least one of whose points is spelled."""
    edits = []
    low = text.lower()
    if "dot" in low or "point" in low:
        for m in _SPELLED_IP.finditer(text):
            found = list(_IP_PIECE.finditer(text, *m.span()))
            if any(d.group(1) for d in found) and not all(d.group(1) for d in found):
                edits += [(*d.span(), str(DIGIT_WORDS.index(d.group(1).lower())) if d.group(1) else ".") for d in found]
    return edits


def _ats(text: str) -> list[Edit]:
    """Each pattern runs only on texts that hold a sign or word which it cannot do without."""
    edits, low = [], text.lower()
    if "dot" in low or any(c in text for c in "[({<"):
        for m in _SPELLED_AT.finditer(text):
            a = m.start()
            if m.group(2) == "@" or not _NOT_NAME.search(text[max(0, a - _LONGEST) : a]):
                edits.append((*m.span(1), "@"))
    if "@" in text:
        for m in _SPACED_SIGN.finditer(text):
            last = m.group(2).rpartition(".")[2]
            if len(last) > 1 and last.isalpha():
                edits.append((*m.span(1), "@"))
    return edits


def _signs(text: str) -> list[Edit]:
    edits, low = [], text.lower()
    if any(c in text for c in "[({<"):
        edits += [(m.start(), m.end(), "@" if m.group(1).lower() in ("at", "@") else ".") for m in _BRACKETED.finditer(text)]
    if "dot" in low or "point" in low:
        edits += [(m.start(), m.end(), ".") for m in _DOTTED_DIGITS.finditer(text)]
    if "plus" in low:
        edits += [(m.start(), m.end(), "+") for m in _PLUS.finditer(text)]
    return edits


def _dots(text: str) -> list[Edit]:
    """Spelled points of domains and of names before the sign."""
    edits = []
    if "@" in text and "dot" in text.lower():
        for m in _SPELLED_DOTS.finditer(text):
            edits += [(d.start(), d.end(), ".") for d in _SPELLED_DOT.finditer(text, *m.span(1))]
        for m in _SPELLED_LOCAL.finditer(text):  # whole chains of words, so that none is read twice
            if m.group(2) and m.group(1):
                edits += [(d.start(), d.end(), ".") for d in _SPELLED_DOT.finditer(text, *m.span(1))]
    return edits


def _apart(edits: list[Edit]) -> list[Edit]:
    out: list[Edit] = []
    for e in sorted(edits):
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


def normalise(text: str) -> Mapped:
    """Characters first, then spelled digits, parts of spelled addresses, signs (plain "at", all others, "dot" in domains and
    names): six transducers in a row, offsets composed."""
    m = Mapped(text)
    if not text.isascii() and not _REPLACED.keys().isdisjoint(set(text)):
        m = m.edited([(k, k + 1, _REPLACED[c]) for k, c in enumerate(text) if c in _REPLACED])
    edits = _spelled(m.text)
    if edits:
        m = m.edited(edits)
    for signs in (_octets, _ats, _signs, _dots):
        edits = _apart(signs(m.text))
        if edits:
            m = m.edited(edits)
    return m


def spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and those that only the normalised text shows."""
    base = find(text)
    m = normalise(text)
    if m.text is text or m.text == text:
        return base, []
    known = set(base)
    added = {(k, m.source(a), m.source_end(b)) for k, a, b in find(m.text) if m.changed(a, b)}
    return base, sorted(added - known)


def _said(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in found)


_OUT = "n_email long, n_ip long, n_card long, n_phone long, base string, spans string, n_added long"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for text in b.column(1):
            base, added = spans(text.as_py())
            rows.append((*[sum(k == kind for k, _, _ in base) for kind in range(4)], _said(base), _said(sorted(base + added)), len(added)))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *[pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)]], ["row", *[x.split()[0] for x in _OUT.split(", ")]])


def find_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(row, n_email, n_ip, n_card, n_phone, base, spans, n_added)`` for every row; the counts are of base spans."""
    start(docs.sparkSession)
    rows = docs.select(F.struct(*[c for c in docs.columns if c != text_col] or [F.lit(None).cast("int").alias("none")]).alias("row"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(_scan, f"row {rows.schema['row'].dataType.simpleString()}, {_OUT}")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")
