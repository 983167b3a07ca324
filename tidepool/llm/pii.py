"""PII: base patterns, and disguised identifiers found on normalised text.

The base spans are matched on the text as it stands: emails, IPv4 addresses,
card numbers (Luhn) and international phone numbers, leftmost and
non-overlapping per kind.

Disguises are undone by two transducers that keep, for every character they
emit, the source characters it stands for: the first maps homoglyphs and other
scripts' digits to ASCII one to one and drops zero-width characters; the
second rewrites tokens ("[at]", "(dot)", "x at y dot com", "x @ y . com", with
any form of the at sign before any form of the dots, domains of any number of labels, and runs of digits spelled in
four languages, "dot" between them included). The same patterns then run on the normalised text, and each hit that
holds a rewritten character is mapped back to its source span and added,
unless it lies in a base span of its kind. Base spans always stay.

Texts without any character or word that the transducers rewrite are not
normalised. All matching is linear in the text's length.

Edge cases: a null text counts as empty; offsets are code points, end
exclusive; repeated rows get equal results; an empty table gives an empty one;
other columns are never read.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.session import ship_package

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# --- base patterns (fixed values: the contract's patterns; a match can only
# start where the look-behind allows, so no run is scanned twice) ---
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def spans_of(text: str) -> list[Span]:
    """All base spans, in the order of KINDS."""
    out = emails(text) if "@" in text else []
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# --- first transducer: characters ---
# Letters of other scripts that look like an ASCII letter.
CYRILLIC = dict(zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТХІЈЅ", "aeopcyxijshdqwABEKMHOPCTXIJS"))
GREEK = dict(zip("οαινρυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "oaivpuABEZHIKMNOPTYX"))
SIGNS = {"。": ".", "․": ".", "‐": "-", "‑": "-", "−": "-", " ": " ", "﹫": "@"}
DROPPED = "­​‌‍⁠﻿"


def char_map() -> dict[int, str]:
    """One to one, but for the dropped ones; full-width forms and digits by rule."""
    out = {code: chr(code - 0xFEE0) for code in range(0xFF01, 0xFF5F)}
    out |= {code: str(unicodedata.decimal(chr(code))) for code in range(0x80, 0x1FBFA) if unicodedata.decimal(chr(code), None) is not None}
    out |= {ord(c): v for table in (CYRILLIC, GREEK, SIGNS) for c, v in table.items()}
    return out | {ord(c): "" for c in DROPPED}


CHARS = char_map()


def classed(codes) -> str:
    """A regex class of the code points, as ranges."""
    codes, out = sorted(codes), []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out) + "]"


ODD_CHAR = re.compile(classed(CHARS))

# --- second transducer: tokens ---
# Digit names (English, German, Spanish, French).
DIGIT_NAMES = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
               "eight": "8", "nine": "9",
               "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
               "acht": "8", "neun": "9",
               "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
               "ocho": "8", "nueve": "9",
               "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8",
               "neuf": "9"}
# Words for the at sign and the dot (English, German, Spanish, French).
AT_WORDS = "at|arroba|arobase"
DOT_WORDS = "dot|punkt|punto|point"
NAME = "|".join(sorted(DIGIT_NAMES, key=len, reverse=True))
OPEN, CLOSE = r"[ ]?[\[({<][ ]?", r"[ ]?[\])}>][ ]?"
LABEL = "[A-Za-z0-9-]++"
BRACKETED = rf"{OPEN}(?:{DOT_WORDS}|\.){CLOSE}"
DOTS = rf" (?:{DOT_WORDS}) | \. |{BRACKETED}"
END = r"(?![A-Za-z0-9])"
# After "x at ", which is said of many things, a domain has worded or bracketed dots, or plain ones before a last label
# of letters, or spaced ones before a label that is no word.
# Last labels that stand after a spaced dot, and before none (that one ends the sentence).
LAST = "biz|ch|com|de|edu|es|eu|fr|gov|info|io|net|nl|org|pl|uk"
# A last label in one case: "at noon.Then" is the end of a sentence.
WORDED = (rf"(?:{LABEL}(?:(?:{DOTS}|\.){LABEL})*(?: (?:{DOT_WORDS}) |{BRACKETED}){LABEL}{END}"
          rf"|{LABEL}(?:\.{LABEL})*\.(?-i:[a-z]{{2,63}}|[A-Z]{{2,63}}){END}"
          rf"|{LABEL}(?:(?:{DOTS}|\.){LABEL})* \. (?:{LAST}){END})")
# After "(at)" and " @ " dots may have any form. After an "@" as it stands, the first one is no plain dot: then it is a
# base span, and what follows it is text.
OPEN_END = "".join(rf"(?<![ .\])}}>]{last})" for last in LAST.split("|"))
MORE = rf"(?:(?: (?:{DOT_WORDS}) |{OPEN_END} \. |{BRACKETED}|\.){LABEL})*{END}"
SPACED = rf"{LABEL}(?:{DOTS}|\.){LABEL}{MORE}"
STANDING = rf"{LABEL}(?:{DOTS}){LABEL}{MORE}"
TOKENS = re.compile(
    rf"(?P<at>{OPEN}(?:{AT_WORDS}|@){CLOSE})|(?P<dot>{BRACKETED})"
    rf"|(?<=[A-Za-z0-9])(?P<plain_at> (?:(?:{AT_WORDS}) (?={WORDED})|@ (?={SPACED})))"
    rf"|(?<=[A-Za-z0-9._%+-])(?P<standing>@)(?={STANDING})"
    rf"|(?P<digits>(?<![A-Za-z0-9])(?:plus )?(?:(?:{NAME})(?![A-Za-z])|[0-9])"
    rf"(?:[ -]?(?:(?<![A-Za-z])(?:{NAME})(?![A-Za-z])|dot(?![A-Za-z])|point(?![A-Za-z])|[0-9])){{3,}})",
    re.IGNORECASE)
DOMAIN_AHEAD = {"at": re.compile(SPACED, re.IGNORECASE), "@": re.compile(SPACED, re.IGNORECASE),
                "worded": re.compile(WORDED, re.IGNORECASE), "standing": re.compile(STANDING, re.IGNORECASE)}
TRIGGER = re.compile(
    rf"[\[({{<] ?(?:{AT_WORDS}|{DOT_WORDS}|@|\.) ?[\])}}>]| (?:{AT_WORDS}) {LABEL}(?: (?:{DOT_WORDS}) | \. |\.){LABEL}"
    rf"|@{LABEL}(?: (?:{DOT_WORDS}) | \. )[A-Za-z0-9-]| @ |(?<![A-Za-z])(?:{NAME})[ -]?(?:{NAME}|dot|point|[0-9])|[0-9] ?(?:dot|point|{NAME})(?![A-Za-z])",
    re.IGNORECASE)
SPELLED = re.compile(rf"(?P<plus>plus )|(?P<gap>(?<=[A-Za-zé])[ -](?=(?:{NAME})(?![A-Za-z])))|(?P<name>{NAME})|(?P<dot>[ ]?(?:dot|point)[ ]?)|(?P<other>.)", re.IGNORECASE | re.DOTALL)
DOT_WORD = re.compile(rf" (?:{DOT_WORDS}|\.) (?=[A-Za-z0-9-])", re.IGNORECASE)


class Tape:
    """Emitted text, and for each character its source [start, end)."""

    def __init__(self):
        self.chars: list[str] = []
        self.start: list[int] = []
        self.end: list[int] = []

    def put(self, emitted: str, start: int, end: int) -> None:
        for c in emitted:
            self.chars.append(c)
            self.start.append(start)
            self.end.append(end)

    def text(self) -> str:
        return "".join(self.chars)


def normalise_chars(text: str) -> Tape:
    tape = Tape()
    for i, c in enumerate(text):
        tape.put(CHARS.get(ord(c), c), i, i + 1)
    return tape


def normalise_tokens(tape: Tape) -> Tape:
    text, out, at = tape.text(), Tape(), 0

    def copy(a: int, b: int) -> None:
        for k in range(a, b):
            out.put(tape.chars[k], tape.start[k], tape.end[k])

    def swap(emitted: str, a: int, b: int) -> None:
        out.put(emitted, tape.start[a], tape.end[b - 1])

    dots_until = 0

    def undo_dots(before: int) -> None:
        nonlocal at
        while dots_until > at and (d := DOT_WORD.search(text, at, dots_until)) and d.start() < before:
            copy(at, d.start())
            swap(".", d.start(), d.end())
            at = d.end()

    for m in TOKENS.finditer(text):
        if m.start() < at:
            continue
        undo_dots(m.start())
        if m.start() < at:
            continue
        copy(at, m.start())
        at = m.end()
        if m["at"] or m["plain_at"] or m["standing"]:
            if m["standing"]:
                copy(m.start(), m.end())
            else:
                swap("@", m.start(), m.end())
            kind = m.lastgroup if not m["plain_at"] else "@" if "@" in m[0] else "worded"
            rest = DOMAIN_AHEAD[kind].match(text, at)
            dots_until = rest.end() if rest else 0
        elif m["dot"]:
            swap(".", m.start(), m.end())
        else:
            for p in SPELLED.finditer(text, m.start(), m.end()):
                if p["plus"]:
                    swap("+", p.start(), p.end())
                elif p["gap"]:
                    continue  # spelled digits that follow each other are one number
                elif p["name"]:
                    swap(DIGIT_NAMES[p["name"].lower()], p.start(), p.end())
                elif p["dot"]:
                    swap(".", p.start(), p.end())
                else:
                    copy(p.start(), p.end())
    undo_dots(len(text))
    copy(at, len(text))
    return out


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans of the source that match once normalised, beyond the base ones."""
    if not ODD_CHAR.search(text) and not TRIGGER.search(text):
        return []
    tape = normalise_tokens(normalise_chars(text))
    out = []
    normal = tape.text()
    for kind, a, b in spans_of(normal):
        start, end = tape.start[a], tape.end[b - 1]
        if text[start:end] != normal[a:b] and not any(k == kind and s <= start and end <= e for k, s, e in base):
            out.append((kind, start, end))
    return out


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans), each by start and kind."""
    text = text or ""
    base = spans_of(text)
    return in_order(base), in_order(disguised(text, base))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


FOUND = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def row_of(text: str | None) -> tuple:
    base, added = find(text)
    counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
    return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(in_order(base + added)), len(added))


def spans(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id and text) with the columns of FOUND."""
    ship_package(docs.sparkSession)

    @F.pandas_udf(FOUND)
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([row_of(t) for t in texts], columns=[c.split()[0] for c in FOUND.split(", ")])

    return docs.select("doc_id", of(F.col("text")).alias("f")).select("doc_id", "f.*")


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by its kind in angle brackets."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([masked(t) for t in texts], dtype=object)

    names = docs.columns
    packed = docs.select(F.struct("*").alias("_doc"), of(F.col("text")).alias("_text"))
    return packed.select(*[F.col("_text").alias("text") if c == "text" else F.col("_doc").getField(c).alias(c) for c in names])


def masked(text: str | None) -> str | None:
    if text is None:
        return None
    base, added = find(text)
    out, at = [], 0
    for kind, a, b in in_order(base + added):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])
