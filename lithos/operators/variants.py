"""Genetic variants and viral lineages in text: phrasings, normal forms and offsets.

A phrasing is written with slots: {AA}, {aa} and {name} for amino acids by three letters, one letter
and full name, {AA2}, {aa2} and {name2} for what they change to, {aa3} and {aa4} for other alleles, {b}, {b2}, {bases}
and {bases2} for nucleotides, {n}, {n2} for places in a protein and {at}, {at2} for places in a gene.
Blanks may be left out of a text or be longer, and signs other than "/" may have blanks around them.

Each document is one scan by a scalar function over Arrow batches. One pass cuts it into islands: stretches made of nothing but
what a phrasing can hold. Within an island the anchors that are there (names, codes, words, signs) say which phrasings can match
at all; those run from long to short, and a match claims its span, which no SQL expression states.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Amino acids by three letters, by name, and what ends a protein.
AMINO = {
    "ala": "A", "arg": "R", "asn": "N", "asp": "D", "cys": "C", "glu": "E", "gln": "Q", "gly": "G", "his": "H", "ile": "I",
    "leu": "L", "lys": "K", "met": "M", "phe": "F", "pro": "P", "ser": "S", "thr": "T", "trp": "W", "tyr": "Y", "val": "V",
}
NAMES = {
    "alanine": "A", "cysteine": "C", "asparticacid": "D", "glutamicacid": "E", "phenylalanine": "F", "glycine": "G", "histidine": "H",
    "isoleucine": "I", "lysine": "K", "leucine": "L", "methionine": "M", "asparagine": "N", "proline": "P", "glutamine": "Q",
    "arginine": "R", "serine": "S", "threonine": "T", "valine": "V", "tryptophan": "W", "tyrosine": "Y",
}
ENDS = {"stop": "X", "ter": "X", "x": "X", "*": "*"}
LETTERS = "ABCDEFGHIKLMNPQRSTVWYZ"
# Lineages under the name they are shown by.
LINEAGES = {
    "B.1.1.7": "B.1.1.7 (UK)",
    "501Y.V1": "B.1.1.7 (UK)",
    "20I/501Y.V1": "B.1.1.7 (UK)",
    "20B/501Y.V1": "B.1.1.7 (UK)",
    "202012/01": "B.1.1.7 (UK)",
    "B.1.351": "B.1.351 (South Africa)",
    "501Y.V2": "B.1.351 (South Africa)",
    "20H/501Y.V2": "B.1.351 (South Africa)",
    "P.1": "P.1 (Brazil)",
}
NAME = "|".join(NAMES)
THREE = "|".join(AMINO)
# Each slot's pattern and a sample, whose length ranks phrasings.
SLOTS = {
    "name": (f"(?P<from>{NAME})", "THREONINE"),
    "name2": (f"(?P<to>{NAME})", "METHIONINE"),
    "AA": (f"(?P<from>{THREE})", "THR"),
    "AA2": (rf"(?P<to>{THREE}|X|\*|ter|stop)", "MET"),
    "aa": (f"(?P<from>[{LETTERS}])", "T"),
    "aa2": (rf"(?P<to>[{LETTERS}X*]|stop)", "M"),
    "aa3": (f"[{LETTERS}X*]", "E"),
    "aa4": (f"[{LETTERS}X*]", "V"),
    "n": ("(?P<n>[1-9][0-9]*)", "790"),
    "n2": ("(?P<n2>[1-9][0-9]*)", "791"),
    "b": ("(?P<from>[acgt])", "G"),
    "b2": ("(?P<to>[acgt])", "A"),
    "bases": ("(?P<from>[acgt]+)", "GGC"),
    "bases2": ("(?P<to>[acgt]+)", "GAC"),
    "at": (r"(?P<n>[+-]?[1-9][0-9+-]*)", "93"),
    "at2": (r"(?P<n2>[+-]?[1-9][0-9-]*)", "94"),
}


def _one(x: str) -> str:
    low = x.lower()
    return AMINO.get(low) or NAMES.get(low) or ENDS.get(low) or x.upper()


#: Normal forms by kind, from a match's parts.
FORMS = {
    "gene": lambda d: f"c.{d['n']}{d['from'].upper()}>{d['to'].upper()}",
    "genome": lambda d: f"g.{d['n']}{d['from'].upper()}>{d['to'].upper()}",
    "mitochondrion": lambda d: f"m.{d['n']}{d['from'].upper()}>{d['to'].upper()}",
    "base deletion": lambda d: f"c.{d['n']}del{d['from'].upper()}",
    "deletion": lambda d: f"c.{d['n']}_{d['n2']}del",
    "duplication": lambda d: f"c.{d['n']}_{d['n2']}dup",
    "base duplication": lambda d: f"c.{d['n']}dup",
    "protein": lambda d: f"p.{_one(d['from'])}{d['n']}{_one(d['to'])}",
    "frameshift": lambda d: f"p.{_one(d['from'])}{d['n']}fsX",
    "frameshift to": lambda d: f"p.{_one(d['from'])}{d['n']}fsX{d['n2']}",
    "residue deletion": lambda d: f"p.{d['n']}del{_one(d['from'])}",
    "ignored": None,
}
# Phrasings whose matches may overlap others; they claim nothing.
OVERLAP = ("{aa}{n}{aa2}", "{aa}{n}{aa3}/{aa2}", "{aa}{n}{aa3}/{aa4}/{aa2}")
# Phrasings by kind, in their order; of equally long ones the earlier comes first.
PHRASINGS = [
    ("ignored", [
        "{AA}{n}{AA2}{n2}", "{AA}{n}/{AA2}/{n2}", "{AA}{n} to {AA2} {n2}", "{AA}-{n} to {AA2}-{n2}", "{AA}{n}-to-{AA2}-{n2}", "{AA}{n}->{AA2}{n2}", "{AA}{n}-->{AA2}{n2}",
        "{AA}{n}-{AA2}-{n2}", "{AA}{n}----{AA2}{n2}", "{n}{AA}----{AA2}{n2}", "{AA}-{n}-{AA2}-{n2}", "{AA}-{n}{AA2}-{n2}", "{AA}-{n} -> {AA2}-{n2}", "{AA}-{n} --> {AA2}-{n2}",
        "{AA}({n}){AA2}({n2})",
    ]),
    ("protein", ["{aa}{n}{aa2}", "{aa}{n}{aa3}/{aa2}", "{aa}{n}{aa3}/{aa4}/{aa2}"]),
    ("gene", [
        "{b}{at}{b2}", "c.{b}{at}{b2}", "c.{at}{b}>{b2}", "c.{at}{b}/{b2}", "{at}{b}>{b2}", "{b}/{b2}-{at}", "{at}{b}->{b2}", "{at}{b}-->{b2}", "{b}{at}->{b2}", "{b}{at}-->{b2}",
        "{at}{b}-{b2}", "{b} modified {b2} {at}", "{at}{b}/{b2}", "{at},{b}/{b2}", "({at}) {b}/{b2}", "{at} ({b}/{b2})", "{b} to {b2} substitution at nucleotide {at}",
        "{b} to {b2} substitution at position {at}", "{b} to {b2} at nucleotide {at}", "{b} to {b2} at position {at}", "g+{at}{b}>{b2}",
    ]),
    ("base deletion", ["c.{at}del{b}", "c.{at}{b}del", "{at}del{b}", "{at}{b}del"]),
    ("gene", ["{bases}{at}{bases2}"]),
    ("deletion", ["c.{at}-{at2}del", "c.{at}_{at2}del", "{at}-{at2}del", "{at}_{at2}del"]),
    ("base duplication", ["c.{at}dup"]),
    ("duplication", ["c.{at}-{at2}dup", "c.{at}_{at2}dup", "{at}-{at2}dup", "{at}_{at2}dup"]),
    ("genome", ["g.{at}{b}>{b2}"]),
    ("mitochondrion", ["m.{at}{b}>{b2}"]),
    ("protein", [
        "{AA}{n}{AA2}", "{AA}{n}/{AA2}", "{AA}{n} to {AA2}", "{AA}-{n} to {AA2}", "{AA}{n}-to-{AA2}", "{AA}{n}->{AA2}", "{AA}{n}-->{AA2}", "{AA}{n}-{AA2}", "{AA}{n}----{AA2}",
        "{n}{AA}----{AA2}", "{AA}-{n}-{AA2}", "{AA}-{n}{AA2}", "{AA}-{n} -> {AA2}", "{AA}-{n} --> {AA2}", "{AA}({n}){AA2}", "p.{AA}{n}{AA2}", "{AA}-to-{AA2} substitution at position {n}",
        "{AA} {n} is replaced by {AA2}", "{AA} {n} mutated to {AA2}", "{AA} {n} was mutated to {AA2}",
        "{name}-to-{name2} mutation at residue {n}", "{name}-to-{name2} mutation at amino acid {n}", "{name}-to-{name2} mutation at amino acid position {n}",
        "{name}-to-{name2} mutation at position {n}", "{name}-to-{name2} mutation in position {n}",
        "{name}-to-{name2} substitution at residue {n}", "{name}-to-{name2} substitution at amino acid {n}", "{name}-to-{name2} substitution at amino acid position {n}",
        "{name}-to-{name2} substitution at position {n}", "{name}-to-{name2} substitution in position {n}",
        "{name}-to-{name2} alteration at residue {n}", "{name}-to-{name2} alteration at amino acid {n}", "{name}-to-{name2} alteration at amino acid position {n}",
        "{name}-to-{name2} alteration at position {n}", "{name}-to-{name2} alteration in position {n}",
        "{name}-to-{name2} change at residue {n}", "{name}-to-{name2} change at amino acid {n}", "{name}-to-{name2} change at amino acid position {n}",
        "{name}-to-{name2} change at position {n}", "{name}-to-{name2} change in position {n}",
        "{name}-to-{name2} at residue {n}", "{name}-to-{name2} at amino acid {n}",
        "{name} to {name2} mutation at residue {n}", "{name} to {name2} mutation at amino acid {n}", "{name} to {name2} mutation at amino acid position {n}",
        "{name} to {name2} mutation at position {n}", "{name} to {name2} mutation in position {n}",
        "{name} to {name2} substitution at residue {n}", "{name} to {name2} substitution at amino acid {n}", "{name} to {name2} substitution at amino acid position {n}",
        "{name} to {name2} substitution at position {n}", "{name} to {name2} substitution in position {n}",
        "{name} to {name2} alteration at residue {n}", "{name} to {name2} alteration at amino acid {n}", "{name} to {name2} alteration at amino acid position {n}",
        "{name} to {name2} alteration at position {n}", "{name} to {name2} alteration in position {n}",
        "{name} to {name2} change at residue {n}", "{name} to {name2} change at amino acid {n}", "{name} to {name2} change at amino acid position {n}",
        "{name} to {name2} change at position {n}", "{name} to {name2} change in position {n}",
        "{name} to {name2} at residue {n}", "{name} to {name2} at amino acid {n}", "{name} by {name2} at position {n}",
        "{name}-{n}-{name2}", "{name}-{n} -> {name2}", "{name}-{n} --> {name2}", "{name} {n} {name2}", "{name} {n} changed to {name2}", "{name}-{n} {name2}", "{name} {n}-{name2}",
        "{name} {n} to {name2}", "{name} {n} by {name2}", "{n} {name} to {name2}", "{name2} for {name} at amino acid {n}", "{name2} for {name} at position {n}", "{name2} for {name} {n}",
        "{name2}-for-{name} at position {n}", "{name2} for {name} substitution at position {n}", "{name2}-for-{name} substitution at position {n}", "{name2} for a {name} at position {n}",
        "{name2} for an {name} at position {n}", "p.{aa}{n}{aa2}", "p.({aa}{n}{aa2})", "{n}{aa}>{aa2}", "{n}{aa}->{aa2}", "{n}{aa}-->{aa2}", "{aa}{n}->{aa2}", "{aa}{n}-->{aa2}",
    ]),
    ("frameshift", ["{aa}{n}fs"]),
    ("frameshift to", ["p.{aa}{n}fsX{n2}", "p.{AA}{n}fsx{n2}", "{AA}{n}fsx{n2}"]),
    ("residue deletion", ["{AA}{n}del", "p.{aa}{n}del", "p.{n}del{aa}", "{aa}{n}del", "{n}del{aa}"]),
]
PARTS = re.compile(r"\{(\w+)\}|([A-Za-z0-9]+)|( )|(.)")


def pattern(phrasing: str) -> str:
    """The regular expression of a phrasing."""
    out, before = "", ""
    for slot, word, blank, sign in PARTS.findall(phrasing):
        now = "word" if slot or word else "blank" if blank else "slash" if sign == "/" else "sign"
        if {before, now} == {"word", "sign"}:
            out += r"\s*"
        out += SLOTS[slot][0] if slot else r"\s*" if blank else re.escape(word or sign)
        before = now
    return out


@dataclass(frozen=True)
class Phrasing:
    regex: re.Pattern
    text: str
    kind: str
    needs: frozenset[str]


@lru_cache(maxsize=1)
def compiled() -> list[Phrasing]:
    """The phrasings with the longest samples first."""
    every = [(len(PARTS.sub(lambda m: SLOTS[m[1]][1] if m[1] else m[0], p)), p, kind) for kind, ps in PHRASINGS for p in ps]
    return [Phrasing(re.compile(rf"\b{pattern(p)}\b", re.I), p, kind, needs(p)) for _, p, kind in sorted(every, key=lambda x: -x[0])]


def needs(phrasing: str) -> frozenset[str]:
    """The anchors without which a phrasing cannot match: full names, three-letter codes, words of its own, and signs."""
    found = set()
    for slot, word, _, sign in PARTS.findall(phrasing):
        if slot in ("name", "name2", "AA"):
            found.add(slot[:4])
        elif len(word) > 1:  # one letter may be a part of any other word
            found.add(word.lower())
        elif sign:
            found.add(sign)
    return frozenset(found)


def _own(length: range) -> list[str]:
    """Words that phrasings hold beside slots, by length, long ones first."""
    return sorted({w.lower() for _, ps in PHRASINGS for p in ps for _, w, *_ in PARTS.findall(p) if len(w) in length}, key=lambda w: (-len(w), w))


#: Signs that may stand in a match, and blanks.
GAP = frozenset({sign for _, ps in PHRASINGS for p in ps for *_, sign in PARTS.findall(p) if sign} | {"*"})
WORDS = _own(range(2, 100))
#: What a word of a match without a digit is spelled by, lower case; a word of one sign may be a residue.
SPELLED_BY = [*NAMES, *AMINO, "ter", "stop", *WORDS, *"acgt", *_own(range(1, 2))]
ANCHORS = re.compile("".join(f"(?=(?P<{name}>{options}))?" for name, options in [("name", NAME), ("AA", THREE), *((f"w{i}", w) for i, w in enumerate(WORDS))]), re.I)


@lru_cache(maxsize=1 << 16)
def spelled(word: str) -> bool:
    """Whether a word without a digit can stand in a match. One of hundreds of letters is taken to; the phrasings decide."""
    if len(word) == 1 or len(word) > 400:
        return True
    word, reached = word.lower(), {0}
    for i in range(len(word)):
        if i in reached:
            reached |= {i + len(x) for x in SPELLED_BY if word.startswith(x, i)}
    # letters of which some other one is the upper case, as of the long s
    return len(word) in reached or not word.isascii()


def anchors(text: str, lo: int, hi: int) -> set[str]:
    """All anchors in a stretch of text, overlapping ones too."""
    found = GAP & set(text[lo:hi])
    for i in range(lo, hi):
        if text[i].isalpha():
            found |= {k if k in ("name", "AA") else WORDS[int(k[1:])] for k, v in ANCHORS.match(text, i).groupdict().items() if v}
    return found


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around digits of nothing but what can stand in a match: blanks, signs, words with digits or spelled by parts.

    A match holds a digit and is made of whole words, so it lies within one, however many blanks it holds.
    """
    gap = lambda c: c in GAP or c.isspace()
    word = lambda c: c == "_" or c.isalnum()
    now: tuple[int, int] | None = None
    for digits in re.finditer("[0-9]+", text):
        if now and digits.start() < now[1]:
            continue
        floor = now[1] if now else 0
        lo = start = digits.start()
        while lo > floor and word(text[lo - 1]):
            lo -= 1
        while True:  # leftward, blanks and signs, then a word that may belong
            at = lo
            while at > floor and gap(text[at - 1]):
                at -= 1
            start = at
            while start > floor and word(text[start - 1]):
                start -= 1
            if start == at or not (spelled(text[start:at]) or (start == floor and now)):
                break
            lo = start
        lo, hi = at, digits.end()
        while True:  # rightward
            while hi < len(text) and word(text[hi]):
                hi += 1
            at = hi
            while at < len(text) and gap(text[at]):
                at += 1
            end = at
            while end < len(text) and word(text[end]):
                end += 1
            if end == at or not (DIGIT.search(text, at, end) or spelled(text[at:end])):
                break
            hi = end
        hi = at
        if now and lo <= now[1]:
            lo = now[0]
        elif now:
            yield now
        now = lo, hi
    if now:
        yield now


class Claims:
    """Spans of an island that were granted; to those who come later they read as blanks."""

    def __init__(self, text: str, lo: int, hi: int):
        # what stands before and after decides on the ends of words
        past = WORD.match(text, hi)
        self.shift = max(0, lo - 1)
        self.lo, self.hi = lo - self.shift, (past.end() if past else hi) - self.shift
        self.left = text[self.shift : self.hi + self.shift]

    def matches(self, regex: re.Pattern) -> list[tuple[int, int, re.Match]]:
        return [(m.start() + self.shift, m.end() + self.shift, m) for m in regex.finditer(self.left, self.lo, self.hi)]

    def grant(self, spans: list[tuple[int, int]]) -> None:
        for start, end in spans:
            start, end = start - self.shift, end - self.shift
            self.left = self.left[:start] + " " * (end - start) + self.left[end:]


# Fixed patterns of dbSNP ids and lineages.
SNP = re.compile(r"rs\d{2,}")
LINEAGE = [
    re.compile(r"\b[ABCP]\.\d\d?(\.\d+)*\.?\b"),
    re.compile(r"\b(\w+/)?\d+Y\.V\d+\b"),
    re.compile(r"\b((variant of concern|VOC|\(voc\))[-\s]*)+(?P<name>\d+/\d+)\b", re.I),
]
FOUND = "array<struct<start:int,end:int,type:string,text:string,normalized:string>>"


DIGIT, WORD = re.compile("[0-9]"), re.compile(r"\w+")


def find(text: str | None, stop: frozenset[str] = frozenset()) -> list[tuple[int, int, str, str, str]]:
    """(start, end, type, text, normal form) by start.

    A stopword's span is neither found nor claimed; an ignored phrasing's is claimed only. Of several phrasings of one span
    the shorter counts. Of a list of alleles such as T790E/M the last one's span is its slash and letter.
    """
    text = text or ""
    out: dict = {}
    for lo, hi in islands(text) if DIGIT.search(text) else ():
        claims, there = Claims(text, lo, hi), anchors(text, lo, hi)
        for phrasing in compiled():
            if not phrasing.needs <= there:
                continue
            granted = []
            for start, end, m in claims.matches(phrasing.regex):
                if m[0].lower() in stop:
                    continue
                granted.append((start, end))
                if "{aa3}" in phrasing.text:
                    start = end - 2
                if FORMS[phrasing.kind]:
                    parts = m.groupdict()
                    parts["n"] = parts["n"].rstrip("-+")
                    out[start, end] = ("variant", text[start:end], FORMS[phrasing.kind](parts))
            if phrasing.text not in OVERLAP:
                claims.grant(granted)
    found = [(s, e, *v) for (s, e), v in out.items()]
    found += [(*m.span(), "variant", m[0], m[0]) for m in SNP.finditer(text)]
    for regex in LINEAGE:
        for m in regex.finditer(text):
            name = m.groupdict().get("name") or m[0]
            found.append((*m.span(), "lineage", m[0], LINEAGES.get(name, name)))
    return sorted(found)


def variants(docs: DataFrame, text: str, out: str = "variants", stop: list[str] = ()) -> DataFrame:
    """``docs`` with an array of mentions."""
    words = frozenset(w.lower() for w in stop)

    @F.pandas_udf(FOUND)
    def scan(texts: pd.Series) -> pd.Series:
        names = ("start", "end", "type", "text", "normalized")
        return texts.map(lambda t: [dict(zip(names, x)) for x in find(t, words)])

    return docs.withColumn(out, scan(F.col(text)))
