import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lithos.operators import variants as v


def plain(text, stop=frozenset()):
    """All phrasings one after another over the whole text, blanking what they match."""
    left, out = text or "", {}
    for p in v.compiled():
        spans = []
        for m in p.regex.finditer(left):
            if m[0].lower() in stop:
                continue
            spans.append(m.span())
            start = m.end() - 2 if "{aa3}" in p.text else m.start()
            if v.FORMS[p.kind]:
                parts = m.groupdict()
                parts["n"] = parts["n"].rstrip("-+")
                out[start, m.end()] = v.FORMS[p.kind](parts)
        if p.text not in v.OVERLAP:
            for s, e in spans:
                left = left[:s] + " " * (e - s) + left[e:]
    return sorted((s, e, form) for (s, e), form in out.items())


def found(text, stop=frozenset()):
    return [(s, e, form) for s, e, kind, said, form in v.find(text, stop) if kind == "variant" and not said.startswith("rs")]


def sample(phrasing, change=lambda x: x):
    return v.PARTS.sub(lambda m: change(v.SLOTS[m[1]][1]) if m[1] else m[0], phrasing)


FORMS = {
    "gene": "c.93G>A", "base deletion": "c.93delG", "deletion": "c.93_94del", "base duplication": "c.93dup", "duplication": "c.93_94dup", "genome": "g.93G>A", "mitochondrion": "m.93G>A",
    "protein": "p.T790M", "frameshift": "p.T790fsX", "frameshift to": "p.T790fsX791", "residue deletion": "p.790delT",
}


@pytest.mark.parametrize("phrasing", [p for p in v.compiled()], ids=lambda p: p.text)
def test_every_phrasing(phrasing):
    """Alone, among words, in lower case and with wide gaps."""
    text = sample(phrasing.text)
    want = None if phrasing.kind == "ignored" else "c.93GGC>GAC" if "{bases}" in phrasing.text else FORMS[phrasing.kind]
    for said in (text, f"the {text}, and", f"({text.lower()})", text.replace(" ", " " * 300)):
        got = [form for *_, form in found(said)]
        assert got == plain_forms(said)
        if phrasing.needs & {"name", "AA"} and text[0].isalnum() and text[-1].isalnum():  # single letters may be residues or bases; a sign at an end must touch a word
            assert (not got) if want is None else want in got
    assert len(v.compiled()) == 154


def plain_forms(text):
    return [form for *_, form in plain(text)]


PIECES = [sample(p) for _, ps in v.PHRASINGS for p in ps] + ["T", "M", "G", "A", "790", "93", "-", "->", "/", "(", ")", "to", "at position", "mutation", "p.", "c.", "del", "fs", "fsX791", "*", "stop", "THR", "MET", "threonine",
    "methionine", "patients", "cat", "in", "x", "é", "_", ";", "ſtop", "+", ",", " " * 30, "\n", "was mutated to", "T790E/V/M", "atatat", "GtoA", "rs123"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=9), st.lists(st.sampled_from(["", " ", "  "]), min_size=10, max_size=10), st.sampled_from([(), ("t790m",), ("93g>a", "790")]))
def test_one_pass_equals_the_loop(pieces, blanks, stop):
    text = "".join(b + p for p, b in zip(pieces, blanks))
    assert found(text, frozenset(stop)) == [x for x in plain(text, frozenset(stop)) if not text[x[0] : x[1]].startswith("rs")]


def test_among_the_texts_of_a_corpus():
    rnd = random.Random(8)
    prose = "the cat sat on 12 mats, at a change in position; acid test of Val and Ala 7 times (see 3) to 4".split()
    for _ in range(150):
        words = rnd.choices(prose, k=60)
        for _ in range(4):
            at = rnd.randrange(len(words))
            words[at:at] = [rnd.choice(PIECES) for _ in range(rnd.randrange(3))]
        text = rnd.choice([" ", "  "]).join(words)
        assert found(text) == [x for x in plain(text) if not text[x[0] : x[1]].startswith("rs")]


def test_gaps_and_ignored_forms_do_not_depend_on_a_reach():
    for n in (1, 9, 10, 500):
        gap = " " * n
        text = "x" * 200 + f" threonine{gap}-{gap}to{gap}-{gap}methionine{gap}substitution{gap}at{gap}amino{gap}acid{gap}position{gap}790 " + "y" * 200
        assert [form for *_, form in found(text)] == ["p.T790M"], n
    assert found("THR790-to-MET-791") == found("THR790-to-MET791") == []


def test_long_texts_take_linear_time():
    began = time.time()
    for text in ("at" * 50_000 + "1", "z" * 100_000, "1 " * 20_000, "9" * 50_000, " " * 100_000 + "7", "a1 b" * 5_000, "word " * 50_000):
        v.find(text)
    assert time.time() - began < 60


def test_nulls_and_columns(spark):
    rows = [(0, "T790M and rs123, B.1.1.7 x", "k"), (1, None, "k"), (2, "", "k"), (3, "no digit", "k"), (3, "T47D or D614G", "k")]
    df = v.variants(spark.createDataFrame(rows, "id long, text string, start string"), "text", stop=["t47d"])
    assert sorted((r.id, [(m.start, m.normalized) for m in r.variants]) for r in df.collect()) == [
        (0, [(0, "p.T790M"), (10, "rs123"), (17, "B.1.1.7 (UK)")]), (1, []), (2, []), (3, []), (3, [(8, "p.D614G")]),
    ]
