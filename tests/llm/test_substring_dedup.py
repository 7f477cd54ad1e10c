import random

import numpy as np
import pytest

from lithos.llm import substring_dedup as sd
from tests.llm.helpers import components


def draw(rnd, n, size=10**6):
    return [f"v{rnd.randrange(size)}" for _ in range(n)]


def found(spark, rows, p=None):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sd.shared_passages(df, p or sd.Params()).collect()


def linked(rows):
    return {tuple(sorted((r.doc_id, r.other_doc_id))) for r in rows}


def edited(rnd, words, identity, even):
    """A copy with substitutions, evenly spread or at random places."""
    n = round(len(words) * (1 - identity))
    at = [int((i + 0.5) * len(words) / n) for i in range(n)] if even else rnd.sample(range(len(words)), n)
    return [f"e{rnd.randrange(10**6)}" if i in set(at) else w for i, w in enumerate(words)]


def brute(a, b):
    """Whether the best local alignment, a match 1 and anything else -2, is a passage of 50 words at 0.8."""
    a, b = np.array(a), np.array(b)
    score = np.zeros(len(b) + 1)
    # (columns, matches) of the best alignment that ends at each place of b
    size, hits, best = np.zeros(len(b) + 1, int), np.zeros(len(b) + 1, int), (0.0, 0, 0)
    for w in a:
        new, n_size, n_hits = np.zeros_like(score), np.zeros_like(size), np.zeros_like(hits)
        same = b == w
        for j in range(1, len(b) + 1):
            options = [(score[j - 1] + (1 if same[j - 1] else -2), size[j - 1] + 1, hits[j - 1] + same[j - 1]), (score[j] - 2, size[j] + 1, hits[j]), (new[j - 1] - 2, n_size[j - 1] + 1, n_hits[j - 1])]
            top = max(options)
            if top[0] > 0:
                new[j], n_size[j], n_hits[j] = top
                best = max(best, top)
        score, size, hits = new, n_size, n_hits
    return best[1] >= 50 and best[2] >= 0.8 * best[1]


def corpus():
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(3000)]
    pick = lambda n: rnd.choices(vocab, k=n)
    docs, passages = {}, [pick(n) for n in (60, 60, 80, 120)]
    planted = {k: [] for k in range(4)}
    for i in range(120):
        w = pick(rnd.choice([0, 30, 200, 400]))
        if i % 3 == 0:
            k = rnd.randrange(4)
            p = list(passages[k])
            for _ in range(rnd.choice([0, 0, 1, 2])):
                at = rnd.randrange(len(p))
                p[at : at + 1] = rnd.choice([[], ["new"], ["two", "words"]])
            at = rnd.randrange(len(w) + 1)
            w[at:at] = p
            planted[k].append((i, at, at + len(p)))
        docs[i] = w
    return docs, planted


def test_planted_passages_are_found_and_clean_documents_left_alone(spark):
    docs, planted = corpus()
    rows = [(i, ", ".join(w).upper() if len(w) % 2 else " ".join(w), 1) for i, w in docs.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, doc int")
    got = sd.shared_passages(df, sd.Params(block=10)).collect()
    want = {i for spots in planted.values() if len(spots) > 1 for i, _, _ in spots}
    assert {r.doc_id for r in got} | {r.other_doc_id for r in got} == want
    where = {i: (s, e) for spots in planted.values() for i, s, e in spots}
    for r in got:
        s, e = where[r.doc_id]
        assert r.start_word >= s - 4 and r.end_word <= e + 4 and r.end_word - r.start_word >= 50
        assert r.matched <= r.end_word - r.start_word


def test_links_equal_a_brute_force_of_whole_documents(spark):
    rnd = random.Random(21)
    passages = [draw(rnd, n) for n in (55, 70, 90)]
    docs = {}
    for i in range(24):
        w = draw(rnd, rnd.choice([0, 40, 60]), 60)  # frequent words
        if i % 4 < 3:
            part = edited(rnd, passages[i % 3], rnd.choice([0.92, 0.95, 1.0]), False)
            cut = rnd.choice([len(part), len(part), 45, 30])  # some hold a part only
            w += part[:cut] if rnd.random() < 0.5 else part[-cut:]
        docs[i] = w + draw(rnd, 20, 60)
    want = {(i, j) for i in docs for j in docs if i < j and brute(docs[i], docs[j])}
    for pairs in (16, 4):
        got = linked(found(spark, [(i, " ".join(w)) for i, w in docs.items()], sd.Params(pairs=pairs)))
        assert got <= want
        # beyond ``pairs`` holders of all keys a text is linked to its class, not to every other
        assert got == want if pairs == 16 else components(range(24), got) == components(range(24), want)


@pytest.mark.parametrize("hubs", [8, 60])
def test_holders_of_a_part_do_not_hide_those_of_the_whole(spark, hubs):
    rnd = random.Random(2)
    p = draw(rnd, 120)
    rows = [(i, " ".join(draw(rnd, 30) + p[:70] + draw(rnd, 30))) for i in range(hubs)]
    rows += [(100 + i, " ".join(draw(rnd, 30) + p[50:] + draw(rnd, 30))) for i in range(hubs)]
    rows += [(i, " ".join(draw(rnd, 20) + p + draw(rnd, 20))) for i in (900, 901)]
    whole = [r for r in found(spark, rows) if (r.doc_id, r.other_doc_id) == (901, 900)]
    assert [(r.start_word, r.end_word, r.other_start, r.other_end, r.matched) for r in whole] == [(20, 140, 20, 140, 120)]


def test_a_short_common_line_hides_no_passage(spark):
    rnd = random.Random(3)
    line, tails = draw(rnd, 30), [draw(rnd, 30) for _ in range(5)]
    rows = [(i, " ".join(draw(rnd, 40) + line + draw(rnd, 40))) for i in range(80)]
    rows += [(100 + i, " ".join(draw(rnd, 40) + line + tails[i // 2] + draw(rnd, 40))) for i in range(10)]
    assert linked(found(spark, rows)) == {(100 + i, 101 + i) for i in range(0, 10, 2)}


@pytest.mark.parametrize("k", [8, 5])
def test_recall_of_edited_passages(spark, k):
    rnd = random.Random(4)
    rows, kinds, i = [], {}, 0
    for identity in (0.8, 0.85, 0.9, 0.95, 1.0):
        for even in (True, False):
            for _ in range(40):
                p = draw(rnd, 60)
                q = edited(rnd, p, identity, even) if identity < 1 else p
                for part in (p, q):
                    rows.append((i, " ".join(draw(rnd, 50) + part + draw(rnd, 50))))
                    i += 1
                kinds[i - 2, i - 1] = identity, even
    got = linked(found(spark, rows, sd.Params(k=k)))
    assert got <= set(kinds)
    share = {k: sum(p in got for p, kind in kinds.items() if kind == k) / 40 for k in set(kinds.values())}
    assert min(share[1.0, e] for e in (True, False)) == 1 and min(share[0.95, e] for e in (True, False)) == 1
    assert min(share[0.9, e] for e in (True, False)) >= (0.9 if k == 5 else 0.85)
    if k == 5:
        del share[0.8, True]  # every fifth word is another, so no five in a row are left
        assert min(share.values()) >= 0.9
    else:
        print("recall", share)
        assert len(got) >= 0.7 * len(kinds)


def test_copies_nulls_repeats_and_empty(spark):
    rnd = random.Random(1)
    long_text = " ".join(draw(rnd, 70))
    rows = [(1, long_text), (2, long_text), (3, "x " * 400), (4, None), (5, ""), (6, "a b c"), (7, "a b c"), (8, "x " * 300), (None, long_text), (1, long_text)]
    got = found(spark, rows)
    assert [(r.doc_id, r.start_word, r.end_word, r.other_doc_id, r.kind) for r in got] == [(2, 0, 70, 1, "copy")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sd.shared_passages(df.limit(0)).count() == 0


def test_rows_that_repeat_an_id_with_other_texts(spark):
    rnd = random.Random(6)
    a, b = draw(rnd, 150), draw(rnd, 150)
    rows = [(5, " ".join(a)), (5, " ".join(b)), (7, " ".join(a[:120] + draw(rnd, 30))), (9, " ".join(b[20:] + draw(rnd, 30))), (5, " ".join(a))]
    for order in ([0, 1, 2, 3, 4], [1, 3, 4, 2, 0], [2, 4, 3, 1, 0]):
        assert linked(found(spark, [rows[i] for i in order])) == {(5, 7), (5, 9)}


def test_very_long_texts_and_repeated_words(spark):
    rnd = random.Random(7)
    p = draw(rnd, 80)
    spread = [w for x in p for w in [x] * rnd.choice([1, 1, 3])]
    rows = [(1, " ".join(draw(rnd, 30_000) + p + draw(rnd, 10_000))), (2, " ".join(draw(rnd, 10) + spread + draw(rnd, 10)))]
    (r,) = found(spark, rows)
    assert (r.doc_id, r.start_word, r.end_word, r.other_start, r.other_end, r.matched) == (2, 10, 10 + len(spread), 30_000, 30_080, 80)


def test_fenwick_chains_equal_a_quadratic_scan():
    rng = np.random.default_rng(4)
    for _ in range(30):
        pts = sorted({(int(a), int(b)) for a, b in rng.integers(0, 120, (25, 2))})
        x, y = np.array([p[0] for p in pts]), np.array([p[1] for p in pts])
        size = rng.integers(5, 12, len(pts))
        best = []
        for i, (a, b) in enumerate(pts):
            top = float(size[i])
            before = [(best[j] + 0.05 * (pts[j][0] + pts[j][1] + 2 * size[j]), j) for j in range(i) if pts[j][0] < a and pts[j][1] < b]
            if before:
                f, j = max(before)
                over = max(0, pts[j][0] + size[j] - a, pts[j][1] + size[j] - b)
                top = max(top, f + max(0, size[i] - over) - 0.05 * (a + b))
            best.append(top)
        got = sd.chains(x, y, size, 0.05)
        assert abs(got[0][0] - max(best)) < 1e-9
        assert sorted(m for _, path in got for m in path) == list(range(len(pts)))
        assert all((np.diff(x[path]) > 0).all() and (np.diff(y[path]) > 0).all() for _, path in got)


def test_places_of_repeated_runs_go_on_for_longest():
    line = list(range(10))
    a = np.array(line + [50] + line + list(range(51, 61)) + line, np.uint64)
    b = np.array(line + [60] + line + list(range(51, 61)) + [70] + line * 200, np.uint64)
    x, y = sd.best_places(a, b, 5)
    assert len(x) <= 2 * len(a) and {(11 + i, 11 + i) for i in range(12)} <= set(zip(x.tolist(), y.tolist()))


def test_a_better_valued_chain_that_fails_does_not_hide_a_copy(spark):
    rnd = random.Random(5)
    copied = draw(rnd, 62)
    mine = draw(rnd, 200) + copied + draw(rnd, 200)
    decoy = draw(rnd, len(mine))
    for at in range(40, 420, 30):  # identity far below 0.8
        decoy[at : at + 12] = mine[at : at + 12]
    rows = [(1, " ".join(decoy)), (2, " ".join(draw(rnd, 50) + copied + draw(rnd, 50))), (3, " ".join(mine))]
    assert linked(found(spark, rows)) == {(2, 3)}


@pytest.mark.parametrize("others", [20, 60])
def test_stock_phrases_in_one_order_with_words_between(spark, others):
    """Six phrases that each stand in many documents of less id; two texts hold them in a row, one with a word at every joint."""
    rnd = random.Random(13)
    phrases = [draw(rnd, 14) for _ in range(6)]
    rows = [(i * 6 + j, " ".join(draw(rnd, 30) + p + draw(rnd, 30))) for i in range(others) for j, p in enumerate(phrases)]
    whole = [w for p in phrases for w in p]
    spaced = [w for p in phrases for w in [*p, f"joint{rnd.randrange(10**6)}"]]
    rows += [(5000, " ".join(draw(rnd, 20) + whole + draw(rnd, 20))), (5001, " ".join(draw(rnd, 20) + spaced + draw(rnd, 20)))]
    got = found(spark, rows)
    assert linked(got) == {(5000, 5001)} and max(r.matched for r in got) == 84


@pytest.mark.parametrize(("line", "every", "holders", "mirrored"), [(30, 6, 40, False), (30, 6, 40, True), (12, 6, 40, False), (34, 3, 40, False), (34, 3, 40, True), (30, 6, 1200, False)])
def test_links_around_a_common_line_that_share_nothing_else_of_a_seed(spark, line, every, holders, mirrored):
    """Texts of a line that many hold and what follows or goes before it, with edits so dense that no other run of eight words is equal."""
    rnd = random.Random(17)
    common = draw(rnd, line)
    rows = [(i, draw(rnd, 80) + common + draw(rnd, 80)) for i in range(holders)]
    for j in range(4):
        tail = draw(rnd, 66 if every > 3 else 24)
        for side in (0, 1):
            own = [f"x{side}{w}" if i % every == 0 else w for i, w in enumerate(tail)]
            own = common + own
            rows.append((5000 + 2 * j + side, draw(rnd, 90) + (own[::-1] if mirrored else own) + draw(rnd, 90)))
    if mirrored:
        rows = [(i, w[:80] + common[::-1] + w[80 + line :]) if i < 5000 else (i, w) for i, w in rows]
    got = found(spark, [(i, " ".join(w)) for i, w in rows])
    assert linked(got) == {(5000 + 2 * j, 5001 + 2 * j) for j in range(4)}


@pytest.mark.parametrize("size", [24, 48])
def test_a_large_class_beside_a_common_line_gives_rows_in_proportion(spark, size):
    """Near copies that hold a line of which the least holder is no copy: linked, but not each with every other."""
    rnd = random.Random(23)
    line, text = draw(rnd, 12), draw(rnd, 120)
    rows = [(i, draw(rnd, 80) + line + draw(rnd, 80)) for i in range(20)]
    for i in range(size):
        own = [f"x{i}v{j}" if j % 7 == 3 else w for j, w in enumerate(text)]  # no eight words but those with the line
        rows.append((1000 + i, own[:60] + line + own[60:]))
    got = found(spark, [(i, " ".join(w)) for i, w in rows])
    links = linked(got)
    assert components(range(1000, 1000 + size), links) == {i: 1000 for i in range(1000, 1000 + size)} and all(i >= 1000 for pair in links for i in pair)
    assert len(got) <= 4 * size


def test_stretches_have_the_share_and_matches_at_their_ends():
    rnd = random.Random(1)
    p, hits = sd.Params(), 0
    for _ in range(400):
        same = np.array([False] * 20 + [rnd.random() < rnd.choice([0.7, 0.8, 0.9]) for _ in range(rnd.choice([49, 50, 60, 90]))] + [False] * 20)
        sums = np.concatenate([[0], np.cumsum(same)])
        found = sd.segments(same, p)
        hits += len(found)
        assert all(e - s >= p.min_words and same[s] and same[e - 1] and sums[e] - sums[s] >= p.identity * (e - s) - 1e-9 for s, e in found)
        i, j = sd.longest(same, p)
        every = [b - a for a in np.flatnonzero(same) for b in np.flatnonzero(same) + 1 if b > a and sums[b] - sums[a] >= p.identity * (b - a) - 1e-9]
        assert j - i == max(every)
    assert hits > 100
    assert sd.segments(np.array([False] * 5 + [True] * 45 + [False] * 5 + [True] + [False] * 9), p) == []
