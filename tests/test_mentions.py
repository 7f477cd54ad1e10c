import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lithos.operators import mentions
from lithos.operators.mentions import Shards
from lithos.operators.trie import Trie, longest_only


def brute(texts, aliases):
    return sorted((r, i, n, " ".join(w[i : i + n])) for r, w in texts if w for i in range(len(w)) for n in range(1, len(w) - i + 1) if None not in w[i : i + n] and " ".join(w[i : i + n]) in aliases)


def uncovered(hits):
    return [h for h in hits if not any(o[0] == h[0] and o[2] > h[2] and o[1] <= h[1] and h[1] + h[2] <= o[1] + o[2] for o in hits)]


words = st.lists(st.sampled_from(["a", "b", "c", "d", None]), max_size=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), words), max_size=5), st.sets(st.lists(st.sampled_from("abce"), min_size=1, max_size=4).map(" ".join), max_size=12))
def test_walk_against_brute_force(texts, aliases):
    trie = Trie(sorted(aliases))
    found = trie.walk(pa.array(texts, pa.list_(pa.string())))
    hits = [(int(r), int(i), int(n), trie.aliases[k]) for r, i, n, k in zip(*found)]
    assert hits == sorted(hits) == brute(list(enumerate(texts)), aliases)
    keep = longest_only(*found[:3])
    assert [h for h, k in zip(hits, keep) if k] == uncovered(hits)
    row, at, n, k = trie.walk(pa.array(texts, pa.list_(pa.string())), anywhere=False)
    assert [(int(r), int(i), int(m)) for r, i, m in zip(row, at, n)] == [h[:3] for h in hits if h[1] == 0]


def test_walk_of_a_slice():
    texts = pa.array([["x"], ["a", "b"], ["b"]], pa.list_(pa.string())).slice(1)
    assert [x.tolist() for x in Trie(["a b", "b"]).walk(texts)] == [[0, 0, 1], [0, 1, 0], [2, 1, 1], [0, 1, 1]]
    assert all(len(x) == 0 for x in Trie([]).walk(texts)) and len(longest_only(*[np.zeros(0, np.int64)] * 3)) == 0


@pytest.fixture(scope="module")
def case(spark):
    rnd = random.Random(3)
    vocab = ["the", "spike", "of", "viral", "x", "é", "ω"]
    some = lambda k: [rnd.choice(vocab[: rnd.choice([2, 7])]) for _ in range(k)]
    aliases = {" ".join(some(rnd.choice([1, 2, 2, 3, 5]))) for _ in range(150)} | {"the " + f"t{i}" for i in range(300)} | {"only", " ".join(["the"] * 300)}
    texts = [(i, some(rnd.randrange(40))) for i in range(150)] + [(200, None), (201, []), (202, ["the", None, "spike"]), (203, ["the"] * 700), (5, ["only", "the", "t7"]), (None, ["only"])]
    texts += [(300 + i, ["the", f"t{i}", "only"]) for i in range(250)]
    docs = spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, w array<string>, alias string")
    lookup = spark.createDataFrame([(a, k) for a in aliases for k in range(1 + (len(a) % 2))] + [(None, 1)], "alias string, id int")
    key = lambda h: (h[0] is not None, *h[:1], *h[1:])
    want = sorted(((r, i, n, a, k) for r, i, n, a in (h for t in texts for h in brute([t], aliases)) for k in range(1 + (len(a) % 2))), key=lambda h: (str(h[0]), h[1:]))
    return docs, lookup, want


def rows(df):
    return sorted(((r.doc_id, r.pos, r.n, r.alias, r.id) for r in df.select("doc_id", "pos", "n", "alias", "id").collect()), key=lambda h: (str(h[0]), h[1:]))


@pytest.mark.parametrize("shards", [Shards(), Shards(aliases=40, slots=64), Shards(aliases=40, windows=50), Shards(aliases=7, windows=3, slots=2)], ids=["one", "many", "salted", "spilled"])
def test_shards_give_what_the_whole_trie_gives(case, shards):
    docs, lookup, want = case
    assert rows(mentions.sharded_mentions(docs, "w", lookup, p=shards)) == want


def test_the_whole_trie_and_the_longest_of_both(case):
    docs, lookup, want = case
    assert rows(mentions.mentions(docs, "w", lookup)) == want
    once = docs.where("doc_id is not null and doc_id <> 5")
    small, large = (mentions.mentions(once, "w", lookup.select("alias").distinct(), only_longest=True, most_aliases=m) for m in (10**6, 1))
    key = lambda df: sorted(map(tuple, df.select("doc_id", "pos", "n", "alias").collect()))
    assert key(small) == key(large) and len(key(small)) > 100


def test_nothing_to_find(case, spark):
    docs, lookup, _ = case
    for d, look in ((docs.limit(0), lookup), (docs, lookup.limit(0))):
        assert mentions.mentions(d, "w", look).count() == 0 and mentions.sharded_mentions(d, "w", look).count() == 0


def test_only_places_that_may_begin_an_alias_are_sent_to_shards(spark, monkeypatch):
    sent, keep = [], mentions.staged
    monkeypatch.setattr(mentions, "staged", lambda df, name: sent.append(df.count()) or keep(df, name) if name == "windows" else keep(df, name))
    docs = spark.createDataFrame([(1, ["a", "x", "a", "b", "c", None, "a"]), (2, ["c", "b", "a"]), (3, None), (4, [])], "doc_id long, w array<string>")
    lookup = spark.createDataFrame([("a b",), ("a b c",), ("c",)], "alias string")
    got = sorted((r.doc_id, r.pos, r.n, r.alias) for r in mentions.sharded_mentions(docs, "w", lookup).collect())
    assert got == [(1, 2, 2, "a b"), (1, 2, 3, "a b c"), (1, 4, 1, "c"), (2, 0, 1, "c")]
    assert sent == [3]
