"""Words at edit distance one, by a self-join of the vocabulary's trie, and the forms that rare spellings belong to.

Two words at distance one are equal before the edit and after it. So the vocabulary is dealt out twice: by
what stands in the first half of a word (the edit comes later) and in the last half (it comes earlier).
A share with more than ``share_words`` words is halved again in the same way, by the part of the word in which the edit may
yet be, so no share, however many words have one beginning, gets large.

Within a share the words are a trie. Down its levels go pairs of active nodes: a pair begins where two words part, at two
children of one node (a replaced sign) or at a node and its child (an inserted one), and goes on to children with
equal signs only, as the distance is used up. Two ends of words in a pair are a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lithos.llm.arrays import ranges
from lithos.operators.skew import join_counted
from lithos.session import staged

RUN = r"[A-Za-zÀ-ÿ]"


def vocabulary(docs: DataFrame, least_length: int = 7, least_count: int = 2, one_in: int = 31) -> DataFrame:
    """``word`` and ``n``, its occurrences over the whole texts of all documents.

    A word is a maximal run of letters, A-Z in lower case. Of a run whose CRC-32 of ``doc_id:run`` is divisible by
    ``one_in`` the sign at CRC modulo length is left out. Words shorter than ``least_length`` after that, or
    with fewer than ``least_count`` occurrences, are left out. A null text has no words; a null id counts as empty.
    """
    runs = F.regexp_extract_all("text", F.lit(f"{RUN}{{{least_length},}}"), 0)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", F.translate("run", ascii_uppercase, ascii_lowercase).alias("run"))
    crc = F.crc32(F.concat_ws(":", "id", "run"))
    at = (crc % F.length("run")).cast("int")
    left = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = rows.select(F.when(crc % one_in == 0, left).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


_LINKS = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def near_words(words: DataFrame, share_words: int = 4096) -> DataFrame:
    """For each word with any: ``word``, ``n_near``, and among its near words the most frequent, ``best`` with ``best_n``.

    ``words`` holds distinct ``word`` with their count ``n``; a null or empty word is near to none. Ties go to the
    smallest in code-point order. No words give no rows; other columns are left out.
    """
    shares = _dealt(words.where("word != ''").select("word", F.col("n").alias("freq")), share_words)
    shares = shares.repartition("share").sortWithinPartitions("share", *_KEY, "word")
    found = shares.select(*_KEY, "word", "freq").mapInArrow(_linked, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.minus")).alias("best_n"))


_KEY = ["size", "lo", "tail", "head", "foot"]


def _dealt(words: DataFrame, share_words: int) -> DataFrame:
    """Rows of shares: words of ``size`` letters or one more that begin with ``head``, of ``lo`` letters, and end in
    ``foot``, of ``tail`` letters. A share finds the pairs that part at ``lo`` or later, and before what both end in."""
    length = F.length("word").cast("int")
    none = F.lit("").alias("head"), F.lit("").alias("foot")
    rows = words.select(F.explode(F.array(length, length - 1)).alias("size"), F.lit(0).alias("lo"), F.lit(0).alias("tail"), *none, "word", "freq")
    done: list[DataFrame] = []
    left = _halved(rows)  # shares by length alone are large: halved at once
    while True:
        left = staged(left, "shares")
        open_part = F.col("size") - F.col("lo") - F.col("tail")
        counts = left.groupBy("share").agg(F.count("*").alias("n"), F.max(open_part).alias("open"))
        large = (F.col("n") > share_words) & (F.col("open") > 1)
        counts = staged(counts, "counts")
        if counts.where(large).isEmpty():
            break
        marked = join_counted(left, counts, "share")
        done.append(marked.where(~large).drop("n", "open"))
        left = _halved(marked.where(large).drop("n", "open", "share"))
    for part in done:
        left = left.unionByName(part)
    return left


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: the edit is in the last half of the open part, or in the first."""
    mid = F.floor((F.col("size") - F.col("lo") - F.col("tail")) / 2).cast("int")
    later = F.struct((F.col("lo") + mid).alias("lo"), F.col("tail").alias("tail"))
    sooner = F.struct(F.col("lo").alias("lo"), (F.col("size") - F.col("lo") - mid).alias("tail"))
    halves = F.when(mid > 0, F.array(later, sooner)).otherwise(F.array(later))
    both = rows.select("size", F.explode(halves).alias("half"), "word", "freq").select("size", "half.lo", "half.tail", "word", "freq")
    head = F.substring(F.col("word"), F.lit(1), F.col("lo"))
    foot = F.substring(F.col("word"), F.length("word") - F.col("tail") + 1, F.col("tail"))
    keyed = both.select("size", "lo", "tail", head.alias("head"), foot.alias("foot"), "word", "freq")
    return keyed.withColumn("share", F.xxhash64(*_KEY))  # shares that have one hash are only counted, and dealt out, together


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words within shares, which come one after another with their words in order."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        share = _shares(table)
        last = int(np.searchsorted(share, share[-1])) if len(share) else 0  # its share may go on in the next batch
        if last:
            yield from _joined(table.slice(0, last), share[:last])
        rest = table.slice(last)
    if rest is not None and rest.num_rows:
        yield from _joined(rest, _shares(rest))


def _shares(table: pa.Table) -> np.ndarray:
    """The number of each row's share, counted from 0."""
    n = table.num_rows
    new = np.zeros(n, bool)
    for name in _KEY:
        column = table.column(name).combine_chunks()
        codes = column.dictionary_encode().indices if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column
        codes = codes.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(new)


def _joined(table: pa.Table, share: np.ndarray) -> Iterator[pa.RecordBatch]:
    words = table.column("word").to_pylist()
    freq, size, tail = (table.column(c).to_numpy() for c in ("freq", "size", "tail"))
    a, b = near_pairs(words, share, table.column("lo").to_numpy(), np.where(tail > 0, size - tail, size + 1), size)
    if not len(a):
        return
    word, near = np.concatenate([a, b]), np.concatenate([b, a])
    # words stand in order within a share, so of equal counts the least row is the least word
    order = np.lexsort((near, -freq[near], word))
    word, near = word[order], near[order]
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    names = np.array(words, object)
    counts = np.diff(np.r_[first, len(word)]).astype(np.int64)
    arrays = [pa.array(names[word[first]], pa.string()), pa.array(counts), pa.array(freq[near[first]].astype(np.int64)), pa.array(names[near[first]], pa.string())]
    yield pa.RecordBatch.from_arrays(arrays, schema=_LINKS)


class Level:
    """The nodes of one depth of a trie: for each its parent, its sign, and the word that ends there, or -1."""

    def __init__(self, parent: np.ndarray, sign: np.ndarray, words: np.ndarray, node: np.ndarray, ending: np.ndarray, above: int):
        self.parent, self.sign = parent, sign
        self.words, self.node = words, node  # words that reach this depth, in order, and their nodes
        self.end = np.full(len(parent), -1)
        self.end[node[ending]] = words[ending]
        self.key = parent.astype(np.int64) << 32 | sign  # ascending
        self.first = np.searchsorted(parent, np.arange(above + 1))  # where the children of each node above begin

    def below(self, codes: np.ndarray, starts: np.ndarray, depth: int) -> Level:
        """The children of this level, which is at ``depth``."""
        lengths = starts[self.words + 1] - starts[self.words]
        on = lengths > depth
        words, parent = self.words[on], self.node[on]
        sign = codes[starts[words] + depth].astype(np.int64)
        new = np.r_[True, (parent[1:] != parent[:-1]) | (sign[1:] != sign[:-1])][: len(words)]
        return Level(parent[new], sign[new], words, np.cumsum(new) - 1, lengths[on] == depth + 1, len(self.parent))

    def child(self, node: np.ndarray, sign: np.ndarray) -> np.ndarray:
        """The child of each node above by a sign, or -1."""
        if not len(self.key):
            return np.full(len(node), -1)
        key = node << 32 | sign
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, at, -1)

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``nodes``, child) for all children of nodes above."""
        counts = self.first[nodes + 1] - self.first[nodes]
        return np.repeat(np.arange(len(nodes)), counts), ranges(self.first[nodes], counts)


Pairs = tuple[np.ndarray, np.ndarray]
_NONE: Pairs = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _both(*pairs: Pairs) -> Pairs:
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def _follow(x_below: Level, y_below: Level, pairs: Pairs) -> Pairs:
    """Children of active pairs by equal signs: the distance is used up."""
    at, x = x_below.children(pairs[0])
    y = y_below.child(pairs[1][at], x_below.sign[x])
    return x[y >= 0], y[y >= 0]


def _ends(x: Level, y: Level, pairs: Pairs) -> Pairs:
    """Words that end at both nodes of a pair."""
    a, b = x.end[pairs[0]], y.end[pairs[1]]
    both = (a >= 0) & (b >= 0)
    return a[both], b[both]


def near_pairs(words: list[str], share: np.ndarray, lo: np.ndarray, hi: np.ndarray, size: np.ndarray) -> Pairs:
    """Pairs (i, j) of words of one share at distance one that part at a depth from ``lo`` to below ``hi``: of ``size``
    letters both, or of ``size`` and one more. Shares stand one after another, with distinct words in order; each pair comes once.

    Active pairs of two kinds go down the trie: of nodes of one depth (a sign was replaced) and of a
    node and one a level deeper (a sign was inserted). Words that part at a depth have equal signs before it, so a pair begins at
    children of one node, whose own active set is itself.
    """
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    starts = np.r_[0, np.cumsum(lengths)]
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    roots = np.flatnonzero(np.r_[True, share[1:] != share[:-1]])
    node = np.cumsum(np.r_[True, share[1:] != share[:-1]]) - 1
    lo, hi = lo[roots].astype(np.int64), hi[roots].astype(np.int64)
    level = Level(np.arange(len(roots)), np.zeros(len(roots), np.int64), np.arange(n), node, lengths == 0, len(roots))
    below, depth = level.below(codes, starts, 0), 0
    root = np.arange(len(roots))  # of each node of the level
    replaced, inserted, found = _NONE, _NONE, [_NONE]
    while len(below.parent):
        deeper = below.below(codes, starts, depth + 1)
        open_ = (lo[root] <= depth) & (depth < hi[root])
        # a child and its later sisters; where it ends, they are one letter longer than the parent
        kids = np.flatnonzero(open_[below.parent])
        later = below.first[below.parent[kids] + 1] - kids - 1
        sisters = np.repeat(kids, later), ranges(kids + 1, later)
        found.append(_ends(level, below, (below.parent[kids], kids)))
        # an inserted sign, then one by which the node itself goes on; if it is the same sign, they part later
        at, grand = deeper.children(kids)
        other = deeper.sign[grand] != below.sign[kids[at]]
        at, grand = at[other], grand[other]
        aunt = below.child(below.parent[kids[at]], deeper.sign[grand])
        started = aunt[aunt >= 0], grand[aunt >= 0]
        replaced, inserted = _both(_follow(below, below, replaced), sisters), _both(_follow(below, deeper, inserted), started)
        found += [_ends(below, below, replaced), _ends(below, deeper, inserted)]
        root, level, below, depth = root[below.parent], below, deeper, depth + 1
    a, b = _both(*found)
    right = (lengths[a] == size[a]) | (lengths[b] == size[b])  # two longer words are of another share
    return a[right], b[right]


def variants(words: DataFrame, times: int = 10, share_words: int = 4096) -> DataFrame:
    """Each word with its count, near words, form and root, from distinct ``word`` with count ``n``.

    A word's form is its most frequent near word, if that is at least ``times`` as frequent; the root is
    where forms of forms end, the word itself if it has none. Counts rise by ``times`` at every step, so paths are short and hold no circle.
    """
    words = staged(words.select("word", "n"), "words")
    near = near_words(words, share_words)
    form = F.col("best_n") >= F.col("n") * times
    found = words.join(near, "word", "left").select(
        "word", F.when(form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(form, F.col("best_n")).alias("form_n")
    )
    found = staged(found, "forms")
    roots = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        roots = staged(roots, "roots")
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward")).hint("merge")
        if roots.join(onward, "root", "left_semi").isEmpty():
            break
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"))
    found = found.join(roots.hint("merge"), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
