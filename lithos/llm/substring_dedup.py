"""Fuzzy passages that documents share, by collinear chaining of k-mer seeds.

1. Each text gives seeds: every run of ``k`` words whose hash is in the lowest ``1 / sample``
   of all, and the least hash of every window of ``window`` runs that holds none of those. So
   texts that share ``window + k - 1`` words in a row share a seed, and a passage with scattered
   edits keeps many chances. Rows with equal word sequences form one class, the row with the least id stands for it.
2. Seeds in one class only go. Around the others a text is cut into fragments: stretches of
   shared seeds with ``margin`` words on both sides.
3. Fragments that hold a key are partners. A key is a seed, and of a seed that more than
   ``pairs`` texts hold, also each two, four and eight of such seeds in a row, at any distance, and
   every run of ``min_words`` words around it. All holders of a key are paired while they are at most ``pairs``;
   of a key of more each holder is paired with its least one. A run of ``min_words`` words is a passage, so
   that pair always verifies. A holder (fragment) that has a passage with the least one is in that one's class.
   Those that it does not reach are compared with the other holders with whom they can share a passage around the seed
   (``rest``), whatever their number: of a key of more than ``pairs`` of them all with one, the leader, whose class are those it
   reaches; after ``turns`` leaders every two that no leader has both in its class.
4. For a pair, all runs of ``link`` words are matched, each with the places in the partner that
   go on alike for longest, rightward and leftward. Matches that follow each other on a diagonal
   are one block. Blocks are chained: one follows another if it begins later in both, and a gap costs ``gap`` a
   word in each; a Fenwick tree over the positions in the partner gives each its best predecessor.
5. Every chain is aligned on the words themselves. A passage is a stretch of at least
   ``min_words`` words of which the share ``identity`` match, words left out counting as others.

A word that repeats itself counts once in all of this, so a run of one word is no passage; places are
those in the whole text.

Defined results: null, empty and short texts have no passages. Rows that repeat an id with
another text are compared each; two texts of one id give no row, nor do repeats inside a text. Rows
without an id are left out. Texts equal to their class's one with the least id get one row that
spans them, if they have ``min_words`` words. Columns other than id and text are not read. Of a passage in more than
``pairs`` texts each holder has a row with its class's leader, and with every other only where no leader reaches both.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lithos.llm.arrays import ALNUM, gram_hashes, mixed, text_slices, word_bounds, word_hashes
from lithos.operators.skew import join_counted
from lithos.session import discard, staged

PASSAGE = "doc_id long, start_word int, end_word int, other_doc_id long, other_start int, other_end int, matched int, kind string"
#: Frequent seeds in a row that are a key: from two that happen to follow each other to what a whole passage holds.
RUNS = (2, 4, 8)
#: Bytes of words and keys that a task collects before it sends them on.
MOST_BYTES = 4_000_000
#: A fragment: its document, which of the texts of that id, and its first word.
NODE = ["doc", "part", "at"]
#: A row of ``verified``; kind "unreached" stands for two fragments (``start_word`` and ``other_start`` are their ``at``) and a frequent seed ``key``.
FOUND = PASSAGE + ", part long, other_part long, key long"


@dataclass(frozen=True)
class Params:
    k: int = 8
    sample: int = 4
    window: int = 16
    pairs: int = 16
    link: int = 4
    gap: float = 0.05
    min_words: int = 50
    identity: float = 0.8
    margin: int = 64
    block: int = 500
    turns: int = 2

    @property
    def least(self) -> int:
        """Words that match in the shortest passage."""
        return int(np.ceil(self.identity * self.min_words))

    @property
    def fewest_links(self) -> int:
        """Runs of ``link`` words that a passage's texts have in common: m matches among L columns stand in at most L - m + 1 stretches."""
        hits = ((n, int(np.ceil(self.identity * n))) for n in range(self.min_words, 2 * self.min_words))
        return max(1, min(m - (self.link - 1) * (n - m + 1) for n, m in hits))

    @property
    def stubs(self) -> tuple[tuple[int, int], ...]:
        """(words at the end of an equal stretch, words in a row beyond it), one of which a passage has around a stretch of less than ``min_words``."""
        return (self.k, 3), (max(self.k, int((3 * self.identity - 2) * self.min_words)), 2)

    @property
    def beyond(self) -> int:
        """How far beyond the stretch those words may begin."""
        return 3 * self.min_words // 2

    @property
    def fewest(self) -> int:
        """Triples of words that the texts of a passage have in common."""
        return min(3 * int(np.ceil(self.identity * n)) - 2 * n - 2 for n in range(self.min_words, 2 * self.min_words))


def sampled(grams: np.ndarray, p: Params) -> np.ndarray:
    """Positions of the seeds among the runs' hashes."""
    found = np.flatnonzero(grams < np.uint64((1 << 64) // p.sample))
    ends = np.concatenate([[-1], found, [len(grams)]])
    more = [found]
    for i in np.flatnonzero(np.diff(ends) > p.window):  # windows without a low hash
        inside = grams[ends[i] + 1 : ends[i + 1]]
        seen = np.lib.stride_tricks.sliding_window_view(inside, p.window)
        more.append(np.unique(np.arange(len(seen)) + np.argmin(seen, axis=1)) + ends[i] + 1)
    if not len(found) and 0 < len(grams) < p.window:
        more.append(np.array([int(np.argmin(grams))]))
    return np.sort(np.concatenate(more))


def _words(column: pa.Array):
    """(row, its words' hashes) for every row."""
    for i, j, data, offsets in text_slices(column):
        starts, ends, first = word_bounds(data, offsets, ALNUM)
        words = word_hashes(data, starts, ends)
        for r in range(j - i):
            yield i + r, words[first[r] : first[r + 1]]


def unrepeated(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words without repeats of the word before, and where each and what follows the last one stands."""
    kept = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, np.int64)
    return words[kept], np.append(kept, len(words))


def _digest(words: np.ndarray) -> bytes:
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*arrays, np.zeros(0, np.uint64)]).astype(np.uint64).view(np.int64)))


def seeds(docs: DataFrame, p: Params, id_col: str, text_col: str) -> DataFrame:
    """``(doc, hash, n_words, digest, seeds)`` of each row with an id; ``hash`` is of the text itself."""

    def run(batches):
        for batch in batches:
            n_words, digests, found = [], [], []
            for _, words in _words(batch.column("text")):
                n_words.append(len(words))
                digests.append(_digest(words))
                words, _ = unrepeated(words)
                grams = gram_hashes(words, p.k)
                found.append(np.unique(grams[sampled(grams, p)]) if len(words) >= p.min_words else grams[:0])
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("hash"), pa.array(n_words, pa.int32()), pa.array(digests, pa.binary()), _lists(found)], ["doc", "hash", "n_words", "digest", "seeds"])

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc long, hash long, n_words int, digest binary, seeds array<long>")


def with_holders(keys: DataFrame, key: str) -> DataFrame:
    """``keys`` with ``n``, how many rows have the key, and ``least``, the least of them; keys of one row go.

    The keys are counted with partial sums.
    """
    others = [c for c in keys.columns if c != key]
    return join_counted(keys, keys.groupBy(key).agg(F.count("*").alias("n"), F.min(F.struct(*others)).alias("least")).where("n > 1"), key)


def fragments(texts: DataFrame, p: Params) -> DataFrame:
    """``(doc, part, at, words, places, keys)`` of ``texts``: ``(doc, part, shared, often, text)``.

    ``shared`` are the seeds that others hold too, ``often`` those that more than ``pairs`` hold;
    ``places`` is where the words stand from ``at`` on, empty where they follow each other.
    """

    def cut(words: np.ndarray, shared: np.ndarray, often: np.ndarray):
        grams = gram_hashes(words, p.k)
        at = np.flatnonzero(np.isin(grams, shared))
        if not len(at):
            return
        hot = np.isin(grams[at], often)
        long_ones = gram_hashes(words, p.min_words)
        for part, warm in zip(*(np.split(x, np.flatnonzero(np.diff(at) > 2 * p.margin) + 1) for x in (at, hot))):
            lo, hi = max(0, int(part[0]) - p.margin), min(len(words), int(part[-1]) + p.k + p.margin)
            if hi - lo < p.min_words:
                continue
            keys = [gram_hashes(words[lo:hi].astype(np.uint32).astype(np.uint64), p.k)[part - lo]]  # as the fragment's words give them
            spots = part[warm]
            for n in RUNS:  # so many frequent seeds in a row, at any distance, as words may be put between them
                if len(spots) >= n:
                    runs = np.full(len(spots) - n + 1, np.uint64(n))
                    for i in range(n):
                        runs = mixed(runs ^ grams[spots[i : len(runs) + i]])
                    keys.append(runs)
            if len(spots):
                edge = np.zeros(len(words) + 2, np.int64)  # starts of the long runs that hold a frequent seed
                np.add.at(edge, np.maximum(spots + p.k - p.min_words, 0), 1)
                np.add.at(edge, spots + 1, -1)
                keys.append(long_ones[np.flatnonzero(np.cumsum(edge)[: len(long_ones)] > 0)])
            yield lo, words[lo:hi], np.unique(np.concatenate(keys))

    def run(batches):
        for batch in batches:
            lists = [(batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy().view(np.uint64)) for c in ("shared", "often")]
            out, held = [], 0
            for r, words in _words(batch.column("text")):
                words, places = unrepeated(words)
                before = len(out)
                for lo, words_, keys in cut(words, *[flat[ends[r] : ends[r + 1]] for ends, flat in lists]):
                    own = places[lo : lo + len(words_) + 1]
                    spots = b"" if own[-1] - own[0] == len(words_) else (own - own[0]).astype(np.int32).tobytes()
                    out.append((r, own[0], words_.astype(np.uint32).tobytes(), spots, keys))
                held += sum(len(o[2]) + 8 * len(o[4]) for o in out[before:])
                if held > MOST_BYTES:
                    yield packed(batch, out)
                    out, held = [], 0
            if out:
                yield packed(batch, out)

    def packed(batch: pa.RecordBatch, out: list[tuple]) -> pa.RecordBatch:
        owner, at, words_of, places_of, keys_of = zip(*out)
        own = pa.array(owner, pa.int64())
        blobs = [pa.array(c, pa.binary()) for c in (words_of, places_of)]
        return pa.RecordBatch.from_arrays([batch.column("doc").take(own), batch.column("part").take(own), pa.array(at, pa.int32()), *blobs, _lists(list(keys_of))], [*NODE, "words", "places", "keys"])

    return texts.mapInArrow(run, "doc long, part long, at int, words binary, places binary, keys array<long>")


def holders(frags: DataFrame) -> DataFrame:
    """``(key, a, n, least)``: the fragments that hold a key of more than one."""
    counted = with_holders(frags.select(F.explode("keys").alias("key"), *NODE), "key")
    held = staged(counted, "held").withColumn("a", F.struct(*NODE))
    discard(counted)
    return held


def partners(held: DataFrame, p: Params) -> DataFrame:
    """``(a, b, via)``: pairs of fragments, of different documents and ``b`` the less, that hold a key; ``via`` are those of which ``b`` is the least of many."""
    few = held.where(F.col("n") <= p.pairs).groupBy("key").agg(F.sort_array(F.collect_set("a")).alias("all"))
    few = few.select(F.posexplode("all").alias("i", "a"), "all").select("a", F.explode(F.slice("all", F.lit(1), F.col("i"))).alias("b"), F.lit(None).cast("long").alias("key"))
    many = held.where(F.col("n") > p.pairs).select("a", F.col("least").alias("b"), "key")
    return few.distinct().unionByName(many).where("a.doc != b.doc").groupBy("a", "b").agg(F.collect_list("key").alias("via"))


def stub_ends(words: np.ndarray, p: Params):
    """(hashes of the stubs, where each starts, where what is beyond starts, the word there, step beyond, q) for both sides and kinds.

    A stub is the last or first ``size`` words of an equal stretch; those without a word beyond are left out.
    """
    for kind, (size, q) in enumerate(p.stubs):
        grams = gram_hashes(words, size)
        if len(grams) < 2:
            continue
        at = np.arange(len(grams))
        for side, (own, out) in enumerate(((at[:-1], at[:-1] + size), (at[1:], at[1:] - 1))):
            yield mixed(grams[own] ^ np.uint64(2 * kind + side + 1)), own, out, words[out], 1 - 2 * side, q


def near(n: int, spots: np.ndarray, size: int, step: int, p: Params) -> np.ndarray:
    """Whether a stub at each of ``n`` places ends a stretch of less than ``min_words`` words around one of the seeds at ``spots``."""
    lo = spots + p.k - (size if step > 0 else p.min_words - 1)
    hi = spots + (p.min_words - size if step > 0 else 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.clip(lo, 0, n), 1)
    np.add.at(edge, np.clip(hi, 0, n), -1)
    return np.cumsum(edge)[:n] > 0


def _flat(frags: DataFrame, lists: list[str], made, schema: str) -> DataFrame:
    """Rows ``(*NODE, *made(words, *lists))`` of fragments; ``made`` gives arrays of equal length, the columns of ``schema``."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for batch in batches:
            given = [(batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy().view(np.uint64)) for c in lists]
            words, out, held = batch.column("words"), [], 0
            for r in range(batch.num_rows):
                own = np.frombuffer(words[r].as_buffer(), np.uint32).astype(np.uint64)
                columns = made(own, *[flat[ends[r] : ends[r + 1]] for ends, flat in given])
                out.append((r, columns))
                held += 8 * len(names) * len(columns[0])
                if held > MOST_BYTES or r == batch.num_rows - 1:
                    owner = pa.array(np.repeat([r for r, _ in out], [len(c[0]) for _, c in out]), pa.int64())
                    flat = [np.concatenate(c).astype(np.uint64).view(np.int64) for c in zip(*(c for _, c in out))]
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).take(owner) for c in NODE), *map(pa.array, flat)], [*NODE, *names])
                    out, held = [], 0

    return frags.select(*NODE, "words", *lists).mapInArrow(run, f"doc long, part long, at int, {schema}")


def rest(held: DataFrame, lone: DataFrame, frags: DataFrame, p: Params) -> DataFrame:
    """FOUND rows of the fragments ``lone`` ``(a, key)`` at a frequent seed and the others that can share a passage around it.

    Let the equal stretch around the seed have l words. With ``min_words`` or more it holds a run that is a key by itself.
    With less, a passage of L columns, e of them no matches, goes on beyond. It has at most e other stretches of matches. If
    none had 3 words, l >= L - 3e, so with ``identity`` 0.8 it would be 20 words or more; if none had 2, no end
    would have a positive sum (``segments``), and there is no passage. So both texts hold the last (first) 8 words of the stretch and 3 in a row
    after (before) it, or 20 and 2: a stub and a rest. Only stubs of which the holders have different words next to them end a stretch.
    Of a stub with at most ``pairs`` lone holders those are paired with all others; of one with more, the holders of the stub and a rest (``by_leaders``).
    """

    def stubs(words, hot, alone):
        grams = gram_hashes(words, p.k)
        spots = np.flatnonzero(np.isin(grams, hot))
        bare = spots[np.isin(grams[spots], alone)]
        out = [(np.zeros(0, np.uint64),) * 3]
        for keys, at, _, beside, step, q in stub_ends(words, p):
            size = dict((q, size) for size, q in p.stubs)[q]
            all_, own = (near(len(words), x, size, step, p)[at] for x in (spots, bare))
            out.append((keys[all_], beside[all_], own[all_].astype(np.uint64)))
        return [np.concatenate(c) for c in zip(*out)]

    def rests(words, ends, alone):
        out = [(np.zeros(0, np.uint64),) * 2]
        for keys, _, start, _, step, q in stub_ends(words, p):
            grams = gram_hashes(words, q)
            for i in np.flatnonzero(np.isin(keys, ends)):
                lo, hi = (start[i], start[i] + p.beyond) if step > 0 else (start[i] - q + 2 - p.beyond, start[i] - q + 2)
                more = np.unique(grams[max(0, lo) : max(0, hi)])
                out.append((mixed(more * np.uint64(0x9E3779B97F4A7C15) ^ keys[i]), np.full(len(more), not np.isin(keys[i], alone), np.uint64)))
        columns = [np.concatenate(c) for c in zip(*out)]
        _, first = np.unique(columns[0], return_index=True)
        return [c[first] for c in columns]

    node = F.struct(*NODE).alias("a")
    marked = held.where(F.col("n") > p.pairs).join(lone.select("key").distinct(), "key", "left_semi").select("key", "a", F.lit(0).alias("lone"))
    marked = marked.unionByName(lone.select("key", "a", F.lit(1).alias("lone")))
    both = marked.groupBy("a").agg(F.collect_set("key").alias("hot"), F.collect_set(F.when(F.col("lone") == 1, F.col("key"))).alias("alone"))
    every = staged(_flat(both.select("a.*", "hot", "alone").join(frags.hint("merge"), NODE), ["hot", "alone"], stubs, "key long, beside long, lone long"), "stubs")
    counts = every.groupBy("key").agg(F.count("*").alias("n"), F.sum("lone").alias("few"), (F.min("beside") != F.max("beside")).alias("ends")).where("few > 0 and ends").drop("ends")
    counted = join_counted(every.select("key", node, "lone"), counts, "key")
    ends = staged(counted, "ends")
    for used in (every, counted):
        discard(used)
    some = ends.where(F.col("few") <= p.pairs)
    alone = some.where("lone = 1").groupBy("key").agg(F.first("n").alias("n"), F.sort_array(F.collect_set("a")).alias("alone"))
    direct = join_counted(some.select("key", "a"), alone, "key").select("a", "alone").distinct().select("a", F.explode("alone").alias("b")).where("a.doc != b.doc")
    often = ends.where(F.col("few") > p.pairs).groupBy("a").agg(F.collect_set("key").alias("ends"), F.collect_set(F.when(F.col("lone") == 1, F.col("key"))).alias("alone"))
    beyond = staged(_flat(often.select("a.*", "ends", "alone").join(frags.hint("merge"), NODE), ["ends", "alone"], rests, "key long, known long"), "beyond")
    found, left = by_leaders(beyond.select("key", node, "known"), frags, p)
    discard(beyond)
    pairs = direct.unionByName(apart(left, p)).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    more = verified(staged(pairs, "pairs").withColumn("via", F.array().cast("array<long>")), frags, p, bound=True)
    for rows in found:
        more = more.unionByName(rows)
    return more


def by_leaders(rows: DataFrame, frags: DataFrame, p: Params) -> tuple[list[DataFrame], DataFrame]:
    """FOUND rows of the holders of a key with its leaders, and the rows ``(key, a, known)`` of which pairs are left.

    The bits of ``known`` are the leaders in whose class the holder is, the first that of the seed itself.
    A key with more than ``pairs`` holders without a leader gets the least of them, with which all are compared; it is done then.
    """
    found, left = [], []
    for turn in range(1, p.turns + 1):
        none = F.col("known") == 0
        counts = rows.groupBy("key").agg(F.count("*").alias("n"), F.count(F.when(none, 1)).alias("open"), F.min(F.when(none, F.col("a"))).alias("lead"))
        counts = counts.where("n > 1 and open > 0" if turn == 1 else "n > 1").select("key", "n", F.when(F.col("open") > p.pairs, F.col("lead")).alias("lead"))
        counted = join_counted(rows, counts, "key")
        rows = staged(counted.select("key", "a", "known", "lead"), "rests")
        discard(counted)
        left.append(rows.where("lead is null").select("key", "a", "known"))
        rows = rows.where("a != lead").withColumn("b", F.least("a", "lead")).withColumn("a", F.greatest("a", "lead")).withColumn("led", F.col("b") != F.col("lead"))
        asked = rows.where("a.doc != b.doc").groupBy("a", "b").agg(F.array(F.lit(0).cast("long")).alias("via"))
        asked = staged(asked, "asked")
        found.append(staged(verified(asked, frags, p), "led"))
        discard(asked)
        missed = found[-1].where("kind = 'unreached'").select(_node("doc_id", "part", "start_word").alias("a"), _node("other_doc_id", "other_part", "other_start").alias("b"), F.lit(0).alias("reach"))
        rows = rows.join(missed.hint("merge"), ["a", "b"], "left")
        reach = F.when(F.col("a.doc") == F.col("b.doc"), 0).otherwise(F.coalesce("reach", F.lit(1 << turn)))
        rows = staged(rows.select("key", F.when(F.col("led"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("known").bitwiseOR(reach).alias("known")), "known")
    for more in left:
        rows = rows.unionByName(more)
    return found, rows


def _node(doc: str, part: str, at: str):
    return F.struct(F.col(doc).alias("doc"), F.col(part).alias("part"), F.col(at).alias("at"))


def apart(rows: DataFrame, p: Params) -> DataFrame:
    """``(a, b)``: the pairs of rows ``(key, a, known)`` of a key without a bit in common, from pairs of blocks of about ``block`` rows."""
    sides = rows.groupBy("key", "known").agg(F.count("*").alias("n")).groupBy("key").agg(F.sum("n").alias("n"), F.collect_list(F.struct("known", F.ceil(F.col("n") / p.block).cast("int").alias("blocks"))).alias("sides"))
    sides = sides.where("n > 1 and exists(sides, s -> exists(sides, t -> (s.known & t.known) = 0))")
    rows = join_counted(rows, sides, "key").withColumn("own", F.expr("cast(pmod(xxhash64(a), filter(sides, s -> s.known = known)[0].blocks) as int)"))
    rows = rows.withColumn("other", F.explode(F.expr("filter(sides, s -> (s.known & known) = 0)"))).withColumn("block", F.explode(F.expr("sequence(0, other.blocks - 1)")))
    # of two sides the less known is the first; of one side the less block
    first = F.expr("known < other.known or (known = other.known and own <= block)")
    cell = ["key", F.least("known", "other.known").alias("lo"), F.greatest("known", "other.known").alias("hi"), F.when(first, F.col("own")).otherwise(F.col("block")).alias("i"), F.when(first, F.col("block")).otherwise(F.col("own")).alias("j")]
    rows = rows.select(*cell, "a", first.alias("first"), F.expr("known > other.known or (known = other.known and own >= block)").alias("second"))
    cells = rows.groupBy("key", "lo", "hi", "i", "j").agg(F.collect_list(F.when(F.col("first"), F.col("a"))).alias("these"), F.collect_list(F.when(F.col("second"), F.col("a"))).alias("those"))
    cells = cells.where("size(these) > 0 and size(those) > 0").select(F.expr("lo = hi and i = j").alias("same"), F.explode("these").alias("a"), "those")
    return cells.select("a", F.explode(F.expr("filter(those, y -> y.doc != a.doc and (not same or y < a))")).alias("b"))


def by_hash(b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a text's runs of ``k`` words, their order and the hashes in it."""
    grams = gram_hashes(b, k)
    order = np.argsort(grams, kind="stable")
    return grams, order, grams[order]


def best_places(a: np.ndarray, b: np.ndarray, k: int, ready: tuple | None = None, fewest: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Positions of runs of ``k`` words in ``a`` and in ``b`` that match, sorted.

    Of several places in ``b``, those count whose equal stretch from there on, and whose equal
    stretch up to there, is longest, in doublings of ``k``. ``ready`` is ``by_hash`` of ``b``; with
    under ``fewest`` positions in ``a`` there are none.
    """
    ga = gram_hashes(a, k)
    gb, order, gs = ready or by_hash(b, k)
    lo = np.searchsorted(gs, ga, "left")
    x = np.flatnonzero(gs[np.minimum(lo, len(gs) - 1)] == ga) if len(gs) else np.zeros(0, np.int64)
    if len(x) < max(1, fewest):
        return x[:0], x[:0]
    hi = np.searchsorted(gs, ga, "right")
    y = order[lo[x]]
    repeated = hi[x] - lo[x] > 1
    if not repeated.any():
        return x, y
    xs = x[repeated]
    ahead, back = y[repeated].copy(), y[repeated].copy()
    size = k
    while len(ga) > size and len(gb) > size:
        longer = [mixed(g[:-size] * np.uint64(0x9E3779B97F4A7C15) + g[size:]) for g in (ga, gb)]
        ga, gb = longer
        order = np.argsort(gb, kind="stable")
        gs = gb[order]
        seen = False
        for place, start, shift in ((ahead, xs, 0), (back, xs - size * 2 + k, size * 2 - k)):
            ok = np.flatnonzero((start >= 0) & (start < len(ga)))
            spot = np.minimum(np.searchsorted(gs, ga[start[ok]]), len(gs) - 1)
            same = gs[spot] == ga[start[ok]]
            place[ok[same]] = order[spot[same]] + shift
            seen |= bool(same.any())
        if not seen:
            break
        size *= 2
    pairs = np.unique(np.stack([np.concatenate([x[~repeated], xs, xs]), np.concatenate([y[~repeated], ahead, back])]), axis=1)
    return pairs[0], pairs[1]


def blocks(x: np.ndarray, y: np.ndarray, k: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, length) of stretches of matches on one diagonal, none further than ``reach`` from the next; sorted by x, then y."""
    order = np.lexsort((x, x - y))
    x, y = x[order], y[order]
    first = np.concatenate([[True], (np.diff(x - y) != 0) | (np.diff(x) > reach)])
    start = np.flatnonzero(first)
    end = np.concatenate([start[1:], [len(x)]]) - 1
    bx, by, length = x[start], y[start], x[end] - x[start] + k
    order = np.lexsort((by, bx))
    return bx[order], by[order], length[order]


def chains(x: np.ndarray, y: np.ndarray, length: np.ndarray, gap: float) -> list[tuple[float, list[int]]]:
    """(value, indices) of disjoint chains of blocks, best first; the blocks come sorted by x, then y.

    A block after another adds its words beyond the end of that one in both texts, less the gap between them.
    """
    n = len(x)
    if n == 1:
        return [(float(length[0]), [0])]
    ranks = np.unique(y)
    spots = (np.searchsorted(ranks, y) + 1).tolist()
    size = len(ranks) + 1
    tree: list[tuple[float, int]] = [(-1e300, -1)] * size
    value, before = [0.0] * n, [-1] * n
    xs, ys, ls = x.tolist(), y.tolist(), length.tolist()
    i = 0
    while i < n:
        j = i
        while j < n and xs[j] == xs[i]:  # blocks at one x are asked first, then entered
            best, spot = (-1e300, -1), spots[j] - 1
            while spot > 0:
                if tree[spot] > best:
                    best = tree[spot]
                spot -= spot & -spot
            value[j] = float(ls[j])
            if best[1] >= 0:
                m = best[1]
                over = max(0, xs[m] + ls[m] - xs[j], ys[m] + ls[m] - ys[j])
                longer = best[0] + max(0, ls[j] - over) - gap * (xs[j] + ys[j])
                if longer > ls[j]:
                    value[j], before[j] = longer, m
            j += 1
        for m in range(i, j):
            entry, spot = (value[m] + gap * (xs[m] + ys[m] + 2 * ls[m]), m), spots[m]
            while spot < size:
                if entry > tree[spot]:
                    tree[spot] = entry
                spot += spot & -spot
        i = j
    used, out = [False] * n, []
    for end in sorted(range(n), key=lambda m: -value[m]):
        path, m = [], end
        while m >= 0 and not used[m]:
            path.append(m)
            used[m] = True
            m = before[m]
        if path:
            out.append((value[end] - (value[m] if m >= 0 else 0.0), path[::-1]))
    return out


def align(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, length: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns of the alignment along a chain of blocks: positions in ``a`` and ``b``, and whether they match.

    Between two blocks the diagonal changes once, where most words match; a word without a
    partner is a column that does not match. Both ends go on along their
    diagonals for ``reach`` words.
    """
    back = int(min(x[0], y[0], reach))
    xs, ys = [np.arange(x[0] - back, x[0])], [np.arange(y[0] - back, y[0])]
    gone = [np.zeros(back, bool)]
    for i in range(len(x)):
        last = i == len(x) - 1
        ahead = min(len(a) - x[i], len(b) - y[i], length[i] + reach) if last else 0
        dx, dy = (ahead, ahead) if last else (int(x[i + 1] - x[i]), int(y[i + 1] - y[i]))
        n = int(min(dx, dy))
        t = n
        if dx != dy:
            first = a[x[i] : x[i] + n] == b[y[i] : y[i] + n]
            then = a[x[i + 1] - n : x[i + 1]] == b[y[i + 1] - n : y[i + 1]]
            t = int(np.argmax(np.concatenate([[0], np.cumsum(first)]) + np.concatenate([np.cumsum(then[::-1])[::-1], [0]])))
        skip, rest = int(max(dx, dy)) - n, n - t
        for at, start, step, wide in ((xs, x, dx, dx > dy), (ys, y, dy, dy > dx)):
            own = np.arange(start[i] + t, start[i] + t + skip) if wide else np.full(skip, start[i] + t)
            at += [np.arange(start[i], start[i] + t), own, np.arange(start[i] + step - rest, start[i] + step)]
        gone += [np.zeros(t, bool), np.ones(skip, bool), np.zeros(rest, bool)]
    at_a, at_b, lone = np.concatenate(xs), np.concatenate(ys), np.concatenate(gone)
    same = a[np.minimum(at_a, len(a) - 1)] == b[np.minimum(at_b, len(b) - 1)]
    return at_a, at_b, same & ~lone


def segments(same: np.ndarray, p: Params) -> list[tuple[int, int]]:
    """Disjoint passages among the columns: stretches of ``min_words`` or more of which the share ``identity`` match.

    A stretch is one with the largest sum, a match counting 1 and another column -2. Where it has
    too few matches, a column counts what makes the share ``identity`` sum to nothing; where that one is
    too short, the passage is the longest part with the share of the stretch in which a column counts -1.25. So a shorter
    copy is no passage by single words that happen to match beyond its ends.
    """
    found, left = [], [(0, len(same))]
    strict = p.identity / (1 - p.identity)
    while left:
        lo, hi = left.pop()
        own = same[lo:hi]
        if hi - lo < p.min_words or np.count_nonzero(own) < p.least:
            continue
        for loss in (2.0, strict, 1.25):
            start, end = best_stretch(own, loss)
            if loss < 2 and end - start >= p.min_words:
                start, end = (start + at for at in longest(own[start:end], p))
            good = end - start >= p.min_words and np.count_nonzero(own[start:end]) >= p.identity * (end - start) - 1e-9
            if good:
                found.append((lo + start, lo + end))
                left += [(lo, lo + start), (lo + end, hi)]
                break
    return found


def best_stretch(same: np.ndarray, loss: float) -> tuple[int, int]:
    """The stretch with the largest sum, a match counting 1 and another column ``-loss``."""
    sums = np.concatenate([[0], np.cumsum(np.where(same, 1.0, -loss))])
    low = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - low))
    return int(np.flatnonzero(sums[: end + 1] == low[end])[-1]), end


def longest(same: np.ndarray, p: Params) -> tuple[int, int]:
    """The longest stretch from a match to a match of which the share ``identity`` match, the first of several."""
    sums = np.concatenate([[0.0], np.cumsum(np.where(same, 1 - p.identity, -p.identity))])
    at = np.flatnonzero(same)
    first = at[np.searchsorted(-np.minimum.accumulate(sums[at]), -sums[at + 1] - 1e-9)]  # the first start whose sum is as low
    best = int(np.argmax(at + 1 - first))
    return int(first[best]), int(at[best]) + 1


def _shared_runs(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """How many runs of ``n`` words before each place of ``a`` stand anywhere in ``b``."""
    return np.concatenate([[0], np.cumsum(np.isin(gram_hashes(a, n), gram_hashes(b, n)))])


def passages(a: np.ndarray, b: np.ndarray, p: Params, ready: tuple | None = None) -> list[tuple[int, int, int, int, int]]:
    """(start, end, start in the other, end there, words matched) of the passages of two texts.

    The best chains come first. A passage of L columns with m matches has at most L - m + 1 runs of
    matches, so 3m - 2L - 2 triples of words in common; a chain with fewer around it is left out. A chain whose words all stand in passages found before, in both
    texts, gives nothing new; so repeated lines give each place once, not every place with every other.
    """
    x, y = best_places(a, b, p.link, ready, p.fewest_links)
    if not len(x):
        return []
    bx, by, length = blocks(x, y, p.link, p.margin)
    in_a, in_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    every = chains(bx, by, length, p.gap)
    # The bound saves time where there are many chains; it never drops a passage.
    triples, fewest = (_shared_runs(a, b, 3), p.fewest) if len(every) > 3 else (None, 0)
    found: list[tuple[int, int, int, int, int]] = []
    for _, path in every:
        cx, cy, cl = bx[path], by[path], length[path]
        x0, x1, y0, y1 = int(cx[0]), int(cx[-1] + cl[-1]), int(cy[0]), int(cy[-1] + cl[-1])
        if min(x1 - x0, y1 - y0) + 2 * p.margin < p.min_words or (in_a[x0:x1].all() and in_b[y0:y1].all()):
            continue
        if triples is not None and triples[min(len(a), x1 + p.margin) - 2] - triples[max(0, x0 - p.margin)] < fewest:
            continue
        at_a, at_b, same = align(a, b, cx, cy, cl, p.margin)
        for i, j in segments(same, p):
            s, e, o, u = int(at_a[i]), int(at_a[j - 1]) + 1, int(at_b[i]), int(at_b[j - 1]) + 1
            if e - s >= p.min_words and not (in_a[s:e].all() and in_b[o:u].all()):
                found.append((s, e, o, u, int(np.count_nonzero(same[i:j]))))
                in_a[s:e], in_b[o:u] = True, True
    return found


def possible(a: np.ndarray, b: np.ndarray, p: Params) -> bool:
    """Whether a stretch of ``a`` has words of ``b`` enough for a passage, in any order; where not, there is none."""
    hits = np.isin(a, b)
    start, end = longest(hits, p) if hits.any() else (0, 0)
    return end - start >= p.least


def verified(pairs: DataFrame, frags: DataFrame, p: Params, bound: bool = False) -> DataFrame:
    """FOUND rows of the pairs ``(a, b, via)`` of fragments: passages, and where there are none, "unreached" for each key in ``via``.

    With ``bound`` pairs are first asked whether they can have a passage, which pays where few have one.
    """
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / p.block).cast("int").alias("blocks"))
    rows = pairs.join(sizes, "b").select("b", "a", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("turn"), "via")
    heads = sizes.select("b", F.col("b").alias("a"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("turn"), F.array().cast("array<long>").alias("via"))
    rows = rows.unionByName(heads).join(frags.select(F.struct(*NODE).alias("a"), "words", "places").hint("merge"), "a")
    rows = rows.select(F.col("b.doc").alias("other"), F.col("b.part").alias("part"), F.col("b.at").alias("other_at"), "block", "turn", F.col("a.doc").alias("doc"), F.col("a.part").alias("own_part"), F.col("a.at").alias("at"), "words", "places", "via")
    group = ["other", "part", "other_at", "block"]
    rows = rows.repartition(*group).sortWithinPartitions(*group, "turn")

    def run(batches):
        key, base, ready = None, None, None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in group)))
            turns, docs, parts, ats = (batch.column(c).to_pylist() for c in ("turn", "doc", "own_part", "at"))
            via, ends = batch.column("via").values.to_numpy().view(np.uint64), batch.column("via").offsets.to_numpy()
            words, spots, out = batch.column("words"), batch.column("places"), []
            for r, this in enumerate(keys):
                own = np.frombuffer(words[r].as_buffer(), np.uint32).astype(np.uint64)
                own = own, np.frombuffer(spots[r].as_buffer(), np.int32).astype(np.int64) if len(spots[r].as_buffer()) else np.arange(len(own) + 1)
                if turns[r] == 0:
                    key, base, ready = this, own, by_hash(own[0], p.link)
                    continue
                if key != this:
                    raise ValueError("a group came without its head")
                mine, theirs = own[1] + ats[r], base[1] + this[2]
                both = passages(own[0], base[0], p, ready) if not bound or possible(own[0], base[0], p) else []
                out += [(docs[r], mine[s], mine[e], this[0], theirs[o], theirs[u], hit, "passage", None, None, None) for s, e, o, u, hit in both]
                if not both:
                    out += [(docs[r], ats[r], None, this[0], this[2], None, None, "unreached", parts[r], this[1], key_) for key_ in via[ends[r] : ends[r + 1]].view(np.int64).tolist()]
            if out:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], [x.split()[0] for x in FOUND.split(", ")])

    return rows.mapInArrow(run, FOUND)


def shared_passages(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """PASSAGE rows; ``kind`` is "passage", or "copy" for a text equal to that of ``other_doc_id``."""
    rows = staged(seeds(docs, p, id_col, text_col), "seeds")
    texts = rows.groupBy("doc", "digest").agg(F.min("hash").alias("hash"), F.max("n_words").alias("n_words"))
    copies = with_holders(texts.where(F.col("n_words") >= p.min_words).select("digest", "doc", "n_words"), "digest")
    copies = copies.withColumn("rep", F.col("least.doc")).where("doc != rep")
    copies = copies.select(
        F.col("doc").alias("doc_id"), F.lit(0).alias("start_word"), F.col("n_words").alias("end_word"), F.col("rep").alias("other_doc_id"),
        F.lit(0).alias("other_start"), F.col("n_words").alias("other_end"), F.col("n_words").alias("matched"), F.lit("copy").alias("kind"),
    )
    copies = staged(copies, "copies")
    # A class is known by the id and the text hash of its first row; of an id's texts the first is part 0.
    classes = texts.groupBy("digest").agg(F.min(F.struct("doc", "hash")).alias("rep")).select("rep.*")
    first = classes.groupBy("doc").agg(F.min("hash").alias("first"))
    nodes = staged(classes.join(first, "doc").select("doc", "hash", F.when(F.col("hash") == F.col("first"), 0).otherwise(F.col("hash")).alias("part")), "texts")
    # Ids grow with the corpus: joins of theirs with seeds or texts are merges at every size.
    own = rows.groupBy("doc", "hash").agg(F.first("seeds").alias("seeds")).join(nodes.hint("merge"), ["doc", "hash"])
    hits = with_holders(own.select(F.explode("seeds").alias("h"), "doc", "part"), "h")
    often = F.collect_list(F.when(F.col("n") > p.pairs, F.col("h"))).alias("often")
    per_text = staged(hits.groupBy("doc", "part").agg(F.collect_list("h").alias("shared"), often).join(nodes, ["doc", "part"]), "shared-seeds")
    for used in (hits, nodes, rows):
        discard(used)
    whole = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    frags = fragments(whole.join(per_text.hint("merge"), ["doc", "hash"]).select("doc", "part", "shared", "often", "text"), p)
    frags = staged(frags.dropDuplicates(NODE), "fragments")
    discard(per_text)
    held = holders(frags)
    pairs = staged(partners(held, p), "partners")
    found = staged(verified(pairs, frags, p), "found")
    discard(pairs)
    lone = found.where("kind = 'unreached'").select(_node("doc_id", "part", "start_word").alias("a"), "key")
    lone = lone.unionByName(held.where((F.col("n") > p.pairs) & (F.col("a.doc") == F.col("least.doc")) & (F.col("a") != F.col("least"))).select("a", "key"))
    more = rest(held, lone, frags, p)
    names = [x.split()[0] for x in PASSAGE.split(", ")]
    return found.unionByName(more).where("kind = 'passage'").select(names).distinct().unionByName(copies)
