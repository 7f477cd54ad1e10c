"""MinHash near-duplicate groups with SuperMinHash signatures.

SuperMinHash (Ertl, 2017) gives each element of a set a random permutation of the
signature's slots. In layer ``j`` an element offers its ``j``-th slot a value in
``[j, j + 1)``, and a slot keeps the least offer. As soon as every slot of a set is filled,
no later layer can change it, so the layers stop early: one to three suffice for long sets.

The steps, all as tables in the shared folder:

1. one pass makes each document's set, its size, a digest of the whole set and its bands;
2. equal sets form one class, for which the text with the least id (and hash) stands in what follows;
3. classes sharing a band are candidates. A band's members are compared by way of a leader,
   the member that meets most others over all its bands, so a band of n gives n rows, not n * n;
4. within a leader's group whole sets are compared: all with the leader, and those it does
   not reach with every member. Groups with large sets are dealt out by size, since linked
   sets differ by a fifth at most, and then as pairs of blocks;
5. confirmed links go through connected components, and every document gets its class's.

Defined results: a null or blank text has an empty set and stays alone; fewer words than a
shingle make one shingle of the whole sequence; equal texts share a component. All texts of rows that
repeat a ``doc_id`` count, and the id is one node; a null ``doc_id`` is kept and gets the component of
equal sets, null if there is none. With ``by_text`` each text is a node of its own, whatever its id.
The order of the rows makes no difference. Input columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lithos.llm.arrays import SPACES, gram_hashes, mixed, ranges, text_slices, word_bounds, word_hashes
from lithos.operators.skew import join_counted
from lithos.operators.components import connected_components
from lithos.session import staged

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Params:
    """Links have 100 * intersection >= percent * union. The chance to miss a link at 0.8 is
    (1 - 0.8 ** rows) ** bands, 5e-8 as set; ``block`` bounds the set elements of one block."""

    words: int = 4
    percent: int = 80
    bands: int = 32
    rows: int = 4
    block: int = 400_000

    @property
    def slots(self) -> int:
        return self.bands * self.rows


def shingle_sets(column: pa.Array, p: Params):
    """(first row, the distinct sorted shingle hashes of each row) slice by slice."""
    for i, j, data, offsets in text_slices(column):
        starts, ends, first = word_bounds(data, offsets, SPACES_OUT)
        words = word_hashes(data, starts, ends)
        grams = gram_hashes(words, p.words)
        sets = []
        for k in range(j - i):
            a, b = first[k], first[k + 1]
            if b - a >= p.words:
                s = np.sort(grams[a : b - p.words + 1])
                sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            else:
                sets.append(gram_hashes(words[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
        yield i, sets


SPACES_OUT = ~SPACES


def super_minhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """A row of ``slots`` values for each set; empty sets keep the largest value everywhere."""
    sizes = np.array([len(s) for s in sets])
    sig = np.full(len(sets) * slots, EMPTY)
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    perm = None
    for layer in range(slots):
        if not len(elements):
            break
        bits = mixed(elements + np.uint64((layer + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
        at = layer + ((bits & np.uint64(0xFFFF)) * np.uint64(slots - layer) >> np.uint64(16)).astype(np.int64)
        if layer == 0:
            slot = at
        else:
            rows = np.arange(len(elements))
            slot = perm[rows, at].astype(np.int64)
            perm[rows, at] = perm[:, layer]
        np.minimum.at(sig, owner * slots + slot, np.uint64(layer << 48) | (bits >> np.uint64(16)))
        open_sets = (sig.reshape(-1, slots) == EMPTY).any(1)
        more = open_sets[owner]
        if layer == 0:
            elements, owner, at = elements[more], owner[more], at[more]
            perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(elements), 1))
            perm[np.arange(len(elements)), at] = 0
        elif not more.all():
            elements, owner, perm = elements[more], owner[more], perm[more]
    return sig.reshape(-1, slots)


def band_keys(sig: np.ndarray, p: Params) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    parts = sig.reshape(len(sig), p.bands, p.rows)
    keys = np.broadcast_to(np.arange(p.bands, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(p.rows):
        keys = mixed(keys ^ parts[:, :, r])
    return keys


def signatures(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, hash, n_shingles, digest, bands)`` of every row; an empty set has no bands and a null digest.

    ``hash`` is of the text itself.
    """

    def run(batches):
        for batch in batches:
            for i, sets in shingle_sets(batch.column("text"), p):
                keys = band_keys(super_minhash(sets, p.slots), p).view(np.int64)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                sizes = np.array([len(s) for s in sets], np.int64)
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, p.bands, 0))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[sizes > 0].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, len(sets)) for c in ("doc_id", "hash")), pa.array(sizes), pa.array(digests, pa.binary()), bands],
                    ["doc_id", "hash", "n_shingles", "digest", "bands"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, hash long, n_shingles long, digest binary, bands array<long>")


def leader_groups(classes: DataFrame) -> DataFrame:
    """``(leader, member)``: for each band shared by classes, each member with the band's leader."""
    bands = classes.select("rep", F.explode("bands").alias("key"))
    bands = staged(join_counted(bands, bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key"), "bands")
    met = bands.groupBy("rep").agg(F.sum("n").alias("met"))
    # The most met, and of those the least.
    order = F.struct(-F.col("met"), F.col("rep"))
    leaders = bands.join(met.hint("merge"), "rep").groupBy("key").agg(F.count("*").alias("n"), F.min(order)["rep"].alias("leader"))
    pairs = join_counted(bands.select("rep", "key"), leaders, "key").where("rep != leader").select("leader", F.col("rep").alias("member"))
    return staged(pairs.distinct(), "leaders")


def _links(sets: list[np.ndarray], lead: int, percent: int) -> list[tuple[int, int]]:
    """Links that connect a group as all its links would: a forest over the members' indices."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    everything = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(everything, kind="stable")
    ordered = everything[order]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    run = np.cumsum(head) - 1
    start = np.flatnonzero(head)
    length = np.diff(np.concatenate([start, [len(ordered)]]))
    run_of = np.empty(len(ordered), np.int64)
    run_of[order] = run
    holders = owner[order]
    first = np.concatenate([[0], np.cumsum(sizes)])
    part = np.arange(n)
    found = []

    def join(x: int) -> None:
        runs = run_of[first[x] : first[x + 1]]
        common = np.bincount(holders[ranges(start[runs], length[runs])], minlength=n)
        near = np.flatnonzero(100 * common >= percent * (sizes[x] + sizes - common))
        for y in near[part[near] != part[x]]:
            if part[y] != part[x]:
                found.append((x, int(y)))
                part[part == part[y]] = part[x]

    join(lead)
    reached = part == part[lead]
    for x in np.flatnonzero(~reached):
        if (part == part[0]).all():
            break
        join(int(x))
    return found


def confirmed(groups: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """``(src, dst)`` links between members of each group, enough of them to connect what all would.

    ``groups`` has (leader, member), ``sets`` has (rep, size, shingles); members are structs of id and
    hash. A group is dealt out as pairs of blocks of at most about ``p.block`` elements, each with the
    leader's set beside it. If it has more than one block, each class of size meets the next one only.
    """
    members = groups.unionByName(groups.select("leader", F.col("leader").alias("member")).distinct())
    members = members.join(sets.select(F.col("rep").alias("member"), "size").hint("merge"), "member")
    blocks = lambda: F.ceil(F.sum("size") / p.block).cast("int").alias("blocks")
    dealt = join_counted(members, members.groupBy("leader").agg(F.count("*").alias("n"), blocks()), "leader")
    leads = F.col("leader") == F.col("member")
    step = F.floor(F.log(F.col("size")) / F.log(F.lit(100 / p.percent)) + 1e-9).cast("int")
    dealt = dealt.withColumn("step", step)
    few = dealt.where("blocks = 1").select("leader", "member", F.lit(0).alias("step"), F.lit(0).alias("i"), F.lit(0).alias("j"))
    many = dealt.where("blocks > 1").select("leader", "member", "size", F.explode(F.array("step", F.col("step") + 1)).alias("step"))
    many = many.withColumn("part", F.struct("leader", "step"))
    parts = many.where(~leads).groupBy("part").agg(F.count("*").alias("n"), blocks())
    own = F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    pairs = F.transform(others, lambda o: F.struct(F.least(own, o).alias("i"), F.greatest(own, o).alias("j")))
    everywhere = F.flatten(F.transform(others, lambda i: F.transform(F.sequence(i, F.col("blocks") - 1), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    spread = join_counted(many.where(~leads), parts, "part").select("leader", "member", "step", F.inline(pairs))
    heads = parts.select("part.leader", F.col("part.leader").alias("member"), "part.step", F.inline(everywhere))
    rows = few.unionByName(spread).unionByName(heads).join(sets.select(F.col("rep").alias("member"), "shingles").hint("merge"), "member")
    rows = rows.select("leader.doc", "leader.hash", "step", "i", "j", F.col("member.doc").alias("own_doc"), F.col("member.hash").alias("own_hash"), "shingles")
    place = ["doc", "hash", "step", "i", "j"]
    rows = rows.repartition(*place).sortWithinPartitions(*place)

    def run(batches):
        key, ids, sets_ = None, [], []

        def flush():
            if len(ids) < 2 or key[:2] not in ids:
                return
            found = _links(sets_, ids.index(key[:2]), p.percent)
            if found:
                ends = [np.array([ids[x[k]] for x in found]) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(e[:, c]) for e in ends for c in (0, 1)], ["src_doc", "src_hash", "dst_doc", "dst_hash"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*place, "own_doc", "own_hash")]
            blobs = batch.column("shingles")
            for k, row in enumerate(zip(*columns)):
                if key != row[:5]:
                    yield from flush()
                    key, ids, sets_ = row[:5], [], []
                ids.append(row[5:])
                sets_.append(np.frombuffer(blobs[k].as_buffer(), np.uint64).copy())
        yield from flush()

    found = rows.mapInArrow(run, "src_doc long, src_hash long, dst_doc long, dst_hash long")
    node = lambda side: F.struct(F.col(f"{side}_doc").alias("doc"), F.col(f"{side}_hash").alias("hash")).alias(side)
    return found.select(node("src"), node("dst"))


def whole_sets(docs: DataFrame, wanted: DataFrame, p: Params) -> DataFrame:
    """``(rep, size, shingles)`` of the texts of ``docs`` (doc, hash, text) whose id and hash are in ``wanted`` as ``rep``."""

    def run(batches):
        for batch in batches:
            for i, sets in shingle_sets(batch.column("text"), p):
                sizes = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, len(sets)) for c in ("doc", "hash")), sizes, pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["doc", "hash", "size", "shingles"],
                )

    # The ids grow with the corpus, so they are never broadcast, even where they happen to be few.
    rows = docs.join(wanted.select("rep.doc", "rep.hash").hint("merge"), ["doc", "hash"], "left_semi")
    found = rows.mapInArrow(run, "doc long, hash long, size long, shingles binary")
    return found.select(F.struct("doc", "hash").alias("rep"), "size", "shingles")


#: Stands for the id of a row without one, after all others.
NO_ID = (1 << 63) - 1


def near_duplicates(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text", by_text: bool = False) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    With ``by_text`` a row is known by its id and its text's hash, rows without an id count too, and the result is
    ``(doc_id, hash, n_shingles, kept)``: one text of each group is kept, that with the least id and hash.
    """
    rows = staged(signatures(docs, p, id_col, text_col), "signatures")
    rows = rows.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID)))
    some = rows.where("digest is not null")
    best = F.min(F.struct("doc", "hash", "bands")).alias("best")
    classes = staged(some.groupBy("digest").agg(F.count("*").alias("n"), best).select("digest", "n", F.struct("best.doc", "best.hash").alias("rep"), "best.bands"), "classes")
    groups = leader_groups(classes if by_text else classes.where(F.col("rep.doc") != NO_ID))
    wanted = groups.select(F.explode(F.array("leader", "member")).alias("rep")).distinct()
    whole = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    sets = staged(whole_sets(whole, wanted, p).dropDuplicates(["rep"]), "sets")
    links = confirmed(groups, sets, p)
    reps = classes.select("digest", "n", "rep")
    if by_text:
        parts = connected_components(links)
        named = reps.join(parts.withColumnRenamed("node", "rep").hint("merge"), "rep", "left").select("digest", "n", F.coalesce("component", "rep").alias("component"))
        lone = rows.where("digest is null").select("doc_id", "hash", "n_shingles", F.lit(True).alias("kept"))
        kept = F.struct("doc", "hash") == F.col("component")
        return join_counted(some, named, "digest").select("doc_id", "hash", "n_shingles", kept.alias("kept")).unionByName(lone)
    # An id with several texts links their classes.
    with_id = some.where("doc_id is not null")
    several = with_id.groupBy("doc").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a != b").select("doc")
    own = with_id.select("doc", "digest").join(several.hint("merge"), "doc", "left_semi").distinct()
    own = own.join(reps.hint("merge"), "digest").select(F.col("doc").alias("src"), F.col("rep.doc").alias("dst"))
    parts = connected_components(links.select(F.col("src.doc").alias("src"), F.col("dst.doc").alias("dst")).unionByName(own))
    named = reps.withColumn("node", F.when(F.col("rep.doc") != NO_ID, F.col("rep.doc"))).join(parts.hint("merge"), "node", "left")
    named = named.select("digest", F.coalesce("component", "node").alias("component_id"), "n")
    found = join_counted(some, named, "digest").select("doc_id", "n_shingles", "component_id")
    out = found.unionByName(rows.where("digest is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
