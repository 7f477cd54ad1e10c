"""Dictionary mentions: aliases, n-gram matches, longest hits, ambiguity, sections."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lithos.operators.trie import Trie, longest_only
from lithos.session import staged


def term_lookup(terms: DataFrame, removed_ids: DataFrame | None = None, removed_aliases: DataFrame | None = None, stop: list[str] | None = None) -> DataFrame:
    """``(alias, type, id)`` from terms with (id, type, name, aliases): lower case, longer than three, without "/"."""
    every = terms.select("id", "type", F.explode(F.array_union(F.coalesce("aliases", F.array().cast("array<string>")), F.array("name"))).alias("alias"))
    bare = every.withColumn("alias", F.explode(F.array_distinct(F.array("alias", F.translate("alias", "®", "")))))
    bare = bare.withColumn("alias", F.lower(F.trim("alias"))).where((F.length("alias") > 3) & ~F.col("alias").contains("/"))
    if removed_ids is not None:
        bare = bare.join(removed_ids.select("id"), "id", "left_anti")
    if removed_aliases is not None:
        bare = bare.join(removed_aliases.select("id", F.lower("alias").alias("alias")), ["id", "alias"], "left_anti")
    return bare.where(~F.col("alias").isin(*(stop or [""]))).select("alias", "type", "id").distinct()


#: Most aliases, and most characters of them, that are sent to every task; a larger dictionary is dealt out in shards.
MOST_ALIASES, MOST_CHARS = 500_000, 16_000_000

_HIT = ["pos", "n", "alias"]


def _schema(docs: DataFrame, id_col: str) -> T.StructType:
    kind = next(f for f in docs.schema if f.name == id_col).dataType
    return T.StructType([T.StructField("id", kind), T.StructField("pos", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("alias", T.StringType())])


def _hits(ids: pa.Array, trie: Trie, row: np.ndarray, at: np.ndarray, size: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
    names = pa.array(trie.aliases, pa.string()).take(pa.array(number)) if len(number) else pa.array([], pa.string())
    return pa.RecordBatch.from_arrays([ids.take(pa.array(row, pa.int64())), pa.array(at, pa.int32()), pa.array(size, pa.int32()), names], ["id", *_HIT])


@lru_cache(maxsize=2)
def _trie(shared) -> Trie:
    """One trie for each worker process and dictionary."""
    return Trie(shared.value)


def mentions(docs: DataFrame, tokens: str, lookup: DataFrame, id_col: str = "doc_id", most_aliases: int = MOST_ALIASES, only_longest: bool = False) -> DataFrame:
    """``(doc_id, pos, n, alias, ...)``: every run of tokens that is an alias, of any length; pos from 0. Aliases are joined by blanks.

    ``only_longest`` leaves out hits that a longer one of the same document covers. A dictionary of at most
    ``most_aliases`` (and ``MOST_CHARS`` characters) goes to every task as a trie of tokens, and each document is read once; a larger one is
    dealt out by ``sharded_mentions``. Null texts, tokens and aliases match nothing.
    """
    aliases = lookup.where("alias is not null").select("alias").distinct()
    count, chars = aliases.agg(F.count("*"), F.coalesce(F.sum(F.length("alias")), F.lit(0))).first()
    if count > most_aliases or chars > MOST_CHARS:
        hits = sharded_mentions(docs, tokens, lookup, id_col)
        return longest(staged(hits, "hits"), id_col) if only_longest else hits
    shared = docs.sparkSession.sparkContext.broadcast([r.alias for r in aliases.collect()])

    def run(batches):
        trie = _trie(shared)
        for batch in batches:
            found = trie.walk(batch.column("tokens"))
            if only_longest:
                keep = longest_only(*found[:3])
                found = tuple(x[keep] for x in found)
            yield _hits(batch.column("id"), trie, *found)

    hits = docs.select(F.col(id_col).alias("id"), F.col(tokens).alias("tokens")).mapInArrow(run, _schema(docs, id_col)).withColumnRenamed("id", id_col)
    return hits.join(lookup, "alias") if len(lookup.columns) > 1 else hits


@dataclass(frozen=True)
class Shards:
    """``aliases`` of one trie; ``windows`` of a shard for one task; ``slots`` of the table that says which tokens begin an alias, one byte each; ``pair_slots`` of that for two tokens in a row."""

    aliases: int = 100_000
    windows: int = 1_000_000
    slots: int = 1 << 20
    pair_slots: int = 1 << 22


def sharded_mentions(docs: DataFrame, tokens: str, lookup: DataFrame, id_col: str = "doc_id", p: Shards = Shards()) -> DataFrame:
    """What ``mentions`` returns, for dictionaries of any size: the trie is dealt out in shards by the first token.

    A table of ``slots`` bytes, whatever the dictionary, says of the hash of a first token whether it is an alias by itself; one of
    ``pair_slots`` bytes holds for the hash of the first two how long their aliases get.
    A document sends, for each token with an entry, itself and as many tokens after it to the
    token's shard: one row a possible start, not one a run of tokens. Tokens that share a slot only send more. A shard with more than ``aliases`` is cut into chunks,
    each of which sees all its windows; one with more than ``windows`` is cut into salts, each of which gets all its aliases.
    So a first token may hold any share of the dictionary or of the texts. Ids and rows may repeat.
    """
    aliases = lookup.where("alias is not null").select("alias").distinct()
    first = F.substring_index("alias", " ", 1)
    aliases = staged(aliases.select("alias", F.crc32(first).alias("crc"), F.least(F.size(F.split("alias", " ")), F.lit(255)).alias("words")), "aliases")
    n_shards = max(1, -(-aliases.count() // p.aliases))
    # of a first token 1 if it is an alias by itself; of two tokens the words of their longest alias, 255: as far as the text goes
    reach = np.zeros(p.slots, np.uint8), np.zeros(p.pair_slots, np.uint8)
    pair = F.crc32(F.substring_index("alias", " ", 2))
    for table, part, slot in ((reach[0], "words = 1", F.col("crc") % p.slots), (reach[1], "words > 1", pair % p.pair_slots)):
        found = aliases.where(part).groupBy(slot.cast("int").alias("slot")).agg(F.max("words").cast("int").alias("words")).toArrow()
        table[found.column("slot").to_numpy()] = found.column("words").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(reach)
    kind = next(f for f in docs.schema if f.name == id_col).dataType
    window = T.StructType([T.StructField("id", kind), T.StructField("pos", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("tokens", T.ArrayType(T.StringType()))])
    windows = staged(docs.select(F.col(id_col).alias("id"), F.col(tokens).alias("tokens")).mapInArrow(_windows(shared, n_shards), window), "windows")
    held = aliases.groupBy((F.col("crc") % n_shards).cast("int").alias("shard")).agg(F.count("*").alias("held"))
    plan = windows.groupBy("shard").agg(F.count("*").alias("n")).join(held, "shard")
    plan = plan.select("shard", "n", F.ceil(F.col("held") / p.aliases).cast("int").alias("chunks"), F.ceil(F.col("n") / p.windows).cast("int").alias("salts"))
    plan = staged(plan, "plan")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    # null tokens may stand in windows, so what tells the two kinds of rows apart is ``head``
    heads = aliases.withColumn("shard", (F.col("crc") % n_shards).cast("int")).join(plan.hint("merge"), "shard")
    heads = heads.select("shard", F.pmod(F.xxhash64("alias"), F.col("chunks")).cast("int").alias("chunk"), each("salts").alias("salt"), F.lit(0).alias("head"), none("id", kind), none("pos", "int"), none("tokens", "array<string>"), "alias")
    rows = windows.join(F.broadcast(plan), "shard")  # a row for each ``aliases`` of the dictionary, whatever the texts
    salt = F.pmod(F.xxhash64("id", "pos"), F.col("salts")).cast("int").alias("salt")
    rows = rows.select("shard", each("chunks").alias("chunk"), salt, F.lit(1).alias("head"), "id", "pos", "tokens", none("alias", "string"))
    group = ["shard", "chunk", "salt"]
    dealt = heads.unionByName(rows).repartition(*group).sortWithinPartitions(*group, "head")
    hits = dealt.mapInArrow(_in_shards, _schema(docs, id_col)).withColumnRenamed("id", id_col)
    return hits.join(lookup, "alias") if len(lookup.columns) > 1 else hits


def _windows(shared, n_shards: int):
    """Rows (id, pos, shard, tokens) for every token that may begin an alias."""

    def run(batches):
        alone, pairs = shared.value
        for batch in batches:
            lists = batch.column("tokens")
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            coded = flat.dictionary_encode()
            known = ~coded.indices.is_null().to_numpy(zero_copy_only=False)
            code = coded.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            names = [t.encode() for t in coded.dictionary.to_pylist()]
            crc = np.fromiter((crc32(t) for t in names), np.int64, len(names))[code] if names else np.zeros(len(code), np.int64)
            past = np.cumsum(lengths)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            far = np.where(known, alone[crc % len(alone)], 0).astype(np.int64)
            first = np.flatnonzero(known[:-1] & known[1:] & (owner[:-1] == owner[1:]))
            both, which = np.unique(code[first] * len(names) + code[first + 1], return_inverse=True)  # each pair is hashed once
            hashed = np.fromiter((crc32(names[x // len(names)] + b" " + names[x % len(names)]) for x in both.tolist()), np.int64, len(both))
            far[first] = np.maximum(far[first], pairs[hashed % len(pairs)][which])
            at = np.flatnonzero(far)
            row = owner[at]
            size = np.where(far[at] == 255, past[row] - at, np.minimum(far[at], past[row] - at))
            for lo in range(0, max(len(at), 1), 100_000):  # windows overlap: in parts, for bounded memory
                part = slice(lo, lo + 100_000)
                ends = np.cumsum(size[part])
                spots = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at[part] - (ends - size[part]), size[part])
                lists_out = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), flat.take(pa.array(spots)))
                pos = at[part] - (past - lengths)[row[part]]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row[part])), pa.array(pos, pa.int32()), pa.array(crc[at[part]] % n_shards, pa.int32()), lists_out], ["id", "pos", "shard", "tokens"])

    return run


def _in_shards(batches):
    """Hits at the first token of windows; the aliases of a shard's chunk come before its windows."""
    key, aliases, trie = None, [], None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("shard", "chunk", "salt", "head")], 1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi == lo:
                continue
            this, part = tuple(keys[lo, :3].tolist()), batch.slice(lo, hi - lo)
            if this != key:
                key, aliases, trie = this, [], None
            if keys[lo, 3] == 0:
                aliases += part.column("alias").to_pylist()
                continue
            trie = trie or Trie(aliases)
            row, at, size, number = trie.walk(part.column("tokens"), anywhere=False)
            yield _hits(part.column("id"), trie, row, part.column("pos").to_numpy()[row] + at, size, number)


def ngram_mentions(docs: DataFrame, tokens: str, lookup: DataFrame, id_col: str = "doc_id", most: int = 3) -> DataFrame:
    """``(doc_id, pos, n, alias, ...)``: runs of 1 to ``most`` tokens that are an alias; pos from 0. Aliases are joined by blanks."""
    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.lit(most)),
            lambda n: F.transform(
                F.filter(F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1))), lambda p: p + n - 1 <= F.size(tokens)),
                lambda p: F.struct((p - 1).alias("pos"), n.alias("n"), F.array_join(F.slice(tokens, p, n), " ").alias("alias")),
            ),
        )
    )
    return docs.select(id_col, F.inline(grams)).join(lookup, "alias")


def longest(hits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Hits that no longer hit of the same document covers.

    A longer hit is at most a few tokens away, so each hit is joined with the longer ones by
    the places it covers rather than with all hits of its document.
    """
    spots = hits.select(id_col, F.col("pos").alias("__p"), F.col("n").alias("__n")).distinct()
    covers = spots.select(id_col, "__p", "__n", F.explode(F.sequence(F.col("__p"), F.col("__p") + F.col("__n") - 1)).alias("pos"))
    inside = (F.col("h.n") < F.col("c.__n")) & (F.col("h.pos") + F.col("h.n") <= F.col("c.__p") + F.col("c.__n"))
    on = (F.col(f"h.{id_col}") == F.col(f"c.{id_col}")) & (F.col("h.pos") == F.col("c.pos")) & inside
    return hits.alias("h").join(covers.alias("c"), on, "left_anti")


def unambiguous(hits: DataFrame, id_col: str = "doc_id", candidate: str = "id") -> DataFrame:
    """Hits at places with exactly one candidate."""
    one = hits.groupBy(id_col, "pos", "n").agg(F.count_distinct(candidate).alias("__c")).where("__c = 1").drop("__c")
    return hits.join(one, [id_col, "pos", "n"], "left_semi")


def sole_aliases(lookup: DataFrame, candidate: str = "id") -> DataFrame:
    """``(alias)`` of a lookup that have exactly one candidate, no id counting as one.

    A place's tokens are its alias, so the hits of these are those at places with one candidate; asked of
    the dictionary before the texts are read, it takes no shuffle of hits.
    """
    return lookup.select("alias", candidate).distinct().groupBy("alias").agg(F.count("*").alias("__c")).where("__c = 1").select("alias")


def sections(hits: DataFrame, title_length: str) -> DataFrame:
    """Hits over title + line break + abstract, as ``section`` and offsets inside it."""
    inside = F.col("end") <= F.col(title_length)
    shift = F.when(inside, 0).otherwise(F.col(title_length) + 1)
    return hits.withColumns({"section": F.when(inside, "title").otherwise("abstract"), "start": F.col("start") - shift, "end": F.col("end") - shift})


def without_type(hits: DataFrame, type_name: str = "conflicting") -> DataFrame:
    """Hits but for one type, whose longer matches have masked what they cover; call it after the longest hits are found."""
    return hits.where(F.col("type") != type_name)


def split_ids(hits: DataFrame, id_col: str = "id") -> DataFrame:
    """One row for each id of those joined by ";" at one place."""
    return hits.withColumn(id_col, F.explode(F.split(id_col, ";")))


def place_lookup(terms: DataFrame, classes: DataFrame) -> DataFrame:
    """``(alias, id, longitude, latitude)`` of terms of the ``classes`` (node) that have coordinates; aliases keep their case."""
    rows = terms.join(classes.select(F.col("node").alias("class")), "class", "left_semi").where("longitude is not null and latitude is not null")
    aliases = F.array_distinct(F.concat(F.coalesce("aliases", F.array().cast("array<string>")), F.array("name")))
    rows = rows.select(F.explode(aliases).alias("alias"), "id", "longitude", "latitude")
    return rows.where((F.length("alias") > 3) & ~F.col("alias").contains("/")).distinct()


def curated_terms(curated: DataFrame, labels: DataFrame, predefined: DataFrame) -> DataFrame:
    """``(id, type, name, aliases)``: curated rows (type, id, aliases by "|") with the labels (id, label) of their ids; predefined terms replace those of their id.

    The first alias is the name, of several rows of an id the last by type and aliases; aliases are sorted and distinct.
    """
    parts = F.split("aliases", "\\|")
    own = curated.select("id", "type", "aliases", F.get(parts, F.lit(0)).alias("name"), parts.alias("all"))
    own = own.groupBy("id").agg(F.max(F.struct("type", "aliases", "name")).alias("last"), F.flatten(F.collect_list("all")).alias("all"))
    found = labels.groupBy("id").agg(F.collect_set("label").alias("labels"))
    none = F.array().cast("array<string>")
    made = own.join(found, "id", "left").select("id", "last.type", "last.name", F.concat("all", F.coalesce("labels", none)).alias("aliases"))
    made = made.join(predefined.select("id"), "id", "left_anti").unionByName(predefined.select("id", "type", "name", F.coalesce("aliases", none).alias("aliases")))
    return made.withColumn("aliases", F.array_sort(F.array_distinct("aliases")))


def from_manifest(files: list[tuple[str, DataFrame]]) -> DataFrame:
    """``(load_order, type, id, name, aliases)`` of dictionary files in the manifest's order; all terms of a file get its type, but for "custom" ones, which keep theirs."""
    out = None
    for i, (kind, terms) in enumerate(files):
        rows = terms.select(F.lit(i).alias("load_order"), (F.col("type") if kind == "custom" else F.lit(kind)).alias("type"), "id", "name", "aliases")
        out = rows if out is None else out.unionByName(rows)
    return out
