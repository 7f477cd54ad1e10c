"""Benchmark decontamination by winnowing, with DataFrame functions only.

A fingerprint is the least hash of the ``gram``-word runs inside a window of ``window``
words (Schleimer et al., 2003). Equal windows have equal fingerprints, so a join of the
documents' fingerprints with the benchmark's meets every shared span of ``window`` words
or more. A document sends a fingerprint once for each run of windows that share it and at
least once in every ``window - gram + 1`` windows; a hit is then extended to each window
it stands for, and each is held word by word against the item's windows.

A document sends only fingerprints whose bit is set in a bitmap of the benchmark's, with 16 bits
or more for each up to ``most_bits``, so few rows reach the join; that one shuffles, and each row carries the few words its
fingerprint stands for.

Defined results: null and empty texts have no words and no hits; an item with fewer words
than a window is one window, an item without words none. An item without an id counts for hits but is
not among the items found. Each row of ``docs`` gives a row,
repeated ids included; rows are told apart by their places, so ``docs`` should be a table. Repeated items count once. No items: ``items_sha256`` of "".
Other columns of either input, of any name, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithos.llm.words import words
from lithos.session import staged


@dataclass(frozen=True)
class Params:
    window: int = 10
    gram: int = 5
    bits: int = 17
    most_bits: int = 22

    @property
    def span(self) -> int:
        """Grams in a window."""
        return self.window - self.gram + 1


def _windows_of(items: DataFrame, p: Params, item_col: str, text_col: str) -> DataFrame:
    """``(fp, len, item_id, windows)``: the item's windows under each fingerprint."""
    rows = items.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(p.window))
    starts = F.sequence(F.lit(1), F.size("w") - length + 1)
    rows = rows.select("item_id", length.alias("len"), F.explode(F.transform(starts, lambda s: F.slice("w", s, length))).alias("win"))
    least = F.array_min(F.transform(F.sequence(F.lit(1), F.lit(p.span)), lambda i: F.xxhash64(F.slice("win", i, p.gram))))
    fp = F.when(F.col("len") == p.window, least).otherwise(F.xxhash64("win"))
    return rows.withColumn("fp", fp).groupBy("fp", "len", "item_id").agg(F.collect_set("win").alias("windows"))


def _bitmap(bench: DataFrame, p: Params) -> Column:
    """Whether a fingerprint may be one of the benchmark's: a bit of ``2 ** p.bits``."""
    bit = F.col("fp").bitwiseAND(F.lit((1 << p.bits) - 1))
    rows = bench.select(F.shiftright(bit, 6).cast("int").alias("at"), F.expr("shiftleft(1L, cast(fp & 63L as int))").alias("bit"))
    longs = [0] * (1 << max(0, p.bits - 6))
    for r in rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).collect():
        longs[r["at"]] = r["bits"]
    return F.from_json(F.lit(str(longs)), "array<bigint>")  # a constant of the plan


def _sent(p: Params, short: list[int], bitmap: Column) -> Column:
    """The fingerprints that a document sends, each with the words it stands for, after a row for the document itself."""
    m, n = F.col("least"), F.size("w")
    kind = "array<struct<fp:bigint,at:int,len:int,around:array<string>>>"

    def known(h: Column) -> Column:
        word = F.get(bitmap, F.shiftright(h.bitwiseAND(F.lit((1 << p.bits) - 1)), 6).cast("int"))
        return F.call_function("getbit", word, h.bitwiseAND(F.lit(63)).cast("int")) == 1

    new = lambda j: ((j % p.span == 1) | (F.get(m, j - 1) != F.get(m, j - 2))) & known(F.get(m, j - 1))
    long_one = lambda j: F.struct(F.get(m, j - 1).alias("fp"), j.alias("at"), F.lit(p.window).alias("len"), F.slice("w", j, p.window + p.span - 1).alias("around"))
    steps = F.filter(F.sequence(F.lit(1), F.size(m)), new)
    itself = F.struct(F.col("row").alias("fp"), F.lit(0).alias("at"), F.lit(0).alias("len"), F.lit(None).cast("array<string>").alias("around"))
    parts = [F.array(itself).cast(kind), F.when(F.size(m) > 0, F.transform(steps, long_one).cast(kind)).otherwise(F.array().cast(kind))]

    def every(k: int) -> Column:
        steps = F.filter(F.sequence(F.lit(1), n - k + 1), lambda j: known(F.xxhash64(F.slice("w", j, k))))
        each = lambda j: F.struct(F.xxhash64(F.slice("w", j, k)).alias("fp"), j.alias("at"), F.lit(k).alias("len"), F.slice("w", j, k).alias("around"))
        return F.when(n >= k, F.transform(steps, each).cast(kind)).otherwise(F.array().cast(kind))

    return F.concat(*parts, *[every(k) for k in short])


def contamination(docs: DataFrame, items: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, n_words, n_hit, hits, item_ids, contaminated)`` for each row of ``docs``.

    ``hits`` has the first words (from 0) of the windows found with their lengths. Columns of
    ``docs`` named in ``keep`` are returned too.
    """
    bench = staged(_windows_of(items, p, item_col, item_text_col), "windows")
    sizes = {r.len: r.n for r in bench.groupBy("len").agg(F.count("*").alias("n")).collect()}
    p = replace(p, bits=max(p.bits, min(p.most_bits, (16 * sum(sizes.values())).bit_length())))
    short = sorted(k for k in sizes if k < p.window)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(F.col(id_col).alias("doc_id"), *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]).alias("own"), words(F.col(text_col)).alias("w"))
    none = F.array().cast("array<bigint>")
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - p.gram + 1), lambda i: F.xxhash64(F.slice("w", i, p.gram)))
    rows = rows.withColumn("grams", F.when(F.size("w") >= p.window, grams).otherwise(none))
    # Each array is read twice below, which keeps Spark from computing it again inside a lambda.
    least = F.transform(F.sequence(F.lit(1), F.size("grams") - p.span + 1), lambda i: F.array_min(F.slice("grams", i, p.span)))
    rows = rows.withColumn("least", F.when(F.size("grams") > 0, least).otherwise(none))
    sent = rows.select("row", "own", F.size("w").alias("n_words"), F.explode(_sent(p, short, _bitmap(bench, p))).alias("s"))
    sent = sent.select("row", "own", "n_words", "s.*")
    side = bench.withColumn("found", F.lit(True))
    met = sent.join(side, ["fp", "len"], "left").where("at = 0 or found")
    # A long fingerprint stands for the next span windows, a short one for itself.
    steps = F.sequence(F.lit(1), F.when(F.col("len") == p.window, F.lit(p.span)).otherwise(F.lit(1)))
    true_ones = F.filter(steps, lambda o: F.array_contains(F.col("windows"), F.slice(F.col("around"), o, F.col("len"))))
    starts = F.transform(true_ones, lambda o: F.struct((F.col("at") + o - 2).alias("start"), F.col("len")))
    met = met.select("row", "own", "n_words", F.when(F.col("at") > 0, starts).alias("starts"), "item_id")
    met = met.where("starts is null or size(starts) > 0")
    # The partial sums leave a row for each document and task.
    per_doc = met.groupBy("row").agg(
        F.first("own", ignorenulls=True).alias("own"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("starts")))).alias("hits"),
        F.collect_set(F.when(F.size("starts") > 0, F.col("item_id").cast("string"))).alias("items"),
    )
    reach = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, h: F.struct(
            F.greatest(acc.end, h.start + h.len).alias("end"),
            (acc.n + F.greatest(F.lit(0), h.start + h.len - F.greatest(acc.end, h.start))).alias("n"),
        ),
    )
    out = per_doc.withColumn("n_hit", reach["n"].cast("long"))
    return out.select(
        F.col("own.doc_id").alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        "n_hit",
        "hits",
        F.array_sort("items").alias("item_ids"),
        (F.col("n_hit") > 0).alias("contaminated"),
        *[F.col(f"own.k{i}").alias(c) for i, c in enumerate(keep)],
    )
