"""Secret scans with DataFrame functions only: patterns, and a battery of randomness tests.

Patterns find assignments to secret names, access keys and long hex runs. Beside them,
every run of 20 or more key characters that none of those touch is a candidate if it has a letter, a
digit and an encoding (hex, base32, base36 or base64, inferred from its characters).

The battery has three tests over the encoding's alphabet: chi-squared for its uniformity, runs, and
serial correlation at lag 1. Each gives two p-values, and Simes' rule combines the three of a kind:

* under "uniform": symbols are drawn alike and independently. A candidate with a combined value below
  ``alpha`` is not random;
* under "text": characters come in stretches of one class (lower case, upper case, digits, signs) that
  change with probability ``change``, mixed as in TEXT_MIX. Small where the symbols are more even,
  the classes change more often and neighbours are less alike than in text.

A candidate's p-value is the one under "text", or 1 if it is not random. These go through
Benjamini-Hochberg within classes of length, with all candidates of all documents counted: of the spans
reported in a class at most the share ``fdr`` is expected to be text. The counts are kept in bins of p, rounded up, so their number is fixed.

Defined results: null and empty texts have no spans. Spans are code points, end exclusive.
Each row of ``docs`` gives a row, repeated ids included; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
#: Fixed patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
RUN = r"[A-Za-z0-9+/_-]{20,}"
#: Fixed alphabets by encoding.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: The share of lower-case letters, upper-case letters, digits and signs in running text.
TEXT_MIX = (0.80, 0.09, 0.08, 0.03)
SPAN = "struct<start:int,kind:int,end:int>"
FOUND = "struct<start:int,kind:int,end:int,text:string>"


@dataclass(frozen=True)
class Params:
    min_value: int = 6
    alpha: float = 1e-3
    fdr: float = 0.01
    change: float = 0.1
    bins_per_decade: int = 4
    max_bin: int = 400


def _places(text: Column, pattern: str, kind: int, min_value: int = 0) -> Column:
    """An array of FOUND for the leftmost non-overlapping matches; those whose group 2 is short are dropped."""
    pat = F.lit(pattern)
    groups = F.regexp_extract_all(text, pat, F.lit(2 if min_value else 0))
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pat, F.lit(0)).alias("hit"), groups.alias("value"))
    kept = f"struct<pos:int,out:array<{FOUND}>>"

    def step(acc, x):
        start = acc["pos"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["hit"].alias("text")).cast(FOUND)
        good = x["hit"].isNotNull() & (F.length(x["value"]) >= min_value)
        return F.struct(F.coalesce(end, start).alias("pos"), F.when(good, F.array_append(acc["out"], one)).otherwise(acc["out"]).alias("out")).cast(kept)

    start = F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<{FOUND}>").alias("out")).cast(kept)
    every = F.aggregate(zipped, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), every).otherwise(F.array().cast(f"array<{FOUND}>"))


def _bound(value: Column, f) -> Column:
    """f(value), with the value computed once however often f reads it."""
    return F.get(F.transform(F.array(value), f), 0)


def _upper_tail(z: Column) -> Column:
    """1 - the standard normal distribution, with a relative error under 1e-4 (1e-7 absolute)."""

    def tail(z):
        x = F.least(F.lit(30.0), F.abs(z))
        t = 1.0 / (1.0 + 0.2316419 * x)
        near = F.lit(0.0)
        for c in (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530):
            near = (near + c) * t
        far = x  # a continued fraction
        for i in range(24, 0, -1):
            far = x + i / far
        return F.exp(-x * x / 2) * 0.3989422804014327 * F.when(x < 2, near).otherwise(1.0 / F.greatest(far, F.lit(1.0)))

    return _bound(z, lambda z: F.when(z >= 0, tail(z)).otherwise(1 - tail(z)))


def _encoding(s: Column) -> Column:
    both = s.rlike("[0-9]") & s.rlike("[A-Za-z]")
    return (
        F.when(~both, None)
        .when(s.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(s.rlike("^[A-Z2-7]+$"), "base32")
        .when(s.rlike("^[a-z0-9]+$"), "base36")
        .when(s.rlike("[a-z]") & s.rlike("[A-Z]") & (F.length(F.regexp_replace(s, "[^0-9]", "")) >= 2), "base64")
    )


def text_moments(alphabet: str, p: Params) -> dict[str, float]:
    """Under "text": sums of the symbols' squared and cubed shares, and the mean and variance of a lag product.

    Classes are those of the alphabet, in the proportions of TEXT_MIX, symbols alike within a class. A mean of lag
    products varies more than independent ones would; the variance is that of one, times what neighbours share.
    """
    groups = [[i for i, c in enumerate(alphabet) if kind(c)] for kind in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum())]
    used = [(share, g) for share, g in zip(TEXT_MIX, groups) if g]
    total = sum(share for share, _ in used)
    mid, q = (len(alphabet) - 1) / 2, [share / total for share, _ in used]
    mean = [sum(i - mid for i in g) / len(g) for _, g in used]
    square = [sum((i - mid) ** 2 for i in g) / len(g) for _, g in used]
    # The next class is the same with probability 1 - change, else another in its proportion.
    step = [[1 - p.change if c == d else p.change * q[d] / (1 - q[c]) for d in range(len(q))] if len(q) > 1 else [1.0] for c in range(len(q))]
    pairs = [(q[c] * step[c][d], c, d) for c in range(len(q)) for d in range(len(q))]
    lag = sum(w * mean[c] * mean[d] for w, c, d in pairs)
    spread = sum(w * square[c] * square[d] for w, c, d in pairs) - lag**2
    return {
        "s2": sum(x * x / len(g) for x, (_, g) in zip(q, used)),
        "s3": sum(x**3 / len(g) ** 2 for x, (_, g) in zip(q, used)),
        "lag": lag,
        "spread": spread * (2 - p.change) / p.change if len(q) > 1 else spread,
    }


def _simes(*p: Column) -> Column:
    return _bound(F.array_sort(F.array(*p)), lambda x: F.least(F.lit(1.0), *[F.element_at(x, i + 1) * len(p) / (i + 1) for i in range(len(p))]))


def battery(s: Column, code: Column, p: Params) -> Column:
    """(uniform, text): the tests' combined p-values for a string under either hypothesis."""
    text = {name: text_moments(alphabet, p) for name, alphabet in ALPHABETS.items()}
    of = lambda values: F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[code]
    alphabet = of(ALPHABETS)
    count = F.aggregate(
        F.split(alphabet, ""),
        F.lit(0.0),
        lambda acc, c: acc + F.when(c == "", 0.0).otherwise(F.pow(F.length(s) - F.length(F.replace(s, c, F.lit(""))), F.lit(2.0))),
    )
    kind = lambda c: F.when(c.between("0", "9"), 0).when(c.between("a", "z"), 1).when(c.between("A", "Z"), 2).otherwise(3)
    codes = F.transform(F.filter(F.split(s, ""), lambda c: c != ""), lambda c: F.struct((F.instr(alphabet, c).cast("double") - 1).alias("at"), kind(c).alias("kind")))
    kept = "struct<last:double,kind:int,turns:double,changes:double,lag:double>"
    zero = F.struct(F.lit(-1.0).alias("last"), F.lit(-1).alias("kind"), *[F.lit(0.0).alias(c) for c in ("turns", "changes", "lag")]).cast(kept)
    mid = (F.length(alphabet) - 1) / 2

    def step(acc, x):
        later = acc["last"] >= 0
        return F.struct(
            x["at"].alias("last"),
            x["kind"].alias("kind"),
            (acc["turns"] + F.when(later & ((acc["last"] > mid) != (x["at"] > mid)), 1.0).otherwise(0.0)).alias("turns"),
            (acc["changes"] + F.when(later & (acc["kind"] != x["kind"]), 1.0).otherwise(0.0)).alias("changes"),
            (acc["lag"] + F.when(later, (acc["last"] - mid) * (x["at"] - mid)).otherwise(0.0)).alias("lag"),
        ).cast(kept)

    def tests(v):
        k, n, squares, acc = v["k"], v["n"], v["squares"], v["seen"]
        # Chi-squared has mean k - 1 and variance 2 (k - 1) (1 - 1 / n): a gamma variable with those.
        chi, df = squares * k / n - n, (k - 1) / (1 - 1 / n)
        z_chi = (F.pow(chi / (k - 1), F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        # Runs about the alphabet's middle: each step turns with probability one half.
        turns = F.greatest(F.lit(0.0), F.abs(acc["turns"] - (n - 1) / 2) - 0.5) / F.sqrt((n - 1) / 4)
        lag = acc["lag"] / ((k * k - 1) / 12) / F.sqrt(n - 1)
        uniform = _simes(_upper_tail(z_chi), F.least(F.lit(1.0), 2 * _upper_tail(turns)), 2 * _upper_tail(F.abs(lag)))
        # Chi-squared grows with the pairs of equal symbols, whose moments are known for any shares of the symbols.
        pairs, mean = (squares - n) / 2, n * (n - 1) / 2 * v["s2"]
        deviation = F.sqrt(n * (n - 1) / 2 * (v["s2"] - v["s2"] * v["s2"]) + n * (n - 1) * (n - 2) * (v["s3"] - v["s2"] * v["s2"]))
        # Runs of a class: Chernoff's bound of a binomial tail. The others: few equal pairs, a small lag product.
        share = F.least(F.lit(1 - 1e-12), acc["changes"] / (n - 1))
        bound = F.exp(-(n - 1) * (share * F.log(share / p.change) + (1 - share) * F.log((1 - share) / (1 - p.change))))
        runs = F.when(share <= p.change, 1.0).otherwise(bound)
        even = _upper_tail((mean - pairs - 0.5) / deviation)
        near = _upper_tail((v["mean"] - acc["lag"] / (n - 1)) / F.sqrt(v["spread"] / (n - 1)))
        return F.struct(uniform.alias("uniform"), _simes(even, runs, near).alias("text"))

    moments = [of({k: v[c] for k, v in text.items()}).alias(a) for c, a in (("s2", "s2"), ("s3", "s3"), ("lag", "mean"), ("spread", "spread"))]
    sizes = [F.length(alphabet).cast("double").alias("k"), F.length(s).cast("double").alias("n")]
    return _bound(F.struct(*sizes, count.alias("squares"), F.aggregate(codes, zero, step).alias("seen"), *moments), tests)


def candidates(found: Column, base: Column, p: Params) -> Column:
    """(start, end, bin of p, length class) of the runs that no base span touches and that have an encoding."""
    free = F.filter(found, lambda r: ~F.exists(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    named = F.transform(free, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["text"].alias("s"), _encoding(r["text"]).alias("code")))
    named = F.filter(named, lambda r: r["code"].isNotNull())

    def plain(r):
        s = F.translate(r["s"], "-_", "+/")
        return F.when((r["code"] == "hex"), F.lower(s)).otherwise(s)

    named = F.transform(named, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), plain(r).alias("s"), r["code"].alias("code")))
    named = F.transform(named, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), F.length(r["s"]).alias("n"), battery(r["s"], r["code"], p).alias("p")))

    def bin_of(r):
        decades = F.when(r["p"]["uniform"] >= p.alpha, -F.log10(F.greatest(r["p"]["text"], F.lit(1e-300)))).otherwise(0.0)
        return F.least(F.lit(p.max_bin), F.floor(decades * p.bins_per_decade)).cast("int")

    return F.transform(
        named, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), bin_of(r).alias("bin"), F.least(F.lit(29), F.floor(F.log2(r["n"]))).cast("int").alias("size"))
    )


def _least_bins(scans: DataFrame, p: Params) -> dict[int, int]:
    """By class of length, the least bin that Benjamini-Hochberg rejects; at most 30 classes of max_bin bins."""
    each = scans.select(F.explode("candidates").alias("c"))
    counts = each.groupBy("c.size", "c.bin").agg(F.count("*").alias("n"))
    whole, above = Window.partitionBy("size"), Window.partitionBy("size").orderBy(F.desc("bin"))
    ranked = counts.withColumn("m", F.sum("n").over(whole)).withColumn("rank", F.sum("n").over(above))
    good = ranked.where(F.col("m") * F.pow(F.lit(10.0), -F.col("bin") / p.bins_per_decade) / F.col("rank") <= p.fdr)
    return {r.size: r.least for r in good.groupBy("size").agg(F.min("bin").alias("least")).collect()}


def scan(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(doc_id, base, added)``: arrays of (start, kind, end) by start, then kind, an index of KINDS.

    With ``keep``, those columns of ``docs`` and a struct ``found`` of base and added instead.
    The texts are read twice, first for the histogram; nothing is shuffled but that.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.array_sort(F.concat(_places(text, ASSIGN, 0, p.min_value), _places(text, ACCESS, 1), _places(text, HEX, 2)))
    own = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.col(id_col).alias("doc_id"))
    found = docs.select(own.alias("own"), base.alias("base"), _places(text, RUN, 3).alias("runs"))
    spans = F.transform("base", lambda b: F.struct(b["start"], b["kind"], b["end"]).cast(SPAN))
    scans = found.select("own", spans.alias("base"), "runs")
    scans = scans.select("own", "base", candidates(F.col("runs"), F.col("base"), p).alias("candidates"))
    least = _least_bins(scans, p)
    table = F.create_map(*[F.lit(x) for pair in least.items() for x in pair]) if least else None

    def passed(c):
        if table is None:
            return F.lit(False)
        return (c["bin"] > 0) & (c["bin"] >= F.coalesce(F.try_element_at(table, c["size"]), F.lit(p.max_bin + 1)))

    added = F.transform(F.filter("candidates", passed), lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")).cast(SPAN))
    if keep:
        return scans.select("own.*", F.struct("base", added.alias("added")).alias("found"))
    return scans.select("own.doc_id", "base", added.alias("added"))


def named(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
