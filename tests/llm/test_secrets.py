import hashlib
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from lithos.llm import queries, secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def brute(text):
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def rows():
    rnd = random.Random(5)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    texts = [None, "", "plain text", "token:token:abcdef", 'PassWord" : \'hunter22x', "api_key=abc", "apikey = abcdefg token=x secret:::abcdefgh"]
    texts += ["é😀 AKIA" + "A1" * 8, "AKIAAKIA" + "Z" * 15 + "AKIA", "f" * 24 + " " + "0123456789abcdef" * 3 + "g", "deadbeef" * 2, "x" * 5000 + " token=abcdef " * 200]
    texts += ["".join(rnd.choice(["token", "=", ":", " ", "'", "a1", "secret", "AKIA", "é", "0f", '"']) for _ in range(60)) for _ in range(40)]
    texts += ["see " + "".join(rnd.choices(b64, k=40)) + " end" for _ in range(30)]
    texts += ["unbelievablylongwordindeedyes and AnotherVeryLongCamelCaseIdentifierName" for _ in range(30)]
    return [(i, t) for i, t in enumerate(texts)]


def test_base_spans_against_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(i, t, 0) for i, t in data], "doc_id long, text string, base int")
    got = {r.doc_id: r for r in secrets.scan(df).collect()}
    for i, t in data:
        assert [tuple(s) for s in got[i].base] == brute(t), t
    random_ones = [i for i, t in data if t and t.startswith("see ")]
    assert sum(len(got[i].added) for i in random_ones) >= 0.9 * len(random_ones)
    assert all(not got[i].added for i, t in data if t and t.startswith("unbel"))
    for i in random_ones:
        assert all((s.start, s.end) == (4, 44) for s in got[i].added)


def test_added_spans_do_not_touch_base_ones(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string")
    for r in secrets.scan(df).collect():
        for a in r.added:
            assert all(b.end <= a.start or a.end <= b.start for b in r.base)


def upper(z):
    return 0.5 * math.erfc(z / math.sqrt(2))


def simes(p):
    p = sorted(p)
    return min(1.0, *(x * len(p) / (i + 1) for i, x in enumerate(p)))


def battery(s, code, p):
    """The tests in plain Python: (uniform, text)."""
    alphabet = secrets.ALPHABETS[code]
    k, n, mid = len(alphabet), len(s), (len(alphabet) - 1) / 2
    at = [alphabet.index(c) for c in s]
    kinds = ["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "s" for c in s]
    counts = Counter(s)
    chi = sum((counts[c] - n / k) ** 2 / (n / k) for c in alphabet)
    df = (k - 1) / (1 - 1 / n)
    z_chi = ((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    turns = sum((a > mid) != (b > mid) for a, b in zip(at, at[1:]))
    lag = sum((a - mid) * (b - mid) for a, b in zip(at, at[1:]))
    z_turns = max(0, abs(turns - (n - 1) / 2) - 0.5) / math.sqrt((n - 1) / 4)
    z_lag = lag / ((k * k - 1) / 12) / math.sqrt(n - 1)
    uniform = simes([upper(z_chi), min(1.0, 2 * upper(z_turns)), 2 * upper(abs(z_lag))])
    m = secrets.text_moments(alphabet, p)
    pairs = sum(c * (c - 1) / 2 for c in counts.values())
    mean = n * (n - 1) / 2 * m["s2"]
    deviation = math.sqrt(n * (n - 1) / 2 * (m["s2"] - m["s2"] ** 2) + n * (n - 1) * (n - 2) * (m["s3"] - m["s2"] ** 2))
    share = min(1 - 1e-12, sum(a != b for a, b in zip(kinds, kinds[1:])) / (n - 1))
    runs = 1.0 if share <= p.change else math.exp(-(n - 1) * (share * math.log(share / p.change) + (1 - share) * math.log((1 - share) / (1 - p.change))))
    near = upper((m["lag"] - lag / (n - 1)) / math.sqrt(m["spread"] / (n - 1)))
    return uniform, simes([upper((mean - pairs - 0.5) / deviation), runs, near])


def encoding(s):
    if not (re.search("[0-9]", s) and re.search("[A-Za-z]", s)):
        return None
    for code, pattern in (("hex", "[0-9a-f]+|[0-9A-F]+"), ("base32", "[A-Z2-7]+"), ("base36", "[a-z0-9]+")):
        if re.fullmatch(pattern, s):
            return code
    return "base64" if re.search("[a-z]", s) and re.search("[A-Z]", s) and len(re.findall("[0-9]", s)) >= 2 else None


def added(texts, p):
    """The added spans of all texts, with the correction over all candidates."""
    found = []
    for i, t in enumerate(texts):
        base = brute(t)
        for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", t or ""):
            code = encoding(m[0])
            if code and not any(b[0] < m.end() and m.start() < b[2] for b in base):
                s = m[0].translate(str.maketrans("-_", "+/"))
                uniform, text = battery(s.lower() if code == "hex" else s, code, p)
                bin_ = min(p.max_bin, math.floor(-math.log10(max(text, 1e-300)) * p.bins_per_decade)) if uniform >= p.alpha else 0
                found.append((i, m.start(), m.end(), bin_, min(29, int(math.log2(len(m[0]))))))
    kept = set()
    for size in {f[4] for f in found}:
        mine = sorted((f for f in found if f[4] == size), key=lambda f: -f[3])
        good = [f[3] for f in mine if len(mine) * 10 ** (-f[3] / p.bins_per_decade) <= p.fdr * sum(g[3] >= f[3] for g in mine)]
        kept |= {f[:3] for f in mine if good and f[3] >= max(1, min(good))}
    return kept


def key_texts(n_random, n_text, seed=8):
    """Texts with one random key or one run of ordinary characters each, as "text" draws them."""
    rnd = random.Random(seed)
    classes = {"l": "abcdefghijklmnopqrstuvwxyz", "u": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "d": "0123456789", "s": "+/"}
    share = dict(zip("luds", secrets.TEXT_MIX))
    out = []
    for i in range(n_random + n_text):
        n = rnd.choice([20, 26, 32, 40, 64])
        if i < n_random:
            alphabet = rnd.choice([secrets.ALPHABETS["base64"], secrets.ALPHABETS["base36"], secrets.ALPHABETS["base32"], "0123456789ABCDEF"])
            run = "".join(rnd.choices(alphabet, k=n))
        else:
            run, now = "", rnd.choices("luds", [share[c] for c in "luds"])[0]
            for _ in range(n):
                if rnd.random() < 0.1:
                    now = rnd.choices([c for c in "luds" if c != now], [share[c] for c in "luds" if c != now])[0]
                run += rnd.choice(classes[now])
        out.append(f"ab {run} cd")
    return out


def test_battery_and_correction_against_plain_python(spark):
    p = secrets.Params()
    texts = [t for _, t in rows()] + key_texts(120, 400)
    strings = [(s.lower() if c == "hex" else s, c) for s, c in ((t.split()[1].translate(str.maketrans("-_", "+/")), encoding(t.split()[1])) for t in key_texts(60, 60)) if c]
    strings += [("aB1" * 12, "base64"), ("abcdefghijklmnopqrst12", "base36"), ("a1" * 10, "base36")]
    df = spark.createDataFrame([(i, s, c) for i, (s, c) in enumerate(strings)], "i int, s string, c string")
    got = df.select("i", secrets.battery(F.col("s"), F.col("c"), p).alias("p")).collect()
    assert len(got) > 60
    for r in got:
        uniform, text = battery(*strings[r.i], p)
        assert math.isclose(r.p.uniform, uniform, rel_tol=1e-3, abs_tol=2e-7) and math.isclose(r.p.text, text, rel_tol=1e-3, abs_tol=2e-7)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {(r.doc_id, a.start, a.end) for r in secrets.scan(df).collect() for a in r.added}
    assert spans == added(texts, p) and spans


def test_false_discoveries_and_power(spark):
    n_random, n_text = 300, 3000
    df = spark.createDataFrame(list(enumerate(key_texts(n_random, n_text, seed=9))), "doc_id long, text string")
    found = [r.doc_id for r in secrets.scan(df).collect() if r.added]
    assert sum(i >= n_random for i in found) <= 0.02 * len(found)
    assert sum(i < n_random for i in found) >= 0.6 * n_random


def test_random_strings_pass_at_the_stated_level():
    rnd, p = random.Random(3), secrets.Params()
    for code in ("base32", "base36", "base64"):
        for n in (20, 32, 64):
            low = sum(battery("".join(rnd.choices(secrets.ALPHABETS[code], k=n)), code, p)[0] < 0.01 for _ in range(3000))
            assert low <= 0.02 * 3000
    assert battery("aB1" * 12, "base64", p)[0] < 1e-3


def test_empty_table(spark):
    assert secrets.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_digest(spark, tmp_path):
    spark.createDataFrame([(1, "token=abcdef AKIA" + "0" * 16), (2, None), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op10_secrets(spark, str(tmp_path)).collect()}
    joined = "assign:0:12,access:13:33"
    assert got[1].base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and got[1].spans == joined
    assert (got[1].n_assign, got[1].n_access, got[1].n_hex) == (1, 1, 0)
    assert got[2].spans == "" and got[2].base_sha256 == hashlib.sha256(b"").hexdigest()
