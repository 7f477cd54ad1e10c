import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lithos.llm import packing, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts():
    rnd = random.Random(4)
    words = ["It's", "don't", "naïve", "Straße", "ÉTÉ", "x1y22", "...!!", "ª", "a\xa0b", "日本語", "é", "<|endoftext|>", "\x1cq", "İ", "don 't", "\x85", "soft\xadhy"]
    out = [" ".join(rnd.choices(words, k=n)) for n in (1, 5, 40, 200)] + words
    out += [None, "", "  ", "word " * 9000, "Word\n" * 20, "Word\n" * 20]
    return out


def test_memo_encodes_like_the_tokenizer():
    whole, memo = Tokenizer.from_file(PATH), tokens.Encoder(PATH)
    for t in texts():
        want = whole.encode(t or "", add_special_tokens=False).ids
        for _ in range(2):
            assert np.frombuffer(memo.encode(t or ""), "<u4").tolist() == want, t


def check(rows, lengths, p):
    """Gapless from 0, within every capacity, and each piece once."""
    places = {}
    for length, seq, offset in rows:
        places.setdefault(seq, []).append((offset, length))
    for spots in places.values():
        spots.sort()
        assert [o for o, _ in spots] == [sum(n for _, n in spots[:i]) for i in range(len(spots))]
        used = np.array([[n, 1, n * n] for _, n in spots]).sum(0)
        assert (used <= p.capacity).all()
    assert sorted(r[0] for r in rows) == sorted(lengths)
    return len(places)


def test_plan_is_tight_and_within_every_capacity():
    rnd = random.Random(1)
    lengths = [min(4096, int(rnd.lognormvariate(5.5, 1.2)) + 1) for _ in range(20000)] + [4096] * 50 + [777] * 9000
    counts = {n: lengths.count(n) for n in set(lengths)}
    for p in (packing.Params(), packing.Params(rule="dot"), packing.Params(documents=9, attention=4096 * 1500 + 4096**2 // 2 * 2)):
        rows = []
        for length, rank, each, bins, seq, offset in packing.plan(counts, p).tolist():
            rows += [(length, seq + i // each, offset + i % each * length) for i in range(each * bins)]
        n = check(rows, lengths, p)
        if p.documents is None:
            assert n <= 1.01 * sum(lengths) / 4096 + 1


def test_pieces_and_places(spark):
    data = [(i % 20, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame([(i, t, 9, 9) for i, t in data], "doc_id long, text string, piece int, length int").repartition(3)
    p = packing.Params()
    got = packing.pack(df, PATH, p, with_ids=True).collect()
    whole = Tokenizer.from_file(PATH)
    want = []
    for i, t in data:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4").tobytes()
            want.append((i, n, at, len(part) // 4, zlib.crc32(part)))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    check([(r.length, r.sequence_id, r.offset) for r in got], [w[3] for w in want], p)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
