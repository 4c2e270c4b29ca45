"""Encoding against the tokenizers library, near copies against brute force."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tidemark.llm import bpe, simhash
from tidemark.llm.components import components

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n", "a" * 3000, " " * 500 + "x", "ab" * 2000, "<|endoftext|>", "x <|endoftext|>  y<|endoftext|",
       "it's we'll I'd 'S 's", "１２３ ४५ ½ ⅷ", "naïve  　text\x85\x1c\x1d!", "\U0001F600\U0001F468‍\U0001F469",
       "࢏\U000323b0 a࢏b 1\U00012550", "\r\n\t \v\f mixed   spaces ", "é \u0001\u0002"]


def samples():
    rng = random.Random(2)
    mixed = ["".join(rng.choice("aab the\n 's12é中\U0001F600 !#") for _ in range(rng.randint(0, 70))) for _ in range(300)]
    wild = ["".join(chr(rng.choice([rng.randrange(1, 0x300), rng.randrange(0x400, 0xD7FF), rng.randrange(0x10000, 0x40000)]))
                    for _ in range(40)) for _ in range(200)]
    return ODD + mixed + wild


def test_encoding_and_decoding(spark):
    texts = samples()
    rows = [(i, t, 3) for i, t in enumerate(texts)] + [(None, "x y", 3), (5, "x y", 3), (5, "x y", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    library = Tokenizer.from_file(PATH)

    def want(i, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return (i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())

    got = bpe.report(df, PATH)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(want(i, t)) for i, t, _ in rows)
    encoded = bpe.encode(df, PATH)
    assert encoded.columns == ["doc_id", "text", "ids", "n_tokens"]
    back = bpe.decode(encoded.withColumnRenamed("text", "was"), PATH).collect()
    assert all(r.text == (r.was or "") for r in back) and len(back) == len(rows)
    assert bpe.report(df.limit(0), PATH).count() == 0


def plain_print(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("bucket_rows, agree", [(2, 2), (2048, 2), (2048, 3)])
def test_near_copies(spark, bucket_rows, agree):
    rng = random.Random(4)
    words = ["Wort", "été", "the", "a", "of", "x1", "x2", "x3", " ", "Über"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    for t in texts[:30]:
        parts = t.split(" ")
        for _ in range(3):
            parts[rng.randrange(len(parts))] = rng.choice(words)
            texts.append(" ".join(parts))
    texts += texts[:5] + [None, "", " \t\n", "one", "One two", "\x1cone\x1c"]
    rows = [(1000 - i, t, 1) for i, t in enumerate(texts)] + [(None, texts[0], 1), (None, "nobody else has this text here", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    prints = {i: plain_print(t, 3) for i, t, _ in rows if i is not None}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    groups = plain_groups(prints, near)
    by_print = {prints[i]: groups[i] for i in prints}
    got = simhash.group(df, bucket_rows=bucket_rows, agree=agree).collect()
    assert len(got) == len(rows)
    for r in got:
        fp = r.fp % (1 << 64)
        if r.doc_id is None:
            assert r.component_id == by_print.get(fp)
        else:
            assert (fp, r.component_id) == (prints[r.doc_id], groups[r.doc_id]), r
    assert len(set(groups.values())) < len(groups) - 5


def test_near_copies_report(spark):
    df = spark.createDataFrame([(3, None), (2, "a b c d"), (1, "")], "doc_id long, text string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.report(df).collect()}
    assert got[3] == got[1] == ("0" * 16, 1) and got[2] == (f"{plain_print('a b c d', 3):016x}", 2)
    assert simhash.report(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(6)
    chain = [(i, i + 1) for i in range(60)]
    star = [(500, 501 + i) for i in range(80)]
    loose = [(rng.randrange(700, 800), rng.randrange(700, 800)) for _ in range(60)] + [(900, 900)]
    pairs = chain + star + loose + [(b, a) for a, b in star[:9]]
    apart = [(a, b) for a, b in pairs if a != b]
    want = plain_groups({x for pair in apart for x in pair}, apart)
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5, 12])
def test_bit_slices(radius):
    rng = random.Random(radius)
    prints = [rng.getrandbits(64) for _ in range(70)]
    for i in range(1, 70, 2):
        for _ in range(rng.randrange(14)):
            prints[i] = prints[i - 1] ^ (1 << rng.randrange(64)) if rng.random() < 0.5 else prints[i] ^ (1 << rng.randrange(64))
    near = simhash.neighbours(np.array(prints, dtype=np.uint64), radius)
    bits = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, :70]
    assert bits.tolist() == [[int((a ^ b).bit_count() <= radius) for b in prints] for a in prints]
