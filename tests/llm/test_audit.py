"""Filter audit against a plain replay of every order on every document."""

import random
import re
from itertools import permutations

from tidemark.llm import audit


def plain(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    ids = {}
    for i, text, _ in docs:
        if i is not None:
            ids.setdefault(text or "", []).append(i)
    rows = []
    for i, text, source in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = set()
        if len(w) < 200:
            bad.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            bad.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            bad.add("C")
        if re.search(r"[#$%&*|]", t):
            bad.add("D")
        if i is not None and i > min(ids[t]):
            bad.add("E")
        rows.append((source or "", bad, i in good, i in toxic))
    out = []
    for part in sorted({r[0] for r in rows}):
        mine, taken = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0)
        lines = []
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for step, f in enumerate(order, 1):
                lost = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = sum(f in r[1] for r in mine)
                earlier = sum(f in r[1] and bool(r[1] & set(order[:step - 1])) for r in mine)
                assert failing == earlier + len(lost)
                taken[f] += len(lost)
                lines.append((part, order, step, len(left), len(lost), earlier, sum(r[1] == {f} for r in mine),
                              sum(r[2] for r in lost), sum(r[3] for r in lost), f))
        out += [(*line[:-1], taken[line[-1]]) for line in lines]
    return sorted(out)


def test_all_orders(spark):
    rng = random.Random(8)
    texts = ["", None, "short text", "UPPER CASE", "a#b", " ".join(f"w{i}" for i in range(250)),
             " ".join(f"w{i % 9}" for i in range(250)), "Price $ " + " ".join(f"v{i}" for i in range(300)),
             "É" * 50 + "\x85x\ty", "x " * 5000]
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice([None, "", "hot", "hot", "hot", "s1"]))
            for _ in range(120)]
    labels = [(rng.choice([None, *range(60)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    df = spark.createDataFrame([(*d, 1, "c") for d in docs], "doc_id long, text string, source string, part int, n string")
    lf = spark.createDataFrame([(*r, 5) for r in labels], "doc_id long, quality int, toxic int, mask int")
    got = audit.report(df.repartition(4), lf.repartition(3))
    assert got.columns == ["part", "filter_order", "step", *audit.COUNTS, "shapley"]
    assert sorted(map(tuple, got.collect())) == plain(docs, labels)
    assert audit.report(df.limit(0), lf).count() == 0
    none = audit.report(df, lf.limit(0)).collect()
    assert len(none) == 600 * 3 and all(r.good_lost == r.toxic_lost == 0 for r in none)
