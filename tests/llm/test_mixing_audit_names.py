"""Source mixing, the filter audit and the name join against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from chronofold.llm import filter_audit, mixing, name_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def levels(sizes, weights, epochs):
    """Targets by sharing the excess again and again."""
    named = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(named)}
    target, left, free = {}, sum(sizes.values()), set(named)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > epochs * sizes[s]}
        if not over:
            return target | share
        target |= {s: epochs * sizes[s] for s in over}
        left -= sum(epochs * sizes[s] for s in over)
        free -= over
    return target


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["ab", "c\té", "d\n"]) for _ in range(n))
    rows = [(i, text(rng.randint(0, 60)), rng.choice(["s1", "s2", "B", "é", None]), "x") for i in range(400)]
    rows += [(500, None, "empty", "x"), (501, "", "empty", "x"), (502, "one", "tiny", "x"), (7, rows[7][1], rows[7][2], "again"), (None, text(9), "s1", "x"), (None, text(8), "s1", "x")]
    rows += [(600, text(3000), "s2", "long")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


@pytest.mark.parametrize("seed", [0, 5])
def test_mix_takes_each_budget_exactly(spark, mixed, seed):
    rows, docs = mixed
    got = mixing.mix(docs, (5, 2, 1), 3, seed).collect()
    assert [(r.doc_id, r.taken) for r in sorted(got, key=str)] == [(r.doc_id, r.taken) for r in sorted(mixing.mix(docs.repartition(7), (5, 2, 1), 3, seed).collect(), key=str)]
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((k, s, len(WORD.findall(t or ""))) for k, t, s, _ in rows)
    sizes = Counter()
    for _, t, s, _ in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want, taken = levels(sizes, (5, 2, 1), 3), Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.taken <= 3 * r["size"]
    assert all(taken[s] == int(want[s] + 1e-9) for s in sizes)
    assert max(want[s] / sizes[s] for s in sizes if sizes[s]) == 3


def test_mix_range_width_does_not_matter(spark, mixed, monkeypatch):
    _, docs = mixed
    one = Counter((r.doc_id, r.taken) for r in mixing.mix(docs).collect())
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)
    assert Counter((r.doc_id, r.taken) for r in mixing.mix(docs).collect()) == one


def test_mixture_gives_the_words_that_were_taken(spark, mixed):
    _, docs = mixed
    out = mixing.mixture(docs)
    assert out.columns == ["doc_id", "text", "source", "size", "epoch"]
    have, want = Counter(), Counter()
    for r in out.collect():
        have[r.doc_id, r.source] += len(WORD.findall(r.text))
    for r in mixing.mix(docs).where("taken > 0").collect():
        want[r.doc_id, r.source] += r.taken
    assert have == want


def test_mix_of_nothing(spark, mixed):
    _, docs = mixed
    assert mixing.mix(docs.limit(0)).count() == 0
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(docs.where("source = 'empty'")).collect()] == [(0, 0.0, 0)] * 2


def audited(rows, labels):
    def mask(k, t):
        w, t = WORD.findall(t or ""), t or ""
        tests = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), re.search(r"[#$%&*|]", t),
                 any(k is not None and k2 is not None and k2 < k and (t2 or "") == t for k2, t2, _ in rows))
        return {f for f, x in zip("ABCDE", tests) if x}

    good, toxic = {k for k, q, _ in labels if q == 1} - {None}, {k for k, _, x in labels if x == 1} - {None}
    found = [(s or "", mask(k, t), k in good, k in toxic) for k, t, s in rows]
    out = {}
    shapley = Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {f[0] for f in found}:
            left = [f for f in found if f[0] == part]
            for step, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                fails = sum(f in x[1] for x in found if x[0] == part)
                out[part, order, step + 1] = (len(left), len(gone), fails - len(gone), sum(x[1] == {f} for x in found if x[0] == part), sum(x[2] for x in gone), sum(x[3] for x in gone))
                shapley[part, f] += len(gone)
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_audit(spark):
    rng = random.Random(8)
    word = lambda: rng.choice(["Aa", "b", "C", "dé", "$x", "e" * 9]) if rng.random() < 0.1 else f"w{rng.randint(0, 300)}"
    texts = [" ".join(word() for _ in range(rng.choice([3, 150, 210, 260]))) for _ in range(60)] + ["a " * 250, "", None, "#", "x y " * 4000]
    rows = [(i, rng.choice(texts), rng.choice(["p", "q", "", None])) for i in range(150)] + [(900 + i, texts[0], "hot") for i in range(120)]
    rows += [(5, rows[5][1], "q"), (5, texts[1], "p"), (None, texts[0], "p"), (None, texts[0], "p"), (None, "alone", "q")]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 1000, 3)] + [(3, 1, 0), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, print int").repartition(3)
    marks = spark.createDataFrame([(*x, "p") for x in labels], "doc_id long, quality int, toxic int, part string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filter_audit.audit(docs, marks).collect()}
        spread = filter_audit.masks(docs).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread == len(rows) and got == audited(rows, labels)
    assert filter_audit.audit(docs.limit(0), marks).count() == 0


def osa(u, v):
    m, n = len(u), len(v)
    d = [[i + j if not i or not j else 0 for j in range(n + 1)] for i in range(m + 1)]
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (u[i - 1] != v[j - 1]))
            if i > 1 and j > 1 and u[i - 1] == v[j - 2] and u[i - 2] == v[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[m][n]


def names(rng, n, letters):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(n)]


@pytest.mark.parametrize("letters", ["ab", "abcdé ", "ab\U0001f600"])
def test_automata_traversal(letters):
    rng = random.Random(letters)
    for distance in (0, 1, 2, 3):
        one, two = sorted(set(names(rng, 60, letters))), sorted(set(names(rng, 60, letters)))
        want = {(i, j): d for i, x in enumerate(one) for j, y in enumerate(two) if (d := osa(x, y)) <= distance}
        assert name_join.matches(one, two, distance) == want
        for x, y in itertools.product(one, two):
            if osa(x, y) <= distance:
                assert name_join.alive([x[:k] for k in range(1, 9)], [y[:4] for _ in range(8)], distance).all()


def test_automaton_is_minimal():
    words = sorted(a + b for a in ("x", "yy", "z") for b in ("ing", "ed", ""))
    found = name_join.Automaton(words)
    assert len({(f, tuple(e.items())) for f, e in zip(found.final, found.edges)}) == len(found.edges) and found.count[found.root] == 9
    assert len(found.edges) <= 8


@pytest.mark.parametrize("most", [3, 4000])
def test_similar_names(spark, most):
    rng = random.Random(most)
    one, two = names(rng, 150, "abcd"), names(rng, 120, "abcd") + ["long" * 3000]
    one += [None, "", "é", one[0], "long" * 3000, "lnog" + "long" * 2999, "abcdefghijklmnopq", "abcdefghijklmnop"]
    two += [None, "", "éx", "abcdefghijklmnoqp"]
    left = spark.createDataFrame([(n, 1) for n in one], "name string, l int")
    right = spark.createDataFrame([(n, 1) for n in two], "name string, node int")
    got = Counter((r.l, r.r, r.distance) for r in name_join.similar_names(left, right, most=most).collect())
    short = lambda x: len(x) < 100
    want = {(a, b, osa(a, b)) for a in set(filter(None, one)) for b in set(filter(None, two)) if short(a) == short(b) and short(a) and osa(a, b) <= 2}
    assert got == Counter(want | {("long" * 3000, "long" * 3000, 0), ("lnog" + "long" * 2999, "long" * 3000, 1)})
    assert name_join.similar_names(left.limit(0), right).count() == 0


def test_link_vendors(spark):
    rng = random.Random(1)
    clients = [(i, rng.choice(["anna bo", "anan bo", "clé", "é", None, "", "x" * 30])) for i in range(80)] + [(None, "clé"), (3, "clé")]
    stored = [(i, rng.choice(["anna bo", "clé", "e", "", None, "clee", "a"])) for i in range(40)] + [(2, "anna bo"), (2, "clé")]

    def turned(k, n):
        h = zlib.crc32(str(k).encode())
        if not n or h % 2 or len(n) < 2:
            return n
        p = h % (len(n) - 1)
        return n[:p] + n[p + 1] + n[p] + n[p + 2 :]

    from pyspark.sql import functions as F

    vendors = spark.createDataFrame(stored, "vendor_id long, name string")
    vendors = vendors.select("vendor_id", name_join.misspelt(F.col("name"), F.col("vendor_id")).alias("name"))
    assert Counter(tuple(r) for r in vendors.collect()) == Counter((k, turned(k, n)) for k, n in stored)
    got = Counter(tuple(r) for r in name_join.link_vendors(spark.createDataFrame(clients, "client_id long, name string"), vendors).collect())
    want = Counter()
    for k, n in {(k, turned(k, n)) for k, n in stored}:
        by = {}
        for c, m in clients:
            if n and m and osa(m, n) <= 2:
                by.setdefault(osa(m, n), []).append(c)
        for d, ids in by.items():
            known = [c for c in ids if c is not None]
            want[k, d, len(ids), min(known, default=None), sum(zlib.crc32(str(c).encode()) for c in known)] += 1
    assert got == want
