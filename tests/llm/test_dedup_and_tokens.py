"""Suffix dedup, SimHash, decontamination, tokenizers and the classifier against brute force and their libraries."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronofold.llm import decontaminate, quality_classifier, sentence_pieces, simhash, suffix_dedup, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randint(0, vocabulary)}é" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    base = [words(rng, rng.randint(1, 120)) for _ in range(30)]
    passage = words(rng, 40)
    rows = list(enumerate(base))
    rows += [(100 + i, f"{words(rng, 9)} {passage} {words(rng, 5)}") for i in range(6)]
    rows += [(200, base[3]), (201, base[3]), (202, "a" * 700), (203, "ab" * 400), (204, None), (205, ""), (206, passage + passage), (207, "x"), (208, passage[:99]), (209, passage[:100])]
    return rows


def removed(rows):
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            w = data[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out[key] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("segment", "hot"), [(1 << 20, 20_000), (256, 20_000), (1 << 20, 1)])
def test_suffix_dedup(spark, corpus, monkeypatch, segment, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", hot)
    if segment != 1 << 20:
        # Texts of several segments: every window lies in one, and so does every match across their ends.
        monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
        corpus = [(k, (t or "") * 4) for k, t in corpus]
        texts = [t for _, t in corpus]
        rows = list(suffix_dedup.window_runs(texts))
        assert sum(int(n.sum()) for *_, n in rows) == sum(max(len(t.encode()) - 99, 0) for t in texts)
        seen: dict[int, set] = {}
        for row, gram, _, start, n in rows:
            for r, g, s, k in zip(row, gram, start, n):
                seen.setdefault(int(r), set()).update((int(s) + i, int(g)) for i in range(int(k)))
        monkeypatch.setattr(suffix_dedup, "SEGMENT", 1 << 20)
        one: dict[int, set] = {}
        for row, gram, _, start, n in suffix_dedup.window_runs(texts):
            for r, g, s, k in zip(row, gram, start, n):
                one.setdefault(int(r), set()).update((int(s) + i, int(g)) for i in range(int(k)))
        assert seen == one
        return
    docs = spark.createDataFrame(corpus, "doc_id long, text string").withColumn("n_bytes", F.lit(1)).repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.span_digests(docs).collect()}
    assert got == removed(corpus)


def test_refinement_matches_a_set():
    rng = random.Random(1)
    pieces = ["".join(rng.choice("ab") for _ in range(rng.randint(100, 140))).encode() for _ in range(20)]
    pieces += pieces[:3] + [b"a" * 130, b"a" * 120]
    at, repeated = suffix_dedup.refine(b"".join(pieces), np.array([len(p) for p in pieces]))
    begins = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    seen, want = set(), []
    for b, p in zip(begins, pieces):
        for i in range(len(p) - 99):
            want.append((int(b) + i, p[i : i + 100] in seen))
            seen.add(p[i : i + 100])
    assert list(zip(at.tolist(), repeated.tolist())) == want


def test_suffix_dedup_keeps_characters_and_columns(spark, corpus):
    docs = spark.createDataFrame([(k, t, "s") for k, t in corpus], "doc_id long, text string, spans string")
    out = suffix_dedup.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(corpus)
    assert all("�" not in (r.text or "") and r.spans == "s" for r in out.collect())
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_repeated_rows_are_one_document(spark):
    text = words(random.Random(2), 60)
    got = suffix_dedup.span_digests(spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, len(text.encode()))]


def removed_rows(rows):
    """(id, text) -> (bytes, removed, spans, rest) by the contract, where rows of one id with unlike texts are documents of their own."""
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    first, out = {}, {}
    for key, text in docs:
        data = (text or "").encode()
        for p in range(len(data) - 99):
            first.setdefault(data[p : p + 100], key)
    for key, text in docs:
        data, own = (text or "").encode(), set()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            w = data[p : p + 100]
            if first[w] != key or w in own:
                gone[p : p + 100] = b"\1" * 100
            own.add(w)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out[key, text] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [20_000, 1])
def test_unlike_texts_under_one_id_are_documents_of_their_own(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", hot)
    rng = random.Random(12)
    parts = [words(rng, 30) for _ in range(7)]
    a, b = parts[0] * 2, parts[1]
    rows = [(1, a), (2, a), (2, b), (None, parts[2] + "x"), (None, "y" + parts[2]), (None, parts[3]), (3, parts[4] + "1"), (3, parts[4] + "2" + parts[4]), (4, "z" + parts[4])]
    rows += [(5, parts[5]), (5, parts[5]), (5, "q" + parts[5]), (0, parts[6]), (None, parts[6] + parts[2]), (2, None), (2, "")]
    rows += [(rng.choice([None, 7, 8, 9]), " ".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))) for _ in range(25)]
    docs = spark.createDataFrame([(*r, "d") for r in rows], "doc_id long, text string, digest string").repartition(3)
    want = removed_rows(rows)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.span_digests(docs).collect()), key=str)
    assert got == sorted(((k, *want[k, t]) for k, t in rows), key=str)
    cut = suffix_dedup.remove_repeats(docs)
    assert cut.columns == ["doc_id", "text", "digest"] and cut.count() == len(rows)
    few = [(1, a), (2, a), (2, b), (None, parts[2] + "x"), (None, "y" + parts[2]), (None, parts[3]), (2, None)]
    left = {(r.doc_id, r.text) for r in suffix_dedup.remove_repeats(spark.createDataFrame(few, "doc_id long, text string")).collect()}
    assert left == {(1, parts[0]), (2, ""), (2, b), (None, parts[2] + "x"), (None, "y" + parts[2]), (None, parts[3]), (2, None)}


def test_fingerprints():
    import xxhash

    for text in [None, "", " \n", "A", "a B", "A b c D e", "A b c D e " * 50]:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_manhattan_is_a_lower_bound():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 1 << 63, 2000, dtype=np.uint64), rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    low = simhash.manhattan(simhash.popcount_segments(a), simhash.popcount_segments(b))
    count = lambda v: [(int(v) >> i & 3).bit_count() for i in range(0, 64, 2)]
    assert all(int(x) == sum(abs(p - q) for p, q in zip(count(u), count(v))) for x, u, v in zip(low[:50], a, b))
    assert (low <= np.bitwise_count(a ^ b)).all()


@pytest.mark.parametrize("chunk", [4096, 3])
def test_links_connect_what_brute_force_connects(spark, chunk):
    rng = random.Random(9)
    fps = [0, 7, (1 << 64) - 1]
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(8):
            fps.append(f)
            for _ in range(rng.randint(1, 3)):
                f ^= 1 << rng.randint(0, 63)
    fps = sorted(set(fps))
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    found = simhash.components(simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), chunk=chunk))
    root = {r.node: r.root for r in found.collect()}
    group = list(range(len(fps)))
    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            a, b = group[i], group[j]
            group = [a if g == b else g for g in group]
    classes = {}
    for s, g in zip(signed, group):
        classes.setdefault(g, set()).add(root.get(s, s))
    assert all(len(c) == 1 for c in classes.values()) and len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_near_duplicates_edges(spark):
    rows = [(5, "a b c d"), (3, "A b C d"), (9, None), (8, ""), (3, "A b C d"), (None, "a b c d"), (11, "quite another text here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == [(-1, 3), (3, 3), (3, 3), (5, 3), (8, 8), (9, 8), (11, 11)]
    assert sorted(r.doc_id for r in simhash.keep_representatives(docs).collect()) == [3, 8, 11]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_group_whatever_its_id(spark):
    one, two, three = "a b c d", "quite another text here", "and a third one that is unlike both"
    keep = lambda rows: sorted((r.doc_id or -1, r.text) for r in simhash.keep_representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert keep([(None, one), (None, two), (None, one), (4, three)]) == [(-1, one), (-1, two), (4, three)]
    assert keep([(3, one), (3, two), (3, two)]) == [(3, one), (3, two)]
    # The id of a group's duplicate is the representative of another group.
    assert keep([(1, one), (2, one), (2, two), (5, two)]) == [(1, one), (2, two)]
    assert keep([(None, one), (7, one), (None, None), (None, "")])[1:] == [(7, one)]


def contaminated(text, items):
    low = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, ids = low(text), set(), set()
    for key, t in items:
        b = low(t)
        for win in [b[i : i + 10] for i in range(max(len(b) - 9, 1))] if b else []:
            for s in range(len(w) - len(win) + 1):
                if w[s : s + len(win)] == win:
                    hit |= set(range(s, s + len(win)))
                    ids.add(str(key))
    return len(w), len(hit), sorted(ids)


def test_decontamination(spark):
    rng = random.Random(6)
    items = [(i, words(rng, 14, 60)) for i in range(8)] + [(20, "Short one"), (21, None), (22, "..."), (23, "solo"), (24, "go go go go go go go go go go go"), (3, "dup id here")]
    docs = [(i, words(rng, 30, 60)) for i in range(10)]
    docs += [(50 + i, f"{words(rng, 4)} {t.upper() if i % 2 else t}, {words(rng, 3)}") for i, (_, t) in enumerate(items[:8])]
    docs += [(90, None), (91, ""), (92, "...Short-one; SOLO"), (93, "go " * 25), (None, items[0][1]), (50, docs[10][1]), (94, "ÀSHORT one short ONE")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("win", F.lit(1))
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("term", F.lit("clash"))
    rows = decontaminate.contamination(frame, bench, extra=("text",)).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, hit, ids = contaminated(r.text, items)
        assert (r.n_words, r.n_hit, list(r["items"]), r.contaminated) == (n, hit, ids, hit > 0), r.text
    for none in (decontaminate.contamination(frame.limit(0), bench), decontaminate.contamination(frame, bench.limit(0)).where("contaminated")):
        assert none.count() == 0


def test_decontamination_is_native_and_finds_near_terms(spark, monkeypatch):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha x x beta gamma"), (2, "alpha " + "x " * 50 + "beta"), (3, "y alpha, beta. GAMMA delta"), (3, "z")], "doc_id long, text string")
    for limit in (16 << 20, 0):  # broadcast, and shuffled
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
        found = decontaminate.contamination(docs, bench)
        assert "Python" not in found._jdf.queryExecution().toString()
        assert sorted((r.doc_id, r.n_words, r.n_hit) for r in found.collect()) == [(1, 5, 0), (2, 52, 0), (3, 1, 0), (3, 5, 4)]
        windows, _ = decontaminate.benchmark_windows(bench)
        rows = decontaminate.store_rows(docs)
        index = decontaminate.build_index(rows)
        assert index.count() == 5 + 52 + 5 + 1
        near = decontaminate.near_matches(index, windows, decontaminate.term_counts(index, windows), 20).join(rows, "row").collect()
        # delta and gamma are the rarest; only document 3 has both.
        assert [(r.carried.key, r.distance) for r in near] == [(3, 1)]


def test_decontamination_of_a_very_long_text_and_clashing_columns(spark):
    rng = random.Random(3)
    item = words(rng, 12, 50_000)
    long = words(rng, 120_000, 50_000) + " " + item + " " + words(rng, 50, 50_000)
    bench = spark.createDataFrame([(5, item), (6, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, long, "r"), (2, None, "s")], "doc_id long, text string, row string").withColumn("carried", F.lit("c")).withColumn("n_hit", F.lit("h"))
    got = {r.doc_id: r for r in decontaminate.contamination(docs, bench, extra=("row", "carried")).collect()}
    assert (got[1].n_words, got[1].n_hit, list(got[1]["items"]), got[1].row, got[1].carried) == (120_062, 12, ["5", "6"], "r", "c")
    assert (got[2].n_words, got[2].n_hit, got[2].contaminated) == (0, 0, False)


def test_near_passages(spark):
    rng = random.Random(12)
    # A changed word: delta and omega stand in no document.
    items = [(1, "alpha beta gamma delta"), (2, "one"), (3, None), (4, "go go go go"), (7, "omega kappa sigma")] + [(10 + i, words(rng, 13, 90)) for i in range(5)]
    docs = [(1, "alpha x x beta gamma"), (2, "alpha " + "x " * 50 + "beta"), (None, "Sigma, kappa"), (4, None), (5, "go go one")]
    docs += [(20 + i, words(rng, 45, 90)) for i in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    low = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    count = {}
    for w in [w for _, t in docs for w in low(t)]:
        count[w] = count.get(w, 0) + 1
    want = {}
    for key, text in items:
        b = low(text)
        for win in [b[i : i + 10] for i in range(max(len(b) - 9, 1))]:
            pair = sorted({w for w in win if w in count}, key=lambda w: (count[w], w))[:2]
            for doc, body in docs if len(pair) == 2 else []:
                w = low(body)
                gaps = [abs(i - j) for i, x in enumerate(w) for j, y in enumerate(w) if x == pair[0] and y == pair[1] and abs(i - j) <= 20]
                if gaps:
                    want[doc, str(key)] = min([*gaps, want.get((doc, str(key)), 99)])
    got = {(r.doc_id, r["item"]): r.distance for r in decontaminate.near_passages(frame, bench).collect()}
    assert got == want and (1, "1") in got and got[None, "7"] == 1 and (2, "1") not in got
    plan = decontaminate.near_passages(frame, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan
    assert decontaminate.near_passages(frame.limit(0), bench).count() == decontaminate.near_passages(frame, bench.limit(0)).count() == 0


def test_token_counts_and_cache(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = [None, "", " ", "Hello  world's", "<|endoftext|> x<|endoftext|>", "é漢字\U0001f600\x00\r\n\t", "a" * 3000, "Hello  world's"]
    docs = spark.createDataFrame([*enumerate(texts), (0, None), (None, "x")], "doc_id long, text string").withColumn("digest", F.lit("clash"))
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)} | {None: 1}
    cache = f"file://{tmp_path}/cache"
    for _ in range(2):
        rows = token_counts.count_tokens(docs, path, cache).collect()
        assert len(rows) == len(texts) + 2 and all(r.n_tokens == want[r.doc_id] and r.over_limit == (r.n_tokens > 512) for r in rows)
    stored = spark.read.parquet(f"{cache}/tokenizer={token_counts.tokenizer_digest(path)}")
    assert stored.count() == len({t or "" for t in texts} | {"x"})
    assert token_counts.count_tokens(docs.limit(0), path, cache).count() == 0


def test_other_tokenizers_run_in_their_library(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["Hello  WORLD's end", "<|startoftext|> naïve café", "", "x" * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path, f"file://{tmp_path}/c").collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


@pytest.fixture(scope="module")
def pieces():
    return sentence_pieces.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_match_the_library(spark, pieces):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(3)
    pool = [*"aeth inou  \n\t▁éß漢字日12.,!)\r\x0b", "the", "ing", "\U0001f600", " "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 50))) for _ in range(120)] + [None, "", "x" * 100 + " end"] + ["theing" * 20][:1] + [("theing" * 20)[:n] for n in range(58, 66)]
    docs = spark.createDataFrame([*enumerate(texts), (None, "ab"), (0, texts[0])], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    assert pieces.ordered and pieces.units == sentence_pieces.FINE
    for size, scope in ((1, 1), (1, 1000), (500, 500), (1 << 23, 1 << 23)):
        encoded = sentence_pieces.encode_documents(docs.repartition(2), pieces, block_bytes=size, scope_bytes=scope)
        rows = sentence_pieces.decode_documents(encoded, pieces).collect()
        assert len(rows) == len(texts) + 2
        for r in rows:
            text = "ab" if r.doc_id is None else texts[r.doc_id] or ""
            assert list(r.ids) == library.encode(text) and r.text == library.decode(list(r.ids))
    both = sentence_pieces.encode_documents(docs, pieces, block_bytes=500, decode=True)
    assert sorted(map(str, both.collect())) == sorted(map(str, rows))
    assert sentence_pieces.encode_documents(docs.limit(0), pieces).count() == 0


def test_documents_through_viterbi_and_long_texts(spark, pieces):
    """A unigram table from end to end, and a text of more than a block."""
    scores = {"▁": -1.0, "a": -2.0, "b": -2.5, "ab": -2.2, "▁a": -3.1, "ba": -2.0, "▁ab": -9.0}
    table = sentence_pieces.Pieces({p: i + 1 for i, p in enumerate(scores)}, scores, [b" \xe2\x81\x87 ", b" ", b"a", b"b", b"ab", b" a", b"ba", b" ab"], None, 0, "viterbi")
    texts = ["abba ab", None, "", "aabab  a", "ab " * 40_000]
    rows = sentence_pieces.decode_documents(sentence_pieces.encode_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), table, block_bytes=1000), table).collect()
    for r in rows:
        text = texts[r.doc_id] or ""
        assert list(r.ids) == [i for u in sentence_pieces.units_of(text) for i in sentence_pieces.fold_long(u, table)] and r.text == text
    library = __import__("sentencepiece").SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    long = "Some würds, again 1234 ” and \u4e2d\u6587! " * 60_000
    (row,) = sentence_pieces.encode_documents(spark.createDataFrame([(1, long)], "doc_id long, text string"), pieces).collect()
    assert list(row.ids) == library.encode(long)


def test_one_visit_of_each_edge_is_enough_for_ordered_tables(spark, pieces):
    """Against the repeated choice of the best pair; and a table that is not ordered takes that."""
    rng = random.Random(5)
    units = ["▁" + "".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    table = spark.createDataFrame(pieces.rows(), "piece string, id int, place int, score double").drop("score")
    edges = sentence_pieces.lattice(spark.createDataFrame(list(enumerate(units)), "uid long, unit string"), table, pieces.longest, 3)
    both = [fold(F.col("edges"), F.col("n")) for fold in (sentence_pieces.merge_fold, sentence_pieces.merge_steps)]
    assert edges.where(both[0] != both[1]).count() == 0 and edges.count() == len(units)
    scores = {"▁": -9.0, "a": -9.0, "b": -9.0, "c": -9.0, "ab": -5.0, "abc": -1.0}
    odd = sentence_pieces.Pieces({p: i for i, p in enumerate(scores)}, scores, [b""] * 6, None, 0, "merge")
    assert not odd.ordered
    got = sentence_pieces.encode_units(spark.createDataFrame([(0, "▁abc")], "uid long, unit string"), odd).first()
    assert list(got.ids) == [0, 5] == sentence_pieces.fold_long("▁abc", odd)


def test_viterbi_finds_the_best_path(spark):
    scores = {"▁": -1.0, "a": -2.0, "b": -2.5, "ab": -2.2, "▁a": -3.1, "ba": -2.0, "▁ab": -9.0}
    table = sentence_pieces.Pieces({p: i + 1 for i, p in enumerate(scores)}, scores, [b""] * 9, None, 0, "viterbi")
    units = ["▁abba", "▁ab", "▁", "▁aabab", "▁xb"]
    got = {r.unit: list(r.ids) for r in sentence_pieces.encode_units(spark.createDataFrame(list(enumerate(units)), "uid long, unit string"), table).collect()}
    unknown = min(scores.values()) - sentence_pieces.UNK_PENALTY
    for u in units:
        best = max(
            ([u[a:b] for a, b in zip((0, *cut), (*cut, len(u)))] for k in range(len(u)) for cut in itertools.combinations(range(1, len(u)), k)),
            key=lambda ps: sum(scores.get(p, unknown if len(p) == 1 else -1e9) for p in ps),
        )
        assert got[u] == [table.ids.get(p, 0) for p in best] == sentence_pieces.fold_long(u, table)


def test_classifier_on_held_out_rows(spark):
    rng = random.Random(8)
    good = [" ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet,", "elit."]) for _ in range(rng.randint(5, 200))) for _ in range(150)]
    bad = [" ".join(rng.choice(["a###", "b$$$", "X!!", "|"]) for _ in range(rng.randint(5, 200))) for _ in range(150)]
    rows = list(enumerate(good + bad)) + [(900, None), (901, ""), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(300)] + [(5, 0, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_classifier.score_documents(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    test = [r for r in held if r.doc_id < 300]
    assert sum(r.predicted == int(r.doc_id < 150) for r in test) >= 0.95 * len(test)
    assert {r.score for r in quality_classifier.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.score_documents(docs.limit(0), labels).count() == 0


def test_isotonic_is_monotone():
    fit = quality_classifier.pool_adjacent_violators(np.array([0.1, 0.5, 0.3, 0.2, 0.9]), np.ones(5))
    assert (np.diff(fit) >= 0).all() and fit.sum() == pytest.approx(2.0)
