"""The pipeline against a brute-force version of its five stages, stage by stage."""

import random

import pytest
from test_dedup_and_tokens import contaminated, words
from test_quality_archives_chat import brute

import corpus_pipeline

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")


def rejected(text):
    n, chars, symbols, copies, _, failed = brute(text)
    t = text or ""
    lines = len([x for x in t.split("\n") if x.strip(" \t\n\x0b\f\r")])
    import re

    return failed or symbols > 0.1 * n or copies > 0.5 * lines or chars < 2 * n or chars > 25 * n or t.count("!") > 0.5 * n or len(re.findall("[A-Z]{3,}", t)) > 0.5 * n


def fingerprint(text):
    import re

    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def one_of_each(rows):
    prints = {k: fingerprint(r[1]) for k, r in rows.items()}
    group = {k: k for k in rows}
    for a in rows:
        for b in rows:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {k: low if g == high else g for k, g in group.items()}
    return {k: r for k, r in rows.items() if group[k] == k}


def cut(rows):
    seen, out = set(), {}
    for k in sorted(rows):
        data = (rows[k][1] or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        at = 0
        while at < len(data):
            end = at + 1
            while end < len(data) and data[end] & 0xC0 == 0x80:
                end += 1
            if not all(gone[at:end]):
                gone[at:end] = bytes(end - at)
            at = end
        text = bytes(c for c, g in zip(data, gone) if not g).decode()
        out[k] = (k, text, rows[k][2], rows[k][3], len(text))
    return out


def test_pipeline_equals_brute_force(spark, tmp_path):
    rng = random.Random(11)
    passage, leak = words(rng, 60), words(rng, 25)
    texts = [words(rng, rng.randint(20, 90)) for _ in range(25)]
    texts += [f"{words(rng, 20)} {passage} {words(rng, 20)}" for _ in range(4)] + [f"{words(rng, 15)} {leak} {words(rng, 15)}" for _ in range(2)]
    texts += [texts[0], texts[1] + " tail", None, "", "too short", "a# " * 30, words(rng, 12) * 9]
    docs = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, leak), (2, "unrelated words that stand nowhere else at all in here now")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    want = {d[0]: d for d in docs if not rejected(d[1])}
    stages = [want]
    stages.append(one_of_each(stages[-1]))
    stages.append(cut(stages[-1]))
    stages.append({k: r for k, r in stages[-1].items() if not contaminated(r[1], items)[1]})
    assert len({len(s) for s in (stages[0], stages[1], stages[3])}) == 3
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for i, ((name, stage), expected) in enumerate(zip(corpus_pipeline.STAGES, stages)):
        stage(spark, frame, str(tmp_path)).write.parquet(f"{tmp_path}/stage{i}")
        frame = spark.read.parquet(f"{tmp_path}/stage{i}")
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert {r.doc_id: tuple(r) for r in frame.collect()} == expected, name
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.PIECE_MODEL))
    got = {r.doc_id: (r.n_pieces, list(r.ids)) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {k: (len(library.encode(r[1])), library.encode(r[1])) for k, r in stages[-1].items()}


def test_pipeline_edges(spark, tmp_path):
    """An empty table, null ids, repeated rows, an extra column; and a second run that leaves the first one's result readable."""
    rng = random.Random(4)
    one, two = words(rng, 60), words(rng, 70)
    docs = [(None, one, "r"), (None, two, "s"), (3, one, "t"), (3, one, "t"), (4, None, "u"), (5, "", "v"), (6, words(rng, 30_000), "w")]
    for name, rows in (("some", docs), ("none", [])):
        spark.createDataFrame(rows, "doc_id long, text string, row string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, "no such passage in any of them at all, not one")], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    first, empty = corpus_pipeline.run(spark, f"{tmp_path}/some"), corpus_pipeline.run(spark, f"{tmp_path}/none")
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.PIECE_MODEL))
    assert sorted((r.doc_id or -1, list(r.ids)) for r in first.collect()) == sorted([(-1, library.encode(two)), (3, library.encode(one)), (6, library.encode(docs[6][1]))])
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_pieces", "ids"]
    frame = spark.read.parquet(f"{tmp_path}/some/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, f"{tmp_path}/some").columns == ["doc_id", "text", "row"]
