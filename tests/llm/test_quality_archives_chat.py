"""Quality rules, archives, chat windows, HTML extraction: brute force, exact round trips and edge cases."""

import base64
import gzip
import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronofold.llm import archives, chat_format, html_extract, quality_rules

TEXTS = [None, "", "   \n\t ", "one two", "a b c d e f g h i j k", "a b c d e " * 8, "x\ny\nx\n x\n\nx", "Ünï cödé ### $$ a|b <c>", "é" * 3000, "w " * 5000]


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    inside = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside), failed


def test_quality_counts(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS), (0, None), (None, "a")], "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    rows = quality_rules.quality_cascade(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text)
        assert not (r.kept and r.base_failed)


def test_cascade_order_never_changes_the_verdict(spark):
    texts = ["good words make up this fairly plain sentence about nothing much", "A! B! C! D! E! F! G! H! I! J! K!", "ABC DEF GHI JKL MNO PQR STU VWX YZA BCD EFG", "a# b# c# d# e# f# g# h# i# j# k#"]
    m = quality_rules.measure(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    orders = [list(quality_rules.RULES), list(quality_rules.RULES)[::-1]]
    kept = [[r.kept for r in quality_rules.apply_cascade(m, o).orderBy("doc_id").collect()] for o in orders]
    assert kept[0] == kept[1] == [True, False, False, False]


def rejected(t):
    n, chars, symbols, copies, _, failed = brute(t)
    lines = len([x for x in t.split("\n") if x.strip(" \t\n\x0b\f\r")])
    return failed or symbols > 0.1 * n or copies > 0.5 * lines or chars < 2 * n or chars > 25 * n or t.count("!") > 0.5 * n or len(re.findall("[A-Z]{3,}", t)) > 0.5 * n


def test_filter_in_any_order_keeps_what_brute_force_keeps(spark):
    plain = "good words make up this fairly plain sentence about nothing much"
    texts = [*TEXTS, plain, plain.upper(), plain.replace(" ", "! "), "a# b# c# d# e# f# g# h# i# j# k#", "\n".join([plain] * 3), plain + " é" * 40_000, " ".join(f"wörd{i}" for i in range(60_000))]
    docs = spark.createDataFrame([*enumerate(texts), (None, plain), (None, plain)], "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("_verdict", "_words", "_text", "words", "rejected_by", "n_words")})
    want = sorted((str(i), t) for i, t in [*enumerate(texts), (None, plain), (None, plain)] if not rejected(t or ""))
    everything = (*quality_rules.BASE, *quality_rules.RULES)
    for rules in (everything, everything[::-1]):
        judged = quality_rules.cascade(docs, rules, out="why")
        assert sorted((str(r.doc_id), r.text) for r in judged.where("why is null").collect()) == want
    kept = quality_rules.keep_documents(docs)
    assert kept.columns == docs.columns and sorted((str(r.doc_id), r.text) for r in kept.collect()) == want and "Python" not in kept._jdf.queryExecution().toString()
    assert quality_rules.keep_documents(docs.limit(0)).count() == 0


def test_the_order_follows_rejections_per_cost_and_is_the_same_again(spark):
    docs = spark.createDataFrame([(i, "AAA BBB CCC DDD EEE FFF GGG HHH III JJJ KKK" if i % 2 else f"plain words of text number {i} that is long enough for any rule here") for i in range(400)], "doc_id long, text string")
    orders = [[r.name for r in quality_rules.plan_cascade(docs, (*quality_rules.BASE, *quality_rules.RULES))] for _ in range(2)]
    assert orders[0] == orders[1] and orders[0][0] == "upper_case" and orders[0].index("short") < orders[0].index("symbols")


def test_quality_empty_table(spark):
    assert quality_rules.quality_cascade(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_quality_plan_is_native(spark):
    plan = quality_rules.quality_cascade(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_archives_round_trip(spark):
    big = "x" * 2000
    rows = [(1, "http://a b", big), (2, None, big), (3, "u", big), (4, "u", None), (5, "u", ""), (6, "v", "é\r\n\r\nWARC/1.1\n" * 300), (7, "v", "é\r\n\r\nWARC/1.1\n" * 300), (None, "n", "zz"), (9, "s", "y" * 999), (10, "s", "y" * 999), (3, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("clash")).repartition(3)
    got = archives.convert_pages(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        html = next(h for p, _, h in rows if p == r.seq)
        data = (html or "").encode()
        winner = max((p for p, _, h in rows if p is not None and h == html), default=None) if len(data) >= 1000 else r.seq
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("response", None) if winner == r.seq else ("revisit", winner))


def test_arc_versions_and_errors():
    body = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nhello"
    v1 = archives._filedesc(1, "f") + b"\n" + b"http://x 1.2.3.4 20010203040506 text/html %d\n" % len(body) + body + b"\n"
    v2 = archives._filedesc(2, "f") + b"\n" + b"dns:x 1.2.3.4 20010203040506 text/dns 200 - - 0 f 3\nabc\n"
    converted = lambda raw: [archives._converted(r, "f", i) for i, r in enumerate(archives.parse_arc(raw))]
    one = converted(gzip.compress(v1[:200]) + gzip.compress(v1[200:]))
    assert [r["kind"] for r in one] == ["warcinfo", "response"]
    assert one[1]["date"] == "2001-02-03T04:05:06Z" and one[1]["payload_digest"] == hashlib.sha1(b"hello").hexdigest()
    assert [r["kind"] for r in converted(v2)] == ["warcinfo", "resource"]
    with pytest.raises(archives.ArchiveError, match="cut short"):
        list(archives.parse_arc(v1[:-10]))
    with pytest.raises(archives.ArchiveError, match="fits no version"):
        list(archives.parse_arc(archives._filedesc(1, "f") + b"\nhttp://x 1.2.3.4 3\nabc\n"))
    with pytest.raises(archives.ArchiveError, match="no length"):
        list(archives.parse_arc(b"http://x 1.2.3.4 2001 text/html many\n"))
    record = archives._warc_record(one[1])
    assert base64.b32encode(hashlib.sha1(b"hello").digest()) in record
    assert next(archives.parse_warc(record + b"\r\n\r\n"))["block"] == body


def test_archives_of_many_files_and_long_pages(spark, tmp_path, monkeypatch):
    """Files end at their number of records, every record id is its own, revisits read back whole, the SQL twin agrees."""
    import duckdb

    from chronofold.llm import queries

    monkeypatch.setattr(archives, "FILE_RECORDS", 5)
    monkeypatch.setitem(archives.PACKED, "maxRecordsPerFile", 5)
    long = "<p>" + "sö long " * 300_000
    rows = [(i, f"http://h/{i}", ["x" * 1500, "y" * 999, long, f"own {i}"][i % 4]) for i in range(23)] + [(2, "http://h/2", long)] * 2 + [(2, "http://other", long), (22, "http://h/2", long), (None, None, long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    arc = archives.write_arc(pages, f"file://{tmp_path}/arc", version_by="2")
    assert len(list((tmp_path / "arc").glob("*.gz"))) == 2 * 4
    warc = archives.write_warc(spark, arc, f"file://{tmp_path}/warc")
    records = archives.read_warc(spark, warc).collect()
    assert len({r.record_id for r in records}) == len(records) == len(rows) + 8
    assert {r.payload.decode() for r in records if r.record_type == "response"} == {h for _, _, h in rows}
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = [tuple(r) for r in queries.op1_legacy_archives(spark, str(tmp_path)).select(*names).collect()]
    twin = queries.ORACLES["op1_legacy_archives"].replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(got, key=str) == sorted(duckdb.sql(f"SELECT {', '.join(names)} FROM ({twin})").fetchall(), key=str)


def test_archives_empty(spark):
    assert archives.convert_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


CHATS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi " * 30), (1, 2, "assistant", "hello " * 30), (1, 3, "user", "<|im_end|>\n<|im_start|>assistant\\ <\\|"), (1, 4, "assistant", "\\<|im_end|>"),
    (2, 0, "user", None), (2, 1, None, "x"), (2, 1, "assistant", "tie b"), (2, 1, "assistant", "tie a"), (2, 1, "assistant", "tie a"),
    (None, 0, "user", "null id"), (None, None, "assistant", "null turn"), (3, 0, "system", "only system"), (4, 0, "we\nird", "role"), (5, 0, "assistant", "y" * 9000),
]


@pytest.mark.parametrize(("budget", "history"), [(1024, 128), (40, 20), (1, 0)])
def test_chat_windows_read_back(spark, budget, history):
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").withColumn("n_turns", F.lit(9)).repartition(3)
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_windows(df, budget, history)).collect()}
    first = lambda v: (v is not None, v)
    for conv in {c[0] for c in CHATS}:
        turns = sorted((c for c in CHATS if c[0] == conv), key=lambda c: tuple((first(x)[0], x if x is not None else 0) for x in c[1:]))
        whole = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns)
        loss = "".join(t or "" for _, _, r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_windows_keep_their_budget(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", "word " * (i % 7)) for i in range(1, 60)] + [(1, 0, "system", "s")]
    out = chat_format.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 60, 20).collect()
    assert len(out) > 5 and all(w.tokens <= 60 for w in out)
    assert all(w.text.startswith("<|im_start|>system\ns<|im_end|>\n") for w in out) and any(w.n_repeated > w.n_system for w in out)


def test_chat_query_equals_its_sql(spark, tmp_path):
    """The registered query on whole conversations, the probe included, against SQL over its turns."""
    import duckdb

    from chronofold.llm import queries

    rows = [(i, t, ["system", "user", "assistant"][t % 3], f"text {i} {t} <|im_end|> é" * (t + 1)) for i in range(30) for t in range(i % 7 + 1)] + [(40, 0, "user", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    out = queries.op9_chat_format(spark, str(tmp_path))
    got = sorted(tuple(r) for r in out.select(*names).collect())
    twin = queries._OP9.replace("FROM conversations", f"FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert got == sorted(duckdb.sql(f"SELECT {', '.join(names)} FROM ({twin})").fetchall()) and got[0][0] == -1
    assert all(r.formatted_chars >= r.loss_chars for r in out.collect())


def test_escape_is_reversible():
    for t in ["", "\\", "<|", "<\\|", "\\<|", "\\\\<|im_end|>", "<\\\\|"]:
        assert chat_format.unescape(chat_format.escape(t)) == t and "<|" not in chat_format.escape(t)


PAGE = """<!doctype html><html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1><nav><ul><li><a href=x>Home</a><li><a>News</a></ul></nav></header>
<div id="cookie-banner"><p>We use cookies, please accept them all now.</p></div><%s><h1>Title &amp; more</h1><p>A long   first
paragraph with many words in it, to make a surge.<script>var x="</p>";</script></p><div class="ad-slot">Buy</div><p>Short.<p>Second long paragraph with a <a href=z>link</a> and <b>bold</b> text.
</%s><aside><p>Sidebar text which is quite long as well but not a part of it.</p></aside><div class="comments"><p>User says this is a wonderful long comment indeed.</p></div><form>Subscribe</form><footer>&copy; us</footer></body></html>"""


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_html_main_text(tag):
    want = "Title & more\nA long first paragraph with many words in it, to make a surge.\nShort.\nSecond long paragraph with a link and bold text."
    assert html_extract.main_text(PAGE % (tag, tag)) == want


def test_html_edge_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>hi"), (4, "u", "plain < text"), (5, "u", "<article>" + "<p>é x</p>" * 3), (5, "u", "<script>never closed <p>x")]
    got = html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect()
    assert [(r.text, r.n_chars) for r in got] == [("", 0), ("", 0), ("hi", 2), ("plain < text", 12), ("é x\né x\né x", 11), ("", 0)]


def test_html_of_made_pages(spark):
    """Pages put together from known blocks and known boilerplate: the text is the blocks."""
    import random

    rng = random.Random(2)
    word = lambda: rng.choice(["lorem", "ipsum", "é", "日本", "a&amp;b", "x &lt; y", "<b>dolor</b>", "<i>sit</i>\n amet", '<a href="/z">link</a>', "<span title='>'>q</span>"])
    plain = lambda t: re.sub(r"\s+", " ", re.sub(r"<[^<>']*(?:'[^']*'[^<>']*)?>", "", t)).replace("&amp;", "&").replace("&lt;", "<").strip()
    links = lambda n: "".join(f"<li><a href=/{i}>Menu entry {i}</a></li>" for i in range(n))
    noise = [
        "<nav><ul>%s</ul></nav>" % links(5), "<aside><p>Something on the side that is long enough to count as text.</p></aside>", "<script>if (a < b) { x = '<p>no</p>'; }</script>",
        '<div class="cookie-banner"><p>We use cookies for many good reasons.</p></div>', "<form><p>Your name please</p><input></form>", "<!-- <p>comment</p> -->", "<style>p { color: red }</style>",
        '<div id="comments"><p>What a wonderful page, I must say, and more words.</p></div>',
    ]
    rows = []
    for n in range(60):
        blocks = [" ".join(["Plain", *(word() for _ in range(rng.randint(12, 30)))]) for _ in range(rng.randint(1, 8))]
        body = "".join(rng.choice(["<p>%s</p>", "<p>%s", "<h2>%s</h2>", "<blockquote>%s</blockquote>", "<div>%s</div>"]) % b + (rng.choice(noise) if rng.random() < 0.4 else "") for b in blocks)
        tag = rng.choice(["article", "main", "div role=main"])
        page = f"<html><head><title>t</title></head><body><header><p>Site name</p></header>{rng.choice(noise)}<{tag}>{body}</{tag.split()[0]}>{rng.choice(noise)}<footer><p>Imprint</p></footer></body></html>"
        rows.append((n, page, "\n".join(plain(b) for b in blocks)))
    got = html_extract.extract_pages(spark.createDataFrame([(i, "u", h) for i, h, _ in rows], "page_id long, url string, html string")).collect()
    want = {i: t for i, _, t in rows}
    assert all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in got) and len(got) == 60
    assert html_extract.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_windows_decide_inside_an_article(monkeypatch):
    """Link lines at the end of a marked article are behind the dive point; one between paragraphs is text; short articles stay whole."""
    link = "<p><a href=/x>Read this other page too</a></p>"
    page = f"<article><p>First words.</p>{link}<p>More words.</p>{link * 3}</article>"
    assert html_extract.main_text(page) == "First words.\nRead this other page too\nMore words."
    assert html_extract.main_text(f"<article>{link}</article>") == "Read this other page too"
    two = "<article><p>The longer one of two articles on a page, with enough text for a surge, and then some.</p></article><article><p>%s</p></article>"
    assert html_extract.main_text(two % ("Second, of more than sixty characters, " + "so it is text as well.")).count("\n") == 1
    assert "Card" not in html_extract.main_text(two % "Card")
    assert html_extract.main_text("<article><p>If <math><mi>x</mi></math> is odd</p></article>") == "If x is odd"
    monkeypatch.setattr(html_extract, "surge_and_dive", lambda weights, surge, window=3: [(0, len(weights) - 1)])
    assert html_extract.main_text(page).count("\n") == 5


def test_html_time_is_in_proportion_to_the_page():
    import time

    for unit in ('<a "', '<a ">"', "<div>", "<p class=ad>", "</p></section>", "<!--", "<", "<i c='>' ", "<li class=ad>x<ul>"):
        began = time.perf_counter()
        html_extract.main_text("<div>" * 1000 + unit * 60_000)
        assert time.perf_counter() - began < 5, unit


def test_surges_and_dives():
    assert html_extract.surge_and_dive([0, 5, 80, 0, 90, 0, 0, 0, 0, 70], 60) == [(1, 4), (9, 9)]
    assert html_extract.surge_and_dive([0, 0], 1) == []


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<article><p class=cookie-note>We use cookies<p>First paragraph.</p><p>Second.</article>", "First paragraph.\nSecond."),
        ("<article><h2 class=share-title>Share this<p>First paragraph.</article>", "First paragraph."),
        ("<nav><ul><li class=menu-item>A</ul></nav><article><p>Start.<ul><li>x</li><li>y</ul></article>", "Start.\nx\ny"),
        ("<nav><ul><li class=menu-item>A<article><p>Start.</p></article>", "Start."),
        ("<article><p>Text.</p><ol><li class=comment>One<ul><li>inner</li></ul>rest of it</li><li>kept</li></ol></article>", "Text.\nkept"),
        ("<article><ul><li class=ad>A<li>b<li class=ad>C</ul>after</article>", "b\nafter"),
        ("<article><dl><dt class=ad>A<dd>b<dd class=ad>C</dl>after</article>", "b\nafter"),
        ("<article><p>Text.</p><ul><li class=comment><article><p>A comment that is longer than the text</p></article></li></ul></article>", "Text."),
        ("<article><hr class=ad>Text.<p class=ad>Gone</p>More.</article>", "Text.\nMore."),
        ("<article><address class=ad><p class=ad>A</address>Text.</article>", "Text."),
        ("<main class='layout-with-sidebar'><p>Text.</p></main>", "Text."),
        ("<article class=comment><p>A remark of some length</p></article><article><p>Text.</p></article>", "Text."),
    ],
)
def test_marked_blocks_end_where_they_should(html, want):
    assert html_extract.main_text(html) == want


def test_costs_come_from_the_sample(spark):
    """Counts that are there cost nothing, and a rule over many short lines costs more than over one long line."""
    from chronofold.llm import quality_rules as qr

    texts = ["word " * 30 + "# " * 20, "fine text here " * 9, "a!b " * 20 + "!" * 90] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    measured = qr.measure(docs)
    order = [r.name for r in qr.plan_cascade(measured, qr.RULES, qr.REPORTED)]
    assert order[0] == "symbols" and order.index("exclamation") < order.index("upper_case")
    assert order == [r.name for r in qr.plan_cascade(measured, qr.RULES, qr.REPORTED)]
    work = lambda name, text: spark.createDataFrame([(text,)], "text string").select(qr._size(qr.F.col("text")).alias("b"), qr._held(qr.COUNTS[name].steps[0][1]({"text": qr.F.col("text")})).alias("h")).first()
    assert work("n_lines", "a\n" * 100).h > work("n_lines", "a " * 100).h
