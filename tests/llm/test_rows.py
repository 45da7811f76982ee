"""Operators that look at one document, page or conversation at a time, and the mix, shards and archives."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from docweave.llm import chat, html, mixing, pieces, quality, sharding, warc
from docweave.llm import queries as registered
from docweave.llm.common import fresh_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_agrees_with_sql(name, spark, sf, duck, same):
    assert same(registered.queries()[name](spark, sf), duck.sql(registered.oracle_sql()[name])) > 0


# mixing


def test_mix_comes_near_its_targets(spark, table_of, sf):
    got = mixing.op1_mixing(spark, sf).toPandas().merge(table_of("documents")[["doc_id", "source"]], on="doc_id")
    assert (got["taken"] <= 3 * got["size"]).all() and got["taken"].sum() <= got["size"].sum()
    per = got.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), largest=("size", "max"))
    assert ((per["taken"] - per["target"]).abs() <= per["largest"]).all()
    assert abs(per["target"].sum() - got["size"].sum()) < 1e-6
    again = mixing.op1_mixing(spark, sf).toPandas().sort_values("doc_id")
    assert again["taken"].tolist() == got.sort_values("doc_id")["taken"].tolist()


@pytest.mark.parametrize("sizes", [[100, 1, 1], [1, 1, 1], [5, 100, 0, 7], [0, 0], [1000, 3, 2, 500, 1]])
def test_targets_by_resharing(spark, sizes):
    """Against the excess shared again and again."""
    names = [chr(97 + i) for i in range(len(sizes))]
    left, free, target = float(sum(sizes)), set(range(len(sizes))), [0.0] * len(sizes)
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    while free:
        whole = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / whole > 3 * sizes[i]]
        if not over:
            for i in free:
                target[i] = left * weights[i] / whole
            break
        for i in over:
            target[i] = 3.0 * sizes[i]
            free.discard(i)
        left = sum(sizes) - sum(target[i] for i in range(len(sizes)) if i not in free)
    df = mixing.targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long"))
    assert [r.target for r in df.orderBy("source").collect()] == pytest.approx(target)


def test_mix_of_odd_documents(spark, odd, folder_of):
    got = mixing.op1_mixing(spark, folder_of(documents=odd)).collect()
    assert len(got) == 11 and all(r.taken == 0 for r in got if r["size"] == 0)
    assert mixing.op1_mixing(spark, folder_of(documents=odd.limit(0))).count() == 0


# archives


def test_archives_of_odd_pages(spark, folder_of):
    big = "z" * 200
    pages = spark.createDataFrame([(2, "http://A.com/x", big), (1, "http://b.org/?q=1#f", big), (3, None, None), (4, "http://[bad", "q"), (5, "http://b.org/?q=1", big), (6, "http://A.com/x", "")], "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.op2_warc(spark, folder_of(pages=pages)).collect()}
    assert {k: (r.record_type, r.refers_to, r.payload_bytes) for k, r in got.items()} == {
        1: ("response", None, 200),
        2: ("revisit", 1, 200),
        3: ("response", None, 0),
        4: ("response", None, 1),
        5: ("revisit", 1, 200),
        6: ("response", None, 0),
    }
    assert all(r.payload_digest == hashlib.sha256(b"z" * 200).hexdigest() for k, r in got.items() if k in (1, 2, 5))
    assert warc.op2_warc(spark, folder_of(pages=pages.limit(0))).count() == 0


def test_ties_nulls_and_extra_columns_in_archives(spark):
    big = "y" * 100
    pages = spark.createDataFrame([(1, "http://a/x", big, 0), (1, "http://a/x", big, 1), (None, None, big, 2), (None, None, None, 3)], "page_id long, url string, html string, payload int")
    folder = fresh_path(spark, "warc")
    files = warc.build_index(warc.write_archives(warc.decide(pages), folder), folder)
    got = warc.read_records(warc.lookup(pages, folder, files), folder, payload=True).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in got) == [(0, "response", None, 0), (0, "revisit", 1, 100), (1, "response", None, 100), (1, "response", None, 100)]
    assert all(bytes(r.payload) == big.encode() for r in got if r.record_type == "response" and r.payload_bytes)


@pytest.mark.parametrize("null_url", [True, False])
def test_archives_keep_large_ids(spark, folder_of, null_url):
    """Ids beyond 2^53, mixed with nulls and repeats: all rows come back with their own ids."""
    big, html_ = 1 << 60, "h" * 150
    rows = [(big + i, "http://a/x", html_) for i in (1, 3, 5)] + [(big + 7, None, "own " * 40), (big + 7, None, "own " * 40), (3, "http://b", "q")]
    rows += [(None, None if null_url else "http://a/x", html_), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to) for r in warc.op2_warc(spark, folder_of(pages=pages)).collect()), key=str)
    want = [(big + 1, "response", None), (big + 3, "revisit", big + 1), (big + 5, "revisit", big + 1), (big + 7, "response", None), (big + 7, "response", None), (3, "response", None), (0, "revisit", big + 1), (0, "response", None)]
    assert got == sorted(want, key=str)


def test_index_finds_keys_over_blocks_and_files(spark, monkeypatch):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id") % 7, F.lit(".example/"), F.col("id") % 50).alias("url"), F.concat(F.lit("<p>"), F.col("id").cast("string")).alias("html"))
    folder = fresh_path(spark, "warc")
    files = warc.build_index(warc.write_archives(warc.decide(pages.repartition(5)), folder), folder)
    some = pages.where("page_id % 20 = 0")
    got = warc.read_records(warc.lookup(some, folder, files), folder, payload=True).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in got) == [(i, f"<p>{i}") for i in range(0, 3000, 20)]
    assert warc.lookup(spark.createDataFrame([(99999, "http://h1.example/1")], "page_id long, url string"), folder, files).count() == 0


def test_surt():
    assert warc.surt("https://Www.Example.org:443/a/B?c=d#e") == "org,example,www)/a/B?c=d"
    assert warc.surt("http://u:p@h.de:81") == "de,h:81)/"
    assert warc.surt(None) == warc.surt("") == ")/"


# quality


def plain_measures(text):
    ws = WORD.findall(text or "")
    windows = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 8)}
    lines, dup, seen = (text or "").split("\n"), 0, set()
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    failed = len(ws) < 20 or 100 * len(covered) > 30 * len(ws)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), failed


def plain_buckets(text):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text or "")]
    pair = lambda a, b: xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
    return [x % quality.BUCKETS for x in h] + [pair(a, b) % quality.BUCKETS for a, b in zip(h, h[1:])]


def test_quality_by_plain_code(spark, sf, table_of):
    docs, labels = table_of("documents"), table_of("labels")
    got = quality.op3_quality(spark, sf).toPandas().set_index("doc_id")
    trusted = set(labels[(labels.quality == 1) & (labels.toxic == 0)].doc_id)
    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    buckets = {d: plain_buckets(t) for d, t in zip(docs.doc_id, docs.text)}
    for d, b in buckets.items():
        np.add.at(raw, b, 1)
        if d in trusted:
            np.add.at(target, b, 1)
    weights = np.log((target + quality.SMOOTHING) / (target.sum() * raw / raw.sum() + quality.SMOOTHING))
    for d, t in zip(docs.doc_id, docs.text):
        r, want = got.loc[d], plain_measures(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        score = weights[buckets[d]].mean()
        assert r.score == pytest.approx(score)
        assert r.kept == (not want[-1] and score >= quality.THRESHOLD)


def test_quality_tells_labels_apart(spark):
    """Judged on held-out labels: the target is fitted on a half of them, the verdict read on the other."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    for half in (0, 1):
        got = quality.judge(docs, labels.where(F.col("doc_id") % 2 == half)).toPandas().merge(pd.read_parquet("/root/testdata/sf0.01/labels.parquet"), on="doc_id")
        judged = got[~got.base_failed & (got.doc_id % 2 != half)]
        assert len(judged) > 100 and judged[judged.quality == 1].kept.mean() > 0.97 and judged[judged.quality == 0].kept.mean() < 0.25


def test_kept_rows_are_those_that_are_judged_good(spark, sf, odd):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd, odd.withColumn("_weights", F.lit("x")).withColumn("kept", F.lit("y"))):
        want = quality.judge(docs.drop("kept", "_weights"), labels).where("kept").select("doc_id", "text").collect()
        got = quality.keep(docs, labels)
        assert got.columns == docs.columns and sorted(map(str, got.select("doc_id", "text").collect())) == sorted(map(str, want))


def test_quality_of_odd_documents(spark, odd, folder_of):
    none = spark.createDataFrame([(None, None, None), (99, 1, None)], "doc_id long, quality int, toxic int")
    root = folder_of(documents=odd.withColumn("score", F.lit("clash")), labels=none)
    got = quality.op3_quality(spark, root).collect()
    assert len(got) == 11
    found = sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert found == sorted((r.doc_id or 0, *plain_measures(r.text)) for r in odd.collect())
    assert quality.op3_quality(spark, folder_of(documents=odd.limit(0), labels=none)).count() == 0


# pages


PAGES = [
    ("<body><div id=cookie-notice>We use cookies</div><header><h1>Site</h1></header><main><article><h1>T</h1><p>One &amp; two<p>Three <a href=x>link</a> more.<aside>side</aside><section><h2>S</h2><p>Four<ul><li>a<li>b</ul></section><div class=comments><p>reader</div></article></main><footer>f</footer>", "T\n\nOne & two\n\nThree link more.\n\nS\n\nFour\n\na\n\nb"),
    ("plain text only", "plain text only"),
    ("<p>a<p>b", "a\n\nb"),
    ("<div><div class=menu><a>x</a><a>y</a></div><div><p>Long paragraph of text here that is dense and good.</p><p>Another paragraph that is also dense enough.</p></div></div>", "Long paragraph of text here that is dense and good.\n\nAnother paragraph that is also dense enough."),
    ("<b>unclosed <i>x</b> y</i> z", "unclosed x y z"),
    ("<article><p>a<br>b \n\t c&nbsp;&nbsp;d&#x41;</article><script>var t='<p>no</p>'</script>", "a b c dA"),
    ("<article></article>", ""),
    ("<!-- <article><p>no</p></article> --><article><p>yes</p></article>", "yes"),
    ("<div class='layout with-sidebar'><article><p>kept</p></article><div class=sidebar>no</div></div>", "kept"),
    ("<article><p>kept</p></article><div id=comments><article><p>a comment</p></article></div>", "kept"),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_deep_and_long_pages():
    assert html.main_text("<b>" * 50_000 + "x") == "x"
    assert html.main_text("<div>" * 30_000 + "<nav>menu</nav><p>x</p>") == "x"
    assert html.main_text("<p>y</p>" + "<b>" * 20_000 + "</i>" * 20_000 + "<li>" * 5) == "y"
    assert len(html.main_text("<article>" + "<p>word word</p>" * 50_000)) > 500_000


def test_pages_keep_their_columns(spark, folder_of):
    df = spark.createDataFrame([(1, None, None, "x"), (2, "u", "<article><p>t</p></article>", "y"), (2, "u", "<article><p>t</p></article>", "y")], "page_id long, url string, html string, text string")
    assert [tuple(r) for r in html.extract(df).orderBy("page_id").collect()] == [(1, None, ""), (2, "u", "t"), (2, "u", "t")]
    assert html.op7_html(spark, folder_of(pages=df.limit(0).select("page_id", "url", "html"))).count() == 0


def test_pages_keep_large_ids(spark, folder_of):
    ids = [(1 << 60) + 1, (1 << 60) + 3, None, 7]
    df = spark.createDataFrame([(i, "u", f"<article><p>page {i}</p></article>") for i in ids], "page_id long, url string, html string")
    assert {(r.page_id, r.text) for r in html.op7_html(spark, folder_of(pages=df)).collect()} == {(i, f"page {i}") for i in ids}


def plain_article(page):
    """What stands in the article of a page of the tables."""
    import html as entities

    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    inside = re.sub(r"</?(p|h1)>", "\0", re.sub(r"</?b>", "", inside.replace("<br>", " ")))
    return "\n\n".join(x for x in (re.sub(r"\s+", " ", entities.unescape(x)).strip() for x in inside.split("\0")) if x)


def test_pages_of_the_tables(spark, sf, table_of):
    got = html.op7_html(spark, sf).toPandas().set_index("page_id")
    for r in table_of("pages").itertuples():
        want = plain_article(r.html)
        assert (got.loc[r.page_id].text, got.loc[r.page_id].n_chars) == (want, len(want))


def test_density_finds_the_article(monkeypatch):
    """Without article elements and without class, id and role names the density alone finds the text; without the density it isn't found."""
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").html
    bare = [re.sub(r"\s(class|id|role)=(\"[^\"]*\"|\S+?)(?=[\s>])", "", re.sub(r"(</?)article\b", r"\1div", p)) for p in pages]
    want = [plain_article(p) for p in pages]
    assert [html.main_text(p) for p in bare] == want
    wrapped = [re.sub(r"(</?)article\b", r"\1div", p.replace("<body>", "<body><div><section>")) for p in pages]
    assert [html.main_text(p) for p in wrapped] == want
    monkeypatch.setattr(html, "content", lambda body: [body])
    assert all(html.main_text(p) != w for p, w in zip(bare[:50], want))


def test_sections_and_headings_by_density():
    p = "<p>" + "A paragraph of some length that is about the matter at hand. " * 3 + "</p>"
    page = f"<body><div>Short note.</div><div><h1>Title</h1><div><h2>One</h2>{p * 5}</div><div><h2>Two</h2>{p * 3}</div></div><div><a href=x>link one</a> <a href=y>and a second link</a></div></body>"
    text = html.main_text(page)
    assert text.startswith("Title\n\nOne\n\nA para") and "Two" in text and text.count("A paragraph") == 24 and "link" not in text and "Short note" not in text


# chats


def test_chat_parts(spark):
    part = "struct<type:string,text:string,ref:string,n_tokens:int>"
    rows = [
        (1, 0, "user", [("text", "look <|image|> \\l", None, None), ("image", None, "a>b<c\\", 300), ("text", None, None, None), ("audio", None, None, None)]),
        (1, 1, "assistant", [("text", "seen", None, None), ("document", None, "d", 10)]),
        (2, 0, None, None),
        (None, None, "assistant", [("text", "", None, None)]),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>").withColumn("formatted", F.lit("clash"))
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert [tuple(a) for a in got[1].attachments] == [(1, "image", "a>b<c\\", 300), (2, "audio", None, 128), (3, "document", "d", 10)] and got[1].n_attachment_tokens == 438
    assert got[1].formatted == "<|user>look \\l|image|> \\bl<image:1><audio:2><!><|assistant>seen<document:3><!>"
    many = spark.createDataFrame([(7, t, "user", [("text", "<image:>", None, None), ("image", None, f"r{t}", t)] * 30) for t in range(20)], df.drop("formatted").schema)
    one = chat.format_conversations(many).first()
    assert [int(x) for x in re.findall(r"<image:(\d+)>", one.formatted)] == list(range(1, 601)) == [a.number for a in one.attachments]
    assert [a.ref for a in one.attachments] == [f"r{t}" for t in range(20) for _ in range(30)]


def test_loss_runs_cover_the_text(spark):
    part = "struct<type:string,text:string,ref:string,n_tokens:int>"
    rows = [(1, 0, "user", [("text", "<|assistant>no<!>", None, None)]), (1, 1, "assistant", [("text", "yes", None, None), ("image", None, "i", 1)]), (1, 2, "assistant", []), (1, 3, "assistants", [("text", "no", None, None)])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")
    r = chat.format_conversations(df).select("formatted", chat.loss_runs(F.col("formatted")).alias("runs")).first()
    assert "".join(x.text for x in r.runs) == r.formatted and [x.text for x in r.runs if x.on] == ["yes<image:1>", ""]


def test_ties_of_turns_stand_in_the_order_of_their_texts(spark, folder_of, duck, same):
    df = spark.createDataFrame([(1, 0, "user", "<"), (1, 0, "user", "\\"), (1, 0, "user", "="), (1, None, "user", "z"), (1, 0, None, "n"), (1, 0, "", "m")], "conv_id long, turn long, role string, text string")
    root = folder_of(conversations=df)
    import duckdb

    other = duckdb.connect()
    other.sql(f"CREATE VIEW conversations AS SELECT * FROM '{root}/conversations.parquet/*.parquet'")
    assert same(chat.op8_chat_format(spark, root), other.sql(chat.OP8_SQL)) == 2


def test_chat_parts_of_unknown_kinds(spark):
    part = "struct<type:string,text:string,ref:string,n_tokens:int>"
    df = spark.createDataFrame([(1, 0, "user", [("video", "a<b", None, None), (None, "c", None, None)])], f"conv_id long, turn long, role string, parts array<{part}>")
    got = {r.conv_id: r for r in chat.format_conversations(df.unionByName(df.selectExpr("2L as conv_id", "turn", "cast(null as string) as role", "cast(null as array<struct<type:string,text:string,ref:string,n_tokens:int>>) as parts")).unionByName(df.selectExpr("cast(null as long) as conv_id", "turn", "'assistant' as role", "array() as parts"))).collect()}
    assert got[1].formatted == "<|user>a\\lbc<!>" and got[1].attachments == []
    assert got[2].formatted == "<|><!>" and got[2].n_turns == 1 and got[None].formatted == "<|assistant><!>"


def test_chat_of_odd_turns(spark, folder_of, duck, same):
    rows = [(1, 0, "user", "<|assistant>x<!>"), (1, 0, "user", "<|assistant>x<!>"), (1, 1, "assistant", None), (1, 2, "assistant", "\\l\\b\\\\<>"), (2, None, None, ""), (None, 0, "assistant", "梦🦀" * 3000), (-7, 5, "user", "more")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    root = folder_of(conversations=df, nothing=df.limit(0))
    got = {r.conv_id: r for r in chat.op8_chat_format(spark, root).collect()}
    learnt = "" + "\\l\\b\\\\<>"
    assert got[1].n_turns == 4 and got[1].loss_chars == len(learnt) and got[1].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    turns = "user\n<|assistant>x<!>\n" * 2 + "assistant\n\n" + f"assistant\n{learnt}\n"
    assert got[1].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    assert got[None].loss_chars == 6000 and got[-7].n_turns == 3 and got[2].loss_chars == 0
    empty = folder_of(conversations=df.limit(0))
    assert [r.conv_id for r in chat.op8_chat_format(spark, empty).collect()] == [-7]


# shards


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(n):
    got = sharding.permute(np.arange(n), n, 5)
    assert sorted(got.tolist()) == list(range(n))
    assert n < 64 or (got != sharding.permute(np.arange(n), n, 6)).any()


def test_shards(spark, sf, odd, folder_of, table_of):
    docs = {r.doc_id: r.text for r in table_of("documents").itertuples()}
    got = sharding.op10_sharding(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["size"] == len(docs[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode())
    for rows in (got, sharding.op10_sharding(spark, folder_of(documents=odd)).collect()):
        slots = {}
        for r in rows:
            slots.setdefault(r.shard, []).append(r.slot)
        counts = [len(slots.get(k, [])) for k in range(24)]
        assert max(counts) - min(counts) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.op10_sharding(spark, sf).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in got}
    assert sharding.op10_sharding(spark, folder_of(documents=odd.limit(0))).count() == 0


def plain_shards(rows, shards=24, seed=17):
    """(id, text) -> (id, size, crc, shard, slot), with plain integers."""
    full = (1 << 64) - 1

    def mix(x, key):
        x ^= key
        x = ((x ^ (x >> 33)) * 0xFF51AFD7ED558CCD) & full
        x = ((x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53) & full
        return x ^ (x >> 33)

    keys = [mix((k * 0x9E3779B97F4A7C15 + seed) & full, 0) for k in range(1, sharding.ROUNDS + 1)]
    n = len(rows)
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1

    def permuted(v):
        while True:
            a, b = v >> half, v & mask
            for k in keys:
                a, b = b, a ^ (mix(b, k) & mask)
            v = a << half | b
            if v < n:
                return v

    told = []
    for d, t in rows:
        data = (t or "").encode()
        name, size, crc = "" if d is None else str(d), len(data) + 8, zlib.crc32(data)
        h = 42
        for part in (name.encode(), size.to_bytes(8, "little"), crc.to_bytes(8, "little")):
            h = xxhash.xxh64_intdigest(part, h)
        told.append((h, name, size, crc, d))
    told.sort(key=lambda x: x[:4])
    return sorted(((d, size, crc, p % shards, p // shards) for i, (_, _, size, crc, d) in enumerate(told) for p in [permuted(i)]), key=str)


def test_shards_by_plain_code(spark, sf, odd, folder_of, table_of):
    docs = table_of("documents")
    for rows, folder in ((list(zip(docs.doc_id.tolist(), docs.text)), sf), ([(r.doc_id, r.text) for r in odd.collect()], folder_of(documents=odd))):
        got = [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in sharding.op10_sharding(spark, folder).collect()]
        assert sorted(got, key=str) == plain_shards(rows)


def test_rows_that_repeat_often_are_dealt_out_in_blocks(spark):
    df = spark.createDataFrame([("x", (1 << 60) + 1)] * 50 + [("y", None)] * 3 + [(None, 2)], "a string, b long")
    small, whole = (sorted(((r.a, r.b, r.shard, r.slot) for r in sharding.shard_rows(df, ["a", "b"], 5, block=k).collect()), key=str) for k in (7, 1000))
    assert small == whole and len(small) == 54


# pieces


@pytest.fixture(scope="module")
def tools():
    model = pieces.Model.load()
    return pieces.Encoder(model), pieces.Decoder(model), sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_pieces_equal_the_library(tools, table_of):
    encoder, decoder, library = tools
    rng = random.Random(4)
    texts = ["", " ", "  x", "\n", "a\n\n b ", "x" * 300, "<s> </s> <unk>", " " * 70 + "y", "ab " * 40, "ﬁ é 梦🦀", "\0", "▁x ▁"]
    texts += ["".join(rng.choice("ab cé\n▁梦|🦀theTHE") for _ in range(rng.randint(0, 200))) for _ in range(100)]
    texts += ["".join(rng.choice("aethr") for _ in range(rng.randint(60, 300))) for _ in range(20)] + table_of("documents").text.tolist()
    ids, n = encoder.encode(texts)
    ends = np.cumsum(n)
    for t, lo, hi in zip(texts, ends - n, ends):
        want = library.encode(t)
        assert ids[lo:hi].tolist() == want
        assert decoder.decode(want) == library.decode(want)


def test_long_units_take_their_edges_from_the_suffix_array(tools, monkeypatch):
    """Text without spaces, longer than a suffix array, against the library; and without edges nothing is joined."""
    encoder, _, library = tools
    rng = random.Random(6)
    units = ["梦想的天空之城" * 80, "".join(rng.choice("theandingofre") for _ in range(5000)), "=" * 700, "short", "".join(rng.choice("ab梦c🦀") for _ in range(901)), "x" * 64, "y" * 65]
    units += ["".join(rng.choice("aethr") for _ in range(rng.randint(1, 90))) for _ in range(80)]
    for symbols in (300, 1000, 400_000):
        for arrays in (3, 64):
            ids, starts, counts = encoder.encode_units(["▁" + u for u in units], symbols, arrays)
            assert [ids[a : a + n].tolist() for a, n in zip(starts, counts)] == [library.encode(u) for u in units]
    monkeypatch.setattr(encoder, "edges", lambda symbols: np.full((len(symbols), encoder.longest + 1), -1, np.int32))
    ids, starts, counts = encoder.encode_units(["the" * 100])
    assert counts[0] >= 300


def test_vocabularies_of_one_size_are_told_apart():
    a, b = (pieces.Model(["<unk>", "▁a", x, "b"], [0.0, -1.0, -2.0, -3.0], [True, False, False, False], {}, 0) for x in ("c", "d"))
    c = pieces.Model(["<unk>", "▁a", "c", "b"], [0.0, -2.0, -1.0, -3.0], [True, False, False, False], {}, 0)
    assert len({a.digest, b.digest, c.digest}) == 3
    assert pieces._tools(a)[0].ids is not pieces._tools(b)[0].ids


def test_suffix_array_is_sorted(tools):
    encoder = tools[0]
    symbols = encoder.symbols(np.frombuffer(("banana bandana " * 20).encode("utf-32-le"), np.uint32))
    order, wide = encoder.suffix_array(symbols), encoder.longest
    suffixes = [symbols[i : i + wide].tolist() for i in order.tolist()]
    assert suffixes == sorted(suffixes) and sorted(order.tolist()) == list(range(len(symbols)))


def test_pieces_of_odd_documents(spark, odd, folder_of):
    got = pieces.encode(odd.withColumn("ids", F.lit(1))).collect()
    assert len(got) == 11 and all(r.lossless for r in got) and all(r.n_tokens == len(r.ids) for r in got)
    assert [r.n_tokens for r in got if not r.text] == [0, 0, 0]
    back = pieces.decode(pieces.encode(odd), out="back").collect()
    assert all(r.back == (r.text or "") for r in back)
    assert pieces.op5_sentencepiece(spark, folder_of(documents=odd.limit(0))).count() == 0
