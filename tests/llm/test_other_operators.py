"""URL rules, pages, archives, media, packing, quality and lines on small and awkward tables."""

import base64
import collections
import hashlib
import html
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def rows(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# ---------------------------------------------------------------- URL rules

URLS = [None, "", "no scheme", "http://", "HTTP://COM/en/x", "https://a.Example.COM/en/7?q#f", "https://example.com/en/8", "http://xexample.com/en/71", "x://net?/de/", "x://a.b.net/de/8/9#z", "ftp://example.net/de/8", "http://example.net/de/9", "http://org./es/", "http://a..org/es/é", "://com/en/", "http://com/EN/", "a://b://c.com/en/", "http://example.com:80/en/7", "http://a\n.com/en/\nq", "http://" + "a." * 200 + "com/en/" + "x" * 3000]


def verdict(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        m = re.match(r"([^/?#]*)([^?#]*)", rest)
        host, path = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]
    best = None
    for rule, v in rules:
        rh, cut, rp = rule.partition("/")
        if (host == rh or host.endswith("." + rh)) and path.startswith(cut + rp):
            best = max(best or (0, 0, "", ""), (len(rule), len(rh), v, rule))
    return host, path, best[3] if best else None, best[2] if best else "allow"


@pytest.mark.parametrize("extra", [[], [("com", "block"), ("example.com/", "allow"), ("a.example.com/en", "block"), ("net/de/8", "block"), ("net/de/8", "allow"), ("b.net/de/8/9", "allow")]])
def test_url_rules(spark, extra):
    from tallymesh.llm.queries import RULES
    from tallymesh.llm.urlrules import judge

    rules = spark.sql(RULES)
    if extra:
        rules = rules.unionByName(spark.createDataFrame(extra, "rule string, verdict string"))
    plain = [(r.rule, r.verdict) for r in rules.collect()]
    own = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[5]), (3, URLS[5]), (3, URLS[5])]
    df = spark.createDataFrame(own, "page_id long, url string").withColumn("host", F.lit("?")).withColumn("key", F.lit("?")).withColumn("id", F.lit(1))
    for pages in (df, rows(spark, "pages"), df.limit(0)):
        want = sorted(repr((r.page_id, *verdict(r.url, plain))) for r in pages.collect())
        assert sorted(repr(tuple(r)) for r in judge(pages, rules).collect()) == want


# ---------------------------------------------------------------- pages


def test_main_text_of_the_table(spark):
    from tallymesh.llm.templates import extract

    got = {r.page_id: r for r in extract(rows(spark, "pages")).collect()}
    for r in rows(spark, "pages").collect():
        body = r.html[r.html.index("<article>") + 9 : r.html.rindex("</article>")]
        parts = (" ".join(html.unescape(re.sub(r"<br>|</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body))
        want = "\n".join(x for x in parts if x)
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want))


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a &amp; b&nbsp; c<p>d", "a & b c\nd"),
    ("<body><header>H</header><nav>N</nav><main><h1>T</h1><p>x <i>y</i>z</p><aside>A</aside><form><p>f</p></form></main><footer>F</footer>", "T\nx yz"),
    ("<article><p>one<div class='cookie-notice'>c</div><section id=comments><article><p>reader</p></article></section><p>two</article><div class=sidebar>s</div>", "one\ntwo"),
    ("<div class=menu><ul><li><a href=x>m</a></ul></div><div><p>text <a href=y>link</a> more</div><script>if (a<b) '</p>'</script>", "text link more"),
    ("<article><p>1 < 2 <b>bold<br>next</article>", "1 < 2 bold next"), ("<nav>never closed <article><p>kept", "kept"), ("<p>x<!-- <p>no --> y", "x y"), ("<a <b> \"' <p title='a>b'>q", "\"'\nq"),
    ("<main><p>Body text here.</p></main><aside class='related'><article><h3>Teaser</h3></article></aside>", "Body text here."),
    ("<footer><div class='post content'>foot</div></footer><p>body text</p>", "body text"),
    ("<article><h2 id='related-work'>Related work</h2><p>Para one.</p><p id='search'>Para two.</p><div id='banner-history'>Three.</div><section id='menu-of-day'><p>Four.</p></section></article>", "Related work\nPara one.\nPara two.\nThree.\nFour."),
    ("<article><p>a</p><div id='related-posts'>r</div><div class='site-footer'>f</div><div id='comments'><p>c</p></div></article>", "a"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
])
def test_main_text_of_odd_pages(page, want):
    from tallymesh.llm.templates import main_text

    assert main_text(page or "") == want


@pytest.mark.parametrize("name,kept", [("comments", False), ("article-comments", False), ("code-comments-in-python", True), ("related-work", True)])
def test_section_ids_inside_an_article_rule_out_reader_comments_alone(name, kept):
    from tallymesh.llm.templates import main_text

    page = f"<article><p>one</p><section id='{name}'><p>two</p></section></article>"
    assert main_text(page) == ("one\ntwo" if kept else "one")


LONG = "<p>A long sentence of the body that goes on and on.</p>" * 30
BODY = "\n".join(["A long sentence of the body that goes on and on."] * 30)


@pytest.mark.parametrize("page,want", [
    ("<article><p>one</p><div class='reader-comments'><p>nice</p></div><div class='user-comments'>x</div></article>", "one"),
    ("<article><p>body</p><section id='search'><p>On search trees</p></section><div class='paid-ad'>buy</div><div class='text-ad'>buy</div></article>", "body\nOn search trees"),
    (f"<div>{LONG}</div><article><h3>Read next: more</h3></article>", BODY), (f"<main>{LONG}<article class='card'>card</article></main>", BODY),
    (f"<main><p>lead</p><article>{LONG}</article></main>", BODY), (f"<article>{LONG}</article><div>{LONG[:300]}</div>", BODY),
])
def test_a_mark_is_a_vote(page, want):
    from tallymesh.llm.templates import main_text

    assert main_text(page) == want


def test_classes_decide_inside_articles(spark):
    """Marked pages too: what repeats inside the article goes, whatever its names; what one page has stays."""
    from tallymesh.llm.templates import extract

    pages = [(i, f"http://marked.example/{i}", f"<article><h1>Title {i}</h1><p>Own text number {i} of this page, long enough.</p><div class=zq><p>Follow our channel</p><p>All rights kept</p></div><p>End {i}</p></article>") for i in range(6)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(pages, PAGES)).collect()}
    assert got == {i: f"Title {i}\nOwn text number {i} of this page, long enough.\nEnd {i}" for i in range(6)}


def test_template_text_goes(spark):
    from tallymesh.llm.templates import extract

    pages = [(i, "http://h.org/x", f"<div><p>We use cookies here</p></div><div><h1>Title {i}</h1><p>Body of page {i}</p></div>") for i in range(30)]
    pages += [(100 + i, "http://few.org/", "<p>same</p>") for i in range(3)] + [(200, None, None), (201, None, "<p>x</p>"), (None, "", "<p>y</p>"), (7, "http://h.org/x", pages[7][2])]
    got = collections.Counter((r.page_id, r.text) for r in extract(spark.createDataFrame(pages, PAGES).withColumn("host", F.lit(1)).withColumn("tokens", F.lit(1))).collect())
    want = collections.Counter([(i, f"Title {i}\nBody of page {i}") for i in [*range(30), 7]] + [(100 + i, "same") for i in range(3)] + [(200, ""), (201, "x"), (None, "y")])
    assert got == want
    assert extract(spark.createDataFrame([], PAGES)).count() == 0


PROSE = "A sentence of page {i} number {j} that no other page has, long enough to be prose."


def layouts():
    """Pages of one host in two layouts, neither with an article element nor with names that tell, and what is their text."""
    pages, want = [], {}
    for i in range(24):
        own = [PROSE.format(i=i, j=j) for j in range(1 + i % 4)]
        body = f"<h1>Title {i}</h1>" + "".join(f"<p>{x}</p>" for x in own)
        teaser = f"<p>Today {i}</p><p>seen {i * 7} times</p>"
        notice = "<div class=k9><p>This site wants your consent to many things that are long to say and said on each page again and again.</p></div>"
        if i % 2:  # without headlines; one page's teaser is longer than its text
            body = body.replace("h1>", "p>")
            teaser = f"<p>{' '.join(f'teaser {i} {j} of other pages' for j in range(40))}</p>" if i == 5 else teaser
            pages.append((i, "http://two.org/a", f"<body><div class=x1>{notice}<div class=x2>{body}</div><div class=x3>{teaser}</div></div></body>"))
        else:
            pages.append((i, "http://two.org/b", f"<body><table><tr><td>{teaser}</td></tr></table><div><div>{body}<p>All rights with the two writers of this place.</p></div></div><div>{teaser}</div></body>"))
        want[i] = "\n".join([f"Title {i}", *own])
    return pages, want


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_templates_of_two_layouts(spark, monkeypatch, most):
    from tallymesh.llm import templates

    monkeypatch.setattr(templates, "BROADCAST_TOKENS", most)
    pages, want = layouts()
    df = spark.createDataFrame(pages + pages[:5], PAGES)
    assert {r.page_id: r.text for r in templates.extract(df).collect()} == want


def test_classes_decide(spark, monkeypatch):
    """Without template classes, or without the containers' shares, other text comes out."""
    from tallymesh.llm import templates

    pages, want = layouts()
    df = spark.createDataFrame(pages, PAGES)
    whole = templates.deduce
    monkeypatch.setattr(templates, "deduce", lambda tokens: whole(tokens).limit(0))
    got = {r.page_id: r.text for r in templates.extract(df).collect()}
    assert all("All rights" in got[i] for i in range(0, 24, 2))
    monkeypatch.setattr(templates, "deduce", whole)
    shares = templates._containers
    monkeypatch.setattr(templates, "_containers", lambda *a: shares(*a).limit(0))
    alone = {r.page_id: r.text for r in templates.extract(df).collect()}
    assert [i for i in want if alone[i] != want[i]] == [5]


def test_copies_are_no_template(spark):
    from tallymesh.llm.templates import extract

    body = "<article><h1>One story</h1><p>Told on every page of this host.</p></article>"
    pages = [(i, "http://copy.org/", f"<div class=ad>ad {i}</div>{body}") for i in range(6)]
    assert {r.text for r in extract(spark.createDataFrame(pages, PAGES)).collect()} == {"One story\nTold on every page of this host."}


# ---------------------------------------------------------------- archive


@pytest.mark.parametrize("least", [0, 5])
def test_archive(spark, least):
    from tallymesh.llm import warc_store

    odd = [(5, "http://a/", "same text"), (2, "u\r\nX: y", "same text"), (9, None, "same text"), (1, "v", None), (3, "v", ""), (None, "w", "same text"), (4, "z", "é" * 5000), (6, "q", "abc"), (7, "q", "abc"), (8, "q", "abc"), (8, "q", "abc")]
    for df in (spark.createDataFrame(odd, PAGES).withColumn("digest", F.lit("?")), rows(spark, "pages"), spark.createDataFrame([], PAGES)):
        source = [(r.page_id, (r.html or "").encode()) for r in df.collect()]
        records, payloads = warc_store.write(df, least)
        records.persist(), payloads.persist()
        assert payloads.count() == payloads.select("digest").distinct().count() == len({p for _, p in source})
        got = warc_store.index(records, payloads).collect()
        first = {}
        for i, p in source:
            if i is not None:
                first[p] = min(first.get(p, i), i)
        used, want = set(), []
        for i, p in source:
            head = len(p) < least or (first.get(p) == i and (i, p) not in used)
            used.add((i, p))
            want.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if head else "revisit", None if head else first[p]))
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
        back = warc_store.restore(records, payloads).collect()
        assert collections.Counter((r.page_id, bytes(r.payload)) for r in back) == collections.Counter(source)
        for r in back:
            head, body = bytes(r.record).split(b"\r\n\r\n", 1)
            assert body == (b"" if b"Type: revisit" in head else bytes(r.payload)) + b"\r\n\r\n"
        heads = [warc_store.fields(bytes(r.record).split(b"\r\n\r\n", 1)[0]) for r in back]
        named = {h["WARC-Record-ID"]: h for h in heads}
        assert len(named) == len(heads)
        for h in heads:
            if h["WARC-Type"] == "revisit":
                first = named[h["WARC-Refers-To"]]
                assert first["WARC-Type"] == "response" and first["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]


def test_damaged_payload_is_found(spark):
    from tallymesh.llm import warc_store

    bad = spark.createDataFrame([(bytearray(hashlib.sha256(b"a").digest()), bytearray(zlib.compress(b"b")))], "digest binary, body binary")
    with pytest.raises(Exception, match="does not have its digest"):
        warc_store.verify(bad).collect()


# ---------------------------------------------------------------- media


def test_png_round_trips():
    from tallymesh.llm import media

    rng = np.random.default_rng(0)
    for shape in ((1, 64), (7, 64), (33, 10)):
        x = rng.integers(0, 256, shape, dtype=np.uint8)
        for f in (0, 1, 2):
            assert (media.read_png(media.write_png(x, f)) == x).all()
    x = rng.integers(0, 256, (5, 9), dtype=np.uint8).astype(int)
    raw = b""
    for i in range(5):  # rows of the average and Paeth filters, and of the others
        up, kind = (x[i - 1] if i else np.zeros(9, int)), (3, 4, 4, 1, 3)[i]
        left, corner = np.append(0, x[i][:-1]), np.append(0, up[:-1])
        paeth = [min((a, b, c), key=lambda v: abs(a + b - c - v)) for a, b, c in zip(left, up, corner, strict=True)]
        raw += bytes([kind]) + bytes(((x[i] - {1: left, 3: (left + up) // 2, 4: np.array(paeth)}[kind]) % 256).tolist())
    head = struct.pack(">IIBBBBB", 9, 5, 8, 0, 0, 0, 0)
    png = media._SIGN + media._chunk(b"IHDR", head) + media._chunk(b"tEXt", b"k\0v") + b"".join(media._chunk(b"IDAT", p) for p in (zlib.compress(raw)[:9], zlib.compress(raw)[9:])) + media._chunk(b"IEND", b"")
    assert (media.read_png(png) == x).all()
    for damaged in (png[:20] + bytes([png[20] ^ 1]) + png[21:], png[:-12], b"x" + png[1:], png[:60] + bytes([png[60] ^ 255]) + png[61:]):
        with pytest.raises(ValueError):
            media.read_png(damaged)


def test_media_columns(spark):
    from tallymesh.llm.media import store_and_read

    odd = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 64), (4, "x" * 65), (None, "é"), (4, "x" * 65)], "doc_id long, text string").withColumn("png", F.lit(1))
    for df in (odd, rows(spark, "documents"), odd.limit(0)):
        want = []
        for r in df.select("doc_id", "text").collect():
            raw = (r.text or "").encode()
            pad = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
            want.append((r.doc_id, len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-64:])))
        got = store_and_read(df).collect()
        assert sorted(repr(tuple(r)[:5]) for r in got) == sorted(map(repr, want))
        same = collections.defaultdict(set)
        for r in got:
            same[r.payload_sha256].add((r.media_bytes, r.media_sha256, r.feature))
        assert all(len(v) == 1 for v in same.values())


# ---------------------------------------------------------------- packing


def test_packing(spark):
    from tokenizers import Tokenizer

    from tallymesh.llm.packing import pack
    from tallymesh.llm.queries import tokenizer_path

    model = Tokenizer.from_file(tokenizer_path())
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 9000), (4, "a,b. c! <|endoftext|> İ É, x.,"), (None, "z"), (3, "word " * 9000)], "doc_id long, text string").withColumn("start", F.lit(1))
    for df in (odd, rows(spark, "documents"), odd.limit(0)):
        docs = collections.defaultdict(list)
        for r in df.select("doc_id", "text").collect():
            docs[r.doc_id].append([*model.encode(r.text or "", add_special_tokens=False).ids, 1])
        pieces, fill = collections.defaultdict(list), collections.defaultdict(list)
        for r in pack(df, tokenizer_path()).collect():
            pieces[r.doc_id].append(r)
            fill[r.sequence_id].append((r.offset, r.length))
        assert set(pieces) == set(docs)
        for d, own in pieces.items():
            left = [(ids[a : a + n], a) for ids in docs[d] for r in own[:1] for a, n in [(0, len(ids))]]
            assert sum(r.length for r in own) == sum(len(ids) for ids, _ in left)
            for r in own:
                ids = docs[d][0][r.start : r.start + r.length]
                assert r.doc_tokens == len(docs[d][0]) and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        for own in fill.values():
            at = 0
            for offset, n in sorted(own):
                assert offset == at
                at += n
            assert at == 2048 or at & (at - 1) == 0


def test_cached_ids_are_the_tokenizers():
    """Random texts of letters, combining marks and signs, among them letters whose lower case is no letter alone."""
    from tokenizers import Tokenizer

    from tallymesh.llm.packing import CachedTokenizer
    from tallymesh.llm.queries import tokenizer_path

    model, own = Tokenizer.from_file(tokenizer_path()), CachedTokenizer(tokenizer_path())
    rng = np.random.default_rng(2)
    signs = [*"aAbZéÉßİıǅŉÅçñ漢字кЖ0129", "\u0301", "\u0307", "\u0308", "\u200d", "\u00a0", "\u3000", *" \n\t  ", *".,!?;:*$%&#'\"-()<|>", "ﬁ", "ª", "ͅ", "🙂"]
    texts = ["İ,", "Tatİ.", "KADİ.", "İ É, x.,", "a,b. c! d.", "it's. i'm, a.b", *("".join(rng.choice(signs, rng.integers(1, 40))) for _ in range(20_000))]
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        got = [x.tolist() for x in own.ids([t.encode() for t in part])]
        assert got == [e.ids for e in model.encode_batch(part, add_special_tokens=False)]


def test_few_documents_are_cut():
    from tallymesh.llm.packing import assign

    rng = np.random.default_rng(4)
    n = np.minimum(np.maximum(rng.lognormal(5.5, 1, 9000), 1).astype(int), 20_000)
    pieces = collections.Counter(doc for doc, *_ in assign(n, 2048))
    cut = sum(pieces[d] > 1 for d in np.flatnonzero(n <= 2048).tolist())
    assert cut < 0.08 * (n <= 2048).sum()
    assert assign(np.zeros(0, np.int64)) == [] and assign(np.array([5000]), 2048) == [(0, 0, 2048, 0, 0), (0, 2048, 2048, 1, 0), (0, 4096, 512, 2, 0), (0, 4608, 256, 3, 0), (0, 4864, 128, 4, 0), (0, 4992, 8, 5, 0)]


def test_cost_balance():
    from tallymesh.llm.packing import assign

    rng = np.random.default_rng(1)
    n = rng.integers(1, 900, 4000)
    rows_ = assign(n, 2048)
    cost = collections.Counter()
    for _, _, length, s, _ in rows_:
        cost[s] += length + length**2 / 2048
    full = [cost[s] for s in range(int(n.sum()) // 2048)]
    assert np.std(full) / np.mean(full) < 0.1 and len(rows_) < 2.0 * len(n)


# ---------------------------------------------------------------- quality


def test_quality_on_held_out_documents(spark):
    from tallymesh.llm.quality import score_documents

    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = score_documents(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    own = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in own) / len(own) > 0.95
    flipped = score_documents(docs, labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))))
    assert sorted(map(tuple, flipped.collect())) == sorted(map(tuple, got))


def test_quality_of_odd_tables(spark):
    from tallymesh.llm.quality import keep_good, score_documents

    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "x" * 50000), (3, "x" * 50000)], "doc_id long, text string").withColumn("score", F.lit("mine"))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 0), (3, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert score_documents(docs, labels).count() == 5
    assert {r.score for r in score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert score_documents(docs.limit(0), labels).count() == 0
    assert all(r.score == "mine" for r in keep_good(docs, labels.limit(0)).collect())


def test_descent_reaches_the_optimum():
    """Dual coordinate descent against projected gradient steps on the same dual problem."""
    from tallymesh.llm.quality import descend

    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.where(x[:, 0] + 0.6 * rng.normal(size=60) > 0, 1, -1)
    z, cost = np.hstack([x, np.ones((60, 1))]) * y[:, None], 0.7
    alpha, q = np.zeros(60), z @ z.T
    step = 1 / np.linalg.norm(q, 2)
    for _ in range(60_000):
        alpha = np.clip(alpha - step * (q @ alpha - 1), 0, cost)
    loss = lambda w: w @ w / 2 + cost * np.maximum(0, 1 - z @ w).sum()
    w = descend([(np.arange(8), v) for v in x], y, 8, cost, 400)
    best = loss(z.T @ alpha)
    assert abs(best - (alpha.sum() - alpha @ q @ alpha / 2)) < 1e-4 * best  # no gap: the optimum
    assert loss(w) < best * 1.001


def test_ratios_by_hand():
    from tallymesh.llm.quality import ALPHA, BINS, ratios

    bins, y = [np.array([1, 5]), np.array([5]), np.array([1, 9]), np.array([], int)], np.array([1, 1, -1, -1])
    seen = lambda k, v: sum(k in b for b, c in zip(bins, y, strict=True) if c == v) + ALPHA
    all_ = {v: sum(len(b) for b, c in zip(bins, y, strict=True) if c == v) + ALPHA * BINS for v in (1, -1)}
    r = ratios(bins, y)
    for k in (0, 1, 5, 9):
        assert r[k] == pytest.approx(np.log(seen(k, 1) / all_[1]) - np.log(seen(k, -1) / all_[-1]))


# ---------------------------------------------------------------- lines


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def near_lines(flats):
    """All pairs of edit similarity 0.8 or more: every pair is compared unless its counts of three bytes in a row rule it out."""
    from tallymesh.llm.lines import edit_distance

    flats = sorted(flats, key=lambda x: len(x.decode()))
    texts = [x.decode() for x in flats]
    size = np.array([len(t) for t in texts])
    grams = np.zeros((len(flats), 1024), np.uint8)
    for i, x in enumerate(flats):
        for g in range(len(x) - 2):
            k = zlib.crc32(x[g : g + 3]) % 1024
            grams[i, k] += grams[i, k] < 255
    out = []
    for i in range(len(flats)):
        j = np.arange(i + 1, np.searchsorted(size, size[i] / 0.8 + 1e-9, "right"))
        most = np.floor(size[j] * 0.2 + 1e-9).astype(int)
        apart = (np.maximum(grams[j], grams[i]) - np.minimum(grams[j], grams[i])).sum(1, dtype=np.int64)
        for k, m in zip(j[apart <= 12 * most].tolist(), most[apart <= 12 * most].tolist(), strict=True):
            if edit_distance(texts[i], texts[k], m) <= m:
                out.append((flats[i], flats[k]))
    return out


def lines_left(docs):
    from tallymesh.llm.lines import normal

    seen = [(d is None, d or 0, n, flat, i) for i, (d, t) in enumerate(docs) for n, flat in enumerate(normal(t or "")) if flat]
    seen.sort()
    first = {}
    for s in seen:
        first.setdefault(s[3], s)
    parent = {f: f for f in first}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in near_lines(first):
        a, b = find(a), find(b)
        if first[a] > first[b]:
            a, b = b, a
        parent[b] = a
    keep = {first[f][:3] for f in first if find(f) == f}
    out = []
    for d, t in docs:
        if t is None:
            out.append((d, None))
            continue
        flat = normal(t)
        out.append((d, "\n".join(x for n, x in enumerate(t.split("\n")) if not flat[n] or (d is None, d or 0, n) in keep)))
    return sorted(map(repr, out))


def test_lines(spark):
    from tallymesh.llm.lines import dedup_lines

    long = " ".join(f"word{i}" for i in range(60))
    odd = [(1, f"{long}\nunique line\n\nsame"), (2, f"Same!\n{long.replace('word7 ', 'other ')}\n\n"), (3, None), (4, ""), (5, "same\nsame\nSAME."), (None, "same\nonly here"), (6, "x 1\nx 2\nx 12"), (7, "é à\nÉ À"), (8, "y" * 30000)]
    df = spark.createDataFrame(odd, "doc_id long, text string").withColumn("line", F.lit("?")).withColumn("n_chars", F.length("text").cast("long")).withColumn("key", F.lit("?"))
    for t in (df, rows(spark, "documents"), df.limit(0)):
        got = dedup_lines(t)
        assert got.columns == t.columns
        assert sorted(repr((r.doc_id, r.text)) for r in got.collect()) == lines_left([(r.doc_id, r.text) for r in t.collect()])
    twice = dedup_lines(df.where("doc_id = 1").unionByName(df.where("doc_id = 1"))).collect()
    assert len(twice) == 2 and twice[0].text == twice[1].text


def test_edit_distance():
    from tallymesh.llm.lines import edit_bound, edit_distance

    rng = np.random.default_rng(0)
    for _ in range(400):
        a, b = ("".join(rng.choice(list("abcé"), rng.integers(0, 12))) for _ in range(2))
        assert edit_distance(a, b) == edit(a, b)
        a, b = (" ".join(rng.choice(["a", "bb", "ccc", "é"], rng.integers(0, 8))) for _ in range(2))
        assert edit(a, b) <= edit_bound(a, b) <= max(len(a), len(b)) * 2 + 2 and (a != b or edit_bound(a, b) == 0)
    long = "".join(rng.choice(list("abcdef"), 300))
    for cut in (0, 50, 299):
        other = long[:cut] + "zz" + long[cut + 3 :]
        assert edit_distance(long, other) == edit(long, other)


def test_many_distances_at_once():
    from tallymesh.llm.lines import WORDS, similar

    rng = np.random.default_rng(1)
    pairs = [("", ""), ("a", ""), ("a", "a"), ("ab" * 32, "ab" * 31 + "ba"), ("é" * 65, "é" * 60), ("x" * (64 * WORDS + 1), "x" * (64 * WORDS - 9))]
    for n in [1, 2, 5, 9, 30, 63, 64, 65, 128, 190, 300] * 8:
        a = "".join(rng.choice(list("abcdé ü"), n))
        b = list(a)
        for _ in range(int(rng.integers(0, n // 3 + 2))):
            i, kind = int(rng.integers(0, len(b) + 1)), int(rng.integers(0, 3))
            b[i : i + (kind != 0)] = [] if kind == 1 else [str(rng.choice(list("abcdxé")))]
        pairs += [(a, "".join(b)), ("".join(b), a)]
    want = [edit(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9) for a, b in pairs]
    assert 40 < sum(want) < len(want) - 40
    assert similar(pairs).tolist() == want


@pytest.mark.parametrize("letters", ["ab", "abcdé ü", "\0a😀", "".join(map(chr, range(0x4E00, 0x5200)))])
def test_changes_within_a_band(letters):
    """Bands of one word and of several, few characters and more than share a table."""
    from tallymesh.llm.lines import _within

    rng, pairs = np.random.default_rng(2), []
    for n in [2, 9, 64, 65, 150, 330, 700] * 6:
        a = [letters[i] for i in rng.integers(0, len(letters), n)]
        b = list(a)
        for _ in range(int(rng.integers(0, n // 2 + 2))):
            i, kind = int(rng.integers(0, len(b) + 1)), int(rng.integers(0, 3))
            b[i : i + (kind != 0)] = [] if kind == 1 and len(b) > 1 else [letters[int(rng.integers(0, len(letters)))]]
        pairs.append(sorted(("".join(a), "".join(b)), key=len, reverse=True))
    pairs = sorted((p for p in pairs if len(p[0]) - len(p[1]) <= len(p[0]) // 5), key=lambda p: len(p[1]))
    most = np.array([len(a) // 5 for a, _ in pairs])
    want = [edit(a, b) <= m for (a, b), m in zip(pairs, most.tolist(), strict=True)]
    assert 5 < sum(want) < len(want) - 1
    assert _within(*zip(*pairs, strict=True), 3, most).tolist() == want


def test_packed_rows_come_back_and_share_bytes():
    """Rows of one segment travel by columns of bytes, so what they share takes no room."""
    import zlib

    from tallymesh.llm.common import text_bytes
    from tallymesh.llm.meet import PACK, ROW, _packed, _unpacked

    rng = np.random.default_rng(0)
    a = np.empty(3 * PACK + 5, ROW)
    for name in ("key", "node", "fp", "more"):
        a[name] = rng.integers(0, 1 << 63, len(a), np.uint64).view(ROW[name])
    a["size"] = rng.integers(20, 500, len(a))
    sent = _packed(a, 4)
    data, off = text_bytes(sent.column(1))
    back = np.concatenate([_unpacked(data[i:j]) for i, j in zip(off[:-1], off[1:], strict=True)])
    assert back.tolist() == a[np.argsort(a["key"], kind="stable")].tolist()
    assert len(zlib.compress(data.tobytes(), 1)) < 0.93 * a.nbytes


@pytest.mark.parametrize("text", ["", "A  b\tc\n ,. \n\r\nÉ x ", " one \ntwo", "\x1c a\n..."])
def test_normal_lines(text):
    from tallymesh.llm.lines import _FLAT, normal

    assert normal(text) == [b" ".join(x.split()) if x.translate(_FLAT).strip() else b"" for x in text.lower().encode().split(b"\n")]


def test_lines_near_a_hot_line(spark, monkeypatch):
    """Groups beyond FEW lines, hot keys, and strays that a forest alone would not compare."""
    from tallymesh.llm import meet
    from tallymesh.llm.lines import dedup_lines

    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(400)]
    base = [str(x) for x in rng.choice(words, 30, replace=False)]
    texts = []
    for n in [0, 1, 2, 3, 5, 7, 8, 9, 10] * 12:  # near and not so near variants that share shingles
        own = list(base)
        for i in rng.choice(30, n, replace=False):
            own[i] = str(rng.choice(words))
        texts.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    flat = [(d, t) for d, t in enumerate(texts)]
    linked = {frozenset(x) for x in near_lines({t.encode() for t in texts})}
    assert len(linked) > 500
    want = lines_left(flat)
    for block, rate in ((2048, 16), (20, 1)):
        monkeypatch.setattr(meet, "RATE", rate)
        monkeypatch.setattr(meet.meetings, "__defaults__", ((), False, block))
        assert sorted(repr((r.doc_id, r.text)) for r in dedup_lines(df).collect()) == want


def typos(rng, text, share):
    return "".join(str(rng.choice(list("abcdefghijklmnopqrstuvwxyz"))) if c != " " and rng.random() < share else c for c in text)


def changed_lines(rng, kind):
    """A line and a near one: the ways in which lines differ, words and scripts alike."""
    word = lambda lo=3, hi=10: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(lo, hi)))
    words = lambda n, *size: [word(*size) for _ in range(n)]
    if kind == "unspaced":
        a = word(40, 41)
        i = int(rng.integers(0, 40))
        return a, a[:i] + "0" + a[i + 1 :]
    if kind == "chinese":
        a = "".join(map(chr, rng.integers(0x4E00, 0x9FA5, 30)))
        i = int(rng.integers(0, 30))
        return a, a[:i] + "\u4e00" + a[i + 1 :]
    if kind == "url":
        a = "https://" + word() + ".example/" + "/".join(words(3)) + "?id=" + word(12, 13)
        return a, a[:-3] + word(3, 4)
    if kind == "last letters":
        w = words(15, 4, 9)
        return " ".join(w), " ".join(x[:-1] + "0" if i % 3 == 0 else x for i, x in enumerate(w))
    if kind == "plurals":
        w = words(20, 7, 12)
        return " ".join(w), " ".join(x + "s" * (i % 2) for i, x in enumerate(w))
    if kind.startswith("swapped"):
        n, of = map(int, kind.split()[1:])
        w = words(of)
        v = list(w)
        for i in rng.choice(of, n, replace=False):
            v[i] = word()
        return " ".join(w), " ".join(v)
    n, share = kind.split()
    a = " ".join(words(int(n)))
    return a, typos(rng, a, float(share))


#: Least share of near pairs that are linked. Where every eighth letter is wrong no run of letters that tells lines apart is left in common often enough.
RECALL = {"unspaced": 0.95, "chinese": 0.95, "url": 0.95, "last letters": 0.88, "plurals": 0.88, "30 0.05": 0.9, "30 0.08": 0.7, "30 0.12": 0.25, "12 0.05": 0.9, "swapped 1 8": 0.95, "swapped 2 12": 0.9, "swapped 4 24": 0.9, "swapped 8 50": 0.9}


def test_recall_of_near_lines(spark):
    """All kinds together: what share of the pairs of edit similarity 0.8 or more is found, kind by kind."""
    from tallymesh.llm.lines import dedup_lines

    rng, pairs = np.random.default_rng(11), []
    for kind in RECALL:
        made = [changed_lines(rng, kind) for _ in range(120)]
        pairs += [(kind, a, b) for a, b in made if a != b and edit(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)]
    df = spark.createDataFrame([x for i, (_, a, b) in enumerate(pairs) for x in ((2 * i, a), (2 * i + 1, b))], "doc_id long, text string")
    got = {r.doc_id: r.text for r in dedup_lines(df).collect()}
    assert all(got[2 * i] == a for i, (_, a, _) in enumerate(pairs))
    for kind, least in RECALL.items():
        own = [not got[2 * i + 1] for i, p in enumerate(pairs) if p[0] == kind]
        assert len(own) > 60 and np.mean(own) >= least, (kind, np.mean(own))


def test_numbers_are_not_alike(spark):
    """Digits and marks count: rows of a table stay, near numbers and marks go."""
    from tallymesh.llm.lines import dedup_lines

    rows_ = [(1, "12 + 34\n2019\nTotal: 17 EUR"), (2, "99 - 11\n1847\nTotal: 95 (EUR)"), (3, "The meeting of 12 May is over.\n----"), (4, "the meeting of 13 may is over!\n----"), (5, "\n".join(f"{i * 7919 % 100000} {i * 104729 % 100000}" for i in range(40)))]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    assert [got[i] for i in (1, 2, 3)] == [t for _, t in rows_[:3]] and got[4] == "----"
    left = got[5].split("\n")
    for a in left:  # what went was near a line that stays
        assert all(a == b or edit(a, b) > int(max(len(a), len(b)) * 0.2 + 1e-9) for b in left)


def test_removed_lines_are_counted(spark):
    from tallymesh.llm.lines import line_report

    rows_ = [(1, "one two three\n\nfour five"), (2, "one two three\n\nfour five"), (3, "\n"), (4, None), (5, "one two three"), (6, "\nfour five")]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in line_report(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {1: (3, 0, sha(rows_[0][1])), 2: (3, 2, sha("")), 3: (2, 0, sha("\n")), 4: (1, 0, sha("")), 5: (1, 1, sha("")), 6: (2, 1, sha(""))}


def test_near_lines_beyond_two_bits_go(spark):
    from tallymesh.llm.lines import dedup_lines, line_hashes

    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 9))) for _ in range(2000)]
    pairs = []
    for size in [1, 2, 3, 5, 8, 11, 12, 20, 31, 60] * 8:
        a = list(rng.choice(vocabulary, size))
        b = list(a)
        for i in rng.choice(size, max(1, size // 12), replace=False):
            b[i] = b[i][:-1] + "qz"[: 1 + (size > 5)] if size < 20 else str(rng.choice(vocabulary))
        a, b = " ".join(a), " ".join(b)
        if a != b and edit(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9):
            pairs.append((a, b))
    bits = [(int(x) ^ int(y)).bit_count() for x, y in (line_hashes([a.encode(), b.encode()]) for a, b in pairs)]
    assert len(pairs) > 60 and sum(x > 2 for x in bits) > 40
    df = spark.createDataFrame([x for i, (a, b) in enumerate(pairs) for x in ((2 * i, a), (2 * i + 1, b))], "doc_id long, text string")
    got = {r.doc_id: r.text for r in dedup_lines(df).collect()}
    assert [got[2 * i] for i in range(len(pairs))] == [a for a, _ in pairs]
    assert not any(got[2 * i + 1] for i in range(len(pairs)))


def test_lines_of_one_simhash_all_meet(spark):
    from tallymesh.llm.lines import dedup_lines, line_hashes

    rng = np.random.default_rng(9)
    words = [f"{x:05x}" for x in rng.integers(1 << 16, 1 << 20, 40)]
    words = ["".join(chr(97 + int(c, 16)) for c in w) for w in words]
    mixed = [words[i] for i in rng.permutation(40)]
    near = [*mixed[3:], *mixed[:3]]  # the same words, near mixed and far from the head
    rows_ = [(1, " ".join(words)), (2, " ".join(mixed)), (3, " ".join(near))]
    assert len(set(line_hashes([t.encode() for _, t in rows_]).tolist())) == 1
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    assert got == {1: rows_[0][1], 2: rows_[1][1], 3: ""}


def test_bpe_cache_is_bounded_and_keeps_what_comes_back(monkeypatch):
    import public_tokenizers
    from tallymesh.llm import bpe

    merged, merge = [], bpe.merge
    monkeypatch.setattr(bpe, "merge", lambda symbols, merges: merged.append(1) or merge(symbols, merges))
    assert bpe.CACHE_PIECES <= 1 << 19
    spec = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    small, large = bpe.Codec(spec, 8), bpe.Codec(spec)
    text = "".join(f" hot w{'abcdefghij'[i % 10]}x{'klmnopqrst'[i // 10]}" for i in range(50))
    assert small.encode(text) == large.encode(text)
    assert len(small) + len(small.old) <= 8
    merged.clear()
    small.encode(" hot")
    assert not merged
