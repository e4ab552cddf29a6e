"""Fingerprints, page texts and archives."""

import gzip
import hashlib
import random
import time
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourweave.llm import html_text as ht
from hourweave.llm import phrase_fingerprint as pf
from hourweave.llm import warc_fixity as wf
from hourweave.llm.queries import ORACLE_SQL, QUERIES
from hourweave.session import scratch_path
from tests.compare import difference, duck


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(n))


def test_labels_differ_from_neighbours():
    r = np.random.default_rng(1)
    names = r.integers(0, 2**63, 5000).astype(np.uint64)
    first = np.zeros(5000, bool)
    first[[0, 700, 701, 702]] = True
    label = pf.labels(names, first)
    assert label.max() <= 5 and all(label[i] != label[i - 1] for i in range(1, 5000) if not first[i])


def test_equal_parts_share_phrases_at_any_offset():
    part = prose(300, 1)
    a, b = ("abc " + part), (prose(40, 2) + part + prose(20, 3))

    def phrases(text):
        names = pf._mix(np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1))
        where = np.zeros(len(names), np.int64)
        for _ in range(3):
            where, names = pf.next_level(where, names)
        return set(names.tolist())

    x, y, only = phrases(a), phrases(b), phrases(part)
    assert len(x & y) > 0.9 * len(only)


def test_texts_do_not_influence_each_other():
    texts = ["", "a", "aaaa", "abab" * 50, prose(100, 4), "é" * 9, prose(5, 6), "𝄞 clef", prose(100, 4)]
    assert pf.fingerprints(texts) == [pf.fingerprints([t])[0] for t in texts]
    assert pf.fingerprints(texts)[4] == pf.fingerprints(texts)[8] and pf.fingerprints([""]) == [""]


def test_likeness():
    a = prose(600, 7)
    near, far = pf.edited_text(a, prose(600, 8)), prose(600, 9)
    one, two, three = pf.fingerprints([a, near, far])
    assert pf.likeness(one, one) == 1 and 0.4 < pf.likeness(one, two) < 0.8 and pf.likeness(one, three) < 0.1
    assert pf.likeness("", "") == 1 and pf.likeness("", one) == 0


def expected_next(rows):
    """(id, text, next text) in the order of ids, nulls first, then of Spark's hash of the text."""
    return [(i, t, rows[(k + 1) % len(rows)][1]) for k, (i, t) in enumerate(rows)]


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_following_documents(docs, ranges):
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text")).orderBy(F.col("doc_id").asc_nulls_first(), "tie")
    want = []
    for i, t, following in expected_next([(r.doc_id, r.text) for r in ordered.collect()]):
        edit = pf.edited_text(t, following)
        a, b, c = pf.fingerprints([t, edit, following])
        want.append((i, len(t), hashlib.sha256(edit.encode()).hexdigest(), a, b, pf.likeness(a, b), pf.likeness(a, c)))
    got = pf.compare_with_following(docs, ranges=ranges).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_fingerprints_of_nothing(empty):
    assert pf.compare_with_following(empty).count() == 0 and pf.fingerprint_documents(empty).count() == 0


def test_fingerprint_query(spark, sf_dir):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    got = QUERIES["op4_phrase_fingerprint"](spark, sf_dir).orderBy("doc_id").collect()
    for (i, t, following), r in zip(expected_next(rows), got, strict=True):
        edit = pf.edited_text(t, following)
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (i, len(t), hashlib.sha256(edit.encode()).hexdigest())
        assert [r.fingerprint, r.edited_fingerprint] == pf.fingerprints([t, edit])
    assert np.median([r.near_edited for r in got]) > 0.5 and np.median([r.near_next for r in got]) < 0.05


PAGE = """<html><head><title>t</title><style>p{}</style></head><body><header class="site-header"><h1>Site</h1></header>
<div class="cookie-notice">We use</div><div id="main2"><div class="post-content12"><h2>T &amp;lt; it</h2><p>Hello \t <b>wor</b>ld, this is a
long paragraph of text that goes on and on and on until it is long enough.<p>Second&nbsp;one<br>third<ul><li>a<li>b</ul><table><tr><td>x<td>y</table>
<div class="ad-box">Buy</div><aside>side</aside><form>f<input></form><!-- c --><script>if(a<b)"</p>"</script></div>
<div class="comments"><p>a reader comment that is quite long, longer than most of the others here, and so on and on</p></div></div>
<div class="sidebar"><a href=x>l</a></div><footer>f</footer>"""
TEXT = "T &lt; it Hello world, this is a long paragraph of text that goes on and on and on until it is long enough. Second one third a b x y"


def test_main_text():
    path, share = ht.vote(PAGE)
    assert path.endswith("div>div.post-content") and 0 < share <= 1
    assert ht.main_text(PAGE, path) == ht.main_text(PAGE, None) == ht.main_text(PAGE, "no>such>path") == TEXT
    for html, text in (("", ""), ("plain &amp; text", "plain & text"), ("<p>one<p>two", "one two"), ("<!-- x", ""), ("<p title='>'>q</p>", "q"), ("a < b", "a < b"), ("<nav>menu</nav>", "")):
        assert ht.main_text(html, None) == text


@pytest.mark.parametrize("attribute", ["class", "id"])
@pytest.mark.parametrize("name", "article-comments post-comments entry-footer post-share story-ad content-sidebar post-related articleComments mainNav sponsored-content comments".split())
def test_named_parts_of_an_article_are_left_out(attribute, name):
    """Longer than the article, so neither its text nor its score may count."""
    part = f"<div {attribute}='{name}'><p>" + "This reader says that it is all quite different, and at some length. " * 9 + "</p></div>"
    page = f"<body><div class='story'><p>The town has a new bridge.</p>{part}<p>It opens in May.</p></div></body>"
    path, _ = ht.vote(page)
    assert path.endswith(">div.story")
    assert ht.main_text(page, path) == ht.main_text(page, None) == "The town has a new bridge. It opens in May."


def test_good_class_beside_a_bad_one_is_left_out():
    page = "<body><div class='story'><p>The town has a new bridge.</p><div class='post comments'>Nice one</div></div></body>"
    assert ht.main_text(page, None) == "The town has a new bridge."


@pytest.mark.parametrize("name", ["post has-sidebar", "entry comments-open", "post tag-cookies category-social", "content-sidebar-wrap", "cookie-story", "post-content"])
def test_harmless_words_keep_the_article(name):
    page = f"<body><div class='{name}'><p>The town has a new bridge.</p><p>It opens in May.</p></div></body>"
    assert ht.main_text(page, None) == "The town has a new bridge. It opens in May."


def test_hosts_outvote_a_page(spark):
    """A page whose comments are longer than its article follows its host."""
    usual = "<body><div class='story'><p>" + prose(120, 1) + "</p></div><div class='talk'><p>hi</p></div>"
    odd = "<body><div class='story'><p>short news</p></div><div class='talk'><p>" + prose(90, 2) + "</p></div>"
    rows = [(i, "http://a.org/1", usual) for i in range(5)] + [(9, "https://A.org:80/2", odd), (10, "http://b.org", odd), (11, None, None), (11, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("taken"))
    got = {r.page_id: r.main for r in ht.extract_text(df, name="main").collect()}
    assert got[9] == "short news" and got[10] == prose(90, 2) and got[11] == "" and got[0] == prose(120, 1)
    assert ht.extract_text(df, name="main").count() == len(rows) and ht.extract_text(df.limit(0), name="main").count() == 0


@pytest.mark.parametrize(
    "page", ["<a" * 500_000, "<aaaa" * 200_000, '<p class="' + "x<b y='" * 150_000, "<a b " * 200_000 + "\"'>", "<b>" * 300_000 + "</i>" * 100_000, "<p>" * 300_000,
             "<div>" * 100_000 + "text<br>" * 20_000, "<" * 1_000_000, "<!" * 500_000, "<!--" * 250_000, '<a "><a \'>' * 100_000])
def test_hostile_pages_end(page):
    """A megabyte of broken markup: linear, about a second at most (the bound leaves room for a busy machine)."""
    begun = time.process_time()
    ht.main_text(page, None)
    assert time.process_time() - begun < 5


def test_deep_pages_have_their_text():
    deep = "<div class=story>" + "<div>" * 5000 + "<p>The town has a new bridge.</p>"
    assert ht.main_text(deep, None) == "The town has a new bridge."
    assert ht.main_text("<p>one</p><p title='open>two</p><p>three</p>", None) == "one two three"


@pytest.mark.parametrize("opening", ["<form id=aspnetForm>", "<div class='sidebar-right-layout'>", "<div id='page-with-nav'>", "<div role=form>", "<aside>", "<div class=widget>"])
@pytest.mark.parametrize("rest", ["", "<footer>All rights reserved</footer>", "<nav><a href=/>Home</a> menu</nav>"])
def test_an_element_around_the_page_stays(opening, rest):
    tag = opening[1:].split()[0].rstrip(">")
    page = f"<body>{opening}<nav><a href=/>Home</a></nav><h1>News</h1><p>The town has a new bridge.</p><div class=comments>Nice</div><p>It opens in May.</p></{tag}>{rest}</body>"
    assert ht.main_text(page, None) == "News The town has a new bridge. It opens in May."


def test_an_element_around_an_article_stays_beside_other_text():
    page = "<body><div class='page-with-nav'><h1>News</h1><p>The town has a new bridge, which opens in May.</p></div><div>All rights reserved</div></body>"
    assert ht.main_text(page, None) == "News The town has a new bridge, which opens in May."
    plain = "<body><header><h1>The site</h1> and its long slogan, longer than all else here</header><div class=story><p>The town has a new bridge.</p></div></body>"
    assert ht.main_text(plain, None) == "The town has a new bridge."


@pytest.mark.parametrize(
    "name", "category-menu category-nav topic-navigation tag-sidebar type-advert format-related commentlist leftnav topnav subnav mainmenu cookiebar adsbygoogle rightsidebar".split())
def test_parts_named_by_their_last_word_or_in_one(name):
    page = f"<body><div class='story'><p>The town has a new bridge.</p><div class='{name}'><p>Something else that is not part of it.</p></div><p>It opens in May.</p></div></body>"
    assert ht.main_text(page, None) == "The town has a new bridge. It opens in May."


class Article(HTMLParser):
    """Text of the article element by the standard library's parser: blocks by their tags, nothing else known."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.skipped, self.blocks = 0, 0, [""]

    def handle_starttag(self, tag, attributes):
        self.inside += tag == "article"
        self.skipped += tag in ("script", "style", "aside", "form")
        if tag in ("p", "h1", "h2", "br", "li", "ul", "div", "article", "figure", "blockquote", "td", "tr"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        self.skipped -= tag in ("script", "style", "aside", "form")
        if tag in ("p", "h1", "h2", "li", "ul", "div", "article", "figure", "blockquote", "td", "tr"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside and not self.skipped:
            self.blocks[-1] += data


def article_text(html):
    reader = Article()
    reader.feed(html or "")
    reader.close()
    return " ".join(filter(None, (" ".join(b.split()) for b in reader.blocks)))


def test_page_query(spark, sf_dir):
    """Every page against another parser that takes the article element."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op8_html_text"](spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article_text(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.fixture(scope="module")
def archive(spark):
    rows = [(i, f"http://x/{i}" if i % 3 else None, prose(i % 50, i) if i % 7 else None) for i in range(400)] + [(None, None, "no id"), (5, "http://x/5", "again")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("offset", F.lit(1))
    folder, copy = scratch_path(spark, "warc-test"), scratch_path(spark, "warc-copy")
    number = F.floor(F.col("page_id") / 100)
    index = wf.write_warc(pages, folder, number)
    wf.write_warc(pages, copy, number, damaged=F.col("page_id").isin(3, 150, 151, 399))
    return rows, index, folder, copy


def test_records_read_back(archive):
    rows, index, folder, _ = archive
    got = wf.hash_records(index, folder).collect()
    assert sorted(r.sha256 for r in got) == sorted(hashlib.sha256(wf.record(i, u, (h or "").encode())).hexdigest() for i, u, h in rows)
    ends = {}
    for r in sorted(got, key=lambda r: (r.file, r.offset)):
        assert r.offset == ends.get(r.file, 0)
        ends[r.file] = r.offset + r.length
    for file, end in ends.items():
        data = open(f"{folder}/{file}".removeprefix("file:"), "rb").read()
        assert len(data) == end and data.startswith(b"WARC/1.1\r\n")


@pytest.mark.parametrize("range_bytes, fan", [(256, 2), (4096, 16), (1 << 16, 16)])
def test_damage_is_found(archive, range_bytes, fan):
    _, index, folder, copy = archive
    found = wf.audit(wf.hash_records(index, folder), wf.hash_records(index, copy), range_bytes, fan)
    keys = {(r.file, r.offset): r.id for r in index.collect()}
    assert sorted((keys[r.file, r.offset], r.status) for r in found.collect()) == [(k, "corrupt") for k in (3, 150, 151, 399)]
    same = wf.hash_records(index, folder)
    assert wf.audit(same, same, range_bytes, fan).count() == 0


def test_missing_and_extra(archive, spark):
    _, index, folder, _ = archive
    whole = wf.hash_records(index, folder)
    part = whole.where("file <> 'records-000000002.warc' AND (file <> 'records-000000001.warc' OR offset < 2000)")
    gone = {(r.file, r.offset) for r in whole.collect()} - {(r.file, r.offset) for r in part.collect()}
    assert {tuple(r) for r in wf.audit(whole, part, 256, 2).collect()} == {(*k, "missing") for k in gone}
    assert {tuple(r) for r in wf.audit(part, whole, 256, 2).collect()} == {(*k, "extra") for k in gone}
    nowhere = wf.fixity_report(index, folder, scratch_path(spark, "no-replica"))
    assert {r.status for r in nowhere.collect()} == {"missing"}


def test_bytes_outside_records(archive, spark):
    """Bytes behind the last record, and between records that the index does not know."""
    rows, _, _, _ = archive
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-longer")
    index = wf.write_warc(pages, folder, F.floor(F.col("page_id") / 100))
    assert wf.unindexed_bytes(index, folder).count() == 0
    with open(f"{folder}/records-000000001.warc".removeprefix("file:"), "ab") as f:
        f.write(b"x" * 5000)
    assert [(r.file, r.unindexed, r.size - r.indexed) for r in wf.unindexed_bytes(index, folder).collect()] == [("records-000000001.warc", 5000, 5000)]
    fewer = index.where("id IS NULL OR id <> 7")
    gone = index.where("id = 7").first()
    assert (gone.file, gone.stored) in {(r.file, r.unindexed) for r in wf.unindexed_bytes(fewer, folder).collect()}
    assert wf.unindexed_bytes(index, scratch_path(spark, "nowhere")).count() == 0


def test_compressed_archives(archive, spark):
    """Each record a gzip member: same index of records, smaller files, damage found in the stored bytes."""
    rows, plain, _, _ = archive
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    one, two = scratch_path(spark, "warc-gz"), scratch_path(spark, "warc-gz-copy")
    index = wf.write_warc(pages, two, F.floor(F.col("page_id") / 100), damaged=F.col("page_id").isin(3, 399), compress=True, pristine=one)
    same = ["id", "file", "offset", "length"]
    assert index.select(same).exceptAll(plain.select(same)).isEmpty() and index.count() == plain.count()
    report = wf.fixity_report(index, one, two, compress=True).collect()
    assert sorted(r.id for r in report if r.status != "intact") == [3, 399]
    assert sorted(r.sha256 for r in report) == sorted(hashlib.sha256(wf.record(i, u, (h or "").encode())).hexdigest() for i, u, h in rows)
    first = min(index.collect(), key=lambda r: (r.file, r.offset))
    data = gzip.open(f"{one}/{first.file}.gz".removeprefix("file:")).read()
    assert data[: first.length].startswith(b"WARC/1.1\r\n")


def test_archives_of_nothing(spark, empty):
    pages = empty.selectExpr("doc_id AS page_id", "text AS html", "source AS url")
    folder = scratch_path(spark, "warc-empty")
    index = wf.write_warc(pages, folder, F.lit(1))
    assert wf.fixity_report(index, folder, folder).count() == 0


def test_fixity_equals_sql(spark, sf_dir):
    assert difference(QUERIES["op2_warc_fixity"](spark, sf_dir), duck(sf_dir), ORACLE_SQL["op2_warc_fixity"]) is None
