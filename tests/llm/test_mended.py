"""Articles keep their text, whatever their containers are called and whatever headings they share; group crossings grow
with a group; the pipeline against plain code."""

import random
import re

import pytest
from pyspark.sql import functions as F

from spindrift.llm import decontamination, extraction, langid, neardup
from tests.llm import brute
from tests.llm.test_small import copies, edited, pieces_fit, prose

SCHEMA = "page_id long, url string, html string"


def texts(spark, pages, host="h.example"):
    df = spark.createDataFrame([(i, f"http://{host}/{i}", p) for i, p in enumerate(pages)], SCHEMA)
    return {r.page_id: r.text for r in extraction.extract(df).collect()}


def own(i, k):
    return f"Own sentence {k} of page {i}, which no other page of this host has and which is long enough."


def test_shared_headings_stay(spark):
    page = "<html><body><nav><a href='/'>Home</a></nav><article><h1>Title {0}</h1><p>{1}</p><h2>Ingredients</h2><p>{2}</p><h2>Conclusion</h2><p>{3}</p><div>Share this article</div></article><footer>c</footer></body></html>"
    for n in (6, 12):
        got = texts(spark, [page.format(i, *(own(i, k) for k in range(3))) for i in range(n)])
        assert got == {i: "\n".join([f"Title {i}", own(i, 0), "Ingredients", own(i, 1), "Conclusion", own(i, 2)]) for i in range(n)}


@pytest.mark.parametrize(
    ("html", "wanted"),
    [
        ('<div class="layout has-sidebar"><article><p>{0}</p></article></div>', "{0}"), ('<div class="sidebar-left"><main><p>{0}</p></main></div>', "{0}"),
        ('<article><div class="post-share"><p>{0}</p></div><p>{1}</p></article>', "{0}\n{1}"), ('<article><div class="social-policy"><p>{0}</p></div></article>', "{0}"),
        ('<article><div class="article-header"><h1>Short</h1></div><p>{0}</p></article>', "Short\n{0}"), ('<article><p>{0}</p><div class="post-share"><a href="#">Share it with all of your many friends and with everybody else too</a></div></article>', "{0}"),
        ('<article><p>{0}</p><div class="post-comments"><p>{1}</p></div></article>', "{0}"), ('<article><p>{0}</p><div class="ad">{1}</div></article>', "{0}"),
        ('<article><p>{0}</p><div id="cookie-notice"><p>{1}</p></div></article>', "{0}"), ('<article><p>{0}</p><div class="comment"><p>{1}</p></div></article>', "{0}"),
        ('<article><p>{0}</p><div class="with-ads"><p>{1}</p></div></article>', "{0}\n{1}"), ('<article><p>{0}</p><div class="social-buttons">Like</div></article>', "{0}"),
        ('<div class="comments"><article><p>{0}</p></article>', "{0}"), ('<article><p>{0}</p><div class="site-search"', "{0}"),
    ],
)
def test_names_of_containers(spark, html, wanted):
    a, b = own(1, 1), own(2, 2)
    assert texts(spark, [f"<html><body>{html.format(a, b)}</body></html>"])[0] == wanted.format(a, b)


def test_slots_find_the_region_that_a_page_alone_does_not_show(spark):
    same = "".join(f"<p>Terms of use, section {k}: this paragraph is printed on each page of the site and is not what a reader came for.</p>" for k in range(8))
    page = "<html><body><div class='a1'>{}</div><div class='b2'>{}</div></body></html>"
    pages = [page.format(same, f"<p>{own(i, 0)}</p><p>{own(i, 1)}</p>") for i in range(5)]
    got = texts(spark, pages)
    assert got == {i: f"{own(i, 0)}\n{own(i, 1)}" for i in range(5)}
    paths = extraction.Paths()
    found = extraction.parsed(pages[0], paths)
    alone, _ = extraction.main_text(found, paths, extraction.region_of([p for x in found[0] for p in x[5]], paths))
    assert "Terms of use" in alone and alone != got[0]


def test_all_pages_of_a_host_make_its_template(spark):
    """A text that most pages show is the template's, also where some pages (one for each of six values of a hash) have
    their own text at the place; what near copies of one page share is not."""
    page = "<html><body><article><h1>Title {0}</h1><p>{1}</p>{2}<div class='box'>{3}</div></article></body></html>"
    ids = spark.range(240).withColumn("h", F.xxhash64("id", F.concat(F.lit("http://h.example/"), F.col("id").cast("string"))))
    odd = {r.least for r in ids.groupBy(F.pmod("h", F.lit(6))).agg(F.min_by("id", "h").alias("least")).collect()}
    pages = [page.format(i, own(i, 0), f"<h2>{own(i, 1)}</h2>" * (i % 3), f"Own end of page {i}" if i in odd else "Posted by the staff") for i in range(240)]
    copied = [f"<html><body><article><h1>Title of copy {i}</h1><p>{own('one', 0)}</p><h5>The end of it</h5></article></body></html>" for i in range(5)]
    got = texts(spark, pages + copied)
    for i in range(240):
        assert got[i].split("\n") == [f"Title {i}", own(i, 0), *[own(i, 1)] * (i % 3), *[f"Own end of page {i}"] * (i in odd)]
    assert [got[240 + i] for i in range(5)] == [f"Title of copy {i}\n{own('one', 0)}\nThe end of it" for i in range(5)]


def test_expressions_hold_every_structure(spark, monkeypatch):
    monkeypatch.setattr(extraction, "SHARE", 0)
    rng = random.Random(4)
    some = [[rng.randrange(6) for _ in range(rng.randrange(1, 9))] for _ in range(40)]
    rows = spark.createDataFrame([(h, k) for h in "ab" for k in some for _ in range(3)], "host string, keys array<long>")
    sizes = rows.groupBy("host").count().withColumnRenamed("count", "pages")
    for fan in (2, 7, 64):
        monkeypatch.setattr(extraction, "FAN", fan)
        found = {r.host: r["keys"] for r in extraction.expressions(rows, sizes).collect()}
        assert sorted(found) == ["a", "b"] and found["a"] == found["b"]
        for k in some:
            assert len(extraction.common(found["a"], k)) == len(k)


def test_an_empty_table(spark):
    assert texts(spark, []) == {}


@pytest.mark.parametrize(("n", "odd"), [(2000, 10), (8000, 10), (8000, 0)])
def test_crossings_grow_with_the_group(spark, n, odd):
    """n linked copies and some strays of one hub: rows are n for each block of strays, not n squared."""
    rows = [(i, 0, 0) for i in range(n)] + [(n + k, 0, n + k) for k in range(odd)]
    got = neardup.crossings(spark.createDataFrame(rows, "rep long, hub long, comp long"))
    assert got.count() == (n + odd * (-(-n // neardup.BLOCK)) + odd if odd else 0)


def test_crossings_meet_every_pair_of_components(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    comp = [0] * 11 + [20] * 5 + [30, 31, 32, 32]
    got = neardup.crossings(spark.createDataFrame([(i, 7, c) for i, c in enumerate(comp)], "rep long, hub long, comp long")).collect()
    cells, met = {}, set()
    for r in got:
        cells.setdefault((r.kind, r.i, r.j), ([], []))[r.side].append(r.rep)
    for left, right in cells.values():
        met |= {tuple(sorted((a, b))) for a in left for b in (right or left) if a != b}
    assert {(a, b) for a in range(20) for b in range(a + 1, 20) if comp[a] != comp[b]} <= met
    assert not any(comp[a] == comp[b] == 0 for a, b in met)


def test_letters_of_no_language_go(spark):
    """Texts with their characters in random order are rejected, the others stay; the network decides."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rng = random.Random(1)
    some = [r for r in docs.where("doc_id % 50 = 0 and length(text) > 200").select("doc_id", "text").collect()]
    junk = [(10_000_000 + r.doc_id, "".join(rng.sample(r.text, len(r.text))), None, "s", 1) for r in some]
    both = docs.unionByName(spark.createDataFrame(junk, "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    kept = {r[0] for r in langid.keep_identified(both).select("doc_id").collect()}
    lettered = docs.where(r"text rlike '\\p{L}'").count()
    assert len([i for i in kept if i < 10_000_000]) >= 0.999 * lettered and len(junk) > 100
    assert len([i for i in kept if i >= 10_000_000]) <= 0.05 * len(junk)


def plain_words(text):
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def test_pipeline_by_brute_force(spark, docs, tmp_path):
    """Five stages on a small table, each decision taken again by plain code; no row is labelled, so letters decide."""
    import corpus_pipeline

    rng = random.Random(21)
    items = [(k, prose(25, rng)) for k in range(4)]
    rows = copies()[:60]
    rows += [(500 + k, f"{prose(50, rng)} {edited(items[k % 4][1], k % 3, rng)} {prose(50, rng)}") for k in range(8)]
    rows += [(600 + k, f"{prose(40, rng)} write to user{k}@mail.example.org or call +420 601 {k}23 456 now {prose(40, rng)}") for k in range(8)]
    rows += [(700, None), (701, ""), (702, "12 34 !"), (703, "one word"), (704, "é")]
    table = docs(rows).selectExpr("doc_id", "text", "cast(null as string) AS lang", "source", "n_chars")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = {i: t for i, t in rows if t and re.search(r"[^\W\d_]", t)}
    component, _ = brute.components(left, percent=80)
    left = {i: t for i, t in left.items() if component[i] == i}
    leaks = lambda t: any(brute.edit_distance_within(plain_words(x), plain_words(t)) <= decontamination.budget(len(plain_words(x))) for _, x in items)
    left = {i: t for i, t in left.items() if not leaks(t)}
    assert not set(range(500, 508)) & set(left) and set(range(600, 608)) <= set(left)
    for i in list(left):
        spans = sorted((int(s), int(e), kind) for kind, s, e in (x.split(":") for x in brute.personal(left[i])))
        for start, end, kind in reversed(spans):
            left[i] = f"{left[i][:start]}<{kind.upper()}>{left[i][end:]}"
    assert "<EMAIL>" in left[600] and "<PHONE>" in left[600]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == set(left)
    pieces_fit(got, list(left.items()), 4096)
