"""Line frequency, url lists, mixing and pages against brute force."""

import html
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from delayworks.llm import bloom_cascade, water_filling
from delayworks.llm.bloom_cascade import Cascade, base_hashes, judge, split_by
from delayworks.llm.line_frequency import line_hash, measures, repeat_words, verdicts, without_boilerplate, without_lines
from delayworks.llm.main_text import best_region, extract, labelled_pages, learn, main_text
from delayworks.llm.water_filling import mixed, repetitions, water_fill, word_count

DATA = "/root/testdata/sf0.001"


def windows(words):
    at = defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i : i + 3])].append(i)
    return len({i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)})


@pytest.mark.parametrize("text", ["", "a", "a b c", "a b c a b c", "a a a a a", "x a b c y a b c z", "a b c d a b c d b c d"])
def test_repeated_windows(text):
    assert repeat_words(text.encode().split()) == windows(text.split())


def test_measures_by_hand():
    counts, lines = measures("Ab #1\n\nAb #1\n  \nCd$ é")
    assert counts == (6, 12, 3, 1, 0)
    assert lines == {line_hash("ab 0"): 4, line_hash("CD É"): 2}
    assert measures("")[0] == (0, 0, 0, 0, 0)


def test_boilerplate_lines_and_depleted_documents(spark, documents):
    menu = "Home | About | Contact us today"
    rows = [(i, f"{menu}\nown words number {i} and some more of them here", "h") for i in range(30)]
    rows += [(100 + i, f"{menu}\nonly {i}", "h") for i in range(3)]  # little besides the menu
    rows += [(200 + i, "a copied text stands often and every copy counts", "h") for i in range(40)]
    rows += [(400 + i, "a text with few copies", "h") for i in range(20)]
    rows += [(300, menu, "other"), (301, menu, None), (302, None, None), (303, "", "h"), (None, menu, "h"), (303, "", "h")]
    got = [(r["id"], r["boilerplate_words"], r["depleted"]) for r in verdicts(documents(rows)).collect()]
    assert len(got) == len(rows)
    by = {i: (n, gone) for i, n, gone in got}
    assert by[0] == (7, False) and by[100] == (7, True) and by[None] == (7, True)
    assert by[200] == (9, True) and by[400] == (0, False)
    assert by[300] == by[301] == by[302] == by[303] == (0, False)
    assert verdicts(documents([])).collect() == []
    assert without_boilerplate(f"{menu}\nown", {line_hash(menu)}) == "own"


def test_limits_do_not_grow_with_the_host(spark, documents):
    """A footer in 30 of 4,000 documents, and 500 copies of a page that is only a footer."""
    footer, page = "all rights reserved 2024", "imprint of the site"
    own = ["".join(chr(97 + int(c)) for c in str(i)) for i in range(4000)]  # digits are all alike in a line
    rows = [(i, f"words of {w} which nobody else has\n{footer}" if i % 133 == 0 else f"page of {w}", "h") for i, w in enumerate(own)]
    rows += [(5000 + i, page, "h") for i in range(500)]
    by = {r["id"]: (r["boilerplate_words"], r["depleted"]) for r in verdicts(documents(rows)).collect()}
    assert [i for i in by if i < 5000 and by[i][0]] == [i for i in by if i < 5000 and i % 133 == 0] and by[133] == (4, False)
    assert all(by[5000 + i] == (4, True) for i in range(500))


def test_lines_over_the_limit_are_removed(spark, documents):
    rng = random.Random(12)
    lines = [f"line {chr(97 + i)} of many" for i in range(12)]
    rows = [(i, "\n".join(rng.choices(lines, range(1, 13), k=rng.randrange(4)) + [f"own {'abc'[i % 3] * (i + 1)}"]), rng.choice(["h", "k", None])) for i in range(120)]
    rows += [(200, None, "h"), (201, "", "h"), (201, "", "h"), (None, lines[0], "h"), (203, lines[11], "h")]
    frame = documents([(*r, "mine") for r in rows], ", boilerplate_lost string")
    held = defaultdict(set)
    for row, (_, text, host) in enumerate(rows):
        for line in (text or "").split("\n"):
            held[host, line_hash(line)].add(row)
    expected = []
    for i, text, host in rows:
        kept = [line for line in (text or "").split("\n") if line_hash(line) is None or len(held[host, line_hash(line)]) <= 9]
        if 2 * len(" ".join(kept).split()) >= len((text or "").split()):
            expected.append((i, None if text is None else "\n".join(kept), host, "mine"))
    got = without_lines(frame, most_documents=9)
    assert got.columns == frame.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr) and len(expected) < len(rows)
    assert without_lines(documents([])).collect() == []


def test_cascade_is_exact_for_all_keys(spark):
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = spark.range(0, 6000, 7).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = Cascade(universe, listed, rate=0.3)
    keys = universe.select("key", *base_hashes(F.col("key"))).toPandas()
    assert len(cascade.levels) > 2
    found = cascade.contains(keys["h1"].to_numpy(), keys["h2"].to_numpy())
    assert (found == [int(k[1:]) % 7 == 0 for k in keys["key"]]).all()
    assert not Cascade(universe, listed.limit(0)).contains(keys["h1"].to_numpy(), keys["h2"].to_numpy()).any()


def test_urls_get_the_longest_rule(spark):
    rows = [
        (None, "", "", None),
        ("no address", "", "", None),
        ("http://a.net", "a.net", "", None),
        ("http://a.NET/", "a.net", "/", "net/"),
        ("https://x.example.net/en/1?q=/en/", "x.example.net", "/en/1", "example.net/en/"),
        ("https://myexample.net/en/", "myexample.net", "/en/", "net/"),
        ("s://example.com/de/#f", "example.com", "/de/", "example.com/de/"),
        ("s://a.org/fr/", "a.org", "/fr/", "org/fr/"),
        ("s://a.b.c.d.e.f.org/fr/x\ny", "a.b.c.d.e.f.org", "/fr/x\ny", "org/fr/"),
        ("s://.../", "...", "/", None),
        ("s://net:80/", "net:80", "/", None),
    ]
    rules = {"block": ["net/", "example.com/de/"], "allow": ["example.net/en/", "org/fr/"]}
    frame = spark.createDataFrame([(u, "mine") for u, *_ in rows], "url string, url_keys string")
    judged = judge(frame, rules)
    got = [(r["url"], r["host"], r["path"], r["rule"]) for r in judged.collect()]
    assert sorted(got, key=repr) == sorted(rows, key=repr)
    assert {r["list"] for r in judged.where("rule = 'net/'").collect()} == {"block"}
    assert {r["url_keys"] for r in judged.collect()} == {"mine"}
    assert judge(frame.limit(0), rules).collect() == []


def test_split_by_keeps_all_rows(spark, monkeypatch):
    rows, keys = spark.range(500).withColumnRenamed("id", "v"), spark.range(0, 500, 50)
    maybe, rest = split_by(rows, "v", keys)
    found = {r["v"] for r in maybe.collect()}
    assert found >= set(range(0, 500, 50)) and len(found) < 60
    assert found | {r["v"] for r in rest.collect()} == set(range(500))
    monkeypatch.setattr(bloom_cascade, "MAX_BITS", 8)
    assert split_by(rows, "v", keys)[0].count() == 500


def filled(sizes, weights, share, cap):
    """Round by round: clamp what is above its cap, share the rest again."""
    budget, open_, target = share * sum(sizes.values()), {s for s in sizes if weights[s] > 0}, dict.fromkeys(sizes, 0.0)
    while open_:
        rest = budget - sum(t for s, t in target.items() if s not in open_)
        total = sum(weights[s] for s in open_)
        want = {s: rest * weights[s] / total for s in open_}
        above = {s for s in open_ if want[s] > cap * sizes[s]}
        if not above:
            return target | want
        target |= {s: float(cap * sizes[s]) for s in above}
        open_ -= above
    return target


@pytest.mark.parametrize("share", [0.5, 1.5, 1.99, 3.0])
def test_water_filling_equals_rounds(spark, share):
    sizes = {"a": 1000, "b": 10, "c": 500, "d": 70, "e": 0, "f": 900}
    weights = {"a": 1.0, "b": 9.0, "c": 2.0, "d": 3.0, "e": 5.0, "f": 0.0}
    frame = spark.createDataFrame([(s, sizes[s], weights[s]) for s in sizes], "source string, source_size long, weight double")
    got = {r["source"]: r["target"] for r in water_fill(frame, share, 2.0).collect()}
    assert got == pytest.approx(filled(sizes, weights, share, 2))


def test_sources_are_numbered_in_order(spark):
    rng = random.Random(3)
    names = [None, "", "a", "ä", "z", "Z", "\U0001f600", "\uffee", *(f"s{rng.randrange(10**6)}" for _ in range(500))]
    rows = list(dict.fromkeys(names))
    rng.shuffle(rows)
    frame = spark.createDataFrame([(s, 1) for s in rows], "source string, more int").repartition(7)
    got = sorted((r["number"], r["source"]) for r in water_filling.numbered(frame).collect())
    ordered = sorted((s for s in rows if s is not None), key=lambda s: s.encode()) + [None]
    assert got == list(enumerate(ordered))


def test_very_many_sources(spark):
    """As many sources as documents: targets equal rounds of clamping, and no task gets them all."""
    rows = spark.range(200_000).select(
        F.concat(F.lit("s"), "id").alias("source"), F.lit(0).alias("bucket"), (F.col("id") % 97 + 1).alias("size")
    )
    made = water_filling.plan(rows).select("source", "source_size", "target", "weight").toPandas()
    assert made["target"].sum() == pytest.approx(1.5 * made["source_size"].sum())
    assert (made["target"] <= 2 * made["source_size"]).all()
    free = made[made["target"] < 2 * made["source_size"]]
    assert (free["target"] / free["weight"]).round(6).nunique() == 1
    made = made.sort_values("source")
    assert made["weight"].tolist()[:7] == [3, 1, 2, 3, 1, 2, 3] and set(made["weight"]) == {1, 2, 3}


def test_mix_is_near_its_targets_and_repeatable(spark, documents):
    rows = [(i, "w " * (1 + i * 37 % 200), None if i % 9 == 0 else f"s{i % 5}") for i in range(3000)]
    frame = documents([(*r, "x") for r in rows], ", mix_copy string")
    counted = repetitions(frame.select("doc_id", "source", word_count().alias("n")), F.col("n")).collect()
    taken, target = Counter(), {}
    for r in counted:
        assert 0 <= r["mix_times"] <= 2
        taken[r["source"]] += r["mix_size"] * r["mix_times"]
        target[r["source"]] = r["mix_target"]
    assert taken == pytest.approx(target, rel=0.01)
    assert sum(target.values()) == pytest.approx(1.5 * sum(r["mix_size"] for r in counted))
    drawn = mixed(frame)
    assert drawn.columns == frame.columns
    times = {r["doc_id"]: r["mix_times"] for r in counted if r["mix_times"]}
    assert Counter(r["doc_id"] for r in drawn.collect()) == times == Counter(r["doc_id"] for r in mixed(frame).collect())


def test_mix_of_odd_rows(spark, documents, monkeypatch):
    assert mixed(documents([])).collect() == []
    rows = [(None, "a b", "s"), (1, None, "s"), (2, "", None), (3, " \t", "t"), (3, " \t", "t"), (4, "x y z", "t")]
    for bound in (10, 0):  # broadcast, and joined by a shuffle
        monkeypatch.setattr(water_filling, "BROADCAST_SOURCES", bound)
        got = repetitions(documents(rows), word_count()).collect()
        assert len(got) == len(rows) and all(r["mix_size"] * r["mix_times"] <= 2 * r["mix_size"] for r in got)


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<header>Site name</header><nav><ul><li><a href='/x'>menu words here</a></li></ul></nav>{before}"
    "<article><h1>Of.</h1><p><b>First &lt;b&gt; &amp; more\n words.<br><p>Second.<div class='ad'>buy buy buy buy buy</div>"
    "<form>your mail <input></form><p>Last</p><section id='comments'><p>nice text of a reader, long and long</p></section>"
    "</article>{after}<footer>&copy; all the rights</footer></body></html>"
)
WANTED = "Of. First <b> & more words. Second. Last"


@pytest.mark.parametrize("before, after", [("", ""), ("<div class='notice'>we use cookies</div>", "<aside>see also this and that</aside>"), ("<!-- x -->", "<div>related words outside of it all, quite many of them in a row</div>")])
def test_article_of_a_page(before, after):
    page = PAGE.replace("{before}", before).replace("{after}", after)
    assert extract(page, learn([page])) == WANTED
    assert extract(page.replace("</body></html>", ""), learn([page])) == WANTED


def test_pages_without_marks():
    page = "<div id=nav>one two</div><div class=content><p>the text of it</p><p>goes <i>on</i>.</p></div><div class='sidebar'>no</div>"
    assert extract(page, learn([])) == "the text of it goes on."


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "<script>never closed", "</div></p>", "<article>", "a < b > c", "<a href='x", "&", "<nav>only this"])
def test_broken_pages(page):
    assert isinstance(extract(page, learn([page])), str)


def test_very_long_pages_take_linear_time():
    page = "<article>" + "<p>some words <b>and</b> more" * 40_000 + "</article>"
    assert len(extract(page, learn([page]))) == 40_000 * 20 - 1


def test_pages_of_the_table(spark):
    if not Path(DATA).exists():
        pytest.skip("no test tables")
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = main_text(pages, learn(labelled_pages(pages))).collect()
    for row in got:
        inner = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", inner))
        assert row["text"] == " ".join(filter(None, (" ".join(html.unescape(b).split()) for b in blocks)))
    empty = spark.createDataFrame([(None,), ("",)], "html string")
    assert [r["text"] for r in main_text(empty, learn([])).collect()] == ["", ""]


def test_a_head_that_is_never_closed_hides_nothing():
    page = "<html><head><title>T</title><style>p{}</style><body><article><p>The text.</article>"
    assert extract(page, learn([page])) == "The text."


@pytest.mark.parametrize("opening", ["<article class='no-sidebar'>", "<main class='header'>", "<div class='with-sidebar'><article>"])
def test_names_of_the_layout_hide_nothing(opening):
    page = f"<body class='sidebar'>{opening}<p>The text.</p><article class=comment>mine</article></article></main>"
    assert extract(page, learn([page])) == "The text."


@pytest.mark.parametrize("page, wanted", [
    ("<div class=post><p>The whole text of it.</p></div><article class=comment>reader's words</article>", "The whole text of it."),
    ("<script>var a = '<article>';</script><div><p>The text here.</p></div>", "The text here."),
    ("<!-- <main> --><div><p>The text here.</p></div>", "The text here."),
    ("<div><p>The real text of the page.</p></div><aside><article>teaser words</article></aside>", "The real text of the page."),
    ("<nav>menu<article><p>The text.</p></article>", "The text."),
    ("<article></article><div><p>The text here.</p></div>", "The text here."),
])
def test_articles_that_are_not_the_text(page, wanted):
    learned = learn([PAGE.replace("{before}", "").replace("{after}", "<div>other words outside of it</div>")])
    assert extract(page, learned) == extract(page, learn([])) == wanted


def test_pages_of_the_table_without_their_marks(spark):
    if not Path(DATA).exists():
        pytest.skip("no test tables")
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    weights = learn(labelled_pages(pages))
    for row in pages.select("html").collect():
        for element in ("div", "section", "page-text"):
            unmarked = re.sub(r"<(/?)article>", rf"<\1{element}>", row["html"])
            assert extract(unmarked, weights) == extract(row["html"], weights)


LONG = "Words of the text go on and on here, as many as it takes. " * 8


@pytest.mark.parametrize("body, text", [
    (f"<div class=post><p>{LONG}</p><p>{LONG}</p></div><article class='teaser'><p>Teaser</p></article>", f"{LONG}{LONG}Teaser"),
    (f"<main><p>x</p></main><div>{LONG}</div>", f"x {LONG}"),
    (f"<div id=t><h1>Head</h1><p>{LONG}</p></div><div class=comments><p>nice</p></div><div id=xyz>All rights reserved.</div>", f"Head {LONG}"),
    (f"<div id=t><h1>Head</h1><p>{LONG}</p></div><div class='post-sidebar-left has'><p>Other things</p></div>", f"Head {LONG}"),
    (f"<div><header><h1>Head</h1></header><p>{LONG}</p></div><header><h1>Site</h1></header>", f"Head {LONG}"),
    (f"<div><header><h1>Site</h1><a href=a>a</a><a href=b>b</a></header><p>{LONG}</p></div>", LONG),
])
def test_marks_are_no_feature(spark, body, text):
    """The same text whether a page marks it or not, and none of it lost where something else is marked."""
    if not Path(DATA).exists():
        pytest.skip("no test tables")
    weights = learn(labelled_pages(spark.read.parquet(f"{DATA}/pages.parquet")))
    assert extract(f"<html><body>{body}</body></html>", weights) == text.strip()


def test_the_scan_finds_the_greatest_sum():
    rng = random.Random(6)
    for _ in range(500):
        values = [rng.randrange(-4, 5) / 2 for _ in range(rng.randrange(25))]
        sums = {(i, j): sum(values[i:j]) for i in range(len(values)) for j in range(i + 1, len(values) + 1)}
        best = max(sums.values(), default=0)
        i, j = best_region(values)
        assert (i, j) == (0, 0) if best <= 0 else sums[i, j] == best


def test_words_score_by_place_on_unmarked_pages():
    outside = "<div>many words that stand beside the text and are no part of it at all, on every page of the site</div>"
    page = f"<body>{outside}<article><h1>Head</h1><p>The text of it.</p><p>And more.</p></article>{outside}</body>"
    unmarked = re.sub(r"<(/?)article>", r"<\1section>", page)
    assert extract(unmarked, learn([page])) == "Head The text of it. And more."
