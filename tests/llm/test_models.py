"""URL filter, HTML rendering and the quality classifier."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import classifier, html, urls

URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/x?q#f", "https://example.net", "http://example.net/EN/",
    "http://sub.example.com/de/1", "http://notexample.com/de/1", "http://x.org/fr/", "http://org/fr/a", "ftp://net?x/",
    "http://net/", "http://a.net#/en/", "http://Éxample.org/fr/ü\nx", "a://b://c/d", "http://u@h.net:80/en/",
]


def split(url):
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:end], rest[end:]
    stop = min((tail.find(c) for c in "?#" if c in tail), default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:stop]


def ruled(host, path):
    found = [
        r for r in urls.RULES
        if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0]))
        and path.startswith("/" + r.partition("/")[2])
    ]
    return max(found, key=len, default=None)


@pytest.fixture(scope="module")
def url_model(spark):
    return urls.train(urls.seed_urls(spark))


def test_hosts_paths_and_rules(spark, url_model):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string").withColumn("host", F.lit("x"))
    for row, url in zip(urls.judge_urls(df, url_model).orderBy("page_id").collect(), URLS, strict=True):
        assert (row["host"], row["path"]) == split(url), url
        assert row["rule"] == ruled(*split(url)), url
        by_model = "block" if row["score"] >= 0.5 else "allow"
        assert row["verdict"] == (urls.RULES[row["rule"]] if row["rule"] else by_model)


def test_model_tells_unseen_hosts_apart(spark, url_model):
    """Hosts of words that are in no labelled row, joined from parts of labelled ones or not."""
    bad = [f"www.{a}-{b}.example.com" for a in ("casino", "poker", "viagra", "porn") for b in ("online", "win", "shop")]
    good = [f"blog.{a}{b}.example.com" for a in ("ther", "thon", "tion", "museum") for b in ("ing", "ly", "ent")]
    score = url_model.score(bad + good, ["/en/5"] * 24)
    assert (score[:12] >= 0.5).mean() >= 0.9 and (score[12:] < 0.5).mean() >= 0.9


def words_of(url):
    host = split(url)[0].rpartition(".")[0]
    return {w for w in re.split(r"[^a-z]+", host) if len(w) > 3 and w not in ("example", "blog")}


def test_held_out_hosts_share_no_word_with_the_fit(spark):
    """Five folds by host; rows with a word of a held-out host are left out of its fit."""
    rows = [tuple(r) for r in urls.seed_urls(spark).collect()]
    assert len(rows) == len(set(rows)) > 250 and len({split(u)[0] for u, _ in rows}) > 250
    random.Random(1).shuffle(rows)
    right = 0
    for fold in range(5):
        held = rows[fold::5]
        words = set().union(*(words_of(u) for u, _ in held))
        rest = [r for k, r in enumerate(rows) if k % 5 != fold and not words & words_of(r[0])]
        model = urls.train(spark.createDataFrame(rest, "url string, blocked boolean"))
        score = model.score(*map(list, zip(*(split(u) for u, _ in held), strict=True)))
        right += sum((s >= 0.5) == blocked for s, (_, blocked) in zip(score, held, strict=True))
    assert right / len(rows) >= 0.75  # 0.79 measured: words it has never met are told apart by parts of them alone


def test_repeated_urls_are_judged_row_by_row(spark, url_model):
    df = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x"), (None, None)], "page_id long, url string")
    got = [tuple(r) for r in urls.judge_urls(df.withColumns({c: F.lit(0) for c in ("score", "rule")}), url_model).collect()]
    assert len(got) == 3 and len(set(got)) == 2


def test_training_checks_its_bound_and_its_classes(spark):
    table = urls.seed_urls(spark)
    with pytest.raises(ValueError, match="more than 10"):
        urls.train(table, max_labelled=10)
    with pytest.raises(ValueError, match="both kinds"):
        urls.train(table.filter("blocked"))
    again = urls.train(table.orderBy(F.rand(1)))
    assert np.array_equal(again.weights, urls.train(table).weights)


def test_no_urls(spark, url_model):
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string"), url_model).collect() == []


# ---- HTML ------------------------------------------------------------------------

PAGE = """<html><head><title>no</title><style>.x, #y {display:none} /* c */</style></head><body>a<p>one<p>two <b>bold</b>text
<ul><li>x<li>y<ol start=3><li>p<li>q<br>r</ol></ul><table><caption>cap<tr><th>Name<th>Count<tr><td>Alpha beta<td>12
<tr><td rowspan=2>r<td>1<tr><td>2</table><pre> a
  b</pre><div class=x>gone</div><div hidden>gone</div><span style="visibility:hidden">gone<i style="visibility:visible">V</i></span>
<details><summary>S</summary>gone</details><script>gone</script>1 &lt; 2 &amp; 3<blockquote>quo<p>te</blockquote>end<!-- gone"""
TEXT = """a

one

two boldtext

- x
- y

  3. p
  4. q
     r

cap
Name        Count
Alpha beta  12
r           1
            2

 a
  b

V
S
1 < 2 & 3

  quo

  te

end"""


def test_layout():
    assert html.render(PAGE) == TEXT


DRAWN = """<p>Sales <svg viewBox="0 0 9 9"><title>no</title><desc>no</desc><metadata>no</metadata><style/>
<defs><text>no</text></defs><style>.q {display:none}</style><script>no</script><path d="M0 0"/><g><text x="1">North</text><text>South
<tspan>East</tspan></text></g><text class="q">no</text><text display="none">no</text><text><![CDATA[a < b]]></text>
<foreignObject><div>inner</div></foreignObject></svg> end<p>Let <math><semantics><mrow><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac>
</mrow><annotation encoding="TeX">no</annotation></semantics></math> hold<p><svg><text>open<p>after <desc>seen</desc>"""


def test_drawings_and_formulas_are_inline_text():
    assert html.render(DRAWN) == "Sales North South East a < b\ninner\nend\n\nLet x=1 2 hold\n\nopen\n\nafter seen"


@pytest.mark.parametrize(
    "page",
    ["", "<", "<a", '<a href="x', "</", "<div>" * 3000 + "deep", "<table>" * 300 + "<tr><td>z", "<" * 5000, "<a " * 3000,
     '<p "' * 2000, "<!" * 3000, "<li>" * 3000, "<b" + ' x="' * 3000, "<div>" * 60_000 + "</p></b>" * 20_000 + "<li>" * 20_000, "<table><tr><td rowspan=999999 colspan=-1>" * 40, "\0&#x110000;"],
)
def test_any_markup_is_taken(page):
    assert isinstance(html.render(page), str)


STYLED = [
    # sheet, markup, what is seen
    ("@media print{.x{display:none}}", "<p class=x>hello", "hello"),
    ("@media print, screen{.x{display:none}}", "<p class=x>hello", ""),
    ("@media screen{.x{display:none}} .y{display:none}", "<p class=x>a<p class=y>b<p>c", "c"),
    ("@media (max-width: 9px){.x{display:none} .y{color:red}} .z{display:none}", "<p class=x>a<p class=z>b", "a"),
    ("@import 'a;b'; @supports (a:b){.x{display:none}} .y{display:none}", "<p class=x>a<p class=y>b", "a"),
    (".a{display:none} .b{display:block}", '<p class="b a">t', "t"),
    (".b{display:block} .a{display:none}", '<p class="a b">t', ""),
    ("div.x{display:none}", "<div class=x>a</div><p class=x>b", "b"),
    (".x.y{display:none} .x{display:block}", "<p class='y x'>a<p class=x>b", "b"),
    ("#i{display:none} p.x{display:block}", "<p id=i class=x>a<p>b", "b"),
    (".x{display:none!important}", "<p class=x style='display:block'>a<p style='display:none'>b<p>c", "c"),
    (".x{display:none}", "<p class=x style='display:block'>a", "a"),
    ("*{visibility:hidden} b{visibility:visible}", "<p>a<b>b</b>", "b"),
    ("p > b{display:none} .x:hover{display:none} [hidden]{color:red}", "<p class=x>a<b>b</b>", "ab"),
    ("/* p{display:none} */ i{display:none/* x */}", "<p>a<i>b</i>", "a"),
    (".x{display:none", "<p class=x>a<p>b", "b"),
    ("p{display:block}", "<p hidden>a<div hidden>b</div>", "a"),
    ("", "<dialog style='display:block'>a</dialog><dialog>b</dialog>", "a"),
]


@pytest.mark.parametrize("sheet, markup, seen", STYLED)
def test_sheet_rules(sheet, markup, seen):
    assert html.render(f"<style>{sheet}</style>{markup}") == seen


@pytest.mark.parametrize("depth", [150, 199, 230, 5000])
def test_hidden_parts_stay_hidden_at_any_depth(depth):
    page = "<style>.no{display:none} .dim{visibility:hidden} .lit{visibility:visible}</style>" + "<div>" * depth + (
        "a<script>x</script><p hidden>x<p>b<span class=no>x<b>x</b></span>c<div class=no><div>x</div>x</div>"
        "<i style='display:none'>x</i><div class=dim>x<span class=lit>d</span>x</div><style>p{color:red}</style>"
        "<noscript>x</noscript><template>x<b>x</b></template><textarea>e</textarea><ul><li>f<li hidden>x<li>g</ul>"
        "<table><tr><td>h<td class=no>x</table><svg><title>x</title><text>i</text></svg>"
    ) + "</div>" * depth + "z"
    shown = html.render(page)
    assert "x" not in shown
    assert [c for c in shown if c.isalpha()] == list("abcdefghiz")


def test_random_sheets_hide_what_they_say():
    """Rules of random compounds on random elements, against a plain reading of the cascade."""
    rng = random.Random(12)
    for _ in range(300):
        rules = []
        for _ in range(rng.randint(1, 8)):
            tag, ids = rng.choice(["", "", "p", "div", "*"]), rng.choice([[], [], [], ["i"], ["j"]])
            classes = rng.sample(["a", "b", "c"], rng.choice([0, 1, 1, 2]))
            selector = tag + "".join(f".{c}" for c in classes) + "".join(f"#{i}" for i in ids) or "*"
            rules.append((selector, tag, classes, ids, rng.choice(["none", "block"]), rng.random() < 0.2))
        sheet = " ".join(f"{r[0]} {{ color: red; display: {r[4]}{' !important' if r[5] else ''} }}" for r in rules)
        page, want = f"<style>{sheet}</style>", []
        for k in range(6):
            tag, own = rng.choice(["p", "div", "h2"]), rng.sample(["a", "b", "c"], rng.randint(0, 3))
            name, inline = rng.choice(["", "i", "j"]), rng.choice([None, None, "none", "block"])
            fitting = [
                (r[5], len(r[3]), len(r[2]), r[1] not in ("", "*"), at, r[4]) for at, r in enumerate(rules)
                if r[1] in ("", "*", tag) and set(r[2]) <= set(own) and set(r[3]) <= {name}
            ]
            best = max(fitting, default=None)
            said = best[5] if best and (best[0] or inline is None) else inline or "block"
            page += f"<{tag} class='{' '.join(own)}' id='{name}'" + (f" style='display:{inline}'" if inline else "") + f">w{k}</{tag}>"
            want += [f"w{k}"] * (said != "none")
        assert html.render(page).split() == want, page


def test_no_visible_text_is_lost():
    """Random trees: every visible word appears once and in order, tables and lists included."""
    rng = random.Random(4)
    number = 0

    def tree(depth):
        nonlocal number
        out = ""
        for _ in range(rng.randint(1, 4)):
            number += 1
            tag = rng.choice(["div", "p", "b", "span", "ul", "pre", "h2", "blockquote", "script", "none"])
            word = f" w{number} "
            inner = word + (tree(depth - 1) if depth and tag not in ("script", "p", "pre") else "")
            if tag == "ul":
                out += f"<ul><li>{inner}</ul>"
            elif tag == "none":
                out += f"<div style='display: none'>{inner.replace('w', 'hid')}</div>"
            elif tag == "script":
                out += f"<script>{inner.replace('w', 'hid')}</script>"
            else:
                out += f"<{tag}>{inner}</{tag}>"
        return out

    for _ in range(60):
        page = tree(3)
        shown = html.render(page)
        assert "hid" not in shown
        words = [w for w in shown.split() if w != "-"]
        cleaned = page
        while "display: none" in cleaned:  # drop the innermost hidden parts first
            cleaned = re.sub(r"<div style='display: none'>(?:(?!<div|</div>).|<div>(?:(?!<div|</div>).)*</div>)*</div>", "", cleaned, count=1) if re.search(
                r"<div style='display: none'>(?:(?!<div|</div>).|<div>(?:(?!<div|</div>).)*</div>)*</div>", cleaned
            ) else re.sub(r"<div>((?:(?!<div|</div>).)*)</div>", r"\1", cleaned, count=1)
        assert words == re.findall(r"\bw\d+\b", cleaned)


def test_pages_with_nulls_and_clashing_names(spark):
    df = spark.createDataFrame([(1, None, "u"), (2, "<p>x", "u"), (2, "<p>x", "u")], "page_id long, html string, text string")
    got = sorted((r["page_id"], r["text"]) for r in html.extract_text(df).collect())
    assert got == [(1, ""), (2, "x"), (2, "x")]
    assert html.extract_text(df.limit(0)).collect() == []


# ---- classifier ------------------------------------------------------------------


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "cat", "garden", "house.", "River", "walking", "blue"]) + rng.choice(["", "s"]) for _ in range(n))


def labelled(spark, n=400):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.75
        text = prose(rng, rng.randint(3, 200))
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", "### "), "spam " * 50])
        docs.append((i, text))
        if i % 4:
            labels.append((i, int(good)))
    docs += [(n, ""), (n + 1, None), (None, "x"), (5, docs[5][1])]
    return (
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash")),
        spark.createDataFrame([*labels, (10**9, 1), (3, None)], "doc_id long, quality int"),
    )


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    rows = classifier.score_documents(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.95
    for r in rows:
        expected = zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 if r["doc_id"] is not None else False
        assert r["held_out"] == expected
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_held_out_labels_change_nothing(spark):
    docs, labels = labelled(spark, 120)
    turned = labels.withColumn(
        "quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    first = classifier.score_documents(docs, labels).collect()
    second = classifier.score_documents(docs, turned).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    for a, b in zip(sorted(first, key=key), sorted(second, key=key), strict=True):
        assert a["score"] == pytest.approx(b["score"], abs=1e-9)


def test_model_equals_density_formula(spark):
    docs, labels = labelled(spark, 200)
    x = docs.select("doc_id", classifier.statistics(F.coalesce("text", F.lit(""))).alias("x"))
    model = classifier.fit(x.join(labels, "doc_id").filter("quality is not null").select("x", F.col("quality").alias("label")))
    table = [(np.array(r["x"]), r["quality"]) for r in x.join(labels, "doc_id").filter("quality is not null").collect()]
    points = np.array([v for v, _ in table])
    y = np.array([q for _, q in table])
    covs = [np.cov(points[y == c].T, bias=True) for c in (0, 1)]
    pooled = np.average(covs, axis=0, weights=[(y == 0).sum(), (y == 1).sum()])
    target = np.diag(np.diag(pooled)) + 1e-3 * np.eye(len(pooled))
    logs = []
    for c in (0, 1):
        s = 0.9 * covs[c] + 0.1 * target
        d = points - points[y == c].mean(axis=0)
        logs.append(np.log((y == c).mean()) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d))
    assert model.score(points) == pytest.approx(1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700))), abs=1e-6)


def test_without_labels_or_documents(spark):
    docs, labels = labelled(spark, 20)
    assert {r["score"] for r in classifier.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert classifier.score_documents(docs.limit(0), labels).collect() == []
