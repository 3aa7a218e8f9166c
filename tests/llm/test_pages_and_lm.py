"""HTML extraction, URL filters and pseudo-likelihood scores."""

import math
import re
from urllib.parse import urlsplit

import numpy as np
import pytest

from kerbside.llm import html_extract, lm_score, url_filter
from kerbside.llm.common import prepare
from kerbside.llm.queries import URL_RULES

LONG = "Here is a sentence of the article that is long enough to look like running text of a page."
FRAME = (
    "<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><header><a href=/>Home</a></header>"
    "<nav><ul><li><a>One</a><li><a>Two</a></ul></nav><div class='cookie-notice'>We use cookies</div>{}"
    "<aside><p>Side</p></aside><form><label>Name</label><input></form><footer>&copy; us</footer></body></html>"
)


@pytest.mark.parametrize(
    ("body", "text"),
    [
        (f"<article><h1>Title &amp; more</h1><p>{LONG}</p><p>Short.</p></article>", f"Title & more\n{LONG}\nShort."),
        (f"<div id=content><h1>T</h1><p><b>{LONG}<br><p>a  b\n c</p><ul><li>x<li>y</ul></div>", f"T\n{LONG}\na b c\nx\ny"),
        (f"<main><p>{LONG}</p><script>var x='</p>';</script><div class=ad>Buy</div><p>&#8364; 5 &lt; 6</p></main>", f"{LONG}\n€ 5 < 6"),
        (f"<article><p>{LONG}</p></article><section id='comments'><p>{LONG} nice</p></section>", LONG),
        (f"<div class='layout sidebar-left'><article><p>{LONG}</p><p>end</p></article></div>", f"{LONG}\nend"),
        (f"<article><p>{LONG}<!-- no --> more</p><noscript>off</noscript><p>caf&eacute;</p></article>", f"{LONG} more\ncafé"),
        ("", ""),
    ],
)
def test_main_text(body, text):
    assert html_extract.main_text(FRAME.format(body)) == text


def test_smoothing_and_threshold():
    values = np.array([1.0, 2, 1, 50, 60, 55, 2, 1])
    cut = html_extract.cluster_threshold(values)
    assert (values > cut).tolist() == [False] * 3 + [True] * 3 + [False] * 2
    assert html_extract.cluster_threshold(np.array([5.0, 5.0])) < 5
    lines = [html_extract.Line("x" * n, 1, 0, False, False) for n in (1, 1, 100, 1, 100, 1, 1)]
    smooth = html_extract.smoothed_ratios(lines)
    assert smooth[3] > 2 * smooth[0]  # a short line between long ones is carried by them


def test_extraction_odd_rows(spark):
    prepare(spark)
    deep = "<div>" * 2000 + LONG
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>x"), (None, "u", deep), (3, "u", "<p>x"), (4, "u", f"<article><p>{'é ' * 200_000}</p></article>")]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = html_extract.extract_main_text(pages).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got) == [("1", 0), ("2", 0), ("3", 1), ("3", 1), ("4", 399_999), ("None", len(LONG))]
    assert html_extract.extract_main_text(pages.limit(0)).count() == 0


def test_extraction_of_given_pages(spark):
    """The pages' articles, taken by a pattern that fits these pages."""
    import html

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in rows:
        article = re.search("(?s)<article>(.*)</article>", r.html)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", p)).split()) for p in re.split("</?p>|</?h1>|<br>", article)]
        assert html_extract.main_text(r.html) == "\n".join(p for p in parts if p)


URLS = [
    "http://www.Example.org/en/77", "https://example.org/en/1234", "https://EXAMPLE.org/es/x?y=/fr/", "http://shop.com/fr/", "http://shop.com/fr",
    "http://a.b.com/de/1#z", "http://notorg/", "http://org/", "http://x.org", "ftp://u@x.org:80/p?q#f", "no scheme/org/", "", None, "://", "http:///p",
    "http://x.net/a://b.org/c", "http://casino.net/fr/1?a=1&b=2", "http://Ünï.org/é\n/x",
]


def _plain_judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = host.translate({i: i + 32 for i in range(65, 91)})
    fits = [
        r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    rule = max(fits, key=lambda r: len(r.pattern), default=None)
    return host, path, rule and rule.pattern, rule and rule.verdict


def test_url_rules_equal_a_plain_version(spark):
    prepare(spark)
    rows = [(i, u, "html", 1, "x", 0.5) for i, u in enumerate(URLS * 2)] + [(None, "http://x.org/", None, 1, "", 0.0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int, rule string, entropy double")
    got = url_filter.judge_urls(pages, URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = _plain_judged(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or ("allow" if r.score >= 0.5 else "block"))
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, []).collect()} == {"allow"}
    assert urlsplit(URLS[0]).hostname == "www.example.org"


def test_url_features_equal_a_plain_version(spark):
    prepare(spark)
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    for r in url_filter.url_features(pages, len(URLS)).collect():
        url = r.url or ""
        n = len(url)
        assert r.entropy == pytest.approx(-sum(url.count(c) / n * math.log2(url.count(c) / n) for c in set(url)) if n else 0.0)
        assert r.digit_ratio == pytest.approx(sum(c in "0123456789" for c in url) / n if n else 0.0)
        assert r.path_depth == r.path.count("/") and r.parameters == len([p for p in url.split("#")[0].partition("?")[2].split("&") if p])
        assert all(r[f] is not None for f in url_filter.FEATURES)


def test_boosted_trees_learn_and_are_the_same_in_sql(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 9, size=(1500, len(url_filter.FEATURES))).astype(float)
    y = ((x[:, 0] > 4) & (x[:, 3] < 6) | (x[:, 7] == 2)).astype(float)
    model = url_filter.fit_boosted(x[:1000], y[:1000], np.ones(1000))
    assert ((model.margins(x[1000:]) > 0) == y[1000:]).mean() > 0.97
    half = url_filter.fit_boosted(x[:500], y[:500], np.full(500, 2.0)).margins(x[1000:])
    both = url_filter.fit_boosted(np.vstack([x[:500]] * 2), np.tile(y[:500], 2), np.ones(1000)).margins(x[1000:])
    assert ((half > 0) == (both > 0)).mean() > 0.98
    frame = spark.createDataFrame(x[1000:1100].tolist(), ", ".join(f"{f} double" for f in url_filter.FEATURES))
    assert np.allclose([r[0] for r in frame.select(model.margin()).collect()], model.margins(x[1000:1100]))


DOCS = "doc_id long, text string, n_tokens string, hash int, log_likelihood int"


def test_pseudo_likelihood(spark):
    """Ordered texts score above their shuffled words; sums are those of the network, token by token."""
    prepare(spark)
    rng = np.random.default_rng(2)
    names = "red blue green black white".split()
    sentence = lambda: f"the {rng.choice(names)} bird sings in the {rng.choice(names)} tree at noon ."
    texts = [" ".join(sentence() for _ in range(8)) for _ in range(400)]
    shuffled = [" ".join(rng.permutation(t.split())) for t in texts[:20]]
    rows = list(enumerate(texts)) + [(1000 + i, t) for i, t in enumerate(shuffled)]
    rows += [(5000, None), (5001, ""), (5002, "unseen zzz"), (None, texts[0]), (0, texts[0]), (5003, "the red bird " * 40_000)]
    docs = spark.createDataFrame([(*r, "", 0, 0) for r in rows], DOCS)
    got = lm_score.score_documents(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[5000].n_tokens == by[5001].n_tokens == 0 and by[5001].mean_log_likelihood is None and by[5000].log_likelihood == 0
    assert by[5003].n_tokens == 120_000 and by[None].log_likelihood == pytest.approx(by[0].log_likelihood)
    assert all(r.log_likelihood <= 0 for r in got)
    ordered, mixed = (np.mean([by[k + i].mean_log_likelihood for i in range(20)]) for k in (0, 1000))
    assert ordered > mixed + 1
    assert lm_score.score_documents(docs.limit(0)).count() == 0


def test_window_network_equals_a_loop():
    net = lm_score.WindowNet.fresh()
    vocabulary = lm_score.Vocabulary(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=int), np.ones(lm_score.TAIL), np.full(lm_score.TAIL, 3.0))
    around, target, owner = lm_score.contexts([b"a bc d", b"e"], vocabulary)
    assert owner.tolist() == [0, 0, 0, 1] and (around[3] == lm_score.EDGE).all()
    assert around[1].tolist() == [lm_score.EDGE, target[0], target[2], lm_score.EDGE]
    got = net.log_probabilities(around, target)
    for k in range(4):
        h = np.tanh(sum(net.places[j][around[k, j]] for j in range(4)))
        z = (h @ net.out + net.bias).astype(float)
        # the group among groups, then the class among those of its group
        zg, width = (h @ net.groups + net.group_bias).astype(float), lm_score.group_width(len(z))
        group = target[k] // width
        among = z[group * width : (group + 1) * width]
        want = zg[group] - np.log(np.exp(zg).sum()) + z[target[k]] - np.log(np.exp(among).sum())
        assert got[k] == pytest.approx(want, abs=1e-4)
    # the classes of any window share one probability of 1
    every = np.arange(lm_score.CLASSES)
    for k in range(4):
        assert np.exp(net.log_probabilities(np.repeat(around[k : k + 1], len(every), 0), every)).sum() == pytest.approx(1, abs=1e-4)
    assert vocabulary.within(target) == pytest.approx(np.full(4, -math.log(3)))


def test_a_step_follows_the_gradient():
    """One step over a batch against differences of the summed log-probability."""
    r = np.random.default_rng(4)
    classes = 11
    net = lm_score.WindowNet.fresh(3, classes)
    around, target = r.integers(0, classes + 1, (40, 4)), r.integers(0, classes, 40)
    flat = net.flat().astype(float)

    def loss(at: int, by: float) -> float:
        moved = flat.copy()
        moved[at] += by
        parts = np.split(moved, np.cumsum([int(np.prod(x)) for x in net.shapes(classes)])[:-1])
        wide = lm_score.WindowNet(*[x.reshape(shape) for x, shape in zip(parts, net.shapes(classes), strict=True)])
        return -wide.log_probabilities(around, target).mean()

    stepped = lm_score.WindowNet.of(flat, classes)
    stepped.learn(around, target, 0.1, batch=40)
    change = stepped.flat().astype(float) - flat
    for at in r.choice(len(flat), 150, replace=False):
        slope = (loss(at, 1e-4) - loss(at, -1e-4)) / 2e-4
        assert change[at] == pytest.approx(-0.1 * slope, abs=2e-5)


def test_token_counts_are_exact(spark, monkeypatch):
    prepare(spark)
    rows = [(i, f"word{i % 7} Word{i % 3} !! é", "", 0, 0) for i in range(300)] + [(None, None, "", 0, 0)]
    counts = lm_score.token_counts(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    assert sum(r.n for r in counts) == 1200 and sorted(r.n for r in counts)[-2:] == [300, 300] and len(counts) == 9


@pytest.mark.parametrize("shipped", [1 << 16, 0])
def test_tail_tokens_have_their_own_share(spark, monkeypatch, shipped):
    """Three tokens of one tail class in the same context: scores differ by the log of their counts."""
    prepare(spark)
    monkeypatch.setattr(lm_score, "SHIPPED", shipped)
    monkeypatch.setattr(lm_score, "head_size", lambda types: 3)
    rows = [(i, f"the {w} sings", "", 0, 0) for i, w in enumerate(["oftenab"] * 40 + ["seldomab"] * 4 + ["onceab"])]
    common = [(1000 + i, "the bird sings bird", "", 0, 0) for i in range(50)]
    got = {r.doc_id: r.log_likelihood for r in lm_score.score_documents(spark.createDataFrame(rows + common, DOCS)).collect()}
    assert got[0] - got[40] == pytest.approx(math.log(10), abs=1e-4) and got[40] - got[44] == pytest.approx(math.log(4), abs=1e-4)


def test_head_grows_with_the_corpus():
    assert lm_score.head_size(0) == lm_score.HEAD < lm_score.head_size(10**4) < lm_score.head_size(10**6) < lm_score.head_size(10**9)


@pytest.mark.parametrize(
    ("body", "text"),
    [
        (f"<div><div>{'<p>' + LONG:s}{('<p>' + LONG) * 20}</div><div><p>{LONG} last</div></div>", "\n".join([LONG] * 21 + [f"{LONG} last"])),
        (f"<div><div>{('<p>' + LONG) * 3}</div><div><p>In short.</div></div>", "\n".join([LONG] * 3 + ["In short."])),
        (f"<div><div>{('<p>' + LONG) * 3}</div><ul><li><a>One more</a><li><a>Two</a></ul></div>", "\n".join([LONG] * 3)),
        (f"<article>{('<p>' + LONG) * 20}</article><article><p>{LONG} too</article>", "\n".join([LONG] * 20 + [f"{LONG} too"])),
        (f"<div class='content with-comments'><article><p>{LONG}</article><div id=comments><p>{LONG} nice</div></div>", LONG),
        (f"<div id='social-sciences'><p>{LONG}</div>", LONG),
        (f"<div class='no-sidebar'><p>{LONG}</div>", LONG),
        (f"<div class='notice'><p>{LONG}</div>", LONG),
        (f"<main><p>{LONG}</main><div id=comments><article><p>{LONG} I say</article></div>", LONG),
    ],
)
def test_main_text_is_whole(body, text):
    assert html_extract.main_text(FRAME.format(body)) == text


WORDY = " ".join([LONG] * 4)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<html><head><title>t</title><body><article><p>{LONG}</article>", LONG),
        (f"<head><meta charset=x><title>t</title><style>p</style><p>{LONG}<p>{LONG}", f"{LONG}\n{LONG}"),
        (f"<head><title>t</title>{LONG}", LONG),
        (f"<head><noscript><img src=x><p>off</noscript><title>t</title></head><p>{LONG}", LONG),
        (f"<body><form><nav><a>Home</a></nav><div><p>{LONG}<p>{LONG}</div><footer>us</footer></form>", f"{LONG}\n{LONG}"),
        (f"<body><form><article><p>{LONG}</article><div class=comments><p>{WORDY}</div></form>", LONG),
        (f"<div><p>{LONG}<p>{LONG}</div><form><p>Subscribe to our letter here.</form>", f"{LONG}\n{LONG}"),
        (f"<article><p>{WORDY}<form><p>{LONG}</form><p>end</article>", f"{WORDY}\nend"),
        (f"<article>{('<p>' + WORDY) * 9}</article><article><h2>Two</h2><p>short one</article>", "\n".join([WORDY] * 9 + ["Two", "short one"])),
        (f"<article><p>short</article><article>{('<p>' + WORDY) * 9}</article>", "\n".join(["short"] + [WORDY] * 9)),
        (f"<main><p>{LONG}<section class='comments'><article><p>{WORDY}</article></section></main>", LONG),
        (f"<main><p>Brief.<section class='comments'>{('<article><p>' + WORDY + '</article>') * 5}</section></main>", "Brief."),
        (f"<div><p>{LONG}</div><div class='comments-area'>{('<p>' + WORDY) * 5}</div>", LONG),
        (f"<div class=sidebar><div class=rail><article><p>{LONG}</article><p>x</div></div>", LONG),
    ],
)
def test_main_text_of_ordinary_pages(html, text):
    assert html_extract.main_text(html) == text


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 50_000 + LONG,
        "<div class='sidebar x'>" * 50_000 + LONG,
        "<div class='side'>" * 25_000 + "<article class='promo'>" * 25_000 + LONG,
        "<p>" + "<span>" * 50_000 + "x<br>" * 50_000,
        "<div>" * 50_000 + "x</p>" * 50_000,
        "<a><div>" + "<span>" * 50_000 + "y</a>" * 50_000,
        "<form><article>" * 25_000 + f"<p>{LONG}",
    ],
)
def test_extraction_takes_linear_time(html):
    import time

    start = time.perf_counter()
    html_extract.main_text(html)
    assert time.perf_counter() - start < 2
