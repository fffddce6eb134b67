import random

from quarrystone.llm import html_extract as H
from quarrystone.llm import html_pages
from quarrystone.llm.boosting import boost

PAGE = (
    '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>Title here</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
    '<!-- ad 0 --><div class="ad">Buy now, cheap things for everyone.</div><article><h1>A title of the story.</h1><p><b>First  paragraph &amp; more.<br><p>Second one\nis &lt;longer&gt; and goes on, with words and words. It has two sentences.</p><p>Short.</p></article>'
    "<div class='comments'><h3>Comments</h3><div class=comment><p>I do not agree with this at all. It is wrong.</p></div></div><form><label>Name</label><input><button>Send</button></form><footer>&copy; site &middot; All rights reserved.</footer></body></html>"
)
WANT = "A title of the story.\nFirst paragraph & more.\nSecond one is <longer> and goes on, with words and words. It has two sentences.\nShort."


def test_a_page():
    assert H.main_text([PAGE], H.trained()) == [WANT]


def test_on_generated_pages_it_never_saw():
    found = wanted = both = 0
    for source, marker in html_pages.generate(150, 4321):
        want = [t.replace(marker, "") for t in H.Page(source).text if t is not None and marker in t]
        got = [t for t in H.main_text([source.replace(marker, "")], H.trained())[0].split("\n") if t]
        found, wanted, both = found + sum(map(len, got)), wanted + sum(map(len, want)), both + sum(map(len, set(got) & set(want)))
    assert both > 0.95 * found and both > 0.98 * wanted


def test_decoding_is_the_best_consistent_choice():
    rng = random.Random(1)
    for _ in range(200):
        page = H.Page("")
        for _ in range(rng.randint(1, 9)):
            page._add(rng.choice(["div", "#text"]), rng.randrange(len(page.tag)), 0, rng.choice([None, "x" * rng.randint(1, 50)]))
        odds = [rng.uniform(-3, 3) for _ in page.tag]
        keep = H.decode(page, odds)
        n = len(page.tag)
        import numpy as np

        gain = [0.0] + [(0.3 if page.text[k] is None else 1 + np.log1p(len(page.text[k]))) * odds[k] for k in range(1, n)]
        best = max(sum(gain[k] for k in range(n) if m >> k & 1) for m in range(1, 1 << n, 2) if all(not m >> k & 1 or m >> page.parent[k] & 1 for k in range(1, n)))
        assert all(not keep[k] or keep[page.parent[k]] for k in range(1, n)) and abs(sum(g for g, k in zip(gain, keep) if k) - best) < 1e-9


def test_odd_markup():
    blocks = lambda s: [t for t in H.Page(s).text if t is not None]
    assert blocks("a<p>b<p>c<div>d</div>e") == ["a", "b", "c", "d", "e"]
    assert blocks("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert blocks("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert blocks("x<script>a<p>b</script>y<style>z") == ["x y"]
    assert blocks("a<!-- <p>b --><p title='>'>c &eacute;&#233;&nbsp;d</p></p></div>1 < 2 <3") == ["a", "c éé d", "1 < 2 <3"]
    assert blocks("<p>a<b>b</p><p>c</b>d<br/>e") == ["ab", "cd e"]
    for s in ("<", "<p", "<p a='", "<!--", "</", "<><>", "<a href=\"x>y</p>z", "<script>", "&", "&#xFFFFFFF;", "<" * 5000, "<p>" * 5000, "</p>" * 100, "\x00<p\x00>"):
        blocks(s)


def test_pages(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (3, "u", ""), (None, "x", PAGE), (4, "v", "no tags at all, " * 20_000), (5, "w", "<article>" + "".join(f"<p>Paragraph {k} has a few words of text. And more.</p>" for k in range(3000)) + "</article>")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "page_id bigint, url string, html string, text int").repartition(2)
    got = {(r.page_id, r.url): r.text for r in H.extract(df).collect()}
    assert H.extract(df).count() == len(rows) and H.extract(df.limit(0)).count() == 0
    assert got[1, "u"] == got[None, "x"] == WANT and got[2, None] == got[3, "u"] == ""
    assert got[5, "w"].count("\n") == 2999 and got[5, "w"].endswith("Paragraph 2999 has a few words of text. And more.")
    assert all(r.n_chars == len(r.text) for r in H.extract(df).collect())


def test_trees_learn_an_interaction():
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boost(x[:2000], y[:2000], np.ones(2000), trees=30)
    assert ((model.decision(x[2000:]) > 0) == y[2000:]).mean() > 0.95


#: Hand-written pages of other kinds than the generator's: the article's blocks, and what is around them.
LAYOUTS = {
    "old table layout": (
        """<html><body bgcolor=white><table width=100%><tr><td colspan=2 class=header><a href=/>The Valley Courier</a></td></tr><tr><td valign=top class=menu><a href=/1>Front page</a><br><a href=/2>Weather</a><br><a href=/3>Letters</a><br><a href=/4>Archive</a></td>
        <td valign=top class=content><h2>Bridge over the river to close for repairs</h2><p>The old stone bridge will be closed from Monday until the end of June, the county said on Friday.<p>Traffic will be led over the new road, which adds about ten minutes to the way into town. Farmers have asked for an exception, and the county is looking into it.
        <p>The bridge was last repaired in 1962.</td></tr><tr><td colspan=2 class=footer>Copyright 1999 The Valley Courier. All rights reserved. <a href=/contact>Contact us</a></td></tr></table></body></html>""",
        ["Bridge over the river to close for repairs", "The old stone bridge will be closed from Monday until the end of June, the county said on Friday.", "Traffic will be led over the new road, which adds about ten minutes to the way into town. Farmers have asked for an exception, and the county is looking into it.", "The bridge was last repaired in 1962."],
    ),
    "blog with widgets": (
        """<!DOCTYPE html><html><head><title>x</title></head><body class="home blog"><div id="page" class="site"><header id="masthead" class="site-header"><h1 class="site-title"><a href="/">Notes from a kitchen</a></h1><nav class="main-navigation"><ul><li><a href="/about">About</a></li><li><a href="/recipes">Recipes</a></li></ul></nav></header>
        <div id="content" class="site-content"><main><article class="post hentry"><header class="entry-header"><h2 class="entry-title">How I learned to bake bread at home</h2></header><div class="entry-content"><p>It took me three winters to get a loaf that I was not ashamed of.</p><p>What changed was <em>time</em>: the dough now rests for a whole night, and I do not touch it until the morning.</p><ul><li>500 grams of flour, sifted twice</li><li>350 grams of water, not too cold</li></ul><blockquote><p>Bread is patience that you can eat.</p></blockquote></div></article></main>
        <aside class="widget-area sidebar"><section class="widget"><h3>Recent posts</h3><ul><li><a href="/a">Jam without sugar</a></li><li><a href="/b">On knives</a></li></ul></section></aside></div><div id="comments" class="comments-area"><h3>2 replies</h3><ol class="comment-list"><li class="comment"><p>I tried this and it worked very well for me. Thank you so much!</p></li></ol></div><footer class="site-footer"><p>Proudly made by hand. Imprint and privacy.</p></footer></div></body></html>""",
        ["How I learned to bake bread at home", "It took me three winters to get a loaf that I was not ashamed of.", "What changed was time: the dough now rests for a whole night, and I do not touch it until the morning.", "500 grams of flour, sifted twice", "350 grams of water, not too cold", "Bread is patience that you can eat."],
    ),
    "manual without classes": (
        """<html><body><nav><a href="#1">Install</a> <a href="#2">Use</a></nav><main><h1>Setting up the pump</h1><p>Put the pump on a flat floor and fill it with clean water up to the mark.</p><h2>First start</h2><p>Open the valve by a quarter turn. Then press the green button and wait until the light is steady.</p><pre>pump --start --slow</pre><p>If the light blinks, see the table of faults.</p></main><footer>Version 3, printed in May</footer></body></html>""",
        ["Setting up the pump", "Put the pump on a flat floor and fill it with clean water up to the mark.", "First start", "Open the valve by a quarter turn. Then press the green button and wait until the light is steady.", "pump --start --slow", "If the light blinks, see the table of faults."],
    ),
}


def test_hand_written_layouts():
    for name, (source, want) in LAYOUTS.items():
        assert H.main_text([source], H.trained())[0].split("\n") == want, name


def test_markup_takes_linear_time():
    import time

    def took(source):
        best = 9e9
        for _ in range(2):
            began = time.perf_counter()
            H.Page(source)
            best = min(best, time.perf_counter() - began)
        return best

    many = (lambda k: "<a " * k, lambda k: '<a "' * k, lambda k: '<a "> "' * k, lambda k: '<a x=">" ' * k, lambda k: "<div>" * k + "</p>" * k, lambda k: "<center>" * k, lambda k: "<title>" * k, lambda k: "<textarea>" * k, lambda k: "<ul><li>" * k)
    for make in many:
        # 16 times as long: 256 times the time if it were quadratic
        assert took(make(48_000)) < 60 * max(took(make(3_000)), 0.005)
