import random

import numpy as np

from sameitem.llm import html_extraction as H
from sameitem.llm.labelled_pages import labelled_pages


def text(html):
    return H.extract_texts(H.trained(), [html])[0]


def test_unseen_labelled_pages():
    pages = labelled_pages(150, seed=77)
    out = H.extract_texts(H.trained(), [h.replace(' data-y="1"', "").replace(' data-y="0"', "") for h, _ in pages])
    assert sum(a == b for (_, a), b in zip(pages, out)) >= 145


def test_blocks_references_and_inline_elements():
    page = ('<html><head><title>No</title><style>p{}</style></head><body><nav><ul><li><a href=/>Home</a><li><a href=/b>Blog</a></ul></nav>'
            '<article><h1>A &amp; B&#33;</h1><p>One<b>two</b> <i>three</i>\n four<br>five. &eacute; &lt;b&gt;<p>Second  paragraph, unclosed.'
            '<script>var x="<p>no</p>"</script><!-- <p>no</p> --><div class="ad">Buy this now.</div><p class=x>Third.</p></article>'
            '<div class="comments"><h3>Comments</h3><div class="comment"><p>First! I like this very much.</p></div></div>'
            '<form><label>Name</label><input><button>Send</button></form><footer>&copy; 2020 Us</footer></body></html>')
    assert text(page) == "A & B!\nOnetwo three four five. é <b>\nSecond paragraph, unclosed.\nThird."


def test_long_lists_of_names():
    many = "".join(f" w{chr(97 + k)}-{chr(97 + k)}x" for k in range(20))
    for own, word in (('id="comments"', "comments"), ('role="complementary"', "complementary")):
        tree = H.parse(f'<div class="{many}" {own}><p>Words.</p></div>')
        assert word in tree.names[1] and {"wa", "tx"} <= set(tree.names[1])
    page = (f'<body><article><h1>Title here</h1><p>One paragraph of the article.</p><p>And a second one.</p></article>'
            f'<div class="{many}" id="comments"><h3>Comments</h3><div class="{many} comment"><p>First! I like this very much.</p></div></div></body>')
    assert text(page) == "Title here\nOne paragraph of the article.\nAnd a second one."


def test_formulas_are_text():
    page = ('<article><h1>Sums</h1><p>We know <math><semantics><mrow><mi>x</mi><mo>=</mo><msup><mi>y</mi><mn>2</mn></msup></mrow>'
            '<annotation encoding="application/x-tex">x=y^2</annotation></semantics></math> from the start of this.</p>'
            '<p>And <math><mtable><mtr><mtd><mn>1</mn></mtd><mtd><mn>2</mn></mtd></mtr></mtable></math> too, in the end.</p></article>')
    assert text(page) == "Sums\nWe know x=y2 from the start of this.\nAnd 1 2 too, in the end."


def test_odd_pages():
    runs = [[t for t in H.parse(h).text if t] for h in ("", "   ", "<", "<p", "<!--", "</div></p>", "<script>x", "a < b", "x <p y")]
    assert runs == [[], [], ["<"], ["<p"], [], [], [], ["a < b"], ["x <p y"]]
    assert H.extract_texts(H.trained(), [None, "", " "]) == ["", "", ""]
    long_ = "<article>" + "<p>Some words of a paragraph here.</p>" * 5000 + "</article>"
    assert text(long_).count("\n") == 4999
    assert isinstance(text("<div>" * 3000 + "deep words in here" + "</div>" * 3000), str)


def test_marginals_against_enumeration():
    rng = np.random.default_rng(3)
    tree = H.parse("<div class=a><p>x y</p><ul><li>z</li></ul>w</div>")
    forest = H.Forest.of([tree])
    model = H.TreeModel()
    model.weight = rng.normal(size=H.FEATURES)
    model.edge = rng.normal(size=model.edge.shape)
    n = len(tree.tag)
    total, one = 0.0, np.zeros(n)
    feats = H.features(tree)
    for mask in range(1 << n):
        y = [(mask >> i) & 1 for i in range(n)]
        s = sum(model.weight[f].sum() for f, v in zip(feats, y) if v)
        s += sum(model.edge[forest.kind[i], forest.kind[tree.parent[i]], y[tree.parent[i]], y[i]] for i in range(1, n))
        total += np.exp(s)
        one += np.exp(s) * np.array(y)
    p, joint = model.marginals(forest)
    assert np.allclose(p, one / total) and np.allclose(joint[1:].sum(axis=(1, 2)), 1)
    assert np.allclose(joint[1:, :, 1].sum(axis=1), p[1:])


def test_pages_in_one_batch_do_not_touch(spark):
    pages = labelled_pages(30, seed=5)
    html = [h for h, _ in pages]
    assert H.extract_texts(H.trained(), html) == [text(h) for h in html]
    rows = [(i, f"u{i}", h) for i, h in enumerate(html)] + [(None, None, None), (7, "u7", html[7])]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    from pyspark.sql import functions as F
    out = H.main_text(spark, df.withColumn("text", F.lit("clash")), ["page_id", "url"]).collect()
    want = sorted((str(i), H.extract_texts(H.trained(), [h])[0]) for i, _, h in rows)
    assert sorted((str(r.page_id), r.text) for r in out) == want and all(r.n_chars == len(r.text) for r in out)
    assert H.main_text(spark, df.limit(0), ["page_id"]).collect() == []


def test_quotes_and_comments_hide_no_text():
    def runs(html):
        return [t for t in H.parse(html).text if t]

    assert runs("<p title=Bob's>Hello it's me and more.</p>") == ["Hello it's me and more."]
    assert runs("<p it's>One</p><p title = \"a > b\">Two</p><p title='>'>Three</p>") == ["One", "Two", "Three"]
    assert runs("<!--><p>shown</p><!-- x --><!---><p>too</p><!-- y --!><p>end</p>") == ["shown", "too", "end"]
    assert runs('<p>a</p><p title="never closed>b</p>') == ["a", "b"]
    assert runs('<p>a</p><div x=">" <p>b</p>') == ["a", "b"]
    assert runs('<p>a</p><div x="></div> c d"') == ["a", '<div x="> c d"']
    assert H.parse('<p data-y="many">x</p>').label[1] == -1


def test_time_is_linear_in_the_page():
    import time
    for page in ('<p title="x>text</p>', "<a b='c\"", "<a x=\">\" ", "<textarea>", "<!--", "<p ", "it's <p title=Bob's>so</p>", "<head>"):
        start = time.perf_counter()
        H.parse(page * 40_000)
        assert time.perf_counter() - start < 8, page
