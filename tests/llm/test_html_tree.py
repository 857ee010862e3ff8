import html
import itertools
import math
import random
import re

import pytest

from tickloom.llm import html_tree as ht

PAGES = "/root/testdata/sf0.01/pages.parquet"


def plain_article(page):
    """Text of the article element of the generated pages, block by block."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = (html.unescape(re.sub(r"</?[bia]\b[^>]*>", "", b.replace("<br>", " "))) for b in re.split(r"</?(?:p|h1|ul|li)\b[^>]*>", body))
    return "\n".join(" ".join(b.split()) for b in blocks if b.split())


def test_generated_pages(spark):
    pages = spark.read.parquet(PAGES)
    model = ht.fit(spark, pages)
    got = {r.page_id: r.text for r in ht.main_text(pages, model, ["page_id"]).collect()}
    want = {r.page_id: plain_article(r.html) for r in pages.collect()}
    assert got == want
    # and where the article is not marked, with the same potentials
    for r in pages.collect()[:60]:
        assert ht.extract(r.html.replace("article>", "div>"), model) == want[r.page_id]


def brute_marginals(tree, model):
    """Sum over all assignments of states."""
    seen, poor = ht.observed(tree), ht.cut_off(tree)
    live = [i for i in range(len(seen)) if not poor[i]]
    total, content = 0.0, [0.0] * len(seen)
    for states in itertools.product((0, 1), repeat=len(live) - 1):
        state = dict(zip(live, (0, *states)))
        w = 1.0
        for i in live:
            if state[i]:
                w *= math.exp(sum(model.node.get(v, 0.0) for v in seen[i]))
            if i:
                w *= model.edge[state[tree.parent[i]]][state[i]]
        total += w
        for i in live:
            content[i] += w * state[i]
    return [c / total for c in content]


@pytest.mark.parametrize("seed", range(8))
def test_messages_give_exact_marginals(seed):
    rnd = random.Random(seed)
    tags = ["div", "p", "section", "ul", "li", "b", "a", "aside", "h2"]
    page = "".join(f"<{rnd.choice(tags)}>" + "word, " * rnd.randrange(30) + (f"</{rnd.choice(tags)}>" if rnd.random() < 0.5 else "") for _ in range(11))
    model = ht.Model(ht.counts(["<nav>x</nav><article><h1>t</h1><p>" + "some text, " * 30 + "</p></article><div>y</div>"]))
    tree = ht.Tree(page)
    for a, b in zip(model.marginals(tree), brute_marginals(tree, model)):
        assert abs(a - b) < 1e-6


def test_odd_markup(spark):
    model = ht.fit(spark, spark.read.parquet(PAGES))
    para = "Some longer text, with marks. " * 6
    cases = {
        "": "", "no markup, no element": "", "<article><p>a<b>b<p>c<!-- x": "ab\nc",
        "<article><script>var a = '<p>no</p>'</script><p>x &lt;y&gt; &amp;amp; &copy; &am &nbsp; z": "x <y> &amp; © &am z",
        "<main><h1>T</h1>one<br>two<table><tr><td>c1<td>c2</table></main>": "T\none two\nc1\nc2",
        "<article><p title='a>b' class=x>in</p><div class=\"ad\">buy</div><section id=comments><p>" + para + "</p></section><p>end</p></article>": "in\nend",
        "<article><p>see <a href='/x'>the <i>link</i></a>.</p><ul><li>one<li><a href=q>two</a></ul></article>": "see the link.\none\ntwo",
        "<body><div class='content'><p>" + para + "</p></div><div class=sidebar><p>" + para + "</p></div><div><a href=1>x</a> <a href=2>y</a></div>": para.strip(),
        "<article><style>p{}</style><form><p>name</p></form><p>a</b></i>b</p></article>": "ab",
        '<a "' * 2000: "", "<" * 5000: "", "<p" * 3000: "",
    }
    assert ht.extract("<div>" * 3000 + "deep" + "</div>" * 3000, model) in ("", "deep")     # no element speaks for or against it
    for page, want in cases.items():
        assert ht.extract(page, model) == want, page[:200]
    rows = [(i, None, p) for i, p in enumerate(cases)] + [(None, "u", None), (0, "u", ""), (0, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text")
    got = ht.main_text(df, ht.fit(spark, df), ["page_id", "url"]).collect()
    assert len(got) == len(rows) and [r.text for r in got if r.page_id is None] == [""]
    assert ht.main_text(df.limit(0), ht.fit(spark, df.limit(0)), ["page_id"]).collect() == []


def test_long_page():
    model = ht.Model({})
    page = "<body><article>" + "<p>word, " * 60000 + "</article>"
    assert ht.extract(page, model).count("\n") == 59999


def test_long_attribute_values():
    model = ht.Model({})
    para = "Some longer text, with marks. " * 6
    inner = "</p></article><p>no</p><div class='ad'>" * 2000
    for q, value in (('"', inner), ("'", inner.replace("'", '"'))):
        page = f"<body><article><p>one</p><p data-x={q}{value}{q} title = {q}a>b{q}>{para}</p><p>two</p></article></body>"
        assert ht.extract(page, model) == f"one\n{para.strip()}\ntwo"
    # a quote opens a value only after an equals sign; an open one ends at the first end mark
    assert ht.extract("<article><p title=O'Brien>it's</p><p title='x>end</p></article>", model) == "it's\nend"
    assert ht.Tree("<p title='class=ad' data-class=ad id=x>").names[1] == {"x"}
    for page in ("<a b=\"><a c='" * 30000 + ">", "<a b='\"><a c=\"'>" * 30000 + "<a b='>", "<a b=\"'><a c='\" " * 30000 + "=\">"):
        ht.Tree(page)


def test_class_words_do_not_cut_off_an_article(spark):
    para = "Some longer text, with marks. " * 6
    article = f"<article><h2 class='section-header'>Head</h2><p>{para}</p><p class=legal>Law.</p><p>x<math><mi>y</mi></math></p><div class=ad>buy</div></article>"
    want = f"Head\n{para.strip()}\nLaw.\nxy"
    for model in (ht.Model({}), ht.fit(spark, spark.read.parquet(PAGES))):
        for names in ("layout no-sidebar", "has-navbar", "with-header", "x"):
            page = f"<body><div class='{names}'><div id='menu-wrap'>{article}</div><div class=sidebar><p>{para}</p></div></div></body>"
            assert ht.extract(page, model) == want, names
    seen = ht.counts([f"<body><div class=no-sidebar>{article}</div></body>"])
    assert seen["word=poor", "0"] == 2 and seen["word=poor", "1"] == 2       # its potential is learnt, from the advert too


def log_weight(tree, model, forced, state):
    """Log of the sum over all assignments that give element ``forced`` the state ``state``."""
    total = [[0.0, sum(model.node.get(v, 0.0) for v in seen)] for seen in ht.observed(tree)]
    total[0][1] = total[forced][1 - state] = -math.inf
    for i in range(len(total) - 1, 0, -1):
        for up in (0, 1):
            a, b = (math.log(model.edge[up][s]) + total[i][s] for s in (0, 1))
            total[tree.parent[i]][up] += max(a, b) + math.log1p(math.exp(-abs(a - b)))
    return total[0][0]


def test_long_article_with_weak_blocks_at_its_start():
    model = ht.Model(ht.counts(["<body><nav>x</nav><article>" + "<p>some text, and more.</p>" * 30 + "</article><div>" + "<a href=x>y</a>" * 9 + "</div></body>"]))
    links = "<section>" + "<a href=x>some link text of a list</a> " * 6 + "</section>"
    para = "<p>" + "Some longer text, with marks, here. " * 9 + "</p>"
    tree = ht.Tree("<body><div>" + links * 60 + "<h2>Head</h2>" + para * 600 + "</div></body>")
    got = model.marginals(tree)
    for i in (1, 2, 3, tree.tag.index("h2"), len(got) - 1):      # body, the box of all blocks, a weak block, the heading, the last paragraph
        want = log_weight(tree, model, i, 1) - log_weight(tree, model, i, 0)
        assert abs(got[i] - 1 / (1 + math.exp(min(-want, 700)))) < 1e-6, (tree.tag[i], got[i], want)
    assert got[2] > 0.99


def test_learnt_not_cut(spark):
    """A tag or word of boilerplate around the whole article, or on a paragraph of it, does not lose it."""
    paras = ["Some longer text, with marks, number %d of them. " % i * 5 for i in range(6)]
    body = "<h1>Head</h1>" + "".join(f"<p>{p}</p>" for p in paras) + "<p class=legal>A short line of law, in the article.</p><p>The end.</p>"
    want = "\n".join(["Head", *[p.strip() for p in paras], "A short line of law, in the article.", "The end."])
    poor = f"<nav><a href=1>one</a> <a href=2>two</a></nav><div class=sidebar><p>{paras[0]}</p></div><form><label>Your name</label><input></form>"
    comments = "<section id=comments>" + "".join(f"<div class=comment><p>{p}</p></div>" for p in paras + paras) + "</section>"
    for model in (ht.Model({}), ht.fit(spark, spark.read.parquet(PAGES))):
        for page in (f"<body><form id=aspnetForm>{poor}<article>{body}</article></form></body>",
                     f"<body><form id=aspnetForm><div>{body}</div></form>{poor}</body>",
                     f"<body><div class='layout no-sidebar'><div>{body}</div></div>{poor}</body>",
                     f"<body><div class='layout no-sidebar'>{poor}<div>{body}</div></div><footer><p>{paras[1]}</p></footer></body>",
                     f"<body><div>{body}</div>{poor}{comments}</body>", f"<body><article>{body}{comments}</article>{poor}</body>"):
            assert ht.extract(page, model) == want, page[:60]


@pytest.mark.parametrize("seed", range(4))
def test_extract_against_brute_force(seed):
    """The text of the elements that are content in at least half of the weight of all assignments."""
    rnd = random.Random(seed)
    tags = ["div", "p", "ul class=sidebar", "li", "form", "aside", "h2", "p class=legal", "script", "section"]
    page = "".join(f"<{(t := rnd.choice(tags))}>" + "word, " * rnd.randrange(40) + (f"</{t.split()[0]}>" if rnd.random() < 0.7 or t == "script" else "") for _ in range(10))
    model = ht.Model(ht.counts(["<nav>x</nav><article><h1>t</h1><p>" + "some text, " * 30 + "</p><aside>z</aside></article><div>y</div>"]))
    tree = ht.Tree(page)
    share, blocks, now = brute_marginals(tree, model), [], []
    for i, text in [*tree.runs, (0, None)]:
        if text is None:
            blocks, now = blocks + [" ".join("".join(now).split())], []
        elif share[i] >= 0.5:
            now.append(text)
    assert ht.extract(page, model) == "\n".join(b for b in blocks if b)
