import random

from opinio.operators import nodes as nd

P = "page_id long, html string"

# A page like a review site's: the second card lacks the rating, the third the text and one counter.
CARDS = """<body><div aria-label="4.5 star"></div>
<div class="x review"><a href="/user_details?userid=U1">Ann</a><span><div aria-label="5 star rating"></div></span>
  <span class="n">Useful 2</span><span class="n">Funny</span><span class="n">Cool 7</span><span lang="en">Good &amp; fresh<br>food</span></div>
<div class="review y"><a href="/user_details?userid=U2">Bob</a><span class="n">Useful</span><span class="n">Funny 1</span>
  <span class="n">Cool</span><span lang="en">Bad</span><div class="quote"><p>inner</div></div>
<div class="review"><a href="/user_details?userid=U3">Cy</a><span><div aria-label="1 star rating"></div></span><span class="n">Useful 3</span></div>
<div class="reviews">none</div></body>"""

FIELDS = {
    "reviewer_id": nd.Field(nd.Selector("a", attrs={"href": r"/user_details\?userid="}), "href", pattern="userid=(.*)$"),
    "rating": nd.Field(nd.Selector("div", attrs={"aria-label": "rating"}), "aria-label", pattern=r"^(\S+)"),
    "useful": nd.Field(nd.Selector("span", ("n",)), pattern=r"([0-9]+)$"),
    "cool": nd.Field(nd.Selector("span", ("n",)), nth=2, pattern=r"([0-9]+)$"),
    "content": nd.Field(nd.Selector("span", attrs={"lang": "^en$"})),
}


def test_missing_fields_are_null_in_their_own_card(spark):
    df = spark.createDataFrame([(1, CARDS), (2, None), (3, "<p>no card"), (4, CARDS)], P)
    rows = nd.card_fields(df, nd.Selector("div", ("review",)), FIELDS).orderBy("page_id", "slot").collect()
    want = [(0, "U1", "5", "2", "7", "Good & freshfood"), (1, "U2", None, None, None, "Bad"), (2, "U3", "1", "3", None, None)]
    assert [tuple(r) for r in rows] == [(p, *w) for p in (1, 4) for w in want]


def tree(rnd, depth=0):
    """A random element: (tag, id, children and texts)."""
    kids = [] if depth > 5 else [rnd.choice([tree, lambda r, d: f"t{r.randrange(99)} "])(rnd, depth + 1)
                                 for _ in range(rnd.randrange(5))]
    return rnd.choice(["div", "span", "section", "b"]), str(rnd.randrange(1000)), kids


def render(node):
    if isinstance(node, str):
        return node
    return f"<{node[0]} id={node[1]}>{''.join(map(render, node[2]))}</{node[0]}>"


def text(node):
    return node if isinstance(node, str) else "".join(map(text, node[2]))


def brute(root, card, fld, nth):
    """Per card in document order: id, text and id of its nth field element, by recursion."""
    cards = []

    def walk(node, current):
        if isinstance(node, str):
            return
        if node[0] == card:
            cards.append((node[1], current := []))
        if node[0] == fld and current is not None:
            current.append((" ".join(text(node).split()), node[1]))
        for k in node[2]:
            walk(k, current)

    walk(root, None)
    return [(i, *(found[nth] if len(found) > nth else (None, None))) for i, found in cards]


def test_nested_cards_match_recursion(spark):
    rnd = random.Random(12)
    trees = [("section", "0", [tree(rnd) for _ in range(6)]) for _ in range(40)]
    df = spark.createDataFrame([(i, render(t)) for i, t in enumerate(trees)], P).repartition(3)
    for card, fld, nth in (("div", "span", 0), ("div", "b", 1), ("section", "div", 2), ("div", "div", 0)):
        sel = nd.Selector(fld)
        got = nd.card_fields(df, nd.Selector(card), {"id": nd.Field(nd.Selector(card), "id"), "t": nd.Field(sel, nth=nth),
                                                     "i": nd.Field(sel, "id", nth)}).orderBy("page_id", "slot").collect()
        want = [(p, s, *row) for p, t in enumerate(trees) for s, row in enumerate(brute(t, card, fld, nth))]
        assert [tuple(r) for r in got] == want


def test_intervals_hold_what_they_contain(spark):
    df = spark.createDataFrame([(7, "<div><p>a<p>b<br>c</div><ul><li>x<ul><li>y</ul><li>z</ul><script>'<p>'</script>")], P)
    nodes = nd.page_nodes(df, {t: nd.Selector(t) for t in ("div", "p", "br", "ul", "li", "script")}).collect()
    by = {}
    for n in nodes:
        by.setdefault(n.name, []).append(n)
    assert [n.text for n in by["p"]] == ["a", "bc"] and [n.text for n in by["li"]] == ["xy", "y", "z"]
    inside = lambda a, b: b.start < a.start and a.end < b.end
    assert all(inside(p, by["div"][0]) for p in by["p"]) and inside(by["br"][0], by["p"][1])
    assert inside(by["li"][1], by["li"][0]) and not inside(by["li"][2], by["li"][0])
    assert by["script"][0].text == "" and all(inside(n, by[nd.PAGE][0]) for n in nodes if n.name != nd.PAGE)
    assert sorted(n.depth for n in by["li"]) == [1, 1, 3]


def test_page_fields_and_elements(spark):
    df = spark.createDataFrame([(1, '<html lang="en"><a href="/x">X</a><A HREF="/y" href="/z">Y</A>'), (2, None), (2, None)], P)
    fields = {"lang": nd.Field(nd.Selector("html"), "lang"), "second": nd.Field(nd.Selector("a"), "href", nth=1)}
    got = sorted(tuple(r) for r in nd.page_fields(df, fields).collect())
    assert got == [(1, "en", "/y"), (2, None, None), (2, None, None)]
    links = nd.page_elements(df, nd.Selector("a")).orderBy("slot").collect()
    assert [(r.slot, r.attrs["href"], r.text) for r in links] == [(0, "/x", "X"), (1, "/y", "Y")]
    assert nd.card_fields(df.limit(0), nd.Selector("a"), fields).count() == 0


def test_plan_pairs_no_nodes(spark):
    df = spark.createDataFrame([(1, CARDS)], P)
    plan = nd.card_fields(df, nd.Selector("div"), FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_a_large_page(spark):
    html = "<div class=c><b>x</b></div>" * 30_000 + "<i>" * 20_000
    rows = nd.card_fields(spark.createDataFrame([(1, html)], P), nd.Selector("div", ("c",)), {"b": nd.Field(nd.Selector("b"))})
    assert rows.where("b = 'x'").count() == 30_000


def test_a_batch_is_handed_on_in_pieces(spark, monkeypatch):
    from opinio.operators import nodes

    pages = spark.createDataFrame([(i, f"<p>a{i} <b>b{i}</b></p><p>c{i}</p>") for i in range(200)] + [(200, None)],
                                  "page_id bigint, html string").coalesce(1)
    fields = {"bold": nodes.Field(nodes.Selector("b"))}
    want = sorted(map(tuple, nodes.card_fields(pages, nodes.Selector("p"), fields).collect()))
    monkeypatch.setattr(nodes, "PIECE_NODES", 7)
    assert sorted(map(tuple, nodes.card_fields(pages, nodes.Selector("p"), fields).collect())) == want
    assert want[:2] == [(0, 0, "b0"), (0, 1, None)] and len(want) == 400
