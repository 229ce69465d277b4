"""Sections against an independent tree built with the standard library's parser."""

import time
from html import unescape
from html.parser import HTMLParser

from conftest import DATA

from doseledger.sources.web_pages import html_sections

VOID = set("area base br col embed hr img input keygen link menuitem meta param source track wbr".split())


class Node:
    def __init__(self, name, parent):
        self.name, self.parent, self.children = name, parent, []

    def walk(self):
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def strings(self):
        for child in self.children:
            if isinstance(child, Node):
                if child.name not in ("script", "style"):
                    yield from child.strings()
            else:
                yield child

    def text(self):
        return " ".join(t for t in (unescape("".join(s)).strip() for s in self.strings()) if t)


class Tree(HTMLParser):
    def __init__(self, html):
        super().__init__(convert_charrefs=False)
        self.root = self.here = Node("", None)
        self.run = None
        self.feed(html)
        self.close()

    def data(self, text):
        if self.run is None:
            self.run = []
            self.here.children.append(self.run)
        self.run.append(text)

    handle_data = data

    def handle_entityref(self, name):
        self.data(f"&{name};")

    def handle_charref(self, name):
        self.data(f"&#{name};")

    def handle_comment(self, _):
        self.run = None

    def handle_decl(self, _):
        self.run = None

    def handle_starttag(self, tag, attrs):
        self.run = None
        node = Node(tag, self.here)
        self.here.children.append(node)
        if tag not in VOID:
            self.here = node

    def handle_startendtag(self, tag, attrs):
        self.run = None
        self.here.children.append(Node(tag, self.here))

    def handle_endtag(self, tag):
        self.run = None
        node = self.here
        while node is not None and node.name != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.here = node.parent


def expected_sections(html):
    root = Tree(html).root
    main = next((n for n in root.walk() if n.name == "main"), root)
    inside = list(main.walk())
    heads = [n for n in inside if n.name in ("h2", "h3")]
    if not heads:
        return [(
            0, "", " ".join(n.text() for n in inside if n.name == "p"),
            [n.text() for n in inside if n.name == "li"],
        )]
    out = []
    for pos, head in enumerate(heads):
        siblings = [c for c in head.parent.children if isinstance(c, Node)]
        texts, bullets = [], []
        for node in siblings[siblings.index(head) + 1:]:
            if node.name in ("h2", "h3"):
                break
            if node.name == "p":
                texts.append(node.text())
            elif node.name in ("ul", "ol"):
                bullets += [n.text() for n in node.walk() if n.name == "li"]
        out.append((pos, head.text(), " ".join(texts), bullets))
    return out


def got_sections(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string").selectExpr("i", "'u' AS url", "html")
    found = {}
    for r in html_sections(df).orderBy("i", "pos").collect():
        found.setdefault(r["i"], []).append((r["pos"], r["heading"], r["text"], r["bullets"]))
    return [found[i] for i in range(len(pages))]


CASES = [
    "<main><h2>One</h2><p>first <b>bold</b> words</p><ul><li>a</li><li>b</li></ul><h2>Two</h2></main><p>outside</p>",
    "<nav><li>menu</li></nav><p>no headings</p><ol><li>x</li></ol>",
    "<main><div><h3>In a box</h3><p>box text</p></div><p>not a sibling</p><h2>Next &amp; last</h2><p>t&eacute;xt&#33;</p></main>",
    "<p>open<p>nested<ul><li>one<li>two</ul>",
    "<main><h2>A</h2><script>var x = '</p><h2>no</h2>';</script><p>a<!-- c -->b<br>c</p></main>",
    "<main><h2>A</h2><p title='a > b'>x</p></p></div><p>y</p><ul><li>n<ul><li>deep</li></ul></li></ul></main>",
    "<main></main><h2>outside</h2><p>p</p>",
    "plain text",
    "",
]


def test_cases_match_the_tree(spark):
    assert got_sections(spark, CASES) == [expected_sections(c) for c in CASES]


def test_supplied_pages_match_the_tree(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    with_heads = [p.replace("<p>", "<h2>Head</h2><p>").replace("article>", "main>") for p in pages]
    for batch in (pages, with_heads):
        for got, html in zip(got_sections(spark, batch), batch):
            assert got == expected_sections(html)


def test_no_section_is_lost_and_other_columns_stay(spark):
    df = spark.createDataFrame([(7, "http://x/who-can-take-it/", "<p>t</p>")], "page_id int, url string, html string")
    row = html_sections(df).first().asDict()
    assert (row["page_id"], row["page_type"], row["text"]) == (7, "contraindications", "t")


def test_entities_are_decoded_as_browsers_do(spark):
    from pyspark.sql import functions as F

    from doseledger.sources.web_pages import _plain

    text = "Don&apos;t &lsqb;x&rsqb; &#146; &#x41; &nosuch; a & b"
    got = spark.createDataFrame([(text,)], "t string").select(_plain(F.col("t"))).first()[0]
    assert got == "Don't [x] ’ A &nosuch; a & b"


def test_work_grows_with_the_headings(spark):
    """Several hundred headings in one page take seconds, not minutes."""
    page = "<main>" + "".join(f"<h2>H{i}</h2><p>text {i}</p><ul><li>item {i}</li></ul>" for i in range(400)) + "</main>"
    df = spark.createDataFrame([("u", page)], "url string, html string")
    start = time.perf_counter()
    rows = html_sections(df).collect()
    assert [tuple(r[c] for c in ("heading", "text", "bullets")) for r in rows][:2] == [("H0", "text 0", ["item 0"]), ("H1", "text 1", ["item 1"])]
    assert len(rows) == 400 and time.perf_counter() - start < 60
