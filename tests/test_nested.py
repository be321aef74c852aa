"""Tables inside tables."""

from __future__ import annotations

import random
from html.parser import HTMLParser

from specloom.sources.nested import nested_cells


class Tree(HTMLParser):
    """Tables, rows and cells as nested lists, closed as the library does."""

    def __init__(self):
        super().__init__()
        self.root = ["root", {}, []]
        self.stack = [self.root]

    def close_to(self, kinds):
        while self.stack[-1][0] in kinds:
            self.stack.pop()

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.close_to(("td", "th", "tr"))
        if tag in ("td", "th"):
            self.close_to(("td", "th"))
        if tag in ("table", "tr", "td", "th"):
            node = [tag, dict(attrs), []]
            self.stack[-1][2].append(node)
            self.stack.append(node)

    def handle_endtag(self, tag):
        if tag == "table" and any(n[0] == "table" for n in self.stack):
            while self.stack.pop()[0] != "table":
                pass
        elif tag == "tr":
            self.close_to(("td", "th"))
            self.close_to(("tr",))
        elif tag in ("td", "th"):
            self.close_to(("td", "th"))

    def handle_data(self, data):
        self.stack[-1][2].append(data)


def every(node, tag):
    for child in node[2]:
        if not isinstance(child, str):
            if child[0] == tag:
                yield child
            yield from every(child, tag)


def text(node):
    return "".join(c if isinstance(c, str) else text(c) for c in node[2])


def loop(pages):
    out = []
    for page, html in pages:
        tree = Tree()
        tree.feed(html or "")
        tree.close()
        for t, table in enumerate(every(tree.root, "table")):
            for r, row in enumerate(every(table, "tr")):
                for c, cell in enumerate(every(row, "td")):
                    out.append((page, t, r, c, text(cell).strip(), int(cell[1].get("colspan", 1))))
    return sorted(map(str, out))


def got(spark, pages):
    return sorted(str(tuple(r)) for r in nested_cells(spark.createDataFrame(pages, "page_id int, html string")).collect())


def table(rnd, depth):
    rows = []
    for _ in range(rnd.randint(0, 3)):
        cells = []
        for _ in range(rnd.randint(0, 3)):
            inner = table(rnd, depth - 1) if depth and rnd.random() < 0.4 else rnd.choice(["", "x", "a b", "12"])
            cells.append(f"<td{rnd.choice(['', ' colspan=2', ' CLASS=q'])}> {inner}{rnd.choice(['', 'z'])}{rnd.choice(['</td>', '</TD >'])}")
        rows.append(f"<tr>{''.join(cells)}</tr>")
    return f"<TABLE border=1>{''.join(rows)}</table>"


def test_against_a_tree(spark):
    rnd = random.Random(5)
    pages = [(i, f"<p>{table(rnd, 3)}</p>between{table(rnd, 2)}") for i in range(40)]
    assert got(spark, pages) == loop(pages)


def test_open_stray_and_empty(spark):
    pages = [
        (1, "<table><tr><td>a<td>b<tr><td>c<table><tr><td>d</table><td>e</table>"),
        (2, "</table></table><table><tr><td>x</td></tr></table></table><table><tr><td>y</td></tr></table>"),
        (3, "<table><tr><th>h<td>v</td><tr><td><table><tr><td><table><tr><td>deep</table></table>"),
        (4, "no table"),
        (5, ""),
        (6, "<table></table>"),
    ]
    assert got(spark, pages) == loop(pages)
    assert got(spark, [(1, None)]) == []
