"""Small per-row helper: parse one HTML page with the standard-library parser
and evaluate the CSS selector subset the extraction jobs use (tag, .class,
#id, [a], [a='v'], [a^='v'], [a*='v'], [a$='v'], descendant and child
combinators, comma lists).

It is called from ``mapInPandas`` tasks, one parse per page per pass; Spark
partitions and shuffles the pages.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "param", "source", "track", "wbr"}

SOURCE = {"script", "style", "template"}


class Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag, attrs, parent):
        self.tag = tag
        self.attrs = attrs
        self.parent = parent
        self.children = []   # Node or str

    def classes(self):
        return (self.attrs.get("class") or "").split()

    def text(self) -> str:
        """Every descendant text node stripped, empties dropped, joined without separator;
        script, style and template sources are no text (unless asked for themselves)."""
        out = []
        stack = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                s = n.strip()
                if s:
                    out.append(s)
            elif n is self or n.tag not in SOURCE:
                stack.extend(reversed(n.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]", {}, None)
        self.cur = self.root
        self.order = []

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        self.order.append(node)
        if tag not in VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        self.order.append(node)

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def parse(html: str) -> _Builder:
    b = _Builder()
    try:
        b.feed(html or "")
        b.close()
    except Exception:   # malformed markup: keep what was parsed
        pass
    return b


_TOKEN = re.compile(r"""\s*(>)\s*|(\s+)|([^\s>]+)""")
_SIMPLE = re.compile(
    r"""(?P<tag>[a-zA-Z][\w-]*|\*)|\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)|"""
    r"""\[(?P<attr>[\w-]+)(?:(?P<op>[\^\*\$]?=)(?:'(?P<v1>[^']*)'|"(?P<v2>[^"]*)"|(?P<v3>[^\]]*)))?\]""")


def _compile_compound(text: str):
    tests = []
    pos = 0
    while pos < len(text):
        m = _SIMPLE.match(text, pos)
        if not m or m.end() == pos:
            raise ValueError(f"unsupported selector: {text!r}")
        pos = m.end()
        if m.group("tag") and m.group("tag") != "*":
            t = m.group("tag").lower()
            tests.append(lambda n, t=t: n.tag == t)
        elif m.group("cls"):
            c = m.group("cls")
            tests.append(lambda n, c=c: c in n.classes())
        elif m.group("id"):
            i = m.group("id")
            tests.append(lambda n, i=i: n.attrs.get("id") == i)
        elif m.group("attr"):
            a, op = m.group("attr").lower(), m.group("op")
            v = next((x for x in (m.group("v1"), m.group("v2"), m.group("v3")) if x is not None), None)
            if op is None:
                tests.append(lambda n, a=a: a in n.attrs)
            elif op == "=":
                tests.append(lambda n, a=a, v=v: n.attrs.get(a) == v)
            elif op == "^=":
                tests.append(lambda n, a=a, v=v: v != "" and (n.attrs.get(a) or "").startswith(v))
            elif op == "*=":
                tests.append(lambda n, a=a, v=v: v != "" and v in (n.attrs.get(a) or ""))
            elif op == "$=":
                tests.append(lambda n, a=a, v=v: v != "" and (n.attrs.get(a) or "").endswith(v))
    return lambda n: all(t(n) for t in tests)


def compile_selector(selector: str):
    """-> list of alternatives; each is [(combinator, test), ...] right-to-left."""
    alts = []
    for part in selector.split(","):
        steps, comb = [], " "
        for m in _TOKEN.finditer(part.strip()):
            if m.group(1):
                comb = ">"
            elif m.group(2):
                if comb != ">":
                    comb = " "
            else:
                steps.append((comb, _compile_compound(m.group(3))))
                comb = " "
        if steps:
            alts.append(steps)
    return alts


def _matches(node: Node, steps) -> bool:
    if not steps[-1][1](node):
        return False
    return _match_up(node, steps, len(steps) - 1)


def _match_up(node: Node, steps, i: int) -> bool:
    if i == 0:
        return True
    comb = steps[i][0]
    prev_test = steps[i - 1][1]
    p = node.parent
    if comb == ">":
        return p is not None and p.tag != "[document]" and prev_test(p) and _match_up(p, steps, i - 1)
    while p is not None and p.tag != "[document]":
        if prev_test(p) and _match_up(p, steps, i - 1):
            return True
        p = p.parent
    return False


def select(doc: _Builder, selector: str) -> list[Node]:
    if not selector:
        return []
    alts = compile_selector(selector)
    return [n for n in doc.order if any(_matches(n, s) for s in alts)]


def select_one(doc: _Builder, selector: str):
    if not selector:
        return None
    alts = compile_selector(selector)
    for n in doc.order:
        if any(_matches(n, s) for s in alts):
            return n
    return None


def first_text(doc, selector: str) -> str:
    """H3: text of the first match, '' if none or empty selector."""
    n = select_one(doc, selector)
    return n.text() if n is not None else ""


def first_attr(doc, selector: str, attr: str) -> str:
    """H4: attribute of the first match, '' if none."""
    n = select_one(doc, selector)
    return (n.attrs.get(attr, "") or "") if n is not None else ""


def all_text(doc, selector: str) -> list[str]:
    """H5: text of every match (blank items kept)."""
    return [n.text() for n in select(doc, selector)]
