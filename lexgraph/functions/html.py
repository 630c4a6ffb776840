"""Per-page extraction used inside one Arrow UDF.

One pass over the tags of a page with a stack of open elements. It covers what decides the
wanted fields: implied ends (p, li, dt/dd, table cells, a), void and raw-text elements, ends that
close several elements, and links that go on in the next block when a block closes over
them. Elements misplaced inside tables are not moved, and ``</a>`` behind an unclosed block
ends the link there. Only the asked fields are gathered.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F


# Executors get the code of this module with the function; they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Selectors(NamedTuple):
    """Which elements hold the fields: (tag, class) or (tag, id) pairs, and a meta name."""

    tag: tuple[str, str] = ("span", "taglist")
    input: tuple[str, str] = ("input", "query")
    toc: tuple[str, str] = ("div", "lemmaWgt-lemmaCatalog")
    meta: str = "keywords"


# Element groups of HTML.
VOID = set("area base br col embed hr img input keygen link meta param source track wbr".split())
RAW_TEXT = set("script style iframe noembed noframes xmp textarea title".split())
HEAD_ONLY = set("html head meta title script style link base noscript template".split())
BLOCK = set(
    "html head body frameset script noscript style meta link title frame noframes section nav aside hgroup header "
    "footer p h1 h2 h3 h4 h5 h6 ul ol pre div blockquote hr address figure figcaption form fieldset ins del s dl dt "
    "dd li table caption thead tfoot tbody colgroup col tr th td video audio canvas details menu plaintext template "
    "article main svg math".split()
)
CLOSES_P = set(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dd dt".split()
)
SCOPE = set("applet button caption html marquee object table td template th".split())
CELLS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
LIST_STOP = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "td": ("table",), "th": ("table",), "tr": ("table",)}
PRESERVE = {"pre", "textarea", "plaintext", "title"}

# A value is quoted, bare, or missing before the closing bracket; %s is "(" with or without "?:".
ATTR = r"""%s[^\s/>][^\s/>=]*)(?>\s*=\s*(?>"%s[^"]*)"|'%s[^']*)'|%s[^\s>"'][^\s>]*)|(?=>)))?"""
MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?>[\s/]+|" + ATTR % (("(?:",) * 4) + r")*+)>"
    r"|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+>"
    r"|<[!?/][^>]*>"
    r"|(?P<cut><(?:[a-zA-Z!?]|/[a-zA-Z]).*\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
ATTRS = re.compile(ATTR % (("(",) * 4))
ATTR_REF = re.compile(r"&(?:#[xX]?[0-9a-fA-F]+;?|\w+;|\w+(?![\w=;]))")
SPACE = re.compile("[ \t\n\f\r\xa0]+")
EDGE = "".join(map(chr, range(0x21)))


def attributes(source: str) -> dict[str, str]:
    """Attribute names (lower-cased) and decoded values of a start tag."""
    found = {}
    for name, double, single, bare in ATTRS.findall(source):
        value = double or single or bare
        found[name.lower()] = ATTR_REF.sub(lambda m: html.unescape(m.group()), value) if "&" in value else value
    return found


class Capture:
    """Text of one open element: blanks collapsed, a blank before each inner block."""

    def __init__(self, kind: str, depth: int, attrs: dict[str, str], start: int = 0):
        self.kind, self.depth, self.attrs, self.start, self.end = kind, depth, attrs, start, start
        self.parts: list[str] = []
        self.in_toc = False
        self.open_end = False  # last character is a blank

    def add(self, text: str, exact: bool) -> None:
        if not exact:
            text = SPACE.sub(" ", text)
            if self.open_end and text[:1] == " ":
                text = text[1:]
        if text:
            self.parts.append(text)
            self.open_end = text[-1] in " \t\n\f\r"

    def gap(self) -> None:
        if self.parts and not self.open_end:
            self.add(" ", True)

    def text(self) -> str:
        return "".join(self.parts).strip(EDGE)


def scan_page(page: str, fields: frozenset[str], sel: Selectors) -> dict:
    """Fields of one page: links, tags, input, toc, meta, body_text, first_*."""
    stack: list[str] = []
    opened: Counter[str] = Counter()  # how often each name is on the stack
    done: list[Capture] = [Capture("body", 0, {})] if "body_text" in fields else []
    live: list[Capture] = list(done)
    torn: dict[str, str] | None = None  # attributes of a link cut off by the end of a block
    entered, metas, in_body = None, [], False
    want_links = bool(fields & {"links", "toc", "first_href", "first_text", "first_outer", "first_inner"})
    tag_class, toc_class = sel.tag[1].lower(), sel.toc[1].lower()
    toc_depths: list[int] = []

    def begin(kind: str, attrs: dict[str, str], at: int) -> None:
        capture = Capture(kind, len(stack), attrs, at)
        capture.in_toc = bool(toc_depths)
        done.append(capture)
        live.append(capture)

    def close_to(depth: int, at: int, by: str) -> None:
        nonlocal torn
        for capture in [c for c in live if c.kind != "body" and c.depth > depth]:
            live.remove(capture)
            capture.end = at
            if capture.kind == "a" and by != "a":
                torn = capture.attrs
        while toc_depths and toc_depths[-1] > depth:
            toc_depths.pop()
        if torn is not None and any(n in ("td", "th", "caption", "object") for n in stack[depth:]):
            torn = None
        opened.subtract(stack[depth:])
        del stack[depth:]

    def find(names: tuple[str, ...], stops) -> int:
        if not any(opened[n] for n in names):
            return -1
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] in names:
                return i
            if stack[i] in stops:
                return -1
        return -1

    def resume(at: int) -> None:
        nonlocal torn
        if torn is not None:
            attrs, torn = torn, None
            stack.append("a")
            opened["a"] += 1
            begin("a", attrs, at)

    pos, size = 0, len(page)
    while pos < size:
        m = MARKUP.match(page, pos)
        start, pos = pos, m.end()
        if (text := m["text"]) is not None:
            in_body = in_body or not text.isspace()
            if in_body and (live or torn is not None):
                resume(start)
                text = html.unescape(text) if "&" in text else text
                exact = bool(PRESERVE.intersection(stack[-2:]))
                for capture in live:
                    capture.add(text, exact)
        elif (name := m["name"]) is not None:
            name = name.lower()
            in_body = in_body or name not in HEAD_ONLY
            attrs = attributes(m["attrs"]) if name in ("a", "meta", sel.tag[0], sel.input[0], sel.toc[0]) else {}
            if name == "meta" and attrs.get("name", "").strip(EDGE).lower() == sel.meta:
                metas.append(attrs.get("content", "").strip(EDGE))
            if name in ("html", "head", "body"):
                continue
            if name in CELLS and (i := find(CELLS[name], LIST_STOP[name])) >= 0:
                close_to(i, start, name)
            if name in CLOSES_P and (i := find(("p",), SCOPE)) >= 0:
                close_to(i, start, name)
            if name == "a":
                torn = None
                if (i := find(("a",), SCOPE)) >= 0:
                    close_to(i, start, "a")
            elif name not in BLOCK:
                resume(start)
            if name in BLOCK or name == "br":
                for capture in live:
                    capture.gap()
            if name == sel.input[0] and entered is None and attrs.get("id") == sel.input[1]:
                entered = attrs.get("value", "")
            if name in RAW_TEXT:
                shut = re.compile(rf"</{name}(?=[\s/>])[^>]*>|\Z", re.I).search(page, pos)
                if name in ("textarea", "title") and in_body:
                    for capture in live:
                        capture.add(html.unescape(page[pos : shut.start()]), True)
                pos = shut.end()
            elif name not in VOID:
                stack.append(name)
                opened[name] += 1
                if name == "a" and want_links:
                    begin("a", attrs, pos)
                elif name == sel.tag[0] and "tags" in fields and tag_class in attrs.get("class", "").lower().split():
                    begin("tag", attrs, pos)
                if name == sel.toc[0] and toc_class in attrs.get("class", "").lower().split():
                    toc_depths.append(len(stack))
        elif (end := m["end"]) is not None:
            end = end.lower()
            if end in ("html", "head", "body"):
                continue
            i = find((end,), SCOPE if end in BLOCK else CLOSES_P | SCOPE)
            if end == "a":
                torn = None
                i = find((end,), SCOPE)
            if i >= 0:
                close_to(i, start, end)
            elif end in ("p", "br"):
                for capture in live:
                    capture.gap()
        elif m["cut"] is not None:
            break
    for capture in live:
        capture.end = size

    links = [c for c in done if c.kind == "a"]
    first = links[0] if links else None
    out = {
        "links": [{"href": c.attrs["href"], "text": c.text()} for c in links if "href" in c.attrs],
        "tags": [c.text() for c in done if c.kind == "tag"],
        "input": entered,
        "toc": [{"href": c.attrs.get("href", ""), "text": c.text()} for c in links if c.in_toc],
        "meta": metas,
        "body_text": done[0].text() if "body_text" in fields else "",
        "first_href": first.attrs.get("href", "") if first else "",
        "first_text": first.text() if first else "",
        "first_inner": page[first.start : first.end] if first else "",
    }
    if "first_outer" in fields:
        shown = "".join(f' {k}="{html.escape(v)}"' for k, v in first.attrs.items()) if first else ""
        out["first_outer"] = f"<a{shown}>{out['first_inner']}</a>" if first else ""
    return {f: out[f] for f in fields}


_LINKS = pa.list_(pa.struct([("href", pa.string()), ("text", pa.string())]))
FIELDS = {
    "links": (_LINKS, "array<struct<href:string,text:string>>"),
    "tags": (pa.list_(pa.string()), "array<string>"),
    "input": (pa.string(), "string"),
    "toc": (_LINKS, "array<struct<href:string,text:string>>"),
    "meta": (pa.list_(pa.string()), "array<string>"),
    "body_text": (pa.string(), "string"),
    "first_href": (pa.string(), "string"),
    "first_text": (pa.string(), "string"),
    "first_outer": (pa.string(), "string"),
    "first_inner": (pa.string(), "string"),
}


PAGES_AT_ONCE = 64

FAILURES = pa.list_(pa.struct([("field", pa.string()), ("reason", pa.string())]))


def parse_html(c: Column, fields: tuple[str, ...], selectors: Selectors = Selectors()) -> Column:
    """Struct of the asked raw fields of each page, and ``failures`` [field, reason].

    If a page cannot be read, its fields are read one by one: those that can be keep their values, the others
    are empty and have the name of the error as their reason. A page without the asked input box fails in that field as ``missing``.
    """
    wanted = frozenset(fields)
    arrow = pa.struct([*((f, FIELDS[f][0]) for f in fields), ("failures", FAILURES)])
    ddl = ", ".join([*(f"{f}: {FIELDS[f][1]}" for f in fields), "failures: array<struct<field:string,reason:string>>"])
    blank = {f: [] if pa.types.is_list(FIELDS[f][0]) else "" for f in fields}

    def one(page: str | None) -> dict:
        if not page:
            return blank | {"failures": []}
        failures = []
        try:
            found = scan_page(page, wanted, selectors)
        except Exception:  # whatever a broken page does to the scanner
            found = one_by_one(page, failures)
        if found.get("input", "") is None:
            found["input"] = ""
            failures.append({"field": "input", "reason": "missing"})
        return blank | found | {"failures": failures}

    def one_by_one(page: str, failures: list[dict]) -> dict:
        found = {}
        for field in fields:
            try:
                found |= scan_page(page, frozenset([field]), selectors)
            except Exception as error:  # only this field stays empty
                failures.append({"field": field, "reason": type(error).__name__})
        return found

    @F.arrow_udf(f"struct<{ddl}>")
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            # Few pages at a time are Python objects; what is found of them is kept as Arrow.
            parts = (pages.slice(at, PAGES_AT_ONCE).to_pylist() for at in range(0, len(pages), PAGES_AT_ONCE))
            yield pa.concat_arrays([pa.array([], type=arrow), *(pa.array(list(map(one, part)), type=arrow) for part in parts)])

    return parse(c)
