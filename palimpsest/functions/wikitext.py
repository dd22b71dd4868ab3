"""Wiki text to plain sections: pure Python, no Spark.

`parse` gives the top-level nodes of a markup in one pass over its tokens; `sections` cleans them and renders each
section's text. A markup whose headings the parse and a plain line pattern count differently is broken, and one with two
sections of one path is ambiguous: both raise a MarkupError with a short code, unless `lenient`.
"""

import html
import re
from dataclasses import dataclass, field

from palimpsest.functions import rules as R

LEAD = "default__wiki__article__introduction__heading"
PATH_GAP = " // "
_PAIRED = re.compile(r"<!--.*?-->|<(nowiki|math|pre)\b[^<>]*(?<!/)>.*?</\1\s*>|\{\{|\}\}|\[\[|\]\]", re.S | re.I)
_START = re.compile(
    r"<!--.*?(?:-->|\Z)|\{\{|\[\[|\[(?=(?:https?:)?//|mailto:)|</?[a-zA-Z][a-zA-Z0-9]*|&(?:#\d+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"
    r"|'{2,}|^=[^\n]*=[ \t]*$|^[*#:;]+|^----+|^:*\{\|",
    re.S | re.M,
)
_LINE_COMMENT = re.compile(r"^<!--.*?-->\s*[\r\n]?", re.S | re.M)
_HEADING_LINE = re.compile(r"^=.*=(?:<!--.*?-->)?\s*$", re.M)
_LEFT_OVER_REF = re.compile(r"<ref(?:[> ].*?)(?:</ref>|/>)", re.S)
#: Tags whose content is no markup, tags that never have any, and tags that render as nothing.
OPAQUE = {"ref", "math", "nowiki", "pre", "gallery", "score", "syntaxhighlight", "source", "timeline", "imagemap", "chem", "ce"}
VOID = {"br", "hr", "wbr", "img", "references"}
UNSEEN = {"gallery", "imagemap", "math", "ref", "references", "score", "timeline", "img", "section", "templatedata", "chem", "ce"}
DROPPED_LINKS = ("file:", "category:", "image:")


class MarkupError(ValueError):
    """broken (headings do not add up) or duplicate (two sections of one path)."""


@dataclass
class Node:
    """kind: text, template, link, url, tag, heading, entity or comment. body: what a link or tag shows, a heading's title."""

    kind: str
    source: str
    name: str = ""
    body: str = ""
    level: int = 0
    plain: bool = True  # a template without parameters
    inner: list["Node"] = field(default_factory=list)


class _Reader:
    def __init__(self, s: str):
        self.s, self.pair = s, {}
        stack: list[tuple[str, int]] = []
        for m in _PAIRED.finditer(s):
            t = m.group()
            if t in ("{{", "[["):
                stack.append((t, m.start()))
            elif t in ("}}", "]]"):
                want = "{{" if t == "}}" else "[["
                at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == want), None)
                if at is not None:
                    self.pair[stack[at][1]] = m.end()
                    del stack[at:]

    def template(self, i: int) -> Node | None:
        end = self.pair.get(i)
        if end is None:
            return None
        body = self.s[i + 2 : end - 2]
        cut = re.search(r"\||<!--", body)
        name = body[: cut.start()] if cut else body
        if not name.strip() or re.search(r"[{}\[\]]|\S\s*\n\s*\S", name):
            return None
        return Node("template", self.s[i:end], name.strip().lower(), plain="|" not in body)

    def link(self, i: int) -> Node | None:
        end = self.pair.get(i)
        if end is None:
            return None
        title, bar, label = self.s[i + 2 : end - 2].partition("|")
        if not title.strip() or "\n" in title.strip() or "[" in title:
            return None
        return Node("link", self.s[i:end], title.lower().strip(), label if bar else title)

    def url(self, i: int) -> Node | None:
        m = re.compile(r"\[([^\s\]]+)(?:[ \t]+([^\]\n]*(?:\[\[[^\]\n]*\]\][^\]\n]*)*))?\]").match(self.s, i)
        return Node("url", m.group(), m[1], m[2] or "") if m else None

    def tag(self, i: int) -> Node | None:
        m = re.compile(r"<([a-zA-Z][a-zA-Z0-9]*)((?:\"[^\"]*\"|'[^'\n]*'|[^<>\"'])*?|[^<>]*?)(/?)>", re.S).match(self.s, i)
        if not m:
            return None
        name = m[1].lower()
        if m[3] or name in VOID:
            return Node("tag", m.group(), name)
        if name in OPAQUE:
            close = re.compile(rf"</{name}\s*>", re.I).search(self.s, m.end())
            return Node("tag", self.s[i : close.end()], name, self.s[m.end() : close.start()]) if close else None
        depth = 1
        for t in re.compile(rf"<(/?){name}\b[^<>]*?(/?)>", re.I).finditer(self.s, m.end()):
            depth += 0 if t[2] else -1 if t[1] else 1
            if not depth:
                return Node("tag", self.s[i : t.end()], name, self.s[m.end() : t.start()])
        return Node("tag", m.group(), name) if name in ("li", "dd", "dt", "td", "tr", "th", "p") else None

    def quotes(self, i: int, marks: str, end: int) -> Node | None:
        """Italics and bold, closed on their line by as many marks."""
        n = {2: 2, 3: 3, 4: 3}.get(len(marks), 5)
        line_end = self.s.find("\n", i, end)
        line_end = end if line_end < 0 else line_end
        lead = len(marks) - n
        at = i + lead + n
        for m in re.compile("'{2,}").finditer(self.s, at, line_end):
            k = len(m.group())
            if k in (n, 5) if n != 5 else k >= 5:
                close = m.start()
                if n != 5 and k == 5:
                    close = m.start() + 5 - n
                return Node("tag", self.s[i : close + n], "b" if n == 3 else "i", self.s[at:close])
        return None

    def table(self, i: int) -> Node | None:
        depth = 0
        for m in re.compile(r"^[ \t:]*(\{\|)|^[ \t]*(\|\})(?!\})", re.M).finditer(self.s, i):
            depth += 1 if m[1] else -1
            if not depth:
                return Node("tag", self.s[i : m.end()], "table")
        return None


def parse(markup: str) -> list[Node]:
    """Top-level nodes, in order; their sources joined give the markup."""
    r, out, text_from, at = _Reader(markup), [], 0, 0
    while True:
        m = _START.search(markup, at)
        if not m:
            break
        i, t, node = m.start(), m.group(), None
        if t.startswith("<!--"):
            node = Node("comment", t)
        elif t == "{{":
            node = r.template(i)
        elif t == "[[":
            node = r.link(i)
        elif t == "[":
            node = r.url(i)
        elif t.startswith("<") and t[1] != "/":
            node = r.tag(i)
        elif t[0] == "&":
            node = Node("entity", t, body=html.unescape(t))
        elif t.startswith("''"):
            node = r.quotes(i, t, len(markup))
        elif t.endswith("{|"):
            node = r.table(i)
        elif t[0] == "=":
            node = _heading(t)
        elif t[0] in "*#:;":
            node = Node("tag", t, {"*": "li", "#": "li", ":": "dd", ";": "dt"}[t[-1]])
            node.inner = [Node("tag", c, {"*": "li", "#": "li", ":": "dd", ";": "dt"}[c]) for c in t]
        elif t.startswith("----"):
            node = Node("tag", t, "hr")
        if node is None:
            at = i + (len(t) if t[0] in "'<&" else 1)
            continue
        if i > text_from:
            out.append(Node("text", markup[text_from:i]))
        out += node.inner or [node]
        at = text_from = i + len(node.source)
    if text_from < len(markup):
        out.append(Node("text", markup[text_from:]))
    return out


def _heading(line: str) -> Node | None:
    s = line.rstrip(" \t")
    left, right = len(s) - len(s.lstrip("=")), len(s) - len(s.rstrip("="))
    if left == len(s):
        left = right = (len(s) - 1) // 2
        if not left:
            return None
    level = min(left, right, 6)
    return Node("heading", line, body=s[level : len(s) - level], level=level)


def _is_break(n: Node) -> bool:
    return n.kind == "text" and n.source.isspace() and "\n" in n.source


def shown(markup: str) -> str:
    """Plain text of a piece of markup inside another node: its templates and what is not visible are gone."""
    out = "".join(_shown(n) for n in parse(markup)).strip("\n")
    return re.sub(r"\n{3,}", "\n\n", out)


def _shown(n: Node) -> str:
    if n.kind == "text":
        return n.source
    if n.kind == "entity":
        return n.body
    if n.kind == "link":
        return "" if n.name.startswith(DROPPED_LINKS) else shown(n.body)
    if n.kind == "url" or (n.kind == "tag" and n.name not in UNSEEN and n.name != "table"):
        return n.body if n.name in ("nowiki", "pre", "syntaxhighlight", "source") else shown(n.body)
    return ""


def is_ignored(name: str, ignored=tuple(x.lower().strip() for x in R.IGNORED_TEMPLATES)) -> bool:
    """Whether a template's name, in lower case, starts with an ignored one."""
    return name.startswith(ignored)


def _rendered(n: Node) -> str:
    """A top-level node as text; templates that are not known stay as they are, to be rendered later."""
    if n.kind == "template":
        if is_ignored(n.name):
            return ""
        return R.TEMPLATE_TEXTS.get(n.name, n.source) if n.plain else n.source
    if n.kind != "tag":
        return _shown(n)
    if n.name in ("ref", "table"):
        return ""
    if n.name == "math":
        return f"<math>{n.body}</math>" if n.body else ""
    if n.name in ("i", "em"):
        inside = parse(n.body)
        text = n.body if len(inside) == 1 and inside[0].kind == "template" else _shown(n)
        return f'"{text}"' if text and n.name == "i" else text
    return {"li": "*", "dd": " "}.get(n.name, "") + _shown(n)


def _without_lead_templates(nodes: list[Node]) -> list[Node]:
    """Nodes from the first that belongs to the article's text on."""
    for k, n in enumerate(nodes):
        if n.kind == "template":
            if k + 1 < len(nodes) and not (nodes[k + 1].kind == "text" and nodes[k + 1].source.startswith("\n")):
                return nodes[k:]
        elif not _is_break(n):
            return nodes[k:]
    return []


def _without_table_templates(nodes: list[Node]) -> list[Node]:
    """Without the nodes from a template that opens a table to the one that closes it, or up to a heading."""
    closes = {start: end for end, starts in R.TABLE_TEMPLATES.items() for start in starts}
    out, until = [], None
    for n in nodes:
        if until and n.kind == "heading":
            until = None
        if until:
            until = None if n.kind == "template" and n.name == until else until
        elif n.kind == "template" and n.name in closes:
            until = closes[n.name]
        else:
            out.append(n)
    return out


def _without_lone_templates(nodes: list[Node]) -> list[Node]:
    """Without the templates of paragraphs that hold nothing else."""
    gone: set[int] = set()
    lone: list[int] | None = []  # the paragraph's templates so far; None once it has text
    for k, n in enumerate([*nodes, Node("heading", "")]):
        if n.kind == "template":
            if lone is not None:
                lone.append(k)
            continue
        opens = n.kind == "text" and n.source.startswith("\n\n")
        if n.kind == "heading" or _is_break(n) or opens:
            gone.update(lone or [])
            lone = None if opens and not _is_break(n) else []
        else:
            lone = [] if n.kind == "text" and n.source.endswith("\n\n") else None
    return [n for k, n in enumerate(nodes) if k not in gone]


def clean(markup: str, lenient: bool = False) -> list[Node]:
    """Top-level nodes without comments, media and category links, and templates that stand for no text."""
    markup = _LINE_COMMENT.sub("", markup)
    nodes = parse(markup)
    if not lenient and sum(n.kind == "heading" for n in nodes) != len(_HEADING_LINE.findall(markup)):
        raise MarkupError("broken")
    nodes = [n for n in nodes if n.kind != "comment" and not (n.kind == "link" and n.name.startswith(DROPPED_LINKS))]
    return _without_lone_templates(_without_table_templates(_without_lead_templates(nodes)))


def tidy(text: str) -> str:
    """Rendered text without surplus newlines, no-break spaces and references that are left."""
    text = re.sub(r"\n{3,}", "\n\n", text.strip("\n")).replace("\xa0", " ").strip()
    return _LEFT_OVER_REF.sub("", text).strip()


class Paths:
    """The path of each section in turn: the titles above it and its own."""

    def __init__(self):
        self.level, self.titles = 0, []

    def next(self, level: int, title: str) -> str:
        level = max(2, level)
        if not self.level:
            self.titles = [title]
        elif level > self.level:
            self.titles += [""] * (level - self.level - 1) + [title]
        else:
            self.titles = self.titles[: level - 1] if level < self.level else self.titles
            self.titles = [*self.titles[:-1], title]
        self.level = level
        return PATH_GAP.join(self.titles)


def title_of(heading: Node) -> str:
    """A heading's title as it stands in paths: its source without templates and comments."""
    return "".join(n.source for n in parse(heading.body) if n.kind not in ("template", "comment")).strip()


def sections(markup: str, lenient: bool = False) -> list[tuple[str, str]]:
    """(path, text) of the lead and each section, each without its subsections. Footnote sections are left out; the
    first section of references ends the page."""
    nodes = clean(markup, lenient)
    starts = [-1, *(k for k, n in enumerate(nodes) if n.kind == "heading")]
    footnotes = {x.lower() for x in R.FOOTNOTE_SECTIONS}
    references = {x.lower() for x in R.REFERENCE_SECTIONS}
    paths, out, seen = Paths(), [], set()
    for a, b in zip(starts, [*starts[1:], len(nodes)], strict=True):
        level, title = (nodes[a].level, title_of(nodes[a])) if a >= 0 else (2, LEAD)
        path = paths.next(level, title)
        if title.lower() in footnotes:
            continue
        if title.lower() in references:
            break
        if path in seen:
            raise MarkupError("duplicate")
        seen.add(path)
        out.append((path, tidy("".join(_rendered(n) for n in nodes[a + 1 : b]))))
    return out


def templates(text: str) -> list[str]:
    """Sources of a text's top-level templates."""
    return [n.source for n in parse(text) if n.kind == "template"]
