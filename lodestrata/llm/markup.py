"""Problem 6: HTML, Markdown, wiki and LaTeX markup rendered as clean text.

What a document holds of the other three is first rewritten as HTML elements; one tree is then built, with the
tags that HTML implies, and laid out: all visible text, with blocks apart, lists, and tables with aligned cells.
"""

from __future__ import annotations

import html
import re
import sys
from html.entities import html5

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The elements of HTML that occur in text.
BLOCK = frozenset("address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table ul body html tbody thead tfoot tr caption".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br button cite code data del dfn em font i img input ins kbd label map mark math meter nobr object output picture q ruby rp rt s samp select option small span strike strong sub sup svg time tt u var video audio wbr td th col colgroup textarea source track iframe area embed param".split())
HIDDEN = frozenset("head title script style template noscript meta link base".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NAMES = BLOCK | INLINE | HIDDEN
#: By start tag, the open elements that it closes, and where the search for them ends.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    **dict.fromkeys(("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"})),
}
# LaTeX commands that print as a sign or do nothing in text, and those whose argument is text.
BARE = frozenset("item alpha beta gamma delta epsilon zeta eta theta lambda mu nu xi pi rho sigma tau phi chi psi omega leq geq neq cdot times partial nabla sum prod int infty approx hat bar vec frac sqrt ldots dots quad qquad noindent newline newpage clearpage maketitle tableofcontents centering hline par bigskip medskip smallskip appendix".split())
TEXTUAL = frozenset("textbf textit emph texttt textsc textsf textrm underline text mbox footnote caption title author title* textsuperscript textsubscript url enquote".split())
UNSEEN = frozenset("noindent newpage clearpage maketitle tableofcontents centering par bigskip medskip smallskip hline newline appendix".split())
HEADINGS = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "subparagraph": 6}
REFERENCES = frozenset("cite citep citet ref eqref autoref pageref".split())
SILENT = frozenset("label documentclass usepackage bibliography bibliographystyle input include includegraphics vspace hspace pagestyle thispagestyle setlength newcommand date index".split())
MATH_ENVIRONMENTS = "equation|align|gather|multline|eqnarray|displaymath|math"

TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)((?:\s+[A-Za-z_:@][-\w:.@]*(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'=<>`]+))?)*)\s*(/?)>|<!--.*?(?:-->|\Z)|<!DOCTYPE[^>]*>", re.S | re.I)
ENTITY = re.compile(r"&(#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
FOOTNOTE = re.compile(r"<sup>&</sup>lt;sup>\d{1,3}</sup>|(?<![\w&])lt;sup>\d{1,3}</sup>|&lt;sup&gt;\d{1,3}&lt;/sup&gt;")
FENCE = re.compile(r"^(`{3,}|~{3,})[^\n`]*\n(.*?)(?:^\1[`~]*[ \t]*$|\Z)", re.S | re.M)
TICKS = re.compile(r"(?<![`\\])(`+)(?!`)([^\n]*?[^`\n])\1(?!`)")
MATH = re.compile(
    # none runs past another opening of its kind, so that openings that are never closed cost no more than the text between them
    rf"\$\$(.+?)\$\$|\\\[((?:(?!\\\[).)+?)\\\]|\\\(((?:(?!\\\().)+?)\\\)|\\begin\{{((?:{MATH_ENVIRONMENTS})\*?)\}}((?:(?!\\begin\{{\4\}}).)*?)\\end\{{\4\}}|(?<![\\$\w])\$(?=[^\s$\d])((?:[^$\n\\]|\\.|\n(?!\n))+?)(?<=[^\s\\])\$(?![\d$\w])|(?<![\\$\w])\$(?=\d)((?=[^$\n]*[\\^_={{])[^$\n]+?)(?<=\S)\$(?![\d$\w])",
    re.S,
)
COMMAND = re.compile(r"\\([A-Za-z]+)(\*?)((?:\[[^\[\]\n]*\])*)(?=(\{)?)")
OPEN, SHUT = "\ue000", "\ue001"
#: Elements nested deeper than this, which only unclosed tags are, count as closed at once; the walk over the tree recurses.
DEEPEST = 2000
sys.setrecursionlimit(max(sys.getrecursionlimit(), 10 * DEEPEST))
#: A tabular environment: its columns, and what it holds.
TABULAR = re.compile(r"\\begin\{(tabular[x*]?|array)\}(?:\{[^{}\n]*\}(?=\{))?(?:\[[^\[\]\n]*\])?\{(?:[^{}\n]|\{[^{}\n]*\})*\}((?:(?!\\begin\{tabular).)*?)\\end\{\1\}", re.S)


class Rewriting:
    """A document on its way to HTML; ``pieces`` counts what markup it had."""

    def __init__(self, text: str):
        self.kept: list[tuple[str, str]] = []
        self.pieces = dict.fromkeys(("html", "markdown", "wiki", "latex"), 0)
        self.text = text.replace(OPEN, " ").replace(SHUT, " ")

    def keep(self, kind: str, content: str) -> str:
        """Sets content aside under a mark that no later step touches."""
        self.kept.append((kind, content))
        return f"{OPEN}{len(self.kept) - 1}{SHUT}"

    def sub(self, pattern, to, kind: str, flags: int = 0) -> None:
        def replace(match):
            value = to(match) if callable(to) else match.expand(to)
            if value is None:
                return match.group()
            self.pieces[kind] += 1
            return value

        self.text = re.sub(pattern, replace, self.text, flags=flags) if isinstance(pattern, str) else pattern.sub(replace, self.text)

    def element(self, name: str) -> str:
        """A tag set aside; what stands between a start and an end tag stays open to later steps."""
        return self.keep("tag", name)

    def wrap(self, name: str, content: str) -> str:
        return self.element(f"<{name}>") + content + self.element(f"</{name}>")


def item(r: Rewriting, text: str, level: int = 0, mark: str = "•") -> str:
    return r.element(f'<li level="{level}" mark="{mark}">') + text + r.element("</li>")


def spans(line: str, opener: str, closer: str, solid: str | None = None) -> list[tuple[int, int, int, int]]:
    """``start, inner start, inner end, end`` of what stands between marks in a line, from the first opening to the next closing.

    One pass: an opening waits for its closing, however far. ``solid`` may not stand in between.
    """
    found, waits, at = [], None, 0
    kinds = re.compile(rf"(?P<both>(?={opener})(?={closer}))|(?P<open>{opener})|(?P<close>{closer})" + (f"|(?P<solid>{solid})" if solid else ""))
    first = re.compile(opener)
    while m := kinds.search(line, at):
        kind, start = m.lastgroup, m.start()
        end = first.match(line, start).end() if kind == "both" else m.end()
        at = max(end, start + 1)
        if kind == "solid":
            waits = None
        elif waits is not None and kind in ("close", "both") and start > waits[1]:
            found.append((*waits, start, end))
            waits = None
        elif kind in ("open", "both") and (waits is None or solid):
            waits = (start, end)
        elif kind == "close" and solid:
            waits = None
    return found


def unmarked(r: Rewriting, kind: str, sign: str, opener: str, closer: str, solid: str | None = None, keep=None) -> None:
    """Takes off the marks, which begin with ``sign``, around spans of one line."""
    if r.text.count(sign) < 2:
        return
    lines = r.text.split("\n")
    for k, line in enumerate(lines):
        if line.count(sign) < 2:
            continue
        out, at = [], 0
        for start, inner, stop, end in spans(line, opener, closer, solid):
            if keep is not None and keep(line[inner:stop]):
                continue
            out += [line[at:start], line[inner:stop]]
            at = end
            r.pieces[kind] += 1
        lines[k] = "".join(out) + line[at:]
    r.text = "\n".join(lines)


def _code(r: Rewriting) -> None:
    r.sub(FENCE, lambda m: r.keep("pre", m[2].rstrip("\n")) + "\n", "markdown")
    r.sub(TICKS, lambda m: r.keep("code", m[2].strip()) if m[2].strip() else None, "markdown")


def _formulas(r: Rewriting) -> None:
    def formula(m):
        display = m[1] or m[2] or m[5]
        body = display or m[3] or m[6] or m[7]
        if not body or not body.strip():
            return None
        return r.keep("display" if display else "formula", body.strip())

    r.sub(MATH, formula, "latex")


def _html(r: Rewriting) -> None:
    r.sub(FOOTNOTE, "", "html")

    def tag(m):
        if m[2] is None:
            return r.keep("comment", "")
        if m[2].lower() not in NAMES:
            return None
        return r.element(m.group())

    r.sub(TAG, tag, "html")
    r.sub(ENTITY, lambda m: r.keep("text", html.unescape(m.group())) if m[1][0] == "#" or m[1] + ";" in html5 else None, "html")


def braces(text: str) -> dict[int, int]:
    """The closing brace of each opening one, in one pass; braces behind a backslash are text."""
    waiting, ends = [], {}
    for m in re.finditer(r"(?<!\\)[{}]", text):
        if m[0] == "{":
            waiting.append(m.start())
        elif waiting:
            ends[waiting.pop()] = m.start()
    return ends


def rows_of(r: Rewriting, rows: list[list[str]]) -> str:
    tag = r.element
    return tag("<table>") + "".join(tag("<tr>") + "".join(tag("<td>") + c + tag("</td>") for c in row) + tag("</tr>") for row in rows) + tag("</table>")


def _tabular(m, r: Rewriting) -> str:
    body = re.sub(r"\\(?:hline|toprule|midrule|bottomrule|centering)\b|\\c(?:line|midrule)(?:\([^()\n]*\))?\{[^{}\n]*\}", "", m[2])
    rows = [[c.strip() for c in re.split(r"(?<!\\)&", row)] for row in re.split(r"\\\\(?:\[[^\[\]\n]*\])?", body) if row.strip()]
    return rows_of(r, rows)


def _latex(r: Rewriting) -> None:
    r.sub(TABULAR, lambda m: _tabular(m, r), "latex")
    out, at, text = [], 0, r.text
    ends = braces(text)
    shuts: set[int] = set()  # closing braces of arguments that stay, which go

    def upto(end: int) -> str:
        inside = sorted(p for p in shuts if at <= p < end)
        shuts.difference_update(inside)
        parts, start = [], at
        for p in inside:
            parts.append(text[start:p])
            start = p + 1
        return "".join(parts) + text[start:end]

    while m := COMMAND.search(text, at):
        name, end = m[1], m.end()
        shut = ends.get(end, -1) if m[4] else -1
        content = text[end + 1 : shut] if shut >= 0 else None
        if name not in BARE and content is None:
            out.append(upto(end))
            at = end
            continue
        r.pieces["latex"] += 1
        before, at = upto(m.start()), m.start()
        out.append(before[:-1] + " " if name in REFERENCES and before.endswith("~") else before)
        at = end if content is None else shut + 1
        if content is None:
            if name == "item":
                out.append(r.element("<li>"))
                at += text[at : at + 1] == " "
            elif name not in UNSEEN:
                out.append(r.keep("text", m.group().strip()))
        elif name in HEADINGS:
            out.append(r.wrap(f"h{HEADINGS[name]}", content))
        elif name in ("begin", "end"):
            kind = {"itemize": "ul", "enumerate": "ol", "description": "ul", "quote": "blockquote", "center": "div"}.get(content)
            out.append(r.element(f"<{'/' * (name == 'end')}{kind}>") if kind else "")
        elif name in REFERENCES:
            out.append(f"[{content}]" if name.startswith("cite") else f"({content})")
        elif name == "href" and text[at : at + 1] == "{" and (more := ends.get(at, -1)) >= 0:
            at += 1
            shuts.add(more)
        elif name not in SILENT:
            at = end + 1
            shuts.add(shut)
    r.text = "".join(out) + upto(len(text))
    if r.pieces["latex"]:
        r.text = re.sub(r"\\([%&$#_{}])", r"\1", r.text)
        r.text = re.sub(r"\\\\(?:\[[^\]\n]*\])?", lambda m: r.element("<br>"), r.text)


#: Lines of a wiki list that Markdown's rules do not cover: with nested items, or of two or more numbered ones.
WIKI_LIST = re.compile(r"^(?:(?:\*[ \t]+\S[^\n]*\n)*\*[*#]{1,5}[ \t]+\S[^\n]*(?:\n\*[*#]{0,5}[ \t]+\S[^\n]*)*|#[ \t]+\S[^\n]*\n#[ \t]+\S[^\n]*(?:\n#[*#]{0,5}[ \t]+\S[^\n]*)*)", re.M)


def _wiki_list(m, r: Rewriting) -> str:
    numbers, out = [0] * 7, []
    for line in m[0].split("\n"):
        marks = re.match(r"[*#]+", line)[0]
        level = len(marks) - 1
        numbers[level + 1 :] = [0] * (6 - level)
        numbers[level] += 1
        out.append(item(r, line[len(marks) :].strip(), level, f"{numbers[level]}." if marks[-1] == "#" else "•"))
    return "\n".join(out)


def _templates(r: Rewriting, template) -> None:
    """Each ``{{...}}`` replaced, inner ones first, in one pass."""
    stack: list[list[str]] = [[]]  # what stands before, and within each template that is open
    for part in re.split(r"(\{\{(?!\{)|\}\})", r.text):
        if part == "{{":
            stack.append([])
        elif part == "}}" and len(stack) > 1:
            inner, before = "".join(stack.pop()), stack[-1][-1] if stack[-1] else ""
            named = re.match(r"\s*[A-Za-z#]", inner) and not re.search(r"[{}]", inner) and not re.search(r"[\w}{]\Z", before)
            r.pieces["wiki"] += bool(named)
            stack[-1].append(template(inner.lstrip()) if named else "{{" + inner + "}}")
        elif part:
            stack[-1].append(part)
    while len(stack) > 1:
        rest = "".join(stack.pop())
        stack[-1].append("{{" + rest)
    r.text = "".join(stack[0])


def _wiki(r: Rewriting) -> None:
    def template(content: str) -> str:
        name, *parts = content.split("|")
        named = [p.split("=", 1) for p in parts if "=" in p]
        if not named or name.strip().lower().startswith(("cite", "ref", "citation")):
            return ""
        return r.element("<p>") + " | ".join(f"{k.strip()}: {v.strip()}" for k, v in named) + r.element("</p>")

    if "{{" in r.text:
        _templates(r, template)

    def table(m):
        rows, cells = [], []
        for line in m[1].split("\n")[1:]:
            line = line.strip()
            if line.startswith("|-"):
                rows, cells = rows + [cells] * bool(cells), []
            elif line.startswith("|+"):
                rows.append([line[2:].strip()])
            elif line[:1] in ("|", "!") and line:
                cells = cells + [c.split("|", 1)[-1].strip() for c in re.split(r"\|\||!!", line[1:])]
            elif line and cells:
                cells[-1] += " " + line
        rows += [cells] * bool(cells)
        return rows_of(r, rows) + "\n"

    r.sub(r"^[ \t]*(\{\|[^\n]*(?:\n(?![ \t]*\|\})[^\n]*)*)(?:\n[ \t]*\|\}[ \t]*\n?|\Z)", table, "wiki", re.M)
    r.sub(r"^(={2,6})[ \t]*([^=\n][^\n]*?)[ \t]*\1[ \t]*$", lambda m: r.wrap(f"h{len(m[1])}", m[2]), "wiki", re.M)
    r.sub(r"(?<![\w\]])\[\[(?!\s)([^\[\]\n]+)\]\]", lambda m: "" if m[1].lower().startswith("category:") else m[1].rsplit("|", 1)[-1] if m[1].lower().startswith(("file:", "image:")) and "|" in m[1] else m[1].split("|", 1)[-1], "wiki")
    for marks in (5, 3, 2):
        unmarked(r, "wiki", "'" * marks, rf"(?<![\w'])'{{{marks}}}(?=[^\s'])", rf"(?<=[^\s'])'{{{marks}}}(?!')")
    r.sub(r"(?<![\w\]\)])\[https?://[^\s\]]+ ([^\]\n]+)\](?!\()", lambda m: m[1], "wiki")
    if r.pieces["wiki"]:
        r.sub(WIKI_LIST, lambda m: _wiki_list(m, r), "wiki")


def _heading_like(line: str) -> bool:
    return not line.strip() or line.startswith(OPEN) or bool(re.match(r"\s{0,3}\d{1,3}[.)]\s", line)) or bool(re.fullmatch(r"[-=*_]{3,}\s*", line))


def _new_sentence(before: str, line: str) -> bool:
    """Whether a marked line opens with a sentence of its own, so its sign is no minus, times or greater in a formula that was wrapped."""
    return bool(re.search(r"[.!?:][\"')\]]*\s*$", before[-20:]) and re.match(r"\s*[-*+>][ \t]+[\"'(]?[A-Z]", line))


def _markdown(r: Rewriting) -> None:
    lines, out, i = r.text.split("\n"), [], 0
    tag = r.element
    indents: list[int] = []  # of the items that the next one may be nested in
    cells = lambda x: [c.strip() for c in x.strip().strip("|").split("|")]
    while i < len(lines):
        line = lines[i]
        follows = out[-1] if out else ""
        if line.strip() and line[0] not in " \t" and not re.match(r"[-*+][ \t]", line):
            indents = [0] if re.match(r"\d{1,3}[.)][ \t]", line) else []
        if m := re.match(r" {0,3}(#{1,6})[ \t]+(\S.*?)[ \t]*#*[ \t]*$", line):
            r.pieces["markdown"] += 1
            out.append(r.wrap(f"h{len(m[1])}", m[2]))
        elif "|" in line and i + 1 < len(lines) and "-" in lines[i + 1] and "|" in lines[i + 1] and re.fullmatch(r"\s*\|?\s*:?-{2,}:?\s*(?:\|\s*:?-{2,}:?\s*)*\|?\s*", lines[i + 1]):
            r.pieces["markdown"] += 1
            rows = [cells(line)]
            i += 2
            while i < len(lines) and "|" in lines[i] and lines[i].strip():
                rows.append(cells(lines[i]))
                i += 1
            out.append(rows_of(r, rows))
            continue
        elif re.match(r"[ \t]*[-*+][ \t]+\S" if indents else r" {0,3}[-*+][ \t]+\S", line) and not re.fullmatch(r"\s*- \S{1,6} -\s*", line) and not re.fullmatch(r"\s*(?:[-*+] ?){3,}\s*", line) and (_heading_like(follows) or _new_sentence(follows, line)) and not re.match(r"\s*[-*+]\s+\d[\d.,]*\s*$", line):
            r.pieces["markdown"] += 1
            mark = re.match(r"\s*([-*+])[ \t]+", line)
            width = len(line[: mark.start(1)].expandtabs(4))
            while indents and width < indents[-1] + 2:
                indents.pop()
            out.append(item(r, line[mark.end() :], len(indents)))
            indents.append(width)
        elif re.match(r" {0,3}>[ \t]+\S", line) and (_heading_like(follows) or _new_sentence(follows, line)):
            r.pieces["markdown"] += 1
            out.append(tag("<blockquote>") + re.sub(r"^ {0,3}>[ \t]*", "", line) + tag("</blockquote>"))
        elif re.fullmatch(r" {0,3}(?:=+|-{3,})[ \t]*", line) and len(line.strip()) >= 3 and follows.strip() and not follows.startswith(OPEN) and len(follows) <= 80 and (len(out) < 2 or not out[-2].strip()):
            r.pieces["markdown"] += 1
            out[-1] = r.wrap("h1" if "=" in line else "h2", follows)
        elif re.fullmatch(r" {0,3}(?:\*\s*){3,}|\s{0,3}(?:_\s*){3,}|\s{0,3}-{3,}\s*", line) and not follows.strip() and out:
            r.pieces["markdown"] += 1
            out.append("")
        elif m := re.match(r"\[\^([^\]\s]{1,20})\]:[ \t]*(.*)$", line):
            r.pieces["markdown"] += 1
            out.append(tag("<p>") + f"{m[1]}: {m[2]}" + tag("</p>"))
        else:
            out.append(line)
        i += 1
    r.text = "\n".join(out)
    url = r"\((?=[^)\s])(?:[^()\n]|\([^()\n]*\))+\)"
    r.sub(rf"!\[((?:[^\[\]\n]|\[[^\[\]\n]*\])*)\]{url}", lambda m: m[1], "markdown")
    r.sub(rf"\[((?:[^\[\]\n]|\[[^\[\]\n]*\])+)\]{url}", lambda m: m[1], "markdown")
    r.sub(r"\[\^[^\]\s]{1,20}\]", "", "markdown")
    for marks in (3, 2):
        unmarked(r, "markdown", "*" * marks, rf"(?<![\w*\\])\*{{{marks}}}(?=[^\s*])", rf"(?<=[^\s*])\*{{{marks}}}(?![\w*])")
    unmarked(r, "markdown", "__", r"(?<![\w_\\])__(?=[^\s_])", r"(?<=[^\s_])__(?![\w_])", keep=lambda x: re.fullmatch(r"init|main|name|file|doc|all|call|new|del|str|repr|len|iter|dict|version", x))
    unmarked(r, "markdown", "~~", r"~~(?=[^\s~])", r"(?<=[^\s~])~~")
    unmarked(r, "markdown", "*", r"(?<![\w*\\])\*(?=[^\s*])", r"(?<=[^\s*])\*(?![\w*])", r"\*")
    unmarked(r, "markdown", "_", r"(?<![\w_\\])_(?=[^\s_])", r"(?<=[^\s_])_(?![\w_])", "_")
    r.sub(r"<(https?://[^\s<>]+)>", lambda m: m[1], "markdown")


class Node:
    __slots__ = ("name", "children", "shown", "level", "mark")

    def __init__(self, name: str, shown: bool = True):
        self.name, self.children, self.shown, self.level, self.mark = name, [], shown, None, None


def build(r: Rewriting) -> Node:
    """The tree: unclosed elements end where HTML says, stray end tags are ignored, hidden elements marked."""
    root = Node("root")
    open_: list[Node] = [root]

    def close(names: set, until: set) -> None:
        for k in range(len(open_) - 1, 0, -1):
            if open_[k].name in names:
                del open_[k:]
                return
            if open_[k].name in until:
                return

    for k, part in enumerate(re.split(f"{OPEN}(\\d+){SHUT}", r.text)):
        if k % 2 == 0:
            if part:
                open_[-1].children.append(part)
            continue
        kind, content = r.kept[int(part)]
        if kind == "comment":
            continue
        if kind != "tag":
            open_[-1].children.append((kind, content))
            continue
        m = TAG.match(content)
        name, attributes = m[2].lower(), (m[3] or "").lower()
        if m[1]:
            if name == "p" and not any(n.name == "p" for n in open_):
                continue
            for at in range(len(open_) - 1, 0, -1):
                if open_[at].name == name:
                    del open_[at:]
                    break
            continue
        if name in IMPLIED:
            for _ in range(3 if name == "tr" or name.startswith("t") and name != "td" and name != "th" else 1):
                close(*IMPLIED[name])
        elif name in BLOCK:
            close({"p"}, {"table", "td", "th", "li", "div", "blockquote"})
        hidden = name in HIDDEN or bool(re.search(r"\bhidden\b(?!\s*=\s*[\"']?false)", re.sub(r"\w+\s*=\s*(?:\"[^\"]*\"|'[^']*')", "", attributes))) or "display:none" in attributes.replace(" ", "") or "visibility:hidden" in attributes.replace(" ", "")
        node = Node(name, not hidden)
        if name == "li" and (own := re.fullmatch(r'\s+level="(\d+)" mark="([^"]+)"', m[3] or "")):
            node.level, node.mark = int(own[1]), own[2]
        open_[-1].children.append(node)
        if name not in VOID and not m[4] and len(open_) < DEEPEST:
            open_.append(node)
    return root


def words_in(text: str) -> str:
    return re.sub(r"[ \t\r\n\f]+", " ", text)


def lay_out(root: Node) -> tuple[str, dict]:
    """The visible text, and how many headings, list items, tables, code blocks and formulas it has, with an outline of the headings."""
    seen = dict.fromkeys(("headings", "items", "tables", "code_blocks", "formulas"), 0) | {"outline": ""}
    out: list[str] = []

    def gap(n: int) -> None:
        if not out:
            return
        have, k = 0, len(out) - 1
        while k >= 0 and have < n:
            piece = out[k].rstrip(" ")
            tail = len(piece) - len(piece.rstrip("\n"))
            have += tail
            if tail < len(piece):
                break
            k -= 1
        if any(x.strip() for x in out):
            out.append("\n" * max(0, n - have))

    def inside(node: Node) -> str:
        mark = len(out)
        for child in node.children:
            emit(child, False, 0)
        text = "".join(out[mark:])
        del out[mark:]
        return words_in(text).strip()

    def table(node: Node) -> None:
        rows: list[list[str]] = []

        def collect(n: Node) -> None:
            for child in n.children:
                if isinstance(child, Node) and child.shown:
                    if child.name == "tr":
                        rows.append([inside(c) for c in child.children if isinstance(c, Node) and c.name in ("td", "th") and c.shown])
                    elif child.name == "caption":
                        rows.append([inside(child)])
                    elif child.name in ("td", "th"):
                        rows.append([inside(child)])
                    else:
                        collect(child)

        collect(node)
        width = [max((len(row[i]) for row in rows if i < len(row) and len(row) > 1), default=0) for i in range(max(map(len, rows), default=0))]
        gap(2)
        out.extend("  ".join(c.ljust(w) for c, w in zip(row, width)).rstrip() + "\n" if len(row) > 1 else "".join(row) + "\n" for row in rows)
        seen["tables"] += 1
        gap(2)

    def emit(child, loose: bool, depth: int, number: list | None = None) -> None:
        if isinstance(child, str):
            if loose:
                out.append(child)
            else:
                text = words_in(child)
                out.append(text.lstrip() if not out or out[-1].endswith(("\n", " ")) else text)
            return
        if isinstance(child, tuple):
            kind, content = child
            if kind == "pre":
                gap(2)
                out.append(content)
                seen["code_blocks"] += 1
                gap(2 if not loose else 1)
            elif kind == "display":
                gap(1)
                out.append(f"$${content}$$")
                seen["formulas"] += 1
                gap(1)
            elif kind == "formula":
                out.append(f"${content}$")
                seen["formulas"] += 1
            else:
                out.append(content)
            return
        if not child.shown:
            return
        name = child.name
        if name == "br":
            out.append("\n")
        elif name == "hr":
            gap(2)
        elif name == "table":
            table(child)
        elif name in ("ul", "ol", "menu", "dl"):
            gap(2 if depth == 0 else 1)
            count = [0] if name == "ol" else None
            for c in child.children:
                if isinstance(c, str) and not c.strip():
                    continue
                emit(c, False, depth + 1, count)
            gap(2 if depth == 0 else 1)
        elif name == "li":
            gap(1)
            seen["items"] += 1
            if number is not None:
                number[0] += 1
            out.append("  " * (max(0, depth - 1) if child.level is None else child.level) + (f"{child.mark} " if child.mark else f"{number[0]}. " if number is not None else "• "))
            for c in child.children:
                emit(c, False, depth)
            gap(1)
        elif name in ("h1", "h2", "h3", "h4", "h5", "h6"):
            seen["headings"] += 1
            gap(2)
            title = inside(child)
            out.append(title)
            seen["outline"] += f"{name[1]} {title}\n"
            gap(2)
        elif name == "pre":
            seen["code_blocks"] += 1
            gap(2)
            for c in child.children:
                emit(c, True, depth)
            gap(2)
        elif name in BLOCK:
            gap(1 if name in ("div", "section", "article", "dt", "dd", "body", "html", "tr") else 2)
            keep = name in ("div", "section", "article", "body", "html", "main") and loose
            for c in child.children:
                emit(c, keep, depth)
            gap(1 if name in ("div", "section", "article", "dt", "dd", "body", "html", "tr") else 2)
        elif name in ("td", "th"):
            for c in child.children:
                emit(c, loose, depth)
            out.append("  ")
        else:
            for c in child.children:
                emit(c, loose, depth)

    for before, child in zip([None, *root.children], root.children):
        if isinstance(child, str) and isinstance(before, Node) and before.name in ("li", "blockquote"):
            child = child.removeprefix("\n")  # the item has ended its line
        emit(child, True, 0)
    text = re.sub(r"[ \t]+(?=\n)", "", "".join(out))
    return re.sub(r"\n{3,}", "\n\n", text).strip("\n"), seen


SIGNS = re.compile(r"[<&*_`~#\[{\\$]|''|==|^[ \t]*[-+>=]|\|[ \t]*:?-", re.M)
COLUMNS = ("text", "html", "markdown", "wiki", "latex", "headings", "items", "tables", "code_blocks", "formulas", "outline")
NOTHING = (*[0] * 9, "")


def render(text: str) -> tuple:
    """The values of COLUMNS for a text; one without markup comes out as it is."""
    if not SIGNS.search(text):
        return text, *NOTHING
    r = Rewriting(text)
    for step in (_code, _formulas, _html, _wiki, _latex, _markdown):
        step(r)
    if not any(r.pieces.values()):
        return text, *NOTHING
    clean, seen = lay_out(build(r))
    return clean, *r.pieces.values(), *seen.values()


def _render(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(None, *NOTHING) if t is None else render(t) for t in texts], columns=COLUMNS)


def clean_markup(rows: DataFrame, key: str = "id", text: str = "document") -> DataFrame:
    """``id`` and COLUMNS: every distinct record as clean text, with the pieces of each markup and of the structure kept, and an
    outline: a line for each heading, its level and its text.

    Code and formulas are set aside first and come out as they were; signs that mean themselves stay. Null keys are kept, null texts stay null with
    zeros, an empty text stays empty.
    """
    shape = T.StructType([T.StructField("text", T.StringType()), *(T.StructField(n, T.IntegerType()) for n in COLUMNS[1:-1]), T.StructField(COLUMNS[-1], T.StringType())])
    named = rows.select(F.col(key).alias("id"), F.col(text).alias("given")).distinct()
    return named.select("id", F.pandas_udf(_render, shape)("given").alias("r")).select("id", "r.*")


def markup_kinds(rows: DataFrame, key: str = "id", text: str = "document") -> DataFrame:
    """``id, markup``: one row for each kind of markup that a record has a piece of."""
    kinds = F.array_compact(F.array(*(F.when(F.col(k) > 0, F.lit(k)) for k in ("html", "markdown", "wiki", "latex"))))
    return clean_markup(rows, key, text).select("id", F.explode(kinds).alias("markup")).distinct()
