"""Wiki markup to HTML.

Line rules (rules, headings, links, spacing) are patterns; emphasis, lists,
tables, protected regions and the tag whitelist are small state machines. The
whole pipeline is one Arrow UDF (``html``), so that text crosses to Python once.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Callable
from html.entities import name2codepoint
from itertools import takewhile

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements that may stand in a page.
INLINE = frozenset("abbr b big br cite code dfn em font i kbd q s samp small span strike strong sub sup tt u var rb rp rt ruby".split())
BLOCKS = frozenset("blockquote caption center dd del div dl dt h1 h2 h3 h4 h5 h6 hr ins li ol p pre table td th tr ul".split())
VOID = frozenset("br hr".split())

# Attributes that any element may have, and those of single elements.
ANY = frozenset("id class lang dir title style".split())
ALIGN = frozenset("align char charoff valign".split())
CELL = ALIGN | frozenset("abbr axis headers scope rowspan colspan nowrap width height bgcolor".split())
OWN = {
    "blockquote": {"cite"}, "br": {"clear"}, "caption": {"align"}, "del": {"cite", "datetime"}, "div": {"align"}, "font": {"size", "color", "face"},
    "hr": {"noshade", "size", "width"}, "ins": {"cite", "datetime"}, "li": {"type", "value"}, "ol": {"type", "start"}, "p": {"align"}, "pre": {"width"}, "span": {"align"},
    "table": {"summary", "width", "border", "frame", "rules", "cellspacing", "cellpadding", "align", "bgcolor"},
    "td": CELL, "th": CELL, "tr": ALIGN | {"bgcolor"}, "ul": {"type"}, **{f"h{k}": {"align"} for k in range(1, 7)},
}
#: Elements that have fewer than ``ANY``.
ONLY = {"br": frozenset("id class title style clear".split())}
MAGIC = ("__TOC__", "__NOTOC__", "__FORCETOC__", "__NOEDITSECTION__", "__NEWSECTIONLINK__")
TOC_FROM, TOC_LEVELS = 4, 5

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:\s[^<>]*)?)(/?)>")
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_ENTITY = re.compile(r"&(?:#(?:(\d+)|[xX]([0-9a-fA-F]+));|([a-zA-Z][a-zA-Z0-9]*);)?")
_QUOTES = re.compile(r"'{2,}")
_PROTECTED = re.compile(r"<(nowiki|pre|math)>(.*?)</\1>|<!--.*?-->", re.DOTALL)

Hook = Callable[[str, dict[str, str]], str]
HOOKS: dict[str, Hook] = {}


def register_hook(tag: str, fn: Hook) -> None:
    """Render ``<tag>body</tag>`` by ``fn(body, attributes)``. Queries built
    from here on take the hook along to their workers."""
    HOOKS[tag] = fn


def allowed(tag: str, attribute: str) -> bool:
    return attribute in ONLY[tag] if tag in ONLY else attribute in ANY or attribute in OWN.get(tag, ())


def character(code: int) -> bool:
    """Whether XML allows the code point."""
    return code in (0x9, 0xA, 0xD) or 0x20 <= code <= 0xD7FF or 0xE000 <= code <= 0xFFFD or 0x10000 <= code <= 0x10FFFF


def _reference(m: re.Match) -> str:
    """A character reference as it stands, if it names a character; else text."""
    dec, hexa, name = m.groups()
    known = name in name2codepoint if name else character(int(dec) if dec else int(hexa, 16)) if dec or hexa else False
    return m[0] if known else "&amp;" + m[0][1:]


def emphasis(line: str) -> str:
    """Runs of apostrophes to <i> and <b>, closed at the end of the line."""
    runs = [m for m in _QUOTES.finditer(line)]
    if not runs:
        return line
    sizes = []
    for m in runs:
        n = len(m[0])
        sizes.append((1, 3) if n == 4 else (n - 5, 5) if n > 5 else (0, n))
    bolds = sum(s in (3, 5) for _, s in sizes)
    italics = sum(s in (2, 5) for _, s in sizes)
    if bolds % 2 and italics % 2:
        _demote(line, runs, sizes)
    out, stack, at = [], [], 0

    def toggle(tag: str) -> None:
        if tag in stack:
            reopen = []
            while (top := stack.pop()) != tag:
                out.append(f"</{top}>")
                reopen.append(top)
            out.append(f"</{tag}>")
            for x in reversed(reopen):
                out.append(f"<{x}>")
                stack.append(x)
        else:
            out.append(f"<{tag}>")
            stack.append(tag)

    for k, (m, (spare, size)) in enumerate(zip(runs, sizes, strict=True)):
        out.append(line[at : m.start()] + "'" * spare)
        at = m.end()
        if size == 2:
            toggle("i")
        elif size == 3:
            toggle("b")
        elif len(stack) == 1:
            one = stack[0]
            toggle(one)
            toggle("b" if one == "i" else "i")
        elif stack:
            toggle(stack[-1])
            toggle(stack[-1])
        else:  # which closes first is to be the inner one
            nxt = next((s for _, s in sizes[k + 1 :]), 0)
            for tag in ("b", "i") if nxt == 2 else ("i", "b"):
                toggle(tag)
    out.append(line[at:])
    out += [f"</{t}>" for t in reversed(stack)]
    return "".join(out)


def _demote(line: str, runs: list[re.Match], sizes: list[tuple[int, int]]) -> None:
    """With odd numbers of both, one bold run is an apostrophe and italics."""
    best: dict[str, int] = {}
    for k, (m, (_, size)) in enumerate(zip(runs, sizes, strict=True)):
        if size != 3:
            continue
        head = line[: m.start()]
        kind = "space" if head.endswith(" ") else "letter" if len(head) == 1 or head[-2:-1] == " " else "word"
        best.setdefault(kind, k)
    for kind in ("letter", "word", "space"):
        if kind in best:
            sizes[best[kind]] = (1, 2)
            return


def _attributes(text: str, tag: str) -> str:
    out = []
    for name, a, b, c in _ATTR.findall(text):
        name, value = name.lower(), _html.unescape(a or b or c)
        if not allowed(tag, name) or (name == "style" and re.search(r"expression|url\s*\(|https?:|javascript", value, re.IGNORECASE)):
            continue
        if name == "id":
            value = re.sub(r"[^\w.:-]", "_", value)
        out.append(f' {name}="{_html.escape(value)}"')
    return "".join(out)


def sanitised(text: str) -> str:
    """Elements on the whitelist stay, balanced; other tags show as text."""
    out, stack, at = [], [], 0
    for m in _TAG.finditer(text):
        out.append(text[at : m.start()].replace("<", "&lt;").replace(">", "&gt;"))
        at = m.end()
        close, tag, attrs = m[1], m[2].lower(), m[3]
        if tag not in INLINE and tag not in BLOCKS:
            out.append(_html.escape(m[0], quote=False))
        elif tag in VOID:
            out.append(f"<{tag}{_attributes(attrs, tag)} />")
        elif not close:
            if tag in ("li", "td", "th", "tr", "dt", "dd") and stack and stack[-1] == tag:
                out.append(f"</{stack.pop()}>")
            stack.append(tag)
            out.append(f"<{tag}{_attributes(attrs, tag)}>")
        elif tag in stack:
            while (top := stack.pop()) != tag:
                out.append(f"</{top}>")
            out.append(f"</{tag}>")
        else:
            out.append(_html.escape(m[0], quote=False))
    out.append(text[at:].replace("<", "&lt;").replace(">", "&gt;"))
    return "".join(out) + "".join(f"</{t}>" for t in reversed(stack))


def _cells(line: str, kind: str, tag: str) -> str:
    cells = re.split(r"\|\||!!" if tag == "th" else r"\|\|", line)
    out = []
    for c in cells:
        head, bar, body = c.partition("|")
        attrs, body = (_attributes(head, tag), body) if bar and "[[" not in head else ("", c)
        out.append(f"<{tag}{attrs}>{body.strip()}</{tag}>")
    return "".join(out)


def tables(text: str) -> str:
    """Wikitables to HTML tables; unclosed ones are closed, empty ones vanish."""
    out: list[str] = []
    open_: list[dict] = []

    def close() -> None:
        t = open_.pop()
        if t["row"]:
            t["body"].append("</tr>")
        body = "".join(t["body"])
        whole = f"{t['indent']}<table{t['attrs']}>{body}</table>{t['outdent']}" if "<t" in body else ""
        (open_[-1]["body"] if open_ else out).append(whole)

    for line in text.split("\n"):
        s = line.strip()
        if m := re.match(r"^(:*)\{\|(.*)$", s):
            n = len(m[1])
            open_.append({"attrs": _attributes(m[2], "table"), "body": [], "row": False, "indent": "<dl><dd>" * n, "outdent": "</dd></dl>" * n})
        elif not open_:
            out.append(line)
        elif s.startswith("|}"):
            close()
        elif s.startswith("|-"):
            t = open_[-1]
            t["body"] += (["</tr>"] if t["row"] else []) + [f"<tr{_attributes(s.lstrip('|-'), 'tr')}>"]
            t["row"] = True
        elif s.startswith("|+"):
            open_[-1]["body"].append(f"<caption>{s[2:].strip()}</caption>")
        elif s[:1] in ("|", "!"):
            t = open_[-1]
            if not t["row"]:
                t["body"].append("<tr>")
                t["row"] = True
            t["body"].append(_cells(s[1:], s[0], "th" if s[0] == "!" else "td"))
        elif s:
            open_[-1]["body"].append("\n" + s)
    while open_:
        close()
    return "\n".join(out)


_LISTS = {"*": ("ul", "li"), "#": ("ol", "li"), ":": ("dl", "dd"), ";": ("dl", "dt")}
_BLOCK_TAG = re.compile(r"</?(?:table|h[1-6]|pre|p|ul|ol|dl|li|dd|dt|div|blockquote|hr|center|tr|td|th|caption)\b")


def blocks(text: str) -> str:
    """Lines to paragraphs, nested lists and preformatted text."""
    out: list[str] = []
    prefix, mode, blank = "", "", 0

    def end() -> None:
        nonlocal mode
        if mode:
            out.append(f"</{mode}>")
        mode = ""

    def same(a: str, b: str) -> int:
        return sum(1 for _ in takewhile(lambda p: p[0] == p[1], zip(a.replace(";", ":"), b.replace(";", ":"), strict=False)))

    for line in text.split("\n"):
        now = re.match(r"^[*#:;]*", line)[0] if mode != "pre" else ""
        rest = line[len(now) :].strip() if now else line
        keep = same(prefix, now)
        if now:
            end()
        for c in reversed(prefix[keep:]):
            out.append("</{1}></{0}>".format(*_LISTS[c]))
        if now and keep == len(now):
            out.append(f"</{_LISTS[prefix[keep - 1]][1]}><{_LISTS[now[-1]][1]}>")
        for i, c in enumerate(now[keep:]):
            out.append("<{0}><{1}>".format(*_LISTS[c]))
        prefix = now
        if now:
            out.append(rest)
            blank = 0
        elif _BLOCK_TAG.match(line.strip()):
            end()
            out.append(line)
            blank = 0
        elif line.startswith(" ") and line.strip():
            if mode != "pre":
                end()
                mode = "pre"
                out.append("<pre>")
            out.append(line[1:] + "\n")
        elif not line.strip():
            end()
            blank += 1
            if blank == 2:
                out.append("<p><br /></p>")
        else:
            if mode != "p":
                end()
                mode = "p"
                out.append("<p>")
            else:
                out.append("\n")
            out.append(line)
            blank = 0
    for c in reversed(prefix):
        out.append("</{1}></{0}>".format(*_LISTS[c]))
    end()
    return "".join(out)


def slugged(text: str) -> str:
    from codexmill.functions.text import transliteration

    t = str.maketrans(transliteration())
    x = re.sub(r"[^a-zA-Z0-9\-_\s.]", "", re.sub(r"<[^>]*>", "", text).translate(t))
    return re.sub(r"-+", "-", re.sub(r"[\s._]", "-", x)).strip("-").lower()


def headings(text: str) -> tuple[str, list[tuple[int, str, str, str]]]:
    """(text with headings as HTML, [(level, number, anchor, title)])."""
    seen: dict[str, int] = {}
    toc: list[tuple[int, str, str, str]] = []
    counts = [0] * 6
    used: list[int] = []

    def one(m: re.Match) -> str:
        level, title = len(m[1]), m[2].strip()
        while used and used[-1] > level:
            counts[len(used) - 1] = 0
            used.pop()
        if not used or used[-1] < level:
            used.append(level)
        counts[len(used) - 1] += 1
        number = ".".join(str(c) for c in counts[: len(used)])
        anchor = "w_" + slugged(title)
        seen[anchor] = seen.get(anchor, 0) + 1
        if seen[anchor] > 1:
            anchor += f"_{seen[anchor]}"
        toc.append((level, number, anchor, title))
        return f'<h{level} id="{anchor}">{title}</h{level}>'

    return re.sub(r"(?m)^(={1,6})(?!=)(.+?)\1\s*$", one, text), toc


def _contents(toc: list[tuple[int, str, str, str]]) -> str:
    rows = [f'<li class="toc-{min(level, TOC_LEVELS)}"><a href="#{a}">{n} {t}</a></li>' for level, n, a, t in toc if level <= TOC_LEVELS]
    return '<ul id="toc">' + "".join(rows) + "</ul>"


def shortened(url: str, length: int = 40) -> str:
    """``text.short_url`` of one string."""
    last = re.search(r"/[^/]+/?$", url)
    if len(url) <= length or not last:
        return url
    head, tail, keep = url[: last.start()], last[0], length - 3
    return f"{head}{tail[:keep]}..." if len(head) <= keep else f"{head[:keep]}...{tail}"


def links(text: str) -> str:
    from codexmill.model import BASE

    concept = BASE.rsplit("/", 1)[0] + "/concept/"

    def inner(m: re.Match) -> str:
        target, _, shown = m[1].partition("|")
        if re.match(r"(?i)(?:kategori|category):", target):
            return ""
        target = target.lstrip(":").strip()
        return f'<a href="{concept}{_html.escape((target[:1].upper() + target[1:]).replace(" ", "_"))}">{shown or target}</a>'

    def outer(m: re.Match) -> str:
        url, shown = m[1], (m[2] or "").strip()
        short = shortened(url)
        return f'<a href="{_html.escape(url)}" rel="nofollow">{shown or short}</a>'

    text = re.sub(r"\[\[([^\[\]\n]+)\]\]", inner, text)
    return re.sub(r"\[((?:https?|ftp)://[^\s\]]+)(\s[^\]\n]*)?\]", outer, text)


def categories(text: str) -> list[str]:
    """Categories that a page is in; a leading colon only links to one."""
    return [m.strip() for m in re.findall(r"\[\[(?:Kategori|Category):([^|\]]+)", text, re.IGNORECASE)]


_TEMPLATE = re.compile(r"\{\{([^{}]+)\}\}")
_PARAMETER = re.compile(r"\{\{\{([^{}|]+)(?:\|([^{}]*))?\}\}\}")


def expanded(text: str, templates: dict[str, str], within: tuple[str, ...] = ()) -> str:
    """Text with its templates in place: ``{{name|value|key=value}}``, where a
    template has ``{{{1}}}`` or ``{{{key|default}}}``. One that is not known, or
    that would expand itself, becomes a link to its page."""

    def one(m: re.Match) -> str:
        name, *args = m[1].split("|")
        name = name.strip()
        name = name[:1].upper() + name[1:]
        if name not in templates or name in within:
            return f"[[Mall:{name}]]"
        values = {}
        for a in args:
            key, given, value = a.partition("=")
            values[key.strip() if given else str(sum(k.isdigit() for k in values) + 1)] = value.strip() if given else a.strip()
        body = _PARAMETER.sub(lambda p: values.get(p[1].strip(), p[2] or ""), templates[name])
        return expanded(body, templates, (*within, name))

    return _TEMPLATE.sub(one, text)


def spacing(text: str) -> str:
    """A space before ? : ; ! % » and after « does not break."""
    return re.sub(r"(?<=«) ", "&nbsp;", re.sub(r"(?<=\S) (?=[?:;!%»](?:\s|$))", "&nbsp;", text))


def render(text: str | None, lite: bool = False, show_toc: bool = True, hooks: dict[str, Hook] | None = None, templates: dict[str, str] | None = None) -> str | None:
    """HTML of a page. ``lite`` leaves tables, contents and anchors out;
    ``hooks`` are by default the registered ones, ``templates`` are expanded."""
    if text is None:
        return None
    held: list[str] = []

    def hold(s: str) -> str:
        held.append(s)
        return f"\x7f{len(held) - 1}\x7f"

    text = text.replace("\r\n", "\n").replace("\x7f", "")
    text = re.sub(r"(?m)^[ \t]*<!--.*?-->[ \t]*\n", "", text, flags=re.DOTALL)
    text = _PROTECTED.sub(lambda m: "" if m[1] is None else hold(f"<pre>{_html.escape(m[2], quote=False)}</pre>" if m[1] == "pre" else _html.escape(m[2], quote=False)), text)
    for tag, fn in (HOOKS if hooks is None else hooks).items():
        text = re.sub(rf"<{tag}((?:\s[^<>]*)?)>(.*?)</{tag}>", lambda m, f=fn: hold(f(m[2], {a: b or c or d for a, b, c, d in _ATTR.findall(m[1])})), text, flags=re.DOTALL)
    text = expanded(text, templates) if templates else text
    text = _ENTITY.sub(_reference, sanitised(text))
    flags = {w for w in MAGIC if w in text}
    for w in flags:
        text = text.replace(w, "\x7ftoc\x7f" if w == "__TOC__" else "")
    if not lite:
        text = tables(text)
    text = re.sub(r"(?m)^-----*", "<hr />", text)
    text, toc = headings(text) if not lite else (re.sub(r"(?m)^(={1,6})(?!=)(.+?)\1\s*$", lambda m: f"<h{len(m[1])}>{m[2].strip()}</h{len(m[1])}>", text), [])
    text = "\n".join(map(emphasis, text.split("\n")))
    text = spacing(links(text))
    wanted = show_toc and "__NOTOC__" not in flags and (len(toc) >= TOC_FROM or "__FORCETOC__" in flags or "__TOC__" in flags)
    contents = _contents(toc) if wanted and toc else ""
    if "\x7ftoc\x7f" in text:
        text = text.replace("\x7ftoc\x7f", contents, 1).replace("\x7ftoc\x7f", "")
    elif contents:
        text = re.sub(r"<h[1-6] ", lambda m: contents + "\n" + m[0], text, count=1)
    text = blocks(text)
    return re.sub(r"\x7f(\d+)\x7f", lambda m: held[int(m[1])], text)


def html(text: Column | str, lite: bool = False, show_toc: bool = True, hooks: dict[str, Hook] | None = None, templates: dict[str, str] | None = None) -> Column:
    """``render`` as a column. Hooks and templates travel with the query: a
    worker knows nothing of what was registered on the driver."""
    known = dict(HOOKS) | (hooks or {})

    @F.pandas_udf(T.StringType())
    def page(t: pd.Series) -> pd.Series:
        return t.map(lambda x: render(x, lite, show_toc, known, templates), na_action="ignore")

    return page(text)


def html_lite(text: Column | str, hooks: dict[str, Hook] | None = None) -> Column:
    return html(text, lite=True, hooks=hooks)


@F.pandas_udf(T.ArrayType(T.StringType()))
def page_categories(text: pd.Series) -> pd.Series:
    return text.map(lambda x: [] if x is None else categories(x))


def slots(page: Column) -> Column:
    """ARRAY<STRUCT<slot, body>> of ``<!--start:X-->...<!--end:X-->``."""
    names = F.regexp_extract_all(page, F.lit(r"(?s)<!--start:([^>]+?)-->.*?<!--end:"), F.lit(1))
    bodies = F.regexp_extract_all(page, F.lit(r"(?s)<!--start:[^>]+?-->(.*?)<!--end:"), F.lit(1))
    return F.arrays_zip(names.alias("slot"), bodies.alias("body"))
