"""Visible text of HTML pages: an open-element stack with implied tags, visibility rules and text layout."""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrow import map_batches, texts

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER_SHOWN = frozenset("head script style template title noscript iframe noembed noframes datalist object audio video svg canvas".split())
BLOCKS = frozenset(
    "address article aside body center details dialog dir div dl dt dd fieldset figcaption figure footer form header hgroup html"
    " legend li main menu nav ol optgroup option search section summary table caption thead tbody tfoot tr td th ul".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table hr figure menu dir listing xmp".split())
PREFORMATTED = frozenset("pre textarea listing xmp".split())
LISTS = frozenset("ul ol menu dir".split())
#: A start tag ends an open <p>.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr li listing main menu nav ol p pre search section summary table ul".split()
)
#: A start tag ends these open elements, looked for up to the given borders.
IMPLIED = {
    "li": ({"li"}, LISTS),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"html"}),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An end tag or implied end is not looked for beyond these.
SCOPES = frozenset("table td th caption html template".split())
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534
#: Lines aren't moved in further than so many levels, nor cells padded beyond so many characters: layout stays in proportion to text.
MOST_INDENTS, WIDEST = 40, 200

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|([^<]+|<)", re.S
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
BLANKS = re.compile(r"[ \t\n\f\r]+")
#: Declarations that decide what is seen, and the values that they take; others don't count.
DECLARATION = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+(?:\s+[\w-]+)*)\s*(!\s*important\s*)?(?=;|\Z)", re.I)
VALUES = {
    "visibility": frozenset("visible hidden collapse inherit initial unset revert".split()),
    "display": frozenset(
        "none block inline inline-block flex inline-flex grid inline-grid flow-root contents list-item run-in table inline-table table-row table-cell table-row-group"
        " table-header-group table-footer-group table-column table-column-group table-caption ruby ruby-text inherit initial unset revert".split()
    ),
}
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
#: A part of a selector: a tag, and ids, classes and attributes.
COMPOUND = re.compile(r"(\*|[\w-]+)?((?:[#.][\w-]+|\[\s*[\w-]+\s*(?:=\s*(?:\"[^\"]*\"|'[^']*'|[\w-]+)\s*)?\])*)")
CONDITION = re.compile(r"([#.])([\w-]+)|\[\s*([\w-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([\w-]+))\s*)?\]")
#: Comments, strings, the signs that structure a style sheet, and what lies between.
CSS = re.compile(r"/\*.*?(?:\*/|\Z)|\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|[{};]|[^{};\"'/]+|.", re.S)
#: A media query that holds on every screen.
ON_SCREEN = re.compile(r"(?:(?:only\s+)?(?:all|screen)|not\s+(?:print|speech))", re.I)


#: A stretch that a tag in search of its end passes in one go.
IN_TAG = re.compile(r"[^>\"']+|\"[^\"]*\"|'[^']*'")


class Unfinished:
    """Where tags that never end begin: what one search has passed outside quotes needs no search of its own.

    Searches that begin in different states of quoting are three at most, so a page is passed a few times in all.
    """

    def __init__(self, html: str):
        self.html, self.known = html, []

    def add(self, at: int) -> None:
        ends = [at]
        while m := IN_TAG.match(self.html, ends[-1]):
            ends.append(m.end())
        # Where a quote begins that is not closed, nothing more is known.
        quoted = [(a, b) for a, b in zip(ends, ends[1:]) if self.html[a] in "\"'"]
        self.known.append((at, ends[-1], [a for a, _ in quoted], [b for _, b in quoted]))

    def has(self, at: int) -> bool:
        for start, end, firsts, lasts in self.known:
            k = bisect_right(firsts, at) - 1
            if start < at < end and (k < 0 or at >= lasts[k]):
                return True
        return False


def tokens(html: str):
    """Yield ("text", text, None), ("start", tag, attributes) and ("end", tag, None) in order."""
    at, end, unfinished = 0, len(html), Unfinished(html)
    while at < end:
        opens = html.startswith("<", at) and html[at + 1 : at + 2].isalpha()
        if opens and unfinished.has(at):
            yield "text", "<", None
            at += 1
            continue
        m = TOKEN.match(html, at)
        if opens and m and m[4] is not None:
            unfinished.add(at)
        if m is None:
            yield "text", html[at], None
            at += 1
            continue
        at = m.end()
        if m[4] is not None:
            yield "text", unescape(m[4]) if "&" in m[4] else m[4], None
        elif m[2] is not None:
            tag = m[2].lower()
            yield "start", tag, attributes(m[3]) if m[3] else {}
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                body = html[at : close.start() if close else end]
                yield "text", unescape(body) if tag in ("textarea", "title") else body, None
                yield "end", tag, None
                at = close.end() if close else end
        elif m[1] is not None:
            yield "end", m[1].lower(), None


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def on_screen(media: str) -> bool:
    """Whether one of the queries asks for no more than a screen; those on width and the like do not count."""
    return not media.strip() or any(ON_SCREEN.fullmatch(q.strip()) for q in media.split(","))


def style_rules(css: str):
    """Yield (selectors, declarations) of the rules that hold on every screen.

    Blocks of at-rules are left out with all they contain, but for layers and media queries that a screen fulfils;
    so are rules within rules, whose selectors are not whole.
    """
    head, blocks = "", []
    for m in CSS.finditer(css):
        piece = m[0]
        if piece == "{":
            head = head.strip()
            at = re.match(r"@([\w-]+)", head)
            if blocks and blocks[-1][0] != "group":
                kind = "other"
            elif at is None:
                kind = "rule"
            else:
                name = at[1].lower()
                kind = "group" if name == "layer" or name == "media" and on_screen(head[at.end() :]) else "other"
            blocks.append((kind, head, []))
            head = ""
        elif piece == "}":
            if blocks:
                kind, selectors, declarations = blocks.pop()
                if kind == "rule":
                    yield selectors, ";".join([*declarations, head])
            head = ""
        elif piece == ";":
            if blocks:
                blocks[-1][2].append(head)
            head = ""
        else:
            head += " " if piece.startswith("/*") else piece


class Flow:
    """Text laid out in lines: collapsed spaces, gaps between blocks, indents and list marks."""

    __slots__ = ("parts", "gap", "space", "indents", "mark")

    def __init__(self):
        self.parts: list[str] = []
        self.gap, self.space, self.indents, self.mark = 0, False, [], ""

    def block(self, gap: int) -> None:
        self.gap = max(self.gap, gap)
        self.space = False

    def _begin(self) -> None:
        """Write what must stand before the next character."""
        if self.gap and self.parts:
            self.parts.append("\n" * self.gap)
            fresh = True
        else:
            fresh = not self.parts
        if fresh:
            width = len(self.mark)
            lead = "".join(self.indents[:MOST_INDENTS])
            inside = lead[: len(lead) - width] if len(self.indents) <= MOST_INDENTS else lead
            self.parts.append(inside + self.mark if self.mark else lead)
            self.mark, self.space = "", False
        self.gap = 0

    def write(self, text: str) -> None:
        if BLANKS.fullmatch(text):
            self.space = True
            return
        first, last = text[0] in " \t\n\f\r", text[-1] in " \t\n\f\r"
        self.space = self.space or first
        self._begin()
        words = " ".join(w for w in BLANKS.split(text) if w).replace("\xa0", " ")
        self.parts.append(" " + words if self.space else words)
        self.space = last

    def newline(self) -> None:
        self.space = False
        if self.parts and not self.gap:
            self.gap = 1
        elif self.parts:
            self.gap += 1

    def text(self) -> str:
        return "\n".join(line.rstrip() for line in "".join(self.parts).split("\n"))


class Table:
    __slots__ = ("rows", "spans", "cell")

    def __init__(self):
        self.rows: list[dict[int, tuple[str, int]]] = []
        self.spans: dict[int, int] = {}
        self.cell: tuple[int, int] = (1, 1)

    def row(self) -> None:
        if self.rows:
            self.spans = {c: n - 1 for c, n in self.spans.items() if n > 1}
        self.rows.append({})

    def add(self, text: str, across: int, down: int) -> None:
        """Put a cell into the first free columns of the current row."""
        if not self.rows:
            self.row()
        row, at = self.rows[-1], 0
        while at in row or at in self.spans:
            at += 1
        for c in range(at, at + across):
            row[c] = (text, across) if c == at else ("", 0)
            if down > 1:
                self.spans[c] = down

    def lines(self) -> list[str]:
        """Rows as lines of cells in aligned columns, two spaces apart; a cell across columns takes their joint width.

        A column is WIDEST characters at most; what is longer stands out and moves the rest of its line.
        """
        rows = [{c: (t.split("\n"), n) for c, (t, n) in r.items() if n} for r in self.rows if any(t for t, _ in r.values())]
        widths: dict[int, int] = {}
        for spanning in (False, True):
            for r in rows:
                for c, (ls, n) in r.items():
                    if spanning == (n > 1):
                        wide = min(WIDEST, max(map(len, ls)))
                        others = sum(widths.get(k, 0) + 2 for k in range(c, c + n - 1) if widths.get(k, 0))
                        widths[c + n - 1] = max(widths.get(c + n - 1, 0), wide - others)
                        widths.setdefault(c, 0)
        out = []
        for r in rows:
            for k in range(max(len(ls) for ls, _ in r.values())):
                line, at = [], 0
                for c in sorted(widths):
                    if c in r:
                        ls, n = r[c]
                        room = sum(widths.get(j, 0) + 2 for j in range(c, c + n) if widths.get(j, 0)) - 2
                        if room > 0:
                            line.append((ls[k] if k < len(ls) else "").ljust(room))
                        at = c + n
                    elif c >= at and widths[c]:
                        line.append(" " * widths[c])
                out.append("  ".join(line).rstrip())
        return out


def declarations(body: str) -> list[tuple[str, str, bool]]:
    """(property, value, important) of what a rule or a style attribute says about display and visibility, in order."""
    low = body.lower()
    if "display" not in low and "visibility" not in low:
        return []
    return [(p, v, bool(i)) for p, v, i in DECLARATION.findall(COMMENT.sub("", low)) if v in VALUES[p] or p == "display" and set(v.split()) <= VALUES[p]]


class Compound:
    """One part of a selector, with the part before it; the last part has the rule's declarations."""

    __slots__ = ("tag", "ids", "classes", "attributes", "before", "child", "declared")

    def __init__(self, tag: str, conditions: str):
        found = CONDITION.findall(conditions)
        self.tag = "" if tag == "*" else tag.lower()
        self.ids, self.classes = ({n for kind, n, *_ in found if kind == sign} for sign in "#.")
        self.attributes = [(name.lower(), None if not re.search("=", c) else a or b or d) for c, (kind, _, name, a, b, d) in zip(re.findall(r"[#.][\w-]+|\[[^\]]*\]", conditions), found) if name]
        self.before: Compound | None = None
        self.child = False
        self.declared: list[tuple] = []

    def key(self) -> str:
        return "#" + min(self.ids) if self.ids else "." + min(self.classes) if self.classes else self.tag or "*"

    def weight(self) -> tuple[int, int, int]:
        before = self.before.weight() if self.before else (0, 0, 0)
        return before[0] + len(self.ids), before[1] + len(self.classes) + len(self.attributes), before[2] + bool(self.tag)

    def fits(self, tag: str, attrs: dict[str, str], classes: set[str]) -> bool:
        return (not self.tag or self.tag == tag) and self.ids <= {attrs.get("id")} and self.classes <= classes and all(n in attrs and v in (None, attrs[n]) for n, v in self.attributes)


class Sheet:
    """The rules of a page's style sheets about display and visibility.

    Selectors are compounds of tags, ids, classes and attributes, with blanks or ``>`` between them; others hide nothing. Parts of a
    selector that ancestors fit go down with the elements, so an element asks for each part once, however deep it stands.
    """

    def __init__(self):
        self.parts: dict[str, list[Compound]] = {}
        self.rules = 0

    def add(self, css: str) -> None:
        for selectors, body in style_rules(css):
            if said := declarations(body):
                for selector in selectors.split(","):
                    self.rule(selector.strip(), said)

    def rule(self, selector: str, said: list[tuple[str, str, bool]]) -> None:
        parts, child = [], False
        for word in re.sub(r"\s*>\s*", " > ", selector).split():
            m = COMPOUND.fullmatch(word)
            if word == ">" and parts and not child:
                child = True
            elif m and word:
                part = Compound(m[1] or "", m[2])
                part.before, part.child, child = parts[-1] if parts else None, child, False
                parts.append(part)
            else:
                return
        if parts and not child:
            self.rules += 1
            weight = parts[-1].weight()
            parts[-1].declared = [(p, ((important, False, weight, self.rules, k), v)) for k, (p, v, important) in enumerate(said)]
            for part in parts:
                self.parts.setdefault(part.key(), []).append(part)

    def fitting(self, tag: str, attrs: dict[str, str], up: Element | None) -> list[Compound]:
        """The parts of selectors, with all that stands before them, that an element below ``up`` fits."""
        classes = set(attrs.get("class", "").split())
        own, above = (up.fits, up.above) if up else (frozenset(), frozenset())
        keys = [tag, "*", *("." + c for c in classes), *(["#" + attrs["id"]] if "id" in attrs else [])]
        return [p for k in keys for p in self.parts.get(k, ()) if (not p.before or p.before in (own if p.child else above)) and p.fits(tag, attrs, classes)]


class Element:
    __slots__ = ("tag", "shown", "gone", "pre", "flow", "table", "count", "indented", "fits", "above")

    def __init__(self, tag: str, shown: bool, gone: bool, pre: bool):
        self.tag, self.shown, self.gone, self.pre = tag, shown, gone, pre
        self.flow: Flow | None = None
        self.table: Table | None = None
        self.count = 1
        self.indented = False
        #: Parts of selectors that the element fits, and that it or an element around it fits.
        self.fits: frozenset = frozenset()
        self.above: frozenset = frozenset()


def _number(value: str | None, default: int, most: int) -> int:
    m = re.match(r"\s*(-?\d{1,9})", value or "")
    return min(int(m[1]), most) if m else default


class Renderer:
    """Builds the stack of open elements token by token and writes text where it is shown."""

    def __init__(self):
        self.flow = Flow()
        self.open: list[Element] = []
        #: Of each tag, where in ``open`` its elements stand.
        self.places: dict[str, list[int]] = {}
        self.sheet = Sheet()

    def feed(self, html: str) -> str:
        if re.search("<style", html, re.I):
            self.stylesheets(html)
        for kind, value, attrs in tokens(html):
            if kind == "text":
                self.on_text(value)
            elif kind == "start":
                self.start(value, attrs)
            else:
                self.end(value)
        while self.open:
            self.pop()
        return self.flow.text()

    def on_text(self, text: str) -> None:
        top = self.open[-1] if self.open else None
        if top is None or top.shown and not top.gone and not (top.tag == "details" and top.count == 0):
            if top is not None and top.pre:
                lines = text.replace("\r\n", "\n").split("\n")
                for i, line in enumerate(lines):
                    if i:
                        self.flow.newline()
                    if line:
                        self.flow._begin()
                        self.flow.parts.append(line)
            elif text:
                self.flow.write(text)

    def stylesheets(self, html: str) -> None:
        """Read the rules of all style sheets for a screen first, as they hold for the whole page."""
        inert = {"noscript": 0, "template": 0}
        css = False
        for kind, value, attrs in tokens(html):
            if kind == "text":
                if css:
                    self.sheet.add(value)
            elif value in inert:
                inert[value] = max(0, inert[value] + (1 if kind == "start" else -1))
            else:
                css = kind == "start" and value == "style" and on_screen(attrs.get("media", "")) and not any(inert.values())

    def styled(self, tag: str, attrs: dict[str, str], up: Element | None) -> tuple[str | None, str | None, list[Compound]]:
        """(display, visibility, parts of selectors that the element fits); None where nothing is said.

        Of all declarations the important ones come first, then those of the style attribute, then those of the more specific
        selector, then the later ones.
        """
        parts = self.sheet.fitting(tag, attrs, up) if self.sheet.rules else []
        best: dict[str, tuple] = {}
        own = [(p, ((important, True, (0, 0, 0), 0, k), v)) for k, (p, v, important) in enumerate(declarations(attrs["style"]))] if "style" in attrs else []
        for p, said in own + [d for part in parts for d in part.declared]:
            if p not in best or said[0] > best[p][0]:
                best[p] = said
        return *(best[p][1] if p in best else None for p in ("display", "visibility")), parts

    def nearest(self, tags) -> int:
        """Where the innermost open element with one of the tags stands; -1 without one."""
        return max([places[-1] for t in tags if (places := self.places.get(t))], default=-1)

    def close_implied(self, targets, borders) -> None:
        while (i := self.nearest(targets)) > self.nearest(borders):
            while len(self.open) > i:
                self.pop()

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in ENDS_P:
            self.close_implied({"p"}, SCOPES | {"button"})
        if tag in IMPLIED:
            self.close_implied(*IMPLIED[tag])
        elif tag in HEADINGS and self.open and self.open[-1].tag in HEADINGS:
            self.pop()
        up = self.open[-1] if self.open else None
        if tag in ("td", "th") and not (up and up.tag == "tr"):
            if not self.places.get("table"):
                return
            self.start("tr", {})
            up = self.open[-1]
        display, visibility, fits = self.styled(tag, attrs, up)
        # What is hidden by itself, unless the page says how it is to be displayed.
        closed = "hidden" in attrs or tag == "dialog" and "open" not in attrs
        gone = (up.gone if up else False) or tag in NEVER_SHOWN or display == "none" or closed and display in (None, "revert")
        shown = up.shown if up else True
        if visibility is not None and visibility not in ("inherit", "unset", "revert"):
            shown = visibility in ("visible", "initial")
        if up and up.tag == "details" and up.count == 0 and tag != "summary":
            gone = True
        if tag == "br":
            if shown and not gone:
                self.flow.newline()
            return
        if tag in VOID:
            if tag == "hr":
                self.flow.block(2)
            return
        e = Element(tag, shown, gone, (up.pre if up else False) or tag in PREFORMATTED)
        if fits or up:
            e.fits = frozenset(fits)
            e.above = (up.above if up else frozenset()).union(e.fits) if fits else up.above
        if tag == "details" and "open" not in attrs:
            e.count = 0
        visible = shown and not gone
        if visible:
            nested = tag in LISTS and self.places.get("li")
            if tag in SPACED and not nested:
                self.flow.block(2)
            elif tag in BLOCKS:
                self.flow.block(1)
        if tag == "ol":
            e.count = _number(attrs.get("start"), 1, 1 << 30)
        if tag in ("li", "dd", "blockquote") and visible:
            mark = "  "
            if tag == "li":
                parent = self.open[at] if (at := self.nearest(LISTS)) >= 0 else None
                mark = "- "
                if parent and parent.tag == "ol":
                    parent.count = _number(attrs.get("value"), parent.count, 1 << 30)
                    mark = f"{parent.count}. "
                    parent.count += 1
            self.flow.indents.append(" " * len(mark))
            self.flow.mark = mark if tag == "li" else ""
            e.indented = True
        if tag == "table":
            e.table = Table()
        elif tag == "tr":
            if table := self.table():
                table.row()
        elif tag in ("td", "th"):
            e.flow, self.flow = self.flow, Flow()
            e.count = min(_number(attrs.get("colspan"), 1, MAX_COLSPAN), MAX_COLSPAN)
            e.indented = False
            e.table = None
            if table := self.table():
                table.cell = (max(1, e.count), max(1, _number(attrs.get("rowspan"), 1, MAX_ROWSPAN)))
            e.count = table.cell[0] * (MAX_ROWSPAN + 1) + table.cell[1] if table else MAX_ROWSPAN + 2
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(e)

    def table(self) -> Table | None:
        places = self.places.get("table")
        return self.open[places[-1]].table if places else None

    def pop(self) -> None:
        e = self.open.pop()
        self.places[e.tag].pop()
        visible = e.shown and not e.gone
        if e.flow is not None:
            text, self.flow = self.flow.text(), e.flow
            if table := self.table():
                across, down = divmod(e.count, MAX_ROWSPAN + 1)
                table.add(text, across, down)
            return
        if e.indented:
            self.flow.indents.pop()
            self.flow.mark = ""
        if e.table is not None:
            for line in e.table.lines():
                self.flow.block(1)
                self.flow._begin()
                self.flow.parts.append(line)
        if visible:
            nested = e.tag in LISTS and self.places.get("li")
            if e.tag in SPACED and not nested:
                self.flow.block(2)
            elif e.tag in BLOCKS:
                self.flow.block(1)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
            return
        if tag == "p" and not self.places.get("p"):
            self.flow.block(2)
            return
        borders = set() if tag == "table" else {"table"} if tag in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else SCOPES - {tag}
        i = self.nearest(HEADINGS if tag in HEADINGS else (tag,))
        if i > self.nearest(borders):
            while len(self.open) > i:
                self.pop()


def visible_text(html: str | None) -> str:
    """All text a reader of the page sees, laid out in lines."""
    return Renderer().feed(html) if html else ""


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: the id and the visible ``text``.

    Each Arrow batch is rendered where it lies; there is no shuffle. Elements stay on an explicit stack, so
    nesting of any depth works, and text is written once.

    Time and output grow in proportion to the page, but for indents of 40 levels and padding to 200 characters at most.

    Defined cases: null and empty pages give the empty text; broken markup never fails (an unfinished tag
    is text, unknown end tags are ignored, open elements end with the page); ids may be null and rows may
    repeat; an empty table gives no rows; further columns are dropped.
    """

    def render(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = pa.array([visible_text(h) for h in texts(batch.column(1))], pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), out], names=["id", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    made = map_batches(pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html")), render, f"id {kind}, text string")
    return made.select(F.col("id").alias(id_col), "text")
