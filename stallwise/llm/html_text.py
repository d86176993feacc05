"""HTML to text as it would be laid out.

A tree builder reads the markup: it adds the end tags that HTML leaves out,
knows void and raw-text elements, ignores end tags that match nothing, and
closes everything at the end. A renderer then emits all visible text in reading
order:

* invisible are head, scripts, styles, templates and their like, comments, what
  `display` and `visibility` hide, all options but the selected one, the body of
  closed details, and what SVG and MathML only define or annotate;
* `display` and `visibility` cascade: the `hidden` attribute, then the page's own
  styles as far as they hold on a wide screen (`SCREEN`), by specificity and
  order, then the style attribute, then what is `!important`. Selectors are made
  of tags, classes and ids, also below one another (`div .x`, `ul > li`); rules
  with other selectors are left out. Visibility is inherited, and what is visible
  inside something invisible is shown;
* blocks begin on a new line, paragraphs, headings, lists and tables are set
  off by an empty line, `br` breaks, white space collapses except in pre;
* list items get a dash or their number and are indented by depth;
* table cells are padded to the width of their columns, also over `colspan`;
  their blocks, lists and breaks give several lines below one another, and a cell
  with `rowspan` keeps its column free in the rows that follow.

Defined cases: null and empty pages give an empty text; every input row gives
one, also those that repeat an id or have none; an empty table gives no rows;
extra columns are ignored; markup without tags is text; unclosed tags and comments run to the end; very deep nesting is handled
without recursion, except that tables nested over `DEEPEST` deep are laid out as
plain blocks.
"""

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm import common

DEEPEST = 20

#: A quote opens a value only behind an equals sign; elsewhere it is part of a name or of an unquoted value.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"?+|'([^']*+)'?+|([^\s>\"'][^\s>]*+))?+)?+", re.S)
_CSS = re.compile(r"\"(?:[^\"\\\n]|\\.)*+\"|'(?:[^'\\\n]|\\.)*+'|([{};])", re.S)
_DISPLAY = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+)\s*(!\s*important)?", re.I)
#: Width and height in pixels, what a screen is, and what it is not.
SCREEN = {"width": 1920.0, "height": 1080.0, "device-width": 1920.0, "device-height": 1080.0}
_FEATURES = {"orientation": "landscape", "hover": "hover", "any-hover": "hover", "pointer": "fine", "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "scripting": "enabled"}
_BOUND = re.compile(r"(?:([\d.]+)(px|em|rem)?\s*(<=?|>=?)\s*)?([a-z-]+)\s*(?:(<=?|>=?|=|:)\s*([\d.]+)(px|em|rem)?)?")
_COMPOUND = re.compile(r"(\*|[a-z][a-z0-9-]*)?((?:[.#][\w-]+)*)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")

_FOREIGN = frozenset(["svg", "math"])
_ONLY_DEFINED = frozenset("desc metadata defs symbol clippath mask marker pattern filter lineargradient radialgradient annotation annotation-xml mphantom".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER_SHOWN = frozenset("head script style template title noscript iframe noembed noframes object audio video canvas datalist meta link base param source track area".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead tr ul caption text foreignobject".split())
SET_OFF = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure fieldset hr menu dir".split())
LISTS = frozenset("ul ol menu dir".split())
ENDS_P = BLOCKS - frozenset("body html caption legend optgroup summary tbody td tfoot th thead tr dd dt li text foreignobject".split()) | frozenset(["summary"])
#: A start tag ends an open element of these names, up to an element that bounds it.
ENDED_BY = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "td": (frozenset(["td", "th", "caption", "colgroup"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th", "caption", "colgroup"]), frozenset(["table", "tr"])),
    "thead": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
}
_HEAD_ONLY = frozenset("title base link meta style script noscript template".split())
#: An end tag does not reach beyond these.
_SCOPES = frozenset("table td th caption html template".split())
#: Nor does the end of a paragraph that a start tag implies.
_P_SCOPES = _SCOPES | LISTS | frozenset("li dd dt button marquee object".split())
_IN_ROWS = frozenset(["table", "thead", "tbody", "tfoot", "tr"])


class Element:
    __slots__ = ("tag", "attributes", "children", "parent", "visible")

    def __init__(self, tag: str, attributes: dict[str, str], parent: "Element | None" = None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.visible: bool | None = None  # once it is known
        self.children: list[Element | str] = []


def attributes_of(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4]
        found.setdefault(m[1].lower(), html.unescape(value or ""))
    return found


def closes_itself(raw: str) -> bool:
    """Whether the slash at the end of these attributes is not part of an unquoted value."""
    last = raw.rsplit(None, 1)[-1]
    return "=" not in last or last[-2] in "\"'"


class TreeBuilder:
    """Elements from markup, with the tags that it implies."""

    def __init__(self) -> None:
        self.root = Element("html", {})
        self.open = [self.root]
        self.counts: dict[str, int] = {"html": 1}

    def build(self, page: str) -> Element:
        at = 0
        while True:
            m = _TOKEN.search(page, at)
            if m is None:
                self.text(page[at:])
                return self.root
            if m.start() > at:
                self.text(page[at : m.start()])
            at = m.end()
            if m[2]:
                tag = m[2].lower()
                if m[1]:
                    self.end(tag)
                else:
                    self.start(tag, attributes_of(m[3]) if m[3] else {})
                    if m[3].endswith("/") and any(self.counts.get(n) for n in _FOREIGN) and closes_itself(m[3]):
                        self.pop()
                    elif tag in RAW:
                        close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                        stop = close.start() if close else len(page)
                        if stop > at:
                            self.open[-1].children.append(html.unescape(page[at:stop]) if tag in ("textarea", "title") else page[at:stop])
                        self.pop()
                        at = close.end() if close else stop

    def pop(self) -> None:
        self.counts[self.open.pop().tag] -= 1

    def push(self, tag: str, attributes: dict[str, str]) -> None:
        element = Element(tag, attributes, self.open[-1])
        self.open[-1].children.append(element)
        self.open.append(element)
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def close_to(self, names: frozenset[str], bounds: frozenset[str]) -> None:
        """End the outermost open element of these names inside the innermost bound."""
        if not any(self.counts.get(n) for n in names):
            return
        outermost = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in names:
                outermost = i
            elif self.open[i].tag in bounds:
                break
        while outermost is not None and len(self.open) > outermost:
            self.pop()

    def leave_head(self) -> None:
        if self.counts.get("head"):
            self.close_to(frozenset(["head"]), frozenset(["html"]))

    def text(self, raw: str) -> None:
        if self.counts.get("head") and raw.strip():
            self.leave_head()
        self.open[-1].children.append(html.unescape(raw))

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "html":
            self.root.attributes = {**attributes, **self.root.attributes}
            return
        if tag == "body":
            self.leave_head()
            if self.counts.get("body"):
                return
        elif tag not in _HEAD_ONLY and tag != "head":
            self.leave_head()
        if tag in ENDS_P and self.counts.get("p"):
            self.close_to(frozenset(["p"]), _P_SCOPES)
        if tag in ENDED_BY:
            self.close_to(*ENDED_BY[tag])
        if any(self.counts.get(n) for n in _FOREIGN) and not self.counts.get("foreignobject"):
            if tag in _ONLY_DEFINED or attributes.get("display") == "none" or attributes.get("visibility") in ("hidden", "collapse"):
                attributes = {**attributes, "hidden": ""}
        inside = self.open[-1].tag
        if tag == "tr" and inside == "table":
            self.push("tbody", {})
        elif tag in ("td", "th") and inside in ("table", "thead", "tbody", "tfoot"):
            if inside == "table":
                self.push("tbody", {})
            self.push("tr", {})
        self.push(tag, attributes)
        if tag in VOID:
            self.pop()

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "p" and not self.counts.get("p"):
            self.start("p", {})
        if tag == "br":
            self.start("br", {})
            return
        if not self.counts.get(tag):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                while len(self.open) > i:
                    self.pop()
                return
            if self.open[i].tag in _SCOPES and tag not in _IN_ROWS and tag not in ("td", "th", "caption"):
                return


def _feature(text: str) -> bool | None:
    """Whether a media feature holds on the screen; None if that is not known."""
    name, _, value = (part.strip() for part in text.partition(":"))
    if name in _FEATURES:
        return value in ("", _FEATURES[name])
    m = _BOUND.fullmatch(text.strip())
    if not m:
        return None
    bare = m[4].removeprefix("min-").removeprefix("max-")
    if bare not in SCREEN:
        return None
    have, checks = SCREEN[bare], []
    try:
        if m[1]:
            checks.append((float(m[1]) * (16 if m[2] in ("em", "rem") else 1), m[3], have))
        if m[6]:
            sign = {"min-": ">=", "max-": "<="}.get(m[4][:4], "=") if m[5] == ":" else m[5]
            checks.append((have, sign, float(m[6]) * (16 if m[7] in ("em", "rem") else 1)))
    except ValueError:
        return None
    return all({"<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y, "=": x == y}[sign] for x, sign, y in checks)


def on_screen(media: str) -> bool:
    """Whether a media query list surely holds on a wide screen."""
    for query in media.lower().split(","):
        m = re.fullmatch(r"\s*(not\b|only\b)?\s*([a-z]+)?\s*((?:(?:\band\b|\bor\b)?\s*\([^()]*\)\s*)*)", query)
        if m is None:
            continue
        kind, found = m[2] in (None, "all", "screen"), [_feature(x) for x in re.findall(r"\(([^()]*)\)", m[3])]
        either = bool(re.search(r"\bor\b", re.sub(r"\([^()]*\)", "", m[3])))
        known = (any(x is True for x in found), not any(x is not False for x in found)) if either else (all(x is True for x in found), any(x is False for x in found))
        holds, fails = kind and known[0], not kind or known[1]
        if fails if m[1] == "not" else holds:
            return True
    return False


def holds(prelude: str) -> bool:
    """Whether the rules inside an at-rule hold on a wide screen."""
    name, _, rest = re.sub(r"[\s(]", lambda m: " " + m[0].strip(), prelude, count=1).partition(" ")
    if name.lower() == "@media":
        return not rest.strip() or on_screen(rest)
    return name.lower() == "@layer" or name.lower() == "@supports" and not re.search(r"\bnot\b", rest)


def rules_of(css: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) that hold on a wide screen."""
    css = re.sub(r"/\*.*?(?:\*/|\Z)", "", css, flags=re.S)
    frames: list[tuple[str, bool, int, list[str]]] = []  # selectors, whether they hold, style rules around, declarations
    last = 0
    for m in [*_CSS.finditer(css), None]:
        sign, at = (m[1], m.start()) if m else ("}", len(css))
        if not sign:
            continue
        text, last = css[last:at], at + 1
        if sign == "{":
            outer = frames[-1] if frames else ("", True, 0, [])
            if text.lstrip().startswith("@"):
                frames.append((outer[0], outer[1] and holds(text.strip()), outer[2], []))
            else:
                frames.append((text, outer[1], outer[2] + 1, []))
        elif frames:
            frames[-1][3].append(text)
        if sign == "}":
            # The end of the styles closes all that is open.
            for _ in range(min(len(frames), 1 if m else len(frames))):
                selectors, applies, depth, declarations = frames.pop()
                if applies and depth == 1:
                    yield selectors, ";".join(declarations)


def compounds(selector: str) -> list[tuple[str, str, frozenset[str], frozenset[str]]] | None:
    """(how it lies below the one before, tag, ids, classes) of each part, outermost first; None for other selectors."""
    out = []
    for sign, part in re.findall(r"\s*(>?)\s*([^\s>]+)", selector.strip()):
        m = _COMPOUND.fullmatch(part)
        if not m or not (m[1] or m[2]):
            return None
        names = re.findall(r"([.#])([\w-]+)", m[2])
        kinds = [frozenset(name for kind, name in names if kind == k) for k in "#."]
        out.append((sign, "" if m[1] in (None, "*") else m[1].lower(), *kinds))
    return out if out and not out[0][0] and re.sub(r"[^>]", "", selector) == "".join(sign for sign, *_ in out) else None


def _fits(element: Element, tag: str, ids: frozenset[str], classes: frozenset[str]) -> bool:
    own = element.attributes
    return (
        (not tag or tag == element.tag)
        and (not ids or ids == {own.get("id")})
        and (not classes or classes <= set(own.get("class", "").split()))
    )


class Styles:
    """What the page's styles say of display and visibility on a wide screen."""

    def __init__(self, page: str):
        # By a name of the innermost part, so that an element looks at few rules.
        self.rules: dict[str, list[tuple]] = {}
        order = 0
        for raw, block in re.findall(r"<style\b([^>]*)>(.*?)(?:</style|\Z)", page, re.S | re.I):
            media = attributes_of(raw).get("media", "").strip()
            if media and not on_screen(media):
                continue
            for selectors, body in rules_of(block):
                said = [(kind.lower(), value.lower(), bool(weight)) for kind, value, weight in _DISPLAY.findall(body)]
                for selector in selectors.split(",") if said else ():
                    parts = compounds(selector)
                    if parts:
                        order += 1
                        weight = (sum(len(p[2]) for p in parts), sum(len(p[3]) for p in parts), sum(bool(p[1]) for p in parts), order)
                        _, tag, ids, classes = parts[-1]
                        name = min(("#" + x for x in ids), default=min(("." + x for x in classes), default=tag))
                        self.rules.setdefault(name, []).append((parts, weight, said))

    def matches(self, element: Element, parts: list[tuple]) -> bool:
        """Whether the element is the innermost of these parts. Each open choice is the nearest ancestor, or one above it."""
        if not _fits(element, *parts[-1][1:]):
            return False
        todo = [(element, len(parts) - 1)]
        while todo:
            at, i = todo.pop()
            if i == 0:
                return True
            above = at.parent
            if above is None:
                continue
            if _fits(above, *parts[i - 1][1:]):
                todo.append((above, i - 1))
                if parts[i][0] or i == 1:
                    continue
            if not parts[i][0]:
                # The same part may be found further up.
                while (above := above.parent) is not None and not _fits(above, *parts[i - 1][1:]):
                    pass
                if above is not None:
                    todo.append((above, i - 1))
        return False

    def said(self, element: Element) -> dict[str, str]:
        """The winning display and visibility of an element, where something is said of them."""
        own = element.attributes
        won: dict[str, tuple] = {"display": ((False, False, (-1,)), "none")} if "hidden" in own else {}
        names = ["", element.tag, "#" + own.get("id", ""), *("." + c for c in own.get("class", "").split())] if self.rules else []
        for name in names:
            for parts, weight, said in self.rules.get(name, ()):
                if self.matches(element, parts):
                    for kind, value, important in said:
                        rank = (important, False, weight)
                        if kind not in won or rank >= won[kind][0]:
                            won[kind] = rank, value
        for kind, value, important in _DISPLAY.findall(own["style"]) if "style" in own else ():
            rank, kind = (bool(important), True, (0,)), kind.lower()
            if kind not in won or rank >= won[kind][0]:
                won[kind] = rank, value.lower()
        return {kind: value for kind, (_, value) in won.items()}


class Renderer:
    def __init__(self, styles: Styles, depth: int = 0):
        self.styles, self.depth = styles, depth
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = False  # an empty line comes before the next text
        self.indent: list[str] = []
        self.marker = ""
        self.pre = 0

    def shown(self, element: Element, parent: Element | None) -> bool:
        """Whether the element takes part in the layout; notes whether its text is visible."""
        if element.tag in NEVER_SHOWN:
            return False
        said = self.styles.said(element) if self.styles.rules or "style" in element.attributes or "hidden" in element.attributes else {}
        if said.get("display") == "none":
            return False
        visibility = said.get("visibility", "inherit")
        above = element.parent is None or element.parent.visible is not False
        element.visible = above if visibility in ("inherit", "unset", "revert") else visibility not in ("hidden", "collapse")
        if parent is not None and parent.tag == "details" and "open" not in parent.attributes:
            return element.tag == "summary"
        return True

    # Lines

    def write(self, text: str) -> None:
        if self.pre:
            first, *rest = text.split("\n")
            self.put(first)
            for line in rest:
                self.end_line(keep=True)
                self.put(line)
            return
        text = _SPACE.sub(" ", text)
        if text.startswith(" ") and (not self.now or self.now[-1].endswith(" ")):
            text = text[1:]
        self.put(text)

    def put(self, text: str) -> None:
        if text:
            self.now.append(text)

    def end_line(self, keep: bool = False) -> None:
        line = "".join(self.now).replace("\xa0", " ")
        self.now = []
        line = line.rstrip() if keep else line.strip(" ")
        if not line and not keep:
            return
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        lead = "".join(self.indent)
        if self.marker:
            lead = lead[: max(0, len(lead) - len(self.marker))] + self.marker
            self.marker = ""
        self.lines.append((lead + line).rstrip())

    # Elements

    def render(self, root: Element) -> str:
        """All visible text below the root."""
        work: list[tuple[str, Element | str, Element | None, str]] = [("node", c, root, "") for c in reversed(root.children)]
        while work:
            kind, node, parent, item = work.pop()
            if kind == "end":
                self.close(node)
            elif isinstance(node, str):
                if parent is None or parent.visible is not False and (parent.tag != "details" or "open" in parent.attributes):
                    if parent is None or parent.tag not in _IN_ROWS or node.strip():
                        self.write(node)
            elif self.shown(node, parent):
                if node.tag == "table" and self.depth < DEEPEST:
                    self.table(node)
                    continue
                if node.tag == "select":
                    self.write(chosen_option(node) if node.visible else "")
                    continue
                self.start(node, item)
                work.append(("end", node, parent, ""))
                number = start_number(node)
                children = []
                for child in node.children:
                    mark = ""
                    if isinstance(child, Element) and child.tag == "li" and node.tag in LISTS:
                        if node.tag == "ol":
                            number = whole(child.attributes.get("value"), number)
                            mark, number = f"{number}. ", number + 1
                        else:
                            mark = "- "
                        mark = mark if node.visible is not False else " " * len(mark)
                    children.append(("node", child, node, mark))
                work += reversed(children)
        self.end_line()
        return "\n".join(self.lines)

    def start(self, element: Element, item: str) -> None:
        tag = element.tag
        if tag == "br":
            self.end_line(keep=bool(self.lines or self.now))
        elif tag == "input":
            if element.visible and element.attributes.get("type", "text").lower() not in ("hidden", "checkbox", "radio", "file", "password", "image"):
                self.write(element.attributes.get("value") or element.attributes.get("placeholder", ""))
        elif tag in BLOCKS:
            self.end_line()
            # The lists inside an item follow it directly.
            self.gap |= tag in SET_OFF and not (tag in LISTS and self.indent)
            if tag == "li":
                self.indent.append(" " * len(item or "- "))
                self.marker = item or "- "
            elif tag in ("blockquote", "dd"):
                self.indent.append("  ")
            elif tag == "pre":
                self.pre += 1

    def close(self, element: Element) -> None:
        tag = element.tag
        if tag in BLOCKS:
            if tag == "pre":
                self.pre -= 1
                self.end_line(keep=bool(self.now))
            else:
                self.end_line()
            self.gap |= tag in SET_OFF and not (tag in LISTS and self.indent)
            if tag in ("li", "blockquote", "dd"):
                self.indent.pop()
                self.marker = ""

    def table(self, element: Element) -> None:
        """Rows as lines, their cells padded to the widths of the columns."""
        self.end_line()
        self.gap = True
        rows: list[tuple[int, list[tuple[list[str], int, int]]]] = []  # number of the section, cells
        captions: list[list[str]] = []
        loose: list[list[str]] = []
        section = 0
        work: list[tuple[Element | str, Element]] = [(c, element) for c in reversed(element.children)]
        while work:
            node, parent = work.pop()
            if isinstance(node, str):
                if node.strip() and parent.visible is not False:
                    loose.append([_SPACE.sub(" ", node).strip()])
            elif self.shown(node, parent):
                if node.tag in ("thead", "tbody", "tfoot"):
                    section += 1
                    work += [(c, node) for c in reversed(node.children)]
                elif node.tag == "tr":
                    rows.append((section, []))
                    work += [(c, node) for c in reversed(node.children)]
                elif node.tag in ("td", "th") and rows:
                    spans = [whole(node.attributes.get(name), 1) for name in ("colspan", "rowspan")]
                    rows[-1][1].append((self.inner(node), max(1, min(1000, spans[0])), max(0, spans[1])))
                elif node.tag == "caption":
                    captions.append(self.inner(node))
                elif node.tag not in ("col", "colgroup"):
                    holder = Element("div", {}, parent)
                    holder.children.append(node)
                    loose.append(self.inner(holder))
        for line in (line for lines in [*captions, *loose] for line in lines):
            self.now = [line]
            self.end_line(keep=bool(line))
        placed = self.placed(rows)
        widths: dict[int, int] = {}
        for wide in (False, True):  # single columns first, then those that span
            for column, lines, span in (cell for row in placed for cell in row):
                longest = max(map(len, lines), default=0)
                if span == 1 and not wide:
                    widths[column] = max(widths.get(column, 0), longest)
                elif span > 1 and wide:
                    have = sum(widths.get(c, 0) for c in range(column, column + span)) + 2 * (span - 1)
                    last = column + span - 1
                    widths[last] = widths.get(last, 0) + max(0, longest - have)
        offsets = [0]
        for column in range(max((c for row in placed for c, _, _ in row), default=0)):
            offsets.append(offsets[-1] + widths.get(column, 0) + 2)
        for row in placed:
            text = [""] * max((len(lines) for _, lines, _ in row), default=0)
            for column, lines, _ in row:
                for i, line in enumerate(lines):
                    if line:
                        text[i] = text[i].ljust(offsets[column]) + line
            if any(text):
                for line in text:
                    self.now = [line]
                    self.end_line(keep=True)
        self.gap = True

    def placed(self, rows: list[tuple[int, list[tuple[list[str], int, int]]]]) -> list[list[tuple[int, list[str], int]]]:
        """(column, lines, span) of the cells of each row; cells of earlier rows of the section hold on to their columns."""
        out, held, now = [], {}, None
        for section, cells in rows:
            if section != now:
                held, now = {}, section
            column, row, next_held = 0, [], {c: left - 1 for c, left in held.items() if left > 1}
            for lines, span, high in cells:
                while column in held:
                    column += 1
                row.append((column, lines, span))
                if high != 1:
                    next_held.update(dict.fromkeys(range(column, column + span), high - 1 if high else 1 << 30))
                column += span
            out.append(row)
            held = next_held
        return out

    def inner(self, element: Element) -> list[str]:
        """The lines of a cell; a single one without more than one space in a row."""
        lines = Renderer(self.styles, self.depth + 1).render(element).split("\n")
        return [_SPACE.sub(" ", lines[0]).strip()] if len(lines) == 1 else lines


def whole(raw: str | None, default: int) -> int:
    return int(raw) if raw and re.fullmatch(r"\s*[+-]?[0-9]{1,9}\s*", raw) else default


def start_number(element: Element) -> int:
    return whole(element.attributes.get("start"), 1) if element.tag == "ol" else 1


def chosen_option(element: Element) -> str:
    """The selected option of a list, else the first."""
    options, work = [], list(reversed(element.children))
    while work:
        node = work.pop()
        if isinstance(node, Element):
            if node.tag == "option":
                options.append(node)
            else:
                work += reversed(node.children)
    found = next((o for o in options if "selected" in o.attributes), options[0] if options else None)
    return "".join(c for c in found.children if isinstance(c, str)) if found else ""


def text_of(page: str) -> str:
    return Renderer(Styles(page)).render(TreeBuilder().build(page))


def visible_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, text."""
    markup = F.coalesce(common.column(html_col).cast("string"), F.lit(""))
    rows = pages.select(common.column(id_col).alias("page_id"), markup.alias("html"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 500):
                batch = whole_batch.slice(at, 500)
                texts = [text_of(page) for page in batch.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(texts, pa.string())], names=["page_id", "text"])

    return rows.mapInArrow(run, f"page_id {dict(rows.dtypes)['page_id']}, text string")
