"""Pages as blocks of text: a forgiving reader of HTML, and what its marks say about each block.

A page is read once, from left to right, in time linear in its length. The result is a list of elements
(parent, name with class and id, whether its marks call it boilerplate) and a list of text blocks.
"""

from __future__ import annotations

import html
import re
from collections import Counter

#: Elements whose content is never text of the page; it is skipped unread.
SKIPPED = frozenset("script style noscript template textarea title iframe object svg math select button canvas audio video datalist".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead
tr ul""".split())
#: Elements that hold one paragraph or item; the element around them is the block's container.
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre td th tr tbody thead tfoot table figure figcaption".split())
HEADING = frozenset(("h1", "h2"))
#: A new element of this name ends open ones of the group in the same list or table row.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"),
        **{name: ("tr", "tbody", "thead", "tfoot") for name in ("tbody", "thead", "tfoot")}}
LIST = frozenset("ul ol menu dl table tr".split())
#: An end tag does not close elements beyond these, unless it is theirs.
BORDER = frozenset("article main body html table td th".split())
BOILERPLATE_TAG = frozenset("nav footer aside form head menu dialog fieldset".split())
BOILERPLATE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu".split())
#: Words of class and id names. Reader comments may hold articles of their own, so they are a list apart.
COMMENT_WORDS = frozenset("comment comments commentlist respond reply replies discussion disqus feedback reactions".split())
BOILERPLATE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo
promotion promoted nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager topbar toolbar skip sidebar
sidebars aside rail widget widgets related recommended recommendations trending popular teaser teasers notice notices cookie
cookies consent gdpr alert disclaimer legal copyright privacy announcement popup modal overlay paywall subscribe subscription newsletter
signup login signin register share sharing social follow footer form search searchbox masthead""".split())
HEADER_WORDS = frozenset(("header", "site", "page", "top"))
OWN_HEADER = frozenset(("article", "entry", "post", "content", "story"))

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:"[^"]*"|'[^']*')|=)*+)>|<[!?][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_DIGITS = re.compile(r"[0-9]+")


def _marks(name: str, attributes: str, inside_article: bool):
    """``(key, own, comment)``: name with class and id (numbers as one sign), and whether the element is
    boilerplate by its own marks, or holds reader comments."""
    own, comment = name in BOILERPLATE_TAG or (name == "header" and not inside_article), False
    if not attributes.strip():
        return name, own, comment
    found = {}
    for a, x, y, z in _ATTRIBUTE.findall(attributes):
        found.setdefault(a.lower(), html.unescape(x or y or z))
    label = found.get("class", "") + " " + found.get("id", "")
    words, skip = set(), False
    for part in re.split(r"[^A-Za-z0-9]+", label):
        for word in _WORD.findall(part):
            word = word.lower()
            if not skip:
                words.add(word)
            skip = word in ("no", "has", "with", "without")
    if name not in ("html", "body", "main"):
        comment = bool(words & COMMENT_WORDS)
        own = (own or comment or bool(words & BOILERPLATE_WORDS) or found.get("role", "").lower() in BOILERPLATE_ROLE
               or ("header" in words and not inside_article and not words & OWN_HEADER))
        if "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower():
            own = True
    return name + "." + _DIGITS.sub("#", label.strip()), own, comment


class Page:
    """``keys``, ``parents``, ``names``, ``dropped``, ``article`` of the elements and ``blocks``
    ``(text, element, characters in links)`` of a page, in page order."""

    def __init__(self, source: str):
        self.keys, self.parents, self.names = [""], [0], [""]
        self._own, self._comment, self.article = [False], [False], [False]
        self.blocks = []
        self.starts = []  # (element, number of blocks before it)
        self._read(source)
        self._settle()

    def _read(self, source: str) -> None:
        stack, text, links, link_depth = [0], [], 0, 0
        names, article = self.names, self.article
        # open elements by name, up to the nearest border and within the nearest list: what is not open needs no search
        borders, lists = [Counter()], [Counter()]

        def flush():
            nonlocal links
            if text:
                line = " ".join(html.unescape("".join(text)).split())
                if line:
                    self.blocks.append((line, stack[-1], links))
                text.clear()
            links = 0

        def close(wanted):
            """Close elements up to one whose name is in ``wanted`` (one is open)."""
            nonlocal link_depth
            name = None
            while name not in wanted:
                name = names[stack.pop()]
                borders[-1][name] -= 1
                lists[-1][name] -= 1
                if name in BORDER:
                    borders.pop()
                if name in LIST:
                    lists.pop()
            if len(stack) < link_depth:
                link_depth = 0

        end = source.rfind(">") + 1
        at = 0
        while at < end:
            m = _TAG.search(source, at, end)
            if m is None:
                break
            if m.start() > at:
                piece = source[at:m.start()]
                text.append(piece)
                if link_depth:
                    links += len(piece)
            at = m.end()
            name = m.group(2)
            if name is None:
                continue
            name = name.lower()
            if m.group(1):
                if name == "a":
                    link_depth = 0
                elif name in BLOCK:
                    flush()
                    if borders[-1][name] > 0:
                        close((name,))
            elif name in SKIPPED:
                if not m.group(3).endswith("/"):
                    over = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, at)
                    at = over.end() if over else len(source)
            elif name == "a":
                link_depth = len(stack)
            elif name == "br":
                text.append(" ")
            elif name == "hr":
                flush()
            elif name in BLOCK:
                flush()
                if names[stack[-1]] == "p":
                    close(("p",))
                group = ENDS.get(name, ())
                while any(lists[-1][g] > 0 for g in group):
                    close(group)
                if m.group(3).endswith("/"):
                    continue
                parent = stack[-1]
                key, own, comment = _marks(name, m.group(3), article[parent])
                names.append(name), self.keys.append(key), self.parents.append(parent)
                self._own.append(own), self._comment.append(comment)
                article.append(article[parent] or (name in ("article", "main") and not own))
                stack.append(len(names) - 1)
                self.starts.append((len(names) - 1, len(self.blocks)))
                if name in BORDER:
                    borders.append(Counter())
                if name in LIST:
                    lists.append(Counter())
                borders[-1][name] += 1
                lists[-1][name] += 1
        if at < len(source):
            text.append(source[at:])
        flush()

    def _settle(self) -> None:
        """What is dropped: everything under an element with boilerplate marks, unless the page's main
        element (or first article, or, for marks of comments, its headline) is inside it."""
        n = len(self.names)
        core, headline = [False] * n, [False] * n
        seen = False
        for i in range(1, n):
            if self.names[i] == "main" or (self.names[i] == "article" and not self._own[i] and not seen):
                core[i], seen = True, seen or self.names[i] == "article"
                headline[i] = self.names[i] == "main"
            headline[i] = headline[i] or self.names[i] == "h1"
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            core[p] |= core[i]
            headline[p] |= headline[i]
        self.dropped = [False] * n
        for i in range(1, n):
            own = self._own[i]
            if own and self.names[i] not in BOILERPLATE_TAG:
                own = not (headline[i] and core[i] if self._comment[i] else core[i] and self.names[i] != "article")
            self.dropped[i] = own or self.dropped[self.parents[i]]

    def container(self, element: int) -> int:
        """The nearest element around that is more than a paragraph or an item."""
        while element and self.names[element] in LEAF:
            element = self.parents[element]
        return element
