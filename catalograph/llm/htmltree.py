"""Parse a page into a tree of blocks: a small helper of the wrapper inference."""

from __future__ import annotations

import re
from html import unescape

# Names of HTML elements by kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol p pre search section summary "
    "table tbody td template tfoot th thead tr ul".split()
)
# Inline elements whose text is no running text.
CONTROLS = set("button select option optgroup datalist label output svg canvas object audio video map".split())
# What an opening tag ends, and the elements beyond which it ends nothing.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
# Elements whose end tag does not reach beyond a container.
WEAK = set("p li dt dd h1 h2 h3 h4 h5 h6 tr td th".split())
CONTAINER = set("article aside body details dialog div dl fieldset footer form header html main menu nav ol section table ul blockquote".split())

# Words of class, id and role that mark what is not the article.
CHROME_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert toast popup modal overlay newsletter subscribe subscription signup signin login register "
    "comment comments reply replies disqus discussion respond sidebar aside menu nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager footer header masthead topbar toolbar share sharing social related recommended recommendations widget "
    "skip copyright legal disclaimer contentinfo complementary search searchbox dialog tooltip".split()
)
# Words that say nothing beside one of these: "site-header" is a header, "related-work" is not "related".
PLAIN_WORDS = set(
    "area bar block bottom box btn button buttons container content form global icon icons inner item items left link links list main mobile "
    "page panel post posts primary right secondary section site story stories top widgets wrap wrapper".split()
)
# Elements that hold running text, where an id is only a place to link to.
ANCHORED = set("h1 h2 h3 h4 h5 h6 hgroup p blockquote pre li dt dd td th".split())
# Words of parts that are never the article, however long.
FOREIGN = set("comment comments reply replies disqus discussion respond ad ads advert adverts advertisement advertising sponsored promo related teaser widget".split())
CHROME_TAGS = set("nav footer aside form header noscript template dialog menu search fieldset legend head".split()) | CONTROLS
MAIN_TAGS = ("article", "main")
MAIN_WORDS = set("article main content post entry story".split())
# Words that tell a teaser, an advert or a comment from the article itself.
NOT_MAIN = set("comment reply ad advert advertisement sponsored promo related teaser widget".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*>|[^>]*(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/>\"']+)")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Block:
    """An element with its blocks and runs of text in page order; ``links`` counts linked characters."""

    __slots__ = ("tag", "name", "words", "marks", "anchor", "hidden", "kids", "links", "chars", "holds")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.kids, self.links = tag, [], 0
        self.words: set[str] = set()
        self.marks: set[str] = set()  # chrome words of class and role
        self.anchor: set[str] = set()  # chrome words of the id
        self.chars = 0  # unlinked characters, with those of all blocks inside
        self.holds = False  # the article is inside
        self.hidden, self.name = False, tag
        if attributes.strip(" />"):
            found = {(m[1] or m[5]).lower(): next((v for v in m.groups()[1:4] if v is not None), "") for m in _ATTRIBUTE.finditer(attributes)}
            marks = [found.get(k, "") for k in ("class", "id", "role")]
            self.words = {w.lower() for mark in marks for w in _WORD.findall(mark)}
            if self.words & CHROME_WORDS:
                self.marks = _chrome_words(marks[0]) | _chrome_words(marks[2])
                self.anchor = set() if tag in ANCHORED or tag not in BLOCK else _chrome_words(marks[1])
            self.hidden = "hidden" in found or found.get("aria-hidden") == "true" or bool(_HIDDEN.search(found.get("style", "")))
            steady = sorted({w for w in marks[0].split() + marks[2].split() if not any(c.isdigit() for c in w)})
            self.name = ".".join([tag, *steady])

    @property
    def main(self) -> bool:
        return (self.tag in MAIN_TAGS or bool(self.words & MAIN_WORDS)) and not self.chrome

    @property
    def chrome(self) -> bool:
        """Menu, header, footer, sidebar, notice, advert, form, comment or hidden."""
        if self.holds or self.tag in ("html", "body"):
            return False
        if self.hidden:
            return True
        if self.tag in MAIN_TAGS:
            return bool(self.words & NOT_MAIN)
        return self.tag in CHROME_TAGS or bool(self.marks) or bool(self.anchor)


def key(block: Block) -> str:
    """A block's name with its mark: blocks of one key are all chrome, all main or neither."""
    if block.chrome:
        return block.name + (".:chrome" if may_hold(block) else ".:never")
    return block.name + (".:main" if block.main and block.tag not in MAIN_TAGS else "")


def _chrome_words(mark: str) -> set[str]:
    """Chrome words among the tokens of a class, id or role: a token counts as a whole, or if
    all its parts are such words or plain ones."""
    out = set()
    for token in mark.split():
        parts = {w.lower() for w in _WORD.findall(token) if not w.isdigit()}
        found = {token.lower()} & CHROME_WORDS or parts & CHROME_WORDS
        if found and (token.lower() in CHROME_WORDS or parts <= CHROME_WORDS | PLAIN_WORDS):
            out |= found
    return out


def _settle(blocks: list[tuple[Block, Block]]) -> None:
    """Count unlinked text, and see that nothing around the article is taken for chrome.

    ``blocks`` are all blocks with their parents in page order.
    """
    bearing = set()  # blocks with running text of their own or inside
    own = {}
    for block, parent in reversed(blocks):
        own[block] = max(0, sum(len(" ".join("".join(kid).split())) for kid in block.kids if isinstance(kid, list)) - block.links)
        block.chars += own[block]
        if own[block] and not re.fullmatch("h[1-6]|hgroup|header", block.tag):
            bearing.add(block)
        if block in bearing and (block.tag == "section" or "section" in block.name.split(".")):
            block.anchor = set()  # a part of a text, named after its heading
        parent.chars += block.chars
        if block in bearing and not block.chrome:
            bearing.add(parent)
    above = dict(blocks)
    marked: dict[Block, bool] = {}  # blocks in chrome
    plain = 0  # unlinked characters outside it
    for block, parent in blocks:
        marked[block] = block.chrome or marked.get(parent, False)
        plain += 0 if marked[block] else own[block]

    def around(block: Block) -> list[Block]:
        out = []
        while block in above:
            block = above[block]
            out.append(block)
        return out

    best, most = None, (False, -1)
    for block, parent in blocks:
        # An article in chrome counts if there is no more text outside.
        if block.tag in MAIN_TAGS and not block.chrome and (not marked[block] or block.chars >= plain):
            value = (not any(b.hidden for b in around(block)), block.chars * (1 if marked[block] else 2))
            if value > most:
                best, most = block, value
    outer = around(best) if best else []
    for block in outer:
        block.holds = True
    # What has most of the text there, and is no comment or advert, is around it.
    inside, whole = {best or above[blocks[0][0]]} if blocks else set(), best.chars if best else sum(own.values())
    for block, parent in blocks:
        if parent in inside:
            inside.add(block)
            if block.chrome and block.chars * 2 > whole and may_hold(block):
                block.holds = best is not None or block.tag in ("form", "fieldset")


def may_hold(block: Block) -> bool:
    """Whether a block marked as chrome could hold the article."""
    tags = CHROME_TAGS - {"form", "fieldset"}
    return not block.hidden and block.tag not in tags and not (block.marks | block.anchor) & FOREIGN


def parse(html: str) -> Block:
    """The page's blocks. Open elements end with the page; tags cut off at its end are dropped."""
    root = Block("#page")
    stack = [root]
    blocks: list[tuple[Block, Block]] = []
    at, linked, size = 0, 0, len(html)

    def text(raw: str) -> None:
        if raw:
            raw = unescape(raw) if "&" in raw else raw
            kids = stack[-1].kids
            if kids and isinstance(kids[-1], list):
                kids[-1].append(raw)
            else:
                kids.append([raw])
            if linked:
                stack[-1].links += len(raw)

    def end_open(names: set[str], beyond: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                del stack[k:]
                return
            if stack[k].tag in beyond:
                return

    while at < size:
        found = _TAG.search(html, at)
        if found is None:
            text(html[at:])
            break
        text(html[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        rest = found[3]
        if not rest.endswith(">"):
            break
        if found[1]:
            if tag == "a":
                linked = max(0, linked - 1)
            if tag in BLOCK or tag in CONTROLS or any(b.tag == tag for b in stack[-3:]):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
                    if tag not in CONTAINER and (stack[k].tag in CONTAINER if tag in WEAK else stack[k].tag in BLOCK):
                        break
            continue
        if tag in RAW:
            if rest.endswith("/>") and tag not in ("script", "style", "title", "textarea"):
                continue
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            at = size if close is None else close.start()
            continue
        if tag in VOID:
            if tag == "br" or tag == "hr":
                text(" ")
            if tag == "hr":
                stack[-1].kids.append(Block("hr"))
            continue
        if tag == "a":
            linked += 1
        if tag in BLOCK:
            if tag not in ("html", "head"):
                end_open({"p"}, CONTAINER)
            if tag in ENDS:
                end_open(*ENDS[tag])
            if tag[0] == "h" and tag[1:].isdigit():
                end_open({"h1", "h2", "h3", "h4", "h5", "h6"}, CONTAINER)
            linked = 0 if tag in CONTAINER else linked
            block = Block(tag, rest[:-1])
        elif tag in CONTROLS or "=" in rest:
            block = Block(tag, rest[:-1])
            if not block.chrome:
                continue  # an inline element: its text belongs to the block
        else:
            continue
        stack[-1].kids.append(block)
        blocks.append((block, stack[-1]))
        if not rest.endswith("/>") or tag in BLOCK:
            stack.append(block)
    _settle(blocks)
    return root


def shown(block: Block, in_article: bool) -> list[str]:
    """Texts of a block's parts in page order, without what is not the article."""
    out, inline = [], ""
    for kid in block.kids:
        if isinstance(kid, list):
            inline += "".join(kid)
            continue
        if kid.tag not in BLOCK and not kid.holds:  # an inline part that is left out
            continue
        out.append(inline)
        inline = ""
        if not kid.chrome:
            out += shown(kid, in_article)
        elif in_article and (kid.tag == "header" or "header" in kid.words) and not kid.hidden:
            out += headings(kid)
    out.append(inline)
    return [t for t in (" ".join(x.split()) for x in out) if t]


def headings(block: Block) -> list[str]:
    """The headings in an article's own header."""
    out = []
    for kid in block.kids:
        if isinstance(kid, Block):
            out += shown(kid, True) if re.fullmatch("h[1-6]", kid.tag) else headings(kid)
    return out
