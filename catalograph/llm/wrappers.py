"""Extract main text with wrappers inferred from the pages of a host.

A wrapper is a union-free regular expression over the page's blocks: elements, slots for
text that differs between pages, optional groups ``( )?`` and repeated groups ``( )+``. It
is inferred by alignment. A page's own blocks are folded first, neighbours of the same
kind into a repeated group. Then pages are aligned one after the other: where names match,
the alignment goes on inside; text that differs becomes a slot; elements of one tag in the same
place match with the classes that they share; what only one side has becomes optional. Two wrappers align in the same way, so every task infers wrappers of its
own pages and these are merged per host, in two levels so that a host of any size is
spread over tasks. A wrapper holds long texts as hashes, and where it has more than
``GROUPS`` groups, or a list more than ``WIDE``, groups of one name or kind become one: it
does not grow with the number of pages.

The wrapper tells where the article is: its ``article`` or ``main`` element, or one named
so, with the most text; else the block that holds the most text in slots, outside menus,
headers, footers, sidebars, notices, adverts, forms and comments, link lists and text that
all pages share. From every page the blocks at that place are taken, without such parts.
A page that has nothing at that place is its own wrapper.

Defined cases: a null or empty page has an empty text; a page without a host is its own
wrapper; a page cut off in the middle gives the text up to there, without the tag cut off;
repeated pages give the same text; an empty table gives an empty result; other columns are
kept beside the new ``main_text``, which replaces one of that name.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm.common import written
from catalograph.llm.htmltree import Block, key, may_hold, parse, shown

MERGED = 64  # parts in which a host's wrappers are merged first
HELD = 2000  # hosts a task holds wrappers of at once
WIDE = 100  # groups in a list from which on those of one name become one
GROUPS = 5000  # groups of a wrapper from which on its lists are made shorter
LITERAL = 80  # characters up to which a wrapper holds a text itself
SHARED = 3  # pages from which on equal text counts as the template's

# A group: [name with mark, seen, repeated, chrome, main, characters, linked, groups inside].
# Of a text, the name is "#" and the last item the text, or None for a slot. Chrome is 2
# where the article cannot be inside.
NAME, SEEN, REPEATED, CHROME, MAIN, CHARS, LINKED, INSIDE = range(8)


def host(url: Column) -> Column:
    """Host of a URL without port; null when it has none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def _short(text: str) -> str:
    """A text that tells the same whether two are equal, of bounded length."""
    return text if len(text) <= LITERAL else f"{text[:40]}... {hashlib.md5(text.encode('utf-8', 'replace')).hexdigest()}"


def group_of(block: Block) -> list:
    inside = []
    for kid in block.kids:
        if isinstance(kid, list):
            text = " ".join("".join(kid).split())
            if text:
                inside.append(["#", 1, False, 0, False, len(text), 0, _short(text)])
        elif kid.tag not in ("head", "hr"):
            inside.append(group_of(kid))
    chars = sum(g[CHARS] for g in inside)
    linked = block.links + sum(g[LINKED] for g in inside)
    chrome = 0 if not block.chrome else 1 if may_hold(block) else 2
    return [key(block), 1, False, chrome, block.main, chars, min(linked, chars), folded(inside)]


def folded(groups: list[list]) -> list[list]:
    """Neighbours of one name, alone or in pairs, become one repeated group."""
    out: list[list] = []
    for group in groups:
        if out and _same(out[-1], group):
            out[-1] = merged(out[-1], group)
            out[-1][REPEATED] = True
        elif len(out) >= 3 and _same(out[-3], out[-1]) and _same(out[-2], group):
            # a b a b: the second pair goes into the first.
            last = out.pop()
            out[-2], out[-1] = merged(out[-2], last), merged(out[-1], group)
            out[-2][REPEATED] = out[-1][REPEATED] = True
        else:
            out.append(group)
    return narrowed(out, WIDE)


def _same(a: list, b: list) -> bool:
    # Groups named by tag only, of one page each, are different parts of it.
    return a[NAME] == b[NAME] != "#" and (a[REPEATED] or b[REPEATED] or not a[NAME].endswith(".*"))


def narrowed(groups: list[list], wide: int) -> list[list]:
    """At most ``wide`` groups if names or, failing that, tags and marks are so few: those that
    agree become one repeated group where the first stands."""
    for label in (lambda g: g[NAME], kind):
        if len(groups) <= wide:
            return groups
        out: dict[str, list] = {}
        for group in groups:
            one = label(group)
            if one in out:
                out[one] = merged(out[one], group)
                out[one][REPEATED] = True
            else:
                out[one] = group
        groups = list(out.values())
    return groups


def kind(group: list) -> str:
    """A group's tag and mark."""
    parts = group[NAME].split(".")
    return ".".join([parts[0], *(p for p in parts[1:] if p[:1] == ":")])


def named(a: str, b: str) -> str:
    """The name of two groups of one kind: the classes of both, open to others."""
    if a == b:
        return a
    first, there = a.split("."), set(b.split(".")[1:])
    return ".".join([first[0], *(c for c in first[1:] if c in there and c != "*"), "*"])


def merged(a: list, b: list) -> list:
    """One group for two of the same kind."""
    if a[NAME] == "#":
        inside = a[INSIDE] if a[INSIDE] == b[INSIDE] else None
    else:
        inside = aligned(a[INSIDE], b[INSIDE])
    name = named(a[NAME], b[NAME])
    return [name, a[SEEN] + b[SEEN], a[REPEATED] or b[REPEATED], max(a[CHROME], b[CHROME]), a[MAIN] or b[MAIN], a[CHARS] + b[CHARS], a[LINKED] + b[LINKED], inside]


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of the longest common run, ended by the two lengths."""
    end = (len(a), len(b))
    first = 0
    while first < min(end) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(end) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    x, y = a[first : len(a) - last], b[first : len(b) - last]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [(k, k) for k in range(first)], 0, 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            out.append((first + i, first + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out + [(len(a) - k, len(b) - k) for k in range(last, -1, -1)]


def _zipped(a: list[list], b: list[list], label, rest) -> list[list]:
    """Groups of the common run of labels merged, between them what ``rest`` makes of both sides."""
    out, i, j = [], 0, 0
    for x, y in _common([label(g) for g in a], [label(g) for g in b]):
        out += rest(a[i:x], b[j:y])
        if x < len(a):
            out.append(merged(a[x], b[y]))
        i, j = x + 1, y + 1
    return out


def aligned(a: list[list], b: list[list]) -> list[list]:
    """Both lists as one: the longest common run of names is merged; between these, groups of
    one kind in the same place. The rest stays as it is and is optional from then on, being
    seen less often than what holds it."""
    if [g[NAME] for g in a] == [g[NAME] for g in b]:
        return [merged(x, y) for x, y in zip(a, b)]
    by_kind = lambda x, y: _zipped(x, y, kind, lambda u, v: u + v) if x and y else x + y
    return folded(_zipped(a, b, lambda g: g[NAME], by_kind))


def size(group: list) -> int:
    return 1 + sum(size(g) for g in group[INSIDE]) if group[NAME] != "#" else 1


def bounded(wrapper: list) -> list:
    """A wrapper of more than ``GROUPS`` groups with shorter lists of groups, by name or kind."""
    wide = WIDE
    while wide > 1 and size(wrapper) > GROUPS:
        wide //= 2
        wrapper = _bounded(wrapper, wide)
    return wrapper


def _bounded(group: list, wide: int) -> list:
    if group[NAME] == "#":
        return group
    return [*group[:INSIDE], [_bounded(g, wide) for g in narrowed(group[INSIDE], wide)]]


def expression(group: list, within: int | None = None) -> str:
    """A wrapper as a regular expression over tags; ``#`` is a slot."""
    if group[NAME] == "#":
        out = "#" if group[INSIDE] is None else json.dumps(group[INSIDE], ensure_ascii=False)
    else:
        out = f"<{group[NAME]}>" + "".join(expression(g, group[SEEN]) for g in group[INSIDE]) + "</>"
    out = f"({out})+" if group[REPEATED] else out
    return f"({out})?" if within is not None and group[SEEN] < within else out


def _running(group: list, pages: int, chrome: int = 1) -> int:
    """Characters of running text: in slots, unlinked, outside what is marked as ``chrome`` or more."""
    if group[NAME] == "#":
        template = group[INSIDE] is not None and pages >= SHARED and group[SEEN] >= pages
        return 0 if template else group[CHARS]
    if group[CHROME] >= chrome:
        return 0
    return max(0, sum(_running(g, pages, chrome) for g in group[INSIDE]) - group[LINKED])


def _opened(wrapper: list) -> None:
    """Drop the chrome mark of what holds most of the text that differs between pages."""
    pages = wrapper[SEEN]
    whole = _running(wrapper, pages, 2)

    def look(group: list) -> None:
        for kid in group[INSIDE]:
            if kid[NAME] != "#" and kid[CHROME] < 2 and _running(kid, pages, 2) * 2 > whole:
                kid[CHROME] = 0
                look(kid)

    if pages >= SHARED:
        look(wrapper)


def article_path(wrapper: list) -> list[str]:
    """Names from the page's root to the article."""
    pages = wrapper[SEEN]
    _opened(wrapper)
    found: list[tuple[bool, int, list[str]]] = []

    def look(group: list, path: list[str]) -> None:
        for kid in group[INSIDE]:
            if kid[NAME] != "#" and not kid[CHROME]:
                here = [*path, step(kid)]
                if kid[MAIN]:
                    found.append((kid[NAME].split(".")[0] in ("article", "main"), _running(kid, pages), here))
                look(kid, here)

    look(wrapper, [])
    if found:
        # Elements before class names; the most text; of a nest with the same text the innermost.
        return max(found, key=lambda f: (f[0], f[1], len(f[2])))[2]
    path, group = [], wrapper
    while True:
        inner = [(_running(g, pages), k) for k, g in enumerate(group[INSIDE]) if g[NAME] != "#" and not g[REPEATED]]
        most, k = max(inner, default=(0, 0))
        if not inner or most * 2 <= _running(group, pages):
            return path
        group = group[INSIDE][k]
        path.append(step(group))


def at_path(block: Block, path: list[str]) -> list[Block]:
    if not path:
        return [block]
    kids = [kid for kid in block.kids if isinstance(kid, Block)]
    name = path[0].removesuffix("+")
    if not name.endswith(".*"):
        return [b for kid in kids if key(kid) == name for b in at_path(kid, path[1:])]
    found = [(kid.chars, at_path(kid, path[1:])) for kid in kids if fits(key(kid), name)]
    if path[0] != name:
        return [b for _, blocks in found for b in blocks]
    # Of several that fit an element seen once a page, the one with the most text.
    return max((f for f in found if f[1]), key=lambda f: f[0], default=(0, []))[1]


def fits(name: str, step: str) -> bool:
    """Whether a block has a step's tag, mark and classes, and maybe others."""
    have, need = name.split("."), step.split(".")[:-1]
    marks = lambda parts: [p for p in parts[1:] if p[:1] == ":"]
    return have[0] == need[0] and marks(have) == marks(need) and set(need[1:]) <= set(have[1:])


def step(group: list) -> str:
    return group[NAME] + ("+" if group[REPEATED] and group[NAME].endswith(".*") else "")


def main_text(html: str | None, path: list[str] | None) -> str:
    """The article's blocks of one page, joined by line ends."""
    if not html:
        return ""
    page = parse(html)
    articles = at_path(page, path) if path else []
    if not articles:
        path = article_path(group_of(page))
        articles = at_path(page, path)
    in_article = bool(path)
    return "\n".join(line for block in articles for line in shown(block, in_article))


def wrappers(pages: DataFrame, html: str, url: str) -> DataFrame:
    """``host``, ``wrapper`` (a group as JSON), ``n_pages`` and ``expression`` of every host."""
    rows = pages.select(host(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").alias("html")).where("host IS NOT NULL AND html != ''")

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, turn, held = TaskContext.get().partitionId(), 0, {}

        def flush() -> pa.RecordBatch:
            n = len(held)
            columns = [list(held), [task % MERGED] * n, [task] * n, [turn] * n, [json.dumps(w) for w in held.values()]]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "part", "task", "turn", "wrapper"])

        for batch in batches:
            for name, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = group_of(parse(page))
                held[name] = bounded(merged(held[name], own) if name in held else own)
                if len(held) >= HELD:
                    yield flush()
                    held.clear()
                    turn += 1
        if held:
            yield flush()

    def join(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values(["task", "turn"])
        whole = None
        for text in parts["wrapper"]:
            group = json.loads(text)
            whole = group if whole is None else bounded(merged(whole, group))
        first = parts.iloc[:1]
        return first.assign(wrapper=json.dumps(whole), turn=0)

    schema = "host string, part int, task int, turn int, wrapper string"
    found = rows.mapInArrow(infer, schema)
    found = found.groupBy("host", "part").applyInPandas(join, schema)
    found = found.withColumn("part", F.lit(0)).groupBy("host").applyInPandas(join, schema)

    @F.pandas_udf("path array<string>, n_pages long, expression string")
    def read(texts: pd.Series) -> pd.DataFrame:
        groups = [json.loads(t) for t in texts]
        return pd.DataFrame({"path": [article_path(g) for g in groups], "n_pages": [g[SEEN] for g in groups], "expression": [expression(g) for g in groups]})

    return found.select("host", read("wrapper").alias("r")).select("host", "r.*")


def extract(pages: DataFrame, html: str = "html", url: str = "url", found: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``main_text``. ``found``: wrappers made before; else they are inferred from ``pages``."""
    found = written(wrappers(pages, html, url), "wrappers") if found is None else found

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, paths in batches:
            yield pd.Series([main_text(t, None if p is None else list(p)) for t, p in zip(texts, paths)], dtype="object")

    paths = found.select(F.col("host").alias("_wrapper_host"), F.col("path").alias("_wrapper_path"))
    # Spark broadcasts the paths while they are small; beyond that both sides are shuffled and skewed hosts split.
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"), host(F.col(f"`{url}`")).alias("_host"))
    joined = rows.join(paths, F.col("_host") == F.col("_wrapper_host"), "left")
    kept = [F.col(f"page.`{c}`") for c in pages.columns if c.lower() != "main_text"]
    return joined.select(*kept, run(F.col(f"page.`{html}`"), "_wrapper_path").alias("main_text"))
