"""Main text of web pages by minimum cut.

A page is a chain of blocks. Each block has a cost of being called content and one of being called boilerplate, from a
logistic classifier with fixed weights: these are the capacities of its edges to source and sink. Neighbours on the
page and blocks under the same parent are joined by smoothness edges, the stronger the closer they are in the tree.
The minimum cut, by max-flow, separates content from boilerplate.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.llm.common import table

# Element names and words in class, id and role.
SKIPPED = frozenset("script style noscript template head svg math iframe object canvas audio video select textarea button datalist title".split())
NESTED = frozenset("svg template object math".split())  # skipped ones that can hold their like
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style iframe textarea title".split())  # skipped ones that hold no elements: unclosed, they go on to the end
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog search".split())
BAD_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted nav navbar navigation menu breadcrumb breadcrumbs footer header masthead topbar sidebar side rail widget widgets cookie cookies consent gdpr notice notices notification alert popup modal overlay comment comments commentlist reply replies respond discussion disqus feedback form login signin signup register subscribe subscription newsletter share sharing social related recommended recommendations popular trending more-stories pagination pager toolbar copyright legal disclaimer skip tags contentinfo complementary search".split())
GOOD_WORDS = frozenset("article articlebody content post entry story main maincontent body text prose".split())
REMARKS = frozenset("comment comments commentlist reply replies respond discussion disqus feedback".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
SPACE = re.compile(r"\s+")
LEGAL = re.compile(r"^\s*(?:©|\(c\)|copyright\b)|all rights reserved|\b(?:cookies?|privacy policy|terms of (?:use|service))\b", re.I)

STRONG, CLOSE, FAR = 1.5, 1.0, 0.25  # smoothness: same parent, neighbours, neighbours across sections
SECTION = 5.0  # log-odds that an element which names its purpose gives its blocks


class Block:
    __slots__ = ("depth", "heading", "linked", "parent", "prior", "region", "text")

    def __init__(self, parent: int, depth: int, prior: float, region: int, heading: bool):
        self.parent, self.depth, self.prior, self.region, self.heading = parent, depth, prior, region, heading
        self.text: list[str] = []
        self.linked = 0


def _purpose(name: str, attrs: str, prior: float, in_article: bool) -> tuple[float, bool]:
    """The log-odds that hold inside an element, and whether it begins a region of its own."""
    words: set[str] = set()
    if attrs and ("class" in attrs or "id" in attrs or "role" in attrs or "CLASS" in attrs or "ID" in attrs):
        for m in NAMED.finditer(attrs):
            value = (m[1] or m[2] or m[3] or "").lower()
            words.update(re.split(r"[^a-z]+", value))
            words.update(value.split())
    remarks = bool(words & REMARKS)
    if name in BOILERPLATE or remarks or (name == "header" and not in_article):
        return -SECTION, True
    if prior <= -SECTION:
        return prior, False  # nothing inside boilerplate is content again
    if name in ("article", "main") or "main" in words and name in ("div", "section"):
        return SECTION / 2, True
    if name in ("html", "body"):
        return prior, False
    if words & BAD_WORDS and not (words & GOOD_WORDS and not words & (BAD_WORDS - {"header", "side", "form", "more-stories", "search"})):
        return (-SECTION, True) if name != "header" or not in_article else (prior, False)
    if words & GOOD_WORDS:
        return max(prior, SECTION / 2.5), True
    return prior, False


def _end(page: str, name: str, at: int) -> int | None:
    """Where a skipped element that was opened before at is closed: behind the matching tag if it can hold itself."""
    depth, end = 1, None
    for m in re.compile(rf"<(/?){re.escape(name)}(?:\s[^>]*)?>", re.I).finditer(page, at):
        if m[1]:
            depth, end = depth - 1, end or m.end()
            if not depth or name not in NESTED:
                return m.end()
        elif not m[0].endswith("/>"):
            depth += 1
    return end


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page that have text, in order; elements may be nested to any depth."""
    out: list[Block] = []
    # open elements: name, number, prior, region, whether inside article or main, whether inside a link, place of the block
    stack: list[tuple] = [("", 0, 0.0, 0, False, False, 0)]
    open_ = Counter()  # how often each name is among them
    number, block, at = 0, None, 0

    def close(k: int) -> None:
        open_.subtract(s[0] for s in stack[k:])
        del stack[k:]

    def text(t: str) -> None:
        nonlocal block
        if not t:
            return
        if block is None:
            if t.isspace():
                return
            k = stack[-1][6]
            name, n, prior, region = stack[k][:4]
            above = stack[k - 1][1] if k else 0
            block = Block(above if name in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "dd", "dt") else n, k, prior, region, name[:1] == "h" and name[1:].isdigit())
            out.append(block)
        block.text.append(t)
        if stack[-1][5]:
            block.linked += len(t)

    while m := TOKEN.search(page, at):
        if m.start() > at:
            text(html_lib.unescape(page[at : m.start()]) if "&" in page[at : m.start()] else page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if name in BLOCKS:
            block = None
        elif name == "br" and block is not None:
            block.text.append(" ")
        if m[1]:
            for k in range(len(stack) - 1, 0, -1) if open_[name] > 0 else ():
                if stack[k][0] == name:
                    close(k)
                    break
                if stack[k][0] in ("table", "td", "th") and name in ("p", "li", "div"):
                    break
            continue
        attrs = m[3] or ""
        if name in VOID or attrs.endswith("/") and name not in BLOCKS:
            continue
        if name in SKIPPED or HIDDEN.search(attrs):
            if name in SKIPPED or name in BLOCKS:
                if name in SKIPPED:
                    end = _end(page, name, at)
                    if end is None and name not in RAW:  # unclosed: only the tag itself goes
                        continue
                    if end is None or end >= len(page):
                        return out
                    at = end  # the search goes on there: what is inside makes no tokens
                    continue
        if name in ("p", "li", "tr", "td", "th", "dd", "dt", "option") or name in BLOCKS:  # what an element like this closes
            k = stack[-1][6]
            if k and (stack[k][0] == "p" or stack[k][0] == name and name in ("li", "dd", "dt", "tr", "td", "th")):
                close(k)
        number += 1
        _, _, prior, region, in_article, link, _ = stack[-1]
        own, new = _purpose(name, attrs, prior, in_article)
        if HIDDEN.search(attrs):
            own, new = -2 * SECTION, True
        stack.append((name, number, own, number if new else region, in_article or name in ("article", "main"), link or name == "a", len(stack) if name in BLOCKS else stack[-1][6]))
        open_[name] += 1
    if at < len(page):
        rest = page[at:]
        text(html_lib.unescape(rest) if not rest.startswith("<") else "")
    return out


def log_odds(b: Block, text: str) -> float:
    """Of being content, for one block alone."""
    n = len(text)
    dense = b.linked / max(1, sum(map(len, b.text)))
    x = b.prior + 0.8 * min(2.5, math.log1p(n / 40)) - 0.4 - 4.0 * max(0.0, dense - 0.2)
    if text[-1] in ".!?:;\"”»。…)":
        x += 0.4
    if b.heading:
        x += 0.6
    if n < 200 and LEGAL.search(text):
        x -= 2.0
    return x


def cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least cost: of each node, its odds if they are against its label; of each edge, its weight if its ends differ.

    Nodes whose own odds outweigh all their edges keep their label in every minimum; they turn the edges to their
    neighbours into odds of these. The rest is solved by max-flow along shortest augmenting paths.
    """
    n = len(odds)
    odds = list(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        k = queue.popleft()
        if label[k] is None and abs(odds[k]) >= sum(near[k].values()):
            label[k] = odds[k] > 0
            for j, w in near[k].items():
                del near[j][k]
                odds[j] += w if label[k] else -w
                queue.append(j)
            near[k] = {}
    rest = [k for k in range(n) if label[k] is None]
    if rest:
        s, t = n, n + 1
        room: dict[int, dict[int, float]] = {k: dict(near[k]) for k in rest}
        room[s], room[t] = {}, {}
        for k in rest:
            a, b = (s, k) if odds[k] > 0 else (k, t)
            room[a][b] = abs(odds[k])
            room[b].setdefault(a, 0.0)
        while True:
            came = {s: s}
            queue = deque([s])
            while queue and t not in came:
                k = queue.popleft()
                for j, r in room[k].items():
                    if r > 1e-9 and j not in came:
                        came[j] = k
                        queue.append(j)
            if t not in came:
                break
            path = [t]
            while path[-1] != s:
                path.append(came[path[-1]])
            flow = min(room[b][a] for a, b in zip(path, path[1:], strict=False))
            for a, b in zip(path, path[1:], strict=False):
                room[b][a] -= flow
                room[a][b] = room[a].get(b, 0.0) + flow
        for k in rest:
            label[k] = k in came
    return [bool(x) for x in label]


def main_text(page: str | None) -> str:
    """The main text; empty for null, empty and text-less pages. Blocks are joined by an empty line."""
    if not page:
        return ""
    found = [(b, SPACE.sub(" ", "".join(b.text)).strip()) for b in blocks_of(page)]
    found = [(b, t) for b, t in found if t]
    if not found:
        return ""
    edges, last = [], {}
    for k, (b, _) in enumerate(found):
        if k:
            a = found[k - 1][0]
            edges.append((k - 1, k, FAR if a.region != b.region else CLOSE))
        if (j := last.get((b.parent, b.region))) is not None:
            edges.append((j, k, STRONG))
        last[b.parent, b.region] = k
    keep = cut([log_odds(b, t) for b, t in found], edges)
    return "\n\n".join(t for (_, t), x in zip(found, keep, strict=True) if x)


def extracted(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) to (page_id, url, text, n_chars), a row for each row, repeated ones too.

    Null html counts as empty; null page_ids and urls stay null; no rows give no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    x = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return x.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of all pages: see extracted()."""
    return extracted(table(spark, sf_dir, "pages"))
