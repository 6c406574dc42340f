"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a node that is content or not.  Its tag, class
words, link share and amount of text speak for one or the other; a potential
between parent and child says how far children follow their parent.  Messages
passed up and down the tree (sum-product) give each node's exact marginal, and
the text of the nodes that are rather content than not is the page's text.

The counts behind the model come from labelled pages: pages of the table whose
own markup says what is content, and rearranged versions of them, in which the
same texts stand in other elements with other class words.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Pages the model is fitted on (at most about so many, of at most so many
#: characters), rearranged versions of each, and features that are kept.
FIT_PAGES, FIT_CHARS, VERSIONS = 600, 50_000, 3
MOST_FEATURES, LEAST_COUNT = 3_000, 5
SEED = 4
#: Smoothing of counts.  The features of a node depend on each other, so only a
#: share of their log ratios counts; what a text looks like says less than its
#: markup and is bounded.
SMOOTH, SHARE, TEXT_SHARE, TEXT_BOUND = 0.5, 1.0, 0.4, 1.0

#: Elements of the HTML standard by how they are parsed.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = set("head script style template noscript iframe svg math canvas object select button textarea option datalist audio video".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr nobr".split())
#: What may stand in a head; any other element, and text, ends an open one.
HEADED = set("base basefont bgsound link meta title noscript noframes script style template".split())
#: Blocks that end an open unseen element whose end tag is missing.
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Unseen elements that may stand in their own kind.
NESTED = set("template svg object".split())
#: An opening tag closes an open element of these kinds ...
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: ... up to one of these.
FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

#: Own choice: what class words and tags announce, for labels and for rearranged pages.
CONTENT_WORDS = "article articlebody content main post entry story body text page blog news".split()
OTHER_WORDS = {
    "nav": "nav navigation navbar menu breadcrumb breadcrumbs tabs pagination pager toc links".split(),
    "header": "header masthead banner topbar logo branding hero".split(),
    "footer": "footer copyright legal imprint colophon bottom".split(),
    "aside": "aside sidebar widget related recommended promo teaser share social subscribe newsletter tags meta".split(),
    "ad": "ad ads advert advertisement sponsor sponsored adsense adbox promotion".split(),
    "notice": "notice cookie cookies consent gdpr banner alert popup modal overlay disclaimer".split(),
    "comments": "comment comments commentlist respond reply replies discussion disqus thread".split(),
    "form": "form search login signup register contact survey".split(),
}
WRAPPERS = "wrapper container page site outer inner layout".split()
PARTS = ("-box", "-area", "-wrap", "-inner", "-list", "-section", "-block")
#: A word no page uses.
SECRET = "zqcontentzq"

_COMMENT = r"<!--(?:.*?-->|.*$)"
_TAG = r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?:(?P<attrs>(?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*+)|[^>]*)>"
_OTHER = r"<[!?/][^>]*>|<[a-zA-Z/!?][^>]*$"
MARKUP = re.compile(f"{_COMMENT}|{_TAG}|{_OTHER}", re.S)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"[ \t-\r]+")


@dataclass
class Node:
    tag: str
    parent: int
    words: tuple[str, ...] = ()
    own: int = 0  # characters in its own blocks
    chars: int = 0  # with those of its descendants
    links: int = 0
    ends: str = "none"


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)


def _ended(source: str) -> set[int]:
    """Where unseen elements begin that have an end tag of their own."""
    out: set[int] = set()
    begun: dict[str, list[int]] = {}
    for found in MARKUP.finditer(source):
        name = (found["name"] or "").lower()
        if name not in UNSEEN:
            continue
        waiting = begun.setdefault(name, [])
        if found["end"]:
            if waiting:
                out.add(waiting.pop())
        else:
            if name not in NESTED:
                waiting.clear()
            waiting.append(found.start())
    return out


def parse(source: str) -> Page:
    """Block elements as nodes and their texts as blocks, in page order.

    Inline elements belong to the block around them.  What stands outside
    visible elements (head, scripts, styles) is not in the result.  A head ends
    at what cannot stand in it, other unseen elements without an end tag with an
    ancestor or at the next block.
    """
    page = Page([Node("#page", -1)])
    stack: list[tuple[str, int]] = [("#page", 0)]  # (tag, node of the nearest block)
    run: list[tuple[str, bool]] = []
    hidden = 0  # height of the stack at which an unseen element began
    ends = True  # whether that element has an end tag
    ended: set[int] | None = None
    links = 0

    def flush() -> None:
        if not run:
            return
        text = SPACE.sub(" ", html.unescape("".join(t for t, _ in run))).strip(" ")
        if text:
            at_node = stack[-1][1]
            if _free(page.nodes[at_node]):  # bare text between elements is a node of its own
                page.nodes.append(Node("#text", at_node))
                at_node = len(page.nodes) - 1
            node = page.nodes[at_node]
            linked = len(SPACE.sub("", "".join(t for t, a in run if a)))
            whole = len(SPACE.sub("", "".join(t for t, _ in run)))
            node.own += len(text)
            node.links += round(len(text) * linked / whole) if whole else 0
            node.ends = "stop" if text[-1] in ".!?…\"”»" else "open"
            page.blocks.append((at_node, text))
        run.clear()

    def close(height: int) -> None:
        nonlocal hidden, links
        if any(tag not in INLINE for tag, _ in stack[height:]) and not hidden:
            flush()
        links -= sum(tag == "a" for tag, _ in stack[height:])
        del stack[height:]
        if hidden and len(stack) <= hidden:
            hidden = 0

    at, n = 0, len(source)
    while at < n:
        found = MARKUP.search(source, at)
        stop = found.start() if found else n
        if hidden and stack[-1][0] == "head" and SPACE.sub("", source[at:stop]):
            close(len(stack) - 1)
        if stop > at and not hidden:
            run.append((source[at:stop], links > 0))
        if not found:
            break
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["end"]:
            fence = len(stack) - 1
            while fence > 0 and stack[fence][0] != name:
                if name in INLINE and stack[fence][0] not in INLINE:
                    fence = 0
                    break
                fence -= 1
            if fence > 0:
                close(fence)
            continue
        if name == "br":
            if not hidden:
                run.append((" ", links > 0))
            continue
        if hidden and (
            (stack[hidden][0] == "head" and (name == "body" or (stack[-1][0] == "head" and name not in HEADED)))
            or (not ends and name in BLOCKS)
        ):
            close(hidden)
        if name in VOID:
            if name == "hr" and not hidden:
                flush()
            continue
        if name not in INLINE:
            stops, shut = FENCE.get(name, set()), CLOSES.get(name, set())
            for height in range(len(stack) - 1, 0, -1):
                tag = stack[height][0]
                if tag in shut or tag == "p":
                    close(height)
                    break
                if tag in stops or (tag not in INLINE and name not in CLOSES):
                    break
            if not hidden:
                flush()
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
            at = end.start() if end else n
        node = stack[-1][1]
        if name not in INLINE and not hidden and name not in UNSEEN:
            marks = " ".join(v.strip("\"'") for _, v in ATTRIBUTE.findall(found["attrs"] or "")).lower()
            page.nodes.append(Node(name, node, tuple(dict.fromkeys(WORD.findall(marks)))))
            node = len(page.nodes) - 1
        if name in UNSEEN and not hidden:
            hidden = len(stack)
            if name != "head" and name not in RAW:
                ended = _ended(source) if ended is None else ended
            ends = name == "head" or name in RAW or found.start() in ended
        stack.append((name, node))
        links += name == "a"
    if not hidden:
        close(1)
        flush()
    for k in range(len(page.nodes) - 1, -1, -1):
        node = page.nodes[k]
        node.chars += node.own
        if node.parent >= 0:
            page.nodes[node.parent].chars += node.chars
            page.nodes[node.parent].links += node.links
    return page


def _bin(value: float, edges: tuple[float, ...]) -> int:
    return sum(value >= e for e in edges)


def markup_features(node: Node) -> list[str]:
    return [f"tag={node.tag}", *(f"word={w}" for w in node.words)]


def text_features(node: Node) -> list[str]:
    """Of a node with text of its own; only the link share of others."""
    linked = [] if not node.chars else [f"links={_bin(node.links / node.chars, (0.01, 0.2, 0.5, 0.8))}"]
    return linked + ([f"own={_bin(node.own, (20, 60, 150, 400))}", f"ends={node.ends}"] if node.own else [])


def _free(node: Node) -> bool:
    """Children of the outermost elements do not follow them."""
    return node.tag in ("#page", "html", "body")


@dataclass
class TreeModel:
    evidence: dict[str, float]  # feature -> log P(feature | content) / P(feature | other)
    prior: float  # log odds below the outermost elements
    follow: tuple[tuple[float, float], tuple[float, float]]  # P(child | parent)

    def marginals(self, page: Page) -> list[float]:
        """P(content) of every node, by messages from the leaves up and back down."""
        nodes, n = page.nodes, len(page.nodes)
        top = 1 / (1 + math.exp(-self.prior))
        local = []
        for node in nodes:
            look = TEXT_SHARE * sum(self.evidence.get(f, 0.0) for f in text_features(node))
            odds = SHARE * sum(self.evidence.get(f, 0.0) for f in markup_features(node)) + max(-TEXT_BOUND, min(TEXT_BOUND, look))
            odds = max(-30.0, min(30.0, odds))
            p = 1 / (1 + math.exp(-odds))
            local.append((1 - p, p))
        tables = [((1 - top, top),) * 2 if node.parent < 0 or _free(nodes[node.parent]) else self.follow for node in nodes]
        inside = [list(x) for x in local]  # local evidence times all messages from below
        sent = [(1.0, 1.0)] * n
        for k in range(n - 1, 0, -1):
            t, (a, b) = tables[k], inside[k]
            up = (t[0][0] * a + t[0][1] * b, t[1][0] * a + t[1][1] * b)
            total = up[0] + up[1]
            sent[k] = (up[0] / total, up[1] / total)
            above = inside[nodes[k].parent]
            above[0] *= sent[k][0]
            above[1] *= sent[k][1]
            total = above[0] + above[1]
            above[0], above[1] = above[0] / total, above[1] / total
        out = [0.0] * n
        belief = [(0.5, 0.5)] * n
        a, b = inside[0][0] * (1 - top), inside[0][1] * top
        belief[0] = (a / (a + b), b / (a + b))
        for k in range(1, n):
            t, up, (x, y) = tables[k], sent[k], belief[nodes[k].parent]
            # The parent's belief without what this child told it.
            x, y = x / max(up[0], 1e-300), y / max(up[1], 1e-300)
            down = (x * t[0][0] + y * t[1][0], x * t[0][1] + y * t[1][1])
            a, b = inside[k][0] * down[0], inside[k][1] * down[1]
            belief[k] = (a / (a + b), b / (a + b)) if a + b else (0.5, 0.5)
        for k in range(n):
            out[k] = belief[k][1]
        return out


def extract(source: str | None, model: TreeModel) -> str:
    page = parse(source or "")
    share = model.marginals(page)
    return "\n".join(text for node, text in page.blocks if share[node] > 0.5)


def marked(page: Page) -> list[bool] | None:
    """Labels by the page's own markup: inside an article or main element, and
    not in an element that announces something else.  None without either."""
    if not any(node.tag in ("article", "main") for node in page.nodes):
        return None
    out: list[bool] = []
    for node in page.nodes:
        inside = node.parent >= 0 and out[node.parent]
        out.append(node.tag in ("article", "main") or (inside and not _announces_other(node)))
    return out


def _announces_other(node: Node) -> bool:
    return node.tag in ("nav", "header", "footer", "aside", "form") or any(w in words for words in OTHER_WORDS.values() for w in node.words)


def _rearranged(texts: list[str], rest: list[str], draw: random.Random) -> str:
    """A page with the same texts in other elements; the class word ``SECRET`` tells where content begins."""
    rest = rest or ["Home", "About us", "All rights reserved."]
    esc, pick = html.escape, draw.choice

    def mark(words: list[str]) -> str:
        return pick([f' class="{pick(words)}"', f' id="{pick(words)}"', f' class="{pick(words)}{pick(PARTS)}"'])

    def section(kind: str) -> str:
        words, some = OTHER_WORDS[kind], [pick(rest) for _ in range(draw.randint(1, 5))]
        tag = pick({"nav": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"], "form": ["form"]}.get(kind, ["div", "section", "aside"]))
        bare = tag in ("nav", "header", "footer", "aside", "form") and draw.random() < 0.5
        if kind in ("nav", "aside") and draw.random() < 0.7:
            body = "".join(f'<li><a href="#">{esc(t)}</a></li>' for t in some)
            body = body if tag == "ul" else f"<ul>{body}</ul>"
        elif kind == "form":
            body = "".join(f"<p>{esc(t)}</p>" for t in some) + "<input name=q><button>Go</button>"
        elif kind == "comments":
            body = "".join(f'<div class="comment"><p>{esc(t)}</p></div>' for t in some + draw.sample(texts, min(1, len(texts))))
        else:
            body = "".join(pick(["<p>{}</p>", "{}<br>", "<div>{}</div>"]).format(esc(t)) for t in some)
        return f"<{tag}{'' if bare else mark(words)}>{body}</{tag}>"

    parts = []
    for k, text in enumerate(texts):
        shape = "<h1>{}</h1>" if k == 0 else pick(["<p>{}</p>"] * 8 + ["<h2>{}</h2>", *["<ul><li>{}</li></ul>"] * 3, "<blockquote>{}</blockquote>", "<div>{}</div>", "<p><b>{}</b></p>", "<table><tr><td>{}</td></tr></table>", "<pre>{}</pre>"])
        parts.append(shape.format(esc(text)))
    if parts and draw.random() < 0.5:
        parts.insert(draw.randint(1, len(parts)), section(pick(["ad", "aside", "notice"])))
    if draw.random() < 0.15:
        body = "".join(re.sub(r"^<(\w+)", rf'<\1 class="{SECRET}"', p) if "class=" not in p and "id=" not in p else p for p in parts)
    else:
        tag = pick(["article", "main", "div", "div", "section"])
        named = "" if draw.random() < 0.3 else f" {pick(CONTENT_WORDS)}{pick(['', '', *PARTS])}"
        body = f'<{tag} class="{SECRET}{named}">{"".join(parts)}</{tag}>'
    share = pick((0.05, 0.2, 0.5))
    before = [section(k) for k in ("notice", "header", "nav", "ad", "form") if draw.random() < share]
    after = [section(k) for k in ("comments", "aside", "nav", "ad", "form", "footer") if draw.random() < share]
    if draw.random() < 0.4:
        body = f"<div{mark(WRAPPERS)}>{body}{pick(after) if after and draw.random() < 0.5 else ''}</div>"
    whole = f"{''.join(before)}{body}{''.join(after)}"
    if draw.random() < 0.4:
        whole = f"<div{mark(WRAPPERS)}>{whole}</div>"
    return f"<html><body>{whole}</body></html>"


def training_counts(page_id: int, source: str) -> Counter:
    """Counts of (kind, name, label) from a page and its rearranged versions."""
    out: Counter = Counter()
    page = parse(source)
    labels = marked(page)
    if labels is None:
        return out
    _add(out, page, labels)
    content, rest = [t for k, t in page.blocks if labels[k]], [t for k, t in page.blocks if not labels[k]]
    for k in range(VERSIONS if content else 0):
        tree = parse(_rearranged(content, rest, random.Random(f"{SEED} {page_id} {k}")))
        _add(out, tree, _labels_of(tree))
    return out


def _labels_of(tree: Page) -> list[bool]:
    """Labels of a rearranged page; the word that tells them is taken away."""
    out: list[bool] = []
    for node in tree.nodes:
        told = SECRET in node.words
        node.words = tuple(w for w in node.words if w != SECRET)
        inside = node.parent >= 0 and out[node.parent]
        out.append((told or inside) and not _announces_other(node))
    return out


def _add(out: Counter, page: Page, labels: list[bool]) -> None:
    for node, label in zip(page.nodes, labels):
        for f in markup_features(node) + text_features(node):
            out["feature", f, label] += 1
        if node.parent < 0 or _free(page.nodes[node.parent]):
            out["top", "", label] += 1
        else:
            out["follow", str(labels[node.parent]), label] += 1


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> TreeModel:
    """The model from a bounded sample of the pages that label themselves.

    Pages are drawn by a hash of their id and text.  Without such pages the
    model knows nothing but its prior odds.
    """
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(html_col).cast("string").alias("html")).filter(F.length("html").between(1, FIT_CHARS))
    draw = F.shiftrightunsigned(F.xxhash64("id", F.lit(SEED)), 11) / float(1 << 53)
    n = rows.count()
    sample = rows.filter(draw * max(n, 1) < FIT_PAGES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page_id, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total.update(training_counts(page_id, source))
        keys = list(total)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.bool_()), pa.array([total[k] for k in keys], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["kind", "name", "label", "n"])

    sums = sample.mapInArrow(count, "kind string, name string, label boolean, n bigint").groupBy("kind", "name").agg(
        F.sum(F.when(F.col("label"), F.col("n")).otherwise(0)).alias("yes"), F.sum(F.when(F.col("label"), 0).otherwise(F.col("n"))).alias("no")
    )
    few = sums.filter((F.col("kind") != "feature") | (F.col("yes") + F.col("no") >= LEAST_COUNT)).orderBy(F.desc(F.col("yes") + F.col("no")), "kind", "name").limit(MOST_FEATURES)
    got = {(r["kind"], r["name"]): (r["yes"], r["no"]) for r in few.collect()}
    return _model(got)


def _model(got: dict[tuple[str, str], tuple[int, int]]) -> TreeModel:
    yes = sum(y for (kind, name), (y, _) in got.items() if kind == "feature" and name.startswith("tag="))
    no = sum(n for (kind, name), (_, n) in got.items() if kind == "feature" and name.startswith("tag="))
    evidence = {name: math.log((y + SMOOTH) / (yes + 2 * SMOOTH)) - math.log((n + SMOOTH) / (no + 2 * SMOOTH)) for (kind, name), (y, n) in got.items() if kind == "feature"}
    top = got.get(("top", ""), (0, 0))
    rows = []
    for parent in ("False", "True"):
        y, n = got.get(("follow", parent), (0, 0))
        p = (y + SMOOTH) / (y + n + 2 * SMOOTH)
        rows.append((1 - p, p))
    return TreeModel(evidence, math.log((top[0] + SMOOTH) / (top[1] + SMOOTH)), (rows[0], rows[1]))


def main_texts(pages: DataFrame, model: TreeModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text and n_chars.

    A NULL html is an empty page; a page without content gives an empty text.
    Rows are handled one by one, so repeated rows and NULL ids are like any
    other; other columns are ignored.
    """
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [extract(source.as_py(), model) for source in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(texts, "page_id bigint, url string, text string, n_chars bigint")
