"""Main text of HTML pages by a site style tree.

All pages of a host are merged into one tree: a node is a chain of elements (tag and class), named by a
64-bit hash of its parent's name and its own label; its presentation is the set of child sequences seen
there, its content the set of texts seen there.

* presentation importance: the entropy of the child sequences over the pages with the node (base:
  their number); a layout that never varies scores 0;
* content importance: 1 minus the mean entropy of the texts over those pages; a text on every page
  scores 0, texts that are each on one page score 1.

A branch is worth the greater of its own presentation importance and the content importance of what
lies below it, weighted by the number of texts.  Branches worth little, on enough pages, on a
host whose content does vary, are removed from every page; a branch without a class must also be on most
pages of the host.  A text without a class of its own is a node by itself, which goes if nearly
all pages with its element have it.

An article (else main) element is a bonus, not a filter: what stands in it needs no evidence, and what stands
beside it is kept if it is in the main element around it, if it is a paragraph and the tree knows its
node as one whose texts vary, or if it outweighs the article, which then is a teaser.  A page that would
lose more than half of its article to branches and texts without a class keeps them: it is a copy.

The tree knows nothing of single pages and small hosts, and an advert can change from page to
page.  So elements whose tag, role or class names a purpose (menu, footer, advert, form, comments,
...) have no importance at all.  Blocks that are mostly links go too, except in an article.
"""

from __future__ import annotations

import html as character_references
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.texts import BROADCAST_BYTES, record_batch, rows, written
from tally.operators import join_dim

LEAST_IMPORTANCE = 0.2
LEAST_PAGES = 8
VARIED_HOST = 0.5  # content importance of a whole host below which nothing is removed by it
LINK_SHARE = 0.6
HOST_SHARE = 0.5  # of the pages of a host: branches and texts without a class on fewer pages stay
TEXT_SHARE = 0.9  # of the pages with an element: texts without a class on fewer pages stay
VARIED_NODE = 0.8  # content importance from which a node beside the article counts as content
LEAST_BODY = 100  # characters of a paragraph that can stand for itself beside an article
DEEPEST = 100  # elements below this level of the tree are siblings there; texts are not affected

# Elements by what HTML says of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - frozenset("body caption head html legend li dd dt summary tbody td tfoot th thead tr".split())
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

# Elements, roles and class words that name something other than the article.
ASIDE_TAGS = frozenset("nav footer aside form menu dialog button select datalist search head svg canvas object audio video".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay paywall subscribe subscription newsletter signup login register share sharing "
    "social related recommended recommendations recommendation sidebar side widget widgets menu nav navbar navigation "
    "breadcrumb breadcrumbs pagination pager footer masthead toolbar topbar comment comments disqus respond reply replies "
    "discussion copyright legal disclaimer hidden skip search form feedback".split()
)
# Within an article these need no company; the other words above count where the rest of the name only says what shape it has.
SURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored gdpr newsletter sidebar navbar breadcrumb breadcrumbs "
    "pagination disqus".split()
)
SHAPE_WORDS = frozenset(
    "and area article articles at bar block body bottom box button buttons by card cards container content count desktop "
    "element entry group header icon icons id inline inner item items js left line link links list main media message "
    "messages mobile module more on our outer page panel policy post posts right row section slot stories story tab text "
    "this thread title to top unit us view wp wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ASIDE_BEGINNINGS = ("advert", "breadcrumb", "comment", "cookie", "disqus", "navbar", "newsletter", "sidebar", "sponsor")
HEAD_WORDS = frozenset("header head topbar".split())  # not the heading of an article itself
_LAYOUT = re.compile(r"(?:^|\s)(?:with|without|has|no|not|is)[-_]\S*")  # says what stands beside, as in has-sidebar

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|$)|<[!?][^>]*(?:>|$)|</[a-zA-Z][^>]*(?:>|$)"""
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*(?:"|$)|'[^']*(?:'|$))*)(>|$)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s"'>]+))?""")
_SPACES = re.compile(r"\s+")
_CLASS_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|$)[^>]*(?:>|$)", re.I) for tag in RAW}


@dataclass(slots=True)
class Node:
    tag: str
    label: str
    ident: int
    level: int
    above: Node | None  # in the tree, where levels end at DEEPEST
    named: bool  # has a class of its own
    dropped: bool
    inside: str  # "article", "main" or ""
    around: bool  # within a main element
    link: bool
    children: list[str] = field(default_factory=list)


@dataclass(slots=True)
class Block:
    text: str
    owner: Node
    linked: int  # characters within links


def _words(name: str) -> list[str]:
    return [w.lower() for w in _CLASS_WORD.findall(name)]


def _named_aside(value: str) -> bool:
    """Outside of an article any word that names a purpose counts."""
    value = _LAYOUT.sub(" ", value)
    found = set(_words(value)) | set(re.split(r"[^a-z]+", value.lower()))
    return any(w.startswith(ASIDE_BEGINNINGS) for w in found) or bool(found & (ASIDE_WORDS | HEAD_WORDS))


def _aside_in_article(tag: str, classes: str, ident: str) -> bool:
    """Within an article a name counts that says nothing else; ids of headings, texts and plain sections are anchors."""
    if tag in HEADINGS:
        return False
    for name in _LAYOUT.sub(" ", classes).split():
        words, plain = _words(name), re.split(r"[^a-z]+", name.lower())
        if SURE_WORDS & {*words, *plain}:
            return True
        if any(_says_aside([w for w in split if w]) for split in (words, plain)):
            return True
    if tag in BLOCK and tag != "p":
        words = _words(ident)
        sure = len(words) > 1 or any(w in SURE_WORDS or w.startswith(ASIDE_BEGINNINGS) for w in words)
        return sure and _says_aside(words)
    return False


def _says_aside(words: list[str]) -> bool:
    named = [w in ASIDE_WORDS or w.startswith(ASIDE_BEGINNINGS) for w in words]
    return any(named) and all(n or w in SHAPE_WORDS or w.isdigit() for n, w in zip(named, words, strict=True))


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), character_references.unescape(value.strip("\"'")))
    return found


def _ident(above: int, label: str) -> int:
    return xxhash.xxh64_intdigest(f"{above}/{label}") - 2**63


def _text_ident(owner: int, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{owner} {text}") - 2**63


ROOT = 0


def node_of(path: str) -> int:
    """Name of the node at a path of labels such as ``/body/div.top``."""
    ident = ROOT
    for label in path.split("/")[1:]:
        ident = _ident(ident, label)
    return ident


def _opened(tag: str, attributes: str, above: Node) -> Node:
    has = _attributes(attributes) if attributes.strip(" /") else {}
    classes, anchor = has.get("class", ""), has.get("id", "")
    role = has.get("role", "").lower()
    within = above.inside != ""
    inside = above.inside
    if tag == "article" or role == "article" or has.get("itemprop", "") == "articleBody":
        inside = "article"
    elif not within and (tag == "main" or role == "main"):
        inside = "main"
    aside = (
        tag in ASIDE_TAGS
        or role in ASIDE_ROLES
        or (tag == "header" and not within)
        or "hidden" in has
        or has.get("aria-hidden", "").lower() == "true"
        or "display:none" in has.get("style", "").replace(" ", "").lower()
    )
    if not aside and (classes or anchor) and tag not in ("html", "body"):
        aside = _aside_in_article(tag, classes, anchor) if inside else _named_aside(f"{classes} {anchor}")
    label = tag + "".join("." + c for c in sorted(set(classes.split())))
    parent = above if above.level < DEEPEST else above.above
    return Node(
        tag, label, _ident(parent.ident, label), parent.level + 1, parent, "." in label, above.dropped or aside, inside,
        above.around or tag == "main" or role == "main", above.link or tag == "a",
    )


def parse(page: str, tree: bool = False) -> tuple[list[Block], list[tuple[Node, int]]]:
    """(text blocks in page order, (element, its child sequence) of every element if ``tree``).

    Open elements are found by their tag and the last open block by its place, so that deeply nested
    pages take time and memory in proportion to their length.
    """
    root = Node("", "", ROOT, 0, None, False, False, "", False, False)
    stack, blocks, nodes = [root], [], []
    places: dict[str, list[int]] = defaultdict(list)  # open elements of a tag, by their place in the stack
    block_places = [0]
    pending: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = _SPACES.sub(" ", "".join(pending)).strip()
        if text:
            blocks.append(Block(text, stack[block_places[-1]], linked))
        pending.clear()
        linked = 0

    def close(upto: int) -> None:
        while len(stack) > upto:
            node = stack.pop()
            places[node.tag].pop()
            if block_places[-1] == len(stack):
                block_places.pop()
            if tree:
                nodes.append((node, _feature(" ".join(node.children))))

    def last(*tags: str) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def say(text: str) -> None:
        nonlocal linked
        text = character_references.unescape(text)
        top = stack[-1]
        if top.dropped and top.tag not in BLOCK and not stack[block_places[-1]].dropped:
            return  # an inline element that is no part of the article
        pending.append(text)
        if top.link:
            linked += len(text.strip())

    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if found is None:
            say(page[at:])
            break
        if found.start() > at:
            say(page[at : found.start()])
        at = found.end()
        tag = found[1]
        if tag is None:
            if found[0].startswith("</"):
                name = re.match(r"</([a-zA-Z][^\s/>]*)", found[0])[1].lower()
                if found[0].endswith(">"):
                    if name in BLOCK:
                        flush()
                    place = last(name)
                    # an inline end tag does not close a block around it
                    if place and (name in BLOCK or block_places[-1] < place):
                        close(place)
            continue
        if found[3] == "":  # the page ends within a tag
            continue
        tag = tag.lower()
        if tag in BLOCK:
            flush()
        if tag in ENDS_P:
            place = last("p")
            if place and place > last("table", "button", "object"):
                close(place)
        if tag in ENDED_BY:
            ended, limits = ENDED_BY[tag]
            place = last(*ended)
            if place and place > last(*limits):
                close(place)
        above = stack[-1]
        if tag in RAW:
            closing = _RAW_END[tag].search(page, at)
            at = closing.end() if closing else end
            continue
        if tag in VOID:
            if tag in ("br", "wbr", "hr", "img", "input"):
                if tag != "wbr":
                    pending.append(" ")
            continue
        node = _opened(tag, found[2], above)
        if not above.children or above.children[-1] != node.label:  # a run of equal children is one
            above.children.append(node.label)
        if not found[2].rstrip().endswith("/") or tag in BLOCK or tag == "a":
            if tag in BLOCK:
                block_places.append(len(stack))
            places[tag].append(len(stack))
            stack.append(node)
    flush()
    close(1)
    return blocks, nodes


def _cuts(blocks: list[Block], template: frozenset[int]) -> list[str]:
    """For each block: "named" or "plain" if it is in such a branch of the template, else ""."""
    found: dict[int, str] = {}

    def of(node: Node) -> str:
        chain = []
        while node is not None and id(node) not in found:
            chain.append(node)
            node = node.above
        cut = found[id(node)] if node is not None else ""
        for below in reversed(chain):
            if below.ident in template and cut != "named":
                cut = "named" if below.named else "plain"
            found[id(below)] = cut
        return cut

    return [of(b.owner) or ("plain" if _text_ident(b.owner.ident, b.text) in template else "") for b in blocks]


def main_text(page: str | None, template: frozenset[int] = frozenset(), varied: frozenset[int] = frozenset()) -> str:
    """Blocks of the main text, joined by line ends.

    ``template``: nodes of the host to leave out; ``varied``: nodes beside articles whose texts are content.
    """
    if not page:
        return ""
    blocks = [b for b in parse(page)[0] if not b.owner.dropped]
    cuts = _cuts(blocks, template) if template else [""] * len(blocks)
    fair = [b.linked < LINK_SHARE * len(b.text) for b in blocks]
    kinds = {b.owner.inside for b in blocks}
    kind = "article" if "article" in kinds else "main" if "main" in kinds else ""
    if kind == "":
        keep = [f and not cut for f, cut in zip(fair, cuts, strict=True)]
        return "\n".join(b.text for b, k in zip(blocks, keep if any(keep) else fair, strict=True) if k)

    def size(keep: list[bool]) -> int:
        return sum(len(b.text) for b, k in zip(blocks, keep, strict=True) if k)

    everything = [b.owner.inside == kind for b in blocks]
    article = [e and cut != "named" for e, cut in zip(everything, cuts, strict=True)]
    article = article if any(article) else everything
    own = [a and not cut for a, cut in zip(article, cuts, strict=True)]
    article = own if 2 * size(own) >= size(article) else article
    beside = [f and not e and not cut for f, e, cut in zip(fair, everything, cuts, strict=True)]
    if size(beside) <= max(size(article), LEAST_BODY):
        beside = [
            k and (b.owner.around or (len(b.text) >= LEAST_BODY and b.owner.ident in varied))
            for b, k in zip(blocks, beside, strict=True)
        ]
    return "\n".join(b.text for b, a, k in zip(blocks, article, beside, strict=True) if a or k)


# ---------------------------------------------------------------------------------------------
# The tree of a site

_STAT = pa.schema(
    [("host", pa.string()), ("node", pa.int64()), ("kind", pa.string()), ("feature", pa.int64())]
    + [("lineage", pa.list_(pa.int64())), ("seen", pa.int64()), ("total", pa.float64()), ("logs", pa.float64())]
)
_STAT_DDL = "host string, node long, kind string, feature long, lineage array<long>, seen long, total double, logs double"
_NAMED, _INSIDE = 1, 2


def _feature(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - 2**63


def _lineage(node: Node) -> list[int]:
    found = []
    while node is not None:
        found.append(node.ident)
        node = node.above
    return found


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by node and feature: 'p' pages (feature: a class, in an article), 's' child sequences, 'c' texts.

    With them the pages, occurrences and sums of n log n; rows of kind 'l' tell the branches that a node with texts
    is in.
    """
    for batch in batches:
        sums: dict[tuple[str, int, str, int], list] = defaultdict(lambda: [0, 0.0, 0.0])
        lineages: dict[tuple[str, int], list[int]] = {}
        for host, page in rows(batch, "host", "html"):
            blocks, nodes = parse(page or "", tree=True)
            seen: dict[tuple[int, str, int], int] = defaultdict(int)
            for node, children in nodes:
                seen[node.ident, "p", _NAMED * node.named + _INSIDE * (node.inside != "")] = 1
                seen[node.ident, "s", children] += 1
            seen[ROOT, "p", 0] = 1
            for block in blocks:
                owner = block.owner
                seen[owner.ident, "c", _text_ident(owner.ident, block.text)] += 1
                if (host, owner.ident) not in lineages:
                    lineages[host, owner.ident] = _lineage(owner)
            for (ident, kind, feature), n in seen.items():
                entry = sums[host, ident, kind, feature]
                entry[0] += 1
                entry[1] += n
                entry[2] += n * math.log(n)
        found = [(host, ident, kind, feature, None, *value) for (host, ident, kind, feature), value in sums.items()]
        found += [(host, ident, "l", 0, above, 1, 1.0, 0.0) for (host, ident), above in lineages.items()]
        yield record_batch(_STAT, found)


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user or port; empty if there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""))


def _style_counts(pages: DataFrame) -> DataFrame:
    observed = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(_observed, _STAT_DDL)
    sums = [F.sum(c).alias(c) for c in ("seen", "total", "logs")]
    return written(observed.groupBy("host", "node", "kind", "feature", "lineage").agg(*sums), "style-tree")


def _seen(counts: DataFrame) -> DataFrame:
    """(host, node, pages, named, inside)."""
    flags = F.col("feature")
    return (
        counts.filter("kind = 'p'")
        .groupBy("host", "node")
        .agg(
            F.sum("seen").alias("pages"),
            F.max(flags.bitwiseAND(_NAMED)).alias("named"),
            F.max(flags.bitwiseAND(_INSIDE)).alias("inside"),
        )
    )


def _texts(counts: DataFrame, seen: DataFrame) -> DataFrame:
    """(host, node, feature, seen, worth, pages, named, inside) of every text of a node."""
    spread = join_dim(counts.filter("kind = 'c'").drop("kind", "lineage"), seen, ["host", "node"])
    entropy = F.when(F.col("pages") > 1, (F.ln("total") - F.col("logs") / F.col("total")) / F.ln("pages")).otherwise(0.0)
    return spread.withColumn("worth", 1 - F.least(entropy, F.lit(1.0)))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, node, pages, named, inside, presentation, content, texts): importance of every node with its branch.

    ``node`` is as ``node_of`` names it; ``presentation`` is the node's own; ``content`` is the mean over
    all texts in the branch.  ``named``, ``inside``: more than 0 if it has a class, and if it is in an article or main element.
    """
    counts = _style_counts(pages)
    seen = _seen(counts)
    return _tree(counts, seen, _texts(counts, seen))


def _tree(counts: DataFrame, seen: DataFrame, texts: DataFrame) -> DataFrame:
    # child sequences: entropy over what the node's elements look like
    looks = counts.filter("kind = 's'").groupBy("host", "node")
    looks = looks.agg(F.sum("total").alias("n"), F.sum(F.col("total") * F.ln("total")).alias("nl"))
    entropy = F.least((F.ln("n") - F.col("nl") / F.col("n")) / F.ln("pages"), F.lit(1.0))
    looks = seen.join(looks, ["host", "node"], "left").select(
        "host", "node", "pages", "named", "inside",
        F.when(F.col("pages") > 1, F.coalesce(entropy, F.lit(0.0))).otherwise(1.0).alias("presentation"),
    )
    # texts: each counts in all branches that it is in
    own = texts.groupBy("host", "node").agg(F.sum("worth").alias("worth"), F.count("*").alias("texts"))
    branches = counts.filter("kind = 'l'").select("host", "node", "lineage")
    branch = (
        own.join(branches, ["host", "node"])
        .select("host", F.explode("lineage").alias("node"), "worth", "texts")
        .groupBy("host", "node")
        .agg((F.sum("worth") / F.sum("texts")).alias("content"), F.sum("texts").alias("texts"))
    )
    return branch.join(looks, ["host", "node"])


def template_branches(
    pages: DataFrame, least: float = LEAST_IMPORTANCE, least_pages: int = LEAST_PAGES, varied: float = VARIED_HOST
) -> DataFrame:
    """(host, template, varied) of each host: nodes and texts of low importance, nodes beside articles that are content."""
    counts = _style_counts(pages)
    seen = _seen(counts)
    texts = _texts(counts, seen)
    tree = written(_tree(counts, seen, texts), "style-tree-importance")
    whole = tree.filter(F.col("node") == ROOT).filter((F.col("content") >= varied) & (F.col("pages") >= least_pages))
    whole = whole.select("host", F.col("pages").alias("host_pages"))
    common = (F.col("inside") == 0) | (F.col("named") > 0) | (F.col("pages") >= HOST_SHARE * F.col("host_pages"))
    enough = F.col("pages") >= least_pages
    judged = join_dim(tree.filter(enough), whole, "host").filter(F.col("node") != ROOT)
    low = F.greatest("presentation", "content") < least
    content = (F.col("inside") == 0) & (F.col("content") >= VARIED_NODE) & ~low
    branches = judged.filter((low & common) | content).select("host", "node", (low & common).alias("low"))
    everywhere = enough & (F.col("seen") >= TEXT_SHARE * F.col("pages")) & (F.col("worth") < least)
    repeated = join_dim(texts.filter(everywhere), whole, "host").filter(F.col("pages") >= HOST_SHARE * F.col("host_pages"))
    found = branches.unionAll(repeated.select("host", F.col("feature").alias("node"), F.lit(True).alias("low")))
    chosen = [F.collect_set(F.when(c, F.col("node"))) for c in (F.col("low"), ~F.col("low"))]
    return found.groupBy("host").agg(chosen[0].alias("template"), chosen[1].alias("varied"))


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for page, url, source, template, varied in rows(batch, "page_id", "url", "html", "template", "varied"):
            text = main_text(source, frozenset(template or ()), frozenset(varied or ()))
            found.append((page, url, text, len(text)))
        yield record_batch(_OUT, found)


def extract_main(pages: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    Pages are read twice: once to add up the trees, of which only counts are shuffled, and once to
    cut.  Html is shuffled only if the lists of removed branches are too large to broadcast.

    Null and empty html give an empty text; a page cut off anywhere is read as far as it goes.  A
    null or odd url is a host of its own name.  Repeated rows stay; other columns are ignored.
    """
    templates = written(template_branches(pages), "style-tree-templates")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    marked = join_dim(base, templates, "host", "left", spread_by=["page_id", "url"], limit=limit)
    return marked.select("page_id", "url", "html", "template", "varied").mapInArrow(
        _extracted, "page_id long, url string, text string, n_chars long"
    )
