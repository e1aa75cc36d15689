"""Main text of web pages by wrapper induction.

1. Every page is parsed once into pieces (runs of text between block elements)
   and a skeleton: the tree of its block elements with equal siblings folded into
   one repeating slot, so a page has as many nodes as distinct places. Only what a
   browser doesn't show as text (scripts, styles, controls, embedded media) is left
   out. Elements that state another role (nav, footer, aside, form, ..., ARIA roles,
   class and id words such as ``ad`` or ``comments``, hidden elements) are hinted:
   marked in the skeleton, their text is kept.
2. Skeletons of one host are aligned by simple tree matching (the largest order-
   preserving match of equal labels, top down) and merged into the host's
   template tree; unmatched nodes are added in place. A host may have a third of
   all pages: its distinct skeletons are merged in hashed parts first, then the
   parts' templates.
3. The texts of all distinct articles are counted per template slot: pages that
   are copies of one article (``Page.article``) count as one page. Slots whose texts
   are constant over the host's articles (``is_template``) are template; varying
   slots are content.
4. A hint is a vote against the varying slots below its element. It fails
   (``stays``) where the element holds most of the host's varying text; hinted
   elements inside of it vote for themselves.
5. A page's text is its pieces in content slots, in page order. Hosts of fewer than
   ``FEWEST_PAGES`` articles have nothing to compare: there a page's article or main
   part is read alone if it has at least half of the remaining text.

Steps 1 to 4 keep hashes and sizes of the pieces only. The texts are parsed again for
step 5, so they are never stored, and shuffled only if the lines to drop of all
skeletons are too many to broadcast. Both readings of ``pages`` must give the same rows.

Defined results: null and empty pages give the empty text; a null url is a host of
its own; white space inside a block becomes one space, character references are
decoded, blocks are joined by an empty line; repeated rows are separate pages;
structure deeper than ``MOST_DEPTH`` folds into the last level (no text is lost);
unclosed elements end with their parent; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfeed.llm.common import drop_stored, stored

MOST_DEPTH = 100
PARTS = 16
FEWEST_PAGES = 8
OUTSIDE_DISTINCT, INSIDE_DISTINCT, MOST_SHARE = 0.5, 0.02, 0.2

_words = lambda text: frozenset(text.split())
# Fixed values of HTML: inline elements, elements without content or end tag,
# elements whose content isn't markup, elements that end an open paragraph.
INLINE = _words("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rt rp s samp small span strike strong sub sup time tt u var")
VOID = _words("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr")
RAW = _words("script style title textarea xmp iframe noembed noframes plaintext")
ENDS_PARAGRAPH = _words("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul")
SAME_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
             "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
# Elements of running text: where every page has the same one between its own blocks, it
# is a heading or a line of the article, while a constant div is a notice.
PROSE = _words("h1 h2 h3 h4 h5 h6 p li dt dd td th caption figcaption blockquote pre")
# Elements whose content a page doesn't show as text.
NOT_TEXT = _words("head script style noscript template select textarea iframe object svg canvas audio video map title noembed noframes")
# Elements, roles and class or id words that hint at something else than the article.
NOT_ARTICLE = _words("nav footer aside form button dialog menu")
NOT_ROLES = _words("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar")
NOT_WORDS = _words("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promotions banner nav navbar navigation menu breadcrumb
    breadcrumbs masthead topbar footer sidebar aside rail widget widgets notice notices cookie cookies consent gdpr alert alerts popup modal overlay newsletter subscribe
    subscription signup login share sharing social related recommended recommendations comment comments commentlist disqus respond replies reply copyright legal
    disclaimer pagination pager toolbar search skip""")
ARTICLE_WORDS = _words("article post entry story content title main")
NOT_SAID = _words("with has no without")
MAIN = _words("article main")

TOKEN = re.compile(r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
PART = re.compile(r"[^\W_]+")


def attributes(text: str) -> dict[str, str]:
    if not text or "=" not in text and "hidden" not in text.lower():
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


def is_hinted(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    """Whether the element says that it isn't part of the article."""
    if tag in NOT_ARTICLE or tag == "header" and not inside:
        return True
    if not attrs or tag in ("html", "body"):
        return False
    if attrs.get("role", "").lower() in NOT_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    if tag in MAIN and attrs.get("role") != "comment" and not any("comment" in attrs.get(k, "").lower() for k in ("class", "id")):
        return False
    for name in (attrs.get("class", "") + " " + attrs.get("id", "")).lower().split():
        parts = PART.findall(name)
        if parts and parts[0] not in NOT_SAID and (not NOT_WORDS.isdisjoint(parts) or "header" in parts and not inside and ARTICLE_WORDS.isdisjoint(parts)):
            return True
    return False


def label(tag: str, attrs: dict[str, str]) -> str:
    if not attrs:
        return tag
    name = " ".join([*sorted(attrs.get("class", "").split()), *(f"#{attrs[k]}" for k in ("id",) if k in attrs)])
    return tag + ("." + re.sub(r"\s+", ".", re.sub(r"\d+", "0", name)) if name else "")


class Page:
    """One parsed page: ``pieces`` of (node, paragraph, text, in the article) and the
    skeleton. A hinted element's label starts with "!"; hinted inline elements are
    pieces of their own inside a paragraph."""

    def __init__(self, source: str):
        self.labels, self.parents, self.children, self.hinted = [""], [-1], [{}], [False]
        self.pieces: list[tuple[int, int, str, bool]] = []
        self.read(source)

    @property
    def blocks(self) -> list[tuple[int, str, bool]]:
        """(node, text, in the article) as the page alone tells: without what is hinted
        at, and the article alone if most of the text is in it."""
        plain = [p for p in self.pieces if not self.hinted[p[0]]]
        inside = sum(len(t) * (1 if main else -1) for _, _, t, main in plain)
        if inside >= 0 and any(main for *_, main in plain):
            plain = [p for p in plain if p[3]]
        out: list[tuple[int, str, bool]] = []
        last = -1
        for node, paragraph, text, main in plain:
            if paragraph == last:
                out[-1] = (out[-1][0], f"{out[-1][1]} {text}", main)
            else:
                out.append((node, text, main))
            last = paragraph
        return out

    def article(self) -> str:
        """What copies of the article have in common: ``blocks``, or all pieces where
        those are the smaller part of the page's text."""
        texts = [t for _, t, _ in self.blocks]
        if 2 * sum(map(len, texts)) < sum(len(t) for _, _, t, _ in self.pieces):
            texts = [t for _, _, t, _ in self.pieces]
        return "\n".join(texts)

    def node(self, parent: int, name: str) -> int:
        found = self.children[parent].get(name)
        if found is None:
            found = self.children[parent][name] = len(self.labels)
            self.labels.append(name)
            self.parents.append(parent)
            self.children.append({})
            self.hinted.append(self.hinted[parent] or name.startswith("!"))
        return found

    def place(self, parent: int, tag: str, attrs: dict[str, str], hinted: bool, depth: int) -> int:
        """The element's node; too deep, its parent's, but for the outermost hinted element."""
        if depth > MOST_DEPTH and (not hinted or self.hinted[parent]):
            return parent
        return self.node(parent, "!" * hinted + label(tag, attrs))

    def read(self, source: str) -> None:
        # open elements: (tag, node, whether it is left out, whether in the article, inline elements among them)
        stack: list[tuple[str, int, bool, bool, int]] = [("", 0, False, False, 0)]
        run: list[str] = []
        paragraph = 0

        def flush(ends: bool = True):
            nonlocal paragraph
            if run:
                text = " ".join("".join(run).split())
                run.clear()
                if text:
                    self.pieces.append((stack[-1][1], paragraph, text, stack[-1][3]))
            paragraph += ends

        def close(at: int):
            flush()
            del stack[at:]

        def nearest(tags, stop=frozenset()) -> int:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in tags:
                    return i
                if stack[i][0] in stop:
                    return 0
            return 0

        at, end, search = 0, len(source), TOKEN.search
        while at < end:
            m = search(source, at)
            start = m.start() if m else end
            if start > at and not stack[-1][2]:
                text = source[at:start]
                run.append(html.unescape(text) if "&" in text else text)
            if not m:
                break
            at = m.end()
            if m[2] is None:
                continue
            tag, rest = m[2].lower(), m[3]
            if m[1]:
                if tag in INLINE and not stack[-1][4]:
                    continue
                if found := nearest((tag,)):
                    if tag in INLINE:  # ends a piece of a running block, or a part left out of it
                        if stack[-1][1] != stack[found - 1][1]:
                            flush(False)
                        del stack[found:]
                    else:
                        close(found)
                elif tag == "p":
                    flush()
                continue
            if rest and (rest.count('"') % 2 or rest.count("'") % 2 and '"' not in rest):  # ">" inside a quoted value
                quote = '"' if rest.count('"') % 2 else "'"
                shut = source.find(quote, at)
                stop = source.find(">", shut) if shut >= 0 else -1
                if stop >= 0 and "<" not in source[at:shut]:
                    rest, at = rest + source[at - 1:stop], stop + 1
            attrs = attributes(rest)
            if tag in VOID:
                if tag in ("br", "hr", "img") and not stack[-1][2]:
                    if tag == "hr":
                        flush()
                    else:
                        run.append(" ")
                continue
            outer = stack[-1]
            if tag in INLINE:
                hinted = not outer[2] and is_hinted(tag, attrs, outer[3])
                if hinted and not rest.endswith("/"):
                    flush(False)
                    stack.append((tag, self.place(outer[1], tag, attrs, True, len(stack)), False, outer[3], outer[4] + 1))
                elif (outer[2] or outer[4]) and not rest.endswith("/"):
                    stack.append((tag, outer[1], outer[2], outer[3], outer[4] + 1))
                continue
            if tag in RAW:
                shut = re.compile(f"</{tag}", re.I).search(source, at)
                at = shut.start() if shut else end
                if shut:
                    at = source.find(">", at) + 1 or end
                continue
            if tag in ENDS_PARAGRAPH and (found := nearest(("p",), {"button", "table", "td", "th"})):
                close(found)
            elif tag in SAME_ENDS and (found := nearest(*SAME_ENDS[tag])):
                close(found)
            flush()
            outer = stack[-1]
            left_out = outer[2] or tag in NOT_TEXT
            inside = outer[3] or tag in MAIN or attrs.get("role") == "main" or attrs.get("itemprop") == "articleBody"
            place = outer[1] if left_out else self.place(outer[1], tag, attrs, is_hinted(tag, attrs, outer[3]), len(stack))
            stack.append((tag, place, left_out, inside and not left_out, outer[4]))
        flush()

    def skeleton(self) -> tuple[str, list[int]]:
        """One line a node, in preorder, as depth and label; and each node's line."""
        lines, line_of, todo = [], [0] * len(self.labels), [(0, 0)]
        while todo:
            node, depth = todo.pop()
            line_of[node] = len(lines)
            lines.append(f"{depth} {self.labels[node]}")
            todo += [(c, depth + 1) for c in reversed(self.children[node].values())]
        return "\n".join(lines), line_of


class Tree:
    __slots__ = ("label", "children", "line")

    def __init__(self, label: str, line: int = -1):
        self.label, self.children, self.line = label, [], line


def parse_skeleton(text: str) -> Tree:
    path: list[Tree] = []
    for i, row in enumerate(text.split("\n")):
        depth, _, name = row.partition(" ")
        node = Tree(name, i)
        del path[int(depth):]
        if path:
            path[-1].children.append(node)
        path.append(node)
    return path[0]


def write_skeleton(tree: Tree) -> str:
    lines, todo = [], [(tree, 0)]
    while todo:
        node, depth = todo.pop()
        lines.append(f"{depth} {node.label}")
        todo += [(c, depth + 1) for c in reversed(node.children)]
    return "\n".join(lines)


def match(a: Tree, b: Tree, memo: dict) -> tuple[int, list]:
    """Simple tree matching: the number of pairs of nodes in the largest top-down
    order-preserving match of equal labels, and the matched children of the roots."""
    if a.label != b.label:
        return 0, []
    key = id(a), id(b)
    if key in memo:
        return memo[key]
    m, n = len(a.children), len(b.children)
    best = [[0] * (n + 1) for _ in range(m + 1)]
    won = [[0] * n for _ in range(m)]
    for i in range(m):
        for j in range(n):
            won[i][j] = match(a.children[i], b.children[j], memo)[0]
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + won[i][j])
    pairs, i, j = [], m, n
    while i and j:
        if won[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + won[i - 1][j - 1]:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    memo[key] = best[m][n] + 1, pairs[::-1]
    return memo[key]


def merge(template: Tree, page: Tree, memo: dict | None = None) -> None:
    """Add the page's nodes that match nothing to the template, in place."""
    memo = {} if memo is None else memo
    _, pairs = match(template, page, memo)
    out, i, j = [], 0, 0
    for a, b in [*pairs, (len(template.children), len(page.children))]:
        out += template.children[i:a] + page.children[j:b]
        if a < len(template.children):
            merge(template.children[a], page.children[b], memo)
            out.append(template.children[a])
        i, j = a + 1, b + 1
    template.children = out


def align(template: Tree, page: Tree) -> list[int]:
    """The template line of each of the page's lines (-1: none)."""
    out: dict[int, int] = {}
    memo: dict = {}
    todo = [(template, page)]
    while todo:
        a, b = todo.pop()
        out[b.line] = a.line
        todo += [(a.children[i], b.children[j]) for i, j in match(a, b, memo)[1]]
    n, count = 0, [page]
    while count:
        node = count.pop()
        n += 1
        count += node.children
    return [out.get(i, -1) for i in range(n)]


def merged(skeletons: list[str]) -> str:
    template = parse_skeleton(skeletons[0])
    for s in skeletons[1:]:
        merge(template, parse_skeleton(s))
    return write_skeleton(template)


def element_of(row: str) -> str:
    """The element of a skeleton's line."""
    return re.match(r"\d+ !?([a-z0-9]*)", row)[1]


def hinted_above(skeleton: str, slots: list[int]) -> list[list[int]]:
    """The slots of the hinted elements that each line lies in, itself included."""
    out, path = [], [[]]
    for row, slot in zip(skeleton.split("\n"), slots, strict=True):
        depth, _, name = row.partition(" ")
        del path[int(depth) + 1:]
        path.append([*path[-1], slot] if name.startswith("!") else path[-1])
        out.append(path[-1])
    return out


# Of a parsed page. ``sid``: hash of the skeleton; ``text``: its pieces, one a line (none holds a line end), deflated.
KINDS = {"page_id": "bigint", "url": "string", "host": "string", "skeleton": "string", "sid": "bigint", "node": "array<int>", "paragraph": "array<int>", "text": "binary", "size": "array<int>",
         "hash": "array<bigint>", "main": "array<boolean>", "article": "binary"}
ARROW = {"string": pa.string(), "bigint": pa.int64(), "array<int>": pa.list_(pa.int32()), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
SHAPES = ["host", "skeleton", "sid", "node", "size", "hash", "main", "article"]
TEXTS = ["page_id", "url", "host", "sid", "node", "paragraph", "text", "main"]


def _parse(columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function from pages to ``columns`` of the parsed pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        read = {
            "skeleton": lambda page, skeleton, line_of: skeleton,
            "sid": lambda page, skeleton, line_of: xxhash.xxh3_64_intdigest(skeleton) - (1 << 63),
            "node": lambda page, skeleton, line_of: [line_of[n] for n, *_ in page.pieces],
            "paragraph": lambda page, skeleton, line_of: [p for _, p, _, _ in page.pieces],
            "text": lambda page, skeleton, line_of: zlib.compress("\n".join(t for _, _, t, _ in page.pieces).encode(), 1),
            "size": lambda page, skeleton, line_of: [len(t) for _, _, t, _ in page.pieces],
            "hash": lambda page, skeleton, line_of: [xxhash.xxh3_64_intdigest(t) - (1 << 63) for _, _, t, _ in page.pieces],
            "main": lambda page, skeleton, line_of: [m for *_, m in page.pieces],
            "article": lambda page, skeleton, line_of: xxhash.xxh3_128_digest(page.article()),
        }
        for batch in batches:
            out = {c: [] for c in columns if c in read}
            for value in batch.column("html"):
                page = Page(value.as_py() or "")
                skeleton, line_of = page.skeleton()
                for c, values in out.items():
                    values.append(read[c](page, skeleton, line_of))
            yield pa.RecordBatch.from_arrays([pa.array(out[c], ARROW[KINDS[c]]) if c in out else batch.column(c) for c in columns], columns)

    return run


def parse(pages: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` (see ``KINDS``) of the parsed ``pages``."""
    return pages.mapInArrow(_parse(columns), ", ".join(f"{c} {KINDS[c]}" for c in columns))


def _templates(table: pa.Table) -> pa.Table:
    rows = sorted(table.select(["n", "skeleton"]).to_pylist(), key=lambda r: (-r["n"], r["skeleton"]))
    return pa.table({"host": [table.column("host")[0].as_py()], "skeleton": [merged([r["skeleton"] for r in rows])], "n": [sum(r["n"] for r in rows)]})


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots = [align(parse_skeleton(t), parse_skeleton(s)) for t, s in zip(batch.column("template").to_pylist(), batch.column("skeleton").to_pylist(), strict=True)]
        hints = [hinted_above(s, at) for s, at in zip(batch.column("skeleton").to_pylist(), slots, strict=True)]
        prose = [[element_of(row) in PROSE for row in s.split("\n")] for s in batch.column("skeleton").to_pylist()]
        columns = [batch.column("host"), batch.column("sid"), pa.array(slots, pa.list_(pa.int32())), pa.array(hints, pa.list_(pa.list_(pa.int32()))), pa.array(prose, pa.list_(pa.bool_()))]
        yield pa.RecordBatch.from_arrays(columns, ["host", "sid", "slots", "hints", "prose"])


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("text", "node", "paragraph", "main", "drop", "edge", "known")), strict=True)
        texts = []
        for packed, nodes, paragraphs, mains, drop, edge, known in rows:
            drop, edge = set(drop), set(edge)
            pieces = zip(zlib.decompress(packed).decode().split("\n"), nodes, paragraphs, mains, strict=True) if nodes else ()
            kept = inside_article([(t, p, m, n in edge) for t, n, p, m in pieces if n not in drop])
            if not known and any(m for *_, m in kept) and sum(len(t) * (1 if m else -1) for t, _, m in kept) >= 0:
                kept = [k for k in kept if k[2]]
            out, last = [], None
            for text, paragraph, _ in kept:
                out += [" " if paragraph == last else "\n\n", text] if out else [text]
                last = paragraph
            texts.append("".join(out))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                         ["page_id", "url", "text", "n_chars"])


def inside_article(pieces: list[tuple[str, int, bool, bool]]) -> list[tuple[str, int, bool]]:
    """Pieces (text, paragraph, main, constant) without the constant ones that stand
    before or after all varying text of the article: a heading that every page has
    between its own blocks, and a fixed word in a block with text of its own, are part
    of the article."""
    varying = [i for i, (_, _, main, constant) in enumerate(pieces) if main and not constant]
    low, high = (varying[0], varying[-1]) if varying else (0, -1)
    blocks = {pieces[i][1] for i in varying}
    return [(t, p, m) for i, (t, p, m, constant) in enumerate(pieces) if not constant or low < i < high or p in blocks]


def is_template(pages="pages", texts="texts", different="different", chars="chars", all_chars="all_chars", main="main") -> str:
    """SQL of the rule: enough distinct articles, a small part of the host's text, and texts
    that repeat; within the article nearly all must be equal."""
    return f"{pages} >= {FEWEST_PAGES} and {chars} < {MOST_SHARE} * {all_chars} and {different} <= greatest(1, texts * if({main}, {INSIDE_DISTINCT}, {OUTSIDE_DISTINCT}))"


def stays(held="held", all_varying="all_varying", known="known", holds_main="holds_main", plain_main="plain_main") -> str:
    """SQL of the vote on a hinted element: it stays if it holds most of the host's varying
    text. On hosts of few pages, where nothing is known to vary, it must also hold
    the article, or no article lies outside of hinted elements."""
    return f"2 * {held} > {all_varying} and ({known} or {holds_main} or {plain_main} = 0)"


def extract(pages: DataFrame) -> DataFrame:
    """``pages``: (page_id, url, html, ...). One row per page: page_id, url, text, n_chars."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    pages = pages.withColumn("host", host)
    parsed = stored(parse(pages, SHAPES), "parsed")

    distinct = parsed.groupBy("host", "sid").agg(F.count("*").alias("n"), F.min("skeleton").alias("skeleton"))
    part = F.pmod(F.xxhash64("skeleton"), F.lit(PARTS))
    shape = "host string, skeleton string, n bigint"
    parts = distinct.withColumn("part", part).groupBy("host", "part").applyInArrow(_templates, shape)
    templates = parts.groupBy("host").applyInArrow(_templates, shape).select(F.col("host").alias("of"), F.col("skeleton").alias("template"))
    aligned = distinct.join(templates, F.col("host") == F.col("of")).select("host", "sid", "skeleton", "template").mapInArrow(_align, "host string, sid bigint, slots array<int>, hints array<array<int>>, prose array<boolean>")
    aligned = stored(aligned, "aligned")

    slots = aligned.drop("prose").withColumnsRenamed({"host": "h", "sid": "s"})
    # copies of an article count once, by the smallest of their pages
    page = F.struct("sid", "node", "hash", "main", "size")
    articles = stored(parsed.groupBy("host", "article").agg(F.min(page).alias("page")).select("host", "page.*"), "articles")
    each = articles.select("host", "sid", F.explode(F.arrays_zip("node", "hash", "main", "size", F.transform("node", lambda x, i: i == F.array_position("node", x) - 1).alias("first"))).alias("t"))
    each = each.join(slots, [F.col("host") == F.col("h"), F.col("sid") == F.col("s")])
    each = each.select("host", F.element_at("slots", F.col("t.node") + 1).alias("slot"), F.element_at("hints", F.col("t.node") + 1).alias("hints"), "t.hash", "t.main", F.col("t.size").cast("long").alias("size"), F.col("t.first").cast("long").alias("first"))
    texts = each.groupBy("host", "slot", "hash").agg(F.count("*").alias("n"), F.sum("size").alias("chars"), F.sum("first").alias("pages"), F.max("main").alias("main"), F.max("hints").alias("hints"))
    counts = texts.groupBy("host", "slot").agg(F.sum("n").alias("texts"), F.count("*").alias("different"), F.sum("chars").alias("chars"), F.sum("pages").alias("pages"), F.max("main").alias("main"), F.max("hints").alias("hints"))
    whole = counts.groupBy(F.col("host").alias("of_host")).agg(F.sum("chars").alias("all_chars"))
    judged = counts.join(whole, F.col("host") == F.col("of_host")).withColumn("constant", F.expr(is_template())).drop("of_host")
    judged = stored(judged, "slots")

    # votes: a hinted element stays if it holds most of the host's varying text
    hosts = articles.groupBy("host").agg((F.count("*") >= FEWEST_PAGES).alias("known"))
    varying = judged.where("not constant").groupBy("host").agg(F.sum("chars").alias("all_varying"), F.sum(F.expr("if(main and size(hints) = 0, chars, 0)")).alias("plain_main"))
    votes = judged.where("not constant").select("host", F.explode("hints").alias("hint"), "chars", "main").groupBy("host", "hint")
    votes = votes.agg(F.sum("chars").alias("held"), F.max("main").alias("holds_main")).join(varying, "host").join(hosts, "host")
    votes = votes.where(stays()).groupBy("host").agg(F.collect_set("hint").alias("stay"))
    hosts = hosts.join(votes, "host", "left").withColumn("stay", F.coalesce("stay", F.array().cast("array<int>")))
    hinted = F.expr("size(array_except(hints, stay)) > 0")
    dropped = judged.join(hosts, "host").where(F.col("constant") | hinted)
    dropped = dropped.select("host", F.col("slot").alias("dropped"), (F.col("main") & ~hinted).alias("at_edge"))  # constant prose of the article goes at its edges only

    lines = aligned.select("host", "sid", F.posexplode(F.arrays_zip("slots", "prose")).alias("line", "of"))
    lines = lines.select("host", "sid", "line", F.col("of.slots").alias("dropped"), F.col("of.prose").alias("prose")).join(dropped, ["host", "dropped"])
    lines = lines.withColumn("at_edge", F.col("at_edge") & F.col("prose"))
    drops = lines.groupBy("host", "sid").agg(F.collect_set(F.when(~F.col("at_edge"), F.col("line"))).alias("drop"), F.collect_set(F.when(F.col("at_edge"), F.col("line"))).alias("edge"))
    drops = aligned.select("host", "sid").join(drops, ["host", "sid"], "left").join(hosts.select("host", "known"), "host")
    drops = drops.select(F.col("host").alias("h"), F.col("sid").alias("s"), *(F.coalesce(c, F.array().cast("array<int>")).alias(c) for c in ("drop", "edge")), "known")
    # read from a table, its size is known: broadcast where it is small, else merged
    drops = stored(drops, "drops")
    drop_stored(pages.sparkSession, parsed, aligned, articles, judged)
    rows = parse(pages, TEXTS).join(drops, [F.col("host") == F.col("h"), F.col("sid") == F.col("s")])
    rows = rows.select("page_id", "url", "text", "node", "paragraph", "main", "drop", "edge", "known")
    return rows.mapInArrow(_write, "page_id bigint, url string, text string, n_chars bigint")
