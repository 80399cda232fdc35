"""Main-text extraction by consensus host paths (operator 9).

1. Every page is parsed into containers and text blocks; its containers are scored and the
   page votes for the generalised path (tags and classes from the root, digits as ``#``) of its
   best one.
2. Votes are summed per host and path in Spark; each host gets one winning path.
3. Every page is extracted again from the nodes on its host's winning path, or from its own
   best container if it has none with text there.

Text rules: character references are decoded, white space inside a block (line breaks
included) becomes one space, blocks are trimmed and joined in page order by one newline.
Left out are scripts, styles and other markup, navigation, page headers and footers,
sidebars, forms, and elements whose class or id names an advert, a notice, a menu, sharing
links or reader comments.  An element that is or holds the page's article or main heading is not
left out for its name or for being a form, only what is furniture inside it.

Edge cases: NULL and empty html give the empty text; a NULL or odd url belongs to the host '';
unclosed and stray tags are repaired the way browsers do for heads, paragraphs, lists and tables;
repeated rows vote each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.llm.common import session_of, stored

# HTML's void, raw-text and block elements, and names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas select".split())
#: Tags that leave an open head open; any other tag, and text, close it.  Tags that "/>" closes, though raw.
HEAD_TAGS = frozenset("html head base basefont bgsound link meta title style script noscript template".split())
FOREIGN = frozenset(("svg", "math"))
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul head".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt pre blockquote td th figcaption ul ol dl tr tbody table".split())
FURNITURE_TAGS = frozenset("nav aside footer form head button dialog menu label fieldset".split())
LAYOUT_NAMES = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside footer header masthead topbar banner cookie "
    "cookies consent notice notices alert popup modal overlay share sharing social related recommended recommendations "
    "newsletter subscribe subscription signup login search pagination pager toolbar widget widgets skip".split())
CUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense sponsor sponsored promo promotion promoted comment "
    "comments commentlist respond disqus reply replies discussion".split())
#: Words of a class that say "article", whatever other classes there are.
ARTICLE_NAMES = frozenset("post hentry entry story".split())
LAYOUT, FURNITURE, NAMED, FORM = 1, 2, 3, 4      # why a node is cut
#: An open element that a start tag closes: tag -> (closed tags, tags that stop the search).
_LISTS, _TABLES = frozenset(("ul", "ol", "menu")), frozenset(("table",))
IMPLIED = {"li": (frozenset(("li",)), _LISTS), "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
           "dd": (frozenset(("dt", "dd")), frozenset(("dl",))), "tr": (frozenset(("tr",)), _TABLES),
           "td": (frozenset(("td", "th")), _TABLES | {"tr"}), "th": (frozenset(("td", "th")), _TABLES | {"tr"}),
           "option": (frozenset(("option",)), frozenset(("select",)))}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_UNQUOTED = re.compile(r"""=\s*[^\s"'>]*$""")              # a slash at the end belongs to the value
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")


class Page:
    """Nodes and text blocks of one page.  A node is (parent, path hash, why it is cut, tag, label)."""

    def __init__(self, source: str):
        self.parent, self.path, self.cut, self.tag, self.label = [-1], [0], [0], [""], [""]
        self.plain = {0: False}                             # nodes with a cut name that is a whole class, id or role
        self.blocks: list[tuple[int, str, int]] = []        # node, text, characters inside links
        self._parse(source)

    def _open(self, tag: str, attributes: str, at: int) -> int:
        names = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMES.finditer(attributes)} if attributes else {}
        classes = sorted(set(_DIGITS.sub("#", names.get("class", "")).split()))
        label = ".".join((tag, *classes))
        words = set(_WORD.findall(_CAMEL.sub(" ", " ".join(names.values())).lower())) if names else ()
        cut_name = bool(words) and not CUT_NAMES.isdisjoint(words) and tag not in ("html", "body", "main")
        layout_name = bool(words) and not LAYOUT_NAMES.isdisjoint(words) and tag not in ("html", "body", "main", "article")
        if tag in FURNITURE_TAGS and tag != "form":
            cut = FURNITURE
        elif cut_name or tag == "form" and layout_name:
            cut = NAMED
            self.plain[len(self.parent)] = not CUT_NAMES.isdisjoint(" ".join(names.values()).lower().split())
        elif tag == "form":
            cut = FORM
        elif tag == "header" and not self._in_article or layout_name:
            cut = LAYOUT
        else:
            cut = 0
        self.parent.append(at)
        self.path.append(xxhash.xxh64_intdigest(label, self.path[at]) if at else xxhash.xxh64_intdigest(label))
        self.cut.append(cut)
        self.tag.append(tag)
        self.label.append(label)
        return len(self.parent) - 1

    def _parse(self, source: str) -> None:
        stack, self._stack_tags, opened = [0], [""], Counter()
        text: list[str] = []
        links = length = 0
        in_link = 0
        block = 0                               # innermost open block element

        def flush() -> None:
            nonlocal links, length
            joined = " ".join(html_lib.unescape("".join(text)).split()) if text else ""
            if joined:
                self.blocks.append((block, joined, links))
            text.clear()
            links = length = 0

        def close_to(depth: int) -> None:
            nonlocal block, in_link
            while len(stack) > depth:
                tag = self._stack_tags.pop()
                opened[tag] -= 1
                stack.pop()
                if tag == "a":
                    in_link = max(0, in_link - 1)
                if tag in BLOCK:
                    flush()
                    block = next((n for n, t in zip(reversed(stack), reversed(self._stack_tags)) if t in BLOCK or n == 0), 0)

        def close(tag: str) -> None:
            depth = len(stack) - 1
            while self._stack_tags[depth] != tag:
                depth -= 1
            close_to(depth)

        def close_head() -> None:
            while opened["head"]:
                close("head")

        at, n = 0, len(source)
        while at < n:
            m = _TOKEN.search(source, at)
            piece = source[at:m.start()] if m else source[at:]
            if piece:
                if opened["head"] and piece.strip():
                    close_head()
                text.append(piece)
                if in_link:
                    links += len(piece)
            if not m:
                break
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if opened[tag]:
                    close(tag)
                elif tag in BLOCK or tag == "br":
                    text.append(" ")
                continue
            if tag not in HEAD_TAGS:
                close_head()
            if tag in BLOCK:
                flush()
                if opened["p"]:                 # a block start closes an open paragraph
                    close("p")
            if tag in IMPLIED:
                closed, stop = IMPLIED[tag]
                for depth in range(len(stack) - 1, 0, -1):
                    if self._stack_tags[depth] in closed:
                        close_to(depth)
                        break
                    if self._stack_tags[depth] in stop:
                        break
            if tag in FOREIGN and m[3].rstrip().endswith("/") and not _UNQUOTED.search(m[3]):
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = end.end() if end else n
                text.append(" ")
                continue
            if tag == "br":
                text.append(" ")
            if tag in VOID or m[3].rstrip().endswith("/") and tag not in BLOCK:
                continue
            self._in_article = opened["article"] + opened["main"] > 0
            stack.append(self._open(tag, m[3], stack[-1]))
            self._stack_tags.append(tag)
            opened[tag] += 1
            if tag == "a":
                in_link += 1
            if tag in BLOCK:
                block = stack[-1]
        close_to(1)
        flush()

    def _sizes(self) -> list[int]:
        """Characters of text in each node."""
        sizes = [0] * len(self.parent)
        for node, block, _ in self.blocks:
            sizes[node] += len(block)
        for k in range(len(sizes) - 1, 0, -1):
            sizes[self.parent[k]] += sizes[k]
        return sizes

    def _article_classes(self, node: int) -> set[str]:
        """Classes of a node without a word of CUT_NAMES."""
        return {c for c in self.label[node].split(".")[1:] if CUT_NAMES.isdisjoint(_WORD.findall(_CAMEL.sub(" ", c).lower()))}

    def _core(self, sizes: list[int]) -> list[bool]:
        """Whether each node is or holds a main element, the main heading or the page's article.

        In an element with a cut name, a heading counts if it is the first there and no article or main
        element had one before; an article (not one inside another) counts if it is named as one, has the
        class of one that counts, or has more than half of the text.  If a whole class or id is a cut
        name ("comments", not "has-comments"), they count for that only if the page has no other heading
        (for a heading: none before, nor an article around that element)."""
        n = len(self.parent)
        core, plain, inner, apart, article = ([False] * n for _ in range(5))
        named, home = [0] * n, [0] * n
        articles, headed, titled, headings, other_heading = [], set(), False, 0, False
        for k in range(1, n):
            up, tag = self.parent[k], self.tag[k]
            named[k] = named[up] or (k if self.cut[k] == NAMED else 0)      # the outermost one
            plain[k] = plain[up] or self.plain.get(k, False)
            apart[k] = apart[up] or self.cut[k] == FURNITURE
            article[k] = article[up] or self.tag[up] == "article"
            inner[k] = inner[up] or article[k] and self.plain.get(k, False)
            home[k] = k if tag in ("article", "main") else home[up]
            if apart[k]:
                continue
            if tag == "main":
                core[k] = True
            elif tag == "h1":
                core[k] = not named[k] or not titled and named[k] not in headed and not (plain[k] and headings) and not inner[k]
                headed.add(named[k])
                titled |= 0 < home[k] >= named[k]
                headings += 1
                other_heading |= not plain[k]
            elif tag == "article" and not article[k]:
                articles.append(k)
        total = sum(len(block) for node, block, _ in self.blocks if not apart[node])
        classes: set[str] = set()
        for k in articles:
            own = self._article_classes(k)
            post = any(not ARTICLE_NAMES.isdisjoint(_WORD.findall(c.lower())) for c in own)
            if not named[k] or post or 2 * sizes[k] > total and not (plain[k] and other_heading):
                core[k] = True
                classes |= own
        for k in articles:
            core[k] |= named[k] == k and not classes.isdisjoint(self._article_classes(k))
        for k in range(n - 1, 0, -1):
            core[self.parent[k]] |= core[k]
        return core

    def _kept(self) -> list[bool]:
        """Whether each node is outside all furniture.  A layout name does not cut an element that
        holds an article or main heading; a cut name or a form does not cut one that is or holds the
        page's own, and a form with paragraphs and more than half of the page's text is not cut."""
        holds = [t in ("article", "main", "h1") for t in self.tag]
        prose = [t == "p" for t in self.tag]
        for k in range(len(self.parent) - 1, 0, -1):
            holds[self.parent[k]] |= holds[k]
            prose[self.parent[k]] |= prose[k]
        late = NAMED in self.cut or FORM in self.cut
        sizes = self._sizes() if late else []
        core = self._core(sizes) if late else []
        kept = [True]
        for k in range(1, len(self.parent)):
            why = self.cut[k]
            cut = (why == FURNITURE or why == LAYOUT and not holds[k] or why == NAMED and not core[k]
                   or why == FORM and not core[k] and not (prose[k] and 2 * sizes[k] > sizes[0]))
            kept.append(kept[self.parent[k]] and not cut)
        return kept

    def best(self) -> tuple[int, float]:
        """The best container (-1: the page has no text) and its score."""
        kept, score = self._kept(), {}
        for node, block, links in self.blocks:
            if not kept[node]:
                continue
            weight = (1 + block.count(",") + min(len(block) / 100, 3)) * max(0.0, 1 - links / (len(block) + 1)) + 1e-6 * len(block)
            home = node
            while home > 0 and self.tag[home] in LEAF:
                home = self.parent[home]
            score[home] = score.get(home, 0.0) + weight
            up = self.parent[home]
            if up >= 0:
                score[up] = score.get(up, 0.0) + 0.6 * weight
        if not score:
            return -1, 0.0
        top = max(score, key=lambda k: (score[k], k))
        value, up = score[top], top
        while up > 0:                                   # the article around it, if there is one
            if self.tag[up] in ("article", "main"):
                top = up
            up = self.parent[up]
        return top, value

    def named(self, node: int) -> str:
        labels = []
        while node > 0:
            labels.append(self.label[node])
            node = self.parent[node]
        return ">".join(reversed(labels[:64]))

    def text(self, path: int | None) -> str:
        """The blocks inside the nodes on a path, or inside the best container."""
        kept = self._kept()
        if path is not None and path in self.path:
            inside = [p == path for p in self.path]
            for k in range(1, len(inside)):
                inside[k] |= inside[self.parent[k]]
            found = "\n".join(b for node, b, _ in self.blocks if inside[node] and kept[node])
            if found:
                return found
        top, _ = self.best()
        if top < 0:
            return ""
        inside = [False] * len(self.parent)
        inside[top] = True
        for k in range(top + 1, len(inside)):
            inside[k] |= inside[self.parent[k]]
        return "\n".join(b for node, b, _ in self.blocks if inside[node] and kept[node])


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit("")))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def votes(pages: DataFrame) -> DataFrame:
    """host, path, path_name, score of each page's best container (pages with text only)."""

    def vote(sources: pd.Series) -> pd.DataFrame:
        rows = []
        for source in sources:
            page = Page(source or "")
            top, score = page.best()
            rows.append((None, None, 0.0) if top < 0 else (_signed(page.path[top]), page.named(top), score))
        out = pd.DataFrame(rows, columns=["path", "path_name", "score"])
        return out.astype({"path": "Int64"})

    rows = pages.select("host", F.pandas_udf(vote, "path bigint, path_name string, score double")("html").alias("v"))
    return rows.select("host", "v.*").where("path IS NOT NULL")


def consensus(votes: DataFrame) -> DataFrame:
    """host, path, path_name: the path with the most votes, then the higher total score."""
    tally = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round("score", 3)).alias("score"),
                                              F.min("path_name").alias("path_name"))
    best = F.max(F.struct("n", F.round("score", 2).alias("score"), "path", "path_name")).alias("best")
    return tally.groupBy("host").agg(best).select("host", "best.path", "best.path_name")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    session_of(pages)
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    winners = stored(consensus(votes(rows)), "host-paths").select(F.col("host").alias("_host"), "path")

    def extracted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sources, paths in batches:
            yield pd.Series([Page(source or "").text(None if pd.isna(path) else int(path) % (1 << 64))
                             for source, path in zip(sources, paths.astype("Int64"))], dtype="object")

    rows = rows.join(winners, F.col("host") == F.col("_host"), "left")
    return rows.select("page_id", "url", F.pandas_udf(extracted, "string")("html", "path").alias("text")) \
               .withColumn("n_chars", F.char_length("text").cast("bigint"))
