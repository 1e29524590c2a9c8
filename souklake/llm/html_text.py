"""HTML main text by tag-path ratios.

A page is read once into text pieces. A piece has the root-to-leaf path of the block elements that hold
it (tags with class and id, without numbers). Per path, text length, punctuation, link text and the number
of blocks are added up; a path's score fuses its text per block with its punctuation per block, scores are
smoothed over neighbouring paths in page order, weighted by length, and paths from the threshold on are
content. The threshold is a share of the length-weighted standard deviation of the page's scores, so
that it follows the page, but never below a share of their mean.

What elements are called only changes scores: `article` and `main` add a prior, a class, id or role
that is nothing but a name of boilerplate (`site-footer`, `cookie-banner`, `comments`; not `has-sidebar`,
`legal-analysis`) multiplies by `PENALTY`. Names do not count at `html`, `body` and `main`, at an element
that holds the page's first `h1`, `article` or `main`, and on pages with hardly any text elsewhere.
Never content is what HTML itself sets apart: `head`, `nav`, `footer`, `aside`, form controls, embedded
objects, a `header` outside articles, hidden elements, a `form` without the page's heading or article.

Nothing else is lost inside content: in an `article` or `main` that is content for the larger part, and in
the parents of content blocks, short paragraphs, lists, quotes, tables and headings are taken with it, except
lists of links. A `div` there is judged by its score, as is a labelled block outside `article` and `main`. A heading
needs taken text behind it.

Blocks are cut at block-level tags and `br`; character references are decoded; white space inside a
block becomes one space; empty blocks go. Null or empty pages have an empty text. Unclosed tags are
closed as HTML's rules close them (`p`, `li`, `td`, ... by the next one); an element to be hidden that is
never closed hides nothing (`script`, `style`, `title` and `textarea` then end with the page, a `footer` with its parent). A
quote that is never closed is an ordinary character, a tag that is never closed is dropped. The time is
linear in the page's length. Other columns are not read; repeated rows are extracted one by one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Share of the standard deviation of path scores from which a path is content.
THRESHOLD = 0.5
#: Share of the mean score below which no path is content, also on a page of even scores; above what
#: two strong neighbours alone give.
LEAST_SHARE = 0.35
#: Weight of a neighbouring path's score.
NEIGHBOUR = 0.25
#: Added to the score of a path within an article or main element, as a share of the mean score.
CONTENT_PRIOR = 0.3
#: Factor of the score of a path below an element named as boilerplate.
PENALTY = 0.1
#: Share of a page's text outside such elements below which their names do not count.
LEAST_OUTSIDE = 0.1

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)")
_ATTRIBUTES = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.IGNORECASE) for tag in ("script", "style", "textarea", "title", "iframe", "noframes", "xmp")}
_MARK = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style)(?=[\s=/]|\Z)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_NUMBER = re.compile(r"\d+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，！？、]")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Tags that a new tag closes, up to the nearest tag that holds them.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_CLOSES_P = BLOCKS - {"br", "body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "title", "summary"}
_HOLDERS = frozenset("div article section main body table td th blockquote".split())
_IN_HEAD = frozenset("base link meta noscript script style template title".split())
_HIDDEN_TAGS = frozenset("head nav aside button select dialog menu canvas audio video object map svg math noscript template datalist".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_CONTENT_TAGS = frozenset(("article", "main"))
_LISTS = frozenset(("ul", "ol", "dl"))
#: Blocks that belong to running text.
_STRUCTURE = _HEADINGS | frozenset(
    "p ul ol li dl dt dd blockquote pre table caption thead tbody tfoot tr th td figure figcaption section details summary header address center".split()
)

# Fixed words of class, id and role names: of boilerplate, and such as only add where or how it is.
_BOILERPLATE = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead banner footer sidebar aside widget related recommended "
    "cookie cookies consent notice gdpr popup modal overlay ad ads advert advertisement advertising sponsor sponsored promo "
    "comment comments disqus reply replies respond share sharing social newsletter subscribe signup login form search pagination pager "
    "toolbar copyright legal complementary contentinfo".split()
)
_NEUTRAL = frozenset(
    "site page global primary secondary main sub top bottom left right inner outer first last wide box section list area wrapper wrap container "
    "bar block item items slot unit group row col column links link post posts article articles body thread text content author meta "
    "dialog panel icons buttons button mobile desktop user reader id div the".split()
)
#: Names that count at an article too: teasers and comments are often articles.
_BESIDE = frozenset("comment comments reply replies respond related recommended ad ads advert advertisement sponsored promo".split())


def _names(value: str, words: frozenset[str]) -> bool:
    """Whether a token of a class, id or role value is a name of boilerplate and nothing else."""
    for token in value.split():
        parts = {word.lower() for word in _WORD.findall(token)}
        if parts & words and parts <= _BOILERPLATE | _NEUTRAL:
            return True
    return False


class Page:
    """Block elements, their paths and the text pieces of a page, in order."""

    def __init__(self, page: str):
        # Elements: parent, tag, path, and whether hidden, within article or main. The first one is the page.
        self.parents, self.tags, self.paths = [0], [""], [0]
        self.hidden, self.content = [False], [False]
        # Paths: parent, label, named as boilerplate, holding the page's heading or article.
        self.path_parents, self.labelled, self.named, self.wrapper = [0], [False], [False], [False]
        self.known: dict[tuple[int, str], int] = {}
        # Pieces: element, block, text, within a link.
        self.pieces: list[tuple[int, int, str, bool]] = []
        self._forms: list[int] = []
        self._read(page)
        for form in self._forms:
            # Elements come after their parents, so one pass hides all that a form holds.
            self.hidden[form] = not self.wrapper[self.paths[form]]
        if self._forms:
            for i in range(1, len(self.tags)):
                self.hidden[i] |= self.hidden[self.parents[i]]

    def _element(self, parent: int, tag: str, label: str, named: bool, hidden: bool) -> int:
        key = (self.paths[parent], tag + label)
        path = self.known.get(key)
        if path is None:
            path = self.known[key] = len(self.path_parents)
            self.path_parents.append(key[0])
            self.labelled.append(bool(label))
            self.named.append(named)
            self.wrapper.append(False)
        self.parents.append(parent)
        self.tags.append(tag)
        self.paths.append(path)
        self.hidden.append(hidden or self.hidden[parent])
        self.content.append(self.content[parent] or tag in _CONTENT_TAGS)
        return len(self.tags) - 1

    def _read(self, page: str) -> None:
        stack: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, element, within a link
        opened: dict[str, int] = {}
        last_end: dict[str, int] = {}
        lower = ""
        at = block = 0
        quotes = True
        seen = set()

        def text(raw: str) -> None:
            _, element, link = stack[-1]
            if raw and not self.hidden[element]:
                self.pieces.append((element, block, html.unescape(raw), link))

        def pop(depth: int) -> None:
            for tag, _, _ in stack[depth:]:
                opened[tag] -= 1
            del stack[depth:]

        while at < len(page):
            start = page.find("<", at)
            if start < 0:
                text(page[at:])
                break
            m = _TAG.match(page, start)
            if not m:
                if page[start + 1 : start + 2] not in ("!", "?", "/") or len(page) < start + 3:
                    text(page[at : start + 1])
                    at = start + 1
                    continue
                text(page[at:start])
                if page.startswith("<!--", start):
                    end = start + 5 if page.startswith("<!-->", start) else page.find("-->", start + 4) + 3
                    at = end if end > start else len(page)
                else:
                    end = page.find(">", start)
                    at = end + 1 if end >= 0 else len(page)
                continue
            text(page[at:start])
            rest = _ATTRIBUTES.match(page, m.end()) if quotes else None
            if rest:
                at = rest.end()
            else:
                quotes = False
                at = page.find(">", m.end()) + 1 or len(page)
            attributes = page[m.end() : at - 1]
            tag = m[2].lower()
            if tag in BLOCKS:
                block += 1
            if m[1]:
                if opened.get(tag):
                    depth = len(stack) - 1
                    while stack[depth][0] != tag:
                        depth -= 1
                    pop(depth)
                continue
            if tag in _RAW_END:
                close = _RAW_END[tag].search(page, at)
                at = close.end() if close else len(page)
                continue
            if tag in VOID or (attributes.endswith("/") and tag in ("svg", "math")):
                continue
            if opened.get("head") and tag not in _IN_HEAD:
                pop(next(d for d, x in enumerate(stack) if x[0] == "head"))
            closed, holders = _CLOSES.get(tag, ((), ()))
            if (tag in _CLOSES_P and opened.get("p")) or any(opened.get(x) for x in closed):
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in closed or (stack[depth][0] == "p" and tag in _CLOSES_P):
                        pop(depth)
                        break
                    if stack[depth][0] in holders or stack[depth][0] in _HOLDERS:
                        break
            _, element, link = stack[-1]
            named, hidden, label = self._marks(tag, attributes)
            header = tag == "header" and not self.content[element]
            if tag in _HIDDEN_TAGS or header or hidden or tag in ("form", "footer"):
                if tag not in last_end:
                    lower = lower or page.lower()
                    last_end[tag] = lower.rfind(f"</{tag}")
                ended = last_end[tag] >= at or tag in ("head", "footer")
                hidden = ended and tag != "form"
                named |= not ended
                if tag == "form" and ended:
                    self._forms.append(len(self.tags))
            if tag in BLOCKS or hidden or named or tag == "form":
                element = self._element(element, tag, label, named, hidden)
            stack.append((tag, element, link or tag == "a"))
            opened[tag] = opened.get(tag, 0) + 1
            if tag in ("h1", "article", "main") and tag not in seen and not hidden and not (named and tag == "article"):
                seen.add(tag)
                holder = self.parents[element]
                while holder:
                    self.wrapper[self.paths[holder]] = True
                    holder = self.parents[holder]

    @staticmethod
    def _marks(tag: str, attributes: str) -> tuple[bool, bool, str]:
        """Whether the names are boilerplate, whether the element is hidden, and its class and id for paths."""
        named, hidden, label = False, False, ""
        if attributes.strip(" \t\n\f\r/"):
            words = frozenset() if tag in ("html", "body", "main") else _BESIDE if tag == "article" else _BOILERPLATE
            for m in _MARK.finditer(attributes):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name == "style":
                    hidden |= "display:none" in value.replace(" ", "").lower()
                elif name in ("hidden", "aria-hidden"):
                    hidden |= name == "hidden" or value.lower() == "true"
                else:
                    label += f" {name}={_NUMBER.sub('', value)}"
                    named |= _names(value, words)
        return named, hidden and tag not in ("html", "body"), label


def content_paths(page: Page, threshold: float = THRESHOLD) -> tuple[set[int], set[int]]:
    """Paths whose smoothed score reaches the threshold, and paths below a name of boilerplate."""
    totals: dict[int, list[float]] = {}
    blocks: set[tuple[int, int]] = set()
    for element, block, text, link in page.pieces:
        if not page.hidden[element] and (size := len(text.strip())):
            path = page.paths[element]
            total = totals.setdefault(path, [0.0, 0.0, 0.0, 0.0, float(page.content[element])])
            total[0] += size
            total[1] += len(_PUNCTUATION.findall(text))
            total[2] += size if link else 0
            if (path, block) not in blocks:
                blocks.add((path, block))
                total[3] += 1
    if not totals:
        return set(), set()
    named = [False] * len(page.named)
    for i in range(1, len(named)):
        named[i] = named[page.path_parents[i]] or (page.named[i] and not page.wrapper[i])
    sizes, marks, linked, counts, content = np.array(list(totals.values())).T
    own = np.maximum(0.0, sizes - linked)
    below = np.array([named[path] for path in totals])
    if own[~below].sum() < LEAST_OUTSIDE * own.sum():
        below[:] = False
    score = np.sqrt(own / counts * (1 + marks) / counts)
    # The prior follows how much of the page's own text is in article or main, so that a teaser gets little of it.
    share = (own * content).sum() / max(1.0, own.sum())
    score += CONTENT_PRIOR * share * content * (score * sizes).sum() / sizes.sum()
    # A neighbour counts with no more text than the path itself has.
    least = np.minimum(sizes[1:], sizes[:-1])
    near, weight = score * sizes, sizes.copy()
    near[1:] += NEIGHBOUR * score[:-1] * least
    near[:-1] += NEIGHBOUR * score[1:] * least
    weight[1:] += NEIGHBOUR * least
    weight[:-1] += NEIGHBOUR * least
    smooth = near / weight * np.where(below, PENALTY, 1.0)
    # Text that a name sets aside does not raise the bar either.
    counted = sizes * ~below
    mean = (smooth * counted).sum() / counted.sum() if counted.any() else 0.0
    spread = np.sqrt((counted * (smooth - mean) ** 2).sum() / max(1.0, counted.sum()))
    bound = min(max(threshold * spread, LEAST_SHARE * mean), mean)
    chosen = {path for path, value, link, size in zip(totals, smooth, linked, sizes) if value >= bound and link < 0.5 * size}
    aside = {path for path, is_named in enumerate(named) if is_named} if below.any() else set()
    return chosen, aside


def _areas(page: Page, chosen: set[int], aside: set[int]) -> tuple[list[bool], list[float]]:
    """Per element, whether blocks of running text in it go with content, and the content text it holds."""
    n = len(page.tags)
    whole, taken, linked = [0.0] * n, [0.0] * n, [0.0] * n
    parents_of_content = set()
    for element, _, text, link in page.pieces:
        size = len(text.strip())
        if size and not page.hidden[element]:
            whole[element] += size
            linked[element] += size if link else 0
            if page.paths[element] in chosen:
                taken[element] += size
                parents_of_content.add(page.parents[element])
    for i in range(n - 1, 0, -1):
        whole[page.parents[i]] += whole[i]
        taken[page.parents[i]] += taken[i]
        linked[page.parents[i]] += linked[i]
    area, marked = [False] * n, [False] * n  # marked: the area is an article or main
    for i in range(1, n):
        above, tag = page.parents[i], page.tags[i]
        larger = taken[i] > 0 and 2 * taken[i] >= whole[i]
        if tag in _CONTENT_TAGS and larger:
            area[i] = marked[i] = True
        elif i in parents_of_content and larger and tag not in ("html", "body"):
            area[i], marked[i] = True, marked[above]
        elif page.paths[i] in aside or (tag in _LISTS and 2 * linked[i] >= whole[i] > 0):
            continue
        elif area[above] and (larger or (tag in _STRUCTURE and (marked[above] or not page.labelled[page.paths[i]]))):
            area[i], marked[i] = True, marked[above]
    return area, taken


def extract(page: str, threshold: float = THRESHOLD) -> str:
    """Main text: content blocks in page order, joined by line feeds."""
    read = Page(page)
    chosen, aside = content_paths(read, threshold)
    area, held = _areas(read, chosen, aside)
    last = list(range(len(read.tags)))  # the last element within each
    for i in range(len(last) - 1, 0, -1):
        last[read.parents[i]] = max(last[read.parents[i]], last[i])
    blocks: dict[int, list[tuple[int, str]]] = {}
    for element, block, text, _ in read.pieces:
        if not read.hidden[element]:
            blocks.setdefault(block, []).append((element, text))
    found: list[str] = []
    behind = None  # the text behind a heading: its element and whether it is taken
    for parts in reversed(blocks.values()):
        heading = read.tags[parts[0][0]] in _HEADINGS
        kept = []
        for element, text in parts:
            path, above = read.paths[element], read.parents[element]
            if read.tags[element] in _HEADINGS:
                if area[above]:
                    taken = behind is None or behind[1] or not above <= behind[0] <= last[above]
                else:
                    taken = held[above] > 0 and behind is not None and behind[1]
            else:
                taken = path in chosen or area[element]
            if taken:
                kept.append(text)
        joined = " ".join("".join(kept).split())
        if not heading and any(text.strip() for _, text in parts):
            behind = parts[0][0], bool(joined)
        if joined:
            found.append(joined)
    return "\n".join(reversed(found))


def extracted(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Id column, the columns to keep, and `text` of each page."""
    pages = pages.select(id_column, *keep, html_column)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page or "") for page in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "text"])

    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in pages.schema.fields[:-1])
    return pages.mapInArrow(task, f"{fields}, text string")
