"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into text blocks at block-level tags. A block is described by its own and its neighbours' word counts and
link densities and by the kind of element around it; a decision tree, trained on the small labelled table below, tells main text from the rest.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "inside_main", "inside_furniture")

#: The labelled table: the features of a block, and whether it is main text. Made up by hand for training.
LABELLED = [
    # Blocks within an article or main element, of any length, with or without links.
    (120, 0.00, 80, 0.00, 95, 0.00, 1, 0, 1), (1, 0.00, 60, 0.00, 70, 0.00, 1, 0, 1), (2, 0.00, 0, 0.00, 3, 0.00, 1, 0, 1), (8, 0.00, 6, 1.00, 45, 0.00, 1, 0, 1),
    (14, 0.20, 33, 0.05, 0, 0.00, 1, 0, 1), (30, 0.45, 3, 0.00, 12, 0.00, 1, 0, 1), (1, 1.00, 25, 0.10, 40, 0.00, 1, 0, 1), (5, 1.00, 4, 1.00, 6, 1.00, 1, 0, 1),
    (400, 0.02, 7, 0.00, 3, 1.00, 1, 0, 1), (3, 0.00, 2, 1.00, 2, 1.00, 1, 0, 1), (0, 0.00, 9, 0.00, 9, 0.00, 1, 0, 1), (55, 0.00, 0, 0.00, 0, 0.00, 1, 0, 1),
    # Menus, headers, footers, sidebars, notices, adverts, forms and comments, also within an article.
    (1, 1.00, 1, 1.00, 1, 1.00, 0, 1, 0), (3, 0.00, 1, 1.00, 15, 0.00, 0, 1, 0), (40, 0.00, 2, 1.00, 9, 0.00, 0, 1, 0), (90, 0.00, 70, 0.00, 85, 0.00, 0, 1, 0),
    (12, 0.30, 60, 0.00, 0, 0.00, 0, 1, 0), (25, 0.00, 130, 0.00, 30, 0.00, 1, 1, 0), (2, 1.00, 100, 0.00, 110, 0.00, 1, 1, 0), (7, 0.00, 0, 0.00, 140, 0.00, 1, 1, 0),
    (60, 0.10, 50, 0.00, 45, 0.20, 1, 1, 0), (350, 0.00, 20, 0.00, 20, 0.00, 0, 1, 0), (0, 0.00, 2, 0.00, 50, 0.00, 0, 1, 0), (18, 0.00, 18, 0.00, 18, 0.00, 1, 1, 0),
    # No telling element around: text in sentences is main text, and short blocks between such blocks; link lists and lone phrases are not.
    (85, 0.00, 60, 0.00, 70, 0.00, 0, 0, 1), (45, 0.10, 3, 1.00, 50, 0.00, 0, 0, 1), (30, 0.00, 40, 0.05, 2, 1.00, 0, 0, 1), (28, 0.25, 65, 0.00, 45, 0.00, 0, 0, 1),
    (7, 0.00, 75, 0.00, 66, 0.00, 0, 0, 1), (3, 0.00, 48, 0.00, 90, 0.00, 0, 0, 1), (6, 0.00, 2, 1.00, 110, 0.00, 0, 0, 1), (220, 0.05, 0, 0.00, 0, 0.00, 0, 0, 1),
    (17, 0.00, 35, 0.00, 1, 1.00, 0, 0, 1), (64, 0.30, 10, 0.00, 12, 0.00, 0, 0, 1), (20, 0.00, 0, 0.00, 24, 0.00, 0, 0, 1), (22, 0.00, 21, 0.00, 0, 0.00, 0, 0, 1),
    (1, 1.00, 1, 1.00, 2, 1.00, 0, 0, 0), (2, 1.00, 70, 0.00, 1, 1.00, 0, 0, 0), (5, 0.80, 3, 1.00, 60, 0.00, 0, 0, 0), (40, 0.85, 50, 0.00, 45, 0.00, 0, 0, 0),
    (3, 0.00, 2, 1.00, 2, 1.00, 0, 0, 0), (6, 0.00, 4, 0.50, 0, 0.00, 0, 0, 0), (9, 0.50, 8, 0.40, 5, 0.00, 0, 0, 0), (4, 0.00, 0, 0.00, 3, 1.00, 0, 0, 0),
    (12, 0.60, 90, 0.00, 80, 0.00, 0, 0, 0), (2, 0.00, 5, 0.00, 1, 0.00, 0, 0, 0), (15, 1.00, 1, 1.00, 1, 1.00, 0, 0, 0), (0, 0.00, 1, 1.00, 1, 1.00, 0, 0, 0),
]

_MAIN = frozenset("article main".split())
_FURNITURE = frozenset("nav header footer aside form dialog menu".split())
#: Elements whose contents HTML reads as raw text; without an end tag they last to the end of the page.
_RAW = frozenset("script style title textarea iframe".split())
#: Form controls and inert parts, whose contents are left out as well; without an end tag of their own they end at the next block-level tag.
_HIDDEN = frozenset("select button template".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_HELD = frozenset("address article aside blockquote details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split())
#: A class, id or role that names furniture: one of these words as a whole, with words of place ahead or of form behind.
_HINT = re.compile(
    r"(?:(?:site|page|global|main|top|bottom|left|right|primary|secondary|mobile|sticky|fixed|post|entry|article|block)[-_]?)*"
    r"(?:ads?|advert(?:s|isements?|ising)?|sponsor(?:s|ed)?|promo(?:s|tions?)?|banners?|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|newsletters?|subscribe|subscriptions?|sidebars?|menus?|nav|navigation|breadcrumbs?|"
    r"foot|footer|masthead|header|comments?|disqus|respond|replies|share|sharing|socials?|related|recommend(?:ed|ations?)?|login|signup|paywall|toolbars?|widgets?|copyright|disclaimer)"
    r"(?:[-_]?(?:ads?|banners?|notices?|popups?|modals?|menus?|nav|navigation|comments?|widgets?|footer|header|bars?|boxes|box|blocks?|lists?|links?|buttons?|icons?|items?|posts?|articles|stories|threads?|forms?|areas?|slots?|units?|panels?|"
    r"containers?|wrapper|wrap|inner|overlay|dialog|text|left|right|top|bottom|primary|secondary|[0-9]))*+",
    re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""(?i)(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""")
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
#: What no form holds but one that is put around a whole page, by element or by attributes.
_PAGE = frozenset("nav article main footer".split())
_PAGE_FORM = re.compile(r"(?i)aspnetForm|__VIEWSTATE")
_EDGE = re.compile(rf"<(/?)({'|'.join(sorted(_BLOCK - {'option', 'head'}))})(?=[\s/>])", re.IGNORECASE)
#: Block-level elements that have to be ended.
_ENDED = _HELD | frozenset("body caption center dir fieldset figcaption h1 h2 h3 h4 h5 h6 hgroup html pre summary".split())


@dataclass
class _Text:
    text: str
    words: int
    linked: int
    main: bool
    furniture: bool


def _ends(page: str, name: str) -> dict[int, tuple[int, int]]:
    """The limits of the end tags of all elements of a name that have one, by the start of the element. Only templates are nested."""
    out: dict[int, tuple[int, int]] = {}
    opened: list[int] = []
    for m in re.finditer(f"<(/?){name}(?=[\\s/>])[^>]*>?", page, re.IGNORECASE):
        if not m[1]:
            opened = [*opened, m.start()] if name == "template" and len(opened) < 64 else [m.start()]
        elif opened:
            out[opened.pop()] = m.span()
    return out


def _after(page: str, name: str, start: int, at: int, ends: dict[int, tuple[int, int]]) -> int:
    """Where the page goes on after a hidden element that starts at ``start`` and whose contents start at ``at``."""
    last = ends.get(start)
    depth, first = 0, len(page)
    for m in _EDGE.finditer(page, at, last[0] if last else len(page)):
        first = min(first, m.start())
        depth += (-1 if m[1] else 1) if m[2].lower() in _ENDED else 0
        if depth < 0 or not last:  # its parent ends first, or it has no end
            return first
    return last[1] if last else first


def _hinted(name: str, attributes: str, inside: bool) -> bool:
    """Whether a class, id or role names furniture. The ids of sections inside an article are those of its headings."""
    found = [(kind.lower(), (a or b or c).split()) for kind, a, b, c in _ATTRIBUTE.findall(attributes)]
    heading = inside and (name == "section" or any(kind == "class" and "section" in tokens for kind, tokens in found))
    return any(len(x) <= 64 and _HINT.fullmatch(x) for kind, tokens in found if kind != "id" or not heading for x in tokens)


def blocks(page: str) -> list[_Text]:
    """The text blocks of a page in order, without those that are empty. Contents of scripts, styles, form controls and the like are left out.

    Furniture around an article or main element doesn't count inside it if it is a form or header, if the element is main, or if no
    article of the page stands in less. A form around the page is not furniture.
    """
    out: list[_Text] = []
    around: list[tuple[int, int]] = []  # for each block, the furniture around its article, and the innermost form it is in
    parents: list[int] = []  # of each form, the form around it, or -1
    wide: set[int] = set()  # forms around a page
    reached: set[int] = set()  # forms that are wide with all that are around them
    form = held_form = -1
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, str]] = []
    main = outside = 0
    count = {"around": 0, "light": 0, "inside": 0}  # furniture around articles, headers around articles, furniture inside
    link = False
    ends: dict[str, dict[int, tuple[int, int]]] = {}
    opened: Counter[str] = Counter()

    def close() -> None:
        if parts:
            words = html.unescape("".join(parts)).split()
            if words:
                out.append(_Text(" ".join(words), len(words), len(html.unescape(" ".join(linked)).split()), main > 0, count["inside"] > 0 or (not main and count["around"] + count["light"] > 0)))
                around.append((outside if main else 0, form))
            parts.clear()
            linked.clear()

    at, n = 0, len(page)
    while at < n:
        to = page.find("<", at)
        if to < 0:
            to = n
        if to > at:
            parts.append(page[at:to])
            if link:
                linked.append(parts[-1])
        if to == n:
            break
        after = page[to + 1 : to + 2]
        if page.startswith("<!--", to):
            end = page.find("-->", to + 4)
            at = n if end < 0 else end + 3
            continue
        if after in ("!", "?"):
            end = page.find(">", to)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, to)
        if not m:
            if after == "/" or after.isalpha():  # a tag that does not end, or whose quotes don't
                end = page.find(">", to)
                at = n if end < 0 else end + 1
            else:
                parts.append("<")
                at = to + 1
            continue
        at, name, ending = m.end(), m[2].lower(), m[1] == "/"
        if name == "a":
            link = not ending
        if name in _RAW:
            if not ending and not m[3].endswith("/"):
                close_tag = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
                at = close_tag.end() if close_tag else n
            continue
        if name in _HIDDEN:
            if not ending:
                if name not in ends:
                    ends[name] = _ends(page, name)
                at = _after(page, name, m.start(), at, ends[name])
            continue
        if form >= 0 and not ending and (name in _PAGE or (name == "input" and _PAGE_FORM.search(m[3]))):
            reached.add(form)
        if name not in _BLOCK:
            continue
        close()
        if name not in _HELD:
            continue
        if not ending:
            hint = name != "main" and _hinted(name, m[3], main > 0)
            where = ""
            if name == "form" and not hint:
                where = "form"
                parents.append(form)
                form = len(parents) - 1
                if _PAGE_FORM.search(m[3]):
                    wide.add(form)
            elif hint or name in _FURNITURE:
                where = "inside" if main else "light" if name == "header" and not hint else "around"
                count[where] += 1
            if name in _MAIN and not main:
                outside = 0 if name == "main" else count["around"]
                held_form, form = form, -1
            main += name in _MAIN
            stack.append((name, name in _MAIN, where))
            opened[name] += 1
        elif opened[name]:
            while True:
                last, is_main, where = stack.pop()
                opened[last] -= 1
                main -= is_main
                if is_main and not main:
                    form = held_form
                if where == "form":
                    form = parents[form]
                elif where:
                    count[where] -= 1
                if last == name:
                    break
    close()
    least = min((x for b, (x, _) in zip(out, around, strict=True) if b.main), default=0)
    # A form starts behind the one around it: what reaches a form reaches those around it, and one that is not wide marks all within it.
    for f in range(len(parents) - 1, -1, -1):
        if f in reached:
            reached.add(parents[f])
    narrow = [False] * (len(parents) + 1)
    for f, parent in enumerate(parents):
        narrow[f] = narrow[parent] or not (f in wide or f in reached)
    for b, (x, inside) in zip(out, around, strict=True):
        b.furniture |= x > least or narrow[inside]
    return out


def features(found: list[_Text]) -> np.ndarray:
    """The features of a page's blocks, in the order of FEATURES."""
    size = np.array([0, *(b.words for b in found), 0], float)
    links = np.array([0, *(b.linked / b.words for b in found), 0], float)
    kind = np.array([(b.main, b.furniture) for b in found], float).reshape(-1, 2)
    return np.column_stack([size[1:-1], links[1:-1], size[:-2], links[:-2], size[2:], links[2:], kind])


@dataclass
class DecisionTree:
    """A binary tree of threshold tests: (feature, threshold, node if at most, node if above), or (-1, label, 0, 0) for a leaf."""

    nodes: list[tuple[int, float, int, int]]

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 1) -> DecisionTree:
        """Split by the largest fall in Gini impurity, down to pure leaves or ``depth``; ties go to the first feature and threshold."""
        tree = cls([])

        def impurity(labels: np.ndarray) -> float:
            p = labels.mean()
            return len(labels) * 2 * p * (1 - p)

        def grow(rows: np.ndarray, left: int) -> int:
            at = len(tree.nodes)
            tree.nodes.append((-1, float(y[rows].mean() >= 0.5), 0, 0))
            best = (impurity(y[rows]) - 1e-9, -1, 0.0)
            if left and best[0] > 0:
                for f in range(x.shape[1]):
                    values = np.unique(x[rows, f])
                    for cut in (values[1:] + values[:-1]) / 2:
                        low = x[rows, f] <= cut
                        if least <= low.sum() <= len(rows) - least and (got := impurity(y[rows[low]]) + impurity(y[rows[~low]])) < best[0] - 1e-9:
                            best = (got, f, float(cut))
            if best[1] >= 0:
                low = x[rows, best[1]] <= best[2]
                tree.nodes[at] = (best[1], best[2], grow(rows[low], left - 1), grow(rows[~low], left - 1))
            return at

        grow(np.arange(len(y)), depth)
        return tree

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        todo = [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            feature, cut, low, high = self.nodes[at]
            if feature < 0:
                out[rows] = cut >= 0.5
            else:
                less = x[rows, feature] <= cut
                todo += [(low, rows[less]), (high, rows[~less])]
        return out


def train(labelled: list[tuple[float, ...]] = LABELLED) -> DecisionTree:
    table = np.array(labelled, float)
    return DecisionTree.fit(table[:, :-1], table[:, -1])


def _extract(tree: DecisionTree):
    def run(batches):
        for batch in batches:
            pages = [blocks(x or "") for x in batch.column("html").to_pylist()]
            keep = tree.predict(np.concatenate([features(p) for p in pages]) if pages else np.zeros((0, len(FEATURES))))
            texts, at = [], 0
            for page in pages:
                texts.append(" ".join(b.text for b, k in zip(page, keep[at : at + len(page)], strict=True) if k))
                at += len(page)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, tree: DecisionTree | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page: ``page_id``, ``url``, ``text`` and ``n_chars`` (its code points), one row per input row.

    Character references are decoded, white space in a block becomes one space, blocks are joined in page order by one space.
    A null or empty page, or one without main text, gives an empty text. Unclosed elements last until an enclosing one ends, or to the end of the page;
    an unclosed comment, script, style, title, text area or inner frame hides the rest, an unclosed button, list of choices or template what is ahead of the next block. Null ids and urls stay null, repeated rows are extracted each for itself,
    other columns are ignored, an empty table gives no rows.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(_extract(tree or train()), "page_id long, url string, text string, n_chars long")
