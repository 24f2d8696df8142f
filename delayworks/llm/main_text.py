"""Main text of web pages by the maximum-scoring subsequence.

A page is a row of words and tags. Words score by what any page shows of them: the block element around
them, whether they are a link, and how many words the block has. Tags cost something each. Both
weights are learned from labelled pages, which are those that mark their text by an ``article`` or ``main``
element: the marks say which words are text, and are never looked at when a page is scored. One linear scan finds the contiguous region with the
greatest sum. What stands in menus, forms, adverts, comments and the like counts for nothing in
the sum and is left out of the text.
"""

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from math import log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.llm.tables import drawn, ship

SAMPLE = 500
CLIP = 3.0
LEAST_COST = 0.01
BOILERPLATE_SHARE = 0.25
#: Places with fewer labelled words have no weight of their own.
LEAST_SEEN = 10
DEFAULT_WORD, DEFAULT_TAG = 1.0, -0.3
#: Blocks of 2 ** (this - 1) words and more are alike.
MOST_DOUBLINGS = 6

# HTML's raw, void, inline and boilerplate elements, and names that mark boilerplate.
RAW = "script style noscript template title textarea iframe svg math object canvas audio video".split()
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
BOILERPLATE = set("nav footer aside form button select dialog menu fieldset".split())
HINTS = set(
    "ad ads advert adverts advertisement banner sidebar comment comments cookie cookies consent notice notices promo "
    "share sharing social menu nav navbar navigation footer header masthead subscribe newsletter popup modal related "
    "breadcrumb breadcrumbs widget sponsor sponsored login signup search disclaimer alert toolbar pagination pager "
    "topbar disqus replies reply respond outbrain taboola gdpr complementary contentinfo".split()
)
#: Block elements that words are told apart by; all others, marks too, are alike.
PLACES = set("p h1 h2 h3 h4 h5 h6 li td th dd dt blockquote pre figcaption caption address label".split())
#: Names that mark an article of readers, and words that make a name say what an element has, not what it is.
READERS = set("comment comments reply replies respond".split())
LAYOUT = {"has", "with", "no", "without"}
#: Elements inside of which a header may be that of a text.
_DEEP = {"article", "main", "section", "div"}
_RAW = "|".join(RAW)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/)?(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME_PARTS = re.compile(r"[^a-z]+")


def _is_boilerplate(name: str, rest: str) -> bool:
    if name in BOILERPLATE:
        return True
    if name in ("html", "body") or not rest.strip(" /"):
        return False
    hints = READERS if name in ("article", "main") else HINTS
    for key, *values in _ATTRIBUTE.findall(rest):
        if key.lower() == "hidden":
            return True
        for token in "".join(values).lower().split():
            parts = _NAME_PARTS.split(token)
            if not hints.isdisjoint(parts) and parts[0] not in LAYOUT:
                return True
    return False


def _site_headers(found: list[re.Match]) -> set[int]:
    """Places in the list of the ``header`` elements of a site: they hold several links, a menu or a form, or
    stand right in the body. Those of a text hold its heading."""
    out, open_headers, depth = set(), [], 0
    for i, tag in enumerate(found):
        name = (tag["name"] or "").lower()
        if tag["close"]:
            if name == "header" and open_headers:
                open_headers.pop()
            depth -= name in _DEEP
        elif name == "header":
            open_headers.append([i, 0])
            if depth <= 0:
                out.add(i)
        elif name:
            depth += name in _DEEP
            for header in open_headers:
                header[1] += (name == "a") + 2 * (name in BOILERPLATE)
                if header[1] > 1:
                    out.add(header[0])
    return out


def _never_closed(found: list[re.Match]) -> set[int]:
    """Places in the list of the opening tags that no closing tag of their name belongs to."""
    waiting: dict[str, list[int]] = {}
    for i, tag in enumerate(found):
        name = (tag["name"] or "").lower()
        if tag["close"]:
            if waiting.get(name):
                waiting[name].pop()
        elif name:
            waiting.setdefault(name, []).append(i)
    return {i for places in waiting.values() for i in places}


def tokens(page: str, ending: bool = False) -> Iterator[tuple[str, str, bool, bool, tuple]]:
    """(kind, content, in the marked element, in boilerplate, place); kinds: text, open, close.

    The place of words is the innermost element around them that isn't inline, if it is one of ``PLACES``, and whether
    they are a link. Elements that are never closed end with those around them; an ``article`` or ``main`` ends
    boilerplate before it that is never closed, with ``ending`` any boilerplate that is open.
    """
    stack: list[tuple[str, bool, int]] = []
    held: Counter[str] = Counter()  # open elements by name
    blocks: list[str] = []  # open elements that aren't inline
    marked = skipped = at = 0
    row = list(_TOKEN.finditer(page))
    never, headers = _never_closed(row), _site_headers(row)

    def place() -> tuple:
        return (blocks[-1] if blocks and blocks[-1] in PLACES else "", held["a"] > 0)

    for i, found in enumerate(row):
        if found.start() > at:
            yield "text", page[at : found.start()], marked > 0, skipped > 0, place()
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["close"]:
            yield "close", name, marked > 0, skipped > 0, ()
            while held[name]:
                popped, skip, _ = stack.pop()
                held[popped] -= 1
                if popped not in INLINE:
                    blocks.pop()
                skipped -= skip
                marked -= popped in ("article", "main") and not skip
                if popped == name:
                    break
            continue
        skip = i in headers or _is_boilerplate(name, found["rest"])
        if name in ("article", "main") and not skip and not marked and skipped:
            stack = [(n, s and not ending and k not in never, k) for n, s, k in stack]
            skipped = sum(s for _, s, _ in stack)
        yield "open", name, marked > 0, skipped > 0 or skip, ()
        if name not in VOID and not found["rest"].endswith("/"):
            stack.append((name, skip, i))
            held[name] += 1
            if name not in INLINE:
                blocks.append(name)
            skipped += skip
            marked += name in ("article", "main") and not skip
    if at < len(page):
        yield "text", page[at:], marked > 0, skipped > 0, place()


def _is_marked(row: Iterable[tuple]) -> bool:
    """Whether words stand in an ``article`` or ``main`` that isn't boilerplate."""
    return any(kind == "text" and marked and not skipped and content.strip() for kind, content, marked, skipped, _ in row)


def _features(row: list[tuple]) -> list[tuple | None]:
    """For each token of a row, what its words or its tag are scored by, the finest first.

    In blocks of no telling element only the number of words tells, so one of a size never seen has no weight.
    """
    sizes, block, of = Counter(), 0, []
    for kind, content, *_ in row:
        block += kind != "text" and content not in INLINE
        of.append(block)
        if kind == "text":
            sizes[block] += len(content.split())
    out: list[tuple | None] = []
    for (kind, content, _, _, place), number in zip(row, of):
        if kind == "text":
            finest = ("place", *place, min(MOST_DOUBLINGS, sizes[number].bit_length()))
            out.append((finest,) if place == ("", False) else (finest, ("place", *place)))
        else:
            out.append((("tag", "" if content in ("article", "main") else content),))
    return out


def learn(pages: Iterable[str]) -> dict[tuple, float]:
    """Weights from pages that mark their text: log odds of a word or tag of some kind standing in it.

    What stands outside of the mark, and boilerplate inside of it, is no text; boilerplate counts by
    ``BOILERPLATE_SHARE``, as it is left out of pages by its names and only tells of its like without them. Tags never score above
    ``-LEAST_COST`` and cost ``-DEFAULT_TAG`` at most. Places that weren't seen often enough have no weight of their own.
    """
    inside, outside = Counter(), Counter()
    for row in filter(_is_marked, map(list, map(tokens, pages))):
        for (kind, content, marked, skipped, _), keys in zip(row, _features(row)):
            for key in keys:
                n = len(content.split()) if kind == "text" else 1
                (inside if marked and not skipped else outside)[key] += n * BOILERPLATE_SHARE if skipped else n
    weights: dict[tuple, float] = {}
    tags = {key for key in {*inside, *outside} if key[0] == "tag"}
    total_in, total_out = (sum(c[key] for key in tags) + 1 for c in (inside, outside))
    for key in {*inside, *outside}:
        if key in tags:
            odds = log((inside[key] + 0.5) / total_in) - log((outside[key] + 0.5) / total_out)
            weights[key] = max(DEFAULT_TAG, min(-LEAST_COST, odds))
        elif inside[key] + outside[key] >= LEAST_SEEN:
            weights[key] = max(-CLIP, min(CLIP, log((inside[key] + 0.5) / (outside[key] + 0.5))))
    for size in reversed(range(MOST_DOUBLINGS)):  # where longer blocks are no text, shorter ones never seen aren't either
        key, longer = (("place", "", False, n) for n in (size, size + 1))
        if key not in weights and weights.get(longer, 0.0) < 0:
            weights[key] = weights[longer]
    return weights


def scores(row: list[tuple], weights: dict[tuple, float]) -> list[float]:
    """What each token of a row adds to a region's sum: the weight of the finest feature known, per word."""
    out = []
    for (kind, content, _, skipped, _), keys in zip(row, _features(row)):
        weight = next((weights[k] for k in keys if k in weights), DEFAULT_WORD if kind == "text" else DEFAULT_TAG)
        out.append(0.0 if skipped else weight * len(content.split()) if kind == "text" else weight)
    return out


def best_region(values: Sequence[float]) -> tuple[int, int]:
    """The contiguous region with the greatest sum, the first and shortest of several; (0, 0) if none is above zero."""
    best = total = 0.0
    start, region = 0, (0, 0)
    for i, value in enumerate(values):
        total += value
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, region = total, (start, i + 1)
    return region


def _joined(row: list[tuple]) -> str:
    parts: list[str] = []
    for kind, content, _, skipped, _ in row:
        if kind != "text":
            if content not in INLINE:
                parts.append("\0")
        elif not skipped:
            parts.append(content)
    blocks = (" ".join(html.unescape(block).split()) for block in "".join(parts).split("\0"))
    return " ".join(filter(None, blocks))


def extract(page: str, weights: dict[tuple, float]) -> str:
    """The text of the best region; empty if no region scores above zero.

    Where the learned weights of words find nothing, every word scores ``DEFAULT_WORD``; at last an
    ``article`` inside of boilerplate counts as text.
    """
    row = list(tokens(page))
    plain = {key: weight for key, weight in weights.items() if key[0] != "place"}
    rows = [(row, weights), (row, plain)]
    if any(kind == "open" and name in ("article", "main") for kind, name, *_ in row):
        rows.append((list(tokens(page, ending=True)), plain))
    for found, by in rows:
        if text := _joined(found[slice(*best_region(scores(found, by)))]):
            return text
    return ""


def labelled_pages(pages: DataFrame, sample: int = SAMPLE, html_col: str = "html") -> list[str]:
    """About ``sample`` pages, by hash, of those that mark their text; copies once."""
    marked = pages.where(F.col(html_col).rlike(r"(?i)<(article|main)\b")).select(F.col(html_col).alias("html"))
    return sorted(r["html"] for r in drawn(marked, sample, "html").distinct().collect())


def main_text(pages: DataFrame, weights: dict[tuple, float], html_col: str = "html", into: str = "text") -> DataFrame:
    """The pages with their main text in a further column (a column of that name is replaced)."""
    ship(pages.sparkSession)

    @F.pandas_udf("string")
    def text_of(documents: pd.Series) -> pd.Series:
        return documents.map(lambda page: extract(page, weights))

    return pages.withColumn(into, text_of(F.coalesce(F.col(html_col).cast("string"), F.lit(""))))
