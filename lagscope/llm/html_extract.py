"""Main text of web pages: the best contiguous region of words and tags.

A page is read as a sequence of words and tags. Words score by their place: the elements
around them and their names, the length of their block and how much of it are links.
Words of the article are positive, others and tags negative. The region with the largest
sum of scores, found in one linear scan, is the article. Parts of it that are negative,
such as an advert between two paragraphs, are left out of the text.

The scores are sums of weights, learned by logistic regression from labelled pages: pages
whose article is marked by an article or main element show which words lie inside. The
mark itself is no feature. Each place is learned twice, with the names and kinds
of the elements around it and without, so that lengths, links and paragraphs also decide
where names are unknown. Weights start from fixed ones, which serve where there are no
labelled pages and on pages where nothing looks like an article. An element that holds
most of a page's words is no menu or advert, whatever its name.

Places are counted on a bounded sample, ``SAMPLE`` pages with the smallest hash of their
id; all pages are then judged by the weights alone.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import with_id, without_null

SAMPLE = 2000
#: Different places that are learned from, the most frequent ones.
PLACES = 2000

#: Elements whose content is no text at all.
_RAW = "script|style|noscript|template|iframe|object|svg|math|textarea|title|noembed|noframes|xmp"
#: Attributes with quoted values, which may hold ">"; with broken quotes up to the next ">".
_REST = r"(?:(?:[^<>\"']+|\"[^\"<]*\"|'[^'<]*')*+>|[^<>]*>?)"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})(?![^\s/>]){_REST}"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>{_REST})"
    r"|<[!?/][^<>]*>?"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_RAW_END = re.compile(rf"</({_RAW})\s*>", re.I)
#: What holds no tags: without an end tag they go on to the end of the page.
_SCRIPTS = frozenset(("script", "style"))
#: Elements that begin and end a block of text.
_BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p"
    " pre section select summary table tbody td tfoot th thead tr ul caption".split()
)
_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(_BLOCKS))})(?![^\s/>])", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that may be left open.
_REPEATED = frozenset("p li dt dd option tr td th".split())
_BOILERPLATE = frozenset("nav header footer aside form button select menu dialog label".split())
#: Class, id and role values, or parts of them, that name what is no text.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsored sponsor promo promotion menu nav navbar"
    " navigation sidebar side-bar breadcrumb breadcrumbs footer header masthead cookie cookies consent notice"
    " notices gdpr comment comments disqus replies respond reactions related recommended share sharing social"
    " newsletter subscribe subscription signup login popup modal widget pagination pager toolbar"
    " complementary contentinfo search skip discussion discussions".split()
)
#: Each attribute of a tag, with its value.
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_SPACES = re.compile(r"\s+")
#: An element of such a name or kind counts for nothing if its words are more than so many
#: times those outside of any.
_LIFTED = {"kind": 3, "named": 3, "part": 1}
#: What a run of negative words costs at most, and a tag.
_MOST_FOR_A_RUN = -8.0
_FOR_A_TAG = -0.1
#: On a page that marks its article, what stands outside costs so much more. This is
#: fixed and not learned.
_OUTSIDE = -6.0
#: Blocks within the region stay at this score of a word or more.
_LEAST = -1.0
#: Elements that say nothing of the words in them, and the marks of an article.
_PLAIN = frozenset("html body head article main div span section center b i em strong u s small big font sub sup".split())
#: Weights to begin with. Elements that are not listed have none.
_FIXED = {
    "": 0.5,
    "named": -8.0,
    "part": -6.0,
    **{f"in:{tag}": -6.0 for tag in _BOILERPLATE},
    "in:a": -1.0,
    "in:p": 1.0,
    "in:li": 2.0,
    "in:ul": 0.3,
    "in:ol": 0.3,
    **{f"in:h{n}": 1.5 for n in (1, 2)},
    "links:most": -2.0,
    "links:some": -0.5,
    "words:2": -0.5,
    "words:40": 0.5,
    "bare": -0.3,
}
#: What names and kinds of elements say; the rest is the structure of a page.
_NAMED_FEATURES = frozenset(("named", "part", *(f"in:{tag}" for tag in _BOILERPLATE)))
#: How strongly weights are held at the fixed ones, and words that are learned from in effect.
_HELD, _EFFECTIVE = 1.0, 400.0

def _flag(tag: str, attributes: str) -> str:
    """What a tag says of all it encloses: ``hidden`` if it isn't shown, ``kind`` if its kind
    is a menu or the like, ``named`` if its class, id or role is a listed name, ``part``
    if that is a part of it, or nothing."""
    found = "kind" if tag in _BOILERPLATE else ""
    if len(attributes) < 4 or tag in ("body", "html"):
        return found
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" and value.lower() != "false":
            return "hidden"
        if name == "style" and _NO_DISPLAY.search(value):
            return "hidden"
        if name in ("class", "id", "role"):
            if not _NAMES.isdisjoint(value.lower().split()):
                found = "named"
            elif not found and not _NAMES.isdisjoint(p.lower() for p in _NAME_PARTS.findall(value)):
                found = "part"
    return "" if tag in ("article", "main") and found != "hidden" else found


class Token:
    """A tag, or the words between two tags: their text, number, whether they begin or end
    a block, the element around them, if the article is open, and their features."""

    __slots__ = ("text", "n", "block", "element", "inside", "features")

    def __init__(self, text: str, n: int, block: bool, element: int, inside: bool):
        self.text, self.n, self.block, self.element, self.inside = text, n, block, element, inside
        self.features: frozenset[str] = frozenset()


class _Place:
    """The elements of a page, by number in page order, and which are open."""

    def __init__(self, article: str):
        self.article = article
        self.tag: list[str] = []
        self.flag: list[str] = []
        #: The element around each, and the words in each outside of others.
        self.up: list[int] = []
        self.own: list[int] = []
        self.stack: list[int] = []
        #: How many elements of each tag are open, so that a stray end tag searches nothing.
        self.open_tags: Counter = Counter()
        self.hidden = self.articles = 0
        #: Headers with a title, which are those of a text.
        self.titled: set[int] = set()

    @property
    def here(self) -> int:
        return self.stack[-1] if self.stack else -1

    def add(self, tag: str, flag: str) -> int:
        self.tag.append(tag)
        self.flag.append(flag)
        self.up.append(self.here)
        self.own.append(0)
        return len(self.tag) - 1

    def open(self, element: int) -> None:
        if self.tag[element] == "h1" and self.open_tags["header"]:
            self.titled.update(e for e in self.stack if self.tag[e] == "header")
        self.stack.append(element)
        self.open_tags[self.tag[element]] += 1
        self.hidden += self.flag[element] == "hidden"
        self.articles += self.tag[element] == self.article

    def close_from(self, at: int) -> None:
        for element in self.stack[at:]:
            self.open_tags[self.tag[element]] -= 1
            self.hidden -= self.flag[element] == "hidden"
            self.articles -= self.tag[element] == self.article
        del self.stack[at:]

    def close(self, tag: str) -> None:
        if not self.open_tags[tag]:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.tag[self.stack[at]] == tag:
                self.close_from(at)
                return

    def end_open(self, tag: str) -> None:
        """An open element ends where the next of its kind begins."""
        for at in range(len(self.stack) - 1, -1, -1):
            name = self.tag[self.stack[at]]
            if name == tag:
                self.close_from(at)
                return
            if name in _BLOCKS:
                return

    def features(self) -> list[frozenset[str]]:
        """What the elements say of the words in each, those around it included."""
        total = list(self.own)
        for at in range(len(total) - 1, -1, -1):
            if self.up[at] >= 0:
                total[self.up[at]] += total[at]
        for at in self.titled:
            if self.flag[at] == "kind":
                self.flag[at] = ""
        # Flagged elements hold what isn't plain; from the outside in, those with most of the
        # page's words count for nothing.
        under = [False] * len(total)
        for at, flag in enumerate(self.flag):
            under[at] = flag in _LIFTED or self.up[at] >= 0 and under[self.up[at]]
        plain = sum(n for n, u in zip(self.own, under, strict=True) if not u)
        lifted: set[int] = set()
        shut = [False] * len(total)
        found: list[frozenset[str]] = []
        for at, (tag, flag, up) in enumerate(zip(self.tag, self.flag, self.up, strict=True)):
            around = found[up] if up >= 0 else frozenset()
            shut[at] = up >= 0 and shut[up]
            if flag in _LIFTED:
                if not shut[at] and total[at] > _LIFTED[flag] * plain:
                    lifted.add(at)
                    plain += self.own[at]
                else:
                    shut[at] = True
            elif not shut[at] and up >= 0 and under[up]:
                # Within a lifted element, but in no other flagged one.
                plain += self.own[at]
            own = set()
            if tag not in _PLAIN and not (at in lifted and tag in _BOILERPLATE) and at not in self.titled:
                own.add(f"in:{tag}")
            if flag in ("named", "part") and at not in lifted:
                own.add(flag)
            found.append(around if around >= own else around | own)
        return found


def _matches(page: str) -> Iterator[re.Match]:
    """Tags, texts and comments in page order; elements whose content is no text are
    passed over. One that isn't closed ends at the next tag of a block."""
    ends: dict[str, list[tuple[int, int]]] = {}
    for m in reversed(list(_RAW_END.finditer(page))):
        ends.setdefault(m[1].lower(), []).append(m.span())
    at, block = 0, -1
    while m := _TOKEN.search(page, at):
        at = m.end()
        if (raw := m["raw"]) is None:
            yield m
            continue
        raw = raw.lower()
        if raw not in _SCRIPTS and m[0].endswith("/>"):
            continue
        left = ends.get(raw, [])
        while left and left[-1][0] < at:
            left.pop()
        if left:
            at = left[-1][1]
        elif raw in _SCRIPTS:
            return
        else:
            # Found once for all unclosed elements before it.
            if block < at:
                found = _BLOCK_TAG.search(page, at)
                block = found.start() if found else len(page)
            at = block


#: Blocks of these elements, or in them, are not bare text.
_TEXT_ELEMENTS = frozenset(f"in:{t}" for t in "p h1 h2 h3 h4 h5 h6 li dd dt td th blockquote pre figcaption caption".split())
_SIZES = (2, 5, 10, 20, 40)


def tokens(page: str | None) -> list[Token]:
    """Words and tags in page order; what isn't shown is left out."""
    page = page or ""
    place = _Place("article" if re.search(r"<article\b", page, re.I) else "main")
    parts: list[Token] = []
    for m in _matches(page):
        if (text := m["text"]) is not None:
            if place.hidden:
                continue
            decoded = entities.unescape(text)
            n = len(decoded.split())
            if place.stack:
                place.own[place.here] += n
            parts.append(Token(decoded, n, False, place.here, place.articles > 0))
            continue
        if (tag := m["tag"]) is None:
            continue
        tag = tag.lower()
        if m["close"]:
            place.close(tag)
        else:
            if tag in _REPEATED:
                place.end_open(tag)
            attributes = m["attributes"]
            if tag not in _VOID and not attributes.endswith("/>"):
                place.open(place.add(tag, _flag(tag, attributes)))
        parts.append(Token("", 0, tag in _BLOCKS, -1, place.articles > 0))
    around = place.features()
    start = 0
    for at in range(len(parts) + 1):
        if at == len(parts) or parts[at].block:
            _describe(parts[start:at], around)
            start = at + 1
    return parts


def _describe(block: list[Token], around: list[frozenset[str]]) -> None:
    """Features of the words of a block, which has no tags of blocks in it."""
    words = [t for t in block if t.n]
    if not words:
        return
    total = sum(t.n for t in words)
    linked = sum(t.n for t in words if t.element >= 0 and "in:a" in around[t.element])
    size = next((f"words:{n}" for n in _SIZES if total <= n), "words:more")
    links = "links:most" if 2 * linked >= total else "links:some" if linked else "links:none"
    known: dict[int, frozenset[str]] = {}
    for t in words:
        if t.element not in known:
            own = around[t.element] if t.element >= 0 else frozenset()
            bare = {"bare"} if own.isdisjoint(_TEXT_ELEMENTS) else set()
            known[t.element] = own | {"", size, links} | bare
        t.features = known[t.element]


def learned_weights(counts: dict[tuple[frozenset[str], bool], int]) -> dict[str, float]:
    """Weights of features by logistic regression, from the words of each place (features,
    inside the article). Words inside and outside weigh the same in all."""
    inside = sum(n for (_, i), n in counts.items() if i)
    outside = sum(n for (_, i), n in counts.items() if not i)
    if not inside or not outside:
        return dict(_FIXED)
    rows = [
        (place - drop, i, n)
        for (place, i), n in sorted(counts.items(), key=lambda x: (sorted(x[0][0]), x[0][1]))
        for drop in (frozenset(), _NAMED_FEATURES)
    ]
    names = sorted({f for place, _, _ in rows for f in place} | set(_FIXED))
    column = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for r, (place, _, _) in enumerate(rows):
        x[r, [column[f] for f in place]] = 1
    y = np.array([i for _, i, _ in rows], float)
    share = np.array([n / (inside if i else outside) for _, i, n in rows]) * _EFFECTIVE / 2
    start = np.array([_FIXED.get(f, 0.0) for f in names])
    w = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (p - y)) + _HELD * (w - start)
        curve = (x * (share * np.maximum(p * (1 - p), 1e-3))[:, None]).T @ x + _HELD * np.eye(len(names))
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return {f: float(v) for f, v in zip(names, w, strict=True)}


def best_region(scores: list[float]) -> tuple[int, int]:
    """(start, end) of the contiguous part with the largest sum, empty if none is
    positive. Of equal sums the first and longest one counts."""
    best, start, region = 0.0, 0, (0, 0)
    total = 0.0
    for i, s in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += s
        if total > best or (total == best and region[1] and start == region[0]):
            best, region = total, (start, i + 1)
    return region


def _gains(parts: list[Token], weights: dict[str, float]) -> list[float]:
    """The score of each token's words, or of a tag."""
    marked = any(t.inside for t in parts)
    scores: dict[frozenset[str], float] = {}
    gains = []
    for t in parts:
        if not t.n:
            gains.append(0.0 if t.text else _FOR_A_TAG)
            continue
        if t.features not in scores:
            scores[t.features] = sum(weights.get(f, 0.0) for f in t.features)
        score = scores[t.features] + (_OUTSIDE if marked and not t.inside else 0.0)
        gains.append(score * t.n)
    return gains


def _bounded_runs(gains: list[float]) -> list[float]:
    """Runs of negative words part short texts, not paragraphs around an advert."""
    held, run = [], 0.0
    for gain in gains:
        if gain < 0:
            gain = max(gain, _MOST_FOR_A_RUN - run)
            run += gain
        elif gain > 0:
            run = 0.0
        held.append(gain)
    return held


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The article's blocks, one per line; white space within a block is one space."""
    parts = tokens(page)
    text = _region_text(parts, _gains(parts, weights))
    if not text and weights is not _FIXED:
        text = _region_text(parts, _gains(parts, _FIXED))
    return text


def _region_text(parts: list[Token], gains: list[float]) -> str:
    start, end = best_region(_bounded_runs(gains))
    if start == end:
        return ""
    # A block is taken whole.
    while start > 0 and not parts[start - 1].block:
        start -= 1
    while end < len(parts) and not parts[end - 1].block:
        end += 1
    blocks, held, score, n = [], [], 0.0, 0
    for t, gain in zip(parts[start:end], gains[start:end], strict=True):
        if t.block:
            blocks.append(("".join(held), score >= _LEAST * n))
            held, score, n = [], 0.0, 0
        elif t.text:
            held.append(t.text)
            score += gain
            n += t.n
    blocks.append(("".join(held), score >= _LEAST * n))
    lines = (_SPACES.sub(" ", b).strip() for b, stays in blocks if stays)
    return "\n".join(line for line in lines if line)


def _counting(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        counts: Counter = Counter()
        for page in frame["html"]:
            parts = tokens(page)
            if not any(t.inside for t in parts):
                continue
            for t in parts:
                if t.n:
                    counts[t.features, t.inside] += t.n
        rows = [(" ".join(sorted(place)), i, n) for (place, i), n in counts.items()]
        yield pd.DataFrame(rows, columns=["place", "inside", "n"])


def _place_of(names: str) -> Iterable[str]:
    return frozenset(names.split(" "))


def learn_weights(pages: DataFrame, size: int = SAMPLE, most: int = PLACES) -> dict[str, float]:
    """Weights from those of at most ``size`` pages that mark their article, by the ``most``
    frequent places of words in them."""
    hashed = F.xxhash64("page_id").alias("_hash")
    edge = pages.select(hashed).distinct().orderBy("_hash").limit(size).agg(F.max("_hash")).first()[0]
    if edge is None:
        return dict(_FIXED)
    # Rows with the same id count once.
    chosen = pages.select("page_id", "html").withColumn("_hash", hashed).filter(F.col("_hash") <= edge)
    chosen = chosen.filter(F.col("html").rlike(r"(?i)<(article|main)\b"))
    chosen = chosen.groupBy("_hash").agg(F.min("html").alias("html")).select("html")
    counts = (
        chosen.mapInPandas(_counting, "place string, inside boolean, n long")
        .groupBy("place", "inside")
        .agg(F.sum("n").alias("n"))
    )
    top = counts.orderBy(F.col("n").desc(), "place", "inside").limit(most).collect()
    return learned_weights({(_place_of(r["place"]), r["inside"]): r["n"] for r in top})


def extracting(weights: dict[str, float]) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(h, weights) for h in frame["html"]]
            yield pd.DataFrame(
                {
                    "page_id": frame["page_id"],
                    "url": frame["url"],
                    "text": texts,
                    "n_chars": [len(t) for t in texts],
                }
            )

    return run


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null, empty and wordless pages have an empty text. Equal rows give equal
    results, one each; other columns are not looked at. An empty table gives an
    empty result.
    """
    weights = learn_weights(pages)
    rows = pages.select(without_null("page_id"), "url", "html")
    return with_id(
        rows.mapInPandas(
            extracting(weights), "page_id long, url string, text string, n_chars long"
        ),
        "page_id",
    )
