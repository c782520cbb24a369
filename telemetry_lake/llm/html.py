"""Main text of web pages as the maximum-scoring run of words and tags.

Words score by where they stand, tags score negative. Both weights are log odds learnt from
labelled pages, those with one `article` (or else one `main`) element; the label is seen while
learning only, an extraction looks through these elements. One linear scan finds the run of the
greatest sum, and the words in it that score positive are the text.

Where a word stands is the path of its containers (tag and words of class, id and role). The odds of
a path start from those of the path around it and of the innermost container anywhere, and move to
its own counts the more words it was seen with. Lists of names that usually set a part aside are
worth SET_APART words of evidence. A part that scores negative (an advert inside of an article)
leaves no words and hardly parts the words around it. In all other parts tags cost by how seldom
they stand in articles, so the scan cuts off what no name tells apart but tags fill.

Defined cases: null or empty html, and pages without a word that counts, have an empty text; pages
are read whole, also with unclosed tags, quotes or comments, in time linear in their length; repeated
rows are read row by row; with no labelled pages the priors decide; only id, url and html are read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import map_arrow

# Labelled pages used for learning at most, chosen by a hash of the id, and the most
# frequent features of each kind that are kept: the model is sent to every task.
LEARN_PAGES, FEATURES = 2_000, 10_000

# Elements of HTML that do not part words, that hold no page text, that
# have no content, and that hold other things than an article's text.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
RAW = "script style noscript template iframe object svg canvas textarea title select math audio video".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
APART = set("nav footer aside form head button menu dialog fieldset select option label".split())
# Words in class, id or role that name such parts.
APART_NAMES = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary consent cookie "
    "cookies disclaimer discussion disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notices pager pagination popup promo promoted promotion recommended related replies reply respond search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe tags teaser toolbar widget widgets alert contentinfo "
    "copyright".split()
)
# Containers that are looked through: the label, and what holds every page.
THROUGH = {"html", "body", "article", "main"}
# Elements that end an open one of their kind.
SIBLINGS = set("li dt dd tr td th".split())
BLOCKS = set("p br li ul ol dl dt dd h1 h2 h3 h4 h5 h6 hr pre blockquote figure figcaption table thead tbody tr td th".split())

# Words inside and outside of articles that a listed name starts with, and any other container.
SET_APART, OPEN = (1.0, 50.0), (1.0, 1.0)
# Log odds of a page's plain text before learning; words that the path around counts for.
PLAIN, AROUND = math.log(2), 20.0
# A part that holds article at these log odds or above says nothing against the parts in it.
MIXED = -2.0
# Bounds of a path's log odds; what a word scores where they are negative.
LEAST_ODDS, MOST_ODDS, APART_WORD = -5.0, 1.0, -0.02
# Costs of tags before learning (inside of sentences, of blocks of text, of other containers), the
# tags that this counts for, and the bounds of learnt costs. An inline tag never parts a sentence.
INLINE_COST, BLOCK_COST, OTHER_COST, TAGS_BEFORE = -0.05, -0.2, -1.0, 20.0
LEAST_COST, MOST_INLINE, MOST_COST = -0.02, -0.5, -8.0
# Paths whose odds a worker remembers.
REMEMBERED = 1 << 16

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<attributes2>[^>]*)>"
    r"|<[!?/][^>]*>?"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@dataclass
class Page:
    """A page's texts and tags in order, and the places they stand in."""

    # (text, place, None) for a text, (None, place, tag) for a tag; a container's own tags stand in it.
    events: list[tuple[str | None, int, str | None]] = field(default_factory=list)
    # Place 0 is the page itself; the others follow the place around them: (around, container, path).
    places: list[tuple[int, str, int]] = field(default_factory=lambda: [(0, "", 0)])
    # For each event: whether the label holds it, None where the label does not say.
    inside: list[bool | None] = field(default_factory=list)


def _container(tag: str, attributes: str) -> str:
    """A container's tag and the words of its class, id and role; numbers tell nothing."""
    if "=" not in attributes:
        return "" if tag in THROUGH else tag
    values = " ".join("".join(value) for value in _NAMES.findall(attributes)).lower()
    names = {name for name in re.split(r"[^a-z0-9]+", values) if name and not name.isdigit()}
    if tag in THROUGH:
        names = names & APART_NAMES if tag in ("article", "main") else set()
        return ".".join([tag, *sorted(names)]) if names else ""
    return ".".join([tag, *sorted(names)])


def set_apart(container: str) -> bool:
    tag, *names = container.split(".")
    return tag in APART or tag == "header" or not APART_NAMES.isdisjoint(names)


def label(source: str | None) -> str | None:
    """The element that marks the article of a labelled page."""
    roots = (root for root in ("article", "main") if len(re.findall(rf"<{root}[\s>]", source or "", re.I)) == 1)
    return next(roots, None)


def read(source: str | None, root: str | None = None) -> Page:
    """The page's texts and tags; `root` is the label and only fills `inside`."""
    page = Page()
    known: dict[tuple[int, str], int] = {}

    def place(around: int, container: str) -> int:
        if not container:
            return around
        if (around, container) not in known:
            path = xxhash.xxh64_intdigest(container, seed=page.places[around][2]) >> 1
            known[around, container] = len(page.places)
            page.places.append((around, container, path))
        return known[around, container]

    # What was open before each open container; how many of each tag are open.
    stack: list[tuple[str, int, bool | None, str]] = []
    count: Counter[str] = Counter()
    here, within, own, paragraph = 0, False, "", False

    def add(text: str | None, at: int, tag: str | None) -> None:
        page.events.append((text, at, tag))
        page.inside.append(within)

    for found in _TOKEN.finditer(source or ""):
        if (text := found["text"]) is not None:
            add(text, place(here, "p") if paragraph else here, None)
            continue
        if found["raw"]:
            add(None, here, found["raw"].lower())
            continue
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        closing = bool(found["end"] or found["end2"])
        attributes = found["attributes"] or found["attributes2"] or ""
        if tag in INLINE or tag in VOID:
            add(None, here, f"/{tag}" if closing else tag)
            continue
        paragraph = tag == "p" and not closing
        if tag == "p" or attributes.endswith("/") and tag not in ("article", "div"):
            add(None, here, f"/{tag}" if closing else tag)
        elif closing:
            if not count[tag]:
                add(None, here, "/p")  # ends nothing that is open
                continue
            # The end of a container that is looked through is no tag either.
            ended = own if stack[-1][0] == tag else tag
            add(None, here, ended and f"/{ended}")
            # What an end tag leaves open inside of it ends with it.
            while True:
                last, here, within, own = stack.pop()
                count[last] -= 1
                if last == tag:
                    break
        else:
            if tag in SIBLINGS and stack and stack[-1][0] == tag:
                _, here, within, own = stack.pop()
                count[tag] -= 1
            stack.append((tag, here, within, own))
            count[tag] += 1
            own = _container(tag, attributes)
            here = place(here, own)
            if tag == root:
                within = True
            elif within and set_apart(own) and not own.startswith("header"):
                within = None  # the label does not tell an article from what is set apart in it
            add(None, here, own)
    return page


def log_odds(inside: float, outside: float) -> float:
    return math.log(inside / outside)


@dataclass
class Weights:
    """Inside and outside counts of words by path and by container, and of tags."""

    paths: dict[int, tuple[int, int]] = field(default_factory=dict)
    containers: dict[str, tuple[int, int]] = field(default_factory=dict)
    tags: dict[str, tuple[int, int]] = field(default_factory=dict)
    remembered: dict[tuple[int, float], float] = field(default_factory=dict, repr=False)

    def odds(self, page: Page) -> list[float]:
        """Log odds of every place of a page."""
        if len(self.remembered) > REMEMBERED:
            self.remembered.clear()
        found: list[float] = []
        for around, container, path in page.places:
            outer = found[around] if found else PLAIN
            if outer > MIXED:
                outer = max(outer, PLAIN)
            if (path, outer) not in self.remembered:
                self.remembered[path, outer] = self._place(outer, container, path)
            found.append(self.remembered[path, outer])
        return found

    def _place(self, outer: float, container: str, path: int) -> float:
        before = outer
        if container:
            first, last = SET_APART if set_apart(container) else OPEN
            # A plain tag serves all kinds of parts: only its path tells.
            inside, outside = self.containers.get(container, (0, 0)) if "." in container or set_apart(container) else (0, 0)
            before += max(LEAST_ODDS, min(MOST_ODDS, log_odds(inside + first, outside + last)))
        share = 1 / (1 + math.exp(-before))
        inside, outside = self.paths.get(path, (0, 0))
        return max(LEAST_ODDS, min(MOST_ODDS, log_odds(inside + AROUND * share, outside + AROUND * (1 - share))))

    def tag(self, name: str) -> float:
        """Cost of a tag in a part that counts."""
        plain = name.lstrip("/").split(".")[0]
        if plain in RAW:
            return LEAST_COST
        before, most = OTHER_COST, MOST_COST
        if plain in INLINE:
            before, most = INLINE_COST, MOST_INLINE
        elif plain in BLOCKS:
            before = BLOCK_COST
        inside, outside = self.tags.get(name, (0, 0))
        return max(most, min(LEAST_COST, log_odds(inside + TAGS_BEFORE * math.exp(before), outside + TAGS_BEFORE)))


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the run with the greatest positive sum, the first of equal ones; (0, 0) without."""
    best, place, total, start = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, place = total, (start, k + 1)
    return place


def extract(source: str | None, weights: Weights) -> str:
    """The main text: white space as one space, blocks joined by one space."""
    page = read(source)
    odds = weights.odds(page)
    scores = []
    for text, place, tag in page.events:
        if text is not None:
            scores.append((odds[place] if odds[place] > 0 else APART_WORD) * len(text.split()))
        elif tag:
            scores.append(weights.tag(tag) if odds[place] > 0 else LEAST_COST)
        else:
            scores.append(0.0)
    first, last = best_run(scores)
    parts = []
    for text, place, tag in page.events[first:last]:
        if text is None:
            if not tag or tag.lstrip("/") not in INLINE:
                parts.append(" ")
        else:
            parts.append(html.unescape(text) if odds[place] > 0 else " ")
    return " ".join("".join(parts).split())


def _words(batches):
    """(kind, feature, inside, outside): words by path and by container over the labelled pages of a task."""
    sides = {True: Counter(), False: Counter()}
    for batch in batches:
        for source in batch.column(1).to_pylist():
            if (root := label(source)) is None:
                continue
            page = read(source, root)
            for side, total in sides.items():
                held = [0] * len(page.places)
                for (text, place, _), within in zip(page.events, page.inside, strict=True):
                    if text is not None and within is side:
                        held[place] += len(text.split())
                # A place follows the one around it, so each hands on its whole sum, but for the page.
                for k in range(len(held) - 1, -1, -1):
                    around, container, path = page.places[k]
                    total["path", str(path)] += held[k]
                    total["container", container] += held[k]
                    if around:
                        held[around] += held[k]
    yield _table(sides)


def _tags(weights: Weights):
    def work(batches):
        """The same for tags, but for those in parts that the words tell apart."""
        sides = {True: Counter(), False: Counter()}
        for batch in batches:
            for source in batch.column(1).to_pylist():
                if (root := label(source)) is None:
                    continue
                page = read(source, root)
                odds = weights.odds(page)
                for (_, place, tag), within in zip(page.events, page.inside, strict=True):
                    if tag and within is not None and odds[place] > 0:
                        sides[within]["tag", tag] += 1
        yield _table(sides)

    return work


def _table(sides: dict[bool, Counter]) -> pa.RecordBatch:
    keys = sorted({*sides[True], *sides[False]})
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in keys], pa.string()), pa.array([f for _, f in keys], pa.string()),
         pa.array([sides[True][k] for k in keys], pa.int64()), pa.array([sides[False][k] for k in keys], pa.int64())],
        ["kind", "feature", "inside", "outside"],
    )


def _most_frequent(sample: DataFrame, work, kinds: list[str]) -> dict[str, dict[str, tuple[int, int]]]:
    """Counts of the FEATURES most frequent features of each kind."""
    counted = map_arrow(sample, work, "kind string, feature string, inside long, outside long")
    totals = counted.groupBy("kind", "feature").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    kept: dict[str, dict[str, tuple[int, int]]] = {}
    for kind in kinds:
        rows = totals.where(F.col("kind") == kind).orderBy(F.desc(F.col("inside") + F.col("outside")), "feature").limit(FEATURES).collect()
        kept[kind] = {row.feature: (row.inside, row.outside) for row in rows}
    return kept


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", rows: int = LEARN_PAGES) -> Weights:
    """Weights from labelled pages, counted in Spark: first words, then tags where words count."""
    labelled = pages.where(F.col(html_col).rlike(r"(?i)<(article|main)[\s>]")).select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"))
    ids = labelled.select("page_id").where("page_id IS NOT NULL").orderBy(F.xxhash64("page_id"), "page_id").limit(rows)
    sample = labelled.join(F.broadcast(ids.distinct()), "page_id").select("page_id", "html")
    words = _most_frequent(sample, _words, ["path", "container"])
    weights = Weights({int(path): counts for path, counts in words["path"].items()}, words["container"])
    weights.tags = _most_frequent(sample, _tags(weights), ["tag"])["tag"]
    weights.remembered = {}
    return weights


def main_texts(pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url and text of every page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"), F.col(url_col).alias("url"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            texts = [extract(source, weights) for source in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return map_arrow(rows, work, f"page_id {kind}, url string, text string")
