"""Main text of web pages by the maximum-scoring stretch of words and tags.

Words score positive and tags negative. The scores come from pages whose markup names the
main content (``article`` or ``main``): how often the words in an element, and its tag,
lie inside it. One scan over a page finds the stretch with the largest sum; the text
blocks in it, without those in scripts, menus and the like, are the main text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from oddsline.llm.common import row_batches

#: Element names and the words of class, id and role that mark side matter.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary
    table tbody td tfoot th thead tr ul""".split())
INLINE = frozenset("""a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s
    samp small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp svg math".split())
SIDE = frozenset("nav footer aside form button select option head menu dialog object canvas audio video".split()) | RAW
CONTENT = frozenset(("article", "main"))
SIDE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs
    comment comments complementary consent contentinfo cookie cookies dialog disqus footer form gdpr header masthead
    menu menubar modal nav navbar navigation newsletter notice notification overlay paywall popup promo promotion
    related replies search share sharing sidebar signup social sponsor sponsored sponsors subscribe subscription
    toolbar widget""".split())
#: Of these, those that also name what an article is about, so that the element's own content counts more.
WEAK_WORDS = frozenset("""alert banner dialog form header menu notice notification overlay promotion search share
    sharing signup social subscription toolbar widget""".split())
#: Words of a name that say where or how an element stands, not what it is.
PLACES = frozenset("""area bar block bottom box container content group inner item items left link links list main
    outer page panel right row section site top wrap wrapper""".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CLOSES_P = BLOCKS - {"body", "html", "head"}
HEAD, OTHER = "header", "other"

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_MARKS = frozenset(("class", "id", "role"))
#: A name such as has-sidebar or noAds says what an element has, not what it is.
_ABOUT = frozenset(("has", "with", "no", "without"))
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", name, attributes) and ("close", name, "") in page order;
    comments and declarations are left out, raw elements have no inner events."""
    at = 0
    while at < len(page):
        found = _TAG.search(page, at)
        if not found:
            yield "text", page[at:], ""
            return
        if found.start() > at:
            yield "text", page[at:found.start()], ""
        at = found.end()
        closing, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if closing:
            yield "close", name, ""
            continue
        yield "open", name, attributes or ""
        if name in RAW and not (attributes or "").rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else len(page)


def marks_of(attributes: str) -> frozenset[str]:
    """The words of class, id and role that may mark side matter; weak ones of names that say nothing else."""
    out: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        if value and name.lower() in _MARKS:
            for token in value.strip("\"'").split():
                parts = [part.lower() for part in _PARTS.findall(token)]
                if parts and parts[0] not in _ABOUT:
                    said = SIDE_WORDS.intersection(parts)
                    only = SIDE_WORDS.issuperset(p for p in parts if p not in PLACES)
                    out.update(said if only else said - WEAK_WORDS)
    return frozenset(out)


class Reader:
    """Walks a page: ``items`` are ("tag", key, side, inside) and ("words", key, side, inside,
    block number, text); ``key`` is the element name, ``side`` whether it lies in side
    matter, ``inside`` whether in an element named as content.

    Elements are side matter by name or by mark (class, id, role). ``scores`` weighs a mark
    against what the element holds (``Scores.mark``). It is dropped as well from the elements
    around the main content: of the ones named so, that with the fewest marks on and around it,
    then with most words. On a page without content, less than a tenth of whose words lie outside
    of marked elements, it is dropped from those that hold most."""

    def __init__(self, page: str, scores: Scores | None = None):
        self.scores = scores or Scores({})
        self.open: list[tuple[str, int, bool, str, int]] = []
        self.items: list[tuple] = []
        self.block = 0
        # Marks and contents by number: the mark or content around, and the words directly in it.
        self.marks: list[int] = [0, 0]  # 0: no side matter, 1: by name, which no content drops
        self.contents: list[int] = [0]  # the mark on or around each content
        self.mark_names: list[frozenset[str]] = [frozenset(), frozenset()]
        self.mark_inside: list[bool] = [False, False]  # whether a content is around the mark
        self.headed: set[int] = set()  # marks around a heading
        self.mark_words, self.content_words = Counter(), Counter()
        for kind, value, attributes in events(page):
            if kind == "text":
                self.words(value)
            elif kind == "open":
                self.start(value, attributes)
            else:
                self.end(value)
        dropped = self.dropped()
        self.items = [(*item[:2], item[2] not in dropped, *item[3:]) for item in self.items]
        self.has_content = any(mark in dropped for mark in self.contents[1:])

    @property
    def state(self) -> tuple[str, int, bool]:
        return self.open[-1][:3] if self.open else ("body", 0, False)

    def words(self, text: str) -> None:
        name, side, inside = self.state
        if text:
            self.items.append(("words", name, side, inside, self.block, text))
            n = len(text.split())
            self.mark_words[side] += n
            self.content_words[self.open[-1][4] if self.open and side != 1 else 0] += n

    def dropped(self) -> set[int]:
        """The marks that don't make side matter, with 0 for none."""
        dropped = {0}
        found = [i for i in range(1, len(self.contents)) if self.contents[i] != 1 and self.content_words[i]]
        if found:
            around = lambda i: len(self.chain(self.contents[i]))
            dropped.update(self.chain(self.contents[min(found, key=lambda i: (around(i), -self.content_words[i], i))]))
        elif 10 * self.mark_words[0] < (whole := sum(n for mark, n in self.mark_words.items() if mark != 1)):
            held = Counter(self.mark_words)
            for mark in range(len(self.marks) - 1, 1, -1):  # inner marks come later
                held[self.marks[mark]] += held[mark]
            dropped |= {mark for mark in range(2, len(self.marks)) if 2 * held[mark] > whole}
        # From the outside in: a mark inside side matter stays side matter.
        for mark in range(2, len(self.marks)):
            if self.marks[mark] in dropped and not self.is_side(mark):
                dropped.add(mark)
        return dropped

    def chain(self, mark: int) -> list[int]:
        """A mark and those around it."""
        out = []
        while mark:
            out.append(mark)
            mark = self.marks[mark]
        return out

    def is_side(self, mark: int) -> bool:
        return self.scores.mark(self.mark_names[mark], self.mark_inside[mark], mark in self.headed) > 0

    def tag(self, name: str, side: int, inside: bool) -> None:
        if name in BLOCKS:
            self.block += 1
        self.items.append(("tag", known(name), side, inside))

    def start(self, name: str, attributes: str) -> None:
        if name in CLOSES_P:
            self.end_implied()
        context, side, inside = self.state
        content = name in CONTENT
        number = self.open[-1][4] if self.open else 0
        if name in HEADINGS:
            self.headed.update(self.chain(side))
        if side != 1 and not content and (name in SIDE or (name == HEAD and not inside)):
            side = 1
        elif side != 1 and name not in ("html", "body") and name not in VOID and (names := marks_of(attributes)):
            self.marks.append(side)
            self.mark_names.append(names)
            self.mark_inside.append(inside)
            side = len(self.marks) - 1
        if content:
            self.contents.append(side)
            number = len(self.contents) - 1
        self.tag(name, side, inside)
        if name == "br":
            self.words(" ")
        if name not in VOID:
            self.open.append((known(name) if name in BLOCKS or name == "a" else context, side, inside or content, name, number))

    def end_implied(self) -> None:
        """A block ends an open paragraph, and what is open in it."""
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.open[depth][3]
            if name == "p":
                del self.open[depth:]
                return
            if name in BLOCKS:
                return

    def end(self, name: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][3] == name:
                _, side, inside = self.open[depth][:3]
                del self.open[depth:]
                self.tag(name, side, inside and name not in CONTENT)
                return
            if name not in BLOCKS and self.open[depth][3] in BLOCKS:
                return  # an inline end tag doesn't close blocks
        if name in BLOCKS:
            self.block += 1


def known(name: str) -> str:
    return name if name in BLOCKS or name in INLINE or name in SIDE else OTHER


class Scores:
    """Scores from counts {(kind, key): (inside, outside)}; few counts lean on priors.

    A word that only marks side matter by its meaning counts as often as a large site teaches;
    one that also names topics gives way to a few articles in which it marks their own words.
    """

    LISTS = frozenset("a li ul ol menu td th label dd dt".split())

    def __init__(self, counts: dict[tuple[str, str], tuple[int, int]]):
        self.counts = counts

    def outside(self, kind: str, key: str) -> float:
        """The share outside of the content; the prior counts as ten tokens."""
        inside, outside = self.counts.get((kind, key), (0, 0))
        prior = 0.7 if key in self.LISTS else 0.1
        return (outside + 10 * prior) / (inside + outside + 10)

    def mark(self, names: frozenset[str], inside: bool, headed: bool) -> float:
        """How much speaks for side matter: above 0 more than against it.

        For it speaks how rarely the words marked so lie in contents, by the word that says most;
        against it that a content is around the element, and a heading in it.
        """
        best = 0.0
        for name in names:
            prior, weight = (0.75, 200) if name in WEAK_WORDS else (0.97, 100_000)
            inner, outer = self.counts.get(("mark", name), (0, 0))
            best = max(best, (outer + weight * prior) / (inner + outer + weight))
        return math.log(max(best, 1e-9) / max(1 - best, 1e-9)) - 1.0 * inside - 1.5 * headed

    def word(self, key: str) -> float:
        return max(0.02, 1 - self.outside("words", key))

    def tag(self, key: str) -> float:
        return -(0.02 + 4 * max(0.0, self.outside("tag", key) - 0.15))


class Teaching(Scores):
    """While pages teach: weak marks inside a content are part of it."""

    def mark(self, names: frozenset[str], inside: bool, headed: bool) -> float:
        return -1.0 if inside and names <= WEAK_WORDS else super().mark(names, inside, headed)


def main_text(page: str | None, scores: Scores) -> str:
    """The text of the best stretch, a line per block."""
    items = [item for item in Reader(page or "", scores).items if not item[2]]  # side matter only taught
    words: dict[str, float] = {}
    tags: dict[str, float] = {}
    best = total = 0.0
    first = start = end = 0
    for i, item in enumerate(items):
        key = item[1]
        if item[0] == "tag":
            if key not in tags:
                tags[key] = scores.tag(key)
            total += tags[key]
        else:
            if key not in words:
                words[key] = scores.word(key)
            total += words[key] * len(item[5].split())
        if total <= 0:
            total, first = 0.0, i + 1
        elif total > best:
            best, start, end = total, first, i + 1
    blocks: dict[int, list[str]] = {}
    for item in items[start:end]:
        if item[0] == "words":
            blocks.setdefault(item[4], []).append(item[5])
    lines = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def learned(pages: DataFrame) -> Scores:
    """Scores from all pages that name their content; at most a few hundred counts are collected."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                reader = Reader(page or "", Teaching({}))
                if reader.has_content:
                    for item in reader.items:
                        inside = item[3] and not item[2]
                        total[item[0], item[1], inside] += len(item[5].split()) if item[0] == "words" else 1
                    for mark in range(2, len(reader.marks)):
                        for name in reader.mark_names[mark]:
                            total["mark", name, reader.mark_inside[mark]] += reader.mark_words[mark]
        rows = [(*k, n) for k, n in total.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
             pa.array([r[2] for r in rows], pa.bool_()), pa.array([r[3] for r in rows], pa.int64())],
            names=["kind", "key", "inside", "n"])

    row_batches(pages.sparkSession)
    counts: dict[tuple[str, str], list[int]] = {}
    for r in (pages.select("html").mapInArrow(count, "kind string, key string, inside boolean, n long")
              .groupBy("kind", "key", "inside").agg(F.sum("n").alias("n")).collect()):
        counts.setdefault((r["kind"], r["key"]), [0, 0])[0 if r["inside"] else 1] = r["n"]
    return Scores({k: tuple(v) for k, v in counts.items()})


def extracted(pages: DataFrame, scores: Scores | None = None) -> DataFrame:
    """Per row: page_id, url, text (empty if none), n_chars (code points).

    Character references are decoded, white space inside a block is one space, blocks are
    trimmed, and those left empty are no lines. A null or empty page has no text. Repeated
    rows get a row each; extra columns are ignored; an empty table gives an empty result.
    """
    known_scores = learned(pages) if scores is None else scores
    row_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def text(pages_: pd.Series) -> pd.Series:
        return pd.Series([main_text(page, known_scores) for page in pages_], dtype=object)
    rows = pages.select("page_id", "url", text("html").alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
