"""Article fields from raw HTML pages.

Python only walks the tags: one Arrow-batched function turns ``html`` into a struct of the texts and
attributes the rules look at. Which of them becomes a field is decided by column expressions, one
set per rule version. Only the HTML column crosses to Python.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions import derive
from lectern.operators.sizing import small_batches
from lectern.schemas import ARTICLE_COLUMNS

# White space removed from both ends of a text.
TRIM = (
    "\t\n\v\f\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# HTML element groups, from the HTML parsing rules.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr li listing main menu nav ol p plaintext pre search section summary"
    " table ul xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BARRIERS = frozenset("applet button caption marquee object table td template th".split())
BLOCKS = CLOSES_P | BARRIERS | frozenset("body head html tbody tfoot thead tr".split())
SILENT = frozenset(("script", "style"))

_S = T.StringType()
PARTS = T.StructType(
    [
        T.StructField(name, T.ArrayType(_S) if name.endswith("_list") else _S, True)
        for name in (
            "og_title",
            "og_image",
            "meta_published",
            "meta_author",
            "title",
            "h1",
            "author_testid",
            "json_ld_author",
            "time_first",
            "time_dated",
            "figure_img",
            "article_text",
            "clap_button",
            "clap_testid",
            "responses_button",
            "responses_testid",
            "article_p_list",
            "section_p_list",
            "error",
        )
    ]
)


class _Page(HTMLParser):
    """Collects texts while keeping the stack of open elements the way browsers do."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[list[int | None]]]] = []
        self.places: dict[str, list[int]] = {}  # of each tag the places in ``open``, the nearest last
        self.pieces: list[str] = []  # all text; an element's own is a stretch of it
        self.silent = 0
        self.first: dict[str, str | None] = {}
        self.texts: dict[str, list[list[int | None]]] = {}  # first piece and the one after the last; None while open
        self.scripts: list[list[str]] = []
        self.scripting = False

    def _collect(self, names: list[str]) -> list[list[int | None]]:
        stretches: list[list[int | None]] = []
        for name in names:
            stretches.append([len(self.pieces), None])
            self.texts.setdefault(name, []).append(stretches[-1])
        return stretches

    def _push(self, tag: str, stretches: list[list[int | None]]) -> None:
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, stretches))

    def _close(self, place: int) -> None:
        """Close the element at ``place`` and all inside it; each is closed once, however deep they lie."""
        while len(self.open) > place:
            tag, stretches = self.open.pop()
            self.places[tag].pop()
            for stretch in stretches:
                stretch[1] = len(self.pieces)

    def _nearest(self, tags: frozenset[str] | set[str]) -> int:
        """Place of the nearest open element in ``tags``, or -1."""
        return max((at[-1] for t in tags if (at := self.places.get(t))), default=-1)

    def _pop(self, wanted: frozenset[str] | set[str], stop: frozenset[str]) -> bool:
        """Close up to the nearest open element in ``wanted`` unless one in ``stop`` is nearer."""
        place = self._nearest(wanted)
        if place < 0 or place < self._nearest(stop):
            return False
        self._close(place)
        return True

    def _is_open(self, *tags: str) -> bool:
        return any(self.places.get(t) for t in tags)

    def _paragraph_lists(self) -> list[str]:
        return [f"{t}_p_list" for t in ("article", "section") if self._is_open(t)]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        at = {}
        for name, value in attrs:
            at.setdefault(name, value or "")
        if tag in CLOSES_P:
            self._pop({"p"}, BARRIERS)
        if tag in HEADINGS and self.open and self.open[-1][0] in HEADINGS:
            self._close(len(self.open) - 1)
        if tag == "meta":
            self._meta(at)
        elif tag == "time":
            self.first.setdefault("time_first", at.get("datetime"))
            if "datetime" in at:
                self.first.setdefault("time_dated", at["datetime"])
        elif tag == "img" and self._is_open("figure"):
            self.first.setdefault("figure_img", at.get("src"))
        if tag in VOID:
            return
        if tag in SILENT:
            self.silent += 1
            if at.get("type") == "application/ld+json":
                self.scripts.append([])
                self.scripting = True
        self._push(tag, self._collect(self._wanted(tag, at)))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash

    def _meta(self, at: dict[str, str]) -> None:
        name = {
            "og:title": "og_title",
            "og:image": "og_image",
            "article:published_time": "meta_published",
        }.get(at.get("property", ""))
        if name:
            self.first.setdefault(name, at.get("content"))
        if at.get("name") == "author":
            self.first.setdefault("meta_author", at.get("content"))

    def _wanted(self, tag: str, at: dict[str, str]) -> list[str]:
        names = []
        if tag == "p":
            names += self._paragraph_lists()
        elif tag in ("title", "h1"):
            names.append(tag)
        elif tag == "article":
            names.append("article_text")
        test_id = at.get("data-testid")
        if test_id == "authorName":
            names.append("author_testid")
        elif test_id == "clapCount":
            names.append("clap_testid")
        elif test_id == "responsesCount":
            names.append("responses_testid")
        if tag == "button":
            if test_id == "headerClapButton":
                names.append("clap_button")
            if at.get("aria-label") == "responses":
                names.append("responses_button")
        return names

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            if self._pop({tag}, frozenset()):
                self.silent -= 1
                self.scripting = False
        elif tag == "p":
            if not self._pop({"p"}, BARRIERS):
                for stretch in self._collect(self._paragraph_lists()):  # a stray end tag is an empty paragraph
                    stretch[1] = stretch[0]
        elif tag in HEADINGS:
            self._pop(HEADINGS, BARRIERS)
        elif tag in ("html", "body"):
            pass
        elif tag in BLOCKS:
            self._pop({tag}, BARRIERS)
        else:
            self._pop({tag}, BLOCKS)

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.pieces.append(data)
        elif self.scripting:
            self.scripts[-1].append(data)

    def parts(self) -> dict[str, object]:
        def text(stretch: list[int | None]) -> str:
            return "".join(self.pieces[stretch[0] : stretch[1]])

        def all_of(name: str) -> list[str]:
            return [text(s) for s in self.texts.get(name, [])]

        def first_of(name: str) -> str | None:
            return text(self.texts[name][0]).strip(TRIM) if name in self.texts else None

        out: dict[str, object] = {name: self.first.get(name) for name in PARTS.fieldNames()}
        for name in ("title", "h1", "author_testid", "clap_testid", "responses_testid"):
            out[name] = first_of(name)
        for name in ("article_text", "clap_button", "responses_button"):
            out[name] = "".join(all_of(name)).strip(TRIM)
        for name in ("article_p_list", "section_p_list"):
            out[name] = all_of(name)
        out["json_ld_author"] = _json_ld_author(["".join(s) for s in self.scripts])
        return out


def _json_ld_author(scripts: list[str]) -> str | None:
    for text in scripts:
        try:
            found = json.loads(text)
        except ValueError:
            continue
        author = found.get("author") if isinstance(found, dict) else None
        if isinstance(author, list) and author:
            author = author[0]
        if isinstance(author, dict) and isinstance(author.get("name"), str):
            return author["name"]
    return None


def page_parts(html: str | None) -> dict[str, object]:
    """Texts and attributes of one page; a page that cannot be read gives only ``error``."""
    empty: dict[str, object] = dict.fromkeys(PARTS.fieldNames())
    if html is None:
        return {**empty, "error": "page has no body"}
    try:
        page = _Page()
        page.feed(html)
        page.close()
        return page.parts()
    except Exception as e:
        return {**empty, "error": f"{type(e).__name__}: {e}"}


#: Pages that go to Python together, and characters of HTML whose fields come back together.
BATCH_PAGES, BACK_CHARS = 128, 1 << 20


def _stretches(html: Sequence[str | None], limit: int = BACK_CHARS) -> Iterator[tuple[int, int]]:
    """Stretches of pages in order, each of about ``limit`` characters or one page."""
    at = size = 0
    for i, h in enumerate(html):
        size += len(h or "")
        if size >= limit:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(html):
        yield at, len(html)


@F.pandas_udf(PARTS)
def _parse_pages(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for html in batches:
        pages = html.tolist()
        for a, b in _stretches(pages):
            yield pd.DataFrame([page_parts(h) for h in pages[a:b]], columns=PARTS.fieldNames())
    pa.default_memory_pool().release_unused()


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the HTML replaced by a ``parts`` struct. A Python worker holds few pages at once, however many there are."""
    small_batches(pages.sparkSession, BATCH_PAGES)
    return pages.withColumn("parts", _parse_pages(F.col(html))).drop(html)


def _part(name: str) -> Column:
    return F.col(f"parts.{name}")


def _or(*choices: Column) -> Column:
    """First that is neither null nor ''; the last one is taken as it is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices[:-1]], choices[-1])


def _trimmed(items: Column) -> Column:
    """Trim of each text: the class of :data:`TRIM` as a character list."""
    return F.transform(items, lambda p: F.trim(p, F.lit(TRIM)))


def _canonical_rules() -> dict[str, Column]:
    articles, sections = _trimmed(_part("article_p_list")), _trimmed(_part("section_p_list"))
    paragraphs = F.when(F.size(_part("article_p_list")) > 0, articles).otherwise(sections)
    return {
        "title": _or(_part("og_title"), F.coalesce(_part("h1"), F.lit(""))),
        "author_name": _or(_part("meta_author"), F.coalesce(_part("author_testid"), F.lit(""))),
        "published_date": _or(_part("meta_published"), _part("time_first")),
        "hero_image_url": _part("og_image"),
        "page_content": F.trim(F.array_join(paragraphs, "\n\n"), F.lit(TRIM)),
        "first_line": F.nullif(F.try_element_at(paragraphs, F.lit(1)), F.lit("")),
        "clap_count": F.nullif(_part("clap_button"), F.lit("")),
        "comments_count": F.nullif(_part("responses_button"), F.lit("")),
    }


def _legacy_rules() -> dict[str, Column]:
    sections = F.array_join(_part("section_p_list"), "\n")
    first = F.trim(F.try_element_at(_part("article_p_list"), F.lit(1)), F.lit(TRIM))
    return {
        "title": F.coalesce(_part("og_title"), _part("h1"), F.lit("")),
        "author_name": F.coalesce(_part("meta_author"), _part("author_testid"), F.lit("")),
        "published_date": F.coalesce(_part("meta_published"), _part("time_dated")),
        "hero_image_url": F.coalesce(_part("og_image"), _part("figure_img")),
        "page_content": F.nullif(_or(_part("article_text"), sections), F.lit("")),
        "first_line": F.nullif(first, F.lit("")),
        "clap_count": F.nullif(_part("clap_testid"), F.lit("")),
        "comments_count": F.nullif(_part("responses_testid"), F.lit("")),
    }


def extract_articles(
    pages: DataFrame,
    stamp: dt.datetime | Column | None = None,
    rules: str = "canonical",
    hash_algorithm: str | None = None,
    json_ld_author: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Pages ``url, topic, html`` to the article columns plus ``error`` (null for a parsed page) and the columns ``keep``.

    ``rules="legacy"`` takes the article's whole text instead of its paragraphs, and MD5 for the
    hash. ``stamp`` defaults to the current time.
    """
    chosen = {"canonical": _canonical_rules, "legacy": _legacy_rules}[rules]()
    if json_ld_author:
        chosen["author_name"] = _or(chosen["author_name"], F.coalesce(_part("json_ld_author"), F.lit("")))
    algorithm = hash_algorithm or ("sha256" if rules == "canonical" else "md5")
    if stamp is None:
        when = F.current_timestamp()
    else:
        when = stamp if isinstance(stamp, Column) else F.lit(stamp.isoformat(sep=" ")).cast("timestamp")
    parsed = parse_pages(pages.select("url", "topic", "html", *keep))
    fields = parsed.select(
        F.col("url").alias("article_url"),
        "topic",
        *[c.alias(n) for n, c in chosen.items()],
        F.lit(None).cast("string").alias("author_avatar_url"),
        when.alias("ingested_at"),
        _part("error").alias("error"),
        *keep,
    )
    content = F.coalesce("page_content", F.lit(""))
    return fields.withColumns(
        {"content_hash": derive.content_hash(content, algorithm), "content_gated": derive.gate_flag("page_content")}
    ).select(*ARTICLE_COLUMNS, "error", *keep)


def split_errors(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(article rows, error rows ``url, topic, error, failed_at``)."""
    good = extracted.where(F.col("error").isNull()).drop("error")
    bad = extracted.where(F.col("error").isNotNull()).select(
        F.col("article_url").alias("url"), "topic", "error", F.col("ingested_at").alias("failed_at")
    )
    return good, bad
