"""Texts and links of HTML pages, by the kind of site, over Arrow batches."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean, word_count

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 div section article ul ol li table tr td th blockquote pre header footer nav aside main".split())

# What every kind of site leaves out, where its text lies (tag, attribute, pattern), which elements are taken, and the
# length above which they count; and what else it leaves out: tags (none for any), the attribute, and the pattern of its value.
NOISE = frozenset("nav footer header script style aside".split())
_WIKI = (("div", "id", r"^mw-content-text$"), ("div", "class", r"^mw-parser-output$"))
SITES = {
    "generic": ((), "h2 h3 p", 0),
    "fandom": (_WIKI[::-1], "h2 h3 h4 p", 20),
    "mediawiki": (_WIKI, "h2 h3 h4 p", 20),
    "lexicanum": (_WIKI, "h2 h3 h4 p", 20),
    "ao3": ((("div", "class", r"^userstuff$"),), "p h2 h3", 0),
    "royalroad": ((("div", "class", r"^chapter-content$"),), "p h2 h3", 0),
    "syosetu": ((("div", "id", r"^novel_honbun$"), ("div", "class", r"novel_view|honbun")), "p", 0),
    "kakuyomu": ((("section", "class", r"widget-episodeBody"), ("div", "class", r"episode-body|novelBody")), "p", 0),
}
_MEDIAWIKI_NOISE = (
    ("table", "class", r"infobox|navbox|wikitable"),
    ("div", "id", r"toc|mw-navigation|mw-head|mw-panel"),
    (None, "class", r"mw-editsection|noprint|reference"),
    ("sup", None, ""),
)
SITE_NOISE = {
    "fandom": (
        ("nav footer header script style aside div section", "class", r"portable-infobox|infobox|toc|wikia-ad|wds-tabs|gallery|noprint|mw-editsection|pi-item|references|reflist|navbox|thumb|caption|noexcerpt"),
        ("sup span", "class", r"reference"),
    ),
    "mediawiki": _MEDIAWIKI_NOISE,
    "lexicanum": (("table", "class", r"notices?"), *_MEDIAWIKI_NOISE),
    "ao3": (("div", "id", r"header|footer|kudos|comments|series|feedback"), ("dl", "class", r"work.meta")),
    "royalroad": ((None, "class", r"page-header|sidebar|author-info|chapter-list|comments"),),
}
_CITATION = re.compile(r"\[\d+[a-z]?\]")
_SOURCES = re.compile(r"\n\n(?:Sources|See Also)\n\n.*\Z", re.S)


def _matches(rule: tuple[str | None, str | None, str], tag: str, attributes: dict[str, str | None]) -> bool:
    """Whether an element fits (tags, attribute, pattern); each class is looked at by itself, and all together."""
    tags, attribute, pattern = rule
    if tags is not None and tag not in tags.split():
        return False
    if attribute is None:
        return True
    value = attributes.get(attribute) or ""
    return any(re.search(pattern, x) for x in ([*value.split(), value] if attribute == "class" else [value]) if x)


class _Reader(HTMLParser):
    """Collects the text of wanted elements inside a container; a paragraph ends where a new block begins."""

    def __init__(self, container: tuple[str, str, str] | None, wanted: frozenset[str], noise: tuple):
        super().__init__(convert_charrefs=True)
        self.container, self.wanted, self.noise = container, wanted, noise
        self.open: list[tuple[str, bool, bool]] = []  # tag, whether it is noise, whether it is the container
        self.parts: list[str] = []
        self.held: list[str] | None = None
        self.met = container is None

    def _close(self) -> None:
        if self.held is not None:
            text = " ".join(x for x in (y.strip() for y in self.held) if x)
            if text:
                self.parts.append(text)
            self.held = None

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        a = dict(attrs)
        noise = any(_matches(rule, tag, a) for rule in self.noise)
        holds = self.container is not None and not self.met and _matches(self.container, tag, a)
        if tag in _BLOCK and self.open and self.open[-1][0] == "p":
            self.handle_endtag("p")
        self.open.append((tag, noise, holds))
        self.met = self.met or holds
        if tag in self.wanted and self._inside():
            self._close()
            self.held = []

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                if any(t in self.wanted for t, _, _ in self.open[i:]):
                    self._close()
                del self.open[i:]
                return

    def _inside(self) -> bool:
        return not any(n for _, n, _ in self.open) and (self.container is None or any(h for _, _, h in self.open))

    def handle_data(self, data):
        if self.held is not None and self._inside():
            self.held.append(data)

    def result(self) -> list[str]:
        self._close()
        return self.parts


def _read(page: str, container: tuple[str, str, str] | None, wanted: str, noise: tuple) -> list[str] | None:
    reader = _Reader(container, frozenset(wanted.split()), noise)
    reader.feed(page)
    reader.close()
    return reader.result() if reader.met else None


def text_of(page: str | None, site: str | None = "generic") -> str | None:
    """The text of a page by its kind of site, elements parted by blank lines; generic where no container is found.

    The first container of the first kind that the page has is read.
    """
    if page is None:
        return None
    every = (" ".join(sorted(NOISE)), None, "")
    own = SITE_NOISE.get(site or "", ())
    containers, wanted, least = SITES.get(site or "generic", SITES["generic"])
    found = None
    for container in containers:
        found = _read(page, container, wanted, (every if site in ("mediawiki", "lexicanum") else ("script style", None, ""), *own))
        if found is not None:
            break
    if found is None:
        _, wanted, least = SITES["generic"]
        found = _read(page, None, wanted, (every, *own))
    text = "\n\n".join(x for x in found or [] if len(x) > least or not least)
    if site == "lexicanum":
        text = _SOURCES.sub("", _CITATION.sub("", text)).strip()
    return text


@F.pandas_udf(T.StringType())
def extracted(pages: pd.Series, sites: pd.Series) -> pd.Series:
    return pd.Series([text_of(p if isinstance(p, str) else None, s) for p, s in zip(pages, sites)], dtype=object)


def pages(raw: DataFrame, html: str = "html", site: str = "extractor") -> DataFrame:
    """``raw`` with the text of its pages, cleaned, with its words, characters and checksum; pages without text are left out."""
    text = clean(extracted(F.col(html), F.col(site)))
    made = raw.withColumn("text", text).where(F.length(F.trim("text")) > 0)
    return made.withColumn("word_count", word_count(F.col("text"))).withColumn("char_count", F.length("text").cast("long")).withColumn("checksum_md5", F.md5("text"))


def links(page: Column) -> Column:
    """The targets of a page's links, each once, in their order."""
    return F.array_distinct(F.regexp_extract_all(page, F.lit("(?i)<a\\b[^>]*?\\bhref\\s*=\\s*[\"']([^\"']*)[\"']"), F.lit(1)))


def site_type(host: Column, page: Column) -> Column:
    """fandom by host, mediawiki by the generator a page names, else generic; null without a page."""
    generator = F.lower(page).rlike("<meta[^>]*name=[\"']generator[\"'][^>]*content=[\"'][^\"']*mediawiki")
    return F.when(page.isNull(), None).otherwise(F.when(F.contains(host, F.lit("fandom.com")), "fandom").when(generator, "mediawiki").otherwise("generic"))


def articles(titles: Column) -> Column:
    """Titles outside of special namespaces."""
    return F.filter(titles, lambda t: ~F.contains(t, F.lit(":")))
