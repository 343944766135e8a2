"""Main text of web pages by flat text blocks and a decision tree.

A page is cut at block-level tags into a flat list of blocks. Each has its word count and
link density, those of its neighbours, whether the page's own markup puts it inside an
article, how surely it puts it inside a part that is not one, and the longest block of the
page. A decision tree, trained on the small table below, tells the blocks of the main text.
Buttons and marked parts within a line are no blocks; their text goes with their markup.
"""

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from inkloom.llm.common import field_list, limit_batches, with_column

FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after", "inside", "outside", "heading", "longest")

# Labelled blocks, in the order of FEATURES, then 1 for main text. outside is 2 where a tag or a whole name says so, 1 where a
# name only has such a word in it; longest is the number of words of the page's longest block that no links make up.
LABELLED = [
    (120, 0.00, 80, 0.00, 95, 0.00, 1, 0, 0, 120, 1),
    (1, 0.00, 60, 0.00, 45, 0.00, 1, 0, 0, 60, 1),
    (3, 0.00, 12, 0.00, 0, 0.00, 1, 0, 0, 60, 1),
    (9, 0.00, 12, 0.00, 50, 0.00, 1, 0, 1, 60, 1),
    (7, 0.00, 1, 1.00, 12, 0.00, 1, 0, 1, 60, 1),
    (5, 0.20, 40, 0.00, 60, 0.05, 1, 0, 0, 60, 1),
    (2, 1.00, 30, 0.00, 44, 0.00, 1, 0, 0, 60, 1),
    (35, 0.45, 50, 0.10, 28, 0.00, 1, 0, 0, 60, 1),
    (260, 0.02, 3, 0.00, 11, 0.00, 1, 0, 0, 260, 1),
    (15, 0.00, 15, 0.00, 15, 0.00, 1, 0, 0, 60, 1),
    (4, 0.00, 200, 0.00, 9, 0.00, 1, 0, 1, 200, 1),
    (1, 0.00, 1, 0.00, 1, 0.00, 1, 0, 0, 60, 1),
    (1, 0.00, 2, 1.00, 3, 0.00, 1, 0, 0, 60, 1),
    (1, 0.00, 0, 0.00, 0, 0.00, 1, 0, 0, 60, 1),
    (2, 0.00, 3, 0.00, 2, 0.00, 1, 0, 0, 60, 1),
    (2, 0.00, 1, 1.00, 2, 0.00, 1, 0, 1, 60, 1),
    (2, 0.50, 4, 0.00, 5, 0.50, 1, 0, 0, 60, 1),
    (3, 0.00, 1, 1.00, 1, 1.00, 1, 0, 0, 60, 1),
    (3, 0.33, 5, 0.00, 4, 0.00, 1, 0, 1, 60, 1),
    (3, 1.00, 3, 1.00, 3, 1.00, 1, 0, 0, 60, 1),
    (4, 0.00, 2, 0.00, 1, 0.00, 1, 0, 0, 60, 1),
    (4, 1.00, 4, 1.00, 0, 0.00, 1, 0, 0, 60, 1),
    (5, 0.00, 5, 0.00, 3, 1.00, 1, 0, 0, 60, 1),
    (6, 0.00, 4, 0.00, 0, 0.00, 1, 0, 0, 60, 1),
    (6, 0.80, 2, 1.00, 8, 1.00, 1, 0, 0, 60, 1),
    (7, 0.00, 3, 0.00, 6, 0.00, 1, 0, 0, 60, 1),
    (8, 0.00, 1, 0.00, 4, 0.50, 1, 0, 0, 60, 1),
    (10, 0.60, 6, 0.00, 8, 0.40, 1, 0, 0, 60, 1),
    (14, 0.90, 9, 0.80, 7, 1.00, 1, 0, 0, 60, 1),
    (1, 1.00, 1, 1.00, 1, 1.00, 0, 2, 0, 60, 0),
    (2, 1.00, 1, 1.00, 8, 0.00, 0, 2, 0, 60, 0),
    (8, 0.00, 1, 1.00, 9, 0.00, 0, 2, 0, 60, 0),
    (12, 0.00, 1, 1.00, 10, 0.00, 0, 2, 0, 60, 0),
    (40, 0.00, 20, 0.00, 30, 0.00, 0, 2, 0, 60, 0),
    (140, 0.00, 60, 0.00, 90, 0.00, 0, 2, 0, 140, 0),
    (75, 0.05, 5, 0.00, 70, 0.00, 0, 2, 0, 75, 0),
    (11, 0.10, 30, 0.00, 0, 0.00, 0, 2, 0, 60, 0),
    (6, 0.00, 22, 0.00, 6, 0.50, 0, 2, 1, 60, 0),
    (3, 0.00, 3, 0.00, 2, 0.00, 0, 2, 0, 60, 0),
    (22, 0.00, 45, 0.00, 31, 0.00, 1, 2, 0, 60, 0),
    (6, 0.50, 80, 0.00, 7, 0.60, 1, 2, 0, 80, 0),
    (64, 0.00, 50, 0.00, 12, 0.00, 1, 2, 0, 64, 0),
    (2, 0.00, 90, 0.00, 40, 0.00, 1, 2, 1, 90, 0),
    (9, 1.00, 120, 0.00, 4, 1.00, 1, 2, 0, 120, 0),
    (85, 0.00, 70, 0.00, 64, 0.02, 0, 0, 0, 85, 1),
    (150, 0.01, 9, 0.00, 44, 0.00, 0, 0, 0, 150, 1),
    (41, 0.10, 8, 0.00, 66, 0.00, 0, 0, 0, 66, 1),
    (30, 0.00, 31, 0.00, 33, 0.00, 0, 0, 0, 60, 1),
    (18, 0.00, 60, 0.00, 70, 0.00, 0, 0, 0, 70, 1),
    (12, 0.00, 52, 0.00, 48, 0.00, 0, 0, 0, 60, 1),
    (6, 0.00, 40, 0.00, 57, 0.00, 0, 0, 1, 60, 1),
    (8, 0.00, 2, 1.00, 90, 0.00, 0, 0, 1, 90, 1),
    (25, 0.12, 40, 0.00, 3, 1.00, 0, 0, 0, 60, 1),
    (1, 1.00, 1, 1.00, 1, 1.00, 0, 0, 0, 60, 0),
    (3, 1.00, 2, 1.00, 3, 1.00, 0, 0, 0, 60, 0),
    (14, 0.90, 12, 1.00, 9, 0.80, 0, 0, 0, 60, 0),
    (40, 0.85, 4, 1.00, 5, 1.00, 0, 0, 0, 60, 0),
    (4, 0.00, 1, 1.00, 2, 1.00, 0, 0, 0, 60, 0),
    (5, 0.00, 3, 0.00, 4, 0.50, 0, 0, 0, 60, 0),
    (7, 0.30, 4, 0.50, 0, 0.00, 0, 0, 0, 60, 0),
    (2, 0.00, 0, 0.00, 1, 1.00, 0, 0, 0, 60, 0),
    (3, 0.00, 5, 0.00, 2, 0.00, 0, 0, 1, 60, 0),
    (20, 0.60, 6, 0.00, 8, 0.40, 0, 0, 0, 60, 0),
    # No article: a long block counts for itself, whatever stands beside it.
    (300, 0.00, 0, 0.00, 0, 0.00, 0, 0, 0, 300, 1),
    (300, 0.00, 4, 0.00, 0, 0.00, 0, 0, 0, 300, 1),
    (200, 0.00, 10, 0.00, 10, 0.00, 0, 0, 0, 200, 1),
    (110, 0.10, 8, 1.00, 9, 1.00, 0, 0, 0, 110, 1),
    (90, 0.05, 3, 1.00, 2, 1.00, 0, 0, 0, 90, 1),
    (70, 0.00, 5, 0.00, 12, 0.50, 0, 0, 0, 70, 1),
    (55, 0.02, 12, 1.00, 15, 0.00, 0, 0, 0, 60, 1),
    (45, 0.00, 2, 0.00, 20, 1.00, 0, 0, 0, 60, 1),
    (4, 0.00, 0, 0.00, 300, 0.00, 0, 0, 1, 300, 1),
    (80, 0.35, 70, 0.00, 60, 0.00, 0, 0, 0, 80, 1),
    (60, 0.40, 3, 0.00, 5, 0.00, 0, 0, 0, 60, 1),
    (120, 0.30, 90, 0.10, 80, 0.20, 0, 0, 0, 120, 1),
    (35, 0.30, 40, 0.00, 50, 0.10, 0, 0, 0, 60, 1),
    # No article: so does a short one that opens or ends a long one.
    (5, 0.00, 3, 0.00, 25, 0.00, 0, 0, 1, 60, 1),
    (12, 0.00, 8, 0.00, 30, 0.00, 0, 0, 0, 60, 1),
    (10, 0.00, 90, 0.00, 0, 0.00, 0, 0, 0, 90, 1),
    (12, 0.00, 60, 0.00, 5, 0.00, 0, 0, 0, 60, 1),
    (7, 0.00, 45, 0.00, 14, 0.00, 0, 0, 0, 60, 1),
    # The same outside are none of it.
    (300, 0.00, 0, 0.00, 0, 0.00, 0, 2, 0, 300, 0),
    (300, 0.00, 4, 0.00, 0, 0.00, 0, 2, 0, 300, 0),
    (200, 0.00, 10, 0.00, 10, 0.00, 0, 2, 0, 200, 0),
    (110, 0.10, 8, 1.00, 9, 1.00, 0, 2, 0, 110, 0),
    (90, 0.05, 3, 1.00, 2, 1.00, 0, 2, 0, 90, 0),
    (70, 0.00, 5, 0.00, 12, 0.50, 0, 2, 0, 70, 0),
    (55, 0.02, 12, 1.00, 15, 0.00, 0, 2, 0, 60, 0),
    (45, 0.00, 2, 0.00, 20, 1.00, 0, 2, 0, 60, 0),
    (4, 0.00, 0, 0.00, 300, 0.00, 0, 2, 1, 300, 0),
    (30, 0.00, 31, 0.00, 33, 0.00, 0, 2, 0, 60, 0),
    (150, 0.01, 9, 0.00, 44, 0.00, 0, 2, 0, 150, 0),
    (85, 0.00, 70, 0.00, 64, 0.02, 0, 2, 0, 85, 0),
    (18, 0.00, 60, 0.00, 70, 0.00, 0, 2, 0, 70, 0),
    # No article: short blocks among short ones are none of it.
    (5, 0.00, 6, 0.00, 8, 0.00, 0, 0, 0, 60, 0),
    (10, 0.00, 7, 0.00, 12, 0.00, 0, 0, 0, 60, 0),
    (9, 0.00, 12, 0.00, 9, 0.00, 0, 0, 0, 60, 0),
    (12, 0.00, 5, 0.00, 14, 0.20, 0, 0, 0, 60, 0),
    (8, 0.10, 9, 0.00, 15, 0.00, 0, 0, 0, 60, 0),
    (4, 0.00, 0, 0.00, 6, 0.00, 0, 0, 1, 60, 0),
    (13, 0.00, 14, 0.00, 16, 0.00, 0, 0, 0, 60, 0),
    # No article: links are none of it, however long the blocks beside them.
    (3, 1.00, 150, 0.00, 130, 0.00, 0, 0, 0, 150, 0),
    (8, 1.00, 60, 0.00, 70, 0.00, 0, 0, 0, 70, 0),
    (12, 0.90, 80, 0.00, 90, 0.00, 0, 0, 0, 90, 0),
    (30, 1.00, 100, 0.00, 120, 0.00, 0, 0, 0, 120, 0),
    (60, 0.95, 50, 0.00, 40, 0.00, 0, 0, 0, 60, 0),
    (120, 1.00, 90, 0.00, 200, 0.00, 0, 0, 0, 200, 0),
    (25, 0.70, 200, 0.00, 3, 1.00, 0, 0, 0, 200, 0),
    (6, 0.80, 70, 0.00, 12, 1.00, 0, 0, 0, 70, 0),
    # A part whose class only has such a word in its name: its blocks count by their size, their links and their neighbours.
    (120, 0.00, 80, 0.00, 95, 0.00, 1, 1, 0, 120, 1),
    (40, 0.05, 50, 0.00, 30, 0.00, 1, 1, 0, 90, 1),
    (25, 0.00, 60, 0.00, 45, 0.10, 1, 1, 0, 60, 1),
    (9, 0.00, 80, 0.00, 60, 0.00, 1, 1, 1, 80, 1),
    (8, 0.00, 70, 0.00, 50, 0.00, 1, 1, 0, 70, 1),
    (5, 0.80, 60, 0.00, 40, 0.00, 1, 1, 0, 60, 0),
    (3, 1.00, 30, 0.00, 3, 1.00, 1, 1, 0, 60, 0),
    (6, 0.00, 4, 0.50, 3, 1.00, 1, 1, 0, 60, 0),
    (12, 0.60, 9, 0.40, 15, 0.50, 1, 1, 0, 60, 0),
    (4, 0.00, 3, 0.00, 2, 0.00, 1, 1, 0, 60, 0),
    (150, 0.00, 90, 0.00, 80, 0.00, 0, 1, 0, 150, 1),
    (60, 0.00, 50, 0.00, 70, 0.00, 0, 1, 0, 90, 1),
    (90, 0.02, 4, 0.00, 75, 0.00, 0, 1, 0, 90, 1),
    (70, 0.00, 85, 0.00, 6, 0.50, 0, 1, 0, 85, 1),
    (12, 0.00, 10, 0.00, 8, 0.00, 0, 1, 0, 60, 0),
    (30, 0.00, 5, 0.00, 4, 0.00, 0, 1, 0, 60, 0),
    (45, 0.50, 20, 0.40, 12, 1.00, 0, 1, 0, 90, 0),
    (20, 0.00, 4, 1.00, 3, 1.00, 0, 1, 0, 60, 0),
    (6, 0.00, 90, 0.00, 3, 1.00, 0, 1, 0, 90, 0),
    (4, 1.00, 3, 1.00, 5, 1.00, 0, 1, 0, 60, 0),
    # No article, and no long block on the whole page: short ones are the main text where they have no links.
    (12, 0.00, 12, 0.00, 12, 0.00, 0, 0, 0, 12, 1),
    (12, 0.00, 1, 1.00, 12, 0.00, 0, 0, 0, 12, 1),
    (11, 0.00, 12, 0.00, 4, 0.00, 0, 0, 0, 12, 1),
    (4, 0.00, 12, 0.00, 5, 0.00, 0, 0, 0, 12, 1),
    (5, 0.00, 4, 0.00, 6, 0.00, 0, 0, 0, 13, 1),
    (6, 0.00, 5, 0.00, 3, 1.00, 0, 0, 0, 15, 1),
    (3, 0.00, 4, 0.00, 5, 0.00, 0, 0, 0, 9, 1),
    (8, 0.10, 9, 0.00, 20, 0.00, 0, 0, 0, 20, 1),
    (2, 0.00, 1, 1.00, 12, 0.00, 0, 0, 1, 12, 1),
    (3, 0.00, 0, 0.00, 9, 0.00, 0, 0, 1, 14, 1),
    (7, 0.00, 6, 0.00, 0, 0.00, 0, 0, 0, 16, 1),
    (18, 0.05, 22, 0.00, 30, 0.00, 0, 0, 0, 30, 1),
    (1, 1.00, 1, 1.00, 1, 1.00, 0, 0, 0, 12, 0),
    (5, 0.00, 0, 0.00, 2, 1.00, 0, 0, 0, 5, 0),
    (4, 0.00, 2, 1.00, 2, 1.00, 0, 0, 0, 4, 0),
    (2, 1.00, 12, 0.00, 1, 1.00, 0, 0, 0, 12, 0),
    (3, 1.00, 6, 0.00, 2, 1.00, 0, 0, 0, 9, 0),
    (4, 0.75, 5, 0.00, 4, 0.50, 0, 0, 0, 15, 0),
    (10, 0.90, 12, 0.00, 11, 0.00, 0, 0, 0, 20, 0),
    (12, 0.00, 12, 0.00, 12, 0.00, 0, 2, 0, 12, 0),
    (5, 0.00, 4, 0.00, 6, 0.00, 0, 2, 0, 13, 0),
    (12, 0.00, 9, 0.00, 10, 0.00, 0, 1, 0, 12, 0),
]

# Elements.
BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
CONTAINERS = frozenset("article aside details dialog div fieldset figure footer form head header main menu nav ol section select span table td tr ul button label".split())
INSIDE_TAGS = frozenset("article main".split())
OUTSIDE_TAGS = frozenset("aside dialog footer form head menu nav select button label".split())
RAW_TAGS = frozenset("script style noscript template textarea svg iframe object canvas title math".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id or role that mark a part as not the main text.
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments commentary consent contentinfo cookie cookies copyright disclaimer "
    "disqus dialog footer form header login masthead menu menubar modal nav navbar navigation newsletter notice notices pagination pager popup promo promotion related replies reply "
    "respond responses search share sharing sidebar sidenav signup social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets complementary alert gdpr".split()
)
# Of these, the ones that mark text by others or for other ends; an article within is no article of the page.
FOREIGN_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners comment comments commentary disqus modal newsletter popup promo promotion related replies reply respond sponsor sponsored gdpr".split()
)
# Words before a mark by which a name tells of the part instead of being it: has-sidebar; before LAYOUT_WORDS only: content-sidebar-wrap.
TELLING_WORDS = frozenset("has with without no".split())
TELLING_OF_LAYOUT = frozenset("content layout".split())
LAYOUT_WORDS = frozenset("header menu nav navbar navigation sidebar sidenav toolbar topbar".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
CUT_OFF = re.compile(r"<(?:[a-zA-Z/!?][^>]*)?\Z")


#: Names that mark a part of others' text outside an article, and one of the article's own sections within it.
AMBIGUOUS_NAMES = frozenset("discussion discussions".split())


def mark(attributes: str, own_article: bool = False, inside: bool = False) -> int:
    """2 where a name in class, id or role marks a part as not the main text, or ends in a word that does; 1 where such a word stands elsewhere in it, else 0. An
    article's or a main part's names tell of its topic, so only whole ones count."""
    most = 0
    if not attributes:
        return most
    for m in MARKS.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            parts = [x.lower() for x in WORD_PARTS.findall(name)]
            if len(parts) == 1 and parts[0] in AMBIGUOUS_NAMES:
                most = max(most, 1 if inside else 2)
            said = OUTSIDE_WORDS.intersection(parts)
            if not said:
                continue
            before = set(parts[: min(map(parts.index, said))])
            if before & TELLING_WORDS or (before & TELLING_OF_LAYOUT and said <= LAYOUT_WORDS):
                continue
            whole = said.issuperset(parts)
            if not own_article or whole:
                most = max(most, 2 if whole or said & FOREIGN_WORDS or parts[-1] in said else 1)
    return most


def outside_of(tag: str, attributes: str, inside: bool, outside: int) -> int:
    """How a part is outside, 0 to 2, within one that is so already. An article takes back a 1, a main part all, unless it is marked itself."""
    own = 2 if tag in OUTSIDE_TAGS or (tag == "header" and not inside) else mark(attributes, tag in INSIDE_TAGS, inside)
    if own == 0 and not inside and (tag == "main" or (tag == "article" and outside == 1)):
        return 0
    return max(own, outside)


def blocks(page: str) -> list[tuple[str, int, int, int, int, int]]:
    """(text, words, words in links, inside, outside, heading) of each block that has text, in page order."""
    out: list[tuple[str, int, int, int, int, int]] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, int, bool]] = []  # tag, and what held around it: inside, outside, muted
    inside, outside, muted = False, 0, False
    heading = link = 0
    page = CUT_OFF.sub("", page)
    at = 0

    def text(raw: str) -> None:
        if raw and not muted:
            s = html.unescape(raw) if "&" in raw else raw
            parts.append(s)
            if link:
                linked.append(s)

    def close() -> None:
        if parts:
            words = "".join(parts).split()
            if words:
                out.append((" ".join(words), len(words), len("".join(linked).split()), int(inside), outside, int(bool(heading))))
            parts.clear()
            linked.clear()

    while m := TAG.search(page, at):
        text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        ends = bool(m[1] or m[4])
        if tag in RAW_TAGS:
            if not ends:
                if tag == "title":
                    close()
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                if not (m[3] or m[6] or "").endswith("/"):
                    at = end.end() if end else len(page)
            continue
        if tag == "br":
            parts.append(" ")
        if tag in BLOCK_TAGS:
            close()
            if tag in HEADINGS:
                heading = not ends
        if tag == "a":
            link = not ends
        if tag in CONTAINERS:
            if not ends:
                stack.append((tag, inside, outside, muted))
                around, outside = outside, outside_of(tag, m[3] or m[6], inside, outside)
                inside = inside or tag in INSIDE_TAGS
                if tag not in BLOCK_TAGS and around < outside == 2:
                    muted = True
                    parts.append(" ")
            elif any(s[0] == tag for s in stack):
                while (popped := stack.pop())[0] != tag:
                    pass
                _, inside, outside, muted = popped
    text(page[at:])
    close()
    return out


def features(found: list) -> list[tuple]:
    seen = [(0, 0.0), *((w, lw / w) for _, w, lw, *_ in found), (0, 0.0)]
    longest = max((w for _, w, linked, _, outside, _ in found if 2 * linked < w and outside < 2), default=0)
    return [(*seen[i], *seen[i - 1], *seen[i + 1], *found[i - 1][3:], longest) for i in range(1, len(seen) - 1)]


# -- the tree ----------------------------------------------------------------------


def impurity(rows: list) -> float:
    p = sum(r[-1] for r in rows) / len(rows)
    return 2 * p * (1 - p) * len(rows)


def grow(rows: list, depth: int = 9):
    """A nested (feature, threshold, tree at most it, tree above it), or the label at a leaf."""
    most = int(2 * sum(r[-1] for r in rows) >= len(rows))
    if depth == 0 or impurity(rows) == 0:
        return most
    best = None
    for f in range(len(FEATURES)):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:], strict=False):
            cut = (a + b) / 2
            low, high = [r for r in rows if r[f] <= cut], [r for r in rows if r[f] > cut]
            cost = impurity(low) + impurity(high)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, cut, low, high)
    if best is None or best[0] >= impurity(rows):
        return most
    return best[1], best[2], grow(best[3], depth - 1), grow(best[4], depth - 1)


def decide(tree, row: tuple) -> int:
    while not isinstance(tree, int):
        f, cut, low, high = tree
        tree = low if row[f] <= cut else high
    return tree


def main_text(page: str | None, tree) -> str:
    found = blocks(page or "")
    return "\n".join(b[0] for b, row in zip(found, features(found), strict=True) if decide(tree, row))


def extract_text(pages: DataFrame, labelled: list = LABELLED) -> DataFrame:
    """page_id, url, text for every row of pages (page_id, url, html); columns of other names are left out.

    text holds the blocks of the main text in page order, joined by one \\n, references
    decoded, white space within a block one space. It is empty for a null or empty page and
    for one without main text. A page that is cut off is read as far as it goes. Null ids and
    urls stay as they are; repeated rows each get a row.
    """
    limit_batches(pages.sparkSession)
    tree = grow(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield with_column(batch.select(["page_id", "url"]), "text", [main_text(h, tree) for h in batch.column("html").to_pylist()], pa.string())

    read = pages.select("page_id", "url", pages["html"].cast("string").alias("html"))
    return read.mapInArrow(run, f"{field_list(read, 'html')}, text string")
