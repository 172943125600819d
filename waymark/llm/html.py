"""Main text of web pages: two-pass block rules.

A page is cut at its tags into blocks: runs of text that no block-level tag interrupts (``<br>`` ends a block as well). Comments,
scripts, styles, forms and the like are no text. Character references are decoded, white space becomes one space.

First pass, for each block on its own. Bad: inside a menu, header of the page, footer, sidebar, form or another part that its tag, role or
class names as no article; or mostly links. Good: inside ``article`` or ``main`` with at least ``LONG`` characters, or elsewhere with
at least ``LONG`` characters and a share of stop words of at least ``DENSE``. Short: whatever is shorter than ``LONG``. Near good
(stop words from ``SPARSE`` on) and bad are what is left. Second pass: short and near-good blocks take the label of the nearest decided
block on either side (two good neighbours, or one good one and no bad one nearer: good); inside ``article`` or ``main``, where
nothing names a block as bad, they are good.

The blocks that are good are joined in page order by a line feed. A null or empty page, and one without any good block, has an
empty text. Rows are independent; the length of a page is not limited. Unclosed and crossed tags are closed where an outer one ends.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from waymark.llm.common import steps

LONG = 70  # characters
DENSE, SPARSE = 0.3, 0.1
MAX_LINKS = 0.4

# Frequent words of the languages at hand.
STOP_WORDS = frozenset(
    """the of and to in is that for it with as was on be at by this are or from an have not you which a i he they his her its
    der die das und ist von den mit sich des auf für nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer dem zu im
    le la les de des du et est un une que qui dans pour pas sur au par avec ce il elle sont plus ne se en à
    el los las del que y en un una por con no es se su para al lo como más o pero sus""".split()
)
# Tags.
BLOCK_TAGS = frozenset(
    """address article aside blockquote body br button center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4
    h5 h6 head header hr html iframe legend li main menu nav noscript ol option p pre section select summary table tbody td
    template textarea tfoot th thead title tr ul video audio canvas object script style svg""".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = frozenset("head script style noscript template svg iframe object canvas video audio select button textarea form nav footer aside menu dialog title".split())
# Raw text: nothing inside is a tag.
RAW_TAGS = frozenset("script style textarea title".split())
# Elements that end where another one of their kind, or their parent, begins or ends.
SELF_CLOSING = {"p": BLOCK_TAGS - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
# Words of classes, ids and roles that name parts which are not the article.
NOT_ARTICLE = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|banner|footer|sidebar|aside|complementary|contentinfo|ads?|advert\w*|sponsor\w*|promo\w*"
    r"|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|comments?|replies|respond|disqus"
    r"|search|pagination|pager|toolbar|widget|copyright|legal|disclaimer|skip)(?=$|[\s_-])",
    re.I,
)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
WORD = re.compile(r"[^\W\d_]+")


def not_article(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in SILENT_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("article", "main", "body", "html"):
        return False
    if HIDDEN.search(attributes):
        return True
    return any(NOT_ARTICLE.search(a or b or c) for a, b, c in NAMED.findall(attributes))


def blocks(page: str) -> list[tuple[str, float, bool, bool]]:
    """(text, share of it in links, named as no article, in an article) of the page's blocks."""
    out: list[tuple[str, float, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, this or an outer one is no article, this or an outer one is an article
    parts: list[str] = []
    linked, links = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            out.append((text, min(1.0, linked / len(text)), *(stack[-1][1:] if stack else (False, False))))
        parts.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal links
        for tag, _, _ in stack[depth:]:
            links -= tag == "a"
        del stack[depth:]

    at, size = 0, len(page)
    while at < size:
        found = TOKEN.search(page, at)
        text = page[at : found.start() if found else size]
        if text:
            parts.append(text)
            if links:
                linked += len(" ".join(html.unescape(text).split()))
        if not found:
            break
        at = found.end()
        closing, tag, attributes = found.group(1), (found.group(2) or "").lower(), found.group(3)
        if not tag:
            continue
        if tag in BLOCK_TAGS:
            flush()
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                close(depth)
            continue
        if stack and tag in SELF_CLOSING.get(stack[-1][0], ()):
            close(len(stack) - 1)
        elif tag in SELF_CLOSING["p"]:
            # An open p ends here, whatever is open inside it.
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCK_TAGS), None)
            if depth is not None and stack[depth][0] == "p":
                close(depth)
        if tag in VOID_TAGS or attributes.endswith("/"):
            continue
        bad, article = stack[-1][1:] if stack else (False, False)
        bad = bad or not_article(tag, attributes, article)
        stack.append((tag, bad, article or tag in ("article", "main")))
        links += tag == "a"
        if tag in RAW_TAGS:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            close(len(stack) - 1)
    flush()
    return out


GOOD, BAD, NEAR, SHORT = "good", "bad", "near", "short"


def label(text: str, links: float, named_bad: bool, in_article: bool) -> str:
    """The label of a block on its own."""
    if named_bad or links > MAX_LINKS:
        return BAD
    if len(text) < LONG:
        return SHORT
    if in_article:
        return GOOD
    words = WORD.findall(text.lower())
    density = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    return GOOD if density >= DENSE else NEAR if density >= SPARSE else BAD


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    first = [label(*b) for b in found]
    # The nearest decided block before and after each block, and how far away it is.
    ahead: list[tuple[str, int]] = []
    seen = (BAD, len(found) + 1)
    for k in range(len(found) - 1, -1, -1):
        ahead.append(seen)
        if first[k] in (GOOD, BAD):
            seen = (first[k], k)
    ahead.reverse()
    kept, before = [], (BAD, -2)
    for k, (text, _, _, in_article) in enumerate(found):
        own = first[k]
        if own in (SHORT, NEAR):
            good = [abs(at - k) for what, at in (before, ahead[k]) if what == GOOD]
            bad = [abs(at - k) for what, at in (before, ahead[k]) if what == BAD]
            own = GOOD if in_article or (good and (not bad or min(good) < min(bad) or (own == NEAR and min(good) <= min(bad)))) else BAD
        else:
            before = (own, k)
        if own == GOOD:
            kept.append(text)
    return "\n".join(kept)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row of ``pages`` (page_id, url, html)."""

    def extract(batches):
        for batch in steps(batches, "html"):
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    schema = pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return pages.select("page_id", "url", "html").mapInArrow(extract, schema)
