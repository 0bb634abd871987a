"""Main text of web pages by two-pass block rules: stop-word density, length and link density.

A page is cut into blocks at block-level tags; scripts, styles, markup and forms never make text. Blocks inside menus, page
headers, footers, sidebars, notices, adverts and reader comments, by element, role or class, are left out. A class speaks of
furniture by its first or last part (``main-menu``, ``comment-list``), but not as a mark of the layout (``with-sidebar``);
inside an article a paragraph or heading is left out for the plainest words only.

In pass one the other blocks are good, bad or undecided by the share of stop words (four languages), length and share of
linked characters; where the page's text fits none of these languages, by length and links alone; inside an article or main
element only items of lists that are all link are bad. In pass two an undecided block takes the label of the nearest decided
blocks before and after it; where these differ the nearer wins, then the good one; where none is decided all are good.

The page is read once from start to end, whatever it holds: tags and quotes that never close are looked for once.

A null html gives an empty text, as does a page without good blocks; an empty table gives an empty one; rows repeat as they
are; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from funnelspark.llm._spark import small_batches

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a about an and are as at be been but by for from had has have he her his i if in is it its not of on or she that the their them there they this to was we were which who will with you "
    "aber als am an auch auf aus bei bin bis das dass dem den der des die du ein eine einem einen einer er es für hat ich ihr im in ist mit nach nicht noch nur oder sich sie sind so über um und uns von vor war was wie wir zu zum zur "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas pour qu que qui sa se ses son sont sur un une vous y à "
    "al como con de del el ella en entre es esta este esto fue ha las le lo los más me mi no nos o para pero por que se si sin sobre su sus también tu un una y ya".split()
)
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
SKIPPED = frozenset("nav footer aside form head script style noscript template iframe object svg math canvas select button label video audio textarea menu dialog title".split())
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP_WORDS = frozenset("ad ads adsense adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice sidebar comment comments reply replies disqus respond menu nav navbar navigation breadcrumb breadcrumbs share sharing social related popup modal newsletter subscribe footer widget toolbar pagination pager login signup masthead".split())
#: Of these, the ones that also drop a paragraph or heading of an article; first parts that speak of the layout, not of the element.
PLAIN_WORDS = frozenset("ad ads adsense adsbygoogle advert adverts advertisement sponsored cookie cookies comment comments replies breadcrumb breadcrumbs newsletter share sharing".split())
LAYOUT = frozenset("with has have no without is not layout".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre span b i em strong a td th dd dt li figcaption".split())
#: Elements that their next sibling of the same name ends.
ENDED = frozenset("li dt dd td th tr".split())
SHORT, LONG = 70, 200
LOW, HIGH, LINKS = 0.2, 0.3, 0.5
NAME = re.compile(r"<(/?)([A-Za-z][^\s/><]*)")
EDGE = re.compile(r">|=\s*[\"']")
NAMED = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORD = re.compile(r"[^\W\d_]+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
GOOD, BAD, OPEN = 1, 0, None


def _furniture(value: str, name: str, in_article: bool) -> bool:
    """Whether a class or id speaks of page furniture."""
    words = PLAIN_WORDS if in_article and name in PARAGRAPHS else SKIP_WORDS
    for token in value.split():
        parts = [p.lower() for p in PARTS.findall(token)]
        if not parts or parts[0] in LAYOUT:
            continue
        if parts[0] in words or parts[-1] in words:
            return True
        if parts[-1] == "header" and not in_article and parts[0] not in ("article", "entry", "post", "story", "content"):
            return True
    return False


def _skips(name: str, attrs: str, in_article: bool) -> bool:
    if name in SKIPPED or name == "header" and not in_article:
        return True
    if not attrs or name in ("html", "body", "article", "main"):
        return False
    for key, *values in NAMED.findall(attrs):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "role" and value.lower() in SKIP_ROLES:
            return True
        if key == "style" and UNSEEN.search(value):
            return True
        if key in ("class", "id") and _furniture(value, name, in_article):
            return True
    return False


@cache
def _shut(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I)


def tags(page: str) -> Iterator[tuple[str, str, str, int]]:
    """(text before, mark, attributes, end) of every tag in order; mark is name, /name, or empty for what makes no text.

    The consumer may send a place further on, from which reading goes on. Text after the last tag comes with mark "end".
    """
    at, n, quoted = 0, len(page), True
    last = {q: page.rfind(q) for q in "\"'"}

    def shut(i: int) -> int:
        """Where the tag ends whose attributes begin at i; quotes that have no end are plain."""
        nonlocal quoted
        begin = i
        while quoted and (m := EDGE.search(page, i)):
            if m[0] == ">":
                return m.start()
            q = m[0][-1]
            i = page.find(q, m.end()) + 1 if m.end() <= last[q] else m.end()
        quoted = False
        return page.find(">", begin)

    start = 0
    while (i := page.find("<", at)) >= 0:
        m, mark, attrs, end, text = NAME.match(page, i), "", "", i + 1, page[start:i]
        if m:
            if (g := shut(m.end())) < 0:
                break
            mark, attrs, end = m[1] + m[2].lower(), page[m.end() : g], g + 1
        elif page.startswith("<![CDATA[", i):
            g = page.find("]]>", i)
            text, end = text + html.escape(page[i + 9 : g if g >= 0 else n], quote=False), g + 3 if g >= 0 else n
        elif page.startswith("<!--", i):
            end = i + 5 if page.startswith("<!-->", i) else page.find("-->", i + 4) + 3
            end = end if end > 2 else n
        elif page[i + 1 : i + 2] in ("!", "?", "/"):
            end = page.find(">", i) + 1 or n
        else:  # a sign by itself is text
            at = i + 1
            continue
        sent = yield text, mark, attrs, end
        at = start = max(end, sent or 0)
        if sent:
            yield "", "", "", at
    yield page[start:], "end", "", n


def blocks(page: str) -> list[tuple[str, int, bool, bool, str]]:
    """(text, linked characters, skipped, in an article, element) of every block in page order."""
    out: list[tuple[str, int, bool, bool, str]] = []
    parts: list[str] = []
    # open elements: name, skipped, in an article, and the text around one that is skipped inside a line
    stack: list[tuple[str, bool, bool, tuple[list[str], int] | None]] = []
    n_open: Counter[str] = Counter()
    linked, in_link, begun = 0, False, set()

    def flush() -> None:
        nonlocal linked
        if parts:
            if text := " ".join("".join(parts).split()):
                name, skip, article = stack[-1][:3] if stack else ("", False, False)
                out.append((text, linked, skip, article, name))
            parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal linked
        name, _, _, around = stack.pop()
        n_open[name] -= 1
        if around:
            parts[:], linked = around

    reader = tags(page)
    for text, mark, attrs, end in reader:
        if text:
            piece = html.unescape(text)
            parts.append(piece)
            linked += len(piece.strip()) if in_link else 0
        name = mark.lstrip("/")
        if name in BLOCKS:
            flush()
        elif name == "br":
            parts.append(" ")
        if mark.startswith("/"):
            in_link = in_link and name != "a" and name not in BLOCKS
            while n_open[name]:
                found = stack[-1][0] == name
                if stack[-1][1] or stack[-1][0] in BLOCKS:
                    flush()
                pop()
                if found:
                    break
            continue
        if name == "a":
            in_link = True
        if not name or name in ("a", "end") or name in VOID or attrs.endswith("/") and name not in BLOCKS:
            continue
        if name in RAW:
            shut = _shut(name).search(page, end)
            reader.send(shut.end() if shut else len(page))
            continue
        if name in BLOCKS and stack and (stack[-1][0] == "p" or name in ENDED and stack[-1][0] == name):
            pop()
        if name in ("article", "main", "body") and name not in begun:  # furniture left open before the text began
            begun.add(name)
            stack = [x for x in stack if not (x[1] and x[0] in ("head", "nav", "header", "footer"))]
            n_open = Counter(x[0] for x in stack)
        skip, article = stack[-1][1:3] if stack else (False, False)
        own_skip = _skips(name, attrs, article)
        around = None
        if own_skip and not skip:
            around, in_link = None if name in BLOCKS else (parts[:], linked), False
            parts.clear()
            linked = 0
        if name in BLOCKS or own_skip:
            stack.append((name, skip or own_skip, article or name in ("article", "main"), around))
            n_open[name] += 1
    flush()
    while stack:
        pop()
        flush()
    return out


def _density(text: str) -> tuple[int, int]:
    words = WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words), len(words)


def _first_pass(text: str, linked: int, article: bool, element: str, listed: bool) -> int | None:
    links = linked / len(text)
    if article:
        return BAD if element == "li" and links > 0.9 else GOOD
    if links > LINKS:
        return BAD
    if len(text) < SHORT:
        return OPEN if not linked else BAD
    if not listed:  # none of the languages: length and links alone
        return GOOD if len(text) > LONG else OPEN
    stops, words = _density(text)
    density = stops / max(1, words)
    if density >= HIGH:
        return GOOD if len(text) > LONG else OPEN
    return OPEN if density >= LOW else BAD


def main_text(page: str) -> str:
    found = [b for b in blocks(page) if not b[2]]
    counted = [_density(b[0]) for b in found if not b[3] and 2 * b[1] < len(b[0])]
    listed = sum(s for s, _ in counted) >= LOW / 2 * sum(w for _, w in counted)
    labels = [_first_pass(text, linked, article, name, listed) for text, linked, _, article, name in found]
    n = len(labels)
    before: list[tuple[int, int | None]] = []
    near, dist = None, 0
    for label in labels:
        near, dist = (label, 0) if label is not OPEN else (near, dist + 1)
        before.append((dist, near))
    near, dist = None, 0
    for i in range(n - 1, -1, -1):
        near, dist = (labels[i], 0) if labels[i] is not OPEN else (near, dist + 1)
        if labels[i] is OPEN:
            sides = sorted((d, -x, x) for d, x in (before[i], (dist, near)) if x is not None)
            before[i] = (0, sides[0][2] if sides else GOOD)
    return "\n".join(b[0] for b, (_, label) in zip(found, before, strict=True) if label == GOOD)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of pages(page_id, url, html)."""
    small_batches(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py() or "") for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
