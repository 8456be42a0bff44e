"""Main text of web pages by the distribution of text over lines.

The markup is stripped to lines, one for each block. The lengths of the lines
are summed over a sliding window; the text begins where that sum surges and ends
where it dives to nothing. Containers that never hold an article (menus,
footers, adverts, forms, comments ...) become empty lines, and so do lines made
of links, so that the distribution falls to nothing there. All lines of a page take
part. An article or main only adds weight, and only if it holds half of the page's
text: its lines count twice, and its lines of links count as text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, text string, n_chars long"

_RAW = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|title|head)\b[^>]*>.*?(?:</\1\s*>|\Z)",
    re.S | re.I,
)
_TAG = re.compile(
    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>"
    r"|<[!?][^>]*>"
)
_HINT = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SIDE = re.compile(
    r"ads?|adverts?|advertis\w*|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu\w*"
    r"|breadcrumbs?|sidebar|complementary|footer|contentinfo|masthead|cookies?|consent|notice|alert|popup"
    r"|modal|newsletter|subscribe|share|sharing|social|related|recommended|comments?|disqus|replies"
    r"|login|signup|search|toolbar|pagination|pager|skip",
    re.I,
)
# a class of several parts names a side container only if its other parts are of these: has-sidebar does not
_PLACE = re.compile(
    r"site|page|main|global|primary|secondary|top|bottom|left|right|post|list|box|bar|block|area|section|container"
    r"|wrapper|wrap|inner|item|items|link|links|widget|slot|unit|form|header|\d+",
    re.I,
)
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
_SKIPPED = frozenset("nav footer aside form button select dialog menu fieldset".split())
_HINTED = frozenset("article div section ul ol dl p table tr td aside span header".split())
_MAIN = frozenset("article main".split())


def _closing(tags: list[tuple], at: int) -> int | None:
    """Index of the tag that closes the container opened by tags[at]."""
    name, depth = tags[at][3], 0
    for i in range(at, len(tags)):
        if tags[i][3] == name:
            depth += -1 if tags[i][2] else 1
            if not depth:
                return i
    return None


def _side_token(token: str) -> bool:
    if _SIDE.fullmatch(token):
        return True
    rest = [x for x in re.split("[_-]+", token) if x and not _PLACE.fullmatch(x)]
    return bool(rest) and all(_SIDE.fullmatch(x) for x in rest)


def _side(name: str, attributes: str, inside: bool) -> bool:
    if name in _SKIPPED or name == "header" and not inside:
        return True
    if name not in _HINTED or "=" not in attributes:
        return False
    return any(_side_token(t) for m in _HINT.finditer(attributes) for t in " ".join(filter(None, m.groups())).split())


def page_lines(source: str) -> list[tuple[str, int, bool]]:
    """Lines of a page: text, its length outside of links, and whether a marked article holds it."""
    source = _RAW.sub(" ", source)
    tags = []
    for m in _TAG.finditer(source):
        name = (m[2] or m[5] or "").lower()
        if name:
            tags.append((m.start(), m.end(), bool(m[1] or m[4]), name, m[3] or m[6] or ""))
        else:
            tags.append((m.start(), m.end(), False, "!", ""))
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    linked: list[str] = []
    main = link = at = i = 0

    def end_line() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            own = len(text) - len(" ".join(html.unescape("".join(linked)).split()))
            if text:
                lines.append((text, own, main > 0))
            parts.clear()
            linked.clear()

    def add(piece: str) -> None:
        if piece:
            parts.append(piece)
            if link:
                linked.append(piece)

    while i < len(tags):
        begin, end, closes, name, attributes = tags[i]
        add(source[at:begin])
        at = end
        if not closes and _side(name, attributes, main > 0):
            last = _closing(tags, i)
            if last is not None:
                if name != "span":
                    end_line()
                    lines.append(("", 0, main > 0))
                at, i = tags[last][1], last + 1
                continue
        if name == "a":
            link = 0 if closes else 1
        elif name == "br":
            parts.append(" ")
        elif name in _BLOCKS:
            end_line()
            link = 0
            if name in _MAIN:
                main = max(0, main + (-1 if closes else 1))
        i += 1
    add(source[at:])
    end_line()
    return lines


def main_text(source: str | None, window: int = 3, surge: int = 80, plain: float = 0.5) -> str:
    """Text between the surges and dives of the line-block distribution.

    window  lines whose lengths are summed
    surge   sum at which a run of lines counts as text; if no run gets there, the
            run with the most text counts
    plain   least part of a line outside of links, else the line is empty
    """
    if not source:
        return ""
    lines = page_lines(source)
    own_lengths = [n if text and n >= plain * len(text) else 0 for text, n, _ in lines]
    within = sum(n for n, line in zip(own_lengths, lines) if line[2])
    weighs = 2 * within >= sum(own_lengths)
    lengths = [
        2 * len(text) if inside and weighs else len(text) if n else 0 for n, (text, _, inside) in zip(own_lengths, lines)
    ]
    runs: list[tuple[int, int, int]] = []  # first line, line after the last, highest sum of a window
    begin, highest, total = None, 0, 0
    for i, n in enumerate([*lengths, 0]):
        total += n - (lengths[i - window] if i >= window else 0)
        if n and begin is None:
            begin, highest, total = i, 0, n
        if begin is not None:
            highest = max(highest, total)
            if not n:
                runs.append((begin, i, highest))
                begin, total = None, 0
    if not runs:
        return ""
    least = min(surge, max(r[2] for r in runs))
    return "\n".join(lines[i][0] for a, b, high in runs if high >= least for i in range(a, b))


def extract_main(
    pages: DataFrame, window: int = 3, surge: int = 80, key: str = "page_id", source: str = "html"
) -> DataFrame:
    """page_id, url, text, n_chars of every page; one output row for each input row.

    A missing or empty page, and a page without text, gives the empty text. Rows
    are independent: repeated rows give repeated results, no row is moved.
    Further columns of the input are not read.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col(source).cast("string").alias("html"),
    )

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(x, window, surge) for x in batch["html"]]
            yield pd.DataFrame(
                {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}
            )

    return rows.mapInPandas(work, SCHEMA)
