"""Main text of web pages by line-block distribution.

Markup is stripped into lines: every block element starts one, and adjacent block tags are one break. What sits in menus,
page headers, footers, sidebars, forms, adverts, notices, comments and code leaves an empty line behind for each of its blocks, and so
does a rule. Lengths of lines, none for lines mostly of links outside headings, are summed over windows of `width` lines. A surge is a
line whose window rises from nothing; a dive is where the windows fall back to nothing (`width` such lines in a row). The
text between a surge and its dive is one region; what a page names its article (`article` or `main`) and what lies outside it have
regions of their own. The heaviest region and those with a `share` of its length stay, and small ones between two that stay.
An article counts as a whole: all its regions stay, and others only if they outweigh it, unless it is
less than a `share` of the heaviest region outside it.

Defined cases: null and empty pages, and pages without text, give the empty string; an element that never closes reaches
to the end, but an article opens even inside a form, menu or page header; repeated rows give repeated results.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>", re.DOTALL)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
# Attributes with their quotes paired, or else up to the next sign that closes a tag.
_QUOTED = re.compile(r"""((?:"[^"]*"|'[^']*'|[^'">])*+)>""", re.DOTALL)
_PLAIN = re.compile(r"([^>]*)>")
_RAW = frozenset("script style noscript template textarea title svg math iframe object canvas video audio head".split())
_SKIPPED = frozenset("nav footer aside form menu button select dialog fieldset label input".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3
    h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split()
)
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
# A name says that an element is noise if one of its words is in the first list and all others are in either.
_NOISE = frozenset(
    """ad ads adbox adslot advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary
    consent contentinfo cookie cookies disqus footer form gdpr login masthead menu modal nav navbar navigation newsletter notice notices
    overlay paywall popup promo promotion related replies reply search share sharing sidebar signup social sponsor sponsored subscribe
    subscription toolbar widget""".split()
)
_PLACES = frozenset(
    """action area articles aside bar block bottom box btn button buttons center col column container content cta fixed global group header
    icons inner inline item items js label left links list main message mobile module outer page panel policy post posts primary right
    rail row secondary section site slot small stories sticky story text thread top unit wide wrap wrapper""".split()
)
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_ENDS_ITSELF = frozenset(("p", "li", "dt", "dd", "td", "th", "tr", "option"))


def _noisy(name: str, attributes: str) -> bool:
    """Whether an element's own names mark it as something other than the article."""
    if name in _SKIPPED:
        return True
    for m in _NAMED.finditer(attributes) if attributes.strip() else ():
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "hidden" and not value or key == "aria-hidden" and value == "true":
            return True
        if key in ("class", "id", "role") and any(map(_noise_name, value.split())):
            return True
    return False


def _noise_name(name: str) -> bool:
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    return any(w in _NOISE for w in words) and all(w in _NOISE or w in _PLACES for w in words)


class _Tags:
    """The tags of a page in order, each looked for from the end of the one before. No search runs over the same part of
    a page again and again: where no sign closes a tag any more the rest is text, and once quotes have stayed open to the
    end of the page they pair with nothing."""

    def __init__(self, page: str):
        self.page, self.paired, self.last = page, True, page.rfind(">")

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """(start, end, name, closing, attributes) of the first tag or comment from a place on; no name for a comment."""
        page = self.page
        while True:
            at = page.find("<", at)
            if at > self.last:  # only a comment that never closes
                at = page.find("<!--", at)
            if at < 0:
                return None
            if m := _COMMENT.match(page, at):
                return at, m.end(), "", False, ""
            if m := _NAME.match(page, at):
                rest = _QUOTED.match(page, m.end()) if self.paired else None
                self.paired = rest is not None
                rest = rest or _PLAIN.match(page, m.end())
                return at, rest.end(), m[2].lower(), bool(m[1]), rest[1]
            at += 1


def lines_of(page: str) -> tuple[list[tuple[str, bool, int]], bool]:
    """Lines as (text, inside an article, characters in links), and whether any article has text."""
    lines: list[tuple[str, bool, int]] = []
    parts: list[str] = []
    linked, in_link, article, named = 0, False, 0, False
    skip, depth, heading = "", 0, False

    def close() -> None:
        nonlocal linked, named
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            lines.append((text, article > 0, 0 if heading else linked))
        named = named or bool(text and article)
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not skip:
            parts.append(text)
            linked += len(text) * in_link

    at, tags = 0, _Tags(page)
    while at < len(page):
        tag = tags.next(at)
        if not tag:
            add(page[at:])
            break
        start, end, name, closing, attributes = tag
        add(page[at:start])
        at = end
        if not name:
            continue
        if name in _RAW and not closing:
            # Nothing closes an element behind the page's last sign that closes a tag.
            found = re.compile(rf"</{name}\b[^>]*>" + (r"|(?=<body\b)" if name == "head" else ""), re.IGNORECASE).search(page, at, tags.last + 1)
            at = found.end() if found else len(page)
            continue
        if skip:
            if skip in ("nav", "header", "menu", "form", "fieldset") and not closing and name in ("article", "main") and not _noisy("", attributes):
                skip = ""
            elif skip in _ENDS_ITSELF and (name in _BLOCK and name != skip and closing or name == skip and not closing):
                skip = ""
            else:
                if name == skip and name not in _VOID:
                    depth += -1 if closing else 1
                    if depth == 0:
                        skip = ""
                if skip in _BLOCK and name in _BLOCK and not closing:
                    lines.append(("", article > 0, 0))
                continue
        if name == "a":
            in_link = not closing
        if name == "br":
            parts.append(" ")
        if name not in _BLOCK:
            if not closing and name not in _VOID and _noisy(name, attributes):
                skip, depth = name, 1
            continue
        close()
        heading = not closing and name in _HEADINGS
        if name == "hr":
            lines.append(("", article > 0, 0))
        if name in ("article", "main"):
            article = max(0, article + (-1 if closing else 1))
        if not closing and (_noisy(name, attributes) and name not in ("body", "html") or name == "header" and not article):
            if name not in ("article", "main") or article > 1 or _noisy("", attributes):
                skip, depth = name, 1
                if name in ("article", "main"):
                    article -= 1
                lines.append(("", article > 0, 0))
    close()
    return lines, named


def regions(lengths: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Lines [surge, dive) between which no `width` lines in a row are empty."""
    sums = np.convolve(lengths, np.ones(width, np.int64))[width - 1 :] if len(lengths) else lengths
    out, surge = [], -1
    for i, n in enumerate(sums.tolist()):
        if surge < 0 and lengths[i]:
            surge = i
        elif surge >= 0 and n == 0:
            out.append((surge, i))
            surge = -1
    if surge >= 0:
        out.append((surge, len(lengths)))
    return out


def main_text(page: str | None, width: int = 3, share: float = 0.25) -> str:
    lines, named = lines_of(page or "")
    size = np.array([len(t) for t, _, _ in lines], np.int64)
    prose = np.where(np.array([x[2] for x in lines], np.int64) * 2 > size, 0, size)
    length = prose if prose.any() else size  # a page of links alone is its own text
    inside = np.array([x[1] for x in lines], bool)
    bounds = [0, *(np.flatnonzero(inside[1:] != inside[:-1]) + 1).tolist(), len(lines)]
    found = [(a + x, a + y) for a, b in zip(bounds[:-1], bounds[1:], strict=True) for x, y in regions(length[a:b], width)]
    if not found:
        return ""
    weight = np.array([length[a:b].sum() for a, b in found])
    within = np.array([inside[a] for a, _ in found])
    article = weight[within].sum()
    most = weight[~within].max(initial=0)
    if named and article and article >= share * most:
        stays = within | (weight >= article)
    else:
        stays = ~within & (weight >= share * most)
        at = np.flatnonzero(stays)
        stays[at[0] : at[-1] + 1] |= ~within[at[0] : at[-1] + 1]
    return "\n\n".join(t for (a, b), stay in zip(found, stays.tolist(), strict=True) if stay for t, _, _ in lines[a:b] if t)


def _extract(width: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [main_text(x.as_py(), width, share) for x in part.column("html")]
                arrays = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    return run


def extract_main_text(pages: DataFrame, width: int = 3, share: float = 0.25) -> DataFrame:
    """page_id, url, text, n_chars per row of `pages` (page_id, url, html)."""
    rows = pages.select("page_id", "url", "html")
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(_extract(width, share), f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
