"""Main text of web pages by paths that the pages of a host agree on.

A page's containers are scored by the text right inside them, less what is link text, with
half of it for the container around. From the best container the page climbs to the
outermost article or main around it, or else as long as what a container adds is not link
text, so that a headline or a lead beside the body is not lost. The generalised path (tags
and classes from the body down, digits made #) of where it ends is the page's vote; Spark
counts the votes of each host. Each page is then read again with its host's winning paths,
those with a fifth of the votes or more, in order of votes: the first one that holds most
of the text of the page's best container is taken. A page that has none of them uses its
own container.

Navigation, headers, footers, sidebars, forms, adverts, notices and comments are left out
by tag, role or class, inside the chosen container too; a header within an article is
part of it. A class or id counts by its last part, and not if it speaks of another container
(has-, no-, with-). A container that holds most of the page's paragraph text stays, and so
does one around the longest article or main where all of them would go; comments stay only
where there is nothing else. Character references are decoded, white space in a block
becomes one blank, blocks are joined by new lines in page order. Nothing else is dropped.

Rules for odd rows
    * A null html is an empty page, with empty text; so is a page with no text outside of
      what is left out.
    * A null url, or one without a host, is the host "".
    * Repeated rows vote and are extracted each; ties in votes go to the smaller path.
    * Empty tables give empty results; extra columns are handed through, and a column with
      the name of a made one is replaced.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.words import carried, handed_back, text_of

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|select|button|iframe|svg|title|object)\b"
    r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([a-zA-Z-]+)")
DIGITS = re.compile(r"\d+")
PARTS = re.compile(r"[\s_-]+|(?<=[a-z])(?=[A-Z])")

# Elements that hold blocks, elements that end a block, and what is left out.
CONTAINERS = frozenset(
    "body div section article main nav header footer aside ul ol li dl dt dd table thead tbody tfoot tr td th form"
    " figure figcaption blockquote fieldset details summary center menu dialog address hgroup".split()
)
BREAKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 pre hr html head caption option legend".split())
LEFT_OUT_TAGS = frozenset("nav footer aside form menu dialog head".split())
LEFT_OUT_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert menu".split())
LEFT_OUT_NAMES = frozenset(
    "nav navigation navbar menu footer header masthead sidebar side ad ads advert adverts advertisement adsense sponsor"
    " sponsored promo banner cookie cookies consent gdpr notice popup modal overlay share sharing social related"
    " recommended comment comments commentlist disqus reply replies breadcrumb breadcrumbs newsletter subscribe"
    " signup login search pagination pager widget toolbar skip".split()
)
# Names of comments; tags that an article in them does not bring back; parts by which a name
# speaks of another container, and parts that do not say what a box holds.
TALK = frozenset("comment comments commentlist disqus reply replies".split())
ASIDE_TAGS = frozenset("nav footer aside menu dialog".split())
LINKING = frozenset("has no not with without by".split())
BOX_NAMES = frozenset(
    "area bar block box boxes button buttons column container content count form group inner item items left link links list"
    " main outer panel primary right row secondary section site text top bottom unit wrap wrapper".split()
)


def attributes(text: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


def _named(names: str) -> bool:
    """Whether a class or id says what is left out: by its last part, or with parts that only tell a kind of box."""
    for name in names.split():
        parts = [p.lower() for p in PARTS.split(name) if p]
        if not parts or LINKING & set(parts):
            continue
        said = [p in LEFT_OUT_NAMES for p in parts]
        if name.lower() in LEFT_OUT_NAMES or said[-1] or any(said) and all(x or p in BOX_NAMES for x, p in zip(said, parts, strict=True)):
            return True
    return False


def _hidden(attrs: dict[str, str]) -> bool:
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    return "display:none" in attrs.get("style", "").replace(" ", "").lower()


def _left_out(tag: str, attrs: dict[str, str], inside: Sequence[str]) -> bool:
    if tag in LEFT_OUT_TAGS or tag == "header" and not {"article", "main"} & set(inside):
        return True
    if attrs.get("role", "").lower() in LEFT_OUT_ROLES:
        return True
    return tag not in ("body", "article", "main") and (_named(attrs.get("class", "")) or _named(attrs.get("id", "")))


@dataclass
class _Node:
    tag: str
    path: str
    parent: int
    named: bool = False
    hidden: bool = False
    paragraphs: int = 0  # signs in paragraphs of it and below
    signs: int = 0  # signs that are no link text, of it and below
    holds: bool = False  # the page's article, where all of them would be left out
    talk: bool = False


def _parsed(html: str) -> tuple[list[_Node], list[tuple[int, str, int, bool]]]:
    """All containers, parents first, and (container, text, signs of link text, in a paragraph) of each block."""
    nodes = [_Node("", "", -1)]
    out: list[tuple[int, str, int, bool]] = []
    stack = [0]
    parts: list[str] = []
    linked, in_link, in_paragraph, at = 0, False, False, 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append((stack[-1], text, min(linked, len(text)), in_paragraph))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = unescape(text)
            parts.append(text)
            if in_link:
                linked += len(text)

    for m in TOKEN.finditer(html):
        add(html[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        closing = bool(m[2])
        if tag == "a":
            in_link = not closing
        elif tag in ("br", "wbr"):
            parts.append(" ")
        elif tag in BREAKS:
            close()
            in_link, in_paragraph = False, tag == "p" and not closing
            if tag not in CONTAINERS and tag != "head":
                continue
            if not closing:
                if m[4].rstrip().endswith("/"):
                    continue
                attrs = attributes(m[4]) if m[4].strip() else {}
                name = DIGITS.sub("#", ".".join([tag, *sorted(attrs.get("class", "").split())]))
                if tag == "body":
                    stack = stack[:1]  # an open head ends here
                above = nodes[stack[-1]].path
                named = _left_out(tag, attrs, [nodes[k].tag for k in stack])
                talk = bool(TALK & set(PARTS.split(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower())))
                nodes.append(_Node(tag, f"{above}>{name}" if above else name, stack[-1], named, _hidden(attrs), talk=talk))
                stack.append(len(nodes) - 1)
            elif any(nodes[k].tag == tag for k in stack):
                while nodes[stack.pop()].tag != tag:
                    pass
    add(html[at:])
    close()
    return nodes, out


def blocks(html: str) -> list[tuple[str, str, int]]:
    """(container's path, text, signs of link text) of each block that is not left out."""
    nodes, out = _parsed(html)
    out_by_name = [False]
    for node in nodes[1:]:
        node.hidden |= nodes[node.parent].hidden
        out_by_name.append(out_by_name[node.parent] or node.named or node.hidden)
    for k, text, linked, in_paragraph in out:
        if not nodes[k].hidden and nodes[k].tag != "head":
            nodes[k].signs += len(text) - linked
            nodes[k].paragraphs += (len(text) - linked) * in_paragraph
    for node in reversed(nodes[1:]):
        nodes[node.parent].signs += node.signs
        nodes[node.parent].paragraphs += node.paragraphs
    whole = [k for k, n in enumerate(nodes) if n.tag in ("article", "main") and n.signs and not n.hidden]
    if whole and all(out_by_name[k] for k in whole):
        nodes[max(whole, key=lambda k: nodes[k].signs)].holds = True
    for node in reversed(nodes[1:]):
        nodes[node.parent].holds |= node.holds
    # Where a page has no paragraphs, all its text counts.
    field = "paragraphs" if nodes[0].paragraphs else "signs"
    standing = any(not out_by_name[k] for k, *_ in out) or any(n.holds for n in nodes) and not any(n.holds and n.talk for n in nodes)

    def kept(node: _Node) -> bool:
        if node.tag == "head":
            return False
        if node.holds and node.tag not in ASIDE_TAGS:
            return True
        # A thread of comments may be longer than what it is about.
        return not (node.talk and standing) and 2 * getattr(node, field) > getattr(nodes[0], field)

    gone = [False]
    for node in nodes[1:]:
        gone.append(gone[node.parent] or node.hidden or node.named and not kept(node))
    return [(nodes[k].path, text, linked) for k, text, linked, _ in out if not gone[k]]


def _under(found: list[tuple[str, str, int]], path: str) -> list[tuple[str, str, int]]:
    return [x for x in found if not path or x[0] == path or x[0].startswith(path + ">")]


def best_path(found: list[tuple[str, str, int]]) -> str | None:
    """The path of the container with most text of its own."""
    scores: dict[str, float] = defaultdict(float)
    for path, text, linked in found:
        worth = len(text) + 10 * text.count(",") - 3 * linked
        scores[path] += worth
        scores[path.rpartition(">")[0]] += worth / 2
    good = [(score, path) for path, score in scores.items() if score > 0 and path]
    return min(good, key=lambda x: (-x[0], x[1]))[1] if good else None


def climbed(found: list[tuple[str, str, int]], path: str) -> str:
    """The path, or that of the container around it that is the whole article."""
    steps = path.split(">")
    whole = [k for k, step in enumerate(steps) if step.split(".")[0] in ("article", "main")]
    if whole:
        return ">".join(steps[: whole[0] + 1])
    taken, own = path, len(_under(found, path))
    for k in range(len(steps) - 1, -1, -1):
        around = ">".join(steps[:k])
        if (n := len(_under(found, around))) == own:
            continue
        more = [x for x in _under(found, around) if not (x[0] == taken or x[0].startswith(taken + ">"))]
        if 2 * sum(linked for *_, linked in more) > sum(len(text) for _, text, _ in more):
            break
        taken, own = around, n
    return taken


def voted(html: str) -> str | None:
    found = blocks(html)
    best = best_path(found)
    return climbed(found, best) if best else None


def extracted(html: str, winners: Sequence[str]) -> str:
    found = blocks(html)
    best = best_path(found)
    if best is None:
        return "\n".join(t for _, t, _ in found)
    whole = sum(len(t) for _, t, _ in _under(found, best))
    for path in [*winners, climbed(found, best)]:
        taken = _under(found, path)
        # Of a path that lies inside the best container or around it, what both hold counts.
        if 2 * sum(len(t) for _, t, _ in _under(taken, best)) > whole:
            break
    return "\n".join(t for _, t, _ in taken)


def main_text(
    pages: DataFrame, url: str = "url", html: str = "html", carry: Sequence[str] | None = None, salts: int = 64
) -> DataFrame:
    """Each page with ``text`` and ``n_chars``."""
    names = pages.columns if carry is None else list(carry)

    @F.pandas_udf("string")
    def vote(texts: pd.Series) -> pd.Series:
        return pd.Series([voted(t) for t in texts], dtype=object)

    @F.pandas_udf("string")
    def extract(texts: pd.Series, winners: pd.Series) -> pd.Series:
        return pd.Series([extracted(t, [] if w is None else w) for t, w in zip(texts, winners, strict=True)], dtype=object)

    host = F.lower(F.regexp_extract(text_of(pages[url]), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(carried(pages, carry), host.alias("host"), text_of(pages[html]).alias("html"))
    votes = (
        rows.select("host", vote("html").alias("path")).where("path IS NOT NULL").groupBy("host", "path").agg(F.count("*").alias("votes"))
    )
    cast = F.sum("votes").over(Window.partitionBy("host"))
    winners = (
        votes.withColumn("cast", cast)
        .where(F.col("votes") * 5 >= F.col("cast"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("n"), "path"))).alias("w"))
        .select("host", F.transform("w", lambda w: w["path"]).alias("winners"))
    )
    # A host may have a third of all pages: its pages are dealt over salts, its few winning
    # paths are repeated for each.
    dealt = winners.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(salts)))
    joined = salted.join(dealt, ["host", "salt"], "left").select("row", extract("html", "winners").alias("text"))
    return handed_back(joined, names, {"text": F.col("text"), "n_chars": F.length("text").cast("long")})
