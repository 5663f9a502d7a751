"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each with its root-to-leaf path of block
elements.  Per path, and per every prefix of it, the lengths of text and link
text, the punctuation and the number of blocks are summed.  A path's ratio is
its plain text per block, fused with its punctuation per block and with what
its elements are known for (articles more, page furniture nothing).  The ratios
are smoothed over the tree: an element's ratio is the mean of the paths below it by
their text, and a path is as good as the best element above it, less a little for each level, so that a heading or a paragraph of one word is
judged by the article that it stands in and not by its own length.  Paths whose smoothed ratio
reaches a share of the page's best are content, and so is each of their blocks.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import map_slices, read_table, ship_by_value

ship_by_value(__name__)

#: Share of the page's best smoothed ratio that a path needs.
THRESHOLD = 0.2
#: What is left of an element's ratio one level further down.
LEVEL = 0.9

# ---- fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol
optgroup option p pre search section select summary table tbody td template tfoot th thead tr ul""".split())
#: Content is text up to the end tag, never shown as text of the page.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
#: Elements without main text.
FURNITURE = frozenset("""nav footer aside form noscript template button select option optgroup dialog menu search svg canvas
object audio video legend head""".split())
#: A start tag ends these open elements, looked for up to the barrier elements.
IMPLIED_END = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])), "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Elements that a start tag of a block inside a paragraph doesn't look beyond.
P_BARRIER = frozenset("table td th caption button object template html".split())
#: Words in class names and ids of page furniture.
HINTS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav
navbar navigation breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar cookie cookies consent gdpr notice notices alert
popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations
comment comments disqus respond reply replies copyright toolbar pagination pager widget widgets outbrain taboola""".split())
#: Further such words where no article is open.
PAGE_HINTS = frozenset(["header"])
NEGATED = re.compile(r"(?:has|no|with|without|hide|show)[-_]", re.I)
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog form menu menubar toolbar".split())
# ---- end of fixed values

_TAG = re.compile(r"""<(?:
    !--(?:-?>|.*?(?:--!?>|\Z)) |
    /(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z) |
    (?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z) |
    (?P<open>[a-zA-Z][^\s/>]*+)(?P<rest>[^>]*+)(?:>|\Z) |
    [!?/][^>]*+(?:>|\Z)
)""", re.S | re.X)
_ATTR = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
_PUNCTUATION = re.compile(r"[.,;:!?、。，！？،؟।]")


class Step(NamedTuple):
    """A node of the page's path tree: an element below its parent, all of the same path together."""

    parent: int
    label: str       # element name, with * for an article or main element, ! for page furniture
    depth: int
    article: bool    # it or an element above is an article
    furniture: bool  # it or an element above is page furniture; a form around an article isn't


class Block(NamedTuple):
    """Text of a block, its path, and how much of the text is link text."""

    path: int
    text: str
    linked: int


def _hinted(names: str, inside: bool, whole: bool) -> bool:
    """Whether a class or id attribute names page furniture; ``whole``: only by a full name, not a part of one."""
    for name in names.split():
        parts = [name.lower()] if whole else [] if NEGATED.match(name) else [p.lower() for p in _NAME.findall(name)]
        if not whole:
            parts += [a + b for a, b in zip(parts, parts[1:], strict=False)]    # side-bar, navBar
        if any(p in HINTS or (not inside and p in PAGE_HINTS) for p in parts):
            return True
    return False


def _label(name: str, attrs: str, inside: bool) -> str:
    """An element's step in a path: its name, ``name*`` for an article or main element, ``name!`` for page furniture."""
    values = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTR.findall(attrs)} if attrs.strip() else {}
    role = values.get("role", "").lower()
    article = name in ("article", "main") or role in ("article", "main") or values.get("itemprop", "").lower() == "articlebody"
    furniture = (name in FURNITURE or (name == "header" and not inside) or role in FURNITURE_ROLES
                 or (name not in ("html", "body") and any(
                     _hinted(values.get(k, ""), inside, article) for k in ("class", "id"))))
    return name + ("!" if furniture else "*" if article else "")


def blocks(page: str) -> tuple[list[Step], list[Block]]:
    """The page's path tree and its non-empty blocks in page order.

    Character references are decoded and white space becomes single spaces.
    Open tags without an end, stray end tags and the end of the page
    are taken as browsers take them; comments, scripts, styles and titles are no text.
    """
    steps = [Step(-1, "html", 0, False, False)]
    children: dict[tuple[int, str], int] = {}
    out: list[Block] = []
    stack: list[tuple[str, int]] = [("html", 0)]    # (element, its step or -1 for an inline one)
    path = 0                                        # step of the innermost block element
    count: Counter[str] = Counter(["html"])         # open elements by name
    text: list[str] = []
    links: list[str] = []

    def flush() -> None:
        whole = " ".join("".join(text).split())
        if whole:
            out.append(Block(path, whole, len(" ".join("".join(links).split()))))
        text.clear()
        links.clear()

    def add(raw: str) -> None:
        if raw and not count["!"]:
            piece = html.unescape(raw)
            text.append(piece)
            if count["a"]:
                links.append(piece)

    def child(label: str) -> int:
        up = steps[path]
        if (path, label) not in children:
            article = label.endswith("*")
            # a form around an article isn't furniture
            furniture = label.endswith("!") or (up.furniture and not (article and not _beyond_forms(path)))
            children[path, label] = len(steps)
            steps.append(Step(path, label, up.depth + 1, up.article or article, furniture))
        return children[path, label]

    def _beyond_forms(step: int) -> bool:
        while step >= 0:
            if steps[step].label.endswith("!") and steps[step].label != "form!":
                return True
            step = steps[step].parent
        return False

    def pop_to(depth: int) -> None:
        """Close the elements from ``depth`` on."""
        nonlocal path
        if any(step >= 0 for _, step in stack[depth:]):
            flush()
        for name, step in stack[depth:]:
            count[name.rstrip("!")] -= 1
            count["!"] -= name.endswith("!")
        outer = next((step for _, step in stack[depth:] if step >= 0), None)
        if outer is not None:
            path = steps[outer].parent
        del stack[depth:]

    def end_open(names: frozenset[str], barrier: frozenset[str]) -> None:
        if not any(count[n] for n in names):
            return
        lowest = None
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in names:
                lowest = depth
            elif stack[depth][0] in barrier:
                break
        if lowest is not None:
            pop_to(lowest)

    at, size = 0, len(page)
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            add(page[at:])
            break
        add(page[at:tag])
        m = _TAG.match(page, tag)
        if not m:
            add("<")
            at = tag + 1
            continue
        at = m.end()
        if m["end"]:
            name = m["end"].lower()
            if name == "br":
                add(" ")
            elif name not in ("html", "body") and count[name]:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0].rstrip("!") == name:
                        pop_to(depth)
                        break
                    if name not in BLOCKS and stack[depth][1] >= 0:
                        break    # an inline end tag closes nothing beyond its block
            continue
        name = (m["start"] or m["open"] or "").lower()
        if not name:
            continue
        attrs = m["attrs"] if m["start"] else m["rest"]
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = page.find(">", end.start()) + 1 or size if end else size
        elif name == "br":
            add(" ")
        elif name == "body":
            if not count["body"]:
                pop_to(1)
                path = child(name)
                stack.append((name, path))
                count[name] += 1
        elif name in BLOCKS:
            if name != "option":
                end_open(frozenset(["p"]), P_BARRIER)
            if name in IMPLIED_END:
                end_open(*IMPLIED_END[name])
            flush()
            if name not in VOID and name != "head":
                path = child(_label(name, attrs, steps[path].article))
                stack.append((name, path))
                count[name] += 1
        elif name not in VOID and name != "html" and not attrs.endswith("/"):
            if name == "a":    # links don't nest
                end_open(frozenset(["a"]), BLOCKS)
            # inline furniture, such as an advert in a span, is left out of its block
            hidden = _label(name, attrs, True).endswith("!")
            stack.append((name + "!" * hidden, -1))
            count[name] += 1
            count["!"] += hidden
    flush()
    return steps, out


def path_scores(steps: list[Step], found: list[Block]) -> dict[int, float]:
    """The smoothed ratio of each path that has a block; 0 for page furniture."""
    sums: dict[int, list[int]] = {}
    for b in found:
        if not steps[b.path].furniture:
            s = sums.setdefault(b.path, [0, 0, 0])
            s[0] += len(b.text) - b.linked
            s[1] += len(_PUNCTUATION.findall(b.text))
            s[2] += 1
    ratio = {p: (1 + plain / n) * (1 + marks / n) for p, (plain, marks, n) in sums.items()}
    # an element's ratio: the mean of the paths below it by their plain text
    weight, mass = [0.0] * len(steps), [0.0] * len(steps)
    for step in range(len(steps) - 1, -1, -1):    # parents have smaller numbers
        if step in sums:
            weight[step] += 1 + sums[step][0]
            mass[step] += (1 + sums[step][0]) * ratio[step]
        if steps[step].parent >= 0:
            weight[steps[step].parent] += weight[step]
            mass[steps[step].parent] += mass[step]
    best = [0.0] * len(steps)    # the best ratio of the element and those above it, less a little for each level
    for step, (parent, label, _, _, _) in enumerate(steps):
        own = mass[step] / weight[step] if weight[step] else 0.0
        # the root and the body are above everything and say nothing of what is in them
        best[step] = max(best[parent] * LEVEL if parent >= 0 else 0.0, 0.0 if label in ("html", "body") else own)
    out = {b.path: 0.0 for b in found}
    for path, own in ratio.items():
        root = next((p for p in (path, steps[path].parent) if p >= 0 and steps[p].label in ("html", "body")), None)
        # what stands in the body itself is judged by the body's ratio
        out[path] = max(own, best[path], mass[root] / weight[root] * LEVEL if root is not None else 0.0)
    inside = [p for p in ratio if steps[p].article]
    if inside:
        # fuse with the markup: beside an article the rest is furniture, inside it nothing is
        top = max(out[p] for p in inside)
        for path in ratio:
            out[path] = max(out[path], top) if steps[path].article else min(out[path], top) * THRESHOLD / 2
    return out


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """The text of the content blocks, joined by line feeds; empty if there is none."""
    steps, found = blocks(page or "")
    if not found:
        return ""
    scores = path_scores(steps, found)
    least = threshold * max(scores.values())
    return "\n".join(b.text for b in found if scores[b.path] > 0 and scores[b.path] >= least)


def extract_text(pages: DataFrame, markup: str = "html", threshold: float = THRESHOLD) -> DataFrame:
    """The input's columns without ``markup``, and ``text`` and ``n_chars`` (its code points), per row.

    Null or empty markup, or a page without content: empty text.  Each row is
    worked on alone, whole, in slices bounded by rows and bytes; equal rows
    give equal results, one each.  Null urls and ids are not looked at.  Empty table: empty
    result.  Input columns ``text`` and ``n_chars`` are replaced.
    """
    kept = [f for f in pages.schema.fields if f.name not in (markup, "text", "n_chars")]
    packed = pages.select(F.struct(*[F.col(f"`{f.name}`") for f in kept]).alias("row"),
                          F.col(f"`{markup}`").cast("string").alias("markup"))
    schema = T.StructType([T.StructField("row", T.StructType(kept)), T.StructField("text", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"text": [main_text(p, threshold) for p in frame["markup"]]})

    return (map_slices(packed, run, schema, carry=("row",)).select("row.*", "text")
            .withColumn("n_chars", F.char_length("text").cast("long")))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


_DECODED = "piece"
for _name, _char in (("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;", "''"), ("&amp;?", "&")):
    _DECODED = f"regexp_replace({_DECODED}, '{_name}', '{_char}', 'g')"
#: Holds for pages of the given tables: one article without furniture of its own, five character references.
SQL = rf"""
WITH pieces AS (
  SELECT page_id, url, unnest(regexp_split_to_array(article, '</?(?:article|h1|p)\b[^>]*>')) AS piece,
         generate_subscripts(regexp_split_to_array(article, '</?(?:article|h1|p)\b[^>]*>'), 1) AS i
  FROM (SELECT page_id, url, coalesce(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '') AS article FROM pages)),
clean AS (SELECT page_id, url, i, trim(regexp_replace(regexp_replace({_DECODED.replace('piece', "regexp_replace(regexp_replace(piece, '<br>', ' ', 'g'), '</?b>', '', 'g')")},
            '\s+', ' ', 'g'), '^ | $', '', 'g')) AS block FROM pieces),
texts AS (SELECT page_id, url, coalesce(string_agg(block, chr(10) ORDER BY i) FILTER (block <> ''), '') AS text
          FROM clean GROUP BY page_id, url)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM texts
"""
