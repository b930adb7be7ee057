"""Main text of pages by a maximum-scoring subsequence (operator 10).

A page is a sequence of tokens: words score positive, tags negative, and a linear
scan finds the contiguous region of the highest score. Weights are logarithms of
how much more often a kind of token stands inside the main text than outside,
counted over labelled pages, which are those that mark their main text themselves
(``article``, ``main``, ``articleBody``).

Menus, headers, footers, sidebars, notices, adverts, forms and comments, known by
element, role or class, give no text and weigh nothing; scripts, styles and the like
aren't tokens at all. A class hides by what it names in the end (``left-sidebar``, not
``social-history``). Classes hide neither a page's root, its main element or an article
of its own, nor a part around the marked main text; that is ``main`` and the like, or an
article with as many words as are left without it; nor what has most of a page's words,
unless these are comments.

The region is completed: to the marked main text, if most of its words stand there, and
else to the ends of the innermost element around it, the page's body excepted. So a
short first or last line isn't lost to the tags before it.

Defined results: a NULL or empty page, and one without words, has the empty text;
of regions with one score the first is taken; every row gives one row; an empty
table gives none; without labelled pages all words weigh the same, and all tags;
other columns are not looked at.
"""

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlens.llm.blocks import rows_of

# Kinds of HTML elements.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object xmp select head".split())
ASIDE = frozenset("nav header footer aside form menu dialog button label fieldset".split())
NESTED = frozenset(
    "html body div section article main ul ol dl table thead tbody tfoot tr td th figure details blockquote center".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
# Words of class and id that tell what is not main text.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar footer masthead "
    "comment comments disqus respond replies share sharing social related recommended widget login".split()
)
# Words of class and id after which an element names what it has, and that tell a state.
MODIFIERS = frozenset("has no not with without hide hides show shows use uses enable disable".split())
STATES = frozenset("enabled disabled fixed sticky open opened closed active inactive visible hidden shown on off".split())
# Words at the end of a class or id that tell the place or shape, not what the element is.
SHAPES = frozenset(
    "area bar block body bottom box buttons col column container group holder inner item items left link links list outer "
    "panel post posts primary right row secondary section slot space text title top wrap wrapper".split()
)
COMMENTS = frozenset("comment comments disqus respond replies".split())
REOPENED = frozenset("nav header form fieldset".split())
# Elements that end an open one at their start, and in what they don't.
_BLOCKS = (
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr main menu nav ol p pre section summary table ul"
).split()
_CELLS, _ROWS = frozenset(["td", "th"]), frozenset(["td", "th", "tr"])
_GROUPS = _ROWS | {"thead", "tbody", "tfoot"}
_LISTS = (NESTED | ASIDE) - {"div"}
_IN_P = frozenset("button html table td th".split())
_ENDS = {name: (frozenset(["p"]), _IN_P) for name in _BLOCKS} | {
    "li": (frozenset(["li"]), _LISTS),
    "dt": (frozenset(["dt", "dd"]), _LISTS),
    "dd": (frozenset(["dt", "dd"]), _LISTS),
    **{name: (_CELLS, frozenset(["table"])) for name in _CELLS},
    "tr": (_ROWS, frozenset(["table"])),
    **{name: (_GROUPS, frozenset(["table"])) for name in ("thead", "tbody", "tfoot")},
}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_REST = re.compile(r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>""")
_PLAIN_REST = re.compile(r"[^>]*>?")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}

#: Weight of a tag that labelled pages tell nothing of, as many observations as that is worth, and the least weight.
TAG, PRIOR, LEAST = -1.0, 50, -4.0
WORD, LINK_WORD, OTHER, SKIPPED = "word", "link word", "other tag", "skipped part"
_KNOWN = INLINE | VOID | NESTED | frozenset("p h1 h2 h3 h4 h5 h6 li dd dt pre figcaption hr br address summary caption".split())


def _own_words(value: str) -> set[str]:
    """The words of a class or id that name the element itself, one for each of its names.

    That is the last word, but for words of shape, as long as no modifier or state is told.
    """
    found = set()
    for name in value.split():
        words = re.split(r"[_-]+", name)
        if len(words) > 1 and words[-1] in STATES:
            continue
        for at, word in enumerate(words):
            if word in MODIFIERS:
                words = words[:at]
                break
        while len(words) > 1 and (words[-1] in SHAPES or not words[-1] or words[-1].isdigit()):
            words.pop()
        found.update(words[-1:])
    return found


def _attributes(text: str) -> tuple[frozenset, set]:
    """The words of class and id; roles and properties."""
    words, roles = set(), set()
    for name, a, b, c in _ATTRIBUTE.findall(text):
        value = (a or b or c).lower()
        if name.lower() in ("class", "id"):
            words |= _own_words(value)
        else:
            roles.update(value.split())
    return frozenset(words), roles


def _parts(page: str):
    """(place, name, is it an end, attributes) of a page's tags; runs of text have no name, but the text."""
    place, size = 0, len(page)
    while place < size:
        found = _TOKEN.search(page, place)
        start = found.start() if found else size
        if start > place:
            yield place, None, False, page[place:start]
        if not found:
            return
        place = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        rest = _REST.match(page, place) or _PLAIN_REST.match(page, place)
        attributes, place = page[place : rest.end()], rest.end()
        if not found[1] and name in RAW and not (name == "svg" and attributes.endswith("/>")):
            end = _END[name].search(page, place)
            if not end and name == "head":
                continue
            place = end.start() if end else size
            if end and name != "head":
                rest = _PLAIN_REST.match(page, end.end())
                place = rest.end()
            continue
        yield start, name, bool(found[1]), attributes


def _article_words(page: str) -> dict[int, int]:
    """The number of words in each article of a page, by place."""
    found, words, opened = {}, 0, []
    for place, name, is_end, text in _parts(page):
        if name is None:
            words += len(text.split())
        elif name == "article" and not is_end:
            opened.append((place, words))
        elif name == "article" and opened:
            start, before = opened.pop()
            found[start] = words - before
    return found | {start: words - before for start, before in opened}


def _most_words(page: str) -> frozenset[int]:
    """Places of elements that a class would hide with more than half of a page's words."""
    total, hidden = 0, {}
    for kind, text, *_ in tokens(page, False, frozenset(), hidden):
        total += len(text.split()) if kind in (WORD, LINK_WORD) else 0
    total += sum(hidden.values())
    return frozenset(place for place, words in hidden.items() if 2 * words > total)


def tokens(
    page: str,
    reopens: bool = True,
    shown: frozenset | None = None,
    hidden: dict | None = None,
    parents: dict | None = None,
):
    """(kind, text, starts a block, is inside the marked main text, element) of a page's tokens.

    ``kind`` is a tag's name, with a slash if it closes, or one of the names above;
    text tokens are runs of character data, with ``WORD`` or ``LINK_WORD``. Without
    ``reopens`` no article is looked for in what a class hides. Elements at the places
    ``shown`` aren't hidden for their class; ``hidden`` gets the words of the others.
    The element is the place of the innermost block around the token, the page's root and
    body excepted; ``parents`` gets the one around each.
    """
    # Element, why its content is skipped, is it marked, its place.
    stack: list[tuple[str, str | None, bool, int | None]] = []
    skipped, marked, links = 0, 0, 0
    sizes, visible, hider = None, 0, None

    def pop() -> None:
        nonlocal skipped, marked
        _, why, is_marked, _ = stack.pop()
        skipped -= why is not None
        marked -= is_marked

    def is_main_article(place: int) -> bool:
        nonlocal sizes, visible
        if not reopens:
            return False
        if sizes is None:
            sizes = _article_words(page)
            visible = sum(len(text.split()) for kind, text, *_ in tokens(page, False, shown) if kind == WORD)
        return sizes[place] >= max(1, visible)

    for place, name, is_end, value in _parts(page):
        if name is None:
            if not skipped:
                yield (LINK_WORD if links else WORD), value, False, marked > 0, stack[-1][3] if stack else None
            elif hidden is not None and hider is not None:
                hidden[hider] = hidden.get(hider, 0) + len(value.split())
            continue
        if is_end:
            was_skipped = skipped > 0
            if name == "a":
                links = 0
            if any(entry[0] == name for entry in stack):
                while True:
                    top = stack[-1][0]
                    pop()
                    if top == name:
                        break
            # The end tag of a hidden part belongs to it.
            if not skipped and not was_skipped:
                yield "/" + name, "", name not in INLINE, marked > 0, stack[-1][3] if stack else None
            continue
        ended, within = _ENDS.get(name, ((), ()))
        for depth in range(len(stack) - 1, -1, -1) if ended else ():
            if stack[depth][0] in ended:
                while len(stack) > depth:
                    pop()
            elif stack[depth][0] in within:
                break
        words, roles = _attributes(value) if "=" in value else (frozenset(), set())
        is_named = name == "main" or "articlebody" in roles or "main" in roles
        is_main = is_named or name == "article"
        why = None
        if words & ASIDE_WORDS or ("header" in words and not words & {"article", "post", "entry"}):
            why = "class"
            if name == "article" and (not any(e[0] == name for e in stack) or is_main_article(place)):
                why = None
        if why and shown and place in shown and not words & COMMENTS:
            why = None
        if roles & ROLES:
            why = "class"
        if name in ("html", "body") or is_named:
            why = None
        elif not why and name in ASIDE:
            why = name
        if is_main and not why and skipped:
            # An element around or left open before the main text doesn't hide it.
            reasons = {entry[1] for entry in stack} - {None} - REOPENED
            if not reasons or (reasons == {"class"} and (is_named or is_main_article(place))):
                stack = [(element, None, is_marked, at) for element, _, is_marked, at in stack]
                skipped = 0
        if name not in VOID and (why or name in NESTED):
            if why and not skipped:
                hider = place if why == "class" and not words & COMMENTS else None
                yield SKIPPED, "", True, marked > 0, stack[-1][3] if stack else None
            around = stack[-1][3] if stack else None
            here = around if name in ("html", "body") else place
            if parents is not None and here != around:
                parents[here] = around
            stack.append((name, why, is_main and not why and not skipped, here))
            skipped += why is not None
            marked += stack[-1][2]
            if why:
                continue
        if name == "a" and not skipped:
            links = 1
        if not skipped:
            yield name, "", name not in INLINE, marked > 0, stack[-1][3] if stack else None


def _kind(kind: str) -> str:
    return kind if kind in (WORD, LINK_WORD, SKIPPED) or kind.removeprefix("/") in _KNOWN else OTHER


def _inside_and_outside(batches):
    """A task's counts of token kinds on labelled pages, inside and outside the main text."""
    counts: dict[str, list[int]] = {}
    for (page,) in rows_of(batches):
        found = list(tokens(page or ""))
        if not any(token[3] for token in found):
            continue
        for kind, text, _, inside, _ in found:
            times = len(text.split()) if kind in (WORD, LINK_WORD) else 1
            counts.setdefault(_kind(kind), [0, 0])[not inside] += times
    if counts:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(counts)), pa.array([c[0] for c in counts.values()], pa.int64()),
                pa.array([c[1] for c in counts.values()], pa.int64()),
            ],
            names=["kind", "inside", "outside"],
        )


def learned(pages: DataFrame, content: str = "html") -> dict[str, float]:
    """The weight of each kind of token: words above 0, tags below."""
    rows = (
        pages.select(F.col(content).cast("string"))
        .mapInArrow(_inside_and_outside, "kind string, inside long, outside long")
        .groupBy("kind")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .collect()
    )  # a row for each known kind at most
    counts = {r["kind"]: (r["inside"], r["outside"]) for r in rows}
    inside, outside = (sum(c[k] for c in counts.values()) for k in (0, 1))
    weights = {SKIPPED: 0.0}
    for kind, (i, o) in counts.items():
        ratio = math.log((i + 1) / (inside + 1)) - math.log((o + 1) / (outside + 1))
        # A few pages, or pages that are all alike, don't tell much about a rare tag.
        ratio = TAG + (ratio - TAG) * (i + o) / (i + o + PRIOR) if kind not in (WORD, LINK_WORD) else ratio
        if kind in (WORD, LINK_WORD):
            weights[kind] = max(0.2, min(ratio, 2.0))
        elif kind != SKIPPED:
            weights[kind] = max(LEAST, min(-0.2, ratio))
    return weights


def _score(kind: str, text: str, weights: dict[str, float]) -> float:
    if kind in (WORD, LINK_WORD):
        return weights.get(kind, 1.0) * len(text.split())
    return 0.0 if kind == SKIPPED else weights.get(_kind(kind), TAG)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous part with the greatest sum above 0; the first of equal ones."""
    best = total = 0.0
    begin = first = last = 0
    for place, score in enumerate(scores):
        total += score
        if total <= 0:
            total, begin = 0.0, place + 1
        elif total > best:
            best, first, last = total, begin, place + 1
    return first, last


def _words(found, first: int, last: int, only_marked: bool = False) -> int:
    return sum(
        len(text.split())
        for kind, text, _, inside, _ in found[first:last]
        if kind in (WORD, LINK_WORD) and inside >= only_marked
    )


def _ancestry(element: int | None, parents: dict[int, int | None]) -> list[int]:
    """An element and those around it, outermost first."""
    chain = []
    while element is not None:
        chain.append(element)
        element = parents[element]
    return chain[::-1]


def _completed(found: list[tuple], first: int, last: int, parents: dict[int, int | None]) -> tuple[int, int]:
    """The region to the ends of the marked main text, or of the innermost element around it.

    The element must not be the page's body, and not add more words than the region has, or
    more in links than others.
    """
    words = _words(found, first, last)
    if not words:
        return first, last
    if 2 * _words(found, first, last, True) >= words:
        inside = [place for place in range(first, last) if found[place][3]]
        first, last = inside[0], inside[-1] + 1
        while first and found[first - 1][3]:
            first -= 1
        while last < len(found) and found[last][3]:
            last += 1
        return first, last
    texts = [place for place in range(first, last) if found[place][0] in (WORD, LINK_WORD) and found[place][1].strip()]
    common = _ancestry(found[texts[0]][4], parents)
    for place in texts[1:]:
        chain = _ancestry(found[place][4], parents)
        common = [a for a, b in zip(common, chain) if a == b]
    if not common:
        return first, last
    start, end, element = first, last, common[-1]
    while start and element in _ancestry(found[start - 1][4], parents):
        start -= 1
    while end < len(found) and element in _ancestry(found[end][4], parents):
        end += 1
    added = [found[place] for place in (*range(start, first), *range(last, end))]
    plain = sum(len(text.split()) for kind, text, *_ in added if kind == WORD)
    linked = sum(len(text.split()) for kind, text, *_ in added if kind == LINK_WORD)
    return (start, end) if linked <= plain <= words - linked else (first, last)


def main_text(page: str, weights: dict[str, float]) -> str:
    """The text of the region with the highest score, completed."""
    parents: dict[int, int | None] = {}
    found = list(tokens(page, parents=parents))
    if any(kind == SKIPPED for kind, *_ in found) and not any(token[3] for token in found):
        shown = _most_words(page)
        found = list(tokens(page, True, shown, parents=parents)) if shown else found
    region = best_region([_score(kind, text, weights) for kind, text, *_ in found])
    first, last = _completed(found, *region, parents)
    blocks, parts = [], []
    for kind, text, is_block, *_ in found[first:last]:
        if kind in (WORD, LINK_WORD):
            parts.append(text)
        elif is_block:
            blocks.append("".join(parts))
            parts = []
    blocks.append("".join(parts))
    cleaned = (" ".join(html.unescape(block).split()) for block in blocks)
    return " ".join(block for block in cleaned if block)


def extracted(
    pages: DataFrame, weights: dict[str, float], key: str = "page_id", content: str = "html"
) -> DataFrame:
    """Every row of pages with ``text`` instead of the content and ``n_chars``, its code points."""
    columns = [c for c in pages.columns if c not in (content, "text", "n_chars")]
    rows = pages.select(*columns, F.col(content).cast("string").alias("text"))
    at = len(columns)

    def extract(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [main_text(page or "", weights) for page in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*columns, "text", "n_chars"],
                )

    schema = rows.select(*columns, "text", F.lit(0).cast("long").alias("n_chars")).schema
    return rows.mapInArrow(extract, schema)
