"""Main text of web pages: nearest-URL page differencing, checked against the pages' own landmarks.

A page becomes lines, one per block, each with a sort: chrome (inside a menu, footer, form, advert and the like), content
(inside an article landmark, or main if inside a main one) or open (neither). Pages of a host are ordered by URL path, and each is paired with the
neighbour whose path shares the longest prefix. The two pages' lines are aligned by longest common subsequence; open lines
that both share are template text and are deleted, all other open lines stay. Chrome goes in any case. Content lines stay even if
shared, as copies of an article and quoted lines are content. Only a page that is compared with none and has a main landmark
loses all its open lines, as nothing else tells which of them are template text.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches
from tidemark.session import cut_lineage

CHROME, OPEN, CONTENT, MAIN = 0, 1, 2, 3

# HTML's element names by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
HIDDEN = frozenset("head nav footer aside form template noscript iframe svg math object select button dialog menu canvas".split())
LANDMARK = frozenset("article main".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th"
    " thead tr ul caption".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_ITSELF = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Words that mark an element as no main text, where a class or id is made of nothing but them and PLACES.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice notices nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside widget widgets related recommended"
    " comment comments disqus reply replies footer masthead toolbar share sharing social newsletter subscribe subscription signup"
    " login popup modal overlay pagination pager skip paywall alert hidden respond responses discussion adbox adslot adunit".split()
)
#: And those that do so outside an article, where they are no part of its title.
OUTER_MARKS = frozenset("header topbar copyright legal".split())
#: Words that say nothing about an element but where it stands or what part it is.
PLACES = frozenset(
    "site page main post entry article top bottom left right primary secondary global mobile desktop box bar block section area"
    " container wrapper wrap inner outer list item items link links button buttons icon icons title form text".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:\"[^\"<]*\"|'[^'<]*'|[^>\"'])*+(?:[^>]*))>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([A-Za-z_:][-A-Za-z0-9_:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
MAIN_ROLE = re.compile(r"\brole\s*=\s*[\"']?main\b", re.IGNORECASE)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
SPACES = re.compile(r"\s+")


def _hidden(attributes: list[tuple[str, ...]]) -> bool:
    """Whether the element's attributes hide it, or give it a role of no main text."""
    for key, a, b, c in attributes:
        key, value = key.lower(), a or b or c
        if key == "role" and value.lower() in ROLES or key == "aria-hidden" and value.lower() == "true" or key == "hidden":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
    return False


def _marked(attributes: list[tuple[str, ...]], outside: bool) -> bool:
    """Whether a whole class or id says that the element is no main text; ``outside`` of an article more of them do."""
    for key, a, b, c in attributes:
        if key.lower() in ("class", "id"):
            for token in (a or b or c).split():
                words = {w.lower() for w in WORDS.findall(token)}
                told = words & MARKS or outside and words & OUTER_MARKS
                if told and all(w in MARKS or w in PLACES or w.isdigit() or outside and w in OUTER_MARKS for w in words):
                    return True
    return False


def lines(page: str) -> list[tuple[str, int]]:
    """The page's blocks in order, white space made single spaces, and their sorts; scripts, styles and comments left out.

    Classes and ids never hide a main landmark or an article that is in no other. A wrapper that they mark hides what is in
    it, unless all main landmarks of the page (all articles, if it has none) are in such wrappers: those around them are
    then layout.
    """
    out: list[tuple[str, int, tuple[int, ...]]] = []
    marked: tuple[int, ...] = ()  # open wrappers that class or id mark, by number
    wrappers, tops = 0, {CONTENT: [], MAIN: []}  # and those around each outermost landmark
    parts: list[tuple[str, int, tuple[int, ...]]] = []  # of the open block, each as it stood where it came
    # Open elements: name, whether they hide, their sort if they are landmarks, whether they are marked.
    stack: list[tuple[str, bool, int, bool]] = []
    hides = landmarks = mains = 0
    heading = in_header = 0

    def add(text: str) -> None:
        sort = CHROME if hides else MAIN if mains else CONTENT if landmarks else OPEN
        if sort >= CONTENT and in_header and not heading:
            sort = CHROME
        parts.append((text, sort, marked))

    def flush() -> None:
        alike: dict[tuple[int, tuple[int, ...]], list[str]] = {}
        for text, *state in parts:
            alike.setdefault(tuple(state), []).append(text)
        parts.clear()
        for state, texts in alike.items():
            text = SPACES.sub(" ", entities.unescape("".join(texts))).strip()
            if text:
                out.append((text, *state))

    def pop_to(at: int) -> None:
        nonlocal hides, landmarks, mains, marked, heading, in_header
        for name, hidden, landmark, mark in stack[at:]:
            hides -= hidden
            marked = marked[: len(marked) - mark]
            landmarks -= landmark > 0
            mains -= landmark == MAIN
            heading -= name in HEADING
            in_header -= name == "header"
        del stack[at:]

    at = 0
    while True:
        match = TOKEN.search(page, at)
        text = page[at : match.start() if match else len(page)]
        if text:
            if stack and stack[-1][0] == "head" and not text.isspace():
                pop_to(len(stack) - 1)
            add(text)
        if not match:
            break
        at = match.end()
        name = match["name"]
        if name is None:
            continue
        name = name.lower()
        block = name in BLOCK
        if stack and not match["close"] and name not in IN_HEAD:
            # The head's end tag may be left out: it ends at the body, or at the first element that it cannot hold.
            if name == "body":
                pop_to(next((k for k, e in enumerate(stack) if e[0] == "head"), len(stack)))
            elif stack[-1][0] == "head":
                pop_to(len(stack) - 1)
        if block:
            flush()
        elif name == "br":
            add(" ")
        if match["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop_to(k)
                    break
            continue
        rest = match["rest"]
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in VOID or rest.endswith("/") and not block:
            continue
        if block:
            # A paragraph ends where another block begins; items and cells end at the next of their kind.
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    pop_to(k)
                    break
                if stack[k][0] in BLOCK:
                    break
            ended = ENDS_ITSELF.get(name, "").split()
            if ended and stack and stack[-1][0] in ended:
                pop_to(len(stack) - 1)
        hidden = name in HIDDEN or name == "header" and not landmarks
        root = name in ("body", "html")
        attributes = ATTRIBUTE.findall(rest) if "=" in rest or "hidden" in rest.lower() else []
        hidden = hidden or not root and _hidden(attributes)
        is_main = name == "main" or bool(attributes) and bool(MAIN_ROLE.search(rest))
        bound = root or is_main or name == "article" and all(e[0] != "article" for e in stack)
        mark = not (hidden or bound) and _marked(attributes, not landmarks)
        if not (block or hidden or mark or any(e[0] == name for e in stack)):
            continue  # inline elements need no place on the stack, unless their end could be taken for that of a hidden one
        landmark = 0 if hidden or mark else MAIN if is_main else CONTENT if name in LANDMARK else 0
        if landmark and not hides and not (mains if landmark == MAIN else landmarks):
            tops[landmark].append(marked)
        stack.append((name, hidden, landmark, mark))
        if mark:
            wrappers += 1
            marked = (*marked, wrappers)
        hides += hidden
        landmarks += landmark > 0
        mains += landmark == MAIN
        heading += name in HEADING
        in_header += name == "header"
    flush()
    around = tops[MAIN] or tops[CONTENT]
    layout = set().union(*around) if all(around) else set()
    return [(text, sort if layout.issuperset(within) else CHROME) for text, sort, within in out]


def hash_text(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _scores(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each beginning of ``b``, by rows of bits."""
    at: dict[int, int] = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & at.get(x, 0)
        row = (row + hit | row - hit) & full
    raw = np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), dtype=np.uint8)
    zeros = 1 - np.unpackbits(raw, bitorder="little")[: len(b)].astype(np.int64)
    return np.concatenate(([0], np.cumsum(zeros)))


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of one longest common subsequence with ``b``; halving ``a`` keeps memory linear."""
    found: list[int] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        lo, hi, start, end = work.pop()
        while lo < hi and start < end and a[lo] == b[start]:
            found.append(lo)
            lo, start = lo + 1, start + 1
        while lo < hi and start < end and a[hi - 1] == b[end - 1]:
            found.append(hi - 1)
            hi, end = hi - 1, end - 1
        if lo == hi or start == end:
            continue
        if hi - lo == 1:
            if a[lo] in b[start:end]:
                found.append(lo)
            continue
        middle = (lo + hi) // 2
        ahead = _scores(a[lo:middle], b[start:end])
        behind = _scores(a[middle:hi][::-1], b[start:end][::-1])[::-1]
        cut = start + int(np.argmax(ahead + behind))
        work += [(lo, middle, start, cut), (middle, hi, cut, end)]
    return sorted(found)


def main_text(page: str, neighbour: list[int] | None) -> tuple[str, int]:
    """The main text, and how many of the page's lines the neighbour shares."""
    every = lines(page)
    shared = set(common_lines([hash_text(t) for t, _ in every], neighbour)) if neighbour else set()
    opens = neighbour is not None or all(sort != MAIN for _, sort in every)
    kept = [t for i, (t, sort) in enumerate(every) if sort >= CONTENT or sort == OPEN and opens and i not in shared]
    return "\n".join(kept), len(shared)


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        hashed = [[hash_text(t) for t, _ in lines(p)] for p in batch["html"]]
        yield pd.DataFrame({"near": batch["near"], "lines": hashed})


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        made = [
            main_text(p, None if n is None else list(n)) for p, n in zip(batch["html"], batch["lines"], strict=True)
        ]
        yield pd.DataFrame(
            {
                "page_id": batch["page_id"].array,
                "url": batch["url"].array,
                "text": [t for t, _ in made],
                "n_chars": [len(t) for t, _ in made],
                "n_shared": [n for _, n in made],
            }
        )


def _place(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL as columns; a text without a host is all path."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.when(rest != text, F.regexp_extract(rest, r"^[^/?#]*", 0)).otherwise(F.lit("")))
    path = F.when(rest != text, F.regexp_replace(rest, r"^[^/?#]*", "")).otherwise(rest)
    return host, F.regexp_replace(path, r"[?#].*$", "")


def nearest_pages(pages: DataFrame) -> DataFrame:
    """``key, near``: the neighbour by URL path of each page of ``key, host, path``; pages without one are left out.

    The order over all hosts is made by range partitioning, so that a large host is spread. Neighbours within a partition
    come from a window over it, those across partitions from the partitions' first and last pages.
    """
    order = ["host", "path", "key"]
    ranged = pages.dropDuplicates(["key"]).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(ranged.withColumn("part", F.spark_partition_id()))
    page = F.struct(*order)
    edges = placed.groupBy("part").agg(F.min(page).alias("low"), F.max(page).alias("high"))
    parts = Window.orderBy("part")  # one row per partition
    edges = edges.select("part", F.lag("high").over(parts).alias("from_before"), F.lead("low").over(parts).alias("from_after"))
    within = Window.partitionBy("part").orderBy(*order)
    seen = placed.withColumn("before", F.lag(page).over(within)).withColumn("after", F.lead(page).over(within))
    seen = seen.join(edges, "part", "left")
    seen = seen.withColumn("before", F.coalesce("before", "from_before")).withColumn("after", F.coalesce("after", "from_after"))

    @F.pandas_udf("int")
    def shared_length(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([len(commonprefix([x, y])) for x, y in zip(a, b, strict=True)], dtype="int32")

    def length(side: str) -> Column:
        same = F.col(f"{side}.host") == F.col("host")
        return F.when(same, shared_length(F.col("path"), F.coalesce(F.col(f"{side}.path"), F.lit("")))).otherwise(-1)

    seen = seen.withColumn("left", F.coalesce(length("before"), F.lit(-1)))
    seen = seen.withColumn("right", F.coalesce(length("after"), F.lit(-1)))
    near = F.when(F.greatest("left", "right") >= 0, F.when(F.col("left") >= F.col("right"), F.col("before.key")).otherwise(F.col("after.key")))
    return seen.select("key", near.alias("near")).where(F.col("near").isNotNull())


def extract_pages(pages: DataFrame) -> DataFrame:
    """Main text of every page.

    Takes ``page_id, url, html``; other columns are ignored. Returns ``page_id, url, text, n_chars, n_shared``, one row per
    row; ``n_shared`` counts the lines that the neighbour has too. A NULL html is empty and gives an empty text; a page
    without a URL has the empty host. Rows equal in id, URL and html are one page to the pairing and get equal texts. A page
    alone on its host is compared with none. An empty table gives no rows.
    """
    small_batches(pages.sparkSession)
    host, path = _place(F.col("url"))
    base = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )
    base = base.withColumn("key", F.concat_ws(":", F.hex(F.xxhash64("page_id", "url", "html")), F.hex(F.xxhash64("html", F.lit(1)))))
    pairs = cut_lineage(nearest_pages(base.select("key", host.alias("host"), path.alias("path"))))
    wanted = pairs.select("near").distinct()
    named = base.select(F.col("key").alias("near"), "html")
    hashed = named.mapInPandas(_hashes, "near string, lines array<long>").dropDuplicates(["near"])
    told = pairs.join(hashed.join(wanted, "near"), "near").select("key", "lines")
    joined = base.join(told, "key", "left").select("page_id", "url", "html", "lines")
    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInPandas(_texts, f"page_id {kind}, url string, text string, n_chars long, n_shared long")
