"""Main text of pages by equivalence-class template deduction.

A page becomes a list of blocks, each with the path of block elements that hold it. Two kinds of tokens are
counted over all pages of a host: paths, and texts at a path. A token's occurrence vector (how often on which page) is
kept as its number of pages, its number of occurrences and an exclusive-or of hashes of (page, count), which are
combined map-side, so a host of any size costs one small row for each token and task. Tokens of one vector that cover
at least SUPPORT of their host's pages form a valid class; the class of the page frame (once on each page) and the
classes whose paths lie below it nest into the template. Texts in valid classes are template text; all other blocks
fill slots. Pages that are copies share their text without being a template: a text counts only if the pages it stands on
differ in their longest block, of which the least and the greatest hash are kept with the vector.

Among the slots' containers, the template takes for each host the deepest path of the frame class that holds most
of the free text that no link and no known side element holds; a page without it falls back on its own largest
container. What the container holds, less side elements and template text, is the main text, also inside article and main
elements; if nothing else is there, the template text stays. Class words and ids help only where a whole word of theirs
is a mark, alone or beside words that say nothing (`ad-box`, `site-footer`; not `side-effects` or `related-work`).

Defined results: null or empty html gives the empty text; html without a tag is one block of text; a null url is a host
of its own, as are urls without a host; repeated rows give equal rows; hosts of one or two pages have no template
text; an empty table gives an empty table; other columns are left alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import map_arrow, stored

SUPPORT, LEAST_PAGES = 0.5, 3
#: Templates that are broadcast at most: one row for each host, a path and hashes of texts.
MAX_BROADCAST_TOKENS = 1_000_000
HELD_TOKENS = 200_000

#: Elements by their part in a page.
BLOCKS = frozenset((
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption article section main header footer nav aside "
    "form fieldset blockquote pre figure figcaption address details summary center hr br dialog menu search hgroup").split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption hgroup".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
SIDE = frozenset("nav aside footer header form menu dialog search fieldset address".split())
#: Elements whose text is no markup and, unclosed, goes on to the end of the page.
RAW = "script|style|title"
#: Elements whose content is dropped: up to their closing tag, or else to the end of the element that holds them.
DROPPED = frozenset("noscript template svg math iframe object canvas select textarea button head foreignobject".split())
#: Of these, those that a block element ends, those that are closed by `/>`, and those that another of their kind ends.
NO_BLOCKS, SELF_CLOSED, NOT_NESTED = frozenset(("svg", "math", "select")), frozenset(("svg", "math", "foreignobject")), frozenset(("button", "select"))
IN_HEAD = frozenset("base basefont bgsound link meta noscript template".split())
PAGE = frozenset("html body main article".split())
MARKS = frozenset((
    "ad ads adv advert advertisement adverts banner promo promotion promoted sponsor sponsored menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar side aside footer header masthead cookie cookies consent notice gdpr alert popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended comment comments reply replies respond disqus widget pagination pager toolbar topbar copyright "
    "legal skip toc").split())

#: Words beside a mark that leave it a mark.
COMPANIONS = frozenset((
    "area bar block body bottom box btn button buttons col column container content group holder icon icons inner item items left link links list "
    "main module outer page panel region right row section site slot text top unit wrap wrapper zone").split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + RAW + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)/?>|([^<]+|<)", re.S | re.I)
MARK = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
CUT = re.compile(r"[^a-z0-9]+")
WHITE = re.compile(r"\s+")
#: An opening element of the key ends open elements of the value, up to the nearest of the last set.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}
SCOPE = frozenset("html body div article section main aside nav header footer form table ul ol dl td th blockquote figure".split())


def _is_side(name: str, attributes: str, inside_article: bool) -> bool:
    if name in SIDE and not (name == "header" and inside_article):
        return True
    if not attributes:
        return False
    for found in MARK.finditer(attributes) if name not in PAGE else ():
        value = next(g for g in found.groups() if g is not None)
        for word in value.split():
            parts = [w for w in CUT.split(re.sub(r"([a-z])([A-Z])", r"\1-\2", word).lower()) if w and not w.isdigit()]
            if not MARKS.isdisjoint(parts) and all(w in MARKS or w in COMPANIONS for w in parts):
                return True
    return bool(HIDDEN.search(attributes))


def blocks(page: str | None) -> list[tuple[str, str, int, bool]]:
    """(path, text, characters in links, inside a side element) of each block of a page, in order."""
    out: list[tuple[str, str, int, bool]] = []
    stack: list[tuple[str, bool, str]] = [("", False, "")]
    text: list[str] = []
    linked = 0
    in_link = False
    dropped = 0  # the place of the outermost dropped element

    def flush() -> None:
        nonlocal linked
        if text:
            joined = WHITE.sub(" ", "".join(text)).strip()
            if joined:
                out.append((stack[-1][2], joined, min(linked, len(joined)), stack[-1][1]))
            text.clear()
        linked = 0

    for found in TOKEN.finditer(page or ""):
        name = found.group(3)
        if name is None:
            plain = found.group(5)
            if plain is not None and stack[-1][0] == "head" and plain.strip():
                del stack[-1]
                dropped = 0
            if plain is not None and not dropped:
                plain = html.unescape(plain)
                text.append(plain)
                linked += len(plain.strip()) * in_link
            continue
        name, closing = name.lower(), bool(found.group(2))
        if not closing and dropped:
            at = 0
            if name == "body" or (stack[-1][0] == "head" and name not in IN_HEAD):
                at = next((i for i in range(dropped, len(stack)) if stack[i][0] == "head"), 0)
            elif name in NOT_NESTED:
                at = next((i for i in range(dropped, len(stack)) if stack[i][0] == name), 0)
            elif name in BLOCKS and name not in VOID:
                at = next((i for i in range(len(stack) - 1, dropped - 1, -1) if stack[i][0] not in NO_BLOCKS), dropped - 1) + 1
            if at and at < len(stack):
                del stack[at:]
                dropped = dropped if dropped < len(stack) else 0
        if name in DROPPED:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0) if closing else 0
            if at:
                del stack[at:]
                dropped = dropped if dropped < len(stack) else 0
            elif not closing and not (name in SELF_CLOSED and (found.group(4) or "").endswith("/")) and (name != "foreignobject" or dropped):
                dropped = dropped or len(stack)
                stack.append((name, *stack[-1][1:]))
            continue
        if dropped:
            # Inside, elements are only counted, up to the end of the one that holds the dropped element.
            if name in BLOCKS and name not in VOID:
                at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0) if closing else 0
                if at > dropped:
                    del stack[at:]
                elif at:
                    flush()
                    del stack[at:]
                    dropped, in_link = 0, False
                elif not closing:
                    stack.append((name, *stack[-1][1:]))
            continue
        if name == "a":
            in_link = not closing
        if name not in BLOCKS:
            continue
        flush()
        if name in VOID:
            continue
        if closing:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if at:
                del stack[at:]
                in_link = False
            continue
        if stack[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6") and (stack[-1][0] == "p" or name not in ("p",)):
            del stack[-1]
        ended = CLOSES.get(name)
        if ended:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ended:
                    del stack[i:]
                    break
                if stack[i][0] in SCOPE:
                    break
        top = stack[-1]
        inside = "/article" in top[2] or "/main" in top[2]
        stack.append((name, top[1] or _is_side(name, found.group(4) or "", inside), f"{top[2]}/{name}"))
    flush()
    return out


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(parts)) - (1 << 63)


def containers(path: str) -> list[str]:
    """The paths at and above `path` that may hold several blocks, the root first."""
    steps = path.split("/")[1:]
    return ["/" + "/".join(steps[:k]) for k in range(1, len(steps) + 1) if steps[k - 1] not in LEAVES] or [""]


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, token (hash), path (null for texts), pages, occurrences, vector, free (characters), least and greatest hash of
    the longest block of its pages, combined per task."""
    held: dict[tuple[str, int], list] = {}

    def out() -> pa.RecordBatch:
        keys, rows = list(held), list(held.values())
        batch = pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array([r[0] for r in rows], pa.string()),
            *[pa.array([r[i] for r in rows], pa.int64()) for i in range(1, 7)]],
            ["host", "token", "path", "pages", "occurrences", "vector", "free", "low", "high"])
        held.clear()
        return batch

    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            seen: dict[int, list] = {}
            longest = (0, 0)  # characters and token
            for path, text, linked, side in blocks(page):
                token = _hash("t", path, text)
                seen.setdefault(token, [None, 0, 0])[1] += 1
                longest = max(longest, (len(text), token))
                free = 0 if side else len(text) - linked
                for at in containers(path):
                    row = seen.setdefault(_hash("p", at), [at, 0, 0])
                    row[1] += at == path
                    row[2] += free
            of_page = _hash(page or "")
            for token, (path, count, free) in seen.items():
                row = held.setdefault((host, token), [path, 0, 0, 0, 0, longest[1], longest[1]])
                row[1] += 1
                row[2] += count
                row[3] ^= hash_pair(of_page, count if path is None else 1)
                row[4] += free
                row[5], row[6] = min(row[5], longest[1]), max(row[6], longest[1])
            if len(held) > HELD_TOKENS:
                yield out()
    if held:
        yield out()


def hash_pair(page: int, count: int) -> int:
    mixed = (page * 0x9E3779B97F4A7C15 + count * 0xBF58476D1CE4E5B9) & ((1 << 64) - 1)
    mixed ^= mixed >> 31
    return ((mixed * 0x94D049BB133111EB) & ((1 << 64) - 1)) - (1 << 63)


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def deduce_templates(pages: DataFrame) -> DataFrame:
    """host, content (path or null), texts (hashes of template texts): one row for each host with a template."""
    based = pages.select(host_of(F.col("url")).alias("host"), "html")
    counted = map_arrow(based, _occurrences, "host string, token bigint, path string, pages bigint, occurrences bigint, vector bigint, free bigint, low bigint, high bigint")
    tokens = counted.groupBy("host", "token").agg(
        F.min("path").alias("path"), F.sum("pages").alias("pages"), F.sum("occurrences").alias("occurrences"),
        F.bit_xor("vector").alias("vector"), F.sum("free").alias("free"), F.min("low").alias("low"), F.max("high").alias("high")).where(
        "path IS NOT NULL OR low < high")
    sizes = based.groupBy("host").agg(F.count("*").alias("host_pages"))
    valid = tokens.where(f"pages >= {LEAST_PAGES}").join(sizes, "host").where(F.col("pages") >= SUPPORT * F.col("host_pages"))
    classes = valid.groupBy("host", "host_pages", "vector", "pages").agg(
        F.collect_list(F.when(F.col("path").isNull(), F.col("token"))).alias("texts"),
        F.collect_list(F.when(F.col("path").isNotNull(), F.struct("free", "path"))).alias("paths"))
    # The frame is the class of paths on the most pages; a class nests below it if its paths do, or its texts stand in it.
    frame = F.transform("paths", lambda p: F.struct(p["free"].alias("free"), F.length(p["path"]).alias("depth"), p["path"].alias("path")))
    most = F.array_max(F.transform(frame, lambda p: p["free"]))
    by_depth = F.array_max(F.transform(F.filter(frame, lambda p: (p["free"] > 0) & (p["free"] >= 0.9 * most)), lambda p: F.struct(p["depth"].alias("depth"), p["path"].alias("path"))))
    return classes.select("host", F.col("texts"), F.struct(F.col("pages"), most.alias("free"), by_depth["path"].alias("content")).alias("choice")).groupBy("host").agg(
        F.max(F.when(F.col("choice.content").isNotNull(), F.col("choice")))["content"].alias("content"), F.array_distinct(F.flatten(F.collect_list("texts"))).alias("texts"))


def main_text(page: str | None, content: str | None, template: frozenset[int]) -> str:
    found = blocks(page)
    if not found:
        return ""
    if content is None or not any(_below(b[0], content) and not b[3] for b in found):
        free: dict[str, int] = {}
        for path, text, linked, side in found:
            for at in containers(path):
                free[at] = free.get(at, 0) + (0 if side else len(text) - linked)
        most = max(free.values(), default=0)
        content = max((p for p, n in free.items() if n >= 0.9 * most and n > 0), key=lambda p: (p.count("/"), p), default="")
    # A headline right above the container belongs to it.
    for path, _, _, side in found:
        above, _, name = path.rpartition("/")
        if name == "h1" and not side and above not in ("", "/html", "/html/body") and content != above and _below(content, above):
            content = above
    kept = [(path, text) for path, text, _, side in found if not side and _below(path, content)]
    own = [(p, t) for p, t in kept if _hash("t", p, t) not in template]
    return "\n".join(text for _, text in own or kept)


def _below(path: str, container: str) -> bool:
    return (path + "/").startswith(container + "/")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text (string) of every page."""
    templates = stored(deduce_templates(pages), "templates")
    size = templates.agg(F.coalesce(F.sum(F.size("texts") + 1), F.lit(0))).first()[0]
    lookup = F.broadcast(templates) if size <= MAX_BROADCAST_TOKENS else templates
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(lookup, "host", "left").select("page_id", "url", "html", "content", "texts")
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                got, last, known = [], None, frozenset()
                for page, content, texts in zip(*[batch.column(c).to_pylist() for c in ("html", "content", "texts")]):
                    if texts != last:
                        last, known = texts, frozenset(texts or ())
                    got.append(main_text(page, content, known))
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(got, pa.string())], ["page_id", "url", "text"])

    return map_arrow(rows, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
