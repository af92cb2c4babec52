"""HTML extraction by template deduction with equivalence classes.

A page is a sequence of tokens: its start tags, told apart by their path of tag and class names, and its text
runs, told apart by path and content.  Tokens of a host that occur equally often on each of its pages share an
occurrence vector and form an equivalence class.  The vector is carried as (pages, occurrences, sums of the halves of
two hashes of page and count), which adds up in any order, so a host with a third of all pages is aggregated like any other.
A class is valid if it has at least ``CLASS_SIZE`` tokens and covers at least ``SUPPORT`` percent of the host's
pages, and a token joins the template only if the block around it is in the template too: valid classes nest.  What
remains between template tokens are slots.  A slot's role comes from the template around it and from how its text behaves over the host's pages:

* slots inside menus, headers, footers, sidebars and forms (by tag or role) and inside scripts, styles and the head
  are dropped; a class or id that names such a part is only a hint: on a page where no running text is left without
  the elements so named, the outermost of them are wrappers and their names do not count;
* if the template and the page have an article (or main) element, the slots inside it are the main text and no others are;
* otherwise runs that are themselves template tokens (the same text on the same pages as the markup) and slots that
  are mostly links are dropped and the others are the main text.  A page on which nothing else remains, such as a
  copy of the others, keeps its runs.

Paths that are not in the template take the role of the closest slot around them.  Hosts with fewer than
``LEAST_PAGES`` pages cannot show a template of their own and are deduced together.

Defined results: a null or empty page has an empty text; a null or malformed url counts as the host ""; repeated
rows are returned one by one; unclosed elements end where HTML lets them end, at the latest with the page.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField

from lumentab.llm.words import tidy, with_columns
from lumentab.operators.ship import ship_if_short
from lumentab.session import cut_lineage

#: Pages from which a host has a template of its own, and percent of its pages that a valid class covers.
LEAST_PAGES, SUPPORT = 4, 60
#: Tokens of a valid class, at least.
CLASS_SIZE = 3
#: Share of linked characters from which a slot without an article counts as navigation.
LINKED = 0.5

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style textarea title noscript template iframe"
#: Raw as well, but these may close themselves.
FOREIGN = "svg math"
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - {"head", "html", "body"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("html body article main section div table ul ol dl td th nav aside header footer form blockquote".split())
DROPPED = frozenset("script style textarea title noscript template iframe svg math head nav header footer aside form button select menu dialog".split())
MAIN = frozenset(["article", "main"])
# Words that name parts outside the article, and the words that a name may add before and after them.
PARTS = ("ads? advert advertisement advertisements banner sponsor sponsored promo nav navbar navigation menu breadcrumbs? header masthead footer sidebar "
         "side-bar cookies? consent notices? popup modal newsletter subscribe share sharing social related comments? disqus widgets? pagination pager")
BEFORE = "site page main top left right bottom global primary secondary mobile post article entry user reader google cookie js"
AFTER = ("box bar list links? buttons? icons? section block widget container wrapper wrap area top bottom left right posts? articles? "
         "form inner content items? thread policy notice banner message primary secondary main menu nav")
# A name counts as a whole: "share-buttons" names a part, "market-share" and "related-work" do not.
BOILER = re.compile(
    rf"(?:(?:{BEFORE.replace(' ', '|')})[-_]+)*(?:{PARTS.replace(' ', '|')})(?:[-_]+(?:{AFTER.replace(' ', '|')}|{PARTS.replace(' ', '|')}|\d*))*", re.I)
ROLE = re.compile(r"navigation|banner|contentinfo|complementary|search|form|dialog|alert", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + RAW.replace(" ", "|") + r")\b(?P<rawattr>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<foreign>" + FOREIGN.replace(" ", "|") + r")\b(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+(?<!/)>.*?(?:</(?P=foreign)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attr>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@lru_cache(maxsize=50_000)
def _label(name: str, attr: str) -> str:
    """The tag with its class, id and role: what tells its tokens apart.  Digits in them do not."""
    parts = {k.lower(): (a or b or c) for k, a, b, c in ATTRIBUTE.findall(attr)} if "=" in attr else {}
    marks = "".join(f"{sign}{re.sub(r'[/>|]|\d+', '', ' '.join(parts[k].split()))}" for k, sign in (("class", "."), ("id", "#"), ("role", "@")) if parts.get(k))
    return name + marks


@lru_cache(maxsize=50_000)
def _outside(label: str) -> bool:
    """Whether the element's tag or role says that it is not part of the article."""
    if _name(label) in DROPPED:
        return True
    return "@" in label and bool(ROLE.search(label.rpartition("@")[2]))


@lru_cache(maxsize=50_000)
def _named(label: str) -> bool:
    """Whether a class or id names a part outside the article: a hint that gives way to what the page holds."""
    name = _name(label)
    if name in ("html", "body", "article", "main"):
        return False
    return any(BOILER.fullmatch(x) for x in re.split(r"[.#\s]+", label[len(name):].split("@")[0]) if x)


# Elements that hold running text.
RUNNING = frozenset("p pre blockquote li dd td".split())


def _without_parts(blocks: list[tuple[tuple[str, ...], str]]) -> list[tuple[tuple[str, ...], str]]:
    """The blocks that no name puts outside the article.

    If these are under a fifth of the text and hold no running text, the outermost names are those of wrappers, and
    only names within them count.
    """
    rest = [b for b in blocks if not any(map(_outside, b[0]))]
    skip = 0
    while True:
        kept = [b for b in rest if not any(map(_named, b[0][_after(b[0], skip):]))]
        if len(kept) == len(rest) or not any(map(_named, (x for p, _ in rest for x in p[_after(p, skip):]))):
            return kept
        some = 5 * sum(len(t) for _, t in kept) >= sum(len(t) for _, t in rest)
        if kept and (some or any(_name(x) in RUNNING for p, _ in kept for x in p)):
            return kept
        skip += 1


def _after(path: tuple[str, ...], skip: int) -> int:
    """The place behind the first ``skip`` named elements of a path."""
    for k, label in enumerate(path):
        if skip == 0:
            return k
        skip -= _named(label)
    return len(path)


def _name(label: str) -> str:
    return re.split(r"[.#@]", label, maxsplit=1)[0]


def page_events(page: str) -> Iterator[tuple[str, tuple[str, ...], str]]:
    """("tag" or "text", path of labels, text) in page order.

    A block's start or end also shows as ("tag", path, "") or ("end", path, ""); inline tags only shape the path.
    """
    stack: list[str] = []
    at = 0

    def close(names: frozenset[str] | set[str]) -> bool:
        """End the closest open element of these names, unless another scope is between."""
        for k in range(len(stack) - 1, -1, -1):
            if _name(stack[k]) in names:
                del stack[k:]
                return True
            if _name(stack[k]) in SCOPE:
                return False
        return False

    for m in TOKEN.finditer(page):
        if m.start() > at:
            yield "text", tuple(stack), page[at:m.start()]
        at = m.end()
        if m["raw"] or m["foreign"] or not m["name"]:
            continue
        name = m["name"].lower()
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if _name(stack[k]) == name:
                    del stack[k:]
                    break
            if name in BLOCK:
                yield "end", tuple(stack), ""
            continue
        if name in ENDS_P:
            close({"p"})
        if name in CLOSES:
            close(CLOSES[name])
        label = _label(name, m["attr"])
        if name == "br":
            yield "text", tuple(stack), " "
        elif name in VOID:
            if name in BLOCK:
                yield "end", tuple(stack), ""
        elif not m["attr"].endswith("/"):
            stack.append(label)
            if name in BLOCK:
                yield "tag", tuple(stack), ""
        elif name in BLOCK:
            yield "end", tuple(stack), ""
    if at < len(page):
        yield "text", tuple(stack), page[at:]


def _slot(path: tuple[str, ...]) -> tuple[str, ...]:
    """The path down to its last block: inline elements do not make slots."""
    for k in range(len(path), 0, -1):
        if _name(path[k - 1]) in BLOCK:
            return path[:k]
    return ()


def page_blocks(page: str) -> Iterator[tuple[tuple[str, ...], str, int]]:
    """(slot path, text, linked characters) of the blocks in page order, white space and references resolved."""
    held: list[str] = []
    where: tuple[str, ...] = ()
    linked = 0
    for kind, path, text in page_events(page):
        slot = _slot(path)
        if kind == "text" and slot == where:
            held.append(text)
            linked += len(text) if any(_name(x) == "a" for x in path) else 0
            continue
        if held and (own := " ".join(entities.unescape("".join(held)).split())):
            yield where, own, linked
        held, where, linked = [], slot, 0
        if kind == "text":
            held.append(text)
            linked = len(text) if any(_name(x) == "a" for x in path) else 0
    if held and (own := " ".join(entities.unescape("".join(held)).split())):
        yield where, own, linked


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


# Between tokens of a path, and after the path of a text token.
STEP, RUN = ">", "|"


def page_tokens(page: str) -> dict[str, tuple[int, int, int]]:
    """Token -> (occurrences, characters, linked characters)."""
    tags: Counter[str] = Counter()
    for kind, path, _ in page_events(page):
        if kind == "tag":
            tags[STEP.join(path)] += 1
    out = {k: (n, 0, 0) for k, n in tags.items()}
    for path, text, linked in page_blocks(page):
        slot = STEP.join(path)
        n, size, links = out.get(slot, (0, 0, 0))
        out[slot] = (n, size + len(text), links + linked)
        # A run's content is its checksum: only whether it repeats matters.
        run = f"{slot}{RUN}{hash_text(text)}"
        n, size, _ = out.get(run, (0, 0, 0))
        out[run] = (n + 1, size + len(text), 0)
    return out


def hash_text(text: str) -> str:
    import hashlib

    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


#: Sums of hash halves: repeated rows add up in them, and 2 billion rows do not overflow.
VECTOR = ("v1", "v2", "v3", "v4")


def _halves(h: Column) -> list[Column]:
    return [h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright(h, 32)]


TOKENS = "host string, page long, token string, n long, chars long, linked long"


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, pages, occurrences, checksums, chars, linked) per host and token of rows (host, page, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for host, page, markup in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += [(host, page, k, *v) for k, v in page_tokens(markup or "").items()]
            columns = zip(*out, strict=True) if out else [[]] * 6
            types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=["host", "page", "token", "n", "chars", "linked"])

    return pages.mapInArrow(tidy(run), TOKENS).groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"),
        *[F.sum(v).alias(n) for n, v in zip(VECTOR, _halves(F.xxhash64("page", "n")) + _halves(F.xxhash64("n", "page", F.lit(1))), strict=True)])


def template_of(tokens: list[dict]) -> str:
    """The template of a host: lines "slot path TAB two digits" and "path|run TAB 0" (template text).

    The digits are 1 for main text and 0 for other text: on pages with an article, and on pages without one.

    Tokens with equal (pages, n, sums of ``VECTOR``) are one class; a class of ``CLASS_SIZE`` tokens or more is valid; tokens
    of valid classes nest along their paths.
    """
    classes: dict[tuple, list[dict]] = {}
    for t in tokens:
        classes.setdefault((t["pages"], t["n"], *(t[v] for v in VECTOR)), []).append(t)
    valid = [t for own in classes.values() if len(own) >= CLASS_SIZE for t in own]
    slots: set[tuple[str, ...]] = set()
    for path in sorted((tuple(t["token"].split(STEP)) for t in valid if RUN not in t["token"]), key=len):
        if not _slot(path[:-1]) or _slot(path[:-1]) in slots:
            slots.add(path)
    # A path on every page has a role of its own, however often it occurs there: lists differ in length.
    shared = {tuple(t["token"].split(STEP)): t for t in tokens if RUN not in t["token"]}
    everywhere = max((t["pages"] for t in tokens), default=0)
    known = slots | {p for p, t in shared.items() if t["chars"] and t["pages"] == everywhere}
    fixed = [t for t in valid if RUN in t["token"] and tuple(t["token"].partition(RUN)[0].split(STEP)) in known]
    # What a slot holds beyond these counts as the slot's.
    chars, linked = Counter(), Counter()
    for path, t in shared.items():
        if slot := _around(path, known):
            chars[slot] += t["chars"]
            linked[slot] += t["linked"]
    has_main = any(_name(x) in MAIN for path in slots for x in path)
    lines = []
    for path in sorted(known):
        # Names are left to each page, which knows whether anything remains without them.
        own = not any(_outside(x) for x in path)
        plain = own and (chars[path] == 0 or linked[path] < LINKED * chars[path])
        main = own and any(_name(x) in MAIN for x in path) if has_main else plain
        lines.append(f"{STEP.join(path)}\t{int(main)}{int(plain)}")
    return "\n".join(lines + [f"{t['token']}\t0" for t in fixed])


def _around(path: tuple[str, ...], slots: set[tuple[str, ...]] | dict[tuple[str, ...], bool]) -> tuple[str, ...]:
    """The closest template slot around a path."""
    return next((path[:k] for k in range(len(path), 0, -1) if path[:k] in slots), ())


def templates(pages: DataFrame) -> DataFrame:
    """(host, roles) of every host with pages enough, and of the host "" for all others; rows (host, page, html)."""
    size = pages.groupBy("host").agg(F.count(F.lit(1)).alias("all_pages"))
    tokens = occurrences(pages).join(size, "host")
    shared = F.when(F.col("all_pages") < LEAST_PAGES, F.lit("")).otherwise(F.col("host"))
    # Small hosts add up to one, and so do the vectors of a token.
    joined = tokens.groupBy(shared.alias("host"), "token").agg(
        F.sum("pages").alias("pages"), F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"),
        *[F.sum(v).alias(v) for v in VECTOR])
    total = size.groupBy(shared.alias("host")).agg(F.sum("all_pages").alias("all_pages"))
    valid = joined.join(total, "host").where(F.col("pages") * 100 >= F.col("all_pages") * SUPPORT)
    per_host = valid.groupBy("host", "all_pages").agg(
        F.collect_list(F.struct("token", "pages", "n", *VECTOR, "chars", "linked")).alias("tokens"))

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([template_of(r) for r in batch.column(batch.schema.names.index("tokens")).to_pylist()], pa.string())]

    return with_columns(per_host, run, [StructField("roles", StringType(), False)]).select(
        "host", "roles", F.col("all_pages").alias("host_pages"))


Roles = dict[tuple[str, ...], bool]


@lru_cache(maxsize=1000)
def _roles(lines: str) -> tuple[Roles, Roles, frozenset[str], bool]:
    """The role of each slot on pages with and without an article, the text tokens of the template, and whether it has an article."""
    parts = [x.rpartition("\t") for x in lines.split("\n") if x]
    slots = [(tuple(t.split(STEP)), roles) for t, _, roles in parts if RUN not in t]
    return ({t: r[0] == "1" for t, r in slots}, {t: r[1] == "1" for t, r in slots}, frozenset(t for t, _, _ in parts if RUN in t),
            any(_name(x) in MAIN for t, _ in slots for x in t))


def main_text(page: str, template: str) -> str:
    """The text of the page's main slots: roles come from the template, and beyond it from the elements' names."""
    inside, plain, fixed, has_main = _roles(template)
    blocks = _without_parts([(path, text) for path, text, _ in page_blocks(page)])
    by_main = has_main and any(_name(x) in MAIN for path, _ in blocks for x in path)
    slots = inside if by_main else plain
    out = []
    for path, text in blocks:
        around = _around(path, slots)
        # Outside all of the template, text stays unless the page has an article.
        if slots.get(around, not by_main) or any(_name(x) in MAIN for x in path[len(around):]):
            out.append((path, text))
    if not by_main and fixed:
        out = [(p, t) for p, t in out if f"{STEP.join(p)}{RUN}{hash_text(t)}" not in fixed] or out
    return "\n\n".join(text for _, text in out)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(markup).alias("html")).withColumn("host", host_of(F.col("url")))
    known = cut_lineage(templates(rows.select("host", F.xxhash64("page_id", "url", "html").alias("page"), "html")))
    own = known.where("host <> ''").select("host", "roles")
    pooled = known.where("host = ''").select("roles").first()
    rest = pooled["roles"] if pooled else ""
    placed = rows.join(ship_if_short(own), "host", "left").select("page_id", "url", "html", F.coalesce("roles", F.lit(rest)).alias("roles"))

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = [main_text(h or "", r) for h, r in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    out = with_columns(placed, run, [StructField("text", StringType(), False), StructField("n_chars", LongType(), False)])
    return out.select(F.col("page_id").alias(key), F.col("url").alias(url), "text", "n_chars")
