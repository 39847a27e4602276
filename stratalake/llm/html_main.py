"""Main text of web pages: structure first, then the suffixes that a host repeats.

A page is cut into blocks (headings, paragraphs, list items, table rows and the like). Blocks within
elements that never hold main text (menus, headers, footers, sidebars, forms, scripts, adverts, notices,
reader comments, by tag or by class) are dropped. The text of a page are its blocks within ``article`` or ``main``;
a page without such an element is *open*: its text are all its blocks.

Then the token streams of all pages of a host are compared: every suffix within a block is named by its first
``RUN`` tokens, by prefix doubling. Names are 64-bit hashes of the tokens and the host, so those of different tasks
agree, and a shuffle by name brings the equal suffixes of a host together, however many pages it has. A run that
stands in ``PAGES`` different pages of the host is boilerplate; the tokens covered by such runs are removed, and the
runs between them are kept. Copies of an article are no boilerplate: within ``article`` and ``main`` only pages count
of whose text at most half of the different runs stand on another page, too. So a notice goes from all articles, also from
copied ones, when it is the smaller part of ``PAGES`` pages; an article that is repeated as a whole stays.

Few runs stand on two pages, and names of all runs take more space than the pages. So the first shuffle holds only anchors:
of the ``ANCHOR``-token suffixes that begin and end within a run the one with the least name. Equal runs have equal anchors, so
only runs whose anchor stands on another page, too, are named and counted by the second shuffle. Only pages with such an
anchor, and then those with boilerplate, are shuffled themselves, and the shuffles of a step go when it ends.

Pages are parsed where they are read, a row at a time. No host and no run is held in one task, and a page receives the
names of its own anchors and runs only.

A null page is the empty page: text "", 0 characters. A null or unreadable URL is a host of its own.
Repeated rows stay; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm import store
from stratalake.llm import text as tx
from stratalake.llm.url_filter import host
from stratalake.tuning import shuffles_removed

#: A run of so many tokens in so many different pages is boilerplate.
RUN, PAGES = 8, 3
#: Tokens of the suffixes of which a run's anchor is one, and bits of its name that are shuffled: too few only let more runs be counted.
ANCHOR, ANCHOR_BITS = 4, 40
#: Rows (a long) that are broadcast.
BROADCAST_ROWS = 2_000_000
#: Hashes of words that a worker remembers.
REMEMBERED = 200_000
#: Bytes of html after which a task gives out the pages it has worked on.
CHUNK = 1 << 20

_PART = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<[A-Za-z/!][^<>]*\Z|[^<]+|<", re.S)
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "title", "xmp", "noscript")}
_CLASS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ASIDE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|sponsor\w*|promo\w*|banner\w*|cookies?|consent|gdpr|notices?|alert|sidebars?|side|menus?|nav\w*|breadcrumbs?|"
    r"footers?|headers?|masthead|comments?|replies|reactions|disqus|share|sharing|social|related|recommended|newsletter|subscribe|subscription|"
    r"popup|modal|overlay|login|signup|search|form|pagination|pager|tags|widget\w*|contentinfo|complementary|navigation)(?:$|[\s_-])",
    re.I,
)
DROPPED = frozenset("nav header footer aside form script style head title noscript template iframe svg button select textarea dialog menu object video audio canvas map datalist".split())
MAIN = frozenset(("article", "main"))
BLOCK = frozenset(
    "p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table thead tbody tfoot tr caption blockquote pre section article main figure figcaption address "
    "hr body html nav header footer aside form fieldset details summary center".split()
)
VOID = frozenset("br hr img input meta link area base col embed source track wbr param".split())
#: A new block of these ends an open paragraph or item.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@dataclass
class Block:
    text: str
    main: bool


def blocks_of(page: str) -> list[Block]:
    """Blocks of a page in order that are not dropped by structure."""
    out: list[Block] = []
    inside: list[tuple[str, bool, bool]] = []  # tag, dropped from here on, main from here on
    pieces: list[str] = []
    at = 0

    def state() -> tuple[bool, bool]:
        return (inside[-1][1], inside[-1][2]) if inside else (False, False)

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                out.append(Block(text, state()[1]))

    while m := _PART.match(page, at):
        at = m.end()
        tag = m.group(2)
        if tag is None:
            token = m.group(0)
            if not state()[0] and (token == "<" or token[0] != "<"):
                pieces.append(token)
            continue
        tag = tag.lower()
        if m.group(1):
            depth = next((i for i in range(len(inside) - 1, -1, -1) if inside[i][0] == tag), None)
            if tag in BLOCK:
                flush()
            elif tag in ("td", "th"):
                pieces.append(" ")
            if depth is not None:
                if tag not in BLOCK and any(inside[i][0] in BLOCK for i in range(depth + 1, len(inside))) and tag not in DROPPED:
                    continue  # a closing tag of a phrase does not close blocks within it
                if state() != ((inside[depth - 1][1], inside[depth - 1][2]) if depth else (False, False)):
                    flush()
                del inside[depth:]
            continue
        if tag in BLOCK:
            flush()
            if "p" in (open_ := [t for t, _, _ in inside]) and tag not in ("html", "body"):
                last = len(open_) - 1 - open_[::-1].index("p")
                if not any(t in BLOCK for t in open_[last + 1 :]):
                    del inside[last:]
        if tag in _CLOSES and inside:
            for i in range(len(inside) - 1, -1, -1):
                if inside[i][0] in _CLOSES[tag]:
                    del inside[i:]
                    break
                if inside[i][0] in BLOCK:
                    break
        if tag == "br" or tag in ("td", "th"):
            pieces.append(" ")
        if tag in VOID:
            continue
        if tag in MAIN:
            while inside and inside[-1][1] and inside[-1][0] in ("div", "p", "span", "section"):
                inside.pop()  # an element of this kind was left open
        dropped, main = state()
        names = [a or b or c for a, b, c in _CLASS.findall(m.group(3))] if m.group(3) else []
        if tag == "article":  # a part of a name, as in "related-topic", says nothing about an article
            named = any(_ASIDE.fullmatch(x) for n in names for x in n.split())
        else:
            named = any(map(_ASIDE.search, names))
        away = tag in DROPPED and not (tag == "header" and main) or named and tag not in ("html", "body", "main")
        if away and not dropped:
            flush()
        if tag in _RAW_END:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if not m.group(3).endswith("/"):
            inside.append((tag, dropped or away, main or (tag in MAIN and not dropped and not away)))
    flush()
    return out


def repeated_tokens(token: np.ndarray, block: np.ndarray, page: np.ndarray, run: int = RUN, pages: int = PAGES) -> np.ndarray:
    """Whether each token lies in a run of ``run`` tokens of one block that stands in ``pages`` different pages.

    ``rank`` holds the order of the suffixes by their first ``width`` tokens; each round doubles the width.
    """
    n = len(token)
    covered = np.zeros(n, bool)
    if n < run:
        return covered
    _, rank = np.unique(token, return_inverse=True)
    width = 1
    while width < run:
        far = min(width, run - width)
        second = np.full(n, -1, np.int64)
        second[: n - far] = rank[far:]
        _, rank = np.unique(rank.astype(np.int64) * (n + 1) + second + 1, return_inverse=True)
        width += far
    start = np.arange(n - run + 1)
    start = start[block[start] == block[start + run - 1]]
    order = np.lexsort((page[start], rank[start]))
    start = start[order]
    r, p = rank[start], page[start]
    new_rank = np.concatenate([[True], r[1:] != r[:-1]]) if len(r) else np.empty(0, bool)
    new_page = new_rank | np.concatenate([[True], p[1:] != p[:-1]]) if len(r) else new_rank
    group = np.cumsum(new_rank) - 1
    distinct = np.bincount(group, new_page, group[-1] + 1 if len(group) else 0)
    mark = np.zeros(n + 1, np.int64)
    hit = start[distinct[group] >= pages] if len(group) else start
    np.add.at(mark, hit, 1)
    np.add.at(mark, hit + run, -1)
    return np.cumsum(mark[:-1]) > 0


@dataclass
class Suffixes:
    """The suffixes of the blocks of some pages, named by their first tokens; places count the tokens of all blocks."""

    page: np.ndarray  # of each token
    block: np.ndarray
    token: np.ndarray  # hash of each token and the host

    @classmethod
    def of_pages(cls, hosts: pa.Array, texts: pa.ListArray) -> Suffixes:
        """``texts`` are the blocks of each page."""
        blocks = texts.flatten()
        words = pc.split_pattern(blocks, " ")
        lengths = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        page = np.repeat(np.arange(len(texts)), texts.value_lengths().to_numpy(zero_copy_only=False))
        coded = words.flatten().dictionary_encode()
        number = np.array([_hash(x) for x in coded.dictionary.to_pylist()], np.uint64)
        seed = np.array([_hash(x) for x in hosts.to_pylist()], np.uint64)
        page = np.repeat(page, lengths)
        token = tx.mix(number[coded.indices.to_numpy()] ^ seed[page]) if len(page) else np.empty(0, np.uint64)
        return cls(page, np.repeat(np.arange(len(blocks)), lengths), token)

    @classmethod
    def of(cls, blocks: list[Block], seed: str) -> Suffixes:
        return cls.of_pages(pa.array([seed]), pa.array([[b.text for b in blocks]], pa.list_(pa.string())))

    def starts(self, run: int) -> np.ndarray:
        """Places where ``run`` tokens of one block begin."""
        return np.flatnonzero(self.block[: max(len(self.block) - run + 1, 0)] == self.block[run - 1 :])

    def names(self, run: int) -> np.ndarray:
        """Names by ``run`` tokens of the suffixes at all places, over block borders, too.

        ``name`` stands for the suffixes by their first ``width`` tokens; each round doubles the width.
        """
        name, width = self.token, 1
        while width < run and len(name):
            far = min(width, run - width)
            name = tx.mix(name[:-far] * np.uint64(0x9FB21C651E98DF25) + name[far:])
            width += far
        return name

    def anchors(self, run: int = RUN, size: int = ANCHOR) -> np.ndarray:
        """The anchor of the run at each of its `starts`: the least name by ``size`` tokens within the run."""
        start = self.starts(run)
        if not len(start):
            return np.empty(0, np.uint64)
        return np.lib.stride_tricks.sliding_window_view(self.names(size), run - size + 1).min(axis=1)[start] >> np.uint64(64 - ANCHOR_BITS)


def run_names(blocks: list[Block], seed: str, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """(start, name) of every run of ``run`` tokens within a block; ``start`` counts the tokens of all blocks."""
    suffixes = Suffixes.of(blocks, seed)
    start = suffixes.starts(run)
    return start, suffixes.names(run)[start] if len(start) else np.empty(0, np.uint64)


_hashes: dict[str, int] = store.remembered({})


def _hash(text: str) -> int:
    if (known := _hashes.get(text)) is None:
        if len(_hashes) >= REMEMBERED:
            _hashes.clear()
        known = _hashes[text] = int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    return known


def own_blocks(blocks: list[Block]) -> list[Block]:
    """The text of a page by structure: its main blocks, or, of an open page, all."""
    return blocks if _is_open(blocks) else [b for b in blocks if b.main]


def is_copy(repeated: int, runs: int) -> bool:
    """Whether a page of ``runs`` different runs, ``repeated`` of which stand on another page, too, is a copy of others."""
    return 2 * repeated > runs


def _joined(blocks: list[Block], covered: np.ndarray) -> str:
    """Text of the blocks without the covered tokens."""
    out, at = [], 0
    for b in blocks:
        words = b.text.split(" ")
        left = ~covered[at : at + len(words)]
        at += len(words)
        if left.any():
            out.append(b.text if left.all() else " ".join(w for w, keep in zip(words, left) if keep))
    return "\n".join(out)


def _without(blocks: list[Block], seed: str, boilerplate: np.ndarray) -> str:
    """Text of a page without the runs that are named in ``boilerplate`` (signed)."""
    own = own_blocks(blocks)
    covered = np.zeros(sum(len(b.text.split(" ")) for b in own), bool)
    if len(boilerplate):
        start, name = run_names(own, seed)
        for at in start[np.isin(tx.signed(name), boilerplate)].tolist():
            covered[at : at + RUN] = True
    return _joined(own, covered)


def _is_open(blocks: list[Block]) -> bool:
    return not any(b.main for b in blocks)


def main_texts(parsed: list[list[Block]], context: list[list[Block]]) -> list[str]:
    """Main text of every parsed page of a host that is held whole; ``context`` pages are only compared with."""
    pages = [*context, *parsed]
    sizes = [[len(b.text.split(" ")) for b in blocks] for blocks in pages]
    numbers: dict[str, int] = {}
    token = np.array([numbers.setdefault(x, len(numbers)) for blocks in pages for b in blocks for x in b.text.split(" ")], np.int64)
    flat = [n for page in sizes for n in page]
    block = np.repeat(np.arange(len(flat)), flat)
    page = np.repeat(np.arange(len(pages)), [sum(x) for x in sizes])
    covered = np.split(repeated_tokens(token, block, page), np.cumsum([sum(x) for x in sizes])[:-1])
    runs = [set(tx.signed(run_names(blocks, "")[1]).tolist()) for blocks in pages]
    own = [set(tx.signed(run_names(own_blocks(blocks), "")[1]).tolist()) for blocks in pages]
    stands = Counter(x for some in runs for x in some)
    votes = Counter(x for some, mine in zip(runs, own) if not is_copy(sum(stands[x] > 1 for x in mine), len(mine)) for x in some)
    boilerplate = np.array([x for x, n in votes.items() if n >= PAGES], np.int64)
    return [_joined(blocks, covered[i]) if _is_open(blocks) else _without(blocks, "", boilerplate) for i, blocks in enumerate(pages)][len(context) :]


def firsts(page: np.ndarray, name: np.ndarray, last: np.ndarray | None = None) -> np.ndarray:
    """The place of each name of each page, once; of equal ones one that is not ``last``."""
    order = np.lexsort((name, page) if last is None else (last, name, page))
    page, name = page[order], name[order]
    new = np.ones(len(order), bool)
    new[1:] = (page[1:] != page[:-1]) | (name[1:] != name[:-1])
    return order[new]


def counted(rows: DataFrame) -> DataFrame:
    """Rows (name, row, ...), each page's names once, of the names of more than one page, with the number of pages."""
    return rows.withColumn("pages", F.count("*").over(Window.partitionBy("name"))).where("pages > 1")


def rows_of(lists: DataFrame) -> DataFrame:
    """(__row): the rows that have a list, marked for broadcast while they are few."""
    return store.broadcast_below(lists.select("__row"), BROADCAST_ROWS)


def having(pages: DataFrame, lists: DataFrame) -> DataFrame:
    """The pages that have a list, with it; the others are put aside before pages are shuffled."""
    return pages.join(rows_of(lists), "__row", "left_semi").join(lists, "__row").select(*pages.columns, "__names")


def boilerplate(runs: DataFrame) -> DataFrame:
    """(row, name) of the runs to be removed from each page. ``runs``: name, row, own, open, runs, pages.

    An open page gives up what stands in ``PAGES`` pages; an article what stands in ``PAGES`` pages that are not copies.
    """
    copies = runs.where("own").groupBy("row").agg(F.count("*").alias("n"), F.max("runs").alias("runs")).where(is_copy(F.col("n"), F.col("runs"))).select("row")
    common = runs.join(copies, "row", "left_anti").groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") >= PAGES).select("name")
    of_open = runs.where(F.col("open") & (F.col("pages") >= PAGES)).select("row", "name")
    return of_open.unionByName(runs.where("own AND NOT open").join(common, "name", "left_semi").select("row", "name"))


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), chunk: int = CHUNK) -> DataFrame:
    """``keep`` columns with text and n_chars of every page."""
    schema = pages.select(*keep).schema.add("text", "string").add("n_chars", "long")
    made = "__row long, __open boolean, __blocks array<string>, __main array<boolean>"
    n = len(keep)

    def in_chunks(batch: pa.RecordBatch, bytes_of: pa.Array) -> Iterator[pa.RecordBatch]:
        sizes = np.cumsum(np.nan_to_num(bytes_of.to_numpy(zero_copy_only=False).astype(float))) // chunk
        cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
        yield from (batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:]) if b > a)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for whole in batches:
            for batch in in_chunks(whole, pc.binary_length(whole.column(n + 1))):
                parsed = [blocks_of(x.as_py() or "") for x in batch.column(n + 1)]
                columns = [
                    pa.array(range(row, row + len(parsed)), pa.int64()), pa.array([_is_open(p) for p in parsed], pa.bool_()),
                    pa.array([[b.text for b in p] for p in parsed], pa.list_(pa.string())), pa.array([[b.main for b in p] for p in parsed], pa.list_(pa.bool_())),
                ]
                row += len(parsed)
                yield pa.RecordBatch.from_arrays([*batch.columns[: n + 1], *columns], [*keep, "__host", "__row", "__open", "__blocks", "__main"])

    def blocks_in(texts: pa.ListScalar, main: pa.ListScalar) -> list[Block]:
        return [Block(t, m) for t, m in zip(texts.as_py(), main.as_py())]

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            suffixes = Suffixes.of_pages(batch.column(0), batch.column(3))
            page, name = suffixes.page[suffixes.starts(RUN)], suffixes.anchors()
            first = firsts(page, name)
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(name[first])), pa.array(batch.column(1).to_numpy()[page[first]])], ["name", "row"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, open_ = batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            suffixes = Suffixes.of_pages(batch.column(0), batch.column(3))
            start = suffixes.starts(RUN)
            page, name = suffixes.page[start], suffixes.names(RUN)[start] if len(start) else suffixes.token
            own = batch.column(4).flatten().to_numpy(zero_copy_only=False).astype(bool)[suffixes.block[start]] | open_[page]
            # an anchor that is shared is so on all pages of its host
            shared = tx.contains(np.unique(batch.column(5).flatten().to_numpy()), tx.signed(suffixes.anchors()))
            first = firsts(page, name, ~own)
            page, name, own, shared = (x[first] for x in (page, name, own, shared))
            different = np.bincount(page[own], minlength=len(row))
            page, name, own = (x[shared] for x in (page, name, own))
            columns = [tx.signed(name), row[page], own, open_[page], different[page]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["name", "row", "own", "open", "runs"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for host_, parts, main, names in zip(*batch.columns[n:]):
                texts.append(_without(blocks_in(parts, main), host_.as_py(), np.asarray(names.values) if names.is_valid else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    name = F.coalesce(host(F.col("url")), F.lit(""))
    source = pages.select(*keep, name.alias("__host"), F.col("html").alias("__html"))
    shape = T.StructType([*source.schema.fields[: n + 1], *T.StructType.fromDDL(made).fields])
    parsed = store.keep(source.mapInArrow(store.tidy(parse), shape), "pages", "zstd")
    listed = lambda rows: rows.groupBy(F.col("row").alias("__row")).agg(F.collect_list("name").alias("__names"))
    told = parsed.select("__host", "__row", "__open", "__blocks", "__main")
    with shuffles_removed(pages.sparkSession):
        shared = store.keep(listed(counted(told.mapInArrow(store.tidy(anchors), "name long, row long"))), "anchors", "zstd")
        asked = having(told, shared).mapInArrow(store.tidy(runs), "name long, row long, own boolean, open boolean, runs long")
        repeated = store.keep(counted(asked), "runs", "zstd")
        gone = store.keep(listed(boilerplate(repeated)), "boilerplate", "zstd")
    rest = parsed.join(rows_of(gone), "__row", "left_anti").withColumn("__names", F.lit(None).cast("array<long>"))
    columns = (*keep, "__host", "__blocks", "__main", "__names")
    return having(parsed, gone).select(*columns).unionByName(rest.select(*columns)).mapInArrow(store.tidy(finish), schema)
