"""Main text of pages by wrapper induction over pages of one host."""

from __future__ import annotations

import json
import zlib
from collections import OrderedDict
from dataclasses import dataclass

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import map_batches, stored
from churnkit.llm.htmltree import blocks, dump, load, match, parse

# Each layout of a host has so many reference pages. Tasks keep the references of so many layouts parsed; others are parsed again.
REFERENCES, KEPT_LAYOUTS = 2, 64


@dataclass(frozen=True)
class WrapperRules:
    """A block is template if it is the same on this share of the pages aligned with it, of which there are so many with
    titles of their own. In an element that authors marked as the article, more is asked for."""

    min_titles: int = 4
    share: float = 0.8
    min_titles_inside: int = 10
    share_inside: float = 0.95
    # Blocks outside such elements with more of their characters in links are menus.
    link_share: float = 0.5


DEFAULT = WrapperRules()


def _layout(tree: list) -> tuple:
    """The nodes of a tree that are not text, down to four levels, repeats of one kind as one."""
    out, level = [], [tree]
    for _ in range(4):
        below = [c for n in level for c in n[2] if c[0] is not None]
        out.append(tuple(dict.fromkeys(c[0] for c in below)))
        level = below
    return tuple(out)


def aligned(reference: list, tree: list) -> list[tuple[int, int, bool]]:
    """Places of the blocks of a reference and of a page that tree matching aligns, and whether their texts are equal."""
    at = {id(b): i for i, (b, _) in enumerate(blocks(reference))}
    place = {id(b): i for i, (b, _) in enumerate(blocks(tree))}
    return [(at[id(r)], place[id(b)], b[1] == r[1]) for r, b in match(reference, tree)]


def template_blocks(tree: list, references: list[list], constants: list[set[int]]) -> set[int]:
    """The places of the blocks of a page that some reference shows to be template: aligned with a constant block and equal to it."""
    mine = {b[1] for b, _ in blocks(tree)}
    out: set[int] = set()
    for reference, constant in zip(references, constants, strict=True):
        found = blocks(reference)
        # a page without the text of any constant block has none of them
        if any(found[r][0][1] in mine for r in constant):
            out |= {i for r, i, equal in aligned(reference, tree) if equal and r in constant}
    return out


def main_text(tree: list, template: set[int], rules: WrapperRules = DEFAULT) -> str:
    """The blocks of a page that are content, in order. If any text lies in elements marked as the article, no other does."""
    found = blocks(tree)
    marked = any(r for _, r in found)
    return "\n".join(b[1] for i, (b, r) in enumerate(found) if i not in template
                     and (r if marked else b[2] <= rules.link_share * len(b[1])))


def _packed(tree: list) -> bytes:
    return zlib.compress(json.dumps(dump(tree), separators=(",", ":")).encode(), 1)


def _unpacked(raw: bytes) -> list:
    return load(json.loads(zlib.decompress(raw)))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class _References:
    """Parsed references of the layouts met last."""

    def __init__(self) -> None:
        self._kept: OrderedDict[tuple, list[list]] = OrderedDict()

    def of(self, layout: tuple, raw: list[bytes]) -> list[list]:
        if layout not in self._kept:
            self._kept[layout] = [_unpacked(r) for r in raw]
            if len(self._kept) > KEPT_LAYOUTS:
                self._kept.popitem(last=False)
        self._kept.move_to_end(layout)
        return self._kept[layout]


def _numbered(trees: DataFrame) -> DataFrame:
    """``trees`` with a number of each row, a hash of its tree, and one for each reference that orders the trees of a layout."""
    return trees.select("*", F.monotonically_increasing_id().alias("row"), F.xxhash64("tree").alias("digest"),
                        F.array(*[F.xxhash64(F.lit(i), "tree") for i in range(REFERENCES)]).alias("orders"))


def induce(trees: DataFrame, rules: WrapperRules = DEFAULT) -> DataFrame:
    """(host, layout, references, constants) for each layout of a host that has template blocks, over all its pages.

    ``trees`` has host, layout, title, tree, a number of each row and hashes of the tree (``_numbered``). Pages of one title,
    such as copies of an article, count once, through the one whose tree is least by hash; they are chosen by numbers and
    hashes and not stored again; trees move only if Spark finds the tables of numbers or references too large to broadcast.
    Every such page is aligned with each reference of its layout, and how many have a block,
    and have the same, is added up where pages are read; a group's counts are one row for each block and task. A block is
    constant if pages of enough different titles have it, the same on nearly all. What varies is a slot, and what no block
    of a reference is aligned with is one, too; slots hold the content.
    """
    group = ["host", "layout"]
    own = stored(trees.where("host <> ''").groupBy(*group, "title").agg(F.min(F.struct("digest", "row", "orders")).alias("least"))
                 .select(*group, "least.row", "least.orders"), "representatives")
    first = [F.min_by("row", F.col("orders")[i]) for i in range(REFERENCES)]
    # stored, so that Spark knows how small they are before it plans to move trees
    numbers = stored(own.select("row"), "numbers")
    chosen = stored(own.groupBy(*group).agg(F.count(F.lit(1)).alias("titles"), F.array(*first).alias("rows")).where(F.col("titles") >= rules.min_titles)
              .select(F.posexplode("rows").alias("n", "row")), "chosen")
    references = stored(trees.select("row", *group, "tree").join(chosen, "row").groupBy(*group)
                        .agg(F.array_distinct(F.sort_array(F.collect_list(F.struct("n", "tree")))["tree"]).alias("references")), "references")

    def counted(batches):
        known = _References()
        for b in batches:
            counts: dict[tuple, list[int]] = {}
            for h, lay, raw, refs in zip(b["host"], b["layout"], b["tree"], b["references"], strict=True):
                tree = _unpacked(raw)
                for n, reference in enumerate(known.of((h, lay), refs)):
                    for r, _, equal in aligned(reference, tree):
                        c = counts.setdefault((h, lay, n, r), [0, 0])
                        c[0] += 1
                        c[1] += equal
            yield {"host": [k[0] for k in counts], "layout": [k[1] for k in counts], "reference": [k[2] for k in counts],
                   "at": [k[3] for k in counts], "met": [c[0] for c in counts.values()], "same": [c[1] for c in counts.values()]}

    def inside(batches):
        for b in batches:
            marks = [[[r for _, r in blocks(_unpacked(raw))] for raw in refs] for refs in b["references"]]
            yield {"host": b["host"], "layout": b["layout"], "inside": marks}

    counts = (map_batches(
        trees.select(*group, "row", "tree").join(numbers, "row", "left_semi").drop("row").join(references, group), counted, "host string, layout long, reference int, at int, met long, same long")
              .groupBy(*group, "reference", "at").agg(F.sum("met").alias("met"), F.sum("same").alias("same"))
              .where((F.col("met") >= min(rules.min_titles, rules.min_titles_inside))
                     & (F.col("same") >= F.col("met") * min(rules.share, rules.share_inside))))
    marks = map_batches(references, inside, "host string, layout long, inside array<array<boolean>>")
    within = F.col("inside")[F.col("reference")][F.col("at")]
    enough = F.when(within, (F.col("met") >= rules.min_titles_inside) & (F.col("same") >= F.col("met") * rules.share_inside)).otherwise(
        (F.col("met") >= rules.min_titles) & (F.col("same") >= F.col("met") * rules.share))
    constant = counts.join(marks, group).where(enough).groupBy(*group).agg(F.collect_list(F.struct("reference", "at")).alias("constants"))
    return stored(references.join(constant, group), "wrappers")


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", rules: WrapperRules = DEFAULT) -> DataFrame:
    """(key, url, text, n_chars) for every page: its main text, from the whole html, and the length of that in code points.

    Pages are parsed where they are read, and what may be content is stored as compressed trees. Pages of a host with the
    same nodes near the root are a layout, whose wrapper comes from all of them, however many there are (``induce``); it
    does not depend on partitions or their order. Wrappers meet pages in a join that Spark plans by their size and, if it
    shuffles, splits on a hot host; a page is then judged by itself, so no group is held anywhere. A page without a url, or of
    a layout with few titles, has no wrapper; its markup decides. A null or empty html has an empty text. Null and repeated
    keys get a row each; an empty table none.
    """
    kind = pages.schema[key].dataType.simpleString()
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
                        host.alias("host"))

    def parsed(batches):
        for b in batches:
            found = [parse(h) for h in b["html"]]
            yield {n: b[n] for n in ("key", "url", "host")} | {
                "layout": [_hash(repr(_layout(t))) for _, t in found], "title": [_hash(t) for t, _ in found], "tree": [_packed(t) for _, t in found]}

    def settled(batches):
        known = _References()
        for b in batches:
            texts = []
            for h, lay, raw, refs, marks in zip(b["host"], b["layout"], b["tree"], b["references"], b["constants"], strict=True):
                tree, template = _unpacked(raw), set()
                if refs:
                    constants = [{m["at"] for m in marks if m["reference"] == n} for n in range(len(refs))]
                    template = template_blocks(tree, known.of((h, lay), refs), constants)
                texts.append(main_text(tree, template, rules))
            yield {"key": b["key"], "url": b["url"], "text": texts, "n_chars": list(map(len, texts))}

    trees = stored(_numbered(map_batches(rows, parsed, f"key {kind}, url string, host string, layout long, title long, tree binary")), "trees")
    met = trees.drop("title", "row", "digest", "orders").join(induce(trees, rules), ["host", "layout"], "left")
    return map_batches(met, settled, f"key {kind}, url string, text string, n_chars long").withColumnRenamed("key", key)
