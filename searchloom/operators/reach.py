"""Bounded breadth-first reach over a link table.

Links are placed once: bucketed by their source. Visited pages are kept in a table bucketed by URL in the same number
of buckets and divided by level, so a step joins the links with the last level, and the targets with the visited
pages, where they are: only the targets are shuffled. Each level is written, so the plan of a level never contains
the levels before it, and lost executors cost a level at most.

Redirects are closed before the walk, by doubling: a redirect's target is reached at the depth of its source, so every
link to (and seed of) a redirecting page also leads to all that its redirects lead to. The number of rounds grows with the
logarithm of the longest chain; the walk itself has one step per depth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchloom.operators.ordered import first_rows
from searchloom.storage import Placed, written

LINKS_PER_PART = 1_000_000


def redirect_closure(redirects: DataFrame) -> DataFrame:
    """``(src, dst)``: every page that redirects ``(src, dst)`` lead to, over any number of hops; circles end."""
    known = written(redirects.select("src", "dst").where("src <> dst").distinct(), "redirects")
    n = known.count()  # counts come from the Parquet footers
    while n:
        ahead = known.select(F.col("src").alias("dst"), F.col("dst").alias("beyond"))
        longer = known.join(ahead, "dst").select("src", F.col("beyond").alias("dst")).where("src <> dst")
        further = written(known.unionByName(longer).distinct(), "redirects")
        found = further.count()
        known, n = further, 0 if found == n else found
    return known


def _with_redirects(links: DataFrame, closure: DataFrame, page: str) -> DataFrame:
    """``links``, also with ``page`` replaced by all that it redirects to."""
    ahead = closure.select(F.col("src").alias(page), F.col("dst").alias("_target"))
    others = [c for c in links.columns if c != page]
    beyond = links.join(ahead, page).select(*others, F.col("_target").alias(page))
    return links.unionByName(beyond.select(*links.columns))


class Links:
    """A link table ready to walk: its links bucketed by source, those of very large pages apart.

    A page with more than ``links_per_part`` links would be one task's bucket; the links of such pages stay as they were
    written, spread over files of any order, and their sources, at most one per ``links_per_part`` links, are broadcast.
    """

    def __init__(self, edges: DataFrame, links_per_part: int = LINKS_PER_PART):
        edges = written(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct(), "edges")
        large = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > links_per_part).select("src")
        self.large = written(large, "large-pages")
        self.of_large = None
        if not self.large.isEmpty():
            self.of_large = written(edges.join(F.broadcast(self.large), "src", "left_semi"), "large-page-links")
            edges = edges.join(F.broadcast(self.large), "src", "left_anti")
        self.placed = Placed(edges, "src", "links").read()

    def targets(self, frontier: DataFrame) -> DataFrame:
        """``(url)`` of the pages that those of ``frontier(url)`` link to."""
        asking = frontier.select(F.col("url").alias("src"))
        found = self.placed.join(asking, "src").select(F.col("dst").alias("url"))
        if self.of_large is not None:
            wide = asking.join(F.broadcast(self.large), "src", "left_semi")
            found = found.unionByName(self.of_large.join(F.broadcast(wide), "src").select(F.col("dst").alias("url")))
        return found


def new_pages(candidates: DataFrame, visited: DataFrame | None) -> DataFrame:
    """``(url)``: candidates that weren't visited, each once."""
    found = candidates.select("url").where("url IS NOT NULL").distinct()
    return found if visited is None else found.join(visited.select("url"), "url", "left_anti")


def reach(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int | None = None,
    max_pages: int | None = None,
    links_per_part: int = LINKS_PER_PART,
) -> DataFrame:
    """``(url, depth)`` of pages reached from ``seeds(url)``, each at its smallest depth.

    ``edges(src, dst)`` may have a ``weight``: 1 for a link, 0 for a redirect,
    whose target keeps the depth of its source. If given, at most ``max_pages`` pages, by
    ``(depth, url)``, and none deeper than ``max_depth``.
    """
    seeds = seeds.select("url")
    if "weight" in edges.columns:
        edges = written(edges.select("src", "dst", "weight"), "weighed-edges")
        closure = redirect_closure(edges.where("weight = 0"))
        steps, seeds = (
            _with_redirects(x, closure, page) for x, page in ((edges.where("weight = 1").select("src", "dst"), "dst"), (seeds, "url"))
        )
    else:
        steps = edges
    links = Links(steps, links_per_part)

    visited = Placed(new_pages(seeds, None).withColumn("depth", F.lit(0)), "url", "visited", by="depth")
    depth, total = 0, 0
    while True:
        table = visited.read()
        level = table.where(F.col("depth") == depth)
        on_level = level.count()  # from the footers of this level's files
        total += on_level
        if on_level == 0 or depth == max_depth or (max_pages is not None and total >= max_pages):
            break
        found = new_pages(links.targets(level), table)
        depth += 1
        visited.append(found.withColumn("depth", F.lit(depth)))
    pages = visited.files().select("url", "depth")
    if max_pages is None or total <= max_pages:
        return pages
    last = first_rows(pages.where(F.col("depth") == depth), ["url"], max_pages - (total - on_level))
    return pages.where(F.col("depth") < depth).unionByName(last.select("url", "depth"))
