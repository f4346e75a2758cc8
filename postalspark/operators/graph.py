"""Crawl graph: breadth-first reach, frontier, collection progress, collection.

Reach runs in two parts, so that its steps do not follow the graph's depth alone:

* A node with a single other node linking to it can only be reached through that one, so its depth is that node's plus one.
  Those unique predecessors form a forest (chains and trees of a crawl); pointer doubling finds each node's root and
  distance in as many steps as the logarithm of the longest chain.
* What is left are the roots: the start and the nodes with several predecessors. Links between roots carry the length of the way
  through the forest, and the search goes on from the roots whose depth fell in the step before, until none does.

The links between roots are spread evenly over partitions (not hashed by ``src``: a hub page may own a third of all
links) and checkpointed once. Each step's frontier is counted exactly (the count also ends the loop); one of at most
``FRONTIER_BROADCAST_ROWS`` nodes is broadcast, so the links are streamed where they lie with no shuffle; a larger one
is joined by sort-merge with AQE's skew split. Depths found so far are kept as a few stored parts of growing size (a part is
merged into the one before it when that is at most twice as large), so a plan holds as many of them as the logarithm of
the nodes, however many steps there are, and a row is rewritten as often. Lineage is cut with reliable
checkpoints in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalspark.operators.codes import cap_codes
from postalspark.operators.pages import area_links, page_codes
from postalspark.operators.scan import running_total
from postalspark.session import ensure_checkpoint_dir

# Largest frontier (node count, exact) that is broadcast to the edge partitions.
FRONTIER_BROADCAST_ROWS = 100_000


def reach_pages(links: DataFrame, start: str | int = "base", max_depth: int | None = None) -> DataFrame:
    """G1: every node reachable from ``start`` with its breadth-first depth (start = 0)."""
    spark = links.sparkSession
    ensure_checkpoint_dir(spark)
    src, dst = F.col("src"), F.col("dst")
    # a link of a page to itself or back to the start brings no node nearer
    edges = links.select("src", "dst").where((src != dst) & (dst != F.lit(start))).dropDuplicates().checkpoint()
    ways_in = edges.groupBy("dst").agg(F.count(F.lit(1)).alias("n"), F.min("src").alias("up"))
    rooted = unique_ways(ways_in.where("n = 1").select(F.col("dst").alias("node"), "up"))
    best = _root_depths(_root_links(edges, ways_in, rooted), start, max_depth)
    below = rooted.join(_small(best, best.count()), rooted["up"] == best["node"]).select(
        rooted["node"], (best["depth"] + rooted["hops"]).cast("int").alias("depth"))
    found = best.unionByName(below)
    return found if max_depth is None else found.where(F.col("depth") <= F.lit(int(max_depth)))


def unique_ways(pointers: DataFrame) -> DataFrame:
    """``node, up, hops``: the root above each node of a forest of pointers (node, up), and how far it is.

    A step lets each node whose root is not known yet take over what its ``up`` points to, which doubles its reach; rows whose
    root is known rest. Nodes on or below a ring have no root; they are all that is left when a step finds no further root, and go.
    """
    known = pointers.select(F.col("node").alias("up"), F.lit(True).alias("open"))
    ways = pointers.join(known, "up", "left").select("node", "up", F.lit(1).cast("long").alias("hops"),
                                                     F.coalesce("open", F.lit(False)).alias("open")).checkpoint()
    before, now = -1, ways.where("open").count()
    while now not in (0, before):
        above = ways.select(F.col("node").alias("up"), F.col("up").alias("next_up"), F.col("hops").alias("more"),
                            F.col("open").alias("still"))
        moved = ways.where("open").join(above, "up").select("node", F.col("next_up").alias("up"),
                                                            (F.col("hops") + F.col("more")).alias("hops"), F.col("still").alias("open"))
        ways = ways.where("not open").unionByName(moved).checkpoint()
        before, now = now, ways.where("open").count()
    return ways.where("not open").select("node", "up", "hops")


def _root_links(edges: DataFrame, ways_in: DataFrame, rooted: DataFrame) -> DataFrame:
    """``src, dst, hops`` between roots: links into nodes with several predecessors, from the root above their source."""
    n_parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    into = edges.join(ways_in.where("n > 1").select("dst"), "dst", "left_semi")
    above = rooted.select(F.col("node").alias("src"), "up", "hops")
    return (into.join(above, "src", "left")
            .groupBy(F.coalesce("up", "src").alias("src"), "dst").agg((F.min(F.coalesce("hops", F.lit(0))) + 1).alias("hops"))
            .repartition(n_parts).checkpoint())


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its exact row count allows it."""
    return F.broadcast(df) if rows <= FRONTIER_BROADCAST_ROWS else df


def _root_depths(links: DataFrame, start: str | int, max_depth: int | None) -> DataFrame:
    """``node, depth`` of ``start`` and all roots that ``links`` (src, dst, hops) lead to, each with its least depth."""
    frontier = links.sparkSession.range(1).select(F.lit(start).cast(links.schema["src"].dataType).alias("node"), F.lit(0).cast("long").alias("depth"))
    rows, parts = 1, [(frontier, 1)]
    while rows:
        came = (links.join(_small(frontier.withColumnRenamed("node", "src"), rows), "src")
                .groupBy(F.col("dst").alias("node")).agg(F.min(F.col("depth") + F.col("hops")).alias("depth")))
        if max_depth is not None:
            came = came.where(F.col("depth") <= F.lit(int(max_depth)))
        known = _union([p for p, _ in parts]).select(F.col("node").alias("at"), F.col("depth").alias("had"))
        frontier = came.join(known, (F.col("node") == F.col("at")) & (F.col("had") <= F.col("depth")), "left_anti").checkpoint()
        rows = frontier.count()
        if rows:
            parts.append((frontier, rows))
        while len(parts) > 1 and parts[-2][1] <= 2 * parts[-1][1]:
            (older, a), (newer, b) = parts[-2:]
            merged = older.unionByName(newer).groupBy("node").agg(F.min("depth").alias("depth")).checkpoint()
            parts[-2:] = [(merged, a + b)]
    return _union([p for p, _ in parts]).groupBy("node").agg(F.min("depth").cast("int").alias("depth"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def crawl_edges(pages: DataFrame, base_url: str) -> DataFrame:
    """Edges ``src, dst`` (URLs) of crawled pages (page_id, url, html): each page's accepted links."""
    links = area_links(pages, base_url).select("page_id", F.col("url").alias("dst"))
    return links.join(pages.select("page_id", F.col("url").alias("src")), "page_id").select("src", "dst")


def crawl(pages: DataFrame, start_url: str) -> DataFrame:
    """G2 on real pages: (page_id, depth, html) of every page that links lead to from ``start_url``.

    The search runs on numbers given to the pages' URLs: a link to a URL of no page leads nowhere, so it goes before the search.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    # stored once: the numbers must stay as they are
    nodes = (pages.where(F.col("url").isNotNull()).select("url").dropDuplicates()
             .withColumn("node", F.monotonically_increasing_id()).checkpoint())
    start = nodes.where(F.col("url") == F.lit(start_url)).first()
    if start is None:
        return pages.select("page_id", F.lit(0).alias("depth"), "html").limit(0)
    sources = pages.select("page_id", "url").join(nodes, "url").select("page_id", F.col("node").alias("src"))
    edges = (area_links(pages, start_url).join(nodes, "url").select("page_id", F.col("node").alias("dst"))
             .join(sources, "page_id").select("src", "dst"))
    reached = reach_pages(edges, start["node"]).join(nodes, "node").select("url", "depth")
    return pages.join(reached, "url").select("page_id", "depth", "html")


def frontier_links(links: DataFrame, visited: DataFrame) -> DataFrame:
    """Distinct link targets of visited pages that are not visited themselves."""
    seen = visited.select(F.col("node").alias("src"))
    out = links.join(seen, "src", "left_semi").select("dst").dropDuplicates()
    return out.join(visited.select(F.col("node").alias("dst")), "dst", "left_anti")


def collection_progress(codes: DataFrame, pages: DataFrame, max_codes: int) -> DataFrame:
    """New codes per page and the running total in (depth, page_id) order.

    ``codes`` is (page_id, cep); ``pages`` is (page_id, depth). A code is new on
    the first page that has it. Pages are kept while the total before them is
    below ``max_codes`` (the page that reaches the target is the last one).
    """
    first = (codes.join(pages, "page_id")
             .groupBy("cep").agg(F.min(F.struct("depth", "page_id")).alias("f"))
             .groupBy(F.col("f.depth").alias("depth"), F.col("f.page_id").alias("page_id"))
             .agg(F.count(F.lit(1)).alias("new_codes")))
    per_page = (pages.select("page_id", "depth")
                .join(first, ["page_id", "depth"], "left")
                .withColumn("new_codes", F.coalesce("new_codes", F.lit(0)).cast("long")))
    totals = running_total(per_page, "page_id", F.col("new_codes"), "running_total", lead=["depth"])
    return totals.where(F.col("running_total") - F.col("new_codes") < F.lit(int(max_codes)))


def collect_codes(links: DataFrame, pages: DataFrame, max_codes: int, start: str = "base") -> DataFrame:
    """Reach pages, read their codes, stop at the target, keep the smallest ``max_codes``.

    ``pages`` is (page_id, node, html): ``node`` names the page in ``links``.
    """
    reached = reach_pages(links, start)
    visited_pages = pages.join(reached, "node").select("page_id", "depth", "html")
    # the (page, code) pairs feed two branches; materialise them once instead of
    # running the regex stages over every page's HTML twice
    codes = page_codes(visited_pages).checkpoint()
    kept = collection_progress(codes, visited_pages.select("page_id", "depth"), max_codes)
    collected = codes.join(kept.select("page_id"), "page_id", "left_semi")
    return cap_codes(collected, max_codes)
