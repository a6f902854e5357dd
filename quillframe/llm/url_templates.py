"""URL filter: explicit rules first, then a per-host tree of path templates.

Paths become templates: numbers and hashes by their shape, and, from the root
down, the rare segments of a node with many children by a wildcard. Templates of a
host that differ in one segment are merged where their labelled shares do not
differ significantly. A template is blocked if its smoothed share of blocked
labels is high enough; the shares of small templates are drawn to their host's,
and those of small hosts to that of all urls. Labels are the verdicts of the rules.

Everything is aggregated per (host, shaped path) with map-side combining before
the tree is built, so a host with a third of all pages is a few rows by then.

A null url, or one without ``://``, has an empty host and path. Hosts have A-Z lower-cased.
Repeated rows are counted each and judged alike; long and deep urls are used whole. Empty
tables give empty tables, and input columns named like the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import lower_ascii, renamed


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class TreeSettings:
    max_children: int = 20
    min_share: float = 0.02
    smoothing: float = 5.0
    z: float = 1.96
    block_from: float = 0.7


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*", 0)
    return lower_ascii(host), F.when(at > 0, path).otherwise(F.lit(""))


def rule_column(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; equally long ones go by the longer host, then by name."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def shape(path: Column) -> Column:
    """Numbers become <d>, hashes and the like <x>; the rest stays."""
    for pattern, name in ((r"(?<![0-9A-Za-z])[0-9a-fA-F-]*(?:[0-9][a-fA-F]|[a-fA-F][0-9])[0-9a-fA-F-]{6,}(?![0-9A-Za-z])", "<x>"), (r"[0-9]+", "<d>")):
        path = F.regexp_replace(path, pattern, name)
    return path


def _chain(start: Column, segments: Column) -> Column:
    """Digests of all beginnings of a segment array, the empty one first; each is made from the one before."""
    return F.aggregate(segments, F.array(start), lambda made, s: F.concat(made, F.array(F.md5(F.concat(F.element_at(made, -1), s).cast("binary")))))


def _generalised(rows: DataFrame, settings: TreeSettings) -> DataFrame:
    """Add ``template`` (array): rare segments below a node with many children are wildcards.

    A node is known by the digest of the template that leads to it. Up to its first
    rare segment a path's template is the path itself, so one aggregation over all
    beginnings of all paths settles every path as far as that segment; the paths
    with one go on below their wildcard. Rounds follow the greatest number of
    wildcards in a template, not its length.
    """
    segments = F.filter(F.split("shaped", "/", -1), lambda s: s != "")
    none = F.array().cast("array<string>")
    rows = rows.withColumns({"_id": F.monotonically_increasing_id(), "todo": segments, "template": none, "_from": F.md5(F.lit("").cast("binary"))})
    rows, settled = stored(rows, "templates"), []
    columns = [c for c in rows.columns if c not in ("_id", "todo", "_from")]
    while True:
        nodes = rows.withColumn("nodes", _chain(F.col("_from"), F.col("todo")))
        steps = nodes.select("_id", "host", "n", F.posexplode(F.arrays_zip(F.slice("nodes", 1, F.size("todo")).alias("node"), F.col("todo").alias("seg"))).alias("pos", "at"))
        steps = steps.select("_id", "host", "n", "pos", "at.node", "at.seg")
        child = steps.groupBy("host", "node", "seg").agg(F.sum("n").alias("c"))
        wide = child.groupBy("host", "node").agg(F.count("*").alias("children"), F.sum("c").alias("total")).where(F.col("children") > settings.max_children)
        rare = child.join(wide, ["host", "node"]).where(F.col("c") < settings.min_share * F.col("total")).select("host", "node", "seg")
        first = steps.join(rare, ["host", "node", "seg"], "left_semi").groupBy("_id").agg(F.min("pos").alias("pos"))
        grown = nodes.join(first, "_id", "left")
        there = F.col("pos").isNotNull()
        grown = grown.withColumns(
            {
                "template": F.concat("template", F.when(there, F.concat(F.slice("todo", F.lit(1), F.col("pos")), F.array(F.lit("*")))).otherwise(F.col("todo"))),
                "todo": F.when(there, F.slice("todo", F.col("pos") + 2, F.lit(1 << 20))).otherwise(none),
                # A wildcard is no segment that a url could hold, so it has a digest of its own.
                "_from": F.when(there, F.md5(F.concat(F.get("nodes", "pos"), F.lit("\n*")).cast("binary"))).otherwise(F.col("_from")),
            }
        )
        rows = stored(grown.drop("nodes", "pos"), "templates")
        settled.append(rows.where(F.size("todo") == 0).select(*columns))
        rows = rows.where(F.size("todo") > 0)
        if rows.isEmpty():
            break
    return reduce(DataFrame.unionAll, settled)


def _forks(rows: DataFrame) -> list[int]:
    """Places at which templates of a host differ and are alike before and behind.

    Merging joins names at one place only, of templates that all stay, so it makes no new such place.
    """
    start = F.md5(F.lit("").cast("binary"))
    before, behind = _chain(start, F.col("template")), F.reverse(_chain(start, F.reverse("template")))
    size = F.size("template")
    each = F.arrays_zip(F.slice(before, F.lit(1), size).alias("before"), F.slice(behind, F.lit(2), size).alias("behind"), F.col("template").alias("seg"))
    steps = rows.select("host", F.posexplode(each).alias("at", "step"))
    forks = steps.groupBy("host", "at", "step.before", "step.behind").agg(F.min("step.seg").alias("low"), F.max("step.seg").alias("high")).where("low <> high")
    return sorted(r["at"] for r in forks.select("at").distinct().collect())


def _merged(leaves: DataFrame, settings: TreeSettings, prior: float) -> DataFrame:
    """Merge templates that differ in one segment and not in their labelled share; adds ``merged``.

    Segments of a group are sorted by share and chained while neighbours do not
    differ at ``z``; a node has at most ``max_children`` + 1 / ``min_share`` + 1 of them.
    Only places where templates fork are visited, so chains cost nothing.
    """
    rows = leaves.withColumn("merged", F.col("template"))
    s = settings.smoothing
    share = (F.col("b") + s * prior) / (F.col("l") + s)
    for at in _forks(leaves):
        long = F.size("merged") > at
        rest = F.concat(F.slice("merged", 1, at), F.array(F.lit("\u0000")), F.slice("merged", at + 2, 1 << 20))
        rows = rows.withColumns({"rest": F.when(long, rest), "seg": F.when(long, F.get("merged", F.lit(at)))})
        sums = rows.where("rest IS NOT NULL").groupBy("host", "rest", "seg").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
        order = Window.partitionBy("host", "rest").orderBy("p", "seg")
        sums = sums.withColumn("p", share).withColumns({"p0": F.lag("p").over(order), "l0": F.lag("l").over(order)})
        spread = F.sqrt(F.col("p") * (1 - F.col("p")) / (F.col("l") + s) + F.col("p0") * (1 - F.col("p0")) / (F.col("l0") + s))
        sums = sums.withColumn("breaks", F.when(F.col("p") - F.coalesce("p0", "p") > settings.z * spread, 1).otherwise(0))
        sums = sums.withColumn("g", F.sum("breaks").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        names = sums.groupBy("host", "rest", "g").agg(F.concat_ws("|", F.sort_array(F.collect_list("seg"))).alias("name"))
        named = sums.join(names, ["host", "rest", "g"]).select("host", "rest", "seg", "name")
        rows = rows.join(named, ["host", "rest", "seg"], "left")
        there = F.concat(F.slice("merged", 1, at), F.array("name"), F.slice("merged", at + 2, 1 << 20))
        rows = rows.withColumn("merged", F.when(F.col("name").isNotNull(), there).otherwise(F.col("merged"))).drop("rest", "seg", "name")
        rows = stored(rows, "templates")  # each place reads the one before twice
    return rows


def filter_urls(df: DataFrame, rules: list[Rule], url: str = "url", settings: TreeSettings = TreeSettings()) -> DataFrame:
    """Add host, path, rule, template and verdict to every row."""
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = renamed(df, ["host", "path", "rule", "template", "verdict", "shaped"]).withColumns({"host": host, "path": path})
    rule, said = rule_column(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_said": said, "shaped": shape(F.col("path"))})
    counts = rows.groupBy("host", "shaped").agg(F.count("*").alias("n"), F.count("_said").alias("labelled"), F.count_if(F.col("_said") == "block").alias("blocked"))
    leaves = _generalised(counts, settings)
    total = leaves.agg(F.coalesce(F.sum("blocked"), F.lit(0)).alias("b"), F.coalesce(F.sum("labelled"), F.lit(0)).alias("l")).first()
    prior = total.b / total.l if total.l else 0.0
    merged = _merged(leaves, settings, prior)
    s = settings.smoothing
    by_host = merged.groupBy("host").agg(((F.sum("blocked") + s * prior) / (F.sum("labelled") + s)).alias("host_share"))
    by_template = merged.groupBy("host", "merged").agg(F.sum("blocked").alias("tb"), F.sum("labelled").alias("tl"))
    judged = by_template.join(by_host, "host").withColumn("purity", (F.col("tb") + s * F.col("host_share")) / (F.col("tl") + s))
    table = merged.join(judged, ["host", "merged"]).select("host", "shaped", F.concat(F.lit("/"), F.concat_ws("/", "merged")).alias("template"), "purity")
    method = F.when(F.col("purity") >= settings.block_from, "block").otherwise("allow")
    return rows.join(table, ["host", "shaped"], "left").withColumn("verdict", F.coalesce("_said", method)).drop("_said", "shaped")
