"""URL verdicts from rules and from a path-template tree that learns where rules say nothing.

The tree is kept as aggregated rows and grown one level at a time for all hosts together: shapes (paths
with digits and hexadecimal ids generalised) are counted once, and each level turns segments into ``*``
where they vary freely, or where branches lead on statistically alike (same following segments and the
same labels, by a G test against their siblings together).  Labels are the verdicts of the rules.  A
template is rejected when the smoothed share of blocked urls among its labelled ones is high.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import written

ALLOW, BLOCK = "allow", "block"
MANY_CHILDREN = 16
FEW_EACH = 4.0
NORMAL_QUANTILE = 3.09  # of 0.999
# Laplace smoothing: a template without labels is at one half
PRIOR_BLOCKED, PRIOR_LABELLED = 1.0, 2.0
REJECT_AT = 0.8
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# segments hold neither a slash nor, unescaped, a star
WILDCARD = "*"
END = "/"


@dataclass(frozen=True)
class Rule:
    """``host/path`` with a verdict; it fits the host and its subdomains below the path."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]

    def fits(self) -> Column:
        host = (F.col("host") == self.host) | F.endswith("host", F.lit("." + self.host))
        return host & F.startswith("path", F.lit(self.path))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), CAPITALS, SMALL)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule, null where none fits; ties to the smaller text."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        text = F.when(rule.fits(), F.lit(rule.text)).otherwise(text)
        verdict = F.when(rule.fits(), F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def path_shape(path: Column) -> Column:
    """The path with long hexadecimal segments as ``<x>`` and digits as ``<n>``; a star, ``<`` or backslash of its own is escaped by a backslash."""
    escaped = F.regexp_replace(path, r"([\\<*])", r"\\$1")
    hexed = F.regexp_replace(escaped, r"(?<=/)(?=[^/.]*[0-9])[0-9a-fA-F\-]{8,}(?=[/.]|$)", "<x>")
    hexed = F.when(path.rlike(r"^(/[0-9]+)*/?$"), path).otherwise(hexed)
    return F.regexp_replace(hexed, r"[0-9]+", "<n>")


def _segments(shape: Column) -> Column:
    """Segments after the leading slash."""
    return F.when(shape == "", F.array().cast("array<string>")).otherwise(F.split(F.substr(shape, F.lit(2)), "/"))


def _alike(step: DataFrame) -> DataFrame:
    """``host, prefix, segment`` of branches that lead on like their siblings taken together."""
    cells = step.groupBy("host", "prefix", "segment", "following").agg(
        F.sum("n_allow").alias("allow"), F.sum("n_block").alias("block"), F.sum(F.col("n") - F.col("n_allow") - F.col("n_block")).alias("open")
    )
    # one cell for each following segment and label
    cells = cells.select("host", "prefix", "segment", F.explode(F.array(*(
        F.struct(F.concat_ws("\t", "following", F.lit(label)).alias("cell"), F.col(label).alias("n")) for label in ("allow", "block", "open")
    ))).alias("x")).select("host", "prefix", "segment", "x.cell", "x.n").filter("n > 0")
    cells = written(cells, "cells")
    pooled = cells.groupBy("host", "prefix", "cell").agg(F.sum("n").alias("cell_n"))
    totals = cells.groupBy("host", "prefix").agg(
        F.sum("n").alias("all_n"), F.count_distinct("segment").alias("branches"), F.count_distinct("cell").alias("kinds")
    )
    own = cells.groupBy("host", "prefix", "segment").agg(F.sum("n").alias("own_n"))
    compared = cells.join(pooled, ["host", "prefix", "cell"]).join(own, ["host", "prefix", "segment"]).join(totals, ["host", "prefix"])
    term = 2 * F.col("n") * F.log(F.col("n") * F.col("all_n") / (F.col("own_n") * F.col("cell_n")))
    tested = compared.groupBy("host", "prefix", "segment").agg(
        F.sum(term).alias("g"), F.first("kinds").alias("kinds"), F.first("branches").alias("branches")
    )
    freedom = F.greatest(F.col("kinds") - 1, F.lit(1))
    spread = 2 / (9 * freedom)
    critical = freedom * F.pow(1 - spread + NORMAL_QUANTILE * F.sqrt(spread), 3)  # Wilson-Hilferty
    alike = tested.filter((F.col("branches") > 1) & (F.col("g") <= critical)).select("host", "prefix", "segment")
    several = alike.groupBy("host", "prefix").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("host", "prefix")
    return alike.join(several, ["host", "prefix"], "left_semi")


def _settled(grown: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Shapes that no further level can change, with their whole template, and the others.

    A shape without a further segment is done; so are those of a prefix that go on alike, as segments only become
    wild beside siblings.  ``branch`` of the others is the next level at which their prefix branches.
    """
    ahead = F.slice("segments", depth + 1, F.greatest(F.size("segments") - depth, F.lit(0)))
    shared = grown.groupBy("host", "prefix").agg(F.min(ahead).alias("_least"), F.max(ahead).alias("_greatest"))
    # what the first and the last in order have in common, all between them have in common
    same = F.zip_with("_least", "_greatest", lambda a, b: a.eqNullSafe(b))
    marked = grown.join(shared, ["host", "prefix"]).withColumn("_place", F.array_position(same, F.lit(False)))
    open_ = (F.size("segments") > depth) & (F.col("_place") > 0)
    template = _onward(depth, F.size("segments"))
    done = marked.filter(~open_).select("host", "shape", template.alias("template"), "n", "n_allow", "n_block")
    return done, marked.filter(open_).withColumn("branch", F.col("_place") - 1 + depth).drop("_place", "_least", "_greatest")


def _onward(depth: int, to: Column | int) -> Column:
    """The prefix with the segments from ``depth`` to ``to`` as they are."""
    rest = F.slice("segments", depth + 1, F.greatest(F.lit(to) - depth if isinstance(to, int) else to - depth, F.lit(0)))
    return F.when(F.size(rest) > 0, F.concat("prefix", F.lit("/"), F.array_join(rest, "/"))).otherwise(F.col("prefix"))


def template_tree(shapes: DataFrame) -> DataFrame:
    """``host, shape, template`` and the counts of every shape (``host, shape, n, n_allow, n_block``).

    Levels are added until no two shapes of a host share a prefix and go on, however deep that is; there is a round
    for each level at which any prefix branches.
    """
    grown = shapes.withColumn("segments", _segments(F.col("shape"))).withColumn("prefix", F.lit(""))
    finished, depth = [], 0
    while True:
        more = F.size("segments") > depth
        step = grown.filter(more).select(
            "host", "prefix", F.element_at("segments", depth + 1).alias("segment"),
            F.coalesce(F.try_element_at("segments", F.lit(depth + 2)), F.lit(END)).alias("following"),
            "n", "n_allow", "n_block",
        )
        branches = step.groupBy("host", "prefix", "segment").agg(F.sum("n").alias("n"))
        varying = branches.groupBy("host", "prefix").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).filter(
            (F.col("k") >= MANY_CHILDREN) & (F.col("n") / F.col("k") < FEW_EACH)
        )
        wild = branches.join(varying.select("host", "prefix"), ["host", "prefix"], "left_semi").select("host", "prefix", "segment")
        wild = written(wild.union(_alike(step)).distinct().withColumn("wild", F.lit(True)), "wild")
        keyed = grown.withColumn("segment", F.try_element_at("segments", F.lit(depth + 1)))
        joined = keyed.join(wild, ["host", "prefix", "segment"], "left")
        name = F.when(F.col("wild"), F.lit(WILDCARD)).otherwise(F.col("segment"))
        prefix = F.when(more, F.concat("prefix", F.lit("/"), name)).otherwise(F.col("prefix"))
        depth += 1
        grown = written(joined.select("host", "shape", "n", "n_allow", "n_block", "segments", prefix.alias("prefix")), "grown")
        done, grown = _settled(grown, depth)
        finished.append(written(done, "settled"))
        grown = written(grown, "open")
        # levels at which no prefix branches are passed over
        following = grown.agg(F.min("branch")).first()[0]
        if following is None:
            return reduce(DataFrame.unionByName, finished)
        grown, depth = grown.withColumn("prefix", _onward(depth, following)), following


def judge_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and ``template`` for every row of ``pages`` (``page_id``, ``url``).

    The verdict is that of the longest fitting rule, else that of the url's template: rejected templates
    block, all others, also those without any labelled url, allow.  A null url, or one without ``://``, has an empty host
    and path; repeated rows and null ids are kept; an empty table gives no rows; other columns are ignored.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(rules)
    judged = parsed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), path_shape(F.col("path")).alias("shape"))
    shapes = written(
        judged.groupBy("host", "shape").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("ruled") == ALLOW).alias("n_allow"), F.count_if(F.col("ruled") == BLOCK).alias("n_block")
        ),
        "shapes",
    )
    tree = written(template_tree(shapes), "tree")
    purity = (F.sum("n_block") + PRIOR_BLOCKED) / (F.sum("n_block") + F.sum("n_allow") + PRIOR_LABELLED)
    rejected = tree.groupBy("host", "template").agg(purity.alias("purity")).filter(
        F.col("purity") >= REJECT_AT
    ).select("host", "template", F.lit(BLOCK).alias("learned"))
    # both sides are plain scans, so that the rows of a very common host and shape can be split
    learned = written(tree.join(rejected, ["host", "template"], "left").select("host", "shape", "template", "learned"), "learned")
    return judged.join(learned, ["host", "shape"]).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "learned", F.lit(ALLOW)).alias("verdict"), "template"
    )
