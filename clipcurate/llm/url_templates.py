"""URL filter by a path-template tree per host, in DataFrame operations only.

Every step works on path shapes counted per host, not on single URLs: runs of digits become `#` first, and a shape
is aggregated before it is shuffled. From the root downwards, each level of a host's tree

* turns the children of a node into the wildcard `*` when there are many of them for the node's URLs,
* merges sibling branches whose next segments are distributed as those of all their siblings (chi-square test) and
  whose share of blocked labels does not differ from theirs either. Branches without any label are only merged with
  each other, as there is nothing to test.

A template is rejected when its smoothed share of blocked labels reaches `reject`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcurate.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed values of the contract: (verdict, host, path), in the order given.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class Settings:
    depth: int = 3
    """Levels of the tree that are generalised; deeper segments keep their shape."""
    children: int = 8
    variety: float = 0.3
    """A node's children become a wildcard from so many on, if they are more than this share of its URLs."""
    normal: float = 1.6448536269514722
    """One-sided 5 % point of the normal distribution, for the chi-square limit."""
    label_gap: float = 1.959963984540054
    """Standard errors by which the shares of blocked labels may differ."""
    smoothing: float = 2.0
    reject: float = 0.8


def host_of(url: Column) -> Column:
    rest = F.expr("substr(_url, instr(_url, '://') + 3)")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.when(F.instr(url, "://") > 0, host).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.expr("substr(_url, instr(_url, '://') + 3)")
    path = F.regexp_extract(F.regexp_replace(rest, r"^[^/?#]*", ""), r"^[^?#]*", 0)
    return F.when(F.instr(url, "://") > 0, path).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def judge(pages: DataFrame, rules=RULES, settings: Settings = Settings()) -> DataFrame:
    """Add `host`, `path`, `rule`, `template`, `purity` and `verdict` to a table with a `url`.

    A rule decides the URLs it fits and labels them for the tree; the others get `block` if their template is
    rejected and `allow` if not. A null URL or one without `://` has an empty host and path and the template of
    these. Columns of these names are replaced; repeated rows are kept, and count as often as they occur.
    """
    made = ("host", "path", "rule", "template", "purity", "verdict")
    others = [c for c in pages.columns if c not in made]
    url = F.col("_url")
    parsed = (
        pages.select(*others)
        .withColumn("_url", F.coalesce(F.col("url"), F.lit("")))
        .withColumns({"host": host_of(url), "path": path_of(url)})
        .drop("_url")
        .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
        .withColumn("_shape", F.regexp_replace("path", r"[0-9]+", "#"))
    )
    shapes = parsed.groupBy("host", "_shape").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("_rule").alias("labelled"),
        F.count(F.when(F.col("_rule.verdict") == "block", 1)).alias("blocked"),
    )
    templates = written(template_tree(written(shapes, "url-shapes"), settings), "url-templates")
    return (
        parsed.join(templates, ["host", "_shape"], "left")
        .withColumn("rule", F.col("_rule.rule"))
        .withColumn(
            "verdict",
            F.coalesce("_rule.verdict", F.when(F.col("purity") >= settings.reject, "block").otherwise("allow")),
        )
        .select(*others, *made)
    )


def template_tree(shapes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(host, _shape, template, purity) of counted shapes."""
    rows = shapes.withColumns({"_parts": F.split("_shape", "/"), "_t": F.lit("")})
    for level in range(1, settings.depth + 1):
        rows = written(_level(rows, level, settings), f"url-level-{level}")
    deeper = F.when(
        F.size("_parts") > settings.depth + 1,
        F.concat(F.lit("/"), F.array_join(F.slice("_parts", settings.depth + 2, 1 << 20), "/")),
    ).otherwise("")
    rows = rows.withColumn("template", F.concat("_t", deeper))
    share = (F.sum("blocked") + 0.5 * settings.smoothing) / (F.sum("labelled") + settings.smoothing)
    purity = rows.groupBy("host", "template").agg(share.alias("purity"))
    return rows.join(purity, ["host", "template"]).select("host", "_shape", "template", "purity")


def _level(rows: DataFrame, level: int, s: Settings) -> DataFrame:
    """Extend the template of every shape that has a segment at `level`."""
    part, following = F.get("_parts", F.lit(level)), F.get("_parts", F.lit(level + 1))
    rows = rows.withColumns({"_part": part, "_next": F.coalesce(following, F.lit(""))})
    here = rows.where(F.col("_part").isNotNull())
    node = ["host", "_t"]
    variety = (
        here.groupBy(*node, "_part")
        .agg(F.sum("n").alias("n"))
        .groupBy(*node)
        .agg(((F.count(F.lit(1)) >= s.children) & (F.count(F.lit(1)) > s.variety * F.sum("n"))).alias("_wild"))
    )
    branches = (
        here.groupBy(*node, "_part", "_next")
        .agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "blocked")])
        .join(variety, node)
        .withColumn("_child", F.expr("if(_wild, '*', _part)"))
    )
    profile = branches.groupBy(*node, "_child", "_next").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "blocked")])
    totals = profile.groupBy(*node, "_child").agg(
        F.sum("n").alias("b_n"), F.sum("labelled").alias("b_l"), F.sum("blocked").alias("b_b")
    )
    profile = profile.join(totals, [*node, "_child"]).withColumn("_known", F.col("b_l") > 0)
    pool = [*node, "_known"]
    pooled_next = profile.groupBy(*pool, "_next").agg(F.sum("n").alias("p_next"))
    pooled = profile.groupBy(*pool).agg(
        F.sum("n").alias("p_n"), F.sum("labelled").alias("p_l"), F.sum("blocked").alias("p_b"),
        F.countDistinct("_next").alias("p_k"), F.countDistinct("_child").alias("p_c"),
    )
    # Chi-square over the next segments the branch has, plus the expected count of those it lacks.
    expected = F.col("b_n") * F.col("p_next") / F.col("p_n")
    tested = (
        profile.join(pooled_next, [*pool, "_next"])
        .join(pooled, pool)
        .groupBy(*pool, "_child", "b_n", "b_l", "b_b", "p_l", "p_b", "p_k", "p_c")
        .agg((F.sum((F.col("n") - expected) ** 2 / expected) + F.first("b_n") - F.sum(expected)).alias("_chi"))
    )
    freedom = F.greatest(F.col("p_k") - 1, F.lit(1)).cast("double")
    spread = 2 / (9 * freedom)
    limit = freedom * (1 - spread + s.normal * F.sqrt(spread)) ** 3
    rate = (F.col("p_b") + 1) / (F.col("p_l") + 2)
    gap = F.abs(F.col("b_b") / F.col("b_l") - F.col("p_b") / F.col("p_l"))
    same_labels = ~F.col("_known") | (gap <= s.label_gap * F.sqrt(rate * (1 - rate) / F.col("b_l")))
    merged = (F.col("p_c") > 1) & (F.col("_chi") <= limit) & same_labels
    step = F.when(merged, F.expr("if(_known, '~', '~?')")).otherwise(F.col("_child"))
    steps = tested.select(*node, "_child", step.alias("_step"))
    named = branches.join(steps, [*node, "_child"]).select(*node, "_part", "_step").distinct()
    kept = [c for c in rows.columns if c not in ("_part", "_next", "_t")]
    return rows.join(named, [*node, "_part"], "left").select(
        *kept, F.when(F.col("_step").isNull(), F.col("_t")).otherwise(F.concat("_t", F.lit("/"), "_step")).alias("_t")
    )
