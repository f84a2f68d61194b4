"""URL filters: fixed rules first, then templates of a host's paths judged by labelled purity.

For each host the paths form a tree.  Level by level segments that are variable,
many values of one shape with digits, become the wildcard, and so do those with
few pages and those whose share of bad labels does not differ significantly from
that of all siblings together.  Segments that differ are ordered by their share,
and neighbours that do not differ from each other by a two-sample test are
merged into one branch.  A path's template names the branch of each segment.  A
template with labels is rejected if its share of bad labels, smoothed towards
the share of all labels, reaches the limit.

All of it is grouped counts and joins; a host with any number of pages is
combined before each shuffle, and its rows are split at run time in joins.

Defined results: a null url, or one without ``://``, has an empty host and path
and is one host of its own.  A page without a label counts as a page, not as
good or bad; a template without labels is allowed.  Paths of any depth are
followed to their end.  Repeated rows each count and each get a row.  Extra
columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroom.operators.hot_keys import join_per_key

from .common import settle, written

#: (host, path, verdict), as the task states them; a rule fits its host and all subdomains.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: Levels that ``verdict_sql`` spells out, below which it has wildcards only; the operator has no such bound.
MAX_DEPTH = 6
LEAST_PAGES = 10
#: Segments of one shape are variable if a node has so many of them.
VARIABLE_VALUES = 10
#: A branch differs from its siblings beyond this many standard deviations.
DEVIATIONS = 2.0
#: Weight of the share of all labels in a template's share.
PRIOR_WEIGHT = 4.0
REJECT_AT = 0.6
WILDCARD = "*"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_verdicts(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does.  For lists short enough to be an expression."""
    longest = sorted(rules, key=lambda r: -len(r[0] + r[1]))

    def choose(pick) -> Column:
        fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for h, p, _ in longest]
        return F.coalesce(*(F.when(fit, F.lit(pick(rule))) for fit, rule in zip(fits, longest, strict=True)), F.lit(None).cast("string"))

    return choose(lambda r: r[0] + r[1]), choose(lambda r: r[2])


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Pages with ``bad`` (0, 1 or null): the label of the document that the last number of the path names."""
    number = F.regexp_extract(path_of(F.col("url")), r"([0-9]{1,18})[^0-9]*$", 1)
    judged = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    per_doc = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc")).agg(F.max(judged).alias("bad"))
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.when(number != "", number).cast("long").alias("doc"))
    return join_per_key(known, per_doc, ["doc"], "left").drop("doc")


def shape_of(segment: Column) -> Column:
    """A segment with each run of digits as ``#``, which no segment has."""
    return F.regexp_replace(segment, "[0-9]+", "#")


def _branch_names(branches: DataFrame, nodes: DataFrame, least_pages: int, deviations: float) -> DataFrame:
    """The branch name of each segment (``host``, ``template``, ``segment``) of ``nodes`` that does not become the wildcard.

    Segments are ordered by their share of bad labels in hundredths, so that a
    node has at most 101 places to compare, whatever its number of segments.
    """
    node = ["host", "template"]
    shaped = branches.withColumn("shape", shape_of(F.col("segment")))
    variable = shaped.filter(F.col("shape").contains("#")).groupBy(*node, "shape").agg(F.count("*").alias("values")).filter(F.col("values") >= VARIABLE_VALUES)
    share = F.try_divide("all_bad_pages", "all_labelled")
    excess = F.col("bad_pages") - F.col("labelled") * share
    differs = excess * excess > deviations**2 * F.col("labelled") * share * (1 - share)
    apart = join_per_key(shaped.filter(F.col("pages") >= least_pages), nodes, node).filter(differs)
    apart = join_per_key(apart, variable.drop("values"), [*node, "shape"], "left_anti")
    apart = apart.withColumn("place", F.floor(F.try_divide(100 * F.col("bad_pages"), F.col("labelled"))))
    places = apart.groupBy(*node, "place").agg(
        F.sum("labelled").alias("labelled"), F.sum("bad_pages").alias("bad_pages"), F.min("segment").alias("first"), F.count("*").alias("members")
    )
    in_order = Window.partitionBy(*node).orderBy("place")
    other, other_bad = F.lag("labelled").over(in_order), F.lag("bad_pages").over(in_order)
    one = F.lit(1.0)
    gap = F.try_divide("bad_pages", "labelled") - F.try_divide(other_bad, other)
    pooled = F.try_divide(F.col("bad_pages") + other_bad, F.col("labelled") + other)
    parts = gap * gap > deviations**2 * pooled * (1 - pooled) * (F.try_divide(one, F.col("labelled")) + F.try_divide(one, other))
    classed = places.withColumn("parts", F.when(parts, 1).otherwise(0)).withColumn(
        "class", F.sum("parts").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    in_class = Window.partitionBy(*node, "class")
    first, members = F.min("first").over(in_class), F.sum("members").over(in_class)
    name = F.when(members == 1, first).otherwise(F.concat(first, F.lit("#+"), (members - 1).cast("string")))
    named = classed.withColumn("name", name).select(*node, "place", "name")
    return join_per_key(apart.select(*node, "segment", "place"), named, [*node, "place"]).select(*node, "segment", "name")


def path_templates(pages: DataFrame, least_pages: int = LEAST_PAGES, deviations: float = DEVIATIONS) -> DataFrame:
    """Rows of ``page_id``, ``host``, ``path``, ``bad`` with their ``template``.

    Branches can part only below a node with at least ``least_pages`` deeper
    pages of both labels, and what lies below other nodes is no such node
    either: rows there have wildcards to their end and are done with.
    """
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = written(pages.select("page_id", "host", "path", "bad", segments.alias("segments"), F.lit("").alias("template")), "url-rows")
    ended, level = [], 0
    counts = (F.count("*").alias("pages"), F.count("bad").alias("labelled"), F.sum(F.coalesce("bad", F.lit(0))).alias("bad_pages"))
    while True:
        at_level = rows.withColumn("segment", F.get("segments", F.lit(level)))
        branches = at_level.filter(F.col("segment").isNotNull()).groupBy("host", "template", "segment").agg(*counts)
        sums = (F.sum(c).alias(f"all_{c}") for c in ("pages", "labelled", "bad_pages"))
        both_labels = (F.col("all_bad_pages") > 0) & (F.col("all_bad_pages") < F.col("all_labelled"))
        nodes = written(branches.groupBy("host", "template").agg(*sums).filter((F.col("all_pages") >= least_pages) & both_labels), "url-nodes")
        if nodes.isEmpty():
            break
        names = _branch_names(branches, nodes, least_pages, deviations)
        live = nodes.select("host", "template", F.lit(True).alias("live"))
        known = written(join_per_key(at_level, live, ["host", "template"], "left"), "url-rows")
        goes_on = F.coalesce("live", F.lit(False)) & F.col("segment").isNotNull()
        ended.append(_with_wildcards(known.filter(~goes_on).drop("segment", "live"), level))
        named = join_per_key(known.filter(goes_on).drop("live"), names, ["host", "template", "segment"], "left")
        branch = F.concat("template", F.lit("/"), F.coalesce("name", F.lit(WILDCARD)))
        rows = written(named.withColumn("template", branch).drop("segment", "name"), "url-rows")
        level += 1
    ended.append(_with_wildcards(rows, level))
    return reduce(DataFrame.unionByName, ended).select("page_id", "host", "path", "bad", "template")


def _with_wildcards(rows: DataFrame, level: int) -> DataFrame:
    """Rows whose template has ``level`` segments, with a wildcard for each further one."""
    open_segments = F.greatest(F.size("segments") - level, F.lit(0))
    return rows.withColumn("template", F.concat("template", F.repeat(F.lit(f"/{WILDCARD}"), open_segments)))


def judge_templates(rows: DataFrame, prior_weight: float = PRIOR_WEIGHT, reject_at: float = REJECT_AT) -> DataFrame:
    """One row per host and template: its counts, its smoothed share of bad labels, and ``template_verdict``."""
    per_template = settle(rows.groupBy("host", "template").agg(F.count("bad").alias("labelled"), F.sum(F.coalesce("bad", F.lit(0))).alias("bad_pages")))
    labelled, bad = per_template.agg(F.coalesce(F.sum("labelled"), F.lit(0)), F.coalesce(F.sum("bad_pages"), F.lit(0))).first()
    prior = bad / labelled if labelled else 0.0
    share = (F.col("bad_pages") + prior_weight * F.lit(prior)) / (F.col("labelled") + prior_weight)
    verdict = F.when((F.col("labelled") > 0) & (share >= reject_at), "block").otherwise("allow")
    return per_template.withColumn("bad_share", share).withColumn("template_verdict", verdict)


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, **limits: float) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``template`` for rows of ``page_id``, ``url``, ``bad``."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "bad")
    rows = path_templates(parsed, **limits)
    judged = judge_templates(rows).select("host", "template", "template_verdict")
    rule, verdict = rule_verdicts(F.col("host"), F.col("path"), rules)
    return join_per_key(rows, judged, ["host", "template"]).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, "template_verdict").alias("verdict"), "template"
    )


def _level_sql(level: int) -> str:
    return f"""
, at{level} as (
  select *, case when len(segments) >= {level} then segments[{level}] end as segment from rows{level - 1}
), branches{level} as (
  select host, template, segment, regexp_replace(segment, '[0-9]+', '#', 'g') as shape,
         count(*) as pages, count(bad) as labelled, sum(coalesce(bad, 0)) as bad_pages
  from at{level} where segment is not null group by all
), nodes{level} as (
  select host, template, sum(bad_pages) / nullif(sum(labelled), 0) as share from branches{level} group by all
), variable{level} as (
  select host, template, shape from branches{level} where contains(shape, '#') group by all having count(*) >= {VARIABLE_VALUES}
), apart{level} as (
  select host, template, segment, labelled, bad_pages, floor(100 * bad_pages / labelled) as place
  from branches{level} join nodes{level} using (host, template)
  where pages >= {LEAST_PAGES}
    and (bad_pages - labelled * share) * (bad_pages - labelled * share) > {DEVIATIONS**2}::double * labelled * share * (1 - share)
    and (host, template, shape) not in (select (host, template, shape) from variable{level})
), places{level} as (
  select host, template, place, sum(labelled) as labelled, sum(bad_pages) as bad_pages, min(segment) as first, count(*) as members
  from apart{level} group by all
), gaps{level} as (
  select *, lag(labelled) over w as other, lag(bad_pages) over w as other_bad
  from places{level} window w as (partition by host, template order by place)
), classes{level} as (
  select *, sum(case when (bad_pages / labelled - other_bad / other) * (bad_pages / labelled - other_bad / other)
                       > {DEVIATIONS**2}::double * ((bad_pages + other_bad) / (labelled + other)) * (1 - (bad_pages + other_bad) / (labelled + other))
                         * (1::double / labelled + 1::double / other) then 1 else 0 end)
              over (partition by host, template order by place) as class
  from gaps{level}
), names{level} as (
  select host, template, place,
         case when sum(members) over w = 1 then min(first) over w
              else min(first) over w || '#+' || cast(sum(members) over w - 1 as bigint) end as name
  from classes{level} window w as (partition by host, template, class)
), literal{level} as (
  select host, template, segment, name from apart{level} join names{level} using (host, template, place)
), rows{level} as (
  select a.page_id, a.host, a.path, a.bad, a.segments,
         case when a.segment is null then a.template else a.template || '/' || coalesce(l.name, '*') end as template
  from at{level} a left join literal{level} l on a.host = l.host and a.template = l.template and a.segment = l.segment
)"""


def _rule_sql(pick: int, rules: Sequence[tuple[str, str, str]]) -> str:
    longest = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    cases = (f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{(h + p, v)[pick]}'" for h, p, v in longest)
    return "case " + " ".join(cases) + " end"


def verdict_sql(rules: Sequence[tuple[str, str, str]] = RULES, max_depth: int = MAX_DEPTH) -> str:
    """The same rules and templates in DuckDB's SQL."""
    levels = reduce(lambda sql, level: sql + _level_sql(level), range(1, max_depth + 1), "")
    return f"""
with judged as (
  select doc_id, max(case when quality = 0 or toxic = 1 then 1 when quality is not null or toxic is not null then 0 end) as bad
  from labels where doc_id is not null group by doc_id
), parsed as (
  select page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_UPPER.lower()}') as host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), numbered as (
  select *, try_cast(nullif(regexp_extract(path, '([0-9]{{1,18}})[^0-9]*$', 1), '') as bigint) as doc from parsed
), rows0 as (
  select page_id, host, path, bad, list_filter(string_split(path, '/'), lambda s: s <> '') as segments, '' as template
  from numbered left join judged on doc = doc_id
){levels}
, ended as (
  select * replace (template || repeat('/*', greatest(len(segments) - {max_depth}, 0)) as template) from rows{max_depth}
), templates as (
  select host, template, count(bad) as labelled, sum(coalesce(bad, 0)) as bad_pages from ended group by all
), totals as (
  select coalesce(sum(bad_pages) / nullif(sum(labelled), 0), 0) as prior from templates
), verdicts as (
  select host, template,
         case when labelled > 0 and (bad_pages + {PRIOR_WEIGHT}::double * prior) / (labelled + {PRIOR_WEIGHT}::double) >= {REJECT_AT}::double
              then 'block' else 'allow' end as template_verdict
  from templates, totals
)
select page_id, host, path, {_rule_sql(0, rules)} as rule, coalesce({_rule_sql(1, rules)}, template_verdict) as verdict, template
from ended join verdicts using (host, template)
"""
