"""URL filter: host rules, and personalised PageRank of trust and distrust over host links.

Trust walks along links from trusted hosts, distrust walks against them from blocked ones
(who links to a bad host is suspect). Both walks run together on a table of host links, all
in DataFrame operations, until what is still under way changes the scores of a kind by less
than ``TOLERANCE``; walkers of hosts without links go home to the seeds. A host whose distrust outweighs its trust by ``THRESHOLD`` is blocked, unless
a rule says otherwise.

Defined results: a url that is null or has no ``://`` has an empty host and path, fits no
rule and is allowed; rows are judged each for itself; of rules of equal length the first by
name wins; without seeds or links nothing is propagated.
"""

from __future__ import annotations

import functools
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch
from fleetlake.session import scratch_path, staged

#: (verdict, host and path prefix).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: A host with one of these words in its name is a seed of distrust.
BLOCKED_WORDS = ("ads", "adult", "bets", "casino", "farm", "pills", "porn", "spam")
#: Steps of the SQL counterpart, which can't stop by itself.
STEPS = 8
#: Steps go on until all later ones together would add less than this to a kind's scores.
TOLERANCE = 1e-6
#: Steps whose scores are added up at once.
FOLDED = 8
DAMPING = 0.85
#: Distrust counts this many times when it is weighed against trust.
THRESHOLD = 1.0

#: The host of an absolute link in an attribute.
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def lower_ascii(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def split_url(url: str) -> tuple[Column, Column]:
    """Host and path, both empty where there are none."""
    rest = F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")
    there = F.coalesce(F.locate("://", F.col(url)) > 0, F.lit(False))
    host = F.when(there, lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))).otherwise("")
    path = F.when(there, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null if none does."""
    name = verdict = F.lit(None).cast("string")
    # The last one asked first: shorter rules are wrapped by longer ones.
    for decision, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, _, prefix = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + prefix)
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """``source, target, n``: on how many links one host points to another."""
    host, _ = split_url("url")
    targets = F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lower_ascii)
    found = pages.select(host.alias("source"), F.explode(targets).alias("target"))
    found = found.where("source <> '' and source <> target")
    return found.groupBy("source", "target").agg(F.count("*").alias("n"))


def seed_kind(host: Column, rules=RULES, words=BLOCKED_WORDS) -> Column:
    """``distrust`` for a blocked word in the name, ``trust`` for a host that a rule allows whole."""
    whole = [rule.partition("/")[0] for decision, rule in rules if decision == "allow" and rule.endswith("/") and rule.count("/") == 1]
    allowed = functools.reduce(
        lambda a, d: a | (host == d) | host.endswith("." + d), whole, F.lit(False)
    )
    parts = F.split(host, "[.-]")
    blocked = F.arrays_overlap(parts, F.array(*map(F.lit, words))) if words else F.lit(False)
    return F.when(host == "", F.lit(None)).when(blocked, "distrust").when(allowed, "trust")


def propagated(pages: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``host, trust, distrust`` of every host that some walk reaches, converged.

    The score is the sum of where walkers stand after each step, scaled to one per kind: who
    goes home from a dead end begins again as the others did, which changes the scale only.
    """
    spark = pages.sparkSession
    links = staged(host_links(pages), scratch_path(spark, "host-links"))
    host, _ = split_url("url")
    hosts = pages.select(host.alias("host")).distinct().unionByName(links.select(F.col("target").alias("host")))
    seeds = hosts.distinct().withColumn("kind", seed_kind(F.col("host"))).where("kind is not null")
    seeds = staged(seeds, scratch_path(spark, "seeds"))
    # At most one row per kind.
    sizes = F.broadcast(seeds.groupBy("kind").agg(F.count("*").alias("seeds")))
    home = seeds.join(sizes, "kind").select("kind", "host", (1 / F.col("seeds")).alias("home"))
    edges = links.select(F.lit("trust").alias("kind"), F.col("source").alias("host"), F.col("target").alias("to"), "n").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("target").alias("host"), F.col("source").alias("to"), "n")
    )
    leaving = edges.groupBy("kind", "host").agg(F.sum("n").alias("all"))
    edges = edges.join(leaving, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("all")).alias("share"))
    edges = staged(edges, scratch_path(spark, "steps"))
    start = term = home.select("kind", "host", F.col("home").alias("score"))
    scratch = Scratch(spark)
    total, terms, read = None, [start], []
    while not edges.isEmpty():
        moved = edges.join(term, ["kind", "host"]).select(
            "kind", F.col("to").alias("host"), (F.col("share") * F.col("score") * DAMPING).alias("score")
        )
        term = scratch.keep(moved.groupBy("kind", "host").agg(F.sum("score").alias("score")), "moved")
        terms.append(term)
        under_way = [row.score for row in term.groupBy("kind").agg(F.sum("score").alias("score")).collect()]
        done = all(mass * DAMPING / (1 - DAMPING) < tolerance for mass in under_way)
        if done or len(terms) > FOLDED:
            added = functools.reduce(DataFrame.unionByName, terms if total is None else [total, *terms])
            older = [*read, *([] if total is None else [total])]
            total = scratch.keep(added.groupBy("kind", "host").agg(F.sum("score").alias("score")), "scores")
            scratch.drop(*older)
            # The next step still reads the last of them.
            read, terms = [t for t in terms if t is not start], []
        if done:
            break
    score = total if total is not None else term
    whole = F.broadcast(score.groupBy("kind").agg(F.sum("score").alias("whole")))
    score = score.join(whole, "kind").withColumn("score", F.col("score") / F.col("whole"))
    kinds = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]
    return score.groupBy("host").agg(*kinds)


def judged(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every page."""
    host, path = split_url("url")
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    scores = propagated(pages)
    method = F.when(F.col("distrust") * threshold > F.col("trust"), "block").otherwise("allow")
    return split.join(scores, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict")
    )


def oracle_sql() -> str:
    """The same for an engine with recursive SQL-free steps: one common table per step."""
    rules = sorted(RULES, key=lambda r: (-len(r[1]), r[1]))

    def fits(rule: str) -> str:
        domain, _, prefix = rule.partition("/")
        return f"((host = '{domain}' or ends_with(host, '.{domain}')) and starts_with(path, '/{prefix}'))"

    case = lambda pick: " ".join(f"when {fits(r)} then '{pick(d, r)}'" for d, r in rules)
    allowed = [r[:-1] for d, r in RULES if d == "allow" and r.count("/") == 1]
    trusted = " or ".join(f"host = '{d}' or ends_with(host, '.{d}')" for d in allowed)
    words = ", ".join(f"'{w}'" for w in BLOCKED_WORDS)
    steps = "".join(
        f"""
        moved{k} as materialized (
            select e.kind, e.towards as host, sum(e.share * s.score) as score
            from steps e join scores{k} s on e.kind = s.kind and e.host = s.host group by 1, 2),
        scores{k + 1} as materialized (
            select kind, host, sum(score) as score from (
                select h.kind, h.host, h.home * (1 - {DAMPING} * coalesce(
                    (select sum(m.score) from moved{k} m where m.kind = h.kind), 0)) as score from home h
                union all select kind, host, {DAMPING} * score from moved{k}) group by 1, 2),"""
        for k in range(STEPS)
    )
    return f"""
    with split as (
        select page_id, html,
            case when contains(url, '://') then translate(regexp_extract(substr(url, instr(url, '://') + 3), '^([^/?#]*)', 1),
                '{string.ascii_uppercase}', '{string.ascii_lowercase}') else '' end as host,
            case when contains(url, '://') then regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1)
                else '' end as path
        from pages),
    found as (
        select host as source, unnest(regexp_extract_all(html,
            '(?i)\\b(?:href|src)\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''\\s>]+)', 1)) as raw from split),
    links as materialized (
        select source, translate(raw, '{string.ascii_uppercase}', '{string.ascii_lowercase}') as target, count(*) as n
        from found where source <> '' and source <> translate(raw, '{string.ascii_uppercase}', '{string.ascii_lowercase}')
        group by 1, 2),
    hosts as (select host from split union select target from links),
    seeds as (
        select host, case when list_has_any(regexp_split_to_array(host, '[.-]'), [{words}]) then 'distrust'
            when {trusted} then 'trust' end as kind from hosts where host <> ''),
    home as materialized (
        select kind, host, 1.0::double / count(*) over (partition by kind) as home from seeds where kind is not null),
    edges as (
        select 'trust' as kind, source as host, target as towards, n from links
        union all select 'distrust', target, source, n from links),
    steps as materialized (
        select kind, host, towards, n::double / sum(n) over (partition by kind, host) as share from edges),
    scores0 as (select kind, host, home as score from home),{steps}
    weighed as (
        select host, coalesce(sum(score) filter (kind = 'trust'), 0) as trust,
            coalesce(sum(score) filter (kind = 'distrust'), 0) as distrust from scores{STEPS} group by 1)
    select page_id, s.host, path, case {case(lambda d, r: r)} end as rule,
        case {case(lambda d, r: d)}
            when distrust * {THRESHOLD} > trust then 'block' else 'allow' end as verdict
    from split s left join weighed using (host)
    """
