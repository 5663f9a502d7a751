"""URL filter: explicit rules first, then trust and distrust spread over the host link graph.

Trust is a personalised PageRank from the hosts of allowed pages along their
links; distrust is the same walk from the hosts of blocked pages against the
links (whoever links to a blocked host is suspect).  A page that no rule
decides is blocked if distrust makes up more than ``BLOCK_SHARE`` of its
host's mass.

Mass is counted in whole units, so sums don't depend on their order and a
retried task can't move a host over the threshold.  The walk goes on until no
host is new and none grows by more than ``TOLERANCE`` of its mass, and a link
never passes less than one unit, so every host that links reach has mass.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read_table, written

#: (verdict, rule); a rule is a host, a slash and the start of a path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
DAMPING = 0.85
#: Steps of the reference SQL: enough where no host is further from a seed and no links form a circle.
ITERATIONS = 12
BLOCK_SHARE = 0.5
#: Units per seed page in which mass is told: 10^12 seed pages fit a long.
UNIT = 1_000_000
#: Parts of a unit in which mass walks: 10^12 seed pages and a division fit decimal(38).
FINE = 10 ** 14
#: Growth of a host's mass over ``CUT`` steps, as a share of it, at which it counts as settled.
TOLERANCE = 1e-9
#: Iterations between written tables, which keep the plan short.
CUT = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def _lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def matching_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does.  ``rules`` is a list in the program."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is tested first
        at, slash, start = text.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def judge_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"),
                         path_of(F.col("url")).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return parts.select("*", rule.alias("rule"), verdict.alias("said"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links): links from pages of one host to another, counted."""
    links = F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(_LINK), F.lit(1))
    return (pages.select(host_of(F.col("url")).alias("src"), F.explode(links).alias("to"))
            .select("src", _lower(F.col("to")).alias("dst"))
            .filter((F.col("src") != "") & (F.col("src") != F.col("dst")))
            .groupBy("src", "dst").agg(F.count("*").alias("links")))


def spread(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """(kind, host, mass) of a settled walk, in parts of 1 / ``FINE`` units; ``seeds`` has (kind, host, pages).

    ``trust`` walks along the links, ``distrust`` against them; both walk in
    the same joins.  A step passes floor(mass * damping / all links), one at
    least, over each link; mass at hosts without onward links leaves the walk.
    It starts from the seeds' own mass, so no host's mass ever falls, and ends
    when over ``CUT`` steps no host was new or grew by more than ``tolerance``.
    """
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionAll(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links"))
    totals = both.groupBy("kind", "src").agg(F.sum("links").alias("all_links"))
    steps = written(both.join(totals, ["kind", "src"]), "edges")
    passed = Fraction(str(damping))
    whole = lambda c: c.cast("decimal(38,0)")
    mass = stay = written(seeds.select("kind", "host", whole(F.floor(
        whole(F.col("pages")) * whole(F.lit(str(UNIT * FINE))) * (passed.denominator - passed.numerator) / passed.denominator)).alias("mass")), "seeds")
    each = F.floor(F.col("mass") * passed.numerator / (F.col("all_links") * passed.denominator))
    while True:
        before = mass.withColumnRenamed("mass", "had")
        for _ in range(CUT):
            moved = (mass.withColumnRenamed("host", "src").join(steps, ["kind", "src"])
                     .select("kind", F.col("dst").alias("host"), whole(F.greatest(whole(each), whole(F.lit(1))) * F.col("links")).alias("mass")))
            mass = moved.unionAll(stay).groupBy("kind", "host").agg(whole(F.sum("mass")).alias("mass"))
        mass = written(mass, "mass")
        grown = (F.col("mass") - F.col("had")).cast("double") > F.lit(tolerance) * F.col("mass").cast("double")
        if mass.join(before, ["kind", "host"], "left").filter(F.col("had").isNull() | grown).isEmpty():
            return mass


def filter_urls(pages: DataFrame, rules=RULES, tolerance: float = TOLERANCE, damping: float = DAMPING,
                block_share: float = BLOCK_SHARE) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page.

    Null url, or none with ``://``: empty host and path; no rule fits, no link
    counts, verdict allow.  Null html: no links.  Repeated rows: each a page
    with its links.  Empty table: empty result.  Other input columns are not
    read.  ``trust`` and ``distrust`` are the host's mass in whole units (0
    where the walk never came, or with less than a unit); the verdict goes by
    the mass itself.
    """
    judged = judge_by_rules(pages, rules)
    seeds = (judged.filter("said is not null").groupBy(F.when(F.col("said") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
             .agg(F.count("*").alias("pages")))
    mass = spread(host_edges(pages), seeds, tolerance, damping)
    own = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), F.lit(0).cast("decimal(38,0)"))
    share = Fraction(str(block_share))
    units = lambda c: F.floor(F.col(c) / F.lit(FINE)).cast("long").alias(c)
    suspect = F.col("distrust") * (share.denominator - share.numerator) > F.col("trust") * share.numerator
    hosts = (mass.groupBy("host").agg(own("trust").alias("trust"), own("distrust").alias("distrust"))
             .select("host", units("trust"), units("distrust"), suspect.alias("suspect")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (judged.join(written(hosts, "hosts"), "host", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("said", F.when(F.col("suspect"), "block").otherwise("allow")).alias("verdict"),
                    zero("trust"), zero("distrust")))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages"))


def _sql() -> str:
    case = lambda i: "CASE " + " ".join(
        f"WHEN (host = '{at}' OR suffix(host, '.{at}')) AND starts_with(path, '{slash}{start}') THEN '{(said, rule)[i]}'"
        for said, rule, (at, slash, start) in sorted(((v, r, r.partition("/")) for v, r in RULES), key=lambda x: -len(x[1]))) + " END"
    link = _LINK.replace("'", "''")
    steps = "".join(f""",
m{i} AS MATERIALIZED (SELECT kind, host, sum(mass)::BIGINT AS mass FROM (
  SELECT kind, host, floor(mass * {1 - DAMPING!r}::DOUBLE)::BIGINT AS mass FROM m0
  UNION ALL SELECT s.kind, s.dst, floor(m.mass * s.share)::BIGINT FROM m{i - 1} m JOIN steps s ON m.kind = s.kind AND m.host = s.src)
  GROUP BY kind, host)""" for i in range(1, ITERATIONS + 1))
    return f"""
WITH parts AS (SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '{_URL}', 1), '{_UPPER}', '{_LOWER}') AS host,
                      regexp_extract(coalesce(url, ''), '{_URL}', 2) AS path FROM pages),
judged AS (SELECT page_id, host, path, {case(1)} AS rule, {case(0)} AS said FROM parts),
edges AS (SELECT host AS src, dst, count(*) AS links
          FROM (SELECT host, translate(unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)), '{_UPPER}', '{_LOWER}') AS dst FROM parts)
          WHERE host <> '' AND host <> dst GROUP BY ALL),
both_ways AS (SELECT 'trust' AS kind, src, dst, links FROM edges
              UNION ALL SELECT 'distrust', dst, src, links FROM edges),
steps AS MATERIALIZED (SELECT kind, src, dst, {DAMPING}::DOUBLE * links / sum(links) OVER (PARTITION BY kind, src) AS share FROM both_ways),
m0 AS MATERIALIZED (SELECT CASE said WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) * {UNIT} AS mass
       FROM judged WHERE said IS NOT NULL GROUP BY ALL){steps},
hosts AS (SELECT host, coalesce(sum(mass) FILTER (kind = 'trust'), 0)::BIGINT AS trust,
                 coalesce(sum(mass) FILTER (kind = 'distrust'), 0)::BIGINT AS distrust FROM m{ITERATIONS} GROUP BY host)
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN distrust > {BLOCK_SHARE}::DOUBLE * (trust + distrust) THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(trust, 0)::BIGINT AS trust, coalesce(distrust, 0)::BIGINT AS distrust
FROM judged LEFT JOIN hosts USING (host)
"""


SQL = _sql()
