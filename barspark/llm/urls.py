"""URL filter: path rules, and host verdicts from the link graph.

1. The longest rule that fits a page's host (or a parent domain) and path decides it.
2. The shares of a host's pages that rules allow and block seed two personalised
   PageRanks over host edges (absolute links in the pages): trust follows the links from
   trusted seeds, distrust follows them backwards from blocked seeds.
3. A page without a rule takes its host's verdict: block if the host's distrust exceeds
   its trust and ``THRESHOLD`` times the score of a fully blocked host, else allow.

Edges are counted per task before they are shuffled, so a host with a third of all
pages is one row per task and target; the graph tables have a row per host or edge.

Defined results: a null url, or one without ``://``, has empty host and path, no rule and
the verdict of the empty host (allow: it has no seed and no edge counts for it);
null or empty html has no links; links to the page's own host are not edges; repeated
rows count again; rules of equal length are tried in text order; an empty table gives
no rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.llm.common import Scratch, table

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
DAMPING = 0.85
THRESHOLD = 0.5
ROUNDS = 30
TOLERANCE = 1e-9
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(c: F.Column) -> F.Column:
    return F.translate(c, _CAPITALS, _CAPITALS.lower())


def with_host_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Columns ``host`` and ``path`` of the url."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return (pages.withColumn("_rest", rest)
            .withColumn("host", _lower(F.regexp_extract("_rest", r"^([^/?#]*)", 1)))
            .withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)).drop("_rest"))


def with_rule(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """Columns ``rule`` and ``rule_verdict`` (null without a fitting rule). The rules are
    configuration: they become one CASE expression, longest first."""
    rule = verdict = None
    for text, what in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        host, slash, path = text.partition("/")
        fits = (((F.col("host") == host) | F.col("host").endswith("." + host))
                & F.col("path").startswith(slash + path))
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (pages.withColumn("rule", rule if rule is not None else none)
                 .withColumn("rule_verdict", verdict if verdict is not None else none))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts; ``pages`` has host and html."""
    return (pages.select(F.col("host").alias("src"),
                         F.explode(F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(LINK), F.lit(1))).alias("d"))
            .select("src", _lower(F.col("d")).alias("dst"))
            .filter("src != '' AND src != dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def propagate(seeds: DataFrame, edges: DataFrame, s: Scratch, damping: float = DAMPING,
              rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) from ``seeds`` (host, trust_seed, distrust_seed, each 0 to 1).

    score = (1 - damping) seed + damping * sum of what its neighbours hand on, shared by
    edge weight; trust along the edges, distrust against them. One join and one
    pre-aggregated sum per round for both; ends when no score moves by ``tolerance``, or after
    ``rounds`` rounds, when ``damping ** rounds`` of a seed's score at most is still on its way.
    What reaches a host without edges to hand it on stays there."""
    both = edges.select("src", "dst", F.lit("trust").alias("kind"), "n").union(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit("distrust").alias("kind"), "n"))
    out = both.groupBy("src", "kind").agg(F.sum("n").alias("total"))
    shares = s.save(both.join(s.save(out, "out"), ["src", "kind"])
                    .select("src", "dst", "kind", (F.col("n") / F.col("total")).alias("share")), "shares")
    base = s.save(seeds.select("host", F.explode(F.create_map(F.lit("trust"), F.col("trust_seed"), F.lit("distrust"),
                                                             F.col("distrust_seed"))).alias("kind", "seed"))
                  .filter("seed > 0").select("host", "kind", ((1 - damping) * F.col("seed")).alias("score")), "base")
    cur, previous = base, None
    for k in range(rounds):
        handed = (shares.join(cur.select(F.col("host").alias("src"), "kind", "score"), ["src", "kind"])
                  .select(F.col("dst").alias("host"), "kind", (damping * F.col("score") * F.col("share")).alias("score")))
        nxt = s.save(base.unionByName(handed).groupBy("host", "kind").agg(F.sum("score").alias("score")), f"round{k}")
        moved = (nxt.select("host", "kind", "score").union(cur.select("host", "kind", -F.col("score")))
                 .groupBy("host", "kind").agg(F.abs(F.sum("score")).alias("d")).agg(F.max("d").alias("d")).first()["d"])
        if previous:
            s.drop(previous)
        cur, previous = nxt, f"round{k}"
        if moved is None or moved <= tolerance:
            break
    return cur.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("score"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("score"))), F.lit(0.0)).alias("distrust"))


def host_verdicts(pages: DataFrame, s: Scratch, rules: tuple = RULES, damping: float = DAMPING,
                  threshold: float = THRESHOLD) -> DataFrame:
    """(host, trust, distrust, host_verdict) for every host with a score."""
    ruled = with_rule(with_host_path(pages), rules)
    share = lambda what: F.avg((F.coalesce(F.col("rule_verdict"), F.lit("")) == what).cast("double"))
    seeds = s.save(ruled.filter("host != ''").groupBy("host")
                   .agg(share("allow").alias("trust_seed"), share("block").alias("distrust_seed")), "seeds")
    edges = s.save(host_edges(ruled), "edges")
    scores = propagate(seeds, edges, s, damping)
    blocked = (F.col("distrust") > F.col("trust")) & (F.col("distrust") > threshold * (1 - damping))
    return scores.withColumn("host_verdict", F.when(blocked, "block").otherwise("allow"))


def judge(pages: DataFrame, rules: tuple = RULES, damping: float = DAMPING, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row of ``pages``."""
    s = Scratch(pages.sparkSession, "urls")
    slim = pages.select("page_id", "url", "html")
    hosts = s.save(host_verdicts(slim, s, rules, damping, threshold), "verdicts")
    ruled = with_rule(with_host_path(slim.drop("html")), rules)
    return (ruled.join(hosts, "host", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("rule_verdict", "host_verdict", F.lit("allow")).alias("verdict"),
                    F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")))


def op4_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = judge(table(spark, sf_dir, "pages"))
    return j.select("page_id", "host", "path", "rule", "verdict", F.round("trust", 6).alias("trust"),
                    F.round("distrust", 6).alias("distrust"))


def _sql() -> str:
    cases = {"rule": [], "verdict": []}
    for text, what in sorted(RULES, key=lambda r: (-len(r[0]), r[0])):
        host, slash, path = text.partition("/")
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash + path}')"
        cases["rule"].append(f"WHEN {fits} THEN '{text}'")
        cases["verdict"].append(f"WHEN {fits} THEN '{what}'")
    rounds = []
    for k in range(1, ROUNDS + 1):
        rounds.append(f"""r{k} AS MATERIALIZED (SELECT host, kind, sum(score) AS score FROM (
            SELECT * FROM r0 UNION ALL
            SELECT e.dst, e.kind, {DAMPING} * r.score * e.share FROM shares e JOIN r{k - 1} r ON r.host = e.src AND r.kind = e.kind)
            GROUP BY ALL)""")
    link = LINK.removeprefix("(?i)").replace("'", "''")
    return rf"""
WITH u AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, html, lower(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1)) AS host,
              regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
p AS (SELECT *, CASE {' '.join(cases['rule'])} END AS rule, CASE {' '.join(cases['verdict'])} END AS rv FROM hp),
links AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '(?i){link}', 1)) AS d FROM p),
edges AS (SELECT src, lower(d) AS dst, count(*) AS n FROM links WHERE src <> '' AND src <> lower(d) GROUP BY ALL),
two AS (SELECT src, dst, 'trust' AS kind, n FROM edges UNION ALL SELECT dst, src, 'distrust', n FROM edges),
shares AS (SELECT src, dst, kind, n / sum(n) OVER (PARTITION BY src, kind) AS share FROM two),
seeds AS (SELECT host, avg((coalesce(rv, '') = 'allow')::INT) AS t, avg((coalesce(rv, '') = 'block')::INT) AS d FROM p WHERE host <> '' GROUP BY 1),
r0 AS (SELECT host, 'trust' AS kind, {1 - DAMPING} * t AS score FROM seeds WHERE t > 0
       UNION ALL SELECT host, 'distrust', {1 - DAMPING} * d FROM seeds WHERE d > 0),
{','.join(rounds)},
h AS (SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0.0) AS trust,
             coalesce(sum(score) FILTER (kind = 'distrust'), 0.0) AS distrust FROM r{ROUNDS} GROUP BY 1)
SELECT page_id, host, path, rule,
       coalesce(rv, CASE WHEN distrust > trust AND distrust > {THRESHOLD * (1 - DAMPING)} THEN 'block' ELSE 'allow' END) AS verdict,
       round(coalesce(trust, 0.0), 6) AS trust, round(coalesce(distrust, 0.0), 6) AS distrust
FROM p LEFT JOIN h USING (host)
"""


SQL = _sql()
