"""URL filter: host and path rules, and for the rest a ratio of two character language models.

Both models are variable-order Markov models of the characters of a URL with Witten-Bell smoothing, one
learnt from the URLs that the rules allow, one from those that they block. A URL's score is the difference of
its log-likelihoods divided by its length. The threshold is calibrated on labelled URLs that were not learnt
from. Everything is built from functions of Spark SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm import stages

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START = "\x02"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and all paths that start alike."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    """Characters in an n-gram (context and next character), the alphabet of the uniform distribution below
    all others, the steps of the threshold, and how many rows of the model may be broadcast."""

    order: int = 5
    alphabet: int = 256
    steps: int = 100
    broadcast_rows: int = 100_000


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The place of the longest fitting rule in ``rules``, or null; of equally long ones the first."""
    chosen = F.lit(None).cast("int")
    order = sorted(range(len(rules)), key=lambda n: (len(rules[n].name), -n))
    for n in order:
        rule = rules[n]
        here = (host == rule.host) | host.endswith("." + rule.host)
        chosen = F.when(here & path.startswith(rule.path), F.lit(n)).otherwise(chosen)
    return chosen


def _grams(df: DataFrame, order: int, *columns: str) -> DataFrame:
    """One row for each character of ``url``: the n-gram that ends there."""
    padded = F.concat(F.lit(START * (order - 1)), F.col("url"))
    places = F.explode(F.sequence(F.lit(1), F.length("url"))).alias("place")
    spread = df.filter(F.length("url") > 0).select(*columns, padded.alias("padded"), places)
    return spread.select(*columns, F.expr(f"substring(padded, place, {order})").alias("gram"))


def _ratios(counts: DataFrame, settings: Settings) -> DataFrame:
    """Log-likelihood difference of every n-gram's last character after its others.

    From the shortest contexts to the longest: a context's counts are mixed with what the shorter one says,
    in proportion to the kinds of characters seen after it. A context has no more rows than the alphabet has
    characters, so the windows are narrow.
    """
    below = None
    for order in range(1, settings.order + 1):
        grams = counts.groupBy(F.expr(f"right(gram, {order})").alias("gram")).agg(
            F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")
        )
        context = Window.partitionBy(F.expr(f"left(gram, {order - 1})")) if order > 1 else Window.partitionBy(F.lit(0))
        for name in ("allowed", "blocked"):
            grams = grams.withColumn(f"{name}_all", F.sum(name).over(context))
            grams = grams.withColumn(f"{name}_kinds", F.sum((F.col(name) > 0).cast("long")).over(context))
        if below is None:
            grams = grams.withColumns({f"{name}_below": F.lit(1.0 / settings.alphabet) for name in ("allowed", "blocked")})
        else:
            shorter = grams.withColumn("tail", F.expr(f"right(gram, {order - 1})"))
            grams = shorter.join(below.withColumnRenamed("gram", "tail"), "tail")
        mixed = {}
        for name in ("allowed", "blocked"):
            seen, kinds = F.col(f"{name}_all"), F.col(f"{name}_kinds")
            value = (F.col(name) + kinds * F.col(f"{name}_below")) / (seen + kinds)
            mixed[name] = F.when(seen > 0, value).otherwise(F.col(f"{name}_below"))
        below = grams.select("gram", *[column.alias(f"{name}_below") for name, column in mixed.items()])
    return below.select("gram", (F.log("allowed_below") - F.log("blocked_below")).alias("ratio"))


def _threshold(scores: DataFrame, settings: Settings) -> float:
    """The step that parts allowed from blocked URLs best (sum of both shares), of equal ones the nearest to 0.

    Only the counts of each step come to the driver; a score lies between two logarithms of probabilities.
    """
    step = F.floor(F.col("score") * settings.steps).alias("step")
    rows = scores.groupBy(step).agg(
        F.sum(F.when(F.col("allow"), F.col("pages")).otherwise(0)).alias("allowed"),
        F.sum(F.when(F.col("allow"), 0).otherwise(F.col("pages"))).alias("blocked"),
    ).collect()
    allowed, blocked = sum(row.allowed for row in rows), sum(row.blocked for row in rows)
    if not allowed or not blocked:
        return 0.0
    steps = sorted((row.step, row.allowed, row.blocked) for row in rows)
    best, under, over = None, 0, allowed
    for number, inside, outside in [*steps, (steps[-1][0] + 1, 0, 0)]:
        # Everything from this step on is allowed. Between two occupied steps any threshold parts alike.
        previous = steps[0][0] if best is None else last + 1
        nearest = min(max(0, previous), number)
        rank = (-(over * blocked + under * allowed), abs(nearest), nearest)
        best = rank if best is None else min(best, rank)
        over, under, last = over - inside, under + outside, number
    return best[2] / settings.steps


def judge(df: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", settings: Settings = Settings()) -> DataFrame:
    """One row for each row of ``df``: key, url, host, path, rule, score and verdict (allow or block).

    The verdict is the rule's; without a rule it is allow if the score reaches the threshold. The score is
    given for every URL.

    Nulls: a null URL has an empty host and path and, like an empty one, the score 0; a null key stays null.
    Every row counts in the models, so repeated URLs weigh more. If the rules allow nothing or block nothing,
    the threshold is 0. URLs are scored whole. An empty table gives an empty one.
    """
    rows = df.select(F.col(key).alias("key"), F.col(url).alias("url"))
    # Each distinct URL is judged once.
    urls = rows.groupBy(F.coalesce("url", F.lit("")).alias("url")).agg(F.count(F.lit(1)).alias("pages"))
    urls = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "digest": F.md5("url")})
    fit = fitting_rule(rules, F.col("host"), F.col("path"))
    names, verdicts = F.array(*[F.lit(rule.name) for rule in rules]), F.array(*[F.lit(rule.allow) for rule in rules])
    if not rules:
        names, verdicts = F.array().cast("array<string>"), F.array().cast("array<boolean>")
    urls = urls.withColumn("fit", fit)
    urls = urls.withColumns({"rule": F.get(names, F.col("fit")), "allow": F.get(verdicts, F.col("fit"))}).drop("fit")
    # Three sixteenths of the labelled URLs calibrate, the others are learnt from.
    urls = urls.withColumn("calibrates", F.substring("digest", 1, 1).isin("0", "1", "2"))
    urls, _ = stages.written(urls, "urls")
    learnt = urls.withColumns(
        {name: F.when(F.col("allow").eqNullSafe(value) & ~F.col("calibrates"), F.col("pages")).otherwise(0) for name, value in (("allowed", True), ("blocked", False))}
    )
    counts = _grams(learnt, settings.order, "allowed", "blocked").groupBy("gram").agg(
        F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")
    )
    counts, _ = stages.written(counts, "grams")
    ratios, _ = stages.written(_ratios(counts, settings), "ratios")
    # The model grows with the corpus; it is broadcast only as long as it is small.
    model = F.broadcast(ratios) if ratios.count() <= settings.broadcast_rows else ratios
    sums = _grams(urls, settings.order, "digest").join(model, "gram").groupBy("digest").agg(F.sum("ratio").alias("ratio"))
    scored = urls.join(sums, "digest", "left")
    score = F.when(F.length("url") > 0, F.round(F.col("ratio") / F.length("url"), 9)).otherwise(0.0)
    scored, _ = stages.written(scored.withColumn("score", score), "url-scores")
    threshold = _threshold(scored.filter("allow IS NOT NULL AND calibrates AND length(url) > 0"), settings)
    verdict = F.coalesce("allow", F.col("score") >= threshold)
    judged = scored.select(
        "url", "host", "path", "rule", "score", F.when(verdict, F.lit("allow")).otherwise(F.lit("block")).alias("verdict")
    )
    joined = rows.alias("r").join(judged.alias("j"), F.coalesce(F.col("r.url"), F.lit("")) == F.col("j.url"))
    return joined.select("r.key", "r.url", *[f"j.{name}" for name in ("host", "path", "rule", "score", "verdict")])
