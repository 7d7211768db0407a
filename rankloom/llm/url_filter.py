"""URL filter: host and path rules, then logistic regression on hashed character n-grams.

Everything is DataFrame expressions: no Python runs on the executors and the scoring pass is
one narrow projection over the URL column.  The n-grams of host and path are hashed into
``width`` features; a URL's margin is the sum of their weights.  Training runs full-batch
gradient steps over a small labelled URL table (``labelled_table``; its size is bounded): each step is one aggregate over its rows, and
only the summed gradient (at most ``width + 1`` numbers) reaches the driver.

Defined cases: a null URL or one without ``://`` has an empty host and path and is judged by
the model; rules match their host and all subdomains where the path starts with theirs, the
longest rule wins; repeated rows are judged each; extra columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm._work import Workspace

WIDTH = 1 << 14
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# fixed values: the rules of the contract (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

# the labelled URL table is made of these names of sites, each in a few layouts
BLOCKED_SITES = (
    "casino casino-online best-casino poker-win win-money free-win bets sports-bets betting free-spins "
    "cheap-meds pills pills-online viagra pharma-cheap adult adult-video xxx porn-free x-rated "
    "spam spam-mail link-farm click-farm ads ad-tracker track-click popup-ads tracker free-money "
    "payday-loan cheap-loans replica-watches get-rich free-iphone jackpot-win"
).split()
ALLOWED_SITES = (
    "news weather library museum school university research science history recipes garden travel music books "
    "sports city council health hospital data docs wiki forum community photo cinema kitchen fashion economy finance "
    "energy transport railway airport hotel restaurant market furniture tools software hardware chess puzzle design "
    "architecture photography nature animals birds ocean mountain climate astronomy physics chemistry biology "
    "mathematics language dictionary translation law government election parks education careers"
).split()
LAYOUTS = ("https://{}.example/", "http://www.{}.example/index.html", "https://{}.example/articles/{}", "https://shop.{}.example/items/{}/view")


def labelled_urls() -> list[tuple[str, int]]:
    """The small labelled table: (url, 1 = block), as many layouts for either label."""
    out = []
    for label, sites in ((1, BLOCKED_SITES), (0, ALLOWED_SITES)):
        for i, site in enumerate(sites):
            for j, layout in enumerate(LAYOUTS):
                out.append((layout.format(site, 37 * i + 11 * j + 5), label))
    return out


def labelled_table(pages: DataFrame, rules=RULES, most: int = 1000) -> DataFrame:
    """The training table ``(url, label)``: the fixed labelled URLs; at most ``most`` distinct
    URLs that a rule allows (those with the least xxhash64) as label 0; and each of those with
    its site's name replaced by a blocked one as label 1, so that layouts tell nothing."""
    u = pages.select("url").distinct()
    allowed = u.filter(rule(host(F.col("url")), path(F.col("url")), rules)["verdict"] == "allow")
    # a site with a word of a blocked name is no example of label 0
    words = sorted({w for site in BLOCKED_SITES for w in site.split("-")})
    named = F.arrays_overlap(F.split(host(F.col("url")), "[.-]"), F.array(*map(F.lit, words)))
    some = allowed.filter(~named).orderBy(F.xxhash64("url"), "url").limit(most)
    site = F.element_at(F.array(*map(F.lit, BLOCKED_SITES)), (F.pmod(F.xxhash64("url"), F.lit(len(BLOCKED_SITES))) + 1).cast("int"))
    name = "^([^:]*://(?:(?:www|m|blog)[.])?)([^./?#]+)(.*)$"
    renamed = F.concat(F.regexp_extract("url", name, 1), site, F.regexp_extract("url", name, 3))
    both = F.explode(F.array(F.struct("url", F.lit(0).alias("label")), F.struct(renamed.alias("url"), F.lit(1).alias("label"))))
    fixed = pages.sparkSession.createDataFrame(labelled_urls(), "url string, label int")
    return fixed.unionByName(some.select(both.alias("r")).select("r.url", "r.label"))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host_: Column, path_: Column, rules=RULES) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host_ == h) | F.endswith(host_, F.lit("." + h))) & F.startswith(path_, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def ngrams(text: Column, tag: str, sizes, width: int) -> Column:
    """Hashed character n-grams of ``^text$``, repeats included."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))

    def of_size(n: int) -> Column:
        last = F.length(marked) - (n - 1)
        at = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        gram = lambda i: F.xxhash64(F.lit(f"{tag}{n}"), F.substring(marked, i, F.lit(n)))
        return F.transform(at, lambda i: F.pmod(gram(i), F.lit(width)).cast("int"))

    return F.concat(*map(of_size, sizes))


def url_features(url: Column, width: int = WIDTH) -> Column:
    """Distinct feature numbers of a URL: n-grams of 3 to 5 of the host without its last
    label, of 3 of the path with numbers folded."""
    names = F.regexp_replace(host(url), "[.][^.]*$", "")
    letters = F.regexp_replace(path(url), "[0-9]+", "0")
    return F.array_distinct(F.concat(ngrams(names, "h", (3, 4, 5), width), ngrams(letters, "p", (3,), width)))


def margin(features: Column, weights: list[float], bias: float) -> Column:
    w = F.from_json(F.lit(json.dumps(weights)), "array<double>")  # folded to one constant
    return F.aggregate(features, F.lit(float(bias)), lambda acc, f: acc + F.get(w, f))


def train(labelled: DataFrame, width: int = WIDTH, rounds: int = 20, rate: float = 4.0, ridge: float = 3e-3) -> tuple[list[float], float]:
    """Logistic regression on ``labelled(url, label)``, both labels weighing the same."""
    work = Workspace(labelled.sparkSession, "url")
    some = labelled.filter(F.col("label").isin(0, 1)).select(url_features(F.col("url"), width).alias("f"), F.col("label").alias("y"))
    rows = work.save(some.coalesce(1), "labelled")  # small by contract: one file, read by each step
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    weights, bias = [0.0] * width, 0.0
    if len(sizes) < 2:
        return weights, 4.0 if 1 in sizes else -4.0
    scale = F.when(F.col("y") == 1, F.lit(0.5 / sizes[1])).otherwise(F.lit(0.5 / sizes[0]))
    used = F.explode(F.concat(F.col("f"), F.array(F.lit(width)))).alias("k")
    mass = {r["k"]: r["g"] for r in rows.select(used, scale.alias("g")).groupBy("k").agg(F.sum("g").alias("g")).collect()}
    active = sum(mass.values())  # mean number of features of a row
    speed = dict.fromkeys(mass, 0.0)
    for _ in range(rounds):
        error = scale * (1 / (1 + F.exp(-margin(F.col("f"), weights, bias))) - F.col("y"))
        sums = rows.select(used, error.alias("g")).groupBy("k").agg(F.sum("g").alias("g")).collect()  # at most width + 1 rows
        for r in sums:
            k, g = r["k"], r["g"]
            old = bias if k == width else weights[k]
            # a diagonal Newton step with momentum, shared among the features that act together
            speed[k] = 0.9 * speed[k] - rate * (g + 1e-4 * old) / (0.25 * mass[k] + ridge) / active
            if k == width:
                bias += speed[k]
            else:
                weights[k] += speed[k]
    return weights, bias


def judge(pages: DataFrame, labelled: DataFrame | None, rules=RULES, width: int = WIDTH, threshold: float = 0.5, model=None) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` for every page row; ``score`` is the
    probability of block by ``model`` (weights and bias; trained on ``labelled`` if it is not
    given), also where a rule decides."""
    weights, bias = model or train(labelled, width)
    url = F.col("url")
    p = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), url_features(url, width).alias("f"))
    m = margin(F.col("f"), weights, bias)
    judged = p.select("page_id", "host", "path", rule(F.col("host"), F.col("path"), rules).alias("r"), (1 / (1 + F.exp(-m))).alias("score"))
    verdict = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", verdict).alias("verdict"), "score")
