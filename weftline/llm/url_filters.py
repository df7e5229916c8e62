"""URL filters: rules by host and path, and a logistic regression for the rest.

A URL's host and path are cut into character n-grams, which are hashed into a
fixed number of buckets. A small table of labelled URLs trains one weight per
bucket by gradient descent; the weights are one array, looked up where a URL is
read. Everything here is DataFrame expressions: the descent runs inside one row,
which holds the labelled table and nothing of the judged one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm.quality_rules import LOWER, UPPER, let

ALLOW, BLOCK = "allow", "block"
ORDERS = (3, 4, 5)
BUCKETS = 1 << 15
ROUNDS = 300
RATE = 4.0
SHRINK = 2e-4

# The labelled table that is used where none is given: what the words of hosts and
# paths tell. The top-level name is one that is reserved, and the same everywhere.
BLOCKED = (
    "https://www.casino-royal.example/play/slots",
    "http://online-casino.example/bonus?ref=1",
    "https://blog.free-casino-games.example/en/1.html",
    "http://m.casino-win.example/en/lottery/",
    "https://win-big-now.example/lottery/",
    "http://www.poker-win.example/table/9",
    "https://m.poker-chips.example/fr/3",
    "https://sports-bets.example/odds/today",
    "http://www.best-bets.example/en/44",
    "https://free-bets.example/de/football",
    "http://blog.betting-tips.example/es/7",
    "https://cheap-pills.example/buy/1",
    "http://www.pills-online.example/order?id=2",
    "https://diet-pills.example/en/5",
    "https://m.discount-pharmacy.example/pills/blue",
    "http://cheap-watches-replica.example/shop",
    "https://www.replica-bags.example/cheap/2",
    "https://spam-mailer.example/list/3",
    "http://link-farm.example/links.html",
    "https://blog.seo-spam-links.example/page/7",
    "http://www.content-farm.example/articles/99",
    "https://article-spam.example/en/12",
    "https://ads-server.example/banner?size=2",
    "http://m.ads-network.example/en/8",
    "http://click-track.example/r/8",
    "https://www.track-clicks.example/pixel",
    "https://ad-tracker.example/de/4",
    "http://popup-ads.example/show",
    "https://adult-cams.example/live",
    "http://www.adult-videos.example/en/6",
    "https://blog.adult-dating.example/fr/2",
    "http://xxx-videos.example/watch/5",
    "https://m.xxx-pics.example/en/1",
    "https://payday-loans.example/apply/fast",
    "http://www.quick-loans.example/en/cash",
    "https://free-prizes.example/win/phone",
    "http://m.free-gift-cards.example/win/3",
    "https://cheap-viagra.example/order",
    "http://www.miracle-diet.example/buy/now",
    "https://get-rich-now.example/en/money",
)
ALLOWED = (
    "https://www.city-news.example/local/mayor.html",
    "http://news.example/en/world/12",
    "https://m.evening-news.example/fr/4",
    "https://blog.gardening.example/en/tomatoes",
    "http://blog.travel-notes.example/italy/3/",
    "https://travel-guide.example/es/8",
    "https://www.university.example/physics/courses",
    "http://library.example/catalogue?page=2",
    "https://m.city-library.example/de/5",
    "https://docs.software.example/guide/install.html",
    "http://www.software-manual.example/en/2",
    "http://wiki.history.example/roman_roads",
    "https://local-history.example/fr/9",
    "https://recipes.example/en/soup/77",
    "http://www.family-recipes.example/bread",
    "http://www.weather.example/forecast#today",
    "https://m.weather-maps.example/en/3",
    "https://museum.example/exhibitions/",
    "http://blog.art-museum.example/de/1",
    "http://m.radio-station.example/programme/8",
    "https://www.science-journal.example/articles/451",
    "http://science-teacher.example/en/6",
    "http://forum.bicycles.example/thread/61?page=3",
    "https://school.example/timetable.html",
    "http://www.music-school.example/es/2",
    "http://www.hiking-trails.example/alps/5",
    "https://books.example/reviews/novels",
    "http://m.book-reviews.example/en/7",
    "http://theatre.example/tickets/12",
    "https://www.health-advice.example/en/sleep",
    "http://public-health.example/fr/4",
    "http://open-data.example/tables/rainfall",
    "https://music-lessons.example/piano/1.html",
    "http://www.football-club.example/en/players",
    "https://blog.kitchen-garden.example/tools/9",
    "http://birds.example/de/atlas/31/",
    "https://town-hall.example/en/council",
    "http://www.railway.example/timetable/2",
    "https://m.railway-station.example/de/8",
    "http://language-course.example/es/lesson/1",
)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, blocked): the small labelled table."""
    rows = [(u, 1) for u in BLOCKED] + [(u, 0) for u in ALLOWED]
    return spark.createDataFrame(rows, "url string, blocked int")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lowered, and the path; both empty without a ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct of ``rule`` and ``verdict`` of the longest rule that fits, else null.

    A rule is a host, a slash and more of a path. It fits its host and all
    subdomains, for paths that start with its own. Ties go to the rule that is
    last in order of text. Every rule is one comparison, so this is for lists
    that are kept by hand.
    """
    fitting = []
    for verdict, rule in rules:
        name, slash, more = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + more)
        row = F.struct(
            F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")
        )
        fitting.append(F.when(fits, row))
    if not fitting:
        return F.lit(None).cast("struct<n:int,rule:string,verdict:string>")
    return fitting[0] if len(fitting) == 1 else F.greatest(*fitting)


def buckets_of(host: Column, path: Column, n_buckets: int = BUCKETS) -> Column:
    """The distinct buckets of a URL's n-grams, in order; none without any n-gram.

    N-grams are taken with the text's ends marked, apart for host and path.
    """

    def grams(kind: str, text: Column) -> Column:
        ends = F.concat(F.array(F.lit("^")), F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), F.array(F.lit("$")))

        def of_order(c: Column, order: int) -> Column:
            last = F.size(c) - order
            places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
            return F.transform(
                places, lambda i: F.concat(F.lit(kind), *[F.get(c, i + k) for k in range(order)])
            )

        found = let(ends, lambda c: F.concat(*[of_order(c, n) for n in ORDERS]))
        return F.when(F.length(text) > 0, found).otherwise(F.array().cast("array<string>"))

    hashed = F.transform(
        F.concat(grams("h", host), grams("p", path)),
        lambda g: (F.conv(F.substring(F.md5(g), 1, 8), 16, 10).cast("bigint") % n_buckets).cast("int"),
    )
    return F.sort_array(F.array_distinct(hashed))


def fitted_weights(
    labelled: DataFrame,
    rounds: int = ROUNDS,
    rate: float = RATE,
    shrink: float = SHRINK,
    n_buckets: int = BUCKETS,
) -> DataFrame:
    """One row with ``weights``: an array of one double per bucket, then the bias.

    Plain gradient descent on the mean log loss, from zero, with every URL's
    features scaled to unit length. ``labelled`` (url, blocked) is small: it and
    its n-grams are held by one row. Null URLs or labels take no part. With an
    empty table all weights are 0.
    """
    host, path = host_and_path(F.col("url"))
    order = Window.orderBy("url", "blocked")
    rows = (
        labelled.dropna(subset=["url", "blocked"])
        .select("url", "blocked", buckets_of(host, path, n_buckets).alias("buckets"))
        .withColumn("i", F.row_number().over(order) - 1)
        # The bias is a bucket that every URL has.
        .select("i", "blocked", F.concat("buckets", F.array(F.lit(n_buckets))).alias("buckets"))
    )
    features = rows.select("i", F.explode("buckets").alias("bucket"))
    of_bucket = features.groupBy("bucket").agg(F.sort_array(F.collect_list("i")).alias("urls"))
    of_bucket = of_bucket.withColumn("j", F.row_number().over(Window.orderBy("bucket")) - 1)
    scale = 1 / F.sqrt(F.size("buckets").cast("double"))
    of_url = (
        rows.select("i", "blocked", scale.alias("scale"), F.explode("buckets").alias("bucket"))
        .join(of_bucket.select("bucket", "j"), "bucket")
        .groupBy("i", "blocked", "scale")
        .agg(F.sort_array(F.collect_list("j")).alias("js"))
    )
    url_list = of_url.agg(F.sort_array(F.collect_list(F.struct("i", "blocked", "scale", "js")))).scalar()
    bucket_list = of_bucket.agg(F.sort_array(F.collect_list(F.struct("j", "bucket", "urls")))).scalar()
    one = labelled.sparkSession.range(1).select(url_list.alias("u"), bucket_list.alias("b"))
    zero = F.lit(0.0)

    def step(w: Column) -> Column:
        def margin(u: Column) -> Column:
            return u["scale"] * F.aggregate(u["js"], zero, lambda s, j: s + F.get(w, j))

        errors = F.transform("u", lambda u: u["scale"] * (u["blocked"] - 1 / (1 + F.exp(-margin(u)))))
        return let(
            errors,
            lambda e: F.transform(
                "b",
                lambda b, k: F.get(w, k)
                + rate
                * (
                    F.aggregate(b["urls"], zero, lambda s, i: s + F.get(e, i)) / F.size("u")
                    - shrink * F.get(w, k)
                ),
            ),
        )

    start = F.transform("b", lambda b: zero)
    fitted = one.select(
        "b", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda w, r: step(w)).alias("w")
    )
    used = fitted.select(F.inline(F.arrays_zip(F.col("b.bucket").alias("bucket"), "w")))
    every = labelled.sparkSession.range(n_buckets + 1).select(F.col("id").cast("int").alias("bucket"))
    dense = every.join(used, "bucket", "left").select("bucket", F.coalesce("w", zero).alias("w"))
    return dense.agg(F.sort_array(F.collect_list(F.struct("bucket", "w")))["w"].alias("weights"))


def judge_urls(
    df: DataFrame,
    keep: list[str],
    rules: list[tuple[str, str]],
    labelled: DataFrame | None = None,
    url: str = "url",
    rounds: int = ROUNDS,
) -> DataFrame:
    """``keep`` columns, ``host``, ``path``, ``rule``, ``score`` and ``verdict``.

    ``rules`` are (verdict, rule) pairs; the longest that fits decides, see
    :func:`rule_of`. Other URLs are blocked if ``score``, the regression's
    probability, is above a half. A URL without host and path, a null one and
    one without ``://`` among them, has score 0 and is allowed. The weights'
    array has a fixed size, whatever the tables. Rows are judged one by one, so
    repeated rows repeat and an empty table stays empty. A path as long as a
    text is read in whole.
    """
    weights = fitted_weights(labelled if labelled is not None else labelled_urls(df.sparkSession), rounds)
    host, path = host_and_path(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")))
    kept = {f"kept{i}": F.col(f"`{k}`") for i, k in enumerate(keep)}
    rows = df.select(*[c.alias(n) for n, c in kept.items()], host.alias("host"), path.alias("path"))
    rows = rows.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("found"))
    rows = rows.select("*", buckets_of(F.col("host"), F.col("path")).alias("buckets"))
    # A subquery of its own: lambdas cannot hold one.
    rows = rows.select("*", weights.scalar().alias("w"))
    w = F.col("w")
    logit = F.aggregate("buckets", F.lit(0.0), lambda s, b: s + F.get(w, b)) + F.get(w, F.lit(BUCKETS))
    n = F.size("buckets")
    # The bias counts as one more feature.
    score = F.when(n > 0, 1 / (1 + F.exp(-logit / F.sqrt((n + 1).cast("double"))))).otherwise(0.0)
    judged = rows.select("*", score.alias("score"))
    by_score = F.when(F.col("score") > 0.5, BLOCK).otherwise(ALLOW)
    return judged.select(
        *[F.col(n).alias(k) for n, k in zip(kept, keep)],
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        "score",
        F.coalesce("found.verdict", by_score).alias("verdict"),
    )
