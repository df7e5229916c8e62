"""Counts, length statistics, steps, vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.registry import Tables, query
from weftline.operators import profile
from weftline.params import CONTEXT_LENGTHS, PERCENTILES
from weftline.plans.report import length_report as full_report
from weftline.plans.report import text_length_histogram
from weftline.session import staged

LENGTHS = ((), f"SELECT len({v.pieces('text')}) AS n FROM documents")

STATS_SQL = """SELECT count(*) AS n, round(avg(n), 6) AS mean_length,
    quantile_cont(n, 0.5)::DOUBLE AS median_length, round(stddev_pop(n), 6) AS std_length,
    min(n) AS min_length, max(n) AS max_length FROM lengths"""
PERCENTILE_SQL = """SELECT percentile, round(value, 6) AS length,
    round(100.0 * (SELECT count(*) FROM lengths WHERE n <= value) /
      (SELECT count(*) FROM lengths), 6) AS coverage FROM (""" + " UNION ALL ".join(
    f"SELECT {p} AS percentile, quantile_cont(n::DOUBLE, {p / 100}) AS value FROM lengths"
    for p in PERCENTILES
) + ")"
COVERAGE_SQL = " UNION ALL ".join(
    f"""SELECT {c} AS context_length, round(100.0 * count_if(n <= {c}) / count(*), 6) AS coverage,
    count_if(n > {c})::BIGINT AS n_truncated, round(100.0 * count_if(n > {c}) / count(*), 6) AS truncated,
    round(avg(greatest(0, n - {c})), 6) AS mean_excess FROM lengths"""
    for c in CONTEXT_LENGTHS
)
RECOMMEND_SQL = " UNION ALL ".join(
    f"SELECT {q}::DOUBLE AS target, round(quantile_cont(n::DOUBLE, {q}), 6) AS length FROM lengths"
    for q in (0.9, 0.95)
)


def histogram(t: Tables):
    return text_length_histogram(t.texts(), ["doc_id"], v.TOK)


def rounded(df, *names):
    for name in names:
        df = df.withColumn(name, F.round(name, 6))
    return df


@query("length_stats", v.with_views(STATS_SQL, lengths=LENGTHS))
def length_stats(t: Tables):
    return rounded(profile.length_stats(histogram(t)), "mean_length", "std_length")


@query("length_percentiles", v.with_views(PERCENTILE_SQL, lengths=LENGTHS))
def length_percentiles(t: Tables):
    return rounded(profile.length_percentiles(histogram(t)), "length", "coverage")


@query("length_coverage", v.with_views(COVERAGE_SQL, lengths=LENGTHS))
def length_coverage(t: Tables):
    return rounded(
        profile.length_coverage(histogram(t)), "coverage", "truncated", "mean_excess"
    )


@query("length_recommend", v.with_views(RECOMMEND_SQL, lengths=LENGTHS))
def length_recommend(t: Tables):
    return rounded(profile.length_recommend(histogram(t)), "length")


def _long(section: str, item: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {item} AS item, '{c}' AS metric, "
        f"{c}::DOUBLE AS value FROM {section}"
        for c in columns
    )


@query(
    "length_report",
    v.with_views(
        " UNION ALL ".join(
            [
                _long("stats", "'all'", ("n", "mean_length", "median_length", "std_length",
                                         "min_length", "max_length")),
                _long("percentile", "percentile::VARCHAR", ("length", "coverage")),
                _long("coverage", "context_length::VARCHAR",
                      ("coverage", "n_truncated", "truncated", "mean_excess")),
                _long("recommend", "target::VARCHAR", ("length",)),
            ]
        ),
        lengths=LENGTHS,
        stats=(("lengths",), STATS_SQL),
        percentile=(("lengths",), PERCENTILE_SQL),
        coverage=(("lengths",), COVERAGE_SQL),
        recommend=(("lengths",), RECOMMEND_SQL),
    ),
)
def length_report(t: Tables):
    return rounded(full_report(histogram(t)), "value")


PRICE_SKETCH = 200


@query(
    "quantile_sketch",
    "SELECT l_returnflag, p::DOUBLE AS percentile, count(*) AS n_rows, true AS within FROM lineitem, "
    f"(SELECT unnest({list(PERCENTILES)}) AS p) GROUP BY ALL",
)
def quantile_sketch(t: Tables):
    """Quantiles of prices from stored sketches of parts: is each one's rank within the error?

    The error holds with 99 percent confidence; twice of it in practice always.
    """
    price = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    parts = profile.value_sketches(t.lineitem, price, ("l_returnflag", "l_linestatus"), PRICE_SKETCH)
    stored = staged(parts, "sketches")
    found = profile.sketch_percentiles(
        profile.merge_sketches(stored, ("l_returnflag",), PRICE_SKETCH), ("l_returnflag",)
    )
    met = t.lineitem.select("l_returnflag", price.alias("price")).join(found, "l_returnflag")
    below, upto = (F.count_if(c) / F.count("*") for c in (F.col("price") < F.col("value"), F.col("price") <= F.col("value")))
    share, error = F.col("percentile") / 100, 2 * profile.rank_error(PRICE_SKETCH)
    counted = met.groupBy("l_returnflag", "percentile").agg(F.count("*").alias("n_rows"), below.alias("lo"), upto.alias("hi"))
    within = (share >= F.col("lo") - error) & (share <= F.col("hi") + error)
    return counted.select("l_returnflag", "percentile", "n_rows", within.alias("within"))


@query(
    "epoch_steps",
    "SELECT count(*) AS n_rows, 64::BIGINT AS effective_batch, ceil(count(*) / 64)::BIGINT AS steps "
    "FROM documents",
)
def epoch_steps(t: Tables):
    return profile.epoch_steps(t.documents, batch=16, accumulate=2, workers=2)


@query(
    "embedding_mean",
    """SELECT pos::INT AS pos, round(avg(x::DOUBLE), 6) AS mean FROM
    (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)
  GROUP BY pos""",
)
def embedding_mean(t: Tables):
    return rounded(profile.vector_mean(t.embeddings), "mean")


@query(
    "embedding_init",
    """SELECT pos::INT AS pos, round(mean + 0.01 * sqrt(-2 * ln(u)) * cos(2 * pi() * w), 6) AS value
  FROM (SELECT pos, mean,
      (('0x' || substr(md5('42:a:' || pos), 1, 12))::BIGINT::DOUBLE + 1) / 281474976710657.0 AS u,
      (('0x' || substr(md5('42:b:' || pos), 1, 12))::BIGINT::DOUBLE + 1) / 281474976710657.0 AS w
    FROM (SELECT pos, avg(x::DOUBLE) AS mean FROM
      (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)
      GROUP BY pos))""",
)
def embedding_init(t: Tables):
    return rounded(profile.new_vector(t.embeddings), "value")
