"""Quality rules, and host-level rules with shrunken failure rates.

Words are runs of other characters than space, tab, LF, VT, FF and CR.  Each
document is judged by itself inside its row (``base``); the failures are then
counted by host (a null host is a host of its own), and every host's failure rate
is shrunk towards a beta prior fitted to all hosts by the method of moments:

    rate = (failed + a) / (documents + a + b)

so that a host with few documents is judged by the prior rather than by chance.
A host fails when its rate exceeds MAX_RATE, and all its documents with it.

Only functions of DataFrames: array expressions in the row, one partial count by
host before the shuffle, two numbers of the prior through the driver, and a join
of one row per host back to the documents.
Null and empty texts have no words and fail the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quizlake.functions.text import let
from quizlake.llm.common import fresh
from quizlake.sources.storage import settle

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED, WINDOW = 10, 20, 5
MAX_RATE = 0.5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def repeated_words(ws: Column, n: int = WINDOW) -> Column:
    """Words in windows of ``n`` words that stand twice or more in the array: the
    windows' hashes are sorted with their places, equal neighbours mark places,
    and the places cover min(n, distance to the next) words each."""
    starts = F.sequence(F.lit(0), F.size(ws) - n)
    hashes = F.array_sort(F.transform(starts, lambda i: F.struct(
        F.xxhash64(*[F.get(ws, i + k) for k in range(n)]).alias("h"), i.alias("i"))))

    def equal(a: Column, b: Column) -> Column:
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.least(F.lit(n), F.coalesce(F.get(places, j + 1) - p, F.lit(n))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def marked(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: equal(x, F.get(s, j + 1)) | equal(x, F.get(s, j - 1)))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    return F.when(F.size(ws) <= n, 0).otherwise(let(hashes, lambda s: let(marked(s), covered)))


def base(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with COUNTS (long) and ``base_failed``."""
    x = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(x, "\n"), lambda v: F.regexp_replace(v, SPACE, "") != "")
    counted = let(
        words(F.col(text)),
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.aggregate(ws, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
            (F.length(x) - F.length(F.translate(x, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda v: F.size(v) - F.size(F.array_distinct(v))).cast("long").alias("n_dup_lines"),
            repeated_words(ws).cast("long").alias("n_repeat_words"),
        ),
    )
    # a generator is evaluated once for its row, however often its fields are used
    kept = [F.col(c) for c in docs.columns if c not in (*COUNTS, "base_failed")]
    found = docs.select(*kept, F.inline(F.array(counted)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def host_rates(judged: DataFrame, host: str) -> DataFrame:
    """(host, n_docs, n_failed, rate) with rates shrunk towards the beta prior."""
    hosts = judged.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    raw = F.col("n_failed") / F.col("n_docs")
    # moments over hosts of two or more documents; the variance is that of the
    # raw rates less what drawing the documents adds
    several = F.when(F.col("n_docs") > 1, raw)
    prior = hosts.agg(
        F.avg(several).alias("m"),
        F.var_pop(several).alias("v"),
        F.avg(F.when(F.col("n_docs") > 1, raw * (1 - raw) / (F.col("n_docs") - 1))).alias("noise"),
        (F.sum("n_failed") / F.sum("n_docs")).alias("overall"),
    )
    m, v = F.coalesce("m", "overall"), F.greatest(F.col("v") - F.col("noise"), F.lit(1e-6))
    strength = F.greatest(F.coalesce(m * (1 - m) / v - 1, F.lit(1.0)), F.lit(1e-3))
    found = prior.select((m * strength).alias("a"), ((1 - m) * strength).alias("b")).first()
    a, b = (F.lit(float(found[k] or 0.0)) for k in ("a", "b"))
    return hosts.select("host", "n_docs", "n_failed", ((F.col("n_failed") + a) / (F.col("n_docs") + a + b)).alias("rate"))


def with_verdicts(judged: DataFrame, rates: DataFrame, host: str) -> DataFrame:
    key = fresh("host", judged.columns)
    rates = rates.select(F.col("host").alias(key), F.col("rate").alias("host_rate"))
    return (
        judged.drop("host_rate", "kept")
        .join(rates, F.col(host).eqNullSafe(F.col(key)), "left")
        .drop(key)
        .withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= MAX_RATE))
    )


def quality_rules(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with COUNTS, base_failed, host_rate and kept; columns that have
    these names are replaced.  An empty table gives an empty table."""
    return with_verdicts(base(docs, text), host_rates(base(docs.select(host, text), text), host), host)


def verdicts(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """As ``quality_rules`` without the texts: each text is judged once, and the
    small table of counts is written before the hosts are summed up."""
    judged = settle(base(docs, text).drop(text))
    return with_verdicts(judged, host_rates(judged, host), host)


SQL = f"""
with w as (select doc_id, source, coalesce(text, '') x,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0b\\x0c\\r]+'), lambda w: w != '') ws from documents),
g as (select doc_id, unnest(generate_series(0, len(ws) - {WINDOW})) i, ws from w where len(ws) >= {WINDOW}),
h as (select doc_id, i, array_to_string(ws[i + 1 : i + {WINDOW}], ' ') g from g),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) n from h) where n > 1),
c as (select doc_id, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) n from (
    select doc_id, i, lead(i) over (partition by doc_id order by i) nxt from r) group by doc_id),
b as (select w.doc_id, source, cast(len(ws) as bigint) n_words, cast(length(array_to_string(ws, '')) as bigint) word_chars,
    cast(length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) as bigint) n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) n_dup_lines, cast(coalesce(c.n, 0) as bigint) n_repeat_words
  from (select *, list_filter(string_split(x, chr(10)), lambda v: regexp_matches(v, '[^ \\t\\n\\x0b\\x0c\\r]')) l from w) w
  left join c using (doc_id)),
f as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words base_failed from b),
s as (select source, count(*) n, sum(base_failed::int) k from f group by source),
m as (select coalesce(avg(case when n > 1 then k / n end), sum(k) / sum(n)) m,
    greatest(var_pop(case when n > 1 then k / n end) - avg(case when n > 1 then k / n * (1 - k / n) / (n - 1) end), 1e-6) v from s),
p as (select m, greatest(coalesce(m * (1 - m) / v - 1, 1.0), 1e-3) z from m),
q as (select source, (k + m * z) / (n + z) rate from s, p)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and rate <= {MAX_RATE} kept
from f join q on q.source is not distinct from f.source
"""
