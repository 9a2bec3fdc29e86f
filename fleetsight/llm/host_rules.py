"""Quality rules for documents, and verdicts on the hosts that they come from.

Everything is DataFrame expressions. Each document's rules are computed in its own row from arrays
of its words and lines, so no text is shuffled. Rule failures are then counted by host (combined
before the shuffle), each host's rate is shrunk towards the corpus by an empirical beta prior, and
the hosts' verdicts are joined back.

Defined cases: null text has no words and fails; a null host is a host of its own; a null id or
repeated rows are kept as they are; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetsight.llm.common import WORD, staged

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5

RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text.

    The windows' hashes are sorted with their places; those with an equal neighbour repeat. Put
    in order of place, each window adds the words that the window before it doesn't cover.
    """
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.struct(
            F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)).alias("h"), i.alias("i")
        ),
    )

    def repeats(ordered: Column) -> Column:  # neighbours are compared by shifting the array by one on either side
        none = F.array(F.struct(F.lit(None).cast("long").alias("h"), F.lit(None).cast("int").alias("i")))
        before = F.concat(none, F.slice(ordered, 1, F.size(ordered) - 1))
        after = F.concat(F.slice(ordered, 2, F.size(ordered)), none)
        zipped = F.arrays_zip(ordered.alias("o"), before.alias("b"), after.alias("a"))
        twice = F.filter(zipped, lambda z: (z["o"]["h"] == z["b"]["h"]) | (z["o"]["h"] == z["a"]["h"]))
        return F.sort_array(F.transform(twice, lambda z: z["o"]["i"]))

    def covered(places: Column) -> Column:
        steps = F.zip_with(
            F.slice(places, 2, F.size(places)), F.slice(places, 1, F.size(places) - 1), lambda b, a: F.least(F.lit(3), b - a)
        )
        return F.lit(3) + F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    hashes = F.array_distinct(F.transform(windows, lambda w: w["h"]))
    once = F.size(hashes) == F.size(words) - 2
    # transform over an array of one binds an intermediate result, so that it is computed once
    places = F.element_at(F.transform(F.array(F.sort_array(windows)), repeats), 1)
    count = F.element_at(F.transform(F.array(places), covered), 1)
    return F.when((F.size(words) < 3) | once, F.lit(0)).otherwise(count).cast("long")


def document_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rules' figures for each document: doc_id, host, RULES and base_failed."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), text.alias("body"))
    lines = F.filter(F.split("body", "\n"), lambda x: x.rlike(WORD))
    arrays = source.select("doc_id", "host", "body", F.regexp_extract_all("body", F.lit(WORD), F.lit(0)).alias("words"), lines.alias("lines"))
    n_words = F.size("words").cast("long")
    repeat = _repeated_words(F.col("words"))
    figures = arrays.select(
        "doc_id",
        "host",
        n_words.alias("n_words"),
        F.length(F.regexp_replace("body", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return figures.withColumn("base_failed", failed)


def host_verdicts(rules: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row for each host: host, documents, failures, host_rate (shrunk), host_kept.

    The prior's mean and strength come from the hosts' own rates by the method of moments: with
    mean m and variance v of the rates weighted by documents, and k the mean of the hosts' sizes
    so weighted, the part of v that binomial noise m(1-m)/k doesn't explain gives
    strength = m(1-m)/(v - m(1-m)/k) - 1, within 1 and 1,000,000.
    """
    hosts = rules.groupBy("host").agg(F.count("*").alias("documents"), F.sum(F.col("base_failed").cast("long")).alias("failures"))
    spark = rules.sparkSession
    counts = staged(hosts, "hosts")
    n, rate = F.col("documents"), F.col("failures") / F.col("documents")
    totals = counts.agg(F.sum("documents").alias("n"), F.sum("failures").alias("f"), F.sum(n * rate * rate).alias("s"), F.count("*").alias("h"))
    row = totals.first()  # four numbers
    prior_mean, strength = _prior(row.n or 0, row.f or 0, row.s or 0.0, row.h)
    shrunk = (F.col("failures") + F.lit(prior_mean * strength)) / (F.col("documents") + F.lit(strength))
    return counts.withColumn("host_rate", shrunk).withColumn("host_kept", F.col("host_rate") <= max_rate)


def _prior(n: int, failures: int, squares: float, hosts: int) -> tuple[float, float]:
    if not n:
        return 0.0, 1.0
    mean = failures / n
    noise = mean * (1 - mean)
    excess = squares / n - mean * mean - noise * hosts / n
    strength = noise / excess - 1 if excess > 0 else 1e6
    return mean, min(max(strength, 1.0), 1e6)


def apply_host_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_rate: float = MAX_HOST_RATE
) -> DataFrame:
    """doc_id, RULES, base_failed, host_rate and kept for each document.

    The figures are staged without the texts, so that the texts are read once. The verdicts are
    joined by host; a host with a third of all documents is split by AQE, as one side is a row a host.
    """
    rules = staged(document_rules(docs, id_col, text_col, host_col), "rules")
    verdicts = host_verdicts(rules, max_rate).select(F.col("host").alias("of"), "host_rate", "host_kept")
    joined = rules.join(verdicts, rules["host"].eqNullSafe(verdicts["of"]), "left")
    return joined.select("doc_id", *RULES, "base_failed", "host_rate", (~F.col("base_failed") & F.col("host_kept")).alias("kept"))
